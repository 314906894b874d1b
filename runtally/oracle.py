"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark plans: the detection feed is derived
directly from the driver tables (no text round trip), individuals follow
the literal population-then-summary form, medians are spelled out from a
sorted list. Each query is ``WITH <needed CTEs> SELECT ...``; CTEs are
named fragments resolved by dependency.
"""

from __future__ import annotations

import re

from runtally import config as C
from runtally.sources import fixtures as FX

CFG = C.FIXTURE_CONFIG


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def _case(expr: str, mapping: dict, default: str | None) -> str:
    arms = " ".join(f"WHEN {k if isinstance(k, int) else _q(k)} THEN {_q(v)}" for k, v in mapping.items())
    tail = f" ELSE {_q(default)}" if default is not None else ""
    return f"CASE {expr} {arms}{tail} END"


def _cur_sy(species: str = "species", cfg: C.RunConfig = CFG) -> str:
    day = f"DATE '{cfg.as_of.isoformat()}'"
    return (
        f"CAST(CASE WHEN {species} = 'Steelhead' AND dayofyear({day}) >= 183 THEN year({day}) + 1 "
        f"WHEN {species} IN {_in(cfg.species)} THEN year({day}) END AS INTEGER)"
    )


def _max_dummy(species: str = "species") -> str:
    arms = " ".join(f"WHEN {_q(s)} THEN DATE '{d.isoformat()}'" for s, d in C.SPECIES_MAX_DUMMY.items())
    return f"CASE {species} {arms} END"


def _dummy(day: str, species: str = "species") -> str:
    doy = f"CAST(dayofyear({day}) AS INTEGER)"
    return (
        f"CASE WHEN {species} = 'Steelhead' AND {doy} < 183 THEN DATE '1977-01-01' + {doy} "
        f"ELSE DATE '1976-01-01' + ({doy} - 1) END"
    )


def _median(x: str) -> str:
    """Exact interpolating median, spelled as Spark's percentile computes it."""
    s = f"list_sort(list({x}) FILTER (WHERE {x} IS NOT NULL))"
    n = f"count({x})"
    return (
        f"(CASE WHEN {n} = 0 THEN NULL WHEN {n} % 2 = 1 THEN {s}[({n} + 1) // 2] "
        f"ELSE 0.5 * {s}[{n} // 2] + 0.5 * {s}[{n} // 2 + 1] END)"
    )


def _elapsed(later: str, earlier: str) -> str:
    return (
        f"CAST(epoch_us(timezone('America/Los_Angeles', {later})) - "
        f"epoch_us(timezone('America/Los_Angeles', {earlier})) AS DOUBLE) / CAST(86400000000 AS DOUBLE)"
    )


AS_OF = f"DATE '{CFG.as_of.isoformat()}'"
FLOOR = CFG.floor_year
FINAL = _in(C.FINAL_ENTRY_SITES)
KEPT = _in(C.ALWAYS_KEPT_RELEASE_SITES)
JUV_SITES = _in(C.JUVENILE_RELEASE_SITES)
RECLASS = _in(C.RECLASSIFY_SPECIES)


def _token_map(m: dict) -> dict:
    return {k: v.split(" ")[0] for k, v in m.items()}


CTES: dict[str, str] = {}

CTES["det"] = """
SELECT pit_id, species, rear_type, CAST(NULL AS VARCHAR) AS run_type, release_sitecode, release_lifestage,
       release_datetime, CAST(year(release_datetime) AS INTEGER) AS release_year,
       observation_sitecode, observation_datetime,
       CAST(month(observation_datetime) AS INTEGER) AS observation_month,
       CAST(year(observation_datetime) AS INTEGER) AS observation_year,
       CAST(year(observation_datetime) - year(release_datetime) AS INTEGER) AS yrs_at_large,
       CAST(CASE WHEN dayofyear(observation_datetime) >= 183 AND species = 'Steelhead'
                 THEN year(observation_datetime) + 1 ELSE year(observation_datetime) END AS INTEGER) AS spawn_year,
       length_mm, ordinal
FROM det0"""

CTES["ds_time"] = """
SELECT pit_id, max(ds_datetime) AS latest_downstream FROM ds GROUP BY pit_id
HAVING max(ds_datetime) IS NOT NULL"""

CTES["ds_latest"] = """
SELECT pit_id, ds_datetime, ds_site FROM (
  SELECT *, row_number() OVER (PARTITION BY pit_id ORDER BY ds_datetime DESC, ord_line, ord_part, ord_supp) AS rn
  FROM ds WHERE ds_datetime IS NOT NULL) WHERE rn = 1"""

# ----------------------------------------------------------------- live
CTES["juv_latest"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY pit_id ORDER BY observation_datetime DESC, ordinal) AS rn
  FROM cur_det WHERE release_lifestage = 'Juvenile' AND observation_datetime IS NOT NULL) WHERE rn = 1"""

CTES["juv_pass"] = """
SELECT j.*, d.latest_downstream FROM juv_latest j JOIN live_ds_time d ON j.pit_id = d.pit_id
WHERE d.latest_downstream < j.observation_datetime"""

CTES["pop_live"] = f"""
SELECT * FROM cur_det
WHERE pit_id IN (SELECT pit_id FROM juv_pass) OR release_lifestage = 'Adult' OR release_sitecode IN {KEPT}"""

CTES["marks_live"] = """
SELECT pit_id, arg_min_null(species, ordinal) AS species, arg_min_null(spawn_year, ordinal) AS spawn_year,
       arg_min_null(release_sitecode, ordinal) AS release_sitecode,
       arg_min_null(release_datetime, ordinal) AS release_datetime
FROM cur_det GROUP BY pit_id"""

CTES["ind_live_sum"] = f"""
SELECT pit_id, arg_min_null(observation_datetime, ordinal) AS sfc_first,
       arg_max_null(observation_datetime, ordinal) FILTER (WHERE observation_sitecode IN {FINAL}) AS final_raw,
       avg(length_mm) AS length_mm, arg_min_null(release_lifestage, ordinal) AS release_lifestage
FROM pop_live GROUP BY pit_id"""

CTES["individuals_live"] = f"""
SELECT s.pit_id, s.sfc_first, coalesce(s.final_raw, s.sfc_first) AS sfc_entry_final,
       {_elapsed('s.final_raw', 's.sfc_first')} AS sfc_diff,
       s.length_mm, s.release_lifestage, m.species, m.spawn_year, m.release_sitecode, m.release_datetime
FROM ind_live_sum s LEFT JOIN marks_live m ON s.pit_id = m.pit_id"""


def _daily(src: str, zone: str | None = None) -> str:
    day = "sfc_entry_final" if zone is None else f"timezone('{zone}', timezone('America/Los_Angeles', sfc_entry_final))"
    return f"""
SELECT sfc_final_date, spawn_year, species, n,
       CAST(sum(n) OVER (PARTITION BY spawn_year, species) AS BIGINT) AS sy_total,
       CAST(sum(n) OVER (PARTITION BY spawn_year, species ORDER BY sfc_final_date NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_total
FROM (SELECT CAST({day} AS DATE) AS sfc_final_date, spawn_year, species, count(*) AS n
      FROM {src} GROUP BY ALL)"""


CTES["daily"] = """
SELECT sfc_final_date, spawn_year, species, n, sy_total, cumulative_total,
       CAST(n AS DOUBLE) / CAST(sy_total AS DOUBLE) AS daily_prop,
       CAST(cumulative_total AS DOUBLE) / CAST(sy_total AS DOUBLE) AS daily_cumulative
FROM daily0"""

# ------------------------------------------------------------ completed
CTES["cdet_re"] = f"""
SELECT * REPLACE (
  CASE WHEN release_lifestage IS NULL AND length_mm <= 300 AND species IN {RECLASS} THEN 'Juvenile'
       WHEN release_lifestage IS NULL AND length_mm > 300 AND species IN {RECLASS} THEN 'Adult'
       WHEN release_lifestage = 'Adult' AND length_mm <= 300 AND species IN {RECLASS} THEN 'Juvenile'
       WHEN release_lifestage IS NULL AND length_mm IS NULL AND species IN {RECLASS} THEN 'Juvenile'
       ELSE release_lifestage END AS release_lifestage,
  run_name AS run_type)
FROM (SELECT d.*, d0.run_name FROM det d JOIN det0 d0 ON d.ordinal = d0.ordinal)"""

CTES["cdet"] = """
SELECT * EXCLUDE (run_name) FROM cdet_re WHERE NOT (yrs_at_large = 0 AND release_lifestage = 'Juvenile')"""

CTES["cjuv"] = f"""
SELECT * EXCLUDE (rn, latest_downstream) FROM (
  SELECT j.*, d.latest_downstream FROM (
    SELECT *, row_number() OVER (PARTITION BY pit_id ORDER BY observation_datetime DESC, ordinal) AS rn
    FROM cdet WHERE release_lifestage = 'Juvenile' AND release_sitecode IN {JUV_SITES}
      AND observation_datetime IS NOT NULL) j
  JOIN ds_time d ON j.pit_id = d.pit_id
  WHERE j.rn = 1 AND j.observation_datetime > d.latest_downstream)"""

CTES["cpop"] = f"""
SELECT *, 0 AS src FROM cdet WHERE release_lifestage = 'Adult' OR release_sitecode IN {KEPT}
UNION ALL
SELECT *, 1 AS src FROM cjuv"""

CTES["cpop_o"] = "SELECT *, src * CAST(100000000000 AS BIGINT) + ordinal AS ord2 FROM cpop"

CTES["cmarks"] = """
SELECT pit_id, arg_min_null(release_sitecode, ord2) AS release_sitecode,
       arg_min_null(release_datetime, ord2) AS release_datetime
FROM cpop_o GROUP BY pit_id"""

CTES["cind_sum"] = f"""
SELECT pit_id, species, spawn_year, arg_min_null(observation_datetime, ord2) AS sfc_first,
       arg_max_null(observation_datetime, ord2) FILTER (WHERE observation_sitecode IN {FINAL}) AS final_raw,
       avg(length_mm) AS length_mm, arg_min_null(release_lifestage, ord2) AS release_lifestage
FROM cpop_o GROUP BY pit_id, species, spawn_year"""

CTES["individuals_completed"] = f"""
SELECT s.pit_id, s.species, s.spawn_year, s.sfc_first, coalesce(s.final_raw, s.sfc_first) AS sfc_entry_final,
       {_elapsed('s.final_raw', 's.sfc_first')} AS sfc_diff, s.length_mm, s.release_lifestage,
       m.release_sitecode, m.release_datetime
FROM cind_sum s LEFT JOIN cmarks m ON s.pit_id = m.pit_id
WHERE s.spawn_year IS NOT NULL"""

CTES["cdaily0"] = _daily("individuals_completed")
# ------------------------------------------------------------- progress
CTES["dc"] = f"""
SELECT *, CAST(dayofyear(sfc_final_date) AS INTEGER) AS day_of_year, {_dummy('sfc_final_date')} AS dummy_date
FROM daily_completed"""

CTES["min_dummy"] = "SELECT species, min(dummy_date) AS min_dummy FROM dc GROUP BY species"

CTES["grid_c"] = f"""
SELECT species, spawn_year, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS dummy_date
FROM (SELECT dc.species, dc.spawn_year, min(m.min_dummy) AS lo, max({_max_dummy('dc.species')}) AS hi
      FROM dc LEFT JOIN min_dummy m ON dc.species = m.species GROUP BY dc.species, dc.spawn_year)
WHERE lo <= hi"""

CTES["cd_join"] = """
SELECT coalesce(g.species, dc.species) AS species, coalesce(g.spawn_year, dc.spawn_year) AS spawn_year,
       coalesce(g.dummy_date, dc.dummy_date) AS dummy_date, dc.sfc_final_date,
       coalesce(dc.n, 0) AS n, dc.sy_total, dc.cumulative_total, coalesce(dc.daily_prop, 0.0) AS daily_prop,
       dc.daily_cumulative, dc.current_sy, dc.day_of_year
FROM grid_c g FULL OUTER JOIN dc
  ON g.species IS NOT DISTINCT FROM dc.species AND g.spawn_year IS NOT DISTINCT FROM dc.spawn_year
 AND g.dummy_date IS NOT DISTINCT FROM dc.dummy_date"""

_W_FILL = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

CTES["complete_daily"] = f"""
SELECT species, spawn_year, dummy_date, sfc_final_date, n,
       last_value(sy_total IGNORE NULLS) OVER w AS sy_total,
       last_value(cumulative_total IGNORE NULLS) OVER w AS cumulative_total,
       last_value(daily_prop IGNORE NULLS) OVER w AS daily_prop,
       last_value(daily_cumulative IGNORE NULLS) OVER w AS daily_cumulative,
       current_sy, day_of_year
FROM cd_join
WINDOW w AS (PARTITION BY species, spawn_year ORDER BY dummy_date NULLS LAST {_W_FILL})"""

CTES["dcur"] = f"""
SELECT *, CAST(dayofyear(sfc_final_date) AS INTEGER) AS day_of_year, {_dummy('sfc_final_date')} AS dummy_date
FROM daily"""

CTES["grid_cur"] = f"""
SELECT species, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS dummy_date
FROM (SELECT species, min(dummy_date) AS lo, max({_max_dummy('species')}) AS hi FROM dcur GROUP BY species)
WHERE lo <= hi"""

CTES["cc_join"] = """
SELECT coalesce(g.species, d.species) AS species, coalesce(g.dummy_date, d.dummy_date) AS dummy_date,
       d.sfc_final_date, d.spawn_year, coalesce(d.n, 0) AS n, d.sy_total, d.cumulative_total,
       coalesce(d.daily_prop, 0.0) AS daily_prop, d.daily_cumulative, d.day_of_year
FROM grid_cur g FULL OUTER JOIN dcur d
  ON g.species IS NOT DISTINCT FROM d.species AND g.dummy_date IS NOT DISTINCT FROM d.dummy_date"""

CTES["complete_current"] = f"""
SELECT species, dummy_date, sfc_final_date,
       last_value(spawn_year IGNORE NULLS) OVER w AS spawn_year, n,
       last_value(sy_total IGNORE NULLS) OVER w AS sy_total,
       last_value(cumulative_total IGNORE NULLS) OVER w AS cumulative_total,
       last_value(daily_prop IGNORE NULLS) OVER w AS daily_prop,
       last_value(daily_cumulative IGNORE NULLS) OVER w AS daily_cumulative,
       day_of_year
FROM cc_join
WINDOW w AS (PARTITION BY species ORDER BY dummy_date NULLS LAST {_W_FILL})"""

CTES["alldaily"] = f"""
SELECT species, spawn_year, sfc_final_date, n, dummy_date, sy_total, cumulative_total, daily_prop,
       daily_cumulative, day_of_year,
       CAST(sum(n) OVER (PARTITION BY spawn_year, species ORDER BY dummy_date NULLS LAST,
            sfc_final_date NULLS LAST {_W_FILL}) AS BIGINT) AS daily_cumulative_n
FROM (
  SELECT species, spawn_year, sfc_final_date, n, dummy_date, CAST(NULL AS BIGINT) AS sy_total,
         CAST(NULL AS BIGINT) AS cumulative_total, CAST(NULL AS DOUBLE) AS daily_prop,
         CAST(NULL AS DOUBLE) AS daily_cumulative, CAST(NULL AS INTEGER) AS day_of_year
  FROM complete_daily
  UNION ALL
  SELECT species, spawn_year, sfc_final_date, n, dummy_date, sy_total, cumulative_total, daily_prop,
         daily_cumulative, day_of_year
  FROM complete_current)"""

CTES["run_stats"] = f"""
SELECT dummy_date, species,
       CAST(round_even({_median('prop_complete')} * 100.0, 0) AS DOUBLE) AS median_percentcomplete,
       CAST(round_even(min(prop_complete) * 100.0, 0) AS DOUBLE) AS min_percentcomplete,
       CAST(round_even(max(prop_complete) * 100.0, 0) AS DOUBLE) AS max_percentcomplete
FROM rs_in GROUP BY dummy_date, species"""

# ------------------------------------------------------------ dashboard
CTES["flow_daily"] = """
SELECT CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS mean_temp, max(l_extendedprice) AS mean_discharge
FROM lineitem GROUP BY CAST(l_shipdate AS DATE)"""

_DOY = CFG.as_of.timetuple().tm_yday


def _today_dummy(species: str = "species", cfg: C.RunConfig = CFG) -> str:
    doy = cfg.as_of.timetuple().tm_yday
    return (
        f"CASE WHEN {species} = 'Steelhead' AND {doy} < 183 THEN DATE '1977-01-01' + {doy} "
        f"ELSE DATE '1976-01-01' + {doy} END"
    )


_KNOWN = _in(CFG.species)



def config_ctes(cfg: C.RunConfig) -> dict[str, str]:
    """The CTEs that depend on the run parameters (as-of date, floor year)."""
    as_of = f"DATE '{cfg.as_of.isoformat()}'"
    doy = cfg.as_of.timetuple().tm_yday
    known = _in(cfg.species)
    cur = _cur_sy("species", cfg)
    # a 12-hour clock read without its marker keeps hour % 12
    live_time = "ds_datetime" if cfg.ampm == "parse" else "ds_datetime - to_hours(CAST(hour(ds_datetime) - hour(ds_datetime) % 12 AS INTEGER))"
    category = "CASE WHEN spawn_year = current_sy THEN 'Current' WHEN spawn_year <> current_sy THEN 'Previous' END"
    return {
        "det0": f"""
SELECT 'T' || CAST(o.o_custkey AS VARCHAR) AS pit_id,
       o.o_orderkey AS ordinal,
       {_case('c.c_mktsegment', FX.SEGMENT_SPECIES, FX.OTHER_SPECIES)} AS species,
       {_case('c.c_nationkey % 3', FX.NATION_REAR, FX.OTHER_REAR)} AS rear_type,
       {_case('c.c_nationkey % 4', FX.NATION_RUN, FX.OTHER_RUN)} AS run_name,
       {_case('o.o_custkey % 6', _token_map(FX.CUSTKEY_RELEASE_SITE), FX.OTHER_RELEASE_SITE.split(' ')[0])} AS release_sitecode,
       {_case('o.o_orderstatus', FX.STATUS_STAGE, None)} AS release_lifestage,
       DATE '1994-01-01' + CAST(o.o_custkey * 37 % 1500 AS INTEGER) AS release_datetime,
       {_case('substr(o.o_orderpriority, 1, 1)', _token_map(FX.PRIORITY_SITE), FX.OTHER_SITE.split(' ')[0])} AS observation_sitecode,
       o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) + to_minutes(CAST(o.o_orderkey % 60 AS INTEGER)) - to_days({FX.shift_days(cfg)}) AS observation_datetime,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_totalprice % 900 + 100 END AS length_mm
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
        "ds": f"""
SELECT 'T' || CAST(o.o_custkey AS VARCHAR) AS pit_id,
       {_case('l.l_returnflag', _token_map(FX.RETURNFLAG_SITE), FX.OTHER_DOWNSTREAM_SITE.split(' ')[0])} AS ds_site,
       l.l_shipdate + to_hours(CAST((l.l_orderkey + l.l_linenumber) % 24 AS INTEGER)) + to_minutes(CAST(l.l_partkey % 60 AS INTEGER))
         - to_days(CAST({FX.shift_days(cfg)} + o.o_custkey % {FX.DOWNSTREAM_STEPS} * {FX.DOWNSTREAM_STEP_DAYS} AS INTEGER)) AS ds_datetime,
       l.l_orderkey * 10 + l.l_linenumber AS ord_line, l.l_partkey AS ord_part, l.l_suppkey AS ord_supp
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
        "live_ds_time": f"""
SELECT pit_id, max({live_time}) AS latest_downstream FROM ds GROUP BY pit_id
HAVING max(ds_datetime) IS NOT NULL""",
        "daily0": _daily("individuals_live", cfg.entry_date_zone),
        "cur_det": f"""
SELECT * FROM (SELECT *, {cur} AS current_sy FROM det) WHERE spawn_year = current_sy""",
        "daily_completed": f"""
SELECT * FROM (
  SELECT sfc_final_date, spawn_year, species, n, sy_total, cumulative_total,
         CAST(n AS DOUBLE) / CAST(sy_total AS DOUBLE) AS daily_prop,
         CAST(cumulative_total AS DOUBLE) / CAST(sy_total AS DOUBLE) AS daily_cumulative,
         {cur} AS current_sy
  FROM cdaily0) WHERE spawn_year <> current_sy""",
        "rs_in": f"""
SELECT *, CAST(daily_cumulative_n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY spawn_year, species) AS DOUBLE) AS prop_complete
FROM alldaily WHERE spawn_year > {cfg.floor_year} AND spawn_year < {cur}""",
        "flow": f"""
SELECT date, mean_temp, mean_discharge, 1 AS "group" FROM flow_daily
WHERE date >= (SELECT min(sfc_final_date) FROM daily) AND date <= {as_of}""",
        "ytd": f"""
SELECT *, {category} AS yr_category, CAST(dayofyear(dummy_date) AS INTEGER) AS dummy_jday
FROM (SELECT *, {cur} AS current_sy,
             CASE WHEN species IN {known} THEN {doy} END AS today_jday,
             CASE WHEN species IN {known} THEN {_today_dummy('species', cfg)} END AS today_dummy
      FROM alldaily WHERE spawn_year > {cfg.floor_year})
WHERE ({category}) = 'Previous' OR dummy_date <= today_dummy""",
    }


CTES.update(config_ctes(CFG))


def status_dummy(cfg: C.RunConfig) -> str:
    return f"DATE '1976-01-01' + {cfg.as_of.timetuple().tm_yday - 1}"


STATUS_DUMMY = f"DATE '1976-01-01' + {_DOY - 1}"


def _cte_deps(body: str, ctes: dict[str, str]) -> list[str]:
    return [n for n in ctes if re.search(rf"\b{re.escape(n)}\b", body)]


def ctes_for(cfg: C.RunConfig) -> dict[str, str]:
    """The CTE library for another set of run parameters."""
    return {**CTES, **config_ctes(cfg)}


def with_ctes(select: str, ctes: dict[str, str] | None = None) -> str:
    """Prefix ``select`` with every CTE it needs, in dependency order."""
    ctes = CTES if ctes is None else ctes
    order: list[str] = []

    def visit(name: str, seen: tuple = ()):
        if name in order:
            return
        for dep in _cte_deps(ctes[name], ctes):
            if dep != name and dep not in seen:
                visit(dep, seen + (name,))
        order.append(name)

    for n in _cte_deps(select, ctes):
        visit(n)
    if not order:
        return select
    body = ",\n".join(f"{n} AS ({ctes[n]}\n)" for n in order)
    head = select.lstrip()
    if head[:4].upper() == "WITH":
        return f"WITH {body},\n{head[4:].lstrip()}"
    return f"WITH {body}\n{select}"
