"""Registered queries: one per operator of the survey's inventory.

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver tables with
the fixture parameters (``config.FIXTURE_CONFIG``), and has a DuckDB twin in
``SQL`` unless noted. Means over summed doubles are rounded to 6 places on
both sides so that summation order cannot change the compared values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtally import config as C
from runtally import oracle as O
from runtally.functions import columns as X
from runtally.operators import densify, ordered, relational, running, segmented, selection
from runtally.plans import canonical, completed, dashboard, jobs, live, progress
from runtally.plans.context import RunTables
from runtally.sources import feeds, fixtures, marts, river, shared

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}
CFG = C.FIXTURE_CONFIG
SPECIES_PARAM = "Steelhead"
ROUND = 6

def tables(spark: SparkSession, sf_dir: str, cfg: C.RunConfig = CFG) -> RunTables:
    return RunTables.from_driver_tables(spark, sf_dir, cfg)


def register(name: str, sql: str | None = None, cfg: C.RunConfig = CFG):
    ctes = O.CTES if cfg == CFG else O.ctes_for(cfg)

    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = O.with_ctes(sql, ctes)
        return fn
    return deco


def _r(c: str) -> F.Column:
    return F.round(F.col(c), ROUND).alias(c)


def _rs(c: str) -> str:
    return f"round({c}, {ROUND}) AS {c}"


DET_COLS = ", ".join(canonical.DETECTION_COLUMNS)

# ---------------------------------------------------------- canonical


@register("canonical_detections", f"SELECT {DET_COLS} FROM det")
def q_canonical(spark, sf):
    return tables(spark, sf).detections


@register("spawn_year", "SELECT pit_id, ordinal, species, observation_datetime, spawn_year FROM det")
def q_spawn_year(spark, sf):
    return tables(spark, sf).detections.select("pit_id", "ordinal", "species", "observation_datetime", "spawn_year")


@register(
    "reclassify_lifestage",
    """SELECT d.pit_id, d.ordinal, d.species, d.length_mm, d.yrs_at_large, d.release_lifestage AS mark_life_stage,
              r.release_lifestage
       FROM det d JOIN cdet_re r ON d.ordinal = r.ordinal""",
)
def q_reclassify(spark, sf):
    det = canonical.canonical_detections(tables(spark, sf).completed_raw)
    return det.select(
        "pit_id", "ordinal", "species", "length_mm", "yrs_at_large",
        F.col("release_lifestage").alias("mark_life_stage"),
        X.reclassify_lifestage("release_lifestage", "length_mm", "species").alias("release_lifestage"),
    )


@register("drop_same_year_juveniles", f"SELECT {DET_COLS} FROM cdet")
def q_drop_same_year(spark, sf):
    return tables(spark, sf).completed_detections


@register(
    "current_year_detections",
    f"SELECT {DET_COLS}, (SELECT max(spawn_year) FROM det) AS most_recent, current_sy FROM cur_det",
)
def q_current_year(spark, sf):
    t = tables(spark, sf)
    return canonical.current_year_detections(t.detections, CFG, with_most_recent=True)


@register("latest_downstream", "SELECT pit_id, ds_datetime, ds_site FROM ds_latest")
def q_latest_downstream(spark, sf):
    return canonical.latest_downstream(tables(spark, sf).downstream)


# --------------------------------------------------------------- live

@register(
    "migratory_juveniles_live",
    f"SELECT {DET_COLS}, current_sy, latest_downstream FROM juv_pass",
)
def q_juv_live(spark, sf):
    t = tables(spark, sf)
    return live.migratory_juveniles_live(t.current_detections, t.downstream_latest_time)


@register("population_live", f"SELECT {DET_COLS}, current_sy FROM pop_live")
def q_pop_live(spark, sf):
    t = tables(spark, sf)
    juv = live.migratory_juveniles_live(t.current_detections, t.downstream_latest_time).select("pit_id")
    return live.population_live(t.current_detections, juv, CFG)


@register("mark_attributes", "SELECT * FROM marks_live")
def q_marks(spark, sf):
    return live.mark_attributes(tables(spark, sf).current_detections)


def _round_len(df: DataFrame, cols) -> DataFrame:
    return df.select(*[_r(c) if c in ("length_mm", "mean_length", "mean_length_in") else F.col(c) for c in cols])


def _round_len_sql(cols) -> str:
    return ", ".join(_rs(c) if c in ("length_mm", "mean_length", "mean_length_in") else c for c in cols)


@register("individuals_live", f"SELECT {_round_len_sql(live.INDIVIDUAL_COLUMNS)} FROM individuals_live")
def q_ind_live(spark, sf):
    return _round_len(tables(spark, sf).individuals, live.INDIVIDUAL_COLUMNS)


@register("daily_entries", "SELECT * FROM daily")
def q_daily(spark, sf):
    return tables(spark, sf).daily


@register("flow_window", "SELECT * FROM flow")
def q_flow(spark, sf):
    return tables(spark, sf).flow


# ----------------------------------------------------------- completed

@register("migratory_juveniles_completed", f"SELECT {DET_COLS} FROM cjuv")
def q_juv_completed(spark, sf):
    return tables(spark, sf).completed_juveniles


@register(
    "population_completed",
    f"SELECT {DET_COLS.replace('ordinal', 'ordinal AS row')}, src AS source FROM cpop",
)
def q_pop_completed(spark, sf):
    p = tables(spark, sf).completed_population
    cols = [c for c in canonical.DETECTION_COLUMNS if c != "ordinal"]
    return p.select(*cols, F.col("ordinal.row").alias("row"), F.col("ordinal.source").alias("source"))


@register(
    "individuals_completed",
    f"SELECT {_round_len_sql(completed.INDIVIDUAL_COLUMNS)} FROM individuals_completed",
)
def q_ind_completed(spark, sf):
    return _round_len(tables(spark, sf).completed_individuals, completed.INDIVIDUAL_COLUMNS)


@register("daily_completed", "SELECT * FROM daily_completed")
def q_daily_completed(spark, sf):
    return tables(spark, sf).daily_completed


# ------------------------------------------------------------ progress

@register("complete_daily", "SELECT * FROM complete_daily")
def q_complete_daily(spark, sf):
    return tables(spark, sf).complete_daily


@register("complete_current", "SELECT * FROM complete_current")
def q_complete_current(spark, sf):
    return tables(spark, sf).complete_current


@register(
    "progress_reference",
    f"""SELECT dummy_date, species, {O._median('daily_cumulative')} AS median_cum, min(daily_cumulative) AS min_cum,
               max(daily_cumulative) AS max_cum, min(daily_prop) AS min_dailyprop,
               {O._median('daily_prop')} AS median_dailyprop, max(daily_prop) AS max_daily_prop
        FROM complete_daily GROUP BY dummy_date, species""",
)
def q_progress_reference(spark, sf):
    return progress.progress_reference(tables(spark, sf).complete_daily)


@register("all_years", "SELECT * FROM alldaily")
def q_all_years(spark, sf):
    return tables(spark, sf).alldaily


@register("run_stats", "SELECT * FROM run_stats")
def q_run_stats(spark, sf):
    return tables(spark, sf).run_stats


# ----------------------------------------------------------- dashboard

@register("latest_discharge", "SELECT * FROM flow ORDER BY date DESC LIMIT 1")
def q_latest_discharge(spark, sf):
    return dashboard.latest_discharge(tables(spark, sf).flow)


@register("year_to_date", "SELECT * FROM ytd")
def q_ytd(spark, sf):
    return tables(spark, sf).year_to_date


@register("earliest_entry", "SELECT species, spawn_year, min(sfc_final_date) AS earliest FROM ytd GROUP BY ALL")
def q_earliest(spark, sf):
    return dashboard.earliest_entry(tables(spark, sf).year_to_date)


@register(
    "run_end_date",
    f"""SELECT dummy_date, species, median_percentcomplete, min_percentcomplete, max_percentcomplete,
               DATE '{CFG.as_of.year - 1}-12-31' + CAST(dayofyear(dummy_date) AS INTEGER) AS current_max
        FROM (SELECT *, row_number() OVER (PARTITION BY species ORDER BY dummy_date) AS rn
              FROM run_stats WHERE min_percentcomplete = 100) WHERE rn = 1""",
)
def q_run_end(spark, sf):
    return dashboard.run_end_date(tables(spark, sf).run_stats, CFG)


def _num_text(c: str) -> str:
    return f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"


@register(
    "run_status_today",
    f"""SELECT *, {_num_text('median_percentcomplete')} || ' %' AS median_text,
               'Range: ' || {_num_text('min_percentcomplete')} || ' % - ' || {_num_text('max_percentcomplete')} || ' %' AS range_text
        FROM run_stats WHERE dummy_date = {O.STATUS_DUMMY}""",
)
def q_run_status(spark, sf):
    return dashboard.run_status_today(tables(spark, sf).run_stats, CFG)


@register(
    "length_frequency",
    f"""WITH a AS (SELECT species, length_mm, floor(length_mm / 25.4 * 2.0) / 2.0 AS length_bin_in
                   FROM individuals_live WHERE release_lifestage = 'Adult' AND length_mm IS NOT NULL),
             s AS (SELECT species, avg(length_mm) AS mean_length, count(*) AS total_sample FROM a GROUP BY species)
        SELECT a.species, a.length_bin_in, count(*) AS freq, s.total_sample,
               round(s.mean_length, {ROUND}) AS mean_length, round(s.mean_length / 25.4, {ROUND}) AS mean_length_in
        FROM a JOIN s ON a.species = s.species
        GROUP BY a.species, a.length_bin_in, s.total_sample, s.mean_length""",
)
def q_length_frequency(spark, sf):
    lf = dashboard.length_frequency(tables(spark, sf).individuals)
    return lf.select("species", "length_bin_in", "freq", "total_sample",
                     F.round("mean_length", ROUND).alias("mean_length"),
                     F.round("mean_length_in", ROUND).alias("mean_length_in"))


@register("unique_fish", "SELECT species, count(*) AS n_fish FROM individuals_live GROUP BY species")
def q_unique_fish(spark, sf):
    return dashboard.unique_fish(tables(spark, sf).individuals)


@register(
    "new_last_week",
    f"""SELECT species, count(*) AS n_new FROM individuals_live
        WHERE CAST(sfc_entry_final AS DATE) >= {O.AS_OF} - 7 GROUP BY species""",
)
def q_new_last_week(spark, sf):
    return dashboard.new_last_week(tables(spark, sf).individuals, CFG)


@register("species_daily", f"SELECT * FROM daily WHERE species = '{SPECIES_PARAM}'")
def q_species_daily(spark, sf):
    return dashboard.species_daily(tables(spark, sf).daily, SPECIES_PARAM)


@register(
    "species_cumulative",
    f"""SELECT * FROM ytd WHERE species = '{SPECIES_PARAM}'
          AND (spawn_year < {O._cur_sy()} OR spawn_year = {O._cur_sy()})""",
)
def q_species_cumulative(spark, sf):
    return dashboard.species_cumulative(tables(spark, sf).year_to_date, CFG, SPECIES_PARAM)


@register("first_entry_date", "SELECT min(CAST(sfc_entry_final AS DATE)) AS slider_min FROM individuals_live")
def q_first_entry(spark, sf):
    return dashboard.first_entry_date(tables(spark, sf).individuals)


@register(
    "current_year_key",
    f"""SELECT s.species, {O._cur_sy('s.species')} AS current_sy, {O._DOY} AS today_jday,
               {O._today_dummy('s.species')} AS today_dummy, coalesce(d.n, 0) AS detections
        FROM (VALUES {', '.join(f"('{s}')" for s in CFG.species)}) s(species)
        LEFT JOIN (SELECT species, count(*) AS n FROM det GROUP BY species) d ON s.species = d.species""",
)
def q_current_year_key(spark, sf):
    # every configured species, whether the detections hold it or not
    seen = tables(spark, sf).detections.groupBy("species").agg(F.count(F.lit(1)).alias("detections"))
    key = dashboard.current_year_key(spark, CFG)
    return key.join(seen, "species", "left").withColumn("detections", F.coalesce("detections", F.lit(0)))


# --------------------------------------------------- generic operators
# Each isolates one operator of the inventory on data derived from the
# driver tables. Operators already isolated by a domain query above are not
# repeated: J4 EXISTS-in-OR = population_live, SET2 = all_years, J2 =
# migratory_juveniles_*, FLT9 = flow_window, TOP1 = latest_discharge,
# FLT3 = drop_same_year_juveniles, W6 = current_year_detections.

@register(
    "latest_by_key",
    """SELECT pit_id, observation_datetime, observation_sitecode, ordinal FROM (
         SELECT *, row_number() OVER (PARTITION BY pit_id ORDER BY observation_datetime DESC, ordinal) AS rn
         FROM det WHERE observation_datetime IS NOT NULL) WHERE rn = 1""",
)
def q_latest_by_key(spark, sf):
    det = tables(spark, sf).detections
    return ordered.top1_by_key(det, ["pit_id"], "observation_datetime", "ordinal",
                               ["observation_datetime", "observation_sitecode", "ordinal"])


@register(
    "first_by_key",
    """SELECT pit_id, arg_min_null(observation_sitecode, ordinal) AS first_site,
              arg_min_null(length_mm, ordinal) AS first_length_mm
       FROM det GROUP BY pit_id""",
)
def q_first_by_key(spark, sf):
    det = tables(spark, sf).detections
    return det.groupBy("pit_id").agg(
        ordered.first_by("observation_sitecode", "ordinal").alias("first_site"),
        ordered.first_by("length_mm", "ordinal").alias("first_length_mm"),
    )


@register(
    "filtered_last",
    f"""SELECT pit_id, arg_max_null(observation_datetime, ordinal) FILTER (WHERE observation_sitecode IN {O.FINAL})
              AS last_final_time
       FROM det GROUP BY pit_id""",
)
def q_filtered_last(spark, sf):
    det = tables(spark, sf).detections
    final = X.isin_false("observation_sitecode", CFG.final_sites)
    return det.groupBy("pit_id").agg(
        ordered.last_by_where("observation_datetime", "ordinal", final).alias("last_final_time")
    )


@register(
    "running_total",
    """SELECT species, spawn_year, sfc_final_date, n,
              CAST(sum(n) OVER (PARTITION BY species ORDER BY sfc_final_date, spawn_year
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_n
       FROM daily_completed""",
)
def q_running_total(spark, sf):
    d = tables(spark, sf).daily_completed.select("species", "spawn_year", "sfc_final_date", "n")
    return running.running_total(d, ["species"], ["sfc_final_date", "spawn_year"], "n", "running_n")


@register(
    "running_total_detections",
    # over the detections themselves: groups without a bound
    """SELECT pit_id, ordinal, species, sum(length_mm_n) OVER (PARTITION BY species ORDER BY observation_datetime NULLS LAST, ordinal
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS running_measured
       FROM (SELECT *, CASE WHEN length_mm IS NULL THEN 0 ELSE 1 END AS length_mm_n FROM det)""",
)
def q_running_detections(spark, sf):
    det = tables(spark, sf).detections.select("pit_id", "ordinal", "species", "observation_datetime",
                                              F.when(F.col("length_mm").isNull(), 0).otherwise(1).cast("long").alias("measured"))
    out = segmented.running_total_segmented(det, ["species"], ["observation_datetime", "ordinal"], "measured", "running_measured")
    return out.select("pit_id", "ordinal", "species", "running_measured")


@register(
    "fill_down_detections",
    """SELECT pit_id, ordinal, species, last_value(length_mm IGNORE NULLS) OVER (PARTITION BY species
              ORDER BY observation_datetime NULLS LAST, ordinal ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS length_mm
       FROM det""",
)
def q_fill_detections(spark, sf):
    det = tables(spark, sf).detections.select("pit_id", "ordinal", "species", "observation_datetime", "length_mm")
    return segmented.fill_down_segmented(det, ["species"], ["observation_datetime", "ordinal"], ["length_mm"]).drop("observation_datetime")


@register(
    "share_of_total",
    """SELECT species, spawn_year, sfc_final_date, n,
              CAST(sum(n) OVER (PARTITION BY species) AS BIGINT) AS species_total,
              CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY species) AS DOUBLE) AS species_share
       FROM daily_completed""",
)
def q_share_of_total(spark, sf):
    d = tables(spark, sf).daily_completed.select("species", "spawn_year", "sfc_final_date", "n")
    d = running.group_total(d, ["species"], "n", "species_total")
    return running.share_of_total(d, "n", "species_total", "species_share")


_GRID_ENTRY_SQL = """
  SELECT coalesce(g.species, d.species) AS species, coalesce(g.spawn_year, d.spawn_year) AS spawn_year,
         coalesce(g.sfc_final_date, d.sfc_final_date) AS sfc_final_date, coalesce(d.n, 0) AS n,
         d.cumulative_total
  FROM (SELECT species, spawn_year,
               CAST(unnest(generate_series(CAST(min(sfc_final_date) AS TIMESTAMP), CAST(max(sfc_final_date) AS TIMESTAMP),
                    INTERVAL 1 DAY)) AS DATE) AS sfc_final_date
        FROM daily_completed GROUP BY species, spawn_year) g
  FULL OUTER JOIN daily_completed d
    ON g.species = d.species AND g.spawn_year = d.spawn_year AND g.sfc_final_date = d.sfc_final_date"""


def _entry_grid(spark, sf) -> DataFrame:
    d = tables(spark, sf).daily_completed.select("species", "spawn_year", "sfc_final_date", "n", "cumulative_total")
    out = densify.complete_dates(d, ["species", "spawn_year"], "sfc_final_date",
                                 F.min("sfc_final_date"), F.max("sfc_final_date"))
    return densify.zero_fill(out, ["n"])


@register("complete_dates", f"SELECT species, spawn_year, sfc_final_date, n FROM ({_GRID_ENTRY_SQL})")
def q_complete_dates(spark, sf):
    return _entry_grid(spark, sf).select("species", "spawn_year", "sfc_final_date", "n")


@register(
    "fill_down",
    f"""SELECT species, spawn_year, sfc_final_date, n,
               last_value(cumulative_total IGNORE NULLS) OVER (PARTITION BY species, spawn_year ORDER BY sfc_final_date
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_total
        FROM ({_GRID_ENTRY_SQL})""",
)
def q_fill_down(spark, sf):
    return running.fill_down(_entry_grid(spark, sf), ["species", "spawn_year"], ["sfc_final_date"], ["cumulative_total"])


@register("left_join_key", f"SELECT {DET_COLS}, {O._cur_sy()} AS current_sy FROM det")
def q_left_join_key(spark, sf):
    det = tables(spark, sf).detections
    key = dashboard.current_year_key(spark, CFG).select("species", "current_sy")
    return det.join(F.broadcast(key), "species", "left")  # one literal row per configured species


@register(
    "fixed_width_bins",
    """SELECT species, floor(length_mm / 25.0) * 25.0 AS length_bin, count(*) AS n
       FROM individuals_completed WHERE length_mm IS NOT NULL GROUP BY ALL""",
)
def q_fixed_width_bins(spark, sf):
    ind = tables(spark, sf).completed_individuals.filter(F.col("length_mm").isNotNull())
    return ind.groupBy("species", X.fixed_width_bin("length_mm", 25.0).alias("length_bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


@register(
    "median_min_max",
    # Exact medians buffer a group's values in one task, so they only run
    # on bounded groups: here the daily counts of one species and year
    # (at most 366 values), as the source does for its run statistics.
    f"""SELECT species, spawn_year, {O._median('n')} AS median_n, min(n) AS min_n, max(n) AS max_n
        FROM daily_completed GROUP BY species, spawn_year""",
)
def q_median_min_max(spark, sf):
    d = tables(spark, sf).daily_completed
    return d.groupBy("species", "spawn_year").agg(*relational.median_min_max(
        d, ["species", "spawn_year"], "n", {"median": "median_n", "min": "min_n", "max": "max_n"}))


@register("median_all_lengths", f"SELECT species, {O._median('length_mm')} AS median_length_mm FROM det GROUP BY species")
def q_median_all_lengths(spark, sf):
    # over every detection of a species: groups without a bound
    return selection.exact_median(tables(spark, sf).detections, ["species"], "length_mm", "median_length_mm")


@register(
    "half_even_percent",
    """SELECT species, spawn_year, sfc_final_date, CAST(round_even(daily_prop * 100.0, 0) AS DOUBLE) AS daily_percent
       FROM daily_completed""",
)
def q_half_even(spark, sf):
    d = tables(spark, sf).daily_completed
    return d.select("species", "spawn_year", "sfc_final_date", X.half_even_percent("daily_prop").alias("daily_percent"))


@register(
    "site_token",
    f"""SELECT site, observation_sitecode, count(*) AS n FROM (
          SELECT {O._case('substr(o_orderpriority, 1, 1)', fixtures.PRIORITY_SITE, fixtures.OTHER_SITE)} AS site,
                 {O._case('substr(o_orderpriority, 1, 1)', O._token_map(fixtures.PRIORITY_SITE), fixtures.OTHER_SITE.split(' ')[0])}
                   AS observation_sitecode
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
        GROUP BY ALL""",
)
def q_site_token(spark, sf):
    raw = tables(spark, sf).live_raw
    return raw.groupBy("site", X.site_token("site").alias("observation_sitecode")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "days_between",
    f"""SELECT pit_id, {O._elapsed('arg_max_null(observation_datetime, ordinal)', 'arg_min_null(observation_datetime, ordinal)')}
               AS days_at_array
        FROM det GROUP BY pit_id""",
)
def q_days_between(spark, sf):
    det = tables(spark, sf).detections
    g = det.groupBy("pit_id").agg(
        ordered.first_by("observation_datetime", "ordinal").alias("_a"),
        F.max_by("observation_datetime", "ordinal").alias("_b"),
    )
    return g.select("pit_id", X.elapsed_days("_b", "_a").alias("days_at_array"))


@register(
    "pivot_daily_values",
    """SELECT CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS mean_temp, max(l_extendedprice) AS mean_discharge
       FROM lineitem GROUP BY CAST(l_shipdate AS DATE)""",
)
def q_pivot(spark, sf):
    long = fixtures.river_daily_long(spark, sf)
    return relational.pivot_values(long, "date", "parameter_cd", "value",
                                   {C.PARAM_TEMPERATURE: "mean_temp", C.PARAM_DISCHARGE: "mean_discharge"})


@register(
    "parse_local_timestamp",
    """SELECT ordinal, strftime(observation_datetime, '%m/%d/%Y %I:%M:%S %p') AS obs_time, observation_datetime
       FROM det""",
)
def q_parse_ts(spark, sf):
    raw = tables(spark, sf).live_raw
    return raw.select("ordinal", "obs_time", X.parse_local_ts("obs_time").alias("observation_datetime"))


@register(
    "entry_date_host_zone",
    """SELECT pit_id, CAST(timezone('UTC', timezone('America/Los_Angeles', sfc_entry_final)) AS DATE) AS entry_date_utc,
              CAST(sfc_entry_final AS DATE) AS entry_date_local
       FROM individuals_live""",
)
def q_entry_zone(spark, sf):
    ind = tables(spark, sf).individuals
    return ind.select("pit_id", X.entry_date("sfc_entry_final", "UTC").alias("entry_date_utc"),
                      X.entry_date("sfc_entry_final").alias("entry_date_local"))


@register(
    "downstream_ampm_ignored",
    # A 12-hour clock read without its marker keeps hour % 12 (PM loses 12 h,
    # 12 o'clock becomes 0), as strptime's %I without %p does.
    """SELECT pit_id, max(ds_datetime - to_hours(CAST(hour(ds_datetime) - hour(ds_datetime) % 12 AS INTEGER)))
              AS latest_downstream
       FROM ds GROUP BY pit_id""",
)
def q_ds_ampm(spark, sf):
    ds = canonical.downstream_detections(tables(spark, sf).live_downstream_raw, ampm="ignore")
    return canonical.latest_downstream_time(ds)


# The whole chain in the scheduled run's mode: see FIXTURE_CONFIG_HOST_ZONE.
HOST = C.FIXTURE_CONFIG_HOST_ZONE


@register("daily_entries_host_zone", "SELECT * FROM daily", HOST)
def q_daily_host(spark, sf):
    return tables(spark, sf, HOST).daily


@register("run_stats_host_zone", "SELECT * FROM run_stats", HOST)
def q_run_stats_host(spark, sf):
    return tables(spark, sf, HOST).run_stats


@register("year_to_date_host_zone", "SELECT * FROM ytd", HOST)
def q_ytd_host(spark, sf):
    return tables(spark, sf, HOST).year_to_date


# ------------------------------------------ second fixture point: mid-year
# as_of = 2000-09-01: the mid-year species' current spawn year is 2001 while
# every other species is in 2000, so the per-species key, the Jul-Dec
# branch of the spawn year and the first-half/second-half dummy calendars
# all take their other branch.
MID = C.FIXTURE_CONFIG_MIDYEAR


@register("current_year_detections_midyear", f"SELECT {DET_COLS}, current_sy FROM cur_det", MID)
def q_current_year_mid(spark, sf):
    return tables(spark, sf, MID).current_detections


@register("daily_entries_midyear", "SELECT * FROM daily", MID)
def q_daily_mid(spark, sf):
    return tables(spark, sf, MID).daily


@register("run_stats_midyear", "SELECT * FROM run_stats", MID)
def q_run_stats_mid(spark, sf):
    return tables(spark, sf, MID).run_stats


@register("year_to_date_midyear", "SELECT * FROM ytd", MID)
def q_ytd_mid(spark, sf):
    return tables(spark, sf, MID).year_to_date


@register(
    "run_status_today_midyear",
    f"""SELECT *, {_num_text('median_percentcomplete')} || ' %' AS median_text,
               'Range: ' || {_num_text('min_percentcomplete')} || ' % - ' || {_num_text('max_percentcomplete')} || ' %' AS range_text
        FROM run_stats WHERE dummy_date = {O.status_dummy(MID)}""",
    MID,
)
def q_run_status_mid(spark, sf):
    return dashboard.run_status_today(tables(spark, sf, MID).run_stats, MID)


@register(
    "flow_labels",
    """SELECT date, ' Date: ' || CAST(date AS VARCHAR) || ' <br> Mean Discharge (cfs):  '
              || regexp_replace(CAST(mean_discharge AS VARCHAR), '\\.0$', '') AS label FROM flow""",
)
def q_flow_labels(spark, sf):
    return dashboard.flow_labels(tables(spark, sf).flow)


# ------------------------------------------------------ display texts
# The text the dashboard attaches to each plotted point (NULL-propagating
# concatenation, "%b %d" dates, whole numbers without decimals).

@register(
    "cumulative_labels",
    """SELECT species, spawn_year, dummy_date,
              ' Date: ' || strftime(dummy_date, '%b %d') || ' <br> Spawn Year: ' || CAST(spawn_year AS VARCHAR)
              || ' <br> Number In: ' || CAST(CAST(round_even(daily_cumulative_n, 0) AS BIGINT) AS VARCHAR) AS label
       FROM ytd""",
)
def q_cumulative_labels(spark, sf):
    return dashboard.cumulative_labels(tables(spark, sf).year_to_date)


@register(
    "daily_entry_labels",
    """SELECT species, spawn_year, sfc_final_date,
              ' Date: ' || CAST(sfc_final_date AS VARCHAR) || ' <br> Number Fish Entered: ' || CAST(n AS VARCHAR) AS label
       FROM daily""",
)
def q_daily_labels(spark, sf):
    return dashboard.daily_entry_labels(tables(spark, sf).daily)


@register(
    "length_frequency_labels",
    f"""WITH a AS (SELECT species, floor(length_mm / 25.4 * 2.0) / 2.0 AS length_bin_in
                   FROM individuals_live WHERE release_lifestage = 'Adult' AND length_mm IS NOT NULL)
        SELECT species, length_bin_in,
               'Length Bin: ' || {_num_text('length_bin_in')} || '<br>Number: ' || CAST(count(*) AS VARCHAR) AS label
        FROM a GROUP BY species, length_bin_in""",
)
def q_lf_labels(spark, sf):
    return dashboard.length_frequency_labels(dashboard.length_frequency(tables(spark, sf).individuals))


# ------------------------------------- operator isolations (survey §7.3)
# Same operators as inside the domain queries, applied to other inputs so
# that each one is checked on its own.

@register(
    "semi_or_exists",
    f"""SELECT {DET_COLS} FROM det
        WHERE pit_id IN (SELECT pit_id FROM ds_latest WHERE ds_site = 'GRA') OR release_lifestage = 'Adult'""",
)
def q_semi_or_exists(spark, sf):
    t = tables(spark, sf)
    last_at_gra = canonical.latest_downstream(t.downstream).filter(F.col("ds_site") == "GRA")
    return relational.filter_member_or(t.detections, last_at_gra, "pit_id", F.col("release_lifestage") == "Adult", "ordinal")


@register(
    "union_missing_cols",
    """SELECT pit_id, observation_datetime, observation_sitecode, CAST(NULL AS VARCHAR) AS ds_site FROM det
       UNION ALL
       SELECT pit_id, CAST(NULL AS TIMESTAMP) AS observation_datetime, CAST(NULL AS VARCHAR) AS observation_sitecode,
              ds_site FROM ds_latest""",
)
def q_union_missing(spark, sf):
    t = tables(spark, sf)
    a = t.detections.select("pit_id", "observation_datetime", "observation_sitecode")
    b = canonical.latest_downstream(t.downstream).select("pit_id", "ds_site")
    return relational.union_all([a, b], allow_missing=True)


@register(
    "inner_join_latest",
    """SELECT l.pit_id, l.observation_datetime, d.ds_datetime, d.ds_site
       FROM (SELECT pit_id, observation_datetime FROM (
               SELECT *, row_number() OVER (PARTITION BY pit_id ORDER BY observation_datetime DESC, ordinal) AS rn
               FROM det WHERE observation_datetime IS NOT NULL) WHERE rn = 1) l
       JOIN ds_latest d ON l.pit_id = d.pit_id""",
)
def q_inner_join_latest(spark, sf):
    t = tables(spark, sf)
    latest = ordered.top1_by_key(t.detections, ["pit_id"], "observation_datetime", "ordinal", ["observation_datetime"])
    return latest.join(canonical.latest_downstream(t.downstream), "pit_id", "inner")


@register(
    "scalar_bound_filter",
    """SELECT date, mean_temp, mean_discharge FROM flow_daily
       WHERE date >= (SELECT min(CAST(observation_datetime AS DATE)) FROM det)""",
)
def q_scalar_bound(spark, sf):
    t = tables(spark, sf)
    lo = t.detections.agg(F.min(F.to_date("observation_datetime")).alias("_lo"))
    return relational.with_scalar(t.flow_daily, lo).filter(F.col("date") >= F.col("_lo")).drop("_lo")


@register(
    "global_max_column",
    "SELECT pit_id, ordinal, spawn_year, (SELECT max(spawn_year) FROM det) AS most_recent FROM det",
)
def q_global_max(spark, sf):
    det = tables(spark, sf).detections
    top = det.agg(F.max("spawn_year").alias("most_recent"))
    return relational.with_scalar(det.select("pit_id", "ordinal", "spawn_year"), top)


@register(
    "top1_global",
    """SELECT pit_id, ordinal, observation_datetime FROM det WHERE observation_datetime IS NOT NULL
       ORDER BY observation_datetime DESC, ordinal LIMIT 1""",
)
def q_top1_global(spark, sf):
    det = tables(spark, sf).detections.filter(F.col("observation_datetime").isNotNull())
    return det.orderBy(F.col("observation_datetime").desc(), F.col("ordinal")).limit(1).select(
        "pit_id", "ordinal", "observation_datetime")


@register(
    "kleene_not_and",
    f"""SELECT {DET_COLS} FROM det WHERE NOT (release_lifestage = 'Juvenile' AND yrs_at_large = 0)""",
)
def q_kleene(spark, sf):
    det = tables(spark, sf).detections
    return det.filter(X.not_same_year_juvenile("yrs_at_large", "release_lifestage"))


# --------------------------------------------------------- landed files
# The feeds written as report files into the shared folder and scanned back.

_UTF16 = {"encoding": "UTF-16LE", "line_sep": "\r\n"}


def _utf16_report(spark, sf) -> DataFrame:
    folder = shared.scratch_folder(spark, "report")
    raw = tables(spark, sf).live_raw
    feeds.land_report(raw, f"{folder}/live", "live_detections", int(spark.conf.get("spark.sql.shuffle.partitions")), **_UTF16)
    return feeds.read_report(spark, f"{folder}/live", "live_detections", **_UTF16)


@register("report_scan_utf16", f"SELECT {DET_COLS.replace(', ordinal', '')} FROM det")
def q_report_utf16(spark, sf):
    return canonical.canonical_detections(_utf16_report(spark, sf)).drop("ordinal")


@register(
    "report_first_by_order",
    """SELECT pit_id, arg_min_null(observation_sitecode, ordinal) AS first_site, arg_max_null(length_mm, ordinal) AS last_length_mm,
              count(*) AS n FROM det GROUP BY pit_id""",
)
def q_report_order(spark, sf):
    # report order is the order of the rows in the files
    det = canonical.canonical_detections(_utf16_report(spark, sf))
    return det.groupBy("pit_id").agg(ordered.first_by("observation_sitecode", "ordinal").alias("first_site"),
                                     F.max_by("length_mm", "ordinal").alias("last_length_mm"), F.count(F.lit(1)).alias("n"))


@register("report_scan_six_files", "SELECT pit_id, ds_datetime, ds_site FROM ds_latest")
def q_report_six_files(spark, sf):
    folder = shared.scratch_folder(spark, "report")
    paths = feeds.land_report(tables(spark, sf).completed_downstream_raw, f"{folder}/downstream", "completed_downstream", 6)
    raw = feeds.read_report(spark, paths, "completed_downstream")
    return canonical.latest_downstream(canonical.downstream_detections(raw))


@register("report_union_two_files", "SELECT pit_id, ds_site, ds_datetime FROM ds")
def q_report_two_files(spark, sf):
    folder = shared.scratch_folder(spark, "report")
    paths = feeds.land_report(tables(spark, sf).live_downstream_raw, f"{folder}/downstream", "live_downstream", 2, **_UTF16)
    return canonical.downstream_detections(feeds.read_report(spark, paths, "live_downstream", **_UTF16)).drop("ordinal")


@register(
    "river_landed_long",
    f"""SELECT date, mean_temp, mean_discharge FROM flow_daily WHERE date >= DATE '{river.HISTORY_START.isoformat()}' AND date <= {O.AS_OF}""",
)
def q_river_landed(spark, sf):
    # two gauges landed, one wanted
    folder = shared.scratch_folder(spark, "river")
    long = fixtures.river_daily_long(spark, sf)
    other = long.select("date", "parameter_cd", (F.col("value") * -1).alias("value"), F.lit("other").alias("site_no"))
    long.select("date", "parameter_cd", "value", F.lit("wanted").alias("site_no")).unionByName(other).write.parquet(f"{folder}/long")
    return river.read_long(spark, f"{folder}/long", "wanted", CFG.as_of)


# --------------------------------------------------------------- marts
# Datasets written by one job and read by the next.

@register("mart_round_trip", "SELECT * FROM daily")
def q_mart(spark, sf):
    folder, daily = shared.scratch_folder(spark, "marts"), tables(spark, sf).daily
    marts.write_mart(daily.limit(0), folder, "daily")  # an older state
    marts.write_mart(daily, folder, "daily")
    return marts.read_mart(spark, folder, "daily").select(*daily.columns)


def _live_feeds(spark, sf) -> jobs.LiveFeeds:
    t = tables(spark, sf)
    return jobs.LiveFeeds(t.live_raw, t.live_downstream_raw, t.flow_daily)


@register("current_year_from_year_mart", f"SELECT {DET_COLS}, current_sy FROM cur_det")
def q_year_mart(spark, sf):
    folder = shared.scratch_folder(spark, "marts")
    jobs.land_detections(_live_feeds(spark, sf), folder)
    return canonical.current_year_detections(marts.read_mart(spark, folder, "detections"), CFG)


@register("individuals_from_fish_marts", f"SELECT {_round_len_sql(live.INDIVIDUAL_COLUMNS)} FROM individuals_live")
def q_fish_marts(spark, sf):
    folder, landed = shared.scratch_folder(spark, "marts"), _live_feeds(spark, sf)
    jobs.land_detections(landed, folder)
    return _round_len(live.individuals_live(*jobs.fish_level(spark, landed, folder, CFG), CFG), live.INDIVIDUAL_COLUMNS)


# ------------------------------------------- dashboard dates of the scheduled run

@register("first_entry_date_host_zone", "SELECT min(CAST(timezone('UTC', timezone('America/Los_Angeles', sfc_entry_final)) AS DATE)) AS slider_min FROM individuals_live", HOST)
def q_first_entry_host(spark, sf):
    return dashboard.first_entry_date(tables(spark, sf, HOST).individuals, HOST.entry_date_zone)


@register(
    "new_last_week_host_zone",
    f"""SELECT species, count(*) AS n_new FROM individuals_live
        WHERE CAST(timezone('UTC', timezone('America/Los_Angeles', sfc_entry_final)) AS DATE) >= {O.AS_OF} - 7 GROUP BY species""",
    HOST,
)
def q_new_last_week_host(spark, sf):
    return dashboard.new_last_week(tables(spark, sf, HOST).individuals, HOST, HOST.entry_date_zone)
