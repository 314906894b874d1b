"""Semantics of the source workflow, one test per rule, on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runtally import config as C
from runtally.functions import columns as X
from runtally.operators import densify, ordered, running
from runtally.plans import canonical, completed, dashboard, live, progress
from runtally.sources.feeds import RAW_COLUMNS

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType() if c == "mark_length" else T.StringType()) for c in RAW_COLUMNS]
    + [T.StructField("ordinal", T.LongType())]
)


def raw_rows(spark, rows):
    """rows: dicts with raw column values; missing -> NULL; ordinal = position."""
    data = [tuple(r.get(c) for c in RAW_COLUMNS) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, RAW_SCHEMA)


def det_row(tag, obs, species="Steelhead", site="SC1 - a", stage="Adult", length=500.0,
            release="01/01/2000", release_site="LGRRBR - x"):
    return {"tag": tag, "species_name": species, "site": site, "release_site": release_site,
            "obs_time": obs, "release_date": release, "mark_life_stage": stage, "mark_length": length}


def one(spark, expr, schema="x string", value=None):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


# ------------------------------------------------------------ scalar rules

def test_site_token(spark):
    df = spark.createDataFrame([("SC1 - lower",), ("LGRRBR",), (None,), (" x",)], "s string")
    assert [r[0] for r in df.select(X.site_token("s")).collect()] == ["SC1", "LGRRBR", None, ""]


@pytest.mark.parametrize("text,expected", [
    ("03/04/2001 12:05:00 AM", dt.datetime(2001, 3, 4, 0, 5)),
    ("3/4/2001 12:30:00 PM", dt.datetime(2001, 3, 4, 12, 30)),
    ("04/01/2001 02:30:00 AM", dt.datetime(2001, 4, 1, 2, 30)),  # DST gap: wall clock kept
    ("13/40/2001 01:00:00 PM", None),
    ("garbage", None),
])
def test_parse_local_ts(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(X.parse_local_ts("s").alias("t")).first()["t"] == expected


def test_parse_without_ampm_keeps_hour_mod_12(spark):
    df = spark.createDataFrame([("3/4/2001 12:30:00 PM",), ("3/4/2001 01:30:00 PM",)], "s string")
    got = [r[0] for r in df.select(X.parse_local_ts("s", ampm="ignore")).collect()]
    assert got == [dt.datetime(2001, 3, 4, 0, 30), dt.datetime(2001, 3, 4, 1, 30)]


def test_parse_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("04/01/2001 02:30:00 AM",)], "s string")
        assert df.select(X.parse_local_ts("s")).first()[0] == dt.datetime(2001, 4, 1, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_elapsed_days_independent_of_session_zone(spark):
    """1995-04-02 02:30 does not exist in New York; the result must not care."""
    old = spark.conf.get("spark.sql.session.timeZone")
    rows = [(dt.datetime(2000, 11, 4, 20, 44), dt.datetime(1995, 4, 1, 18, 30))]
    got = []
    try:
        for tz in ("UTC", "America/New_York", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
            got.append(df.select(X.elapsed_days("b", "a"), X.ntz_micros("b")).first())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got[0] == got[1] == got[2]
    assert got[0][0] == pytest.approx(-2044.0930555555556)


def test_fixture_text_and_labels_independent_of_session_zone(spark):
    from runtally.sources.fixtures import clock_text, date_text
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(dt.datetime(1995, 4, 2, 2, 30), dt.date(1995, 4, 2))], "t timestamp_ntz, d date")
        r = df.select(clock_text(F.col("t")), date_text(F.col("d"), True), X.month_day("d")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert tuple(r) == ("04/02/1995 02:30:00 AM", "04021995", "Apr 02")


def test_parse_mdy_both_spellings(spark):
    df = spark.createDataFrame([("3/5/2001",), ("03052001",), ("bad",)], "s string")
    got = [r[0] for r in df.select(X.parse_mdy("s")).collect()]
    assert got == [dt.date(2001, 3, 5), dt.date(2001, 3, 5), None]


@pytest.mark.parametrize("day,species,expected", [
    (dt.datetime(2000, 7, 1), "Steelhead", 2001),   # leap year: doy 183 = 1 July
    (dt.datetime(2001, 7, 1), "Steelhead", 2001),   # non-leap: doy 182
    (dt.datetime(2001, 7, 2), "Steelhead", 2002),   # non-leap: doy 183
    (dt.datetime(2001, 12, 31), "Chinook", 2001),
])
def test_spawn_year(spark, day, species, expected):
    df = spark.createDataFrame([(day, species)], "t timestamp_ntz, s string")
    assert df.select(X.spawn_year("t", "s")).first()[0] == expected


@pytest.mark.parametrize("day,species,expected", [
    (dt.date(2001, 1, 1), "Steelhead", dt.date(1977, 1, 2)),     # origin + doy (one ahead)
    (dt.date(2001, 6, 30), "Steelhead", dt.date(1977, 7, 1)),    # doy 181 -> past the 30 June cap
    (dt.date(2001, 7, 1), "Steelhead", dt.date(1977, 7, 2)),     # doy 182
    (dt.date(2000, 6, 30), "Steelhead", dt.date(1977, 7, 2)),    # leap doy 182
    (dt.date(2001, 7, 2), "Steelhead", dt.date(1976, 7, 1)),     # doy 183 -> 1976 - 1
    (dt.date(2001, 3, 1), "Chinook", dt.date(1976, 2, 29)),      # non-leap 1 March -> leap day
    (dt.date(2001, 1, 1), "Chinook", dt.date(1976, 1, 1)),
])
def test_dummy_date(spark, day, species, expected):
    df = spark.createDataFrame([(day, species)], "d date, s string")
    assert df.select(X.dummy_date("d", "s")).first()[0] == expected


def test_dummy_date_offset_fix(spark):
    df = spark.createDataFrame([(dt.date(2001, 1, 1), "Steelhead")], "d date, s string")
    assert df.select(X.dummy_date("d", "s", offset_fix=True)).first()[0] == dt.date(1977, 1, 1)


@pytest.mark.parametrize("x,expected", [(0.125, 12.0), (0.135, 14.0), (0.5, 50.0), (1.0, 100.0)])
def test_half_even_percent(spark, x, expected):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(X.half_even_percent("x")).first()[0] == expected


def test_elapsed_days_across_dst(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 3, 31, 12), dt.datetime(2001, 4, 2, 12))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = df.select(X.elapsed_days("b", "a")).first()[0]
    assert got == pytest.approx(2 - 1 / 24)


@pytest.mark.parametrize("stage,length,species,expected", [
    (None, 300.0, "Steelhead", "Juvenile"),
    (None, 301.0, "Chinook", "Adult"),
    ("Adult", 250.0, "Steelhead", "Juvenile"),
    (None, None, "Steelhead", "Juvenile"),
    ("Adult", 250.0, "Bull Trout", "Adult"),
    (None, 250.0, "Bull Trout", None),
    ("Juvenile", 900.0, "Chinook", "Juvenile"),
])
def test_reclassify_lifestage(spark, stage, length, species, expected):
    df = spark.createDataFrame([(stage, length, species)], "st string, ln double, sp string")
    assert df.select(X.reclassify_lifestage("st", "ln", "sp")).first()[0] == expected


def test_kleene_not_and(spark):
    rows = [(0, "Juvenile"), (0, None), (None, "Juvenile"), (1, "Juvenile"), (None, None), (0, "Adult")]
    df = spark.createDataFrame(rows, "y int, st string")
    kept = df.filter(X.not_same_year_juvenile("y", "st")).collect()
    # NOT(TRUE AND NULL) is NULL -> dropped, NOT(FALSE AND NULL) is TRUE -> kept
    assert sorted((r.y, r.st) for r in kept) == sorted([(1, "Juvenile"), (0, "Adult")])


def test_unknown_species_has_no_current_year(spark):
    df = spark.createDataFrame([("Sockeye",), ("Chinook",)], "s string")
    got = [r[0] for r in df.select(X.current_spawn_year("s", C.FIXTURE_CONFIG)).collect()]
    assert got == [None, 2001]


def test_current_year_after_midyear():
    cfg = C.FIXTURE_CONFIG_MIDYEAR
    assert cfg.current_spawn_year("Steelhead") == 2001
    assert cfg.current_spawn_year("Chinook") == 2000


def test_concat_strict_propagates_null(spark):
    df = spark.createDataFrame([(None,)], "x string")
    assert df.select(X.concat_strict(F.col("x"), " %")).first()[0] is None


# ------------------------------------------------------ ordered aggregates

def test_top1_ties_go_to_first_row_and_all_null_gives_no_row(spark):
    rows = [("a", dt.datetime(2001, 1, 2), 3, "late-2"), ("a", dt.datetime(2001, 1, 2), 1, "late-1"),
            ("a", dt.datetime(2001, 1, 1), 0, "early"), ("b", None, 0, "none")]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, o long, v string")
    got = {r.k: r.v for r in ordered.top1_by_key(df, ["k"], "t", "o", ["v"]).collect()}
    assert got == {"a": "late-1"}


def test_top1_orders_nulls_nan_struct_ordinals_and_null_keys(spark):
    nan = float("nan")
    rows = [("a", nan, (0, 0), "nan"), ("a", 2.0, (2, 1), "2-1"), ("a", 2.0, (1, 9), "1-9"), ("a", None, (0, 1), "null"),
            ("n", nan, (1, 1), "nan"), ("z", None, (1, 1), "null"), (None, 1.0, (1, 1), "null key"), (None, 3.0, None, "no ordinal")]
    df = spark.createDataFrame(rows, "k string, t double, o struct<x:int,y:int>, v string")
    down = {r.k: r.v for r in ordered.top1_by_key(df, ["k"], "t", "o", ["v"]).collect()}
    assert down == {"a": "1-9", "n": "nan", None: "no ordinal"}
    up = {r.k: r.v for r in ordered.top1_by_key(df, ["k"], "t", "o", ["v"], descending=False).collect()}
    assert up == {"a": "1-9", "n": "nan", None: "null key"}


def test_first_keeps_null_and_last_of_empty_subset_is_null(spark):
    rows = [("a", 1, None, "X"), ("a", 2, 5.0, "SC1"), ("b", 1, 7.0, "X")]
    df = spark.createDataFrame(rows, "k string, o long, v double, s string")
    final = X.isin_false("s", ["SC1"])
    got = {r.k: (r.f, r.l) for r in df.groupBy("k").agg(
        ordered.first_by("v", "o").alias("f"), ordered.last_by_where("o", "o", final).alias("l")).collect()}
    assert got == {"a": (None, 2), "b": (7.0, None)}


def test_running_total_null_policy(spark):
    df = spark.createDataFrame([("g", 1, 1), ("g", 2, None), ("g", 3, 2)], "g string, d int, n int")
    skip = running.running_total(df, ["g"], ["d"], "n", "c")
    prop = running.running_total(df, ["g"], ["d"], "n", "c", null_policy="propagate")
    assert [r.c for r in skip.orderBy("d").collect()] == [1, 1, 3]
    assert [r.c for r in prop.orderBy("d").collect()] == [1, None, None]


def test_complete_dates_is_full_join_and_fill_leaves_leading_nulls(spark):
    rows = [("g", dt.date(2001, 1, 2), 5), ("g", dt.date(2001, 1, 4), 7), ("g", dt.date(2001, 1, 9), 1)]
    df = spark.createDataFrame(rows, "g string, d date, v int").withColumn(
        "lo", F.lit(dt.date(2001, 1, 1))).withColumn("hi", F.lit(dt.date(2001, 1, 5)))
    out = densify.complete_dates(df, ["g"], "d", F.min("lo"), F.max("hi")).drop("lo", "hi")
    out = running.fill_down(out, ["g"], ["d"], ["v"])
    got = [(r.d.day, r.v) for r in out.orderBy("d").collect()]
    # day 9 lies outside the grid and survives; day 1 has nothing to carry
    assert got == [(1, None), (2, 5), (3, 5), (4, 7), (5, 7), (9, 1)]


# --------------------------------------------------------- pipeline rules

def _live(spark, rows, ds_rows, cfg=C.FIXTURE_CONFIG):
    det = canonical.current_year_detections(canonical.canonical_detections(raw_rows(spark, rows)), cfg)
    ds = spark.createDataFrame(ds_rows, "pit_id string, latest_downstream timestamp_ntz")
    return det, ds


def test_juvenile_rule_uses_latest_with_latest(spark):
    rows = [
        det_row("J1", "01/10/2001 10:00:00 AM", stage="Juvenile", release_site="NEWSOC - x"),
        det_row("J1", "02/10/2001 10:00:00 AM", stage="Juvenile", release_site="NEWSOC - x"),
        det_row("J2", "01/10/2001 10:00:00 AM", stage="Juvenile", release_site="NEWSOC - x"),
        det_row("J3", "01/10/2001 10:00:00 AM", stage="Juvenile", release_site="NEWSOC - x"),
    ]
    ds = [("J1", dt.datetime(2001, 1, 20)),  # before the latest upstream -> passes
          ("J2", dt.datetime(2001, 1, 20))]  # after the only upstream -> fails; J3 never downstream
    det, ds_df = _live(spark, rows, ds)
    ind = live.individuals_live(det, ds_df, C.FIXTURE_CONFIG)
    assert [r.pit_id for r in ind.collect()] == ["J1"]
    two = live.individuals_live_two_pass(det, ds_df, C.FIXTURE_CONFIG)
    assert sorted(map(tuple, ind.collect())) == sorted(map(tuple, two.collect()))


def test_entry_falls_back_to_first_and_diff_stays_null(spark):
    rows = [det_row("A", "01/10/2001 10:00:00 AM", site="SC3 - x"),
            det_row("A", "01/12/2001 10:00:00 AM", site="SC4 - x")]
    det, ds = _live(spark, rows, [("Z", dt.datetime(2000, 1, 1))])
    r = live.individuals_live(det, ds, C.FIXTURE_CONFIG).first()
    assert r.sfc_entry_final == dt.datetime(2001, 1, 10, 10) and r.sfc_diff is None


def test_adult_rows_only_for_non_passing_fish(spark):
    rows = [det_row("M", "01/10/2001 10:00:00 AM", stage="Juvenile", release_site="OTHER - x", length=100.0),
            det_row("M", "01/11/2001 10:00:00 AM", stage="Adult", release_site="OTHER - x", length=600.0)]
    det, ds = _live(spark, rows, [("Z", dt.datetime(2000, 1, 1))])
    r = live.individuals_live(det, ds, C.FIXTURE_CONFIG).first()
    assert r.sfc_first == dt.datetime(2001, 1, 11, 10) and r.length_mm == 600.0
    assert r.release_lifestage == "Adult"


def test_completed_single_pass_equals_literal(spark):
    rows = [
        det_row("A", "01/10/1999 10:00:00 AM", stage="Adult", site="SC1 - x", release="01/01/1998"),
        det_row("A", "01/11/1999 10:00:00 AM", stage="Juvenile", site="SC2 - x", release_site="NEWSOC - x",
                release="01/01/1998"),
        det_row("B", "01/10/1999 10:00:00 AM", stage="Juvenile", site="SC3 - x", release_site="REDR - x",
                release="01/01/1998"),
        det_row("B", "01/12/1999 10:00:00 AM", stage="Juvenile", site="SC1 - x", release_site="REDR - x",
                release="01/01/1998", species="Chinook"),
        det_row("C", "01/12/1999 10:00:00 AM", stage=None, length=None, site="SC1 - x", release_site="CROOKR - x",
                release="01/01/1997"),
    ]
    det = canonical.completed_detections(raw_rows(spark, rows))
    ds = spark.createDataFrame([("A", dt.datetime(1999, 1, 5)), ("B", dt.datetime(1999, 1, 11)),
                                ("C", dt.datetime(1999, 1, 1))], "pit_id string, latest_downstream timestamp_ntz")
    cfg = C.FIXTURE_CONFIG
    single = completed.individuals_completed_single_pass(det, ds, cfg)
    juv = completed.migratory_juveniles_completed(det, ds, cfg)
    literal = completed.individuals_completed(completed.population_completed(det, juv, cfg), cfg)
    a = sorted(map(tuple, single.collect()))
    b = sorted(map(tuple, literal.collect()))
    assert a == b and len(a) == 3


def test_run_stats_excludes_floor_and_current(spark):
    cfg = C.RunConfig(as_of=dt.date(2001, 3, 15), floor_year=1998)
    rows = [(dt.date(y, 1, d), y, "Chinook", 1) for y in (1998, 1999, 2000, 2001) for d in (1, 2)]
    daily = spark.createDataFrame(rows, "sfc_final_date date, spawn_year int, species string, n long")
    daily = running.group_total(daily, ["spawn_year", "species"], "n", "sy_total")
    daily = running.running_total(daily, ["spawn_year", "species"], ["sfc_final_date"], "n", "cumulative_total")
    daily = daily.withColumns({"daily_prop": F.col("n") / F.col("sy_total"),
                               "daily_cumulative": F.col("cumulative_total") / F.col("sy_total"),
                               "current_sy": F.lit(2001)})
    comp = daily.filter("spawn_year < 2001")
    cur = daily.filter("spawn_year = 2001").drop("current_sy")
    alld = progress.all_years(progress.complete_daily(comp, cfg), progress.complete_current(cur, cfg))
    stats = progress.run_stats(alld, cfg)
    day1 = stats.filter(F.col("dummy_date") == dt.date(1976, 1, 1)).first()
    assert (day1.median_percentcomplete, day1.min_percentcomplete, day1.max_percentcomplete) == (50.0, 50.0, 50.0)
    last = stats.filter(F.col("dummy_date") == dt.date(1976, 12, 31)).first()
    assert last.min_percentcomplete == 100.0
    ytd = dashboard.year_to_date(alld, cfg)
    assert ytd.filter("spawn_year = 1998").count() == 0
    assert ytd.filter("spawn_year = 2001").agg(F.max("dummy_date")).first()[0] <= dt.date(1976, 3, 15)


# ------------------------------------------------- progress-chain rules

def _daily_rows(spark, rows, with_current=True):
    """rows: (date, spawn_year, species, n) -> a daily table with totals."""
    d = spark.createDataFrame(rows, "sfc_final_date date, spawn_year int, species string, n long")
    d = running.group_total(d, ["spawn_year", "species"], "n", "sy_total")
    d = running.running_total(d, ["spawn_year", "species"], ["sfc_final_date"], "n", "cumulative_total")
    d = d.withColumns({"daily_prop": F.col("n") / F.col("sy_total"),
                       "daily_cumulative": F.col("cumulative_total") / F.col("sy_total")})
    if with_current:
        d = d.withColumn("current_sy", X.current_spawn_year("species", C.FIXTURE_CONFIG))
    return d


def test_unknown_species_dropped_from_completed_daily(spark):
    ind = spark.createDataFrame(
        [("A", "Sockeye", 1999, dt.datetime(1999, 5, 1, 10)), ("B", "Chinook", 1999, dt.datetime(1999, 5, 1, 10)),
         ("C", "Chinook", 2001, dt.datetime(2001, 1, 5, 10))],
        "pit_id string, species string, spawn_year int, sfc_entry_final timestamp_ntz")
    got = completed.daily_completed(ind, C.FIXTURE_CONFIG).collect()
    assert [(r.species, r.spawn_year) for r in got] == [("Chinook", 1999)]


def test_steelhead_overshoot_rows_survive_the_grid(spark):
    # 30 June 2001 is doy 181 -> dummy 1977-07-01, past the species' last day
    rows = [(dt.date(2000, 7, 10), 2001, "Steelhead", 2), (dt.date(2001, 6, 30), 2001, "Steelhead", 1)]
    cfg = C.RunConfig(as_of=dt.date(2002, 3, 1), floor_year=1990)
    comp = progress.complete_daily(_daily_rows(spark, rows), cfg)
    days = [r.dummy_date for r in comp.orderBy("dummy_date").collect()]
    assert days[0] == dt.date(1976, 7, 10) and days[-1] == dt.date(1977, 7, 1)
    assert dt.date(1977, 6, 30) in days
    last = comp.filter(F.col("dummy_date") == dt.date(1977, 7, 1)).first()
    assert (last.n, last.cumulative_total, last.daily_cumulative) == (1, 3, 1.0)
    # grid rows before the first entry of the year carry nothing forward
    first = comp.orderBy("dummy_date").first()
    assert first.n == 2 and first.sy_total == 3


def test_complete_current_fills_spawn_year_forward(spark):
    rows = [(dt.date(2001, 1, 3), 2001, "Chinook", 1), (dt.date(2001, 1, 6), 2001, "Chinook", 2)]
    cur = progress.complete_current(_daily_rows(spark, rows, with_current=False), C.FIXTURE_CONFIG)
    r = cur.filter(F.col("dummy_date") == dt.date(1976, 1, 4)).first()
    assert (r.spawn_year, r.n, r.cumulative_total, r.daily_prop) == (2001, 0, 1, 0.0)
    assert cur.agg(F.max("dummy_date")).first()[0] == dt.date(1976, 12, 31)


def test_status_date_modes():
    import datetime as _dt
    early = C.RunConfig(as_of=_dt.date(2001, 3, 15))
    assert early.as_of.timetuple().tm_yday == 74

    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([("Steelhead",), ("Chinook",)], "species string")
    ref = [r[0] for r in df.select(dashboard.status_dummy_date(early, F.col("species"))).collect()]
    assert ref == [_dt.date(1976, 3, 14), _dt.date(1976, 3, 14)]
    aligned = C.RunConfig(as_of=_dt.date(2001, 3, 15), status_date_mode="aligned")
    got = [r[0] for r in df.select(dashboard.status_dummy_date(aligned, F.col("species"))).collect()]
    assert got == [_dt.date(1977, 3, 16), _dt.date(1976, 3, 14)]


def test_entry_date_zone_variant(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 3, 4, 20, 30),)], "t timestamp_ntz")
    local, utc = df.select(X.entry_date("t"), X.entry_date("t", "UTC")).first()
    assert local == dt.date(2001, 3, 4) and utc == dt.date(2001, 3, 5)


def test_complete_dates_forms_agree(spark):
    """In-partition completion == full-outer-join completion, including NULL
    keys, days outside the grid, duplicate days and NULL dates."""
    rows = [
        ("a", 1, dt.date(2001, 1, 2), 5), ("a", 1, dt.date(2001, 1, 2), 6),   # duplicate day
        ("a", 1, dt.date(2001, 1, 9), 1),                                      # outside the grid
        ("a", 2, dt.date(2001, 1, 1), 2), ("a", 2, None, 3),                   # NULL date
        (None, 1, dt.date(2001, 1, 3), 4),                                     # NULL key
        ("b", 1, dt.date(2001, 1, 5), 7),                                      # lo > hi: no grid
    ]
    df = spark.createDataFrame(rows, "g string, y int, d date, v int").withColumns({
        "lo": F.when(F.col("g") == "b", F.lit(dt.date(2001, 1, 6))).otherwise(F.lit(dt.date(2001, 1, 1))),
        "hi": F.when(F.col("g") == "b", F.lit(dt.date(2001, 1, 5))).otherwise(F.lit(dt.date(2001, 1, 4))),
    })
    a = densify.complete_dates(df, ["g", "y"], "d", F.min("lo"), F.max("hi")).drop("lo", "hi")
    b = densify.complete_dates_join(df, ["g", "y"], "d", F.min("lo"), F.max("hi")).drop("lo", "hi")

    def key(r):
        return tuple((x is None, str(x)) for x in r)
    ra = sorted((tuple(r) for r in a.select("g", "y", "d", "v").collect()), key=key)
    rb = sorted((tuple(r) for r in b.select("g", "y", "d", "v").collect()), key=key)
    assert ra == rb
    # (a,1): 3 uncovered grid days + 2 duplicate rows + 1 outside = 6;
    # (a,2): 3 + 1 + NULL-date row = 5; (NULL,1): 3 + 1 = 4; b: no grid, 1
    assert len(ra) == 16


def test_completed_entry_days_are_local_in_every_mode(spark, sf_dir):
    import dataclasses

    from runtally.plans.context import RunTables
    host = dataclasses.replace(C.FIXTURE_CONFIG, entry_date_zone="UTC")
    a, b = (sorted(map(str, RunTables.from_driver_tables(spark, sf_dir, c).daily_completed.collect())) for c in (host, C.FIXTURE_CONFIG))
    assert a == b and a


def test_ignoring_the_marker_changes_downstream_times(spark, sf_dir):
    from runtally import registry
    t = registry.tables(spark, sf_dir)
    ignored = registry.QUERIES["downstream_ampm_ignored"](spark, sf_dir).withColumnRenamed("latest_downstream", "other")
    both = t.downstream_latest_time.join(ignored, "pit_id")
    assert both.filter("latest_downstream <> other").count() > 0


def test_both_juvenile_outcomes_occur(spark, sf_dir):
    from runtally import registry
    t = registry.tables(spark, sf_dir)
    late = t.detections.groupBy("pit_id").agg({"observation_datetime": "max"}).toDF("pit_id", "up")
    j = late.join(t.downstream_latest_time, "pit_id")
    assert j.filter("latest_downstream < up").count() >= 10 and j.filter("latest_downstream >= up").count() >= 10


def test_current_year_key_lists_species_not_seen(spark):
    from runtally.plans import dashboard
    key = dashboard.current_year_key(spark, C.FIXTURE_CONFIG)
    assert sorted(r.species for r in key.collect()) == sorted(C.SPECIES)


def test_fill_down_takes_days_in_order_on_one_dummy_day(spark):
    from runtally.operators.running import fill_down
    rows = [("a", dt.date(1976, 1, 1), dt.date(1998, 1, 1), 2), ("a", dt.date(1976, 1, 1), dt.date(1997, 1, 1), 1),
            ("a", dt.date(1976, 1, 2), None, None)]
    df = spark.createDataFrame(rows, "k string, dummy_date date, sfc_final_date date, v int")
    got = fill_down(df, ["k"], ["dummy_date", "sfc_final_date"], ["v"]).filter("dummy_date = date'1976-01-02'").collect()
    assert [r.v for r in got] == [2]


def test_host_zone_run_differs_from_the_local_one(spark, sf_dir):
    from runtally import registry
    local, host = (sorted(map(str, registry.QUERIES[q](spark, sf_dir).collect())) for q in ("daily_entries", "daily_entries_host_zone"))
    assert host and local != host


def test_length_frequency_totals_over_bins(spark):
    from runtally.plans import dashboard
    rows = [("a", 254.0, "Adult"), ("a", 254.0, "Adult"), ("a", 508.0, "Adult"), ("a", 10.0, "Juvenile"), ("a", None, "Adult"),
            ("b", 25.4, "Adult"), (None, 100.0, "Adult")]
    df = spark.createDataFrame(rows, "species string, length_mm double, release_lifestage string")
    got = sorted((r.species, r.length_bin_in, r.freq, r.total_sample, round(r.mean_length, 6)) for r in dashboard.length_frequency(df).collect())
    assert got == [("a", 10.0, 2, 3, 338.666667), ("a", 20.0, 1, 3, 338.666667), ("b", 1.0, 1, 1, 25.4)]
