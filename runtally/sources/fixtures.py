"""Driver tables -> the feeds the pipelines read.

No report files ship with the source workflow, so the registered queries run
on feeds derived from the driver's TPC-H-like tables (documented in
``FIXTURES.md``): detections from ``orders x customer``, downstream
detections from ``lineitem x orders`` and daily river values from
``lineitem``. The derivation is plain projection/join, so its work grows
with the tables. Timestamps are written as report text and parsed back by
the canonicalisation step, exactly like a landed report.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtally import config as C
from runtally.functions.columns import case_map

# Fixed fixture mappings (see FIXTURES.md section 4).
SEGMENT_SPECIES = {
    "BUILDING": "Steelhead",
    "AUTOMOBILE": "Chinook",
    "MACHINERY": "Bull Trout",
    "HOUSEHOLD": "Pacific Lamprey",
}
OTHER_SPECIES = "Cutthroat Trout"
PRIORITY_SITE = {"1": "SC1 - lower", "2": "SC2 - upper", "3": "SC3 - a", "4": "SC4 - b"}
OTHER_SITE = "CRA - c"
CUSTKEY_RELEASE_SITE = {0: "LGRRBR - x", 1: "LGRRRR - x", 2: "NEWSOC - x", 3: "CROOKR - x", 4: "REDR - x"}
OTHER_RELEASE_SITE = "OTHER - x"
STATUS_STAGE = {"O": "Adult", "F": "Juvenile"}
RETURNFLAG_SITE = {"A": "GRA - x", "N": "BON - y"}
OTHER_DOWNSTREAM_SITE = "LGR - z"
NATION_REAR = {0: "W", 1: "H"}
OTHER_REAR = "U"
NATION_RUN = {0: "Spring", 1: "Summer", 2: "Fall"}
OTHER_RUN = "Winter"
RELEASE_ORIGIN = dt.date(1994, 1, 1)
# Day of the driver tables' last order: all dates move back by the days from the
# run's as-of date to it, so a report landed on the as-of date holds every row.
LAST_ORDER = dt.date(2001, 8, 1)
# Downstream detections lie 0, 1, 2 or 3 times so many days before the shipment
# (by fish), so that juveniles both pass and fail "downstream before upstream".
DOWNSTREAM_STEP_DAYS = 150
DOWNSTREAM_STEPS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


TWO_DIGITS = tuple(f"{n:02d}" for n in range(100))


def _two(c) -> F.Column:
    """A field of 0 to 99 as two digits, looked up (cheaper per row than cast and pad)."""
    return F.get(F.array(*[F.lit(n) for n in TWO_DIGITS]), c.cast("int"))


def clock_text(ts) -> F.Column:
    """NTZ wall clock as report text "MM/dd/yyyy hh:mm:ss AM", built from its
    fields: ``date_format`` would pass through the session zone and shift a
    clock that falls in that zone's DST gap. (Concatenation, not
    ``format_string``, which is several times slower per row.)"""
    h = F.hour(ts)
    return F.concat(
        _two(F.month(ts)), F.lit("/"), _two(F.dayofmonth(ts)), F.lit("/"), F.lpad(F.year(ts).cast("string"), 4, "0"), F.lit(" "),
        _two((h + 11) % 12 + 1), F.lit(":"), _two(F.minute(ts)), F.lit(":"), _two(F.second(ts)),
        F.when(h < 12, F.lit(" AM")).otherwise(F.lit(" PM")),
    )


def date_text(d, compact: bool) -> F.Column:
    """Date as "MM/dd/yyyy" or "MMddyyyy", from its fields."""
    sep = F.lit("" if compact else "/")
    return F.concat(_two(F.month(d)), sep, _two(F.dayofmonth(d)), sep, F.lpad(F.year(d).cast("string"), 4, "0"))


def shift_days(cfg: C.RunConfig) -> int:
    """Days by which the tables' dates move back for a run."""
    return (LAST_ORDER - cfg.as_of).days


def _tag(custkey) -> F.Column:
    return F.concat(F.lit("T"), custkey.cast("string"))


def _release_site(custkey) -> F.Column:
    return case_map(custkey % 6, CUSTKEY_RELEASE_SITE, OTHER_RELEASE_SITE)


def detection_feed(spark: SparkSession, sf_dir: str, cfg: C.RunConfig, completed: bool = False) -> DataFrame:
    """Raw detection report as landed on ``cfg.as_of`` (one row per order, all orders).

    ``completed=True`` gives the completed-years report spelling: release
    date as ``MMddyyyy`` and a run name column.
    """
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    d = o.join(c, o.o_custkey == c.c_custkey, "inner")
    key = F.col("o_orderkey")
    obs = F.col("o_orderdate") + F.make_dt_interval(F.lit(-shift_days(cfg)), (key % 24).cast("int"), (key % 60).cast("int"), F.lit(0))
    release = F.date_add(F.lit(RELEASE_ORIGIN), (F.col("o_custkey") * 37 % 1500).cast("int"))
    cols = {
        "tag": _tag(F.col("o_custkey")),
        "species_name": case_map("c_mktsegment", SEGMENT_SPECIES, OTHER_SPECIES),
        "rear_type": case_map(F.col("c_nationkey") % 3, NATION_REAR, OTHER_REAR),
        "run_name": case_map(F.col("c_nationkey") % 4, NATION_RUN, OTHER_RUN) if completed
        else F.lit(None).cast("string"),
        "site": case_map(F.substring("o_orderpriority", 1, 1), PRIORITY_SITE, OTHER_SITE),
        "release_site": _release_site(F.col("o_custkey")),
        "obs_time": clock_text(obs),
        "release_date": date_text(release, compact=completed),
        "mark_life_stage": case_map("o_orderstatus", STATUS_STAGE),
        "mark_length": F.when(key % 11 != 0, F.col("o_totalprice") % 900 + 100),
        "ordinal": key,
    }
    return d.select(*[v.alias(k) for k, v in cols.items()])


def downstream_feed(spark: SparkSession, sf_dir: str, cfg: C.RunConfig) -> DataFrame:
    """Raw downstream-detection report (one row per line item)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    d = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    ordinal = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supp"),
    )
    earlier = -(F.lit(shift_days(cfg)) + F.col("o_custkey") % DOWNSTREAM_STEPS * DOWNSTREAM_STEP_DAYS)
    clock = F.make_dt_interval(earlier.cast("int"), ((F.col("l_orderkey") + F.col("l_linenumber")) % 24).cast("int"),
                               (F.col("l_partkey") % 60).cast("int"), F.lit(0))
    return d.select(
        _tag(F.col("o_custkey")).alias("tag"),
        case_map("l_returnflag", RETURNFLAG_SITE, OTHER_DOWNSTREAM_SITE).alias("site"),
        _release_site(F.col("o_custkey")).alias("release_site"),
        clock_text(F.col("l_shipdate") + clock).alias("obs_time"),
        ordinal.alias("ordinal"),
    )


def river_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily river values, wide: date, mean_temp, mean_discharge."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.max("l_quantity").alias("mean_temp"), F.max("l_extendedprice").alias("mean_discharge")
    )


def river_daily_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily river values as landed in long form: (date, parameter_cd, value)."""
    li = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"), "l_quantity", "l_extendedprice")
    temp = li.select("date", F.lit(C.PARAM_TEMPERATURE).alias("parameter_cd"), F.col("l_quantity").alias("value"))
    flow = li.select("date", F.lit(C.PARAM_DISCHARGE).alias("parameter_cd"), F.col("l_extendedprice").alias("value"))
    return temp.unionByName(flow)
