"""Raw feeds -> canonical detection tables (OP1-OP6).

Canonical ``detection`` columns: pit_id, species, rear_type, run_type,
release_sitecode, release_lifestage, release_datetime (date), release_year,
observation_sitecode, observation_datetime (timestamp_ntz wall clock),
observation_month, observation_year, yrs_at_large, spawn_year, length_mm,
ordinal (report order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtally import config as C
from runtally.functions import columns as X
from runtally.operators.ordered import top1_by_key
from runtally.operators.relational import evaluated_once

DETECTION_COLUMNS = (
    "pit_id", "species", "rear_type", "run_type", "release_sitecode", "release_lifestage",
    "release_datetime", "release_year", "observation_sitecode", "observation_datetime",
    "observation_month", "observation_year", "yrs_at_large", "spawn_year", "length_mm", "ordinal",
)


def canonical_detections(raw: DataFrame, ampm: str = "parse") -> DataFrame:
    """OP1 + OP2: rename, site tokens, parse clocks and dates, years."""
    release = X.parse_mdy("release_date")
    df = evaluated_once(raw, X.parse_local_ts("obs_time", ampm), "observation_datetime").select(
        F.col("tag").alias("pit_id"),
        F.col("species_name").alias("species"),
        F.col("rear_type"),
        F.col("run_name").alias("run_type"),
        X.site_token("release_site").alias("release_sitecode"),
        F.col("mark_life_stage").alias("release_lifestage"),
        release.alias("release_datetime"),
        X.site_token("site").alias("observation_sitecode"),
        F.col("observation_datetime"),
        F.col("mark_length").cast("double").alias("length_mm"),
        F.col("ordinal"),
    )
    df = df.withColumns({
        "release_year": F.year("release_datetime"),
        "observation_month": F.month("observation_datetime"),
        "observation_year": F.year("observation_datetime"),
    })
    df = df.withColumns({
        "yrs_at_large": F.col("observation_year") - F.col("release_year"),
        "spawn_year": X.spawn_year("observation_datetime", "species"),
    })
    return df.select(*DETECTION_COLUMNS)


def completed_detections(raw: DataFrame) -> DataFrame:
    """Completed-years feed: canonical + OP3 life-stage reclassification +
    OP4 drop of juveniles detected in their release year."""
    df = canonical_detections(raw, ampm="parse")
    df = df.withColumn(
        "release_lifestage", X.reclassify_lifestage("release_lifestage", "length_mm", "species")
    )
    return df.filter(X.not_same_year_juvenile("yrs_at_large", "release_lifestage"))


def current_year_detections(det: DataFrame, cfg: C.RunConfig, with_most_recent: bool = False) -> DataFrame:
    """OP5: keep detections of each species' current spawn year.

    The species -> current-year key is a literal CASE (no join). The implied
    ``observation_year`` range is added as a separate conjunct so a table
    partitioned or sorted by observation year prunes files at the scan.
    ``with_most_recent`` adds the global max spawn year (a scalar subquery,
    never an unpartitioned window).
    """
    cur = X.current_spawn_year("species", cfg)
    years = sorted({cfg.current_spawn_year(s) for s in cfg.species} - {None})
    coarse = F.col("observation_year").between(years[0] - 1, years[-1])
    out = det
    if with_most_recent:
        top = det.agg(F.max("spawn_year").alias("most_recent"))
        out = out.withColumn("most_recent", top.scalar())
    out = out.withColumn("current_sy", cur)
    return out.filter(coarse & (F.col("spawn_year") == F.col("current_sy")))


def downstream_detections(raw: DataFrame, ampm: str = "parse") -> DataFrame:
    """Downstream feed: pit_id, ds_site, ds_datetime, ordinal."""
    return raw.select(
        F.col("tag").alias("pit_id"),
        X.site_token("site").alias("ds_site"),
        X.parse_local_ts("obs_time", ampm).alias("ds_datetime"),
        F.col("ordinal"),
    )


def latest_downstream(ds: DataFrame) -> DataFrame:
    """OP6: per fish the latest downstream detection (ties -> first row in
    report order; fish with no parseable time -> no row)."""
    return top1_by_key(ds, ["pit_id"], "ds_datetime", "ordinal", ["ds_datetime", "ds_site"])


def latest_downstream_times(raw: DataFrame, ampm: str) -> DataFrame:
    """Per fish the latest downstream time as ``ampm`` reads it and as "parse" does, one pass over a
    report that both rules use; fish without either time -> no row. The filter names both times, so
    that neither is pruned and both uses share one exchange."""
    ds = raw.select(
        F.col("tag").alias("pit_id"),
        X.parse_local_ts("obs_time", ampm).alias("_as_read"),
        X.parse_local_ts("obs_time", "parse").alias("_parsed"),
    )
    out = ds.groupBy("pit_id").agg(F.max("_as_read").alias("latest_as_read"), F.max("_parsed").alias("latest_parsed"))
    return out.filter(F.col("latest_as_read").isNotNull() | F.col("latest_parsed").isNotNull())


def latest_downstream_time(ds: DataFrame) -> DataFrame:
    """Only the latest time per fish (what the juvenile rule needs)."""
    return ds.groupBy("pit_id").agg(F.max("ds_datetime").alias("latest_downstream")).filter(
        F.col("latest_downstream").isNotNull()
    )
