"""Current-run-year pipeline ("live" policy): OP7-OP11 and OP17.

Plan shape at scale: the detection table is shuffled once, on ``pit_id``,
through a partial/final hash aggregate that computes, per fish, both the
"all rows" and the "flagged rows only" versions of every summary plus the
mark attributes and the latest juvenile detection. The downstream table is
reduced per fish the same way. The two per-fish results are co-partitioned
on ``pit_id``, so the juvenile rule is a join without a further exchange.
Everything after that is one row per fish, then one row per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtally import config as C
from runtally.functions import columns as X
from runtally.operators.ordered import first_by, first_by_where, last_by_where, top1_by_key
from runtally.operators.relational import filter_member_or
from runtally.operators.running import group_total, running_window, share_of_total

INDIVIDUAL_COLUMNS = (
    "pit_id", "sfc_first", "sfc_entry_final", "sfc_diff", "length_mm", "release_lifestage",
    "species", "spawn_year", "release_sitecode", "release_datetime",
)
DAILY_COLUMNS = (
    "sfc_final_date", "spawn_year", "species", "n", "sy_total", "cumulative_total",
    "daily_prop", "daily_cumulative",
)


def migratory_juveniles_live(det: DataFrame, ds_latest: DataFrame) -> DataFrame:
    """OP7 (live): each juvenile-marked fish's latest detection, kept when
    its latest downstream detection is earlier. Compares latest with latest
    (not an as-of join)."""
    juv = det.filter(F.col("release_lifestage") == "Juvenile")
    latest = top1_by_key(juv, ["pit_id"], "observation_datetime", "ordinal")
    return latest.join(ds_latest, "pit_id", "inner").filter(
        F.col("latest_downstream") < F.col("observation_datetime")
    )


def _kept_anyway(cfg: C.RunConfig) -> F.Column:
    return (F.col("release_lifestage") == "Adult") | F.col("release_sitecode").isin(list(cfg.kept_release_sites))


def population_live(det: DataFrame, juveniles: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP8 (live): all rows of passing juveniles, plus adult-marked rows and
    rows from the always-kept release sites (EXISTS inside an OR)."""
    return filter_member_or(det, juveniles, "pit_id", _kept_anyway(cfg), spread_by="ordinal")


def mark_attributes(det: DataFrame) -> DataFrame:
    """OP9: first species, spawn year, release site and date per fish."""
    o = "ordinal"
    return det.groupBy("pit_id").agg(
        first_by("species", o).alias("species"),
        first_by("spawn_year", o).alias("spawn_year"),
        first_by("release_sitecode", o).alias("release_sitecode"),
        first_by("release_datetime", o).alias("release_datetime"),
    )


def summarise_individuals(pop: DataFrame, keys: list[str], cfg: C.RunConfig, weight: str = "ordinal") -> DataFrame:
    """OP10 core: first time, last final-site time, elapsed days, mean
    length and first life stage per key group (over the given rows)."""
    final = X.isin_false("observation_sitecode", cfg.final_sites)
    return pop.groupBy(*keys).agg(
        first_by("observation_datetime", weight).alias("sfc_first"),
        last_by_where("observation_datetime", weight, final).alias("sfc_entry_final"),
        F.avg("length_mm").alias("length_mm"),
        first_by("release_lifestage", weight).alias("release_lifestage"),
    )


def finish_individuals(df: DataFrame) -> DataFrame:
    """Elapsed days from the un-filled final time, then fall back to first."""
    return df.withColumns({
        "sfc_diff": X.elapsed_days("sfc_entry_final", "sfc_first"),
    }).withColumn("sfc_entry_final", F.coalesce("sfc_entry_final", "sfc_first"))


def individuals_live_two_pass(det: DataFrame, ds_latest: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """Literal form of OP10 (population rows, then summary, then marks).
    Kept as the reference for ``individuals_live``; it shuffles detections
    three times."""
    juv = migratory_juveniles_live(det, ds_latest).select("pit_id")
    pop = population_live(det, juv, cfg)
    ind = finish_individuals(summarise_individuals(pop, ["pit_id"], cfg))
    marks = mark_attributes(det)
    return ind.join(marks, "pit_id", "left").select(*INDIVIDUAL_COLUMNS)


def individuals_live(det: DataFrame, ds_latest: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP7-OP10 (live) in a single per-fish aggregate over the detections.

    For each fish, compute the summary over all rows (used when the fish
    passes the juvenile rule) and over kept-anyway rows only (used
    otherwise), the marks over all rows, and the latest juvenile time.
    One partial+final aggregate on ``pit_id`` replaces the three shuffles of
    the literal plan; ``ds_latest`` is already partitioned on ``pit_id``.
    """
    o = "ordinal"
    obs = "observation_datetime"
    kept = F.coalesce(_kept_anyway(cfg), F.lit(False))
    final = X.isin_false("observation_sitecode", cfg.final_sites)
    juvenile = F.col("release_lifestage") == "Juvenile"
    per_fish = det.groupBy("pit_id").agg(
        # marks: all current-year rows
        first_by("species", o).alias("species"),
        first_by("spawn_year", o).alias("spawn_year"),
        first_by("release_sitecode", o).alias("release_sitecode"),
        first_by("release_datetime", o).alias("release_datetime"),
        # juvenile rule input
        F.max(F.when(juvenile, F.col(obs))).alias("_juv_latest"),
        # summary over all rows
        first_by(obs, o).alias("_a_first"),
        last_by_where(obs, o, final).alias("_a_final"),
        F.avg("length_mm").alias("_a_len"),
        first_by("release_lifestage", o).alias("_a_stage"),
        # summary over kept-anyway rows
        F.max(kept.cast("int")).alias("_k_any"),
        first_by_where(obs, o, kept).alias("_k_first"),
        last_by_where(obs, o, kept & final).alias("_k_final"),
        F.avg(F.when(kept, F.col("length_mm"))).alias("_k_len"),
        first_by_where("release_lifestage", o, kept).alias("_k_stage"),
    )
    j = per_fish.join(ds_latest, "pit_id", "left")
    passing = F.coalesce(F.col("latest_downstream") < F.col("_juv_latest"), F.lit(False))
    pick = {
        "sfc_first": F.when(passing, F.col("_a_first")).otherwise(F.col("_k_first")),
        "sfc_entry_final": F.when(passing, F.col("_a_final")).otherwise(F.col("_k_final")),
        "length_mm": F.when(passing, F.col("_a_len")).otherwise(F.col("_k_len")),
        "release_lifestage": F.when(passing, F.col("_a_stage")).otherwise(F.col("_k_stage")),
    }
    out = j.filter(passing | (F.col("_k_any") == 1)).withColumns(pick)
    return finish_individuals(out).select(*INDIVIDUAL_COLUMNS)


def daily_entries(ind: DataFrame, entry_date_zone: str | None = None) -> DataFrame:
    """OP11: fish entering per day, per-year totals, running totals, shares.

    The per-day count is a partial/final aggregate; the windows then run on
    at most species x years x 366 rows. The running share is computed as
    running count / total (exact, independent of summation order).
    """
    day = X.entry_date("sfc_entry_final", entry_date_zone)
    counts = ind.groupBy(day.alias("sfc_final_date"), "spawn_year", "species").agg(F.count(F.lit(1)).alias("n"))
    part = ["spawn_year", "species"]
    out = group_total(counts, part, "n", "sy_total")
    out = out.withColumn("cumulative_total", F.sum("n").over(running_window(part, ["sfc_final_date"])))
    out = share_of_total(out, "n", "sy_total", "daily_prop")
    out = share_of_total(out, "cumulative_total", "sy_total", "daily_cumulative")
    return out.select(*DAILY_COLUMNS)


def flow_window(flow: DataFrame, daily: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP17: river values from the first entry day up to the as-of date.

    The lower bound is a scalar subquery, so it is pushed down like a literal."""
    lo = daily.agg(F.min("sfc_final_date").alias("_lo")).scalar()
    return (
        flow.filter((F.col("date") >= lo) & (F.col("date") <= F.lit(cfg.as_of)))
        .select("date", "mean_temp", "mean_discharge", F.lit(1).alias("group"))
    )
