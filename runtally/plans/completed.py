"""Completed-run-years pipeline ("completed" policy): OP7, OP8, OP10, OP11.

Differences from the live policy: juvenile candidates must come from the
listed release sites, only a passing fish's latest juvenile row joins the
population, summaries are per (fish, species, spawn year), and the current
spawn year is dropped at the end.

Two forms are kept. ``individuals_completed`` is the literal plan: latest
juvenile row per fish, downstream rule, population union, summary per
(fish, species, year); it reads the detections twice (candidates and main
rows). ``individuals_completed_single_pass`` (used by the pipelines) reads
them once: one partial/final aggregate per (fish, species, year) carries
both the main-row summaries and the group's best juvenile candidate, and a
window over each fish's few aggregated rows settles the rest. Marks (first
release site/date per fish) also come from that window, never from a second
pass over the detections.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runtally import config as C
from runtally.functions import columns as X
from runtally.operators.ordered import first_by, last_by_where, top1_by_key
from runtally.plans.canonical import DETECTION_COLUMNS
from runtally.plans.live import DAILY_COLUMNS, daily_entries, finish_individuals

INDIVIDUAL_COLUMNS = (
    "pit_id", "species", "spawn_year", "sfc_first", "sfc_entry_final", "sfc_diff", "length_mm",
    "release_lifestage", "release_sitecode", "release_datetime",
)


def migratory_juveniles_completed(det: DataFrame, ds_latest: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP7 (completed): latest row of each juvenile from the listed release
    sites, kept when it is later than the fish's latest downstream time;
    returned with the detection columns only."""
    cand = det.filter(
        (F.col("release_lifestage") == "Juvenile")
        & F.col("release_sitecode").isin(list(cfg.juvenile_release_sites))
    )
    latest = top1_by_key(cand, ["pit_id"], "observation_datetime", "ordinal")
    return (
        latest.join(ds_latest, "pit_id", "inner")
        .filter(F.col("observation_datetime") > F.col("latest_downstream"))
        .select(*DETECTION_COLUMNS)
    )


def population_completed(det: DataFrame, juveniles: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP8 (completed): adult-marked or always-kept rows, then the passing
    juvenile rows. Report order becomes (source, ordinal)."""
    main = det.filter(
        (F.col("release_lifestage") == "Adult") | F.col("release_sitecode").isin(list(cfg.kept_release_sites))
    )
    ranked = [
        main.withColumn("ordinal", F.struct(F.lit(0).alias("source"), F.col("ordinal").alias("row"))),
        juveniles.withColumn("ordinal", F.struct(F.lit(1).alias("source"), F.col("ordinal").alias("row"))),
    ]
    return ranked[0].unionByName(ranked[1])


def individuals_completed(pop: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP10 (completed): one row per (fish, species, spawn year) with marks."""
    o = "ordinal"
    final = X.isin_false("observation_sitecode", cfg.final_sites)
    groups = pop.groupBy("pit_id", "species", "spawn_year").agg(
        first_by("observation_datetime", o).alias("sfc_first"),
        last_by_where("observation_datetime", o, final).alias("sfc_entry_final"),
        F.avg("length_mm").alias("length_mm"),
        first_by("release_lifestage", o).alias("release_lifestage"),
        F.min(o).alias("_first_ord"),
        first_by("release_sitecode", o).alias("_site"),
        first_by("release_datetime", o).alias("_rdate"),
    )
    fish = Window.partitionBy("pit_id")
    marks = groups.withColumns({
        "release_sitecode": F.min_by("_site", "_first_ord").over(fish),
        "release_datetime": F.min_by("_rdate", "_first_ord").over(fish),
    })
    out = marks.filter(F.col("spawn_year").isNotNull())
    return finish_individuals(out).select(*INDIVIDUAL_COLUMNS)


def individuals_completed_single_pass(det: DataFrame, ds_latest: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP7+OP8+OP10 (completed) from one scan and one detection shuffle.

    Per (fish, species, year) group a partial/final aggregate computes the
    summaries over the kept-anyway rows ("main") and the group's best
    juvenile candidate (latest time, first in order). A window over each
    fish's few aggregated groups picks the fish's best candidate; the
    downstream rule decides whether that row joins the population. Its row
    comes after every main row in report order, so it only becomes the
    first row of a group without main rows, and it becomes the last final-
    site row whenever it is at a final site. Same result as the literal
    population-then-summary plan (``individuals_completed``), which reads
    the detections twice.
    """
    o = F.col("ordinal")
    obs = F.col("observation_datetime")
    main = F.coalesce(
        (F.col("release_lifestage") == "Adult") | F.col("release_sitecode").isin(list(cfg.kept_release_sites)),
        F.lit(False),
    )
    listed = F.coalesce(
        (F.col("release_lifestage") == "Juvenile")
        & F.col("release_sitecode").isin(list(cfg.juvenile_release_sites)),
        F.lit(False),
    )
    cand = listed & obs.isNotNull()
    final = X.isin_false("observation_sitecode", cfg.final_sites)
    # a row that is neither counts nowhere: a group of such rows has no main row and no candidate.
    # The filter names no time, so it runs before the clock is parsed.
    det = det.filter(main | listed).withColumns({
        "_j_key": F.when(cand, F.struct(X.descending_time(obs), o)),
        "_final": final,
    })

    def m_first(c):
        return F.min_by(F.when(main, F.col(c)), F.when(main, o))

    def j_pick(c):
        return F.min_by(c, "_j_key")

    groups = det.groupBy("pit_id", "species", "spawn_year").agg(
        F.max(main.cast("int")).alias("_m_any"),
        m_first("observation_datetime").alias("_m_first"),
        F.max_by(F.when(main & F.col("_final"), obs), F.when(main & F.col("_final"), o)).alias("_m_final"),
        F.sum(F.when(main, F.col("length_mm"))).alias("_m_len_sum"),
        F.count(F.when(main, F.col("length_mm"))).alias("_m_len_n"),
        m_first("release_lifestage").alias("_m_stage"),
        m_first("release_sitecode").alias("_m_rsite"),
        m_first("release_datetime").alias("_m_rdate"),
        F.min(F.when(main, o)).alias("_m_ord"),
        F.min("_j_key").alias("_j_key"),
        j_pick(obs).alias("_j_obs"),
        j_pick(F.col("_final")).alias("_j_final"),
        j_pick(F.col("length_mm")).alias("_j_len"),
        j_pick(F.col("release_lifestage")).alias("_j_stage"),
        j_pick(F.col("release_sitecode")).alias("_j_rsite"),
        j_pick(F.col("release_datetime")).alias("_j_rdate"),
    )
    fish = Window.partitionBy("pit_id")
    g = groups.withColumn("_j_best", F.min("_j_key").over(fish))
    g = g.join(ds_latest, "pit_id", "left")
    holds = F.coalesce(
        (F.col("_j_key") == F.col("_j_best")) & (F.col("_j_obs") > F.col("latest_downstream")), F.lit(False)
    )
    g = g.withColumn("_juv_row", holds)
    # marks: first main row of the fish, else its (passing) juvenile row
    g = g.withColumns({
        "_mk_site": F.min_by("_m_rsite", "_m_ord").over(fish),
        "_mk_date": F.min_by("_m_rdate", "_m_ord").over(fish),
        "_mk_any": F.max("_m_any").over(fish),
        "_jk_site": F.max(F.when(F.col("_juv_row"), F.col("_j_rsite"))).over(fish),
        "_jk_date": F.max(F.when(F.col("_juv_row"), F.col("_j_rdate"))).over(fish),
    })
    has_main = F.col("_m_any") == 1
    juv = F.col("_juv_row")
    juv_len = F.when(juv & F.col("_j_len").isNotNull(), F.col("_j_len"))
    len_sum = F.coalesce(F.col("_m_len_sum"), F.lit(0.0)) + F.coalesce(juv_len, F.lit(0.0))
    len_n = F.col("_m_len_n") + F.when(juv_len.isNotNull(), 1).otherwise(0)
    fish_main = F.col("_mk_any") == 1
    out = g.filter((has_main | juv) & F.col("spawn_year").isNotNull()).select(
        "pit_id", "species", "spawn_year",
        F.when(has_main, F.col("_m_first")).otherwise(F.col("_j_obs")).alias("sfc_first"),
        F.when(juv & F.col("_j_final"), F.col("_j_obs"))
        .otherwise(F.col("_m_final")).alias("sfc_entry_final"),
        F.when(len_n > 0, len_sum / len_n).alias("length_mm"),
        F.when(has_main, F.col("_m_stage")).otherwise(F.col("_j_stage")).alias("release_lifestage"),
        F.when(fish_main, F.col("_mk_site")).otherwise(F.col("_jk_site")).alias("release_sitecode"),
        F.when(fish_main, F.col("_mk_date")).otherwise(F.col("_jk_date")).alias("release_datetime"),
    )
    return finish_individuals(out).select(*INDIVIDUAL_COLUMNS)


def daily_completed(ind: DataFrame, cfg: C.RunConfig, entry_date_zone: str | None = None) -> DataFrame:
    """OP11 (completed): daily entries of completed years only. Species
    without a current-year key are dropped with the current year."""
    d = daily_entries(ind, entry_date_zone).withColumn("current_sy", X.current_spawn_year("species", cfg))
    return d.filter(F.col("spawn_year") != F.col("current_sy")).select(*DAILY_COLUMNS, "current_sy")
