"""Run progress across years: OP12-OP16.

Inputs are the daily tables (one row per species, spawn year and entry
day), so every operator here works on at most species x years x 366 rows
whatever the detection volume. The chain keeps one partitioning: the first
window (by species) places each species' rows together, and the calendar
completion, zero fill and fill-down of every (species, year) then run inside
it without further exchanges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runtally import config as C
from runtally.functions import columns as X
from runtally.operators.densify import complete_dates, zero_fill
from runtally.operators.running import fill_down, group_total, running_window

# Fixed output columns. Totals are carried forward; daily_prop is zero-filled before.
CARRIED_COLUMNS = ("sy_total", "cumulative_total", "daily_cumulative")
SHARE_COLUMNS = ("sy_total", "cumulative_total", "daily_prop", "daily_cumulative")


def with_dummy_calendar(daily: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """D4: day of year and the dummy-calendar date of each entry day."""
    return daily.withColumns({
        "day_of_year": F.dayofyear("sfc_final_date"),
        "dummy_date": X.dummy_date("sfc_final_date", "species", cfg.dummy_offset_fix),
    })


def complete_daily(daily_completed: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP12: every completed (species, year) spans every dummy day from the
    species' earliest completed day to its last calendar day; counts and
    shares zero-filled, totals carried forward."""
    d = with_dummy_calendar(daily_completed, cfg)
    # species minimum over all completed years (D5) as a window: the one
    # exchange (by species) also serves every later window of this chain
    d = d.withColumns({
        "min_dummy": F.min("dummy_date").over(Window.partitionBy("species")),
        "max_date": X.max_dummy_date("species"),
    })
    keys = ["species", "spawn_year"]
    out = complete_dates(d, keys, "dummy_date", F.min("min_dummy"), F.max("max_date"))
    out = out.drop("min_dummy", "max_date")
    out = zero_fill(out, ["n", "daily_prop"])
    out = fill_down(out, keys, ["dummy_date", "sfc_final_date"], CARRIED_COLUMNS)
    return out.select(
        "species", "spawn_year", "dummy_date", "sfc_final_date", "n", *SHARE_COLUMNS, "current_sy", "day_of_year"
    )


def complete_current(daily: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP13: the current year completed per species from its first entry
    day to the species' last calendar day; spawn year carried forward too."""
    d = with_dummy_calendar(daily, cfg).withColumn("max_date", X.max_dummy_date("species"))
    out = complete_dates(d, ["species"], "dummy_date", F.min("dummy_date"), F.max("max_date"))
    out = out.drop("max_date")
    out = zero_fill(out, ["n", "daily_prop"])
    out = fill_down(out, ["species"], ["dummy_date", "sfc_final_date"], [*CARRIED_COLUMNS, "spawn_year"])
    return out.select(
        "species", "dummy_date", "sfc_final_date", "spawn_year", "n", *SHARE_COLUMNS, "day_of_year"
    )


def progress_reference(complete: DataFrame) -> DataFrame:
    """OP14: per dummy day, spread of the cumulative and daily shares."""
    return complete.groupBy("dummy_date", "species").agg(
        F.median("daily_cumulative").alias("median_cum"),
        F.min("daily_cumulative").alias("min_cum"),
        F.max("daily_cumulative").alias("max_cum"),
        F.min("daily_prop").alias("min_dailyprop"),
        F.median("daily_prop").alias("median_dailyprop"),
        F.max("daily_prop").alias("max_daily_prop"),
    )


ALL_YEARS_COLUMNS = (
    "species", "spawn_year", "sfc_final_date", "n", "dummy_date", "sy_total", "cumulative_total",
    "daily_prop", "daily_cumulative", "day_of_year", "daily_cumulative_n",
)


def all_years(complete: DataFrame, current: DataFrame) -> DataFrame:
    """OP15: completed years (counts only) and the current year (all columns,
    missing ones NULL on the completed side), running count per year."""
    hist = complete.select("species", "spawn_year", "sfc_final_date", "n", "dummy_date")
    both = hist.unionByName(current, allowMissingColumns=True)
    w = running_window(["spawn_year", "species"], ["dummy_date", "sfc_final_date"])
    return both.withColumn("daily_cumulative_n", F.sum("n").over(w)).select(*ALL_YEARS_COLUMNS)


def run_stats(alldaily: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP16 (flagship): per dummy day and species, median/min/max percent of
    the run complete over the completed comparison years, half-even."""
    cur = X.current_spawn_year("species", cfg)
    d = alldaily.filter((F.col("spawn_year") > cfg.floor_year) & (F.col("spawn_year") < cur))
    d = group_total(d, ["spawn_year", "species"], "n", "total_n")
    d = d.withColumn("prop_complete", F.col("daily_cumulative_n").cast("double") / F.col("total_n").cast("double"))
    agg = d.groupBy("dummy_date", "species").agg(
        F.median("prop_complete").alias("_med"), F.min("prop_complete").alias("_min"), F.max("prop_complete").alias("_max")
    )
    return agg.select(
        "dummy_date", "species",
        X.half_even_percent("_med").alias("median_percentcomplete"),
        X.half_even_percent("_min").alias("min_percentcomplete"),
        X.half_even_percent("_max").alias("max_percentcomplete"),
    )
