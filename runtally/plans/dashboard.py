"""Dashboard marts and per-species queries: OP18-OP29.

Each function is ``(tables..., cfg[, species]) -> DataFrame``; a caller's
species predicate is a plain filter, so on a mart partitioned by species it
becomes partition pruning at the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql import types as T

from runtally import config as C
from runtally.functions import columns as X
from runtally.operators.ordered import top1_by_key


def today_doy(cfg: C.RunConfig) -> int:
    return cfg.as_of.timetuple().tm_yday


def current_year_key(spark: SparkSession, cfg: C.RunConfig) -> DataFrame:
    """OP29: species, current spawn year, today's day of year and today's
    dummy date (no ``doy - 1`` shift, as the dashboard's key table does)."""
    doy = today_doy(cfg)
    schema = T.StructType([
        T.StructField("species", T.StringType(), False),
        T.StructField("current_sy", T.IntegerType(), True),
        T.StructField("today_jday", T.IntegerType(), False),
    ])
    rows = [(s, cfg.current_spawn_year(s), doy) for s in cfg.species]
    key = spark.createDataFrame(rows, schema)
    return key.withColumn("today_dummy", _today_dummy_key(F.col("species"), doy))


def _today_dummy_key(species: F.Column, doy: int) -> F.Column:
    first_half = (species == C.MIDYEAR_SPECIES) & F.lit(doy < C.MIDYEAR_DOY)
    return F.when(first_half, F.date_add(F.make_date(F.lit(C.DUMMY_NEXT_YEAR), F.lit(1), F.lit(1)), doy)).otherwise(
        F.date_add(F.make_date(F.lit(C.DUMMY_YEAR), F.lit(1), F.lit(1)), doy)
    )


def status_dummy_date(cfg: C.RunConfig, species: F.Column | None = None) -> F.Column:
    """Today's dummy date for the run-status lookup.

    "reference": 1976 calendar with ``doy - 1`` for every species;
    "aligned": the species' own dummy calendar (needs ``species``)."""
    if cfg.status_date_mode == "aligned" and species is not None:
        return X.dummy_date(F.lit(cfg.as_of), species, cfg.dummy_offset_fix)
    return F.date_add(F.make_date(F.lit(C.DUMMY_YEAR), F.lit(1), F.lit(1)), today_doy(cfg) - 1)


def latest_discharge(flow: DataFrame) -> DataFrame:
    """OP18: the most recent river-value row (ties -> earliest in order).
    A top-1 report: TakeOrderedAndProject keeps one row per task."""
    return flow.orderBy(F.col("date").desc_nulls_last()).limit(1)


def year_to_date(alldaily: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP19: comparison years tagged Current/Previous; the current year is
    cut at today's dummy date. The key is a literal CASE per species."""
    doy = today_doy(cfg)
    d = alldaily.filter(F.col("spawn_year") > cfg.floor_year).withColumns({
        "current_sy": X.current_spawn_year("species", cfg),
        "today_jday": F.when(F.col("species").isin(list(cfg.species)), F.lit(doy)),
    })
    d = d.withColumn(
        "today_dummy", F.when(F.col("species").isin(list(cfg.species)), _today_dummy_key(F.col("species"), doy))
    )
    d = d.withColumns({
        "yr_category": F.when(F.col("spawn_year") == F.col("current_sy"), F.lit("Current")).when(
            F.col("spawn_year") != F.col("current_sy"), F.lit("Previous")
        ),
        "dummy_jday": F.dayofyear("dummy_date"),
    })
    return d.filter((F.col("yr_category") == "Previous") | (F.col("dummy_date") <= F.col("today_dummy")))


def earliest_entry(ytd: DataFrame) -> DataFrame:
    """OP20: first entry day per species and spawn year."""
    return ytd.groupBy("species", "spawn_year").agg(F.min("sfc_final_date").alias("earliest"))


def run_end_date(stats: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP21: per species the first dummy day on which every comparison year
    was 100 % complete, projected onto the as-of year's calendar."""
    done = stats.filter(F.col("min_percentcomplete") == 100)
    first = top1_by_key(done, ["species"], "dummy_date", "dummy_date", descending=False)
    return first.withColumn("current_max", X.project_on_year("dummy_date", cfg.as_of.year)).select(
        "dummy_date", "species", "median_percentcomplete", "min_percentcomplete", "max_percentcomplete", "current_max"
    )


def run_status_today(stats: DataFrame, cfg: C.RunConfig) -> DataFrame:
    """OP22: today's row per species with the two display texts."""
    today = stats.filter(F.col("dummy_date") == status_dummy_date(cfg, F.col("species")))
    return today.withColumns({
        "median_text": X.concat_strict(X.number_text("median_percentcomplete"), " %"),
        "range_text": X.concat_strict(
            "Range: ", X.number_text("min_percentcomplete"), " % - ", X.number_text("max_percentcomplete"), " %"
        ),
    })


def length_frequency(ind: DataFrame) -> DataFrame:
    """OP23: adult length frequency in half-inch bins with species mean and N.

    One aggregate reads the fish: count and sum per species and bin. The species
    totals are sums over its bins, a few rows whatever the number of fish.
    """
    adults = ind.filter((F.col("release_lifestage") == "Adult") & F.col("length_mm").isNotNull())
    bins = adults.groupBy("species", X.inch_bin("length_mm", 0.5).alias("length_bin_in")).agg(
        F.count(F.lit(1)).alias("freq"), F.sum("length_mm").alias("_sum"))
    of_species = Window.partitionBy("species")  # one row per bin
    bins = bins.withColumn("total_sample", F.sum("freq").over(of_species))
    bins = bins.withColumn("mean_length", F.sum("_sum").over(of_species) / F.col("total_sample"))
    return bins.filter(F.col("species").isNotNull()).select(
        "species", "length_bin_in", "freq", "total_sample", "mean_length",
        (F.col("mean_length") / C.MM_PER_INCH).alias("mean_length_in"),
    )


def unique_fish(ind: DataFrame) -> DataFrame:
    """OP24: number of fish per species (callers filter the species)."""
    return ind.groupBy("species").agg(F.count(F.lit(1)).alias("n_fish"))


def new_last_week(ind: DataFrame, cfg: C.RunConfig, entry_date_zone: str | None = None) -> DataFrame:
    """OP25: fish whose entry day is within 7 days before the as-of date."""
    day = X.entry_date("sfc_entry_final", entry_date_zone)
    recent = ind.filter(day >= F.date_sub(F.lit(cfg.as_of), 7))
    return recent.groupBy("species").agg(F.count(F.lit(1)).alias("n_new"))


def species_daily(daily: DataFrame, species: str) -> DataFrame:
    """OP26: daily entries of one species."""
    return daily.filter(F.col("species") == species)


def species_cumulative(ytd: DataFrame, cfg: C.RunConfig, species: str) -> DataFrame:
    """OP27: one species' year-to-date series up to its current year."""
    cur = cfg.current_spawn_year(species)
    d = ytd.filter(F.col("species") == species)
    if cur is None:
        return d.filter(F.lit(False))
    return d.filter((F.col("spawn_year") < cur) | (F.col("spawn_year") == cur))


def first_entry_date(ind: DataFrame, entry_date_zone: str | None = None) -> DataFrame:
    """OP28: earliest entry day over all fish (slider lower bound)."""
    return ind.agg(F.min(X.entry_date("sfc_entry_final", entry_date_zone)).alias("slider_min"))


def cumulative_labels(ytd: DataFrame) -> DataFrame:
    """Display text of the year-to-date cumulative series (one per point)."""
    text = X.concat_strict(
        " Date: ", X.month_day("dummy_date"), " <br> Spawn Year: ", F.col("spawn_year").cast("string"),
        " <br> Number In: ", F.bround("daily_cumulative_n", 0).cast("bigint").cast("string"),
    )
    return ytd.select("species", "spawn_year", "dummy_date", text.alias("label"))


def daily_entry_labels(daily: DataFrame) -> DataFrame:
    """Display text of the daily entry counts."""
    text = X.concat_strict(
        " Date: ", F.col("sfc_final_date").cast("string"), " <br> Number Fish Entered: ", F.col("n").cast("string")
    )
    return daily.select("species", "spawn_year", "sfc_final_date", text.alias("label"))


def length_frequency_labels(lf: DataFrame) -> DataFrame:
    """Display text of the length-frequency bars."""
    text = X.concat_strict("Length Bin: ", X.number_text("length_bin_in"), "<br>Number: ", F.col("freq").cast("string"))
    return lf.select("species", "length_bin_in", text.alias("label"))


def flow_labels(flow: DataFrame) -> DataFrame:
    """Text of each river point; the value follows two spaces, as its separator adds one."""
    value = F.regexp_replace(F.col("mean_discharge").cast("double").cast("string"), r"\.0$", "")
    return flow.select("date", F.concat(
        F.lit(" Date: "), F.col("date").cast("string"), F.lit(" <br> Mean Discharge (cfs):  "), value).alias("label"))
