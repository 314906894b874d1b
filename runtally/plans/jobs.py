"""Batch jobs: the scheduled live run and the completed-years run.

Each job reads landed feeds, writes its marts, and reads every mart it
reuses back from storage, so no downstream step recomputes the detection
work and a lost executor only costs re-reading a mart. The completed-years
job writes ``daily_completed``; the live job reads it.

The live job parses its report once, into a ``detections`` mart with a partition a year of
observation: a run replaces the years its report holds and reads back the current
ones only. The fish-level marts (``current_detections``, ``downstream_latest``) are
bucketed by fish, so the per-fish aggregate and the join with the downstream times
need no exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from runtally import config as C
from runtally.plans import canonical, completed, dashboard, live, progress
from runtally.sources import feeds as reports
from runtally.sources import marts, river


@dataclass
class LiveFeeds:
    detections: DataFrame          # raw live detection report (feeds.read_report)
    downstream: DataFrame          # raw downstream reports, unioned
    river: DataFrame               # daily river values: date, mean_temp, mean_discharge


@dataclass
class CompletedFeeds:
    detections: DataFrame
    downstream: DataFrame


@dataclass
class LandedReports:
    """Where one run's inputs lie: files, folders or globs, in report order."""

    detections: Sequence[str]
    downstream: Sequence[str]
    river: str | None = None
    river_site: str | None = None  # gauge of a long river file that holds several
    river_is_wide: bool = False
    encoding: str | None = None
    line_sep: str | None = None


def live_feeds(spark: SparkSession, at: LandedReports, cfg: C.RunConfig) -> LiveFeeds:
    """The live run's feeds from landed files; river values from the start of the history to the as-of date."""
    how = {"encoding": at.encoding, "line_sep": at.line_sep}
    if at.river_is_wide:
        values = river.read_wide(spark, at.river, cfg.as_of)
    else:
        values = river.read_long(spark, at.river, at.river_site, cfg.as_of)
    return LiveFeeds(reports.read_report(spark, at.detections, "live_detections", **how),
                     reports.read_report(spark, at.downstream, "live_downstream", **how), values)


def completed_feeds(spark: SparkSession, at: LandedReports) -> CompletedFeeds:
    how = {"encoding": at.encoding, "line_sep": at.line_sep}
    return CompletedFeeds(reports.read_report(spark, at.detections, "completed_detections", **how),
                          reports.read_report(spark, at.downstream, "completed_downstream", **how))


def completed_years_job(feeds: CompletedFeeds, out_root: str, cfg: C.RunConfig) -> str:
    """Completed run years -> ``daily_completed`` mart."""
    det = canonical.completed_detections(feeds.detections)
    ds = canonical.latest_downstream_time(canonical.downstream_detections(feeds.downstream, "parse"))
    ind = completed.individuals_completed_single_pass(det, ds, cfg)
    daily = completed.daily_completed(ind, cfg)  # always local days
    return marts.write_mart(daily, out_root, "daily_completed")


def land_detections(feeds: LiveFeeds, out_root: str) -> str:
    """The report's detections into the mart by year: years that the report holds are replaced, others stay."""
    return marts.write_years(canonical.canonical_detections(feeds.detections, "parse"), out_root, "detections", "observation_year")


def fish_level(spark: SparkSession, feeds: LiveFeeds, out_root: str, cfg: C.RunConfig) -> tuple[DataFrame, DataFrame]:
    """(current-year detections, latest downstream time per fish), as marts bucketed by fish."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    det = canonical.current_year_detections(marts.read_mart(spark, out_root, "detections"), cfg)
    marts.write_by_key(det, out_root, "current_detections", "pit_id", n)
    ds = canonical.latest_downstream_time(canonical.downstream_detections(feeds.downstream, cfg.ampm))
    marts.write_by_key(ds, out_root, "downstream_latest", "pit_id", n)
    return marts.read_mart(spark, out_root, "current_detections"), marts.read_mart(spark, out_root, "downstream_latest")


def live_job(spark: SparkSession, feeds: LiveFeeds, out_root: str, cfg: C.RunConfig) -> dict[str, str]:
    """Current run year: individuals, daily, flow window, all years, run
    statistics, over the detection marts. Needs the ``daily_completed`` mart under
    ``out_root``; returns the datasets that the dashboard reads."""
    written: dict[str, str] = {}
    land_detections(feeds, out_root)
    det, ds = fish_level(spark, feeds, out_root, cfg)
    written["individuals"] = marts.write_mart(live.individuals_live(det, ds, cfg), out_root, "individuals")
    ind = marts.read_mart(spark, out_root, "individuals")

    written["daily"] = marts.write_mart(live.daily_entries(ind, cfg.entry_date_zone), out_root, "daily")
    daily = marts.read_mart(spark, out_root, "daily")
    written["sfc_flow"] = marts.write_mart(live.flow_window(feeds.river, daily, cfg), out_root, "sfc_flow")

    daily_completed = marts.read_mart(spark, out_root, "daily_completed")
    alld = progress.all_years(progress.complete_daily(daily_completed, cfg), progress.complete_current(daily, cfg))
    written["alldaily"] = marts.write_mart(alld, out_root, "alldaily")
    alld = marts.read_mart(spark, out_root, "alldaily")
    written["run_stats"] = marts.write_mart(progress.run_stats(alld, cfg), out_root, "run_stats")
    return written


@dataclass
class DashboardMarts:
    """Load-time marts of the dashboard, computed from the stored datasets."""

    flow: DataFrame
    latest_discharge: DataFrame
    daily: DataFrame
    individuals: DataFrame
    year_to_date: DataFrame
    run_stats: DataFrame
    earliest_entry: DataFrame
    run_end_date: DataFrame
    run_status_today: DataFrame
    length_frequency: DataFrame
    new_last_week: DataFrame
    first_entry_date: DataFrame
    unique_fish: DataFrame


def dashboard_marts(spark: SparkSession, root: str, cfg: C.RunConfig) -> DashboardMarts:
    flow = marts.read_mart(spark, root, "sfc_flow")
    ind = marts.read_mart(spark, root, "individuals")
    stats = marts.read_mart(spark, root, "run_stats")
    ytd = dashboard.year_to_date(marts.read_mart(spark, root, "alldaily"), cfg)
    return DashboardMarts(
        flow=flow,
        latest_discharge=dashboard.latest_discharge(flow),
        daily=marts.read_mart(spark, root, "daily"),
        individuals=ind,
        year_to_date=ytd,
        run_stats=stats,
        earliest_entry=dashboard.earliest_entry(ytd),
        run_end_date=dashboard.run_end_date(stats, cfg),
        run_status_today=dashboard.run_status_today(stats, cfg),
        length_frequency=dashboard.length_frequency(ind),
        new_last_week=dashboard.new_last_week(ind, cfg, cfg.entry_date_zone),
        first_entry_date=dashboard.first_entry_date(ind, cfg.entry_date_zone),
        unique_fish=dashboard.unique_fish(ind),
    )
