"""Wires the feeds into every stage, lazily.

``RunTables`` holds the raw feeds of one run and exposes each stage as a
DataFrame property. Nothing executes until an action; a stage that feeds
several outputs appears as identical subtrees, which the planner's exchange
reuse computes once per query. Batch jobs that write several outputs cut
lineage by writing marts instead (``runtally.plans.jobs``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtally import config as C
from runtally.plans import canonical, completed, dashboard, live, progress
from runtally.sources import fixtures


@dataclass
class RunTables:
    spark: SparkSession
    cfg: C.RunConfig
    live_raw: DataFrame
    live_downstream_raw: DataFrame
    completed_raw: DataFrame
    completed_downstream_raw: DataFrame
    flow_daily: DataFrame

    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str, cfg: C.RunConfig = C.FIXTURE_CONFIG) -> "RunTables":
        ds = fixtures.downstream_feed(spark, sf_dir, cfg)
        return cls(
            spark=spark,
            cfg=cfg,
            live_raw=fixtures.detection_feed(spark, sf_dir, cfg, completed=False),
            live_downstream_raw=ds,
            completed_raw=fixtures.detection_feed(spark, sf_dir, cfg, completed=True),
            completed_downstream_raw=ds,
            flow_daily=fixtures.river_daily(spark, sf_dir),
        )

    # ------------------------------------------------------------- live
    @cached_property
    def detections(self) -> DataFrame:
        return canonical.canonical_detections(self.live_raw)

    @cached_property
    def current_detections(self) -> DataFrame:
        return canonical.current_year_detections(self.detections, self.cfg)

    @cached_property
    def downstream(self) -> DataFrame:
        return canonical.downstream_detections(self.live_downstream_raw, self.cfg.ampm)

    @cached_property
    def _shared_latest_times(self) -> DataFrame | None:
        """Both readings of the latest times, where both runs read one downstream report in different ways."""
        if self.cfg.ampm == "parse" or self.live_downstream_raw is not self.completed_downstream_raw:
            return None
        return canonical.latest_downstream_times(self.live_downstream_raw, self.cfg.ampm)

    @cached_property
    def downstream_latest_time(self) -> DataFrame:
        if self._shared_latest_times is not None:
            return self._shared_latest_times.select("pit_id", F.col("latest_as_read").alias("latest_downstream"))
        return canonical.latest_downstream_time(self.downstream)

    @cached_property
    def individuals(self) -> DataFrame:
        return live.individuals_live(self.current_detections, self.downstream_latest_time, self.cfg)

    @cached_property
    def daily(self) -> DataFrame:
        return live.daily_entries(self.individuals, self.cfg.entry_date_zone)

    @cached_property
    def flow(self) -> DataFrame:
        return live.flow_window(self.flow_daily, self.daily, self.cfg)

    # -------------------------------------------------------- completed
    @cached_property
    def completed_detections(self) -> DataFrame:
        return canonical.completed_detections(self.completed_raw)

    @cached_property
    def completed_downstream_latest_time(self) -> DataFrame:
        if self._shared_latest_times is not None:
            return self._shared_latest_times.select("pit_id", F.col("latest_parsed").alias("latest_downstream"))
        ds = canonical.downstream_detections(self.completed_downstream_raw, "parse")
        return canonical.latest_downstream_time(ds)

    @cached_property
    def completed_juveniles(self) -> DataFrame:
        return completed.migratory_juveniles_completed(
            self.completed_detections, self.completed_downstream_latest_time, self.cfg
        )

    @cached_property
    def completed_population(self) -> DataFrame:
        return completed.population_completed(self.completed_detections, self.completed_juveniles, self.cfg)

    @cached_property
    def completed_individuals(self) -> DataFrame:
        return completed.individuals_completed_single_pass(
            self.completed_detections, self.completed_downstream_latest_time, self.cfg
        )

    @cached_property
    def completed_individuals_literal(self) -> DataFrame:
        return completed.individuals_completed(self.completed_population, self.cfg)

    @cached_property
    def daily_completed(self) -> DataFrame:
        return completed.daily_completed(self.completed_individuals, self.cfg)  # always local days

    # --------------------------------------------------------- progress
    @cached_property
    def complete_daily(self) -> DataFrame:
        return progress.complete_daily(self.daily_completed, self.cfg)

    @cached_property
    def complete_current(self) -> DataFrame:
        return progress.complete_current(self.daily, self.cfg)

    @cached_property
    def alldaily(self) -> DataFrame:
        return progress.all_years(self.complete_daily, self.complete_current)

    @cached_property
    def run_stats(self) -> DataFrame:
        return progress.run_stats(self.alldaily, self.cfg)

    # -------------------------------------------------------- dashboard
    @cached_property
    def year_to_date(self) -> DataFrame:
        return dashboard.year_to_date(self.alldaily, self.cfg)
