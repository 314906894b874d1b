"""Spark-native run-timing analytics over tag-detection reports."""

from runtally.config import FIXTURE_CONFIG, RunConfig

__all__ = ["RunConfig", "FIXTURE_CONFIG"]
