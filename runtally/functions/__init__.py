"""Column-level expressions (all built-in Spark functions, no UDFs)."""

from runtally.functions.columns import *  # noqa: F401,F403
