"""Generic DataFrame -> DataFrame operators; key, order and measure column
names are arguments, so the domain pipelines are only compositions."""

from runtally.operators.densify import complete_dates, complete_dates_join, date_grid, zero_fill
from runtally.operators.ordered import first_by, first_by_where, last_by_where, top1_by_key
from runtally.operators.relational import (
    filter_member_or,
    median_min_max,
    pivot_values,
    union_all,
    with_scalar,
)
from runtally.operators.running import (
    fill_down,
    group_total,
    running_total,
    share_of_total,
)
from runtally.operators.segmented import fill_down_segmented, running_total_segmented
from runtally.operators.selection import exact_median

__all__ = [
    "complete_dates", "complete_dates_join", "date_grid", "exact_median", "fill_down", "fill_down_segmented", "first_by",
    "first_by_where", "filter_member_or", "group_total",
    "last_by_where", "median_min_max", "pivot_values", "running_total",
    "running_total_segmented", "share_of_total", "top1_by_key", "union_all", "with_scalar", "zero_fill",
]
