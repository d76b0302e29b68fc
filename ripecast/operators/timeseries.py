"""Daily calendar series: spine, forward fill, moving averages and relative changes.

Every function works on one row per (group, day), so a window holds at most the days of the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def by_day(partition_by: Sequence[str] = ()) -> WindowSpec:
    """Order by date. Without a group this is one task over one row per calendar day."""
    return Window.partitionBy(*partition_by).orderBy("date")


def one_row_per_day(df: DataFrame, value: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Average several quotes of a day, so that a repeated day can neither multiply rows nor grow a window."""
    return df.groupBy(*partition_by, "date").agg(F.avg(value).alias(value))


def daily_spine(bounds: DataFrame, start: str, end: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """All days from ``start`` to ``end``, both included; nothing when either is NULL or they are reversed."""
    return bounds.where(F.col(start) <= F.col(end)).select(
        *partition_by, F.explode(F.sequence(F.col(start), F.col(end))).alias("date")
    )


def forward_fill(value: str, w: WindowSpec) -> Column:
    return F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def trailing_mean(value: str, w: WindowSpec, rows: int, *, include_current: bool) -> Column:
    """Mean of the last ``rows`` rows; a shorter history gives the mean of what there is."""
    return F.avg(value).over(w.rowsBetween(-(rows - 1), 0) if include_current else w.rowsBetween(-rows, -1))


def pct_change(value: str, w: WindowSpec, rows: int) -> Column:
    before = F.lag(value, rows).over(w)
    return F.try_divide(F.col(value) - before, before)
