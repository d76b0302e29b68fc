"""Series tails: all that a bounded-lookback window needs of the past, so that new rows are featured without reading it.

A tail holds the last ``lookback`` rows of every series, each with its position in the series, which makes the position
of the last row the number of rows so far. New rows stand behind the tail in one window, so their features are those of
a window over everything, and the tail is moved on from itself and the new rows. Its size depends on the number of
series and not on the length of their history.

A series that holds a large share of all rows is no special case for the tail: the rank filter is applied before the
shuffle, so a task passes on at most ``lookback`` rows of a series, and counts are combined map-side. The windows over
the new rows are those of :func:`series_columns`, which splits long series.

Defined results: NULL keys form a series of their own. Rows that share a date are ordered as in ``series_columns``. New
rows must be later than all rows of the tail; the caller sees to it. An empty tail is a start from nothing, and without
new rows the tail stays as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripecast.operators.series import MAX_SERIES_ROWS, WindowColumns, row_order, series_columns

NTH = "_nth"
_NEW = "_new"


def start_tail(rows: DataFrame, keys: Sequence[str], order: str, lookback: int, ties: Sequence[str] = ()) -> DataFrame:
    """The tail of a whole history: its columns and ``_nth``, the position of a row in its series."""
    return _last(rows.withColumn(NTH, F.lit(None).cast("long")), keys, order, lookback, ties)


def move_tail(
    tail: DataFrame, rows: DataFrame, keys: Sequence[str], order: str, lookback: int, ties: Sequence[str] = ()
) -> DataFrame:
    """The tail after ``rows``, which must come later than the tail's."""
    fresh = rows.withColumn(NTH, F.lit(None).cast("long"))
    return _last(tail.select(*fresh.columns).unionByName(fresh), keys, order, lookback, ties)


def _last(rows: DataFrame, keys: Sequence[str], order: str, lookback: int, ties: Sequence[str]) -> DataFrame:
    names = [c for c in rows.columns if c != NTH]
    latest_first = [c.desc() for c in row_order(names, keys, order, ties)]
    w = Window.partitionBy(*keys).orderBy(*latest_first)
    kept = rows.withColumn("_back", F.row_number().over(w)).where(F.col("_back") <= lookback)
    before = F.coalesce(F.max(NTH), F.lit(0))
    sizes = rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg((before + F.count_if(F.col(NTH).isNull())).alias("_rows"))
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return kept.drop(NTH).join(sizes, match).select(*names, (F.col("_rows") - F.col("_back") + 1).alias(NTH))


def columns_after(
    tail: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    lookback: int,
    columns: WindowColumns,
    *,
    min_history: int | None = None,
    ties: Sequence[str] = (),
    max_rows: int | None = MAX_SERIES_ROWS,
) -> DataFrame:
    """``series_columns`` of the rows behind the tail, as if the whole history stood before them.

    A series with more than ``lookback`` rows before has ``lookback`` of them in its tail, and ``min_history`` is at most
    that, so the rows that are kept are the same as well.
    """
    both = tail.select(*rows.columns, F.lit(False).alias(_NEW)).unionByName(rows.withColumn(_NEW, F.lit(True)))
    done = series_columns(both, keys, order, lookback, columns, min_history=min_history, ties=ties, max_rows=max_rows)
    return done.where(_NEW).drop(_NEW)
