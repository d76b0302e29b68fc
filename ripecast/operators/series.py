"""Bounded-lookback windows over a panel of series, safe for a series that holds a large share of all rows.

A window needs each of its partitions in one task. On a unique (series, date) grain a series has at most one row per
calendar day, which is a proven bound, and one window does the job: one exchange, one sort. Where the grain is not
proven, :func:`series_columns` counts the series first (two columns, combined map-side) and splits any that exceeds
``max_rows`` into numbered chunks. Every chunk carries the last ``lookback`` rows of the one before it, so the result
is the same and no task holds more than about ``max_rows`` rows of a series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

MAX_SERIES_ROWS = 1_000_000
HOT_BROADCAST_ROWS = 100_000
BLOCKS_PER_DATE = 256
EXPAND_STEP = 100_000

WindowColumns = Callable[[WindowSpec], dict[str, Column]]


def row_order(names: Sequence[str], keys: Sequence[str], order: str, ties: Sequence[str] = ()) -> list[Column]:
    """One total order of the rows of a series, whichever way they are split: rows that agree in all of it are equal."""
    rest = [c for c in names if c not in (*keys, order, *ties)]
    return [F.col(order), _spread(ties), *[F.col(c) for c in (*ties, *rest)]]


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def series_columns(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    lookback: int,
    columns: WindowColumns,
    *,
    min_history: int | None = None,
    ties: Sequence[str] = (),
    max_rows: int | None = MAX_SERIES_ROWS,
) -> DataFrame:
    """Add window columns per series, and keep only rows with more than ``min_history`` rows up to and including them.

    ``columns`` maps a window to named expressions; none may look back more than ``lookback`` rows or look ahead.
    ``ties`` tells rows of a series that share a date apart; such rows are ordered by the hash of ``ties``, then by
    ``ties``. ``max_rows=None`` states that the caller's grain is unique, which bounds every series.
    """
    if min_history is not None and min_history > lookback:
        raise ValueError("min_history must not exceed lookback")
    if max_rows is None:
        return _plain(df, keys, columns, min_history, [order])

    by = row_order(df.columns, keys, order, ties)
    hot = _hot_series(df, keys, max_rows)
    n_hot = hot.count()
    if n_hot == 0:
        return _plain(df, keys, columns, min_history, by)

    # one small row per hot series; broadcast only after its size is known, else left to AQE
    names = [f"_hot_{k}" for k in keys]
    hot = hot.toDF(*names)
    if n_hot <= HOT_BROADCAST_ROWS:
        hot = F.broadcast(hot)
    match = _same(df, hot, list(zip(keys, names)))
    cold_rows = df.join(hot, match, "left_anti")
    hot_rows = df.join(hot, match, "left_semi")
    return _plain(cold_rows, keys, columns, min_history, by).unionByName(
        _chunked(hot_rows, keys, order, lookback, columns, min_history, ties, max_rows)
    )


def _hot_series(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > max_rows).select(*keys)


def _spread(ties: Sequence[str]) -> Column:
    """Block number that spreads the rows of one date over many small groups."""
    return F.pmod(F.xxhash64(*ties), F.lit(BLOCKS_PER_DATE)) if ties else F.lit(0)


def _plain(
    df: DataFrame,
    keys: Sequence[str],
    columns: WindowColumns,
    min_history: int | None,
    by: Sequence[str | Column],
) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*by)
    added = columns(w)
    # an exchange of its own: below may lie a join layout by item only, which would put an item's stores into one task
    dealt = df.repartition(*[F.col(k) for k in keys])
    if min_history is None:
        return dealt.withColumns(added)
    numbered = dealt.withColumns({**added, "_row": F.row_number().over(w)})
    return numbered.where(F.col("_row") > min_history).drop("_row")


def _chunked(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    lookback: int,
    columns: WindowColumns,
    min_history: int | None,
    ties: Sequence[str],
    max_rows: int,
) -> DataFrame:
    """The same windows over numbered chunks of each series."""
    base = df.columns
    rest = [*ties, *[c for c in base if c not in keys and c != order and c not in ties]]

    # Exact copies collapse map-side. The first `lookback` copies can see different rows before them; every later copy
    # sees only copies, so one row stands for all of those and is expanded again at the end.
    copies = df.groupBy(*base).agg(F.count(F.lit(1)).alias("_copies"))
    kept = F.least(F.col("_copies"), F.lit(lookback + 1))

    # Number the rows without sorting a series in one task: count per block of (series, date, hash), add up the
    # counts of earlier blocks, then number within a block.
    copies = copies.withColumn("_block", _spread(ties))
    block = [*keys, order, "_block"]
    sizes = copies.groupBy(*block).agg(F.sum(kept).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy(order, "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(c).alias(f"_s_{c}") for c in block],
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"),
    )
    rows = copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), kept)))
    within = Window.partitionBy(*block).orderBy(*[F.col(c) for c in rest], "_copy")
    numbered = (
        rows.withColumn("_nth", F.row_number().over(within))
        .alias("r")
        .join(
            starts.alias("s"),
            reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"s._s_{c}")) for c in block]),
        )
        .select(
            *[F.col(f"r.{c}") for c in base],
            F.when(F.col("_copy") > lookback, F.col("_copies") - lookback).otherwise(1).alias("_weight"),
            (F.col("_start") + F.col("_nth") - 1).alias("_pos"),
        )
    )

    size = max(max_rows, lookback, 1)
    chunk = F.floor(F.col("_pos") / size)
    is_tail = F.col("_pos") % size >= size - lookback
    spread = numbered.withColumn("_home", chunk).withColumn(
        "_chunk",
        F.explode(F.when(is_tail, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))),
    )
    w = Window.partitionBy(*keys, "_chunk").orderBy("_pos")
    out = spread.withColumns(columns(w)).where(F.col("_chunk") == F.col("_home"))
    if min_history is not None:
        out = out.where(F.col("_pos") >= min_history)

    # two steps, so that no single array grows with the number of copies
    step = F.lit(EXPAND_STEP)
    out = out.withColumn("_step", F.explode(F.sequence(F.lit(0), F.floor((F.col("_weight") - 1) / step))))
    left = F.col("_weight") - F.col("_step") * step
    out = out.withColumn("_one", F.explode(F.sequence(F.lit(1), F.least(left, step))))
    return out.drop("_weight", "_pos", "_home", "_chunk", "_step", "_one")
