"""Data-quality checks. Each check returns its failing rows; a report counts the failures of many.

The checks of a table, or of tables that hold the same rows, share one grouped pass: see ``shared_report``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_outside(column: str, low: float, high: float) -> Column:
    return ~F.col(column).between(low, high)


def is_unlisted(column: str, values: Sequence) -> Column:
    return ~F.col(column).isin(list(values))


def is_violated(expression: str | Column) -> Column:
    """The expression is not true: false or NULL."""
    condition = F.expr(expression) if isinstance(expression, str) else expression
    return ~F.coalesce(condition, F.lit(False))


def failing(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet a failure condition."""
    return df.where(condition)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return failing(df, is_missing(column))


def accepted_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return failing(df, is_outside(column, low, high))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return failing(df, is_unlisted(column, values))


def expression_is_true(df: DataFrame, expression: str | Column) -> DataFrame:
    return failing(df, is_violated(expression))


def no_negative(df: DataFrame, column: str = "unit_sales") -> DataFrame:
    return failing(df, F.col(column) < 0)


def duplicates(df: DataFrame, *columns: str, skip_null: bool = False) -> DataFrame:
    """Keys that occur more than once, with their count."""
    if skip_null:
        df = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def unique(df: DataFrame, column: str) -> DataFrame:
    """Repeated values of one column; NULLs are left to the not-null check."""
    return duplicates(df, column, skip_null=True)


def unique_combination(df: DataFrame, *columns: str) -> DataFrame:
    return duplicates(df, *columns)


@dataclass(frozen=True)
class RowCheck:
    column: str
    check: str
    condition: Column


@dataclass(frozen=True)
class KeyCheck:
    columns: tuple[str, ...]
    check: str = "unique"

    @property
    def column(self) -> str:
        return ",".join(self.columns)


Check = RowCheck | KeyCheck


def missing(*columns: str) -> list[Check]:
    return [RowCheck(c, "not_null", is_missing(c)) for c in columns]


def flag(check: RowCheck) -> Column:
    """1 where a row fails, else 0."""
    return F.coalesce(check.condition, F.lit(False)).cast("bigint")


def lines(counts: DataFrame, found: Sequence[tuple[str, Check, Column]]) -> DataFrame:
    """A one-row frame of counts to a row per check: table_name, column_name, check_name, failures."""
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(check.column).alias("column_name"),
            F.lit(check.check).alias("check_name"),
            F.coalesce(failures.cast("bigint"), F.lit(0).cast("bigint")).alias("failures"),
        )
        for table, check, failures in found
    ]
    return counts.select(F.inline(F.array(*rows)))


def repeated(check: KeyCheck, n: Column) -> Column:
    """Whether a key that stands ``n`` times fails; ``unique`` leaves NULLs to the not-null check."""
    known = [F.col(c).isNotNull() for c in check.columns] if check.check == "unique" else []
    return reduce(lambda a, b: a & b, known, n > 1)


def shared_report(df: DataFrame, checks: Mapping[str, Sequence[Check]]) -> DataFrame:
    """The checks of one table, or of several that hold the same rows, compiled into one grouped pass.

    The rows are grouped by the key of the first key check; each group carries its size and its row-check sums, which
    are combined map-side, and one aggregate over the groups finishes all checks. A condition that several tables share
    is evaluated once. Further keys take a pass each.
    """
    named = [(table, c) for table, many in checks.items() for c in many]
    rows = {(c.column, c.check): c for _, c in named if isinstance(c, RowCheck)}
    keys = {(c.columns, c.check): c for _, c in named if isinstance(c, KeyCheck)}
    place = {k: f"r{i}" for i, k in enumerate(rows)}
    sums = [F.sum(flag(c)).alias(place[k]) for k, c in rows.items()]
    first = next(iter(keys), None)
    if first is None:
        counts = df.agg(*sums)
    else:
        groups = df.groupBy(*first[0]).agg(F.count(F.lit(1)).alias("_n"), *sums)
        fails = F.count_if(repeated(keys[first], F.col("_n"))).alias("k")
        counts = groups.agg(fails, *[F.sum(p).alias(p) for p in place.values()])
    found = [(t, c, F.col(place[c.column, c.check])) for t, c in named if isinstance(c, RowCheck)]
    found += [(t, c, F.col("k")) for t, c in named if isinstance(c, KeyCheck) and (c.columns, c.check) == first]
    parts = [lines(counts, found)]
    for k, c in keys.items():
        if k != first:
            counts = df.groupBy(*c.columns).agg(F.count(F.lit(1)).alias("_n")).agg(F.count_if(repeated(c, F.col("_n"))).alias("k"))
            parts.append(lines(counts, [(t, c, F.col("k")) for t, other in named if other == c]))
    return reduce(DataFrame.unionByName, parts)


def table_report(name: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check of one table: table_name, column_name, check_name, failures."""
    return shared_report(df, {name: checks})


def report(tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence[Check]]) -> DataFrame:
    """All checks of all tables."""
    return reduce(DataFrame.unionByName, [table_report(t, tables[t], c) for t, c in checks.items()])
