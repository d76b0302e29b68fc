"""Joins of a large table to small dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, keys: str | Sequence[str], *columns: str, how: str = "left") -> DataFrame:
    """Join the named columns of a dimension.

    No broadcast is forced. Spark broadcasts a dimension whose size estimate is under the threshold; otherwise it
    shuffles, and AQE turns that into a broadcast once the real size is measured or splits a skewed key.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return fact.join(dim.select(*keys, *columns), keys, how)


def keep_matching(fact: DataFrame, dim: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in the dimension; never multiplies rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return fact.join(dim.select(*keys), keys, "left_semi")


def replace_unknown(df: DataFrame, column: str, vocabulary: DataFrame, marker: str) -> DataFrame:
    """Categories outside a one-column vocabulary become the marker."""
    known = vocabulary.select(F.col(column).alias("_known")).distinct()
    joined = df.join(known, F.col(column) == F.col("_known"), "left")
    return joined.withColumn(column, F.when(F.col("_known").isNotNull(), F.col(column)).otherwise(marker)).drop(
        "_known"
    )
