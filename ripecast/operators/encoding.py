"""Out-of-fold target encoding: wide categories become numbers without labels on the driver.

A category is replaced by the mean label of its training rows, drawn towards the overall mean by ``prior`` rows. A training
row takes the mean over the other folds only, so no row sees its own label; other rows take the mean over all training
rows. Sums per (category, fold) are combined map-side, and encodings are tables that are joined, so a category may have
millions of values. Missing values are a category of their own; unknown ones take the overall mean.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
PRIOR = 20.0
ALL = -1


def fold_of(*identity: str, folds: int = FOLDS) -> Column:
    """The fold of a row, from the columns that tell rows apart; equal rows share one."""
    return F.pmod(F.xxhash64(*identity), F.lit(folds)).cast("int")


def spelled(column: str | Column) -> Column:
    """A category as text, with a mark for a missing one that no value can have."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.when(text.isNull(), "").otherwise(F.concat(F.lit("="), text))


@dataclass(frozen=True)
class Encoding:
    """``table`` holds value, slot and encoded; ``means`` the fallback of each slot. Slot -1 is all training rows."""

    table: DataFrame
    means: dict[int, float]

    def encode(self, df: DataFrame, column: str | Column, out: str, slot: Column | None = None) -> DataFrame:
        """``df`` with ``out``; ``slot`` is the fold of training rows and -1 of others (all rows, where not given)."""
        slot = F.lit(ALL) if slot is None else slot
        known = self.table.select(F.col("value").alias("_value"), F.col("slot").alias("_slot"), F.col("encoded").alias("_encoded"))
        fallback = F.element_at(F.create_map(*[x for k, v in self.means.items() for x in (F.lit(k), F.lit(v))]), slot)
        joined = df.withColumns({"_of": spelled(column), "_at": slot, "_mean": fallback})
        joined = joined.join(known, (F.col("_of") == F.col("_value")) & (F.col("_at") == F.col("_slot")), "left")
        filled = joined.withColumn(out, F.coalesce("_encoded", "_mean"))
        return filled.drop("_of", "_at", "_mean", "_value", "_slot", "_encoded")


def fit(train: DataFrame, column: str, label: str, fold: str, folds: int = FOLDS, prior: float = PRIOR) -> Encoding:
    """The encoding of one column from training rows that carry their ``fold``."""
    # decimal sums do not depend on the order of the rows
    y = F.col(label).cast("decimal(28,9)")
    rows = train.where(y.isNotNull()).select(spelled(column).alias("value"), F.col(fold).alias("fold"), y.alias("y"))
    parts = rows.groupBy("value", "fold").agg(F.sum("y").alias("s"), F.count(F.lit(1)).alias("n"))
    by_fold = {r["fold"]: (float(r["s"]), r["n"]) for r in rows.groupBy("fold").agg(F.sum("y").alias("s"), F.count(F.lit(1)).alias("n")).collect()}
    s, n = (sum(v[k] for v in by_fold.values()) for k in (0, 1))
    means = {ALL: s / n if n else 0.0}
    for k in range(folds):
        own_s, own_n = by_fold.get(k, (0.0, 0))
        means[k] = (s - own_s) / (n - own_n) if n > own_n else 0.0
    # one row per value with its sums by fold; a value has at most ``folds`` of them
    folded = F.map_from_entries(F.collect_list(F.struct("fold", F.struct(F.col("s").cast("double").alias("s"), "n").alias("sums"))))
    values = parts.groupBy("value").agg(F.sum("s").cast("double").alias("s"), F.sum("n").alias("n"), folded.alias("own"))
    slots = values.select("*", F.explode(F.array(*[F.lit(k) for k in means])).alias("slot"))
    own = F.try_element_at("own", F.col("slot"))
    left_s, left_n = F.col("s") - F.coalesce(own["s"], F.lit(0.0)), F.col("n") - F.coalesce(own["n"], F.lit(0))
    mean = F.element_at(F.create_map(*[x for k, v in means.items() for x in (F.lit(k), F.lit(v))]), F.col("slot"))
    return Encoding(slots.select("value", "slot", ((left_s + prior * mean) / (left_n + prior)).alias("encoded")), means)
