"""Mixing sources to target weights.

Every row gets a key from a hash of its id and a seed. Keys are uniform, so equal slices of the key space are ranges of
nearly equal size in every source: rows are sorted within (source, slice), slice totals are summed along each source,
and both together are the running word count of the source in key order. No task ever holds a source. A source whose
target exceeds its size is taken whole for each full epoch; the rest of the target is cut from the front of the order.

Defined results: a null text has size 0; a null source is a source of its own, ordered last; a null id hashes as the
empty string; rows with equal ids tie in the order and are told apart by size (equal rows are interchangeable); an
empty table gives an empty mix. A document is taken whole or not at all in an epoch: the one on the budget is taken
when more than half of it lies inside, so a source misses its target by at most half a document. A single document
that is larger than twice the rest of the budget may thus be left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripecast.llm.common import WORD, as_text, fresh

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
MAX_EPOCHS = 2
SLICES = 1024
SEED = "mix-1"


def size_of(text: str) -> Column:
    return F.regexp_count(as_text(text), F.lit(WORD)).cast("long")


def order_key(doc_id: str, seed: str) -> Column:
    """A 60-bit number from md5, the same in every engine."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target: one row per source of (source, source_size).

    Sources by code point, null last, take the weights in turn. All share ``share_percent`` of all words by weight; a
    target above ``max_epochs`` times its source stops there and the excess goes to the others by weight. That water
    level is found without iteration: with sources ordered by cap per weight, the level after k full sources is what is
    left over the weights left, and the first source that lies below its cap at that level fixes it. The number of rows
    is the number of sources.
    """
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (rank % len(weights) + 1).cast("int"))
    s = sizes.select("source", "source_size", weight.alias("w"), (F.col("source_size") * max_epochs * 100).alias("cap"))
    s = s.select("*", (F.sum("source_size").over(whole) * share_percent).alias("budget"))
    s = s.withColumn("budget", F.least(F.col("budget"), F.sum("cap").over(whole)))
    full_first = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = full_first.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select(
        "*",
        (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        F.sum("w").over(full_first.rowsBetween(0, Window.unboundedFollowing)).alias("w_left"),
    )
    open_ = F.col("left") * F.col("w") < F.col("cap") * F.col("w_left")
    level = F.min(F.when(open_, F.struct(F.col("cap") / F.col("w"), F.col("left"), F.col("w_left")))).over(whole)
    s = s.select("*", level["left"].alias("l_left"), level["w_left"].alias("l_w"))
    capped = F.col("l_w").isNull() | (F.col("l_left") * F.col("w") >= F.col("cap") * F.col("l_w"))
    target = F.when(capped, F.col("cap").cast("double") / 100.0).otherwise(
        (F.col("l_left") * F.col("w")).cast("double") / (F.col("l_w") * 100).cast("double")
    )
    return s.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED, slices: int = SLICES, **shares) -> DataFrame:
    """The input rows with size, source_size, target, epochs (times the document is taken) and taken (words).

    Added columns get a free name where the input has one of these already; ``mixed_names`` tells them.
    """
    out = mixed_names(docs.columns)
    n = lambda base: fresh([*docs.columns, *out.values()], base)
    key, cell, tie, run, before = n("key_"), n("slice_"), n("source_key_"), n("run_"), n("before_")
    tie_null = n("source_null_")
    base = docs.select(
        "*",
        size_of(text).alias(out["size"]),
        order_key(doc_id, seed).alias(key),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias(tie),
        F.col(source).isNull().alias(tie_null),
    ).withColumn(cell, F.floor(F.col(key) / ((1 << 60) // slices)).cast("int"))
    cells = base.groupBy(tie, tie_null, cell).agg(F.sum(out["size"]).alias("cell_size"))
    along = Window.partitionBy(tie, tie_null).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn(before, F.coalesce(F.sum("cell_size").over(along), F.lit(0)))
    of_source = cells.groupBy(tie, tie_null).agg(F.sum("cell_size").alias("source_size"))
    goal = targets(of_source.select(F.when(~F.col(tie_null), F.col(tie)).alias("source"), "source_size"), **shares)
    goal = goal.select(F.coalesce("source", F.lit("")).alias(tie), F.col("source").isNull().alias(tie_null), F.col("source_size").alias(out["source_size"]), F.col("target").alias(out["target"]))
    cells = cells.join(goal, [tie, tie_null]).select(tie, tie_null, cell, before, out["source_size"], out["target"])

    sorted_rows = Window.partitionBy(tie, tie_null, cell).orderBy(key, F.col(doc_id), F.col(out["size"]))
    placed = base.withColumn(run, F.coalesce(F.sum(out["size"]).over(sorted_rows.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = placed.join(cells, [tie, tie_null, cell])
    size, total = F.col(out["size"]), F.col(out["source_size"])
    whole = F.when(total > 0, F.floor(F.col(out["target"]) / total)).otherwise(F.lit(0))
    rest = F.col(out["target"]) - whole * total
    extra = (2 * (F.col(before) + F.col(run)) + size < 2 * rest).cast("long")
    placed = placed.withColumn(out["epochs"], whole.cast("long") + extra)
    placed = placed.withColumn(out["taken"], F.col(out["epochs"]) * size)
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], *out.values())


def mixed_names(columns) -> dict[str, str]:
    found: dict[str, str] = {}
    for base in ("size", "source_size", "target", "epochs", "taken"):
        found[base] = fresh([*columns, *found.values()], base)
    return found


def take(mixed: DataFrame, columns, epochs: str) -> DataFrame:
    """The rows of the mix with their input columns: each row as often as it is taken."""
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col(epochs)))
    return mixed.where(F.col(epochs) > 0).select(*[F.col(f"`{c}`") for c in columns], copies.alias(fresh(columns, "copy_"))).select(*[F.col(f"`{c}`") for c in columns])
