"""Quality rules as a ledger: every rule is evaluated once, policies are bit masks over what was stored.

``ledger`` measures each text once and keeps the measurements and one bit per failed rule. A policy names rules and has
a version; ``apply_policy`` is a bitwise AND, so a new policy needs no second look at a text. ``ablation`` counts
documents per bit pattern (at most one row per pattern, whatever the corpus size) and derives from these counts what
each rule removes alone, and what would stay without it.

Defined results: a null or empty text has no words (all measurements 0) and fails ``few_words``; equal rows get equal
ledger rows; a null in the key stays null; other columns of the input are not read, so their names cannot clash; an
empty table gives an empty ledger. Texts of any length are measured whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripecast.llm import spans
from ripecast.llm.common import as_text, fresh, text_last

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_letters",
    "n_capitals",
)
WINDOW = 5

# The rules in bit order, each with its failure condition over the measurements.
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "repeated_lines": "100 * n_dup_lines > 40 * n_lines",
    "capitals": "100 * n_capitals > 50 * n_letters",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
}
BITS = {name: 1 << k for k, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules; a document stays when it fails none of them."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeated_windows"))
STRICT = Policy("training", 2, tuple(RULES))


def _flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL = _flags(b"#*$%&|<>")
_CAPITAL = _flags(bytes(range(65, 91)))
_LETTER = _flags(bytes([*range(65, 91), *range(97, 123)]))
_FOLLOWS = _flags(bytes(range(0x80, 0xC0)))


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def _measure(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    texts = len(offsets) - 1
    solid = ~spans._SPACE[data]
    starts, ends, first = spans.words(data, offsets)
    hasher = spans.Hasher(data)
    windows, at = spans.shingles(hasher.of(starts, ends), first, WINDOW)
    text_of_word = np.repeat(np.arange(texts), np.diff(first))
    order, opens = spans.grouped(spans.mix(windows + text_of_word[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    alone = opens & np.append(opens[1:], True)
    covered = np.zeros(len(starts) + 1, np.int64)
    hit = at[order[~alone]]
    np.add.at(covered, hit, 1)
    np.add.at(covered, hit + WINDOW, -1)
    repeat = np.bincount(text_of_word[np.cumsum(covered[:-1]) > 0], minlength=texts)

    breaks = np.flatnonzero(data == 10)
    text_ends = offsets[1:]
    line_ends = np.sort(np.concatenate([breaks, text_ends]), kind="stable")
    text_of_line = np.repeat(np.arange(texts), _per_text(data == 10, offsets) + 1)
    is_first = np.ones(len(line_ends), bool)
    is_first[1:] = text_of_line[1:] != text_of_line[:-1]
    line_starts = np.where(is_first, offsets[text_of_line], np.append(0, line_ends[:-1]) + 1)
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(solid, out=filled[1:])
    with_word = filled[line_ends] > filled[line_starts]
    line_text = text_of_line[with_word]
    line_hash = hasher.of(line_starts[with_word], line_ends[with_word])
    order, opens = spans.grouped(spans.mix(line_hash + line_text.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
    dup = np.bincount(line_text[order[~opens]], minlength=texts)
    return [
        np.diff(first),
        _per_text(solid & ~_FOLLOWS[data], offsets),
        _per_text(_SYMBOL[data], offsets),
        dup,
        repeat,
        np.bincount(line_text, minlength=texts),
        _per_text(_LETTER[data], offsets),
        _per_text(_CAPITAL[data], offsets),
    ]


def _task(kept: int):
    """The measures of the last column; the first ``kept`` columns are given back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in spans.slices(batch.column(batch.num_columns - 1)):
                columns = [batch.column(i).slice(row, end - row) for i in range(kept)]
                found = [pa.array(x.astype(np.int64)) for x in _measure(data, offsets)]
                yield pa.RecordBatch.from_arrays([*columns, *found], names=[*batch.schema.names[:kept], *MEASURES])

    return run


def failure_bits() -> Column:
    return sum((F.when(F.expr(rule), F.lit(BITS[name]).cast("long")).otherwise(F.lit(0).cast("long")) for name, rule in RULES.items()), F.lit(0).cast("long"))


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, MEASURES, fail_bits: one row per input row, in one narrow pass."""
    slim = docs.select(F.col(key), as_text(text).alias(fresh([key], "text_")))
    kind = docs.schema[key].dataType.simpleString()
    schema = ", ".join([f"`{key}` {kind}", *(f"{m} bigint" for m in MEASURES)])
    return slim.mapInArrow(_task(1), schema).withColumn("fail_bits", failure_bits())


def fails(policy: Policy, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policy(entries: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept``, ``policy`` and ``policy_version``."""
    return entries.select("*", (~fails(policy)).alias("kept"), F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("policy_version"))


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """rule, n_fail, n_fail_only, n_kept, n_kept_without: what each rule of a policy does.

    Counts per bit pattern first; everything else is a sum over those few rows.
    """
    masked = F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    patterns = entries.groupBy(masked.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit")) for r in policy.rules]))
    each = patterns.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", "r.bit")
    hit, kept = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits") == 0
    only = F.col("bits") == F.col("bit")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return each.groupBy("rule").agg(
        count(hit).alias("n_fail"),
        count(only).alias("n_fail_only"),
        count(kept).alias("n_kept"),
        count(kept | only).alias("n_kept_without"),
    )


def filter_documents(docs: DataFrame, policy: Policy = STRICT, text: str = "text") -> DataFrame:
    """The input rows that fail no rule of the policy, with their columns as they were.

    Narrow: every row carries its own columns through the measuring task, so no join by key is needed and rows with
    equal or null keys keep their own verdict.
    """
    own, columns, kept, schema = text_last(docs, text, True, "in")
    schema = ", ".join([schema, *(f"{m} bigint" for m in MEASURES)])
    judged = own.mapInArrow(_task(kept), schema).withColumn("fail_bits", failure_bits())
    return judged.where(~fails(policy)).select(*[columns[c] for c in docs.columns]).toDF(*docs.columns)
