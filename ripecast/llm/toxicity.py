"""A toxicity score from two class-conditional Kneser-Ney models over the bytes of lower-cased text.

A gram is the ``ORDER`` bytes that end at a byte of the text, packed into one integer; a text starts with line breaks, so
every byte has a gram. White space is folded to one blank. For class c with counts C_c, discount D and context h,

    P_c(x | h) = max(C_c(hx) - D, 0) / C_c(h) + D * N_c(h) / C_c(h) * S(x | h')

where N_c(h) counts the bytes seen after h in class c, h' is h without its first byte, and S is the shared backoff: the
Kneser-Ney continuation model of order ``ORDER - 1`` down to 1 over the distinct grams of all documents, labelled or
not. A context that a class has not seen leaves everything to S, so what is rare in a class is smoothed by counts that
both share. A gram weighs log P_toxic - log P_ordinary. A text's measure is its largest mean weight over ``WINDOW``
bytes in a row: the log-likelihoods of both models, normalised by length, compared in the most toxic place. A logistic
curve fitted on labelled texts that were not counted turns the measure into a score.

All counts are over whole texts and all rows, and grow with them. Tasks reduce their texts to distinct grams with counts
per ``CHUNK`` bytes; the rest of the model is windows and joins over distinct grams, where a key has at most 256 rows.
Weights reach the texts in one of two ways, with equal results: as a broadcast table while there are at most
``MOST_BROADCAST`` of them (12 bytes each, counted first), else chunk by chunk: the distinct grams of a chunk are joined
with the weights and meet the packed texts of the chunk in one group. Labels are broadcast while there are at most
``MOST_BROADCAST`` labelled keys, else joined by shuffle. Only the curve sees a bounded sample: at most
``CURVE_ROWS`` measures of labelled rows, in the order of a hash of the key.

Defined results: a null or empty text has no bytes and measure 0; texts shorter than the window are one window; null
labels and labels other than 0 and 1 are not learned from; a key with both labels is not learned from either; repeated
label rows count once, repeated document rows as often as they stand there; a class without rows makes every score the
share of the other one; equal texts get equal scores; null keys stay null and unlabelled; other columns are carried
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from ripecast.llm import spans
from ripecast.llm.common import as_text, fresh, store

ORDER = 5
WINDOW = 12
DISCOUNT = 0.75
CHUNK = 16 << 20
BLOCK = 1 << 20
MOST_BROADCAST = 1 << 22
CURVE_ROWS = 20_000


def normal(text: str) -> Column:
    """The text that is modelled: lower case, runs of white space as one blank."""
    return F.regexp_replace(F.lower(as_text(text)), r"[\x20\x09-\x0D]+", " ")


def framed(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, each behind ``order - 1`` line breaks, and where each text then begins and the last one ends."""
    n = len(offsets) - 1
    at = offsets + np.arange(n + 1) * (order - 1)
    out = np.full(at[-1], 10, np.uint8)
    keep = np.ones(len(out), bool)
    keep[(at[:-1, None] + np.arange(order - 1)).ravel()] = False
    out[keep] = data
    return out, at


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """The grams that end at each byte from the ``order``-th on."""
    n = max(len(data) - order + 1, 0)
    out = np.zeros(n, np.int64)
    for k in range(order):
        out <<= 8
        out |= data[k : k + n]
    return out


def text_blocks(column: pa.Array, order: int, overlap: int = 0, most: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, grams, first gram of each text and the end) for runs of texts of about ``most`` bytes.

    A longer text comes in several runs of one text each, which share ``overlap`` grams with their neighbours.
    """
    for row, end, data, offsets in spans.slices(column, most):
        whole, at = framed(data, offsets, order)
        if end - row == 1 and len(data) > 2 * most:
            start = 0
            while start == 0 or start + overlap < len(data):
                found = grams(whole[start : start + most + overlap + order - 1], order)
                yield row, found, np.array([0, len(found)])
                start += most
            continue
        found = grams(whole, order)
        inside = np.ones(len(found), bool)
        for k in range(order - 1):
            inside[at[1:-1] - (order - 1) + k] = False
        yield row, found[inside], offsets


class Tally:
    """Distinct grams with counts of class 1 and class 0, merged as they come."""

    def __init__(self):
        self.parts, self.rows = [], 0

    def add(self, codes: np.ndarray, toxic: np.ndarray, ordinary: np.ndarray) -> None:
        self.parts.append((codes, toxic, ordinary))
        self.rows += len(codes)
        if len(self.parts) > 1 and self.rows > 4 * BLOCK:
            self.parts = [self.merged()]
            self.rows = len(self.parts[0][0])

    def merged(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3
        codes, toxic, ordinary = (np.concatenate(x) for x in zip(*self.parts))
        order, opens = spans.grouped(codes)
        first = np.flatnonzero(opens)
        if not len(first):
            return codes, toxic, ordinary
        return codes[order][first], np.add.reduceat(toxic[order], first), np.add.reduceat(ordinary[order], first)


def _count_task(order: int):
    """(text, label) to distinct grams with counts, given out whenever ``CHUNK`` bytes have been read."""

    def out(tally: Tally) -> Iterator[pa.RecordBatch]:
        columns = tally.merged()
        for k in range(0, len(columns[0]), BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array(c[k : k + BLOCK]) for c in columns], names=["gram", "toxic", "ordinary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, read = Tally(), 0
        for batch in batches:
            label = np.asarray(batch.column(1).fill_null(-1))
            for row, codes, offsets in text_blocks(batch.column(0), order):
                y = np.repeat(label[row : row + len(offsets) - 1], np.diff(offsets))
                at, opens = spans.grouped(codes)
                first = np.flatnonzero(opens)
                if len(first):
                    y = y[at]
                    counts = [np.add.reduceat((y == c).astype(np.int64), first) for c in (1, 0)]
                    tally.add(codes[at][first], *counts)
                read += len(codes)
                if read >= CHUNK:
                    yield from out(tally)
                    tally, read = Tally(), 0
        yield from out(tally)

    return run


def count(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """gram, toxic, ordinary: every distinct gram of ``text`` with its counts in texts of ``label`` 1 and 0."""
    part = rows.select("text", F.col("label").cast("int").alias("label")).mapInArrow(_count_task(order), "gram bigint, toxic bigint, ordinary bigint")
    return part.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def backoff(counts: DataFrame, order: int, discount: float) -> DataFrame:
    """gram, shared: the continuation probability of each gram of ``order - 1`` bytes of the corpus."""
    levels = {order: counts.select("gram")}
    for k in range(order - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        longer = levels[k + 1].select(suffix.alias("gram"))
        levels[k] = longer.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    lower = None
    for k in range(1, order):
        context = Window.partitionBy(F.shiftright("gram", 8))
        total, kinds = F.sum("n").over(context), F.count(F.lit(1)).over(context)
        level = levels[k].select("gram", ((F.col("n") - discount) / total).alias("own"), (kinds * discount / total).alias("rest"))
        if lower is None:
            lower = level.select("gram", (F.col("own") + F.col("rest") / 256).alias("shared"))
        else:
            tail = F.col("gram").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1)).alias("tail")
            under = lower.select(F.col("gram").alias("tail"), F.col("shared").alias("under"))
            joined = level.select("*", tail).join(under, "tail")
            lower = joined.select("gram", (F.col("own") + F.col("rest") * F.col("under")).alias("shared"))
    return lower


def weights(counts: DataFrame, order: int = ORDER, discount: float = DISCOUNT) -> DataFrame:
    """gram, weight: log P_toxic - log P_ordinary of every gram of the corpus."""
    context = Window.partitionBy(F.shiftright("gram", 8))
    tail = F.col("gram").bitwiseAND(F.lit((1 << (8 * (order - 1))) - 1))
    shared = backoff(counts, order, discount).select(F.col("gram").alias("tail"), "shared")
    parts = [F.col("gram"), tail.alias("tail")]
    for c in ("toxic", "ordinary"):
        total = F.sum(c).over(context)
        kinds = F.sum((F.col(c) > 0).cast("bigint")).over(context)
        own = F.when(total > 0, F.greatest(F.col(c) - discount, F.lit(0.0)) / total).otherwise(F.lit(0.0))
        rest = F.when(total > 0, kinds * discount / total).otherwise(F.lit(1.0))
        parts += [own.alias(f"{c}_own"), rest.alias(f"{c}_rest")]
    chance = lambda c: F.col(f"{c}_own") + F.col(f"{c}_rest") * F.col("shared")
    joined = counts.select(*parts).join(shared, "tail")
    return joined.select("gram", (F.log(chance("toxic")) - F.log(chance("ordinary"))).cast("float").alias("weight"))


def measure(codes: np.ndarray, offsets: np.ndarray, table: np.ndarray, values: np.ndarray, window: int) -> np.ndarray:
    """The largest mean weight over ``window`` grams of each text; unknown grams weigh nothing."""
    n = np.diff(offsets)
    out = np.zeros(len(n))
    if not len(codes) or not len(table):
        return out
    at = np.minimum(np.searchsorted(table, codes), len(table) - 1)
    weight = np.where(table[at] == codes, values[at], np.float32(0)).astype(float)
    total = np.zeros(len(codes) + 1)
    np.cumsum(weight, out=total[1:])
    solid = n >= window
    if len(codes) >= window:
        means = (total[window:] - total[:-window]) / window
        text = np.repeat(np.arange(len(n)), n)
        inside = text[: len(means)] == text[window - 1 :]
        owner, means = text[: len(means)][inside], means[inside]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        if len(first):
            out[owner[first]] = np.maximum.reduceat(means, first)
    small = ~solid & (n > 0)
    out[small] = (total[offsets[1:]] - total[offsets[:-1]])[small] / n[small]
    return out


def _measures(column: pa.Array, table: np.ndarray, values: np.ndarray, order: int, window: int) -> np.ndarray:
    out = np.full(len(column), -np.inf)
    for row, codes, offsets in text_blocks(column, order, window - 1):
        rows = slice(row, row + len(offsets) - 1)
        out[rows] = np.maximum(out[rows], measure(codes, offsets, table, values, window))
    return out


def _measure_task(table, order: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, values = table.value
        for batch in batches:
            found = _measures(batch.column(batch.num_columns - 1), known, values, order, window)
            kept = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.float64())], names=[*batch.schema.names[:-1], "measure"])

    return run


def _pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows to chunks of about ``CHUNK`` bytes of text: an id that is unique in the job, and the rows as one value."""
    held, size, seq = [], 0, 0
    options = pa.ipc.IpcWriteOptions(compression="zstd")

    def packed() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=options) as stream:
            for part in held:
                stream.write_batch(part)
        chunk = (TaskContext.get().partitionId() << 33) + seq
        return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "rows"])

    for batch in batches:
        for row, end, data, _ in spans.slices(batch.column(batch.num_columns - 1), BLOCK):
            held.append(batch.slice(row, end - row))
            size += len(data)
            if size >= CHUNK:
                yield packed()
                held, size, seq = [], 0, seq + 1
    if held:
        yield packed()


def _unpack(rows: pa.Scalar) -> Iterator[pa.RecordBatch]:
    with pa.ipc.open_stream(rows.as_buffer()) as stream:
        yield from stream


def _chunk_grams_task(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, rows in zip(batch.column(0).to_pylist(), batch.column(1)):
                tally = Tally()
                for part in _unpack(rows):
                    for _, codes, _ in text_blocks(part.column(part.num_columns - 1), order):
                        found = np.unique(codes)
                        tally.add(found, found, found)
                found = tally.merged()[0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), chunk)), pa.array(found)], names=["chunk", "gram"])

    return run


def _chunk_measure_task(order: int, window: int):
    def run(key, packs: pa.Table, table: pa.Table) -> pa.Table:
        codes = np.asarray(table.column("gram").combine_chunks(), np.int64)
        by = np.argsort(codes)
        codes, values = codes[by], np.asarray(table.column("weight").combine_chunks(), np.float32)[by]
        out = []
        for rows in packs.column("rows").combine_chunks():
            for part in _unpack(rows):
                found = _measures(part.column(part.num_columns - 1), codes, values, order, window)
                kept = [part.column(k) for k in range(part.num_columns - 1)]
                out.append(pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.float64())], names=[*part.schema.names[:-1], "measure"]))
        return pa.Table.from_batches(out)

    return run


def measured(docs: DataFrame, table: DataFrame, text: str = "text", order: int = ORDER, window: int = WINDOW, most: int = MOST_BROADCAST) -> DataFrame:
    """The input rows, their columns renamed c0, c1 and so on and without the text, with ``measure``.

    ``table`` holds gram and weight, and should be stored: it is counted before it is used.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    kept = [n for n, c in zip(names, docs.columns) if c != text]
    own = docs.toDF(*names).select(*kept, normal(names[docs.columns.index(text)]).alias("t"))
    kinds = dict(zip(names, docs.schema))
    schema = ", ".join([*(f"{n} {kinds[n].dataType.simpleString()}" for n in kept), "measure double"])
    spark = docs.sparkSession
    if table.count() <= most:
        found = table.orderBy("gram").toArrow()
        columns = (np.asarray(found.column("gram").combine_chunks(), np.int64), np.asarray(found.column("weight").combine_chunks(), np.float32))
        return own.mapInArrow(_measure_task(spark.sparkContext.broadcast(columns), order, window), schema)
    packs = store(own.mapInArrow(_pack_task, "chunk bigint, rows binary"), "toxicity-packs")
    needed = packs.mapInArrow(_chunk_grams_task(order), "chunk bigint, gram bigint").join(table, "gram").select("chunk", "gram", "weight")
    return packs.groupBy("chunk").cogroup(needed.groupBy("chunk")).applyInArrow(_chunk_measure_task(order, window), schema)


@dataclass(frozen=True)
class Curve:
    """score = 1 / (1 + exp(-(slope * measure + shift)))."""

    slope: float
    shift: float

    def of(self, measure: str) -> Column:
        return 1.0 / (1.0 + F.exp(-F.greatest(F.least(F.lit(self.slope) * F.col(measure) + self.shift, F.lit(30.0)), F.lit(-30.0))))


def curve(x: np.ndarray, y: np.ndarray, rounds: int = 200) -> Curve:
    """A logistic fit by damped Newton steps, with a light penalty on the slope so that separable data stay finite."""
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1.0) / (len(y) + 2.0)
        return Curve(0.0, float(np.log(share / (1.0 - share))))
    centre, scale = float(np.mean(x)), float(np.std(x)) or 1.0
    design = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    penalty = np.diag([0.01, 1e-6])

    def loss(w):
        z = design @ w
        return np.sum(np.logaddexp(0.0, z) - y * z) + 0.5 * w @ penalty @ w

    w = np.zeros(2)
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + penalty, design.T @ (y - p) - penalty @ w)
        size = 1.0
        while size > 1e-6 and loss(w + size * step) > loss(w):
            size /= 2
        w = w + size * step
        if np.abs(step).max() < 1e-9:
            break
    return Curve(float(w[0] / scale), float(w[1] - w[0] * centre / scale))


def class_of(labels: DataFrame, key: str, label: str) -> DataFrame:
    """k, y, fold: one row per key whose label rows agree; fold 0 of 5 is for the curve."""
    known = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where(F.col("k").isNotNull() & F.col("y").isin(0, 1))
    one = known.groupBy("k").agg(F.min("y").alias("y"), F.max("y").alias("other")).where(F.col("y") == F.col("other"))
    fold = F.pmod(F.xxhash64(F.col("k").cast("string"), F.lit("curve")), F.lit(5))
    return one.select("k", "y", fold.alias("fold"))


def score(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    out: str = "score",
    order: int = ORDER,
    window: int = WINDOW,
    most: int = MOST_BROADCAST,
) -> DataFrame:
    """The input rows without the text, with ``out``; labels are learned from the rows given (drop held-out rows before)."""
    known = store(class_of(labels, key, label), "toxicity-labels")
    small = known.count() <= most
    sided = F.broadcast(known) if small else known
    own = docs.select(F.col(key).alias("k"), normal(text).alias("text"))
    counted = own.join(sided.where(F.col("fold") != 0).select("k", F.col("y").alias("label")), "k", "left")
    counts = store(count(counted, order), "toxicity-counts")
    table = store(weights(counts, order), "toxicity-weights")
    found = store(measured(docs, table, text, order, window, most), "toxicity-measures")
    names = [n for n in found.columns if n != "measure"]
    kept = [c for c in docs.columns if c != text]
    at = names[kept.index(key)]
    held = found.select(F.col(at).alias("k"), "measure").join(sided.where(F.col("fold") == 0), "k")
    sample = held.orderBy(F.md5(F.col("k").cast("string")), "k", "measure").limit(CURVE_ROWS).select("measure", "y").toArrow()
    fitted = curve(np.asarray(sample.column("measure")), np.asarray(sample.column("y"), float))
    return found.select(*names, fitted.of("measure").alias("measure")).toDF(*kept, fresh(kept, out))
