"""Hard negatives by integer inner product, found through rotated one-bit codes with exact error intervals.

Every vector v becomes integers, is rotated (three rounds of sign flips and a Walsh-Hadamard transform over a power of two
of at least 64 dimensions) and is stored with its code b, the signs of the rotated vector scaled to length 1, its norm
and its alignment a = <b, v/|v|>. Then v/|v| = a b + sqrt(1 - a^2) r with a unit vector r orthogonal to b, and for an
anchor q

    <q, v> = |v| (a <q, b> + sqrt(1 - a^2) <q, r>),    |<q, r>| <= sqrt(|q|^2 - <q, b>^2)  (Cauchy-Schwarz).

<q, b> comes from popcounts: q is quantised to ``PLANES`` bit planes, each ANDed with the code, and the length of what
the quantisation leaves out widens the interval. No bound is a guess, so a row is passed over only when its interval
cannot reach the result; the others are scored with integers.

Anchors are a stated query set and meet all rows, in blocks: about ``ANCHORS`` anchors at a time are collected and sent
to the tasks, each of which reads its share of the stored codes once and gives out its best few rows per anchor. Nothing
is shuffled by label, so a hot label costs nothing extra. One such job finds the positives, a second one the negatives
in the score bands that the positives set.

Defined results: rows with a null label or vector, or with a null or non-finite component, take no part; components
beyond 2^62 are taken as that; only vectors of equal length meet; ties go to the smaller key, a null key last; repeated
rows are rows of their own, and an anchor that stands there twice has results twice; a positive with a negative score has no
band; scores that do not fit a long are null in the result but compared exactly; other columns are ignored whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripecast.llm.common import scratch_path, store

SCALE = 256
PLANES = 6
ROUNDS = 3
ANCHORS = 2_048
BLOCK = 16_384
_EXACT = float(1 << 53)


@lru_cache(maxsize=16)
def _flips(width: int) -> np.ndarray:
    return np.random.default_rng(width).choice([-1.0, 1.0], (ROUNDS, width))


def width_of(dims: int) -> int:
    return max(64, 1 << max(dims - 1, 0).bit_length())


def rotate(vectors: np.ndarray) -> np.ndarray:
    """Rows through the same orthogonal map, padded with zeros to its width."""
    width = width_of(vectors.shape[1])
    out = np.zeros((len(vectors), width))
    out[:, : vectors.shape[1]] = vectors
    for flips in _flips(width):
        out *= flips
        half = 1
        while half < width:
            pairs = out.reshape(len(out), -1, 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(out), width)
            half *= 2
        out /= np.sqrt(width)
    return out


def bits(signs: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    return np.packbits(signs, axis=1, bitorder="little").view(np.uint64)


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code words, norm and alignment of integer vectors."""
    turned = rotate(vectors.astype(float))
    norm = np.sqrt((turned * turned).sum(1))
    align = np.abs(turned).sum(1) / np.sqrt(turned.shape[1]) / np.where(norm > 0, norm, 1.0)
    return bits(turned >= 0), norm, np.where(norm > 0, np.minimum(align, 1.0), 1.0)


class Query:
    """One anchor, ready to be compared with codes by popcount."""

    def __init__(self, vector: np.ndarray):
        turned = rotate(vector.astype(float)[None])[0]
        self.vector, self.width = vector, len(turned)
        self.square = float(turned @ turned)
        self.low = float(turned.min())
        self.step = (float(turned.max()) - self.low) / ((1 << PLANES) - 1) or 1.0
        units = np.rint((turned - self.low) / self.step).astype(np.int64)
        left = turned - (self.low + self.step * units)
        self.slack = float(np.sqrt(left @ left))
        self.planes = [bits(((units >> p) & 1).astype(bool)[None])[0] for p in range(PLANES)]
        self.units = int(units.sum())

    def interval(self, codes: np.ndarray, ones: np.ndarray, norm: np.ndarray, align: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the inner product with every coded vector; ``ones`` are the popcounts of the codes."""
        met = np.zeros(len(codes), np.int64)
        for p, plane in enumerate(self.planes):
            met += np.bitwise_count(codes & plane).sum(1, dtype=np.int64) << p
        along = (self.low * (2.0 * ones - self.width) + self.step * (2.0 * met - self.units)) / np.sqrt(self.width)
        across = np.sqrt(np.maximum(self.square - np.maximum(np.abs(along) - self.slack, 0.0) ** 2, 0.0))
        half = norm * (align * self.slack + np.sqrt(np.maximum(1.0 - align * align, 0.0)) * across)
        half += 1e-9 * norm * np.sqrt(self.square) + 1e-6
        centre = norm * align * along
        return centre - half, centre + half


def scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products: by floating point where every sum is an integer below 2^53, else by Python's integers."""
    if not rows.size:
        return np.zeros(len(rows), np.int64)
    largest = float(np.abs(rows).max()) * float(np.abs(query).max())
    if largest * rows.shape[1] < _EXACT:
        return (rows.astype(float) @ query.astype(float)).astype(np.int64)
    return rows.astype(object) @ query.astype(object)


def _integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, integer vectors) of the rows that share a length."""
    lengths = np.asarray(pc.list_value_length(column))
    flat = np.asarray(column.flatten().cast(pa.float64()))
    starts = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    for dims in np.unique(lengths):
        at = np.flatnonzero(lengths == dims)
        values = flat[(starts[at][:, None] + np.arange(dims)).ravel()].reshape(len(at), int(dims))
        yield at, np.clip(np.floor(values * SCALE), -(2.0**62), 2.0**62).astype(np.int64)


def _encode_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, vectors in _integers(batch.column("vector")):
            codes, norm, align = encode(vectors)
            part = batch.take(pa.array(at))
            kind = np.int32 if not vectors.size or np.abs(vectors).max() < 1 << 31 else np.int64
            values = [v.tobytes() for v in vectors.astype(kind)]
            columns = [part.column("key"), part.column("label"), part.column("anchor"), pa.array(np.full(len(at), vectors.shape[1], np.int32))]
            columns += [pa.array(values, pa.binary()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(align)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "anchor", "dims", "ints", "code", "norm", "align"])


def encoded(rows: DataFrame, key: str, label: str, vector: str, anchor: str) -> DataFrame:
    """uid, key, label, anchor, dims, ints, code, norm, align of the rows that take part, stored so that uid stays."""
    spoilt = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    own = rows.select(F.col(key).alias("key"), F.col(label).alias("label"), F.coalesce(F.col(anchor), F.lit(False)).alias("anchor"), F.col(vector).alias("vector"))
    own = own.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", spoilt))
    own = own.withColumn("vector", F.col("vector").cast("array<double>"))
    kind = lambda c: own.schema[c].dataType.simpleString()
    schema = f"key {kind('key')}, label {kind('label')}, anchor boolean, dims int, ints binary, code binary, norm double, align double"
    return store(own.mapInArrow(_encode_task, schema).withColumn("uid", F.monotonically_increasing_id()), "negatives-codes")


def _unpacked(column: pa.Array, dims: int) -> np.ndarray:
    """Integer vectors of one length, stored in four or eight bytes a component."""
    values = column.to_pylist()
    if all(len(v) == 4 * dims for v in values):
        return np.frombuffer(b"".join(values), np.int32).reshape(len(values), dims).astype(np.int64)
    return np.array([np.frombuffer(v, np.int32 if len(v) == 4 * dims else np.int64) for v in values], np.int64).reshape(len(values), dims)


class Rows:
    """A block of coded rows of one length."""

    def __init__(self, table: pa.Table, dims: int):
        self.key, self.label = (table.column(c).combine_chunks() for c in ("key", "label"))
        self.uid = np.asarray(table.column("uid"))
        self.vectors = _unpacked(table.column("ints"), dims)
        self.codes = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint64).reshape(len(self.uid), -1)
        self.ones = np.bitwise_count(self.codes).sum(1, dtype=np.int64)
        self.norm, self.align = np.asarray(table.column("norm")), np.asarray(table.column("align"))
        self.order = np.asarray(pc.rank(self.key, sort_keys="ascending", null_placement="at_end", tiebreaker="dense"), np.int64)

    def best(self, at: np.ndarray, found: np.ndarray, most: int) -> list[tuple]:
        """(score, null key, key) of the first rows by falling score, then rising key."""
        if found.dtype == object:
            first = sorted(range(len(at)), key=lambda k: (-found[k], self.order[at[k]]))[:most]
        else:
            first = np.lexsort((self.order[at], -found))[:most]
        keys = [self.key[int(at[k])].as_py() for k in first]
        return [(int(found[k]), value is None, value) for k, value in zip(first, keys)]


def _sorted(entries: list[tuple], most: int) -> list[tuple]:
    return sorted(entries, key=lambda e: (-e[0], e[1], 0 if e[1] else e[2]))[:most]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Rows]:
    """Rows of a task in blocks of one vector length."""

    def split(held):
        table = pa.Table.from_batches(held)
        lengths = np.asarray(table.column("dims"))
        for dims in np.unique(lengths):
            yield Rows(table.filter(pa.array(lengths == dims)) if (lengths != dims).any() else table, int(dims))

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= BLOCK:
            yield from split(held)
            held, size = [], 0
    if size:
        yield from split(held)


def _kth(values: np.ndarray, most: int) -> float:
    return float(np.partition(values, len(values) - most)[len(values) - most]) if len(values) >= most else -np.inf


def _prepared(anchors: pa.Table) -> tuple[list[Query], list[int], np.ndarray]:
    dims = [int(d) for d in anchors.column("dims").to_pylist()]
    ints = anchors.column("ints").to_pylist()
    queries = [Query(np.frombuffer(v, np.int32 if len(v) == 4 * d else np.int64).astype(np.int64)) for v, d in zip(ints, dims)]
    return queries, dims, np.asarray(anchors.column("uid"))


def _positive_task(anchors, most: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = anchors.value
        queries, dims, uids = _prepared(table)
        labels = table.column("label").combine_chunks()
        unique = labels.unique()
        wanted = np.asarray(pc.index_in(labels, unique))
        found: list[list[tuple]] = [[] for _ in queries]
        kind = None
        for rows in _blocks(batches):
            kind = rows.key.type
            label = np.asarray(pc.index_in(rows.label, unique).fill_null(-1))
            members = {k: np.flatnonzero(label == k) for k in np.unique(label)}
            for k, query in enumerate(queries):
                at = members.get(wanted[k])
                if at is None or dims[k] != rows.vectors.shape[1]:
                    continue
                at = at[rows.uid[at] != uids[k]]
                low, high = query.interval(rows.codes[at], rows.ones[at], rows.norm[at], rows.align[at])
                least = max(_kth(low, most), found[k][-1][0] if len(found[k]) == most else -np.inf)
                at = at[high >= least]
                found[k] = _sorted(found[k] + rows.best(at, scores(rows.vectors[at], query.vector), most), most)
        if kind is not None:
            flat = [(int(uids[k]), e[2], e[0]) for k, entries in enumerate(found) for e in entries]
            columns = [pa.array([x[0] for x in flat], pa.int64()), pa.array([x[1] for x in flat], kind), pa.array([str(x[2]) for x in flat], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _negative_task(anchors, bands, most: int, low_pct: int, high_pct: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = anchors.value
        queries, dims, uids = _prepared(table)
        labels = table.column("label").combine_chunks()
        unique = labels.unique()
        wanted = np.asarray(pc.index_in(labels, unique))
        spans_ = [[(j, -(-low_pct * p // 100), high_pct * p // 100) for j, p in bands.value.get(int(u), ())] for u in uids]
        found = [{j: [] for j, _, _ in spans} for spans in spans_]
        kind = None
        for rows in _blocks(batches):
            kind = rows.key.type
            label = np.asarray(pc.index_in(rows.label, unique).fill_null(-1))
            for k, query in enumerate(queries):
                if not spans_[k] or dims[k] != rows.vectors.shape[1]:
                    continue
                at = np.flatnonzero(label != wanted[k])
                low, high = query.interval(rows.codes[at], rows.ones[at], rows.norm[at], rows.align[at])
                wants = []
                for j, bottom, top in spans_[k]:
                    best = found[k][j]
                    sure = low[(low >= bottom) & (high <= top)]
                    least = max(float(bottom), _kth(sure, most), best[-1][0] if len(best) == most else -np.inf)
                    wants.append((high >= least) & (low <= top))
                need = np.logical_or.reduce(wants)
                exact = scores(rows.vectors[at[need]], query.vector)
                for (j, bottom, top), want in zip(spans_[k], wants):
                    inside = want[need] & (exact >= bottom).astype(bool) & (exact <= top).astype(bool)
                    if inside.any():
                        found[k][j] = _sorted(found[k][j] + rows.best(at[need][inside], exact[inside], most), most)
        if kind is not None:
            flat = [(int(uids[k]), j, e[2], e[0]) for k, by in enumerate(found) for j, entries in by.items() for e in entries]
            columns = [pa.array([x[0] for x in flat], pa.int64()), pa.array([x[1] for x in flat], pa.int32())]
            columns += [pa.array([x[2] for x in flat], kind), pa.array([str(x[3]) for x in flat], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _first(found: DataFrame, by: list[str], most: int) -> DataFrame:
    """The first rows per group with their ``place``; scores travel as text, which no size can break."""
    exact = F.col("score").cast("decimal(38,0)")
    place = F.row_number().over(Window.partitionBy(*by).orderBy(exact.desc(), F.col("key").asc_nulls_last()))
    return found.withColumn("place", place).where(F.col("place") <= most)


def mine(
    rows: DataFrame,
    key: str,
    label: str,
    vector: str,
    anchor: str,
    positives: int = 5,
    negatives: int = 5,
    low_pct: int = 80,
    high_pct: int = 100,
) -> DataFrame:
    """anchor_key, positive_key, rank, negative_key, positive_score, negative_score.

    ``anchor`` is a boolean column that marks the anchors. An anchor's positives are its first other rows of the same label; for
    each, the first rows of other labels whose score lies between ``low_pct`` and ``high_pct`` percent of the positive's.
    """
    spark = rows.sparkSession
    coded = encoded(rows, key, label, vector, anchor)
    kind = coded.schema["key"].dataType.simpleString()
    queries = coded.where("anchor").select("uid", "key", "label", "dims", "ints")
    n_blocks = max(1, -(-queries.count() // ANCHORS))
    path = scratch_path(spark, "negatives-found")
    schema = f"anchor_key {kind}, positive_key {kind}, rank int, negative_key {kind}, positive_score bigint, negative_score bigint"
    scanned = coded.select("uid", "key", "label", "dims", "ints", "code", "norm", "align")
    for k in range(n_blocks):
        block = queries.where(F.pmod(F.xxhash64("uid"), F.lit(n_blocks)) == k).orderBy("uid").toArrow()
        sent = spark.sparkContext.broadcast(block)
        task = _positive_task(sent, positives, ["uid", "key", "score"])
        near = _first(scanned.mapInArrow(task, f"uid bigint, key {kind}, score string"), ["uid"], positives)
        near = store(near.select("uid", F.col("place").alias("j"), "key", "score"), "negatives-positives")
        bands: dict[int, list[tuple[int, int]]] = {}
        for r in near.select("uid", "j", "score").collect():
            bands.setdefault(r["uid"], []).append((r["j"], int(r["score"])))
        task = _negative_task(sent, spark.sparkContext.broadcast(bands), negatives, low_pct, high_pct, ["uid", "j", "key", "score"])
        far = _first(scanned.mapInArrow(task, f"uid bigint, j int, key {kind}, score string"), ["uid", "j"], negatives)
        ids = queries.select("uid", F.col("key").alias("anchor_key"))
        with_positive = near.select("uid", "j", F.col("key").alias("positive_key"), F.col("score").alias("positive_score")).join(ids, "uid")
        result = far.join(with_positive, ["uid", "j"]).select(
            "anchor_key",
            "positive_key",
            F.col("place").alias("rank"),
            F.col("key").alias("negative_key"),
            F.col("positive_score").try_cast("bigint").alias("positive_score"),
            F.col("score").try_cast("bigint").alias("negative_score"),
        )
        result.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
