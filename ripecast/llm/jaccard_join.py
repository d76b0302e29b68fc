"""Chosen-path join: documents whose sets of word shingles have a Jaccard similarity of ``THRESHOLD`` or more.

Equal sets are collapsed first and carried as one class with a count. Every class gets ``COORDINATES`` sampled tokens:
for each of as many hash functions, the shingle with the smallest hash; two sets share a sampled token with probability
equal to their similarity. Each of ``RUNS`` runs starts a tree: sets are split by one sampled token, and a bucket of
more than ``BUCKET`` sets is split again by ``BRANCHES`` further tokens that the path chooses, down to ``DEPTH`` levels.
Small buckets, and those whose members are mostly alike and so would not fall apart, are compared by brute force with
exact similarities. A pair at the
threshold meets in one run with probability 0.8 (0.77 and 0.74 in buckets split once and twice more), so eight runs
find it with a probability of at least 0.99998; higher similarities are found more surely.

Scale: buckets with the same members are compared once, and members that met in an earlier bucket are not brought
together again where they are the bulk of a bucket. A bucket is cut into tiles and each pair of tiles is one unit of
work, so no task holds a bucket; a pair that meets in several buckets counts in the first one only. Pairs are never
written: a unit emits link counts per set and a spanning forest of its links. Texts cross two exchanges, once by key and
once to the units of those sets that share a bucket.

Defined results: a text of fewer than ``SHINGLE`` words has one shingle, all its words; a null, empty or blank text has
none and is linked to nothing; rows that repeat key and text are separate documents with equal sets; keys may be null or
repeat; other columns are not read; an empty table gives an empty result. Equality of sets and shingles is that of
128-bit and 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripecast.llm import spans
from ripecast.llm.common import as_text, fresh, store, text_last
from ripecast.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
RUNS = 8
COORDINATES = 24
BUCKET = 48
BRANCHES = 2
DEPTH = 3
ALIKE = 0.5
PROBES = 4
TILE = 512
MOST_BROADCAST = 1 << 20
_BLOCK = 4096


def _sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each text, and where each text's begin."""
    starts, ends, first = spans.words(data, offsets)
    hashes = spans.Hasher(data).of(starts, ends)
    found, at = spans.shingles(hashes, first, SHINGLE)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    owner = text[at]
    few = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < SHINGLE))
    if len(few):
        short = np.array([spans.mix(np.array([np.bitwise_xor.reduce(spans.mix(hashes[first[k] : first[k + 1]] + np.arange(1, first[k + 1] - first[k] + 1, dtype=np.uint64)))], np.uint64))[0] for k in few], np.uint64)
        found, owner = np.concatenate([found, short]), np.concatenate([owner, few])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[new], owner[new]
    return found, np.searchsorted(owner, np.arange(len(offsets)))


def _digest(found: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums over each set."""
    out = []
    for seed in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        total = np.zeros(len(found) + 1, np.uint64)
        np.cumsum(spans.mix(found ^ np.uint64(seed)), out=total[1:])
        out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def _sketch_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, data, offsets in spans.slices(batch.column(1)):
            found, bounds = _sets(data, offsets)
            s1, s2 = _digest(found, bounds)
            size = np.diff(bounds)
            filled = size > 0
            samples = np.zeros((len(size), COORDINATES), np.int64)
            if filled.any():
                for k in range(COORDINATES):
                    seed = spans.mix(np.array([k + 1], np.uint64))[0]
                    samples[filled, k] = np.minimum.reduceat(spans.mix(found ^ seed), bounds[:-1][filled]).view(np.int64)
            flat = pa.array(samples.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * COORDINATES), flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(row, end - row), pa.array(s1), pa.array(s2), pa.array(size.astype(np.int64)), lists],
                names=["key", "s1", "s2", "n", "samples"],
            )


def sketches(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, s1, s2 (hash of the set), n (its size), samples: one row per document."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, s1 bigint, s2 bigint, n bigint, samples array<bigint>"
    return docs.select(F.col(key).alias("key"), as_text(text).alias("text")).mapInArrow(_sketch_task, schema)


def _alike(rows: DataFrame) -> DataFrame:
    """path of the buckets whose members agree in ``ALIKE`` or more of a few sampled tokens on average."""
    each = [rows.groupBy("path", F.element_at("samples", RUNS + k + 1).alias("token")).agg(F.count(F.lit(1)).alias("n")) for k in range(PROBES)]
    counts = reduce(DataFrame.unionByName, each)
    # the counts of all probes add up to PROBES times the size
    mean = PROBES * F.sum(F.col("n").cast("double") * F.col("n")) / F.pow(F.sum("n").cast("double"), 2)
    return counts.groupBy("path").agg(mean.alias("mean")).where(F.col("mean") >= ALIKE).select("path")


def buckets(sets: DataFrame) -> DataFrame:
    """path, id, size: the members of the buckets to compare, from (id, samples)."""
    start = F.array(*[F.xxhash64(F.lit(r), F.element_at("samples", F.lit(r + 1))) for r in range(RUNS)])
    rows = sets.select("id", "samples", F.explode(start).alias("path"))
    done = None
    for level in range(DEPTH):
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("who")).where(F.col("size") > 1)
        last = level == DEPTH - 1
        members = rows.join(sizes if last else sizes.where(F.col("size") <= BUCKET), "path").select("path", "id", "size", "who")
        done = members if done is None else done.unionByName(members)
        if last:
            break
        large = store(rows.join(sizes.where(F.col("size") > BUCKET), "path"), "join-large")
        alike = _alike(large)
        done = done.unionByName(large.join(alike, "path", "left_semi").select("path", "id", "size", "who"))
        spare = (COORDINATES - RUNS) // BRANCHES
        picks = F.array(*[(F.pmod(F.xxhash64("path", F.lit(b)), F.lit(spare)) + b * spare + RUNS + 1).cast("int") for b in range(BRANCHES)])
        split = F.explode(F.transform(picks, lambda j: F.xxhash64("path", j, F.element_at("samples", j)))).alias("path")
        rows = store(large.join(alike, "path", "left_anti").select("id", "samples", split), "join-level")
    found = store(done, "join-members")
    once = found.groupBy("size", "who").agg(F.min("path").alias("path"))
    return found.join(once.select("path"), "path", "left_semi").select("path", "id", "size")


def units(found: DataFrame) -> DataFrame:
    """path, low, high, id, tile, paths: which tiles meet, one row per member and unit of work.

    Most members of a bucket often have the same first bucket, where they have met already. Their tiles (numbered first)
    meet only the tiles of the other members.
    """
    paths = found.groupBy("id").agg(F.sort_array(F.collect_set("path")).alias("paths"))
    members = found.join(paths, "id").withColumn("origin", F.element_at("paths", 1))
    met = members.where(F.col("origin") < F.col("path")).groupBy("path", "origin").agg(F.count(F.lit(1)).alias("n"))
    met = met.groupBy("path").agg(F.max(F.struct("n", "origin")).alias("met"))
    members = members.join(met, "path", "left")
    old = F.coalesce(F.col("origin") == F.col("met.origin"), F.lit(False))
    n_old = F.coalesce("met.n", F.lit(0))
    m_old, m_new = F.ceil(n_old / TILE).cast("int"), F.ceil((F.col("size") - n_old) / TILE).cast("int")
    spot = F.xxhash64("id", F.lit(7))
    tile = F.when(old, F.pmod(spot, F.greatest(m_old, F.lit(1)))).otherwise(m_old + F.pmod(spot, F.greatest(m_new, F.lit(1)))).cast("int")
    members = members.select("path", "id", "paths", tile.alias("tile"), F.when(old, m_old).otherwise(0).alias("from"), (m_old + m_new).alias("to"))
    every = F.explode(F.filter(F.sequence(F.lit(0), F.col("to")), lambda k: (k >= F.col("from")) & (k < F.col("to")))).alias("other")
    met_tiles = members.select("path", "id", "paths", "tile", every)
    return met_tiles.select("path", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "id", "tile", "paths")


def _links(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of similar sets: within ``left``, or between ``left`` and ``right``."""
    inside = right is None
    right = left if inside else right
    if len(left) * len(right) <= 64:
        pairs = []
        for i, a in enumerate(left):
            for b in right[i + 1 :] if inside else right:
                x, y = sets[a], sets[b]
                if min(len(x), len(y)) >= THRESHOLD * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if both >= THRESHOLD * (len(x) + len(y) - both) - 1e-9:
                        pairs.append((a, b))
        found = np.array(pairs, np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]
    used = np.concatenate([left, right])
    owner = np.repeat(np.arange(len(used)), [len(sets[k]) for k in used])
    values, codes = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True)
    both = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(codes, kind="stable")
    cuts = np.searchsorted(codes[order], np.arange(0, len(values) + _BLOCK, _BLOCK))
    for k in range(len(cuts) - 1):
        part = order[cuts[k] : cuts[k + 1]]
        grid = np.zeros((len(used), _BLOCK), np.float32)
        grid[owner[part], codes[part] - k * _BLOCK] = 1.0
        both += grid[: len(left)] @ grid[len(left) :].T
    size = np.array([len(s) for s in sets], np.float64)
    union = size[left][:, None] + size[right][None, :] - both
    hit = both >= THRESHOLD * union - 1e-9
    if inside:
        hit = np.triu(hit, 1)
    i, j = np.nonzero(hit)
    return left[i], right[j]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the links (a, b) connect: each vertex with the smallest of its part."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return [(k, int(r)) for k, r in enumerate(root) if r != k]
        root = low


def _cell(rows: list[dict]) -> Iterator[tuple[int, int | None, int]]:
    """Link counts (id, None, count) and forest edges (id, id, 0) of one pair of tiles."""
    texts = pa.array([r["text"] for r in rows], pa.string())
    sets, s1, s2 = [], [], []
    for _, _, data, offsets in spans.slices(texts):
        found, bounds = _sets(data, offsets)
        sets += [found[bounds[k] : bounds[k + 1]] for k in range(len(bounds) - 1)]
        one, two = _digest(found, bounds)
        s1, s2 = [*s1, *one], [*s2, *two]
    seen: set[int] = set()
    pick = []
    for k, r in enumerate(rows):
        if r["s1"] == s1[k] and r["s2"] == s2[k] and r["id"] not in seen:
            seen.add(r["id"])
            pick.append(k)
    index = np.array(pick, np.int64)
    tile = np.array([rows[k]["tile"] for k in pick])
    here = rows[0]
    if here["low"] == here["high"]:
        a, b = _links(sets, index, None)
    else:
        a, b = _links(sets, index[tile == here["low"]], index[tile == here["high"]])
    paths = [frozenset(r["paths"]) for r in rows]
    if len(set(paths)) == 1:
        if min(paths[0]) != here["path"]:
            return
    else:
        first = np.fromiter((min(paths[x] & paths[y]) == here["path"] for x, y in zip(a, b)), bool, len(a))
        a, b = a[first], b[first]
    copies = np.array([r["copies"] for r in rows], np.int64)
    count = np.zeros(len(rows), np.int64)
    np.add.at(count, a, copies[b])
    np.add.at(count, b, copies[a])
    for k in np.flatnonzero(count):
        yield rows[k]["id"], None, int(count[k])
    for x, y in forest(len(rows), a, b):
        yield rows[x]["id"], rows[y]["id"], 0


_UNIT = ["path", "low", "high", "id", "tile", "copies", "s1", "s2", "paths", "text"]


def _verify_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by unit; a unit may go on in the next batch."""

    def flush(rows):
        found = list(_cell(rows)) if len(rows) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in range(3)], names=["a", "b", "n"])

    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and (row["path"], row["low"], row["high"]) != (rows[0]["path"], rows[0]["low"], rows[0]["high"]):
                yield flush(rows)
                rows = []
            rows.append(row)
    if rows:
        yield flush(rows)


def _spelled(column):
    return F.coalesce(column.cast("string"), F.lit(""))


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, s1, s2, rows, n_links, group_key, first: one row for each different (key, set).

    ``rows`` documents have this key and set, each linked to ``n_links`` other documents; ``group_key`` is the smallest
    key reachable by links and ``first`` marks the one (key, set) of its group that stands for it.
    """
    marked = store(sketches(docs, key, text), "join-sketches")
    kinds = marked.where(F.col("n") > 0).groupBy("s1", "s2").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("samples").alias("samples"))
    kinds = store(kinds.withColumn("id", F.monotonically_increasing_id()), "join-classes")
    work = units(buckets(kinds.select("id", "samples")))
    work = work.join(kinds.select("id", "s1", "s2", "copies", _spelled(F.col("rep")).alias("spelled")), "id")
    texts = docs.select(_spelled(F.col(key)).alias("spelled"), as_text(text).alias("text"))
    work = texts.join(work, "spelled").select(*_UNIT)
    work = work.repartition("path", "low", "high").sortWithinPartitions("path", "low", "high")
    linked = store(work.mapInArrow(_verify_task, "a bigint, b bigint, n bigint"), "join-links")
    links = linked.where(F.col("b").isNull()).groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    roots = components(linked.where(F.col("b").isNotNull()))
    group = kinds.join(roots, F.col("id") == F.col("vertex"), "left").select("id", "s1", "s2", "copies", "rep", F.coalesce("root", "id").alias("root"))
    heads = group.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "s1", "s2")).alias("head"))
    group = group.join(links, "id", "left").join(heads, "root")
    group = group.select(
        F.col("s1").alias("g1"), F.col("s2").alias("g2"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "head"
    )
    each = marked.groupBy("key", "s1", "s2", (F.col("n") > 0).alias("filled")).agg(F.count(F.lit(1)).alias("rows"))
    each = each.join(group, F.col("filled") & (F.col("s1") == F.col("g1")) & (F.col("s2") == F.col("g2")), "left")
    alone = F.col("head").isNull()
    first = F.col("key").eqNullSafe(F.col("head.rep")) & (F.col("s1") == F.col("head.s1")) & (F.col("s2") == F.col("head.s2"))
    return each.select(
        "key", "s1", "s2", "rows", "filled",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(alone, F.col("key")).otherwise(F.col("head.rep")).alias("group_key"),
        F.when(alone, True).otherwise(first).alias("first"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input rows without near-duplicates: of each group the row with the smallest key, others go.

    Only the (key, set) pairs that lose rows are joined with the documents; all else passes through. They are counted
    first: up to ``MOST_BROADCAST`` of them (some 50 MB) are broadcast, so that the texts stay where they are; more are
    joined by shuffle.
    """
    verdict = join(docs, key, text)
    touched = verdict.where(F.col("filled") & (~F.col("first") | (F.col("rows") > 1)))
    touched = store(touched.select(F.col("key").alias("k"), F.col("s1").alias("t1"), F.col("s2").alias("t2"), F.col("first").alias("head")), "join-verdict")
    if touched.count() <= MOST_BROADCAST:
        touched = F.broadcast(touched)
    own, columns, kept, schema = text_last(docs, text, True)
    names, k = [columns[c] for c in docs.columns], columns[key]
    own = own.mapInArrow(_digest_task(kept), f"{schema}, s1 bigint, s2 bigint, filled boolean")
    match = F.col("filled") & F.col(k).eqNullSafe(F.col("k")) & (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2"))
    seen = own.join(touched, match, "left")
    whole = seen.where(F.col("head").isNull()).select(*names)
    one = seen.where(F.col("head")).dropDuplicates([k, "s1", "s2"]).select(*names)
    return whole.unionByName(one).toDF(*docs.columns)


def _digest_task(kept: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in spans.slices(batch.column(batch.num_columns - 1)):
                found, bounds = _sets(data, offsets)
                s1, s2 = _digest(found, bounds)
                columns = [batch.column(k).slice(row, end - row) for k in range(kept)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(s1), pa.array(s2), pa.array(np.diff(bounds) > 0)], names=[*batch.schema.names[:kept], "s1", "s2", "filled"]
                )

    return run
