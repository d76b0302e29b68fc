"""NN-descent: near-duplicate vectors by refining a neighbour graph.

Equal vectors of a label are one class with a count. The graph starts from blocks: in each of ``TABLES`` tables, vectors
of a label whose signs agree along a few random directions (about ``BLOCK`` vectors a block, large ones split by hash).
Then neighbours of neighbours are compared: around every vector its own neighbours and those that have it as a
neighbour meet (in chunks, so that a popular vector does not make a large task), and each keeps the ``K`` most similar.
A list that is full of links is saturated and may lack others, so lists are enlarged beyond the component they belong
to: saturated vectors descend again for their most similar partners in OTHER components, links found that way join
components, and this repeats until it finds none (a pair that both lists lack has both lists saturated, and the best
partner outside is a link if any is). Then the members of each component are compared with each other in tiles, which
makes the link counts inside it exact.

The result is audited: for at most ``AUDIT`` vectors of every label, half of them among those with few links found, chosen
by hash, all links are counted by brute force. A label passes when the mean share found per audited vector that has links is at least
``RECALL``, over all of them and over those with at most ``K`` links. While one fails, another round adds new tables
(also among the vectors with room in their lists only, so that large groups do not fill the blocks) and refines again.
Labels that have not passed after ``ROUNDS`` rounds are compared in full, in tiles.

Every similarity is computed in double precision, and only pairs at ``threshold`` or more are links. Vectors take part in
joins with one row per list entry; tiles and blocks bound what a task holds; counts, not pairs, leave the tiles.

Defined results: a vector that is null, empty or all zero, or holds a null or non-finite component, and a vector with a
null label, links with nothing; vectors of different length do not link; rows that repeat a vector are links of each
other; a null id has no component number unless others share it; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ripecast.llm.common import store
from ripecast.llm.components import components
from ripecast.llm.jaccard_join import forest

THRESHOLD = 0.98
K = 10
TABLES = 4
BLOCK = 32
ITERATIONS = 3
STEADY = 0.01
TILE = 512
AUDIT = 50
RECALL = 0.99
ROUNDS = 5
MOST_BITS = 30


def _valid_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the components as little-endian doubles where the vector can link, else null."""
    for batch in batches:
        out = []
        for row in batch.column(2).to_pylist():
            x = np.array([np.nan if c is None else c for c in row or []], np.float64)
            out.append(x.astype("<f8").tobytes() if len(x) and np.isfinite(x).all() and x.any() else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["key", "label", "vec"])


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors of a binary column; all rows have the same length."""
    x = np.stack([np.frombuffer(v, "<f8") for v in column.to_pylist()])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _rows(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(kinds)], names=["a", "b", "sim"])


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows that agree in the first ``keys`` columns; the rows come sorted, and runs may span batches."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        batch = table.combine_chunks().to_batches()[0] if table.num_rows else None
        if batch is None:
            continue
        change = np.zeros(batch.num_rows - 1, bool)
        for k in range(keys):
            v = batch.column(k).to_numpy(zero_copy_only=False)
            change |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1)]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
        rest = pa.Table.from_batches([batch.slice(cuts[-1])])
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks().to_batches()[0]


def _meet_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare all members of a group; each gets its best partners of other parts that beat what it has (column ``least``)."""
    found: list[tuple] = []
    for group in _groups(batches, 2):
        n = group.num_rows
        if n < 2:
            continue
        ids = group.column(2).to_numpy()
        part = group.column(3).to_numpy()
        least = group.column(4).to_numpy()
        x = _matrix(group.column(5))
        sims = x @ x.T
        sims[part[:, None] == part[None, :]] = -2.0
        take = min(K, n - 1)
        best = np.argpartition(-sims, take - 1, axis=1)[:, :take]
        for k in range(n):
            for j in best[k]:
                if sims[k, j] > least[k]:
                    found.append((int(ids[k]), int(ids[j]), float(sims[k, j])))
        if len(found) > 50_000:
            yield _rows(found)
            found = []
    yield _rows(found)


def _tile_task(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            ids, tile, copies = (group.column(k).to_numpy() for k in (3, 4, 5))
            low, high = group.column(1)[0].as_py(), group.column(2)[0].as_py()
            x = _matrix(group.column(6))
            left = np.flatnonzero(tile == low)
            right = left if low == high else np.flatnonzero(tile == high)
            hit = x[left] @ x[right].T >= threshold
            if low == high:
                np.fill_diagonal(hit, False)
            count = np.zeros(len(ids), np.int64)
            np.add.at(count, left, hit @ copies[right])
            if low != high:
                np.add.at(count, right, hit.T @ copies[left])
            i, j = np.nonzero(hit)
            found = [(int(ids[k]), None, float(count[k])) for k in np.flatnonzero(count)]
            yield _rows(found + [(int(ids[a]), int(ids[b]), 1.0) for a, b in forest(len(ids), left[i], right[j])])

    return run


def _sign_task(seed: int):
    """Bits of the signs along random directions, ``TABLES`` numbers of ``MOST_BITS`` bits a vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(MOST_BITS, dtype=np.int64)
        for batch in batches:
            codes = []
            directions: dict[int, np.ndarray] = {}
            for v in batch.column(2).to_pylist():
                x = np.frombuffer(v, "<f8")
                if len(x) not in directions:
                    directions[len(x)] = np.random.default_rng([seed, len(x)]).standard_normal((TABLES * MOST_BITS, len(x)))
                signs = (directions[len(x)] @ (x / np.abs(x).max()) >= 0).reshape(TABLES, MOST_BITS)
                codes.append((signs * weights).sum(axis=1).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.list_(pa.int64()))], names=["id", "room", "codes"])

    return run


def _together(groups: DataFrame, vectors: DataFrame, lists: DataFrame | None) -> DataFrame:
    """(a, b, sim) of the partners of another ``part`` found in groups (g1, g2, id)."""
    rows = groups.join(vectors.select("id", "part", "vec"), "id")
    if lists is None:
        rows = rows.withColumn("least", F.lit(-2.0))
    else:
        floor = lists.groupBy(F.col("a").alias("id")).agg(F.when(F.count(F.lit(1)) >= K, F.min("sim")).otherwise(-2.0).alias("least"))
        rows = rows.join(floor, "id", "left").withColumn("least", F.coalesce("least", F.lit(-2.0)))
    rows = rows.select("g1", "g2", "id", "part", "least", "vec").repartition("g1", "g2").sortWithinPartitions("g1", "g2")
    return rows.mapInArrow(_meet_task, "a bigint, b bigint, sim double")


def _best(pairs: DataFrame) -> DataFrame:
    """The ``K`` most similar partners of each vector."""
    ranked = pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("a").orderBy(F.col("sim").desc(), "b")
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= K).drop("rank")


def _blocks(vectors: DataFrame, seed: int) -> DataFrame:
    """Groups (g1, g2, id): vectors of one label whose signs agree, in blocks of about ``BLOCK``."""
    sizes = vectors.groupBy("room").agg(F.count(F.lit(1)).alias("in_room"))
    bits = F.least(F.greatest(F.ceil(F.log2(F.col("in_room") / BLOCK)), F.lit(0)), F.lit(MOST_BITS)).cast("int")
    coded = vectors.select("id", "room", "vec").mapInArrow(_sign_task(seed), "id bigint, room string, codes array<bigint>").join(sizes, "room")
    each = coded.select("id", "room", bits.alias("bits"), F.posexplode("codes").alias("t", "code"))
    block = F.xxhash64("room", "t", F.expr("code % shiftleft(1L, bits)"))
    each = each.select("id", block.alias("g1"))
    count = each.groupBy("g1").agg(F.count(F.lit(1)).alias("size"))
    parts = F.ceil(F.col("size") / (2 * BLOCK))
    return each.join(count, "g1").select("g1", F.pmod(F.xxhash64("id", "g1", F.lit(seed)), parts).alias("g2"), "id")


def _around(lists: DataFrame, seed: int) -> DataFrame:
    """Groups (g1, g2, id): every vector with its neighbours, and with those that have it as one, in chunks by ``seed``.

    Only around vectors that a new list entry touches.
    """
    ends = [F.struct(F.col(g).alias("g1"), F.col(m).alias("id"), F.lit(own).alias("own"), "fresh") for g, m, own in (("a", "b", True), ("b", "a", False))]
    both = lists.select(F.inline(F.array(*ends)))
    degrees = both.groupBy("g1").agg(F.max("fresh").alias("touched"), F.count(F.when(~F.col("own"), 1)).alias("degree")).where("touched")
    met = both.drop("fresh").join(degrees.select("g1", F.greatest(F.ceil(F.col("degree") / (2 * K)), F.lit(1)).alias("n")), "g1")
    every = F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)
    chunks = F.when(F.col("own"), every).otherwise(F.array(F.pmod(F.xxhash64("id", F.lit(seed)), F.col("n"))))
    return met.select("g1", F.explode(chunks).alias("g2"), "id").repartition("g1", "g2").distinct()


def _descend(vectors: DataFrame, lists: DataFrame | None, seed: int, inner: DataFrame | None = None, unfilled: DataFrame | None = None) -> DataFrame:
    """Lists (a, b, sim) of the most similar partners of another ``part``; paths also lead over the lists ``inner``, and
    the vectors ``unfilled`` meet in blocks of their own as well."""
    groups = _blocks(vectors, seed)
    if unfilled is not None:
        groups = groups.unionByName(_blocks(unfilled, seed + 1_000_000))
    found = _together(groups, vectors, lists).withColumn("fresh", F.lit(True))
    if lists is not None:
        found = found.unionByName(lists.withColumn("fresh", F.lit(False)))
    lists = store(_best(found), "nn-lists")
    for step in range(ITERATIONS):
        paths = lists if inner is None else lists.unionByName(inner.withColumn("fresh", F.lit(False)))
        new = _together(_around(paths, seed * ITERATIONS + step), vectors, lists).withColumn("fresh", F.lit(True))
        lists = store(_best(new.unionByName(lists.withColumn("fresh", F.lit(False)))), "nn-lists")
        counts = lists.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("fresh"), 1)).alias("new")).first()
        if counts["new"] <= STEADY * max(1, counts["n"]):
            break
    return lists


def _saturated(lists: DataFrame, threshold: float) -> DataFrame:
    """id of the vectors whose list is full of links."""
    return lists.where(F.col("sim") >= threshold).groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= K).select("id")


def _enlarged(vectors: DataFrame, lists: DataFrame, threshold: float, seed: int) -> DataFrame:
    """Roots of the components of list links and of the links that saturated lists lack."""
    links = lists.where(F.col("sim") >= threshold).select("a", "b")
    full = vectors.drop("part").join(_saturated(lists, threshold), "id")
    while True:
        roots = components(links)
        open_ = full.join(roots.select(F.col("vertex").alias("id"), F.col("root").alias("part")), "id")
        several = open_.groupBy("room").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
        open_ = store(open_.join(several.select("room"), "room", "left_semi").select(*vectors.columns), "nn-saturated")
        if open_.isEmpty():
            return roots
        inner = lists.select("a", "b", "sim")
        for end in ("a", "b"):
            inner = inner.join(open_.select(F.col("id").alias(end)), end, "left_semi")
        across = _descend(open_, None, seed, store(inner.select("a", "b", "sim"), "nn-inner")).where(F.col("sim") >= threshold).select("a", "b")
        if across.isEmpty():
            return roots
        links = store(links.unionByName(across), "nn-across")
        seed += ROUNDS


def _linked(vectors: DataFrame, roots: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(id, others) and the roots of the components: links inside each of the parts ``roots``, compared in tiles."""
    member = roots.join(vectors.select(F.col("id").alias("vertex"), "copies"), "vertex")
    sizes = member.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    units = member.join(sizes, "root").select("root", "vertex", "copies", "tiles", F.pmod(F.xxhash64("vertex"), F.col("tiles")).cast("int").alias("tile"))
    units = units.select("root", "vertex", "copies", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    units = units.select("root", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), F.col("vertex").alias("id"), "tile", "copies")
    rows = units.join(vectors.select("id", "vec"), "id").select("root", "low", "high", "id", "tile", "copies", "vec")
    rows = rows.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
    found = store(rows.mapInArrow(_tile_task(threshold), "a bigint, b bigint, sim double"), "nn-links")
    counts = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("id")).agg(F.sum("sim").cast("bigint").alias("others"))
    return counts, components(found.where(F.col("b").isNotNull()).select("a", "b"))


def audit(vectors: DataFrame, counts: DataFrame, threshold: float, most: int = AUDIT) -> DataFrame:
    """room, recall: of every room, over at most ``most`` of its vectors, chosen by hash; half have few links as found.

    The lesser of the mean shares of links found: per vector that has links, and per vector that has at most ``K``; 1 in a
    room whose chosen vectors have none. The chosen vectors meet the others of their room in slices of about ``TILE``.
    """
    found = vectors.select("id", "room").join(counts, "id", "left").withColumn("others", F.coalesce("others", F.lit(0)))
    place = F.row_number().over(Window.partitionBy("room").orderBy(F.xxhash64("id", F.lit(11)), "id"))
    few = found.where(F.col("others") <= K).withColumn("place", place).where(F.col("place") <= most // 2)
    any_ = found.withColumn("place", place).where(F.col("place") <= most - most // 2)
    chosen = store(few.unionByName(any_).select("id", "others").distinct(), "nn-audited")

    sizes = vectors.groupBy("room").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("slices"))
    rows = vectors.select("id", "room", "copies", "vec").join(sizes, "room")
    low, high = F.lit(0).alias("low"), F.lit(1).alias("high")
    rest = rows.select("room", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int").alias("slice"), low, high, "id", F.lit(1).alias("tile"), "copies", "vec")
    slices = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    # chosen vectors under numbers of their own, below zero, beside themselves among the rest
    probes = rows.join(chosen.select("id"), "id", "left_semi").select("room", slices, low, high, (-F.col("id") - 1).alias("id"), F.lit(0).alias("tile"), "copies", "vec")
    group = F.concat_ws("/", "slice", "room").alias("group")
    met = probes.unionByName(rest).select(group, "low", "high", "id", "tile", "copies", "vec")
    met = met.repartition("group").sortWithinPartitions("group")
    hits = met.mapInArrow(_tile_task(threshold), "a bigint, b bigint, sim double").where(F.col("b").isNull() & (F.col("a") < 0))
    true = hits.groupBy((-F.col("a") - 1).alias("id")).agg(F.sum("sim").alias("met"))
    judged = chosen.join(true, "id").join(vectors.select("id", "room", "copies"), "id").withColumn("true", F.col("met") - F.col("copies"))
    share = F.least(F.lit(1.0), F.col("others") / F.col("true"))
    means = [F.avg(F.when(condition, share)) for condition in (F.col("true") > 0, (F.col("true") > 0) & (F.col("true") <= K))]
    return store(judged.groupBy("room").agg(F.coalesce(F.least(*means), F.lit(1.0)).alias("recall")), "nn-audit")


def _rest_whole(vectors: DataFrame, roots: DataFrame, passed: DataFrame) -> DataFrame:
    """Roots, with every room that is not in ``passed`` as one part."""
    rest = vectors.join(passed, "room", "left_anti")
    whole = rest.join(rest.groupBy("room").agg(F.min("id").alias("root")), "room").select(F.col("id").alias("vertex"), "root")
    return whole.unionByName(roots.join(whole, "vertex", "left_anti").select("vertex", "root"))


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """key, n_links (other rows linked directly), component (smallest key reachable by links): one row per input row."""
    slim = rows.select(F.col(key).alias("key"), F.col(label).cast("string").alias("label"), F.col(vector).alias("v"))
    kind = rows.schema[key].dataType.simpleString()
    every = store(slim.mapInArrow(_valid_task, f"key {kind}, label string, vec binary").withColumn("room", F.when(F.col("vec").isNotNull(), F.concat("label", F.lit("/"), F.octet_length("vec").cast("string")))), "nn-rows")
    classes = every.where(F.col("room").isNotNull()).groupBy("room", "vec").agg(F.min("key").alias("low"), F.count(F.lit(1)).alias("copies"))
    vectors = store(classes.withColumn("id", F.monotonically_increasing_id()).withColumn("part", F.col("id")), "nn-classes")
    lists = unfilled = None
    for k in range(ROUNDS):
        lists = _descend(vectors, lists, k + 1, unfilled=unfilled)
        joined = _enlarged(vectors, lists, threshold, k + 1)
        counts, roots = _linked(vectors, joined, threshold)
        counts = store(counts, "nn-counts")
        recall = audit(vectors, counts, threshold)
        if recall.where(F.col("recall") < RECALL).isEmpty():
            break
        unfilled = vectors.join(_saturated(lists, threshold), "id", "left_anti")
    else:
        passed = recall.where(F.col("recall") >= RECALL).select("room")
        counts, roots = _linked(vectors, _rest_whole(vectors, joined, passed), threshold)
        counts = store(counts, "nn-counts")
    group = vectors.join(roots.select(F.col("vertex").alias("id"), "root"), "id", "left").join(counts, "id", "left")
    group = group.select("room", "vec", "low", F.coalesce("root", "id").alias("root"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    heads = group.groupBy("root").agg(F.min("low").alias("component"))
    group = group.join(heads, "root").select("room", "vec", "n_links", "component")
    found = every.join(group, ["room", "vec"], "left")
    return found.select("key", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component", "key").alias("component"))
