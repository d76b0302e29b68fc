"""Gradient-boosted regression trees, grown best leaf first from distributed histograms.

Features are cut into at most 256 bins once. A tree then needs, for a node, the sum of gradients and the number of rows per
feature and bin. A tree takes the bins and gradients of its sampled rows as blocks of arrays once. One job over the
blocks sums for many nodes at a time: tasks route their rows down the tree so far and count, one shuffle adds the counts
up by feature, and every feature finds its best splits. Only the smaller child of a split is counted; its sibling is the
parent less that, whose counts lie in the same partition. What reaches the driver is one candidate split per node and
feature. These jobs are RDD jobs of two stages: they are short, and planning and storing each cost more than its counting.

Best first means that the open leaf of largest gain is split next until ``max_leaves``. A job per split would be too many,
so each job looks ahead: it counts the children of all open nodes that may still be split, the driver then splits as far
as the known nodes reach, and the next job goes on from there. Nodes of up to ``NEAR`` rows are not counted level by
level: when only they are open, one job deals their rows out, a task a node, and each task grows all that may come below
its node. Sums are integers, so the tree is the same as one grown a leaf at a time.

Gradients are summed as integers (scaled by a power of two that leaves room for all rows), so sums do not depend on
how rows are dealt out, and trees repeat exactly. Each round goes on from the stored predictions of the one before: a round
costs the same however many came earlier, and training can stop and be resumed with the same trees as in one run. The
rows with their predictions are written to the checkpoint folder every ``CUT`` rounds.
"""

from __future__ import annotations

import heapq
import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ripecast import constants as K
from ripecast.operators import encoding
from ripecast.session import checkpoint_dir
from ripecast.sources import files

BINS = 256
CUT = 10
MISSING = -1.0
ENCODED = [f"{c}_mean" for c in K.CATEGORICAL_FEATURES]
INPUTS = [*K.NUMERIC_FEATURES, *ENCODED]
_STATE = "id bigint, y double, is_valid boolean, bins binary, margin double"
_BLOCK = "gradient binary, bins binary"
# tasks beyond this many are added up in groups before the last step
FAN = 64
# a node of at most this many rows (about 50 bytes each) is grown in one task
NEAR = 1 << 19
# rows whose integer gradients, below 2^36 each, sum up exactly in a double
EXACT = 1 << 16


@dataclass(frozen=True)
class Params:
    """``max_depth`` 0 is no limit; ``patience`` rounds without a better valid error end training, None never does."""

    rounds: int = 100
    step: float = 0.1
    max_leaves: int = 255
    max_depth: int = 0
    min_rows: int = 1
    smoothing: float = 0.0
    row_share: float = 1.0
    feature_share: float = 1.0
    bins: int = 255
    patience: int | None = None
    seed: int = 42


# The two known parameter sets of the single-machine trainers.
PRESETS = {
    "histogram": Params(1000, 0.3, 256, 8, 1, 1.0, 0.8, 0.8, 256, 50),
    "leafwise": Params(800, 0.08, 255, 0, 64, 0.0, 0.8, 0.8, 255, 100),
}


@dataclass(frozen=True)
class Tree:
    """Nodes in arrays; node 0 is the root, feature -1 a leaf. A row goes left where its bin is at most ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray


def route(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The leaf of every row; ``cut`` is compared with bins, or holds thresholds for raw values."""
    node = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while len(rows):
        at = node[rows]
        rows = rows[feature[at] >= 0]
        at = node[rows]
        node[rows] = np.where(x[rows, feature[at]] <= cut[at], left[at], right[at])
    return node


def bins_of(x: np.ndarray, thresholds: Sequence[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(t, x[:, k], "left") for k, t in enumerate(thresholds)]).astype(np.uint8)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), width)


def _bins(batch: pa.RecordBatch, width: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("bins"))
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].reshape(len(column), width) if len(column) else np.zeros((0, width), np.uint8)


def thresholds_of(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Cut points of every feature: its quantiles over the training rows, equal ones once; at most ``bins`` - 1."""
    shares = [k / bins for k in range(1, bins)]
    cuts = rows.agg(*[F.percentile_approx(F.col("x")[k], shares, 20 * bins).alias(f"q{k}") for k in range(width)]).first()
    return [np.unique(np.array(cuts[k] if cuts[k] is not None else [0.0], float)) for k in range(width)]


def _sampled(ids: np.ndarray, seed: int, share: float) -> np.ndarray:
    x = ids.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) < np.uint64(min(int(share * 2.0**64), (1 << 64) - 1))


def _block_task(width: int, scale: float, seed: int, share: float):
    """Integer gradients and bins of the training rows that this round samples, a row per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, margin = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("y", "margin"))
            used = ~np.asarray(batch.column(batch.schema.get_field_index("is_valid")))
            if share < 1.0:
                used &= _sampled(np.asarray(batch.column(batch.schema.get_field_index("id"))), seed, share)
            parts = [np.rint((y - margin)[used] * scale), _bins(batch, width)[used]]
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in parts], names=["gradient", "bins"])

    return run


def _unpacked(width: int):
    return lambda row: (np.frombuffer(row["gradient"]), np.frombuffer(row["bins"], np.uint8).reshape(-1, width))


def _count_task(tree: tuple, slots: dict[int, int], features: list[int]):
    """(place of the feature, histograms of the nodes in ``slots``, one after the other) over the blocks of a task."""

    def run(blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
        size = len(slots) * BINS
        g, n = np.zeros((len(features), size), np.int64), np.zeros((len(features), size), np.int64)
        place = np.full(len(tree[0]), -1)
        place[list(slots)] = list(slots.values())
        for gradient, x in blocks:
            slot = place[route(*tree, x)]
            hit = np.flatnonzero(slot >= 0)
            gradient, base, x = gradient[hit], slot[hit] * BINS, x[hit]
            for k, f in enumerate(features):
                at = base + x[:, f]
                g[k] += np.bincount(at, gradient, size).astype(np.int64)
                n[k] += np.bincount(at, minlength=size)
        for k in range(len(features)):
            yield k, (g[k], n[k])

    return run


def best_cuts(g: np.ndarray, n: np.ndarray, scale: float, min_rows: int, smoothing: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, bin and left rows of the best split of each histogram (a row of ``g`` and ``n``); gain 0 where there is none."""
    left_g, left_n = np.cumsum(g, 1), np.cumsum(n, 1)
    all_g, all_n = left_g[:, -1:], left_n[:, -1:]
    right_g, right_n = all_g - left_g, all_n - left_n
    score = lambda a, b: (a / scale) ** 2 / np.maximum(b + smoothing, 1e-12)
    allowed = (left_n >= max(min_rows, 1)) & (right_n >= max(min_rows, 1))
    gain = np.where(allowed, score(left_g, left_n) + score(right_g, right_n) - score(all_g, all_n), 0.0)
    at = gain.argmax(1)
    rows = np.arange(len(g))
    return np.maximum(gain[rows, at], 0.0), at, left_n[rows, at]


def _sum(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return a[0] + b[0], a[1] + b[1]


# partition functions; one object each, since partitions are told to agree by it
def _by_feature(key: int) -> int:
    return key


def _by_group(key: tuple[int, int]) -> int:
    return key[0] * FAN + key[1]


def _added_up(counts: RDD, tasks: int) -> RDD:
    """The sums by feature, in ``tasks`` partitions."""
    if counts.getNumPartitions() > 2 * FAN:
        dealt = counts.mapPartitionsWithIndex(lambda part, rows: (((k, part % FAN), v) for k, v in rows))
        counts = dealt.reduceByKey(_sum, FAN * tasks, _by_group).map(lambda row: (row[0][0], row[1]))
    return counts.reduceByKey(_sum, tasks, _by_feature)


def _split_task(parents: list[tuple[int, int]], scale: float, min_rows: int, smoothing: float):
    """Per feature: sums of the counted nodes (job -1); siblings are the parents, found by job and place, less those.

    Returns the histograms of all counted nodes, then of their siblings, with their best splits.
    """

    def run(rows: Iterator[tuple[int, tuple[int, np.ndarray, np.ndarray]]]) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray, tuple]]]:
        by_feature: dict[int, dict[int, tuple[np.ndarray, np.ndarray]]] = {}
        for feature, (job, g, n) in rows:
            by_feature.setdefault(feature, {})[job] = (g.reshape(-1, BINS), n.reshape(-1, BINS))
        for feature, kept in by_feature.items():
            g, n = kept[-1]
            if parents:
                above = [np.stack([kept[j][c][at] for j, at in parents]) for c in (0, 1)]
                g, n = np.concatenate([g, above[0] - g]), np.concatenate([n, above[1] - n])
            yield feature, (g, n, (*best_cuts(g, n, scale, min_rows, smoothing), g.sum(1), n.sum(1)))

    return run


def _as_job(job: int):
    return lambda found: (job, found[0], found[1])


@dataclass
class Node:
    """A node that has been counted: totals, and its best split with the numbers of its children once they are known."""

    depth: int
    g: int
    n: int
    gain: float
    feature: int
    cut: int
    left_n: int
    children: tuple[int, int] | None = None


def first_leaves(nodes: dict[int, Node], params: Params) -> tuple[list[int], list[int]]:
    """The nodes that best-first growth splits, in order, and which of them have unknown children.

    Unknown children are taken for leaves. Others would come earlier with them, not later, so a node that is not returned
    is not split in the end.
    """
    order, leaves = [], 1
    heap = [(-nodes[0].gain, 0)]
    while heap and leaves < params.max_leaves:
        gain, k = heapq.heappop(heap)
        if gain >= 0 or (params.max_depth and nodes[k].depth >= params.max_depth):
            continue
        order.append(k)
        leaves += 1
        for c in nodes[k].children or ():
            heapq.heappush(heap, (-nodes[c].gain, c))
    return order, [k for k in order if nodes[k].children is None]


def _counts(gradient: np.ndarray, columns: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The histograms of every feature over some rows, as ``_count_task`` sums them."""
    g, n = (np.zeros((len(columns), BINS), np.int64) for _ in range(2))
    for start in range(0, len(rows), EXACT):
        at = rows[start : start + EXACT]
        weight = gradient[at]
        for k, column in enumerate(columns):
            bins = column[at]
            g[k] += np.bincount(bins, weight, BINS).astype(np.int64)
            n[k] += np.bincount(bins, minlength=BINS)
    return g, n


def subtree(gradient: np.ndarray, x: np.ndarray, features: list[int], depth: int, params: Params, scale: float) -> list[Node]:
    """A node over these rows, and all below it that a tree of ``max_leaves`` may have; children are places in the list."""
    columns, whole = np.ascontiguousarray(x[:, features].T), gradient.astype(np.int64)
    nodes, open_, heap = [], {}, []

    def splits(depth: int, n: int) -> bool:
        return n >= 2 * max(params.min_rows, 1) and not (params.max_depth and depth >= params.max_depth)

    def add(depth: int, rows: np.ndarray, counts: tuple[np.ndarray, np.ndarray] | None) -> int:
        found = (0.0, 0, 0, 0)
        if splits(depth, len(rows)):
            gain, cut, left_n = best_cuts(*counts, scale, params.min_rows, params.smoothing)
            f = int(gain.argmax())
            found = float(gain[f]), features[f], int(cut[f]), int(left_n[f])
            open_[len(nodes)] = f, rows, counts
            heapq.heappush(heap, (-found[0], len(nodes)))
        nodes.append(Node(depth, int(whole[rows].sum()), len(rows), *found))
        return len(nodes) - 1

    rows = np.arange(len(gradient))
    add(depth, rows, _counts(gradient, columns, rows))
    leaves = 1
    while heap and leaves < params.max_leaves:
        gain, k = heapq.heappop(heap)
        if gain >= 0:
            break
        f, rows, counts = open_.pop(k)
        goes_left = columns[f][rows] <= nodes[k].cut
        parts, below, sums = (rows[goes_left], rows[~goes_left]), nodes[k].depth + 1, (None, None)
        if splits(below, max(map(len, parts))):
            less = int(len(parts[0]) > len(parts[1]))
            small = _counts(gradient, columns, parts[less])
            large = counts[0] - small[0], counts[1] - small[1]
            sums = (large, small) if less else (small, large)
        nodes[k].children = tuple(add(below, part, sums[side]) for side, part in enumerate(parts))
        leaves += 1
    return nodes


def _deal_task(tree: tuple, slots: dict[int, int]):
    """(slot, gradients and bins of its rows) of the nodes in ``slots``, in pieces of some blocks."""

    def run(blocks: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
        place = np.full(len(tree[0]), -1)
        place[list(slots)] = list(slots.values())
        held: list[tuple[np.ndarray, ...]] = []

        def pieces():
            slot, gradient, x = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(slot, kind="stable")
            kinds, starts = np.unique(slot[order], return_index=True)
            for s, at in zip(kinds.tolist(), np.split(order, starts[1:])):
                if s >= 0:
                    yield s, (gradient[at], x[at])

        for gradient, x in blocks:
            held.append((place[route(*tree, x)], gradient, x))
            if sum(len(slot) for slot, _, _ in held) >= NEAR:
                yield from pieces()
                held.clear()
        if held:
            yield from pieces()

    return run


def _grow_task(depths: list[int], features: list[int], params: Params, scale: float):
    """(slot, nodes of its subtree) for the one slot whose rows a task gets."""

    def run(rows: Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[int, list[Node]]]:
        by_slot: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for slot, piece in rows:
            by_slot.setdefault(slot, []).append(piece)
        for slot, pieces in by_slot.items():
            gradient, x = (np.concatenate(c) for c in zip(*pieces))
            yield slot, subtree(gradient, x, features, depths[slot], params, scale)

    return run


def _arrays(nodes: dict[int, Node], split: set[int]) -> tuple[np.ndarray, ...]:
    """feature, cut, left, right of a tree in which only ``split`` nodes are split."""
    size = max(nodes) + 1
    feature, cut, left, right = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    for k in split:
        node = nodes[k]
        feature[k], cut[k] = node.feature, node.cut
        left[k], right[k] = node.children
    return feature, cut, left, right


def grow(state: DataFrame, params: Params, round_: int, width: int, scale: float, rows: int | None = None) -> Tree:
    """One tree on the gradients of ``state``, step size included in its values.

    ``rows`` is the number of training rows, where it is known; a tree of few rows is then grown by a single job.
    """
    rng = np.random.default_rng((params.seed, round_))
    features = sorted(rng.permutation(width)[: max(1, round(width * params.feature_share))].tolist())
    nodes: dict[int, Node] = {}
    held: list[RDD] = []
    where: dict[int, tuple[int, int]] = {}
    tasks = min(len(features), state.sparkSession.sparkContext.defaultParallelism)
    block = _block_task(width, scale, params.seed * 1_000_003 + round_, params.row_share)
    blocks = state.mapInArrow(block, _BLOCK).rdd.map(_unpacked(width))

    def splits_to(known: dict[int, Node]) -> tuple:
        return _arrays(known, {k for k, n in known.items() if n.children})

    def count(depth: dict[int, int], counted: list[int], siblings: list[int], above: list[int]) -> None:
        """Adds the nodes in ``depth``; ``above`` are the parents of the counted ones and their siblings."""
        tree = splits_to({**nodes, **{k: Node(d, 0, 0, 0.0, 0, 0, 0) for k, d in depth.items()}})
        slots = {k: s for s, k in enumerate(counted)}
        parts = _added_up(blocks.mapPartitions(_count_task(tree, slots, features)), tasks).mapValues(lambda sums: (-1, *sums))
        parents = [where[k] for k in above]
        # partitioned alike, so that no histogram moves again
        for j in sorted({j for j, _ in parents}):
            parts = parts.union(held[j].mapValues(_as_job(j)))
        found = parts.mapPartitions(_split_task(parents, scale, params.min_rows, params.smoothing), True)
        held.append(found.persist(StorageLevel.MEMORY_AND_DISK))
        splits = [split for _, split in sorted(found.mapValues(lambda v: v[2]).collect(), key=lambda row: row[0])]
        gain, cut, left_n, all_g, all_n = (np.stack(column) for column in zip(*splits))
        for at, k in enumerate([*counted, *siblings]):
            f = int(gain[:, at].argmax())
            nodes[k] = Node(depth[k], int(all_g[0, at]), int(all_n[0, at]), float(gain[f, at]), features[f], int(cut[f, at]), int(left_n[f, at]))
            where[k] = (len(held) - 1, at)

    def finish(near: list[int]) -> None:
        """Adds all nodes below ``near``, each grown in a task of its own."""
        dealt = blocks.mapPartitions(_deal_task(splits_to(nodes), {k: s for s, k in enumerate(near)})).partitionBy(len(near), _by_feature)
        found = dict(dealt.mapPartitions(_grow_task([nodes[k].depth for k in near], features, params, scale)).collect())
        for slot, k in enumerate(near):
            below = found[slot] if slot in found else subtree(np.zeros(0), np.zeros((0, width), np.uint8), features, nodes[k].depth, params, scale)
            first = len(nodes)
            number = lambda at: first + at - 1 if at else k  # noqa: B023, E731
            for at, node in enumerate(below):
                nodes[number(at)] = replace(node, children=node.children and tuple(map(number, node.children)))

    try:
        if rows is not None and rows <= NEAR:
            nodes[0], unknown = Node(0, 0, rows, 0.0, 0, 0, 0), [0]
        else:
            blocks.persist(StorageLevel.MEMORY_AND_DISK)
            count({0: 0}, [0], [], [])
            _, unknown = first_leaves(nodes, params)
        while above := sorted((k for k in unknown if nodes[k].n > NEAR), key=lambda k: (-nodes[k].gain, k)):
            depth, counted, siblings = {}, [], []
            for k in above:
                a = len(nodes) + len(depth)
                nodes[k].children = (a, a + 1)
                depth[a] = depth[a + 1] = nodes[k].depth + 1
                less, more = (a, a + 1) if 2 * nodes[k].left_n <= nodes[k].n else (a + 1, a)
                counted.append(less)
                siblings.append(more)
            count(depth, counted, siblings, above)
            _, unknown = first_leaves(nodes, params)
        if unknown:
            finish(unknown)
        order, _ = first_leaves(nodes, params)
    finally:
        for kept in (blocks, *held):
            kept.unpersist()
    return _tree(nodes, order, params, scale)


def _tree(nodes: dict[int, Node], order: list[int], params: Params, scale: float) -> Tree:
    number, split = {0: 0}, set(order)
    for k in order:
        for c in nodes[k].children:
            number[c] = len(number)
    size = len(number)
    out = Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size), np.zeros(size), np.zeros(size, np.int64))
    for k, at in number.items():
        node = nodes[k]
        out.rows[at] = node.n
        if k in split:
            out.feature[at], out.cut[at], out.gain[at] = node.feature, node.cut, node.gain
            out.left[at], out.right[at] = (number[c] for c in node.children)
        elif node.n:
            out.value[at] = params.step * (node.g / scale) / (node.n + params.smoothing)
    return out


def _add_task(trees: list[Tree], width: int, base: float | None):
    """Adds the values of ``trees`` to the margins, one after the other; ``base`` starts them anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, at = _bins(batch, width), batch.schema.get_field_index("margin")
            margin = np.array(batch.column(at)) if base is None else np.full(len(x), base)
            for t in trees:
                margin = margin + t.value[route(t.feature, t.cut, t.left, t.right, x)]
            yield pa.RecordBatch.from_arrays([pa.array(margin) if k == at else c for k, c in enumerate(batch.columns)], names=batch.schema.names)

    return run


@dataclass
class Booster:
    """A fitted ensemble with the cut points of its features and the encodings of its categories."""

    params: Params
    base: float
    thresholds: list[np.ndarray]
    encodings: dict[str, encoding.Encoding]
    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)

    @property
    def best(self) -> int:
        """How many trees are kept: up to the lowest valid error, all where there were no valid rows."""
        return int(np.argmin(self.errors)) + 1 if self.errors else len(self.trees)

    # --- scoring, in the form that a policy sweep uses

    def prepare(self, df: DataFrame) -> DataFrame:
        """Add the model's own input columns beside the untouched ones."""
        own = [c for c in K.NUMERIC_FEATURES if c in df.columns and c not in ("effective_price", "discount_pct")]
        df = df.withColumns({f"_in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in own})
        for c, e in self.encodings.items():
            df = e.encode(df, c, f"_in_{c}_mean")
        return df

    def score(self, df: DataFrame, price: str, discount: str, output: str) -> DataFrame:
        chosen = {"effective_price": price, "discount_pct": discount}
        inputs = [F.coalesce(F.col(chosen[c]).cast("double"), F.lit(MISSING)) if c in chosen else F.col(f"_in_{c}") for c in INPUTS]
        return df.withColumn(output, self._udf(df.sparkSession)(F.array(*inputs)))

    def finish(self, df: DataFrame) -> DataFrame:
        return df.drop(*[c for c in df.columns if c.startswith("_in_")])

    def _udf(self, spark: SparkSession):
        width, base = len(INPUTS), self.base
        trees = [(t.feature, self._raw_cuts(t), t.left, t.right, t.value) for t in self.trees[: self.best]]
        sent = spark.sparkContext.broadcast(trees)

        @F.arrow_udf("double")
        def predicted(x: pa.Array) -> pa.Array:
            rows = _matrix(x, width)
            out = np.full(len(rows), base)
            for feature, cut, left, right, value in sent.value:
                out = out + value[route(feature, cut, left, right, rows)]
            return pa.array(out, pa.float64())

        return predicted

    def _raw_cuts(self, t: Tree) -> np.ndarray:
        """Thresholds in place of bins; a cut at the last bin lets every value through."""
        return np.array([self.thresholds[f][c] if f >= 0 and c < len(self.thresholds[f]) else np.inf for f, c in zip(t.feature, t.cut)])

    # --- the trees as a table

    def nodes(self, spark: SparkSession) -> DataFrame:
        """tree, node, feature, threshold, left_child, right_child, value, gain, n_rows of every kept node."""
        rows = []
        for i, t in enumerate(self.trees[: self.best]):
            for k, cut in enumerate(self._raw_cuts(t)):
                inner = t.feature[k] >= 0
                rows.append(
                    (i, k, INPUTS[t.feature[k]] if inner else None, float(cut) if inner else None, int(t.left[k]) if inner else None,
                     int(t.right[k]) if inner else None, float(t.value[k]), float(t.gain[k]), int(t.rows[k]))
                )
        return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, left_child int, right_child int, value double, gain double, n_rows long")

    def save(self, spark: SparkSession, path: str) -> None:
        """Trees, encodings and what a resumed training needs."""
        plain = lambda t: {k: v.tolist() for k, v in vars(t).items()}
        means = {c: {str(k): v for k, v in e.means.items()} for c, e in self.encodings.items()}
        meta = {"params": asdict(self.params), "base": self.base, "thresholds": [t.tolist() for t in self.thresholds], "errors": self.errors, "means": means}
        for c, e in self.encodings.items():
            e.table.write.mode("overwrite").parquet(f"{path}/encodings/{c}")
        rows = [(i, json.dumps(plain(t))) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, "tree int, arrays string").write.mode("overwrite").parquet(f"{path}/trees")
        files.write_text(spark, f"{path}/model.json", json.dumps(meta))

    @staticmethod
    def load(spark: SparkSession, path: str) -> Booster:
        meta = json.loads(files.load(spark, f"{path}/model.json"))
        encodings = {}
        for c, means in meta["means"].items():
            encodings[c] = encoding.Encoding(spark.read.parquet(f"{path}/encodings/{c}"), {int(k): v for k, v in means.items()})
        kinds = {"value": float, "gain": float}
        trees = [Tree(**{k: np.array(v, kinds.get(k, np.int64)) for k, v in json.loads(r["arrays"]).items()}) for r in spark.read.parquet(f"{path}/trees").orderBy("tree").collect()]
        return Booster(Params(**meta["params"]), meta["base"], [np.array(t) for t in meta["thresholds"]], encodings, trees, meta["errors"])


def _scratch(spark: SparkSession, name: str) -> str:
    folder = checkpoint_dir(spark)
    if not folder:
        raise ValueError("training needs a shared folder in spark.checkpoint.dir")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _stored(df: DataFrame, name: str, schema: str | StructType, paths: list[str] | None = None) -> DataFrame:
    path = _scratch(df.sparkSession, name)
    df.write.parquet(path)
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def inputs(split: DataFrame, encodings: dict[str, encoding.Encoding] | None, paths: list[str]) -> tuple[DataFrame, dict[str, encoding.Encoding]]:
    """id, y, is_valid and the feature array x of the train and valid rows; encodings are fitted where none are given.

    Fitting reads the rows several times, so they are stored first, under a path that is added to ``paths``.
    """
    rows = split.where(F.col("split").isin("train", "valid") & F.col(K.LABEL).isNotNull())
    fold = encoding.fold_of(*K.KEYS)
    rows = rows.select(
        F.xxhash64(*K.KEYS).alias("_id"),
        *K.NUMERIC_FEATURES,
        *K.CATEGORICAL_FEATURES,
        F.col(K.LABEL).cast("double").alias("_y"),
        (F.col("split") == "valid").alias("_is_valid"),
        F.when(F.col("split") == "train", fold).otherwise(encoding.ALL).alias("_fold"),
    )
    if encodings is None:
        rows = _stored(rows, "boosting-inputs", rows.schema, paths)
        train = rows.where(~F.col("_is_valid"))
        encodings = {c: encoding.fit(train, c, "_y", "_fold") for c in K.CATEGORICAL_FEATURES}
        for c, e in encodings.items():
            encodings[c] = replace(e, table=_stored(e.table, f"encoding-{c}", "value string, slot int, encoded double"))
    for c, e in encodings.items():
        rows = e.encode(rows, c, f"_{c}_mean", F.col("_fold"))
    numbers = [F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in K.NUMERIC_FEATURES]
    x = F.array(*numbers, *[F.col(f"_{c}") for c in ENCODED])
    return rows.select(F.col("_id").alias("id"), F.col("_y").alias("y"), F.col("_is_valid").alias("is_valid"), x.alias("x")), encodings


def _binned(rows: DataFrame, thresholds: list[np.ndarray], base: float) -> DataFrame:
    width = len(thresholds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = bins_of(_matrix(batch.column(3), width), thresholds)
            packed = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed, pa.array(np.full(len(x), base))], names=["id", "y", "is_valid", "bins", "margin"])

    return rows.mapInArrow(run, _STATE)


def _progress(state: DataFrame) -> tuple[float, float | None, int]:
    """Largest training error, mean squared valid error (None without valid rows), training rows."""
    error = F.col("y") - F.col("margin")
    train, valid = F.when(~F.col("is_valid"), F.abs(error)), F.when(F.col("is_valid"), error * error)
    r = state.agg(F.max(train).alias("most"), F.avg(valid).alias("valid"), F.count(train).alias("n")).first()
    return r["most"] or 0.0, r["valid"], r["n"]


def scale_for(most: float, n: int) -> float:
    """A power of two by which gradients become integers whose sums over ``n`` rows fit a long, and over a batch a double."""
    room = min(36, 61 - max(n, 1).bit_length())
    return 2.0 ** (room - int(np.ceil(np.log2(most)))) if most > 0 else 1.0


def train(split: DataFrame, preset: str | Params = "leafwise", resume: Booster | None = None, **overrides) -> Booster:
    """Fit on the train rows of ``split``; valid rows decide when to stop and how many trees to keep.

    With ``resume`` training goes on from that model, with its cut points and encodings, up to the rounds asked for; the
    trees are those of one run over the same rows.
    """
    params = replace(PRESETS[preset] if isinstance(preset, str) else preset, **overrides)
    if not checkpoint_dir(split.sparkSession):
        raise ValueError("training needs a shared folder in spark.checkpoint.dir")
    spark, width, paths = split.sparkSession, len(INPUTS), []
    state = None
    try:
        rows, encodings = inputs(split, resume.encodings if resume else None, paths)
        rows = _stored(rows, "boosting-rows", "id bigint, y double, is_valid boolean, x array<double>", paths)
        if resume:
            model = replace(resume, params=params, trees=list(resume.trees), errors=list(resume.errors))
        else:
            fit = rows.where(~F.col("is_valid"))
            base = fit.agg(F.avg("y")).first()[0]
            if base is None:
                raise ValueError("no training rows with a label")
            model = Booster(params, float(base), thresholds_of(fit, width, min(params.bins, BINS)), encodings)
        binned = _stored(_binned(rows, model.thresholds, model.base), "boosting-state", _STATE, paths)
        state = binned.mapInArrow(_add_task(model.trees, width, model.base), _STATE) if model.trees else binned
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        most, _, n = _progress(state)
        while len(model.trees) < params.rounds and not _stopped(model.errors, params.patience):
            tree = grow(state, params, len(model.trees), width, scale_for(most, n), n)
            after = state.mapInArrow(_add_task([tree], width, None), _STATE)
            cut = (len(model.trees) + 1) % CUT == 0
            if cut:
                after = _stored(after, "boosting-state", _STATE, paths)
            after = after.persist(StorageLevel.MEMORY_AND_DISK)
            most, error, _ = _progress(after)
            state.unpersist()
            state = after
            if cut:
                for path in paths[:-1]:
                    files.remove(spark, path)
                del paths[:-1]
            model.trees.append(tree)
            if error is not None:
                model.errors.append(error)
    finally:
        if state is not None:
            state.unpersist()
        for path in paths:
            files.remove(spark, path)
    return model


def _stopped(errors: list[float], patience: int | None) -> bool:
    return patience is not None and bool(errors) and len(errors) - (int(np.argmin(errors)) + 1) >= patience


def predict(model: Booster, df: DataFrame) -> DataFrame:
    """The input columns plus predicted_unit_sales."""
    return model.finish(model.score(model.prepare(df), "effective_price", "discount_pct", "predicted_unit_sales"))


def importance(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """feature, importance (share of the gain), gain, weight (number of splits) and cover (rows split), from a node table."""
    spark = nodes.sparkSession
    found = nodes.where(F.col("feature").isNotNull()).groupBy("feature")
    found = found.agg(F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("weight"), F.sum("n_rows").cast("double").alias("cover"))
    every = spark.createDataFrame([(n,) for n in names], "feature string").join(found, "feature", "left").fillna({"gain": 0.0, "weight": 0, "cover": 0.0})
    total = found.agg(F.sum("gain").alias("gain")).select("gain").scalar()
    return every.select("feature", F.coalesce(F.try_divide(F.col("gain"), total), F.lit(0.0)).alias("importance"), "gain", "weight", "cover")
