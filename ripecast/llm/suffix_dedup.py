"""Repeated byte strings, removed wherever they occur a second time, by a distributed difference cover.

Two equal strings of ``LENGTH`` bytes start at any two positions. A difference cover of period ``PERIOD`` is a small set
of residues such that both positions reach a sampled one after the same number of steps, less than a period. So the
blocks of ``BLOCK`` bytes at sampled positions (an eighth of all) show every repeat:

1. Texts are dealt into cells of about ``CELL`` bytes. Each cell names its sampled blocks by hash, sorts the names and
   sends each once.
2. Names are sorted across cells; those seen in two cells or twice in one are repeated. Each cell gets one bit per name
   back. Strings are only ``LENGTH`` long, so block and remainder end the recursion on names after one level.
3. The suffixes that start up to a period before a repeated block are merged: each run of them whose strings share their
   smallest hash of ``ANCHOR`` bytes travels as one piece of text to the place of that hash, is sorted there, and neighbours are compared
   byte for byte. Within a cell repeats are settled first, so a very common passage travels once per cell.
4. Starts of strings that are not the first of their kind come back to their cell, which removes the bytes they cover.

Order: a smaller id is earlier, then the smaller offset. Strings are judged on the input. Texts cross one exchange,
whose output serves all three steps that need them.

Defined results: a null text is empty; a null id comes last, null ids in the order of a hash of their texts; rows that
repeat an id are separate documents, in the order of a hash of their texts (equal rows are interchangeable); matches
never cross documents; other columns are not read; an empty table gives an empty result. Texts of any length are
compared whole; a cell holds at least one whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripecast.llm import spans
from ripecast.llm.common import as_text

LENGTH = 100
PERIOD = 57
# Every residue modulo 57 is a difference of two of these.
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
BLOCK = LENGTH - PERIOD + 1
ANCHOR = 24
CELL = 1 << 20
MOST_CELL = 64 << 20
_CHUNK = 4 << 20


class Cell:
    """The texts of one cell in order, one behind another."""

    def __init__(self, table: pa.Table):
        ids, ties = table.column("id").to_pylist(), table.column("tie").to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, ties[k]))
        table = table.take(pa.array(order, pa.int64()))
        self.ids = table.column("id")
        self.ties = table.column("tie")
        ((_, _, self.data, self.offsets),) = spans.slices(table.column("text"), 1 << 62)

    def locate(self) -> Cell:
        """Adds for every byte its text, its place in it and the bytes from there on, and the hashes."""
        self.owner = np.repeat(np.arange(len(self.ids)), np.diff(self.offsets))
        self.at = np.arange(len(self.data)) - self.offsets[self.owner]
        self.left = np.diff(self.offsets)[self.owner] - self.at
        self.hasher = spans.Hasher(self.data)
        return self

    def names(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sampled positions, and for each the bucket and the rest of its name; the order that sorts them."""
        sampled = np.isin(np.arange(PERIOD), COVER)
        where = np.flatnonzero(sampled[self.at % PERIOD] & (self.left >= BLOCK))
        name = self.hasher.of(where, where + BLOCK)
        bucket = (name % np.uint64(buckets)).astype(np.int64)
        rest = ((name // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return where, bucket, rest, np.lexsort((rest, bucket))


def _distinct(bucket: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Along sorted names: whether a name is new, and the number of its distinct name."""
    new = np.ones(len(rest), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (rest[1:] != rest[:-1])
    return new, np.cumsum(new) - 1


def _name_task(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        cell = Cell(table).locate()
        _, bucket, rest, order = cell.names(buckets)
        bucket, rest = bucket[order], rest[order]
        new, _ = _distinct(bucket, rest)
        bucket, rest = bucket[new], rest[new]
        used, start = np.unique(bucket, return_index=True)
        ends = [*start[1:], len(bucket)]
        blobs = [rest[a:b].astype("<u4").tobytes() for a, b in zip(start, ends)]
        mine = table.column("cell")[0].as_py()
        return pa.table({"bucket": pa.array(used, pa.int64()), "cell": pa.array([mine] * len(used), pa.int64()), "names": pa.array(blobs, pa.binary())})

    return run


def _repeat_task(table: pa.Table) -> pa.Table:
    """One bit per name sent: whether another cell sent it too."""
    blobs = [np.frombuffer(b, "<u4") for b in table.column("names").to_pylist()]
    every = np.concatenate(blobs)
    order, opens = spans.grouped(every)
    alone = opens & np.append(opens[1:], True)
    again = np.zeros(len(every), bool)
    again[order] = ~alone
    cuts = np.cumsum([0, *(len(b) for b in blobs)])
    bits = [np.packbits(again[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
    return pa.table({"cell": table.column("cell"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of true."""
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, from each position on (the end is padded)."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        moved = np.concatenate([out[step:], np.full(step, np.uint64(0xFFFFFFFFFFFFFFFF))])
        out = np.minimum(out, moved)
        have += step
    return out


# A start is the number of its text within the cell and the offset in it; ``order`` and ``tie`` rank texts of all cells.
PIECE = "place bigint, cell bigint, order bigint, tie bigint, start bigint, n bigint, text binary"
_KINDS = {"bigint": pa.int64(), "binary": pa.binary()}
_PIECE = pa.schema([(p.split()[0], _KINDS[p.split()[1]]) for p in PIECE.split(", ")])
_TEXT = 1 << 36


def _piece_task(buckets: int):
    """Pieces (text set) to be compared with other cells, and runs already known to repeat (text null)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _PIECE.empty_table()
        cell = Cell(left).locate()
        where, bucket, rest, order = cell.names(buckets)
        new, number = _distinct(bucket[order], rest[order])
        counts = np.bincount(number) if len(number) else np.zeros(0, np.int64)
        sent = bucket[order][new]
        again = np.zeros(len(sent), bool)
        for b, bits in zip(right.column("bucket").to_pylist(), right.column("bits").to_pylist()):
            a, z = np.searchsorted(sent, b), np.searchsorted(sent, b, "right")
            again[a:z] = np.unpackbits(np.frombuffer(bits, np.uint8))[: z - a]
        hit = where[order[(again | (counts > 1))[number]]]
        n = len(cell.data)
        near = np.zeros(n + 1, np.int64)
        np.add.at(near, np.maximum(hit - PERIOD + 1, cell.offsets[cell.owner[hit]]), 1)
        np.add.at(near, hit + 1, -1)
        candidate = (np.cumsum(near[:n]) > 0) & (cell.left >= LENGTH)
        at = np.flatnonzero(candidate)
        whole = cell.hasher.of(at, at + LENGTH)
        order, opens = spans.grouped(whole)
        repeat = np.zeros(n, bool)
        repeat[at[order[~opens]]] = True
        block = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
        usable = np.flatnonzero(cell.left >= ANCHOR)
        block[usable] = cell.hasher.of(usable, usable + ANCHOR)
        low = _lowest(block, LENGTH - ANCHOR + 1)
        send = candidate & ~repeat
        joins = np.zeros(n, bool)
        joins[1:] = send[1:] & send[:-1] & (low[1:] == low[:-1]) & (cell.owner[1:] == cell.owner[:-1])
        begin = np.flatnonzero(send & ~joins)
        stop = np.append(np.flatnonzero(send & ~np.append(joins[1:], False)), []).astype(np.int64) + 1
        a, z = _runs(repeat)
        inner = np.flatnonzero(repeat[1:] & repeat[:-1] & (cell.owner[1:] != cell.owner[:-1])) + 1
        a, z = np.sort(np.concatenate([a, inner])), np.sort(np.concatenate([z, inner]))
        starts, ends = np.concatenate([begin, a]).astype(np.int64), np.concatenate([stop, z]).astype(np.int64)
        places = np.concatenate([low[begin], spans.mix(a.astype(np.uint64))]).view(np.int64)
        owner = cell.owner[starts]
        data = cell.data.tobytes()
        texts = [data[s : e + LENGTH - 1] for s, e in zip(begin.tolist(), stop.tolist())] + [None] * len(a)
        mine = left.column("cell")[0].as_py()
        missing = cell.ids.is_null().to_numpy()
        rank = np.where(missing, np.iinfo(np.int64).max, cell.ids.fill_null(0).to_numpy())
        tie = np.where(missing, cell.ties.to_numpy(), 0)
        known = np.where(np.arange(len(starts)) < len(begin), 0, ends - starts)
        columns = [places, np.full(len(starts), mine), rank[owner], tie[owner], owner * _TEXT + cell.at[starts], known, texts]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE)

    return run


RUN = "cell bigint, start bigint, n bigint"
_RUN = pa.schema([(p.split()[0], _KINDS[p.split()[1]]) for p in RUN.split(", ")])


def _later(rows: pa.Table) -> pa.Table:
    """Runs of starts that are not the first of their string, among the pieces of some places."""
    known = rows.filter(pa.compute.is_null(rows.column("text"))).select(_RUN.names).cast(_RUN)
    rows = rows.filter(pa.compute.is_valid(rows.column("text")))
    if not rows.num_rows:
        return known
    by = [(c, "ascending") for c in ("order", "tie", "cell", "start")]
    rows = rows.take(pa.compute.sort_indices(rows.select([c for c, _ in by]), sort_keys=by))
    texts = rows.column("text").to_pylist()
    length = np.array([len(t) for t in texts], np.int64)
    first = np.cumsum(length) - length
    count = length - LENGTH + 1
    data = np.frombuffer(b"".join(texts), np.uint8)
    piece = np.repeat(np.arange(len(texts)), count)
    step = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    at = first[piece] + step
    name = spans.Hasher(data).of(at, at + LENGTH)
    ranked, opens = spans.grouped(name)
    windows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
    later = np.zeros(len(at), bool)
    again = np.flatnonzero(~opens)
    for k in range(0, len(again), 1 << 16):
        part = again[k : k + (1 << 16)]
        if (windows[at[ranked[part]]] != windows[at[ranked[part - 1]]]).any():
            raise ValueError("two strings share a 64-bit name; change the hash seed")
    later[ranked[again]] = True
    edge = np.zeros(len(at), bool)
    edge[0] = True
    edge[1:] = piece[1:] != piece[:-1]
    begins = np.flatnonzero(later & (edge | ~np.append(False, later[:-1])))
    ends = np.flatnonzero(later & np.append(edge[1:] | ~later[1:], True)) + 1
    source = rows.select(["cell", "start"]).take(pa.array(piece[begins]))
    found = [source.column("cell").combine_chunks(), pa.array(source.column("start").to_numpy() + step[begins]), pa.array(ends - begins)]
    return pa.concat_tables([known, pa.Table.from_arrays(found, schema=_RUN)])


def _merge_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by place; all pieces of a place are compared together, some places at a time."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size < _CHUNK:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        place = table.column("place").to_numpy()
        cut = int(np.searchsorted(place, place[-1]))
        if cut:
            yield from _later(table.slice(0, cut)).to_batches()
        held = table.slice(cut).to_batches()
        size = sum(b.nbytes for b in held)
    if held:
        yield from _later(pa.Table.from_batches(held).combine_chunks()).to_batches()


OUT = "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def _cut_task(left: pa.Table, right: pa.Table) -> pa.Table:
    cell = Cell(left) if left.num_rows else None
    out = {p.split()[0]: [] for p in OUT.split(", ")}
    if cell is not None:
        cover = np.zeros(len(cell.data) + 1, np.int64)
        if right.num_rows:
            start = right.column("start").to_numpy()
            start = cell.offsets[start // _TEXT] + start % _TEXT
            np.add.at(cover, start, 1)
            np.add.at(cover, start + right.column("n").to_numpy() + LENGTH - 1, -1)
        gone = np.cumsum(cover[:-1]) > 0
        for k, i in enumerate(cell.ids.to_pylist()):
            text, own = cell.data[cell.offsets[k] : cell.offsets[k + 1]], gone[cell.offsets[k] : cell.offsets[k + 1]]
            begins, _ = _runs(own)
            for name, value in zip(out, (i, len(text), int(own.sum()), len(begins), text[~own].tobytes())):
                out[name].append(value)
    kinds = [_KINDS[p.split()[1]] for p in OUT.split(", ")]
    return pa.table({n: pa.array(v, t) for (n, v), t in zip(out.items(), kinds)})


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept (the bytes that stay): one row per input row."""
    slim = docs.select(F.col(key).cast("bigint").alias("id"), as_text(text).cast("binary").alias("text"))
    total = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cell_bytes = min(MOST_CELL, max(CELL, int(40 * math.sqrt(total))))
    cells = max(1, math.ceil(total / cell_bytes))
    buckets = max(64, cells)
    place = F.when(F.col("id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("id"))
    dealt = slim.select(F.pmod(place, F.lit(cells)).alias("cell"), "id", F.xxhash64("text").alias("tie"), "text")
    names = dealt.groupBy("cell").applyInArrow(_name_task(buckets), "bucket bigint, cell bigint, names binary")
    bits = names.groupBy("bucket").applyInArrow(_repeat_task, "cell bigint, bucket bigint, bits binary")
    pieces = dealt.groupBy("cell").cogroup(bits.groupBy("cell")).applyInArrow(_piece_task(buckets), PIECE)
    runs = pieces.repartition("place").sortWithinPartitions("place").mapInArrow(_merge_task, RUN)
    cut = dealt.groupBy("cell").cogroup(runs.groupBy("cell")).applyInArrow(_cut_task, OUT)
    return cut.select("id", "n_bytes", "n_removed", "n_spans", "kept")
