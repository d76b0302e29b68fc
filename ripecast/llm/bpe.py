"""Byte-level BPE: encode texts to token ids by a rank file, and decode ids to bytes.

A text is split by a pattern (in the JVM); each distinct piece is turned into ids once by folding ranked merges over its
bytes: start from single bytes, join the adjacent pair of lowest rank, repeat until no pair has a rank. Decoding
concatenates the byte strings of the ids.

Two forms of the fold give the same ids:

* ``fold_native`` is an expression: ``aggregate`` over the bytes of a piece with a literal table from pairs of ids to
  ranks. It is meant for a column of distinct pieces.
* ``encode`` sends pieces to Arrow tasks as arrays; each batch is dictionary-encoded, so Python sees each distinct piece
  once per batch and folds it once per task; ids and decoded bytes are gathered with numpy. ``round_trip``, which the
  query runs, also decodes the ids in the same task and leaves the text behind. The README has the figures that led to
  this form. Nothing is shuffled, so a lost executor costs only its own tasks.

The table of known pieces of a task is emptied when it holds ``KNOWN_BYTES``, which bounds memory and does not change
results. Long pieces are merged with a heap, in O(n log n).

Defined results: a null text is empty and has no ids; special-token strings are ordinary text; a null key stays null;
other columns are carried whatever their names; an empty table gives an empty result. The pattern's classes are those
of the JVM's Unicode version, so characters assigned later than that may be split differently.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripecast.llm.common import as_text, fresh

KNOWN_BYTES = 64 << 20
_ENTRY_BYTES = 240
_BUCKETS = 1 << 17
_IN = 4 << 20


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def jvm_pattern(pattern: str) -> str:
    """The pattern with Unicode white space, as the tokenizer's own engine reads it."""
    return "(?U)" + pattern


class Merger:
    """Folds ranked merges over the bytes of a piece."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def ids(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        return self._short(piece) if len(piece) <= 64 else self._long(piece)

    def _short(self, piece: bytes) -> list[int]:
        rank = self.ranks.get
        parts = [piece[k : k + 1] for k in range(len(piece))]
        pairs = [rank(a + b) for a, b in zip(parts, parts[1:])]
        while pairs:
            best, at = min(((r, k) for k, r in enumerate(pairs) if r is not None), default=(None, 0))
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1])
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at])
        return [self.ranks[p] for p in parts]

    def _long(self, piece: bytes) -> list[int]:
        n, rank = len(piece), self.ranks.get
        end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] < n:
                r = rank(piece[k : end[after[k]]])
                if r is not None:
                    heapq.heappush(heap, (r, k, end[after[k]]))

        for k in range(n):
            offer(k)
        while heap:
            _, k, stop = heapq.heappop(heap)
            if not alive[k] or after[k] >= n or end[after[k]] != stop:
                continue
            gone = after[k]
            alive[gone], end[k], after[k] = False, end[gone], after[gone]
            if after[k] < n:
                before[after[k]] = k
            offer(k)
            offer(before[k])
        return [self.ranks[piece[k : end[k]]] for k in range(n) if alive[k]]


@lru_cache(maxsize=2)
def _tokens(path: str) -> tuple[Merger, np.ndarray, np.ndarray]:
    """The merger, and all tokens by id as one byte array with offsets; once per Python worker."""
    ranks = load_ranks(path)
    by_id = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        by_id[rank] = token
    offsets = np.zeros(len(by_id) + 1, np.int64)
    np.cumsum([len(t) for t in by_id], out=offsets[1:])
    return Merger(ranks), np.frombuffer(b"".join(by_id), np.uint8), offsets


def gather(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray, step: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """The value lists of ``rows`` one behind another, and where each begins; ``step`` rows at a time bound the indexes."""
    lengths = (offsets[1:] - offsets[:-1])[rows]
    starts = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(lengths, out=starts[1:])
    out = np.empty(starts[-1], values.dtype)
    for k in range(0, len(rows), step):
        part = slice(k, k + step)
        base, end = starts[k], starts[min(k + step, len(rows))]
        at = np.arange(base, end) + np.repeat(offsets[rows[part]] - starts[:-1][part], lengths[part])
        out[base:end] = values[at]
    return out, starts


def _binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary values that lie one behind another."""
    data = pa.py_buffer(np.ascontiguousarray(values).view(np.uint8))
    if offsets[-1] < 1 << 31:
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), data])
    raise ValueError("a batch of more than 2 GB; lower spark.sql.execution.arrow.maxRecordsPerBatch")


def _row_blocks(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose pieces take about ``most`` bytes, one row at least."""
    pieces = column.flatten()
    ends = np.asarray(column.offsets, np.int64) - int(column.offsets[0].as_py())
    size = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64) if len(pieces) else np.zeros(1, np.int64)
    bytes_at = size[ends]
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(bytes_at, bytes_at[row] + most, "right")) - 1)
        yield row, end
        row = end


class Folder:
    """Ids of pieces, each folded once while the table of known ones holds it."""

    def __init__(self, merger: Merger):
        self.merger, self.known, self.size = merger, {}, 0

    def ids(self, piece: str) -> bytes:
        ids = self.known.get(piece)
        if ids is None:
            if self.size >= KNOWN_BYTES:
                self.known.clear()
                self.size = 0
            ids = self.known[piece] = np.array(self.merger.ids(piece.encode()), "<u4").tobytes()
            self.size += 4 * len(piece) + len(ids) + _ENTRY_BYTES
        return ids


def _encode_task(path: str, decoded: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, data, token_ends = _tokens(path)
        folder = Folder(merger)
        for batch in batches:
            names = batch.schema.names
            for row, end in _row_blocks(batch.column(batch.num_columns - 1), _IN):
                part = batch.slice(row, end - row)
                lists = part.column(part.num_columns - 1)
                coded = lists.flatten().dictionary_encode()
                found = [folder.ids(piece) for piece in coded.dictionary.to_pylist()]
                offsets = np.zeros(len(found) + 1, np.int64)
                np.cumsum([len(x) // 4 for x in found], out=offsets[1:])
                flat = np.frombuffer(b"".join(found), "<u4")
                ids, starts = gather(flat, offsets, np.asarray(coded.indices, np.int64))
                rows = np.asarray(lists.offsets, np.int64)
                bounds = starts[rows - rows[0]]
                out = [*(part.column(k) for k in range(part.num_columns - 1)), _binary(ids, bounds * 4)]
                if decoded:
                    text, at = gather(data, token_ends, ids.astype(np.int64))
                    out.append(_binary(text, at[bounds]))
                yield pa.RecordBatch.from_arrays(out, names=[*names, "out"] if decoded else names)

    return run


def _decode_task(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, data, offsets = _tokens(path)
        for batch in batches:
            last = batch.column(batch.num_columns - 1)
            ends = np.frombuffer(last.buffers()[1], np.int32)[last.offset : last.offset + len(last) + 1].astype(np.int64)
            row = 0
            while row < len(last):
                end = max(row + 1, int(np.searchsorted(ends, ends[row] + _IN, "right")) - 1)
                ids = np.frombuffer(last.buffers()[2], np.uint8)[ends[row] : ends[end]].view("<u4").astype(np.int64)
                text, starts = gather(data, offsets, ids)
                bounds = starts[(ends[row : end + 1] - ends[row]) // 4]
                kept = [batch.column(k).slice(row, end - row) for k in range(batch.num_columns)]
                yield pa.RecordBatch.from_arrays([*kept, _binary(text, bounds)], names=[*batch.schema.names, "out"])
                row = end

    return run


def _through(rows: DataFrame, extra: Column, task, keep_extra: bool) -> tuple[DataFrame, list[str]]:
    """Rows and one more column through an Arrow task; columns travel under own names, so none can clash."""
    names = [f"c{k}" for k in range(len(rows.columns))]
    own = rows.toDF(*names).select(*names, extra.alias("extra"))
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, rows.schema))
    tail = "extra binary, out binary" if keep_extra else "extra binary"
    return own.mapInArrow(task, f"{schema}, {tail}" if schema else tail), names


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """The input rows with ``out``: token ids as little-endian unsigned 32-bit integers, one behind another."""
    name = fresh(docs.columns, out)
    pieces = F.regexp_extract_all(as_text(f"c{docs.columns.index(text)}"), F.lit(jvm_pattern(pattern)), F.lit(0))
    coded, _ = _through(docs, pieces, _encode_task(path), False)
    return coded.toDF(*docs.columns, name)


def decode(coded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The input rows with ``out``: the bytes that the ids stand for."""
    name = fresh(coded.columns, out)
    rows, names = _through(coded, F.coalesce(F.col(f"c{coded.columns.index(ids)}"), F.lit(b"")), _decode_task(path), True)
    return rows.select(*names, "out").toDF(*coded.columns, name)


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The input rows without the text, with ``ids`` and ``out``, the bytes that the ids stand for, from one task."""
    kept = [c for c in docs.columns if c != text]
    first = fresh(kept, ids)
    names = [f"c{k}" for k in range(len(docs.columns))]
    at = names[docs.columns.index(text)]
    own = docs.toDF(*names)
    others = [n for n in names if n != at]
    pieces = F.regexp_extract_all(as_text(at), F.lit(jvm_pattern(pattern)), F.lit(0)).alias("extra")
    schema = ", ".join([*(f"{n} {own.schema[n].dataType.simpleString()}" for n in others), "extra binary, out binary"])
    coded = own.select(*others, pieces).mapInArrow(_encode_task(path, True), schema)
    return coded.toDF(*kept, first, fresh([*kept, first], out))


def fold_native(piece: Column, path: str) -> Column:
    """The ids of a piece as an expression of built-in higher-order functions."""
    ranks = load_ranks(path)
    buckets: list[list[int]] = [[] for _ in range(_BUCKETS)]
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                buckets[(a * 40503 + b) % _BUCKETS].append((((a << 16) + b) << 16) + rank)
    table = F.from_json(F.lit(json.dumps(buckets)), "array<array<bigint>>")
    single = F.array(*[F.lit(ranks[bytes([k])]) for k in range(256)])

    def rank_of(a, b):
        key = a.cast("bigint") * 65536 + b
        hit = F.filter(F.get(table, (a * 40503 + b) % _BUCKETS), lambda x: F.shiftright(x, 16) == key)
        return F.get(hit, F.lit(0)).bitwiseAND(F.lit(65535)).cast("int")

    def bound(value, body):
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def start(ids):
        n = F.size(ids)
        return F.struct(ids.alias("ids"), F.zip_with(F.slice(ids, 1, n - 1), F.slice(ids, 2, n - 1), rank_of).alias("ranks"))

    def merged(state, best, at):
        ids, ranks_ = state["ids"], state["ranks"]
        none = F.array().cast("array<int>")
        left = F.when(at > 1, F.array(rank_of(F.get(ids, at - 2), best))).otherwise(none)
        right = F.when(at < F.size(ranks_), F.array(rank_of(best, F.get(ids, at + 1)))).otherwise(none)
        head = F.slice(ranks_, F.lit(1), F.greatest(at - 2, F.lit(0)))
        return F.struct(
            F.concat(F.slice(ids, F.lit(1), at - 1), F.array(best), F.slice(ids, at + 2, F.size(ids))).alias("ids"),
            F.concat(head, left, right, F.slice(ranks_, at + 2, F.size(ranks_))).alias("ranks"),
        )

    def step(state, _):
        def go(best):
            at = F.array_position(state["ranks"], best).cast("int")
            return F.when(best.isNull(), state).otherwise(bound(at, lambda k: merged(state, best, k)))

        return bound(F.array_min(state["ranks"]), go)

    raw = F.hex(F.encode(piece, "utf-8"))
    n = F.octet_length(piece)
    byte = lambda k: F.conv(F.substring(raw, 2 * k - 1, F.lit(2)), 16, 10).cast("int")
    ids = F.transform(F.sequence(F.lit(1), n), lambda k: F.get(single, byte(k)))
    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), bound(ids, start), step, lambda s: s["ids"])
    return F.when(n > 0, folded).otherwise(F.array().cast("array<int>"))
