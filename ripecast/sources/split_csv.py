"""CSV whose quoted fields hold line breaks, read by many tasks a file.

Whether a line starts a record depends on all quotes before it in its file: it does where their number is even. So the
quotes are counted by byte range first, one small row each; the ranges of a file are summed up in order, which tells
every range whether it begins inside a quoted field; and the task that reads a range puts its lines together to records
as they come. Only what begins or ends a range can belong to a record of another one: at most two pieces a range move.

A range is what Spark reads as one split (``spark.sql.files.maxPartitionBytes``). A task holds a batch of lines and the
record it is in, and lines are not shuffled; what is broadcast is one small row per range. The file is read three times:
for the quotes, for the pieces at the edges, for the records between.

Defined results: those of Spark's own reader for whole files, with a header, for files that follow the rule that a quote
appears in quoted fields only, where it is doubled; line breaks in fields stay as they are in the file. Lines end with ``\\n`` or ``\\r\\n``; empty lines are skipped, and files
without a record give no rows. A file that ends inside a quoted field, or whose header is not ``columns``, is an error.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
_RANGE = ["_file", "_range"]
_PIECES = "_file string, _range bigint, _k bigint, _header boolean, _text string"


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every line with its file and the offset of its range, in the order of the file within a range."""
    return spark.read.option("lineSep", "\n").text(list(paths)).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_range"),
        F.col("value").alias("_line"),
        (F.length("value") - F.length(F.replace(F.col("value"), F.lit(QUOTE), F.lit("")))).alias("_quotes"),
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """One row a range: whether it begins inside a quoted field, is the first of its file, and the file ends inside one."""
    counts = lines.groupBy(*_RANGE).agg(F.sum("_quotes").alias("_n"))
    in_order = Window.partitionBy("_file").orderBy("_range")
    earlier = F.coalesce(F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    unclosed = F.lead("_n").over(in_order).isNull() & ((earlier + F.col("_n")) % 2 == 1)
    return counts.select(*_RANGE, (earlier % 2).alias("_open"), (F.row_number().over(in_order) == 1).alias("_first"), unclosed.alias("_unclosed"))


def _joined(order: Column, text: Column) -> Column:
    """The texts of a group in order, as the lines of one text."""
    parts = F.array_sort(F.collect_list(F.struct(order.alias("at"), text.alias("text"))))
    return F.array_join(F.transform(parts, lambda p: p["text"]), "\n")


class _Range:
    """The lines of one range on their way to pieces: piece 0 precedes the first record start, piece k is the k-th record."""

    def __init__(self, file: str, start: int, quotes: int, first: bool):
        self.file, self.start, self.quotes, self.first = file, start, quotes, first
        self.k, self.held = 0, []

    def add(self, lines: pa.Array, quotes: np.ndarray) -> Iterator[tuple[bool, int, pa.Array]]:
        """(edge, number of the first, texts) of the pieces that these lines complete; the last one is held."""
        before = self.quotes + np.cumsum(quotes) - quotes
        self.quotes = int(before[-1] + quotes[-1]) % 2
        inside = before % 2 == 1
        # empty lines between records belong to none; within a quoted field they do
        starts = ~inside & ~np.asarray(pc.is_in(lines, pa.array(["", "\r"], lines.type)).to_numpy(zero_copy_only=False))
        kept = starts | inside
        lines, at = lines.filter(pa.array(kept)), np.flatnonzero(starts[kept])
        if not len(at):
            self.held += [lines] if len(lines) else []
            return
        self.held += [lines[: at[0]]] if at[0] else []
        yield from self.end(self.k == 0)
        if len(at) > 1:
            offsets = pa.array(at.astype(np.int32))
            yield False, self.k + 1, pc.binary_join(pa.ListArray.from_arrays(offsets, lines[: at[-1]]), "\n")
        self.k, self.held = self.k + len(at), [lines[at[-1] :]]

    def end(self, edge: bool = True) -> Iterator[tuple[bool, int, pa.Array]]:
        if self.held:
            yield edge, self.k, pa.array(["\n".join(x for part in self.held for x in part.to_pylist())], pa.string())
            self.held = []

    def rows(self, number: int, texts: pa.Array) -> pa.RecordBatch:
        k = np.arange(number, number + len(texts))
        columns = [pa.array([self.file] * len(k), pa.string()), pa.array(np.full(len(k), self.start)), pa.array(k), pa.array((k == 1) & self.first), texts]
        return pa.RecordBatch.from_arrays(columns, names=["_file", "_range", "_k", "_header", "_text"])


def _pieces_task(edges: bool):
    """The pieces that begin or end a range, or those between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for batch in batches:
            if not batch.num_rows:
                continue
            file, start, opened, first, lines, quotes = batch.columns
            low = 0
            for high in np.union1d(*(pc.run_end_encode(c).run_ends.to_numpy() for c in (file, start))).tolist():
                name, at = file[low].as_py(), start[low].as_py()
                if current is None or (current.file, current.start) != (name, at):
                    if current is not None and edges:
                        yield from (current.rows(k, texts) for _, k, texts in current.end())
                    current = _Range(name, at, opened[low].as_py(), first[low].as_py())
                found = current.add(lines[low:high], quotes[low:high].to_numpy())
                yield from (current.rows(k, texts) for edge, k, texts in found if edge == edges)
                low = high
        if current is not None and edges:
            yield from (current.rows(k, texts) for _, k, texts in current.end())

    return run


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """file, header and text of every record; ``header`` marks the first one of a file."""
    lines = _lines(spark, paths)
    located = lines.join(F.broadcast(_ranges(lines)), _RANGE)
    message = F.concat(F.lit("the file ends inside a quoted field: "), F.col("_file"))
    opens = F.when(F.col("_unclosed"), F.raise_error(message).cast("bigint")).otherwise(F.col("_open"))
    located = located.select(*_RANGE, opens.alias("_open"), "_first", "_line", F.col("_quotes").cast("bigint"))
    within, edges = (located.mapInArrow(_pieces_task(edge), _PIECES) for edge in (False, True))

    # the record a range ends with goes on in the pieces that stand before the first record start of the ranges after it
    by_file = Window.partitionBy("_file").orderBy("_range", "_k").rowsBetween(Window.unboundedPreceding, 0)
    numbered = edges.withColumn("_record", F.sum((F.col("_k") > 0).cast("int")).over(by_file))
    spot = F.struct("_range", "_k")
    across = numbered.groupBy("_file", "_record").agg(_joined(spot, F.col("_text")).alias("_text"), F.min_by("_header", spot).alias("_header"))
    columns = ["_file", "_header", "_text"]
    whole = within.select(*columns).unionByName(across.select(*columns))
    return whole.select(F.col("_file").alias("file"), F.col("_header").alias("header"), F.regexp_replace("_text", r"\r\z", "").alias("text"))


def read(spark: SparkSession, paths: Sequence[str], names: Sequence[str], options: dict[str, str]) -> DataFrame:
    """The rows of the files as text columns ``names``, which has to be the header of every file."""
    schema = ", ".join(f"`{c}` STRING" for c in names)
    parse = {k: v for k, v in options.items() if k != "header"} | {"multiLine": "true"}
    parsed = records(spark, paths).select("file", "header", F.from_csv("text", F.lit(schema), parse).alias("row"))
    found = F.array(*[F.col("row")[c] for c in names])
    expected = F.array(*[F.lit(c) for c in names])
    message = F.concat(F.lit("unexpected header in "), F.col("file"), F.lit(": "), F.concat_ws(",", found))
    wrong = F.raise_error(message).cast("boolean")
    data = F.when(~F.col("header"), F.lit(True)).when(found == expected, F.lit(False)).otherwise(wrong)
    return parsed.where(data).select(*[F.col("row")[c].alias(c) for c in names])
