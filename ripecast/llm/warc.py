"""WARC archives: an index first, then coalesced byte-range reads.

``write`` turns rows into records, each a gzip member of its own, in one archive per task, and returns the index: file,
offset, length, URL and payload digest of every record. A task writes under a name of its own (partition, attempt and a
random part), and only rows of tasks that finished reach the index, so a lost executor or a second attempt leaves at
worst an archive that nothing refers to. The payload of a row whose digest another row carries is not written again: the
row becomes a revisit record that refers to the one with the largest id.

``fetch`` sorts the wanted index rows by file and offset, joins neighbouring ranges (gaps up to ``GAP`` bytes are read
over) into reads of about ``READ_BYTES``, and deals the reads out over as many tasks as there are reads' worth of bytes,
at least one per archive up to the cluster's cores.

Only digests, ids and lengths are shuffled to find repeats; payloads cross one exchange by row digest, or none where the
table of first copies is small enough for Spark to broadcast it.

Defined results: a null payload is empty; a null id orders below all others; rows that share digest and the largest id
are all responses; payloads shorter than ``least`` bytes are always responses; null URLs are written as empty; other
columns are ignored; an empty table gives an empty index. The folder must be one that all executors share; any store
that pyarrow's file systems open will do.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

READ_BYTES = 8 << 20
GAP = 64 << 10
DATE = "1970-01-01T00:00:00Z"
INDEX = "id bigint, url string, digest string, payload_bytes bigint, record_type string, refers_to bigint, file string, offset bigint, length bigint"


def _base32(column: str):
    """Upper-case base32 of a hex SHA-1: 5 hex digits are 20 bits are 4 letters."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = []
    for k in range(8):
        bits = F.conv(F.substring(column, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            parts.append(F.substring(F.lit(letters), (F.shiftright(bits, shift).bitwiseAND(F.lit(31)) + 1).cast("int"), F.lit(1)))
    return F.concat(*parts)


def classify(pages: DataFrame, key: str, url: str, payload: str, least: int = 0) -> DataFrame:
    """id, url, payload, digest, payload_bytes, record_type, refers_to of every row."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("bigint").alias("id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("bigint"))
    last = rows.groupBy("sha").agg(F.max("id").alias("last"), F.max("payload_bytes").alias("bytes_")).where(F.col("bytes_") >= least).select("sha", "last")
    repeat = F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last"))
    return rows.join(last, "sha", "left").select(
        "id",
        "url",
        F.when(repeat, F.lit(b"")).otherwise(F.col("payload")).alias("payload"),
        _base32("sha").alias("digest"),
        "payload_bytes",
        F.when(repeat, "revisit").otherwise("response").alias("record_type"),
        F.when(repeat, F.col("last")).alias("refers_to"),
    )


def _record(row: dict, date: str) -> bytes:
    name = lambda k: f"<urn:record:{'none' if k is None else k}>"
    head = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {name(row['id'])}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {(row['url'] or '').replace(chr(13), '').replace(chr(10), '')}",
        f"WARC-Payload-Digest: sha1:{row['digest']}",
        f"WARC-Original-Length: {row['payload_bytes']}",
        f"Content-Length: {len(row['payload'])}",
    ]
    if row["record_type"] == "revisit":
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {name(row['refers_to'])}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + row["payload"] + b"\r\n\r\n"


def _writer(folder: str, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        file = f"part-{context.partitionId():05d}-{context.attemptNumber()}-{uuid.uuid4().hex[:12]}.warc.gz"
        out, offset = None, 0
        for batch in batches:
            found = []
            for k in range(batch.num_rows):
                row = {c: batch.column(i)[k].as_py() for i, c in enumerate(batch.schema.names)}
                if out is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{file}", compression=None)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                member = packer.compress(_record(row, date)) + packer.flush()
                out.write(member)
                del row["payload"]
                found.append(row | {"file": file, "offset": offset, "length": len(member)})
                offset += len(member)
            names = INDEX.replace(" bigint", "").replace(" string", "").split(", ")
            kinds = [pa.int64() if part.endswith("bigint") else pa.string() for part in INDEX.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in found], t) for c, t in zip(names, kinds)], names=names)
        if out is not None:
            out.close()

    return run


def write(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0, date: str = DATE
) -> DataFrame:
    """Write one record per row into archives in ``folder`` and return the index, stored beside them.

    ``date`` is the capture time of all records, a parameter so that a rerun writes the same bytes.
    """
    rows = classify(pages, key, url, payload, least)
    index = rows.select("id", "url", "payload", "digest", "payload_bytes", "record_type", "refers_to").mapInArrow(_writer(f"{folder}/data", date), INDEX)
    index.write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def plan_reads(index: DataFrame, read_bytes: int = READ_BYTES, gap: int = GAP) -> DataFrame:
    """file, start, end, parts: ranges of neighbouring records, each read at once; parts are (offset, length)."""
    along = Window.partitionBy("file").orderBy("offset")
    end = F.col("offset") + F.col("length")
    far = F.col("offset") - F.lag(end).over(along) > gap
    cell = F.floor(F.col("offset") / read_bytes)
    opens = (far | (cell != F.lag(cell).over(along))).cast("int")
    runs = index.select("file", "offset", "length", F.coalesce(opens, F.lit(1)).alias("opens"))
    runs = runs.select("*", F.sum("opens").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("run"))
    return runs.groupBy("file", "run").agg(
        F.min("offset").alias("start"), F.max(end).alias("end"), F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("parts")
    )


RECORD = "file string, offset bigint, id string, url string, digest string, payload_bytes bigint, record_type string, refers_to string, payload binary"


def parse(member: bytes) -> dict:
    """Headers (lower case) and payload of one record; a payload that does not fit its digest is an error."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines[1:])}
    fields["payload"] = rest[: int(fields["content-length"])]
    digest = base64.b32encode(hashlib.sha1(fields["payload"]).digest()).decode()
    if fields["warc-type"] == "response" and fields["warc-payload-digest"] != f"sha1:{digest}":
        raise ValueError(f"damaged record {fields['warc-record-id']}")
    return fields


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        bare = lambda x: None if x is None else x.removeprefix("<urn:record:").removesuffix(">")
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['file']}") as source:
                    data = source.read_at(row["end"] - row["start"], row["start"])
                out = {c: [] for c in RECORD.replace(" bigint", "").replace(" string", "").replace(" binary", "").split(", ")}
                for part in row["parts"]:
                    at = part["offset"] - row["start"]
                    r = parse(data[at : at + part["length"]])
                    found = (row["file"], part["offset"], bare(r["warc-record-id"]), r["warc-target-uri"], r["warc-payload-digest"].removeprefix("sha1:"))
                    found += (int(r["warc-original-length"]), r["warc-type"], bare(r.get("warc-refers-to")), r["payload"])
                    for values, value in zip(out.values(), found):
                        values.append(value)
                kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
                types = [kinds[part.split()[1]] for part in RECORD.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    return run


def fetch(index: DataFrame, folder: str) -> DataFrame:
    """The records of the given index rows, read back from the archives (columns of ``RECORD``)."""
    total = index.agg(F.sum("length").alias("bytes"), F.count_distinct("file").alias("files")).first()
    cores = index.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-(total["bytes"] or 0) // READ_BYTES), min(total["files"], cores), 1)
    # a number of its own, since the rows of the plan are tiny and would be merged into one task
    reads = plan_reads(index).repartition(tasks)
    return reads.select("file", "start", "end", "parts").mapInArrow(_reader(f"{folder}/data"), RECORD)
