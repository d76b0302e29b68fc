"""Helpers shared by the corpus operators: column names, shared folders, small frames."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(taken, base: str) -> str:
    """A column name built on ``base`` that none of the columns in ``taken`` has, whatever the case."""
    lower = {c.lower() for c in taken}
    name, n = base, 0
    while name.lower() in lower:
        n += 1
        name = f"{base}_{n}"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    A session that runs in one process on one machine may name none and gets a scratch folder; on a cluster that is an
    error, since the executors would not see each other's files.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        named = "file://" + tempfile.mkdtemp(prefix="ripecast-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; never reused, so a rerun does not meet old files."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_text(name: str) -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_last(docs: DataFrame, text: str, keep: bool, prefix: str = "c") -> tuple[DataFrame, dict[str, str], int, str]:
    """Rows for an Arrow task that reads the text as its last column and gives its first columns back.

    Returns the rows under own names, the own name of every column, how many columns the task gives back, and their
    schema. The text crosses once: where it is a string to be kept, the task gives back the very column it reads.
    """
    names = [f"{prefix}{k}" for k in range(len(docs.columns))]
    at = docs.columns.index(text)
    others = [n for k, n in enumerate(names) if k != at]
    once = isinstance(docs.schema[text].dataType, StringType)
    kept = [*others, names[at]] if keep else others
    rows = docs.toDF(*names).select(*kept, *([] if keep and once else [as_text(names[at]).alias(f"{prefix}_text")]))
    kinds = dict(zip(names, docs.schema))
    return rows, dict(zip(docs.columns, names)), len(kept), ", ".join(f"{n} {kinds[n].dataType.simpleString()}" for n in kept)
