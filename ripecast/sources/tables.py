"""Typed tables: partitioned writes, replacement, views, descriptions and pruned reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


def laid_out(df: DataFrame, partition: str | None, cluster: Sequence[str] = ()) -> DataFrame:
    """Group rows by partition value and sort them by the cluster keys.

    A rebalance shuffle is used rather than a plain repartition: AQE splits a value that holds too many rows over
    several tasks and files, and merges small ones.
    """
    if partition is None:
        return df.sortWithinPartitions(*cluster) if cluster else df
    return df.hint("rebalance", F.col(partition)).sortWithinPartitions(partition, *cluster)


def write_table(df: DataFrame, path: str, partition: str | None = "date", cluster: Sequence[str] = ()) -> None:
    """Replace a table: partition folders, rows sorted by the cluster keys inside each file."""
    writer = laid_out(df, partition, cluster).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def read_table(spark: SparkSession, path: str, schema: str, comments: Mapping[str, str] | None = None) -> DataFrame:
    """A stored table in its declared column order, with descriptions; the declared schema saves reading footers."""
    declared = documented(empty(spark, schema).schema, comments or {})
    table = spark.read.schema(declared).parquet(path)
    return describe(table.select(*[f.name for f in declared]), comments or {})


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def save_series_table(df: DataFrame, name: str, keys: Sequence[str], buckets: int, order: str = "date") -> None:
    """Managed table bucketed by the series keys, so that series windows and key joins need no shuffle."""
    writer = df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys, order)
    writer.format("parquet").saveAsTable(name)


def publish(df: DataFrame, name: str, materialized: str = "view", comment: str | None = None, location: str | None = None) -> DataFrame:
    """Expose a model under a name, as a view (lazy) or as a stored table, and return it for further use.

    A stored table keeps a description; ``location`` is its folder, by default one in the session's warehouse, which on
    a cluster has to be a shared one.
    """
    if materialized == "view":
        df.createOrReplaceTempView(name)
    elif materialized == "table":
        writer = df.write.mode("overwrite").format("parquet")
        (writer.option("path", location) if location else writer).saveAsTable(name)
        if comment is not None:
            text = comment.replace("\\", "\\\\").replace("'", "\\'")
            df.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{text}'")
    else:
        raise ValueError(f"unknown materialization: {materialized}")
    return df.sparkSession.table(name)


def describe(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column descriptions; they are stored with a table and shown by DESCRIBE."""
    return df.select(
        *[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c) for c in df.columns]
    )


def empty(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """Typed table without rows."""
    return spark.createDataFrame([], schema)


def names(spark: SparkSession, schema: str) -> list[str]:
    """Column names of a declared schema."""
    return empty(spark, schema).schema.names


def documented(schema: StructType, comments: Mapping[str, str]) -> StructType:
    """The schema with descriptions."""
    return StructType(
        [
            StructField(f.name, f.dataType, f.nullable, {**f.metadata, "comment": comments[f.name]})
            if f.name in comments
            else f
            for f in schema
        ]
    )


def read_split(table: DataFrame, split: str, columns: Sequence[str]) -> DataFrame:
    """Named columns of one split; both the filter and the projection reach the scan."""
    return table.where(F.col("split") == split).select("date", *columns, "split")


def read_day(table: DataFrame, day: str) -> DataFrame:
    """One day; a partition filter on a date-partitioned table."""
    return table.where(F.col("date") == F.lit(day).cast("date"))
