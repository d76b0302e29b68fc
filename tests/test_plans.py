"""Plan shapes: what is shuffled, what reaches the scan, and how skewed keys are spread."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from test_queries import CORE

import catalog
from ripecast.operators.series import MAX_SERIES_ROWS
from ripecast.plans import fact, features
from ripecast.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Stored sales and dimensions; the sales are unique per day, store and item, and one item has many of them."""
    root = str(tmp_path_factory.mktemp("stored"))
    rows = spark.range(30_000).select(
        F.col("id").cast("string").alias("id"),
        F.date_add(F.lit(dt.date(2010, 1, 1)), (F.col("id") % 1000).cast("int")).alias("date"),
        (F.col("id") % 30).alias("store_nbr"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 400).cast("long").alias("item_nbr"),
        F.lit(False).alias("onpromotion"),
        (F.col("id") % 11).cast("double").alias("unit_sales"),
        F.log1p((F.col("id") % 11).cast("double")).alias("log_sales"),
    )
    rows.dropDuplicates(["date", "store_nbr", "item_nbr"]).write.parquet(f"{root}/sales")
    items = spark.range(400).select(
        F.col("id").alias("item_nbr"),
        F.lit("DAIRY").alias("family"),
        F.col("id").alias("class"),
        (F.col("id") % 2 == 1).alias("perishable_bool"),
        F.lit(5.0).alias("base_price"),
    )
    items.write.parquet(f"{root}/items")
    stores = spark.range(30).select(F.col("id").alias("store_nbr"), *[F.lit("x").alias(c) for c in ("city", "state", "type")], F.col("id").alias("cluster"))
    stores.write.parquet(f"{root}/stores")
    read = lambda t: spark.read.parquet(f"{root}/{t}")
    return read("sales"), read("items"), read("stores")


@pytest.mark.parametrize("name", sorted(set(CORE) - {"win_series_split"}))
def test_no_cross_joins(spark, sample, name):
    text = plan(catalog.QUERIES[name](spark, sample))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_features_from_stored_sales_shuffle_rows_once(stored):
    text = plan(features.features_from_sales(*stored, max_rows=None))
    assert text.count("Exchange hashpartitioning") == 1
    scan = [line for line in text.splitlines() if "FileScan" in line and "log_sales" in line]
    assert len(scan) == 1 and "onpromotion" not in scan[0].split("ReadSchema")[1]


def test_fact_from_stored_sales_shuffles_rows_once(spark, stored):
    sales, items, stores = stored
    oil = spark.sql("SELECT date'2010-01-01' date, 1D dcoil, 1D dcoil_ma7, 1D dcoil_ma30, 0D pct_change_1d, 0D pct_change_7d")
    text = plan(fact.fct_sales_features(sales, items, stores, oil, max_rows=None))
    assert text.count("Exchange hashpartitioning") == 1


def test_pushed_filters_do_not_repeat_the_key_hash(spark, stored):
    sales, items, stores = stored
    priced = fact.priced_sales(sales, items).where(features.has_valid_price() & (F.col("time_to_expiry") <= 2))
    assert plan(priced).count("md5(cast(concat_ws") == 1


def test_split_filter_reaches_the_scan(spark, tmp_path, stored):
    split = features.features_split(features.features_from_sales(*stored, max_rows=None), "2012-09-26", 56, 28)
    tables.write_table(split, str(tmp_path / "s"), None)
    text = plan(tables.read_split(spark.read.parquet(str(tmp_path / "s")), "train", ["unit_sales"]))
    assert "EqualTo(split,train)" in text
    schema = text.split("ReadSchema: ")[1]
    assert "unit_sales" in schema and "base_price" not in schema


def test_large_dimensions_are_not_broadcast(spark, stored):
    """Beyond the size threshold the same join shuffles instead."""
    sales, items, _ = stored
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = fact.priced_sales(sales, items)
        assert "BroadcastHashJoin" not in plan(shuffled)
        want = shuffled.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert fact.priced_sales(sales, items).count() == want


def test_checked_and_proven_grain_agree(stored):
    def rows(max_rows):
        got = features.features_from_sales(*stored, max_rows=max_rows)
        return sorted((r.date, r.store_nbr, r.item_nbr, r.lag28_log_sales, round(r.rm28_log_sales, 9)) for r in got.collect())

    want = rows(None)
    assert want and rows(MAX_SERIES_ROWS) == want and rows(50) == want


def test_hot_day_is_split_when_written(spark, tmp_path):
    """A day with most of the rows is spread over several tasks and files."""
    hot = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 10 < 9, F.lit(dt.date(2017, 8, 1)))
        .otherwise(F.date_add(F.lit(dt.date(2017, 8, 1)), (F.col("id") % 97).cast("int")))
        .alias("date"),
        F.md5(F.col("id").cast("string")).alias("v"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        tables.write_table(hot, str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "t" / "date=2017-08-01").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000
