"""The daily sales fact of perishable items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast.functions import discount_ladder, effective_price, shelf_life, stable_hash, stock_age, time_to_expiry
from ripecast.operators.lookup import keep_matching, lookup
from ripecast.operators.series import MAX_SERIES_ROWS, series_columns
from ripecast.operators.timeseries import trailing_mean

FACT_COLUMNS = [
    *K.KEYS,
    "family",
    "class",
    "perishable_bool",
    "onpromotion",
    "unit_sales",
    "log_sales",
    "base_price",
    "discount_pct",
    "effective_price",
    "shelf_life_days",
    "days_since_stock",
    "time_to_expiry",
    "dow",
    "month",
    "year",
    "avg_units_7d",
    "avg_units_14d",
    "city",
    "state",
    "type",
    "cluster",
    "oil_price",
    "oil_price_ma7",
    "oil_price_ma30",
    "pct_change_1d",
    "pct_change_7d",
]


def with_calendar(df: DataFrame) -> DataFrame:
    """Day of week (1 is Sunday), month and year."""
    return df.withColumns(
        {
            "dow": F.expr("CAST(dayofweek(date) AS BIGINT)"),
            "month": F.expr("CAST(month(date) AS BIGINT)"),
            "year": F.expr("CAST(year(date) AS BIGINT)"),
        }
    )


def with_price_and_expiry(df: DataFrame) -> DataFrame:
    """Stock age, days left, markdown and today's price, from the row's shelf life, price and key hash."""
    life, age, left, markdown = (F.col(c) for c in ("shelf_life_days", "days_since_stock", "time_to_expiry", "discount_pct"))
    return (
        df.withColumn("days_since_stock", stock_age(F.col("_key_hash"), life))
        .withColumn("time_to_expiry", time_to_expiry(life, age))
        .withColumn("discount_pct", discount_ladder(left))
        .withColumn("effective_price", effective_price(F.col("base_price"), markdown))
        .drop("_key_hash")
    )


def perishable_items(dim_items: DataFrame) -> DataFrame:
    return dim_items.where("perishable_bool")


def with_recent_units(sales: DataFrame, max_rows: int | None = MAX_SERIES_ROWS) -> DataFrame:
    """Mean units of the previous 7 and 14 rows of the series, today excluded."""
    return series_columns(
        sales,
        K.SERIES,
        "date",
        14,
        lambda w: {
            "avg_units_7d": trailing_mean("unit_sales", w, 7, include_current=False),
            "avg_units_14d": trailing_mean("unit_sales", w, 14, include_current=False),
        },
        ties=["id"],
        max_rows=max_rows,
    )


def priced_sales(sales: DataFrame, dim_items: DataFrame) -> DataFrame:
    """Perishable sales with item columns, calendar parts, price and expiry; row by row, one small join.

    What depends on the item alone is computed on the dimension. The key hash is computed below the join, so that a
    filter on price or expiry, which Catalyst pushes into the join, does not repeat it.
    """
    items = perishable_items(dim_items).withColumn("shelf_life_days", shelf_life(F.col("family")))
    hashed = sales.withColumn("_key_hash", stable_hash(F.col("store_nbr"), F.col("item_nbr"), F.col("date")))
    columns = ["family", "class", "perishable_bool", "base_price", "shelf_life_days"]
    return with_price_and_expiry(with_calendar(lookup(hashed, items, "item_nbr", *columns, how="inner")))


def fct_sales_features(
    sales: DataFrame,
    dim_items: DataFrame,
    dim_stores: DataFrame,
    dim_oil: DataFrame,
    max_rows: int | None = MAX_SERIES_ROWS,
) -> DataFrame:
    """The fact. Rows of other items leave before the window: an item is wholly in or out, so no series is cut."""
    kept = keep_matching(sales, perishable_items(dim_items), "item_nbr")
    windowed = with_recent_units(kept, max_rows)
    priced = priced_sales(windowed, dim_items)
    stores = lookup(priced, dim_stores, "store_nbr", "city", "state", "type", "cluster")
    oil = dim_oil.withColumnsRenamed({"dcoil": "oil_price", "dcoil_ma7": "oil_price_ma7", "dcoil_ma30": "oil_price_ma30"})
    joined = lookup(
        stores, oil, "date", "oil_price", "oil_price_ma7", "oil_price_ma30", "pct_change_1d", "pct_change_7d"
    )
    return joined.select(*FACT_COLUMNS)
