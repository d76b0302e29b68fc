"""Cleaned sales and the item, store, oil and holiday dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast.functions import base_price, by_family, clip_units, log_units, perishable_flag
from ripecast.operators.series import MAX_SERIES_ROWS, series_columns
from ripecast.operators.timeseries import (
    by_day,
    daily_spine,
    forward_fill,
    one_row_per_day,
    pct_change,
    trailing_mean,
)


def int_sales(stg: DataFrame, *carried: str) -> DataFrame:
    """Sales with clipped units, their log, and a promotion flag without NULLs, and the ``carried`` columns as they are."""
    units = clip_units(F.col("unit_sales"))
    return stg.select(
        "id",
        "date",
        "store_nbr",
        "item_nbr",
        F.coalesce("onpromotion", F.lit(False)).alias("onpromotion"),
        units.alias("unit_sales"),
        log_units(units).alias("log_sales"),
        *carried,
    )


def int_items(stg: DataFrame) -> DataFrame:
    return stg.select("item_nbr", "family", "class", perishable_flag(F.col("perishable")).alias("perishable_bool"))


def price_bands(spark: SparkSession) -> DataFrame:
    """The fixed price bands, nine rows."""
    rows = ", ".join(f"('{family}', {low}D, {high}D)" for family, low, high in K.PRICE_BANDS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS bands(family, p_min, p_max)")


def with_price_band(items: DataFrame) -> DataFrame:
    return items.join(F.broadcast(price_bands(items.sparkSession)), "family", "left")


def distinct_items(stg: DataFrame) -> DataFrame:
    return stg.select("item_nbr", F.upper("family").alias("family")).distinct()


def int_base_price(stg: DataFrame) -> DataFrame:
    """One price per item and family; NULL for a family without a band."""
    price = base_price(F.col("item_nbr"), F.col("p_min"), F.col("p_max"))
    return with_price_band(distinct_items(stg)).select("item_nbr", "family", price.alias("base_price"))


def item_with_price(items: DataFrame) -> DataFrame:
    """Items with their price. The price depends on the row's own item and family, so nothing is joined; bands are
    upper case, so a family in other case has no price."""
    low, high = (by_family({band[0]: band[i] for band in K.PRICE_BANDS}, F.col("family")) for i in (1, 2))
    price = base_price(F.col("item_nbr"), low, high)
    return items.select("item_nbr", "family", "class", "perishable_bool", price.alias("base_price"))


def dim_items(items: DataFrame) -> DataFrame:
    return item_with_price(items).withColumn("perishable_bool", F.coalesce("perishable_bool", F.lit(False)))


def dim_stores(stg: DataFrame) -> DataFrame:
    return stg.select("store_nbr", "city", "state", "type", "cluster")


def oil_bounds(sales: DataFrame, oil: DataFrame) -> DataFrame:
    """One row: first and last sales day and first quoted oil day, from one aggregate over both tables."""
    none = F.lit(None).cast("date")
    days = sales.select(F.col("date").alias("sold"), none.alias("quoted")).unionByName(
        oil.where(F.col("dcoil_raw").isNotNull()).select(none.alias("sold"), F.col("date").alias("quoted"))
    )
    bounds = days.agg(
        F.min("sold").alias("first_sale"), F.max("sold").alias("last_sale"), F.min("quoted").alias("first_quote")
    )
    # greatest() skips NULL; without any quote there is no series
    return bounds.where(F.col("first_quote").isNotNull() & F.col("first_sale").isNotNull()).withColumn(
        "start", F.greatest("first_sale", "first_quote")
    )


def oil_spine(sales: DataFrame, oil: DataFrame) -> DataFrame:
    """All days from the later of the first sale and the first quote to the last sale."""
    return daily_spine(oil_bounds(sales, oil), "start", "last_sale")


def int_oil_prices(sales: DataFrame, oil: DataFrame, seed_history: bool = False) -> DataFrame:
    """Filled daily oil price with moving averages and relative changes.

    ``seed_history`` lets a quote from before the first day fill the first days; otherwise they stay NULL.
    """
    bounds = oil_bounds(sales, oil)
    quotes = one_row_per_day(oil, "dcoil_raw")
    w = by_day()
    if seed_history:
        days = bounds.where(F.col("start") <= F.col("last_sale")).select(
            "start", F.explode(F.sequence(F.least("first_quote", "start"), F.col("last_sale"))).alias("date")
        )
        filled = days.join(quotes, "date", "left").withColumn("dcoil", forward_fill("dcoil_raw", w))
        filled = filled.where(F.col("date") >= F.col("start"))
    else:
        days = daily_spine(bounds, "start", "last_sale")
        filled = days.join(quotes, "date", "left").withColumn("dcoil", forward_fill("dcoil_raw", w))
    return filled.select(
        "date",
        "dcoil",
        trailing_mean("dcoil", w, 7, include_current=True).alias("dcoil_ma7"),
        trailing_mean("dcoil", w, 30, include_current=True).alias("dcoil_ma30"),
        pct_change("dcoil", w, 1).alias("pct_change_1d"),
        pct_change("dcoil", w, 7).alias("pct_change_7d"),
    )


def dim_oil_prices(oil: DataFrame) -> DataFrame:
    return oil.select("date", "dcoil", "dcoil_ma7", "dcoil_ma30", "pct_change_1d", "pct_change_7d")


def int_holidays(stg: DataFrame) -> DataFrame:
    """Whether a day is a national day off: a holiday that was not moved, or an extra day."""
    kept = (F.col("type") == K.HOLIDAY_TYPE) & ~F.coalesce("transferred", F.lit(False))
    day_off = (F.col("locale") == K.NATIONAL_LOCALE) & (F.col("type").isin(K.DAY_OFF_TYPES) | kept)
    return stg.groupBy("date").agg(F.bool_or(F.coalesce(day_off, F.lit(False))).alias("is_nat_holiday"))


def dim_holidays(holidays: DataFrame) -> DataFrame:
    return holidays.select("date", "is_nat_holiday")


def tx_signals(transactions: DataFrame, max_rows: int | None = MAX_SERIES_ROWS) -> DataFrame:
    """Earlier store traffic: the previous row, and means of the previous 7 and 30 rows."""
    return series_columns(
        transactions.select("date", "store_nbr", "transactions"),
        ["store_nbr"],
        "date",
        30,
        lambda w: {
            "tx_lag1": F.lag("transactions", 1).over(w),
            "tx_ma7_lag1": trailing_mean("transactions", w, 7, include_current=False),
            "tx_ma30_lag1": trailing_mean("transactions", w, 30, include_current=False),
        },
        ties=["transactions"],
        max_rows=max_rows,
    )
