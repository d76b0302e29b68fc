"""Model features: cleaned rows, lag and rolling features per series, time split."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast.functions import split_label
from ripecast.operators.lookup import lookup
from ripecast.operators.series import MAX_SERIES_ROWS, series_columns
from ripecast.operators.timeseries import trailing_mean
from ripecast.plans.fact import priced_sales

ID_COLUMNS = ["store_nbr", "item_nbr", "class", "cluster", "family"]
CLEAN_COLUMNS = [
    "date",
    *ID_COLUMNS,
    "unit_sales",
    "log_sales",
    "base_price",
    "discount_pct",
    "effective_price",
    "time_to_expiry",
    "dow",
    "month",
    "year",
]
SERIES_FEATURES = [
    "lag1_log_sales",
    "lag7_log_sales",
    "lag14_log_sales",
    "lag28_log_sales",
    "rm7_log_sales",
    "rm28_log_sales",
    "promo_in_last_7d",
]
LOOKBACK = 28
# what tells rows of a series and date apart
TIES = ["log_sales", "discount_pct"]


def ids_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in ID_COLUMNS})


def has_valid_price() -> Column:
    """A known positive list price and a known price today."""
    return (F.col("base_price") > 0) & (F.col("effective_price") >= 0)


def features_clean(fact: DataFrame) -> DataFrame:
    """Perishable rows with a valid price; ids become categories."""
    doubles = ["unit_sales", "log_sales", "base_price", "discount_pct", "effective_price"]
    longs = ["time_to_expiry", "dow", "month", "year"]
    kept = fact.where(F.col("perishable_bool") & has_valid_price())
    return kept.select(
        "date",
        *[F.col(c).cast("string").alias(c) for c in ID_COLUMNS],
        *[F.col(c).try_cast("double").alias(c) for c in doubles],
        *[F.col(c).try_cast("long").alias(c) for c in longs],
    )


def clean_from_sales(sales: DataFrame, dim_items: DataFrame, dim_stores: DataFrame) -> DataFrame:
    """The same rows straight from cleaned sales; a filter on days reaches the sales, as no window lies between."""
    return features_clean(lookup(priced_sales(sales, dim_items), dim_stores, "store_nbr", "cluster"))


def series_features(w: WindowSpec) -> dict[str, Column]:
    """Lags, rolling means and markdown recency; every frame ends before the current row."""
    lags = {f"lag{n}_log_sales": F.lag("log_sales", n).over(w) for n in (1, 7, 14, 28)}
    means = {f"rm{n}_log_sales": trailing_mean("log_sales", w, n, include_current=False) for n in (7, 28)}
    marked_down = F.when(F.col("discount_pct") > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")
    return {**lags, **means, "promo_in_last_7d": F.max(marked_down).over(w.rowsBetween(-7, -1))}


def features_enriched(
    clean: DataFrame, max_rows: int | None = MAX_SERIES_ROWS, min_history: int | None = K.MIN_HISTORY_ROWS
) -> DataFrame:
    """Rows with a full history, and their series features."""
    return series_columns(
        clean,
        K.SERIES,
        "date",
        LOOKBACK,
        series_features,
        min_history=min_history,
        ties=TIES,
        max_rows=max_rows,
    )


def features_split(
    enriched: DataFrame,
    max_date: str | dt.date = K.SPLIT_MAX_DATE,
    valid_days: int = K.SPLIT_VALID_DAYS,
    test_days: int = K.SPLIT_TEST_DAYS,
) -> DataFrame:
    return enriched.withColumn("split", split_label(F.col("date"), max_date, valid_days, test_days))


def features_from_sales(
    sales: DataFrame, dim_items: DataFrame, dim_stores: DataFrame, max_rows: int | None = MAX_SERIES_ROWS
) -> DataFrame:
    """Enriched features straight from cleaned sales, when the fact is not stored.

    Leaves out what features do not use (oil, store address, recent units) and turns ids into text after the window,
    so the job has one shuffle of the rows it keeps. A positive list price already makes today's price valid, since no
    markdown exceeds the price; items without one leave with the dimension.
    """
    priced = priced_sales(sales, dim_items.where(F.col("base_price") > 0))
    narrow = priced.select(*[c for c in CLEAN_COLUMNS if c != "cluster"])
    enriched = features_enriched(narrow, max_rows)
    return ids_as_text(lookup(enriched, dim_stores, "store_nbr", "cluster")).select(*CLEAN_COLUMNS, *SERIES_FEATURES)
