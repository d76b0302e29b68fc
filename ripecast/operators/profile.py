"""Profile queries over the sales fact. Each is one pass with partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripecast.functions import safe_corr
from ripecast.operators.selection import quantiles

MISSING_COLUMNS = {
    "null_onpromotion": "onpromotion",
    "null_family": "family",
    "null_class": "class",
    "null_city": "city",
    "null_state": "state",
    "null_type": "type",
    "null_cluster": "cluster",
    "null_oil_price": "oil_price",
    "null_oil_ma7": "oil_price_ma7",
    "null_oil_ma30": "oil_price_ma30",
}
OIL_COLUMNS = {
    "r_oil": "oil_price",
    "r_oil_ma7": "oil_price_ma7",
    "r_oil_ma30": "oil_price_ma30",
    "r_oil_d1": "pct_change_1d",
    "r_oil_d7": "pct_change_7d",
}
DISTINCT_COLUMNS = {
    "stores": "store_nbr",
    "items": "item_nbr",
    "families": "family",
    "classes": "class",
    "cities": "city",
    "states": "state",
    "types": "type",
    "clusters": "cluster",
}
QUANTILES = {"p01_sales": 0.01, "p50_sales": 0.50, "p95_sales": 0.95}


def shape(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("nrows"), F.min("date").alias("min_date"), F.max("date").alias("max_date")
    )


def missingness(fact: DataFrame) -> DataFrame:
    return fact.agg(*[F.count_if(F.col(c).isNull()).alias(name) for name, c in MISSING_COLUMNS.items()])


def distribution(fact: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Quantiles and means of the target. The quantile sketch is bounded by ``accuracy``, not by the data."""
    points = F.percentile_approx("unit_sales", list(QUANTILES.values()), accuracy)
    return fact.agg(
        points.alias("q"), F.avg("unit_sales").alias("mean_sales"), F.avg("log_sales").alias("mean_log_sales")
    ).select(*[F.col("q")[i].alias(name) for i, name in enumerate(QUANTILES)], "mean_sales", "mean_log_sales")


def distribution_exact(fact: DataFrame) -> DataFrame:
    """``distribution`` with exact quantiles at any size; runs its passes at once."""
    found = quantiles(fact, {name: (F.col("unit_sales"), share) for name, share in QUANTILES.items()})
    means = fact.agg(F.avg("unit_sales").alias("mean_sales"), F.avg("log_sales").alias("mean_log_sales"))
    return means.select(*[F.lit(v).cast("double").alias(name) for name, v in found.items()], "mean_sales", "mean_log_sales")


def seasonality(fact: DataFrame, part: str) -> DataFrame:
    """Mean log sales by a calendar part (dow or month)."""
    return fact.groupBy(part).agg(F.avg("log_sales").alias("avg_log_sales")).orderBy(part)


def _promo_lift() -> Column:
    return F.avg(F.when(F.col("onpromotion"), F.col("log_sales"))) - F.avg(
        F.when(~F.col("onpromotion"), F.col("log_sales"))
    )


def promo_lift(fact: DataFrame) -> DataFrame:
    return fact.agg(_promo_lift().alias("avg_lift_log"))


def promo_lift_by_family(fact: DataFrame, top: int = 50) -> DataFrame:
    lifts = fact.groupBy("family").agg(_promo_lift().alias("lift_log"))
    return lifts.orderBy(F.col("lift_log").desc_nulls_last(), "family").limit(top)


def store_differences(fact: DataFrame, top: int = 50) -> DataFrame:
    groups = fact.groupBy("type", "cluster").agg(
        F.avg("log_sales").alias("avg_log_sales"),
        F.avg(F.when(F.col("onpromotion"), 1.0).otherwise(0.0)).alias("promo_rate"),
        F.count(F.lit(1)).alias("n"),
    )
    return groups.orderBy(F.col("avg_log_sales").desc_nulls_last(), "type", "cluster").limit(top)


def oil_correlations(fact: DataFrame) -> DataFrame:
    return fact.agg(*[safe_corr(F.col("log_sales"), F.col(c)).alias(name) for name, c in OIL_COLUMNS.items()])


def cardinality(fact: DataFrame, exact: bool = True) -> DataFrame:
    """Distinct counts; ``exact=False`` uses a sketch of fixed size instead of one expanded row per column."""
    count = F.count_distinct if exact else F.approx_count_distinct
    return fact.agg(*[count(F.col(c)).alias(name) for name, c in DISTINCT_COLUMNS.items()])


# Sketches of 4,096 registers: the standard error of an estimate is 1.04 / 64, about 1.6 %; small counts are exact.
SKETCH_BITS = 12
CARDINALITY_STATE = ", ".join(f"{name} BINARY" for name in DISTINCT_COLUMNS)


def cardinality_states(fact: DataFrame, by: str = "date") -> DataFrame:
    """One row per day (or per value of ``by``) with a sketch of the values of each column, to be stored and merged with others."""
    return fact.groupBy(by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), SKETCH_BITS).alias(name) for name, c in DISTINCT_COLUMNS.items()])


def cardinality_of(states: DataFrame) -> DataFrame:
    """Estimated distinct counts over the days of ``states``; nothing but the sketches is read."""
    return states.agg(*[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(name)), F.lit(0)).alias(name) for name in DISTINCT_COLUMNS])


def cold_spots(fact: DataFrame, top: int = 100) -> DataFrame:
    """Series with the fewest days that sold anything."""
    sold = fact.groupBy("store_nbr", "item_nbr").agg(F.count_if(F.col("unit_sales") > 0).alias("days_sold"))
    return sold.orderBy("days_sold", "store_nbr", "item_nbr").limit(top)
