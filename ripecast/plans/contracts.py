"""Table contracts: the checks each table must pass, and column descriptions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast.operators.quality import (
    Check,
    KeyCheck,
    RowCheck,
    is_outside,
    is_unlisted,
    is_violated,
    missing,
)

FLAG = [True, False]
FAMILIES = [family for family, _, _ in K.PRICE_BANDS]


def _listed(column: str, values: list) -> Check:
    return RowCheck(column, "accepted_values", is_unlisted(column, values))


def _units() -> Check:
    return RowCheck("unit_sales", "accepted_range", is_outside("unit_sales", K.UNITS_MIN, K.UNITS_MAX))


def _true(column: str, name: str, expression) -> Check:
    return RowCheck(column, name, is_violated(expression))


def _grain(*columns: str) -> Check:
    return KeyCheck(columns, "unique_combination")


def _unique(column: str) -> Check:
    return KeyCheck((column,), "unique")


def contracts() -> dict[str, list[Check]]:
    """Checks by table. Built on demand, since column expressions need a running session."""
    return {
        "stg_sales": missing("id", *K.KEYS, "unit_sales"),
        "stg_items": [*missing("item_nbr"), _unique("item_nbr")],
        "stg_stores": [*missing("store_nbr"), _unique("store_nbr")],
        "stg_oil_prices": [*missing("date"), _unique("date")],
        "stg_holidays": missing("date"),
        "int_sales": [
            _grain(*K.KEYS),
            *missing(*K.KEYS, "unit_sales"),
            _units(),
            RowCheck("unit_sales", "no_negative", F.col("unit_sales") < 0),
            *missing("onpromotion"),
            _listed("onpromotion", FLAG),
        ],
        "int_items": [
            *missing("item_nbr"),
            _unique("item_nbr"),
            _true("perishable_bool", "is_flag_or_null", "perishable_bool IS NULL OR perishable_bool IN (true, false)"),
            RowCheck("family", "price_needs_upper_case", F.col("family") != F.upper("family")),
        ],
        "int_oil_prices": [*missing("date"), _unique("date"), *missing("dcoil")],
        "int_holidays": [*missing("date"), _unique("date"), *missing("is_nat_holiday"), _listed("is_nat_holiday", FLAG)],
        "dim_items": [
            _grain("item_nbr"),
            *missing("item_nbr", "perishable_bool"),
            _listed("perishable_bool", FLAG),
            RowCheck(
                "base_price", "perishable_not_null", F.col("perishable_bool") & F.col("base_price").isNull()
            ),
            _true("base_price", "perishable_positive", "NOT perishable_bool OR base_price > 0"),
            RowCheck("base_price", "other_not_null", ~F.col("perishable_bool") & F.col("base_price").isNull()),
        ],
        "dim_stores": [_grain("store_nbr"), *missing("store_nbr")],
        "dim_oil_prices": [*missing("date"), _unique("date"), *missing("dcoil")],
        "dim_holidays": [*missing("date"), _unique("date"), *missing("is_nat_holiday"), _listed("is_nat_holiday", FLAG)],
        "fct_sales_features": [
            _grain(*K.KEYS),
            *missing(*K.KEYS, "unit_sales"),
            _units(),
            _listed("onpromotion", FLAG),
            *missing("family"),
            _listed("family", FAMILIES),
            *missing("class", "perishable_bool", "base_price"),
            _true("base_price", "positive", "base_price > 0"),
            *missing("shelf_life_days", "days_since_stock", "time_to_expiry", "discount_pct", "effective_price"),
            _true("effective_price", "not_negative", "effective_price >= 0"),
        ],
    }


TABLE_COMMENTS = {
    "int_sales": "Cleaned daily sales, one row per day, store and item",
    "dim_items": "Items with family, class, whether they perish, and list price",
    "dim_stores": "Stores with place, type and cluster",
    "dim_oil_prices": "Daily oil price, gaps filled forward, with moving averages and changes",
    "dim_holidays": "Days on which a national holiday is observed",
    "fct_sales_features": "Daily sales of perishable items with price, days left and recent units",
    "features_split": "Model features with the part of the time split",
    "scoring_frame": "Test rows close to expiry, with today's discount and price as the baseline",
}
COMMENTS = {
    "date": "Day of sale",
    "store_nbr": "Store number",
    "item_nbr": "Item number",
    "family": "Product family, slashes and spaces as underscores",
    "class": "Product class, a category without order",
    "perishable_bool": "Whether the item is perishable",
    "onpromotion": "Whether the item was promoted that day; unknown counts as no",
    "unit_sales": "Units sold, returns as 0, at most 200",
    "log_sales": "Natural log of one plus unit_sales",
    "base_price": "List price: the family's price band with a small shift per item",
    "discount_pct": "Markdown share by days left",
    "effective_price": "List price less the markdown, in cents",
    "shelf_life_days": "Shelf life of the family",
    "days_since_stock": "Simulated days since stocking, stable per row key",
    "time_to_expiry": "Days left, never negative",
    "dow": "Day of week, 1 is Sunday",
    "month": "Month of the year",
    "year": "Year",
    "avg_units_7d": "Mean units of the previous 7 rows of the series",
    "avg_units_14d": "Mean units of the previous 14 rows of the series",
    "city": "Store city",
    "state": "Store state or province",
    "type": "Store type",
    "cluster": "Group of similar stores",
    "oil_price": "Daily oil price, gaps filled forward",
    "oil_price_ma7": "Mean oil price of up to 7 days",
    "oil_price_ma30": "Mean oil price of up to 30 days",
    "pct_change_1d": "Oil price change against the day before",
    "pct_change_7d": "Oil price change against a week before",
}
