"""Raw tables to typed tables, and typed tables to staged ones.

Raw columns may be text or typed. Keys and dates are cast strictly and fail on bad text; measures become NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripecast.functions import clean_family, parse_bool


def _strict(name: str, kind: str) -> Column:
    return F.expr(f"CAST({name} AS {kind}) AS {name}")


def _lenient(name: str, kind: str) -> Column:
    return F.expr(f"TRY_CAST({name} AS {kind}) AS {name}")


def native_sales(raw: DataFrame) -> DataFrame:
    return raw.select(
        _strict("id", "string"),
        _strict("date", "date"),
        _strict("store_nbr", "long"),
        _strict("item_nbr", "long"),
        parse_bool(F.col("onpromotion")).alias("onpromotion"),
        _lenient("unit_sales", "double"),
    )


def native_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        _strict("item_nbr", "long"),
        _strict("family", "string"),
        _lenient("class", "long"),
        _lenient("perishable", "long"),
    )


def native_stores(raw: DataFrame) -> DataFrame:
    return raw.select(
        _strict("store_nbr", "long"),
        _strict("city", "string"),
        _strict("state", "string"),
        _strict("type", "string"),
        _lenient("cluster", "long"),
    )


def native_holidays(raw: DataFrame) -> DataFrame:
    return raw.select(
        _strict("date", "date"),
        *[_strict(c, "string") for c in ("type", "locale", "locale_name", "description")],
        parse_bool(F.col("transferred")).alias("transferred"),
    )


def native_oil_prices(raw: DataFrame) -> DataFrame:
    return raw.select(_strict("date", "date"), _lenient("dcoilwtico", "double"))


def native_transactions(raw: DataFrame) -> DataFrame:
    return raw.select(_strict("date", "date"), _strict("store_nbr", "long"), _lenient("transactions", "long"))


NATIVE = {
    "sales": native_sales,
    "items": native_items,
    "stores": native_stores,
    "holidays": native_holidays,
    "oil_prices": native_oil_prices,
    "transactions": native_transactions,
}


def stg_sales(native: DataFrame) -> DataFrame:
    return native.select(
        _strict("id", "string"),
        _strict("date", "date"),
        _strict("store_nbr", "long"),
        _strict("item_nbr", "long"),
        _strict("onpromotion", "boolean"),
        _strict("unit_sales", "double"),
    )


def stg_items(native: DataFrame) -> DataFrame:
    return native.select(
        _strict("item_nbr", "long"),
        clean_family(F.col("family")).alias("family"),
        _lenient("class", "long"),
        _lenient("perishable", "long"),
    )


def stg_stores(native: DataFrame) -> DataFrame:
    return native_stores(native)


def stg_holidays(native: DataFrame) -> DataFrame:
    return native_holidays(native)


def stg_oil_prices(native: DataFrame) -> DataFrame:
    return native.select(_strict("date", "date"), F.col("dcoilwtico").try_cast("double").alias("dcoil_raw"))
