"""Declared schemas of the typed tables, as DDL text."""

from __future__ import annotations

_KEYS = "date DATE, store_nbr STRING, item_nbr STRING"
_SERIES = (
    "lag1_log_sales DOUBLE, lag7_log_sales DOUBLE, lag14_log_sales DOUBLE, lag28_log_sales DOUBLE, "
    "rm7_log_sales DOUBLE, rm28_log_sales DOUBLE, promo_in_last_7d BIGINT"
)
_CALENDAR = "dow BIGINT, month BIGINT, year BIGINT"
CLEAN = (
    "date DATE, store_nbr STRING, item_nbr STRING, class STRING, cluster STRING, family STRING, unit_sales DOUBLE, "
    f"log_sales DOUBLE, base_price DOUBLE, discount_pct DOUBLE, effective_price DOUBLE, time_to_expiry BIGINT, {_CALENDAR}"
)
_OIL = "dcoil DOUBLE, dcoil_ma7 DOUBLE, dcoil_ma30 DOUBLE, pct_change_1d DOUBLE, pct_change_7d DOUBLE"
_CHOICE = "policy_discount_pct DOUBLE, policy_effective_price DOUBLE, pred_units_policy DOUBLE, policy_revenue DOUBLE"

NATIVE = {
    "sales": "id STRING, date DATE, store_nbr BIGINT, item_nbr BIGINT, onpromotion BOOLEAN, unit_sales DOUBLE",
    "items": "item_nbr BIGINT, family STRING, class BIGINT, perishable BIGINT",
    "stores": "store_nbr BIGINT, city STRING, state STRING, type STRING, cluster BIGINT",
    "holidays": (
        "date DATE, type STRING, locale STRING, locale_name STRING, description STRING, transferred BOOLEAN"
    ),
    "oil_prices": "date DATE, dcoilwtico DOUBLE",
    "transactions": "date DATE, store_nbr BIGINT, transactions BIGINT",
}

TABLES = {
    "int_sales": (
        "id STRING, date DATE, store_nbr BIGINT, item_nbr BIGINT, onpromotion BOOLEAN, unit_sales DOUBLE, "
        "log_sales DOUBLE"
    ),
    "dim_items": "item_nbr BIGINT, family STRING, class BIGINT, perishable_bool BOOLEAN, base_price DOUBLE",
    "dim_stores": "store_nbr BIGINT, city STRING, state STRING, type STRING, cluster BIGINT",
    "dim_oil_prices": f"date DATE, {_OIL}",
    "dim_holidays": "date DATE, is_nat_holiday BOOLEAN",
    "fact": (
        "date DATE, store_nbr BIGINT, item_nbr BIGINT, family STRING, class BIGINT, perishable_bool BOOLEAN, "
        "onpromotion BOOLEAN, unit_sales DOUBLE, log_sales DOUBLE, base_price DOUBLE, discount_pct DOUBLE, "
        "effective_price DOUBLE, shelf_life_days BIGINT, days_since_stock BIGINT, time_to_expiry BIGINT, "
        f"{_CALENDAR}, avg_units_7d DOUBLE, avg_units_14d DOUBLE, city STRING, state STRING, type STRING, "
        "cluster BIGINT, oil_price DOUBLE, oil_price_ma7 DOUBLE, oil_price_ma30 DOUBLE, pct_change_1d DOUBLE, "
        "pct_change_7d DOUBLE"
    ),
    "features_enriched": f"{CLEAN}, {_SERIES}",
    "features_split": f"{CLEAN}, {_SERIES}, split STRING",
    "scoring_frame": (
        f"{_KEYS}, base_price DOUBLE, time_to_expiry BIGINT, {_SERIES}, {_CALENDAR}, family STRING, class STRING, "
        "cluster STRING, store_nbr_cat STRING, baseline_discount_pct DOUBLE, baseline_effective_price DOUBLE, "
        "observed_unit_sales DOUBLE"
    ),
}

POLICY = {
    "candidates": (
        f"{_KEYS}, cand_discount_pct DOUBLE, cand_effective_price DOUBLE, predicted_unit_sales DOUBLE, "
        f"pred_units DOUBLE, base_price DOUBLE, time_to_expiry BIGINT, {_SERIES}, {_CALENDAR}, family STRING, "
        "class STRING, store_nbr_cat STRING, cluster STRING"
    ),
    "choice": f"{_KEYS}, {_CHOICE}",
    "eval": (
        f"{_KEYS}, baseline_discount_pct DOUBLE, baseline_effective_price DOUBLE, pred_units_baseline DOUBLE, "
        f"baseline_revenue DOUBLE, {_CHOICE}"
    ),
}
