"""Registered queries against their SQL. The default set reaches every shared table; RIPECAST_ALL=1 runs them all."""

import os

import pytest
from compare import compare, duck

import __spark_entry__ as entry_points
import catalog

CORE = [
    "cast_strict",
    "cat_unknown",
    "discount_bin",
    "dim_holidays",
    "dim_items",
    "dq_report",
    "eda_cardinality",
    "eda_distribution",
    "eda_oil_corr",
    "eda_promo_family",
    "eda_store_hetero",
    "eval_metrics",
    "fct_sales_features",
    "features_enriched",
    "features_split",
    "hash_shard",
    "int_sales",
    "join_item_price",
    "join_policy_baseline",
    "kpi_by_date",
    "kpi_by_expiry",
    "kpi_discount_dist",
    "kpi_overall",
    "kpi_overall_states",
    "peak_gap",
    "peak_uplift",
    "policy_eval",
    "policy_score",
    "safe_divide",
    "sink_idempotent_slice",
    "src_csv_split",
    "tx_signals",
    "union_slices",
    "vocab_fit",
    "win_lags",
    "win_series_split",
    "win_series_tail",
    "win_series_tail_state",
]
NAMES = sorted(catalog.SQL) if os.environ.get("RIPECAST_ALL") else CORE


@pytest.fixture(scope="module")
def con(sample):
    return duck(sample)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, sample, con, name):
    assert compare(catalog.QUERIES[name](spark, sample), con, catalog.SQL[name]) is None


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    without = set(catalog.QUERIES) - set(catalog.SQL)
    assert without == {"train_gbt", "train_gbt_alt", "predict", "feature_importance", "policy_sweep_model"}
