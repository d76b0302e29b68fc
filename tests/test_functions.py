import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ripecast import functions as X
from ripecast.plans import dims, fact, features, staging


def column(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_parse_bool(spark):
    words = ["true", "TRUE", "1", "Yes", "false", "0", "no", "NO", "t", "y", "", "other", None]
    want = [True] * 4 + [False] * 4 + [None] * 5
    assert column(spark, words, "string", X.parse_bool) == want


def test_clip_keeps_null(spark):
    assert column(spark, [None, -3.0, 0.0, 7.5, 200.0, 900.0], "double", X.clip_units) == [None, 0, 0, 7.5, 200, 200]
    assert column(spark, [None, 0.0, math.e - 1], "double", X.log_units) == [None, 0.0, pytest.approx(1.0)]


@settings(max_examples=5, deadline=None)
@given(values=st.lists(st.one_of(st.none(), st.floats(allow_nan=False)), min_size=1, max_size=60))
def test_clip_property(spark, values):
    got = column(spark, values, "double", X.clip_units)
    assert got == [None if v is None else min(max(v, 0.0), 200.0) for v in values]


def test_ladder_and_bucket_edges(spark):
    days = list(range(0, 9))
    assert column(spark, days, "long", X.discount_ladder) == [0.5, 0.4, 0.3, 0.2, 0.1, 0.1, 0.0, 0.0, 0.0]
    assert column(spark, days, "long", X.expiry_bucket) == ["0-1d"] * 2 + ["2-3d"] * 2 + ["4-5d"] * 2 + ["6d+"] * 3


def test_family_names_and_shelf_life(spark):
    names = ["BREAD/BAKERY", "PREPARED FOODS", "DAIRY", "LAWN AND GARDEN", None]
    clean = ["BREAD_BAKERY", "PREPARED_FOODS", "DAIRY", "LAWN_AND_GARDEN", None]
    assert column(spark, names, "string", X.clean_family) == clean
    assert column(spark, clean, "string", X.shelf_life) == [3, 3, 10, 14, 14]


def test_hash_is_stable_and_in_range(spark):
    got = column(spark, list(range(500)), "long", X.hash_unit)
    assert all(0 <= u < 1 for u in got) and len(set(got)) > 490
    assert got == column(spark, list(range(500)), "long", X.hash_unit)


def test_stock_age_and_expiry_stay_in_the_shelf_life(spark):
    df = spark.range(2000).select(
        (F.col("id") % 50).alias("s"), F.col("id").alias("i"), F.lit(dt.date(2017, 1, 1)).alias("d"), F.lit(5).alias("life")
    )
    age = X.stock_age(X.stable_hash(F.col("s"), F.col("i"), F.col("d")), F.col("life"))
    seen = df.select(age.alias("a"), X.time_to_expiry(F.col("life"), age).alias("t")).distinct().collect()
    assert {r["a"] for r in seen} == set(range(6)) and all(r["a"] + r["t"] == 5 for r in seen)


def test_money_rounds_half_up(spark):
    assert column(spark, [1.005, 2.675, 0.125, -1.005, None], "double", X.money_round) == [1.01, 2.68, 0.13, -1.01, None]


def test_split_label_edges(spark):
    days = [dt.date(2017, 7, 17), dt.date(2017, 7, 18), dt.date(2017, 7, 31), dt.date(2017, 8, 1), dt.date(2018, 1, 1)]
    assert column(spark, days, "date", X.split_label) == ["train", "valid", "valid", "test", "test"]


def test_safe_corr(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0)], "a double, b double, k double")
    row = df.select(X.safe_corr(F.col("a"), F.col("b")), X.safe_corr(F.col("a"), F.col("k"))).first()
    assert row[0] == pytest.approx(1.0) and row[1] is None


def test_bad_text_is_null_for_measures_and_fails_for_keys(spark):
    columns = "id string, date string, store_nbr string, item_nbr string, onpromotion string, unit_sales string"
    good = ("1", "2017-01-02", "3", "4", "maybe", "many")
    row = staging.native_sales(spark.createDataFrame([good], columns)).first()
    assert (row.store_nbr, row.onpromotion, row.unit_sales) == (3, None, None)
    bad = spark.createDataFrame([("1", "2017-01-02", "three", "4", "no", "1")], columns)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.native_sales(bad).collect()


def test_null_sales_stay_null_and_promotion_defaults_to_no(spark):
    stg = spark.createDataFrame(
        [("a", dt.date(2017, 1, 1), 1, 1, None, None)],
        "id string, date date, store_nbr long, item_nbr long, onpromotion boolean, unit_sales double",
    )
    row = dims.int_sales(stg).first()
    assert row.unit_sales is None and row.log_sales is None and row.onpromotion is False


def items(spark):
    raw = [(1, "DAIRY", 10, 1), (2, "dairy", 10, 1), (3, "BREAD/BAKERY", 11, 0), (4, "TOYS", 12, None), (5, "EGGS", 1, 7)]
    native = spark.createDataFrame(raw, "item_nbr long, family string, class long, perishable long")
    return staging.stg_items(native)


def test_item_dimension(spark):
    stg = items(spark)
    got = {r.item_nbr: r for r in dims.dim_items(dims.int_items(stg)).collect()}
    assert [got[i].perishable_bool for i in range(1, 6)] == [True, True, False, False, False]
    assert 4.0 <= got[1].base_price <= 7.0 and got[2].base_price is None and got[4].base_price is None
    assert got[3].family == "BREAD_BAKERY"
    prices = dims.int_base_price(stg)
    joined = dims.int_items(stg).join(prices, ["item_nbr", "family"], "left")
    assert {r.item_nbr: r.base_price for r in joined.collect()} == {i: got[i].base_price for i in got}


def test_unpriced_rows_leave_the_features(spark):
    sales = spark.createDataFrame(
        [(f"{i}", dt.date(2017, 1, 1), 1, i, False, 2.0, 1.0) for i in range(1, 6)],
        "id string, date date, store_nbr long, item_nbr long, onpromotion boolean, unit_sales double, log_sales double",
    )
    priced = fact.priced_sales(sales, dims.dim_items(dims.int_items(items(spark))))
    assert sorted(r.item_nbr for r in priced.collect()) == [1, 2]
    assert [r.item_nbr for r in priced.where(features.has_valid_price()).collect()] == [1]


def test_holiday_rules(spark):
    d = [dt.date(2017, 1, n) for n in range(1, 9)]
    rows = [
        (d[0], "Holiday", "National", False),
        (d[1], "Holiday", "National", True),
        (d[2], "Transfer", "National", None),
        (d[3], "Work Day", "National", False),
        (d[4], "Event", "National", False),
        (d[5], "Holiday", "Local", False),
        (d[6], "Holiday", "National", None),
        (d[7], "Event", "National", False),
        (d[7], "Bridge", "National", False),
    ]
    stg = spark.createDataFrame(rows, "date date, type string, locale string, transferred boolean")
    got = {r.date: r.is_nat_holiday for r in dims.int_holidays(stg).collect()}
    assert [got[x] for x in d] == [True, False, True, False, False, False, True, True]


def oil(spark, quotes):
    return spark.createDataFrame(quotes, "date date, dcoil_raw double")


def sold(spark, *days):
    return spark.createDataFrame([(x,) for x in days], "date date")


def test_oil_series(spark):
    d = [dt.date(2017, 1, n) for n in range(1, 6)]
    sales = sold(spark, d[0], d[4])
    quotes = oil(spark, [(d[0], None), (d[1], 10.0), (d[3], 20.0), (d[3], 40.0)])
    got = dims.int_oil_prices(sales, quotes).orderBy("date").collect()
    assert [r.date for r in got] == d[1:]
    assert [r.dcoil for r in got] == [10.0, 10.0, 30.0, 30.0]
    assert [r.dcoil_ma7 for r in got] == [10.0, 10.0, pytest.approx(50 / 3), 20.0]
    assert [r.pct_change_1d for r in got] == [None, 0.0, 2.0, 0.0]
    assert dims.int_oil_prices(sales, oil(spark, [(d[0], None)])).count() == 0
    assert dims.int_oil_prices(sales, oil(spark, [(dt.date(2018, 1, 1), 1.0)])).count() == 0


def test_oil_history_can_seed_the_first_days(spark):
    sales = sold(spark, dt.date(2017, 1, 3), dt.date(2017, 1, 4))
    quotes = oil(spark, [(dt.date(2017, 1, 1), 5.0), (dt.date(2017, 1, 4), 6.0)])
    plain = [r.dcoil for r in dims.int_oil_prices(sales, quotes).orderBy("date").collect()]
    seeded = [r.dcoil for r in dims.int_oil_prices(sales, quotes, seed_history=True).orderBy("date").collect()]
    assert (plain, seeded) == ([None, 6.0], [5.0, 6.0])


@settings(max_examples=3, deadline=None)
@given(position=st.integers(0, 44), value=st.floats(0, 5))
def test_features_never_see_their_own_day(spark, position, value):
    """Changing the target of one day leaves the features of that day and all earlier ones alone."""
    start = dt.date(2017, 1, 1)
    base = [("1", "1", start + dt.timedelta(days=i), (i * 7 % 5) / 2.0, 0.1 * (i % 2)) for i in range(45)]
    changed = [(*r[:3], value if i == position else r[3], r[4]) for i, r in enumerate(base)]

    def build(rows):
        clean = spark.createDataFrame(
            rows, "store_nbr string, item_nbr string, date date, log_sales double, discount_pct double"
        )
        got = features.features_enriched(clean, None, min_history=None).where(F.col("date") <= base[position][2])
        return [tuple(r[c] for c in features.SERIES_FEATURES) for r in got.orderBy("date").collect()]

    assert build(base) == build(changed)


def test_first_row_of_a_series_has_no_features(spark):
    clean = spark.createDataFrame(
        [("1", "1", dt.date(2017, 1, 1), 1.0, 0.1)],
        "store_nbr string, item_nbr string, date date, log_sales double, discount_pct double",
    )
    row = features.features_enriched(clean, None, min_history=None).first()
    assert [row[c] for c in features.SERIES_FEATURES] == [None] * 7
