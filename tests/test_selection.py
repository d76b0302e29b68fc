"""Exact quantiles against sorting, and distinct counts from stored day sketches."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ripecast.operators import model, profile, selection
from ripecast.sources.snapshots import SliceTable

SHARES = {"low": 0.01, "mid": 0.5, "high": 0.95, "first": 0.0, "last": 1.0, "seven": 0.07}


def by_sorting(values, share):
    known = sorted(v for v in values if v is not None)
    return known[selection.rank_of(share, len(known)) - 1] if known else None


def test_ranks_are_exact():
    assert [selection.rank_of(s, 100) for s in (0.0, 0.01, 0.07, 0.5, 0.951, 1.0)] == [1, 1, 7, 50, 96, 100]
    assert selection.rank_of(0.29, 10**17) == 29 * 10**15


@pytest.mark.parametrize("few, accuracy", [(10_000, 10_000), (20, 50), (1, 20)])
def test_quantiles_equal_sorting(spark, few, accuracy):
    r = np.random.default_rng(2)
    columns = {
        "spread": np.exp(r.normal(size=3_000) * 40),
        "ties": np.repeat([3.0, -1.0, 8.0], 1_000),
        "signed": r.normal(size=3_000) * np.where(r.random(3_000) < 0.01, 1e250, 1.0),
        "few": np.where(np.arange(3_000) < 5, np.arange(3_000), np.nan),
    }
    rows = [tuple(None if math.isnan(v) else float(v) for v in row) for row in zip(*columns.values())]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).withColumn("none", F.lit(None).cast("double")).repartition(3)
    wanted = {f"{c}:{s}": (F.col(c), p) for c in [*columns, "none"] for s, p in SHARES.items()}
    got = selection.quantiles(df, wanted, accuracy, few)
    lists = {c: [row[k] for row in rows] for k, c in enumerate(columns)} | {"none": []}
    assert got == {f"{c}:{s}": by_sorting(lists[c], p) for c in lists for s, p in SHARES.items()}


def test_a_misleading_sketch_costs_rounds_only(spark, monkeypatch):
    df = spark.range(5_000).select(F.col("id").cast("double").alias("v"))
    real, wrong = F.percentile_approx, iter([(0.0, 10.0), (4_000.0, 4_500.0)])

    def misled(column, shares, accuracy):
        pair = next(wrong, None)
        return real(column, shares, accuracy) if pair is None else F.array(*[F.max(F.lit(v)) for v in pair])

    monkeypatch.setattr(F, "percentile_approx", misled)
    assert selection.quantiles(df, {"m": (F.col("v"), 0.5)}, few=10)["m"] == 2_499.0


def test_exact_median_of_metrics(spark):
    df = spark.range(30_001).select((F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("unit_sales"), F.lit(0.0).alias("predicted_unit_sales"))
    values = sorted(r.unit_sales for r in df.collect())
    assert model.metrics(df, exact=True).first().median_absolute_error == values[15_000]
    assert model.metrics(df.limit(0), exact=True).first().median_absolute_error is None


def test_a_new_day_adds_one_sketch(spark, tmp_path):
    columns = ["date", *dict.fromkeys(profile.DISTINCT_COLUMNS.values())]

    def day(d, n):
        rows = spark.range(n).select(F.lit(dt.date(2020, 1, d)).alias("date"), *[(F.col("id") + d * 1_000 * (k % 3)).cast("string").alias(c) for k, c in enumerate(columns[1:])])
        return rows.unionByName(rows)

    table = SliceTable(spark, str(tmp_path / "t"), f"date DATE, {profile.CARDINALITY_STATE}")
    facts = [day(d, 20_000) for d in (1, 2, 3)]
    for k, fact in enumerate(facts):
        table.write(profile.cardinality_states(fact))
        assert table.read().count() == k + 1
    whole = facts[0].unionByName(facts[1]).unionByName(facts[2])
    exact, guess = profile.cardinality(whole).first(), profile.cardinality_of(table.read()).first()
    for name in profile.DISTINCT_COLUMNS:
        assert abs(guess[name] - exact[name]) <= 0.065 * exact[name], name
    assert set(profile.cardinality_of(table.read().limit(0)).first()) == {0}
