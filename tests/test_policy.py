import datetime as dt

import pytest
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast.operators import kpis, policy, quality

SCHEMA = (
    "date date, store_nbr string, item_nbr string, base_price double, time_to_expiry long, lag1_log_sales double, "
    "lag7_log_sales double, lag14_log_sales double, lag28_log_sales double, rm7_log_sales double, "
    "rm28_log_sales double, promo_in_last_7d long, dow long, month long, year long, family string, class string, "
    "cluster string, store_nbr_cat string, baseline_discount_pct double, baseline_effective_price double, "
    "observed_unit_sales double"
)


def frame(spark, *rows):
    """Rows of (item, base_price, days left, rm7)."""
    return spark.createDataFrame(
        [
            (dt.date(2017, 8, 1), "1", i, p, t, 1.0, 1.0, 1.0, 1.0, rm, 1.0, 1, 3, 8, 2017, "DAIRY", "10", "4", "1")
            + (0.3, None if p is None else round(p * 0.7, 2), 5.0)
            for i, p, t, rm in rows
        ],
        SCHEMA,
    )


def values(df):
    return sorted(tuple(r[c] for c in policy.EVAL_COLUMNS) for r in df.collect())


def stepwise(f, scorer):
    choice = policy.choose(policy.score_candidates(policy.candidates(f), scorer))
    return policy.join_eval(policy.baseline(f, scorer), choice)


def test_sweep_equals_the_stepwise_tables(spark):
    f = frame(spark, ("1", 5.0, 0, 1.3), ("2", 3.33, 1, 0.7), ("3", 18.0, 2, 2.0))
    scorer = policy.FormulaScorer()
    assert values(policy.sweep(f, scorer)) == values(stepwise(f, scorer))
    scored = policy.score_candidates(policy.candidates(f), scorer)
    assert sorted(policy.choose(scored).collect()) == sorted(policy.choose_by_rank(scored).collect())


def test_best_candidate_beats_every_candidate(spark):
    f = frame(spark, *[(str(i), 3.0 + i, i % 3, 0.2 * i) for i in range(12)])
    scored = policy.score_candidates(policy.candidates(f), policy.FormulaScorer())
    best = policy.choose(scored)
    worse = scored.join(best, K.KEYS).where(F.col("cand_effective_price") * F.col("pred_units") > F.col("policy_revenue"))
    assert worse.count() == 0
    assert {r[0] for r in best.select("policy_discount_pct").collect()} <= set(K.DISCOUNT_GRID)


def test_equal_revenue_takes_the_lowest_discount(spark):
    f = frame(spark, ("1", 5.0, 0, 0.0))
    for result in (policy.sweep(f, policy.FormulaScorer()), stepwise(f, policy.FormulaScorer())):
        row = result.first()
        assert (row.policy_discount_pct, row.policy_revenue) == (0.0, 0.0)


class HalfBlind(policy.FormulaScorer):
    """No prediction for small discounts."""

    def units(self, discount):
        return F.when(discount > 0.35, super().units(discount))


def test_missing_revenue_loses(spark):
    f = frame(spark, ("1", 5.0, 2, 1.0))
    for result in (policy.sweep(f, HalfBlind()), stepwise(f, HalfBlind())):
        assert result.first().policy_discount_pct == 0.4


def test_repeated_keys_keep_their_rows(spark):
    f = frame(spark, ("1", 5.0, 0, 1.0), ("1", 5.0, 0, 1.0), ("1", 9.0, 2, 1.0))
    assert policy.sweep(f, policy.FormulaScorer()).count() == 3


def test_custom_grid_and_empty_input(spark):
    f = frame(spark, ("1", 5.0, 0, 1.0))
    assert policy.sweep(f, policy.FormulaScorer(), grid=[0.25]).first().policy_discount_pct == 0.25
    none = policy.sweep(f.limit(0), policy.FormulaScorer(), keep=["time_to_expiry"])
    assert none.columns == [*policy.EVAL_COLUMNS, "time_to_expiry"] and none.count() == 0
    row = kpis.overall(none).first()
    assert row.n_rows == 0 and row.uplift_pct is None
    assert kpis.peak_gap(kpis.by_date(none)).count() == 0
    assert kpis.peak_uplift(kpis.by_expiry(none)).count() == 0


def test_sweep_needs_no_shuffle(spark):
    f = frame(spark, ("1", 5.0, 0, 1.0))
    plan = policy.sweep(f, policy.FormulaScorer(), keep=["time_to_expiry"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def evaluation(spark, rows):
    return spark.createDataFrame(
        rows,
        "date date, baseline_discount_pct double, policy_discount_pct double, baseline_revenue double, "
        "policy_revenue double, time_to_expiry long",
    )


def test_zero_baseline_gives_no_uplift(spark):
    e = evaluation(spark, [(dt.date(2017, 8, 1), 0.3, 0.2, 0.0, 5.0, 1)])
    row = kpis.overall(e).first()
    assert row.uplift_pct is None and row.uplift_abs == 5.0 and row.corr_discount_vs_expiry is None
    assert kpis.by_expiry(e).first().uplift_pct is None


def test_peaks(spark):
    d = [dt.date(2017, 8, n) for n in (1, 2, 3, 4)]
    gaps = [5.0, 9.0, 9.0, -2.0]
    e = evaluation(spark, [(x, 0.3, 0.2, 10.0, 10.0 + g, i) for i, (x, g) in enumerate(zip(d, gaps))])
    peaks = {r.kind: (r.date, r.gap) for r in kpis.peak_gap(kpis.by_date(e)).collect()}
    assert peaks == {"peak_positive": (d[1], 9.0), "peak_negative": (d[3], -2.0)}
    gains_only = kpis.peak_gap(kpis.by_date(e.where(F.col("policy_revenue") > 10))).collect()
    assert [r.kind for r in gains_only] == ["peak_positive"]
    top = kpis.peak_uplift(kpis.by_expiry(e)).first()
    assert top.expiry_bucket == "0-1d" and top.uplift_pct_pp == pytest.approx(70.0)


def test_checks_report_their_failures(spark):
    df = spark.createDataFrame([(1, -1.0), (1, 5.0), (2, None), (None, 300.0)], "k long, unit_sales double")
    assert quality.not_null(df, "k").count() == 1
    assert quality.accepted_range(df, "unit_sales", 0, 200).count() == 2
    assert quality.no_negative(df).count() == 1
    assert quality.accepted_values(df, "k", [1]).count() == 1
    assert quality.expression_is_true(df, "unit_sales > 0").count() == 2
    assert [(r.k, r.n_records) for r in quality.unique(df, "k").collect()] == [(1, 2)]
    checks = [*quality.missing("k", "unit_sales"), quality.KeyCheck(("k",)), quality.KeyCheck(("k", "unit_sales"), "grain")]
    got = {(r.column_name, r.check_name): r.failures for r in quality.report({"t": df}, {"t": checks}).collect()}
    assert got == {("k", "not_null"): 1, ("unit_sales", "not_null"): 1, ("k", "unique"): 1, ("k,unit_sales", "grain"): 0}
