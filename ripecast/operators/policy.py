"""Discount policy: candidate grid, scoring, best candidate and comparison with the baseline.

Two ways lead to the same rows. The step-by-step tables (candidates, choice, baseline, eval) are long and keyed. The
:func:`sweep` keeps the candidates of a row beside it in columns, so the whole range of days is one narrow job without
a shuffle, whatever the key distribution.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast.functions import effective_price

FRAME_FEATURES = [
    "base_price",
    "time_to_expiry",
    "lag1_log_sales",
    "lag7_log_sales",
    "lag14_log_sales",
    "lag28_log_sales",
    "rm7_log_sales",
    "rm28_log_sales",
    "promo_in_last_7d",
    "dow",
    "month",
    "year",
    "family",
    "class",
    "cluster",
]
EVAL_COLUMNS = [
    *K.KEYS,
    "baseline_discount_pct",
    "baseline_effective_price",
    "pred_units_baseline",
    "baseline_revenue",
    "policy_discount_pct",
    "policy_effective_price",
    "pred_units_policy",
    "policy_revenue",
]


class Scorer(Protocol):
    """Predicts units. ``prepare`` runs once per frame; ``score`` once per (price, discount) pair of columns."""

    def prepare(self, df: DataFrame) -> DataFrame: ...

    def score(self, df: DataFrame, price: str, discount: str, output: str) -> DataFrame: ...

    def finish(self, df: DataFrame) -> DataFrame: ...


class FormulaScorer:
    """Demand as a closed formula of the features: recent level, lifted by the discount, more so near expiry."""

    def prepare(self, df: DataFrame) -> DataFrame:
        return df

    def units(self, discount: Column) -> Column:
        pull = F.greatest(F.lit(4.0) - F.lit(1.25) * F.col("time_to_expiry"), F.lit(0.0))
        return F.expm1("rm7_log_sales") * (F.lit(1.0) + pull * discount)

    def score(self, df: DataFrame, price: str, discount: str, output: str) -> DataFrame:
        return df.withColumn(output, self.units(F.col(discount)))

    def finish(self, df: DataFrame) -> DataFrame:
        return df


def scoring_frame(split: DataFrame, max_expiry: int = K.NEAR_EXPIRY_DAYS) -> DataFrame:
    """Test rows near expiry, with today's price and discount as the baseline."""
    return split.where((F.col("split") == "test") & (F.col("time_to_expiry") <= max_expiry)).select(
        *K.KEYS,
        *FRAME_FEATURES,
        F.col("store_nbr").alias("store_nbr_cat"),
        F.col("discount_pct").alias("baseline_discount_pct"),
        F.col("effective_price").alias("baseline_effective_price"),
        F.col(K.LABEL).alias("observed_unit_sales"),
    )


def in_days(frame: DataFrame, start: str | dt.date | None, end: str | dt.date | None) -> DataFrame:
    """Inclusive date range, pruned by the scan on a date-partitioned table."""
    if start is not None:
        frame = frame.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        frame = frame.where(F.col("date") <= F.lit(end).cast("date"))
    return frame


def candidates(frame: DataFrame, grid: Sequence[float] = tuple(K.DISCOUNT_GRID)) -> DataFrame:
    """One row per frame row and candidate discount, with the price the model sees."""
    rows = frame.select(
        *K.KEYS, *FRAME_FEATURES, F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("cand_discount_pct")
    )
    return rows.withColumn(
        "cand_effective_price", effective_price(F.col("base_price"), F.col("cand_discount_pct"))
    ).withColumns({"effective_price": F.col("cand_effective_price"), "discount_pct": F.col("cand_discount_pct")})


def score_candidates(cands: DataFrame, scorer: Scorer) -> DataFrame:
    """Candidates with the prediction, in the layout of the candidate table."""
    scored = scorer.score(scorer.prepare(cands), "effective_price", "discount_pct", "predicted_unit_sales")
    head = ["cand_discount_pct", "cand_effective_price", "predicted_unit_sales"]
    return scorer.finish(scored).select(
        *K.KEYS,
        *head,
        F.col("predicted_unit_sales").alias("pred_units"),
        *[c for c in FRAME_FEATURES if c != "cluster"],
        F.col("store_nbr").alias("store_nbr_cat"),
        "cluster",
    )


def _ranked(discount: Column, price: Column, units: Column) -> Column:
    """Candidate that sorts by revenue, NULL lowest, and by the smaller discount on equal revenue."""
    return F.struct(
        (price * units).alias("revenue"),
        (-discount).alias("order"),
        discount.alias("discount"),
        price.alias("price"),
        units.alias("units"),
    )


def _policy_columns(best: Column) -> list[Column]:
    return [
        best["discount"].alias("policy_discount_pct"),
        best["price"].alias("policy_effective_price"),
        best["units"].alias("pred_units_policy"),
        best["revenue"].alias("policy_revenue"),
    ]


def choose(scored: DataFrame) -> DataFrame:
    """Best candidate per key. A partial aggregate keeps one candidate per key and map task before the shuffle."""
    best = F.max(_ranked(F.col("cand_discount_pct"), F.col("cand_effective_price"), F.col("pred_units")))
    grouped = scored.groupBy(*K.KEYS).agg(best.alias("_best"))
    return grouped.select(*K.KEYS, *_policy_columns(F.col("_best")))


def choose_by_rank(scored: DataFrame) -> DataFrame:
    """The same choice through a ranking window, which Spark cuts to one row per group before the shuffle."""
    revenue = F.col("cand_effective_price") * F.col("pred_units")
    w = Window.partitionBy(*K.KEYS).orderBy(revenue.desc_nulls_last(), "cand_discount_pct")
    best = scored.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1)
    return best.select(
        *K.KEYS,
        F.col("cand_discount_pct").alias("policy_discount_pct"),
        F.col("cand_effective_price").alias("policy_effective_price"),
        F.col("pred_units").alias("pred_units_policy"),
        revenue.alias("policy_revenue"),
    )


def baseline(frame: DataFrame, scorer: Scorer) -> DataFrame:
    """Prediction and revenue at today's price."""
    rows = frame.select(*K.KEYS, *FRAME_FEATURES, "baseline_discount_pct", "baseline_effective_price")
    rows = scorer.score(
        scorer.prepare(rows), "baseline_effective_price", "baseline_discount_pct", "pred_units_baseline"
    )
    return scorer.finish(rows).select(
        *K.KEYS,
        "baseline_discount_pct",
        "baseline_effective_price",
        "pred_units_baseline",
        (F.col("baseline_effective_price") * F.col("pred_units_baseline")).alias("baseline_revenue"),
    )


def join_eval(base: DataFrame, choice: DataFrame) -> DataFrame:
    """Baseline and choice side by side."""
    return base.join(choice, K.KEYS).select(*EVAL_COLUMNS)


def sweep(
    frame: DataFrame,
    scorer: Scorer,
    grid: Sequence[float] = tuple(K.DISCOUNT_GRID),
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Policy against baseline for a range of days: one row per frame row, computed in place.

    ``keep`` carries frame columns (time_to_expiry for the KPIs) into the result, which saves joining them back.
    """
    rows = scorer.prepare(in_days(frame, start, end))
    rows = scorer.score(rows, "baseline_effective_price", "baseline_discount_pct", "pred_units_baseline")
    ranked = []
    for i, g in enumerate(grid):
        discount, price, units = f"_discount_{i}", f"_price_{i}", f"_units_{i}"
        rows = rows.withColumn(discount, F.lit(float(g)))
        rows = rows.withColumn(price, effective_price(F.col("base_price"), F.col(discount)))
        rows = scorer.score(rows, price, discount, units)
        ranked.append(_ranked(F.col(discount), F.col(price), F.col(units)))
    return (
        scorer.finish(rows)
        .withColumn("_best", F.array_max(F.array(*ranked)))
        .select(
            *K.KEYS,
            "baseline_discount_pct",
            "baseline_effective_price",
            "pred_units_baseline",
            (F.col("baseline_effective_price") * F.col("pred_units_baseline")).alias("baseline_revenue"),
            *_policy_columns(F.col("_best")),
            *keep,
        )
    )
