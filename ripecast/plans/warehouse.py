"""All tables of the pipeline over one set of raw tables; each is built on first use and stays lazy."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import cache, cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast import schemas
from ripecast.operators import boosting, kpis, model, policy, quality
from ripecast.operators.series import MAX_SERIES_ROWS
from ripecast.plans import contracts, daily, dims, fact, features, sales_checks, staging
from ripecast.sources import files, snapshots, tables
from ripecast.sources.deliveries import read_raw
from ripecast.sources.sample_retail import SPLIT, SampleRetail


# Stored tables in build order, with partition column and sort keys inside a partition.
LAYERS: list[tuple[str, str | None, list[str]]] = [
    ("int_sales", "date", K.SERIES),
    ("dim_items", None, ["item_nbr"]),
    ("dim_stores", None, ["store_nbr"]),
    ("dim_oil_prices", None, ["date"]),
    ("dim_holidays", None, ["date"]),
    ("fact", "date", K.SERIES),
    ("features_split", "date", K.SERIES),
    ("scoring_frame", "date", K.SERIES),
]


def policy_tables(spark: SparkSession, base: str) -> dict[str, snapshots.SliceTable]:
    """The tables that a policy run keeps, by name."""
    evaluation = f"{schemas.POLICY['eval']}, time_to_expiry BIGINT"
    made = lambda name, schema, **more: snapshots.SliceTable(spark, f"{base}/{name}", schema, "date", **more)
    return {
        "policy_candidates": made("policy_candidates", schemas.POLICY["candidates"], cluster=K.SERIES),
        "policy_choice": made("policy_choice", schemas.POLICY["choice"], cluster=K.SERIES),
        "policy_eval": made("policy_eval", evaluation, cluster=K.SERIES),
        "policy_eval_csv": made("policy_eval_csv", evaluation, cluster=K.SERIES, format="csv"),
        "kpi_states": made("kpi_states", kpis.STATE),
    }


def kpis_of(states: DataFrame) -> dict[str, DataFrame]:
    """The four KPI tables from day states."""
    return {
        "kpi_overall": kpis.overall_of(states),
        "kpi_by_date": kpis.by_date_of(states),
        "kpi_by_expiry": kpis.by_expiry_of(states),
        "kpi_discount_dist": kpis.discount_distribution_of(states),
    }


# Tables and the tables that are their rows under another name.
TWINS = [("stg_stores", "dim_stores"), ("int_oil_prices", "dim_oil_prices"), ("int_holidays", "dim_holidays")]
# The file that names the folder of the last complete build.
CURRENT = "CURRENT"


class Warehouse:
    """``raw`` returns a raw table by name. ``max_rows=None`` states that sales are unique per (date, store, item), so no series needs splitting."""

    def __init__(
        self,
        raw: Callable[[str], DataFrame],
        split: Mapping[str, object] | None = None,
        max_rows: int | None = MAX_SERIES_ROWS,
        sale_days: Callable[[], DataFrame] | None = None,
        name: str = "",
    ):
        self.name = name
        self._sale_days = sale_days
        self.raw = cache(raw)
        self.split = dict(split or {})
        self.max_rows = max_rows
        self._stored = False

    @classmethod
    def from_sample(cls, spark: SparkSession, folder: str) -> Warehouse:
        """Over the sample star schema; its sales come from a group-by on the grain."""
        source = SampleRetail(spark, folder)
        return cls(lambda table: getattr(source, table)(), SPLIT, None, source.sale_days, folder)

    @classmethod
    def from_raw_zone(cls, spark: SparkSession, raw: str, ingest_date: str, **options) -> Warehouse:
        """Over one dated snapshot of CSV deliveries."""
        return cls(lambda table: read_raw(spark, raw, table, ingest_date), **options)

    def native(self, table: str) -> DataFrame:
        return staging.NATIVE[table](self.raw(table))

    @cached_property
    def stg_sales(self) -> DataFrame:
        return staging.stg_sales(self.native("sales"))

    @cached_property
    def stg_items(self) -> DataFrame:
        return staging.stg_items(self.native("items"))

    @cached_property
    def stg_stores(self) -> DataFrame:
        return staging.stg_stores(self.native("stores"))

    @cached_property
    def stg_holidays(self) -> DataFrame:
        return staging.stg_holidays(self.native("holidays"))

    @cached_property
    def stg_oil_prices(self) -> DataFrame:
        return staging.stg_oil_prices(self.native("oil_prices"))

    @cached_property
    def int_sales(self) -> DataFrame:
        return dims.int_sales(self.stg_sales)

    @cached_property
    def sale_days(self) -> DataFrame:
        """Any table whose dates span the sales; the cleaned sales unless the source knows a cheaper one."""
        return self._sale_days() if self._sale_days else self.int_sales

    @cached_property
    def int_items(self) -> DataFrame:
        return dims.int_items(self.stg_items)

    @cached_property
    def int_oil_prices(self) -> DataFrame:
        return dims.int_oil_prices(self.sale_days, self.stg_oil_prices)

    @cached_property
    def int_holidays(self) -> DataFrame:
        return dims.int_holidays(self.stg_holidays)

    @cached_property
    def dim_items(self) -> DataFrame:
        return dims.dim_items(self.int_items)

    @cached_property
    def dim_stores(self) -> DataFrame:
        return dims.dim_stores(self.stg_stores)

    @cached_property
    def dim_oil_prices(self) -> DataFrame:
        return dims.dim_oil_prices(self.int_oil_prices)

    @cached_property
    def dim_holidays(self) -> DataFrame:
        return dims.dim_holidays(self.int_holidays)

    @cached_property
    def tx_signals(self) -> DataFrame:
        return dims.tx_signals(self.native("transactions"), self.max_rows)

    @cached_property
    def fact(self) -> DataFrame:
        return fact.fct_sales_features(
            self.int_sales, self.dim_items, self.dim_stores, self.dim_oil_prices, self.max_rows
        )

    @cached_property
    def features_enriched(self) -> DataFrame:
        return features.features_from_sales(self.int_sales, self.dim_items, self.dim_stores, self.max_rows)

    @cached_property
    def features_split(self) -> DataFrame:
        return features.features_split(self.features_enriched, **self.split)

    @cached_property
    def scoring_frame(self) -> DataFrame:
        return policy.scoring_frame(self.features_split)

    def build(self, root: str) -> Warehouse:
        """Store every layer under a shared folder and go on from the stored tables.

        Each table is computed once; later layers scan it with pruned columns and partitions, and a job that loses
        executors recomputes from the last stored table at most. Every build starts from the raw tables and writes into
        a folder of its own; the pointer file is switched when all layers are there, so a build that fails leaves the
        tables before it readable.
        """
        self._forget()
        version = f"build-{uuid.uuid4().hex}"
        try:
            for name, partition, cluster in LAYERS:
                table = tables.describe(getattr(self, name), contracts.COMMENTS)
                path = f"{root}/{version}/{name}"
                tables.write_table(table, path, partition, cluster)
                self.__dict__[name] = tables.read_table(table.sparkSession, path, schemas.TABLES[name], contracts.COMMENTS)
                if name == "fact":
                    clean = features.features_clean(self.fact)
                    self.__dict__["features_enriched"] = features.features_enriched(clean, self.max_rows)
        except Exception:
            self._forget()
            raise
        files.write_text(table.sparkSession, f"{root}/{CURRENT}", version)
        self._stored = True
        return self

    def open(self, spark: SparkSession, root: str) -> Warehouse:
        """Go on from the layers of the last complete build under ``root``."""
        self._forget()
        version = files.read_text(spark, f"{root}/{CURRENT}").strip()
        for name, _, _ in LAYERS:
            self.__dict__[name] = tables.read_table(spark, f"{root}/{version}/{name}", schemas.TABLES[name], contracts.COMMENTS)
        self._stored = True
        return self

    def feature_days(self, root: str, start: str | None, end: str) -> DataFrame:
        """Store and return the features of the days from ``start`` to ``end`` from the tails under ``root``; of the sales
        only these days are read. Without ``start`` the tables begin anew with everything up to ``end``."""
        clean = features.clean_from_sales(self.int_sales, self.dim_items, self.dim_stores)
        table = daily.DailyFeatures(clean.sparkSession, root, self.max_rows)
        return table.start(clean, end) if start is None else table.append(clean, start, end)

    def _forget(self) -> None:
        """Drop what was derived or stored, so that tables are built from the raw side again."""
        self._stored = False
        for name in [k for k in self.__dict__ if isinstance(getattr(type(self), k, None), cached_property)]:
            del self.__dict__[name]

    def publish(self, prefix: str = "", materialized: str = "view", root: str | None = None) -> None:
        """Expose the tables for ``spark.sql``: staged ones as views, gold ones as views or as described tables under ``root``."""
        for name in ("stg_sales", "stg_items", "stg_stores", "stg_oil_prices", "stg_holidays", "features_enriched"):
            tables.publish(getattr(self, name), f"{prefix if '.' not in prefix else ''}{name}")
        for name, _, _ in LAYERS:
            shown = "fct_sales_features" if name == "fact" else name
            place = f"{root}/{shown}" if root else None
            gold = tables.describe(getattr(self, name), contracts.COMMENTS)
            tables.publish(gold, f"{prefix}{shown}", materialized, contracts.TABLE_COMMENTS[shown], place)

    def run_policy(
        self,
        scorer: policy.Scorer,
        root: str,
        *,
        model: str | None = None,
        grid: Sequence[float] = tuple(K.DISCOUNT_GRID),
        start: str | None = None,
        end: str | None = None,
        shard: int | None = None,
        n_shards: int = 16,
    ) -> dict[str, DataFrame]:
        """Store candidates, choice and evaluation of a slice of days (and of one shard of the series, where given), and
        the KPIs of the whole stored evaluation. Each ``model`` has tables of its own.

        Every table is a ``SliceTable``: each of the slices lands whole or not at all. KPIs come from stored day states,
        of which only the days of the slice are made anew, so a backfill does not reread the evaluation; its CSV form
        is written by slice too.
        """
        base = f"{root}/{model}" if model else root
        frame = policy.in_days(self.scoring_frame, start, end)
        part = None if shard is None else snapshots.Shard(shard, n_shards, tuple(K.SERIES))
        if part is not None:
            frame = frame.where(part.holds())
        scored = policy.score_candidates(policy.candidates(frame, grid), scorer)
        evaluation = policy.sweep(frame, scorer, grid, keep=["time_to_expiry"])
        stored = policy_tables(frame.sparkSession, base)
        stored["policy_candidates"].write(scored, start, end, part)
        stored["policy_eval"].write(evaluation, start, end, part)
        fresh = policy.in_days(stored["policy_eval"].read(), start, end)
        own = fresh if part is None else fresh.where(part.holds())
        stored["policy_choice"].write(own, start, end, part)
        stored["policy_eval_csv"].write(own, start, end, part)
        stored["kpi_states"].write(kpis.day_states(fresh), start, end)
        states = stored["kpi_states"].read()
        results = kpis_of(states)
        for name, table in results.items():
            tables.write_csv(table, f"{base}/{name}")
        return {**{name: table.read() for name, table in stored.items()}, **results}

    def train_model(self, root: str, preset: str = "warehouse", name: str | None = None, **overrides):
        """Fit a model and keep it with its metrics on the valid and test rows and its feature importances."""
        name = name or preset
        fit = boosting.train if preset in boosting.PRESETS else model.train
        fitted = fit(self.features_split, preset, **overrides)
        spark = self.features_split.sparkSession
        if isinstance(fitted, boosting.Booster):
            fitted.save(spark, f"{root}/{name}/model")
        else:
            model.save(fitted, f"{root}/{name}/model")
        scored = model.predict(fitted, self.features_split.where(F.col("split") != "train"))
        by_split = [model.metrics(scored.where(F.col("split") == part)).select(F.lit(part).alias("split"), "*") for part in ("valid", "test")]
        self.store_model_report(name, by_split[0].unionByName(by_split[1]), model.feature_importance(fitted, scored), root)
        return fitted

    def store_model_report(self, model: str, metrics: DataFrame, importance: DataFrame, root: str) -> None:
        """Keep a model's metrics and feature importances beside its policy tables."""
        tables.write_table(metrics, f"{root}/{model}/metrics", None)
        tables.write_table(importance, f"{root}/{model}/feature_importance", None)

    def policy_eval(
        self,
        scorer: policy.Scorer,
        grid: Sequence[float] = tuple(K.DISCOUNT_GRID),
        start: str | None = None,
        end: str | None = None,
    ) -> DataFrame:
        """Policy against baseline, with time_to_expiry kept for the KPIs."""
        return policy.sweep(self.scoring_frame, scorer, grid, start, end, keep=["time_to_expiry"])

    def kpis(self, evaluation: DataFrame) -> dict[str, DataFrame]:
        """The four KPI tables of an evaluation that kept time_to_expiry."""
        return {
            "kpi_overall": kpis.overall(evaluation),
            "kpi_by_date": kpis.by_date(evaluation),
            "kpi_by_expiry": kpis.by_expiry(evaluation),
            "kpi_discount_dist": kpis.discount_distribution(evaluation),
        }

    def report(self) -> DataFrame:
        """Failure counts of every contract check.

        Stored tables are checked one by one, as they are. Before that, tables that are views of the same rows share a
        pass: staged, cleaned and featured sales read the sales once.
        """
        checks = contracts.contracts()
        frames = {t: lambda t=t: self.fact if t == "fct_sales_features" else getattr(self, t) for t in checks}
        if self._stored:
            return quality.report({t: f() for t, f in frames.items()}, checks)
        parts = [sales_checks.report(self.stg_sales, self.dim_items, self.dim_stores, {t: checks.pop(t) for t in sales_checks.TABLES})]
        for base, twin in TWINS:
            parts.append(quality.shared_report(frames[base](), {t: checks.pop(t) for t in (base, twin)}))
        parts += [quality.table_report(t, frames[t](), c) for t, c in checks.items()]
        return reduce(DataFrame.unionByName, parts)
