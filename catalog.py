"""Registered queries: the Spark side, and the SQL it is checked against, side by side.

Each query gets a :class:`Warehouse` over one folder of sample tables. Doubles are rounded here and in the SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

import oracle as o
from oracle import r6
from ripecast import constants as K
from ripecast import functions as X
from ripecast import schemas, session
from ripecast.operators import boosting, kpis, lookup, model, policy, profile, quality, tails
from ripecast.operators.policy import FormulaScorer
from ripecast.operators.timeseries import by_day, forward_fill, one_row_per_day, pct_change
from ripecast.plans import daily, dims, fact, features, staging
from ripecast.plans.warehouse import Warehouse
from ripecast.sources import deliveries, snapshots, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

DAY = "2001-07-16"
RANGE = ("2001-06-01", "2001-08-31")
SHARDS = 16
PAIR = "concat_ws('|', store_nbr, item_nbr)"
FORMULA = FormulaScorer()


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    names = {f.name for f in df.schema if isinstance(f.dataType, DoubleType)}
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


def query(name: str, needs: str = "", body: str | None = None):
    def register(build: Callable[[Warehouse], DataFrame]):
        QUERIES[name] = lambda spark, folder: rounded(build(Warehouse.from_sample(spark, folder)))
        if body is not None:
            SQL[name] = o.sql(needs, body)
        return build

    return register


# --- sources --------------------------------------------------------------------------------------------------------


@query("src_split_scan", "split", f"SELECT date, unit_sales, {r6('rm7_log_sales')} AS rm7_log_sales, family, split FROM split WHERE split = 'train'")
def _(w):
    return tables.read_split(w.features_split, "train", ["unit_sales", "rm7_log_sales", "family"])


@query("src_day_scan", "frame", f"SELECT {o.FRAME} FROM frame WHERE date = DATE '{DAY}'")
def _(w):
    return tables.read_day(w.scoring_frame, DAY)


# --- scalar expressions ---------------------------------------------------------------------------------------------


@query("cast_strict", "raw_sales", "SELECT id, date, store_nbr, item_nbr, unit_sales FROM raw_sales")
def _(w):
    raw = w.raw("sales")
    return staging.stg_sales(staging.native_sales(raw.select(*[F.col(c).cast("string") for c in raw.columns]))).drop(
        "onpromotion"
    )


@query(
    "cast_safe",
    "raw_holidays",
    "SELECT description, TRY_CAST(split_part(description, ' ', 2) AS BIGINT) AS number, "
    "TRY_CAST(transferred AS BIGINT) AS not_a_number FROM raw_holidays",
)
def _(w):
    return w.raw("holidays").select(
        "description",
        F.element_at(F.split("description", " "), 2).try_cast("long").alias("number"),
        F.col("transferred").try_cast("long").alias("not_a_number"),
    )


@query("parse_bool", "stg_holidays", "SELECT description, transferred FROM stg_holidays")
def _(w):
    return w.raw("holidays").select("description", X.parse_bool(F.col("transferred")).alias("transferred"))


@query("parse_date", "raw_sales", "SELECT id, CAST(date::VARCHAR AS DATE) AS date FROM raw_sales")
def _(w):
    return w.raw("sales").select("id", F.to_date(F.col("date").cast("string")).alias("date"))


@query("family_clean", "stg_items", "SELECT item_nbr, family FROM stg_items")
def _(w):
    return w.stg_items.select("item_nbr", "family")


@query("family_upper", "stg_items", "SELECT item_nbr, upper(family) AS family FROM stg_items")
def _(w):
    return w.stg_items.select("item_nbr", F.upper("family").alias("family"))


@query("perishable_flag", "int_items", "SELECT item_nbr, perishable_bool FROM int_items")
def _(w):
    return w.int_items.select("item_nbr", "perishable_bool")


@query("promo_default", "int_sales", "SELECT id, onpromotion FROM int_sales")
def _(w):
    return w.int_sales.select("id", "onpromotion")


@query("sales_clip", "int_sales", "SELECT id, unit_sales FROM int_sales")
def _(w):
    return w.int_sales.select("id", "unit_sales")


@query("log_sales", "int_sales", f"SELECT id, {r6('log_sales')} AS log_sales FROM int_sales")
def _(w):
    return w.int_sales.select("id", "log_sales")


@query(
    "calendar_parts",
    "raw_sales",
    "SELECT id, date, (dayofweek(date) + 1)::BIGINT AS dow, month(date)::BIGINT AS month, year(date)::BIGINT AS year "
    "FROM raw_sales",
)
def _(w):
    return fact.with_calendar(w.int_sales.select("id", "date"))


@query("hash_unit", "item_prices", f"SELECT item_nbr, {r6('u')} AS u FROM item_prices")
def _(w):
    return dims.distinct_items(w.stg_items).select("item_nbr", X.hash_unit(F.col("item_nbr")).alias("u"))


@query("base_price", "item_prices", "SELECT item_nbr, family, base_price FROM item_prices")
def _(w):
    return dims.int_base_price(w.stg_items)


def _priced(*columns):
    return lambda w: fact.priced_sales(w.int_sales, w.dim_items).select(*K.KEYS, *columns)


query("shelf_life", "priced", f"SELECT {o.KEYS}, family, shelf_life_days FROM priced")(_priced("family", "shelf_life_days"))
query("stock_age", "priced", f"SELECT {o.KEYS}, days_since_stock FROM priced")(_priced("days_since_stock"))
query("time_to_expiry", "priced", f"SELECT {o.KEYS}, time_to_expiry FROM priced")(_priced("time_to_expiry"))
query("discount_ladder", "priced", f"SELECT {o.KEYS}, time_to_expiry, discount_pct FROM priced")(
    _priced("time_to_expiry", "discount_pct")
)
query("effective_price", "priced", f"SELECT {o.KEYS}, effective_price FROM priced")(_priced("effective_price"))


@query("id_to_string", "clean", f"SELECT {o.KEYS}, class, cluster, family FROM clean")
def _(w):
    return features.features_clean(w.fact).select(*K.KEYS, "class", "cluster", "family")


@query("split_label", "split", f"SELECT {o.KEYS}, split FROM split")
def _(w):
    return w.features_split.select(*K.KEYS, "split")


@query("expiry_bucket", "priced", f"SELECT {o.KEYS}, {o._BUCKET} AS expiry_bucket FROM priced")
def _(w):
    priced = fact.priced_sales(w.int_sales, w.dim_items)
    return priced.select(*K.KEYS, X.expiry_bucket(F.col("time_to_expiry")).alias("expiry_bucket"))


@query("discount_bin", "choice", f"SELECT {o.KEYS}, {o.money('policy_discount_pct', 1)} AS discount_bin FROM choice")
def _(w):
    chosen = w.policy_eval(FORMULA)
    return chosen.select(*K.KEYS, X.money_round(F.col("policy_discount_pct"), 1).alias("discount_bin"))


@query(
    "safe_divide",
    "int_sales raw_stores",
    f"SELECT id, {r6('unit_sales / nullif(cluster, 0)')} AS ratio FROM int_sales LEFT JOIN raw_stores USING (store_nbr)",
)
def _(w):
    joined = lookup.lookup(w.int_sales, w.dim_stores, "store_nbr", "cluster")
    return joined.select("id", F.try_divide("unit_sales", "cluster").alias("ratio"))


@query("revenue", "scored", f"SELECT {o.KEYS}, cand_discount_pct, {r6('cand_effective_price * pred_units')} AS revenue FROM scored")
def _(w):
    scored = policy.score_candidates(policy.candidates(w.scoring_frame), FORMULA)
    return scored.select(
        *K.KEYS, "cand_discount_pct", (F.col("cand_effective_price") * F.col("pred_units")).alias("revenue")
    )


@query(
    "date_offset",
    "raw_sales",
    "SELECT id, date - 28 AS before, date + 1 AS after FROM raw_sales",
)
def _(w):
    return w.int_sales.select("id", F.date_sub("date", 28).alias("before"), F.date_add("date", 1).alias("after"))


@query(
    "cat_unknown",
    "int_sales stg_items split",
    "SELECT id, CASE WHEN family IN (SELECT family FROM split WHERE split = 'train') THEN family ELSE '__UNK__' END "
    "AS family FROM int_sales JOIN stg_items USING (item_nbr)",
)
def _(w):
    train = w.features_split.where(F.col("split") == "train")
    sales = lookup.lookup(w.int_sales, w.stg_items, "item_nbr", "family", how="inner")
    seen = model.vocabulary(train, "family")
    return lookup.replace_unknown(sales, "family", seen, K.UNKNOWN_CATEGORY).select("id", "family")


@query("uplift_pp", "buckets", f"SELECT expiry_bucket, {r6('uplift_pct * 100')} AS uplift_pct_pp FROM buckets")
def _(w):
    return kpis.uplift_points(kpis.by_expiry(w.policy_eval(FORMULA))).select("expiry_bucket", "uplift_pct_pp")


@query("revenue_gap", "daily", f"SELECT date, {r6('policy_rev - baseline_rev')} AS gap FROM daily")
def _(w):
    return kpis.revenue_gap(kpis.by_date(w.policy_eval(FORMULA))).select("date", "gap")


# --- filters --------------------------------------------------------------------------------------------------------


@query("filter_perishable", "dim_items", "SELECT item_nbr, family, class, base_price FROM dim_items WHERE perishable_bool")
def _(w):
    return fact.perishable_items(w.dim_items).drop("perishable_bool")


@query("filter_price_valid", "clean", f"SELECT {o.KEYS}, base_price, effective_price FROM clean")
def _(w):
    return features.features_clean(w.fact).select(*K.KEYS, "base_price", "effective_price")


@query("filter_min_history", "lagged", f"SELECT {o.KEYS} FROM lagged WHERE nth > 28")
def _(w):
    return features.features_enriched(features.features_clean(w.fact), w.max_rows).select(*K.KEYS)


@query("filter_split", "split", f"SELECT {o.KEYS}, unit_sales FROM split WHERE split = 'valid'")
def _(w):
    return w.features_split.where(F.col("split") == "valid").select(*K.KEYS, "unit_sales")


@query("filter_near_expiry", "frame", f"SELECT {o.KEYS}, time_to_expiry FROM frame")
def _(w):
    return w.scoring_frame.select(*K.KEYS, "time_to_expiry")


@query(
    "filter_date_range",
    "frame",
    f"SELECT {o.FRAME} FROM frame WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'",
)
def _(w):
    return policy.in_days(w.scoring_frame, *RANGE)


@query(
    "hash_shard",
    "int_sales",
    f"SELECT id, {o.hashed(PAIR)} % {SHARDS} AS shard FROM int_sales",
)
def _(w):
    return w.int_sales.select("id", X.shard_of(SHARDS, F.col("store_nbr"), F.col("item_nbr")).alias("shard"))


# --- joins ----------------------------------------------------------------------------------------------------------


@query(
    "join_items",
    "int_sales dim_items",
    "SELECT id, item_nbr, family, class, perishable_bool, base_price FROM int_sales LEFT JOIN dim_items USING (item_nbr)",
)
def _(w):
    columns = ["family", "class", "perishable_bool", "base_price"]
    return lookup.lookup(w.int_sales, w.dim_items, "item_nbr", *columns).select("id", "item_nbr", *columns)


@query(
    "join_stores",
    "int_sales raw_stores",
    "SELECT id, store_nbr, city, state, type, cluster FROM int_sales LEFT JOIN raw_stores USING (store_nbr)",
)
def _(w):
    columns = ["city", "state", "type", "cluster"]
    return lookup.lookup(w.int_sales, w.dim_stores, "store_nbr", *columns).select("id", "store_nbr", *columns)


@query("join_oil", "int_sales oil", f"SELECT id, date, {o.OIL} FROM int_sales LEFT JOIN oil USING (date)")
def _(w):
    columns = [c for c in w.dim_oil_prices.columns if c != "date"]
    return lookup.lookup(w.int_sales, w.dim_oil_prices, "date", *columns).select("id", "date", *columns)


@query("join_price_band", "item_prices", "SELECT item_nbr, family, p_min, p_max FROM item_prices")
def _(w):
    return dims.with_price_band(dims.distinct_items(w.stg_items)).select("item_nbr", "family", "p_min", "p_max")


@query(
    "join_item_price",
    "int_items item_prices",
    "SELECT item_nbr, family, class, perishable_bool, base_price FROM int_items "
    "LEFT JOIN item_prices USING (item_nbr, family)",
)
def _(w):
    return dims.item_with_price(w.int_items)


@query("join_calendar", "oil_days raw_oil", "SELECT date, dcoilwtico AS dcoil_raw FROM oil_days LEFT JOIN raw_oil USING (date)")
def _(w):
    spine = dims.oil_spine(w.sale_days, w.stg_oil_prices)
    return lookup.lookup(spine, w.stg_oil_prices, "date", "dcoil_raw")


@query("join_rolling", "recent_units", f"SELECT id, {o._rounded('avg_units_7d avg_units_14d')} FROM recent_units")
def _(w):
    return fact.with_recent_units(w.int_sales, w.max_rows).select("id", "avg_units_7d", "avg_units_14d")


@query(
    "cross_grid",
    "frame",
    f"SELECT {o.KEYS}, unnest({o._GRID}) AS cand_discount_pct FROM frame",
)
def _(w):
    return policy.candidates(w.scoring_frame).select(*K.KEYS, "cand_discount_pct")


@query("join_policy_baseline", "eval", f"SELECT {o.EVAL} FROM eval")
def _(w):
    frame = w.scoring_frame
    choice = policy.choose(policy.score_candidates(policy.candidates(frame), FORMULA))
    return policy.join_eval(policy.baseline(frame, FORMULA), choice)


@query("join_eval_frame", "eval", f"SELECT {o.EVAL}, time_to_expiry FROM eval")
def _(w):
    return kpis.with_expiry(policy.sweep(w.scoring_frame, FORMULA), w.scoring_frame)


# --- aggregations ---------------------------------------------------------------------------------------------------


@query("agg_sales_bounds", "int_sales", "SELECT min(date) AS first_sale, max(date) AS last_sale FROM int_sales")
def _(w):
    return w.int_sales.agg(F.min("date").alias("first_sale"), F.max("date").alias("last_sale"))


@query("agg_distinct_items", "stg_items", "SELECT DISTINCT item_nbr, upper(family) AS family FROM stg_items")
def _(w):
    return dims.distinct_items(w.stg_items)


@query("holiday_flag", "holidays", "SELECT date, is_nat_holiday FROM holidays")
def _(w):
    return w.int_holidays


KPI_OVERALL = (
    "SELECT count(*) AS n_rows, "
    f"{r6('sum(baseline_revenue)')} AS baseline_rev, {r6('sum(policy_revenue)')} AS policy_rev, "
    f"{r6('sum(policy_revenue - baseline_revenue)')} AS uplift_abs, "
    f"{r6('sum(policy_revenue - baseline_revenue) / nullif(sum(baseline_revenue), 0)')} AS uplift_pct, "
    f"{r6('avg(baseline_discount_pct)')} AS avg_baseline_discount, "
    f"{r6('avg(policy_discount_pct)')} AS avg_policy_discount, "
    f"{r6(o.corr('policy_discount_pct', 'time_to_expiry'))} AS corr_discount_vs_expiry FROM eval"
)


@query("kpi_overall", "eval", KPI_OVERALL)
def _(w):
    return kpis.overall(w.policy_eval(FORMULA))


@query("kpi_corr", "eval", f"SELECT {r6(o.corr('policy_discount_pct', 'time_to_expiry'))} AS corr_discount_vs_expiry FROM eval")
def _(w):
    pair = F.col("policy_discount_pct"), F.col("time_to_expiry")
    return w.policy_eval(FORMULA).agg(X.safe_corr(*pair).alias("corr_discount_vs_expiry"))


@query("kpi_by_date", "daily", f"SELECT date, {o._rounded('baseline_rev policy_rev uplift_pct')} FROM daily")
def _(w):
    return kpis.by_date(w.policy_eval(FORMULA))


@query(
    "kpi_by_expiry",
    "buckets",
    f"SELECT expiry_bucket, {o._rounded('baseline_rev policy_rev uplift_pct avg_policy_discount')} FROM buckets",
)
def _(w):
    return kpis.by_expiry(w.policy_eval(FORMULA))


@query(
    "kpi_discount_dist",
    "choice",
    f"SELECT {o.money('policy_discount_pct', 1)} AS discount_bin, count(*) AS n_rows FROM choice GROUP BY ALL",
)
def _(w):
    return kpis.discount_distribution(w.policy_eval(FORMULA))


@query("eda_shape", "fact", "SELECT count(*) AS nrows, min(date) AS min_date, max(date) AS max_date FROM fact")
def _(w):
    return profile.shape(w.fact)


@query(
    "eda_missing",
    "fact",
    "SELECT "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {n}" for n, c in profile.MISSING_COLUMNS.items())
    + " FROM fact",
)
def _(w):
    return profile.missingness(w.fact)


DISTRIBUTION = (
    "SELECT "
    + ", ".join(f"quantile_disc(unit_sales, {q})::DOUBLE AS {n}" for n, q in profile.QUANTILES.items())
    + f", {r6('avg(unit_sales)')} AS mean_sales, {r6('avg(log_sales)')} AS mean_log_sales FROM fact"
)


@query("eda_distribution", "fact", DISTRIBUTION)
def _(w):
    return profile.distribution(w.fact)


@query("eda_distribution_exact", "fact", DISTRIBUTION)
def _(w):
    return profile.distribution_exact(w.fact)


@query("eda_dow", "fact", f"SELECT dow::BIGINT AS dow, {r6('avg(log_sales)')} AS avg_log_sales FROM fact GROUP BY ALL")
def _(w):
    return profile.seasonality(w.fact, "dow")


@query("eda_month", "fact", f"SELECT month::BIGINT AS month, {r6('avg(log_sales)')} AS avg_log_sales FROM fact GROUP BY ALL")
def _(w):
    return profile.seasonality(w.fact, "month")


LIFT = "avg(log_sales) FILTER (WHERE onpromotion) - avg(log_sales) FILTER (WHERE NOT onpromotion)"


@query("eda_promo_lift", "fact", f"SELECT {r6(LIFT)} AS avg_lift_log FROM fact")
def _(w):
    return profile.promo_lift(w.fact)


@query(
    "eda_promo_family",
    "fact",
    f"SELECT family, {r6('lift')} AS lift_log FROM (SELECT family, {LIFT} AS lift FROM fact GROUP BY family "
    "ORDER BY lift DESC NULLS LAST, family LIMIT 50)",
)
def _(w):
    return profile.promo_lift_by_family(w.fact)


@query(
    "eda_store_hetero",
    "fact",
    f"SELECT type, cluster, {r6('a')} AS avg_log_sales, {r6('p')} AS promo_rate, n FROM (SELECT type, cluster, "
    "avg(log_sales) AS a, avg(onpromotion::INT) AS p, count(*) AS n FROM fact GROUP BY ALL "
    "ORDER BY a DESC NULLS LAST, type, cluster LIMIT 50)",
)
def _(w):
    return profile.store_differences(w.fact)


@query(
    "eda_oil_corr",
    "fact",
    "SELECT " + ", ".join(f"{r6(o.corr('log_sales', c))} AS {n}" for n, c in profile.OIL_COLUMNS.items()) + " FROM fact",
)
def _(w):
    return profile.oil_correlations(w.fact)


@query(
    "eda_cardinality",
    "fact",
    "SELECT " + ", ".join(f"count(DISTINCT {c}) AS {n}" for n, c in profile.DISTINCT_COLUMNS.items()) + " FROM fact",
)
def _(w):
    return profile.cardinality(w.fact)


@query(
    "eda_cardinality_states",
    "fact",
    "SELECT "
    + ", ".join(f"count(DISTINCT {c}) AS {n}, true AS {n}_near" for n, c in profile.DISTINCT_COLUMNS.items())
    + " FROM fact",
)
def _(w):
    """Exact counts, and whether the estimate from sketches stored per year is within four standard errors (6.5 %)."""
    table = snapshots.SliceTable(w.raw("sales").sparkSession, scratch(w, "sketches"), f"year BIGINT, {profile.CARDINALITY_STATE}", "year")
    table.write(profile.cardinality_states(w.fact, "year"))
    guess = profile.cardinality_of(table.read()).first()
    near = lambda n: (F.abs(F.col(n) - F.lit(guess[n])) <= 0.065 * F.col(n)).alias(f"{n}_near")
    return profile.cardinality(w.fact).select(*[c for n in profile.DISTINCT_COLUMNS for c in (F.col(n), near(n))])


@query(
    "eda_cold_spots",
    "fact",
    "SELECT store_nbr, item_nbr, count(*) FILTER (WHERE unit_sales > 0) AS days_sold FROM fact GROUP BY ALL "
    "ORDER BY days_sold, store_nbr, item_nbr LIMIT 100",
)
def _(w):
    return profile.cold_spots(w.fact)


@query(
    "vocab_fit",
    "split",
    " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS feature, {c} AS category FROM split WHERE split = 'train'"
        for c in K.CATEGORICAL_FEATURES
    ),
)
def _(w):
    train = w.features_split.where(F.col("split") == "train")
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("category")) for c in K.CATEGORICAL_FEATURES]
    return train.select(F.inline(F.array(*pairs))).distinct()


@query("argmax_group", "choice", f"SELECT {o.CHOICE} FROM choice")
def _(w):
    return policy.choose(policy.score_candidates(policy.candidates(w.scoring_frame), FORMULA))


# --- windows --------------------------------------------------------------------------------------------------------


@query("win_ffill", "oil", f"SELECT date, {r6('dcoil')} AS dcoil FROM oil")
def _(w):
    spine = dims.oil_spine(w.sale_days, w.stg_oil_prices)
    joined = spine.join(one_row_per_day(w.stg_oil_prices, "dcoil_raw"), "date", "left")
    return joined.select("date", forward_fill("dcoil_raw", by_day()).alias("dcoil"))


query("win_ma7", "oil", f"SELECT date, {r6('dcoil_ma7')} AS dcoil_ma7 FROM oil")(
    lambda w: w.int_oil_prices.select("date", "dcoil_ma7")
)
query("win_ma30", "oil", f"SELECT date, {r6('dcoil_ma30')} AS dcoil_ma30 FROM oil")(
    lambda w: w.int_oil_prices.select("date", "dcoil_ma30")
)


@query("win_pct_change", "oil", f"SELECT date, {o._rounded('pct_change_1d pct_change_7d')} FROM oil")
def _(w):
    return w.int_oil_prices.select(
        "date", *[pct_change("dcoil", by_day(), n).alias(f"pct_change_{n}d") for n in (1, 7)]
    )


@query("win_avg_units", "priced", f"SELECT {o.KEYS}, {o._rounded('avg_units_7d avg_units_14d')} FROM priced")
def _(w):
    return w.fact.select(*K.KEYS, "avg_units_7d", "avg_units_14d")


def _lagged(*names):
    def build(w):
        enriched = features.features_enriched(features.features_clean(w.fact), w.max_rows, min_history=None)
        return enriched.select(*K.KEYS, *names)

    return build


query(
    "win_lags",
    "lagged",
    f"SELECT {o.KEYS}, {o._rounded('lag1_log_sales lag7_log_sales lag14_log_sales lag28_log_sales')} FROM lagged",
)(_lagged(*[f"lag{n}_log_sales" for n in (1, 7, 14, 28)]))
query(
    "win_rolling_mean", "lagged", f"SELECT {o.KEYS}, {o._rounded('rm7_log_sales rm28_log_sales')} FROM lagged"
)(_lagged("rm7_log_sales", "rm28_log_sales"))
query("win_promo_recency", "lagged", f"SELECT {o.KEYS}, promo_in_last_7d FROM lagged")(_lagged("promo_in_last_7d"))


def clean_sales(w: Warehouse) -> DataFrame:
    return features.clean_from_sales(w.int_sales, w.dim_items, w.dim_stores)


def stepped(w: Warehouse) -> tuple[list[DataFrame], DataFrame]:
    """The features of all sales in three steps of days, each from the stored tail of the one before, and the last tail."""
    rows, spark = clean_sales(w), w.raw("sales").sparkSession
    stores = (K.SERIES, "date", features.LOOKBACK)

    def stored(tail):
        path = scratch(w, "tail")
        tables.write_table(tail, path, None)
        return tables.read_table(spark, path, f"{schemas.CLEAN}, {tails.NTH} BIGINT")

    day = F.col("date")
    first, second, third = (rows.where(c) for c in (day <= RANGE[0], (day > RANGE[0]) & (day <= DAY), day > DAY))
    done, tail = [features.features_enriched(first, w.max_rows)], stored(tails.start_tail(first, *stores, features.TIES))
    for new in (second, third):
        done.append(daily.features_after(tail, new, w.max_rows))
        tail = stored(tails.move_tail(tail, new, *stores, features.TIES))
    return done, tail


@query("win_series_split", "lagged", f"SELECT {o.CLEAN}, {o.LAGS}, promo_in_last_7d FROM lagged WHERE nth > 28")
def _(w):
    """The lag features with every series of more than 64 rows cut into chunks, as done for hot series."""
    return features.features_enriched(clean_sales(w), max_rows=64)


query("win_series_tail", "enriched", f"SELECT {o.CLEAN}, {o.LAGS}, promo_in_last_7d FROM enriched")(
    lambda w: reduce(DataFrame.unionByName, stepped(w)[0])
)


@query(
    "win_series_tail_state",
    "clean",
    f"""
    , placed AS (
        SELECT {o.CLEAN}, row_number() OVER s AS nth, count(*) OVER (PARTITION BY store_nbr, item_nbr) AS n FROM clean
        WINDOW s AS (PARTITION BY store_nbr, item_nbr ORDER BY date)
    )
    SELECT * EXCLUDE n FROM placed WHERE nth > n - 28
    """,
)
def _(w):
    return stepped(w)[1].withColumnRenamed(tails.NTH, "nth")


@query("win_argmax", "choice", f"SELECT {o.CHOICE} FROM choice")
def _(w):
    return policy.choose_by_rank(policy.score_candidates(policy.candidates(w.scoring_frame), FORMULA))


# --- top-k and set operations ---------------------------------------------------------------------------------------


@query(
    "peak_gap",
    "daily",
    f"""
    , gaps AS (SELECT *, policy_rev - baseline_rev AS gap FROM daily),
    top AS (FROM gaps ORDER BY gap DESC, date LIMIT 1), low AS (FROM gaps ORDER BY gap, date LIMIT 1)
    SELECT kind, date, {o._rounded('baseline_rev policy_rev gap')}
    FROM (SELECT 'peak_positive' AS kind, * FROM top
          UNION ALL SELECT 'peak_negative', low.* FROM low, top WHERE low.gap < 0 AND low.date <> top.date)""",
)
def _(w):
    return kpis.peak_gap(kpis.by_date(w.policy_eval(FORMULA)))


@query(
    "peak_uplift",
    "buckets",
    f"SELECT expiry_bucket, {r6('uplift_pct * 100')} AS uplift_pct_pp FROM buckets "
    "WHERE uplift_pct IS NOT NULL ORDER BY uplift_pct DESC, expiry_bucket LIMIT 1",
)
def _(w):
    return kpis.peak_uplift(kpis.by_expiry(w.policy_eval(FORMULA)))


@query("union_slices", "eval", f"SELECT {o.EVAL} FROM eval")
def _(w):
    early = policy.sweep(w.scoring_frame, FORMULA, end=DAY)
    later = policy.sweep(w.scoring_frame.where(F.col("date") > F.lit(DAY).cast("date")), FORMULA)
    return early.unionByName(later)


# --- stored slices ----------------------------------------------------------------------------------------------------


def scratch(w: Warehouse, name: str) -> str:
    return f"{session.checkpoints(w.raw('sales').sparkSession)}/{name}-{uuid.uuid4().hex}"


def sliced(w: Warehouse, name: str, schema: str) -> snapshots.SliceTable:
    return snapshots.SliceTable(w.raw("sales").sparkSession, scratch(w, name), schema, "date", K.SERIES)


EVAL_TABLE = f"{schemas.POLICY['eval']}, time_to_expiry BIGINT"


@query("sink_idempotent_slice", "eval", f"SELECT {o.EVAL}, time_to_expiry FROM eval")
def _(w):
    """Whole days, then wrong rows for one shard of some of them, then the same slices once more, by shard and whole."""
    table, evaluation = sliced(w, "slices", EVAL_TABLE), w.policy_eval(FORMULA)
    shard = snapshots.Shard(3, SHARDS, tuple(K.SERIES))
    within = lambda df, start, end: policy.in_days(df, start, end)
    table.write(within(evaluation, None, RANGE[1]), None, RANGE[1])
    table.write(within(evaluation, DAY, None).where("time_to_expiry > 99"), DAY, None)
    wrong = within(evaluation, *RANGE).where(shard.holds()).withColumn("policy_revenue", F.lit(-1.0))
    table.write(wrong, *RANGE, shard)
    table.write(within(evaluation, *RANGE).where(shard.holds()), *RANGE, shard)
    table.write(within(evaluation, DAY, None), DAY, None)
    return table.read()


@query("sink_replace", "choice", f"SELECT {o.CHOICE} FROM choice")
def _(w):
    table = sliced(w, "replaced", schemas.POLICY["choice"])
    choice = w.policy_eval(FORMULA).select(*table.schema.names)
    table.write(choice.withColumn("policy_revenue", F.lit(0.0)))
    table.replace(choice)
    return table.read()


@query("sink_csv", "daily", f"SELECT date, {o._rounded('baseline_rev policy_rev uplift_pct')} FROM daily")
def _(w):
    path, daily = scratch(w, "kpi-csv"), kpis.by_date(w.policy_eval(FORMULA))
    tables.write_csv(daily, path)
    return deliveries.read_csv(daily.sparkSession, path).select(F.col("date").cast("date"), *[F.col(c).cast("double") for c in daily.columns[1:]])


@query(
    "src_csv_split",
    "",
    """SELECT o_orderkey::VARCHAR AS id, '"' || o_orderpriority || '"' || chr(10) || chr(10) || o_orderstatus || ',' AS note,
       o_orderdate::DATE::VARCHAR AS day FROM orders""",
)
def _(w):
    """Orders written with quotes, commas and line breaks in a field, and read back by byte ranges."""
    spark, path = w.raw("sales").sparkSession, scratch(w, "csv")
    note = F.concat(F.lit('"'), "o_orderpriority", F.lit('"\n\n'), "o_orderstatus", F.lit(","))
    orders = spark.read.parquet(f"{w.name}/orders.parquet")
    rows = orders.select(F.col("o_orderkey").cast("string").alias("id"), note.alias("note"), F.col("o_orderdate").cast("date").cast("string").alias("day"))
    rows.write.options(**deliveries.CSV).csv(path)
    return deliveries.read_csv(spark, path, columns="id note day", multi_line="split")


@query("sink_native", "int_sales", f"SELECT id, {o.KEYS}, onpromotion, unit_sales, {r6('log_sales')} AS log_sales FROM int_sales")
def _(w):
    path = scratch(w, "int-sales")
    tables.write_table(w.int_sales, path, "date", K.SERIES)
    return tables.read_table(w.int_sales.sparkSession, path, schemas.TABLES["int_sales"])


def stored_states(w: Warehouse) -> DataFrame:
    """Day states of the evaluation, written as two slices of days."""
    table = snapshots.SliceTable(w.raw("sales").sparkSession, scratch(w, "states"), kpis.STATE)
    for start, end in ((None, DAY), ((dt.date.fromisoformat(DAY) + dt.timedelta(1)).isoformat(), None)):
        table.write(kpis.day_states(w.policy_eval(FORMULA, start=start, end=end)), start, end)
    return table.read()


query("kpi_overall_states", "eval", KPI_OVERALL)(lambda w: kpis.overall_of(stored_states(w)))
query("kpi_by_date_states", "daily", f"SELECT date, {o._rounded('baseline_rev policy_rev uplift_pct')} FROM daily")(
    lambda w: kpis.by_date_of(stored_states(w))
)
query(
    "kpi_by_expiry_states",
    "buckets",
    f"SELECT expiry_bucket, {o._rounded('baseline_rev policy_rev uplift_pct avg_policy_discount')} FROM buckets",
)(lambda w: kpis.by_expiry_of(stored_states(w)))


# --- tables ---------------------------------------------------------------------------------------------------------


@query("oil_spine", "oil_days", "SELECT date FROM oil_days")
def _(w):
    return dims.oil_spine(w.sale_days, w.stg_oil_prices)


query("int_oil", "oil", f"SELECT date, {o.OIL} FROM oil")(lambda w: w.int_oil_prices)
query("dim_oil", "oil", f"SELECT date, {o.OIL} FROM oil")(lambda w: w.dim_oil_prices)
query(
    "int_sales",
    "int_sales",
    f"SELECT id, {o.KEYS}, onpromotion, unit_sales, {r6('log_sales')} AS log_sales FROM int_sales",
)(lambda w: w.int_sales)
query("dim_items", "dim_items", "SELECT item_nbr, family, class, perishable_bool, base_price FROM dim_items")(
    lambda w: w.dim_items
)
query("dim_stores", "raw_stores", "SELECT store_nbr, city, state, type, cluster FROM raw_stores")(lambda w: w.dim_stores)
query("dim_holidays", "holidays", "SELECT date, is_nat_holiday FROM holidays")(lambda w: w.dim_holidays)
query("fct_sales_features", "fact", f"SELECT {o.FACT} FROM fact")(lambda w: w.fact)
query("features_clean", "clean", f"SELECT {o.CLEAN} FROM clean")(lambda w: features.features_clean(w.fact))
query("features_enriched", "enriched", f"SELECT {o.CLEAN}, {o.LAGS}, promo_in_last_7d FROM enriched")(
    lambda w: w.features_enriched
)
query("features_split", "split", f"SELECT {o.CLEAN}, {o.LAGS}, promo_in_last_7d, split FROM split")(
    lambda w: w.features_split
)
query("scoring_frame", "frame", f"SELECT {o.FRAME} FROM frame")(lambda w: w.scoring_frame)


@query(
    "tx_signals",
    "raw_transactions",
    f"SELECT date, store_nbr, transactions, lag(transactions) OVER s AS tx_lag1, "
    f"{r6('avg(transactions) OVER (s ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)')} AS tx_ma7_lag1, "
    f"{r6('avg(transactions) OVER (s ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)')} AS tx_ma30_lag1 "
    "FROM raw_transactions WINDOW s AS (PARTITION BY store_nbr ORDER BY date)",
)
def _(w):
    return w.tx_signals


# --- policy ---------------------------------------------------------------------------------------------------------


@query(
    "policy_candidates",
    "cands",
    f"SELECT {o.KEYS}, base_price, time_to_expiry, {o.LAGS}, promo_in_last_7d, dow, month, year, family, class, "
    "cluster, cand_discount_pct, cand_effective_price, cand_effective_price AS effective_price, "
    "cand_discount_pct AS discount_pct FROM cands",
)
def _(w):
    return policy.candidates(w.scoring_frame)


@query(
    "policy_score",
    "scored",
    f"SELECT {o.KEYS}, cand_discount_pct, cand_effective_price, {r6('pred_units')} AS predicted_unit_sales, "
    f"{r6('pred_units')} AS pred_units, base_price, time_to_expiry, {o.LAGS}, promo_in_last_7d, dow, month, year, "
    "family, class, store_nbr AS store_nbr_cat, cluster FROM scored",
)
def _(w):
    return policy.score_candidates(policy.candidates(w.scoring_frame), FORMULA)


@query("policy_choice", "choice", f"SELECT {o.CHOICE} FROM choice")
def _(w):
    # all candidates of a key start in one row, so the choice is made there, without a shuffle
    return w.policy_eval(FORMULA).select(*tables.names(w.scoring_frame.sparkSession, schemas.POLICY["choice"]))


@query("policy_baseline", "base_eval", f"SELECT {o.BASELINE} FROM base_eval")
def _(w):
    return policy.baseline(w.scoring_frame, FORMULA)


@query("policy_eval", "eval", f"SELECT {o.EVAL} FROM eval")
def _(w):
    return policy.sweep(w.scoring_frame, FORMULA)


@query(
    "policy_sweep",
    "eval",
    f"SELECT {o.EVAL}, time_to_expiry FROM eval WHERE date BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'",
)
def _(w):
    return w.policy_eval(FORMULA, start=RANGE[0], end=RANGE[1])


@query(
    "eval_metrics",
    "scored_test",
    f"""
    SELECT count(*) AS n_rows, {r6('avg(abs(e))')} AS mean_absolute_error, {r6('avg(e * e)')} AS mean_squared_error,
           {r6('sqrt(avg(e * e))')} AS root_mean_squared_error, {r6('avg(le * le)')} AS mean_squared_log_error,
           {r6('quantile_disc(abs(e), 0.5)')} AS median_absolute_error,
           {r6('1 - avg(e * e) / nullif(var_pop(y), 0)')} AS r2_score,
           {r6('1 - var_pop(e) / nullif(var_pop(y), 0)')} AS explained_variance
    FROM (SELECT unit_sales AS y, unit_sales - predicted_unit_sales AS e,
                 ln(1 + greatest(unit_sales, 0)) - ln(1 + greatest(predicted_unit_sales, 0)) AS le
          FROM scored_test WHERE unit_sales IS NOT NULL AND predicted_unit_sales IS NOT NULL)""",
)
def _(w):
    test = w.features_split.where(F.col("split") == "test")
    return model.metrics(FORMULA.score(test, "effective_price", "discount_pct", "predicted_unit_sales"))


@query(
    "eval_metrics_exact",
    "scored_all",
    "SELECT count(*) AS n_rows, "
    f"{r6('quantile_disc(abs(unit_sales - predicted_unit_sales), 0.5)')} AS median_absolute_error "
    "FROM scored_all WHERE unit_sales IS NOT NULL AND predicted_unit_sales IS NOT NULL",
)
def _(w):
    """The exact median over all splits, more rows than the sketch keeps whole."""
    scored = FORMULA.score(w.features_split, "effective_price", "discount_pct", "predicted_unit_sales")
    return model.metrics(scored, exact=True).select("n_rows", "median_absolute_error")


# Predicted values of trained models have no SQL twin; what can be told exactly about them is registered as *_exact.
# A model is fitted once per session, folder and preset, and the queries that use it share it.
# So are the features that models are fitted on and score: kept on the executors' disks, in the layout they are computed in
# (sampled rows depend on it), so that the order lines are read once for both.
_MODELS: dict = {}
_FEATURES: dict = {}


def stored(w: Warehouse) -> Warehouse:
    """``w`` going on from its features as kept for this session and folder."""
    key = (w.raw("sales").sparkSession.sparkContext.applicationId, w.name)
    if key not in _FEATURES:
        _FEATURES[key] = w.features_split.persist(StorageLevel.DISK_ONLY)
    w.features_split = _FEATURES[key]
    return w


def fitted(w: Warehouse, preset: str = "warehouse"):
    spark = w.raw("sales").sparkSession
    key = (spark.sparkContext.applicationId, w.name, preset)
    if key not in _MODELS:
        session.checkpoints(spark)
        if preset in boosting.PRESETS:
            _MODELS[key] = boosting.train(stored(w).features_split, preset)
        else:
            _MODELS[key] = model.train(stored(w).features_split, preset)
    return _MODELS[key]


def split_metrics(w: Warehouse, preset: str) -> DataFrame:
    scored = model.predict(fitted(w, preset), stored(w).features_split.where(F.col("split") != "train"))
    parts = [
        model.metrics(scored.where(F.col("split") == s)).select(F.lit(preset).alias("preset"), F.lit(s).alias("split"), "*")
        for s in ("valid", "test")
    ]
    return parts[0].unionByName(parts[1])


@query("train_gbt")
def _(w):
    return split_metrics(w, "warehouse")


@query("train_gbt_alt")
def _(w):
    return split_metrics(w, "histogram").unionByName(split_metrics(w, "leafwise"))


@query("predict")
def _(w):
    test = stored(w).features_split.where(F.col("split") == "test")
    return model.predict(fitted(w), test)


@query("feature_importance")
def _(w):
    return model.feature_importance(fitted(w), w.int_sales)


@query("policy_sweep_model")
def _(w):
    return stored(w).policy_eval(model.ModelScorer(fitted(w)))


def split_sizes(w: Warehouse, *presets: str) -> DataFrame:
    """Rows scored per split, and whether every score is a finite number."""
    parts = []
    for preset in presets:
        scored = model.predict(fitted(w, preset), stored(w).features_split.where((F.col("split") != "train") & F.col(K.LABEL).isNotNull()))
        good = F.col("predicted_unit_sales").isNotNull() & (F.abs("predicted_unit_sales") < float("inf"))
        parts.append(scored.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.every(good).alias("all_finite")).select(F.lit(preset).alias("preset"), "*"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _split_sizes_sql(*presets: str) -> str:
    names = ", ".join(f"('{p}')" for p in presets)
    return (
        f"SELECT preset, split, count(*) AS n_rows, true AS all_finite FROM split, (VALUES {names}) p(preset) "
        "WHERE split <> 'train' AND unit_sales IS NOT NULL GROUP BY preset, split"
    )


@query("train_gbt_exact", "split", _split_sizes_sql("warehouse"))
def _(w):
    return split_sizes(w, "warehouse")


@query("train_gbt_alt_exact", "split", _split_sizes_sql("histogram", "leafwise"))
def _(w):
    return split_sizes(w, "histogram", "leafwise")


@query(
    "predict_exact",
    "split",
    "SELECT date, store_nbr, item_nbr, unit_sales, split, true AS scored FROM split WHERE split = 'test'",
)
def _(w):
    scored = model.predict(fitted(w), stored(w).features_split.where(F.col("split") == "test"))
    return scored.select(*K.KEYS, K.LABEL, "split", F.col("predicted_unit_sales").isNotNull().alias("scored"))


@query(
    "feature_importance_exact",
    "",
    "SELECT unnest([" + ", ".join(f"'{c}'" for c in (*K.NUMERIC_FEATURES, *K.CATEGORICAL_FEATURES)) + "]) AS feature, "
    "true AS in_range, 1.0::DOUBLE AS total",
)
def _(w):
    table = model.feature_importance(fitted(w), w.int_sales)
    total = F.round(F.sum("importance").over(Window.partitionBy()), 6)
    return table.select("feature", F.col("importance").between(0, 1).alias("in_range"), total.alias("total"))


@query(
    "policy_sweep_model_exact",
    "frame",
    "SELECT date, store_nbr, item_nbr, true AS in_grid, true AS is_best FROM frame",
)
def _(w):
    scorer = model.ModelScorer(fitted(w))
    swept = stored(w).policy_eval(scorer)
    scored = policy.score_candidates(policy.candidates(w.scoring_frame), scorer)
    best = scored.groupBy(*K.KEYS).agg(F.max(F.col("cand_effective_price") * F.col("pred_units")).alias("most"))
    return swept.join(best, K.KEYS).select(
        *K.KEYS,
        F.col("policy_discount_pct").isin(*[float(g) for g in K.DISCOUNT_GRID]).alias("in_grid"),
        F.coalesce(F.abs(F.col("policy_revenue") - F.col("most")) < 1e-9, F.col("most").isNull()).alias("is_best"),
    )


# --- data quality ---------------------------------------------------------------------------------------------------


@query("dq_not_null", "stg_sales", "SELECT id, unit_sales FROM stg_sales WHERE onpromotion IS NULL")
def _(w):
    return quality.not_null(w.stg_sales, "onpromotion").select("id", "unit_sales")


@query(
    "dq_unique",
    "stg_holidays",
    "SELECT date, count(*) AS n_records FROM stg_holidays WHERE date IS NOT NULL GROUP BY date HAVING count(*) > 1",
)
def _(w):
    return quality.unique(w.stg_holidays, "date")


@query(
    "dq_unique_combo",
    "stg_holidays",
    "SELECT date, type, count(*) AS n_records FROM stg_holidays GROUP BY ALL HAVING count(*) > 1",
)
def _(w):
    return quality.unique_combination(w.stg_holidays, "date", "type")


@query("dq_range", "stg_sales", "SELECT id, unit_sales FROM stg_sales WHERE unit_sales < 0 OR unit_sales > 200")
def _(w):
    return quality.accepted_range(w.stg_sales, "unit_sales", 0, 200).select("id", "unit_sales")


@query(
    "dq_accepted_values",
    "dim_items bands",
    "SELECT item_nbr, family FROM dim_items WHERE family NOT IN (SELECT family FROM bands)",
)
def _(w):
    listed = [family for family, _, _ in K.PRICE_BANDS]
    return quality.accepted_values(w.dim_items, "family", listed).select("item_nbr", "family")


@query("dq_expression", "dim_items", "SELECT item_nbr, base_price FROM dim_items WHERE (base_price > 0) IS NOT TRUE")
def _(w):
    return quality.expression_is_true(w.dim_items, "base_price > 0").select("item_nbr", "base_price")


@query("dq_no_negative", "stg_sales", "SELECT id, unit_sales FROM stg_sales WHERE unit_sales < 0")
def _(w):
    return quality.no_negative(w.stg_sales).select("id", "unit_sales")


@query("dq_promo_not_null", "int_sales", "SELECT id, unit_sales FROM int_sales WHERE onpromotion IS NULL")
def _(w):
    return quality.not_null(w.int_sales, "onpromotion").select("id", "unit_sales")


def _count(table: str, column: str, check: str, condition: str) -> str:
    return f"SELECT '{table}', '{column}', '{check}', count(*) FILTER (WHERE {condition}) FROM {table}"


def _repeats(table: str, columns: str, check: str = "unique_combination") -> str:
    return (
        f"SELECT '{table}', '{columns}', '{check}', count(*) "
        f"FROM (SELECT {columns} FROM {table} GROUP BY ALL HAVING count(*) > 1)"
    )


def _nulls(table: str, columns: str) -> list[str]:
    return [_count(table, c, "not_null", f"{c} IS NULL") for c in columns.split()]


_KEY_NAMES = "date store_nbr item_nbr"
_LISTED = "family NOT IN (SELECT family FROM bands)"
REPORT = [
    *_nulls("stg_sales", f"id {_KEY_NAMES} unit_sales"),
    *_nulls("stg_items", "item_nbr"),
    _repeats("stg_items", "item_nbr", "unique"),
    *_nulls("stg_stores", "store_nbr"),
    _repeats("stg_stores", "store_nbr", "unique"),
    *_nulls("stg_oil_prices", "date"),
    _repeats("stg_oil_prices", "date", "unique"),
    *_nulls("stg_holidays", "date"),
    _repeats("int_sales", "date,store_nbr,item_nbr"),
    *_nulls("int_sales", f"{_KEY_NAMES} unit_sales onpromotion"),
    _count("int_sales", "unit_sales", "accepted_range", "unit_sales NOT BETWEEN 0 AND 200"),
    _count("int_sales", "unit_sales", "no_negative", "unit_sales < 0"),
    _count("int_sales", "onpromotion", "accepted_values", "onpromotion NOT IN (true, false)"),
    *_nulls("int_items", "item_nbr"),
    _repeats("int_items", "item_nbr", "unique"),
    _count("int_items", "perishable_bool", "is_flag_or_null", "perishable_bool NOT IN (true, false)"),
    _count("int_items", "family", "price_needs_upper_case", "family <> upper(family)"),
    *_nulls("int_oil_prices", "date dcoil"),
    _repeats("int_oil_prices", "date", "unique"),
    *_nulls("int_holidays", "date is_nat_holiday"),
    _repeats("int_holidays", "date", "unique"),
    _count("int_holidays", "is_nat_holiday", "accepted_values", "is_nat_holiday NOT IN (true, false)"),
    _repeats("dim_items", "item_nbr"),
    *_nulls("dim_items", "item_nbr perishable_bool"),
    _count("dim_items", "perishable_bool", "accepted_values", "perishable_bool NOT IN (true, false)"),
    _count("dim_items", "base_price", "perishable_not_null", "perishable_bool AND base_price IS NULL"),
    _count("dim_items", "base_price", "perishable_positive", "perishable_bool AND (base_price > 0) IS NOT TRUE"),
    _count("dim_items", "base_price", "other_not_null", "NOT perishable_bool AND base_price IS NULL"),
    _repeats("dim_stores", "store_nbr"),
    *_nulls("dim_stores", "store_nbr"),
    *_nulls("dim_oil_prices", "date dcoil"),
    _repeats("dim_oil_prices", "date", "unique"),
    *_nulls("dim_holidays", "date is_nat_holiday"),
    _repeats("dim_holidays", "date", "unique"),
    _count("dim_holidays", "is_nat_holiday", "accepted_values", "is_nat_holiday NOT IN (true, false)"),
    _repeats("fct_sales_features", "date,store_nbr,item_nbr"),
    *_nulls("fct_sales_features", f"{_KEY_NAMES} unit_sales family class perishable_bool base_price"),
    *_nulls("fct_sales_features", "shelf_life_days days_since_stock time_to_expiry discount_pct effective_price"),
    _count("fct_sales_features", "unit_sales", "accepted_range", "unit_sales NOT BETWEEN 0 AND 200"),
    _count("fct_sales_features", "onpromotion", "accepted_values", "onpromotion NOT IN (true, false)"),
    _count("fct_sales_features", "family", "accepted_values", _LISTED),
    _count("fct_sales_features", "base_price", "positive", "(base_price > 0) IS NOT TRUE"),
    _count("fct_sales_features", "effective_price", "not_negative", "(effective_price >= 0) IS NOT TRUE"),
]


@query(
    "dq_report",
    "stg_sales stg_items raw_stores raw_oil stg_holidays int_sales int_items oil holidays dim_items fact bands",
    """
    , stg_stores AS (FROM raw_stores), dim_stores AS (FROM raw_stores), stg_oil_prices AS (FROM raw_oil),
    int_oil_prices AS (FROM oil), dim_oil_prices AS (FROM oil), int_holidays AS (FROM holidays),
    dim_holidays AS (FROM holidays), fct_sales_features AS (FROM fact),
    report(table_name, column_name, check_name, failures) AS ("""
    + " UNION ALL ".join(REPORT)
    + ") SELECT * FROM report",
)
def _(w):
    return w.report()
