"""The registered queries in SQL over the sample tables, for an engine other than Spark.

Shared tables are CTEs; a query names the ones it needs and :func:`sql` puts their dependencies in front.
Floating point results are rounded on both sides, since engines add in different orders.
"""

from __future__ import annotations

from ripecast import constants as K
from ripecast.sources.sample_retail import FAMILIES, SPLIT, STORE_TYPES


def _text_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_BANDS = ", ".join(f"('{f}', {lo}::DOUBLE, {hi}::DOUBLE)" for f, lo, hi in K.PRICE_BANDS)
_LIFE = ", ".join(f"('{f}', {d})" for f, d in K.SHELF_LIFE_DAYS.items())
_GRID = "[" + ", ".join(f"{g}::DOUBLE" for g in K.DISCOUNT_GRID) + "]"
_LADDER = "CASE " + " ".join(f"WHEN time_to_expiry >= {n} THEN {d}::DOUBLE" for n, d in K.MARKDOWN_STEPS)
_LADDER += f" ELSE {K.MARKDOWN_CLEARANCE}::DOUBLE END"
_BUCKET = "CASE " + " ".join(f"WHEN time_to_expiry <= {n} THEN '{b}'" for n, b in K.EXPIRY_BUCKETS)
_BUCKET += f" ELSE '{K.EXPIRY_BUCKET_LAST}' END"


def money(expression: str, digits: int = 2) -> str:
    return f"round(({expression})::DECIMAL(18,6), {digits})::DOUBLE"


def r6(expression: str) -> str:
    return f"round(({expression})::DOUBLE, 6)"


def hashed(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def flag(expression: str) -> str:
    return (
        f"CASE WHEN lower({expression}::VARCHAR) IN ('true', '1', 'yes') THEN true "
        f"WHEN lower({expression}::VARCHAR) IN ('false', '0', 'no') THEN false END"
    )


def units(discount: str) -> str:
    """The formula scorer."""
    return f"(exp(rm7_log_sales) - 1) * (1 + greatest(4.0 - 1.25 * time_to_expiry, 0.0) * {discount})"


def corr(a: str, b: str) -> str:
    """Correlation over rows with both values, NULL when one side is constant."""
    both = f"FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    a, b = f"({a})::DOUBLE", f"({b})::DOUBLE"
    return f"covar_pop({a}, {b}) {both} / nullif(sqrt(var_pop({a}) {both}) * sqrt(var_pop({b}) {both}), 0)"


# --- shared tables: name -> (tables needed, body) -------------------------------------------------------------------

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: str, body: str) -> None:
    CTES[name] = (tuple(needs.split()), body)


cte(
    "raw_sales",
    "",
    """
    SELECT day AS date, store AS store_nbr, item AS item_nbr, concat_ws('-', day, store, item) AS id,
           4.0 * units AS unit_sales,
           CASE WHEN top_discount >= 0.08 THEN 'Yes' WHEN top_discount >= 0.04 THEN 'FALSE' END AS onpromotion
    FROM (
      SELECT l_shipdate::DATE AS day, s_nationkey::BIGINT AS store, split_part(p_brand, '#', 2)::BIGINT AS item,
             sum(CASE l_returnflag WHEN 'R' THEN -1 ELSE 1 END * l_quantity) AS units, max(l_discount) AS top_discount
      FROM lineitem, part, supplier
      WHERE l_partkey = p_partkey AND l_suppkey = s_suppkey
      GROUP BY ALL)""",
)
cte(
    "raw_items",
    "",
    f"""
    SELECT item AS item_nbr, {_text_list(FAMILIES)}[item % {len(FAMILIES)} + 1] AS family, 1000 + item AS class,
           CASE WHEN item % 11 < 9 THEN 1 WHEN item % 11 = 9 THEN 0 END::BIGINT AS perishable
    FROM (SELECT DISTINCT split_part(p_brand, '#', 2)::BIGINT AS item FROM part)""",
)
cte(
    "raw_stores",
    "",
    f"""
    SELECT n_nationkey::BIGINT AS store_nbr, n_name AS city, r_name AS state,
           {_text_list(STORE_TYPES)}[n_nationkey % 5 + 1] AS type, n_regionkey::BIGINT AS cluster
    FROM nation, region WHERE n_regionkey = r_regionkey""",
)
cte(
    "raw_oil",
    "",
    f"""
    SELECT o_orderdate::DATE AS date,
           CASE WHEN dayofweek(o_orderdate::DATE) NOT IN (0, 6)
                THEN {money('avg(o_totalprice) / 1000')} END AS dcoilwtico
    FROM orders GROUP BY o_orderdate::DATE""",
)
cte(
    "raw_holidays",
    "",
    """
    SELECT o_orderdate::DATE AS date,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Holiday' WHEN '2-HIGH' THEN 'Transfer'
                WHEN '3-MEDIUM' THEN 'Bridge' WHEN '4-NOT SPECIFIED' THEN 'Work Day'
                ELSE if(o_custkey % 2 = 1, 'Additional', 'Event') END AS type,
           CASE o_orderstatus WHEN 'F' THEN 'National' WHEN 'O' THEN 'Regional' ELSE 'Local' END AS locale,
           'Locale ' || o_orderstatus AS locale_name, 'Order ' || o_orderkey AS description,
           ['True', 'FALSE', 'yes', 'n/a'][o_custkey % 4 + 1] AS transferred
    FROM orders""",
)
cte(
    "raw_transactions",
    "",
    """
    SELECT o_orderdate::DATE AS date, c_nationkey::BIGINT AS store_nbr, count(*) AS transactions
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
cte("stg_sales", "raw_sales", f"SELECT * REPLACE ({flag('onpromotion')} AS onpromotion) FROM raw_sales")
cte("stg_items", "raw_items", "SELECT * REPLACE (replace(replace(family, '/', '_'), ' ', '_') AS family) FROM raw_items")
cte("stg_holidays", "raw_holidays", f"SELECT * REPLACE ({flag('transferred')} AS transferred) FROM raw_holidays")
cte(
    "int_sales",
    "stg_sales",
    """
    SELECT id, date, store_nbr, item_nbr, onpromotion IS NOT DISTINCT FROM true AS onpromotion, clipped AS unit_sales,
           ln(1 + clipped) AS log_sales
    FROM (SELECT *, CASE WHEN unit_sales IS NOT NULL THEN greatest(0.0, least(200.0, unit_sales)) END AS clipped
          FROM stg_sales)""",
)
cte(
    "int_items",
    "stg_items",
    "SELECT item_nbr, family, class, CASE perishable WHEN 1 THEN true WHEN 0 THEN false END AS perishable_bool "
    "FROM stg_items",
)
cte("bands", "", f"FROM (VALUES {_BANDS}) AS v(family, p_min, p_max)")
cte(
    "item_prices",
    "stg_items bands",
    f"""
    SELECT item_nbr, upper(i.family) AS family, p_min, p_max, {hashed('item_nbr::VARCHAR')} % 1000000 / 1000000.0 AS u,
           {money('p_min + (0.5 + (u - 0.5) * 0.1) * (p_max - p_min)')} AS base_price
    FROM (SELECT DISTINCT item_nbr, family FROM stg_items) i LEFT JOIN bands b ON b.family = upper(i.family)""",
)
cte(
    "dim_items",
    "int_items item_prices",
    """
    SELECT item_nbr, family, class, perishable_bool IS NOT DISTINCT FROM true AS perishable_bool, base_price
    FROM int_items LEFT JOIN item_prices USING (item_nbr, family)""",
)
cte(
    "oil_days",
    "int_sales raw_oil",
    """
    SELECT unnest(generate_series(greatest(s.lo, o.lo), s.hi, INTERVAL 1 DAY))::DATE AS date
    FROM (SELECT min(date) AS lo, max(date) AS hi FROM int_sales) s,
         (SELECT min(date) AS lo FROM raw_oil WHERE dcoilwtico IS NOT NULL) o""",
)
cte(
    "oil",
    "oil_days raw_oil",
    """
    SELECT date, dcoil, avg(dcoil) OVER (d ROWS 6 PRECEDING) AS dcoil_ma7,
           avg(dcoil) OVER (d ROWS 29 PRECEDING) AS dcoil_ma30,
           dcoil / nullif(lag(dcoil) OVER d, 0) - 1 AS pct_change_1d,
           dcoil / nullif(lag(dcoil, 7) OVER d, 0) - 1 AS pct_change_7d
    FROM (SELECT date, last_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date) AS dcoil
          FROM oil_days LEFT JOIN raw_oil USING (date))
    WINDOW d AS (ORDER BY date)""",
)
cte(
    "holidays",
    "stg_holidays",
    """
    SELECT date, bool_or(locale = 'National' AND (type IN ('Transfer', 'Bridge', 'Additional')
                         OR (type = 'Holiday' AND transferred IS DISTINCT FROM true))) AS is_nat_holiday
    FROM stg_holidays GROUP BY date""",
)
cte(
    "recent_units",
    "int_sales",
    """
    SELECT *, avg(unit_sales) OVER (s ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS avg_units_7d,
           avg(unit_sales) OVER (s ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING) AS avg_units_14d
    FROM int_sales WINDOW s AS (PARTITION BY store_nbr, item_nbr ORDER BY date)""",
)
cte(
    "priced",
    "recent_units dim_items",
    f"""
    SELECT *, {money('base_price * (1 - discount_pct)')} AS effective_price
    FROM (SELECT *, {_LADDER} AS discount_pct
          FROM (SELECT *, greatest(shelf_life_days - days_since_stock, 0) AS time_to_expiry
                FROM (SELECT *, {hashed("concat_ws('-', store_nbr, item_nbr, date)")} % (shelf_life_days + 1)
                                AS days_since_stock
                      FROM (SELECT u.*, family, class, perishable_bool, base_price,
                                   coalesce(days, {K.SHELF_LIFE_DEFAULT})::BIGINT AS shelf_life_days,
                                   dayofweek(date) + 1 AS dow, month(date) AS month, year(date) AS year
                            FROM recent_units u JOIN dim_items USING (item_nbr)
                            LEFT JOIN (VALUES {_LIFE}) AS life(family, days) USING (family)
                            WHERE perishable_bool))))""",
)
cte(
    "fact",
    "priced raw_stores oil",
    """
    SELECT p.*, city, state, type, cluster, dcoil AS oil_price, dcoil_ma7 AS oil_price_ma7,
           dcoil_ma30 AS oil_price_ma30, pct_change_1d, pct_change_7d
    FROM priced p LEFT JOIN raw_stores USING (store_nbr) LEFT JOIN oil USING (date)""",
)
cte(
    "clean",
    "priced raw_stores",
    """
    SELECT date, store_nbr::VARCHAR AS store_nbr, item_nbr::VARCHAR AS item_nbr, class::VARCHAR AS class,
           cluster::VARCHAR AS cluster, family, unit_sales, log_sales, base_price, discount_pct, effective_price,
           time_to_expiry, dow::BIGINT AS dow, month::BIGINT AS month, year::BIGINT AS year
    FROM priced LEFT JOIN raw_stores USING (store_nbr) WHERE base_price > 0 AND effective_price >= 0""",
)
cte(
    "lagged",
    "clean",
    """
    SELECT *, lag(log_sales, 1) OVER s AS lag1_log_sales, lag(log_sales, 7) OVER s AS lag7_log_sales,
           lag(log_sales, 14) OVER s AS lag14_log_sales, lag(log_sales, 28) OVER s AS lag28_log_sales,
           avg(log_sales) OVER (s ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rm7_log_sales,
           avg(log_sales) OVER (s ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS rm28_log_sales,
           max((discount_pct > 0)::INT) OVER (s ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)::BIGINT AS promo_in_last_7d,
           row_number() OVER s AS nth
    FROM clean WINDOW s AS (PARTITION BY store_nbr, item_nbr ORDER BY date)""",
)
cte("enriched", "lagged", "SELECT * EXCLUDE (nth) FROM lagged WHERE nth > 28")
cte(
    "split",
    "enriched",
    f"""
    SELECT *, CASE WHEN date < DATE '{SPLIT["max_date"]}' - {SPLIT["valid_days"]} THEN 'train'
                   WHEN date < DATE '{SPLIT["max_date"]}' - {SPLIT["test_days"]} THEN 'valid' ELSE 'test' END AS split
    FROM enriched""",
)
cte(
    "frame",
    "split",
    """
    SELECT * EXCLUDE (split, log_sales, discount_pct, effective_price, unit_sales), store_nbr AS store_nbr_cat,
           discount_pct AS baseline_discount_pct, effective_price AS baseline_effective_price,
           unit_sales AS observed_unit_sales
    FROM split WHERE split = 'test' AND time_to_expiry <= 2""",
)
cte(
    "cands",
    "frame",
    f"""
    SELECT *, {money('base_price * (1 - cand_discount_pct)')} AS cand_effective_price
    FROM (SELECT * EXCLUDE (store_nbr_cat, baseline_discount_pct, baseline_effective_price, observed_unit_sales),
                 unnest({_GRID}) AS cand_discount_pct FROM frame)""",
)
cte("scored", "cands", f"SELECT *, {units('cand_discount_pct')} AS pred_units FROM cands")
cte(
    "choice",
    "scored",
    """
    SELECT date, store_nbr, item_nbr, cand_discount_pct AS policy_discount_pct,
           cand_effective_price AS policy_effective_price, pred_units AS pred_units_policy,
           cand_effective_price * pred_units AS policy_revenue
    FROM scored
    QUALIFY row_number() OVER (PARTITION BY date, store_nbr, item_nbr
                               ORDER BY policy_revenue DESC NULLS LAST, cand_discount_pct) = 1""",
)
cte(
    "base_eval",
    "frame",
    f"""
    SELECT date, store_nbr, item_nbr, baseline_discount_pct, baseline_effective_price,
           {units('baseline_discount_pct')} AS pred_units_baseline,
           baseline_effective_price * pred_units_baseline AS baseline_revenue, time_to_expiry
    FROM frame""",
)
cte("eval", "base_eval choice", "SELECT * FROM base_eval JOIN choice USING (date, store_nbr, item_nbr)")
cte(
    "daily",
    "eval",
    """
    SELECT date, sum(baseline_revenue) AS baseline_rev, sum(policy_revenue) AS policy_rev,
           policy_rev / nullif(baseline_rev, 0) - 1 AS uplift_pct
    FROM eval GROUP BY date""",
)
cte(
    "buckets",
    "eval",
    f"""
    SELECT {_BUCKET} AS expiry_bucket, sum(baseline_revenue) AS baseline_rev, sum(policy_revenue) AS policy_rev,
           policy_rev / nullif(baseline_rev, 0) - 1 AS uplift_pct, avg(policy_discount_pct) AS avg_policy_discount
    FROM eval GROUP BY expiry_bucket""",
)
cte(
    "scored_test",
    "split",
    f"SELECT *, {units('discount_pct')} AS predicted_unit_sales FROM split WHERE split = 'test'",
)


cte("scored_all", "split", f"SELECT *, {units('discount_pct')} AS predicted_unit_sales FROM split")


def sql(needs: str, body: str) -> str:
    """The body with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in CTES[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in needs.split():
        visit(name)
    head = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in order)
    return f"WITH {head}\n{body}" if head else body


# --- row layouts shared by several queries --------------------------------------------------------------------------

KEYS = "date, store_nbr, item_nbr"


def _rounded(names: str) -> str:
    return ", ".join(f"{r6(n)} AS {n}" for n in names.split())


OIL = _rounded("dcoil dcoil_ma7 dcoil_ma30 pct_change_1d pct_change_7d")
FACT = (
    f"{KEYS}, family, class, perishable_bool, onpromotion, unit_sales, {r6('log_sales')} AS log_sales, base_price, "
    "discount_pct, effective_price, shelf_life_days, days_since_stock, time_to_expiry, dow::BIGINT AS dow, "
    f"month::BIGINT AS month, year::BIGINT AS year, {_rounded('avg_units_7d avg_units_14d')}, city, state, type, "
    f"cluster, {_rounded('oil_price oil_price_ma7 oil_price_ma30 pct_change_1d pct_change_7d')}"
)
CLEAN = (
    f"{KEYS}, class, cluster, family, unit_sales, {r6('log_sales')} AS log_sales, base_price, discount_pct, "
    "effective_price, time_to_expiry, dow, month, year"
)
LAGS = _rounded("lag1_log_sales lag7_log_sales lag14_log_sales lag28_log_sales rm7_log_sales rm28_log_sales")
FRAME = (
    f"{KEYS}, base_price, time_to_expiry, {LAGS}, promo_in_last_7d, dow, month, year, family, class, cluster, "
    "store_nbr_cat, baseline_discount_pct, baseline_effective_price, observed_unit_sales"
)
CHOICE = f"{KEYS}, policy_discount_pct, policy_effective_price, {_rounded('pred_units_policy policy_revenue')}"
BASELINE = (
    f"{KEYS}, baseline_discount_pct, baseline_effective_price, {_rounded('pred_units_baseline baseline_revenue')}"
)
EVAL = f"{BASELINE}, {CHOICE.removeprefix(KEYS + ', ')}"
