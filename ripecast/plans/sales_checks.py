"""The checks of staged, cleaned and featured sales in one pass over the sales.

The three tables are the same rows in three states, so their checks need not build them one by one. The rows are grouped
by (date, store, item); a group carries its size and the failures of every check that looks at sales columns. Price and
expiry of the fact depend on the group's key and its item alone, so they are worked out per group, after the join to the
item dimension, and weigh as many rows as the group has. Neither windows nor the oil series are touched.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast.functions import shelf_life, stable_hash
from ripecast.operators.quality import Check, KeyCheck, RowCheck, flag, lines
from ripecast.plans import dims
from ripecast.plans.fact import perishable_items, with_price_and_expiry

TABLES = ("stg_sales", "int_sales", "fct_sales_features")


def report(stg: DataFrame, dim_items: DataFrame, dim_stores: DataFrame, checks: Mapping[str, Sequence[Check]]) -> DataFrame:
    """table_name, column_name, check_name, failures of the three tables.

    Repeated rows of the item or store dimension multiply the fact's rows here as they do in its joins.
    """
    staged, cleaned, fact = (checks[t] for t in TABLES)
    odd = [c for t in TABLES for c in checks[t] if isinstance(c, KeyCheck) and (t == "stg_sales" or c.columns != tuple(K.KEYS) or c.check == "unique")]
    if odd:
        raise ValueError(f"only the grain is a key here: {odd}")
    sales = dims.int_sales(stg.select("*", *[flag(c).alias(f"_s{i}") for i, c in enumerate(staged)]), *[f"_s{i}" for i in range(len(staged))])
    by_row = lambda c: isinstance(c, RowCheck) and c.column in sales.columns
    groups = sales.groupBy(*K.KEYS).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(f"_s{i}").alias(f"_s{i}") for i in range(len(staged))],
        *[F.sum(flag(c)).alias(f"_c{i}") for i, c in enumerate(cleaned) if isinstance(c, RowCheck)],
        *[F.sum(flag(c)).alias(f"_f{i}") for i, c in enumerate(fact) if by_row(c)],
    )

    columns = ["family", "class", "perishable_bool", "base_price"]
    items = perishable_items(dim_items).groupBy("item_nbr").agg(F.collect_list(F.struct(*columns)).alias("_items"))
    stores = dim_stores.groupBy("store_nbr").agg(F.count(F.lit(1)).alias("_stores"))
    joined = groups.join(items, "item_nbr", "left").join(stores, "store_nbr", "left")
    opened = joined.select("*", F.posexplode_outer("_items").alias("_place", "_item")).select("*", *[F.col(f"_item.{c}").alias(c) for c in columns])
    hashed = opened.withColumns(
        {"shelf_life_days": shelf_life(F.col("family")), "_key_hash": stable_hash(F.col("store_nbr"), F.col("item_nbr"), F.col("date"))}
    )
    rows = with_price_and_expiry(hashed)

    first = F.coalesce(F.col("_place") == 0, F.lit(True))
    perishable = F.col("_place").isNotNull()
    copies = F.coalesce("_stores", F.lit(1))
    once = lambda n: F.sum(F.when(first, n).otherwise(0))
    in_fact = lambda n: F.sum(F.when(perishable, n * copies).otherwise(0))
    found, sums = [], []

    def add(table: str, check: Check, total) -> None:
        name = f"t{len(sums)}"
        sums.append(total.alias(name))
        found.append((table, check, F.col(name)))

    for i, c in enumerate(staged):
        add("stg_sales", c, once(F.col(f"_s{i}")))
    for i, c in enumerate(cleaned):
        add("int_sales", c, once(F.col(f"_c{i}")) if isinstance(c, RowCheck) else F.count_if(first & (F.col("_n") > 1)))
    for i, c in enumerate(fact):
        if isinstance(c, KeyCheck):
            total = F.count_if(first & perishable & (F.col("_n") * F.size("_items") * copies > 1))
        elif by_row(c):
            total = in_fact(F.col(f"_f{i}"))
        else:
            total = in_fact(F.when(F.coalesce(c.condition, F.lit(False)), F.col("_n")).otherwise(0))
        add("fct_sales_features", c, total)
    return lines(rows.agg(*sums), found)
