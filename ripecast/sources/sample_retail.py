"""The six raw retail tables, derived from the sample star schema by whole-table rules.

Stores are nations, items are part brands, a day's sales of an item in a store are its shipped order lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripecast.session import tune

# fixed values: raw family names by item number modulo 11; the last two are not perishable
FAMILIES = [
    "BREAD/BAKERY",
    "DAIRY",
    "DELI",
    "EGGS",
    "MEATS",
    "POULTRY",
    "PREPARED FOODS",
    "PRODUCE",
    "SEAFOOD",
    "GROCERY I",
    "CLEANING",
]
STORE_TYPES = ["A", "B", "C", "D", "E"]
# the columns in use; a declared schema saves a footer read per table
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "part": "p_partkey BIGINT, p_brand STRING",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
        "o_orderpriority STRING"
    ),
    "lineitem": (
        "l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE, l_discount DOUBLE, l_returnflag STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
}
SPLIT = dict(max_date="2001-11-04", valid_days=360, test_days=180)


class SampleRetail:
    """Raw tables over one folder of sample parquet files; every table is lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.folder}/{table}.parquet")

    def _item_of_part(self) -> DataFrame:
        number = F.element_at(F.split("p_brand", "#"), 2).cast("long")
        return self._read("part").select("p_partkey", number.alias("item_nbr"))

    def _lines(self) -> DataFrame:
        """Order lines with their store and item."""
        lines = self._read("lineitem").select(
            F.col("l_shipdate").cast("date").alias("date"),
            "l_partkey",
            "l_suppkey",
            F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("units"),
            "l_discount",
        )
        stores = self._read("supplier").select("s_suppkey", F.col("s_nationkey").cast("long").alias("store_nbr"))
        return lines.join(stores, F.col("l_suppkey") == F.col("s_suppkey")).join(
            self._item_of_part(), F.col("l_partkey") == F.col("p_partkey")
        )

    def sale_days(self) -> DataFrame:
        """Dates with sales, once per order line: enough for the first and last day, without grouping."""
        return self._lines().select("date")

    def sales(self) -> DataFrame:
        """One row per (date, store, item): returned lines count negative, the largest line discount sets the promo."""
        grouped = (
            self._lines()
            .groupBy("date", "store_nbr", "item_nbr")
            .agg(F.sum("units").alias("units"), F.max("l_discount").alias("discount"))
        )
        promo = F.when(F.col("discount") >= 0.08, "Yes").when(F.col("discount") >= 0.04, "FALSE")
        return grouped.select(
            F.concat_ws("-", "date", "store_nbr", "item_nbr").alias("id"),
            "date",
            "store_nbr",
            "item_nbr",
            promo.alias("onpromotion"),
            (F.col("units") * 4.0).alias("unit_sales"),
        )

    def items(self) -> DataFrame:
        numbers = self._item_of_part().select("item_nbr").distinct()
        kind = F.col("item_nbr") % len(FAMILIES)
        family = F.get(F.array(*[F.lit(f) for f in FAMILIES]), kind.cast("int"))
        return numbers.select(
            "item_nbr",
            family.alias("family"),
            (F.lit(1000) + F.col("item_nbr")).alias("class"),
            F.when(kind < 9, 1).when(kind == 9, 0).cast("long").alias("perishable"),
        )

    def stores(self) -> DataFrame:
        nation, region = self._read("nation"), self._read("region")
        store_type = F.get(F.array(*[F.lit(t) for t in STORE_TYPES]), F.col("n_nationkey") % len(STORE_TYPES))
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").cast("long").alias("store_nbr"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            store_type.alias("type"),
            F.col("n_regionkey").cast("long").alias("cluster"),
        )

    def oil_prices(self) -> DataFrame:
        """Daily price without weekend quotes."""
        daily = (
            self._read("orders")
            .groupBy(F.col("o_orderdate").cast("date").alias("date"))
            .agg(F.avg("o_totalprice").alias("price"))
        )
        quote = F.round((F.col("price") / 1000.0).cast("decimal(18,6)"), 2).cast("double")
        return daily.select("date", F.when(~F.dayofweek("date").isin(1, 7), quote).alias("dcoilwtico"))

    def holidays(self) -> DataFrame:
        """One calendar entry per order."""
        kind = (
            F.when(F.col("o_orderpriority") == "1-URGENT", "Holiday")
            .when(F.col("o_orderpriority") == "2-HIGH", "Transfer")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "Bridge")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Work Day")
            .when(F.col("o_custkey") % 2 == 1, "Additional")
            .otherwise("Event")
        )
        locale = F.when(F.col("o_orderstatus") == "F", "National").when(F.col("o_orderstatus") == "O", "Regional")
        moved = F.get(F.array(*[F.lit(x) for x in ("True", "FALSE", "yes", "n/a")]), (F.col("o_custkey") % 4).cast("int"))
        return self._read("orders").select(
            F.col("o_orderdate").cast("date").alias("date"),
            kind.alias("type"),
            locale.otherwise("Local").alias("locale"),
            F.concat(F.lit("Locale "), F.col("o_orderstatus")).alias("locale_name"),
            F.concat(F.lit("Order "), F.col("o_orderkey")).alias("description"),
            moved.alias("transferred"),
        )

    def transactions(self) -> DataFrame:
        orders, customer = self._read("orders"), self._read("customer")
        return (
            orders.join(customer, orders.o_custkey == customer.c_custkey)
            .groupBy(
                F.col("o_orderdate").cast("date").alias("date"), F.col("c_nationkey").cast("long").alias("store_nbr")
            )
            .agg(F.count(F.lit(1)).alias("transactions"))
        )
