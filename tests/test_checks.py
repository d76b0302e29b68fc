"""The compiled checks against one check at a time."""

import re

from pyspark.sql import functions as F

import catalog
from ripecast.operators import quality
from ripecast.operators.quality import KeyCheck, RowCheck
from ripecast.plans import contracts
from ripecast.plans.warehouse import Warehouse
from test_sources import small_raw


def one_by_one(frames, checks):
    out = {}
    for table, many in checks.items():
        for c in many:
            if isinstance(c, RowCheck):
                n = frames[table].where(c.condition).count()
            else:
                n = quality.duplicates(frames[table], *c.columns, skip_null=c.check == "unique").count()
            out[table, c.column, c.check] = n
    return out


def found(report):
    rows = report.collect()
    assert len(rows) == len({r[:3] for r in rows})
    return {(r.table_name, r.column_name, r.check_name): r.failures for r in rows}


def frames_of(w):
    return {t: w.fact if t == "fct_sales_features" else getattr(w, t) for t in contracts.contracts()}


def test_one_grouped_pass_equals_single_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", None), (2, None, -1), (None, "b", 7), (None, "b", 3)], "k int, s string, v int")
    checks = {
        "t": [KeyCheck(("k",)), *quality.missing("k", "s", "v"), RowCheck("v", "low", F.col("v") < 0), KeyCheck(("k", "s"), "unique_combination"), KeyCheck(("s",))],
        "twin": [*quality.missing("k"), KeyCheck(("k",)), KeyCheck(("k",), "unique_combination")],
    }
    frames = {"t": df, "twin": df}
    assert found(quality.shared_report(df, checks)) == one_by_one(frames, checks)
    none = df.limit(0)
    assert set(found(quality.shared_report(none, checks)).values()) == {0}
    rows_only = {"t": quality.missing("s", "v")}
    assert found(quality.shared_report(df, rows_only)) == one_by_one(frames, rows_only)


def test_report_equals_single_checks_on_dirty_tables(spark):
    raw = small_raw(spark)

    def dirty(name):
        df = raw(name)
        if name == "sales":
            twice = df.where("id IN ('0', '7', '8')")
            bad = df.where("id = '9'").withColumns({"store_nbr": F.lit(None).cast("string"), "unit_sales": F.lit("999"), "id": F.lit(None).cast("string")})
            new = df.where("id IN ('12', '13')").withColumn("item_nbr", F.lit("44"))
            return df.unionByName(twice).unionByName(twice).unionByName(bad).unionByName(new)
        if name == "items":
            extra = spark.createDataFrame([("1", "MEATS", "9", "1"), ("2", "toys", None, "1"), ("2", None, "5", "0"), (None, "DELI", "1", "1")], df.schema)
            return df.unionByName(extra)
        return df.unionByName(df.limit(1)) if name == "stores" else df

    w = Warehouse(dirty)
    want = one_by_one(frames_of(w), contracts.contracts())
    assert found(w.report()) == want
    assert want["fct_sales_features", "date,store_nbr,item_nbr", "unique_combination"] > want["int_sales", "date,store_nbr,item_nbr", "unique_combination"] > 0
    assert sum(n > 0 for n in want.values()) > 10


def test_stored_tables_are_checked_as_they_are(spark, tmp_path):
    built = Warehouse(small_raw(spark)).build(str(tmp_path))
    assert found(built.report()) == one_by_one(frames_of(built), contracts.contracts())
    # a stored fact that differs from what its inputs would give
    built.__dict__["fact"] = built.fact.withColumn("base_price", F.lit(-1.0))
    assert found(built.report())["fct_sales_features", "base_price", "positive"] == built.fact.count()


def test_the_report_scans_order_lines_twice(spark, sample):
    plan = catalog.QUERIES["dq_report"](spark, sample)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[[^\n]*lineitem\.parquet", plan)) <= 2
