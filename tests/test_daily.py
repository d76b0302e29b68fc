"""Features appended day by day equal those of a full build."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from test_series import columns, day, panel, result
from test_series import SCHEMA as PANEL

from ripecast import schemas
from ripecast.operators import series, tails
from ripecast.plans import features
from ripecast.plans.daily import DailyFeatures
from ripecast.plans.warehouse import Warehouse
from ripecast.sources import snapshots

KEYS = ["store", "item"]


def steps(spark, rows, cuts, max_rows, min_history=None):
    """All features by a start and one step per later cut, and the last tail."""
    df = spark.createDataFrame(rows, PANEL)
    first = df.where(F.col("date") < F.lit(cuts[0]))
    done = [series.series_columns(first, KEYS, "date", 5, columns, min_history=min_history, ties=["id"], max_rows=max_rows)]
    tail = tails.start_tail(first, KEYS, "date", 5, ["id"])
    for a, b in zip(cuts, [*cuts[1:], day(100_000)]):
        new = df.where((F.col("date") >= F.lit(a)) & (F.col("date") < F.lit(b)))
        done.append(tails.columns_after(tail, new, KEYS, "date", 5, columns, min_history=min_history, ties=["id"], max_rows=max_rows))
        kept = tails.move_tail(tail, new, KEYS, "date", 5, ["id"]).collect()
        tail = spark.createDataFrame(kept, f"{PANEL}, {tails.NTH} long")
    return sorted((r for part in done for r in result(part)), key=str), tail


@pytest.mark.parametrize("max_rows", [20, 1_000_000])
@pytest.mark.parametrize("min_history", [None, 4])
def test_steps_equal_one_pass(spark, max_rows, min_history):
    """With a hot series, NULL keys and values, repeated dates and a crowded date."""
    rows = panel(7)
    whole = spark.createDataFrame(rows, PANEL)
    expected = result(series.series_columns(whole, KEYS, "date", 5, columns, min_history=min_history, ties=["id"], max_rows=max_rows))
    got, tail = steps(spark, rows, [day(7), day(8), day(60)], max_rows, min_history)
    assert got == expected
    sizes = {(r[0], r[1]): r[2] for r in whole.groupBy(*KEYS).count().collect()}
    last = tail.groupBy(*KEYS).agg(F.max(tails.NTH), F.min(tails.NTH), F.count(F.lit(1))).collect()
    assert {(r[0], r[1]): r[2] for r in last} == sizes
    assert all(r[4] == min(5, r[2]) and r[3] == r[2] - r[4] + 1 for r in last)


def test_tail_passes_on_few_rows_of_a_series(spark):
    """The rank filter stands below the exchange, so a hot series is cut before it is shuffled."""
    rows = spark.range(1000).select((F.col("id") % 2).alias("store"), (F.col("id") % 3).alias("item"), F.expr("date_add(date'2020-01-01', cast(id as int))").alias("date"), F.col("id").cast("string"), F.rand().alias("value"))
    plan = tails.start_tail(rows, KEYS, "date", 5, ["id"])._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "WindowGroupLimit" in line or "Exchange hashpartitioning" in line]
    limits = [k for k, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line]
    assert limits and any("Exchange" in line for line in lines[: limits[0]])


def clean_rows(spark, days=40, series_count=4, seed=1):
    rng = random.Random(seed)
    start, rows = dt.date(2024, 1, 1), []
    for s in range(series_count):
        for n in range(days):
            if rng.random() < 0.1 and s:
                continue
            date = start + dt.timedelta(n)
            log = None if rng.random() < 0.05 else rng.random() * 4
            rows.append((date, "1", str(s), "9", "3", "DAIRY", 2.0, log, 5.0, rng.choice([0.0, 0.3]), 4.0, 3, 1, 1, 2024))
    return spark.createDataFrame(rows, schemas.CLEAN)


def content(df):
    return sorted([tuple(None if v is None else round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()], key=str)


def at(n):
    return (dt.date(2024, 1, 1) + dt.timedelta(n)).isoformat()


def test_stored_days_equal_a_full_build(spark, tmp_path):
    clean = clean_rows(spark).cache()
    full = features.features_enriched(clean)
    table = DailyFeatures(spark, str(tmp_path), keep=3)
    table.start(clean, at(29))
    assert content(table.read()) == content(full.where(F.col("date") <= at(29)))
    for n in (30, 31, 32):
        step = table.append(clean, at(n), at(n))
        assert content(step) == content(full.where(F.col("date") == at(n)))
    table.append(clean, at(33), at(39))
    assert content(table.read()) == content(full)
    # a corrected day takes the table back to it, later days come again
    fixed = clean.withColumn("log_sales", F.when(F.col("date") == at(32), F.lit(9.0)).otherwise(F.col("log_sales")))
    table.append(fixed, at(32), at(32))
    assert table.read().agg(F.max("date")).first()[0].isoformat() == at(32)
    table.append(fixed, at(33), at(39))
    assert content(table.read()) == content(features.features_enriched(fixed))
    # only the last three tails are kept
    with pytest.raises(ValueError, match="start anew"):
        table.append(clean, at(30), at(30))
    with pytest.raises(ValueError, match="after"):
        table.append(clean, at(40), at(39))


def test_days_without_rows_and_empty_start(spark, tmp_path):
    clean = clean_rows(spark, 36)
    table = DailyFeatures(spark, str(tmp_path / "a"))
    table.start(clean, at(35))
    before = content(table.read())
    assert table.append(clean, at(36), at(50)).count() == 0
    assert content(table.read()) == before and content(table.tail()) == content(table.tail(at(36)))
    none = DailyFeatures(spark, str(tmp_path / "b"))
    assert none.start(clean.where("false"), at(3)).count() == 0 and none.tail().count() == 0
    with pytest.raises(ValueError, match="start anew"):
        none.append(clean, at(4), at(5))


@pytest.mark.parametrize("failing", ["features", "tails"])
def test_a_step_that_stops_is_repeated(spark, tmp_path, monkeypatch, failing):
    clean = clean_rows(spark).cache()
    full = features.features_enriched(clean)
    table = DailyFeatures(spark, str(tmp_path))
    table.start(clean, at(29))
    table.append(clean, at(30), at(33))
    write = snapshots.SliceTable.write

    def fails(self, df, *args, **more):
        if self is getattr(table, failing) and (failing == "features" or not df.isEmpty()):
            raise OSError("stopped")
        return write(self, df, *args, **more)

    monkeypatch.setattr(snapshots.SliceTable, "write", fails)
    with pytest.raises(OSError):
        table.append(clean, at(30), at(35))
    monkeypatch.setattr(snapshots.SliceTable, "write", write)
    with pytest.raises(ValueError, match="no tail covers"):
        table.append(clean, at(36), at(39))
    table.append(clean, at(30), at(39))
    assert content(table.read()) == content(full)


def test_warehouse_reads_only_new_days(spark, sample, tmp_path):
    w = Warehouse.from_sample(spark, sample)
    sales, cut = w.int_sales, "2001-07-16"
    last = sales.agg(F.max("date")).first()[0].isoformat()
    recent = sales.where(F.col("date") >= "2000-01-01")
    w.__dict__["int_sales"] = recent
    w.feature_days(str(tmp_path), None, cut)
    w.__dict__["int_sales"] = recent.where(F.col("date") > cut)
    w.feature_days(str(tmp_path), (dt.date.fromisoformat(cut) + dt.timedelta(1)).isoformat(), last)
    clean = features.clean_from_sales(recent, w.dim_items, w.dim_stores)
    assert content(DailyFeatures(spark, str(tmp_path)).read()) == content(features.features_enriched(clean))
