"""Split series give the same rows as one plain window, checked against plain Python."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ripecast.operators import series
from ripecast.operators.timeseries import trailing_mean

SCHEMA = "store long, item long, date date, id string, value double"
DAY0 = dt.date(2020, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def columns(w):
    return {
        "lag1": F.lag("value", 1).over(w),
        "lag5": F.lag("value", 5).over(w),
        "mean5": trailing_mean("value", w, 5, include_current=False),
    }


def run(df, max_rows, min_history=None):
    return series.series_columns(
        df, ["store", "item"], "date", 5, columns, min_history=min_history, ties=["id"], max_rows=max_rows
    )


def result(df):
    rows = [(r["store"], r["item"], r["date"], r["id"], r["lag1"], r["lag5"], r["mean5"]) for r in df.collect()]
    rows = [(*r[:6], None if r[6] is None else round(r[6], 9)) for r in rows]
    return sorted(rows, key=str)


def brute(spark, rows, min_history=0):
    """Order each series by (date, hash of id, id) and look back row by row."""
    ids = sorted({r[3] for r in rows})
    hashed = spark.createDataFrame([(i,) for i in ids], "id string").select("id", series._spread(["id"]).alias("h"))
    block = {r["id"]: r["h"] for r in hashed.collect()}
    groups = defaultdict(list)
    for r in rows:
        groups[r[:2]].append(r)
    out = []
    for g in groups.values():
        g.sort(key=lambda r: (r[2], block[r[3]], r[3]))
        for i, r in enumerate(g):
            if i < min_history:
                continue
            values = [x[4] for x in g[max(0, i - 5) : i]]
            known = [v for v in values if v is not None]
            mean = round(sum(known) / len(known), 9) if known else None
            out.append((*r[:4], g[i - 1][4] if i >= 1 else None, g[i - 5][4] if i >= 5 else None, mean))
    return sorted(out, key=str)


def panel(seed):
    """A third of all rows in one series, NULL keys, NULL values, repeated dates and one crowded date."""
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        rows.append((1, 1, day(i // 3), f"a{i}", rng.choice([None, float(rng.randrange(50))])))
    for i in range(200):
        rows.append((1, 2, day(7), f"b{i}", float(rng.randrange(50))))
    for i in range(150):
        rows.append((None, 3, day(i), f"c{i}", float(rng.randrange(50))))
    for s in range(2, 12):
        for i in range(rng.randrange(1, 40)):
            rows.append((s, 1, day(i * 2), f"d{s}-{i}", float(rng.randrange(50))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("max_rows", [1, 7, 60, 10_000])
def test_any_chunk_size_gives_the_same_rows(spark, max_rows):
    rows = panel(1)
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(run(df, max_rows)) == brute(spark, rows)


def test_history_filter_survives_the_split(spark):
    rows = panel(2)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(spark, rows, min_history=5)
    assert result(run(df, 20, min_history=5)) == want
    assert result(run(df, 10_000, min_history=5)) == want


@pytest.mark.parametrize("copies", [3, 6, 7, 500])
def test_exact_copies_are_kept_whole(spark, monkeypatch, copies):
    monkeypatch.setattr(series, "EXPAND_STEP", 100)
    rows = [(1, 1, day(i), f"a{i}", float(i)) for i in range(30)]
    rows += [(1, 1, day(10), "copy", 3.0)] * copies
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(run(df, 16)) == brute(spark, rows)


def test_twenty_eight_rows_are_too_few(spark):
    rows = [(1, 1, day(i), str(i), 1.0) for i in range(28)] + [(1, 2, day(i), str(i), 1.0) for i in range(29)]
    df = spark.createDataFrame(rows, SCHEMA)
    for max_rows in (None, 1000, 10):
        kept = series.series_columns(
            df, ["store", "item"], "date", 28, columns, min_history=28, ties=["id"], max_rows=max_rows
        )
        assert [(r["item"], r["date"]) for r in kept.collect()] == [(2, day(28))]


def test_no_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert run(df, 10).collect() == []
    assert run(df, 10).columns == [*df.columns, "lag1", "lag5", "mean5"]


def test_history_longer_than_lookback_is_refused(spark):
    with pytest.raises(ValueError):
        run(spark.createDataFrame([], SCHEMA), 10, min_history=6)


def test_repeated_ids_give_the_same_rows_on_both_paths(spark):
    rows = [(1, 1, day(n // 4), "same", float(n % 7)) for n in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole, split = run(df, 10**6), run(df, 10)
    assert sorted(map(str, whole.collect())) == sorted(map(str, split.collect()))
