import datetime as dt

import pytest
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast import schemas
from ripecast.operators import policy
from ripecast.operators.policy import EVAL_COLUMNS
from ripecast.plans.contracts import COMMENTS, TABLE_COMMENTS
from ripecast.plans.warehouse import Warehouse
from ripecast.sources import deliveries, tables

FILES = {
    "train.csv": "id,date,store_nbr,item_nbr,unit_sales,onpromotion\n"
    + "".join(f"{i},2017-01-{i + 1:02d},1,7,{v},{p}\n" for i, (v, p) in enumerate([(5, "True"), (-2, ""), ("x", "no")])),
    "test.csv": "id,date,store_nbr,item_nbr,onpromotion\n9,2017-02-01,1,7,False\n",
    "items.csv": "item_nbr,family,class,perishable\n7,BREAD/BAKERY,1001,1\n8,TOYS,bad,0\n",
    "stores.csv": "store_nbr,city,state,type,cluster\n1,Quito,Pichincha,D,13\n2,Loja,Loja,A,none\n",
    "oil.csv": "date,dcoilwtico\n2017-01-01,\n2017-01-02,50.5\n",
    "holidays_events.csv": "date,type,locale,locale_name,description,transferred\n2017-01-01,Holiday,National,E,New,False\n",
    "transactions.csv": "date,store_nbr,transactions\n2017-01-01,1,100\n2017-01-02,1,?\n",
    "sample_submission.csv": "id,unit_sales\n9,0\n",
}


@pytest.fixture(scope="module")
def zones(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("zones")
    landing, raw = root / "landing", root / "raw"
    landing.mkdir()
    for name, text in FILES.items():
        (landing / name).write_text(text)
        for day in ("2025-01-01", "2025-01-02"):
            deliveries.ingest(spark, str(landing / name), str(raw), day)
    # a rerun must not duplicate
    deliveries.ingest(spark, str(landing / "train.csv"), str(raw), "2025-01-02")
    return str(landing), str(raw)


def test_files_are_routed(spark, zones):
    routed = {r.file: r.table_name for r in deliveries.list_deliveries(spark, zones[0]).collect()}
    assert routed == {
        "train.csv": "sales",
        "test.csv": "sales",
        "items.csv": "misc",
        "stores.csv": "stores",
        "oil.csv": "oil_prices",
        "holidays_events.csv": "holidays",
        "transactions.csv": "transactions",
        "sample_submission.csv": "_docs",
    }


def test_raw_is_text_of_one_snapshot(spark, zones):
    raw = deliveries.read_raw(spark, zones[1], "sales", "2025-01-02")
    assert {f.dataType.simpleString() for f in raw.schema} == {"string"}
    assert raw.count() == 3 and "onpromotion" in raw.columns and "unit_sales" in raw.columns
    assert all("ingest_date=2025-01-02/source_file=train.csv" in f for f in raw.inputFiles())
    assert deliveries.read_raw(spark, zones[1], "items", "2024-01-01").count() == 0


def test_csv_to_fact(spark, zones):
    w = Warehouse.from_raw_zone(spark, zones[1], "2025-01-02")
    rows = w.fact.orderBy("date").collect()
    assert [(r.unit_sales, r.onpromotion) for r in rows] == [(5.0, True), (0.0, False), (None, False)]
    assert [r.oil_price for r in rows] == [None, 50.5, 50.5]
    assert rows[0].family == "BREAD_BAKERY" and rows[0].city == "Quito" and rows[0].cluster == 13
    assert [r.avg_units_7d for r in rows] == [None, 5.0, 2.5]
    assert [r.cluster for r in w.dim_stores.orderBy("store_nbr").collect()] == [13, None]
    assert [r["class"] for r in w.dim_items.orderBy("item_nbr").collect()] == [1001, None]
    assert w.features_split.count() == 0 and w.scoring_frame.count() == 0
    assert w.tx_signals.where("transactions IS NULL").count() == 1
    w.publish("csv_")
    assert spark.sql("SELECT sum(unit_sales) FROM csv_fct_sales_features WHERE family = 'BREAD_BAKERY'").first()[0] == 5.0


def daily(spark, *rows):
    return spark.createDataFrame([(dt.date(2017, 8, d), s, v) for d, s, v in rows], "date date, store_nbr long, v long")


def content(spark, path):
    return sorted((r.date.day, r.store_nbr, r.v) for r in spark.read.parquet(path).collect())


QUOTED = 'date,type,locale,locale_name,description,transferred\n2017-01-01,Holiday,National,E,"Says ""hi"", ok\nand more",True\n'


def test_quotes_commas_and_line_breaks_in_fields(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    landing.mkdir()
    (landing / "holidays_events.csv").write_text(QUOTED)
    deliveries.ingest(spark, str(landing / "holidays_events.csv"), raw, "2025-01-01", multi_line=True)
    row = deliveries.read_raw(spark, raw, "holidays", "2025-01-01", multi_line=True).first()
    assert (row.description, row.transferred) == ('Says "hi", ok\nand more', "True")


def test_moved_columns_and_stray_files(spark, tmp_path):
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    landing.mkdir()
    for name, text in {"items.csv": FILES["items.csv"], "notes.csv": "item_nbr,note\n99,hello\n", "oil.csv": "dcoilwtico,date\n50.5,2017-01-02\n"}.items():
        (landing / name).write_text(text)
        deliveries.ingest(spark, str(landing / name), raw, "2025-01-01")
    assert sorted(r.item_nbr for r in deliveries.read_raw(spark, raw, "items", "2025-01-01").collect()) == ["7", "8"]
    with pytest.raises(Exception, match="CSV header"):
        deliveries.read_raw(spark, raw, "oil_prices", "2025-01-01").collect()


def test_day_scan_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(daily(spark, (1, 1, 1), (2, 1, 2)), path)
    one = tables.read_day(spark.read.parquet(path), "2017-08-02")
    assert [r.v for r in one.collect()] == [2]
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().executedPlan().toString()


def test_rows_are_sorted_inside_a_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(daily(spark, *[(1, s, s) for s in (5, 3, 9, 1)]), path, cluster=["store_nbr"])
    assert [r.store_nbr for r in spark.read.parquet(path).collect()] == [1, 3, 5, 9]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "c")
    tables.write_csv(daily(spark, (1, 1, 7)), path)
    tables.write_csv(daily(spark, (1, 1, 8)), path)
    assert [tuple(r) for r in deliveries.read_csv(spark, path).collect()] == [("2017-08-01", "1", "8")]


def test_views_tables_schemas_and_descriptions(spark):
    df = daily(spark, (1, 1, 7))
    tables.create_schema(spark, "gold")
    tables.create_schema(spark, "gold")
    assert tables.publish(df, "v_daily").count() == 1
    noted = tables.describe(df, COMMENTS)
    assert tables.publish(noted, "gold.daily", "table").count() == 1
    assert tables.publish(noted, "gold.daily", "table").count() == 1
    comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE gold.daily").collect()}
    assert comments["date"] == COMMENTS["date"] and comments["v"] is None
    with pytest.raises(ValueError):
        tables.publish(df, "x", "cube")


def test_tables_keep_a_description_and_a_place(spark, tmp_path):
    tables.create_schema(spark, "gold")
    place = str(tmp_path / "daily")
    tables.publish(daily(spark, (1, 1, 7)), "gold.described", "table", "Sam's \\ daily 'sales'", place)
    shown = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED gold.described").collect()}
    assert shown["Comment"] == "Sam's \\ daily 'sales'" and shown["Location"].endswith(place)
    w = Warehouse(small_raw(spark))
    w.publish("gold.", "table", str(tmp_path / "gold"))
    for name, text in TABLE_COMMENTS.items():
        shown = {r.col_name: r for r in spark.sql(f"DESCRIBE TABLE EXTENDED gold.{name}").collect()}
        assert shown["Comment"].data_type == text
    assert spark.table("gold.dim_items").schema["item_nbr"].metadata["comment"] == COMMENTS["item_nbr"]


def test_empty_typed_tables(spark):
    none = tables.empty(spark, schemas.POLICY["eval"])
    assert none.columns == EVAL_COLUMNS and none.count() == 0
    assert tables.documented(none.schema, COMMENTS)["date"].metadata == {"comment": COMMENTS["date"]}


def layout(df):
    return [(f.name, f.dataType.simpleString()) for f in df.schema]


def test_tables_have_their_declared_schemas(spark, sample):
    w = Warehouse.from_sample(spark, sample)
    for name, ddl in schemas.TABLES.items():
        assert layout(getattr(w, name)) == layout(tables.empty(spark, ddl)), name
    for name, ddl in schemas.NATIVE.items():
        assert layout(w.native(name)) == layout(tables.empty(spark, ddl)), name
    scored = policy.score_candidates(policy.candidates(w.scoring_frame), policy.FormulaScorer())
    assert layout(scored) == layout(tables.empty(spark, schemas.POLICY["candidates"]))
    assert layout(policy.choose(scored)) == layout(tables.empty(spark, schemas.POLICY["choice"]))
    swept = policy.sweep(w.scoring_frame, policy.FormulaScorer())
    assert layout(swept) == layout(tables.empty(spark, schemas.POLICY["eval"]))


def small_raw(spark):
    """Sixty days of six series, all text."""
    sales = spark.range(360).select(
        F.col("id").cast("string").alias("id"),
        F.date_add(F.lit(dt.date(2017, 6, 17)), F.floor(F.col("id") / 6).cast("int")).cast("string").alias("date"),
        (F.col("id") % 2 + 1).cast("string").alias("store_nbr"),
        (F.col("id") % 3 + 1).cast("string").alias("item_nbr"),
        F.when(F.col("id") % 5 == 0, "True").alias("onpromotion"),
        (F.pmod(F.xxhash64("id"), F.lit(30)) - 2).cast("string").alias("unit_sales"),
    )
    rows = {
        "items": ([("1", "DAIRY", "1", "1"), ("2", "BREAD/BAKERY", "2", "1"), ("3", "TOYS", "3", "0")], "item_nbr string, family string, class string, perishable string"),
        "stores": ([("1", "Quito", "P", "D", "13"), ("2", "Loja", "L", "A", "4")], "store_nbr string, city string, state string, type string, cluster string"),
        "oil_prices": ([("2017-06-20", "50.0")], "date string, dcoilwtico string"),
        "holidays": ([("2017-06-20", "Holiday", "National", "E", "N", "False")], "date string, type string, locale string, locale_name string, description string, transferred string"),
        "transactions": ([("2017-06-20", "1", "9")], "date string, store_nbr string, transactions string"),
    }
    frames = {t: spark.createDataFrame(*r) for t, r in rows.items()} | {"sales": sales}
    return frames.__getitem__


def test_stored_layers_give_the_same_results(spark, tmp_path):
    root = str(tmp_path)
    lazy, scorer = Warehouse(small_raw(spark)), policy.FormulaScorer()
    built = Warehouse(small_raw(spark)).build(root)
    for name in ("fact", "features_split", "scoring_frame"):
        left, right = getattr(lazy, name), getattr(built, name)
        assert left.columns == right.columns and left.count() > 0
        assert sorted(map(str, left.collect())) == sorted(map(str, right.collect())), name
    assert built.report().where("failures > 0").count() == lazy.report().where("failures > 0").count()
    want = sorted(map(str, lazy.policy_eval(scorer).collect()))
    built.run_policy(scorer, root, end="2017-08-07")
    for _ in range(2):
        results = built.run_policy(scorer, root, start="2017-08-05")
    assert sorted(map(str, results["policy_eval"].collect())) == want
    assert results["kpi_overall"].first().n_rows == len(want)
    assert deliveries.read_csv(spark, f"{root}/kpi_by_date").columns == ["date", "baseline_rev", "policy_rev", "uplift_pct"]


def test_builds_leave_the_last_complete_one(spark, tmp_path):
    root = str(tmp_path)
    raw = small_raw(spark)
    w = Warehouse(raw).build(root)
    first = sorted(map(str, w.fact.collect()))
    assert sorted(map(str, w.build(root).fact.collect())) == first
    assert w.dim_items.schema["item_nbr"].metadata == {"comment": COMMENTS["item_nbr"]}
    broken = Warehouse(lambda t: raw(t).withColumn("item_nbr", F.lit("bad")) if t == "items" else raw(t))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        broken.build(root)
    again = Warehouse(raw).open(spark, root)
    assert sorted(map(str, again.fact.collect())) == first


def test_policy_tables_of_models_and_shards(spark, tmp_path):
    root = str(tmp_path)
    w, scorer = Warehouse(small_raw(spark)), policy.FormulaScorer()
    want = sorted(map(str, w.policy_eval(scorer).collect()))
    for shard in range(3):
        results = w.run_policy(scorer, root, model="a", start="2017-08-01", end="2017-08-31", shard=shard, n_shards=3)
    assert sorted(map(str, results["policy_eval"].collect())) == want
    assert results["policy_candidates"].count() == len(want) * len(K.DISCOUNT_GRID)
    assert results["policy_choice"].count() == len(want)
    w.run_policy(scorer, root, model="b", start="2017-08-01", end="2017-08-02")
    assert sorted(map(str, results["policy_eval"].collect())) == want


def test_bucketed_series_need_no_shuffle(spark):
    rows = spark.range(200).select(
        (F.col("id") % 5).alias("store_nbr"),
        (F.col("id") % 3).alias("item_nbr"),
        F.date_add(F.lit(dt.date(2017, 1, 1)), F.col("id").cast("int")).alias("date"),
        F.col("id").cast("string").alias("id"),
        F.lit(1.0).alias("unit_sales"),
    )
    tables.create_schema(spark, "gold")
    tables.save_series_table(rows, "gold.series", K.SERIES, 4)
    from ripecast.plans.fact import with_recent_units

    stored = spark.table("gold.series")
    threshold = spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    plan = with_recent_units(stored, None)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, (threshold, plan)
