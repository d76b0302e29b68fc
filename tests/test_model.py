import dataclasses

import pytest
from pyspark.sql import functions as F

import catalog
from ripecast import constants as K
from ripecast.operators import boosting, lookup, model, policy
from ripecast.plans.warehouse import Warehouse
from ripecast.session import checkpoint_dir

SMALL = dict(maxIter=4, maxDepth=4)


@pytest.fixture(scope="module")
def split(spark, sample, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("features") / "split")
    Warehouse.from_sample(spark, sample).features_split.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def fitted(split):
    return model.train(split, **SMALL)


def predictions(m, df):
    return sorted((r.date, r.store_nbr, r.item_nbr, r.predicted_unit_sales) for r in model.predict(m, df).collect())


def test_model_beats_the_mean(split, fitted):
    train = split.where(F.col("split") == "train")
    mean = train.agg(F.avg(K.LABEL)).first()[0]
    ours = model.metrics(model.predict(fitted, train)).first()
    constant = model.metrics(train.withColumn("predicted_unit_sales", F.lit(mean))).first()
    assert ours.root_mean_squared_error < constant.root_mean_squared_error
    assert constant.r2_score == pytest.approx(0, abs=1e-9)


def test_training_needs_a_checkpoint_folder(split, monkeypatch):
    monkeypatch.setattr(model, "checkpoint_dir", lambda spark: None)
    with pytest.raises(ValueError, match="checkpoint"):
        model.train(split, **SMALL)


def test_category_limit_is_the_callers(split):
    with pytest.raises(ValueError, match="categorical"):
        model.train(split, max_categories=1, **SMALL)


def test_training_repeats_under_a_seed(split, fitted):
    test = split.where(F.col("split") == "test")
    assert predictions(fitted, test) == predictions(model.train(split, **SMALL), test)


def test_saved_model_predicts_the_same(split, fitted, tmp_path):
    test = split.where(F.col("split") == "test")
    model.save(fitted, str(tmp_path / "m"))
    model.save(fitted, str(tmp_path / "m"))
    assert predictions(model.load(str(tmp_path / "m")), test) == predictions(fitted, test)


def test_predict_keeps_its_input(split, fitted):
    test = split.where(F.col("split") == "test")
    scored = model.predict(fitted, test)
    assert scored.columns == [*test.columns, "predicted_unit_sales"]
    assert scored.drop("predicted_unit_sales").exceptAll(test).count() == 0


def test_unknown_categories_and_missing_numbers_are_scored(split, fitted):
    odd = split.limit(5).withColumns(
        {"family": F.lit("NEW"), "class": F.lit(None).cast("string"), "rm7_log_sales": F.lit(None).cast("double")}
    )
    assert model.predict(fitted, odd).where(F.col("predicted_unit_sales").isNotNull()).count() == 5


def test_importance_covers_all_features(split, fitted):
    table = {r.feature: r.importance for r in model.feature_importance(fitted, split).collect()}
    assert set(table) == {*K.NUMERIC_FEATURES, *K.CATEGORICAL_FEATURES}
    assert sum(table.values()) == pytest.approx(1.0)


def test_weight_and_cover_come_from_the_stored_nodes(spark, split, fitted):
    nodes = model.nodes(fitted, spark)
    nodes.createOrReplaceTempView("tree_nodes")
    counted = spark.sql("SELECT feature, count(*) AS weight, sum(n_rows) AS cover FROM tree_nodes WHERE feature IS NOT NULL GROUP BY feature")
    want = {r.feature: (r.weight, r.cover) for r in counted.collect()}
    table = {r.feature: r for r in model.feature_importance(fitted, split).collect()}
    assert {f: (r.weight, r.cover) for f, r in table.items() if r.weight} == want
    assert sum(r.weight for r in table.values()) == sum((t.numNodes - 1) // 2 for t in fitted.stages[-1].trees)
    roots = nodes.where("node = 0").collect()
    assert len(roots) == fitted.stages[-1].getNumTrees and all(r.n_rows > 0 for r in roots)
    assert all((r.gain > 0) == (r.weight > 0) for r in table.values())


def test_policy_with_a_model(split, fitted):
    frame = policy.scoring_frame(split)
    scorer = model.ModelScorer(fitted)
    swept = policy.sweep(frame, scorer)
    assert "Exchange" not in swept._jdf.queryExecution().executedPlan().toString()
    scored = policy.score_candidates(policy.candidates(frame), scorer)
    long = policy.join_eval(policy.baseline(frame, scorer), policy.choose(scored))
    assert sorted(map(tuple, swept.collect())) == sorted(map(tuple, long.collect()))
    assert swept.count() == frame.count()
    revenue = F.col("cand_effective_price") * F.col("pred_units")
    assert scored.join(swept, K.KEYS).where(revenue > F.col("policy_revenue")).count() == 0


def test_checkpoints_go_to_the_named_folder(spark):
    assert checkpoint_dir(spark).startswith(("file:", "/")) and "checkpoints" in checkpoint_dir(spark)


def test_presets_train(split):
    for preset in model.PRESETS:
        assert model.train(split, preset, maxIter=1, maxDepth=2).stages[-1].getNumTrees == 1
    for preset in boosting.PRESETS:
        assert len(boosting.train(split, preset, rounds=1).trees) == 1
    # without valid rows there is nothing to stop on
    assert model.train(split.where(F.col("split") == "train"), maxIter=1, maxDepth=2).stages[-1].getNumTrees == 1


def test_vocabulary_and_unknown_marker(spark, split):
    train = split.where(F.col("split") == "train")
    seen = model.vocabulary(train, "family")
    df = spark.createDataFrame([("DAIRY",), ("NEW",), (None,)], "family string")
    got = lookup.replace_unknown(df, "family", seen, K.UNKNOWN_CATEGORY)
    assert sorted(r.family for r in got.collect()) == ["DAIRY", "__UNK__", "__UNK__"]


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0), (None, 1.0)], "unit_sales double, predicted_unit_sales double")
    row = model.metrics(df).first()
    assert row.n_rows == 3
    assert row.mean_absolute_error == pytest.approx(4 / 3)
    assert row.mean_squared_error == pytest.approx(10 / 3)
    assert row.median_absolute_error == 1.0
    assert row.r2_score == pytest.approx(1 - 10 / 8)


def test_registered_models_are_fitted_on_and_score_features_computed_once(spark, sample, monkeypatch):
    given = []
    kept = lambda df: "InMemoryRelation" in df._jdf.queryExecution().withCachedData().toString()
    monkeypatch.setattr(catalog, "_FEATURES", {})
    train, cut = model.train, dict(SMALL, maxIter=1)
    monkeypatch.setattr(catalog, "_MODELS", {})
    monkeypatch.setattr(model, "train", lambda rows, *a: given.append(kept(rows)) or train(rows, *a, **cut))
    scored = catalog.QUERIES["predict_exact"](spark, sample)
    assert given == [True] and kept(scored)
    plain = Warehouse.from_sample(spark, sample).features_split.where(F.col("split") == "test")
    assert scored.count() == plain.count() and scored.select(*K.KEYS).exceptAll(plain.select(*K.KEYS)).isEmpty()
    catalog._FEATURES.popitem()[1].unpersist()


def test_registered_boosters_train_by_their_whole_presets(spark, sample, monkeypatch):
    given = {}
    monkeypatch.setattr(catalog, "_FEATURES", {})
    monkeypatch.setattr(catalog, "_MODELS", {})
    monkeypatch.setattr(boosting, "train", lambda rows, preset, **overrides: given.update({preset: dataclasses.replace(boosting.PRESETS[preset], **overrides)}))
    for preset in boosting.PRESETS:
        catalog.fitted(Warehouse.from_sample(spark, sample), preset)
    catalog._FEATURES.popitem()[1].unpersist()
    assert given == boosting.PRESETS
    assert {k: (p.rounds, p.patience) for k, p in given.items()} == {"histogram": (1000, 50), "leafwise": (800, 100)}
