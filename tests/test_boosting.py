"""Distributed leaf-wise boosting against a plain one, resumed training, encodings, importance."""

import dataclasses
import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast.operators import boosting, encoding, model, policy
from ripecast.operators.boosting import Params
from ripecast.plans.warehouse import Warehouse


@pytest.fixture(scope="module")
def split(spark, sample, tmp_path_factory):
    """Features of the sample tables with a label that depends on them."""
    path = str(tmp_path_factory.mktemp("features") / "split")
    label = 5 + 3 * F.col("dow") + 10 * F.coalesce("discount_pct", F.lit(0.0)) * F.col("month") + F.pmod(F.xxhash64(*K.KEYS), F.lit(3))
    Warehouse.from_sample(spark, sample).features_split.withColumn(K.LABEL, label.cast("double")).write.parquet(path)
    return spark.read.parquet(path)


def mean_error(split, part):
    mean = split.where(F.col("split") == "train").agg(F.avg(K.LABEL)).first()[0]
    return split.where(F.col("split") == part).agg(F.avg(F.pow(F.col(K.LABEL) - mean, 2))).first()[0]


# --- one tree --------------------------------------------------------------------------------------------------------


def plain_tree(x, g, params):
    """(feature, cut, rows) of the splits in the order of best-first growth, by trying every cut."""

    def best(rows):
        score = lambda r: g[r].sum() ** 2 / (len(r) + params.smoothing)
        found = (0.0, 0, 0)
        for f in range(x.shape[1]):
            for cut in range(256):
                left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                if min(len(left), len(right)) >= max(params.min_rows, 1):
                    gain = score(left) + score(right) - score(rows)
                    if gain > found[0] + 1e-9:
                        found = (gain, f, cut)
        return found

    out, leaves = [], 1
    heap = [(-best(np.arange(len(x)))[0], 0, 0, np.arange(len(x)))]
    made = 0
    while heap and leaves < params.max_leaves:
        gain, _, depth, rows = heapq.heappop(heap)
        if gain >= 0 or (params.max_depth and depth >= params.max_depth):
            continue
        _, f, cut = best(rows)
        out.append((f, cut, len(rows)))
        leaves += 1
        for part in (rows[x[rows, f] <= cut], rows[x[rows, f] > cut]):
            made += 1
            heapq.heappush(heap, (-best(part)[0], made, depth + 1, part))
    return out


@pytest.mark.parametrize("params", [Params(max_leaves=12), Params(max_leaves=40, min_rows=9, smoothing=1.0), Params(max_leaves=64, max_depth=3), Params(max_leaves=2)])
def test_a_tree_equals_one_grown_a_leaf_at_a_time(spark, params):
    r = np.random.default_rng(3)
    x = r.integers(0, 12, (400, 3)).astype(np.uint8)
    y = np.round(np.where(x[:, 0] > 5, 4.0 * x[:, 1], 1.0 * x[:, 2]) + r.normal(size=400), 2)
    rows = [(k, float(y[k]), k >= 390, x[k].tobytes(), 0.0) for k in range(400)]
    state = spark.createDataFrame(rows, boosting._STATE).repartition(3)
    tree = boosting.grow(state, params, 0, 3, 2.0**20)
    inner = [(int(f), int(c), int(n)) for f, c, n in zip(tree.feature, tree.cut, tree.rows) if f >= 0]
    want = plain_tree(x[:390], y[:390], params)
    assert sorted(inner) == sorted(want)
    leaf = boosting.route(tree.feature, tree.cut, tree.left, tree.right, x[:390])
    assert len(set(leaf)) == len(want) + 1 <= params.max_leaves
    for k in set(leaf):
        mine = y[:390][leaf == k]
        assert len(mine) >= params.min_rows and tree.rows[k] == len(mine)
        assert tree.value[k] == pytest.approx(params.step * mine.sum() / (len(mine) + params.smoothing), abs=1e-6)


@pytest.mark.parametrize("params", [Params(max_leaves=40, min_rows=20), Params(max_leaves=64, max_depth=6, smoothing=1.0, row_share=0.8, feature_share=0.75)])
def test_a_tree_is_the_same_whichever_of_its_nodes_are_grown_in_one_task(spark, monkeypatch, params):
    r = np.random.default_rng(5)
    x = r.integers(0, 40, (3000, 4)).astype(np.uint8)
    rows = [(k, float(v), k % 9 == 0, x[k].tobytes(), 0.0) for k, v in enumerate(x[:, 0] % 7 + r.normal(size=3000))]
    state = spark.createDataFrame(rows, boosting._STATE).repartition(3).persist()
    counted, count = [], boosting._count_task
    monkeypatch.setattr(boosting, "_count_task", lambda *a: counted.append(len(a[1])) or count(*a))
    trees, levelled = [], []
    for near in (0, 400, 3000):
        monkeypatch.setattr(boosting, "NEAR", near)
        counted.clear()
        trees.append(boosting.grow(state, params, 0, 4, 2.0**20, 3000))
        levelled.append(sum(counted))
    state.unpersist()
    assert levelled[0] > levelled[1] > levelled[2] == 0
    assert (trees[0].feature < 0).sum() > 20
    assert all((a == b).all() for t in trees[1:] for a, b in zip(vars(trees[0]).values(), vars(t).values()))


def test_a_round_that_samples_no_row_adds_a_leaf_of_zero(spark):
    state = spark.createDataFrame([(k, 1.0, False, b"ab", 0.0) for k in range(5)], boosting._STATE)
    tree = boosting.grow(state, Params(row_share=0.0), 0, 2, 1.0, 5)
    assert (tree.feature.tolist(), tree.value.tolist(), tree.rows.tolist()) == ([-1], [0.0], [0])


def test_integer_gradients_leave_room():
    for most, n in ((1e-9, 10), (200.0, 10**10), (1e12, 3), (1.0, 1)):
        scale = boosting.scale_for(most, n)
        assert most * scale * n < 2**62 and most * scale <= 2**36
    assert boosting.scale_for(0.0, 5) == 1.0


# --- training --------------------------------------------------------------------------------------------------------

SMALL = dict(rounds=4, max_leaves=12, min_rows=5)


def same_trees(a, b):
    return len(a.trees) == len(b.trees) and all(all((x == y).all() for x, y in zip(vars(s).values(), vars(t).values())) for s, t in zip(a.trees, b.trees))


def test_resumed_training_gives_the_trees_of_one_run(spark, split, tmp_path, monkeypatch):
    monkeypatch.setattr(boosting, "CUT", 3)
    whole = boosting.train(split, "leafwise", **SMALL)
    assert whole.errors[-1] < mean_error(split, "valid")
    # as if the run had ended after two rounds; the rows come in another layout
    dataclasses.replace(whole, trees=whole.trees[:2], errors=whole.errors[:2]).save(spark, str(tmp_path / "m"))
    again = boosting.train(split.repartition(3), "leafwise", resume=boosting.Booster.load(spark, str(tmp_path / "m")), **SMALL)
    assert same_trees(again, whole) and again.errors == pytest.approx(whole.errors)


def test_a_round_costs_the_same_however_many_came_before(split, monkeypatch):
    grown, added = [], []
    grow, add = boosting.grow, boosting._add_task
    monkeypatch.setattr(boosting, "grow", lambda *a: grown.append(a[2]) or grow(*a))
    monkeypatch.setattr(boosting, "_add_task", lambda trees, *a: added.append(len(trees)) or add(trees, *a))
    boosting.train(split, "leafwise", **{**SMALL, "max_leaves": 3})
    assert grown == [0, 1, 2, 3] and added == [1, 1, 1, 1]


def test_patience_ends_training_and_the_best_round_is_kept(split):
    noise = split.withColumn(K.LABEL, F.pmod(F.xxhash64(*K.KEYS, F.lit("noise")), F.lit(100)).cast("double"))
    kept = boosting.train(noise, "leafwise", rounds=60, step=0.9, max_leaves=6, min_rows=3, patience=1)
    assert len(kept.trees) == kept.best + 1 < 60 and kept.errors[kept.best - 1] == min(kept.errors)
    assert kept.nodes(split.sparkSession).agg(F.max("tree")).first()[0] == kept.best - 1


def test_a_leaf_wise_tree_is_not_worse_than_one_of_depth_eight(split):
    # one tree each, at full weight: the other library weighs its first tree fully and doubles later gradients
    ours = boosting.train(split, "leafwise", rounds=1, step=1.0, min_rows=5, row_share=1.0, feature_share=1.0)
    theirs = model.train(split, maxIter=1, maxDepth=8, subsamplingRate=1.0, minInstancesPerNode=5, early_stop=False)
    assert (ours.trees[0].feature < 0).sum() <= 255
    valid = split.where(F.col("split") == "valid")
    error = lambda m: model.metrics(model.predict(m, valid)).first().root_mean_squared_error
    assert error(ours) <= error(theirs)


def test_stored_models_sweeps_and_odd_rows(spark, split, tmp_path):
    fitted = boosting.train(split, "histogram", rounds=2, max_depth=3)
    fitted.save(spark, str(tmp_path / "m"))
    again = boosting.Booster.load(spark, str(tmp_path / "m"))
    test = split.where(F.col("split") == "test")
    scores = lambda m, df: sorted((r.date, r.store_nbr, r.item_nbr, r.predicted_unit_sales) for r in model.predict(m, df).collect())
    assert scores(again, test) == scores(fitted, test)
    assert model.predict(fitted, test).columns == [*test.columns, "predicted_unit_sales"]
    odd = split.limit(5).withColumns({"family": F.lit("NEW"), "class": F.lit(None).cast("string"), "rm7_log_sales": F.lit(None).cast("double")})
    assert model.predict(fitted, odd).where(F.col("predicted_unit_sales").isNotNull()).count() == 5
    frame = policy.scoring_frame(split)
    scored = policy.score_candidates(policy.candidates(frame), fitted)
    swept = policy.sweep(frame, fitted)
    assert swept.count() == frame.count()
    worse = scored.join(swept, K.KEYS).where(F.col("cand_effective_price") * F.col("pred_units") > F.col("policy_revenue") + 1e-9)
    assert worse.count() == 0
    with pytest.raises(ValueError, match="no training rows"):
        boosting.train(split.where("split = 'valid'"), "leafwise", rounds=1)
    alone = boosting.train(split.where("split = 'train'"), "leafwise", rounds=2, max_leaves=4)
    assert alone.errors == [] and alone.best == 2


def test_importance_counts_the_node_table(spark, split):
    fitted = boosting.train(split, "leafwise", **{**SMALL, "rounds": 2})
    fitted.nodes(spark).createOrReplaceTempView("boosted_nodes")
    want = spark.sql("SELECT feature, count(*) AS weight, sum(n_rows) AS cover, sum(gain) AS gain FROM boosted_nodes WHERE left_child IS NOT NULL GROUP BY feature")
    table = {r.feature: r for r in model.feature_importance(fitted, split).collect()}
    assert set(table) == set(boosting.INPUTS)
    assert {r.feature: (r.weight, r.cover) for r in want.collect()} == {f: (r.weight, r.cover) for f, r in table.items() if r.weight}
    assert sum(r.importance for r in table.values()) == pytest.approx(1.0)
    assert max(table.values(), key=lambda r: r.gain).feature in ("dow", "month", "discount_pct", "time_to_expiry")


def test_training_keeps_model_metrics_and_importance(spark, sample, tmp_path):
    w, root = Warehouse.from_sample(spark, sample), str(tmp_path)
    fitted = w.train_model(root, "leafwise", rounds=1, max_leaves=4)
    again = boosting.Booster.load(spark, f"{root}/leafwise/model")
    assert same_trees(again, fitted)
    metrics = {r.split: r for r in spark.read.parquet(f"{root}/leafwise/metrics").collect()}
    assert set(metrics) == {"valid", "test"} and metrics["valid"].mean_squared_error == pytest.approx(fitted.errors[0])
    assert spark.read.parquet(f"{root}/leafwise/feature_importance").agg(F.sum("weight")).first()[0] == (fitted.trees[0].feature >= 0).sum()


def test_growing_stores_nothing_and_encodings_are_fitted_on_stored_rows(split, monkeypatch):
    named, read, grown = [], [], []
    scratch, fit, grow = boosting._scratch, encoding.fit, boosting.grow
    monkeypatch.setattr(boosting, "_scratch", lambda spark, name: named.append(name) or scratch(spark, name))
    monkeypatch.setattr(encoding, "fit", lambda train, *a: read.append(train.inputFiles()) or fit(train, *a))

    def spied(*a):
        before = len(named)
        tree = grow(*a)
        grown.append(named[before:])
        return tree

    monkeypatch.setattr(boosting, "grow", spied)
    boosting.train(split, "leafwise", **{**SMALL, "rounds": 1})
    assert grown == [[]]
    assert len(read) == len(K.CATEGORICAL_FEATURES) and all("boosting-inputs" in path for paths in read for path in paths)


# --- encodings -------------------------------------------------------------------------------------------------------


def test_encodings_are_out_of_fold(spark):
    r = np.random.default_rng(0)
    rows = [(k, None if k % 11 == 0 else f"c{r.integers(6)}", float(r.integers(0, 50)), int(r.integers(0, 5))) for k in range(120)]
    df = spark.createDataFrame(rows, "id long, c string, y double, fold int")
    fitted = encoding.fit(df, "c", "y", "fold", prior=4.0)
    new = spark.createDataFrame([(500, "c0", -1), (501, "never", -1), (502, None, -1)], "id long, c string, fold int")
    got = {x.id: x.e for x in fitted.encode(df.drop("y").unionByName(new), "c", "e", F.col("fold")).collect()}

    def mean(c, fold):
        others = [y for _, _, y, f in rows if f != fold]
        same = [y for _, v, y, f in rows if v == c and f != fold]
        return (sum(same) + 4.0 * np.mean(others)) / (len(same) + 4.0)

    assert len(got) == 123
    for k, c, _, fold in rows:
        assert got[k] == pytest.approx(mean(c, fold))
    assert [got[k] for k in (500, 501, 502)] == pytest.approx([mean("c0", -1), mean("never", -1), mean(None, -1)])
    # a row's own label changes nothing for it
    moved = df.withColumn("y", F.when(F.col("id") == 7, 1e6).otherwise(F.col("y")))
    other = {x.id: x.e for x in encoding.fit(moved, "c", "y", "fold", prior=4.0).encode(df, "c", "e", F.col("fold")).collect()}
    assert other[7] == pytest.approx(got[7]) and other != {k: v for k, v in got.items() if k < 500}


def test_wide_categories_stay_off_the_driver(spark):
    df = spark.range(300_000).select("id", F.col("id").cast("string").alias("c"), F.lit(1.0).alias("y"), encoding.fold_of("id").alias("fold"))
    fitted = encoding.fit(df, "c", "y", "fold")
    assert len(fitted.means) == 6
    row = fitted.encode(df, "c", "e", F.col("fold")).agg(F.count("e").alias("n"), F.min("e").alias("low"), F.max("e").alias("high")).first()
    assert tuple(row) == (300_000, 1.0, 1.0)
