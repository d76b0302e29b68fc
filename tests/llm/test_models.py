"""Toxicity, hard negatives and whitening against brute force, held-out labels, and their edge cases."""

import math
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[1]))

from ripecast.llm import hard_negatives, toxicity, whitening  # noqa: E402
from ripecast.llm.common import read, store  # noqa: E402
from ripecast.llm.queries import QUERIES  # noqa: E402

ORDER, WINDOW, D = toxicity.ORDER, toxicity.WINDOW, toxicity.DISCOUNT
R = random.Random(5)
TEXTS = [
    None,
    "",
    "Ab",
    "you  are\n an IDIOT\tand a clown",
    "é😀 ünïcode here, é😀",
    " ".join(R.choice(["calm", "sea", "wind", "idiot", "stone", "river"]) for _ in range(300)),
    " ".join(R.choice(["calm", "sea", "wind", "stone", "river"]) for _ in range(300)),
]
TEXTS.append(TEXTS[5])
LABELS = [None, 0, 0, 1, 0, 1, 0, None]


# --- toxicity --------------------------------------------------------------------------------------------------------


def plain(text):
    out, gap = [], False
    for c in (text or "").lower():
        if c in " \t\n\x0b\x0c\r":
            gap = True
            continue
        out.append((" " if gap else "") + c)
        gap = False
    return ("".join(out) + (" " if gap else "")).encode()


def brute_grams(text):
    data = b"\n" * (ORDER - 1) + plain(text)
    return [data[k : k + ORDER] for k in range(len(data) - ORDER + 1)]


def brute_weights(texts, labels):
    """Kneser-Ney by the formulas, with dictionaries."""
    seen = {g for t in texts for g in brute_grams(t)}
    levels = {ORDER: seen}
    counts = {}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in levels[k + 1])
        levels[k] = set(counts[k])

    def shared(gram):
        n = counts[len(gram)]
        same = [c for g, c in n.items() if g[:-1] == gram[:-1]]
        low = shared(gram[1:]) if len(gram) > 1 else 1 / 256
        return (n[gram] - D) / sum(same) + len(same) * D / sum(same) * low

    own = {c: Counter(g for t, y in zip(texts, labels) if y == c for g in brute_grams(t)) for c in (0, 1)}
    context = {c: {} for c in own}
    for c, n in own.items():
        for g, k in n.items():
            total, kinds = context[c].get(g[:-1], (0, 0))
            context[c][g[:-1]] = (total + k, kinds + 1)

    def chance(c, gram, base):
        total, kinds = context[c].get(gram[:-1], (0, 0))
        return base if not total else max(own[c][gram] - D, 0) / total + kinds * D / total * base

    out = {}
    for g in seen:
        base = shared(g[1:])
        out[g] = math.log(chance(1, g, base)) - math.log(chance(0, g, base))
    return out


def brute_measure(text, weight):
    w = [weight.get(g, 0.0) for g in brute_grams(text)]
    if not w:
        return 0.0
    n = min(WINDOW, len(w))
    return max(sum(w[k : k + n]) / n for k in range(len(w) - n + 1))


def model(spark, texts=TEXTS, labels=LABELS):
    rows = spark.createDataFrame(list(zip(texts, labels)), "text string, label int").repartition(3)
    counts = store(toxicity.count(rows.withColumn("text", toxicity.normal("text"))), "t")
    return counts, store(toxicity.weights(counts), "t")


def packed(gram):
    return int.from_bytes(gram, "big")


def test_grams_are_counted_per_class(spark):
    counts, _ = model(spark)
    want = {g: [0, 0] for t in TEXTS for g in brute_grams(t)}
    for t, y in zip(TEXTS, LABELS):
        for g in brute_grams(t):
            if y is not None:
                want[g][1 - y] += 1
    assert {r.gram: [r.toxic, r.ordinary] for r in counts.collect()} == {packed(g): v for g, v in want.items()}


def test_weights_follow_the_formulas(spark):
    want = {packed(g): w for g, w in brute_weights(TEXTS, LABELS).items()}
    got = {r.gram: r.weight for r in model(spark)[1].collect()}
    assert set(got) == set(want)
    assert max(abs(got[g] - want[g]) for g in want) < 1e-5


def test_shared_model_is_a_distribution(spark):
    counts, _ = model(spark)
    shared = {r.gram: r.shared for r in toxicity.backoff(counts, ORDER, D).collect()}
    assert all(0 < p < 1 for p in shared.values())
    by_context = Counter()
    for g, p in shared.items():
        by_context[g >> 8] += p
    assert max(by_context.values()) <= 1 + 1e-9


@pytest.mark.parametrize("most", [toxicity.MOST_BROADCAST, 0])
def test_both_ways_measure_like_brute_force(spark, most, monkeypatch):
    monkeypatch.setattr(toxicity, "CHUNK", 1_000)
    _, table = model(spark)
    weight = brute_weights(TEXTS, LABELS)
    docs = spark.createDataFrame([(k, t, k * 2, -1.0) for k, t in enumerate(TEXTS)], "k int, text string, c1 int, measure double")
    rows = toxicity.measured(docs, table, most=most).collect()
    assert sorted((r.c0, r.c2) for r in rows) == [(k, k * 2) for k in range(len(TEXTS))]
    for r in rows:
        assert r[-1] == pytest.approx(brute_measure(TEXTS[r.c0], weight), abs=1e-5)


def test_a_text_in_runs_measures_like_the_whole(monkeypatch):
    r = random.Random(3)
    text = "".join(r.choice("abc ") for _ in range(5_000))
    table = np.unique(toxicity.grams(toxicity.framed(np.frombuffer(text.encode(), np.uint8), np.array([0, 5_000]), ORDER)[0], ORDER))
    values = np.array([r.uniform(-1, 1) for _ in table], np.float32)
    column = pa.array(["", text, None, "ab", text[:700]])
    whole = toxicity._measures(column, table, values, ORDER, WINDOW)
    blocks = toxicity.text_blocks
    for most in (100, 97, 2_400):
        monkeypatch.setattr(toxicity, "text_blocks", lambda c, o, overlap=0: blocks(c, o, overlap, most))
        assert np.allclose(toxicity._measures(column, table, values, ORDER, WINDOW), whole)
        runs = [codes for _, codes, _ in blocks(column, ORDER, 0, most)]
        assert sum(map(len, runs)) == 5_000 + 2 + 700


def test_toxicity_finds_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op11_toxicity"](spark, folder).join(read(spark, folder, "labels"), "doc_id").where("held_out").select("toxic", "score", "predicted").collect()
    toxic, clean = ([r for r in got if r.toxic == y] for y in (1, 0))
    # 18 % of the rows marked toxic at this size hold none of the words that mark the others.
    assert np.mean([[(a.score > b.score) + 0.5 * (a.score == b.score) for b in clean] for a in toxic]) > 0.88
    assert np.mean([r.predicted for r in clean]) < 0.01
    assert np.mean([r.predicted for r in toxic]) > 0.45


def test_toxicity_edges(spark):
    insults = ["you total idiot and clown", "what an idiot you are, clown", "idiot! such a pathetic clown"]
    rows = [(k, "  ".join([R.choice(insults), *R.choices(["calm sea", "old stone", "warm wind", "wide river"], k=9)]) if k % 3 == 0 else " ".join(R.choices(["calm sea", "old stone", "warm wind", "wide river"], k=10)), k % 3 == 0) for k in range(120)]
    docs = spark.createDataFrame([(k, t, "x") for k, t, _ in rows] + [(None, "calm idiot", "x"), (500, None, "y"), (501, "", None), (0, rows[0][1], "x")], "doc_id int, text string, score string")
    labels = [(k, int(y)) for k, _, y in rows] + [(0, 1), (1, 1), (2, None), (None, 1), (4, 7)]
    found = toxicity.score(docs, spark.createDataFrame(labels, "doc_id int, toxic int"))
    assert found.columns == ["doc_id", "score", "score_1"]
    got = found.collect()
    assert len(got) == 124 and all(0 <= r.score_1 <= 1 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add(r.score_1)
    assert len(by[0]) == 1 and by[500] == by[501]
    assert min(min(by[k]) for k, _, y in rows if y) > max(max(by[k]) for k, _, y in rows if not y)
    empty = toxicity.score(docs.limit(0), spark.createDataFrame([], "doc_id int, toxic int"))
    assert empty.count() == 0
    one_sided = toxicity.score(docs, spark.createDataFrame([(k, 0) for k in range(50)], "doc_id int, toxic int"))
    assert len({r.score_1 for r in one_sided.collect()}) == 1
    known = toxicity.class_of(spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1), (3, None), (None, 1)], "doc_id int, toxic int"), "doc_id", "toxic")
    assert [(r.k, r.y) for r in known.collect()] == [(2, 1)]


# --- hard negatives --------------------------------------------------------------------------------------------------


def brute_negatives(rows, positives=5, negatives=5):
    """rows: (key, label, vector, anchor), by Python's integers."""
    good = [(k, y, [math.floor(256 * c) for c in v], a) for k, y, v, a in rows if y is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    order = lambda e: (-e[1], e[0] is None, 0 if e[0] is None else e[0])
    for i, (key, label, vector, anchor) in enumerate(good):
        if not anchor:
            continue
        others = [(k, sum(x * y for x, y in zip(v, vector)), y == label) for j, (k, y, v, _) in enumerate(good) if j != i and len(v) == len(vector)]
        for p, p_score, _ in sorted((o for o in others if o[2]), key=order)[:positives]:
            band = sorted((o for o in others if not o[2] and 80 * p_score <= 100 * o[1] <= 100 * p_score), key=order)[:negatives]
            out += [(key, p, r + 1, n, p_score, s) for r, (n, s, _) in enumerate(band)]
    return out


def mined(spark, rows, kind="bigint", **more):
    df = spark.createDataFrame(rows, f"vec_id {kind}, label bigint, embedding array<double>, pick boolean")
    return [tuple(r) for r in hard_negatives.mine(df, "vec_id", "label", "embedding", "pick", **more).collect()]


def clusters(n, dims, seed, groups=6, spread=0.25):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(groups, dims))
    return [(k, int(r.integers(0, 3)), [float(x) for x in centres[r.integers(groups)] + spread * r.normal(size=dims)], k % 9 == 0) for k in range(n)]


def as_text(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("dims", [1, 3, 64, 70])
def test_negatives_equal_brute_force(spark, dims, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 13)
    monkeypatch.setattr(hard_negatives, "BLOCK", 40)
    rows = clusters(200, dims, dims)
    assert as_text(mined(spark, rows)) == as_text(brute_negatives(rows))


def test_negative_edges(spark):
    big, ties = [1e9, -3e12, 5.5e7], [0.5, 0.25, 0.0]
    rows = [(k, k % 2, ties, k % 4 == 0) for k in range(30)]
    rows += [(7, 0, ties, True), (7, 0, ties, True), (None, 1, ties, True), (100, None, ties, True), (101, 0, None, True)]
    rows += [(102, 0, [0.1, None, 0.2], True), (103, 0, [0.1, float("nan"), 0.2], True), (104, 0, [float("inf"), 0.0, 0.0], True)]
    rows += [(105, 0, [], True), (106, 0, [], False), (107, 1, [], False), (108, 0, [1.0, 2.0], True), (109, 0, big, True), (110, 0, big, False)]
    rows += [(111, 1, [x * 0.9 for x in big], False), (112, 0, [-0.5, -0.25, 0.0], True), (113, 1, [0.0, 0.0, 0.0], None)]
    assert as_text(mined(spark, rows)) == as_text([x if max(abs(x[4]), abs(x[5])) < 1 << 63 else (*x[:4], None, None) for x in brute_negatives(rows)])
    named = [(None if k is None else f"n{k:04d}", y, v, a) for k, y, v, a in rows[:33]]
    assert as_text(mined(spark, named, "string")) == as_text(brute_negatives(named))
    assert mined(spark, []) == []


def test_intervals_hold_the_scores_and_prune():
    r = np.random.default_rng(1)
    centres = r.normal(size=(40, 64))
    vectors = np.floor(256 * (centres[r.integers(0, 40, 2_000)] + 0.1 * r.normal(size=(2_000, 64)))).astype(np.int64)
    codes, norm, align = hard_negatives.encode(vectors)
    ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
    for k in range(20):
        low, high = hard_negatives.Query(vectors[k]).interval(codes, ones, norm, align)
        exact = hard_negatives.scores(vectors, vectors[k])
        assert (low <= exact).all() and (exact <= high).all()
        assert (high >= 0.8 * exact[k]).mean() < 0.5


# --- whitening -------------------------------------------------------------------------------------------------------


def brute_white(vectors, most=8):
    """Components of the exact integer covariance, by an eigenvalue solver."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    total = [sum(v[d] for v in x) for d in range(dims)]
    apart = [[n * v[d] - total[d] for d in range(dims)] for v in x]
    a = np.array(apart, object)
    cov = (a.T @ a).astype(float) / float(n) ** 3
    values, vectors_ = np.linalg.eigh(cov)
    order = np.argsort(-values)[:most]
    white = np.array(apart, float) / n @ vectors_[:, order] / np.sqrt(values[order])
    return n, [int(sum(c * c for c in v)) for v in apart], white, values[order] / np.trace(cov)


def vectors_of(n, dims, seed, scales):
    r = np.random.default_rng(seed)
    mixed = r.normal(size=(n, dims)) * scales @ np.linalg.qr(r.normal(size=(dims, dims)))[0]
    return [[float(np.float32(c)) for c in v] for v in mixed]


@pytest.mark.parametrize("dims, scales", [(3, 1.0), (12, np.linspace(5, 0.05, 12)), (20, np.logspace(4, -1, 20))])
def test_whitening_equals_an_eigenvalue_solver(spark, dims, scales):
    rows = vectors_of(150, dims, dims, scales * np.linspace(1, 1.5, dims))
    df = spark.createDataFrame(list(enumerate(rows)), "id int, v array<float>").repartition(5)
    got = whitening.whiten(df, "id", "v").collect()
    n, deviation, white, explained = brute_white(rows)
    assert len(got) == n * min(8, dims)
    k = {c: [r for r in got if r.component == c] for c in range(1, min(8, dims) + 1)}
    for c, found in k.items():
        found.sort(key=lambda r: r.key)
        w = np.array([r.whitened for r in found])
        assert min(np.abs(w - white[:, c - 1]).max(), np.abs(w + white[:, c - 1]).max()) < 1e-6
        assert {r.n for r in found} == {n} and [r.deviation for r in found] == [d if d < 1 << 63 else None for d in deviation]
        assert found[0].explained == pytest.approx(explained[c - 1], rel=1e-9)
        assert found[0].identity_error < 1e-9


def test_whitening_edges(spark):
    r = np.random.default_rng(0)
    plane = [[float(a), float(b), float(a + b), 3.0] for a, b in r.integers(-50, 50, (40, 2))]
    rows = [(k, v) for k, v in enumerate(plane)] + [(100, None), (101, [1.0, None, 2.0, 3.0]), (102, [1.0, float("nan"), 2.0, 3.0])]
    rows += [(103, [float("inf"), 0.0, 0.0, 0.0]), (104, []), (None, plane[0]), (0, plane[0]), (200, [1.0, 2.0]), (201, [1.0, 5.0]), (300, [7.0])]
    got = whitening.whiten(spark.createDataFrame([(k, v, "x") for k, v in rows], "id int, v array<double>, n string"), "id", "v").collect()
    four = [r for r in got if r.n == 42]
    assert {r.component for r in four} == {1, 2} and len(four) == 84
    assert sorted((r.key, round(abs(r.whitened), 9)) for r in got if r.n == 2) == [(200, 1.0), (201, 1.0)]
    assert {r.key for r in got} & {100, 101, 102, 103, 104, 300} == set() and None in {r.key for r in got}
    assert max(r.identity_error for r in got) < 1e-9
    same = spark.createDataFrame([(1, [1.0, 2.0])] * 5, "id int, v array<double>")
    assert whitening.whiten(same, "id", "v").count() == 0 and whitening.whiten(same.limit(0), "id", "v").count() == 0
    huge = spark.createDataFrame([(k, [float(k) * 1e30, float(k)]) for k in range(4)], "id int, v array<double>")
    assert {r.deviation for r in whitening.whiten(huge, "id", "v").collect()} == {None}


def test_whitening_query(spark, sample):
    rows = [r for r in read(spark, sample, "embeddings").collect() if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    n, deviation, white, _ = brute_white([r.embedding for r in rows])
    got = {(r.vec_id, r.component): r for r in QUERIES["op13_whitening"](spark, sample).collect()}
    assert len(got) == 8 * n
    for k, row in enumerate(rows):
        for c in range(1, 9):
            found = got[(row.vec_id, c)]
            assert found.deviation == deviation[k] and abs(abs(found.whitened) - abs(white[k, c - 1])) < 1e-6
