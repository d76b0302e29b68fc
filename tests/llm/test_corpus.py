"""The corpus operators against SQL, brute force, exact round trips or held-out accuracy, and their edge cases."""

import base64
import hashlib
import random
import struct
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[1]))

import helpers as h  # noqa: E402
from compare import compare  # noqa: E402

import corpus_pipeline  # noqa: E402
from ripecast.llm import bpe, compress_quality, jaccard_join, mixing, nn_descent, pii, quality_rules, sharding, suffix_dedup, warc  # noqa: E402
from ripecast.llm.common import scratch_path  # noqa: E402
from ripecast.llm.queries import QUERIES, SQL, TOKENIZER  # noqa: E402

DOCS = "doc_id bigint, text string, source string"
RNG = random.Random(7)
WORDS = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 9))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def edited(text, every, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) if k % every == every // 2 else w for k, w in enumerate(text.split(" ")))


LONG = prose(30_000, 99)
EDGE = [
    (1, "", "a"),
    (2, None, "a"),
    (None, prose(40, 1), None),
    (3, LONG, "b"),
    (3, LONG, "b"),
    (4, " \n\t\x0b ", "b"),
    (5, "one two\nthree four\x1cfive é😀\n\none two\n", ""),
    (6, prose(12, 2) + "\n" + prose(12, 2) + "\n" + prose(30, 3), "c"),
    (7, prose(12, 2), "c"),
]


def frame(spark, rows=EDGE, schema=DOCS):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sample, name):
    assert compare(QUERIES[name](spark, sample), h.duck(sample), SQL[name]) is None


# --- quality rules ---------------------------------------------------------------------------------------------------


def test_measures_of_edge_texts(spark):
    got = sorted(tuple(r[m] for m in quality_rules.MEASURES) for r in quality_rules.ledger(frame(spark)).collect())
    assert got == sorted(h.measures(t) for _, t, _ in EDGE)


def test_policies_and_ablation(spark):
    entries = quality_rules.ledger(frame(spark))
    strict = quality_rules.apply_policy(entries, quality_rules.STRICT).collect()
    assert [r.kept for r in strict] == [r.fail_bits == 0 for r in strict]
    rows = {r.rule: r for r in quality_rules.ablation(entries, quality_rules.STRICT).collect()}
    for rule, bit in quality_rules.BITS.items():
        assert rows[rule].n_fail == sum(bool(r.fail_bits & bit) for r in strict)
        assert rows[rule].n_fail_only == sum(r.fail_bits == bit for r in strict)
        assert rows[rule].n_kept_without == rows[rule].n_kept + rows[rule].n_fail_only
    base = quality_rules.apply_policy(entries, quality_rules.BASE).where("kept").count()
    assert base >= sum(r.kept for r in strict)


def test_filter_keeps_clashing_columns(spark):
    docs = frame(spark).withColumn("n_words", F.lit("x")).withColumn("fail_bits", F.lit(1)).withColumn("in0_", F.lit(2))
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    want = sorted(str(r) for r in EDGE if not (h.measures(r[1])[0] < 10 or 100 * h.measures(r[1])[4] > 20 * h.measures(r[1])[0]))
    assert sorted(str((r.doc_id, r.text, r.source)) for r in kept.collect()) == want
    assert quality_rules.filter_documents(docs.limit(0)).count() == 0


# --- mixing ----------------------------------------------------------------------------------------------------------


def test_mix_edges(spark):
    docs = frame(spark).withColumn("size", F.lit("mine"))
    names = mixing.mixed_names(docs.columns)
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    assert len(rows) == len(EDGE) and names["size"] == "size_1"
    assert sorted(r["size_1"] for r in rows) == sorted(h.measures(t)[0] for _, t, _ in EDGE)
    sources = {}
    for r in rows:
        sources.setdefault(r.source, []).append(r)
    total = sum(r["size_1"] for r in rows)
    assert sum(v[0].target for v in sources.values()) == pytest.approx(1.5 * total)
    for own in sources.values():
        assert own[0].target <= 2 * own[0].source_size + 1e-6
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size_1"] for r in own)
    taken = mixing.take(mixed, docs.columns, names["epochs"])
    assert taken.columns == docs.columns and taken.count() == sum(r.epochs for r in rows)
    assert mixing.mix(docs).exceptAll(mixed).count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0


def test_targets_by_repeated_sharing(spark):
    sizes = [("a", 10), ("b", 500), ("c", 40), ("d", 7), ("e", 0), (None, 300)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(sizes, "source string, source_size bigint")).collect()}
    weight = {s: mixing.WEIGHTS[k % 3] for k, (s, _) in enumerate(sizes)}
    size, fixed = dict(sizes), {}
    while True:
        left = 1.5 * sum(size.values()) - sum(fixed.values())
        open_ = {s: w for s, w in weight.items() if s not in fixed}
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = {s: 2.0 * size[s] for s, t in share.items() if t > 2 * size[s]}
        if not over:
            break
        fixed.update(over)
    assert got == pytest.approx({**fixed, **share})


# --- sharding --------------------------------------------------------------------------------------------------------


def test_table_is_even_and_stable():
    table = sharding.fill(["a", "b", "c", "d"], 1009)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1
    fewer = sharding.fill(["a", "b", "c"], 1009)
    assert sum(x != y for x, y in zip(table, fewer) if x != 3) < 0.25 * 1009
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill(bad, 1009)
    with pytest.raises(ValueError):
        sharding.fill(["a"], 1000)


def test_placement_by_brute_force(spark):
    docs = frame(spark).withColumn("slot", F.lit("x"))
    shards = ["p", "q", "r"]
    table = sharding.fill(shards, 101)
    placed = sharding.place(docs, "doc_id", shards, 101)
    assert placed.columns == [*docs.columns, "slot_1", "shard"]
    for r in placed.collect():
        slot = int(hashlib.md5(str("" if r.doc_id is None else r.doc_id).encode()).hexdigest()[:15], 16) % 101
        assert (r.slot_1, r.shard) == (slot, shards[table[slot]])
    assert sharding.place(docs.limit(0), "doc_id", shards, 101).count() == 0


# --- personal data ---------------------------------------------------------------------------------------------------

TRICKY = [
    "a@b.co_c@d.ef x@y x@y. .a-b@c-d.e.f,g%h+i@j.k",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.0003.255 1.2.3 9.9.9.9999",
    "4785380592391139 4785-3805 9239 1139 4785  3805 1234567890123 0000000000000 1 2",
    "+1 (202) 555-0147 +12345678 ++123456789 +1-2 +49 30 1234 5678 9012 345 +1..........2",
    "é😀a@b.cd 😀1.2.3.4",
    "",
    None,
    "7" * 30_000,
    "x" * 60_000 + "@",
    "a@b" + ".c" * 20_000,
    "1" + " 2" * 20_000,
    "@" * 500 + "+" * 500,
]


def test_base_spans_by_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id int, text string")
    got = {r.key: [(s.kind, s.start, s.end) for s in r.base] for r in pii.find(docs).collect()}
    assert got == {k: h.base_spans(t) for k, t in enumerate(TRICKY)}


def test_terms_that_disclose(spark):
    rows = [(k, f"{prose(30, k)} write to zelda.fitz@example.org about zeldafitz {prose(20, 100 + k)}", "x") for k in range(5)]
    rows += [(100 + k, prose(60, 200 + k), "x") for k in range(200)]
    rows += [(500, rows[0][1], "y"), (500, rows[0][1], "y"), (None, None, None)]
    docs = frame(spark, rows).withColumn("hit_key_", F.lit(1)).withColumn("base_", F.lit(1))
    found = {r.key: r.spans for r in pii.find(docs).collect()}
    for k in range(5):
        assert {s.value for s in found[k] if s.kind == "term"} >= {"zeldafitz"}
        assert all(s.kind in pii.KINDS for s in found[k])
    assert all(not found[100 + k] for k in range(200))
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)
    for r in clean.collect():
        assert r.text is None or ("zelda" not in r.text)
    assert clean.where("doc_id = 500").count() == 2
    assert pii.find(docs.limit(0)).count() == 0 and pii.sanitise(docs.limit(0)).count() == 0


# --- byte-level BPE --------------------------------------------------------------------------------------------------

PIECES = [*[t for _, t, _ in EDGE], "a" * 5_000, "      x\n\n  y", "don't 'LL we'll", "1234567890" * 30, "<|endoftext|>", "日本語のテキスト", "👩‍👩‍👧 ñ́", "\x00\x7f​", "ab" * 400]


def tiktoken_ids():
    import tiktoken

    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(TOKENIZER), special_tokens={})
    return lambda text: coder.encode_ordinary(text or "")


def test_ids_equal_the_library(spark):
    encode = tiktoken_ids()
    docs = spark.createDataFrame(list(enumerate(PIECES)), "doc_id int, text string").withColumn("ids", F.lit("mine"))
    coded = bpe.encode(docs, TOKENIZER, public_tokenizers.PATTERN)
    back = bpe.decode(coded, TOKENIZER, "ids_1")
    assert back.columns == ["doc_id", "text", "ids", "ids_1", "decoded"]
    rows = back.collect()
    assert len(rows) == len(PIECES)
    for r in rows:
        ids = encode(r.text)
        assert bytes(r.ids_1) == struct.pack(f"<{len(ids)}I", *ids)
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.decode(bpe.encode(docs.limit(0), TOKENIZER, public_tokenizers.PATTERN), TOKENIZER, "ids_1").count() == 0


def test_query_equals_the_library(spark, sample):
    encode = tiktoken_ids()
    got = {r.doc_id: r for r in QUERIES["op9_bpe"](spark, sample).collect()}
    for r in spark.read.parquet(f"{sample}/documents.parquet").collect():
        ids = encode(r.text)
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_native_fold_gives_the_same_ids(spark):
    merger = bpe.Merger(bpe.load_ranks(TOKENIZER))
    words = sorted({w for _, t, _ in EDGE[-3:] for w in t.split()} | {" the", "x", "ñandú", "a" * 40})
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", bpe.fold_native(F.col("w"), TOKENIZER).alias("ids"))
    assert {r.w: list(r.ids) for r in rows.collect()} == {w: merger.ids(w.encode()) for w in words}


# --- quality classifier ----------------------------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op1_quality_classifier"](spark, folder)
    rows = got.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    good = np.array([r.score for r in rows if r.quality == 1])
    bad = np.array([r.score for r in rows if r.quality == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.85
    assert (good >= 0.3).mean() > 0.95


def test_scores_of_edge_texts(spark):
    good = [(prose(80, k), 1, k % 4 == 0) for k in range(60)]
    bad = [(prose(80, k).upper().replace(" ", "## "), 0, k % 4 == 0) for k in range(60)]
    model = compress_quality.fit([(t.encode(), y, c) for t, y, c in good + bad])
    docs = frame(spark, [*EDGE, (8, bad[1][0], "x")]).withColumn("score", F.lit("mine"))
    rows = compress_quality.score(docs, model).collect()
    assert len(rows) == len(EDGE) + 1 and all(0 <= r.score_1 <= 1 for r in rows)
    by = {r.doc_id: r.score_1 for r in rows}
    assert by[1] == by[2] and by[8] < 0.5 < by[3]
    assert compress_quality.score(docs.limit(0), model).count() == 0
    one = compress_quality.fit([(t.encode(), y, c) for t, y, c in good])
    assert one.score(np.array([0.0]))[0] > 0.9
    assert compress_quality.learn(docs.limit(0), spark.createDataFrame([], "doc_id bigint, quality int")).slope == 0


def test_sample_outlives_a_long_text(spark):
    texts = [(k, prose(10, k)) for k in range(20)]
    first = min(range(0, 20, 2), key=lambda k: hashlib.md5(str(k).encode()).hexdigest())
    docs = spark.createDataFrame([(k, t * 5_000 if k == first else t) for k, t in texts], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in texts], "doc_id bigint, quality int")
    got = {r.key: r.text for r in compress_quality.labelled_sample(docs, labels, "doc_id", "text", "quality", longest=64 << 10).collect()}
    assert got == {k: t for k, t in texts if k != first}
    again = spark.createDataFrame([(k, k % 2) for k, _ in texts] * 2 + [(3, 0), (4, None), (None, 1)], "doc_id bigint, quality int")
    rows = compress_quality.labelled_sample(docs, again, "doc_id", "text", "quality", longest=64 << 10).collect()
    assert sorted((r.key, r.label) for r in rows) == [(k, k % 2) for k, _ in texts if k not in (first, 3)]


def test_scores_follow_the_compressed_sizes(spark):
    good, bad = ([(prose(80, k) if y else prose(80, k).upper().replace(" ", "## ")).encode() for k in range(60)] for y in (1, 0))
    model = compress_quality.fit([(t, y, k % 4 == 0) for y, texts in ((1, good), (0, bad)) for k, t in enumerate(texts)])

    def size(dictionary, data):
        made = zstandard.ZstdCompressionDict(dictionary)
        packer = zstandard.ZstdCompressor(level=compress_quality.LEVEL, dict_data=made, write_content_size=False, write_dict_id=False)
        return sum(len(packer.compress(data[k : k + compress_quality.PIECE])) for k in range(0, len(data), compress_quality.PIECE))

    for r in compress_quality.score(frame(spark), model).collect():
        data = (r.text or "").encode()
        x = (size(model.bad, data) - size(model.good, data)) / len(data) if data else 0.0
        assert r.score == pytest.approx(1 / (1 + np.exp(-(model.slope * x + model.shift))), abs=1e-9)
    assert compress_quality.score(frame(spark), model, keep_text=False).columns == ["doc_id", "source", "score"]


# --- Jaccard join ----------------------------------------------------------------------------------------------------


def planted():
    rows = list(EDGE) + [(8, "two words", "x"), (9, "two  words", "x"), (10, "two others", "x")]
    big = prose(120, 1000)
    rows += [(100 + k, edited(big, 60, k), "x") for k in range(jaccard_join.BUCKET + 30)]
    for k in range(30):
        text = prose(100, 2000 + k)
        rows += [(300 + 3 * k, text, "x"), (301 + 3 * k, edited(text, 50, k), "x"), (302 + 3 * k, edited(text, 12, k), "x")]
    rows += [(300, prose(100, 2000), "copy"), (None, prose(100, 2001), "copy")]
    return rows


def test_join_by_brute_force(spark):
    rows = planted()
    links = h.similar([t for _, t, _ in rows])
    root = h.groups(len(rows), links)
    count = [0] * len(rows)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    found = jaccard_join.join(frame(spark, rows)).collect()
    got = sorted((str(r.key), r.n_links, str(r.group_key)) for r in found for _ in range(r.rows))
    low = {}
    for k, r in enumerate(root):
        low.setdefault(r, []).append(rows[k][0])
    smallest = {r: min((x for x in own if x is not None), default=None) for r, own in low.items()}
    assert got == sorted((str(row[0]), count[k], str(smallest[root[k]])) for k, row in enumerate(rows))


def test_one_of_each_group_stays(spark):
    rows = planted()
    docs = frame(spark, rows).withColumn("s1", F.lit("x")).withColumn("head", F.lit(1))
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert not h.similar(texts)
    assert len(texts) == len(set(h.groups(len(rows), h.similar([t for _, t, _ in rows]))))
    assert jaccard_join.keep_one(docs.limit(0)).count() == 0


def test_large_buckets_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", 16)
    test_join_by_brute_force(spark)


# --- suffixes --------------------------------------------------------------------------------------------------------


def test_cover_has_every_difference():
    assert {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER} == set(range(suffix_dedup.PERIOD))


def test_repeats_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CELL", 3_000)
    monkeypatch.setattr(suffix_dedup, "MOST_CELL", 3_000)
    shared, r = prose(60, 5), random.Random(3)
    rows = [(k, f"{prose(r.randint(0, 30), k)} {shared[r.randint(0, 60) : r.randint(150, 300)]} {prose(r.randint(0, 60), 50 + k)}", "x") for k in range(40)]
    rows += [(50, "ab" * 300, "x"), (51, "z" * 99, "x"), (52, "z" * 100, "x"), (53, "z" * 250, "x"), (54, None, "x"), (55, "", "x"), (56, rows[3][1], "x"), (57, "é" * 120, "x")]
    docs = frame(spark, rows).withColumn("cell", F.lit("mine"))
    want = h.cut_repeats([(t or "").encode() for _, t, _ in rows])
    got = {x.id: (x.n_removed, x.n_spans, bytes(x.kept)) for x in suffix_dedup.dedup(docs).collect()}
    assert got == {row[0]: w for row, w in zip(rows, want)}
    assert suffix_dedup.dedup(docs.limit(0)).count() == 0


def test_repeated_and_missing_ids(spark):
    text, other = prose(60, 8), prose(60, 9)
    rows = [(5, text, "x"), (5, text, "x"), (5, other, "x"), (None, text, "x"), (None, other, "x"), (4, other[:150], "x")]
    got = sorted((x.id is None, x.id or 0, x.n_removed) for x in suffix_dedup.dedup(frame(spark, rows)).collect())
    want = [(False, 4, 0), (False, 5, 0), (False, 5, len(text)), (False, 5, 150), (True, 0, len(text)), (True, 0, len(other))]
    assert got == sorted(want)


# --- archives --------------------------------------------------------------------------------------------------------


def test_archives_read_back(spark):
    big = "<p>" + LONG
    rows = [(1, "http://a", "x"), (2, "http://b\r\nX: y", "x"), (3, None, None), (4, "u", ""), (5, "u", big), (6, "u", big), (None, "n", "x"), (7, "ü", "é\r\n\r\nWARC/1.1"), (8, "v", "w"), (8, "v", "w")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit(1))
    folder = scratch_path(spark, "warc-test")
    index = warc.write(pages.repartition(3), folder)
    assert index.count() == len(rows)
    back = warc.fetch(index, folder).collect()
    assert len(back) == len(rows)
    by = {(r.id, r.url): r for r in back}
    assert (by["2", "http://bX: y"].record_type, bytes(by["2", "http://bX: y"].payload)) == ("response", b"x")
    assert (by["1", "http://a"].record_type, by["1", "http://a"].refers_to) == ("revisit", "2")
    assert (by["none", "n"].record_type, by["none", "n"].refers_to) == ("revisit", "2")
    assert by["5", "u"].refers_to == "6" and by["5", "u"].payload_bytes == len(big) and bytes(by["6", "u"].payload) == big.encode()
    assert by["3", ""].refers_to == "4" and sum(r.record_type == "response" for r in back if r.id == "8") == 2
    for r in back:
        if r.record_type == "response":
            assert r.digest == base64.b32encode(hashlib.sha1(bytes(r.payload)).digest()).decode()
    some = warc.fetch(index.where("id in (5, 7)"), folder)
    assert sorted(r.id for r in some.collect()) == ["5", "7"]
    none = warc.write(pages.limit(0), scratch_path(spark, "warc-test"))
    assert none.count() == 0


def test_reads_are_joined(spark):
    rows = [("f", 0, 10), ("f", 10, 10), ("f", 200_000, 5), ("g", 0, 7)]
    reads = warc.plan_reads(spark.createDataFrame(rows, "file string, offset bigint, length bigint")).collect()
    assert sorted((r.file, r.start, r.end, len(r.parts)) for r in reads) == [("f", 0, 20, 2), ("f", 200_000, 200_005, 1), ("g", 0, 7, 1)]


# --- vectors ---------------------------------------------------------------------------------------------------------


def test_vectors_by_brute_force(spark):
    r = np.random.default_rng(5)
    base = r.standard_normal((120, 24))
    rows = [(k, base[k].tolist(), k % 3) for k in range(120)]
    rows += [(200 + k, (base[k] + 0.12 * r.standard_normal(24)).tolist(), k % 3) for k in range(60)]
    rows += [(300 + k, (base[0] + 0.1 * r.standard_normal(24)).tolist(), 0) for k in range(50)]
    rows += [(400, base[1].tolist(), 1), (401, base[1].tolist(), 1), (401, base[1].tolist(), 1), (402, (3 * base[1]).tolist(), 1), (403, base[1].tolist(), None)]
    rows += [(404, None, 1), (405, [0.0] * 24, 1), (406, [None, *base[1][1:].tolist()], 1), (407, [float("nan"), *base[1][1:].tolist()], 1), (408, [float("inf")] * 24, 1), (409, [], 1), (410, base[1][:5].tolist(), 1), (None, base[2].tolist(), 2)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("room", F.lit(1))

    def usable(v):
        return v[2] is not None and v[1] and None not in v[1] and np.isfinite(v[1]).all() and np.any(v[1])

    links = []
    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]), np.array(b[1])
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links.append((i, j))
    root = h.groups(len(rows), links)
    count = np.bincount(np.array(links).ravel(), minlength=len(rows))
    low = {}
    for k, g in enumerate(root):
        if rows[k][0] is not None:
            low[g] = min(low.get(g, rows[k][0]), rows[k][0])
    want = sorted((str(v[0]), int(count[k]), str(low.get(root[k]))) for k, v in enumerate(rows))
    got = sorted((str(x.key), x.n_links, str(x.component)) for x in nn_descent.near_duplicates(table).collect())
    assert got == want
    assert nn_descent.near_duplicates(table.limit(0)).count() == 0


def two_clusters(n, label, first, r):
    """Two clusters of ``n`` vectors: over 0.999 within a cluster, over 0.98 and under 0.999 across."""
    away = np.arccos(0.9855)
    centres = np.eye(24)[0], np.cos(away) * np.eye(24)[0] + np.sin(away) * np.eye(24)[1]
    return [(first + k * n + i, (c + 0.002 * r.standard_normal(24)).tolist(), label) for k, c in enumerate(centres) for i in range(n)]


def cosines(rows):
    x = np.array([v[1] for v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def test_links_between_saturated_clusters(spark):
    r = np.random.default_rng(8)
    rows = two_clusters(12, "a", 0, r)
    sims = cosines(rows)
    assert sims[:12, :12].min() > 0.999 > sims[:12, 12:].max() and sims.min() > 0.98
    rows += two_clusters(40, "b", 100, r)
    rows += [(1000 + k, r.standard_normal(24).tolist(), "ab"[k % 2]) for k in range(100)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")
    got = {x.key: (x.n_links, x.component) for x in nn_descent.near_duplicates(table).collect()}
    assert [got[k] for k in range(24)] == [(23, 0)] * 24
    assert [got[k] for k in range(100, 180)] == [(79, 100)] * 80
    assert all(got[k] == (0, k) for k in range(1000, 1100))


def crowded(r):
    """A third of a label in one group of near copies, 40 pairs near them but not linked with them, and others."""
    e = np.eye(24)
    rows = [(k, (e[0] + 0.001 * r.standard_normal(24)).tolist(), 1) for k in range(300)]
    for k in range(40):
        side = r.standard_normal(24)
        side[0] = 0
        pair = np.cos(0.3) * e[0] + np.sin(0.3) * side / np.linalg.norm(side)
        rows += [(1000 + 2 * k + i, (pair + 0.001 * r.standard_normal(24)).tolist(), 1) for i in range(2)]
    return rows + [(2000 + k, r.standard_normal(24).tolist(), 1) for k in range(520)]


def test_vector_audit_counts_vectors_not_links(spark):
    rows = crowded(np.random.default_rng(9))
    hit = cosines(rows) >= 0.98
    np.fill_diagonal(hit, False)
    true = hit.sum(axis=1)
    vec = [(k, "r", np.array(v[1], "<f8").tobytes(), 1) for k, v in enumerate(rows)]
    vectors = spark.createDataFrame(vec, "id bigint, room string, vec binary, copies bigint")
    counts = lambda few: spark.createDataFrame([(k, int(n)) for k, n in enumerate(true) if n > (0 if few else 10)], "id bigint, others bigint")
    recall = lambda found: {r.room: r.recall for r in nn_descent.audit(vectors, found, 0.98).collect()}
    assert recall(counts(True)) == {"r": 1.0}
    assert recall(counts(False))["r"] == 0.0


def test_vectors_whole_where_no_round_passes(spark, monkeypatch):
    rows = crowded(np.random.default_rng(10))
    hit = cosines(rows) >= 0.98
    np.fill_diagonal(hit, False)
    want = {v[0]: int(n) for v, n in zip(rows, hit.sum(axis=1))}
    nothing = spark.createDataFrame([], "a bigint, b bigint, sim double, fresh boolean")
    monkeypatch.setattr(nn_descent, "_descend", lambda *a, **b: nothing)
    monkeypatch.setattr(nn_descent, "ROUNDS", 1)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert {x.key: x.n_links for x in nn_descent.near_duplicates(table).collect()} == want


def test_descent_plans_stay_small(spark, monkeypatch):
    """Every descent step, also of saturated vectors, is a plan of few exchanges: the driver keeps plans, not vectors."""
    r = np.random.default_rng(13)
    rows = two_clusters(12, "a", 0, r) + [(1000 + k, r.standard_normal(24).tolist(), "a") for k in range(100)]
    plans = []
    real = nn_descent.store

    def planned(df, name):
        if name == "nn-lists":
            plans.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange "))
        return real(df, name)

    monkeypatch.setattr(nn_descent, "store", planned)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")
    got = {x.key: x.n_links for x in nn_descent.near_duplicates(table).collect()}
    assert [got[k] for k in range(24)] == [23] * 24
    assert len(plans) >= 4 and max(plans) <= 12, plans


def test_vector_audit_sees_every_label(spark, monkeypatch):
    """2,000 labels of two vectors, few of them with a link, and a descent that finds none: all links are there."""
    r = np.random.default_rng(12)
    rows = []
    for label in range(2000):
        v = r.standard_normal(8)
        w = v + 1e-3 if label % 400 == 7 else r.standard_normal(8)
        rows += [(2 * label, v.tolist(), label), (2 * label + 1, w.tolist(), label)]
    want = {k: 0 for k, _, _ in rows}
    for label in range(2000):
        a, b = np.array(rows[2 * label][1]), np.array(rows[2 * label + 1][1])
        if a @ b / np.sqrt(a @ a * (b @ b)) >= 0.98:
            want[2 * label] = want[2 * label + 1] = 1
    assert 10 <= sum(want.values()) < 100
    nothing = spark.createDataFrame([], "a bigint, b bigint, sim double, fresh boolean")
    monkeypatch.setattr(nn_descent, "_descend", lambda *a, **b: nothing)
    monkeypatch.setattr(nn_descent, "ROUNDS", 1)
    found = nn_descent.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))
    assert {x.key: x.n_links for x in found.collect()} == want


# --- pipeline --------------------------------------------------------------------------------------------------------


def test_pipeline_by_brute_force(spark, sample):
    """Each stage against SQL or Python over what the stage before it kept."""
    docs = spark.read.parquet(f"{sample}/documents.parquet").cache()
    columns = docs.columns
    encode = tiktoken_ids()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.toPandas()
        docs = stage(spark, docs, sample).cache()
        after = docs.toPandas()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        con = h.duck(sample, documents=before)
        if name == "quality_rules":
            want = {r[0] for r in con.execute(f"SELECT doc_id FROM ({SQL['op5_quality_rules']}) WHERE kept").fetchall()}
            assert sorted(after.doc_id) == sorted(want) and 0 < len(after) < len(before)
        elif name == "jaccard_join":
            want = {r[0] for r in con.execute(f"SELECT doc_id FROM ({SQL['op2_jaccard_join']}) WHERE kept").fetchall()}
            assert sorted(after.doc_id) == sorted(want) and len(after) < len(before)
        elif name == "pii":
            spans = dict(con.execute(f"SELECT doc_id, spans FROM ({SQL['op10_pii']})").fetchall())
            was, now = dict(zip(before.doc_id, before.text)), dict(zip(after.doc_id, after.text))
            assert now == {i: blank(was[i], spans[i]) for i in was}
            assert (after.n_chars == after.text.str.len()).all()
        elif name == "mixing":
            want = con.execute(f"SELECT doc_id, taken // size AS n FROM ({SQL['op3_mix']}) WHERE taken > 0").fetchall()
            assert after.groupby("doc_id").size().to_dict() == dict(want)
        else:
            text = dict(zip(before.doc_id, before.text))
            assert len(after) == len(before)
            for r in after.itertuples():
                ids = encode(text[r.doc_id])
                assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids)
                assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def blank(text, spans):
    found = sorted((int(s), -int(e), kind) for kind, s, e in (x.split(":") for x in spans.split(",") if x))
    out, at = [], 0
    for s, e, kind in found:
        if s >= at:
            out.append(text[at:s] + {"term": "", "hint": "[WORD]"}.get(kind, f"[{kind.upper()}]"))
        at = max(at, -e)
    return "".join(out) + text[at:]


def test_pipeline_edges(spark, sample):
    """Nulls, empty and repeated rows and clashing extra columns go through every stage; so does an empty table."""
    rows = [(i, t, "en", s, len(t) if t is not None else None) for i, t, s in planted()]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for docs in (spark.createDataFrame(rows, schema).withColumn("size", F.lit(1)).withColumn("path", F.lit("p")), spark.createDataFrame([], schema)):
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, sample).cache()
            if k < len(corpus_pipeline.STAGES) - 1:
                assert docs.columns == columns
        docs.count()


# --- WARC reads are spread ---------------------------------------------------------------------------------------------


def test_reads_are_spread_over_tasks_and_records_are_dated(spark):
    folder = scratch_path(spark, "warc")
    pages = spark.createDataFrame([(k, f"http://h/{k}", prose(50, k)) for k in range(40)], "page_id bigint, url string, html string").repartition(6)
    index = warc.write(pages, folder, date="2024-05-06T07:08:09Z")
    archives = index.select("file").distinct().count()
    tasks = warc.fetch(index, folder).select(F.spark_partition_id().alias("t")).distinct().count()
    assert archives > 2 and tasks >= min(archives, spark.sparkContext.defaultParallelism) - 1
    assert warc.fetch(index, folder).rdd.getNumPartitions() >= min(archives, spark.sparkContext.defaultParallelism)
    row = index.first()
    with open(f"{folder.removeprefix('file://').removeprefix('file:')}/data/{row.file}", "rb") as archive:
        archive.seek(row.offset)
        assert warc.parse(archive.read(row.length))["warc-date"] == "2024-05-06T07:08:09Z"
    assert warc.fetch(index.limit(0), folder).count() == 0
