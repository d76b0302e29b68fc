"""The registered corpus queries, each a thin call of its operator over whole tables, and the SQL they are held against."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripecast.llm import bpe, compress_quality, hard_negatives, jaccard_join, mixing, nn_descent, pii, quality_rules, sharding, suffix_dedup, toxicity, warc, whitening
from ripecast.llm.common import read, scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SHARDS = [f"shard-{k:03d}" for k in range(64)]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    labels = read(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out)
    scored = compress_quality.score(docs, compress_quality.learn(docs, labels), keep_text=False)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.join(read(spark, sf_dir, "documents").select("doc_id", "text"))
    rows = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))).alias("row")
    kept = F.col("first") & ((F.col("row") == 1) | ~F.col("filled"))
    return found.select("*", rows).select(F.col("key").alias("doc_id"), F.col("group_key").alias("class_id"), "n_links", kept.alias("kept"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality_rules.ledger(read(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(entries, quality_rules.STRICT).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        quality_rules.fails(quality_rules.BASE).alias("base_failed"),
        "kept",
        "fail_bits",
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(read(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    index = warc.write(read(spark, sf_dir, "pages"), folder)
    return warc.fetch(index, folder).select(
        F.when(F.col("id") != "none", F.col("id").cast("bigint")).alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op8_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = nn_descent.near_duplicates(read(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("key").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.col("key").eqNullSafe(F.col("component")).alias("kept"),
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, TOKENIZER, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        F.col("key").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in pii.PATTERNS],
        F.sha2(pii.spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.spelled(F.col("spans")).alias("spans"),
    )


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out)
    scored = toxicity.score(docs, labels)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label").cast("bigint"))
    rows = rows.withColumn("label", moved).withColumn("anchor", F.coalesce(F.col("vec_id") % 100 == 0, F.lit(False)))
    return hard_negatives.mine(rows, "vec_id", "label", "embedding", "anchor").select(
        F.col("anchor_key").alias("anchor_id"),
        F.col("positive_key").alias("positive_id"),
        "rank",
        F.col("negative_key").alias("negative_id"),
        "positive_score",
        "negative_score",
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding")
    return found.withColumnRenamed("key", "vec_id")


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op7_warc": op7_warc,
    "op8_nn_descent": op8_nn_descent,
    "op9_bpe": op9_bpe,
    "op10_pii": op10_pii,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_mix": op3_mix,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_sharding": op6_sharding,
    "op11_toxicity": op11_toxicity,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_whitening": op13_whitening,
}

SQL = {}

SQL["op3_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::BIGINT AS w
  FROM d GROUP BY source),
c AS (
  SELECT *, source_size * 200 AS cap, sum(source_size) OVER () * 150 AS budget FROM s),
l AS (
  SELECT *, budget - coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
         sum(w) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wl
  FROM c),
f AS (SELECT lft, wl FROM l WHERE lft * w < cap * wl ORDER BY cap / w, source IS NULL, source LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN f.wl IS NULL OR f.lft * w >= cap * f.wl THEN cap::DOUBLE / 100.0
              ELSE (f.lft * w)::DOUBLE / (f.wl * 100)::DOUBLE END AS target
  FROM l LEFT JOIN f ON true),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       ((whole::BIGINT + CASE WHEN 2 * before + size < 2 * (target - whole * source_size) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM r
"""

SQL["op5_quality_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
lines AS (
  SELECT rid, count(*) AS n, count(DISTINCT line) AS n_distinct
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
win AS (
  SELECT rid, p, words[p] || ' ' || words[p+1] || ' ' || words[p+2] || ' ' || words[p+3] || ' ' || words[p+4] AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - 3)) AS p FROM d)),
hit AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, w) AS n FROM win) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p + k) AS n FROM hit, (SELECT unnest(range(0, 5)) AS k) GROUP BY rid),
m AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(l.n - l.n_distinct, 0)::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         coalesce(l.n, 0) AS n_lines,
         len(regexp_extract_all(text, '[A-Za-z]')) AS n_letters,
         len(regexp_extract_all(text, '[A-Z]')) AS n_capitals
  FROM d LEFT JOIN lines l USING (rid) LEFT JOIN rep USING (rid)),
b AS (
  SELECT *,
         (CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
          + CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END
          + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
          + CASE WHEN 100 * n_capitals > 50 * n_letters THEN 16 ELSE 0 END
          + CASE WHEN word_chars < 2 * n_words THEN 32 ELSE 0 END
          + CASE WHEN word_chars > 20 * n_words THEN 64 ELSE 0 END)::BIGINT AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits
FROM b
"""

SQL["op10_pii"] = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
kinds AS (
  SELECT * FROM (VALUES
    (1, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+'),
    (2, 'ip', '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'),
    (3, 'card', '[0-9]([ -]?[0-9])+'),
    (4, 'phone', '\+[0-9][ ().0-9-]+[0-9]')) t(k, kind, pattern)),
raw AS (
  SELECT rid, 1 AS k, string_split_regex(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS p, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS m FROM docs
  UNION ALL SELECT rid, 2, string_split_regex(text, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), regexp_extract_all(text, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') FROM docs
  UNION ALL SELECT rid, 3, string_split_regex(text, '[0-9]([ -]?[0-9])+'), regexp_extract_all(text, '[0-9]([ -]?[0-9])+') FROM docs
  UNION ALL SELECT rid, 4, string_split_regex(text, '\+[0-9][ ().0-9-]+[0-9]'), regexp_extract_all(text, '\+[0-9][ ().0-9-]+[0-9]') FROM docs),
matched AS (SELECT rid, k, i, m[i] AS value, length(p[i]) AS gap FROM (SELECT rid, k, p, m, unnest(range(1, len(m) + 1)) AS i FROM raw)),
placed AS (
  SELECT rid, k, value, regexp_replace(value, '[^0-9]', '', 'g') AS digits,
         (sum(gap + length(value)) OVER (PARTITION BY rid, k ORDER BY i))::BIGINT AS e
  FROM matched),
luhn AS (
  SELECT value, sum(CASE WHEN j % 2 = 0 THEN CASE WHEN d > 4 THEN 2 * d - 9 ELSE 2 * d END ELSE d END) % 10 = 0 AS good
  FROM (SELECT value, j, substr(reverse(digits), j, 1)::INT AS d
        FROM (SELECT value, digits, unnest(range(1, length(digits) + 1)) AS j
              FROM (SELECT DISTINCT value, digits FROM placed WHERE k = 3 AND length(digits) BETWEEN 13 AND 19)))
  GROUP BY value),
base AS (
  SELECT rid, p.k, kind, p.value, e - length(p.value) AS s, e,
         kind || ':' || CASE p.k WHEN 1 THEN lower(p.value) WHEN 2 THEN p.value ELSE digits END AS entity
  FROM placed p JOIN kinds USING (k) LEFT JOIN luhn ON p.k = 3 AND p.value = luhn.value
  WHERE CASE p.k WHEN 1 THEN true
                 WHEN 2 THEN len(list_filter(string_split(p.value, '.'), lambda x: length(ltrim(x, '0')) > 3 OR coalesce(try_cast(ltrim(x, '0') AS INT), 0) > 255)) = 0
                 WHEN 3 THEN coalesce(good, false)
                 ELSE length(digits) BETWEEN 9 AND 15 END),
occurs AS (SELECT DISTINCT rid, text, entity FROM base JOIN docs USING (rid)),
protected AS (SELECT entity, count(*) AS n_e FROM occurs GROUP BY entity HAVING count(DISTINCT text) >= 3),
own AS (SELECT rid, text, entity, n_e FROM occurs JOIN protected USING (entity)),
words AS (
  SELECT rid, i, lower(m[i]) AS term, length(m[i]) AS n, length(p[i]) AS gap
  FROM (SELECT rid, p, m, unnest(range(1, len(m) + 1)) AS i
        FROM (SELECT rid, string_split_regex(text, '\p{L}{3,}') AS p, regexp_extract_all(text, '\p{L}{3,}') AS m FROM docs))),
counts AS (SELECT term, count(DISTINCT rid) AS n_t FROM words GROUP BY term),
spots AS (
  SELECT rid, term, e - n AS s, e
  FROM (SELECT rid, term, n, (sum(gap + n) OVER (PARTITION BY rid ORDER BY i))::BIGINT AS e FROM words WHERE rid IN (SELECT rid FROM own)) w
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = w.rid AND b.s < w.e AND w.e - w.n < b.e)),
met AS (
  SELECT entity, n_e, term, count(DISTINCT rid) AS n_te FROM own JOIN spots USING (rid)
  GROUP BY entity, n_e, term HAVING count(DISTINCT text) >= 3),
scored AS (
  SELECT entity, term, ln(n * n_te / (n_t * n_e)) / ln(n / n_e) AS ratio
  FROM met JOIN counts USING (term), (SELECT count(*)::DOUBLE AS n FROM docs) WHERE n_e < n),
added AS (
  SELECT rid, CASE WHEN max(ratio) >= 0.97 THEN 5 ELSE 6 END AS k, s, e
  FROM own JOIN spots USING (rid) JOIN scored USING (entity, term) WHERE ratio >= 0.9 GROUP BY rid, term, s, e),
spelled AS (
  SELECT rid, k, s, kind || ':' || s || ':' || e AS span FROM base
  UNION ALL SELECT rid, k, s, CASE k WHEN 5 THEN 'term' ELSE 'hint' END || ':' || s || ':' || e FROM added),
joined AS (
  SELECT rid, string_agg(span, ',' ORDER BY k, s) FILTER (k < 5) AS base, string_agg(span, ',' ORDER BY k, s) AS spans,
         count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2, count(*) FILTER (k = 3) AS n3, count(*) FILTER (k = 4) AS n4
  FROM spelled GROUP BY rid)
SELECT doc_id, coalesce(n1, 0)::BIGINT AS n_email, coalesce(n2, 0)::BIGINT AS n_ip, coalesce(n3, 0)::BIGINT AS n_card,
       coalesce(n4, 0)::BIGINT AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (rid)
"""

SQL["op7_warc"] = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS hex FROM p),
l AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS last FROM d),
b AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (bits >> shift) % 32 + 1, 1), '' ORDER BY k, shift DESC) AS digest
  FROM (SELECT hex, k, ('0x' || substr(hex, 5 * k + 1, 5))::INT AS bits
        FROM (SELECT DISTINCT hex FROM d), (SELECT unnest(range(0, 8)) AS k)),
       (SELECT unnest([0, 5, 10, 15]) AS shift)
  GROUP BY hex)
SELECT page_id, payload_bytes, digest AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM l JOIN b USING (hex)
"""

SQL["op2_jaccard_join"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT rid, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[p:p+4], ' ') END AS sh
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
p AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS k
  FROM s a JOIN s b ON a.sh = b.sh AND a.rid <> b.rid GROUP BY a.rid, b.rid),
e AS (
  SELECT x, y FROM p JOIN n m ON m.rid = x JOIN n o ON o.rid = y WHERE k >= 0.8 * (m.n + o.n - k) - 1e-9),
r AS (SELECT rid, rid AS root FROM d UNION SELECT r.rid, e.y FROM r JOIN e ON r.root = e.x),
g AS (SELECT rid, min(root) AS root FROM r GROUP BY rid),
l AS (SELECT x, count(*) AS n FROM e GROUP BY x)
SELECT d.doc_id, h.doc_id AS class_id, coalesce(l.n, 0)::BIGINT AS n_links, g.root = d.rid AS kept
FROM d JOIN g USING (rid) JOIN d h ON h.rid = g.root LEFT JOIN l ON l.x = d.rid
"""

SQL["op8_nn_descent"] = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
ok AS (
  SELECT *, sqrt(list_sum(list_transform(x, lambda c: c * c))) AS norm FROM v
  WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
e AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.x, b.x) / (a.norm * b.norm) >= 0.98),
r AS (SELECT vec_id, vec_id AS root FROM v UNION SELECT r.vec_id, e.y FROM r JOIN e ON r.root = e.x),
g AS (SELECT vec_id, min(root) AS root FROM r GROUP BY vec_id),
l AS (SELECT x, count(*) AS n FROM e GROUP BY x)
SELECT v.vec_id, coalesce(l.n, 0)::BIGINT AS n_links, g.root AS component_id, g.root = v.vec_id AS kept
FROM v JOIN g USING (vec_id) LEFT JOIN l ON l.x = v.vec_id
"""

SQL["op4_suffix_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS LAST) AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT rid, p, substr(h, 2 * p + 1, 200) AS s
  FROM (SELECT rid, h, unnest(range(0, length(h) // 2 - 99)) AS p FROM d)),
f AS (SELECT s, min(rid * 4294967296 + p) AS first, count(*) AS n FROM w GROUP BY s HAVING count(*) > 1),
later AS (SELECT rid, p FROM w JOIN f USING (s) WHERE rid * 4294967296 + p <> first),
isle AS (
  SELECT rid, p, sum(CASE WHEN p <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY p) AS k
  FROM (SELECT rid, p, lag(p) OVER (PARTITION BY rid ORDER BY p) AS before FROM later)),
cut AS (SELECT rid, k, min(p) AS a, max(p) + 100 AS z FROM isle GROUP BY rid, k),
gap AS (
  SELECT rid, k, a, z, lag(z, 1, 0) OVER (PARTITION BY rid ORDER BY k) AS from_, row_number() OVER (PARTITION BY rid ORDER BY k DESC) = 1 AS last
  FROM cut),
kept AS (
  SELECT rid, count(*) AS n_spans, sum(z - a) AS n_removed,
         string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)) || CASE WHEN last THEN substr(h, 2 * z + 1) ELSE '' END, '' ORDER BY k) AS h
  FROM gap JOIN d USING (rid) GROUP BY rid)
SELECT d.doc_id, (length(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""

SQL["op12_hard_negatives"] = r"""
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding::DOUBLE[], lambda c: floor(256 * c)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding::DOUBLE[], lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.rid AS arid, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v a JOIN v b ON a.rid <> b.rid AND len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0),
p AS (
  SELECT arid, anchor_id, other_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY arid ORDER BY score DESC, other_id) AS j
  FROM s WHERE same QUALIFY j <= 5),
n AS (
  SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.arid, p.j ORDER BY score DESC, other_id)::INT AS rank
  FROM p JOIN s ON p.arid = s.arid AND NOT s.same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
