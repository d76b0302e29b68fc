"""Information-theoretic sanitisation of personal data, in built-in functions only.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers by pattern and check digit. Each distinct
value is a protected entity. Removing it is not enough where other words of the text give it away, so the corpus tells
how much a term discloses an entity: PMI(term; entity) over IC(entity) = -log p(entity), all in document counts. The
ratio is 1 when every document with the term holds the entity, and 0 when they are independent. In documents that hold
the entity, terms at ``REMOVE`` or more are removed and terms at ``GENERALISE`` or more replaced by a placeholder.
Only entities in at least ``SUPPORT`` different texts are protected this way, and a term counts only where it meets the
entity in as many different texts: copies of one text say nothing about the term.

Cost: only documents with a base span are paired with their own entities. Counts of terms over the whole corpus are
pre-aggregated per task. Texts of documents without a span are never shuffled.

Defined results: a null text is empty and has no span; positions are code points, end exclusive; rows that agree in key
and text get the same spans; a null key is a key; other columns are carried by ``sanitise`` whatever their names; an
empty table gives an empty result. Patterns are written with possessive repeats and a look behind, which give the same
matches as their plain forms in linear time and without recursion on long runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripecast.llm.common import as_text, fresh, store

# Kinds in their order, each with its pattern and a cheap test that every match passes.
PATTERNS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@[A-Za-z0-9-]"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[ -]?[0-9])++", r"[0-9][ -]?[0-9]"),
    "phone": (r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]"),
}
KINDS = (*PATTERNS, "term", "hint")
TERM = r"\p{L}{3,}"
SUPPORT = 3
REMOVE = 0.97
GENERALISE = 0.9
_BLOCK = 512
_SPAN = "array<struct<start:bigint,end:bigint,value:string>>"


def positions(text: Column, pattern: str) -> Column:
    """start, end and value of every match: what lies between the matches and the matches themselves, added up.

    Sums run in blocks, so that the cost of growing arrays stays low on long texts.
    """
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(pieces, found, lambda p, m: F.struct(F.length(p).cast("bigint").alias("gap"), m.alias("value")))
    pairs = F.filter(pairs, lambda x: x["value"].isNotNull())
    empty = F.array().cast(_SPAN)
    nothing = F.struct(F.lit(0).cast("bigint").alias("pos"), empty.alias("out"))

    def step(a, x):
        start = a["pos"] + x["gap"]
        end = start + F.length(x["value"])
        return F.struct(end.alias("pos"), F.array_append(a["out"], F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))).alias("out"))

    def blocks(all_pairs):
        cuts = F.sequence(F.lit(1), F.size(all_pairs), F.lit(_BLOCK))
        return F.transform(cuts, lambda s: F.aggregate(F.slice(all_pairs, s, F.lit(_BLOCK)), nothing, step))

    def shift(a, b):
        moved = F.transform(b["out"], lambda x: F.struct((x["start"] + a["pos"]).alias("start"), (x["end"] + a["pos"]).alias("end"), x["value"].alias("value")))
        return F.struct((a["pos"] + b["pos"]).alias("pos"), F.concat(a["out"], moved).alias("out"))

    once = F.transform(F.array(pairs), lambda p: F.when(F.size(p) > 0, F.aggregate(blocks(p), nothing, shift)["out"]).otherwise(empty))
    return once[0]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, k):
        d = F.substring(F.reverse(digits), k, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(k % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(r"^0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])){3}$")
    n = F.length(_digits(value))
    if kind == "card":
        return F.when((n >= 13) & (n <= 19), _luhn(_digits(value))).otherwise(F.lit(False))
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array of (kind, start, end, value), by kind as listed, then start."""
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string>>")

    def of(kind, pattern, test):
        valid = F.filter(positions(text, pattern), lambda x: _passes(kind, x["value"]))
        named = F.transform(valid, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value")))
        return F.when(text.rlike(test), named).otherwise(none)

    each = [of(kind, pattern, test) for kind, (pattern, test) in PATTERNS.items()]
    return F.concat(*each)


def _entity(span: Column) -> Column:
    value = F.when(span["kind"] == "email", F.lower(span["value"])).when(span["kind"] == "ip", span["value"]).otherwise(_digits(span["value"]))
    return F.concat(span["kind"], F.lit(":"), value)


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def term_counts(texts: DataFrame, text: str) -> DataFrame:
    """term, n_t: the number of rows that hold each term, over all rows."""
    terms = F.array_distinct(F.transform(F.regexp_extract_all(as_text(text), F.lit(TERM), F.lit(0)), F.lower))
    return texts.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))


def disclosing(held: DataFrame, counts: DataFrame, n_docs: int) -> DataFrame:
    """entity, term, ratio of the terms that disclose an entity at ``GENERALISE`` or more.

    ``held`` has a row for each text, protected entity of it and term of it: copy (a hash of the text), rows (documents
    with that text), entity, n_e, term.
    """
    met = held.groupBy("entity", "n_e", "term").agg(F.sum("rows").alias("n_te"), F.countDistinct("copy").alias("texts"))
    met = met.where((F.col("texts") >= SUPPORT) & (F.col("n_e") < n_docs)).join(counts, "term")
    n = F.lit(n_docs).cast("double")
    pmi = F.log(n * F.col("n_te") / (F.col("n_t") * F.col("n_e")))
    scored = met.select("entity", "term", (pmi / F.log(n / F.col("n_e"))).alias("ratio"))
    return scored.where(F.col("ratio") >= GENERALISE)


def _found(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), as_text(text).alias("text")).select("key", "text", base_spans(F.col("text")).alias("base"))


def _row_key(key: Column, text: Column) -> Column:
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.when(key.isNull(), F.lit("?")).otherwise(F.lit(":")), text))


def hit_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text, base, rows, spans: one row for each different (key, text) with a base span, and its number of rows.

    ``base`` are the pattern spans, ``spans`` these and the disclosing terms (kinds ``term`` and ``hint``).
    """
    found = _found(docs, key, text).where(F.size("base") > 0)
    hits = store(found.groupBy("key", "text").agg(F.first("base").alias("base"), F.count(F.lit(1)).alias("rows")).withColumn("hit", _row_key(F.col("key"), F.col("text"))).withColumn("copy", F.md5("text")), "pii-hits")
    occurs = hits.select("hit", "copy", "rows", F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity"))
    protected = occurs.groupBy("entity").agg(F.sum("rows").alias("n_e"), F.countDistinct("copy").alias("texts"))
    protected = protected.where(F.col("texts") >= SUPPORT).select("entity", "n_e")
    own = occurs.join(protected, "entity").select("hit", "entity", "n_e")

    def outside(t):
        return ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))

    places = F.transform(F.filter(positions(F.col("text"), TERM), outside), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lower(t["value"]).alias("term")))
    with_own = hits.join(own.select("hit").distinct(), "hit", "left_semi")
    places = store(with_own.select("hit", "copy", "rows", places.alias("places")), "pii-terms")
    terms = places.select("hit", "copy", "rows", F.explode(F.array_distinct(F.transform("places", lambda t: t["term"]))).alias("term"))
    held = terms.join(own, "hit")
    flagged = store(disclosing(held, term_counts(docs, text), docs.count()), "pii-disclosing")
    marked = held.join(flagged, ["entity", "term"]).groupBy("hit", "term").agg(F.max("ratio").alias("ratio"))
    marked = marked.groupBy("hit").agg(
        F.collect_list(F.when(F.col("ratio") >= REMOVE, F.col("term"))).alias("remove"),
        F.collect_list(F.when(F.col("ratio") < REMOVE, F.col("term"))).alias("blur"),
    )

    def chosen(kind, names):
        kept = F.filter("places", lambda t: F.array_contains(names, t["term"]))
        return F.transform(kept, lambda t: F.struct(F.lit(kind).alias("kind"), t["start"].alias("start"), t["end"].alias("end"), t["term"].alias("value")))

    added = places.join(marked, "hit").select("hit", F.concat(chosen("term", F.col("remove")), chosen("hint", F.col("blur"))).alias("added"))
    whole = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.concat("base", "added"))
    return hits.join(added, "hit", "left").select("key", "text", "base", "rows", whole.alias("spans"))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, base, spans of every row: arrays of (kind, start, end, value)."""
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string>>")
    clean = _found(docs, key, text).where(F.size("base") == 0).select("key", none.alias("base"), none.alias("spans"))
    hits = hit_spans(docs, key, text).select("key", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))), "base", "spans").select("key", "base", "spans")
    return clean.unionByName(hits)


def blanked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its label, removed terms by nothing; overlapping spans become one."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"))))

    def label(kind):
        return F.when(kind == "term", F.lit("")).when(kind == "hint", F.lit("[WORD]")).otherwise(F.concat(F.lit("["), F.upper(kind), F.lit("]")))

    def step(a, s):
        end = -s["minus_end"]
        between = F.substring(text, (a["pos"] + 1).cast("int"), F.greatest(s["start"] - a["pos"], F.lit(0)).cast("int"))
        piece = F.when(s["start"] >= a["pos"], F.concat(between, label(s["kind"]))).otherwise(F.lit(""))
        return F.struct(F.greatest(a["pos"], end).alias("pos"), F.array_append(a["out"], piece).alias("out"))

    start = F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast("array<string>").alias("out"))
    tail = lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, (a["pos"] + 1).cast("int"), F.length(text)))
    return F.aggregate(order, start, step, tail)


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The input rows with spans blanked in ``text``; rows without a base span pass through as they are."""
    base, joined, cleaned = (fresh(docs.columns, n) for n in ("base_", "hit_key_", "clean_"))
    located = docs.withColumn(base, base_spans(as_text(text)))
    clean = located.where(F.size(base) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
    hits = hit_spans(docs, key, text).select(_row_key(F.col("key"), F.col("text")).alias(joined), blanked(F.col("text"), F.col("spans")).alias(cleaned))
    dirty = located.where(F.size(base) > 0).withColumn(joined, _row_key(F.col(key), as_text(text))).join(hits, joined)
    kept = [F.col(cleaned).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    return clean.unionByName(dirty.select(*kept))
