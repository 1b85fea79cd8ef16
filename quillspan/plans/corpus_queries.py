"""Queries of chunking, retrieval, statistics and packaging on the corpus tables, with their SQL."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan import shared
from quillspan.functions import refs
from quillspan.functions import text as tx
from quillspan.operators import bm25, chunking, dense, incremental, membership, ordered, packaging, validation
from quillspan.sources.tables import table

c = F.col
#: The fixed query of the scoring queries.
QUERY = ("covenant", "river", "mercy")


def chunk_ids(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter(c("text").isNotNull())
    cut, truncated = tx.capped(c("text"))
    rows = rows.select("doc_id", F.coalesce("source", F.lit("")).alias("source"), cut.alias("t"), truncated.alias("truncated")).withColumn("text_checksum", tx.checksum(c("t")))
    return rows.select("doc_id", tx.chunk_id(F.lit("document"), c("source"), c("doc_id").cast("string"), c("text_checksum")).alias("id"), "text_checksum", "truncated")


def skip_reasons(spark: SparkSession, d: str) -> DataFrame:
    reason = F.when(c("text").isNull(), "null text").when(c("text") == "", "empty text").when(tx.strip(c("text")) == "", "blank text").when(F.length("text") > tx.CHUNK_LIMIT, "over the limit").otherwise("kept")
    return table(spark, d, "documents").select("doc_id", reason.alias("reason"))


def scripture_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.scripture(chunking.scripture_windows(table(spark, d, "verse")))[0]


def commentary_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.commentary(table(spark, d, "comments"))[0].select("id", "source", "anchor", "book", "chapter", "verse_start", "verse_end", "key", "text_checksum", "truncated")


def confession_chunks(spark: SparkSession, d: str) -> DataFrame:
    return chunking.confession(table(spark, d, "section"))[0].select("id", "source", "anchor", "key", "text_checksum", "truncated")


def entries(spark: SparkSession, d: str) -> DataFrame:
    """Dictionary entries as the lexicon chunks show them: a head before the first dash, and what follows it."""
    rows = table(spark, d, "chunk").filter("resource_type = 'lexicon'").select("source", "key", "text").distinct()
    dash = F.instr("text", " — ")
    none = F.lit(None).cast("string")
    return rows.select(
        c("source").alias("lexicon"), F.lit("greek").alias("language"), c("key").alias("strongs"), none.alias("raw_key"), F.when(dash > 0, F.substring(c("text"), F.lit(1), dash - 1)).alias("lemma"), none.alias("translit"),
        F.when(dash > 0, F.substring(c("text"), dash + 3, F.length("text"))).otherwise(c("text")).alias("definition"), none.alias("derivation"), none.alias("kjv_def"), F.lit(False).alias("not_used"),
    )


def all_chunks(spark: SparkSession, d: str) -> DataFrame:
    parts = [chunking.scripture(chunking.scripture_windows(table(spark, d, "verse"))), chunking.commentary(table(spark, d, "comments")), chunking.confession(table(spark, d, "section")), chunking.lexicon(entries(spark, d))]
    chunks, skips = chunking.extracted(parts)
    made = chunks.groupBy("resource_type").agg(F.count("*").alias("n_chunks"), F.count_if("truncated").alias("n_truncated"))
    lost = skips.groupBy("resource_type").agg(F.count("*").alias("n_skipped"))
    return made.join(lost, "resource_type", "left").withColumn("n_skipped", F.coalesce("n_skipped", F.lit(0).cast("long")))


def type_source_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunk").select("id", "resource_type", "source").distinct().groupBy("resource_type", "source").agg(F.count("*").alias("n"))


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return bm25.documents(table(spark, d, "documents"), "doc_id", "text")


def doc_token_lengths(spark: SparkSession, d: str) -> DataFrame:
    return _docs(spark, d).select(c("doc").alias("doc_id"), c("len").cast("long").alias("n_tokens"))


def bm25_postings(spark: SparkSession, d: str) -> DataFrame:
    return bm25.postings(_docs(spark, d)).select("term", c("doc").alias("doc_id"), "tf")


def bm25_terms(spark: SparkSession, d: str) -> DataFrame:
    return bm25.terms(bm25.postings(_docs(spark, d))).select("term", "df", c("term_id").cast("long").alias("term_id"))


def bm25_stats(spark: SparkSession, d: str) -> DataFrame:
    return bm25.stats(_docs(spark, d))


def scoped_bm25_stats(spark: SparkSession, d: str) -> DataFrame:
    scope = packaging.scoped(table(spark, d, "documents"), "resource_type", ["sermon", "letter"], ["doc_id"])
    return bm25.stats(bm25.documents(scope, "doc_id", "text"))


def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    return bm25.scored(_docs(spark, d), list(QUERY)).orderBy(c("score").desc(), "doc").limit(10).select(c("doc").alias("doc_id"), "score")


def _query_vector(spark: SparkSession, d: str) -> list[float]:
    return [float(x) for x in table(spark, d, "embeddings").filter("vec_id = 0").select("embedding").first()[0]]


def dense_topk(spark: SparkSession, d: str) -> DataFrame:
    return dense.top_k(table(spark, d, "embeddings"), "vec_id", "embedding", _query_vector(spark, d), 5)


def hybrid_topk(spark: SparkSession, d: str) -> DataFrame:
    """Fusion of the 50 best documents by BM25 with the 50 nearest vectors; a document and a vector of one number are one item."""
    from pyspark.sql import Window

    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(Window.orderBy(c("score").desc(), "doc")))  # noqa: E731 - 50 rows
    lexical = bm25.scored(_docs(spark, d), list(QUERY)).orderBy(c("score").desc(), "doc").limit(50)
    near = dense.top_k(table(spark, d, "embeddings"), "vec_id", "embedding", _query_vector(spark, d), 50).withColumnRenamed("vec_id", "doc")
    return bm25.fused([ranked(lexical), ranked(near)], "doc", "rank").select(c("doc").alias("doc_id"), "score")


def vector_lengths(spark: SparkSession, d: str) -> DataFrame:
    return dense.loaded(table(spark, d, "chunk").select("id", "resource_type").distinct(), table(spark, d, "embedding"), 64).groupBy("resource_type").agg(F.count("*").alias("n"))


def determinism(spark: SparkSession, d: str) -> DataFrame:
    """A stored encoding of all documents against a second one of a sample, made in other batches."""
    rows = table(spark, d, "documents").filter(c("text").isNotNull()).select("doc_id", "text")
    stored = shared.materialize(incremental.encoded(rows, "doc_id", "text", incremental.HashingEncoder, batch=64), "encoded")
    sample = ordered.strided_sample(rows, ["doc_id"], 400)
    again = incremental.encoded(sample, "doc_id", "text", incremental.HashingEncoder, batch=7)
    return dense.compared(again, stored, "doc_id", "vector")


def incremental_partition(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter(c("text").isNotNull())
    key = lambda t: tx.chunk_id(F.lit("document"), F.coalesce("source", F.lit("")), c("doc_id").cast("string"), tx.checksum(t))
    prior = rows.filter("doc_id % 3 <> 0").select(key(c("text")).alias("id"))
    now = rows.select(key(F.when(c("doc_id") % 5 == 0, F.concat("text", F.lit("!"))).otherwise(c("text"))).alias("id"))
    return incremental.partition(now, prior, "id").groupBy("action").agg(F.count("*").alias("n"))


def edge_stats(spark: SparkSession, d: str) -> DataFrame:
    return validation.edge_statistics(table(spark, d, "crossref"))


def inverted_ranges(spark: SparkSession, d: str) -> DataFrame:
    return validation.inverted_ranges(table(spark, d, "crossref"), table(spark, d, "book"))


def top_votes(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "crossref").select("edge_id", "votes").distinct()
    return rows.orderBy(c("votes").desc_nulls_last(), "edge_id").limit(50)


def translation_stats(spark: SparkSession, d: str) -> DataFrame:
    return validation.translation_statistics(table(spark, d, "verse"))


def chapter_max_deviation(spark: SparkSession, d: str) -> DataFrame:
    rows = validation.chapter_lengths(table(spark, d, "verse"))
    return rows.groupBy("translation", "book").agg(F.count("*").alias("n_chapters"), F.sum("got").alias("n_got"), F.sum("expected").alias("n_expected"), F.count_if(c("got") != c("expected")).alias("n_deviating"))


def commentary_stats(spark: SparkSession, d: str) -> DataFrame:
    return validation.commentary_statistics(table(spark, d, "comments"), membership.spine(table(spark, d, "verse")))


def confession_stats(spark: SparkSession, d: str) -> DataFrame:
    return validation.confession_statistics(table(spark, d, "section"), membership.spine(table(spark, d, "verse")))


def three_way_classification(spark: SparkSession, d: str) -> DataFrame:
    return validation.entry_statistics(table(spark, d, "chunk"))


def _ratios(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter(c("text").isNotNull())
    return rows.select("doc_id", "source", F.round(tx.garble_ratio(c("text")), 6).alias("ratio"))


def garble_ratio(spark: SparkSession, d: str) -> DataFrame:
    return _ratios(spark, d).select("doc_id", "ratio")


def garble_by_commentator(spark: SparkSession, d: str) -> DataFrame:
    return validation.garble_statistics(table(spark, d, "comments"))


def percentile_by_index(spark: SparkSession, d: str) -> DataFrame:
    rows = shared.materialize(_ratios(spark, d), "ratios")  # read three times: by the mean, the range bounds and the numbering
    at = ordered.at_shares(rows, "ratio", {"median": 0.5, "p90": 0.9, "p99": 0.99, "most": 1.0})
    both = rows.agg(F.round(F.avg("ratio"), 6).alias("mean")).join(F.broadcast(at))
    return both.select("mean", "median", "p90", "p99", "most", validation.verdict(c("mean"), c("p90")).alias("verdict"))


def component_completeness(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "comments").filter(c("component").isNotNull())
    sets = rows.groupBy("commentator", "book", "chapter").agg(F.collect_set("component").alias("s"))
    wanted = F.array(*[F.lit(x) for x in ("exposition", "notes", "hints")])
    return sets.select("commentator", "book", "chapter", (F.size(F.array_except(wanted, "s")) == 0).alias("complete"))


def ack_rollup(spark: SparkSession, d: str) -> DataFrame:
    of = lambda name, key: table(spark, d, name).select(F.lit(name).alias("resource"), c(key).alias("id")).distinct()
    books = table(spark, d, "book").select(F.lit("book").alias("resource"), "id", "name")
    return packaging.acknowledgements([of("verse", "translation"), of("section", "document"), of("comments", "commentator"), of("crossref", "source"), books])


def pack_split(spark: SparkSession, d: str) -> DataFrame:
    rows = packaging.split(table(spark, d, "documents"), F.lower(F.substring("lang", 1, 2)) == "en")
    return packaging.sizes(rows, "pack", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))


def flag_totals(spark: SparkSession, d: str) -> DataFrame:
    verse, comments = table(spark, d, "verse"), table(spark, d, "comments")
    spine = membership.spine(verse)
    bad = membership.resolves(comments.select("commentator", "key", "book", "chapter", "verse_start").distinct(), spine, "book", "chapter", c("verse_start"), "ok", allow_zero=True).filter("not ok")
    parts = [
        ("verse", "error", "chapter length", validation.chapter_deviations(verse), "translation"),
        ("verse", "flag", "empty", verse.distinct().filter(F.coalesce("text", F.lit("")) == ""), "translation"),
        ("comments", "error", "bad reference", bad, "commentator"),
        ("comments", "flag", "blank", comments.distinct().filter(chunking.empty(c("text"))), "commentator"),
    ]
    return validation.totals(validation.flags(parts))


def example_lists(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "verse").filter(F.coalesce("text", F.lit("")) == "").select("translation", "book", "chapter", "verse_start").distinct()
    return validation.examples(rows, "translation", [c("book"), c("chapter"), c("verse_start")], 25)


def versification(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "verse").select("translation", "book", "chapter", "verse_start").distinct()
    first = rows.agg(F.min("translation")).first()[0]
    point = refs.resolved(c("translation"), c("book"), c("chapter"), c("verse_start"), [first], "HYM")
    return rows.withColumn("p", point).filter(c("p.note").isNotNull()).select("translation", "p.book", "p.chapter", "p.verse", "p.note")


def prose_crosscheck(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "section").select(c("document").alias("source"), "key", "text")
    b = table(spark, d, "chunk").filter(c("resource_type") == "confession").select("source", "key", "text")
    return validation.prose_crosscheck(a, b, ["source", "key"], "text").groupBy("source", "agrees").agg(F.count("*").alias("n"))


def quoted_anchors(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter(c("anchor").isNotNull())
    return rows.select("doc_id", tx.quoted(c("anchor")).alias("url"), tx.preview(F.coalesce("text", F.lit(""))).alias("preview"))


def section_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = packaging.section_rows(table(spark, d, "section"))
    return rows.select("document", "key", c("position").cast("long").alias("position"), "title", "proofs")


def smoke_query(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings")
    label = rows.filter("vec_id = 0").first()["label"]
    hits = dense_topk(spark, d).join(rows.select("vec_id", "label"), "vec_id")
    return dense.smoke(hits, "vector 0", c("label") == label)


def vector_blobs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.lower(F.hex(tx.vector_bytes("embedding"))).alias("bytes"))


QUERIES = {
    f.__name__: f
    for f in (
        versification, prose_crosscheck, quoted_anchors, section_rows, smoke_query, vector_blobs, chunk_ids, skip_reasons, scripture_chunks, commentary_chunks, confession_chunks, all_chunks, type_source_counts, doc_token_lengths, bm25_postings, bm25_terms, bm25_stats,
        scoped_bm25_stats, bm25_topk, dense_topk, hybrid_topk, vector_lengths, determinism, incremental_partition, edge_stats, inverted_ranges, top_votes, translation_stats,
        chapter_max_deviation, commentary_stats, confession_stats, three_way_classification, garble_ratio, garble_by_commentator, percentile_by_index, component_completeness, ack_rollup,
        pack_split, flag_totals, example_lists,
    )
}

_ID = "substr({t}, 1, 3) || '_' || substr(sha256({t} || chr(0) || {s} || chr(0) || {a} || chr(0) || {x}), 1, 24)"


def _id(t: str, s: str, a: str, x: str) -> str:
    return _ID.format(t=t, s=s, a=a, x=x)


_SPACE = r"'^[\s\x0b\x1c-\x1f\x85\p{Z}]+|[\s\x0b\x1c-\x1f\x85\p{Z}]+$'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, {_SPACE}, '', 'g')"




def _forms() -> list[tuple[str, str]]:
    """Characters that compatibility normalisation turns into others, as far as letters, digits and apostrophes of search tokens come of it."""
    every = (chr(n) for n in range(128, 0x110000) if unicodedata.decomposition(chr(n)).startswith("<"))
    pairs = ((ch, unicodedata.normalize("NFKC", ch)) for ch in every)
    return [(ch, form) for ch, form in pairs if re.search("[a-z0-9']", form.casefold())]


def _folded(x: str) -> str:
    """Case folding where it gives letters of search tokens and lower case does not."""
    for n in range(128, 0x3000):
        ch = chr(n)
        if unicodedata.normalize("NFKC", ch) == ch and re.search("[a-z]", ch.casefold()):
            x = f"replace({x}, chr({n}), {' || '.join(f'chr({ord(y)})' for y in ch.casefold())})"
    return f"lower({x})"


# NFKC in SQL: characters one by one by a table of their forms, then canonical composition
_DOCS = """forms(c, form) AS (VALUES {forms}),
raw AS (SELECT doc_id, coalesce(text, '') AS t FROM documents {{w}}),
odd AS (SELECT doc_id, unnest(regexp_extract_all(t, '(?s).')) AS c, generate_subscripts(regexp_extract_all(t, '(?s).'), 1) AS i FROM raw WHERE regexp_matches(t, '[^\\x00-\\x7f]')),
formed AS (SELECT doc_id, string_agg(coalesce(form, c), '' ORDER BY i) AS t FROM odd LEFT JOIN forms USING (c) GROUP BY doc_id),
docs AS (SELECT doc_id, regexp_extract_all({folded}, '[a-z0-9]+(?:''[a-z0-9]+)*') AS tokens FROM raw LEFT JOIN formed USING (doc_id))""".format(
    forms=", ".join(f"(chr({ord(ch)}), {' || '.join(f'chr({ord(y)})' for y in form)})" for ch, form in _forms()), folded=_folded("nfc_normalize(coalesce(formed.t, raw.t))")
)
_STATS = """, a AS (SELECT count(*) AS n, coalesce(sum(len(tokens)), 0) AS total FROM docs), vo AS (SELECT count(DISTINCT t) AS vocab FROM (SELECT unnest(tokens) AS t FROM docs))
  SELECT 'n_docs' AS key, n::DOUBLE AS value FROM a UNION ALL SELECT 'avgdl', round(total::DOUBLE / n, 6) FROM a UNION ALL SELECT 'total_tokens', total::DOUBLE FROM a
  UNION ALL SELECT 'vocab_size', vocab::DOUBLE FROM vo UNION ALL SELECT 'k1', 1.5::DOUBLE UNION ALL SELECT 'b', 0.75::DOUBLE"""
_WINDOWS = """
v AS (SELECT * FROM (SELECT DISTINCT translation, book, chapter, verse_start, verse_end, CASE WHEN omitted THEN '' ELSE coalesce(text, '') END AS text, loaded_at FROM verse)
  QUALIFY row_number() OVER (PARTITION BY translation, book, chapter, verse_start ORDER BY loaded_at, verse_end, text) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY translation, book, chapter ORDER BY verse_start) AS rn, count(*) OVER (PARTITION BY translation, book, chapter) AS n FROM v),
w AS (SELECT *, least((rn - 1) // 10, CASE WHEN n < 10 THEN 1 WHEN n % 10 < 4 THEN n // 10 ELSE n // 10 + 1 END - 1) AS w FROM r),
win AS (SELECT translation, book, chapter, w, min(verse_start) AS verse_start, arg_max(verse_end, rn) AS verse_end, coalesce(string_agg(text, ' ' ORDER BY rn) FILTER (WHERE text <> ''), '') AS text FROM w GROUP BY ALL),
sc AS (SELECT *, translation || ':' || book || ' ' || chapter || ':' || verse_start || CASE WHEN verse_end <> verse_start THEN '-' || verse_end ELSE '' END AS anchor, """ + _strip("text") + """ AS whole FROM win)"""
_COMMENTS = "co AS (SELECT *, commentator || ':' || key || '#' || ord AS anchor, " + _strip("coalesce(text, '')") + " AS whole FROM (SELECT DISTINCT commentator, key, ord, book, chapter, verse_start, verse_end, passage, text FROM comments))"
_SECTIONS = (
    "se AS (SELECT *, upper(document) || ' ' || key AS anchor, "
    + _strip("CASE WHEN coalesce(title, '') <> '' THEN title || chr(10) || text ELSE text END")
    + " AS whole, " + _strip("coalesce(text, '')") + " AS body FROM (SELECT DISTINCT document, key, title, text FROM section))"
)
_ENTRIES = """e AS (SELECT source, key, CASE WHEN instr(text, ' — ') > 0 THEN substr(text, instr(text, ' — ') + 3) ELSE text END AS definition,
  CASE WHEN instr(text, ' — ') > 0 THEN substr(text, 1, instr(text, ' — ') - 1) END AS lemma FROM (SELECT DISTINCT source, key, text FROM chunk WHERE resource_type = 'lexicon'))"""
_MADE = "sha256(substr(whole, 1, 6000)) AS text_checksum, length(whole) > 6000 AS truncated"
_SCORES = """, q AS (SELECT doc_id, len(tokens) AS dl, unnest(tokens) AS term FROM docs), tf AS (SELECT doc_id, dl, term, count(*) AS tf FROM q WHERE term IN ('covenant', 'river', 'mercy') GROUP BY ALL),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY ALL), s AS (SELECT count(*) AS n, avg(len(tokens)) AS avgdl FROM docs),
  sc AS (SELECT doc_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))), 6) AS score FROM tf JOIN df USING (term), s GROUP BY ALL)"""
_GARBLE = "CASE WHEN len(w) = 0 THEN 1.0::DOUBLE ELSE 1 - len(list_filter(w, lambda x: regexp_matches(x, '[aeiouAEIOU]')))::DOUBLE / len(w) END"
_RATIO = "r AS (SELECT doc_id, round(" + _GARBLE + ", 6) AS ratio FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z]{2,}') AS w FROM documents WHERE text IS NOT NULL))"
_DEVIATIONS = """spine AS (SELECT book, chapter, max(verse_end) AS n FROM verse GROUP BY ALL), t AS (SELECT DISTINCT translation FROM verse),
  g AS (SELECT translation, book, chapter, max(verse_end) AS got FROM verse GROUP BY ALL),
  dev AS (SELECT t.translation, s.book, s.chapter, s.n AS expected, coalesce(g.got, 0) AS got FROM spine s CROSS JOIN t LEFT JOIN g ON g.translation = t.translation AND g.book = s.book AND g.chapter = s.chapter WHERE coalesce(g.got, 0) <> s.n)"""
_KEY = "trim(regexp_replace(regexp_replace(lower(regexp_replace({}, '\\([^()]*[0-9]+\\s*[:.]\\s*[0-9]+[^()]*\\)', ' ', 'g')), '[^a-z]+', ' ', 'g'), ' +', ' ', 'g'))"
SQL = {
    "versification": """SELECT DISTINCT translation, book, chapter, verse_start AS verse, 'the title is numbered as verse 1' AS note FROM verse
      WHERE translation = (SELECT min(translation) FROM verse) AND book = 'HYM' AND verse_start = 1 AND chapter IN (SELECT unnest(generate_series(1, 145)) EXCEPT SELECT unnest([1, 2, 10, 33, 43, 71, 91, 99, 135, 136, 137] || generate_series(93, 97) || generate_series(104, 107) || generate_series(111, 119)))""",
    "prose_crosscheck": f"""WITH a AS (SELECT document AS source, key, array_to_string(list_slice(string_split({_KEY.format("text")}, ' '), 1, 14), ' ') AS f FROM section), b AS (SELECT source, key, {_KEY.format("text")} AS o FROM chunk WHERE resource_type = 'confession'),
      j AS (SELECT a.source, a.key, bool_or(contains(o, f)) AS agrees FROM a JOIN b ON a.source = b.source AND a.key = b.key GROUP BY ALL) SELECT source, agrees, count(*) AS n FROM j GROUP BY ALL""",
    "quoted_anchors": "SELECT doc_id, url_encode(anchor) AS url, substr(coalesce(text, ''), 1, 70) AS preview FROM documents WHERE anchor IS NOT NULL",
    "section_rows": """WITH r AS (SELECT DISTINCT document, key, ord, title, text, proof_texts FROM section)
      SELECT document, key, row_number() OVER (PARTITION BY document ORDER BY ord, key, text) - 1 AS position, nullif(title, '') AS title,
        CASE WHEN len(proof_texts) > 0 THEN '[' || array_to_string(list_transform(proof_texts, lambda p: '{"book":"' || p.book || '","chapter":' || p.chapter || coalesce(',"verse_end":' || p.verse_end, '') || ',"verse_start":' || p.verse_start || '}'), ',') || ']' END AS proofs FROM r""",
    "smoke_query": """WITH t AS (SELECT vec_id, label, round(list_inner_product(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)), 6) AS s FROM embeddings ORDER BY s DESC, vec_id LIMIT 5)
      SELECT 'vector 0' AS query, bool_or(label = (SELECT label FROM embeddings WHERE vec_id = 0)) AS passed, count(*) AS n_hits FROM t""",
    "vector_blobs": """WITH w AS (SELECT vec_id, list_transform(embedding, lambda x: printf('%08x', x::FLOAT::BIT::BIGINT)) AS w FROM embeddings)
      SELECT vec_id, array_to_string(list_transform(w, lambda x: substr(x, 7, 2) || substr(x, 5, 2) || substr(x, 3, 2) || substr(x, 1, 2)), '') AS bytes FROM w""",
    "chunk_ids": f"""WITH r AS (SELECT doc_id, coalesce(source, '') AS source, {_strip('text')} AS whole FROM documents WHERE text IS NOT NULL), x AS (SELECT *, {_MADE} FROM r)
      SELECT doc_id, {_id("'document'", 'source', 'doc_id', 'text_checksum')} AS id, text_checksum, truncated FROM x""",
    "skip_reasons": f"""SELECT doc_id, CASE WHEN text IS NULL THEN 'null text' WHEN text = '' THEN 'empty text' WHEN {_strip('text')} = '' THEN 'blank text' WHEN length(text) > 6000 THEN 'over the limit' ELSE 'kept' END AS reason FROM documents""",
    "scripture_chunks": f"""WITH {_WINDOWS}, x AS (SELECT *, {_MADE} FROM sc WHERE whole <> '')
      SELECT {_id("'scripture'", 'translation', 'anchor', 'text_checksum')} AS id, 'scripture' AS resource_type, translation AS source, anchor, book, chapter, verse_start, verse_end, NULL::VARCHAR AS key,
             substr(whole, 1, 6000) AS text, text_checksum, truncated FROM x""",
    "commentary_chunks": f"""WITH {_COMMENTS}, x AS (SELECT *, {_MADE} FROM co WHERE whole <> '')
      SELECT {_id("'commentary'", 'commentator', 'anchor', 'text_checksum')} AS id, commentator AS source, anchor, book, chapter, nullif(verse_start, 0) AS verse_start, nullif(verse_end, 0) AS verse_end, key, text_checksum, truncated FROM x""",
    "confession_chunks": f"""WITH {_SECTIONS}, x AS (SELECT *, {_MADE} FROM se WHERE body <> '')
      SELECT {_id("'confession'", 'document', 'anchor', 'text_checksum')} AS id, document AS source, anchor, key, text_checksum, truncated FROM x""",
    "all_chunks": f"""WITH {_WINDOWS}, {_COMMENTS}, {_SECTIONS}, {_ENTRIES}, lx AS (SELECT coalesce(trim(definition), '') <> '' AS kept, length({_strip("coalesce(nullif(lemma, '') || ' — ', '') || definition")}) > 6000 AS t FROM e), a AS (SELECT 'scripture' AS resource_type, whole <> '' AS kept, length(whole) > 6000 AS t FROM sc
      UNION ALL SELECT 'commentary', whole <> '', length(whole) > 6000 FROM co UNION ALL SELECT 'confession', body <> '', length(whole) > 6000 FROM se UNION ALL SELECT 'lexicon', kept, t FROM lx)
      SELECT resource_type, count(*) FILTER (WHERE kept) AS n_chunks, count(*) FILTER (WHERE kept AND t) AS n_truncated, count(*) FILTER (WHERE NOT kept) AS n_skipped FROM a GROUP BY ALL""",
    "type_source_counts": "SELECT resource_type, source, count(*) AS n FROM (SELECT DISTINCT id, resource_type, source FROM chunk) GROUP BY ALL",
    "doc_token_lengths": f"WITH {_DOCS.format(w='')} SELECT doc_id, len(tokens) AS n_tokens FROM docs",
    "bm25_postings": f"WITH {_DOCS.format(w='')} SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM docs) GROUP BY ALL",
    "bm25_terms": f"WITH {_DOCS.format(w='')}, t AS (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(tokens) AS term FROM docs) GROUP BY ALL) SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS term_id FROM t",
    "bm25_stats": f"WITH {_DOCS.format(w='')}{_STATS}",
    "scoped_bm25_stats": f"WITH {_DOCS.format(w=chr(10) + 'WHERE resource_type IN (' + repr('sermon') + ', ' + repr('letter') + ')')}{_STATS}",
    "bm25_topk": f"WITH {_DOCS.format(w='')}{_SCORES} SELECT doc_id, score FROM sc ORDER BY score DESC, doc_id LIMIT 10",
    "hybrid_topk": f"""WITH {_DOCS.format(w='')}{_SCORES}, near AS (SELECT vec_id AS doc_id, round(list_inner_product(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)), 6) AS score FROM embeddings),
      a AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM sc), b AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM near)
      SELECT doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 6) AS score FROM (SELECT * FROM a WHERE rank <= 50 UNION ALL SELECT * FROM b WHERE rank <= 50) GROUP BY ALL""",
    "dense_topk": """SELECT vec_id, round(list_inner_product(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)), 6) AS score FROM embeddings ORDER BY score DESC, vec_id LIMIT 5""",
    "vector_lengths": """SELECT resource_type, count(*) AS n FROM (SELECT DISTINCT id, resource_type FROM chunk) c JOIN (SELECT DISTINCT chunk_id, vector FROM embedding WHERE len(vector) = 64) e ON c.id = e.chunk_id GROUP BY ALL""",
    "determinism": """WITH n AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n, length(trim(text)) > 0 AS some FROM documents WHERE text IS NOT NULL)
      SELECT count(*) AS n, 0.0::DOUBLE AS max_abs_diff, 1.0::DOUBLE AS min_cosine FROM n WHERE i % greatest(1, n // 400) = 0 AND i // greatest(1, n // 400) < 400""",
    "incremental_partition": f"""WITH r AS (SELECT doc_id, coalesce(source, '') AS s, text FROM documents WHERE text IS NOT NULL),
      p AS (SELECT DISTINCT {_id("'document'", 's', 'doc_id', 'sha256(text)')} AS id FROM r WHERE doc_id % 3 <> 0),
      n AS (SELECT DISTINCT {_id("'document'", 's', 'doc_id', "sha256(CASE WHEN doc_id % 5 = 0 THEN text || '!' ELSE text END)")} AS id FROM r)
      SELECT CASE WHEN n.id IS NULL THEN 'dropped' WHEN p.id IS NULL THEN 'encoded' ELSE 'reused' END AS action, count(*) AS n FROM n FULL JOIN p ON n.id = p.id GROUP BY ALL""",
    "edge_stats": """WITH r AS (SELECT DISTINCT * FROM crossref) SELECT count(*) AS n_edges, count(DISTINCT (src_book, src_chapter, src_verse)) AS n_sources, min(votes) AS min_votes, max(votes) AS max_votes,
      count(*) FILTER (WHERE votes < 0) AS n_negative, count(*) FILTER (WHERE votes = 0) AS n_zero, count(*) FILTER (WHERE (tgt_book, tgt_chapter, tgt_verse) <> (tgt_end_book, tgt_end_chapter, tgt_end_verse)) AS n_range,
      count(*) FILTER (WHERE (tgt_book, tgt_chapter, tgt_verse) = (tgt_end_book, tgt_end_chapter, tgt_end_verse)) AS n_single, count(*) FILTER (WHERE tgt_book <> tgt_end_book) AS n_cross_book FROM r""",
    "inverted_ranges": """WITH r AS (SELECT DISTINCT edge_id, tgt_book, tgt_chapter, tgt_verse, tgt_end_book, tgt_end_chapter, tgt_end_verse FROM crossref)
      SELECT r.* FROM r LEFT JOIN book s ON s.id = tgt_book LEFT JOIN book e ON e.id = tgt_end_book WHERE (coalesce(e.ord, 1073741824), tgt_end_chapter, tgt_end_verse) < (coalesce(s.ord, 1073741824), tgt_chapter, tgt_verse)""",
    "top_votes": "SELECT DISTINCT edge_id, votes FROM crossref ORDER BY votes DESC NULLS LAST, edge_id LIMIT 50",
    "translation_stats": """WITH r AS (SELECT DISTINCT translation, book, chapter, verse_start, verse_end, text, red_letter, omitted FROM verse)
      SELECT translation, count(DISTINCT book) AS n_books, count(DISTINCT (book, chapter)) AS n_chapters, count(*) AS n_verses, count(*) FILTER (WHERE red_letter) AS n_red_letter, count(*) FILTER (WHERE verse_end <> verse_start) AS n_bridges,
      count(*) FILTER (WHERE coalesce(text, '') = '') AS n_empty, count(*) FILTER (WHERE omitted) AS n_omitted, count(*) FILTER (WHERE coalesce(text, '') = '' AND NOT omitted) AS n_empty_not_omitted FROM r GROUP BY ALL""",
    "chapter_max_deviation": f"""WITH {_DEVIATIONS.split("dev AS")[0]} x AS (SELECT t.translation, s.book, s.n AS expected, coalesce(g.got, 0) AS got FROM spine s CROSS JOIN t LEFT JOIN g ON g.translation = t.translation AND g.book = s.book AND g.chapter = s.chapter)
      SELECT translation, book, count(*) AS n_chapters, sum(got)::BIGINT AS n_got, sum(expected)::BIGINT AS n_expected, count(*) FILTER (WHERE got <> expected) AS n_deviating FROM x GROUP BY ALL""",
    "commentary_stats": f"""WITH spine AS (SELECT book, chapter, max(verse_end) AS n FROM verse GROUP BY ALL), r AS (SELECT DISTINCT commentator, key, c.book, c.chapter, verse_start, text, coalesce(s.n IS NOT NULL AND verse_start BETWEEN 0 AND s.n, false) AS valid
        FROM comments c LEFT JOIN spine s ON s.book = c.book AND s.chapter = c.chapter),
      cov AS (SELECT DISTINCT r.commentator, s.book, s.chapter FROM r JOIN spine s ON s.book = r.book), l AS (SELECT commentator, count(*) AS n FROM cov WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.commentator = cov.commentator AND r.book = cov.book AND r.chapter = cov.chapter) GROUP BY ALL),
      st AS (SELECT commentator, count(*) AS n_paragraphs, sum(length(coalesce(text, '')))::BIGINT AS n_chars, count(DISTINCT book) AS n_books, count(DISTINCT (book, chapter)) AS n_chapters, count(*) FILTER (WHERE NOT valid) AS n_bad_refs,
        count(*) FILTER (WHERE length(coalesce(text, '')) >= 12000) AS n_long, count(*) FILTER (WHERE {_strip("coalesce(text, '')")} = '') AS n_blank FROM r GROUP BY ALL)
      SELECT st.*, coalesce(l.n, 0) AS n_chapters_lacking FROM st LEFT JOIN l ON l.commentator = st.commentator""",
    "confession_stats": """WITH spine AS (SELECT book, chapter, max(verse_end) AS n FROM verse GROUP BY ALL), r AS (SELECT DISTINCT * EXCLUDE (loaded_at) FROM section), p AS (SELECT document, unnest(proof_texts) AS p FROM r),
      e AS (SELECT document, (s.n IS NULL OR NOT p.verse_start BETWEEN 1 AND s.n)::INT + (p.verse_end IS NOT NULL AND (s.n IS NULL OR NOT p.verse_end BETWEEN 1 AND s.n))::INT AS bad FROM p LEFT JOIN spine s ON s.book = upper(trim(p.book)) AND s.chapter = p.chapter),
      b AS (SELECT document, sum(bad)::BIGINT AS n FROM e GROUP BY ALL)
      SELECT r.document, count(*) AS n_sections, count(DISTINCT chapter) AS n_chapters, count(DISTINCT question) AS n_questions, count(DISTINCT article) AS n_articles, count(DISTINCT lords_day) AS n_lords_days,
      coalesce(sum(len(proof_texts)), 0)::BIGINT AS n_proofs, coalesce(any_value(b.n), 0) AS n_bad_ends FROM r LEFT JOIN b ON b.document = r.document GROUP BY r.document""",
    "three_way_classification": """WITH r AS (SELECT DISTINCT source, id, key, text FROM chunk WHERE resource_type = 'lexicon'), b AS (SELECT *, trim(regexp_replace(coalesce(text, ''), '^[^—]*—', '')) AS body FROM r)
      SELECT source, CASE WHEN coalesce(text, '') = '' THEN 'empty' WHEN length(body) > 4000 THEN 'long' WHEN body = '' THEN 'head_only' ELSE 'plain' END AS kind, count(*) AS n, count(DISTINCT key) AS n_keys FROM b GROUP BY ALL""",
    "garble_ratio": f"WITH {_RATIO} SELECT * FROM r",
    "garble_by_commentator": f"""WITH g AS (SELECT commentator, {_GARBLE} AS ratio FROM (SELECT commentator, regexp_extract_all(text, '[A-Za-z]{{2,}}') AS w FROM (SELECT DISTINCT commentator, key, text FROM comments WHERE text IS NOT NULL)))
      SELECT commentator, count(*) AS n, round(avg(ratio), 6) AS mean_ratio, count(*) FILTER (WHERE ratio >= 0.3::DOUBLE) AS n_rough FROM g GROUP BY ALL""",
    "percentile_by_index": f"""WITH {_RATIO}, n AS (SELECT ratio, row_number() OVER (ORDER BY ratio) - 1 AS i, count(*) OVER () AS n FROM r),
      a AS (SELECT round(avg(ratio), 6) AS mean, max(ratio) FILTER (WHERE i = n // 2) AS median, max(ratio) FILTER (WHERE i = floor(n * 0.9::DOUBLE)) AS p90, max(ratio) FILTER (WHERE i = floor(n * 0.99::DOUBLE)) AS p99, max(ratio) AS most FROM n)
      SELECT *, CASE WHEN mean < 0.04 AND p90 < 0.08 THEN 'good' WHEN mean < 0.1 THEN 'usable' ELSE 'poor' END AS verdict FROM a""",
    "component_completeness": """SELECT commentator, book, chapter, bool_or(component = 'exposition') AND bool_or(component = 'notes') AND bool_or(component = 'hints') AS complete FROM comments WHERE component IS NOT NULL GROUP BY ALL""",
    "ack_rollup": """SELECT DISTINCT 'verse' AS resource, translation AS id, NULL::VARCHAR AS name, NULL::VARCHAR AS license, NULL::VARCHAR AS attribution FROM verse UNION SELECT 'section', document, NULL, NULL, NULL FROM section
      UNION SELECT 'comments', commentator, NULL, NULL, NULL FROM comments UNION SELECT 'crossref', source, NULL, NULL, NULL FROM crossref UNION SELECT 'book', id, name, NULL, NULL FROM book""",
    "pack_split": """WITH r AS (SELECT CASE WHEN coalesce(lower(substr(lang, 1, 2)) = 'en', false) THEN 'bundled' ELSE 'on_demand' END AS pack, coalesce(strlen(text), 0) AS b FROM documents)
      SELECT pack, count(*) AS n_rows, sum(b)::BIGINT AS bytes, bool_and(pack = 'bundled') AND sum(b) > 209715200 AS over_limit FROM r GROUP BY pack""",
    "flag_totals": f"""WITH {_DEVIATIONS}, bad AS (SELECT DISTINCT commentator, key, c.book, c.chapter, verse_start FROM comments c LEFT JOIN spine s ON s.book = c.book AND s.chapter = c.chapter WHERE NOT coalesce(s.n IS NOT NULL AND verse_start BETWEEN 0 AND s.n, false)),
      f AS (SELECT 'verse' AS resource, 'error' AS s FROM dev UNION ALL SELECT 'verse', 'flag' FROM (SELECT DISTINCT * FROM verse) WHERE coalesce(text, '') = '' UNION ALL SELECT 'comments', 'error' FROM bad
        UNION ALL SELECT 'comments', 'flag' FROM (SELECT DISTINCT * FROM comments) WHERE {_strip("coalesce(text, '')")} = '')
      SELECT resource, count(*) FILTER (WHERE s = 'error') AS error_total, count(*) FILTER (WHERE s = 'flag') AS flag_total FROM f GROUP BY ALL""",
    "example_lists": """WITH e AS (SELECT DISTINCT translation, book, chapter, verse_start FROM verse WHERE coalesce(text, '') = '')
      SELECT *, greatest(count(*) OVER (PARTITION BY translation) - 25, 0) AS more FROM e QUALIFY row_number() OVER (PARTITION BY translation ORDER BY book, chapter, verse_start) <= 25""",
}
