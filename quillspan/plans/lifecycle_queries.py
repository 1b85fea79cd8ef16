"""Queries of whole lifecycles on the test tables, with their SQL.

The build queries write a table out in the format of its sources (zipped book files, edge lists, JSON, markup), build it again from
these files, and are held against the table itself: so zip scans, parsers and builders see all rows and all their dirt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan import shared
from quillspan.operators import chunking, membership, ordered, validation
from quillspan.plans import corpus_queries, pipeline
from quillspan.sources import commentaries, confessions, edges, files, usfm, writers
from quillspan.sources.tables import table

c = F.col


def _books(spark: SparkSession, d: str) -> list[str]:
    return [r["id"] for r in table(spark, d, "book").select("id").distinct().orderBy("id").collect()]  # the canon: 66 rows


def _first_verses(spark: SparkSession, d: str) -> DataFrame:
    """Distinct verses, one for each key."""
    rows = table(spark, d, "verse").select("translation", "book", "chapter", "verse_start", "verse_end", F.coalesce("text", F.lit("")).alias("text"), "superscription").distinct()
    return ordered.first_seen(rows, ["translation", "book", "chapter", "verse_start"], [c("verse_end"), c("text"), c("superscription").asc_nulls_first()])


def verse_build(spark: SparkSession, d: str) -> DataFrame:
    """Verses from zips of book files; the verses that any translation omits are disputed, and those a translation lacks are added to it."""
    rows = _first_verses(spark, d)
    folder = writers.write_files(writers.zipped(writers.book_files(rows), "translation", "book", "text", ".usfm"), shared.new_path(spark, "books"))
    texts = files.zip_members(spark, f"{folder}/*.zip").withColumn("translation", F.regexp_extract("path", r"([^/]+)\.zip$", 1))
    texts = texts.select(F.concat_ws("/", "translation", "member").alias("path"), "text")
    parsed = usfm.verses(texts, frozenset(_books(spark, d)))[0].withColumn("translation", F.substring_index("path", "/", 1)).drop("path", "pos")
    disputed = table(spark, d, "verse").filter("omitted").select("book", "chapter", "verse_start").distinct()
    built = pipeline.standardized(parsed, disputed)
    return built.select("translation", "book", "chapter", "verse_start", "verse_end", "text", "superscription", "omitted")


def crossref_build(spark: SparkSession, d: str) -> DataFrame:
    """Edges from an edge list, and the number of rejects of each kind."""
    rows = table(spark, d, "crossref").select("src_book", "src_chapter", "src_verse", *[f"{p}_{x}" for p in ("tgt", "tgt_end") for x in ("book", "chapter", "verse")], "votes")
    folder = writers.edge_list(rows, shared.new_path(spark, "edges"))
    good, bad = edges.parse(files.whole_texts(spark, f"{folder}/*.csv"), {b: b for b in _books(spark, d)})
    point = lambda p: F.concat_ws(".", *[c(f"{p}_{x}").cast("string") for x in ("book", "chapter", "verse")])
    a = good.groupBy(point("src").alias("source"), point("tgt").alias("target"), point("tgt_end").alias("target_end"), c("votes").cast("long").alias("votes")).agg(F.count("*").alias("n"))
    b = bad.groupBy(c("reason").alias("source")).agg(F.count("*").alias("n"))
    return a.unionByName(b, allowMissingColumns=True)


def section_build(spark: SparkSession, d: str) -> DataFrame:
    """Sections with chapter and section numbers from JSON."""
    rows = table(spark, d, "section").filter("chapter IS NOT NULL AND section IS NOT NULL").select("document", "chapter", "section", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    rows = ordered.first_seen(rows, ["document", "chapter", "section"], [c("title"), c("text")])
    named = writers.chapter_json(rows).select(F.concat("document", F.lit(".json")).alias("name"), c("text").alias("content"))
    folder = writers.write_files(named, shared.new_path(spark, "confessions"))
    texts = files.whole_texts(spark, f"{folder}/*.json")
    return confessions.chapters_json(texts, "all")[0].select("key", "chapter", "section", "title", "text")


def comments_build(spark: SparkSession, d: str) -> DataFrame:
    """Comments of sources that are no scans from anchored markup: how often each text stands at each place."""
    rows = table(spark, d, "comments").select("commentator", "key", "ord", "book", "chapter", "verse_start", "verse_end", "component", "text").distinct()
    clean = rows.groupBy("commentator").agg(F.avg(c("component").isNull().cast("int")).alias("share")).filter("share >= 0.5").select("commentator")
    volumes = writers.anchored_markup(rows.join(clean, "commentator", "left_semi"))
    named = volumes.select(F.concat_ws(".", "commentator", "book", F.lit("xml")).alias("name"), c("text").alias("content"))
    folder = writers.write_files(named, shared.new_path(spark, "commentaries"))
    built, _ = commentaries.parse(files.whole_texts(spark, f"{folder}/*.xml"), "all", codes={b: b for b in _books(spark, d)})
    return built.groupBy("book", "chapter", "verse_start", "verse_end", "text").agg(F.count("*").alias("n"))


def lexicon_chunks(spark: SparkSession, d: str) -> DataFrame:
    made, _ = chunking.lexicon(corpus_queries.entries(spark, d))
    return made.select("id", "source", "anchor", "key", "text_checksum", "truncated")


def lexicon_entries(spark: SparkSession, d: str) -> DataFrame:
    return validation.lexicon_statistics(corpus_queries.entries(spark, d))


def scoped_search(spark: SparkSession, d: str) -> DataFrame:
    """The index of one translation and one confession: its statistics made anew, its vectors as they are."""
    of = lambda kind: table(spark, d, "chunk").filter(c("resource_type") == kind).agg(F.min("source")).first()[0]
    folder = shared.new_path(spark, "index")
    vectors = table(spark, d, "embedding").filter(F.size("vector") == 64).select(c("chunk_id").alias("id"), "vector").distinct()
    vectors.write.parquet(f"{folder}/vector.parquet")
    spark.createDataFrame([("revision", "given"), ("dim", "64")], "key string, value string").write.parquet(f"{folder}/meta.parquet")
    pipeline.scoped_search(spark, d, folder, f"{folder}/scope", of("scripture"), of("confession"))
    n = table(spark, f"{folder}/scope", "vector").agg(F.count("*").cast("double").alias("value")).select(F.lit("n_vectors").alias("key"), "value")
    return table(spark, f"{folder}/scope", "bm25_stats").unionByName(n)


def pack_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each table in each pack."""
    one = lambda name, column: table(spark, d, name).agg(F.min(column)).first()[0]
    folder = shared.new_path(spark, "packs")
    pipeline.package(spark, d, folder, one("verse", "translation"), one("section", "document"))
    parts = [("bundled", "verse"), ("on_demand", "verse"), ("bundled", "section"), ("on_demand", "section"), ("on_demand", "comments"), ("on_demand", "crossref")]
    counts = [table(spark, f"{folder}/{pack}", name).agg(F.count("*").alias("n")).select(F.lit(pack).alias("pack"), F.lit(name).alias("name"), "n") for pack, name in parts]
    return pipeline.union(counts).filter("n > 0")


def malformed_refs(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "crossref").select("edge_id", "src_book", "src_chapter", "src_verse").distinct()
    books = table(spark, d, "book").select(c("id").alias("book"))
    return membership.malformed(rows, books, "src_book", "src_chapter", c("src_verse")).select("edge_id", "src_book", "src_chapter", "src_verse")


def finding_totals(spark: SparkSession, d: str) -> DataFrame:
    """Errors and flags of all tables, by the definitions of each one's report."""
    return validation.totals(pipeline.findings(spark, d)[1])


QUERIES = {f.__name__: f for f in (verse_build, crossref_build, section_build, comments_build, lexicon_chunks, lexicon_entries, scoped_search, pack_rows, malformed_refs, finding_totals)}

_SQUEEZED = r"nullif(trim(regexp_replace({}, '[\s\x0b\x1c-\x1f\x85\p{{Z}}]+', ' ', 'g')), '')"
_SCOPE_DOCS = corpus_queries._DOCS.replace(
    "SELECT doc_id, coalesce(text, '') AS t FROM documents {w}",
    """SELECT id AS doc_id, arg_min(coalesce(text, ''), coalesce(text, '')) AS t FROM chunk
    WHERE (resource_type = 'scripture' AND source = (SELECT min(source) FROM chunk WHERE resource_type = 'scripture')) OR (resource_type = 'confession' AND source = (SELECT min(source) FROM chunk WHERE resource_type = 'confession')) GROUP BY id""",
)
SQL = {
    "verse_build": """WITH v AS (SELECT * FROM (SELECT DISTINCT translation, book, chapter, verse_start, verse_end, coalesce(text, '') AS text, superscription FROM verse)
        QUALIFY row_number() OVER (PARTITION BY translation, book, chapter, verse_start ORDER BY verse_end, text, superscription NULLS FIRST) = 1),
      d AS (SELECT DISTINCT book, chapter, verse_start FROM verse WHERE omitted), tb AS (SELECT DISTINCT translation, book FROM verse),
      added AS (SELECT tb.translation, d.* FROM tb JOIN d USING (book) ANTI JOIN v ON v.translation = tb.translation AND v.book = d.book AND v.chapter = d.chapter AND v.verse_start = d.verse_start)
      SELECT v.translation, v.book, v.chapter, v.verse_start, greatest(v.verse_end, v.verse_start) AS verse_end, trim(v.text) AS text, nullif(v.superscription, '') AS superscription, d.book IS NOT NULL AND trim(v.text) = '' AS omitted
      FROM v LEFT JOIN d ON v.book = d.book AND v.chapter = d.chapter AND v.verse_start = d.verse_start
      UNION ALL SELECT translation, book, chapter, verse_start, verse_start, '', NULL, true FROM added""",
    "crossref_build": """WITH r AS (SELECT * EXCLUDE (source), src_book || '.' || src_chapter || '.' || src_verse AS source, tgt_book || '.' || tgt_chapter || '.' || tgt_verse AS target, tgt_end_book || '.' || tgt_end_chapter || '.' || tgt_end_verse AS target_end FROM crossref),
      j AS (SELECT *, CASE WHEN votes IS NULL THEN 'non-integer votes' WHEN src_book NOT IN (SELECT id FROM book) THEN 'unparseable source'
        WHEN tgt_book NOT IN (SELECT id FROM book) OR tgt_end_book NOT IN (SELECT id FROM book) THEN 'unparseable target' END AS reason FROM r)
      SELECT source, target, target_end, votes::BIGINT AS votes, count(*) AS n FROM j WHERE reason IS NULL GROUP BY ALL UNION ALL SELECT reason, NULL, NULL, NULL, count(*) FROM j WHERE reason IS NOT NULL GROUP BY reason""",
    "section_build": f"""WITH s AS (SELECT DISTINCT document, chapter, section, coalesce(title, '') AS title, coalesce(text, '') AS text FROM section WHERE chapter IS NOT NULL AND section IS NOT NULL),
      f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY document, chapter, section ORDER BY title, text) = 1), t AS (SELECT document, chapter, min(title) AS title FROM f GROUP BY ALL)
      SELECT f.chapter || '.' || f.section AS key, f.chapter, f.section, {_SQUEEZED.format('t.title')} AS title, {_SQUEEZED.format('f.text')} AS text FROM f JOIN t ON f.document = t.document AND f.chapter = t.chapter""",
    "comments_build": f"""WITH r AS (SELECT DISTINCT commentator, key, ord, book, chapter, verse_start, verse_end, component, text FROM comments),
      k AS (SELECT commentator FROM r GROUP BY commentator HAVING avg((component IS NULL)::INT) >= 0.5), x AS (SELECT book, chapter, coalesce(verse_start, 0) AS verse_start, verse_end AS e, {_SQUEEZED.format('text')} AS text FROM r WHERE commentator IN (SELECT commentator FROM k))
      SELECT book, chapter, verse_start, CASE WHEN verse_start > 0 AND coalesce(e, 0) >= verse_start THEN e ELSE verse_start END AS verse_end, text, count(*) AS n FROM x WHERE text IS NOT NULL GROUP BY ALL""",
    "lexicon_chunks": f"""WITH {corpus_queries._ENTRIES}, t AS (SELECT source, source || ':' || coalesce(nullif(key, ''), nullif(lemma, ''), '') AS anchor, coalesce(nullif(key, ''), nullif(lemma, '')) AS key, {corpus_queries._strip("coalesce(nullif(lemma, '') || ' — ', '') || definition")} AS whole FROM e WHERE coalesce(trim(definition), '') <> ''),
      x AS (SELECT *, {corpus_queries._MADE} FROM t) SELECT {corpus_queries._id("'lexicon'", 'source', 'anchor', 'text_checksum')} AS id, source, anchor, key, text_checksum, truncated FROM x""",
    "lexicon_entries": f"""WITH {corpus_queries._ENTRIES} SELECT source AS lexicon, 'greek' AS language, count(*) AS n_entries, count(*) FILTER (WHERE coalesce(key, '') <> '') AS n_linked, count(DISTINCT nullif(key, '')) AS n_keys, 0::BIGINT AS n_duplicates, 0::BIGINT AS n_not_used,
      count(*) FILTER (WHERE coalesce(definition, '') <> '') AS n_defined, count(*) FILTER (WHERE length(definition) > 4000) AS n_long, 0::BIGINT AS n_meaning_elsewhere, 0::BIGINT AS n_no_meaning, count(*) FILTER (WHERE coalesce(definition, '') = '') AS n_stubs FROM e GROUP BY source""",
    "scoped_search": f"""WITH {_SCOPE_DOCS}{corpus_queries._STATS} UNION ALL SELECT 'n_vectors', count(*)::DOUBLE FROM (SELECT DISTINCT chunk_id, vector FROM embedding WHERE len(vector) = 64) WHERE chunk_id IN (SELECT doc_id FROM docs)""",
    "pack_rows": """SELECT CASE WHEN translation = (SELECT min(translation) FROM verse) THEN 'bundled' ELSE 'on_demand' END AS pack, 'verse' AS name, count(*) AS n FROM verse GROUP BY ALL
      UNION ALL SELECT CASE WHEN document = (SELECT min(document) FROM section) THEN 'bundled' ELSE 'on_demand' END, 'section', count(*) FROM section GROUP BY ALL
      UNION ALL SELECT 'on_demand', 'comments', count(*) FROM comments UNION ALL SELECT 'on_demand', 'crossref', count(*) FROM crossref""",
    "malformed_refs": """SELECT DISTINCT edge_id, src_book, src_chapter, src_verse FROM crossref WHERE src_book NOT IN (SELECT id FROM book) OR src_book IS NULL OR coalesce(src_chapter, 0) < 1 OR coalesce(src_verse, 0) < 1""",
    "finding_totals": f"""WITH {corpus_queries._DEVIATIONS}, v AS (SELECT DISTINCT * FROM verse), c AS (SELECT DISTINCT * FROM comments), s AS (SELECT DISTINCT * FROM section), x AS (SELECT DISTINCT * FROM crossref),
      p AS (SELECT unnest(proof_texts) AS p FROM s), q AS (SELECT upper(trim(p.book)) AS book, p.chapter AS chapter, p.verse_start AS verse FROM p UNION ALL SELECT upper(trim(p.book)), p.chapter, p.verse_end FROM p WHERE p.verse_end IS NOT NULL),
      f AS (SELECT 'verse' AS resource, 'error' AS s FROM v WHERE coalesce(text, '') = '' AND NOT coalesce(omitted, false) UNION ALL SELECT 'verse', 'flag' FROM v WHERE omitted AND source_note IS NULL UNION ALL SELECT 'verse', 'flag' FROM dev
        UNION ALL SELECT 'section', 'error' FROM q LEFT JOIN spine ON spine.book = q.book AND spine.chapter = q.chapter WHERE NOT coalesce(q.verse BETWEEN 1 AND spine.n, false)
        UNION ALL SELECT 'comments', 'error' FROM c LEFT JOIN spine ON spine.book = c.book AND spine.chapter = c.chapter WHERE NOT coalesce(c.verse_start BETWEEN 0 AND spine.n, false)
        UNION ALL SELECT 'comments', 'error' FROM c WHERE {corpus_queries._strip("coalesce(text, '')")} = '' UNION ALL SELECT 'comments', 'flag' FROM c WHERE length(text) >= 12000
        UNION ALL SELECT 'crossref', 'flag' FROM x WHERE src_resolves = 0 UNION ALL SELECT 'crossref', 'flag' FROM x WHERE tgt_resolves = 0)
      SELECT resource, count(*) FILTER (WHERE s = 'error') AS error_total, count(*) FILTER (WHERE s = 'flag') AS flag_total FROM f GROUP BY resource""",
}
