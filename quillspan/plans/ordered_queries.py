"""Queries of the ordered and membership operators on the corpus tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan.functions import text as tx
from quillspan.functions.refs import book_id
from quillspan.operators import membership, ordered
from quillspan.sources.tables import table

c = F.col


def _verse(spark: SparkSession, d: str) -> DataFrame:
    """Distinct verses, the first delivered of a key."""
    rows = table(spark, d, "verse").select("translation", "book", "chapter", "verse_start", "verse_end", "text", "omitted", "loaded_at").distinct()
    return ordered.first_seen(rows, ["translation", "book", "chapter", "verse_start"], [c("loaded_at"), c("verse_end"), c("text")])


def pericope_windows(spark: SparkSession, d: str) -> DataFrame:
    keys = ["translation", "book", "chapter"]
    rows = ordered.pericopes(_verse(spark, d), keys, [c("verse_start")])
    return ordered.rolled_up(rows, keys, "verse_start", "verse_end", "text").select(*keys, c("window").cast("int").alias("window"), "verse_start", "verse_end", "n_rows", "text")


def rank_in_source(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "crossref").filter(c("votes").isNotNull())
    rows = rows.select("source", book_id(c("src_book")).alias("book"), "src_chapter", "src_verse", "edge_id", "votes", "loaded_at").distinct()
    keys = ["source", "book", "src_chapter", "src_verse"]
    return ordered.spread_rank(rows, keys, [c("loaded_at"), c("edge_id"), c("votes")], "position").select(*keys, "edge_id", "votes", c("position").cast("long").alias("position"))


def occurrence_suffix(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "comments").select(F.concat(c("book"), F.lit("."), c("chapter").cast("string")).alias("base"), "commentator", "key", "ord", "text").distinct()
    rows = rows.withColumn("anchor", F.concat_ws("/", "commentator", "base"))
    return ordered.occurrence_suffix(rows, "anchor", [c("ord"), c("key"), c("text")], "unique_anchor").select("commentator", "key", "ord", "unique_anchor")


def first_seen_dedupe(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter(c("text").isNotNull()).select("doc_id", tx.checksum(c("text")).alias("sha"))
    return ordered.first_seen(rows, ["sha"], [c("doc_id")]).select("doc_id", "sha")


def keep_longest(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").filter(c("text").isNotNull()).select("source", "resource_type", "doc_id", "text")
    kept = ordered.keep_longest(rows, ["source", "resource_type"], "text", [c("doc_id")])
    return kept.select("source", "resource_type", "doc_id", F.length("text").cast("long").alias("n"))


def coverage_gaps(spark: SparkSession, d: str) -> DataFrame:
    return ordered.gaps(_verse(spark, d), ["translation", "book", "chapter"], "verse_start", "verse_end")


def missing_sequence(spark: SparkSession, d: str) -> DataFrame:
    return ordered.missing_numbers(table(spark, d, "comments"), ["commentator", "book"], "chapter")


def sequence_repair(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "section").filter(c("question").isNotNull()).select("document", "key", "ord", "question").distinct()
    fixed = ordered.repaired_sequence(rows, ["document"], "question", [c("ord"), c("key")])
    return fixed.select("document", "key", "question", c("number").cast("int").alias("number"), "repaired")


def forward_fill(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "comments").select("commentator", "key", "ord", "passage", "text").distinct()
    order = [c("ord"), c("key"), c("text")]
    rows = ordered.spread_forward(rows, ["commentator"], "passage", order, "carried", "anchor")
    return rows.select("commentator", "key", "ord", "carried", "anchor")


def segment_bounds(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "section").filter(c("lords_day").isNotNull()).groupBy("document", "lords_day").agg(F.min("ord").alias("begin"))
    last = table(spark, d, "section").groupBy("document").agg((F.max("ord") + 1).alias("stop"))
    rows = rows.join(last, "document")
    return ordered.segments(rows, ["document"], "begin", c("stop"), [c("begin"), c("lords_day")]).select("document", "lords_day", "begin", "segment_end")


def canonical_order(spark: SparkSession, d: str) -> DataFrame:
    order = table(spark, d, "book").select(c("id").alias("book"), c("ord").alias("book_ord"))
    rows = _verse(spark, d).join(order, "book", "left").withColumn("book_ord", F.coalesce("book_ord", F.lit(999)))
    numbered = ordered.dense_ids(rows.select("translation", "book", "book_ord", "chapter", "verse_start"), ["translation", "book_ord", "book", "chapter", "verse_start"], "position")
    return numbered.select("translation", "book", "chapter", "verse_start", c("position").cast("long").alias("position"))


def strided_sample(spark: SparkSession, d: str) -> DataFrame:
    return ordered.strided_sample(table(spark, d, "documents").select("doc_id", "source"), ["doc_id"], 400)


def even_sample(spark: SparkSession, d: str) -> DataFrame:
    return ordered.even_sample(table(spark, d, "documents").select("doc_id", "lang"), ["doc_id"], 12, forced=c("lang") == "la")


def _proofs(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "section").select("document", "key", F.explode("proof_texts").alias("p"))
    return p.select("document", "key", book_id(c("p.book")).alias("book"), c("p.chapter").alias("chapter"), c("p.verse_start").alias("verse")).distinct()


def range_semi(spark: SparkSession, d: str) -> DataFrame:
    """References and the translations that have their verse."""
    ranges = table(spark, d, "verse").select("translation", c("book").alias("_b"), c("chapter").alias("_c"), c("verse_start").alias("_s"), c("verse_end").alias("_e")).distinct()
    hits = _proofs(spark, d).join(ranges, (c("book") == c("_b")) & (c("chapter") == c("_c")) & c("verse").between(c("_s"), c("_e")))
    return hits.drop("_b", "_c", "_s", "_e").distinct()


def range_anti(spark: SparkSession, d: str) -> DataFrame:
    return membership.range_hits(_proofs(spark, d), table(spark, d, "verse"), ["book", "chapter"], "verse", "verse_start", "verse_end", "left_anti")


def resolves_in_none(spark: SparkSession, d: str) -> DataFrame:
    hits = range_semi(spark, d).groupBy("document", "key", "book", "chapter", "verse").agg(F.countDistinct("translation").alias("n"))
    every = _proofs(spark, d).join(hits, ["document", "key", "book", "chapter", "verse"], "left")
    return every.groupBy(F.coalesce("n", F.lit(0).cast("long")).alias("n_translations")).agg(F.count("*").alias("n_refs"))


def orphan_anti(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chunk").select("id").distinct().join(table(spark, d, "embedding").select(c("chunk_id").alias("id")), "id", "left_anti")


def orphan_fallback(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "comments").select(F.concat_ws("/", "commentator", "key").alias("ref"))
    chunk = table(spark, d, "chunk").filter(c("resource_type") == "commentary").select(F.concat_ws("/", "source", "key").alias("ref"))
    return membership.orphans_with_fallback(keys, "ref", F.regexp_replace("ref", "~[0-9]+$", ""), chunk, "ref")


def except_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "crossref").select(c("tgt_book").alias("book")).subtract(table(spark, d, "book").select(c("id").alias("book")))


def set_operations(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "chunk").select("book", "chapter").filter(c("book").isNotNull()).distinct()
    b = table(spark, d, "verse").select("book", "chapter").distinct()
    tag = lambda df, s: df.groupBy().agg(F.count("*").alias("n")).select(F.lit(s).alias("operation"), "n")
    return tag(a.union(b).distinct(), "union").unionByName(tag(a.intersect(b), "intersect")).unionByName(tag(a.subtract(b), "except"))


def first_match_left_join(spark: SparkSession, d: str) -> DataFrame:
    chapters = table(spark, d, "verse").select("book", "chapter").distinct()
    notes = table(spark, d, "comments").select("book", "chapter", "ord", "commentator", "key", F.concat_ws("/", "commentator", "key").alias("note")).distinct()
    return membership.first_match(chapters, notes, ["book", "chapter"], [c("ord"), c("commentator"), c("key")], "note").select("book", "chapter", "note")


def full_outer_reconcile(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "comments").select(c("commentator").alias("source"), "key")
    b = table(spark, d, "chunk").filter(c("resource_type") == "commentary").select("source", "key")
    return membership.reconciled(a, b, ["source", "key"])


def inject_missing(spark: SparkSession, d: str) -> DataFrame:
    rows = _verse(spark, d).select("translation", "book", "chapter", "verse_start", "text", "omitted")
    spine = membership.spine(table(spark, d, "verse")).select("book", "chapter", F.explode(F.sequence(F.lit(1), "n_verses")).alias("verse_start"))
    expected = spine.crossJoin(rows.select("translation").distinct())  # the numbers of the canon for each translation: what is to be there
    full = membership.injected(rows, expected, ["translation", "book", "chapter", "verse_start"], {"text": F.lit(""), "omitted": F.lit(True)})
    return full.groupBy("translation", "book").agg(F.count("*").alias("n"), F.count_if("omitted").alias("n_omitted"))


def division_all(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "verse").select("translation", "book", "chapter", "verse_start")
    return membership.in_all(rows, ["book", "chapter", "verse_start"], "translation", rows)


def edge_resolution(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "crossref").select("edge_id", book_id(c("src_book")).alias("sb"), "src_chapter", "src_verse", book_id(c("tgt_book")).alias("tb"), "tgt_chapter", "tgt_verse", book_id(c("tgt_end_book")).alias("eb"), "tgt_end_chapter", "tgt_end_verse").distinct()
    s = membership.spine(table(spark, d, "verse"))
    rows = membership.resolves(rows, s, "sb", "src_chapter", c("src_verse"), "src_ok")
    rows = membership.resolves(rows, s, "tb", "tgt_chapter", c("tgt_verse"), "start_ok")
    rows = membership.resolves(rows, s, "eb", "tgt_end_chapter", c("tgt_end_verse"), "end_ok")
    return rows.select("edge_id", c("src_ok").cast("int").alias("src_resolves"), (c("start_ok") & c("end_ok")).cast("int").alias("tgt_resolves"))


def fuzzy_match(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "book").select(F.regexp_replace(F.upper("name"), "[^A-Z]", "").alias("name"), "ord")
    texts = names.select(F.concat(F.substring("name", 1, 2), F.lit("X"), F.substring("name", 4, 100)).alias("seen"))
    return membership.closest_name(texts.distinct(), "seen", names, "name", "ord").select("seen", "matched", "ord", c("edits").cast("int").alias("edits"))


QUERIES = {
    f.__name__: f
    for f in (
        pericope_windows, rank_in_source, occurrence_suffix, first_seen_dedupe, keep_longest, coverage_gaps, missing_sequence, sequence_repair, forward_fill, segment_bounds,
        canonical_order, strided_sample, even_sample, range_semi, range_anti, resolves_in_none, orphan_anti, orphan_fallback, except_keys, set_operations, first_match_left_join,
        full_outer_reconcile, inject_missing, division_all, edge_resolution, fuzzy_match,
    )
}

_VERSE = """
v AS (SELECT * FROM (SELECT DISTINCT translation, book, chapter, verse_start, verse_end, text, omitted, loaded_at FROM verse)
  QUALIFY row_number() OVER (PARTITION BY translation, book, chapter, verse_start ORDER BY loaded_at, verse_end, text) = 1)"""
_PROOFS = """
p AS (SELECT DISTINCT document, key, upper(trim(p.book)) AS book, p.chapter AS chapter, p.verse_start AS verse FROM (SELECT document, key, unnest(proof_texts) AS p FROM section))"""
_SPINE = "spine AS (SELECT book, chapter, max(verse_end) AS n FROM verse GROUP BY ALL)"
SQL = {
    "pericope_windows": f"""WITH {_VERSE},
      r AS (SELECT *, row_number() OVER (PARTITION BY translation, book, chapter ORDER BY verse_start) AS rn, count(*) OVER (PARTITION BY translation, book, chapter) AS n FROM v),
      w AS (SELECT *, least((rn - 1) // 10, CASE WHEN n < 10 THEN 1 WHEN n % 10 < 4 THEN n // 10 ELSE n // 10 + 1 END - 1)::INT AS w FROM r)
      SELECT translation, book, chapter, w AS "window", min(verse_start) AS verse_start, arg_max(verse_end, rn) AS verse_end, count(*) AS n_rows,
             coalesce(string_agg(text, ' ' ORDER BY rn) FILTER (WHERE coalesce(text, '') <> ''), '') AS text FROM w GROUP BY ALL""",
    "rank_in_source": """WITH r AS (SELECT DISTINCT source, upper(trim(src_book)) AS book, src_chapter, src_verse, edge_id, votes, loaded_at FROM crossref WHERE votes IS NOT NULL)
      SELECT source, book, src_chapter, src_verse, edge_id, votes, row_number() OVER (PARTITION BY source, book, src_chapter, src_verse ORDER BY loaded_at, edge_id, votes) AS position FROM r""",
    "occurrence_suffix": """WITH r AS (SELECT DISTINCT commentator, key, ord, text, commentator || '/' || book || '.' || chapter AS anchor FROM comments),
      n AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY ord, key, text) AS n FROM r)
      SELECT commentator, key, ord, CASE WHEN n > 1 THEN anchor || '~' || n ELSE anchor END AS unique_anchor FROM n""",
    "first_seen_dedupe": "SELECT min(doc_id) AS doc_id, sha256(text) AS sha FROM documents WHERE text IS NOT NULL GROUP BY text",
    "keep_longest": """SELECT source, resource_type, doc_id, length(text) AS n FROM documents WHERE text IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY source, resource_type ORDER BY length(text) DESC, doc_id) = 1""",
    "coverage_gaps": f"""WITH {_VERSE}, s AS (SELECT DISTINCT translation, book, chapter, unnest(generate_series(verse_start, verse_end)) AS n FROM v),
      g AS (SELECT *, coalesce(lag(n) OVER (PARTITION BY translation, book, chapter ORDER BY n), 0) AS b FROM s WHERE n >= 1)
      SELECT translation, book, chapter, (b + 1)::INT AS gap_start, (n - 1)::INT AS gap_end FROM g WHERE n > b + 1""",
    "missing_sequence": """WITH m AS (SELECT commentator, book, max(chapter) AS e FROM comments GROUP BY ALL), x AS (SELECT commentator, book, unnest(generate_series(1, e))::INT AS missing FROM m)
      SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM comments s WHERE s.commentator = x.commentator AND s.book = x.book AND s.chapter = x.missing)""",
    "sequence_repair": """WITH r AS (SELECT DISTINCT document, key, ord, question FROM section WHERE question IS NOT NULL),
      n AS (SELECT *, (first_value(question) OVER w + row_number() OVER w - 1)::INT AS number FROM r WINDOW w AS (PARTITION BY document ORDER BY ord, key))
      SELECT document, key, question, number, question <> number AS repaired FROM n""",
    "forward_fill": """WITH r AS (SELECT DISTINCT commentator, key, ord, passage, text FROM comments),
      f AS (SELECT *, last_value(passage IGNORE NULLS) OVER (PARTITION BY commentator ORDER BY ord, key, text ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried,
        first_value(passage IGNORE NULLS) OVER (PARTITION BY commentator ORDER BY ord, key, text ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nxt FROM r)
      SELECT commentator, key, ord, carried, coalesce(carried, nxt) AS anchor FROM f""",
    "segment_bounds": """WITH r AS (SELECT document, lords_day, min(ord) AS b FROM section WHERE lords_day IS NOT NULL GROUP BY ALL), l AS (SELECT document, max(ord) + 1 AS stop FROM section GROUP BY ALL)
      SELECT r.document, lords_day, b AS "begin", coalesce(lead(b) OVER (PARTITION BY r.document ORDER BY b, lords_day), stop) AS segment_end FROM r JOIN l ON r.document = l.document""",
    "canonical_order": f"""WITH {_VERSE} SELECT translation, v.book, chapter, verse_start, row_number() OVER (ORDER BY translation, coalesce(b.ord, 999), v.book, chapter, verse_start) - 1 AS position
      FROM v LEFT JOIN book b ON v.book = b.id""",
    "strided_sample": """WITH n AS (SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents)
      SELECT doc_id, source FROM n WHERE i % greatest(1, n // 400) = 0 AND i // greatest(1, n // 400) < 400""",
    "even_sample": """WITH n AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents),
      k AS (SELECT DISTINCT (g * (SELECT count(*) FROM documents)) // 12 AS i FROM generate_series(0, 11) t(g))
      SELECT doc_id, lang FROM n WHERE i IN (SELECT i FROM k) OR lang = 'la'""",
    "range_semi": f"""WITH {_PROOFS}, t AS (SELECT DISTINCT translation FROM verse)
      SELECT p.*, t.translation FROM p, t WHERE EXISTS (SELECT 1 FROM verse v WHERE v.translation = t.translation AND v.book = p.book AND v.chapter = p.chapter AND p.verse BETWEEN v.verse_start AND v.verse_end)""",
    "range_anti": f"""WITH {_PROOFS} SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM verse v WHERE v.book = p.book AND v.chapter = p.chapter AND p.verse BETWEEN v.verse_start AND v.verse_end)""",
    "resolves_in_none": f"""WITH {_PROOFS}, n AS (SELECT p.*, (SELECT count(DISTINCT translation) FROM verse v WHERE v.book = p.book AND v.chapter = p.chapter AND p.verse BETWEEN v.verse_start AND v.verse_end) AS n FROM p)
      SELECT n AS n_translations, count(*) AS n_refs FROM n GROUP BY ALL""",
    "orphan_anti": "SELECT DISTINCT id FROM chunk WHERE id NOT IN (SELECT chunk_id FROM embedding WHERE chunk_id IS NOT NULL)",
    "orphan_fallback": """WITH k AS (SELECT DISTINCT source || '/' || key AS ref FROM chunk WHERE resource_type = 'commentary' AND key IS NOT NULL), r AS (SELECT DISTINCT commentator || '/' || key AS ref FROM comments)
      SELECT ref FROM r WHERE ref NOT IN (SELECT ref FROM k) AND regexp_replace(ref, '~[0-9]+$', '') NOT IN (SELECT ref FROM k)""",
    "except_keys": "SELECT tgt_book AS book FROM crossref EXCEPT SELECT id FROM book",
    "set_operations": """WITH a AS (SELECT DISTINCT book, chapter FROM chunk WHERE book IS NOT NULL), b AS (SELECT DISTINCT book, chapter FROM verse)
      SELECT 'union' AS operation, count(*) AS n FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'intersect', count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)
      UNION ALL SELECT 'except', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""",
    "first_match_left_join": """WITH ch AS (SELECT DISTINCT book, chapter FROM verse), n AS (SELECT book, chapter, commentator || '/' || key AS note FROM comments QUALIFY row_number() OVER (PARTITION BY book, chapter ORDER BY ord, commentator, key) = 1)
      SELECT ch.book, ch.chapter, note FROM ch LEFT JOIN n ON ch.book = n.book AND ch.chapter = n.chapter""",
    "full_outer_reconcile": """WITH a AS (SELECT DISTINCT commentator AS source, key FROM comments), b AS (SELECT DISTINCT source, key FROM chunk WHERE resource_type = 'commentary')
      SELECT coalesce(a.source, b.source) AS source, coalesce(a.key, b.key) AS key, CASE WHEN a.source IS NULL THEN 'right_only' WHEN b.source IS NULL THEN 'left_only' ELSE 'both' END AS status
      FROM a FULL JOIN b ON a.source = b.source AND a.key = b.key""",
    "inject_missing": f"""WITH {_VERSE}, {_SPINE}, x AS (SELECT t.translation, book, chapter, unnest(generate_series(1, n)) AS vs FROM spine, (SELECT DISTINCT translation FROM v) t),
      f AS (SELECT translation, book, omitted FROM v UNION ALL SELECT translation, book, true FROM x WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.translation = x.translation AND v.book = x.book AND v.chapter = x.chapter AND v.verse_start = x.vs))
      SELECT translation, book, count(*) AS n, count(*) FILTER (WHERE omitted) AS n_omitted FROM f GROUP BY ALL""",
    "division_all": "SELECT book, chapter, verse_start FROM verse GROUP BY ALL HAVING count(DISTINCT translation) = (SELECT count(DISTINCT translation) FROM verse)",
    "edge_resolution": f"""WITH {_SPINE}, r AS (SELECT DISTINCT edge_id, upper(trim(src_book)) AS sb, src_chapter, src_verse, upper(trim(tgt_book)) AS tb, tgt_chapter, tgt_verse, upper(trim(tgt_end_book)) AS eb, tgt_end_chapter, tgt_end_verse FROM crossref)
      SELECT edge_id, (a.n IS NOT NULL AND src_verse BETWEEN 1 AND a.n)::INT AS src_resolves,
             ((b.n IS NOT NULL AND tgt_verse BETWEEN 1 AND b.n) AND (e.n IS NOT NULL AND tgt_end_verse BETWEEN 1 AND e.n))::INT AS tgt_resolves
      FROM r LEFT JOIN spine a ON sb = a.book AND src_chapter = a.chapter LEFT JOIN spine b ON tb = b.book AND tgt_chapter = b.chapter LEFT JOIN spine e ON eb = e.book AND tgt_end_chapter = e.chapter""",
    "fuzzy_match": """WITH n AS (SELECT regexp_replace(upper(name), '[^A-Z]', '', 'g') AS name, ord FROM book), s AS (SELECT DISTINCT substr(name, 1, 2) || 'X' || substr(name, 4, 100) AS seen FROM n),
      m AS (SELECT seen, name, ord, levenshtein(seen, name) AS e FROM s, n WHERE abs(length(seen) - length(name)) <= 3 AND levenshtein(seen, name) <= least(3, greatest(1, length(seen) // 4))
        QUALIFY row_number() OVER (PARTITION BY seen ORDER BY e, ord) = 1)
      SELECT s.seen, name AS matched, ord, e::INT AS edits FROM s LEFT JOIN m ON s.seen = m.seen""",
}
