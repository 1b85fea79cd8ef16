"""Queries on references to records that do not exist, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspan.operators import orphans
from quillspan.sources.tables import table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphans(table(spark, sf_dir, "crossref"), table(spark, sf_dir, "section"), table(spark, sf_dir, "verse"))


def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_counts(p5_found(spark, sf_dir))


QUERIES = {"p5_found": p5_found, "p5_counts": p5_counts}

_FOUND = """
WITH deliveries AS (
  SELECT DISTINCT edge_id, upper(trim(src_book)) AS sb, src_chapter AS sc, src_verse AS sv, upper(trim(tgt_book)) AS tb, tgt_chapter AS tc,
         tgt_verse AS tv, upper(trim(tgt_end_book)) AS eb, tgt_end_chapter AS ec, tgt_end_verse AS ev, loaded_at FROM crossref),
last AS (SELECT * FROM deliveries QUALIFY row_number() OVER (PARTITION BY edge_id ORDER BY loaded_at DESC) = 1),
proofs AS (SELECT document || '/' || key AS row_key, loaded_at, unnest(proof_texts) AS p FROM section),
ends AS (
  SELECT 'crossref' AS ref_table, CAST(edge_id AS VARCHAR) AS row_key, loaded_at, sb AS book, sc AS chapter, sv AS verse FROM last
  UNION SELECT 'crossref', CAST(edge_id AS VARCHAR), loaded_at, tb, tc, tv FROM last
  UNION SELECT 'crossref', CAST(edge_id AS VARCHAR), loaded_at, eb, ec, ev FROM last
  UNION SELECT 'section', row_key, loaded_at, upper(trim(p.book)), p.chapter, p.verse_start FROM proofs
  UNION SELECT 'section', row_key, loaded_at, upper(trim(p.book)), p.chapter, coalesce(p.verse_end, p.verse_start) FROM proofs),
held AS (
  SELECT upper(trim(book)) AS book, chapter, withdrawn_at, loaded_at, unnest(generate_series(verse_start, coalesce(verse_end, verse_start))) AS verse FROM verse),
points AS (SELECT book, chapter, verse, min(loaded_at) FILTER (WHERE withdrawn_at IS NULL) AS since FROM held GROUP BY ALL),
judged AS (
  SELECT e.*, CASE WHEN p.book IS NULL THEN 'missing' WHEN p.since IS NULL THEN 'deleted' WHEN p.since > e.loaded_at THEN 'late' END AS state
  FROM ends e LEFT JOIN points p ON e.book = p.book AND e.chapter = p.chapter AND e.verse = p.verse
  WHERE e.book IS NOT NULL AND e.chapter IS NOT NULL AND e.verse IS NOT NULL),
found AS (
  SELECT DISTINCT ref_table, row_key, book || '.' || chapter || '.' || verse AS point, state, strftime(loaded_at, '%Y-%m') AS ref_month
  FROM judged WHERE state IS NOT NULL)
"""
SQL = {
    "p5_found": _FOUND + "SELECT * FROM found",
    "p5_counts": _FOUND + "SELECT ref_table, ref_month, state, count(*) AS n FROM found GROUP BY ALL",
}
