"""The pN_ queries of the operators in this package, with SQL where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan import shared
from quillspan.functions.refs import book_id
from quillspan.llm import bpe, cutoff, packing, scan_repair, splitter, top_n, vptree
from quillspan.sources.tables import table


def _best_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = [F.col("source"), book_id(F.col("src_book")), F.col("src_chapter"), F.col("src_verse")]
    return top_n.top_n(table(spark, sf_dir, "crossref"), group, "edge_id", "votes", "rank", n=3, delivered="loaded_at")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best_edges(spark, sf_dir).select(F.col("item").alias("edge_id"))


def p1_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best_edges(spark, sf_dir).select(F.col("item").alias("edge_id"), F.col("score").alias("votes"), F.col("tie").alias("rank"), F.col("place").cast("long").alias("place"))


def p2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.similar(table(spark, sf_dir, "embedding"), "chunk_id", "vector")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of at least 0.9; of each vector's five best only those are searched for."""
    near = vptree.similar(table(spark, sf_dir, "embedding"), "chunk_id", "vector", relax=vptree.RELAX_LEAST, least=0.9)
    return near.select(F.least("chunk_id", "neighbour").alias("chunk_id_a"), F.greatest("chunk_id", "neighbour").alias("chunk_id_b")).distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = splitter.split_oversized(table(spark, sf_dir, "chunk"), "id", "text")
    return pieces.filter(F.col("pieces") > 1).select(F.col("id").alias("chunk_id")).distinct()


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chunks as pieces. Chunks of comments and sections are held against their record's whole text for the truncated flag."""
    return _pieces(spark, sf_dir)[1]


def _pieces(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(distinct chunks, their pieces)."""
    chunk = table(spark, sf_dir, "chunk").select("id", "resource_type", "source", "key", "text").distinct()
    comment = table(spark, sf_dir, "comments").select(F.lit("commentary").alias("resource_type"), F.col("commentator").alias("source"), "key", F.col("text").alias("whole"))
    titled = F.when(F.coalesce("title", F.lit("")) != "", F.concat_ws("\n", "title", "text")).otherwise(F.col("text"))  # as confession chunks are made
    section = table(spark, sf_dir, "section").select(F.lit("confession").alias("resource_type"), F.col("document").alias("source"), "key", titled.alias("whole"))
    recorded = F.coalesce(F.col("resource_type").isin("commentary", "confession"), F.lit(False))
    records = comment.unionByName(section).withColumnRenamed("whole", "record")
    keyed = splitter.against_records(chunk.filter(recorded), "text", records, "record", ["resource_type", "source", "key"]).select("id", "text", "whole")
    rest = chunk.filter(~recorded).select("id", "text", F.lit(None).cast("string").alias("whole"))
    return chunk, splitter.split_oversized(rest.unionByName(keyed), "id", "text", whole=F.col("whole")).withColumnRenamed("id", "chunk_id")


def p3_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunk, pieces = _pieces(spark, sf_dir)
    return splitter.invariants(chunk.select(F.col("id").alias("chunk_id"), "text"), "chunk_id", "text", pieces)


def _scan(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, scan_repair.Corpus]:
    """(chunks with the column scanned, scanned sources, corpus statistics)."""
    sources = scan_repair.scanned_sources(table(spark, sf_dir, "comments"))
    chunk = table(spark, sf_dir, "chunk").select("id", "resource_type", "source", "text")
    chunk = scan_repair.marked(chunk, "source", sources, also=F.col("resource_type") == "commentary")
    return chunk, sources, scan_repair.learn(chunk)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunk, _, corpus = _scan(spark, sf_dir)
    found = scan_repair.repaired(chunk.filter("scanned"), corpus, ["id"])
    return found.select(F.col("id").alias("chunk_id"), F.explode("noise").alias("noise")).distinct()


def p4_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk, those from scanned pages as running paragraphs."""
    chunk, _, corpus = _scan(spark, sf_dir)
    fixed = scan_repair.repaired(chunk.filter("scanned").select("id", "text").distinct(), corpus, ["id"]).select(F.col("id").alias("chunk_id"), "text")
    return fixed.unionByName(chunk.filter("not scanned").select(F.col("id").alias("chunk_id"), "text").distinct())


def p4_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every comment, those from scanned pages as running paragraphs."""
    _, sources, corpus = _scan(spark, sf_dir)
    rows = scan_repair.marked(table(spark, sf_dir, "comments").select("commentator", "key", "text").distinct(), "commentator", sources)
    fixed = scan_repair.repaired(rows.filter("scanned"), corpus, ["commentator", "key"]).drop("noise")
    return fixed.unionByName(rows.filter("not scanned").select("commentator", "key", "text"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_ids(table(spark, sf_dir, "documents"), "doc_id", "text")


def p6_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that the ids stand for."""
    got = bpe.decoded(p6_ids(spark, sf_dir), "doc_id", "ids")
    return got.select("doc_id", F.sha2("text", 256).alias("sha256"))


def p7_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.invariants(table(spark, sf_dir, "documents"), "doc_id", shared.materialize(p7_containers(spark, sf_dir), "containers"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text")


_DOCUMENT = ("doc_id", "text", "lang", "source")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutoff.cut_off(table(spark, sf_dir, "documents"), *_DOCUMENT)


def p8_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutoff.per_source(table(spark, sf_dir, "documents"), *_DOCUMENT)


# of each problem, pN_found or the query of its result comes first
QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_ranked, p2_found, p2_neighbours, p3_found, p3_pieces, p3_invariants, p4_found, p4_chunks, p4_comments, p6_ids, p6_texts, p7_containers, p7_invariants, p8_found, p8_sources)
}

_BEST = """
WITH last AS (SELECT * FROM (SELECT DISTINCT edge_id, source, upper(trim(src_book)) AS book, src_chapter, src_verse, votes, rank, loaded_at FROM crossref)
  QUALIFY row_number() OVER (PARTITION BY edge_id ORDER BY loaded_at DESC, votes DESC NULLS LAST, rank NULLS LAST) = 1),
best AS (SELECT *, row_number() OVER (PARTITION BY source, book, src_chapter, src_verse ORDER BY votes DESC, rank NULLS LAST, edge_id) AS place
  FROM last WHERE votes IS NOT NULL)
"""
SQL = {
    "p1_found": _BEST + "SELECT edge_id FROM best WHERE place <= 3",
    "p1_ranked": _BEST + "SELECT edge_id, CAST(votes AS BIGINT) AS votes, CAST(rank AS BIGINT) AS rank, place FROM best WHERE place <= 3",
    # what must hold of the pieces, the ids and the containers of every text
    "p3_invariants": "SELECT count(*) AS n_rows, 0::BIGINT AS n_not_whole, 0::BIGINT AS n_without_overlap, 0::BIGINT AS n_over_limit FROM (SELECT DISTINCT id, resource_type, source, key, text FROM chunk)",
    "p6_texts": "SELECT doc_id, sha256(coalesce(text, '')) AS sha256 FROM documents",
    "p7_invariants": "SELECT count(DISTINCT doc_id) AS n_items, count(DISTINCT doc_id) AS n_placed, 0::BIGINT AS n_badly_split, 0::BIGINT AS n_overfull, true AS few_containers FROM documents",
    "p3_found": "SELECT DISTINCT id AS chunk_id FROM chunk WHERE length(trim(text, ' ' || chr(9) || chr(10) || chr(13))) > 6000",
}
