"""Inverted index with recomputable statistics, and scoring over it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspan import shared
from quillspan.functions import text as tx
from quillspan.operators.ordered import dense_ids

K1, B = 1.5, 0.75


def documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, tokens, len): a row for every document, with no tokens too."""
    rows = df.select(F.col(id_col).alias("doc"), F.coalesce(tx.tokens(F.col(text_col)), F.array().cast("array<string>")).alias("tokens"))
    return rows.withColumn("len", F.size("tokens"))


def postings(docs: DataFrame) -> DataFrame:
    """(term, doc, tf)."""
    return docs.select("doc", F.explode("tokens").alias("term")).groupBy("term", "doc").agg(F.count("*").alias("tf"))


def terms(posts: DataFrame) -> DataFrame:
    """(term, df, term_id): ids are dense in code-point order."""
    return dense_ids(posts.groupBy("term").agg(F.count("*").alias("df")), ["term"], "term_id")


def stats(docs: DataFrame) -> DataFrame:
    """(key, value) rows: n_docs, avgdl, total_tokens, vocab_size, k1, b."""
    # tokens are made once: all sums come from the terms' counts, and the number of documents needs no tokens
    counts = docs.select(F.explode("tokens").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    one = docs.agg(F.count("*").alias("n_docs")).crossJoin(counts.agg(F.count("*").alias("vocab"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")))  # one row each
    avgdl = F.when(F.col("n_docs") > 0, F.col("total") / F.col("n_docs")).otherwise(0.0)
    pairs = [("n_docs", F.col("n_docs")), ("avgdl", F.round(avgdl, 6)), ("total_tokens", F.col("total")), ("vocab_size", F.col("vocab")), ("k1", F.lit(K1)), ("b", F.lit(B))]
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("double").alias("value")) for k, v in pairs])).alias("x")).select("x.key", "x.value")


def scored(docs: DataFrame, query: list[str]) -> DataFrame:
    """(doc, score) of the documents that hold a query term (the reference stores the constants only; the formula is the usual one).

    The query's postings alone are counted: the term filter runs before the explosion's shuffle.
    """
    want = F.array(*[F.lit(t) for t in sorted(set(query))])
    # written out with the query's tokens only, as the scores and the corpus scalars both need every document's length
    docs = shared.materialize(docs.select("doc", "len", F.filter("tokens", lambda t: F.array_contains(want, t)).alias("tokens")), "scored")
    hits = docs.select("doc", "len", F.explode("tokens").alias("term"))
    tf = hits.groupBy("doc", "len", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    one = docs.agg(F.count("*").alias("n"), F.avg("len").alias("avgdl"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("avgdl")))
    return tf.join(F.broadcast(df), "term").join(F.broadcast(one)).groupBy("doc").agg(F.round(F.sum(weight), 6).alias("score"))


def fused(rankings: list[DataFrame], id_col: str, rank_col: str, k: int = 60) -> DataFrame:
    """Reciprocal-rank fusion of several rankings (an extension)."""
    every = None
    for r in rankings:
        part = r.select(F.col(id_col), (1 / (k + F.col(rank_col))).alias("part"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy(id_col).agg(F.round(F.sum("part"), 6).alias("score"))
