"""Brute-force retrieval over unit vectors and the checks around it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, v: acc + v)


def top_k(df: DataFrame, id_col: str, vector_col: str, query: list[float], k: int = 5) -> DataFrame:
    """(id, score) of the k vectors with the largest dot product, ties by id.

    Batches are multiplied in numpy and cut to their own k best before the only shuffle.
    """
    q = np.asarray(query, np.float64)
    kind = df.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            pdf = pdf[[v is not None and len(v) == len(q) for v in pdf["v"]]]
            if len(pdf):
                score = np.round(np.stack(pdf["v"].to_list()).astype(np.float64) @ q, 6)
                out = pd.DataFrame({"id": pdf["id"].to_numpy(), "score": score})
                yield out.sort_values(["score", "id"], ascending=[False, True]).head(k)

    best = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).mapInPandas(run, f"id {kind}, score double")
    return best.orderBy(F.col("score").desc(), "id").limit(k).withColumnRenamed("id", id_col)


def loaded(chunk: DataFrame, embedding: DataFrame, dim: int) -> DataFrame:
    """Chunks with their vectors: inner, of the right length, exact repeats once."""
    vectors = embedding.filter(F.size("vector") == dim).select("chunk_id", "vector").distinct()
    return chunk.join(vectors, chunk["id"] == vectors["chunk_id"])


def compared(a: DataFrame, b: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """One row (n, max_abs_diff, min_cosine) over the vectors with equal ids."""
    x = a.select(id_col, F.col(vector_col).alias("_a"))
    y = b.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_b"))
    both = x.join(y, F.col(id_col) == F.col("_id"))
    diff = F.array_max(F.zip_with("_a", "_b", lambda p, q: F.abs(p.cast("double") - q.cast("double"))))
    cos = F.try_divide(dot(F.col("_a"), F.col("_b")), F.sqrt(dot(F.col("_a"), F.col("_a")) * dot(F.col("_b"), F.col("_b"))))  # null for a vector of zeros
    return both.agg(F.count("*").alias("n"), F.round(F.max(diff), 6).alias("max_abs_diff"), F.round(F.min(cos), 6).alias("min_cosine"))


def smoke(hits: DataFrame, query: str, predicate: Column) -> DataFrame:
    """(query, passed, n_hits): a query passes if any of its hits satisfies the predicate."""
    return hits.agg(F.coalesce(F.max(predicate), F.lit(False)).alias("passed"), F.count("*").alias("n_hits")).select(F.lit(query).alias("query"), "passed", "n_hits")
