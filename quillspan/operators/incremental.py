"""Incremental encoding: vectors are reused by content id, only the rest is encoded."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Encoder(Protocol):
    dim: int
    revision: str

    def encode(self, texts: list[str]) -> np.ndarray: ...


class HashingEncoder:
    """Deterministic stand-in for a model: signed counts of hashed tokens, unit length. For tests."""

    def __init__(self, dim: int = 64) -> None:
        self.dim, self.revision = dim, f"hashing-{dim}"

    def encode(self, texts: list[str]) -> np.ndarray:
        import xxhash

        out = np.zeros((len(texts), self.dim), np.float32)
        for i, text in enumerate(texts):
            for token in text.lower().split():
                h = xxhash.xxh64_intdigest(token)
                out[i, h % self.dim] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)


def query_instruction(model: Encoder) -> str:
    """What the model wants before a query; passages are encoded as they are."""
    return getattr(model, "query_instruction", "")


def query_vector(model: Encoder, query: str) -> list[float]:
    return [float(x) for x in model.encode([query_instruction(model) + query])[0]]


def partition(current: DataFrame, prior: DataFrame, id_col: str) -> DataFrame:
    """(id, action): reused, encoded, or dropped from the prior set."""
    a = current.select(id_col).distinct().withColumn("_c", F.lit(True))
    b = prior.select(id_col).distinct().withColumn("_p", F.lit(True))
    action = F.when(F.col("_c").isNull(), "dropped").when(F.col("_p").isNull(), "encoded").otherwise("reused")
    return a.join(b, id_col, "full_outer").select(id_col, action.alias("action"))


def encoded(chunks: DataFrame, id_col: str, text_col: str, make: Callable[[], Encoder], batch: int = 64) -> DataFrame:
    """(id, vector); the model is made once per worker and fed in batches."""
    kind = chunks.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in frames:
            for i in range(0, len(pdf), batch):
                part = pdf.iloc[i : i + batch]
                yield pd.DataFrame({"id": part["id"].to_numpy(), "vector": list(model.encode([t or "" for t in part["text"]]))})

    return chunks.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, vector array<float>").withColumnRenamed("id", id_col)


def incremental(chunks: DataFrame, prior: DataFrame | None, prior_revision: str, id_col: str, text_col: str, make: Callable[[], Encoder]) -> tuple[DataFrame, DataFrame]:
    """(vectors of all chunks, one row n_total, n_reused, n_encoded, n_dropped).

    Prior vectors of another revision or length are not used; then nothing counts as dropped.
    """
    model = make()
    usable = None
    if prior is not None and prior_revision == model.revision:
        usable = prior.filter(F.size("vector") == model.dim).select(id_col, "vector")
    if usable is None:
        vectors = encoded(chunks, id_col, text_col, make)
        n = chunks.agg(F.count("*").alias("n_total"))
        return vectors, n.select("n_total", F.lit(0).cast("long").alias("n_reused"), F.col("n_total").alias("n_encoded"), F.lit(0).cast("long").alias("n_dropped"))
    fresh = chunks.join(usable.select(id_col), id_col, "left_anti")
    vectors = usable.join(chunks.select(id_col), id_col, "left_semi").unionByName(encoded(fresh, id_col, text_col, make))
    count = lambda a: F.count_if(F.col("action") == a)
    counts = partition(chunks, usable, id_col).agg(
        count("reused").alias("n_reused"), count("encoded").alias("n_encoded"), count("dropped").alias("n_dropped")
    )
    return vectors, counts.select((F.col("n_reused") + F.col("n_encoded")).alias("n_total"), "n_reused", "n_encoded", "n_dropped")
