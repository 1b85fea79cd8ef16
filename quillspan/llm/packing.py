"""Filling containers of fixed capacity with items, as few containers as possible.

Items are grouped by length, of which there are at most ``capacity``: so the whole corpus, however
large, is packed from one histogram. Minimum bin slack: each window is opened by the longest
remaining length, and a bitset subset-sum over the remaining lengths finds the multiset that fills
it closest to capacity; its counts are backtracked, and it is used as often as the counts allow.
The resulting patterns say, for each length, which ranks of its items go to which containers;
ranks come from counters within the partitions plus offsets between them, so no length, however
frequent, is gathered in one task.

An item over the capacity is cut into full containers and a remainder, which is packed like any
other. Defined results: null and empty texts take no room, so their container is null; an empty table gives no
rows; repeated rows are items of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan import shared
from quillspan.llm import bpe

CAPACITY = 2048


def fill_window(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset with the largest remaining length that comes closest to ``capacity``.

    ``counts``: remaining items by length. Bit s of the set is on if the lengths looked at so far can
    make the sum s; each length enters in portions of 1, 2, 4, ... copies.
    """
    lengths = sorted((n for n, c in counts.items() if c and n <= capacity), reverse=True)
    if not lengths:
        return {}
    first = lengths[0]
    room = capacity - first
    mask, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []
    for n in lengths:
        if n > room:
            continue
        left, portion = min(counts[n] - (n == first), room // n), 1
        while left > 0:
            take = min(portion, left)
            grown = (reach | reach << take * n) & mask
            if grown != reach:
                steps.append((reach, n, take))
                reach = grown
            left, portion = left - take, portion * 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    chosen = {first: 1}
    for before, n, take in reversed(steps):
        if not before >> total & 1:
            chosen[n] = chosen.get(n, 0) + take
            total -= take * n
    return chosen


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times used, copies by length), in order of use, until no item is left."""
    counts = {n: c for n, c in histogram.items() if c > 0 and n > 0}
    made = []
    while counts:
        chosen = fill_window(counts, capacity)
        times = min(counts[n] // c for n, c in chosen.items())
        made.append((times, chosen))
        for n, c in chosen.items():
            counts[n] -= times * c
            if not counts[n]:
                del counts[n]
    return made


@dataclass
class _Slots:
    """Which ranks of each length go to which containers: runs of ranks, ordered by length and first rank in one key."""

    key: np.ndarray
    begin: np.ndarray
    times: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, made: list[tuple[int, dict[int, int]]]) -> _Slots:
        rows, base, taken = [], 0, {}
        for times, chosen in made:
            for n, copies in chosen.items():
                rows.append((n, taken.get(n, 0), times, base))
                taken[n] = taken.get(n, 0) + times * copies
            base += times
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return cls(table[:, 0] << 48 | table[:, 1], *table[:, 1:].T)

    def container(self, tokens: np.ndarray, rank: np.ndarray) -> pa.Array:
        """The container of each item of a length with a rank; null for those that take no room."""
        tokens, rank = tokens.astype(np.int64), rank.astype(np.int64)
        at = np.maximum(np.searchsorted(self.key, tokens << 48 | rank, "right") - 1, 0)
        if not len(self.key):
            return pa.nulls(len(tokens), pa.int64())
        return pa.array(self.first[at] + (rank - self.begin[at]) % self.times[at], mask=tokens == 0)


def _measured(df: DataFrame, id_col: str, text_col: str, capacity: int, path: str) -> DataFrame:
    """(id, piece, tokens, part, rank): an item's rank counts the items of its length in its partition."""
    make = bpe.ship(df.sparkSession, path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, part = make(), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for pdf in frames:
            texts = [t if isinstance(t, str) else None for t in pdf["text"]]
            tokens = np.concatenate([enc.lengths(texts[a:b]) for a, b in bpe.slices(texts)]) if texts else np.zeros(0, np.int64)
            pieces = np.maximum(1, -(-tokens // capacity))
            row = np.repeat(np.arange(len(tokens)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            size = np.minimum(capacity, tokens[row] - piece * capacity)
            within = pd.Series(size).groupby(size).cumcount().to_numpy()
            rank = within + seen[size]
            np.add.at(seen, size, 1)
            yield pd.DataFrame({"id": pdf["id"].to_numpy()[row], "piece": piece.astype(np.int32), "tokens": size.astype(np.int32), "part": np.int32(part), "rank": rank})

    schema = T.StructType(
        [
            T.StructField("id", df.schema[id_col].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("tokens", T.IntegerType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("rank", T.LongType()),
        ]
    )
    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, schema)


def pack(df: DataFrame, id_col: str, text_col: str, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """(id, piece, tokens, container) of every item; containers count from 0."""
    from pyspark.sql import Window

    spark = df.sparkSession
    items = shared.materialize(_measured(df, id_col, text_col, capacity, path or bpe.vocabulary_path()), "pack-items")
    counted = items.groupBy("tokens", "part").agg(F.count("*").alias("n"))
    histogram = {r["tokens"]: r["n"] for r in counted.groupBy("tokens").agg(F.sum("n").alias("n")).collect()}  # at most capacity + 1 rows
    slots = _Slots.of(patterns(histogram, capacity))
    held = spark.sparkContext.broadcast(slots)  # a few thousand whatever the corpus: lengths are at most `capacity`
    over = Window.partitionBy("tokens").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.withColumn("offset", F.coalesce(F.sum("n").over(over), F.lit(0))).drop("n")
    ranked = items.join(offsets, ["tokens", "part"]).withColumn("rank", F.col("rank") + F.col("offset"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = held.value.container(batch.column("tokens").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("id", "piece", "tokens")] + [got], names=["id", "piece", "tokens", "container"])

    placed = ranked.select("id", "piece", "tokens", "rank").mapInArrow(place, f"id {items.schema['id'].dataType.simpleString()}, piece int, tokens int, container long")
    return placed.withColumnRenamed("id", id_col)


def invariants(df: DataFrame, id_col: str, placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: items, items placed, items with pieces lacking or split without need, containers over capacity, and whether there are at most 1 % more than the tokens need."""
    by_item = placed.groupBy(id_col).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces"), F.max("piece").alias("last"))
    needed = F.greatest(F.lit(1), F.ceil(F.col("tokens") / capacity))
    items = by_item.agg(F.count("*").alias("n_placed"), F.count_if((F.col("pieces") != needed) | (F.col("last") != F.col("pieces") - 1)).alias("n_badly_split"), F.sum("tokens").alias("tokens"))
    filled = placed.filter(F.col("container").isNotNull()).groupBy("container").agg(F.sum("tokens").alias("filled"))
    used = filled.agg(F.count("*").alias("n"), F.count_if(F.col("filled") > capacity).alias("n_overfull"))
    every = df.agg(F.count_distinct(id_col).alias("n_items"))
    few = F.coalesce(F.col("n") <= F.ceil(F.col("tokens") / capacity * 1.01), F.lit(True)).alias("few_containers")
    return every.crossJoin(items).crossJoin(used).select("n_items", "n_placed", "n_badly_split", "n_overfull", few)  # one row each
