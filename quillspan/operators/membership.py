"""Joins that decide membership: existence in ranges, orphans, reconciliation, division."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spine(verse: DataFrame) -> DataFrame:
    """(book, chapter, n_verses): what the verse table itself holds."""
    return verse.groupBy("book", "chapter").agg(F.max("verse_end").alias("n_verses"))


def resolves(df: DataFrame, spine_df: DataFrame, book: str, chapter: str, verse: Column, out: str, allow_zero: bool = False) -> DataFrame:
    """Whether (book, chapter, verse) lies on the spine; verse 0 stands for a whole chapter if allowed."""
    s = spine_df.select(F.col("book").alias("spine_book"), F.col("chapter").alias("spine_chapter"), F.col("n_verses").alias("spine_length"))
    hit = F.col("spine_length").isNotNull() & (verse >= (0 if allow_zero else 1)) & (verse <= F.col("spine_length"))
    joined = df.join(s, (df[book] == F.col("spine_book")) & (df[chapter] == F.col("spine_chapter")), "left")
    return joined.withColumn(out, F.coalesce(hit, F.lit(False))).drop("spine_book", "spine_chapter", "spine_length")


def malformed(df: DataFrame, books: DataFrame, book: str, chapter: str, verse: Column) -> DataFrame:
    """Rows whose reference is none under any numbering: an unknown book, or a chapter or verse below one. ``books``: (book)."""
    known = books.select(F.col("book").alias("_known")).distinct()
    joined = df.join(known, df[book] == F.col("_known"), "left")
    return joined.filter(F.col("_known").isNull() | ~F.coalesce((joined[chapter] >= 1) & (verse >= 1), F.lit(False))).drop("_known")


def range_hits(refs: DataFrame, ranges: DataFrame, keys: list[str], point: str, start: str, end: str, how: str = "left_semi") -> DataFrame:
    """References whose point lies in a range with equal keys (left_semi), or in none (left_anti)."""
    r = ranges.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(start).alias("_s"), F.col(end).alias("_e"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys]) & F.col(point).between(F.col("_s"), F.col("_e"))
    return refs.join(r, on, how)


def orphans_with_fallback(df: DataFrame, key: str, fallback: Column, known: DataFrame, known_key: str) -> DataFrame:
    """Distinct keys unknown both as they are and in their fallback form."""
    k = known.select(F.col(known_key).alias("_k")).distinct()
    first = df.select(key).distinct().join(k, F.col(key) == F.col("_k"), "left_anti")
    return first.withColumn("_f", fallback).join(k, F.col("_f") == F.col("_k"), "left_anti").drop("_f")


def first_match(left: DataFrame, right: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """Left rows with the first matching right row's value; misses keep null."""
    best = right.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").select(*keys, value)
    return left.join(best, keys, "left")


def reconciled(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, status): both, left_only or right_only."""
    a = left.select(*keys).distinct().withColumn("_l", F.lit(True))
    b = right.select(*keys).distinct().withColumn("_r", F.lit(True))
    status = F.when(F.col("_l").isNotNull() & F.col("_r").isNotNull(), "both").when(F.col("_l").isNotNull(), "left_only").otherwise("right_only")
    return a.join(b, keys, "full_outer").select(*keys, status.alias("status"))


def in_all(df: DataFrame, keys: list[str], member: str, of: DataFrame) -> DataFrame:
    """Keys that occur with every member of ``of`` (relational division)."""
    n = of.select(member).distinct().agg(F.count("*").alias("_all"))
    have = df.join(of.select(member).distinct(), member, "left_semi").groupBy(*keys).agg(F.countDistinct(member).alias("_have"))
    return have.join(F.broadcast(n), F.col("_have") == F.col("_all")).select(*keys)


def injected(df: DataFrame, expected: DataFrame, keys: list[str], defaults: dict[str, Column]) -> DataFrame:
    """``df`` with a synthesized row for every expected key it lacks."""
    missing = expected.join(df.select(*keys).distinct(), keys, "left_anti")
    filled = missing.select(*[F.col(c) if c in keys else defaults.get(c, F.lit(None)).cast(df.schema[c].dataType).alias(c) for c in df.columns])
    return df.unionByName(filled)


def closest_name(df: DataFrame, text: str, known: DataFrame, name: str, number: str, most: int = 3) -> DataFrame:
    """The known name nearest to the text: exact, or within max(1, length // 4) edits and ``most``; the first of equals. ``known`` is a small lookup, held to 10,000 rows."""
    if known.limit(10_001).count() > 10_000:
        raise ValueError("the lookup is too large to compare with every text")
    k = known.select(F.col(name).alias("_name"), F.col(number).alias(number))
    texts = df.select(text).distinct()
    near = texts.join(F.broadcast(k), F.abs(F.length(text) - F.length("_name")) <= most)
    near = near.withColumn("edits", F.levenshtein(F.col(text), F.col("_name"), most)).filter(F.col("edits").between(0, F.greatest(F.lit(1), F.floor(F.length(text) / 4))))
    best = near.withColumn("_n", F.row_number().over(Window.partitionBy(text).orderBy("edits", number))).filter("_n = 1")
    return df.join(best.select(text, F.col("_name").alias("matched"), number, "edits"), text, "left")
