"""Scoped subsets, acknowledgements and the manifest of a release."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUNDLE_LIMIT = 200 * 1024 * 1024


def split(df: DataFrame, bundled: Column, out: str = "pack") -> DataFrame:
    """Every row in one of two disjoint packs."""
    return df.withColumn(out, F.when(F.coalesce(bundled, F.lit(False)), "bundled").otherwise("on_demand"))


def sizes(df: DataFrame, pack: str, size: Column, limit: int = BUNDLE_LIMIT) -> DataFrame:
    """(pack, n_rows, bytes, over_limit)."""
    rows = df.groupBy(pack).agg(F.count("*").alias("n_rows"), F.sum(size).alias("bytes"))
    return rows.withColumn("over_limit", (F.col(pack) == "bundled") & (F.col("bytes") > limit))


def scoped(df: DataFrame, dimension: str, wanted: list[str], order: list[str]) -> DataFrame:
    """Rows of the wanted scopes, in a stable order."""
    return df.filter(F.col(dimension).isin(wanted)).orderBy(*order)


def stable_copy(df: DataFrame, key: list[str] | None, path: str) -> None:
    """A copy in the order of its key, or else of all columns."""
    df.repartitionByRange(*(key or df.columns)).sortWithinPartitions(*(key or df.columns)).write.mode("overwrite").parquet(path)


def acknowledgements(parts: list[DataFrame]) -> DataFrame:
    """(resource, id, name, license, attribution) of all parts; columns a part lacks are null."""
    wanted = ("resource", "id", "name", "license", "attribution")
    every = None
    for p in parts:
        p = p.select(*[F.col(c).cast("string") if c in p.columns else F.lit(None).cast("string").alias(c) for c in wanted])
        every = p if every is None else every.unionByName(p)
    return every.distinct()


def files(spark, path: str) -> DataFrame:
    """(path, bytes, sha256) of every file below ``path``, hashed where the files are read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return rows.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def combined_checksum(file_rows: DataFrame) -> DataFrame:
    """One digest over the sorted digests of the files (a manifest's worth of rows)."""
    return file_rows.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), ""), 256).alias("sha256"))


def manifest(file_rows: DataFrame, acknowledged: DataFrame, ship_ready: bool = False) -> str:
    """The manifest as JSON: files and acknowledgements, a few rows each."""
    as_dicts = lambda df: [r.asDict() for r in df.collect()]
    packed = sorted(as_dicts(file_rows), key=lambda r: r["path"])
    body = {
        "ship_ready": ship_ready,
        "total_bytes": sum(r["bytes"] for r in packed),
        "files": packed,
        "acknowledgements": sorted(as_dicts(acknowledged), key=lambda r: (r["resource"] or "", r["id"] or "")),
    }
    return json.dumps(body, indent=2, ensure_ascii=False)


def section_rows(section: DataFrame) -> DataFrame:
    """Sections as stored: 0-based order, empty titles and proofs null, proofs as JSON with their fields in alphabetical order."""
    from pyspark.sql import Window

    rows = section.select("document", "key", "ord", "title", "text", "proof_texts").distinct()
    proofs = F.transform("proof_texts", lambda p: F.struct(p["book"].alias("book"), p["chapter"].alias("chapter"), p["verse_end"].alias("verse_end"), p["verse_start"].alias("verse_start")))
    position = F.row_number().over(Window.partitionBy("document").orderBy("ord", "key", "text")) - 1
    return rows.select("document", "key", position.alias("position"), F.nullif("title", F.lit("")).alias("title"), F.when(F.size("proof_texts") > 0, F.to_json(proofs)).alias("proofs"))
