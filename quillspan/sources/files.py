"""Scans of source files: whole texts, numbered lines, zip members, digests, snapshots, SQLite."""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillspan import shared


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): every file as one string, a byte-order mark off."""
    rows = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    return rows.withColumn("text", F.regexp_replace("text", "^﻿", ""))


def texts(spark: SparkSession, items: dict[str, str]) -> DataFrame:
    """The same from strings already at hand."""
    return spark.createDataFrame(list(items.items()), "path string, text string")


def lines(df: DataFrame) -> DataFrame:
    """(path, lineno, line): numbered from 1; splits where Python's line splitting does."""
    parts = F.split("text", "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
    rows = df.select("path", F.posexplode(parts).alias("at", "line"), F.size(parts).alias("n"))
    return rows.filter(~((F.col("line") == "") & (F.col("at") + 1 == F.col("n")))).select("path", (F.col("at") + 1).alias("lineno"), "line")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256), hashed on the executors."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return rows.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def model_provenance(spark: SparkSession, folder: str, name: str, revision: str) -> DataFrame:
    """(name, revision, n_files, bytes, sha256) of a model's files: the digest is over their sorted 'path:digest' lines, paths within the folder."""
    rows = digests(spark, folder).withColumn("at", F.regexp_replace("path", r"^.*?/" + re.escape(folder.rstrip("/").rsplit("/", 1)[-1]) + "/", ""))
    lines_ = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "at", "sha256"))), "\n")
    made = rows.agg(F.count("*").alias("n_files"), F.sum("bytes").alias("bytes"), F.sha2(lines_, 256).alias("sha256"))
    return made.select(F.lit(name).alias("name"), F.lit(revision).alias("revision"), "n_files", "bytes", "sha256")


def zip_members(spark: SparkSession, path: str, pattern: str = r"\.(?:usfm|sfm)$", member: str | None = None) -> DataFrame:
    """(path, member, text) of the zip's members whose name matches, or of the one named, by name."""
    wanted = re.compile(pattern, re.I)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for p, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    names = sorted(n for n in z.namelist() if (n == member if member else wanted.search(n)))
                    rows += [(p, n, z.read(n).decode("utf-8-sig", "replace")) for n in names]
            yield pd.DataFrame(rows, columns=["path", "member", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, member string, text string")


def in_canon(members: DataFrame, books: DataFrame) -> DataFrame:
    """Members whose book marker names a book of ``books`` (column id)."""
    marked = members.withColumn("book", F.upper(F.regexp_extract("text", r"(?m)^\s*\\id\s+(\S+)", 1)))
    return marked.join(F.broadcast(books.select(F.col("id").alias("book")).distinct()), "book", "left_semi") if _few(books) else marked.join(books.select(F.col("id").alias("book")), "book", "left_semi")


def _few(df: DataFrame, most: int = 10_000) -> bool:
    return df.limit(most + 1).count() <= most


def fetch(url: str, dest: str, timeout: float = 60.0) -> str:
    """Download a file and return its digest. Runs on the driver."""
    from urllib.request import urlopen

    with urlopen(url, timeout=timeout) as answer:  # noqa: S310
        body = answer.read()
    os.makedirs(os.path.dirname(dest), exist_ok=True)
    with open(dest, "wb") as f:
        f.write(body)
    return hashlib.sha256(body).hexdigest()


def snapshot(sources: dict[str, dict], directory: str, force: bool = False, get=fetch) -> dict[str, dict]:
    """Fetch what is missing (or all, if forced), hash what is there, and write the manifest.

    ``sources``: id -> {url, file, version, license}. The same inputs give the same manifest.
    """
    out = {}
    for name in sorted(sources):
        source = sources[name]
        dest = os.path.join(directory, source["file"])
        if force or not os.path.exists(dest):
            digest = get(source["url"], dest)
        else:
            with open(dest, "rb") as f:
                digest = hashlib.file_digest(f, "sha256").hexdigest()
        out[name] = {**source, "sha256": digest, "bytes": os.path.getsize(dest)}
    with open(os.path.join(directory, "manifest.json"), "w", encoding="utf-8") as f:
        json.dump(out, f, indent=2, sort_keys=True)
    return out


def require(directory: str, mandatory: list[str], optional: list[str]) -> list[str]:
    """The optional files that are missing; a missing mandatory one is an error."""
    lost = [f for f in mandatory if not os.path.exists(os.path.join(directory, f))]
    if lost:
        raise FileNotFoundError(f"missing inputs: {', '.join(lost)}")
    return [f for f in optional if not os.path.exists(os.path.join(directory, f))]


def sqlite_table(spark: SparkSession, path: str, query: str, schema: str) -> DataFrame:
    """Rows of a query on each SQLite file that the path names, read on the executors, a task a file, and passed on in batches."""
    import sqlite3

    names = [f.name for f in StructType.fromDDL(schema)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for content in pdf["content"]:
                db = sqlite3.connect(":memory:")
                db.deserialize(content)
                rows = db.execute(query)
                while batch := rows.fetchmany(10_000):
                    yield pd.DataFrame(batch, columns=names, dtype=object)
                db.close()

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, schema)


def prior_vectors(spark: SparkSession, path: str, dim: int) -> DataFrame | None:
    """Stored vectors of the right length, or None where the path holds nothing. Any other failure is raised: it must not cost a full encoding."""
    return spark.read.parquet(path).filter(F.size("vector") == dim) if shared.exists(spark, path) else None
