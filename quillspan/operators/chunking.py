"""Retrieval chunks from the resource tables. Lossy steps split rows: chunks and skips with their reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspan.functions import text as tx
from quillspan.operators import ordered

COLUMNS = ("id", "resource_type", "source", "anchor", "book", "chapter", "verse_start", "verse_end", "key", "text", "text_checksum", "truncated")


def _made(df: DataFrame, resource_type: str, source: Column, anchor: Column, text: Column, **refs: Column) -> DataFrame:
    cut, truncated = tx.capped(text)
    kinds = {"book": "string", "chapter": "int", "verse_start": "int", "verse_end": "int", "key": "string"}
    rows = df.select(
        F.lit(resource_type).alias("resource_type"), source.alias("source"), anchor.alias("anchor"), *[refs.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds.items()], cut.alias("text"), truncated.alias("truncated")
    )
    rows = rows.withColumn("text_checksum", tx.checksum(F.col("text")))
    return rows.withColumn("id", tx.chunk_id(F.col("resource_type"), F.col("source"), F.col("anchor"), F.col("text_checksum"))).select(*COLUMNS)


def empty(text: Column) -> Column:
    return F.coalesce(tx.strip(text), F.lit("")) == ""


def scripture_windows(verse: DataFrame, size: int = 10, least: int = 4) -> DataFrame:
    """One row per window of a chapter: translation, book, chapter, verse_start, verse_end, n_rows, text."""
    rows = verse.select("translation", "book", "chapter", "verse_start", "verse_end", F.when(F.col("omitted"), "").otherwise(F.coalesce("text", F.lit(""))).alias("text"), "loaded_at").distinct()
    keys = ["translation", "book", "chapter"]
    rows = ordered.first_seen(rows, [*keys, "verse_start"], [F.col("loaded_at"), F.col("verse_end"), F.col("text")])
    return ordered.rolled_up(ordered.pericopes(rows, keys, [F.col("verse_start")], size, least), keys, "verse_start", "verse_end", "text")


def scripture(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    span = F.when(F.col("verse_end") != F.col("verse_start"), F.concat(F.lit("-"), F.col("verse_end").cast("string"))).otherwise("")
    anchor = F.concat(F.col("translation"), F.lit(":"), F.col("book"), F.lit(" "), F.col("chapter").cast("string"), F.lit(":"), F.col("verse_start").cast("string"), span)
    rows = windows.withColumn("anchor", anchor)
    kept = rows.filter(~empty(F.col("text")))
    refs = {c: F.col(c) for c in ("book", "chapter", "verse_start", "verse_end")}
    return _made(kept, "scripture", F.col("translation"), F.col("anchor"), F.col("text"), **refs), skipped(rows, "scripture", "anchor", "empty window")


def skipped(rows: DataFrame, resource_type: str, anchor: str, reason: str) -> DataFrame:
    return rows.filter(empty(F.col("text"))).select(F.lit(resource_type).alias("resource_type"), F.col(anchor).alias("anchor"), F.lit(reason).alias("reason"))


def commentary(comments: DataFrame) -> tuple[DataFrame, DataFrame]:
    rows = comments.select("commentator", "key", "ord", "book", "chapter", "verse_start", "verse_end", "passage", "text").distinct()
    anchor = F.concat(F.col("commentator"), F.lit(":"), F.col("key"), F.lit("#"), F.col("ord").cast("string"))
    named = tx.present(F.col("passage"), F.col("key"), F.concat_ws(" ", "book", F.col("chapter").cast("string")))
    rows = rows.withColumns({"anchor": anchor, "named": F.concat_ws(":", "commentator", named)})
    zero = lambda c: F.nullif(F.col(c), F.lit(0))
    made = _made(
        rows.filter(~empty(F.col("text"))), "commentary", F.col("commentator"), F.col("anchor"), F.col("text"),
        book=F.col("book"), chapter=F.col("chapter"), verse_start=zero("verse_start"), verse_end=zero("verse_end"), key=F.col("key"),
    )
    return made, skipped(rows, "commentary", "named", "empty paragraph")


def confession(section: DataFrame, shortcodes: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``shortcodes``: (document, shortcode); a document without one goes by its id in capitals."""
    rows = section.select("document", "key", "title", "text").distinct()
    code = F.upper("document")
    if shortcodes is not None:
        rows = rows.join(shortcodes.select("document", "shortcode"), "document", "left")
        code = F.coalesce("shortcode", F.upper("document"))
    rows = rows.withColumn("anchor", F.concat_ws(" ", code, "key"))
    text = F.when(F.coalesce("title", F.lit("")) != "", F.concat_ws("\n", "title", "text")).otherwise(F.col("text"))
    made = _made(rows.filter(~empty(F.col("text"))), "confession", F.col("document"), F.col("anchor"), text, key=F.col("key"))
    return made, skipped(rows, "confession", "anchor", "empty section")


def lexicon(entry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries with English; ``entry``: lexicon, strongs, raw_key, lemma, translit, definition, derivation, kjv_def."""
    join = lambda sep, cols: F.array_join(F.filter(F.array(*[F.col(c) for c in cols]), lambda x: x.isNotNull() & (F.trim(x) != "")), sep)
    rows = entry.withColumns({"key": tx.present(F.col("strongs"), F.col("raw_key"), F.col("lemma")), "english": join(" ", ("definition", "derivation", "kjv_def")), "head": join(" ", ("lemma", "translit"))})
    rows = rows.withColumns({"anchor": F.concat(F.col("lexicon"), F.lit(":"), F.coalesce("key", F.lit(""))), "text": F.when(F.col("english") == "", "").otherwise(F.concat_ws(" — ", tx.present(F.col("head")), "english"))})
    made = _made(rows.filter(~empty(F.col("text"))), "lexicon", F.col("lexicon"), F.col("anchor"), F.col("text"), key=F.col("key"))
    return made, skipped(rows, "lexicon", "anchor", "no English definition")


def extracted(parts: list[tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """All chunks with type_ord in the order of the parts, and all skips."""
    chunks = skips = None
    for i, (made, skip) in enumerate(parts):
        made = made.withColumn("type_ord", F.lit(i))
        chunks = made if chunks is None else chunks.unionByName(made)
        skips = skip if skips is None else skips.unionByName(skip)
    return chunks, skips
