"""Commentaries with verse anchors in mixed markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspan.functions import citations
from quillspan.operators import ordered
from quillspan.sources import markup


def parse(files: DataFrame, commentator: str, books: DataFrame | None = None, codes: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(comments, flags) of volumes (path, text).

    Prose before a chapter's first anchor belongs to that anchor and begins its numbering; an anchor that names no
    verse leaves the one before in force. Keys that repeat get the number of their occurrence. ``books``: (id, ord).
    """
    events = markup.events(files, ("scripCom", "p"), container=r"div[1-4]", anchor="scripCom")
    events = events.withColumn("ref", F.when(F.col("tag") == "scripCom", citations.anchor(F.element_at("attrs", "parsed"), codes)))
    mark = F.when(F.col("ref").isNotNull(), F.struct("ref", F.element_at("attrs", "passage").alias("passage"), "pos"))
    where = ["path", "container"]
    prose = ordered.anchored(events.withColumn("mark", mark), where, F.col("mark"), [F.col("pos")], "at").filter((F.col("tag") == "p") & (F.col("text") != ""))
    stranded = prose.filter(F.col("at").isNull()).groupBy("path", "title").agg(F.count("*").alias("n"))
    flags = stranded.select(F.col("path").alias("volume"), F.concat(F.col("n").cast("string"), F.lit(" paragraphs without an anchor under "), F.coalesce("title", F.lit(""))).alias("flag"))
    bad = events.filter((F.col("tag") == "scripCom") & F.col("ref").isNull())
    flags = flags.unionByName(bad.select(F.col("path").alias("volume"), F.concat(F.lit("anchor names no verse: "), F.coalesce(F.element_at("attrs", "parsed"), F.lit(""))).alias("flag")))
    flags = flags.unionByName(events.filter(F.col("tag") == "!error").select(F.col("path").alias("volume"), F.concat(F.lit("no XML: "), "text").alias("flag")))
    rows = prose.filter(F.col("at").isNotNull()).withColumn("mark_pos", F.col("at.pos"))
    rows = rows.withColumn("para_index", F.row_number().over(Window.partitionBy(*where, "mark_pos").orderBy("pos")))
    rows = rows.select("path", "container", "pos", "text", "para_index", F.trim(F.regexp_replace(F.coalesce("at.passage", F.lit("")), r"\s+", " ")).alias("passage"), "at.ref.*")
    span = F.when(F.col("verse_end") != F.col("verse_start"), F.concat(F.lit("-"), F.col("verse_end").cast("string"))).otherwise("")
    base = F.concat("book", F.lit("."), F.col("chapter").cast("string"), F.lit("."), F.col("verse_start").cast("string"), span, F.lit("#p"), F.col("para_index").cast("string"))
    rows = rows.withColumns({"base": base, "end": F.coalesce("verse_end", "verse_start")})
    if books is not None:
        rows = rows.join(books.select(F.col("id").alias("book"), F.col("ord").alias("book_ord")), "book", "left").withColumn("book_ord", F.coalesce("book_ord", F.lit(999)))
    else:
        rows = rows.withColumn("book_ord", F.lit(0))
    order = ["book_ord", "book", "chapter", "verse_start", "end", "para_index", "path", "container", "pos"]
    rows = ordered.occurrence_suffix(rows, "base", [F.col(c) for c in order], "key")
    flags = flags.unionByName(rows.filter(F.col("key") != F.col("base")).groupBy(F.lit("").alias("volume")).agg(F.concat(F.countDistinct("base").cast("string"), F.lit(" keys repeat")).alias("flag")))
    rows = ordered.dense_ids(rows, order, "ord")
    out = rows.select(
        F.lit(commentator).alias("commentator"), "key", F.col("ord").cast("long").alias("ord"), "book", "chapter", "verse_start", F.col("end").alias("verse_end"), F.col("chapter_level").cast("int").alias("chapter_level"),
        "para_index", "passage", F.lit(None).cast("string").alias("component"), F.col("path").alias("volume"), "text", F.sha2("text", 256).alias("checksum"),
    )
    return out, flags
