"""Cross-reference lists in tab-separated form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspan.functions import citations
from quillspan.functions.text import strip
from quillspan.sources.files import lines


def parse(files: DataFrame, codes: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(edges, rejects) of files with a header line and rows source, target, votes.

    Rank counts the accepted rows of a source verse in file order. A reject keeps its line number, text and reason.
    """
    rows = lines(files).filter((F.col("lineno") > 1) & (strip(F.col("line")) != ""))
    cols = F.split("line", "\t", -1)
    get = lambda i: F.get(cols, F.lit(i))
    votes = F.when(F.trim(get(2)).rlike(r"^[+-]?[0-9]+$"), F.trim(get(2)).try_cast("int"))
    rows = rows.withColumns({"n": F.size(cols), "votes": votes, "src": citations.osis_point(get(0), codes), "tgt": citations.osis_range(get(1), codes)})
    reason = (
        F.when(F.col("n") < 3, "too few columns").when(F.col("votes").isNull(), "non-integer votes").when(F.col("src").isNull(), "unparseable source").when(F.col("tgt").isNull(), "unparseable target")
    )
    rows = rows.withColumn("reason", reason)
    rejects = rows.filter(F.col("reason").isNotNull()).select("path", "lineno", "line", "reason")
    good = rows.filter(F.col("reason").isNull())
    rank = F.row_number().over(Window.partitionBy("path", "src").orderBy("lineno"))
    good = good.select(
        "path", F.col("src.book").alias("src_book"), F.col("src.chapter").alias("src_chapter"), F.col("src.verse").alias("src_verse"), F.col("tgt.start.book").alias("tgt_book"),
        F.col("tgt.start.chapter").alias("tgt_chapter"), F.col("tgt.start.verse").alias("tgt_verse"), F.col("tgt.end.book").alias("tgt_end_book"), F.col("tgt.end.chapter").alias("tgt_end_chapter"),
        F.col("tgt.end.verse").alias("tgt_end_verse"), (F.col("tgt.start") != F.col("tgt.end")).cast("int").alias("is_range"), "votes", rank.alias("rank"),
    )
    return good, rejects
