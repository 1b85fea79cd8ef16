"""Tables written out in the formats of their sources: zipped book files, edge lists, chapter JSON, anchored markup.

Each is the inverse of a parser. A file holds what its source holds in one file (a translation, a document, a volume of a
commentary), so it is made in one task; the number of files follows the data.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspan import shared


def write_files(files: DataFrame, folder: str) -> str:
    """Write (name, content) rows as files below ``folder``, from the executors; returns the folder."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = shared.open_file(folder)
        fs.create_dir(base, recursive=True)
        for pdf in frames:
            for name, content in zip(pdf["name"], pdf["content"]):
                with fs.open_output_stream(f"{base}/{name}") as out:
                    out.write(content)
            yield pdf[["name"]]

    files.select("name", F.col("content").cast("binary").alias("content")).mapInPandas(run, "name string").count()
    return folder


def _lines(df: DataFrame, keys: list[str], line: Column, order: list[str]) -> DataFrame:
    """One text for each key: its lines in order."""
    parts = F.array_sort(F.collect_list(F.struct(*order, line.alias("line"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("text"))


def book_files(verse: DataFrame) -> DataFrame:
    """(translation, book, text): marked-up book files of distinct verses."""
    span = F.when(F.col("verse_end") > F.col("verse_start"), F.concat(F.lit("-"), F.col("verse_end").cast("string"))).otherwise("")
    line = F.concat(F.lit("\\v "), F.col("verse_start").cast("string"), span, F.lit(" "), F.coalesce("text", F.lit("")))
    title = F.when(F.coalesce("superscription", F.lit("")) != "", F.concat(F.lit("\\d "), "superscription", F.lit("\n"))).otherwise("")
    chapters = _lines(verse, ["translation", "book", "chapter"], F.concat(title, line), ["verse_start"])
    chapters = chapters.withColumn("text", F.concat(F.lit("\\c "), F.col("chapter").cast("string"), F.lit("\n\\p\n"), "text"))
    books = _lines(chapters, ["translation", "book"], F.col("text"), ["chapter"])
    return books.withColumn("text", F.concat(F.lit("\\id "), "book", F.lit("\n"), "text"))


def zipped(files: DataFrame, key: str, name: str, text: str, suffix: str) -> DataFrame:
    """(name, content): one zip of all its texts for each key."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for member, body in sorted(zip(pdf[name], pdf[text])):
                z.writestr(f"{member}{suffix}", body)
        return pd.DataFrame({"name": [f"{pdf[key].iloc[0]}.zip"], "content": [out.getvalue()]})

    return files.select(key, name, text).groupBy(key).applyInPandas(pack, "name string, content binary")


def edge_list(crossref: DataFrame, folder: str) -> str:
    """Edges as tab-separated source, target and votes, each file with its header line."""
    point = lambda p: F.concat_ws(".", f"{p}_book", F.col(f"{p}_chapter").cast("string"), F.col(f"{p}_verse").cast("string"))
    target = F.when(point("tgt") == point("tgt_end"), point("tgt")).otherwise(F.concat_ws("-", point("tgt"), point("tgt_end")))
    rows = crossref.select(point("src").alias("From"), target.alias("To"), F.coalesce(F.col("votes").cast("string"), F.lit("none")).alias("Votes"))
    rows.write.mode("overwrite").options(sep="\t", header="true", quote="\u0000", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(folder)
    return folder


def chapter_json(section: DataFrame) -> DataFrame:
    """(document, text): chapters with their sections as JSON."""
    parts = F.array_sort(F.collect_list(F.struct(F.col("section").alias("id"), F.coalesce("text", F.lit("")).alias("text"))))
    chapters = section.groupBy("document", "chapter").agg(F.min("title").alias("title"), parts.alias("sections"))
    every = F.array_sort(F.collect_list(F.struct(F.col("chapter").alias("id"), "title", "sections")))
    body = F.to_json(F.struct(F.struct(F.struct(every.alias("chapters")).alias("eng")).alias("languages")))
    return chapters.groupBy("document").agg(body.alias("text"))


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def anchored_markup(comments: DataFrame) -> DataFrame:
    """(commentator, book, text): a volume a book, a division a chapter, an anchor before each paragraph."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    place = F.concat_ws("|", F.lit(""), "book", F.col("chapter").cast("string"), zero("verse_start"), F.col("chapter").cast("string"), zero("verse_end"))
    line = F.concat(F.lit('<scripCom parsed="'), place, F.lit('"/><p>'), _escaped(F.coalesce("text", F.lit(""))), F.lit("</p>"))
    chapters = _lines(comments, ["commentator", "book", "chapter"], line, ["ord", "key"])
    chapters = chapters.withColumn("text", F.concat(F.lit('<div2 title="'), F.col("chapter").cast("string"), F.lit('">'), "text", F.lit("</div2>")))
    volumes = _lines(chapters, ["commentator", "book"], F.col("text"), ["chapter"])
    return volumes.withColumn("text", F.concat(F.lit("<ThML><div1>"), "text", F.lit("</div1></ThML>")))
