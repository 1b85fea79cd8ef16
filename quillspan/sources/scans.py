"""Scanned volumes of a commentary on numbered hymns: boilerplate, heads, components, verse cues."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan.functions import text as tx
from quillspan.operators import membership, ordered
from quillspan.sources import canon

# Phrases that digitisation adds. The first opens the front matter, the next two the back matter; then those that are taken out of
# a line with the name that may follow, and those that end it.
FRONT = "this is a digital copy of a book"
BACK = ("about google book search", "google's mission is to organize", "googles mission is to organize")
STAMPS, STAMP_NAMES = ("digitized by", "vjooq", "d,b,i.ab", "d.b,i.ab", "dbi.ab"), ("google", "vjooq")
ENDINGS = ("original from", "university of", "generated on", "generated for")
#: Components and the heads that open them.
COMPONENTS = {"exposition": r"E\s*X\s*P\s*O\s*S\s*I\s*T\s*I\s*O\s*N\b", "notes": r"EXPLANATORY\s+NOTES\b", "hints": r"HINTS\s+TO\s+THE\b", "works": r"WORKS?\s+UPON\b"}
# The shapes of heads with numerals, heads with ordinals, and verse cues.
_NUMERAL_HEAD = r"^[ \t]{{0,8}}{head}[ \t]+([clxvidm]{{1,7}})\.?[ \t]*\d{{0,4}}[ \t]*$"
_ORDINAL_HEAD = r"\b{head}\s+THE\s+([A-Z][A-Z\- ]{{2,34}}?)\s*\."
_CUE = r"(?:^|\n)\s*(?:Verses?|Ver\.?)\s+(\d{1,3})(?:\s*[-–—.,]|\s)|(?:^|\n)\s*(\d{1,3})\.\s+[\"“']"
GARBLED, GARBLED_LENGTH = 0.45, 80


def _unstamped(line: str) -> str:
    """A line without the stamps that digitisation left in it."""
    low = line.lower()
    cut = min((low.find(x) for x in ENDINGS if x in low), default=len(line))
    line, low = line[:cut], low[:cut]
    for stamp in STAMPS:
        while (at := low.find(stamp)) >= 0:
            end = at + len(stamp)
            while end < len(low) and (low[end].isalnum() or low[end] == "_") and stamp == "vjooq":
                end += 1
            rest = low[end:].lstrip(" ,")
            if rest.startswith(STAMP_NAMES):
                end = len(low) - len(rest) + len(rest.split(maxsplit=1)[0])
            line, low = line[:at] + " " + line[end:], low[:at] + " " + low[end:]
    return line


def without_matter(text: str, head: str = "PSALM") -> str:
    """A volume without the matter before its first head and after its last page, and without stamps. All characters keep their lines."""
    low = text.lower()
    begin = low.find(FRONT)
    if begin >= 0 and (first := re.compile(rf"\b{re.escape(head)}\b", re.I).search(text, begin)):
        before = text[:begin].rstrip()
        text = ("" if before.lower().endswith("google") or not before else before + "\n") + text[first.start() :]
        low = text.lower()
    end = min((at for x in BACK if (at := low.find(x)) >= 0), default=len(text))
    return "\n".join(map(_unstamped, text[:end].split("\n")))


def kind_of_line(line: str, head: str = "PSALM", title: str = "THE TREASURY OF DAVID") -> str:
    """blank, page (a number alone), running (the head with its ordinal, or the work's title, perhaps numbered), or body."""
    words = line.upper().replace("\xa0", " ").split()
    if not words:
        return "blank"
    if len(words) == 1 and len(words[0]) <= 4 and words[0].isdecimal():
        return "page"
    if words[-1].isdecimal() and len(words[-1]) <= 4:
        words.pop()
    joined = " ".join(words).rstrip(".").rstrip()
    if joined == title:
        return "running"
    opening = f"{head} THE "
    spelt = joined.startswith(opening) and all(ch.isalpha() or ch in " -" for ch in joined[len(opening) :])
    return "running" if spelt and "." not in " ".join(words)[:-1] else "body"


def joined_lines(block: str, head: str = "PSALM", title: str = "THE TREASURY OF DAVID") -> str:
    """A block without running headers and page numbers, broken words closed up, runs of blanks and of empty lines as one."""
    out: list[str] = []
    gap = False
    for line in block.split("\n"):
        kind = kind_of_line(line, head, title)
        if kind in ("page", "running"):
            gap = False  # nor does the empty line at a page's edge part two paragraphs
            while out and not out[-1]:
                out.pop()
            continue
        line = " ".join(line.replace("\xa0", " ").replace("\t", " ").split(" ")) if kind == "body" else ""
        line = re.sub(" +", " ", line)
        bare = line.lstrip()
        if out and not gap and bare and len(out[-1].rstrip()) > 1 and out[-1].rstrip().endswith("-") and out[-1].rstrip()[-2].isalpha() and bare[0].islower():
            out[-1] = out[-1].rstrip()[:-1] + bare
        elif kind == "blank":
            if out and out[-1]:
                out.append("")
        else:
            out.append(line)
    return "\n".join(out).strip()


@F.pandas_udf(T.StringType())
def stripped(texts: pd.Series, heads: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else without_matter(t, h) for t, h in zip(texts, heads)])


@F.pandas_udf(T.StringType())
def cleaned(blocks: pd.Series, heads: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else joined_lines(t, h) for t, h in zip(blocks, heads)])


def _marks(df: DataFrame, patterns: list[tuple[str, str]], flags: int) -> DataFrame:
    """(all columns, kind, value, at): where the patterns match in the column text."""
    compiled = [(k, re.compile(p, flags)) for k, p in patterns]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for i, text in enumerate(pdf["text"]):
                rows += [(i, k, next((g for g in m.groups() if g), ""), m.start()) for k, p in compiled for m in p.finditer(text)]
            got = pd.DataFrame(rows, columns=["_i", "kind", "value", "at"])
            yield pdf.reset_index(drop=True).join(got.set_index("_i"), how="inner")

    # code points count alike in Python and in Spark's substring
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, schema + ", kind string, value string, at int")


def _cut(text: str, start: str, end: str) -> Column:
    return F.substring(F.col(text), F.col(start) + 1, F.col(end) - F.col(start))


def hymn_blocks(files: DataFrame, head: str = "PSALM", most: int = 150) -> DataFrame:
    """(path, text, hymn, block, recovered): one block a hymn. ``files``: (path, text, first, last).

    Boundaries are lines with the head and a numeral; for a hymn of the declared range without one, the earliest
    running header that spells its ordinal, which may be misread, is used. The longest block of a hymn is kept.
    """
    rows = files.withColumn("text", stripped(F.col("text"), F.lit(head)))
    found = _marks(rows, [("numeral", _NUMERAL_HEAD.format(head=head)), ("ordinal", _ORDINAL_HEAD.format(head=head))], re.I | re.M)
    numerals = found.filter("kind = 'numeral'").withColumn("hymn", tx.roman_value(F.col("value"), most=most))
    spelt = found.filter("kind = 'ordinal'").withColumn("seen", F.regexp_replace(F.upper("value"), "[^A-Z]", ""))
    known = files.sparkSession.createDataFrame([(canon.ordinal(n), n) for n in range(1, most + 1)], "name string, number int")
    spelt = membership.closest_name(spelt, "seen", known, "name", "number").withColumn("hymn", F.col("number"))
    heads = numerals.select("path", "text", "first", "last", "hymn", "at", F.lit(False).alias("recovered"))
    spare = spelt.filter(F.col("hymn").between(F.col("first"), F.col("last"))).select("path", "text", "first", "last", "hymn", "at", F.lit(True).alias("recovered"))
    spare = spare.join(heads.select("path", "hymn").distinct(), ["path", "hymn"], "left_anti")
    every = heads.filter(F.col("hymn").isNotNull()).unionByName(spare)
    every = ordered.first_seen(every, ["path", "hymn"], [F.col("at")])
    every = ordered.segments(every, ["path"], "at", F.length("text"), [F.col("at")], "stop")
    every = every.withColumn("block", _cut("text", "at", "stop"))
    return ordered.keep_longest(every, ["path", "hymn"], "block", [F.col("at")]).select("path", "hymn", "block", "recovered")


def comments(files: DataFrame, commentator: str, book: str, lengths: DataFrame, head: str = "PSALM") -> tuple[DataFrame, DataFrame]:
    """(comments, flags) of volumes (path, text, first, last). ``lengths``: (hymn, n_verses); a cue beyond a hymn's length is no verse."""
    blocks = hymn_blocks(files, head).withColumn("text", cleaned(F.col("block"), F.lit(head)))
    parts = _marks(blocks, [(k, rf"\b{p}") for k, p in COMPONENTS.items()], re.I)
    begins = blocks.withColumns({"kind": F.lit("title"), "value": F.lit(""), "at": F.lit(0)})
    parts = parts.unionByName(begins)
    parts = ordered.segments(parts, ["path", "hymn"], "at", F.length("text"), [F.col("at"), (F.col("kind") != "title")], "stop")
    parts = parts.withColumn("text", _cut("text", "at", "stop")).filter(tx.strip(F.col("text")) != "").select("path", "hymn", F.col("kind").alias("component"), F.col("at").alias("part_at"), "text")
    cues = _marks(parts, [("cue", _CUE)], 0)
    cues = cues.withColumn("verse", F.col("value").cast("int")).join(lengths, "hymn", "left").filter(F.col("n_verses").isNull() | (F.col("verse") <= F.col("n_verses")))
    cues = cues.select(*parts.columns, "verse", "at").unionByName(parts.withColumns({"verse": F.lit(0), "at": F.lit(0)}))
    cues = ordered.segments(cues, ["path", "hymn", "part_at"], "at", F.length("text"), [F.col("at"), F.col("verse")], "stop")
    rows = cues.withColumn("para", F.trim(F.regexp_replace(_cut("text", "at", "stop"), r"(?U)\s+", " "))).filter("para <> ''")
    counted = Window.partitionBy("hymn", "verse", "component").orderBy("path", "part_at", "at")
    rows = rows.withColumn("para_index", F.row_number().over(counted))
    key = F.concat(F.lit(f"{book}."), F.col("hymn").cast("string"), F.lit("."), F.col("verse").cast("string"), F.lit("#"), F.substring("component", 1, 4), F.col("para_index").cast("string"))
    rows = rows.withColumns({"key": key, "ratio": tx.garble_ratio(F.col("para"))})
    out = rows.select(F.lit(commentator).alias("commentator"), "key", F.lit(book).alias("book"), F.col("hymn").alias("chapter"), F.col("verse").alias("verse_start"), "component", "para_index", F.col("path").alias("volume"), F.col("para").alias("text"), F.round("ratio", 6).alias("garble"))
    garbled = rows.filter((F.col("ratio") >= GARBLED) & (F.length("para") >= GARBLED_LENGTH)).select(F.col("path").alias("volume"), F.concat(F.lit("garbled: "), "key").alias("flag"))
    recovered = blocks.filter("recovered").select(F.col("path").alias("volume"), F.concat(F.lit("head recovered from a running header: "), F.col("hymn").cast("string")).alias("flag"))
    expected = files.select("path", F.explode(F.sequence("first", "last")).alias("hymn"))
    lost = expected.join(blocks.select("path", "hymn"), ["path", "hymn"], "left_anti").select(F.col("path").alias("volume"), F.concat(F.lit("no head found: "), F.col("hymn").cast("string")).alias("flag"))
    return out, garbled.unionByName(recovered).unionByName(lost)
