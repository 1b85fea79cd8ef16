"""Splitting oversized texts at natural boundaries.

A recursive separator hierarchy: sections, paragraphs, sentences, words, characters. A piece is
packed greedily: it ends at the last boundary of the highest level that leaves it well filled, or
else of the next level, down to a cut between characters. Each piece after the first begins with
the last ``overlap`` characters of the piece before, so the pieces without their overlaps join to
the trimmed text again, whole.

Defined results: the text is first trimmed of space, tab, line feed and carriage return; lengths
are in Unicode code points. A text within the limit is its own only piece, an empty or blank text
one empty piece, a null text one null piece. ``truncated`` is true for the last piece of a text
that is a proper beginning of its record's whole text (where that is given), false otherwise:
splitting itself loses nothing. Rows are taken as they are, repeats included: to count them once is up to the caller.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan import shared

LIMIT = 6000
OVERLAP = 200
#: A boundary is taken if the piece keeps at least this share of its room; lower levels are tried otherwise.
LEAST_FILL = 0.5
#: Keys, and texts, up to this number are broadcast; more are shuffled.
BROADCAST_KEYS, BROADCAST_TEXTS = 100_000, 1_000

# The boundaries of each level, from the highest; a piece ends where the match ends.
_SECTION = r"(?:\r?\n[ \t]*){3,}|\r?\n(?=(?:[A-Z][A-Z ,.'-]{3,}|#{1,6} .*)\r?\n)"
_PARAGRAPH = r"(?:\r?\n[ \t]*){2,}"
_SENTENCE = r"[.!?…。！？।॥։؟۔׃]+[\"'”’»)\]]*(?:\s+|(?=[぀-鿿]))"
_LINE_OR_WORD = r"\s+"
_LEVELS = [re.compile(x) for x in (_SECTION, _PARAGRAPH, _SENTENCE, _LINE_OR_WORD)]
_JOINED = re.compile("[̀-ͯ҃-҉֑-ֽֿׁ-ׇؐ-ًؚ-ٟऀ-ःऺ-ॏ᪰-᫿᷀-᷿‍⃐-⃿︀-️︠-︯]")


def _cut(text: str, begin: int, most: int) -> int:
    """Where the piece that begins at ``begin`` ends, at ``most`` at the latest."""
    least = begin + max(1, int((most - begin) * LEAST_FILL))
    for level in _LEVELS:
        end = -1
        for m in level.finditer(text, begin, most):
            if m.end() >= least:
                end = m.end()
        if end > 0:
            return end
        # white space that runs over the limit: the boundary is what lies within it
        if level is _LEVELS[-1] and most < len(text) and text[most].isspace():
            return most
    end = most
    while end > least and _JOINED.match(text[end : end + 1]):
        end -= 1
    return end if end > least else most


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(begin, end) of each piece, the overlap included."""
    if len(text) <= limit:
        return [(0, len(text))]
    out, begin, fresh = [], 0, 0
    while len(text) - begin > limit:
        end = _cut(text, fresh, begin + limit)
        out.append((begin, end))
        fresh, begin = end, max(begin, end - overlap)
    return [*out, (begin, len(text))]


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"^[ \t\n\r]+|[ \t\n\r]+\z", "")


def split_oversized(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP, whole: Column | None = None) -> DataFrame:
    """(id, piece, pieces, begins_at, text, truncated) of every row.

    ``whole``: column of ``df`` with the record's whole text, if known. Only oversized texts pass
    through Python; all others stay in the JVM. A narrow map: no shuffle.
    """
    if not 0 <= overlap < limit * LEAST_FILL:
        raise ValueError("the overlap must be less than the least fill of a piece")
    text = trimmed(F.col(text_col))
    cut_off = F.lit(False) if whole is None else F.coalesce((F.length(text) < F.length(trimmed(whole))) & F.startswith(trimmed(whole), text), F.lit(False))
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"), cut_off.alias("cut_off"))
    big = F.coalesce(F.length("text"), F.lit(0)) > limit
    kind = df.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("piece", T.IntegerType()),
            T.StructField("pieces", T.IntegerType()),
            T.StructField("begins_at", T.IntegerType()),
            T.StructField("text", T.StringType()),
            T.StructField("truncated", T.BooleanType()),
        ]
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for i in range(0, len(pdf), 256):
                out = []
                for key, text, cut_off in zip(pdf["id"][i : i + 256], pdf["text"][i : i + 256], pdf["cut_off"][i : i + 256]):
                    where = cuts(text, limit, overlap)
                    out += [(key, k, len(where), a, text[a:b], bool(cut_off) and k == len(where) - 1) for k, (a, b) in enumerate(where)]
                yield pd.DataFrame(out, columns=schema.names)

    split = rows.filter(big).mapInPandas(run, schema)
    whole_rows = rows.filter(~big).select("id", F.lit(0).alias("piece"), F.lit(1).alias("pieces"), F.lit(0).alias("begins_at"), "text", F.col("cut_off").alias("truncated"))
    return split.unionByName(whole_rows).withColumnRenamed("id", id_col)


def against_records(rows: DataFrame, text_col: str, records: DataFrame, record_text: str, keys: list[str]) -> DataFrame:
    """``rows`` with the column whole: the longest text of the row's record, where it is longer than the row's own; null elsewhere.

    Lengths are joined first, so texts are shuffled only for keys where a row is shorter than its record.
    """
    lengths = records.groupBy(*keys).agg(F.max(F.length(trimmed(F.col(record_text)))).alias("_full"))
    short = rows.select(*keys, F.length(trimmed(F.col(text_col))).alias("_own")).join(lengths, keys).filter("_own < _full").select(*keys).distinct()
    short = shared.materialize(short, "shorter-rows")
    if (few := short.count()) <= BROADCAST_KEYS:
        short = F.broadcast(short)
    full = records.join(short, keys, "left_semi").groupBy(*keys).agg(F.max_by(record_text, F.struct(F.length(record_text), record_text)).alias("whole"))
    return rows.join(F.broadcast(full) if few <= BROADCAST_TEXTS else full, keys, "left")


def invariants(rows: DataFrame, id_col: str, text_col: str, pieces: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """One row: rows, rows whose pieces do not join to the trimmed text, pieces over the limit, and pieces that do not begin with the end of the one before."""
    parts = F.array_sort(F.collect_list(F.struct("piece", "begins_at", "text")))
    by_row = pieces.groupBy(id_col, "pieces").agg(parts.alias("parts"))
    each = F.sequence(F.lit(1), F.size("parts") - 1)
    text = lambda i: F.col("parts")[i]["text"]
    lacking = F.when(F.size("parts") > 1, F.size(F.filter(each, lambda i: ~F.startswith(text(i), F.right(text(i - 1), F.lit(overlap)))))).otherwise(0)
    rest = F.transform(F.col("parts"), lambda x, i: F.when(i == 0, x["text"]).otherwise(F.substring(x["text"], overlap + 1, limit)))
    joined = by_row.select(id_col, F.array_join(rest, "").alias("joined"), (F.size("parts") == F.col("pieces")).alias("all"), lacking.alias("lacking"))
    own = rows.select(F.col(id_col).alias("_id"), trimmed(F.col(text_col)).alias("_text"))
    both = own.join(joined, own["_id"] == joined[id_col], "left")
    whole = F.coalesce(F.col("all"), F.lit(False)) & F.coalesce("_text", F.lit("")).eqNullSafe(F.coalesce("joined", F.lit("")))
    first = both.agg(F.count("*").alias("n_rows"), F.count_if(~whole).alias("n_not_whole"), F.coalesce(F.sum("lacking"), F.lit(0)).alias("n_without_overlap"))
    return first.crossJoin(pieces.agg(F.count_if(F.length("text") > limit).alias("n_over_limit")))  # one row each
