"""Text functions as Column expressions; Python only where Spark has no equivalent."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKEN = "[a-z0-9]+(?:'[a-z0-9]+)*"
CHUNK_LIMIT = 6000
#: Lengths from which a definition or a block counts as long.
LONG_DEFINITION, LONG_BLOCK = 4000, 12_000


def strip(c: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends; empty becomes null."""
    return F.nullif(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def present(*columns: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


@F.pandas_udf(T.ArrayType(T.StringType()))
def tokens(texts: pd.Series) -> pd.Series:
    """Search tokens after compatibility normalisation and full case folding."""
    find = re.compile(TOKEN).findall
    return texts.map(lambda t: None if t is None else find(unicodedata.normalize("NFKC", t).casefold()))


def checksum(text: Column) -> Column:
    return F.sha2(text, 256)


def chunk_id(resource_type: Column, source: Column, anchor: Column, text_checksum: Column) -> Column:
    """Content-addressed: the type's first letters and 24 digits of a digest over all four."""
    digest = F.sha2(F.concat_ws("\x00", resource_type, source, anchor, text_checksum), 256)
    return F.concat(F.substring(resource_type, 1, 3), F.lit("_"), F.substring(digest, 1, 24))


def capped(text: Column, limit: int = CHUNK_LIMIT) -> tuple[Column, Column]:
    """(stripped text cut to the limit, whether it was cut)."""
    whole = strip(text)
    return F.substring(whole, 1, limit), F.coalesce(F.length(whole) > limit, F.lit(False))


def garble_ratio(text: Column) -> Column:
    """One less the share of words of two letters or more that have one of the five vowels; 1 without words."""
    words = F.regexp_extract_all(text, F.lit("[A-Za-z]{2,}"), F.lit(0))
    good = F.size(F.filter(words, lambda w: w.rlike("[aeiouAEIOU]")))
    return F.when(F.size(words) == 0, F.lit(1.0)).otherwise(1 - good / F.size(words))


#: Values of the letters of roman numerals.
_ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


def roman_value(c: Column, least: int = 1, most: int | None = None) -> Column:
    """Value of a roman numeral by subtraction; null with any other character, when empty, or outside ``least`` to ``most``."""
    numeral = F.upper(c)
    table = F.create_map(*[F.lit(x) for pair in _ROMAN.items() for x in pair])
    values = F.transform(F.split(F.when(numeral.rlike(r"\A[IVXLCDM]+\z"), numeral), ""), lambda x: F.element_at(table, x))
    # a letter smaller than one after it counts against the sum
    signed = F.transform(values, lambda v, i: F.when(v < F.array_max(F.slice(values, i + 1, F.size(values))), -v).otherwise(v))
    total = F.aggregate(signed, F.lit(0), lambda acc, v: acc + v)
    return F.when(total.between(least, most if most is not None else 2**31 - 1), total)


def strongs_key(c: Column, prefix: str) -> Column:
    """Dictionary key without leading zeros under the given prefix; null if it is none."""
    digits = F.regexp_extract(F.trim(c), r"^[GH]0*(\d+)$", 1)
    return F.when(digits != "", F.concat(F.lit(prefix), F.try_to_number(digits, F.lit("9999999999")).cast("bigint").cast("string")))


def extended_key(c: Column) -> Column:
    """As ``strongs_key`` for G keys, keeping a homograph letter."""
    t = F.trim(c)
    return F.when(t.rlike(r"^G0*\d+[A-Za-z]?$"), F.concat(F.lit("G"), F.regexp_extract(t, r"^G0*(\d+[A-Za-z]?)$", 1)))


def base_key(c: Column) -> Column:
    """A key without its homograph letter."""
    return F.regexp_replace(c, r"^([GH]\d+)[A-Za-z]$", "$1")


def lemma_keys(c: Column) -> Column:
    """Every run of digits as a Hebrew key."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"(\d+)"), F.lit(1)), lambda d: F.concat(F.lit("H"), d.cast("bigint").cast("string")))


def usage_gloss(c: Column) -> Column:
    """A gloss without its lead-in of colons and dashes."""
    return F.nullif(F.trim(F.regexp_replace(c, r"^[:\s]*-{1,2}\s*", "")), F.lit(""))


def surface(c: Column) -> Column:
    """A word without the note in brackets after it."""
    return F.trim(F.regexp_replace(c, r"\s*\([^)]*\)\s*$", ""))


def quoted(c: Column) -> Column:
    """Percent-encoding with %20 for a space."""
    return F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))


def preview(c: Column, most: int = 70) -> Column:
    return F.substring(c, 1, most)


def prose_key(c: Column) -> Column:
    """Letters and single spaces only, in lower case, cited brackets left out: the same prose in two editions has the same key."""
    bare = F.regexp_replace(c, r"\([^()]*[0-9]+\s*[:.]\s*[0-9]+[^()]*\)", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(bare), r"[^a-z]+", " "), " +", " "))


def first_words(key: Column, n: int = 14) -> Column:
    return F.array_join(F.slice(F.split(key, " "), 1, n), " ")


@F.pandas_udf(T.BinaryType())
def vector_bytes(vectors: pd.Series) -> pd.Series:
    """Vectors as little-endian 32-bit floats."""
    import numpy as np

    return vectors.map(lambda v: None if v is None else np.asarray(v, "<f4").tobytes())
