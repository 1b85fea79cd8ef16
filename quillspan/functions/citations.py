"""Citations and reference tokens: human prose, OSIS, anchors."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan.sources import canon

REF = T.StructType([T.StructField("book", T.StringType()), T.StructField("chapter", T.IntegerType()), T.StructField("verse_start", T.IntegerType()), T.StructField("verse_end", T.IntegerType())])
RESULT = T.StructType([T.StructField("refs", T.ArrayType(REF)), T.StructField("unparsed", T.ArrayType(T.StringType()))])

# Words that join citations, phrases that trail them, words that stand before the number of a verse.
_JOINING = frozenset(["with", "and", "etc", "&"])
_TRAILING = (("to", "the", "end"), ("throughout",), ("ff",), ("f",))
_VERSE_WORDS = frozenset(["ver", "vers", "verse"])
_LEXEME = re.compile(r"(?P<number>\d+)|(?P<word>[A-Za-z]+)|(?P<mark>&(?:c\b)?|[;,:.–-])|(?P<other>[^\s\w]|\w+)")


@dataclass(frozen=True)
class _Lexeme:
    kind: str
    text: str
    start: int
    end: int

    def is_mark(self, *marks: str) -> bool:
        return self.kind == "mark" and self.text in marks


def _lexemes(block: str) -> list[_Lexeme]:
    return [_Lexeme(m.lastgroup, m.group(), m.start(), m.end()) for m in _LEXEME.finditer(block)]


def _split(items: list[_Lexeme], at: Callable[[_Lexeme], bool]) -> Iterator[list[_Lexeme]]:
    run: list[_Lexeme] = []
    for x in items:
        if at(x):
            yield run
            run = []
        else:
            run.append(x)
    yield run


def _joins(x: _Lexeme) -> bool:
    return x.text.lower() in _JOINING if x.kind == "word" else x.kind == "mark" and x.text[0] == "&"


def _trimmed(piece: list[_Lexeme]) -> list[_Lexeme]:
    """A piece without stray stops at its ends, trailing phrases, and words before the numbers of verses."""
    piece = list(piece)
    while piece and piece[0].is_mark(".", ","):
        del piece[0]
    shorter = True
    while shorter:
        shorter = False
        while piece and piece[-1].is_mark(".", ","):
            del piece[-1]
        words = [x.text.lower() for x in piece]
        for phrase in _TRAILING:
            if len(piece) > len(phrase) and tuple(words[-len(phrase) :]) == phrase:
                del piece[-len(phrase) :]
                shorter = True
                break
    out: list[_Lexeme] = []
    for i, x in enumerate(piece):
        after = piece[i + 1 :]
        if after and after[0].is_mark(".") and x.text.lower() in _VERSE_WORDS:
            after = after[1:]
        stop_of_one = x.is_mark(".") and i and piece[i - 1].text.lower() in _VERSE_WORDS and after and after[0].kind == "number"
        if stop_of_one or (x.text.lower() in _VERSE_WORDS and after and after[0].kind == "number"):
            continue
        out.append(x)
    return out


def _named(part: list[_Lexeme]) -> int:
    """How many lexemes of a part spell a book: a numeral of one to three may stand before its words."""
    i = int(len(part) > 1 and part[0].text in ("1", "2", "3") and part[1].kind == "word")
    if i >= len(part) or part[i].kind != "word":
        return 0
    while i < len(part) and (part[i].kind == "word" or part[i].is_mark(".")):
        i += 1
    return i


def _numbers(part: list[_Lexeme]) -> tuple[int, int | None, int | None] | None:
    """(first number, number after a colon or stop, number after a dash); None if the part has another shape."""
    shape = "".join("n" if x.kind == "number" else ":" if x.is_mark(":", ".") else "-" if x.is_mark("-", "–") else "?" for x in part)
    values = [int(x.text) for x in part if x.kind == "number"]
    if shape in ("n", "n:n", "n-n", "n:n-n"):
        return values[0], values[1] if ":" in shape else None, values[-1] if "-" in shape else None
    return None


def parse(block: str, aliases: dict[str, str] | None = None, one_chapter: frozenset[str] = canon.ONE_CHAPTER) -> tuple[list[tuple], list[str]]:
    """(references, pieces that name none). A scanner over the parts of a block with the running book and chapter.

    Semicolons end both; connecting words keep the book and end the chapter; commas keep both. A number alone is a
    verse of the running chapter, or of the only chapter; without one it is a chapter alone, and not a reference.
    """
    aliases = canon.ALIASES if aliases is None else aliases
    refs: list[tuple] = []
    unparsed: list[str] = []
    for group in _split(_lexemes(block), lambda x: x.is_mark(";")):
        book: str | None = None
        for piece in map(_trimmed, _split(group, _joins)):
            chapter: int | None = None
            for part in _split(piece, lambda x: x.is_mark(",")):
                if not part:
                    continue
                written = block[part[0].start : part[-1].end]
                words = _named(part)
                got = _numbers(part[words:])
                if words and got:
                    named = aliases.get(canon.alias_key(block[part[0].start : part[words - 1].end]))
                    if named is None:
                        unparsed.append(written)
                        continue
                    book, chapter = named, None
                if got is None or book is None:
                    unparsed.append(written)
                    continue
                number, verse, end = got
                if chapter is None and book in one_chapter:
                    chapter = 1
                if verse is not None:
                    chapter = number
                elif chapter is not None:
                    verse = number
                else:
                    unparsed.append(written)
                    continue
                refs.append((book, chapter, verse, end))
    return refs, unparsed


@F.pandas_udf(RESULT)
def parsed(blocks: pd.Series) -> pd.DataFrame:
    got = [parse(b) if b is not None else ([], []) for b in blocks]
    names = REF.fieldNames()
    return pd.DataFrame({"refs": [[dict(zip(names, r)) for r in refs] for refs, _ in got], "unparsed": [u for _, u in got]})


def inline_blocks(text: Column) -> Column:
    """The contents of round brackets that hold a chapter and verse."""
    return F.filter(F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1)), lambda g: g.rlike(r"[0-9]+\s*[:.]\s*[0-9]+"))


def _book_of(code: Column, codes: dict[str, str]) -> Column:
    table = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    return F.element_at(table, code)


def osis_point(token: Column, codes: dict[str, str] | None = None) -> Column:
    """(book, chapter, verse) of Book.Chapter.Verse; null if it is malformed or of no known book."""
    part = lambda i: F.regexp_extract(token, r"^([0-9A-Za-z]+)\.([0-9]+)\.([0-9]+)$", i)
    book = _book_of(part(1), codes or canon.OSIS)
    point = F.struct(book.alias("book"), part(2).try_cast("int").alias("chapter"), part(3).try_cast("int").alias("verse"))
    return F.when(book.isNotNull(), point)


def osis_range(token: Column, codes: dict[str, str] | None = None) -> Column:
    """(start, end) of a point or A-B; null unless both ends are points."""
    halves = F.split(token, "-", 2)
    start = osis_point(halves[0], codes)
    end = F.when(F.size(halves) > 1, osis_point(F.get(halves, F.lit(1)), codes)).otherwise(start)
    return F.when(start.isNotNull() & end.isNotNull(), F.struct(start.alias("start"), end.alias("end")))


def anchor(parsed_attr: Column, codes: dict[str, str] | None = None) -> Column:
    """(book, chapter, verse_start, verse_end, chapter_level) of a piped anchor |Book|c|v|c|v|; null if it is none.

    Verse 0 stands for the chapter; an end before the start is left out; the end's chapter is not looked at.
    """
    f = F.split(F.regexp_replace(parsed_attr, r"^\|+|\|+$", ""), r"\|", -1)
    number = lambda i: F.when(F.get(f, F.lit(i)).rlike("^[0-9]+$"), F.get(f, F.lit(i)).try_cast("int"))
    book = _book_of(F.get(f, F.lit(0)), codes or canon.OSIS)
    start, end = F.coalesce(number(2), F.lit(0)), F.coalesce(number(4), F.lit(0))
    value = F.struct(
        book.alias("book"), number(1).alias("chapter"), start.alias("verse_start"), F.when((start > 0) & (end >= start), end).alias("verse_end"), (start == 0).alias("chapter_level")
    )
    return F.when((F.size(f) == 5) & book.isNotNull() & number(1).isNotNull(), value)
