"""XML and HTML as ordered rows. Mixed content needs document order across tags, which tag-wise readers lose."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EVENTS = "path string, container int, pos int, tag string, attrs map<string,string>, text string, title string"


def _name(tag: object) -> str:
    return re.sub(r"^\{[^}]*\}", "", tag) if isinstance(tag, str) else ""


def inner_text(element: ET.Element, sep: str = " ") -> str:
    return re.sub(r"[ \t\n\r\xa0]+", " ", sep.join(t.strip() for t in element.itertext() if t.strip())).strip()


def _leaves(root: ET.Element, container: str, anchor: str) -> list[ET.Element]:
    """Containers that hold an anchor, and no container within them does."""
    matches = [e for e in root.iter() if re.fullmatch(container, _name(e.tag)) and any(_name(x.tag) == anchor for x in e.iter())]
    holding = set(map(id, matches))
    return [e for e in matches if not any(id(x) in holding for x in e.iter() if x is not e)]


def events(df: DataFrame, tags: tuple[str, ...], container: str | None = None, anchor: str | None = None) -> DataFrame:
    """(path, container, pos, tag, attrs, text, title) of the elements with these tags, in document order.

    With ``container`` and ``anchor``, only those within the innermost containers that hold an anchor. A paragraph
    that merely wraps an anchor has no text. Files that are no XML give one row with the tag '!error'.
    """

    def of(path: str, text: str) -> Iterator[tuple]:
        try:
            root = ET.fromstring(re.sub(r"&(?!#|amp;|lt;|gt;|quot;|apos;)(\w+);", "", text))
        except ET.ParseError as e:
            yield path, 0, 0, "!error", {}, str(e), None
            return
        parts = _leaves(root, container, anchor) if container and anchor else [root]
        for n, part in enumerate(parts):
            pos = 0
            for e in part.iter():
                if _name(e.tag) in tags:
                    wraps = anchor is not None and _name(e.tag) != anchor and any(_name(x.tag) == anchor for x in e.iter())
                    yield path, n, pos, _name(e.tag), {_name(k): v for k, v in e.attrib.items()}, "" if wraps else inner_text(e), part.get("title")
                    pos += 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [r for p, t in zip(pdf["path"], pdf["text"]) for r in of(p, t)]
            yield pd.DataFrame(rows, columns=["path", "container", "pos", "tag", "attrs", "text", "title"])

    return df.select("path", "text").mapInPandas(run, EVENTS)


@dataclass(frozen=True)
class Field:
    """A field of a record: the first element with ``tag``, an attribute of it or its text, inline nodes rendered by ``inline``.

    ``inline``: tag -> (attribute, prefix or None). A node with that attribute is rendered as its value (after the prefix, if
    digits, without leading zeros) instead of its text. ``every``: all such elements, joined.
    """

    tag: str
    attr: str | None = None
    inline: dict[str, tuple[str, str | None]] = field(default_factory=dict)
    every: str | None = None


def _rendered(e: ET.Element, inline: dict[str, tuple[str, str | None]]) -> str:
    parts = [e.text or ""]
    for child in e:
        rule = inline.get(_name(child.tag))
        value = child.get(rule[0]) if rule else None
        if rule and value is not None:
            digits = re.fullmatch(r"[A-Za-z]?0*(\d+)\w*", value)
            prefix = rule[1]
            if prefix == "language":
                prefix = "H" if (child.get("language") or "").upper() == "HEBREW" else "G"
            parts.append(value if prefix is None else prefix + digits.group(1) if digits else value)
        elif not rule or rule[0] != "!":
            parts.append(_rendered(child, inline))
        parts.append(child.tail or "")
    return "".join(parts)


def _squeezed(s: str | None) -> str | None:
    return (re.sub(r"\s+", " ", s).strip() or None) if s is not None else None


def records(df: DataFrame, record: str, fields: dict[str, Field]) -> DataFrame:
    """One row per ``record`` element, in document order: path, pos, attrs, text and the fields."""

    def value(e: ET.Element, f: Field) -> str | None:
        found = [x for x in e.iter() if _name(x.tag) == f.tag and x is not e]
        if not found:
            return None
        if f.every is not None:
            return f.every.join(t for t in (_squeezed(_rendered(x, f.inline)) for x in found) if t) or None
        if f.attr:
            return _squeezed({_name(k): v for k, v in found[0].attrib.items()}.get(f.attr))
        return _squeezed(_rendered(found[0], f.inline))

    names = list(fields)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for path, text in zip(pdf["path"], pdf["text"]):
                root = ET.fromstring(text)
                for pos, e in enumerate(x for x in root.iter() if _name(x.tag) == record):
                    rows.append((path, pos, {_name(k): v for k, v in e.attrib.items()}, inner_text(e), *(value(e, f) for f in fields.values())))
            yield pd.DataFrame(rows, columns=["path", "pos", "attrs", "text", *names])

    schema = "path string, pos int, attrs map<string,string>, text string" + "".join(f", `{n}` string" for n in names)
    return df.select("path", "text").mapInPandas(run, schema)


class _Paragraphs(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.done: list[str] = []
        self.open: list[str] | None = None

    def handle_starttag(self, tag, attrs) -> None:
        if tag == "p":
            self.handle_endtag("p")
            self.open = []

    def handle_endtag(self, tag) -> None:
        if tag == "p" and self.open is not None:
            if text := re.sub(r"[ \t\n\r]+", " ", " ".join(x.strip() for x in self.open if x.strip())).strip():
                self.done.append(text)
            self.open = None

    def handle_data(self, data) -> None:
        if self.open is not None:
            self.open.append(data)


def html_paragraphs(df: DataFrame) -> DataFrame:
    """(path, pos, text) of the paragraphs that have text."""

    @F.pandas_udf("array<string>")
    def paragraphs(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> list[str]:
            p = _Paragraphs()
            p.feed(t or "")
            p.close()
            p.handle_endtag("p")
            return p.done

        return texts.map(one)

    return df.select("path", F.posexplode(paragraphs("text")).alias("pos", "text"))
