"""Noise in text from scanned pages: found, named, and repaired into running paragraphs.

1. A source is scanned if most of its comments name a component; a few rows may be wrong about it.
2. Over the whole corpus: the vocabulary of lower-case words and hyphenated compounds in clean
   texts, and the lines at page edges (short, every word capitalised), reduced to fuzzy keys without
   numbers and with letters that scanners confuse folded together. A key that repeats in the middle
   of texts is a running header; one that only ever opens texts is a section's head.
3. A line that holds a number alone is a page's number if it stands at a page's edge: marked as one (in dashes or
   brackets, after p.), beside a running header or a head, or where it breaks a sentence in two; or if it continues the sequence
   of another page number of its text. A bare number elsewhere must at least lie within the range of the
   page numbers attested at edges in the whole corpus; a capital letter or numeral, a digit or a short number
   with a full stop is then left alone, as are years. (Texts are not whole pages in a row, so that a sequence can be
   followed within a text only.) Page numbers and headers are taken out, lines are joined: a word broken over a line
   end is closed up unless the vocabulary knows it as a compound with its own hyphen.
4. A word the vocabulary lacks is misread if undoing a few scanner confusions or removing specks gives a
   word it has; names (capitals within a sentence), numerals, and words of other scripts are left alone. The
   vocabulary is searched as a tree of letters, so that words of any length and any number of specks are looked up.

Both tables are bounded by construction, since an entry needs a least share of all words or of all
edge lines (``WORD_SHARE``, ``EDGE_SHARE``): at most 1 / share entries, whatever the corpus.

Defined results: a null text stays null and has no noise; texts of sources that are not scanned are
unchanged; blank texts have no paragraphs; exact repeats of a row count once.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, fields, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least share of all running words that an ordinary word has; so the vocabulary has 1 / share words at most.
WORD_SHARE = 3e-5
#: Least share of a word's occurrences that are in lower case; names have fewer.
LOWER_SHARE = 0.1
#: The same for words that are seen in scanned texts only: in lower case, and in capitals; and for edge lines.
SCAN_WORD_SHARE, SCAN_CAPITAL_SHARE = 2e-4, 3e-4
#: The same for names, that is words mostly with a capital.
NAME_SHARE = 2e-6
EDGE_SHARE = 2e-5
#: Share of a key's lines that stand within texts, from which it is a header and not a head.
WITHIN_SHARE = 0.2
#: Confusions undone in one word.
MOST_CONFUSIONS = 3

# What scanners write -> what is printed.
_CONFUSED = {
    "li": "h", "b": "h", "c": "e", "f": "ts", "i": "rl", "n": "u", "u": "n", "rn": "m", "cl": "d", "vv": "w", "v": "y", "ſ": "s",
    "0": "o", "1": "li", "j": "i", "^": "a", "l>": "b", "o": "ce", "ﬁ": ("fi",), "ﬂ": ("fl",), "U": ("ll", "tt"), "\\'": "v", "5": "s", "8": "sb", "9": "sog",
    "6": "b", "m": ("rn", "in"), "l": "it", "ii": "u", "d": ("cl",), "h": ("b", "li"), "e": "c", "t": "f", "r": ("i",), "y": "v", "w": ("vv",), "q": "g", "g": "q", "I": "l", "|": "l", "!": "l",
}
#: Rarer confusions, tried after the others: the printed pair or letter for the one seen.
_CONFUSED_PAIR = {"n": ("ri",), "w": ("ri",), "u": ("ii",), "a": ("o",), "s": ("a",)}
_HYPHENS = "-\xad‐‑¬"
_FOLDED = str.maketrans("ETKRJLIP1!|058963", "FFNBIIIFIIIOSSSBS")

_PAGE = re.compile(
    r"[\[({<—–\-~_.*• ]*(?:(?:[Pp](?:p|g|age)?|fol)\.? ?)?"
    r"(?:(?=\S*\d)[0-9lIOoSsBZz|!^■•*.,;:'~]{1,6}|[lIO|]{1,3}|c?(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})|[LX]{0,4}[IVX]{1,5})"
    r"[\])}>—–\-~_.,*• ]*(?: [A-Z]\d?)?"
)
#: What tells a page's number by itself; numerals in capitals, which are sections' as well; ends of sentences.
_MARKED_PAGE = re.compile(r"[\[({<—–\-~_*•]\s*\S|[Pp](?:p|g|age)?\. ?\S|fol\. ?\S")
_CAPITAL_NUMERAL = re.compile(r"[IVXLC]+\.?")
_BEGINS_AFTER = re.compile(r"[.?!:\"“][\"”’')\]]*$")
_SENTENCE_END = re.compile(r"[.?!:][\"”’')\]]*$")
_DIGITS = str.maketrans("lIOoSsBZz|!", "11005582211")
_ROMAN = re.compile(r"[IVXLCDMl1]+", re.I)
_NUMERAL = re.compile(r"(?=.)m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})")
_NUMBERISH = re.compile(r"[\dlIOoSB^|!.,:;'■•*~-]*\d[\dlIOoSB^|!.,:;'■•*~-]*|[lIO]{1,4}")
_LOWER_WORD = re.compile(r"(?:^|\s)[^\w\s]*[^\W\d_A-Z](?:[a-z]|[^\w\s]*(?:\s|$))")
_SMALL_NUMERAL = re.compile(r"(?<!\S)[ivxlcIVXLC1|]+[.\])]*(?!\S)")
_WORD = re.compile(r"[^\W\d_]+(?:[-'’][^\W\d_]+)*")
_SPECK = re.compile(r"[^\w\-]|_")
_LATIN = re.compile(r"[A-Za-zſﬁﬂ0-9]")
_OTHER_SCRIPT = re.compile(r"[^\W\d_A-Za-zÀ-ɏſﬁﬂ]")


def edge_key(line: str) -> str:
    """A line at a page edge without its numbers, confusable letters folded; empty if it is no such line."""
    s = line.strip()
    if not 3 <= len(s) <= 60 or s[-1] in ",;—-" or _LOWER_WORD.search(_SMALL_NUMERAL.sub(" ", s)):
        return ""
    if sum(ch.islower() for ch in s) > 0.3 * len(s) and not re.search(r"(?:^|\s)\W*\d", s):
        return ""  # capitals at word beginnings only, and no number: names at the end of a paragraph
    words = []
    for raw in s.upper().split():
        bare = re.sub(r"[^\w\[-]", "", raw) if raw[0] == "[" else re.sub(r"[^\w-]", "", raw)
        core = bare.lstrip("[")
        if not core or _NUMBERISH.fullmatch(core) or (_ROMAN.fullmatch(core) and words) or (len(core) == 1 and core not in "AI"):
            continue
        words.append(bare)
    key = " ".join(words)
    return key.translate(_FOLDED) if sum(ch.isalpha() for ch in key) >= 3 else ""


def is_page_number(line: str) -> bool:
    """A number or numeral alone in its line, perhaps misread, in brackets, or with the letter of a sheet: it may be a page's."""
    s = line.strip()
    return 0 < len(s) <= 14 and re.search(r"[0-9a-zA-Z]", s) is not None and _PAGE.fullmatch(s) is not None


def page_value(line: str) -> int | None:
    """The number that a page-number line shows, letters read as the digits they stand for; None for a numeral or one beyond reading."""
    bare = re.sub(r"^(?:[Pp](?:p|g|age)?|fol)\.?(?= ?[0-9])", "", re.sub(r"^[^0-9A-Za-z]+|[^0-9A-Za-z]+$", "", line)).strip()
    bare = re.sub(r" [A-Z]\d?$", "", bare).translate(_DIGITS)
    return int(bare) if bare.isdecimal() and len(bare) < 10 else None


def _at_edge(lines: list[str], at: int, headers: set[int]) -> bool:
    """Whether a page-number line shows by its form or place that a page ends there."""
    s = lines[at]
    if _MARKED_PAGE.match(s):
        return True
    before = next((i for i in range(at - 1, -1, -1) if lines[i]), None)
    after = next((i for i in range(at + 1, len(lines)) if lines[i]), None)
    if before in headers or after in headers:
        return True
    if _CAPITAL_NUMERAL.fullmatch(s) or (len(s) == 1 and s.isupper()):
        return False
    if before is None or after is None:
        return after is not None and lines[after][:1].islower()
    return not _SENTENCE_END.search(lines[before]) and (len(s) > 1 or lines[after][:1].islower())


def page_numbers(lines: list[str], headers: set[int], most: int) -> set[int]:
    """The lines of a text that are page numbers. ``headers``: its running headers and heads; ``most``: the greatest number attested at edges in the corpus."""
    may = [i for i, s in enumerate(lines) if s and i not in headers and is_page_number(s)]
    value = {i: page_value(lines[i]) for i in may}
    sure = {i for i in may if _at_edge(lines, i, headers) and (_MARKED_PAGE.match(lines[i]) or value[i] is None or not most or value[i] <= most)}
    known = {value[i] for i in sure} - {None}
    filled = [i for i, s in enumerate(lines) if s]
    for i in may:
        s, v = lines[i], value[i]
        outermost = i in (filled[0], filled[-1])
        if i in sure or _CAPITAL_NUMERAL.fullmatch(s) or (len(s) == 1 and s.isupper()):
            continue
        follows = len(s) > 1 and v is not None and bool(known & {v - 1, v + 1})
        if len(s) == 1:
            likely = s == "l" or outermost  # no word, but a one
        elif s[-1] == ".":
            likely = v is not None and v <= most and (v >= 100 or (outermost and v >= 10))  # shorter ones may number the items of a list
        else:
            likely = v is None or v <= most
        if follows or likely:
            sure.add(i)
    return sure


def _near(a: str, b: str, most: int) -> bool:
    if abs(len(a) - len(b)) > most:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return False
    return row[-1] <= most


class Fuzzy:
    """Keys that can be found with a few edits: with so many parts that one of them is free of edits, looked up where the edits may have moved it."""

    def __init__(self, keys: frozenset[str], edits: Callable[[int], int]) -> None:
        self.edits, self.parts = edits, {}
        for key in keys:
            for at, part in self._cut(len(key)):
                self.parts.setdefault((len(key), at, key[at : at + part]), []).append(key)

    def _cut(self, length: int) -> Iterator[tuple[int, int]]:
        """(begin, length) of the parts of keys of a length."""
        n = min(length, self.edits(length + self.edits(length) + 1) + 1)
        bounds = [length * i // n for i in range(n + 1)] if n else []
        yield from ((a, b - a) for a, b in zip(bounds, bounds[1:]))

    def has(self, key: str, most: int | None = None) -> bool:
        most = self.edits(len(key)) if most is None else most
        seen = set()
        for length in range(max(0, len(key) - most), len(key) + most + 1):
            for at, part in self._cut(length):
                for begin in range(max(0, at - most), min(len(key) - part, at + most) + 1):
                    for other in self.parts.get((length, at, key[begin : begin + part]), ()):
                        if other not in seen:
                            seen.add(other)
                            if _near(key, other, most):
                                return True
        return False


def _edits(length: int) -> int:
    return 1 + length // 12


@dataclass
class Corpus:
    """What all texts together say."""

    words: dict[str, int] = field(default_factory=dict)
    headers: frozenset[str] = frozenset()
    heads: frozenset[str] = frozenset()
    names: frozenset[str] = frozenset()

    page_most: int = 0

    def __post_init__(self) -> None:
        self._undone: dict[str, str | None] = {}
        self._keys: dict[str, tuple[bool, bool]] = {}
        self._fuzzy_headers, self._fuzzy_heads = Fuzzy(self.headers, _edits), Fuzzy(self.heads, _edits)
        self._openings = {" ".join(k.split()[:2]) for k in self.headers if len(k.split()) > 2}
        self._tree: dict | None = None

    def __getstate__(self):
        return {x.name: getattr(self, x.name) for x in fields(self)}

    def __setstate__(self, state) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def _kind(self, key: str) -> tuple[bool, bool]:
        """Whether a key is a header's, and a head's, with a few edits."""
        if key not in self._keys:
            if len(self._keys) > 200_000:
                self._keys.clear()
            header = key in self.headers
            if not header and key not in self.heads and len(key) >= 8:
                header = self._fuzzy_headers.has(key) and not self._fuzzy_heads.has(key, 1)
                two = " ".join(key.split()[:2])
                header = header or (len(two) >= 6 and two != key and two in self._openings)
            head = key in self.heads or (len(key) > 4 and self._fuzzy_heads.has(key))
            self._keys[key] = header, head
        return self._keys[key]

    def is_header(self, key: str) -> bool:
        return self._kind(key)[0]

    def is_head(self, key: str) -> bool:
        return self._kind(key)[1]

    def printed(self, seen: str) -> str | None:
        """The ordinary word that ``seen`` is a misreading of; None if it is none."""
        if seen not in self._undone:
            if len(self._undone) > 200_000:
                self._undone.clear()
            self._undone[seen] = self._undo(seen)
        return self._undone[seen]

    def _undo(self, seen: str) -> str | None:
        """The word with the fewest confusions to undo, of these the most frequent."""
        if self._tree is None:
            self._tree = {}
            for word in self.words:
                node = self._tree
                for ch in word:
                    node = node.setdefault(ch, {})
                node[""] = word
        own = seen.lower()
        for most in range(MOST_CONFUSIONS + 1):
            found = {w for w in self._reached(seen, most) if w != own}
            if found:
                return max(found, key=lambda w: (self.words[w], w))
        return None

    def _reached(self, seen: str, most: int) -> set[str]:
        """Words from which ``most`` confusions, and any specks, make ``seen``."""
        found: set[str] = set()
        todo = [(0, self._tree, most, True)]  # place in ``seen``, place in the tree, confusions left, whether a rare one is
        been = set()
        while todo:
            at, node, left, rare = todo.pop()
            if (at, id(node), left, rare) in been:
                continue
            been.add((at, id(node), left, rare))
            if at == len(seen):
                if not left and "" in node:
                    found.add(node[""])
                continue
            ch = seen[at]
            if (after := node.get(ch.lower())) is not None and len(ch.lower()) == 1:
                todo.append((at + 1, after, left, rare))
            if _SPECK.match(ch):  # taken out, or in a letter's place
                todo.append((at + 1, node, left, rare))
                todo.extend((at + 1, after, left, rare) for letter, after in node.items() if letter and letter.isascii() and letter.isalpha())
            if left:
                for table in (_BY_FIRST, _RARE_BY_FIRST) if rare else (_BY_FIRST,):
                    for wrong, right in table.get(ch, ()):
                        if seen.startswith(wrong, at):
                            for letters in right:
                                after = node
                                for x in letters:
                                    after = after.get(x) if after is not None else None
                                if after is not None:
                                    todo.append((at + len(wrong), after, left - 1, rare and table is _BY_FIRST))
        return found


def _by_first(table: dict[str, object]) -> dict[str, list[tuple[str, tuple[str, ...]]]]:
    out: dict[str, list[tuple[str, tuple[str, ...]]]] = {}
    for wrong, right in table.items():
        out.setdefault(wrong[0], []).append((wrong, tuple(right)))
    return out


_BY_FIRST, _RARE_BY_FIRST = _by_first(_CONFUSED), _by_first(_CONFUSED_PAIR)


def _lines(text: str) -> list[str]:
    return [x.strip() for x in re.split(r"\r\n|\r|\n", text)]


def kinds_of_lines(lines: list[str], corpus: Corpus) -> list[str]:
    """blank, page_no, header, head or body for each line."""
    keys = [edge_key(s) if s else "" for s in lines]
    lone = {i for i, key in enumerate(keys) if key and not is_page_number(lines[i])}
    headers = {i for i in lone if corpus.is_header(keys[i])}
    pages = page_numbers(lines, headers | {i for i in lone if corpus.is_head(keys[i])}, corpus.page_most)
    out, opening = [], True
    for i, (s, key) in enumerate(zip(lines, keys)):
        if not s:
            out.append("blank")
        elif i in pages:
            out.append("page_no")
        elif i in headers:
            out.append("header")
        elif key and opening and corpus.is_head(key):
            out.append("head")
        else:
            out.append("body")
            opening = False
    return out


def _closed(left: str, right: str, corpus: Corpus) -> bool:
    """Whether the two parts of a word broken at a line end are one word without the mark."""
    a, b = left.lower(), right.lower()
    whole, compound = corpus.words.get(a + b, 0), corpus.words.get(f"{a}-{b}", 0)
    if whole or compound:
        return whole >= compound
    if (w := corpus.printed(f"{a}-{b}")) is not None and "-" in w and corpus.printed(a + b) is None:
        return False
    return True


_BROKEN = re.compile(rf"([^\W\d_][^\s]*?)([{_HYPHENS}]+)\s*$")


def analyse(text: str, corpus: Corpus) -> tuple[str, list[str]]:
    """(repaired text, kinds of noise in it)."""
    lines = _lines(text)
    kinds = kinds_of_lines(lines, corpus)
    noise = {k for k in kinds if k in ("page_no", "header")}
    width = max((len(s) for s, k in zip(lines, kinds) if k == "body"), default=0)
    paragraphs: list[str] = []
    current, gap, edge, full = "", False, False, False
    for s, kind in zip(lines, kinds):
        if kind == "blank":
            gap = True
        elif kind in ("page_no", "header"):
            edge = True
        elif kind == "head":
            if current:
                paragraphs.append(current)
            paragraphs.append(s)
            current, gap, edge = "", False, False
        else:
            hanging = current[-1:] in _HYPHENS and bool(current)
            broken = _BROKEN.search(current, max(0, current.rfind(" "))) if hanging else None
            first = re.match(r"[^\W\d_]\S*", s)
            if broken and first and (edge or not gap) and not broken.group(1).endswith("-"):
                left = re.search(r"[^\W\d_](?:[^\s]*)$", current[: broken.start(2)])
                parts = re.match(r"\S*?(?=[.,;:!?)\]\"”’]*(?:\s|$))", s)
                stem = re.sub(r"^\W+", "", current[: broken.start(2)].split()[-1])
                close = _closed(stem, parts.group(0) if parts and parts.group(0) else first.group(0), corpus)
                if close:
                    noise.add("hyphen")
                current = current[: broken.start(2)] + ("" if close else "-") + s
                del left
            elif not current:
                current = s
            elif gap and not (edge and (not re.search(r"[.!?][\"”’)\]]*$", current) or re.match(r"[a-z]", s) or full)):
                paragraphs.append(current)
                current = s
            else:
                current += " " + s
            gap = edge = False
            full = len(s) > 0.75 * width
    if current:
        paragraphs.append(current)
    fixed = [_respelt(p, corpus) for p in paragraphs]
    if any(changed for _, changed in fixed):
        noise.add("misread")
    return "\n\n".join(p for p, _ in fixed), sorted(noise)


def _respelt(paragraph: str, corpus: Corpus) -> tuple[str, bool]:
    changed = False
    letters = [ch for ch in paragraph if ch.isalpha()]
    head = bool(letters) and sum(ch.isupper() for ch in letters) > 0.7 * len(letters)
    pieces = re.split(r"(\s+|—+|–+)", paragraph)
    begins = True
    for i, piece in enumerate(pieces):
        if i % 2 or not piece:
            begins = begins or "—" in piece
            continue
        bare = piece.strip("\"“”‘’()[]?!.,;:")
        if bare.endswith("'") or bare.startswith("'"):
            bare = bare.strip("'")
        unknown = bool(bare) and bare.lower() not in corpus.words
        at = piece.find(bare) if unknown else 0
        word = _misread(bare, begins or head, corpus, head) if unknown else None
        if unknown and word is None and len(bare) > 2 and bare.islower() and not _NUMERAL.fullmatch(bare):
            # a mark at the word's end may stand for a letter
            for more in (piece[at : at + len(bare) + 1], piece[max(0, at - 1) : at + len(bare)]):
                if len(more) > len(bare) and (word := _misread(more, begins or head, corpus, head)) is not None:
                    at, bare = piece.find(more), more
                    break
        if word is not None:
            if bare[:1].isupper() or (begins and not head):
                word = word[:1].upper() + word[1:]
            pieces[i] = piece[:at] + (word.upper() if head else word) + piece[at + len(bare) :]
            changed = True
        begins = not (piece[-1].isalpha() or piece[-1] in ",;") and _BEGINS_AFTER.search(piece) is not None
    return "".join(pieces) if changed else paragraph, changed


def _misread(seen: str, may_be_capital: bool, corpus: Corpus, head: bool = False) -> str | None:
    low = seen.lower()
    if len(seen) < 2 or low in corpus.words or not _LATIN.search(seen) or _OTHER_SCRIPT.search(seen) or not re.search(r"[a-zA-Zſﬁﬂ]", seen):
        return None
    if head and ((seen.isupper() and seen.isalpha()) or _ROMAN.fullmatch(seen)):
        return None  # what a head is printed in is the corpus's own
    if seen[0].isupper() and (not may_be_capital or low in corpus.names):
        return None
    if _NUMERAL.fullmatch(low) or re.fullmatch(r"[\d.,:;lIO-]+", seen) or low.endswith(("'s", "’s")) and low[:-2] in corpus.words:
        return None
    parts = re.split(r"[.,;:!?]", low)
    if len(parts) == 2 and all(p in corpus.words for p in parts):
        return None  # a space is missing, no letter is wrong
    if "-" in low and all(p in corpus.words for p in low.split("-")):
        return None
    return corpus.printed(seen)


# --- the corpus-wide statistics


def scanned_sources(comments: DataFrame, source_col: str = "commentator", component_col: str = "component") -> DataFrame:
    """(source): those most of whose comments name a component."""
    share = comments.groupBy(F.col(source_col).alias("source")).agg(F.avg(F.col(component_col).isNotNull().cast("int")).alias("share"))
    return share.filter("share > 0.5").select("source")


def _words(texts: DataFrame, pattern: str) -> DataFrame:
    tokens = F.explode(F.split("text", r"[^\p{L}'’\-]+")).alias("w")
    return texts.select(tokens).filter(F.col("w").rlike(pattern)).groupBy("w").agg(F.count("*").alias("n"))


def learn(chunks: DataFrame) -> Corpus:
    """Statistics of all texts: ``chunks`` has columns text and scanned."""
    clean = _words(chunks.filter(~F.col("scanned")), r"^\p{L}+(?:-\p{L}+)*$")
    ordinary = F.when((F.lower("w") == F.col("w")) | F.col("w").contains("-"), F.col("n")).otherwise(0)
    clean = clean.groupBy(F.lower("w").alias("w")).agg(F.sum(ordinary).alias("n"), F.sum("n").alias("every"))
    scanned = _words(chunks.filter("scanned"), r"^\p{L}{2,}$").groupBy(F.lower("w").alias("w")).agg(F.sum(ordinary).alias("n"), F.sum("n").alias("every"))

    def frequent(frame: DataFrame, share: float, lower_share: float, capital_share: float) -> dict[str, tuple[int, int]]:
        """Words with enough occurrences in lower case, or of any kind: 1 / share rows at most."""
        total = frame.agg(F.sum("every").alias("total"))
        enough = lambda least, of: F.greatest(F.lit(least), F.ceil(F.col("total") * of))
        lower = (F.col("n") >= lower_share * F.col("every")) & (F.col("n") >= enough(2, share))
        rows = frame.join(F.broadcast(total), lower | (F.col("every") >= enough(3, capital_share))).select("w", "n", "every", lower.alias("lower")).collect()
        return {r["w"]: (r["n"], r["every"], r["lower"]) for r in rows}

    in_clean, in_scans = frequent(clean, WORD_SHARE, LOWER_SHARE, NAME_SHARE), frequent(scanned, SCAN_WORD_SHARE, 0.5, SCAN_CAPITAL_SHARE)
    words = {w: n for w, (n, _, lower) in in_clean.items() if lower}
    names = frozenset(w for w, (n, every, lower) in in_clean.items() if not lower and n < 0.5 * every)
    corpus = Corpus(words)
    more = {w: every for w, (_, every, _) in in_scans.items() if w not in words and w not in names}
    words |= {w: n for w, n in more.items() if (p := corpus.printed(w)) is None or words[p] < 3 * n}

    def edges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            seen: Counter = Counter()
            for text in pdf["text"]:
                opening = True
                for s in _lines(text):
                    if not s or is_page_number(s):
                        continue
                    key = edge_key(s)
                    if key:
                        seen[key, opening] += 1
                    else:
                        opening = False
            yield pd.DataFrame([(k, o, n) for (k, o), n in seen.items()], columns=["key", "opening", "n"])

    lines = chunks.filter(F.col("scanned") & F.col("text").isNotNull()).select("text").mapInPandas(edges, "key string, opening boolean, n long")
    keys = lines.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("opening"), 0).otherwise(F.col("n"))).alias("within"))
    total = keys.agg(F.sum("n").alias("total"))
    kept_keys = keys.join(F.broadcast(total), F.col("n") >= F.greatest(F.lit(2), F.ceil(F.col("total") * EDGE_SHARE))).select("key", "n", "within").collect()  # 1 / share rows at most
    headers = frozenset(r["key"] for r in kept_keys if r["within"] > WITHIN_SHARE * r["n"])
    heads = frozenset(r["key"] for r in kept_keys if r["within"] <= WITHIN_SHARE * r["n"])
    corpus = Corpus(words, headers, heads, names)
    return replace(corpus, page_most=_attested(chunks, corpus))


def _attested(chunks: DataFrame, corpus: Corpus) -> int:
    """The greatest page number at page edges, rare ones beyond the others left out."""
    held = chunks.sparkSession.sparkContext.broadcast((corpus.headers, corpus.heads))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Corpus({}, *held.value)
        for pdf in frames:
            found = []
            for text in pdf["text"]:
                lines = _lines(text)
                may = [i for i, s in enumerate(lines) if s and is_page_number(s)]
                if may:
                    headers = {j for i in may for j in _beside(lines, i) if (key := edge_key(lines[j])) and known.is_header(key)}
                    found += [v for i in may if (v := page_value(lines[i])) is not None and _at_edge(lines, i, headers)]
            yield pd.DataFrame({"page": pd.Series(found, dtype="int64")})

    pages = chunks.filter(F.col("scanned") & F.col("text").isNotNull()).select("text").mapInPandas(run, "page long")
    row = pages.agg(F.percentile_approx("page", 0.99, 10_000).alias("most")).first()
    return int(row["most"] * 1.1) if row["most"] is not None else 0


def _beside(lines: list[str], at: int) -> list[int]:
    """The lines next to one that are not blank."""
    before = next((i for i in range(at - 1, -1, -1) if lines[i]), None)
    after = next((i for i in range(at + 1, len(lines)) if lines[i]), None)
    return [i for i in (before, after) if i is not None]


#: Sources up to this number are broadcast to their texts; more are joined, with the texts salted.
BROADCAST_SOURCES, SALTS = 10_000, 32


def marked(texts: DataFrame, source_col: str, sources: DataFrame, also: Column | None = None) -> DataFrame:
    """``texts`` with the column scanned. A source that holds a third of all texts is never gathered in one task."""
    known = sources.select(F.col("source").alias("scan_source"), F.lit(True).alias("from_scan"))
    few = sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    if few:
        rows = texts.join(F.broadcast(known), texts[source_col] == F.col("scan_source"), "left")
    else:
        salted = known.withColumn("scan_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = texts.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int"))
        rows = rows.join(salted, (rows[source_col] == F.col("scan_source")) & (F.col("salt") == F.col("scan_salt")), "left").drop("salt", "scan_salt")
    is_scan = F.coalesce("from_scan", F.lit(False))
    return rows.withColumn("scanned", is_scan if also is None else is_scan & F.coalesce(also, F.lit(False))).drop("scan_source", "from_scan")


def repaired(rows: DataFrame, corpus: Corpus, id_cols: list[str]) -> DataFrame:
    """(ids..., text, noise) of the scanned rows: the text repaired, the kinds of noise it held."""
    held = rows.sparkSession.sparkContext.broadcast(corpus)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in id_cols)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = held.value
        for pdf in frames:
            done = [analyse(t, known) if isinstance(t, str) else (None, []) for t in pdf["text"]]
            yield pdf[id_cols].assign(text=[t for t, _ in done], noise=[n for _, n in done])

    return rows.select(*id_cols, "text").mapInPandas(run, f"{kinds}, text string, noise array<string>")


