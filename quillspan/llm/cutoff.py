"""Texts that were cut off: found by a backward model of how texts end.

A text that does not end in a full stop may be whole (heading, list, verse line, signature, closing
formula, reference) or cut by a field limit or in transfer. Which one is told by its end, read backward:

* final characters: how often the last letters are a whole word and how often a word goes on after
  them; for letters that no known word begins with, the same by their last three characters;
* final context: the words before the end, back to the beginning of the clause. Frequent words of the
  language are spelled out; of the others only the last letters or the kind (name, number) stay, so that a
  context recurs. For every context, of 1 to 12 words: how often it occurs, how often a line or text
  ends there without a stop, and how often a stop or comma follows.

The longest contexts with enough evidence give two log-odds against a cut at any position, smoothed
with the shorter ones: that texts end so (closing words, verse lines), and that clauses do (the stop
alone is missing). What was put after the end (dots, brackets, quotes) is taken off first, and told
apart by its kind; so are lengths at which a source's texts pile up, in characters or bytes. The shares of
cut and whole texts are then estimated per source and kind of ending from the odds themselves
(expectation-maximisation), which sets the threshold on the log-odds for each. Languages and styles (texts
with and without full stops) have contexts of their own. A second round leaves the texts found cut
out of the endings it learns from.

All counts are over all texts; repeated texts count once as an ending. The tables are bounded by least
shares: a frequent word has ``WORD_SHARE`` of its language's words, a listed word ``LISTED_SHARE`` of
all, a context ``CONTEXT_SHARE`` of all positions; rarer contexts fall back on shorter ones.

Defined results: null, empty and blank texts are no cases, nor is a text whose end, marks taken off, is
a full stop; every id of a repeated text is listed; a null source or language is a group of its own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspan import shared

WORD_SHARE = 2e-3
LISTED_SHARE = 1e-6
CONTEXT_SHARE = 1e-6
#: A closing word ends a line or text in so large a share of its occurrences, and is that share of all such ends.
CLOSING, CLOSING_SHARE = 0.5, 1e-4
#: Texts of a source pile up at a length if so many lie within REACH below it, and hardly any above.
PILE, REACH = 5, 8
ORDERS = (1, 2, 3, 4, 5, 6, 8, 10, 12)
#: Weight of the shorter context, in occurrences.
BACKOFF = 8.0
#: Log-odds beyond which more evidence changes nothing.
CERTAIN = 12.0
#: Characters of a text's end looked at first; twice as many, and so on, where they do not hold what is looked for.
_TAIL = 400
#: Contexts that some text ends in, up to which they are sent to the tasks that count contexts; more are joined afterwards.
BROADCAST_CONTEXTS = 4_000_000

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+|\n+|[^\w\s]|_")
_MARKS = (
    ("bracket", re.compile(r"\s*[\[({<](?=[^\])}>]*[^\W\d_])(?![^\])}>]*\d)[^\])}>]{1,24}[\])}>]\s*\Z")),
    ("folio", re.compile(r"\s*[\[{<][^\]}>]{0,12}\d+[^\]}>]{0,6}[\]}>]\s*\Z")),
    ("dots_quoted", re.compile(r"\s*(?:\.{3,}|…)[\"”’»']+\s*\Z")),
    ("dots", re.compile(r"\s*(?:(?:\.\s?){3,}|…+|(?<![.?!])\.\.)\s*\Z")),
    ("broken", re.compile(r"[�]+\s*\Z")),
    ("dash", re.compile(r"(?<=[^\W_])\s*[-–—]+\s*\Z")),
    ("quoted", re.compile(r"(?<=[^\W_])\s*[\"”’»]+\s*\Z")),
)
_LETTERS = re.compile(r"[^\W\d_]*(?:['’][^\W\d_]+)*\Z")
_STOP = re.compile(r"[.?!।。؟][\"”’»')\]]*\Z")
_HAS_STOP = re.compile(r"[^\W\d_]{2,}[.?!।。؟][\"”’»')\]]*(?:\s|\Z)")
#: Marks that begin a context, that end a line or sentence, and that show a finished clause.
_CLAUSE, _SENTENCE, _STOPS = frozenset(".?!;:,\n"), frozenset(".?!;:\n"), frozenset(".?!;:,")
_NEWLINE, _SMALL, _BREAKS, _ENDS, _FINISHED = 1, 2, 4, 8, 16


def language(lang: Column) -> Column:
    """Codes of two and three letters, in any case, by their first two letters."""
    return F.coalesce(F.substring(F.lower(F.trim(lang)), 1, 2), F.lit("-"))


def ending(text: str) -> tuple[str, str]:
    """(text without what was put after its end, kind of that)."""
    s = text.rstrip()
    for kind, mark in _MARKS:
        begin = max(0, len(s) - 60)
        m = mark.search(s, begin)
        while m and m.start() == begin and begin:  # it may begin before
            begin = max(0, begin - 2 * (len(s) - begin))
            m = mark.search(s, begin)
        if m:
            return s[: m.start()].rstrip(), kind
    return s, "plain"


def last_tokens(body: str) -> list[str]:
    """The tokens of the end: as many as the longest context sees, and the one that a cut in the middle may have harmed, or all."""
    size = _TAIL
    while size < len(body):
        tokens = _TOKEN.findall(body[-size:])
        if len(tokens) > ORDERS[-1] + 1:
            return tokens[1:]
        size *= 2
    return _TOKEN.findall(body)


def last_letters(body: str) -> str:
    """The word, or piece of one, that a text ends in."""
    size = 60
    while True:
        found = _LETTERS.search(body[-size:])
        if found.start() or size >= len(body):
            return found.group(0)
        size *= 2


def style_of(text: str) -> str:
    """s: full stops end its sentences; v: it has none, as verse, lists and headings."""
    return "s" if _HAS_STOP.search(text[: max(0, len(text) - 1)]) else "v"


@dataclass
class Reduction:
    """How words are written in contexts, by language."""

    frequent: dict[str, frozenset[str]]

    closing: frozenset[str] = frozenset()

    def token(self, tok: str, lang_words: frozenset[str]) -> str:
        low = tok.lower()
        if low in lang_words or low in self.closing:
            return low
        if tok[0] == "\n":
            return "\n"
        if tok[0].isdigit():
            return "#"
        if not tok[0].isalpha():
            return tok
        if tok[0].isupper():
            return "N" if not tok.isupper() or len(tok) < 2 else "U"
        return "~" + low[-2:] if low.endswith(("ed", "ly")) else "~" + low[-1:] if low.endswith("s") and not low.endswith("ss") else "~"


class _Codes(dict):
    """Token -> 64-bit code, stable across processes; the low five bits tell what kind of token it is."""

    def __init__(self, reduction: Reduction, lang: str) -> None:
        self.reduction, self.words = reduction, reduction.frequent.get(lang, frozenset())

    def __missing__(self, tok: str) -> int:
        import xxhash

        first = tok[0]
        kind = _NEWLINE * (first == "\n") | _SMALL * first.islower() | _BREAKS * (first in _CLAUSE) | _ENDS * (first in _SENTENCE) | _FINISHED * (tok in _STOPS)
        code = xxhash.xxh64_intdigest(self.reduction.token(tok, self.words)) & ~31 | kind
        if len(self) < 500_000:
            self[tok] = code
        return code


@dataclass
class _Batch:
    """Contexts at every token of several texts, in one array for each order."""

    codes: np.ndarray
    ends: np.ndarray  # where each text ends
    contexts: dict[int, np.ndarray]
    longer: dict[int, np.ndarray]  # whether the order sees more than the one before it

    def has(self, kind: int) -> np.ndarray:
        return (self.codes & np.uint64(kind)) != 0


class _Coder:
    def __init__(self, reduction: Reduction) -> None:
        self.reduction, self.codes, self.seeds = reduction, {}, {}

    def batch(self, texts: list[tuple[list[str], str, str]]) -> _Batch:
        """``texts``: (tokens, language, style). A context begins at its clause's mark, or where the text does."""
        import xxhash

        flat: list[int] = []
        for tokens, lang, _ in texts:
            flat.extend(map(self.codes.setdefault(lang, _Codes(self.reduction, lang)).__getitem__, tokens))
        codes = np.array(flat, np.uint64)
        sizes = np.array([len(t) for t, _, _ in texts], np.int64)
        ends = np.cumsum(sizes)
        seeds = np.array([xxhash.xxh32_intdigest(lang + style) * 2654435761 + 97 for _, lang, style in texts], np.uint64)
        where = np.arange(len(codes))
        start = np.repeat(ends - sizes, sizes)
        breaks = (codes & np.uint64(_BREAKS)) != 0
        mark = np.maximum.accumulate(np.where(breaks, where, -1)) if len(codes) else where
        mark = np.where(breaks, np.r_[-1, mark[:-1]] if len(codes) else mark, mark)  # a mark itself is read from the mark before it
        begin = np.maximum(mark, start)
        out, longer, h = {}, {}, np.repeat(seeds, sizes)
        length, before = where - begin + 1, 0
        with np.errstate(over="ignore"):
            for j in range(1, ORDERS[-1] + 1):
                at = where - (j - 1)
                code = np.where(at >= begin, codes[np.maximum(at, 0)], np.uint64(1))
                h = (h ^ code) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                if j in ORDERS:
                    out[j], longer[j], before = (h ^ np.uint64(j)) >> np.uint64(1), length > before, j
        return _Batch(codes, ends, out, longer)


def _texts(df: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), language(F.col(lang_col)).alias("lang"), F.col(source_col).alias("source"))
    return rows.filter(F.col("text").isNotNull() & (F.length(F.trim("text")) > 0))


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n, ends) over all texts; ends: the word is the last of a line or text that has no stop."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        word = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
        last = re.compile(r"([^\W\d_]+)[^\S\n]*(?=\n+[^\W_a-z]|\Z)")
        for pdf in frames:
            seen: dict[str, Counter] = {}
            ends: dict[str, Counter] = {}
            for lang, text in zip(pdf["lang"], pdf["text"]):
                body = text.rstrip()
                found = word.findall(body)
                ends.setdefault(lang, Counter()).update(last.findall(body))
                if found and body[-1:].isalpha():
                    found.pop()  # the last word may be a piece of one
                seen.setdefault(lang, Counter()).update(found)
            rows = [(g, w, c[w], ends[g][w]) for g, c in seen.items() for w in c | ends[g]]
            yield pd.DataFrame(rows, columns=["lang", "word", "n", "ends"])

    counted = texts.select("lang", "text").mapInPandas(run, "lang string, word string, n long, ends long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))


@dataclass
class Words:
    """Known words in order, with running counts: how often letters are a whole word, and how often they begin a longer one."""

    words: np.ndarray
    upto: np.ndarray
    last: dict[str, tuple[int, int]] = field(default_factory=dict)

    @classmethod
    def of(cls, counts: dict[str, int]) -> Words:
        words = sorted(counts)
        last: dict[str, list[int]] = {}
        for w, n in counts.items():
            for i in range(1, len(w) + 1):
                pair = last.setdefault(w[max(0, i - 3) : i], [0, 0])
                pair[i < len(w)] += n
        return cls(np.array(words, object), np.cumsum([0, *(counts[w] for w in words)]), {k: (a, b) for k, (a, b) in last.items()})

    def whole(self, letters: str) -> float:
        """Share of whole words among the occurrences of ``letters`` at a word's beginning."""
        i = int(np.searchsorted(self.words, letters))
        same = int(self.upto[i + 1] - self.upto[i]) if i < len(self.words) and self.words[i] == letters else 0
        j = int(np.searchsorted(self.words, letters + "\U0010ffff"))
        longer = int(self.upto[j] - self.upto[i]) - same
        a, b = self.last.get(letters[-3:], (0, 1))
        guess = (a + 0.1) / (a + b + 1)
        if not same and not longer and letters[:1].isupper() and letters[1:]:
            return guess
        return (same + 0.5 * guess) / (same + longer + 0.5)


#: Tokens whose contexts are counted together.
_BATCH_TOKENS = 150_000


def _count_contexts(texts: DataFrame, reduction: Reduction, wanted: np.ndarray | None) -> DataFrame:
    """(h, total, ends, stops): occurrences of every context, those where a line ends, those before a stop or comma. The row h = -1 sums them all.

    ``wanted``: the only contexts to count, in order; None counts all.
    """
    held = None if wanted is None else texts.sparkSession.sparkContext.broadcast(wanted)

    def counted_in(batch: _Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = np.ones(len(batch.codes), bool)
        inner[batch.ends - 1] = False  # the end of a text is counted apart
        after = np.r_[batch.codes[1:], np.uint64(0)]
        then = np.r_[after[1:], np.uint64(0)]
        last = np.zeros(len(inner), bool)
        last[np.maximum(batch.ends - 2, 0)] = True
        newline = (after & np.uint64(_NEWLINE)) != 0
        line_end = newline & ~batch.has(_ENDS) & (last | ((then & np.uint64(_SMALL)) == 0))
        stop = (after & np.uint64(_FINISHED)) != 0
        seen = [inner & batch.longer[j] for j in batch.contexts]
        if held is not None and len(held.value):
            for at, h in zip(seen, batch.contexts.values()):
                rows = np.flatnonzero(at)
                values = h[rows].astype(np.int64)
                place = np.minimum(np.searchsorted(held.value, values), len(held.value) - 1)
                at[rows[held.value[place] != values]] = False
        h = np.concatenate([x[m] for x, m in zip(batch.contexts.values(), seen)])
        marks = [np.concatenate([x[m] for m in seen]) for x in (line_end, stop)]
        sums = np.array([inner.sum(), (line_end & inner).sum(), (stop & inner).sum()], np.int64)
        return *_summed(h, np.stack([np.ones(len(h), np.int64), *marks], 1).astype(np.int64)), sums

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = _Coder(reduction)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held: list[tuple[list[str], str, str]] = []
        size, sums = 0, np.zeros(3, np.int64)

        def count() -> None:
            nonlocal held, size, sums
            h, counts, more = counted_in(coder.batch(held))
            parts.append((h, counts))
            held, size, sums = [], 0, sums + more
            if sum(len(x) for x, _ in parts) > 1_200_000:
                parts[:] = [_summed(np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts]))]

        def frame(h: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
            return pd.DataFrame({"h": h, "total": counts[:, 0], "ends": counts[:, 1], "stops": counts[:, 2]})

        for pdf in frames:
            for lang, text in zip(pdf["lang"], pdf["text"]):
                tokens = _TOKEN.findall(text.rstrip())
                if tokens:
                    held.append((tokens, lang, style_of(text)))
                    size += len(tokens)
                if size > _BATCH_TOKENS:
                    count()
                    if len(parts) == 1 and len(parts[0][0]) > 900_000:
                        yield frame(*parts.pop())
        if held:
            count()
        parts.append((np.array([-1], np.int64), sums[None]))
        yield frame(*_summed(np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])))

    counted = texts.select("lang", "text").mapInPandas(run, "h long, total long, ends long, stops long")
    return counted.groupBy("h").agg(*[F.sum(c).alias(c) for c in ("total", "ends", "stops")])


def _summed(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and their summed counts."""
    if not len(h):
        return h.astype(np.int64), counts
    order = np.argsort(h, kind="stable")
    h = h[order].astype(np.int64)
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    return h[first], np.add.reduceat(counts[order], first, axis=0)


_END = "id {id}, source string, kind string, chars int, bytes int, text_hash long, letters string, stopped boolean, contexts array<bigint>"


def text_ends(texts: DataFrame, reduction: Reduction) -> DataFrame:
    """One row per text: what its end looks like."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        coder = _Coder(reduction)
        for pdf in frames:
            rows, open_ends = [], []
            for key, source, lang, text in zip(pdf["id"], pdf["source"], pdf["lang"], pdf["text"]):
                body, kind = ending(text)
                stopped = not body or _STOP.search(body) is not None
                digest = xxhash.xxh64_intdigest(re.sub(r"[\W\d_]+", "", text)) >> 1
                letters = "" if stopped else last_letters(body)
                rows.append([key, source, kind, len(text), len(text.encode()), digest, letters, stopped, []])
                if not stopped and (tokens := last_tokens(body)):
                    open_ends.append((len(rows) - 1, (tokens, lang, style_of(body))))
            if open_ends:
                batch = coder.batch([t for _, t in open_ends])
                at = np.stack([x[batch.ends - 1] for x in batch.contexts.values()], 1).astype(np.int64)
                longer = np.stack([x[batch.ends - 1] for x in batch.longer.values()], 1)
                for (i, _), contexts, use in zip(open_ends, at, longer):
                    rows[i][-1] = contexts[use].tolist()
            yield pd.DataFrame(rows, columns=["id", "source", "kind", "chars", "bytes", "text_hash", "letters", "stopped", "contexts"])

    return texts.mapInPandas(run, _END.format(id=texts.schema["id"].dataType.simpleString()))


def piles(ends: DataFrame, unit: str) -> DataFrame:
    """(source, upto): lengths just below which a source's distinct texts pile up."""
    counted = ends.dropDuplicates(["source", "text_hash", unit]).groupBy("source", unit).agg(F.count("*").alias("n"))
    by = Window.partitionBy("source").orderBy(unit)
    near, above, below = (F.coalesce(F.sum("n").over(by.rangeBetween(a, b)), F.lit(0)) for a, b in ((1 - REACH, 0), (1, 2 * REACH), (-25 * REACH, -REACH)))
    found = counted.withColumns({"near": near, "above": above, "below": below})
    usual = F.col("below") / 24 + 0.5
    return found.filter((F.col("near") >= PILE) & (F.col("above") <= 0.1 * F.col("near")) & (F.col("near") >= 4 * usual)).select("source", F.col(unit).alias("upto"))


@dataclass
class Contexts:
    h: np.ndarray
    total: np.ndarray
    ends: np.ndarray
    stops: np.ndarray
    base_end: float
    base_stop: float

    def odds(self, contexts: list[int], counted: bool) -> tuple[float, float]:
        """Log of how much likelier than at any position a text ends in this context, and a clause does.

        ``counted``: the text itself is among the endings, and is taken out.
        """
        p, q = self.base_end, self.base_stop
        for h in contexts:
            i = int(np.searchsorted(self.h, h))
            if i >= len(self.h) or self.h[i] != h:
                continue
            total = max(0.0, self.total[i] - counted)
            p = (max(0.0, self.ends[i] - counted) + BACKOFF * p) / (total + BACKOFF)
            q = (self.stops[i] + BACKOFF * q) / (total + BACKOFF)
        return float(np.log(p / self.base_end)), float(np.log(q / self.base_stop))


_BINS = ("kind", "as_end", "as_clause", "n")
_SHARES = "source string, kind string, share_cut double, share_ending double, share_clause double"


def _kind_shares(table: pd.DataFrame, rounds: int = 15) -> dict[str, np.ndarray]:
    """Shares of (cut, whole ending, whole clause) of each kind of ending, from counts of log-odds: EM, each kind drawn to all."""
    odds, n = _odds(table), table["n"].to_numpy(float)[:, None]
    kind, names = pd.factorize(table["kind"])
    shares = np.full((len(names), 3), 1 / 3)
    for _ in range(rounds):
        post = shares[kind] * odds
        post = post / post.sum(1, keepdims=True) * n
        sums = np.zeros((len(names), 3))
        np.add.at(sums, kind, post)
        every = post.sum(0) / max(n.sum(), 1)
        shares = (sums + 2 * every) / (sums.sum(1, keepdims=True) + 2)
    return dict(zip(names, shares))


def _odds(table: pd.DataFrame) -> np.ndarray:
    return np.stack([np.ones(len(table)), np.exp(table["as_end"].to_numpy(float)), np.exp(table["as_clause"].to_numpy(float))], 1)


def _own_shares(table: pd.DataFrame, kinds: dict[str, np.ndarray], rounds: int = 15) -> list[tuple[str, float, float, float]]:
    """The same for each kind of ending of one source, drawn to the kind's."""
    out = []
    for kind, rows in table.groupby("kind"):
        odds, n, share = _odds(rows), rows["n"].to_numpy(float)[:, None], kinds[kind]
        for _ in range(rounds):
            post = share * odds
            sums = (post / post.sum(1, keepdims=True) * n).sum(0)
            share = (sums + 4 * kinds[kind]) / (sums.sum() + 4)
        out.append((kind, *map(float, share)))
    return out


def _weighed(ends: DataFrame, counted: DataFrame, whole: DataFrame, words: Words) -> DataFrame:
    """``ends`` with the log-odds. ``counted``: what the texts hold of the ends' contexts; ``whole``: the ends to learn from."""
    spark = ends.sparkSession
    once = whole.dropDuplicates(["text_hash"]).select(F.explode("contexts").alias("h"))
    once = once.groupBy("h").agg(F.count("*").alias("total")).select("h", "total", F.col("total").alias("ends"), F.lit(0).cast("long").alias("stops"))
    sums = counted.filter("h = -1").first()
    t, e, s = (float(sums[c]) if sums else 0.0 for c in ("total", "ends", "stops"))
    least = max(3.0, CONTEXT_SHARE * t)
    both = counted.filter("h >= 0").unionByName(once).groupBy("h").agg(*[F.sum(c).alias(c) for c in ("total", "ends", "stops")])
    table = both.filter(F.col("total") >= least).toArrow().to_pandas().sort_values("h")  # orders / share rows at most
    e += float(once.agg(F.sum("ends")).first()[0] or 0)
    model = Contexts(*(table[c].to_numpy() for c in ("h", "total", "ends", "stops")), max(1e-6, e / max(1.0, t)), max(1e-6, s / max(1.0, t)))
    known = spark.sparkContext.broadcast((words, model))

    def weigh(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, model = known.value
        for pdf in frames:
            got = []
            for letters, hashes, counted in zip(pdf["letters"], pdf["contexts"], pdf["counted"]):
                word = float(np.log(max(words.whole(letters), 1e-6))) if letters else 0.0
                got.append([float(np.clip(o + word, -CERTAIN, CERTAIN)) for o in model.odds(list(hashes), bool(counted))])
            yield pdf[["id"]].assign(as_end=[a for a, _ in got], as_clause=[b for _, b in got])

    keep = [c for c in ends.columns if c != "counted"]
    kinds = ", ".join(f"{c} {ends.schema[c].dataType.simpleString()}" for c in keep) + ", as_end double, as_clause double"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for extra in weigh(iter([pdf])):
                yield pdf[keep].assign(as_end=extra["as_end"].to_numpy(), as_clause=extra["as_clause"].to_numpy())

    return shared.materialize(ends.mapInPandas(run, kinds), "cut-odds")


def _decided(weighed: DataFrame) -> DataFrame:
    """``weighed`` with the shares of its source and kind, the likelihood of a cut, and the decision.

    Counts of tenths of clipped log-odds by kind come to the driver (241 x 241 a kind at most); those by source are each
    worked on in a task of its own.
    """
    source = F.coalesce("source", F.lit("\0"))
    tenths = [F.round("as_end", 1).alias("as_end"), F.round("as_clause", 1).alias("as_clause")]
    counts = weighed.groupBy(source.alias("source"), "kind", *tenths).agg(F.count("*").alias("n"))
    kinds = _kind_shares(counts.groupBy(*_BINS[:3]).agg(F.sum("n").alias("n")).orderBy(*_BINS[:3]).toArrow().to_pandas())

    def per_source(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = _own_shares(pdf.sort_values(list(_BINS[:3])), kinds)
        return pd.DataFrame([(pdf["source"].iloc[0], *r) for r in rows], columns=[x.split()[0] for x in _SHARES.split(", ")])

    prior = counts.groupBy("source").applyInPandas(per_source, _SHARES).select(F.col("source").alias("p_source"), F.col("kind").alias("p_kind"), "share_cut", "share_ending", "share_clause")
    out = weighed.join(prior, (source == F.col("p_source")) & (F.col("kind") == F.col("p_kind"))).drop("p_source", "p_kind")
    whole = F.col("share_ending") * F.exp("as_end") + F.col("share_clause") * F.exp("as_clause")
    return out.withColumn("p_cut", F.col("share_cut") / (F.col("share_cut") + whole)).withColumn("cut", F.col("p_cut") > 0.5)


def judged(df: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(id, source, kind, as_end, as_clause, p_cut, cut) of every text that does not end in a full stop."""
    texts = _texts(df, id_col, text_col, lang_col, source_col)
    counts = shared.materialize(word_counts(texts), "cut-words")
    per_lang = counts.groupBy("lang").agg(F.sum("n").alias("total"))  # one row a language
    lower = counts.join(F.broadcast(per_lang), "lang").groupBy("lang", "total", F.lower("word").alias("word")).agg(F.sum("n").alias("n"))
    frequent: dict[str, set[str]] = {}
    for r in lower.filter(F.col("n") >= WORD_SHARE * F.col("total")).collect():  # 1 / share rows a language
        frequent.setdefault(r["lang"], set()).add(r["word"])
    totals = counts.agg(F.sum("n").alias("total"), F.sum("ends").alias("all_ends"))
    by_word = counts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))
    words = Words.of({r["word"]: r["n"] for r in by_word.join(F.broadcast(totals), (F.col("n") >= LISTED_SHARE * F.col("total")) & (F.col("n") > 0)).select("word", "n").collect()})  # 1 / share rows
    closes = (F.col("ends") >= CLOSING * F.greatest("n", "ends")) & (F.col("ends") >= F.greatest(F.lit(5.0), CLOSING_SHARE * F.col("all_ends")))
    closing = frozenset(r["word"].lower() for r in by_word.join(F.broadcast(totals), closes).select("word").collect())  # 1 / share rows
    reduction = Reduction({g: frozenset(w) for g, w in frequent.items()}, closing)
    ends = shared.materialize(text_ends(texts, reduction), "cut-ends")
    wanted = ends.select(F.explode("contexts").alias("h")).distinct().unionByName(ends.sparkSession.createDataFrame([(-1,)], "h long"))
    wanted, wanted_path = shared.written(wanted, "cut-wanted")
    # only the contexts that some text ends in are ever looked up
    few = wanted.limit(BROADCAST_CONTEXTS + 1).count() <= BROADCAST_CONTEXTS
    only = np.sort(wanted.toArrow().column("h").to_numpy()) if few else None
    counted = _count_contexts(texts, reduction, only)
    counted = shared.materialize(counted if few else counted.join(wanted, "h", "left_semi"), "cut-contexts")
    limits = {unit: piles(ends, unit) for unit in ("chars", "bytes")}
    unstopped = ends.filter(~F.col("stopped"))
    for unit, found in limits.items():
        at = found.select(F.col("source").alias("l_source"), F.explode(F.sequence(F.col("upto") - (REACH - 1), F.col("upto"))).alias("l_size")).distinct()
        at = at.withColumn(f"at_{unit}", F.lit(True))
        unstopped = unstopped.join(at, F.col("source").eqNullSafe(F.col("l_source")) & (F.col(unit) == F.col("l_size")), "left").drop("l_source", "l_size")
    piled = F.coalesce("at_chars", F.lit(False)) | F.coalesce("at_bytes", F.lit(False))
    unstopped = unstopped.withColumn("kind", F.when(piled, F.concat("kind", F.lit("@limit"))).otherwise(F.col("kind"))).select("id", "source", "kind", "text_hash", "letters", "contexts")
    first = _decided(_weighed(unstopped.withColumn("counted", F.lit(True)), counted, unstopped, words))
    first = shared.materialize(first.withColumn("counted", ~F.col("cut")).select("id", "source", "kind", "text_hash", "letters", "contexts", "counted"), "cut-first")
    out = _decided(_weighed(first, counted, first.filter("counted"), words))
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "kind", "as_end", "as_clause", "share_cut", "p_cut", "cut")


def cut_off(df: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(id) of the texts that were cut."""
    return judged(df, id_col, text_col, lang_col, source_col).filter("cut").select(id_col)


def per_source(df: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(source, n_cut, n_texts): how often each source truncates, of all its rows."""
    found = judged(df, id_col, text_col, lang_col, source_col).filter("cut").groupBy(source_col).agg(F.count("*").alias("n_cut"))
    every = df.groupBy(source_col).agg(F.count("*").alias("n_texts"))
    joined = every.join(found.withColumnRenamed(source_col, "found_source"), every[source_col].eqNullSafe(F.col("found_source")), "left")
    return joined.select(source_col, F.coalesce("n_cut", F.lit(0).cast("long")).alias("n_cut"), "n_texts")
