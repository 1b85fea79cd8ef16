"""Byte-level BPE of whole text columns in batched numpy merge rounds.

The symbols of many distinct words lie in one flat array. A round looks up the rank of every
adjacent pair by binary search over the sorted pair keys, merges in every word its lowest-ranked
pair, and takes out the words that have none left. Words are encoded once per worker and kept in a
bounded table; documents are then assembled by gathering.

Defined results: a null or an empty text has an empty list. Strings of special tokens are ordinary
text. Lone surrogates cannot reach a Spark string, so every text is valid UTF-8.
"""

from __future__ import annotations

import functools
import heapq
import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.json"
#: Words of more bytes than this are merged with a heap, one at a time: their many rounds would each touch few symbols.
LONG_WORD = 128
#: A worker's table of encoded words is begun afresh beyond this many words.
WORDS_KEPT = 400_000
#: Characters encoded together.
BATCH_CHARS = 4_000_000

# The split pattern of byte-level BPE, with the Unicode White_Space class spelt out.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPLIT = (
    r"'(?:[sdmt]|ll|ve|re)"
    r"| ?\p{L}+"
    r"| ?\p{N}+"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])"
    rf"|[{_SPACE}]+"
)
_SPLIT_ASCII = (
    r"'(?:[sdmt]|ll|ve|re)"
    r"| ?[A-Za-z]+"
    r"| ?[0-9]+"
    r"| ?[^\t-\r A-Za-z0-9]+"
    r"|[\t-\r ]+(?![^\t-\r ])"
    r"|[\t-\r ]+"
)


def _printable_bytes() -> dict[str, int]:
    """The vocabulary file writes each byte as a printable character: itself, or the next free one from 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """One vocabulary with its word table."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, merges = model["vocab"], model["merges"]
        self.byte_id = np.zeros(256, np.int32)
        for char, byte in _printable_bytes().items():
            self.byte_id[byte] = vocab[char]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.base = np.int64(max(vocab.values()) + 1)
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int32), made[order]
        self.none = np.int32(len(pairs))
        byte_of = _printable_bytes()
        self.spelt = np.full(int(self.base), b"", object)
        for word, i in vocab.items():
            if all(ch in byte_of for ch in word):  # special tokens never come out of a text
                self.spelt[i] = bytes(byte_of[ch] for ch in word)
        self.split = regex.compile(_SPLIT).findall
        self.split_ascii = re.compile(_SPLIT_ASCII).findall
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 15, np.int64)
        self.length = np.zeros(1 << 15, np.int32)
        self.filled = 0

    def _pair_ranks(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = sym[:-1] * self.base + sym[1:]
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        rank = np.where(self.keys[at] == keys, self.rank[at], self.none)
        return rank, at

    def _heap_merge(self, word: bytes) -> np.ndarray:
        sym = [int(x) for x in self.byte_id[np.frombuffer(word, np.uint8)]]
        n = len(sym)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        rank0, at0 = self._pair_ranks(np.array(sym, np.int64))
        heap = [(int(r), i, sym[i], sym[i + 1], int(a)) for i, (r, a) in enumerate(zip(rank0, at0)) if r < self.none]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, at = heapq.heappop(heap)
            j = after[i] if sym[i] == a else n
            if j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = int(self.made[at]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n:
                    key = sym[x] * int(self.base) + sym[y]
                    k = int(np.searchsorted(self.keys, key))
                    if k < len(self.keys) and self.keys[k] == key:
                        heapq.heappush(heap, (int(self.rank[k]), x, sym[x], sym[y], k))
        return np.array([s for s in sym if s >= 0], np.int32)

    def _rounds(self, words: list[bytes]) -> list[np.ndarray]:
        done: list[np.ndarray | None] = [None] * len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)].astype(np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        while len(sym):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rank = np.full(len(sym), self.none, np.int32)
            at = np.zeros(len(sym), np.int64)
            if len(sym) > 1:
                rank[:-1], at[:-1] = self._pair_ranks(sym)
                rank[first[1:] - 1] = self.none  # a pair never spans two words
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(sym)])
            if (ready := least == self.none).any():
                for k in np.flatnonzero(ready):
                    done[owner[first[k]]] = sym[first[k] : first[k] + size[k]].astype(np.int32)
                keep = np.repeat(~ready, size)
                sym, owner, rank, at, least, size = sym[keep], owner[keep], rank[keep], at[keep], least[~ready], size[~ready]
                if not len(sym):
                    break
            hit = rank == np.repeat(least, size)
            # of overlapping equal pairs (x x x) every other one, from the left
            if (both := hit[1:] & hit[:-1]).any():
                where = np.arange(len(hit))
                run = np.maximum.accumulate(np.where(hit & ~np.r_[False, both], where, 0))
                hit &= (where - run) % 2 == 0
            i = np.flatnonzero(hit)
            sym[i] = self.made[at[i]]
            keep = np.ones(len(sym), bool)
            keep[i + 1] = False
            sym, owner = sym[keep], owner[keep]
        return done  # type: ignore[return-value]

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        short = [i for i, w in enumerate(raw) if len(w) <= LONG_WORD]
        out: dict[int, np.ndarray] = dict(zip(short, self._rounds([raw[i] for i in short]))) if short else {}
        for i, w in enumerate(raw):
            if i not in out:
                out[i] = self._heap_merge(w)
        lengths = np.array([len(out[i]) for i in range(len(words))], np.int32)
        total, n0 = int(lengths.sum()), len(self.index)
        while self.filled + total > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        while n0 + len(words) > len(self.start):
            self.start, self.length = np.r_[self.start, np.zeros_like(self.start)], np.r_[self.length, np.zeros_like(self.length)]
        self.ids[self.filled : self.filled + total] = np.concatenate([out[i] for i in range(len(words))])
        self.start[n0 : n0 + len(words)] = self.filled + np.cumsum(lengths) - lengths
        self.length[n0 : n0 + len(words)] = lengths
        self.filled += total
        self.index.update(zip(words, range(n0, n0 + len(words))))

    def _words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(table entries of all words, number of words of each text)."""
        if len(self.index) > WORDS_KEPT:
            self._forget()
        split = [(self.split_ascii if t.isascii() else self.split)(t) if t else [] for t in texts]
        every = [w for words in split for w in words]
        if new := list(dict.fromkeys(w for w in every if w not in self.index)):
            self._learn(new)
        return np.fromiter(map(self.index.__getitem__, every), np.int64, len(every)), np.array([len(x) for x in split], np.int64)

    def lengths(self, texts: list[str | None]) -> np.ndarray:
        entry, per_text = self._words(texts)
        ends = np.r_[0, np.cumsum(self.length[entry], dtype=np.int64)]
        at = np.r_[0, np.cumsum(per_text)]
        return ends[at[1:]] - ends[at[:-1]]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) in the layout of an Arrow list array."""
        entry, per_text = self._words(texts)
        size = self.length[entry].astype(np.int64)
        ends = np.r_[0, np.cumsum(size)]
        gather = np.repeat(self.start[entry] - ends[:-1], size) + np.arange(ends[-1])
        return ends[np.r_[0, np.cumsum(per_text)]], self.ids[gather]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def ship(spark: SparkSession, path: str) -> Callable[[], Encoder]:
    """Send the vocabulary file with the job, so that only the driver need have it. What is returned makes the encoder on an executor."""
    spark.sparkContext.addFile(path)
    name = os.path.basename(path)
    return lambda: encoder(SparkFiles.get(name))


def vocabulary_path(directory: str | None = None, name: str = VOCABULARY) -> str:
    return os.path.join(directory or TOKENIZER_DIR, name)


def slices(texts: list[str | None], most: int = BATCH_CHARS) -> Iterator[tuple[int, int]]:
    begin = chars = 0
    for i, t in enumerate(texts):
        chars += len(t) if t else 0
        if chars >= most:
            yield begin, i + 1
            begin, chars = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def decoded(df: DataFrame, id_col: str, ids_col: str, path: str | None = None) -> DataFrame:
    """(id, text): the text that a list of ids stands for; a null list stays null."""
    make = ship(df.sparkSession, path or vocabulary_path())
    kind = df.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = make()
        for batch in batches:
            lists = batch.column(1)
            parts = enc.spelt[lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)].tolist()
            ends = np.r_[0, np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]
            texts = [b"".join(parts[a:b]).decode() if valid else None for a, b, valid in zip(ends[:-1], ends[1:], lists.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("text", T.StringType())])
    return df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def token_ids(df: DataFrame, id_col: str, text_col: str, path: str | None = None, out: str = "ids") -> DataFrame:
    """(id, list of token ids) of every row. A narrow map: no shuffle, two columns read.

    Rows are kept as they are, repeats included; further columns, whatever their names, are not read.
    """
    make = ship(df.sparkSession, path or vocabulary_path())
    kind = df.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = make()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts):
                offsets, ids = enc.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["id", "ids"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    got = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
    return got.select(F.col("id").alias(id_col), F.col("ids").alias(out))
