"""Containers: whole, within capacity, and few."""

import math
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspan.llm import bpe, packing

needs_vocabulary = pytest.mark.skipif(not os.path.exists(bpe.vocabulary_path()), reason="no vocabulary here")


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 6), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_window_is_the_fullest(counts):
    from itertools import product

    chosen = packing.fill_window(counts, 30)
    assert all(0 < c <= counts[n] for n, c in chosen.items()) and chosen.get(max(counts), 0) >= 1
    best = max(s for s in (sum(n * k for n, k in zip(counts, ks)) for ks in product(*(range(min(c, 30 // n) + 1) for n, c in counts.items())) if dict(zip(counts, ks))[max(counts)] >= 1) if s <= 30)
    assert sum(n * c for n, c in chosen.items()) == best


@given(st.dictionaries(st.integers(1, 64), st.integers(0, 400), max_size=20))
@settings(max_examples=100, deadline=None)
def test_patterns_use_every_item(counts):
    left = dict(counts)
    for times, chosen in packing.patterns(counts, 64):
        assert sum(n * c for n, c in chosen.items()) <= 64
        for n, c in chosen.items():
            left[n] -= times * c
    assert not any(left.values())


def packed(spark, texts, capacity=16):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return packing.pack(rows, "doc_id", "text", capacity).collect()


@needs_vocabulary
def test_items_are_whole_and_few(spark):
    texts = [" a" * (i % 13 + 1) for i in range(200)] + [" a" * 50, "", None, " a" * 16, " a" * 32]
    got = packed(spark, texts)
    room = {}
    for r in got:
        if r.tokens:
            room[r.container] = room.get(r.container, 0) + r.tokens
    assert {r.container for r in got if not r.tokens} == {None}
    sizes = {}
    for r in got:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.tokens
    assert sizes == {i: (len(t) // 2 if t else 0) for i, t in enumerate(texts)}
    assert max(room.values()) <= 16 and sorted(room) == list(range(len(room)))
    assert len(room) <= math.ceil(sum(sizes.values()) / 16) + 1
    pieces = sorted((r.piece, r.tokens) for r in got if r.doc_id == 200)
    assert pieces == [(0, 16), (1, 16), (2, 16), (3, 2)] and all(len([1 for r in got if r.doc_id == i]) == 1 for i in range(200))


@needs_vocabulary
def test_one_length_holds_most_rows(spark):
    got = packed(spark, [" a"] * 1000 + [" a a a"] * 5)
    assert len({r.container for r in got}) == math.ceil(1015 / 16)


@needs_vocabulary
def test_empty_and_only_empty(spark):
    assert packed(spark, ["x"])[:1] and packing.pack(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text").count() == 0
    assert [(r.tokens, r.container) for r in packed(spark, [None, ""])] == [(0, None), (0, None)]


@needs_vocabulary
def test_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "a b", 9, 9, 9)], "doc_id long, text string, rank int, container int, tokens int")
    assert packing.pack(rows, "doc_id", "text").columns == ["doc_id", "piece", "tokens", "container"]


@needs_vocabulary
def test_test_table_is_near_the_bound(spark, data):
    got = packing.pack(spark.read.parquet(f"{data}/documents.parquet"), "doc_id", "text").collect()
    assert len({r.container for r in got} - {None}) <= math.ceil(sum(r.tokens for r in got) / packing.CAPACITY) + 2


@needs_vocabulary
def test_query_equals_its_sql(same_rows):
    from quillspan.llm import queries

    same_rows(queries.p7_invariants, queries.SQL["p7_invariants"])


@needs_vocabulary
def test_invariants_see_what_is_wrong(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "doc_id long, text string")
    placed = spark.createDataFrame([(1, 0, 3, 0), (1, 1, 3, 0), (2, 0, 12, 0)], "doc_id long, piece int, tokens int, container long")
    assert packing.invariants(rows, "doc_id", placed, 16).first().asDict() == {"n_items": 3, "n_placed": 2, "n_badly_split": 1, "n_overfull": 1, "few_containers": True}
