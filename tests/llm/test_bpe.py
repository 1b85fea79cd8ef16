"""Token ids against the public tokenizer library."""

import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspan.llm import bpe

pytestmark = pytest.mark.skipif(not os.path.exists(bpe.vocabulary_path()), reason="no vocabulary here")


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.encode_special_tokens = True
    return t


def ids(texts):
    offsets, flat = bpe.encoder(bpe.vocabulary_path()).encode(texts)
    return [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


ODD = ["", "<|endoftext|>", "aaaaaaaaa", "we'll  \n\n x\x1c\x1d y　z 'sd", "letnone" * 700, "a" * 3000, "\x00\x85 \xa0 é日本語 ٣٤ ² ½", "   ", "x   y", "it's'll", "ἀγάπη אָב‍😀", " lead", "tab\tend\t"]


def test_odd_texts(reference):
    assert ids(ODD) == [reference.encode(t, add_special_tokens=False).ids for t in ODD]


@given(st.lists(st.text(max_size=40), max_size=5))
@settings(max_examples=150, deadline=None)
def test_any_text(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.encode_special_tokens = True
    assert ids(texts) == [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


def test_lengths_equal_the_lists():
    got = bpe.encoder(bpe.vocabulary_path()).lengths([*ODD, None])
    assert got.tolist() == [len(x) for x in ids([*ODD, None])]


def test_table_is_begun_afresh(monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 3)
    e = bpe.Encoder(bpe.vocabulary_path())
    assert [e.encode([w])[1].tolist() for w in ("one two three four", "five", "one two")] == [ids([w])[0] for w in ("one two three four", "five", "one two")]


def test_table_of_texts(spark, data, reference):
    rows = spark.read.parquet(f"{data}/documents.parquet")
    got = {r.doc_id: r.ids for r in bpe.token_ids(rows, "doc_id", "text").collect()}
    texts = {r.doc_id: r.text for r in rows.collect()}
    assert got == {i: reference.encode(t or "", add_special_tokens=False).ids for i, t in texts.items()}


def test_nulls_empties_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, None, 5), (2, "", 6), (None, "a", 7), (2, "", 6)], "id long, text string, ids int")
    got = bpe.token_ids(rows, "id", "text")
    assert got.columns == ["id", "ids"] and sorted(map(str, got.collect())) == sorted(["Row(id=1, ids=[])", "Row(id=2, ids=[])", "Row(id=2, ids=[])", "Row(id=None, ids=[64])"])
    assert bpe.token_ids(rows.limit(0), "id", "text").count() == 0


def test_slices_cover_all():
    texts = ["a" * n for n in (5, 0, 9, 2)] + [None]
    parts = list(bpe.slices(texts, 6))
    assert np.concatenate([np.arange(a, b) for a, b in parts]).tolist() == list(range(5))


def test_ids_stand_for_the_texts(same_rows):
    from quillspan.llm import queries

    same_rows(queries.p6_texts, queries.SQL["p6_texts"])
