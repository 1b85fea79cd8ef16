"""The index queries against brute force over the reference tokenizer's forms, also with forms the test tables lack."""

import math
import re
import unicodedata
from collections import Counter

import pytest

from quillspan.operators.bm25 import B, K1
from quillspan.plans import corpus_queries as queries

TEXTS = [
    (1, "The ﬁrst oﬃce: mercy by the river, Straße", "sermon"),
    (2, "Psalm Ⅻ, １２３ and ｍｅｒｃｙ; covenant", "letter"),
    (3, "café and café, the LORD'S river", "sermon"),
    (4, "ſong of the covenant, the covenant x²", "list"),
    (5, "mercy mercy", None),
    (6, "", "letter"),
    (7, None, "sermon"),
]


def tokens(text):
    return re.findall("[a-z0-9]+(?:'[a-z0-9]+)*", unicodedata.normalize("NFKC", text or "").casefold())


DOCS = {i: tokens(t) for i, t, _ in TEXTS}


def stats(docs):
    total = sum(map(len, docs.values()))
    return {"n_docs": len(docs), "avgdl": round(total / len(docs), 6), "total_tokens": total, "vocab_size": len({t for ts in docs.values() for t in ts}), "k1": K1, "b": B}


def scores():
    avgdl = sum(map(len, DOCS.values())) / len(DOCS)
    out = Counter()
    for term in queries.QUERY:
        df = sum(term in ts for ts in DOCS.values())
        for i, ts in DOCS.items():
            if tf := ts.count(term):
                out[i] += math.log(1 + (len(DOCS) - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ts) / avgdl))
    return out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    spark.createDataFrame(TEXTS, "doc_id long, text string, resource_type string").write.parquet(f"{path}/documents.parquet")
    return path


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_lengths_postings_and_terms(spark, tables):
    assert {"first", "office", "xii", "123", "strasse", "song", "x2"} <= {t for ts in DOCS.values() for t in ts}
    assert rows(queries.doc_token_lengths(spark, tables)) == sorted((i, len(ts)) for i, ts in DOCS.items())
    assert rows(queries.bm25_postings(spark, tables)) == sorted((t, i, n) for i, ts in DOCS.items() for t, n in Counter(ts).items())
    df = Counter(t for ts in DOCS.values() for t in set(ts))
    assert [(t, n) for t, n, _ in sorted(rows(queries.bm25_terms(spark, tables)), key=lambda r: r[2])] == sorted(df.items())


def test_statistics(spark, tables):
    assert {r.key: r.value for r in queries.bm25_stats(spark, tables).collect()} == stats(DOCS)
    scope = {i: DOCS[i] for i, _, kind in TEXTS if kind in ("sermon", "letter")}
    assert {r.key: r.value for r in queries.scoped_bm25_stats(spark, tables).collect()} == stats(scope)


def test_scores(spark, tables):
    want = scores()
    assert {r.doc_id: r.score for r in queries.bm25_topk(spark, tables).collect()} == pytest.approx(want, abs=2e-6)
    vectors = {0: [1.0, 0.0], 1: [0.5, 0.5], 3: [0.9, 0.1], 9: [0.0, 1.0]}
    spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>").write.mode("overwrite").parquet(f"{tables}/embeddings.parquet")
    ranks = [sorted(want, key=lambda i: (-want[i], i)), sorted(vectors, key=lambda i: -vectors[i][0])]
    fused = {i: sum(1 / (60 + r.index(i) + 1) for r in ranks if i in r) for i in set(want) | set(vectors)}
    assert {r.doc_id: r.score for r in queries.hybrid_topk(spark, tables).collect()} == pytest.approx(fused, abs=2e-6)
