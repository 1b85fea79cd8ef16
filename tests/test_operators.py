"""Operators on small inputs, the odd cases among them."""

import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspan.functions import citations
from quillspan.functions import text as tx
from quillspan.operators import bm25, chunking, dense, incremental, membership, ordered, packaging, validation
from quillspan.sources import canon, files, usfm


def column(df, name):
    return [r[name] for r in df.collect()]


@pytest.mark.parametrize("n", [1, 3, 9, 10, 11, 13, 14, 20, 23, 24, 47])
def test_pericopes(spark, n):
    got = ordered.pericopes(spark.range(1, n + 1).withColumn("k", F.lit(1)), ["k"], [F.col("id")]).orderBy("id")
    want, i = [], 0
    while i < n:
        end = n if 0 < n - min(i + 10, n) < 4 else min(i + 10, n)
        want += [len(set(want))] * (end - i)
        i = end
    assert column(got, "window") == want


def test_gaps_and_missing(spark):
    rows = spark.createDataFrame([("a", x) for x in (2, 3, 3, 7)] + [("b", 1), ("b", None)], "k string, n int")
    assert sorted(map(tuple, ordered.gaps(rows, ["k"], "n").collect())) == [("a", 1, 1), ("a", 4, 6)]
    assert sorted(map(tuple, ordered.missing_numbers(rows, ["k"], "n").collect())) == [("a", 1), ("a", 4), ("a", 5), ("a", 6)]
    assert ordered.gaps(rows.limit(0), ["k"], "n").count() == 0


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
def test_dense_ids(spark, n):
    got = ordered.dense_ids(spark.range(n).select((F.col("id") * 7919 % 1009).alias("x")), ["x"])
    assert [r.idx for r in got.orderBy("x").collect()] == list(range(n))


def test_values_at_shares(spark):
    rows = spark.createDataFrame([(float(x),) for x in (5, 1, 4, 2, 3)] + [(None,)], "v double")
    got = ordered.at_shares(rows, "v", {"half": 0.5, "p90": 0.9, "all": 1.0}).first()
    assert tuple(got) == (3.0, 5.0, 5.0)


def test_anchored_takes_the_next_before_the_first(spark):
    rows = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "b")], "i int, v string").withColumn("k", F.lit(1))
    got = ordered.anchored(rows, ["k"], F.col("v"), [F.col("i")], "x").orderBy("i")
    assert column(got, "x") == ["a", "a", "a", "b"]
    assert column(ordered.carried_forward(rows, ["k"], "v", [F.col("i")], "x").orderBy("i"), "x") == [None, "a", "a", "b"]


def test_sequence_is_repaired(spark):
    rows = spark.createDataFrame([(1, 28), (2, 2), (3, 30)], "i int, m int").withColumn("k", F.lit(1))
    got = ordered.repaired_sequence(rows, ["k"], "m", [F.col("i")]).orderBy("i")
    assert column(got, "number") == [28, 29, 30] and column(got, "repaired") == [False, True, False]


def test_spine(spark):
    verse = spark.createDataFrame([("PSA", 119, 176), ("3JN", 1, 14)], "book string, chapter int, verse_end int")
    points = spark.createDataFrame([("PSA", 119, 176), ("3JN", 1, 15), ("3JN", 1, 0), ("XXX", 1, 1), (None, 1, 1)], "b string, c int, v int")
    got = membership.resolves(points, membership.spine(verse), "b", "c", F.col("v"), "ok")
    assert column(got.orderBy(F.col("b").desc_nulls_last(), F.col("v").desc()), "ok") == [False, True, False, False, False]
    assert column(membership.resolves(points.filter("v = 0"), membership.spine(verse), "b", "c", F.col("v"), "ok", allow_zero=True), "ok") == [True]


def test_fallback_and_division(spark):
    keys = spark.createDataFrame([("G1",), ("G2A",), ("G3B",), ("G1",)], "k string")
    known = spark.createDataFrame([("G1",), ("G2",)], "s string")
    assert column(membership.orphans_with_fallback(keys, "k", tx.base_key(F.col("k")), known, "s"), "k") == ["G3B"]
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "a")], "x int, m string")
    assert column(membership.in_all(rows, ["x"], "m", rows), "x") == [1]


def test_tokens(spark):
    rows = spark.createDataFrame([("The LORD'S word—straße ﬁre",), ("",), (None,)], "t string")
    got = rows.select(tx.tokens("t").alias("t"))
    assert column(got, "t") == [["the", "lord's", "word", "strasse", "fire"], [], None]


def test_bm25_counts_empty_documents(spark):
    rows = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "id int, text string")
    docs = bm25.documents(rows, "id", "text")
    values = {r.key: r.value for r in bm25.stats(docs).collect()}
    assert values["n_docs"] == 3 and values["avgdl"] == 1.0 and values["vocab_size"] == 2
    assert sorted(map(tuple, bm25.postings(docs).collect())) == [("a", 1, 2), ("b", 1, 1)]
    assert bm25.stats(docs.limit(0)).count() == 6


def test_dense_top_k_breaks_ties_by_id(spark):
    rows = spark.createDataFrame([(i, [1.0, 0.0]) for i in (5, 3, 4)] + [(1, [0.0, 1.0]), (2, None), (9, [1.0])], "id int, v array<float>")
    assert column(dense.top_k(rows, "id", "v", [1.0, 0.0], 3), "id") == [3, 4, 5]


def test_incremental(spark):
    chunks = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "id string, text string")
    make = incremental.HashingEncoder
    vectors, counts = incremental.incremental(chunks, None, "", "id", "text", make)
    assert tuple(counts.first()) == (3, 0, 3, 0) and vectors.count() == 3
    prior = vectors.filter("id <> 'c'").unionByName(spark.createDataFrame([("gone", [0.0] * 64)], "id string, vector array<float>"))
    again, counts = incremental.incremental(chunks, prior, make().revision, "id", "text", make)
    assert tuple(counts.first()) == (3, 2, 1, 1)
    assert sorted(map(str, again.collect())) == sorted(map(str, vectors.collect()))
    assert tuple(incremental.incremental(chunks, prior, "other", "id", "text", make)[1].first()) == (3, 0, 3, 0)


def test_chunks_and_skips(spark):
    sections = spark.createDataFrame([("wcf", "1.1", "Title", "Body"), ("wcf", "1.2", None, "  "), ("wcf", "1.1", "Title", "Body")], "document string, key string, title string, text string")
    made, skips = chunking.confession(sections, spark.createDataFrame([("wcf", "WCF")], "document string, shortcode string"))
    assert [(r.anchor, r.text, r.truncated) for r in made.collect()] == [("WCF 1.1", "Title\nBody", False)]
    assert column(skips, "anchor") == ["WCF 1.2"]
    entries = spark.createDataFrame([("bdb", "", "a.b", "x", None, None, None, None), ("s", "G1", None, "l", "t", "d", None, "k")], "lexicon string, strongs string, raw_key string, lemma string, translit string, definition string, derivation string, kjv_def string")
    made, skips = chunking.lexicon(entries)
    assert column(made, "text") == ["l t — d k"] and column(skips, "anchor") == ["bdb:a.b"]


def test_truncated_at_the_limit(spark):
    rows = spark.createDataFrame([("a" * 6000,), (" " + "a" * 6001 + " ",), (None,)], "t string")
    cut, truncated = tx.capped(F.col("t"))
    assert [tuple(r) for r in rows.select(F.length(cut), truncated).collect()] == [(6000, False), (6000, True), (None, False)]


def test_flags_and_totals(spark):
    rows = spark.createDataFrame([("x",), ("x",), ("y",)], "e string")
    flags = validation.flags([("r", "error", "k", rows, "e"), ("r", "flag", "l", rows.limit(1), "e")])
    assert tuple(validation.totals(flags).first()) == ("r", 3, 1)


def test_packs_are_disjoint_and_whole(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "t string, n int")
    got = packaging.split(rows, F.col("t") == "a")
    assert sorted(column(got, "pack")) == ["bundled", "on_demand", "on_demand"]
    packaging.stable_copy(rows, None, f"{tmp_path}/x")
    listed = packaging.files(spark, f"{tmp_path}/x").filter(F.col("path").endswith(".parquet"))
    acknowledged = packaging.acknowledgements([rows.select(F.lit("r").alias("resource"), F.col("t").alias("id"))])
    body = json.loads(packaging.manifest(listed, acknowledged))
    assert body["total_bytes"] > 0 and len(body["acknowledgements"]) == 3 and not body["ship_ready"]
    assert len(packaging.combined_checksum(listed).first().sha256) == 64


def test_results_do_not_depend_on_the_partitions(spark, data):
    from quillspan.plans import catalogue

    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append([sorted(map(str, catalogue.QUERIES[q](spark, data).collect())) for q in ("canonical_order", "bm25_terms", "p5_found")])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]


def test_canon():
    assert len(canon.ROWS) == 66 and len(canon.OLD) == 39 and canon.ALIASES["1 cor"] == "1CO" and canon.ALIASES["phil"] == "PHP"
    assert canon.ordinal(23) == "TWENTYTHIRD" and canon.ordinal(119) == "HUNDREDANDNINETEENTH" and canon.ordinal(40) == "FORTIETH"


def test_more_citations():
    assert citations.parse("Jude ver. 4")[0] == [("JUD", 1, 4, None)]
    assert citations.parse("Rom. 8:28 to the end; Psalm 73 throughout") == ([("ROM", 8, 28, None)], ["Psalm 73"])
    assert citations.parse("") == ([], [])


@given(st.text(max_size=60))
@settings(max_examples=200, deadline=None)
def test_citations_never_fail(block):
    refs, unparsed = citations.parse(block)
    assert all(b in canon.IDS for b, *_ in refs) and all(isinstance(u, str) for u in unparsed)


@given(st.lists(st.sampled_from(["\\v 1 a", "\\v 2-3 b \\wj c\\wj*", "\\c 2", "\\p", "\\d x", "\\d \\v 1 t", "\\q1 d", "\\s1 h", "\\v x", "e"]), max_size=12))
@settings(max_examples=100, deadline=None)
def test_spans_lie_on_the_text(parts):
    _, verses, _ = usfm.parse("\\id GEN\n\\c 1\n" + "\n".join(parts))
    for v in verses:
        assert all(0 <= a < b <= len(v["text"]) for a, b in v["wj_spans"])


def test_book_files(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(f"{tmp_path}/b.zip", "w") as z:
        z.writestr("2.usfm", "\\id GEN\n\\c 1\n\\v 1 a")
        z.writestr("1.usfm", "\\id TOB\n\\c 1\n\\v 1 b")
        z.writestr("x.txt", "no")
    members = files.zip_members(spark, f"{tmp_path}/b.zip")
    assert sorted(column(members, "member")) == ["1.usfm", "2.usfm"]
    books = spark.createDataFrame([(b,) for b in canon.IDS], "id string")
    assert column(files.in_canon(members, books), "member") == ["2.usfm"]


def test_lines_and_snapshot(spark, tmp_path):
    got = files.lines(files.texts(spark, {"a": "x\r\ny\n\nz\n", "b": ""})).filter("path = 'a'").orderBy("lineno")
    assert [(r.lineno, r.line) for r in got.collect()] == [(1, "x"), (2, "y"), (3, ""), (4, "z")]
    calls = []

    def get(url, dest):
        calls.append(url)
        with open(dest, "w") as f:
            f.write(url)
        import hashlib

        return hashlib.sha256(url.encode()).hexdigest()

    source = {"s": {"url": "u", "file": "f.txt", "version": "1", "license": "PD"}}
    first = files.snapshot(source, str(tmp_path), get=get)
    assert files.snapshot(source, str(tmp_path), get=get) == first and calls == ["u"]
    assert files.require(str(tmp_path), ["f.txt"], ["g.txt"]) == ["g.txt"]
    with pytest.raises(FileNotFoundError):
        files.require(str(tmp_path), ["h"], [])


def test_sqlite_and_prior(spark, tmp_path):
    import sqlite3

    with sqlite3.connect(f"{tmp_path}/a.db") as db:
        db.execute("CREATE TABLE t (x INTEGER, y TEXT)")
        db.execute("INSERT INTO t VALUES (1, 'a')")
    assert [tuple(r) for r in files.sqlite_table(spark, f"{tmp_path}/a.db", "SELECT * FROM t", "x int, y string").collect()] == [(1, "a")]
    assert files.prior_vectors(spark, f"{tmp_path}/none", 2) is None


def test_stream_encodes_every_id_once(spark, tmp_path):
    from quillspan.streaming.incremental import follow

    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, text string")
    src, out, point = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/point"
    rows.write.parquet(src)
    for more in (None, [("b", "y"), ("c", "z")]):
        if more:
            spark.createDataFrame(more, "id string, text string").write.mode("append").parquet(src)
        follow(spark, src, rows.schema, out, point, incremental.HashingEncoder).awaitTermination()
    got = spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    assert sorted(column(got, "id")) == ["a", "b", "c"]


def test_lifecycle(spark, tmp_path, data):
    from quillspan.plans import pipeline

    with open(f"{tmp_path}/a.usfm", "w") as f:
        f.write("\\id GEN\n\\c 1\n" + "\n".join(f"\\v {i} Word {i}." for i in range(1, 13)))
    with open(f"{tmp_path}/edges.txt", "w") as f:
        f.write("From\tTo\tVotes\nGen.1.1\tGen.1.2\t3\nGen.1.1\tGen.9.9\t1\nbad\n")
    t = f"{tmp_path}/tables"
    assert pipeline.build_verses(spark, {"kjv": f"{tmp_path}/a.usfm"}, t)["verse"] == 12
    assert pipeline.build_edges(spark, f"{tmp_path}/edges.txt", spark.read.parquet(f"{t}/verse.parquet"), t) == {"crossref": 2, "flags": 1}
    assert sorted(column(spark.read.parquet(f"{t}/crossref.parquet"), "tgt_resolves")) == [0, 1]
    assert pipeline.extract(spark, t, t) == {"chunk": 1, "skipped": 0}
    meta = pipeline.index(spark, t, t)
    assert meta["n_encoded"] == 1
    assert pipeline.index(spark, t, f"{tmp_path}/again", prior=t, prior_revision=meta["revision"])["n_reused"] == 1
    assert "translations" in pipeline.validate(spark, t)
    assert pipeline.package(spark, t, f"{tmp_path}/pack", "kjv", "none", t, t)["total_bytes"] > 0


def test_vectors_compare(spark):
    a = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "i int, v array<float>")
    got = dense.compared(a, a, "i", "v").first()
    assert tuple(got) == (2, 0.0, 1.0)
    assert np.isclose(np.linalg.norm(incremental.HashingEncoder().encode(["word"])[0]), 1)


@pytest.mark.parametrize("hot", [0.0, 0.6])
def test_spread_computations_equal_the_plain_ones(spark, hot):
    rng = np.random.default_rng(5)
    rows = [(None if rng.random() < 0.1 else "hot" if rng.random() < hot else f"k{int(rng.integers(9))}", int(i), int(i) if rng.random() < 0.2 else None) for i in rng.permutation(600)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    order = [F.col("o")]
    plain = ordered.anchored(ordered.carried_forward(ordered.running_rank(df, ["k"], order), ["k"], "v", order, "f"), ["k"], F.col("v"), order, "a")
    spread = ordered.spread_forward(ordered.spread_rank(df, ["k"], order), ["k"], "v", order, "f", "a")
    show = lambda frame: sorted(map(str, frame.select("k", "o", "v", "rank", "f", "a").collect()))
    assert show(plain) == show(spread)


def test_gaps_of_spans_of_any_length(spark):
    df = spark.createDataFrame([("a", 3, 5), ("a", 4, 4), ("a", 9, 2_000_000_000), ("b", 1, 1), ("c", 5, 4), ("d", -3, 2)], "k string, s int, e int")
    assert sorted(map(tuple, ordered.gaps(df, ["k"], "s", "e").collect())) == [("a", 1, 2), ("a", 6, 8)]
    upto = spark.createDataFrame([("b", 3), ("x", 2), ("a", 4), ("d", 0)], "k string, expected int")
    got = ordered.missing_numbers(df.filter("k <> 'a'"), ["k"], "s", upto)
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 2), ("b", 3), ("c", 1), ("c", 2), ("c", 3), ("c", 4), ("x", 1), ("x", 2)]


def test_sqlite_is_read_by_tasks(spark, tmp_path):
    import sqlite3

    for name in ("a", "b"):
        with sqlite3.connect(tmp_path / f"{name}.sqlite") as db:
            db.execute("CREATE TABLE t (i INTEGER, s TEXT)")
            db.executemany("INSERT INTO t VALUES (?, ?)", [(1, name), (None, None)])
    got = files.sqlite_table(spark, f"{tmp_path}/*.sqlite", "SELECT i, s FROM t", "i int, s string")
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "a"), (1, "b"), (None, None), (None, None)]
