"""Orphan references on small tables with every odd case, against plain Python."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quillspan.operators import orphans

EDGE = "edge_id long, source string, src_book string, src_chapter int, src_verse int, tgt_book string, tgt_chapter int, tgt_verse int, tgt_end_book string, tgt_end_chapter int, tgt_end_verse int, votes int, loaded_at timestamp_ntz"
SECTION = "document string, key string, proof_texts array<struct<book: string, chapter: int, verse_start: int, verse_end: int>>, loaded_at timestamp_ntz"
VERSE = "translation string, book string, chapter int, verse_start int, verse_end int, loaded_at timestamp_ntz, withdrawn_at timestamp_ntz"
T = lambda y, m=1, d=1: datetime(y, m, d)


@pytest.fixture(scope="module")
def verses(spark):
    rows = [
        ("a", "GEN", 1, 1, 1, T(2020), None), ("a", "GEN", 1, 2, 3, T(2020), None), ("a", "GEN", 1, 4, 4, T(2020), T(2021)), ("b", "GEN", 1, 4, 4, T(2023), None),
        ("a", "GEN", 1, 5, 5, T(2020), T(2021)), ("a", "GEN", 1, 70, 70, T(2022, 6, 15), None), ("a", "GEN", 1, 1, 1, T(2020), None), ("a", "GEN", 1, 9, 8, T(2020), None), ("a", "GEN", 2, 1, 1, None, None),
    ]
    return spark.createDataFrame(rows, VERSE)


def edge(i, start, end=None, at=T(2022, 6), src=("GEN", 1, 1)):
    return (i, "x", *src, *start, *(end or start), 1, at)


def found(spark, edges, sections, verses):
    got = orphans.orphans(spark.createDataFrame(edges, EDGE), spark.createDataFrame(sections, SECTION), verses).collect()
    return sorted((r.ref_table, r.row_key, r.point, r.state, r.ref_month) for r in got)


def test_states(spark, verses):
    edges = [
        edge(1, ("GEN", 1, 3)), edge(2, ("GEN", 1, 4)), edge(3, ("GEN", 1, 5)), edge(4, (" gen ", 1, 6), ("GEN", 1, 6)), edge(5, ("GEN", 1, 70)), edge(6, ("GEN", 1, 70), at=T(2022, 6, 20)),
        edge(7, ("XXX", 9, 9)), edge(8, ("GEN", 1, 9)), edge(9, ("GEN", 1, None)), edge(10, ("GEN", 2, 1), at=T(1990)), edge(11, ("GEN", 1, 1), src=(None, 1, 1)), edge(12, ("GEN", 1, -3)),
    ]
    rows = {(k, p): (s, m) for _, k, p, s, m in found(spark, edges + edges[:4], [], verses)}
    assert rows[("2", "GEN.1.4")] == ("late", "2022-06") and rows[("3", "GEN.1.5")] == ("deleted", "2022-06") and rows[("4", "GEN.1.6")] == ("missing", "2022-06")
    assert rows[("5", "GEN.1.70")] == ("late", "2022-06") and ("6", "GEN.1.70") not in rows and rows[("7", "XXX.9.9")][0] == "missing" and rows[("8", "GEN.1.9")][0] == "missing"
    assert ("10", "GEN.2.1") not in rows and rows[("10", "GEN.1.1")] == ("late", "1990-01") and rows[("12", "GEN.1.-3")][0] == "missing"
    assert not [k for k in rows if k[0] in ("1", "9", "11")]


def test_last_delivery_counts(spark, verses):
    assert found(spark, [edge(1, ("GEN", 1, 4), at=T(2022)), edge(1, ("GEN", 1, 4), at=T(2024))], [], verses) == []
    assert found(spark, [edge(1, ("GEN", 1, 4), at=T(2022)), edge(1, ("GEN", 1, 4), at=T(2022, 3))], [], verses) == [("crossref", "1", "GEN.1.4", "late", "2022-03")]


def test_proofs(spark, verses):
    p = [("GEN", 1, 1, None), ("GEN", 1, 6, 7), ("GEN", 1, 6, 7), ("gen", 1, 8, None), (None, 1, 1, 1)]
    rows = [("d", "k", p, T(2022)), ("d", "k", p, T(2022)), ("d", "e", None, T(2022)), ("d", "f", [], T(2022))]
    assert found(spark, [], rows, verses) == [("section", "d/k", f"GEN.1.{v}", "missing", "2022-01") for v in (6, 7, 8)]


def test_null_times(spark, verses):
    got = found(spark, [edge(1, ("GEN", 1, 6), at=None), edge(2, ("GEN", 1, 4), at=None)], [], verses)
    assert got == [("crossref", "1", "GEN.1.6", "missing", None)]


def test_empty_tables(spark, verses):
    assert found(spark, [], [], verses) == []
    assert {x[3] for x in found(spark, [edge(1, ("GEN", 1, 1))], [], verses.limit(0))} == {"missing"}


def test_hot_key_and_clashing_columns(spark, verses):
    edges = spark.range(20_000).select(
        F.col("id").alias("edge_id"), F.lit("x").alias("source"), *[F.lit("GEN").alias(f"{p}_book") for p in ("src", "tgt", "tgt_end")], *[F.lit(1).alias(f"{p}_chapter") for p in ("src", "tgt", "tgt_end")],
        F.lit(1).alias("src_verse"), F.lit(5).alias("tgt_verse"), F.lit(5).alias("tgt_end_verse"), F.lit(T(2022)).cast("timestamp_ntz").alias("loaded_at"), F.lit(1).alias("bits"), F.lit("y").alias("range_id"), F.lit("z").alias("state"),
    )
    got = orphans.orphans(edges, spark.createDataFrame([], SECTION), verses.withColumn("held", F.lit(1)))
    assert got.count() == 20_000 and [r.state for r in got.select("state").distinct().collect()] == ["deleted"]


def test_survivors_beyond_the_bound_are_shuffled(spark, verses, monkeypatch):
    edges = [edge(1, ("GEN", 1, 6)), edge(2, ("GEN", 1, 4)), edge(3, ("GEN", 1, 5)), edge(4, ("GEN", 1, 2))]
    want = found(spark, edges, [], verses)
    monkeypatch.setattr(orphans, "BROADCAST_WORDS", 0)
    assert found(spark, edges, [], verses) == want and len(want) == 3


def test_spans_of_any_length(spark):
    rows = [("a", "GEN", 1, 1, 2_000_000_000, T(2020), None), ("a", "GEN", 2, 60, 70, T(2020), None), ("a", "GEN", 3, 10, 700, T(2020), T(2021)), ("a", "GEN", 3, 100, 300, T(2023), None)]
    verses = spark.createDataFrame(rows, VERSE)
    points = [(1, v) for v in (0, 1, 63, 64, 127, 128, 1_000_000, 1_999_999_999, 2_000_000_000, 2_000_000_001)] + [(2, v) for v in (59, 60, 63, 64, 70, 71)]
    points += [(3, v) for v in (9, 10, 63, 64, 99, 100, 127, 128, 191, 192, 300, 301, 640, 700, 701)]
    edges = [edge(i, ("GEN", c, v)) for i, (c, v) in enumerate(points)]
    got = {k: s for _, k, _, s, _ in found(spark, edges, [], verses)}
    want = {}
    for i, (c, v) in enumerate(points):
        over = [r for r in rows if r[2] == c and r[3] <= v <= r[4]]
        live = [r[5] for r in over if r[6] is None]
        state = "missing" if not over else "deleted" if not live else "late" if min(live) > T(2022, 6) else None
        if state:
            want[str(i)] = state
    assert got == want
