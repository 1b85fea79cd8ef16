"""Pieces: under the limit, at boundaries, overlapping, and the whole text again."""

from hypothesis import given, settings
from hypothesis import strategies as st

from quillspan.llm import queries, splitter
from quillspan.llm.splitter import cuts, split_oversized
from pyspark.sql import functions as F


def check(text, limit, overlap):
    where = cuts(text, limit, overlap)
    assert where[0][0] == 0 and where[-1][1] == len(text) and all(0 <= b - a <= limit for a, b in where)
    joined = text[: where[0][1]]
    for (_, b), (a2, b2) in zip(where, where[1:]):
        assert a2 == b - overlap and b2 > b
        joined += text[b:b2]
    assert joined == text
    return where


@given(st.text(alphabet="ab .\n\r\t́é!日。", max_size=400), st.integers(10, 60), st.integers(0, 4))
@settings(max_examples=300, deadline=None)
def test_round_trip(text, limit, overlap):
    check(text, limit, overlap)


def test_boundaries_in_their_order():
    paragraphs = ("word " * 9 + "end.\n\n") * 6
    for (_, b) in check(paragraphs, 160, 10)[:-1]:
        assert paragraphs[:b].endswith("\n\n")
    sentences = ("word " * 9 + "end. ") * 9
    for (_, b) in check(sentences, 160, 10)[:-1]:
        assert sentences[:b].endswith(". ")
    words = "word " * 90
    for (_, b) in check(words, 157, 10)[:-1]:
        assert words[:b].endswith(" ")
    assert len(check("x" * 1000, 100, 20)) == 13


def test_no_mark_is_parted_from_its_letter():
    text = "é" * 200
    for (_, b) in check(text, 101, 10)[:-1]:
        assert text[b] != "́"


def test_table(spark):
    rows = spark.createDataFrame([("a", "x" * 6000, "x" * 7000, 1), ("b", "y" * 6001, None, 1), ("c", None, None, 1), ("d", "", None, 1), ("e", " \n" + "z" * 6000 + "\t", None, 1), (None, "q", None, 1)], "id string, text string, whole string, piece int")
    got = {}
    for r in split_oversized(rows, "id", "text", whole=F.col("whole")).collect():
        got.setdefault(r.id, []).append((r.piece, r.pieces, None if r.text is None else len(r.text), r.truncated))
    assert got["a"] == [(0, 1, 6000, True)] and sorted(got["b"]) == [(0, 2, 6000, False), (1, 2, 201, False)]
    assert got["c"] == [(0, 1, None, False)] and got["d"] == [(0, 1, 0, False)] and got["e"] == [(0, 1, 6000, False)] and got[None] == [(0, 1, 1, False)]
    assert split_oversized(rows.limit(0), "id", "text").count() == 0


def test_other_scripts_count_code_points(spark):
    rows = spark.createDataFrame([("a", "𐌺" * 6001)], "id string, text string")
    assert sorted(len(r.text) for r in split_oversized(rows, "id", "text").collect()) == [201, 6000]


def test_query_equals_its_sql(same_rows):
    same_rows(queries.QUERIES["p3_found"], queries.SQL["p3_found"])


def test_all_chunks_come_out(spark, data):
    pieces = queries.p3_pieces(spark, data)
    chunk = spark.read.parquet(f"{data}/chunk.parquet")
    assert pieces.select("chunk_id").distinct().count() == chunk.select("id").distinct().count()
    assert pieces.agg(F.max(F.length("text"))).first()[0] <= 6000


def test_cut_at_white_space_is_truncated(spark, tmp_path):
    comment = "w" * 5999 + " " + "more words."
    rows = [("cut", "commentary", "a", "1", comment[:6000]), ("short", "commentary", "a", "1", comment[:40]), ("all", "commentary", "a", "1", comment + "\n"), ("other", "commentary", "a", "1", "v" * 6000), ("lost", "commentary", "a", "9", comment[:6000])]
    rows += [("titled", "confession", "d", "1", "Of Rivers\nThey ran"), ("section", "confession", "d", "1", "Of Rivers\nThey ran down."), ("plain", "confession", "d", "2", "They"), ("word", "lexicon", "a", "1", comment[:6000])]
    spark.createDataFrame(rows, "id string, resource_type string, source string, key string, text string").write.parquet(f"{tmp_path}/chunk.parquet")
    spark.createDataFrame([("a", "1", comment)] * 2, "commentator string, key string, text string").write.parquet(f"{tmp_path}/comments.parquet")
    spark.createDataFrame([("d", "1", "Of Rivers", "They ran down."), ("d", "2", None, "They ran.")], "document string, key string, title string, text string").write.parquet(f"{tmp_path}/section.parquet")
    got = queries.p3_pieces(spark, str(tmp_path)).collect()
    assert {r.chunk_id for r in got if r.truncated} == {"cut", "short", "titled", "plain"}
    last = {r.chunk_id: r for r in got if r.piece == r.pieces - 1}
    assert len(last) == len(rows) and last["all"].pieces == 2


def test_pieces_keep_what_must_hold(same_rows):
    same_rows(queries.p3_invariants, queries.SQL["p3_invariants"])


def test_invariants_see_what_is_wrong(spark):
    rows = spark.createDataFrame([("a", "x" * 30), ("b", "y")], "id string, text string")
    pieces = spark.createDataFrame([("a", 0, 2, 0, "x" * 20), ("a", 1, 2, 18, "z" * 12)], "id string, piece int, pieces int, begins_at int, text string")
    got = splitter.invariants(rows, "id", "text", pieces, 15, 2).first().asDict()
    assert got == {"n_rows": 2, "n_not_whole": 2, "n_without_overlap": 1, "n_over_limit": 1}
