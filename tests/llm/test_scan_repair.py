"""Scanned text: each kind of noise, and what is none."""

import random
from dataclasses import replace

import pytest

from quillspan.llm import queries, scan_repair
from quillspan.llm.scan_repair import Corpus, analyse, edge_key, is_page_number, page_numbers

WORDS = "the of and river mountain harvest inheritance wonderful therefore establishes soul-stirring well-known far-off prudent there was neither tower nor we have here a who restores shall be before olive deliver dim writer this".split()


@pytest.fixture(scope="module")
def corpus():
    key = edge_key("THE LANTERN OF HYMNS. 12")
    return Corpus({w: 100 for w in WORDS}, frozenset({key, edge_key("HYMN THE FIRST. 3"), edge_key("[HYMN CIV.")}), frozenset({edge_key("EXPLANATORY NOTES."), edge_key("HYMN IV.")}), names=frozenset({"harvett"}))


@pytest.mark.parametrize("line", ["12", "[12]", "- 12 -", "— 112 —", "p. 377", "12.", "l2", "9O1", "115 P", "xiv", "4l1", "1^7"])
def test_page_numbers(line):
    assert is_page_number(line)


@pytest.mark.parametrize("line", ["it.", "be.", "12 and so", "mix it.", "", "the", "EXPOSITION."])
def test_no_page_numbers(line):
    assert not is_page_number(line)


def test_header_keys_are_fuzzy():
    assert edge_key("THE LANTEBN OF HYMK5. 12") == edge_key("13 THE LANTERN OF HYMNS.") == edge_key("  99      The Lantern Of Hymns") != ""
    assert edge_key("the river of") == "" and edge_key("Velperack of Weslan") == ""


def kinds(text, corpus):
    return analyse(text, corpus)[1]


def test_hyphens(corpus):
    for mark in "-\xad‐¬":
        assert analyse(f"the moun{mark}\ntain of", corpus) == ("the mountain of", ["hyphen"])
    assert kinds("the moun- \ntain", corpus) == ["hyphen"]
    assert analyse("the soul-\nstirring tower", corpus) == ("the soul-stirring tower", [])
    assert analyse("the soul-\nstirriug tower", corpus)[1] == ["misread"]
    assert analyse("of Per-\nbelan", corpus) == ("of Perbelan", ["hyphen"])
    assert kinds("the moun-", corpus) == [] and kinds("the tower —\nthe river", corpus) == []


def test_furniture_between_the_parts(corpus):
    assert analyse("the inheri-\n\n  [HYMN CIV.\n\ntance of the\n 117\nriver.", corpus) == ("the inheritance of the river.", ["header", "hyphen", "page_no"])


def test_headers_and_heads(corpus):
    assert analyse("EXPLANATORY NOTES.\n\nthe river", corpus) == ("EXPLANATORY NOTES.\n\nthe river", [])
    assert analyse("12\nHYMN IV.\nthe river", corpus) == ("HYMN IV.\n\nthe river", ["page_no"])
    assert kinds("the river\nTHE LANTFRN OF HYMNS. 99\nof", corpus) == ["header"]
    assert kinds("HYMN THE FIBST. 3\nthe river", corpus) == ["header"]


@pytest.mark.parametrize("seen,printed", [("tbe", "the"), ("inheiitance", "inheritance"), ("w0nderful", "wonderful"), ("rnountain", "mountain"), ("har*vest", "harvest"), ("har^est", "harvest"), ("hatvest", None), ("tliere", "there"), ("ohve", "olive"), ("clim", "dim"), ("haſ", None), ("deli\\'er", "deliver"), ("wnter", "writer")])
def test_misread(seen, printed, corpus):
    assert corpus.printed(seen) == printed


def test_what_is_not_misread(corpus):
    assert kinds("the santhalmond of Belor, κόσμος, lxviii. 3, and 12", corpus) == []
    assert kinds("we have here Hatvest. Harvett was neither tower.The river", corpus) == []
    assert analyse("Tbe river. Thcre was", corpus) == ("The river. There was", ["misread"])


def test_paragraphs(corpus):
    assert analyse("the river of\nthe tower.\n\nthe mountain\r\nof the olive", corpus) == ("the river of the tower.\n\nthe mountain of the olive", [])
    assert analyse("", corpus) == ("", []) and analyse(" \n\n ", corpus) == ("", [])


def test_corpus_travels(corpus):
    import pickle

    assert pickle.loads(pickle.dumps(corpus)).printed("tbe") == "the"


def test_tables(spark):
    comments = spark.createDataFrame([("s", "k", "notes"), ("s", "l", "notes"), ("s", "m", None), ("c", "k", None), ("c", "l", "notes"), ("c", "m", None), (None, "x", None)], "commentator string, key string, component string")
    assert [r.source for r in scan_repair.scanned_sources(comments).collect()] == ["s"]
    clean = "the wonderful river establishes the mountain. " * 5
    rows = [("1", "c", clean), ("2", "s", "the won-\nderful river\nLAMP OF ALL. 12\ntbe mountain"), ("3", "s", "the river\nLAMP OF ALL. 13\nthe river"), ("4", "s", None), ("5", "s", ""), ("6", None, "x"), ("7", "s", "the river. " * 3000), ("2", "s", "the won-\nderful river\nLAMP OF ALL. 12\ntbe mountain")]
    texts = spark.createDataFrame([(*r, 1, 2) for r in rows], "id string, source string, text string, scan_salt int, noise int")
    marked = scan_repair.marked(texts.select("id", "source", "text"), "source", scan_repair.scanned_sources(comments))
    corpus = scan_repair.learn(marked)
    got = {r.id: (r.text, r.noise) for r in scan_repair.repaired(marked.filter("scanned"), corpus, ["id"]).collect()}
    assert got["2"] == ("the wonderful river the mountain", ["header", "hyphen", "misread"]) and got["4"] == (None, []) and got["5"] == ("", []) and got["7"][1] == []
    assert set(got) == {"2", "3", "4", "5", "7"}
    empty = scan_repair.learn(marked.limit(0))
    assert empty.words == {} and scan_repair.repaired(marked.limit(0), empty, ["id"]).count() == 0


def test_many_sources_are_joined_with_salt(spark, monkeypatch):
    monkeypatch.setattr(scan_repair, "BROADCAST_SOURCES", 1)
    texts = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y"), ("3", "c", None)], "id string, source string, text string")
    sources = spark.createDataFrame([("a",), ("b",), ("d",)], "source string")
    assert sorted((r.id, r.scanned) for r in scan_repair.marked(texts, "source", sources).collect())[:2] == [("1", True), ("2", True)]
    assert scan_repair.marked(texts, "source", sources).count() == 3


def test_test_table(spark, data):
    got = queries.p4_found(spark, data)
    assert got.columns == ["chunk_id", "noise"] and {r.noise for r in got.collect()} <= {"hyphen", "misread", "header", "page_no"}
    assert queries.p4_chunks(spark, data).select("chunk_id").distinct().count() == spark.read.parquet(f"{data}/chunk.parquet").select("id").distinct().count()
    assert queries.p4_comments(spark, data).count() > 0


@pytest.mark.parametrize("line", ["I", "O", "II.", "VI", "1.", "5", "1689"])
def test_numbers_of_the_text_stay(corpus, line):
    """What may be a list's number, a section's numeral or a year is left where nothing shows a page's edge."""
    known = replace(corpus, page_most=500)
    text = f"the river of the mountain.\n{line}\nThe harvest and the river."
    assert analyse(text, known) == (f"the river of the mountain. {line} The harvest and the river.", [])


@pytest.mark.parametrize("text", ["the river of\n{}\nthe mountain", "the river.\n{}\nHYMN THE FIRST. 3\nThe mountain", "{}\nthe mountain and the river", "the river of\n\n{}\n\nthe mountain"])
@pytest.mark.parametrize("line", ["12", "- 12 -", "p. 377", "12.", "xiv"])
def test_page_numbers_at_edges(corpus, text, line):
    assert "page_no" in analyse(text.format(line), replace(corpus, page_most=500))[1]


def test_page_numbers_in_sequence(corpus):
    known = replace(corpus, page_most=500)
    assert page_numbers(["the river of", "12", "the mountain.", "13.", "The harvest."], set(), 500) == {1, 3}
    assert page_numbers(["the mountain.", "13.", "The harvest."], set(), 500) == set()
    assert analyse("the river of\n1689\nthe mountain", known) == ("the river of 1689 the mountain", [])


def test_fuzzy_keys_are_those_near_by_brute_force():
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ABC ") for _ in range(n))
    keys = frozenset(word(rng.randint(1, 40)) for _ in range(300))
    index = scan_repair.Fuzzy(keys, scan_repair._edits)
    for _ in range(400):
        k = list(rng.choice(sorted(keys)))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(k) + 1)
            k[at : at + rng.randint(0, 1)] = rng.choice(["", "A", "B"])
        k = "".join(k)
        assert index.has(k) == any(scan_repair._near(k, x, scan_repair._edits(len(k))) for x in keys), k


def test_words_of_any_length_and_with_any_specks(corpus):
    long = "x" * 50 + "river"
    known = replace(corpus, words=corpus.words | {long: 9})
    assert known.printed("r.i•v^e'r") == "river" and known.printed("x" * 50 + "riv•r") == long and known.printed("r•i•v•e•r") == "river"
    assert known.printed("thc") == "the" and known.printed("zzz") is None


def test_misread_words_of_heads(corpus):
    known = replace(corpus, words=corpus.words | {"this": 9})
    assert analyse("WORKS UPON fHIS HYMN.\n\nthe river", known) == ("WORKS UPON THIS HYMN.\n\nthe river", ["misread"])
