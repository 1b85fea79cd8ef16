"""Cut texts: cuts planted in whole texts are found again, whole endings are left alone."""

import random

import pytest

from quillspan.llm import cutoff, queries

SCHEMA = "doc_id long, text string, lang string, source string"
NOUNS = "river tower garden mountain servant harvest candle shepherd valley kingdom lamp vessel".split()
VERBS = "guarded carried planted measured received followed".split()


def sentence(rng):
    n = lambda: rng.choice(NOUNS)
    return rng.choice(
        [
            lambda: f"The {n()} of the {n()} {rng.choice(VERBS)} the {n()}.", lambda: f"It was the {n()} and not the {n()} which {rng.choice(VERBS)} them.", lambda: f"In the days of old there was neither {n()} nor {n()}.",
            lambda: f"He who {rng.choice(VERBS)} the {n()} shall be as the {n()} beside the {n()}.",
        ]
    )()


def corpus(n=900, seed=3):
    rng = random.Random(seed)
    rows, cut = [], set()
    for i in range(n):
        source = rng.choice(["limit", "plain", "plain", "feed", None])
        text = " ".join(sentence(rng) for _ in range(rng.randint(2, 14)))
        if source == "limit" and len(text) > 300:
            text = text[:300].rstrip()
            if not text.endswith("."):
                cut.add(i)
        elif source == "feed" and rng.random() < 0.5:
            text = text[: rng.randint(30, len(text) - 12)].rstrip() + rng.choice(["", "...", "…", " [more]"])
            if not text.rstrip(".…[]more ").endswith((".",)):
                cut.add(i)
        elif rng.random() < 0.3:
            text += rng.choice(["\nFinis", " Amen", "\n\n— Kador of Wesmond", " (HYM 3:12)"])
        rows.append((i, text, rng.choice(["en", "EN", "eng", None]) if i % 50 else None, source))
    return rows, cut


def test_planted_cuts(spark):
    rows, cut = corpus()
    got = {r.doc_id for r in cutoff.cut_off(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "lang", "source").collect()}
    right = len(got & cut)
    assert right / len(cut) >= 0.95 and right / len(got) >= 0.95


def test_copies_fall_alike_and_every_id_is_listed(spark):
    rows, cut = corpus(400)
    one = next(i for i in cut)
    rows += [(1000 + k, *rows[one][1:]) for k in range(3)]
    got = {r.doc_id for r in cutoff.cut_off(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "lang", "source").collect()}
    assert {1000, 1001, 1002} <= got or not {1000, 1001, 1002} & got


def test_odd_texts(spark):
    rows = [(1, None, "en", "s"), (2, "", None, None), (3, " \n\t ", "en", "s"), (4, "A whole sentence.", "en", "s"), (5, "A. " * 20000, "en", "s"), (6, "...", "en", "s"), (7, "∎∎∎", "xx", None), (8, "日本語の文。", "ja", "s")]
    got = {r.doc_id for r in cutoff.cut_off(spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "lang", "source").collect()}
    assert not got & {1, 2, 3, 4, 5}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cutoff.cut_off(empty, "doc_id", "text", "lang", "source").count() == 0
    assert cutoff.per_source(empty, "doc_id", "text", "lang", "source").count() == 0


def test_clashing_columns_and_counts(spark):
    rows, _ = corpus(300)
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", id int, kind string, cut int")
    counts = cutoff.per_source(df, "doc_id", "text", "lang", "source").collect()
    assert sum(r.n_texts for r in counts) == 300 and {r.source for r in counts} == {"limit", "plain", "feed", None}
    assert sum(r.n_cut for r in counts) == cutoff.cut_off(df, "doc_id", "text", "lang", "source").count()


@pytest.mark.parametrize("text,body,kind", [
    ("the riv…", "the riv", "dots"), ("the river [more]", "the river", "bracket"), ("the river [fol. 12]", "the river", "folio"), ('the river..."', "the river", "dots_quoted"), ("the river (HYM 3:2)", "the river (HYM 3:2)", "plain"),
    ("Verhei�", "Verhei", "broken"), ('the river"', "the river", "quoted"), ("The end.  ", "The end.", "plain"),
])
def test_what_follows_the_end(text, body, kind):
    assert cutoff.ending(text) == (body, kind)


def test_test_table(spark, data):
    found = queries.p8_found(spark, data)
    assert found.columns == ["doc_id"] and found.count() == found.distinct().count()
    assert queries.p8_sources(spark, data).count() > 0


def test_ends_are_seen_whole():
    """However long the last words, the clause or the marks are."""
    long = "x" * 500
    assert cutoff.last_letters(f"a {long}") == long and cutoff.last_letters("ends.") == "" and cutoff.last_letters("the king’s") == "king’s"
    words = [f"{long}{chr(97 + i)}" for i in range(20)]
    assert cutoff.last_tokens(" ".join(words))[-13:] == words[-13:] and cutoff.last_tokens("two words") == ["two", "words"]
    assert cutoff.ending("and then" + "." * 300) == ("and then", "dots") and cutoff.ending("and then" + "�" * 90) == ("and then", "broken")


def test_shares_of_sources_apart_from_the_driver():
    import pandas as pd

    rows = [("a", "plain", -6.0, -6.0, 90), ("a", "plain", 6.0, 6.0, 10), ("b", "plain", -6.0, -6.0, 5), ("b", "plain", 6.0, 6.0, 95)]
    table = pd.DataFrame(rows, columns=["source", *cutoff._BINS])
    kinds = cutoff._kind_shares(table.groupby(list(cutoff._BINS[:3]), as_index=False)["n"].sum())
    cut = {s: cutoff._own_shares(part, kinds)[0][1] for s, part in table.groupby("source")}
    assert 0.8 < cut["a"] < 0.95 and cut["b"] < 0.12
