"""Validation as statistics and one long table of flags. Nothing is dropped: a finding is a row.

flags: resource, entity, severity (error or flag), kind, n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspan.functions import text as tx
from quillspan.operators import membership


#: Length from which a block is long.
LONG_BLOCK = tx.LONG_BLOCK


def edge_statistics(crossref: DataFrame) -> DataFrame:
    """One row over all edges as delivered, exact repeats once."""
    rows = crossref.distinct()
    source = F.struct("src_book", "src_chapter", "src_verse")
    start, end = F.struct("tgt_book", "tgt_chapter", "tgt_verse"), F.struct("tgt_end_book", "tgt_end_chapter", "tgt_end_verse")
    is_range = start != end
    return rows.agg(
        F.count("*").alias("n_edges"), F.countDistinct(source).alias("n_sources"), F.min("votes").alias("min_votes"), F.max("votes").alias("max_votes"),
        F.count_if(F.col("votes") < 0).alias("n_negative"), F.count_if(F.col("votes") == 0).alias("n_zero"), F.count_if(is_range).alias("n_range"),
        F.count_if(~is_range).alias("n_single"), F.count_if(F.col("tgt_book") != F.col("tgt_end_book")).alias("n_cross_book"),
    )


def inverted_ranges(crossref: DataFrame, book: DataFrame) -> DataFrame:
    """Edges whose target ends before it starts in canonical order; unknown books come last."""
    order = book.select(F.col("id").alias("_b"), "ord")
    at = lambda name: order.select(F.col("_b").alias(f"_{name}"), F.col("ord").alias(f"_{name}_ord"))
    rows = crossref.select("edge_id", "tgt_book", "tgt_chapter", "tgt_verse", "tgt_end_book", "tgt_end_chapter", "tgt_end_verse").distinct()
    rows = rows.join(at("s"), F.col("tgt_book") == F.col("_s"), "left").join(at("e"), F.col("tgt_end_book") == F.col("_e"), "left")
    last = F.lit(1 << 30)
    start = F.struct(F.coalesce("_s_ord", last).alias("o"), F.col("tgt_chapter").alias("c"), F.col("tgt_verse").alias("v"))
    end = F.struct(F.coalesce("_e_ord", last).alias("o"), F.col("tgt_end_chapter").alias("c"), F.col("tgt_end_verse").alias("v"))
    return rows.filter(end < start).select("edge_id", "tgt_book", "tgt_chapter", "tgt_verse", "tgt_end_book", "tgt_end_chapter", "tgt_end_verse")


def translation_statistics(verse: DataFrame) -> DataFrame:
    """One row a translation: books, chapters, verses, red letters, bridges, empty and omitted verses."""
    rows = verse.select("translation", "book", "chapter", "verse_start", "verse_end", "text", "red_letter", "omitted").distinct()
    blank = F.coalesce(F.col("text"), F.lit("")) == ""
    return rows.groupBy("translation").agg(
        F.countDistinct("book").alias("n_books"), F.countDistinct("book", "chapter").alias("n_chapters"), F.count("*").alias("n_verses"), F.count_if("red_letter").alias("n_red_letter"),
        F.count_if(F.col("verse_end") != F.col("verse_start")).alias("n_bridges"), F.count_if(blank).alias("n_empty"), F.count_if("omitted").alias("n_omitted"), F.count_if(blank & ~F.col("omitted")).alias("n_empty_not_omitted"),
    )


def chapter_lengths(verse: DataFrame) -> DataFrame:
    """(translation, book, chapter, expected, got): the last verse of every chapter of the spine, 0 where it is missing."""
    every = membership.spine(verse)
    expected = every.crossJoin(verse.select("translation").distinct())  # spine x translations: a few rows for every chapter
    got = verse.groupBy("translation", "book", "chapter").agg(F.max("verse_end").alias("got"))
    both = expected.join(got, ["translation", "book", "chapter"], "left").withColumn("got", F.coalesce("got", F.lit(0)))
    return both.select("translation", "book", "chapter", F.col("n_verses").alias("expected"), "got")


def chapter_deviations(verse: DataFrame) -> DataFrame:
    """Chapters whose last verse differs from the spine's."""
    return chapter_lengths(verse).filter("got <> expected")


def commentary_statistics(comments: DataFrame, spine: DataFrame, long_block: int = tx.LONG_BLOCK) -> DataFrame:
    """One row a commentator: paragraphs, characters, books, chapters, chapters of the covered books that lack notes, bad references, long and blank blocks."""
    rows = comments.select("commentator", "key", "book", "chapter", "verse_start", "text").distinct()
    rows = membership.resolves(rows, spine, "book", "chapter", F.col("verse_start"), "valid", allow_zero=True)
    size = F.length(F.coalesce("text", F.lit("")))
    stats = rows.groupBy("commentator").agg(
        F.count("*").alias("n_paragraphs"), F.sum(size).alias("n_chars"), F.countDistinct("book").alias("n_books"), F.countDistinct("book", "chapter").alias("n_chapters"),
        F.count_if(~F.col("valid")).alias("n_bad_refs"), F.count_if(size >= long_block).alias("n_long"), F.count_if(tx.strip(F.coalesce("text", F.lit(""))) == "").alias("n_blank"),
    )
    covered = rows.select("commentator", "book").distinct().join(spine.select("book", "chapter"), "book")
    lacking = covered.join(rows.select("commentator", "book", "chapter").distinct(), ["commentator", "book", "chapter"], "left_anti")
    lacking = lacking.groupBy("commentator").agg(F.count("*").alias("n_chapters_lacking"))
    return stats.join(lacking, "commentator", "left").withColumn("n_chapters_lacking", F.coalesce("n_chapters_lacking", F.lit(0).cast("long")))


def confession_statistics(section: DataFrame, spine: DataFrame) -> DataFrame:
    """One row a document: sections, distinct numbers of each kind, proof texts and the ends of them that do not resolve."""
    rows = section.drop("loaded_at").distinct()
    stats = rows.groupBy("document").agg(
        F.count("*").alias("n_sections"), *[F.countDistinct(c).alias(f"n_{c}s") for c in ("chapter", "question", "article", "lords_day")], F.sum(F.coalesce(F.size("proof_texts"), F.lit(0)).cast("long")).alias("n_proofs")
    )
    stats = stats.withColumn("n_proofs", F.greatest("n_proofs", F.lit(0)))
    bad_ends = bad_proofs(rows, spine).groupBy("document").agg(F.count("*").alias("n_bad_ends"))
    return stats.join(bad_ends, "document", "left").withColumn("n_bad_ends", F.coalesce("n_bad_ends", F.lit(0).cast("long")))


def bad_proofs(section: DataFrame, spine: DataFrame) -> DataFrame:
    """(document, book, chapter, verse): each start, and each end that is given, of a proof text that does not resolve."""
    proofs = section.select("document", F.explode("proof_texts").alias("p")).select("document", F.upper(F.trim("p.book")).alias("book"), "p.chapter", "p.verse_start", "p.verse_end")
    ends = F.array(F.struct(F.lit(True).alias("given"), F.col("verse_start").alias("verse")), F.struct(F.col("verse_end").isNotNull().alias("given"), F.col("verse_end").alias("verse")))
    rows = proofs.select("document", "book", "chapter", F.explode(ends).alias("e")).filter("e.given").select("document", "book", "chapter", "e.verse")
    return membership.resolves(rows, spine, "book", "chapter", F.col("verse"), "ok").filter("not ok").drop("ok")


def entry_statistics(chunk: DataFrame, long_definition: int = tx.LONG_DEFINITION) -> DataFrame:
    """One row a lexicon: entries by kind of definition."""
    rows = chunk.filter(F.col("resource_type") == "lexicon").select("source", "id", "key", "text").distinct()
    body = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"^[^—]*—", ""))
    kind = F.when(F.coalesce("text", F.lit("")) == "", "empty").when(F.length(body) > long_definition, "long").when(body == "", "head_only").otherwise("plain")
    return rows.withColumn("kind", kind).groupBy("source", "kind").agg(F.count("*").alias("n"), F.countDistinct("key").alias("n_keys"))


def classified_entries(entry: DataFrame, long_definition: int = tx.LONG_DEFINITION) -> DataFrame:
    """``entry`` with kind, long and occurrence (of its key in its lexicon).

    kind: not used; defined; meaning elsewhere (in derivation or usage only); no meaning (of a numbered dictionary); stub (of another).
    """
    from pyspark.sql import Window

    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    numbered = F.col("lexicon") == "strongs"
    kind = F.when(F.coalesce("not_used", F.lit(False)), "not used").when(has("definition"), "defined").when(~numbered, "stub").when(has("derivation") | has("kjv_def"), "meaning elsewhere").otherwise("no meaning")
    rows = entry.withColumn("kind", kind).withColumn("long", (F.col("kind") == "defined") & (F.length("definition") > long_definition))
    keyed = F.when(has("strongs"), F.col("strongs"))
    by = Window.partitionBy("lexicon", "language", keyed).orderBy(F.coalesce("raw_key", F.lit("")), F.coalesce("definition", F.lit("")))
    return rows.withColumn("occurrence", F.when(keyed.isNotNull(), F.row_number().over(by)).otherwise(1))


def lexicon_statistics(entry: DataFrame) -> DataFrame:
    """One row a lexicon and language: entries, linked, distinct and repeated keys, unused numbers, defined, long and undefined entries."""
    rows = classified_entries(entry)
    linked = F.coalesce(F.col("strongs"), F.lit("")) != ""
    of = lambda kind: F.count_if(F.col("kind") == kind)
    return rows.groupBy("lexicon", "language").agg(
        F.count("*").alias("n_entries"), F.count_if(linked).alias("n_linked"), F.count_distinct(F.when(linked, F.col("strongs"))).alias("n_keys"), F.count_if((F.col("occurrence") > 1) & (F.col("lexicon") == "strongs")).alias("n_duplicates"),
        of("not used").alias("n_not_used"), of("defined").alias("n_defined"), F.count_if("long").alias("n_long"), of("meaning elsewhere").alias("n_meaning_elsewhere"), of("no meaning").alias("n_no_meaning"), of("stub").alias("n_stubs"),
    )


def garble_statistics(comments: DataFrame) -> DataFrame:
    """(commentator, n, mean_ratio, n_rough): shares of garbled words per commentator."""
    rows = comments.filter(F.col("text").isNotNull()).select("commentator", "key", "text").distinct().withColumn("ratio", tx.garble_ratio(F.col("text")))
    return rows.groupBy("commentator").agg(F.count("*").alias("n"), F.round(F.avg("ratio"), 6).alias("mean_ratio"), F.count_if(F.col("ratio") >= 0.3).alias("n_rough"))


def verdict(mean: Column, p90: Column) -> Column:
    return F.when((mean < 0.04) & (p90 < 0.08), "good").when(mean < 0.10, "usable").otherwise("poor")


def flags(parts: list[tuple[str, str, str, DataFrame, str]]) -> DataFrame:
    """Long table of (resource, severity, kind, frame, entity column): one row an entity with its number of findings."""
    every = None
    for resource, severity, kind, frame, entity in parts:
        rows = frame.groupBy(F.col(entity).cast("string").alias("entity")).agg(F.count("*").alias("n"))
        rows = rows.select(F.lit(resource).alias("resource"), "entity", F.lit(severity).alias("severity"), F.lit(kind).alias("kind"), "n")
        every = rows if every is None else every.unionByName(rows)
    return every


def totals(flag_rows: DataFrame) -> DataFrame:
    """(resource, error_total, flag_total)."""
    n = lambda s: F.coalesce(F.sum(F.when(F.col("severity") == s, F.col("n"))), F.lit(0).cast("long"))
    return flag_rows.groupBy("resource").agg(n("error").alias("error_total"), n("flag").alias("flag_total"))


def examples(rows: DataFrame, key: str, order: list[Column], cap: int = 25) -> DataFrame:
    """The first ``cap`` rows of each kind, each with the number beyond them: a report's capped list."""
    from pyspark.sql import Window

    # each task keeps its own first rows of a key before the shuffle, and the counts are partial sums
    first = rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("_n") <= cap).drop("_n")
    counts = rows.groupBy(F.col(key).alias("_key")).agg(F.greatest(F.count("*") - cap, F.lit(0)).alias("more"))
    return first.join(counts, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def tagged_statistics(words: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """One row over word-tagged text: words, verses, books, words with a key, and distinct keys the dictionary lacks, whole and without their homograph letter."""
    stats = words.agg(
        F.count("*").alias("n_words"), F.countDistinct("book", "chapter", "verse").alias("n_verses"), F.countDistinct("book").alias("n_books"), F.count_if(F.size("strongs") > 0).alias("n_keyed")
    )
    if dictionary is None:
        return stats.withColumn("n_orphans", F.lit(None).cast("long"))
    keys = words.select(F.explode("strongs").alias("key"))
    lost = membership.orphans_with_fallback(keys, "key", tx.base_key(F.col("key")), dictionary, "strongs").agg(F.count("*").alias("n_orphans"))
    return stats.join(F.broadcast(lost))


def prose_crosscheck(a: DataFrame, b: DataFrame, keys: list[str], text: str, words: int = 14) -> DataFrame:
    """(keys, agrees): whether the first words of ``a``'s text occur in ``b``'s under the same keys."""
    left = a.select(*keys, tx.first_words(tx.prose_key(F.col(text)), words).alias("first_words"))
    right = b.select(*keys, tx.prose_key(F.col(text)).alias("other_prose"))
    return left.join(right, keys).groupBy(*keys).agg(F.max(F.contains("other_prose", "first_words")).alias("agrees"))
