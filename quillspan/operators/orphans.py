"""References to records that do not exist, by bitmaps.

Keys are dictionary-encoded: every (book, chapter) that the parent table holds is a key range with an
integer of its own, a verse the bit position within it. A bitmap holds, for a key range and a
period, only its non-zero 64-bit words, one row each, so a sparse range costs what it holds and any
verse number has a word.

* reference bitmap: per table and month of the reference, the points its ends name;
* parent bitmap: per month of loading, the points that live records cover.

A record's span is masks for its first and last word and blocks of full words between, so its length costs
nothing; blocks are looked up for the words that references name.

reference AND-NOT (parents loaded in earlier months) leaves the points that can be missing, deleted or
late in that month; the surviving bits are decoded by the ends that own them, and the state is settled
exactly (a record of the same month may still precede the reference). An end in a range the
dictionary lacks is missing without more ado.

Scale: the bitmaps shrink before any shuffle (partial bit_or), whatever key is hot, as a hot verse is
one bit. The last deliveries are written out once, for the bitmaps and for the ends. The survivors, of which
there is one a table, month, range and word at most, are counted: up to a bound they are broadcast, beyond it
they are shuffled with the ends, a hot key then left to the skew join. The dictionary goes by its measured size.

Defined results: a null book, chapter or verse names no point and is no case, except that a null end
of a span is its start; a span is looked at in its two ends only; book ids are trimmed and upper-cased;
exact repeats count once; of an edge's deliveries the latest counts; a record with a null load time
counts as loaded before everything, a reference with a null load time is late to no record and its
month is null; a record whose end lies before its start covers nothing; empty tables give no rows
(an empty parent: all missing). Further columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspan import shared
from quillspan.functions.refs import book_id, point_label

_MONTH = "yyyy-MM"
#: Surviving words up to this number (some 30 MB) are broadcast to the ends; more are shuffled with them.
BROADCAST_WORDS = 500_000
_KEY = ("range_id", "word")
#: Blocks of up to 2 ** 25 words hold every word of 32-bit numbers.
_LEVELS = 26


def _ends(df: DataFrame, table: str, key: Column, points: Column) -> DataFrame:
    rows = df.select(F.lit(table).alias("ref_table"), key.alias("row_key"), "loaded_at", F.explode(F.array_distinct(points)).alias("p"))
    rows = rows.select("ref_table", "row_key", "loaded_at", "p.book", "p.chapter", "p.verse")
    return rows.filter(F.col("book").isNotNull() & F.col("chapter").isNotNull() & F.col("verse").isNotNull())


def _point(book: Column, chapter: Column, verse: Column) -> Column:
    return F.struct(book_id(book).alias("book"), chapter.cast("int").alias("chapter"), verse.cast("int").alias("verse"))


def last_delivery(crossref: DataFrame) -> DataFrame:
    c = F.col
    ends = F.struct(
        _point(c("src_book"), c("src_chapter"), c("src_verse")).alias("a"),
        _point(c("tgt_book"), c("tgt_chapter"), c("tgt_verse")).alias("b"),
        _point(c("tgt_end_book"), c("tgt_end_chapter"), c("tgt_end_verse")).alias("c"),
    )
    rows = crossref.select("edge_id", "loaded_at", ends.alias("ends"))
    last = rows.groupBy("edge_id").agg(F.max(F.struct("loaded_at", "ends")).alias("m"))
    return last.select("edge_id", "m.loaded_at", F.array("m.ends.a", "m.ends.b", "m.ends.c").alias("points"))


def proof_points() -> Column:
    def both(p: Column) -> Column:
        end = F.coalesce(p["verse_end"], p["verse_start"])
        return F.array(_point(p["book"], p["chapter"], p["verse_start"]), _point(p["book"], p["chapter"], end))

    return F.flatten(F.transform("proof_texts", both))


def reference_ends(edges: DataFrame, section: DataFrame) -> DataFrame:
    """Ends of edges in their last delivery and of proof texts: ref_table, row_key, loaded_at, book, chapter, verse."""
    edges = _ends(edges, "crossref", F.col("edge_id").cast("string"), F.col("points"))
    proofs = _ends(section, "section", F.concat(F.col("document"), F.lit("/"), F.col("key")), proof_points())
    return edges.unionByName(proofs)


def _mask(low: Column, high: Column) -> Column:
    """The bits ``low`` to ``high`` of a word."""
    run = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), (63 - (high - low)).cast("int"))
    return F.call_function("shiftleft", run, low.cast("int"))


def parent_spans(verse: DataFrame) -> DataFrame:
    """(book, chapter, first, last, since): distinct spans of records; since is null where only withdrawn records have it."""
    live = F.col("withdrawn_at").isNull()
    since = F.coalesce(F.col("loaded_at"), F.lit("0001-01-01").cast("timestamp").cast(verse.schema["loaded_at"].dataType))
    end = F.coalesce("verse_end", "verse_start")
    rows = verse.select(book_id(F.col("book")).alias("book"), "chapter", F.col("verse_start").cast("int").alias("first"), end.cast("int").alias("last"), F.when(live, since).alias("since"))
    return rows.filter(F.col("last") >= F.col("first")).groupBy("book", "chapter", "first", "last").agg(F.min("since").alias("since"))


def span_masks(spans: DataFrame) -> DataFrame:
    """(range_id, word, mask, since): the first and the last word of each span; distinct masks only, of which a word has 2,080 at most."""
    first, last = _word(F.col("first")), _word(F.col("last"))
    low, high = F.pmod("first", F.lit(64)), F.pmod("last", F.lit(64))
    one = F.array(F.struct(first.alias("word"), _mask(low, high).alias("mask")))
    two = F.array(F.struct(first.alias("word"), _mask(low, F.lit(63)).alias("mask")), F.struct(last.alias("word"), _mask(F.lit(0), high).alias("mask")))
    rows = spans.select("range_id", "since", F.explode(F.when(first == last, one).otherwise(two)).alias("x"))
    return rows.groupBy("range_id", "x.word", "x.mask").agg(F.min("since").alias("since"))


def span_runs(spans: DataFrame) -> DataFrame:
    """(range_id, level, block, since): the full words between a span's first and last, as blocks of 2 ** level words.

    However long a span is, it has two blocks a level at most, and 26 levels hold all words.
    """
    begin, end = _word(F.col("first")).cast("long") + 1, _word(F.col("last")).cast("long")

    def blocks(level: Column) -> Column:
        a = F.call_function("shiftright", begin + F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1, level)
        b = F.call_function("shiftright", end, level)
        odd = lambda x: F.pmod(x, F.lit(2)) == 1
        ends = F.array(F.when((a < b) & odd(a), a), F.when((a < b) & odd(b), b - 1))
        return F.transform(F.array_compact(ends), lambda x: F.struct(level.alias("level"), x.alias("block")))

    rows = spans.filter(end > begin).select("range_id", "since", F.explode(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(_LEVELS - 1)), blocks))).alias("x"))
    return rows.groupBy("range_id", "x.level", "x.block").agg(F.min("since").alias("since"))


def parent_words(spans: DataFrame, wanted: DataFrame) -> DataFrame:
    """(range_id, word, mask, since) of parents; of long spans only the ``wanted`` words (range_id, word) between their ends."""
    masks = span_masks(spans)
    runs = span_runs(spans)
    levels = [r["level"] for r in runs.select("level").distinct().collect()]  # 26 rows at most
    if not levels:
        return masks
    level = F.explode(F.array(*[F.lit(n) for n in sorted(levels)]))
    asked = wanted.select("range_id", "word", level.alias("level")).withColumn("block", F.call_function("shiftright", F.col("word").cast("long"), F.col("level")))
    inside = asked.join(runs, ["range_id", "level", "block"]).select("range_id", "word", F.lit(-1).cast("long").alias("mask"), "since")
    return masks.unionByName(inside).groupBy("range_id", "word", "mask").agg(F.min("since").alias("since"))


def key_ranges(points: DataFrame) -> DataFrame:
    """The dictionary: (book, chapter, range_id). Written out, so that its integers outlive a lost executor."""
    pairs = points.select("book", "chapter").distinct()
    return shared.materialize(pairs.withColumn("range_id", F.monotonically_increasing_id()), "key-ranges")


def _word(verse: Column) -> Column:
    return F.shiftright(verse, 6)


def _bit(verse: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(verse, F.lit(64)))


def reference_bitmaps(ends: DataFrame) -> DataFrame:
    """(ref_table, ref_month, range_id, word, bits) of encoded ends."""
    return ends.groupBy("ref_table", "ref_month", *_KEY).agg(F.bit_or("bit").alias("bits"))


def parent_bitmaps(words: DataFrame) -> DataFrame:
    """(range_id, word, since, bits): the live points first loaded in each month."""
    live = words.filter(F.col("since").isNotNull())
    return live.groupBy(*_KEY, F.date_format("since", _MONTH).alias("since")).agg(F.bit_or("mask").alias("bits"))


def surviving(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """reference AND-NOT (parents loaded in earlier months), non-zero words only."""
    by_word = parents.groupBy(*_KEY).agg(F.collect_list(F.struct("since", "bits")).alias("loads"))  # one entry a month
    earlier = F.filter(F.coalesce("loads", F.array()), lambda x: x["since"] < F.col("ref_month"))
    known = F.aggregate(earlier, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(x["bits"]))
    left = refs.join(by_word, list(_KEY), "left").withColumn("bits", F.col("bits").bitwiseAND(F.bitwise_not(known)))
    return left.filter(F.col("bits") != 0).select("ref_table", "ref_month", *_KEY, "bits")


def orphans(crossref: DataFrame, section: DataFrame, verse: DataFrame) -> DataFrame:
    """(ref_table, row_key, point, state, ref_month): one row for each distinct missing end of a reference."""
    spans = parent_spans(verse)
    ranges = key_ranges(spans)
    spans = spans.join(ranges, ["book", "chapter"])
    edges = shared.materialize(last_delivery(crossref), "edges")
    ends = reference_ends(edges, section).join(ranges, ["book", "chapter"], "left")
    ends = ends.withColumns({"ref_month": F.date_format("loaded_at", _MONTH), "word": _word(F.col("verse")), "bit": _bit(F.col("verse"))})
    encoded = ends.filter(F.col("range_id").isNotNull())
    bitmaps = reference_bitmaps(encoded)
    words = parent_words(spans, bitmaps.select(*_KEY).distinct())
    left = shared.materialize(surviving(bitmaps, parent_bitmaps(words)), "orphan-words")
    masks = left.select(*[F.col(c).alias(f"mask_{c}") for c in left.columns])
    masks = F.broadcast(masks) if left.count() <= BROADCAST_WORDS else masks
    owns = F.col("bit").bitwiseAND(F.col("mask_bits")) != 0
    for c in ("ref_table", "range_id", "word"):
        owns = owns & (F.col(c) == F.col(f"mask_{c}"))
    owns = owns & F.col("ref_month").eqNullSafe(F.col("mask_ref_month"))
    held = words.groupBy(*_KEY).agg(F.collect_list(F.struct("mask", "since")).alias("held"))  # 2,081 masks at most
    hits = encoded.join(masks, owns, "left_semi").join(held, list(_KEY), "left")
    covering = F.filter(F.coalesce("held", F.array()), lambda x: x["mask"].bitwiseAND(F.col("bit")) != 0)
    hits = hits.withColumns({"covered": F.size(covering) > 0, "live_since": F.array_min(F.transform(covering, lambda x: x["since"]))})
    state = F.when(~F.col("covered"), "missing").when(F.col("live_since").isNull(), "deleted").when(F.col("live_since") > F.col("loaded_at"), "late")
    out = ["ref_table", "row_key", "book", "chapter", "verse", "state", "ref_month"]
    found = hits.withColumn("state", state).filter(F.col("state").isNotNull()).select(*out)
    outside = ends.filter(F.col("range_id").isNull()).withColumn("state", F.lit("missing")).select(*out)
    label = point_label(F.col("book"), F.col("chapter"), F.col("verse")).alias("point")
    return found.unionByName(outside).select("ref_table", "row_key", label, "state", "ref_month").distinct()


def orphan_counts(found: DataFrame) -> DataFrame:
    """Distinct missing ends per table, month and state."""
    return found.groupBy("ref_table", "ref_month", "state").agg(F.count("*").alias("n"))
