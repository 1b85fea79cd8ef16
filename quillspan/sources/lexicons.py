"""Dictionaries and word-tagged texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan.functions import citations
from quillspan.functions import text as tx
from quillspan.operators import membership, ordered
from quillspan.sources import canon, markup
from quillspan.sources.files import lines
from quillspan.sources.markup import Field

ENTRY = ("lexicon", "language", "strongs", "raw_key", "lemma", "translit", "pronunciation", "definition", "derivation", "kjv_def", "not_used")
_JS = T.MapType(T.StringType(), T.StructType([T.StructField(n, T.StringType()) for n in ("lemma", "translit", "xlit", "pron", "strongs_def", "derivation", "kjv_def")]))


def _entries(df: DataFrame, lexicon: str, language: str, **columns: Column) -> DataFrame:
    made = {"lexicon": F.lit(lexicon), "language": F.lit(language), "not_used": F.lit(False)} | columns
    return df.select(*[(made.get(n, F.lit(None).cast("string"))).alias(n) for n in ENTRY])


def _first_of_key(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows that come first under their key, the later ones)."""
    ranked = ordered.running_rank(rows, [key], [F.col("path"), F.col("pos")], "_n")
    return ranked.filter("_n = 1").drop("_n"), ranked.filter("_n > 1").drop("_n")


def _flags(rows: DataFrame, key: Column, what: str) -> DataFrame:
    return rows.select(key.cast("string").alias("key"), F.lit(what).alias("flag"))


def from_script(files: DataFrame, language: str) -> tuple[DataFrame, DataFrame]:
    """A dictionary as an object assigned in a script file."""
    prefix = "G" if language == "greek" else "H"
    body = F.regexp_extract("text", r"(?s)var\s+\w+\s*=\s*(\{.*\})", 1)
    rows = files.select("path", F.explode(F.from_json(body, _JS)).alias("raw", "r")).withColumn("key", tx.strongs_key(F.col("raw"), prefix))
    get = lambda n: tx.squeeze(F.col(f"r.{n}"))
    good = rows.filter(F.col("key").isNotNull())
    out = _entries(
        good, "strongs", language, strongs=F.col("key"), lemma=get("lemma"), translit=F.coalesce(get("translit"), get("xlit")), pronunciation=get("pron"), definition=get("strongs_def"), derivation=get("derivation"), kjv_def=get("kjv_def")
    )
    return out, _flags(rows.filter(F.col("key").isNull()), F.col("raw"), "unparseable key")


_GREEK_NODES = {"greek": ("unicode", None), "strongsref": ("strongs", "language"), "pronunciation": ("!", None)}


def greek_xml(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries by their number attribute; inline words and references are rendered from their attributes."""
    fields = {
        "lemma": Field("greek", "unicode"), "translit": Field("greek", "translit"), "pron": Field("pronunciation", "strongs"),
        "definition": Field("strongs_def", inline=_GREEK_NODES), "derivation": Field("strongs_derivation", inline=_GREEK_NODES), "usage": Field("kjv_def", inline=_GREEK_NODES),
    }
    rows = markup.records(files, "entry", fields)
    raw = F.element_at("attrs", "strongs")
    rows = rows.withColumns({"raw": raw, "key": tx.strongs_key(F.concat(F.lit("G"), F.regexp_replace(F.trim(raw), "^G", "")), "G")})
    first, again = _first_of_key(rows.filter(F.col("key").isNotNull()), "key")
    # a number that was assigned but never filled: no word, and nothing but the notice beside the number
    notice = F.lower(F.trim(F.regexp_replace("text", r"[0-9]+", ""))) == "not used"
    out = _entries(
        first, "strongs", "greek", strongs=F.col("key"), lemma=F.col("lemma"), translit=F.col("translit"), pronunciation=F.col("pron"), definition=F.col("definition"), derivation=F.col("derivation"),
        kjv_def=tx.usage_gloss(F.col("usage")), not_used=F.coalesce(F.col("lemma").isNull() & notice, F.lit(False)),
    )
    bad = _flags(rows.filter(F.col("key").isNull()), F.col("raw"), "unparseable key")
    return out, bad.unionByName(_flags(again, F.col("key"), "duplicate key, first kept"))


def hebrew_xml(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    nodes = {"w": ("src", "H")}
    fields = {"lemma": Field("w"), "translit": Field("w", "xlit"), "pron": Field("w", "pron"), "definition": Field("meaning", inline=nodes), "derivation": Field("source", inline=nodes), "usage": Field("usage", inline=nodes)}
    rows = markup.records(files, "entry", fields).withColumn("raw", F.element_at("attrs", "id")).withColumn("key", tx.strongs_key(F.col("raw"), "H"))
    first, again = _first_of_key(rows.filter(F.col("key").isNotNull()), "key")
    out = _entries(
        first, "strongs", "hebrew", strongs=F.col("key"), lemma=F.col("lemma"), translit=F.col("translit"), pronunciation=F.col("pron"), definition=F.col("definition"), derivation=F.col("derivation"), kjv_def=F.col("usage")
    )
    bad = _flags(rows.filter(F.col("key").isNull()), F.col("raw"), "unparseable key")
    return out, bad.unionByName(_flags(again, F.col("key"), "duplicate key, first kept"))


def linked_xml(files: DataFrame, index_files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entries under ids of their own, linked to keys by an index of which the first match counts. Unlinked entries are kept with an empty key."""
    rows = markup.records(files, "entry", {"lemma": Field("w"), "definition": Field("def", every="; ")})
    rows = rows.withColumn("raw_key", F.element_at("attrs", "id")).filter(F.col("raw_key").isNotNull())
    index = markup.records(index_files, "xref", {}).select(
        "path", "pos", F.element_at("attrs", "bdb").alias("raw_key"), tx.strongs_key(F.concat(F.lit("H"), F.element_at("attrs", "strong")), "H").alias("key")
    )
    linked = membership.first_match(rows, index.filter(F.col("key").isNotNull() & F.col("raw_key").isNotNull()), ["raw_key"], [F.col("path"), F.col("pos")], "key")
    out = _entries(linked, "bdb", "hebrew", strongs=F.coalesce("key", F.lit("")), raw_key=F.col("raw_key"), lemma=F.col("lemma"), definition=F.col("definition"))
    return out, _flags(linked.filter(F.col("key").isNull()), F.col("raw_key"), "no key in the index")


def brief_tsv(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of eight columns that begin with an extended key; other lines are prose and skipped. Morphology and gloss stand where derivation and usage do."""
    c = F.split("line", "\t", -1)
    get = lambda i: tx.squeeze(F.get(c, F.lit(i)))
    rows = lines(files).filter(F.col("line").rlike(r"^G\d{4}") & (F.size(c) >= 8)).withColumns({"pos": F.col("lineno"), "key": tx.extended_key(F.substring_index(F.get(c, F.lit(1)), "=", 1))})
    first, again = _first_of_key(rows.filter(F.col("key").isNotNull()), "key")
    definition = tx.squeeze(F.regexp_replace(F.get(c, F.lit(7)), r"<[^>]*>", " "))
    out = _entries(first, "tbesg", "greek", strongs=F.col("key"), raw_key=get(0), lemma=get(3), translit=get(4), definition=definition, derivation=get(5), kjv_def=get(6))
    bad = _flags(rows.filter(F.col("key").isNull()), F.col("line"), "unparseable key")
    return out, bad.unionByName(_flags(again, F.col("key"), "duplicate key, first kept"))


WORD = ("book", "chapter", "verse", "position", "surface", "strongs", "morph", "lemma_raw", "lemma", "gloss", "editions")


def tagged_xml(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(words, flags) of verses with word elements; the keys of a word are all numbers of its lemma."""
    events = markup.events(files, ("verse", "w"))
    filled = ordered.carried_forward(events, ["path", "container"], F.when(F.col("tag") == "verse", F.struct(F.element_at("attrs", "osisID").alias("id"), "pos")), [F.col("pos")], "verse_mark")
    words = filled.filter((F.col("tag") == "w") & F.col("verse_mark").isNotNull()).withColumn("point", citations.osis_point(F.col("verse_mark.id"), {o: i for o, i in canon.OSIS.items() if i in canon.OLD}))
    words = ordered.running_rank(words.withColumn("mark", F.col("verse_mark.pos")), ["path", "container", "mark"], [F.col("pos")], "position")
    raw = F.coalesce(F.element_at("attrs", "lemma"), F.lit(""))
    good = words.filter(F.col("point").isNotNull())
    out = good.select(
        "point.book", "point.chapter", "point.verse", "position", F.col("text").alias("surface"), tx.lemma_keys(raw).alias("strongs"), tx.squeeze(F.element_at("attrs", "morph")).alias("morph"), raw.alias("lemma_raw"),
        *[F.lit(None).cast("string").alias(n) for n in ("lemma", "gloss", "editions")],
    )
    flags = events.filter(F.col("tag") == "verse").filter(citations.osis_point(F.element_at("attrs", "osisID")).isNull())
    return out, _flags(flags, F.element_at("attrs", "osisID"), "unparseable verse")


def tagged_tsv(files: DataFrame, books: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(words, flags) of rows reference#position=editions, word, gloss, key=morphology, lemma=gloss, further."""
    codes = books or {i.capitalize() if not i[0].isdigit() else i[0] + i[1:].capitalize(): i for i in canon.IDS[39:]}
    c = F.split("line", "\t", -1)
    get = lambda i: F.coalesce(F.get(c, F.lit(i)), F.lit(""))
    shape = r"^(\w+\.\d+\.\d+)\S*?#(\d+)=(\S*)"
    rows = lines(files).filter(F.col("line").rlike(shape + r"\t")).withColumns(
        {"point": citations.osis_point(F.regexp_extract(get(0), shape, 1), codes), "position": F.regexp_extract(get(0), shape, 2).cast("int"), "editions": F.regexp_extract(get(0), shape, 3)}
    )
    key, lemma = F.split(get(3), "=", 2), F.split(get(4), "=", 2)
    good = rows.filter(F.col("point").isNotNull())
    out = good.select(
        "point.book", "point.chapter", "point.verse", "position", tx.surface(get(1)).alias("surface"), F.filter(F.array(tx.extended_key(key[0])), lambda k: k.isNotNull()).alias("strongs"),
        tx.squeeze(F.get(key, F.lit(1))).alias("morph"), key[0].alias("lemma_raw"), tx.squeeze(lemma[0]).alias("lemma"), tx.squeeze(F.get(lemma, F.lit(1))).alias("gloss"), tx.squeeze(F.col("editions")).alias("editions"),
    )
    return out, _flags(rows.filter(F.col("point").isNull()), get(0), "unknown book")


def sort_key(key: Column) -> Column:
    """Dictionary order: by number; keys that are no plain number last."""
    number = F.regexp_extract(key, r"^[GH]([0-9]+)$", 1)
    return F.when(number != "", number.try_cast("int")).otherwise(F.lit(1 << 30))
