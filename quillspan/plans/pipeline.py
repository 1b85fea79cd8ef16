"""The lifecycles: tables from sources, validation of tables, the index from tables, and packs of all.

Sources are described by a library, a JSON object that names for each resource its files, layout and provenance:

    {"translations": {"kjv": {"files": "kjv.zip"}}, "variants": [["MAT", 17, 21]],
     "confessions": {"wsc": {"layout": "catechism", "files": "wsc.xml", "shortcode": "WSC"}},
     "commentaries": {"henry": {"layout": "anchored", "files": "henry*.xml"}, "treasury": {"layout": "scans", "files": "tod*.txt", "book": "PSA", "ranges": {"tod1.txt": [1, 26]}}},
     "lexicons": {"greek": {"layout": "greek_xml", "files": "greek.xml"}}, "tagged": {"oshb": {"layout": "tagged_xml", "files": "*.xml"}},
     "edges": {"tsk": {"files": "edges.txt"}}}

Paths are read relative to the folder of sources, through the session's file systems. Every step that leaves
something out writes a row about it to the resource's flags.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan import shared
from quillspan.operators import bm25, chunking, incremental, membership, ordered, packaging, validation
from quillspan.plans import reports
from quillspan.sources import canon, commentaries, confessions, edges, files, lexicons, scans, usfm
from quillspan.sources.tables import table

_PROVENANCE = "resource string, id string, name string, version string, license string, url string, retrieved string, checksum string, shortcode string"


def _write(df: DataFrame, path: str, *order: str | Column) -> None:
    """A table in a stable order: range-partitioned and sorted, so that no task holds it all."""
    (df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df).write.mode("overwrite").parquet(path)


def union(parts: Iterable[DataFrame]) -> DataFrame | None:
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out


def _have(spark: SparkSession, folder: str, name: str) -> bool:
    return shared.exists(spark, f"{folder}/{name}.parquet")


def _finished(spark: SparkSession, out: str, name: str, rows: DataFrame, flags: DataFrame | None, *order: str | Column) -> dict[str, int]:
    _write(rows, f"{out}/{name}.parquet", *order)
    if flags is not None:
        flags.write.mode("overwrite").parquet(f"{out}/{name}_flags.parquet")
    return {name: table(spark, out, name).count(), "flags": table(spark, out, f"{name}_flags").count() if flags is not None else 0}


def canonical(df: DataFrame, book: str = "book", order: tuple[str, ...] = canon.IDS) -> Column:
    """Position of a book in the canon; books beyond it come last."""
    known = F.create_map(*[F.lit(x) for pair in ((b, i) for i, b in enumerate(order)) for x in pair])
    return F.coalesce(F.element_at(known, df[book]), F.lit(len(order)))


# --- tables from sources


def standardized(parsed: DataFrame, variants: DataFrame, notes: DataFrame | None = None) -> DataFrame:
    """Verses (translation, book, chapter, verse_start, ...) in which every disputed verse has a row.

    ``variants``: (book, chapter, verse_start). A parsed variant without text is marked as omitted; one that lacks altogether is
    added to the translations that have its book, with the wording that another verse's footnote carries (``notes``: translation, book,
    chapter, verse, note), if any. An empty verse that is no variant is not omitted.
    """
    keys = ["book", "chapter", "verse_start"]
    disputed = variants.select(*keys).distinct()
    rows = parsed.join(disputed.withColumn("_variant", F.lit(True)), keys, "left")
    rows = rows.withColumn("omitted", F.coalesce(F.col("_variant"), F.lit(False)) & (F.col("text") == "")).drop("_variant")
    wanted = parsed.select("translation", "book").distinct().join(disputed, "book")
    defaults = {"verse_end": F.col("verse_start"), "text": F.lit(""), "red_letter": F.lit(False), "wj_spans": F.array(), "omitted": F.lit(True), "_added": F.lit(True)}
    rows = membership.injected(rows.withColumn("_added", F.lit(False)), wanted, ["translation", *keys], defaults)
    if notes is None:
        return rows.drop("_added")
    carried = notes.select("translation", "book", "chapter", notes["verse"].alias("verse_start"), notes["note"].alias("_note"))
    rows = rows.join(carried, ["translation", *keys], "left")
    return rows.withColumn("source_note", F.when(F.col("_added"), F.col("_note")).otherwise(F.col("source_note"))).drop("_note", "_added")


def parsed_books(spark: SparkSession, sources: dict[str, str], books: frozenset[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(verses, flags, omission notes) of translations -> glob of book files, or of zips of them."""
    rows, flags, notes = [], [], []
    for translation in sorted(sources):
        path = sources[translation]
        texts = files.zip_members(spark, path).select(F.col("member").alias("path"), "text") if path.endswith(".zip") else files.whole_texts(spark, path)
        verses, found = usfm.verses(texts, books)
        rows.append(verses.withColumn("translation", F.lit(translation)))
        flags.append(found.withColumn("translation", F.lit(translation)))
        notes.append(usfm.omissions(texts).withColumn("translation", F.lit(translation)))
    return union(rows), union(flags), union(notes)


def build_verses(spark: SparkSession, sources: dict[str, str], out: str, variants: DataFrame | None = None, books: tuple[str, ...] = canon.IDS) -> dict[str, int]:
    """Translations -> verse table in canonical order, and flags."""
    every, flags, notes = parsed_books(spark, sources, frozenset(books))
    variants = variants if variants is not None else spark.createDataFrame([], "book string, chapter int, verse_start int")
    rows = standardized(every.drop("path", "pos"), variants, notes)
    return _finished(spark, out, "verse", rows, flags, "translation", canonical(rows, order=books), "chapter", "verse_start")


def sections_of(spark: SparkSession, document: str, source: dict, at: Callable[[str], str]) -> tuple[DataFrame, DataFrame]:
    """The sections and flags of a confession, by the parser of its layout."""
    text = lambda name="files": files.whole_texts(spark, at(source[name]))
    layout = source["layout"]
    if layout == "catechism":
        return confessions.catechism(text(), document, source.get("question", r"(?s)^Q(\d{1,3})[:.]\s*(.*)$"), source.get("answer", r"(?s)^A(\d{1,3})[:.]\s*(.*)$"))
    if layout == "chapters_json":
        amendments, lost = None, None
        if "amended" in source:
            wanted = spark.createDataFrame([tuple(x) for x in source["wanted"]], "chapter int, section int")
            amendments, lost = confessions.amended_sections(text("amended"), wanted)
        rows, flags = confessions.chapters_json(text(), document, amendments, source.get("chapters"))
        return rows, flags if lost is None else flags.unionByName(lost)
    if layout == "paragraphs_json":
        return confessions.paragraphs_json(text(), document, confessions.proof_lines(text("proofs")), source.get("chapters"))
    if layout == "articles_html":
        return confessions.articles_html(text(), document, source.get("articles", 0))
    if layout == "questions_by_day":
        return confessions.questions_by_day(text(), document, source.get("days", 0))
    if layout == "heads_of_doctrine":
        return confessions.heads_of_doctrine(text(), document, source["heads"], {k: tuple(v) for k, v in source.get("expected", {}).items()})
    raise ValueError(f"no parser for the layout {layout!r} of {document}")


def stored_sections(rows: DataFrame) -> DataFrame:
    """Sections as they are stored: numbered by document from 0 in the order of their keys' numbers, empty titles and proofs null."""
    numbers = [F.coalesce(c, F.lit(0)) for c in ("chapter", "section", "question", "article", "lords_day")]
    placed = ordered.running_rank(rows, ["document"], [*numbers, F.col("key")], "ord").withColumn("ord", F.col("ord") - 1)
    return placed.withColumns({"title": F.nullif("title", F.lit("")), "proof_texts": F.when(F.size("proof_texts") > 0, F.col("proof_texts"))})


def build_sections(spark: SparkSession, sources: dict[str, dict], out: str, at: Callable[[str], str] = str) -> dict[str, int]:
    parts = [sections_of(spark, name, sources[name], at) for name in sorted(sources)]
    rows = stored_sections(union(p for p, _ in parts))
    return _finished(spark, out, "section", rows, union(f for _, f in parts), "document", "ord")


def comments_of(spark: SparkSession, name: str, source: dict, at: Callable[[str], str], spine: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The comments and flags of a commentary, by the parser of its layout."""
    texts = files.whole_texts(spark, at(source["files"]))
    if source["layout"] == "anchored":
        order = spark.createDataFrame([(b, i) for i, b in enumerate(canon.IDS)], "id string, ord int")
        return commentaries.parse(texts, name, order, {b: b for b in source["codes"]} if "codes" in source else None)
    if source["layout"] == "scans":
        ranges = spark.createDataFrame([(k, *v) for k, v in source["ranges"].items()], "volume string, first int, last int")
        texts = texts.withColumn("volume", F.element_at(F.split("path", "/"), -1)).join(F.broadcast(ranges), "volume").drop("volume")
        book = source["book"]
        if spine is None:
            lengths = spark.createDataFrame([], "hymn int, n_verses int")
        else:
            lengths = spine.filter(F.col("book") == book).select(F.col("chapter").alias("hymn"), "n_verses")
        rows, flags = scans.comments(texts, name, book, lengths, source.get("head", "PSALM"))
        order = ["chapter", "verse_start", "component", "para_index", "key"]
        rows = ordered.dense_ids(rows.drop("garble"), order, "ord").withColumns({"verse_end": F.col("verse_start"), "chapter_level": (F.col("verse_start") == 0).cast("int"), "passage": F.lit(None).cast("string"), "checksum": F.sha2("text", 256)})
        return rows.withColumn("ord", F.col("ord").cast("long")), flags
    raise ValueError(f"no parser for the layout {source['layout']!r} of {name}")


_COMMENT = ("commentator", "key", "ord", "book", "chapter", "verse_start", "verse_end", "chapter_level", "para_index", "passage", "component", "volume", "text", "checksum")


def build_comments(spark: SparkSession, sources: dict[str, dict], out: str, at: Callable[[str], str] = str, verse: DataFrame | None = None) -> dict[str, int]:
    spine = membership.spine(verse) if verse is not None else None
    parts = [comments_of(spark, name, sources[name], at, spine) for name in sorted(sources)]
    rows = union(p.select(*_COMMENT).withColumn("verse_end", F.coalesce("verse_end", "verse_start")) for p, _ in parts)
    flags = union(f.withColumn("commentator", F.lit(name)) for name, (_, f) in zip(sorted(sources), parts))
    return _finished(spark, out, "comments", rows, flags, "commentator", "ord")


_ENTRY_LAYOUTS = {"greek_xml": lexicons.greek_xml, "hebrew_xml": lexicons.hebrew_xml, "brief_tsv": lexicons.brief_tsv}
_WORD_LAYOUTS = {"tagged_xml": lexicons.tagged_xml, "tagged_tsv": lexicons.tagged_tsv}


def entries_of(spark: SparkSession, name: str, source: dict, at: Callable[[str], str]) -> tuple[DataFrame, DataFrame]:
    texts = files.whole_texts(spark, at(source["files"]))
    if source["layout"] == "linked_xml":
        return lexicons.linked_xml(texts, files.whole_texts(spark, at(source["index"])))
    if source["layout"] == "script":
        return lexicons.from_script(texts, source["language"])
    if source["layout"] in _ENTRY_LAYOUTS:
        return _ENTRY_LAYOUTS[source["layout"]](texts)
    raise ValueError(f"no parser for the layout {source['layout']!r} of {name}")


def build_entries(spark: SparkSession, sources: dict[str, dict], out: str, at: Callable[[str], str] = str) -> dict[str, int]:
    """Dictionaries in the order of their keys' numbers, then of their raw keys."""
    parts = [entries_of(spark, name, sources[name], at) for name in sorted(sources)]
    rows = union(p.withColumn("source_id", F.lit(name)) for name, (p, _) in zip(sorted(sources), parts))
    flags = union(f.withColumn("source_id", F.lit(name)) for name, (_, f) in zip(sorted(sources), parts))
    return _finished(spark, out, "entry", rows, flags, "source_id", lexicons.sort_key(F.col("strongs")), "raw_key", "strongs")


def build_words(spark: SparkSession, sources: dict[str, dict], out: str, at: Callable[[str], str] = str) -> dict[str, int]:
    parts = []
    for name in sorted(sources):
        layout = sources[name]["layout"]
        if layout not in _WORD_LAYOUTS:
            raise ValueError(f"no parser for the layout {layout!r} of {name}")
        words, flags = _WORD_LAYOUTS[layout](files.whole_texts(spark, at(sources[name]["files"])))
        parts.append((words.withColumn("source_id", F.lit(name)), flags.withColumn("source_id", F.lit(name))))
    rows = union(p for p, _ in parts)
    return _finished(spark, out, "word", rows, union(f for _, f in parts), "source_id", canonical(rows), "chapter", "verse", "position")


def resolved_edges(rows: DataFrame, spine: DataFrame) -> DataFrame:
    """Edges with src_resolves and tgt_resolves: a target resolves if both its ends do."""
    for book, chapter, number, name in (("src_book", "src_chapter", "src_verse", "src_resolves"), ("tgt_book", "tgt_chapter", "tgt_verse", "start_ok"), ("tgt_end_book", "tgt_end_chapter", "tgt_end_verse", "end_ok")):
        rows = membership.resolves(rows, spine, book, chapter, F.col(number), name)
    return rows.withColumns({"tgt_resolves": (F.col("start_ok") & F.col("end_ok")).cast("int"), "src_resolves": F.col("src_resolves").cast("int")}).drop("start_ok", "end_ok")


def build_edges(spark: SparkSession, path: str, verse: DataFrame | None, out: str) -> dict[str, int]:
    """Edges in the order of source, target start, whether the target resolves, and file."""
    good, bad = edges.parse(files.whole_texts(spark, path))
    if verse is not None:
        good = resolved_edges(good, membership.spine(verse))
    point = lambda p: [canonical(good, f"{p}_book"), F.col(f"{p}_chapter"), F.col(f"{p}_verse")]
    return _finished(spark, out, "crossref", good, bad, *point("src"), *point("tgt"), *(["tgt_resolves"] if verse is not None else []), "rank")


def build_library(spark: SparkSession, library: dict, folder: str, out: str, only: str | None = None) -> dict[str, dict[str, int]]:
    """Every resource of a library, or one of them; a resource that is not described is left out."""
    at = lambda path: path if "://" in path or path.startswith("/") else f"{folder}/{path}"
    verse = lambda: table(spark, out, "verse") if _have(spark, out, "verse") else None
    done = {}
    if library.get("translations") and only in (None, "translations"):
        variants = spark.createDataFrame([tuple(v) for v in library.get("variants", [])], "book string, chapter int, verse_start int")
        done["translations"] = build_verses(spark, {k: at(v["files"]) for k, v in library["translations"].items()}, out, variants)
    for name, build in (("confessions", build_sections), ("lexicons", build_entries), ("tagged", build_words)):
        if library.get(name) and only in (None, name):
            done[name] = build(spark, library[name], out, at)
    if library.get("commentaries") and only in (None, "commentaries"):
        done["commentaries"] = build_comments(spark, library["commentaries"], out, at, verse())
    if library.get("edges") and only in (None, "edges"):
        paths = [at(v["files"]) for v in library["edges"].values()]
        done["edges"] = build_edges(spark, paths[0] if len(paths) == 1 else "{" + ",".join(paths) + "}", verse(), out)
    _write(provenance(spark, library, at), f"{out}/provenance.parquet")
    return done


def provenance(spark: SparkSession, library: dict, at: Callable[[str], str] = str) -> DataFrame:
    """(resource, id, name, version, license, url, retrieved, checksum, shortcode) of every source whose files are there; the checksum is over all of them."""
    out = None
    for resource in ("translations", "confessions", "commentaries", "lexicons", "tagged", "edges"):
        for name, source in sorted(library.get(resource, {}).items()):
            if not shared.exists(spark, at(source["files"])):
                continue  # not fetched, and not built
            digest = packaging.combined_checksum(files.digests(spark, at(source["files"])))
            kept = {k: source.get(k) for k in ("name", "version", "license", "url", "retrieved", "shortcode")}
            row = digest.select(F.lit(resource).alias("resource"), F.lit(name).alias("id"), *[F.lit(v).cast("string").alias(k) for k, v in kept.items() if k != "shortcode"], F.col("sha256").alias("checksum"), F.lit(kept["shortcode"]).cast("string").alias("shortcode"))
            out = row if out is None else out.unionByName(row)
    return out if out is not None else spark.createDataFrame([], _PROVENANCE)


# --- index


def _shortcodes(spark: SparkSession, tables: str) -> DataFrame | None:
    if not _have(spark, tables, "provenance"):
        return None
    return table(spark, tables, "provenance").filter("resource = 'confessions' AND shortcode IS NOT NULL").select(F.col("id").alias("document"), "shortcode")


def extract(spark: SparkSession, tables: str, out: str) -> dict[str, int]:
    """Chunks and skips of the resource tables that are there, in the order scripture, commentary, confession, lexicon."""
    parts = []
    if _have(spark, tables, "verse"):
        verse = table(spark, tables, "verse")
        parts.append(chunking.scripture(chunking.scripture_windows(verse if "loaded_at" in verse.columns else verse.withColumn("loaded_at", F.lit(None).cast("timestamp")))))
    if _have(spark, tables, "comments"):
        parts.append(chunking.commentary(table(spark, tables, "comments")))
    if _have(spark, tables, "section"):
        parts.append(chunking.confession(table(spark, tables, "section"), _shortcodes(spark, tables)))
    if _have(spark, tables, "entry"):
        parts.append(chunking.lexicon(table(spark, tables, "entry")))
    chunks, skips = chunking.extracted(parts)
    chunks.write.mode("overwrite").parquet(f"{out}/chunk.parquet")
    skips.write.mode("overwrite").parquet(f"{out}/skipped.parquet")
    return {"chunk": table(spark, out, "chunk").count(), "skipped": table(spark, out, "skipped").count()}


def write_index(spark: SparkSession, rows: DataFrame, vectors: DataFrame, out: str, meta: dict[str, object]) -> dict[str, object]:
    """Vectors, the inverted index and its statistics over ``rows`` (id, text), and what made them."""
    vectors.write.mode("overwrite").parquet(f"{out}/vector.parquet")
    docs = bm25.documents(rows, "id", "text")
    docs.select("doc", "len").write.mode("overwrite").parquet(f"{out}/bm25_doc.parquet")
    posts, raw = shared.written(bm25.postings(docs), "postings")
    bm25.terms(posts).write.mode("overwrite").parquet(f"{out}/bm25_term.parquet")
    terms = table(spark, out, "bm25_term")
    _write(posts.join(terms.select("term", "term_id"), "term").select("term_id", "doc", "tf"), f"{out}/bm25_posting.parquet", "term_id", "doc")
    shared.release(spark, raw)
    bm25.stats(docs).write.mode("overwrite").parquet(f"{out}/bm25_stats.parquet")
    meta = {"tokenizer": "nfkc-casefold-alnum", "vector_format": "float32-le", **meta}
    spark.createDataFrame([(k, str(v)) for k, v in sorted(meta.items())], "key string, value string").write.mode("overwrite").parquet(f"{out}/meta.parquet")
    return meta


def index(spark: SparkSession, chunks: str, out: str, make=incremental.HashingEncoder, prior: str | None = None, prior_revision: str = "") -> dict:
    """Vectors, reused where the content is the same, and the inverted index with its statistics."""
    rows = table(spark, chunks, "chunk").dropDuplicates(["id"])
    model = make()
    known = files.prior_vectors(spark, f"{prior}/vector.parquet", model.dim) if prior else None
    vectors, counts = incremental.incremental(rows, known, prior_revision, "id", "text", make)
    meta = {"revision": model.revision, "dim": model.dim, "query_instruction": incremental.query_instruction(model)}
    return write_index(spark, rows, vectors, out, counts.first().asDict() | meta)


# --- validation


_Finding = tuple[str, str, DataFrame, str]


def _verse_report(verse: DataFrame) -> tuple[dict[str, DataFrame], list[_Finding]]:
    empty = verse.filter((F.coalesce("text", F.lit("")) == "") & ~F.coalesce("omitted", F.lit(False)))
    lost = verse.filter(F.col("omitted") & F.col("source_note").isNull())
    deviations = validation.chapter_deviations(verse)
    statistics = {"translations": validation.translation_statistics(verse), "chapters of other length": deviations}
    return statistics, [("error", "empty and not omitted", empty, "translation"), ("flag", "omitted without a note", lost, "translation"), ("flag", "chapter length", deviations, "translation")]


def _section_report(section: DataFrame, spine: DataFrame) -> tuple[dict[str, DataFrame], list[_Finding]]:
    return {"documents": validation.confession_statistics(section, spine)}, [("error", "proof that does not resolve", validation.bad_proofs(section, spine), "document")]


def _comments_report(comments: DataFrame, spine: DataFrame) -> tuple[dict[str, DataFrame], list[_Finding]]:
    bad = membership.resolves(comments, spine, "book", "chapter", F.col("verse_start"), "ok", allow_zero=True).filter("not ok")
    blank, long = comments.filter(chunking.empty(F.col("text"))), comments.filter(F.length("text") >= validation.LONG_BLOCK)
    statistics = {"commentators": validation.commentary_statistics(comments, spine), "garble": validation.garble_statistics(comments)}
    return statistics, [("error", "bad reference", bad, "commentator"), ("error", "blank", blank, "commentator"), ("flag", "long block", long, "commentator")]


def _entry_report(entry: DataFrame) -> tuple[dict[str, DataFrame], list[_Finding]]:
    kinds = validation.classified_entries(entry)
    twice = kinds.filter("lexicon = 'strongs' AND occurrence > 1")
    findings = [("error", kind, kinds.filter(F.col("kind") == kind), "lexicon") for kind in ("no meaning",)] + [("error", "duplicate key", twice, "lexicon")]
    return {"lexicons": validation.lexicon_statistics(entry)}, findings + [("flag", "meaning elsewhere", kinds.filter("kind = 'meaning elsewhere'"), "lexicon"), ("flag", "long", kinds.filter("long"), "lexicon")]


def _word_report(word: DataFrame, spine: DataFrame | None, entry: DataFrame | None) -> tuple[dict[str, DataFrame], list[_Finding]]:
    books = word.sparkSession.createDataFrame([(b,) for b in canon.IDS], "book string")
    findings = [("error", "malformed reference", membership.malformed(word, books, "book", "chapter", F.col("verse")), "source_id")]
    if spine is not None:
        astray = membership.resolves(word.select("source_id", "book", "chapter", "verse").distinct(), spine, "book", "chapter", F.col("verse"), "ok").filter("not ok")
        findings.append(("flag", "other numbering", astray, "source_id"))
    return {"words": validation.tagged_statistics(word, entry)}, findings


def _crossref_report(crossref: DataFrame) -> tuple[dict[str, DataFrame], list[_Finding]]:
    lost = [("flag", name, crossref.filter(F.col(name) == 0).withColumn("entity", F.lit(name)), "entity") for name in ("src_resolves", "tgt_resolves") if name in crossref.columns]
    return {"edges": validation.edge_statistics(crossref)}, lost


def findings(spark: SparkSession, tables: str, only: str | None = None) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """(statistics by title, all findings in one long table) of the resources whose tables are there; exact repeats of a row count once."""
    once = lambda name: table(spark, tables, name).distinct() if _have(spark, tables, name) else None
    verse = once("verse")
    spine = membership.spine(verse) if verse is not None else None
    makers = {
        "verse": lambda rows: _verse_report(rows), "section": lambda rows: _section_report(rows, spine) if spine is not None else ({}, []), "comments": lambda rows: _comments_report(rows, spine) if spine is not None else ({}, []),
        "entry": _entry_report, "word": lambda rows: _word_report(rows, spine, once("entry")), "crossref": _crossref_report,
    }
    titled: dict[str, DataFrame] = {}
    rows: list[tuple[str, str, str, DataFrame, str]] = []
    for name, make in makers.items():
        frame = verse if name == "verse" else once(name) if only in (None, name) else None
        if frame is None or only not in (None, name):
            continue
        statistics, found = make(frame)
        titled |= {f"{name}: {k}": v for k, v in statistics.items()}
        rows += [(name, *f) for f in found]
        if _have(spark, tables, f"{name}_flags"):
            rows.append((name, "flag", "parser", table(spark, tables, f"{name}_flags").withColumn("entity", F.lit(name)), "entity"))
    return titled, validation.flags(rows) if rows else None


def validate(spark: SparkSession, tables: str, only: str | None = None) -> str:
    """The report of each resource whose table is there, with its own totals of errors and flags."""
    titled, rows = findings(spark, tables, only)
    if rows is not None:
        titled |= {"findings": rows, "totals": validation.totals(rows)}
    return reports.rendered(titled)


def validate_index(spark: SparkSession, chunks: str, folder: str, make=incremental.HashingEncoder) -> str:
    """Counts by type and source, vectors by length, and a sample encoded anew against what is stored."""
    from quillspan.operators import dense

    chunk, vector = table(spark, chunks, "chunk"), table(spark, folder, "vector")
    sample = ordered.strided_sample(chunk.dropDuplicates(["id"]).select("id", "text"), ["id"])
    again = incremental.encoded(sample, "id", "text", make)
    lacking = chunk.select("id").distinct().join(vector.select("id"), "id", "left_anti").agg(F.count("*").alias("n_without_vector"))
    parts = {
        "chunks": chunk.groupBy("resource_type", "source").agg(F.count("*").alias("n"), F.count_if("truncated").alias("n_truncated")),
        "skipped": table(spark, chunks, "skipped").groupBy("resource_type", "reason").agg(F.count("*").alias("n")),
        "vectors": vector.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")),
        "chunks without a vector": lacking, "encoded again": dense.compared(again, vector, "id", "vector"), "statistics": table(spark, folder, "bm25_stats"), "made by": table(spark, folder, "meta"),
    }
    return reports.rendered(parts)


# --- packs


def scoped_search(spark: SparkSession, chunks: str, folder: str, out: str, translation: str, confession: str) -> dict[str, object]:
    """The index of one translation and one confession: vectors as they are stored, the inverted index and its statistics made anew over these chunks."""
    of = lambda kind, source: (F.col("resource_type") == kind) & (F.col("source") == source)
    chunk = table(spark, chunks, "chunk").filter(of("scripture", translation) | of("confession", confession)).dropDuplicates(["id"])
    _write(chunk, f"{out}/chunk.parquet", "id")
    rows = table(spark, out, "chunk")
    vectors = table(spark, folder, "vector").join(rows.select("id"), "id", "left_semi")
    stored = {r["key"]: r["value"] for r in table(spark, folder, "meta").collect()}
    kept = {k: stored[k] for k in ("revision", "dim", "query_instruction") if k in stored}
    return write_index(spark, rows, vectors, out, kept | {"scope": f"{translation} + {confession}", "n_chunks": rows.count()})


_PACK_KEYS = {"comments": ["commentator", "ord", "key"], "entry": ["lexicon", "strongs", "raw_key"], "word": ["book", "chapter", "verse", "position"], "crossref": ["src_book", "src_chapter", "src_verse", "rank"]}


def package(spark: SparkSession, tables: str, out: str, translation: str, confession: str, chunks: str | None = None, search: str | None = None) -> dict[str, object]:
    """Nine packs: a translation, a confession and their search index bundled; the other translations and confessions, the other tables and the
    whole index on demand. No row of a table is in both. Then the manifest of all files."""
    scopes = {"verse": ("translation", translation, ["translation", "book", "chapter", "verse_start"]), "section": ("document", confession, ["document", "ord", "key"])}
    for name, (column, wanted, key) in scopes.items():
        if _have(spark, tables, name):
            rows = packaging.split(table(spark, tables, name), F.col(column) == wanted)
            for pack in ("bundled", "on_demand"):
                packaging.stable_copy(rows.filter(F.col("pack") == pack).drop("pack"), key, f"{out}/{pack}/{name}.parquet")
    for name, key in _PACK_KEYS.items():
        if _have(spark, tables, name):
            packaging.stable_copy(table(spark, tables, name), key, f"{out}/on_demand/{name}.parquet")
    if chunks and search:
        scoped_search(spark, chunks, search, f"{out}/bundled/search", translation, confession)
        packaging.stable_copy(table(spark, chunks, "chunk"), ["id"], f"{out}/on_demand/search/chunk.parquet")
        for name in ("vector", "bm25_doc", "bm25_term", "bm25_posting", "bm25_stats", "meta"):
            packaging.stable_copy(table(spark, search, name), None, f"{out}/on_demand/search/{name}.parquet")
    rows = packaging.files(spark, out).select(F.regexp_extract("path", r"((?:bundled|on_demand)/.*\.parquet)$", 1).alias("path"), "bytes", "sha256").filter("path <> ''")
    if _have(spark, tables, "provenance"):
        acknowledged = packaging.acknowledgements([table(spark, tables, "provenance")])
    else:
        acknowledged = packaging.acknowledgements([table(spark, tables, n).select(F.lit(n).alias("resource"), F.col(c).alias("id")).distinct() for n, (c, _, _) in scopes.items() if _have(spark, tables, n)])
    body = packaging.manifest(rows, acknowledged)
    shared.write_text(spark, f"{out}/manifest.json", body)
    sizes = packaging.sizes(rows.withColumn("pack", F.substring_index("path", "/", 1)), "pack", F.col("bytes"))
    return {r["pack"]: r.asDict() for r in sizes.collect()} | {"total_bytes": json.loads(body)["total_bytes"]}
