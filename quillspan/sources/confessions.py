"""Confessions and catechisms in their several layouts, as sections (document, key, ...) and flags (document, flag)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspan.functions import citations
from quillspan.functions import text as tx
from quillspan.operators import membership, ordered
from quillspan.sources import markup
from quillspan.sources.files import lines

# The shapes that the sources' layouts give to heads, markers and citations.
_CHAPTER_LINE, _PARAGRAPH_LINE, _CITED_LINE = r"^##\s*CHAPTER\s+(\d+):", r"^\s*(\d+)\.\s+.+$", r"^\s*\((.+)\)\s*$"
_REVISED_CHAPTER, _CHAPTER_NUMBER, _SECTION_NUMBER = r"Chapter\s+\d+\s*\((\d+)\)", r"Chapter\s+(\d+)", r"(?s)^\s*(\d+)\.\s*(.*)$"
_INSERTION = r"\[(?:PCUS|UPCUSA|PCA|OPC|ARP)\b[^\]]*\]"
_ARTICLE_HEAD = r"^(?:Article\s+)?([IVXLC]+)\.\s*(.*)$"
_DAY = r"^(\d{1,3})\.?\s*Lord's [Dd]ay\b"
_NUMBERED = r"(?s)^(ARTICLE|PARAGRAPH)\s+(\d+)\s*\.?\s*(.*)$"

COLUMNS = ("document", "key", "chapter", "section", "question", "article", "lords_day", "title", "text", "proof_texts", "amendment_1788_text")
_KINDS = {"chapter": "int", "section": "int", "question": "int", "article": "int", "lords_day": "int", "proof_texts": citations.REF.simpleString().join(("array<", ">"))}


def _sections(df: DataFrame, document: str, **columns: Column) -> DataFrame:
    made = {"document": F.lit(document)} | columns
    return df.select(*[made.get(c, F.lit(None)).cast(_KINDS.get(c, "string")).alias(c) for c in COLUMNS])


def _flags(df: DataFrame, document: str, flag: Column) -> DataFrame:
    return df.select(F.lit(document).alias("document"), flag.alias("flag"))


def _distinct_refs(refs: Column, with_end: bool = True) -> Column:
    """References in order, each once: by all of it, or without its end."""
    same = (lambda a, b: a == b) if with_end else (lambda a, b: (a["book"] == b["book"]) & (a["chapter"] == b["chapter"]) & (a["verse_start"] == b["verse_start"]))
    add = lambda acc, x: F.when(F.exists(acc, lambda y: F.coalesce(same(x, y), F.lit(False)) if not with_end else x.eqNullSafe(y)), acc).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(refs, F.array().cast(_KINDS["proof_texts"]), add)


def catechism(files: DataFrame, document: str, question: str, answer: str) -> tuple[DataFrame, DataFrame]:
    """Paragraphs that pair a question with the next answer. The patterns capture number and text; an answer's number may be lacking."""
    rows = markup.events(files, ("p",)).filter("text <> ''")
    q = F.col("text").rlike(question)
    a = F.col("text").rlike(answer) & ~q
    asked = F.when(q, F.struct(F.regexp_extract("text", question, 1).try_cast("int").alias("number"), F.trim(F.regexp_extract("text", question, 2)).alias("text"), "pos"))
    rows = ordered.carried_forward(rows, ["path"], asked, [F.col("pos")], "asked").filter(a & F.col("asked").isNotNull())
    rows = ordered.first_seen(rows.withColumn("at", F.col("asked.pos")), ["path", "at"], [F.col("pos")])
    groups = answer.count("(") - answer.count("(?")
    number = F.regexp_extract("text", answer, 1).try_cast("int") if groups > 1 else F.lit(None).cast("int")
    rows = rows.withColumns({"number": F.col("asked.number"), "answered": number, "reply": F.trim(F.regexp_extract("text", answer, groups))})
    body = F.concat(F.lit("Q"), F.col("number").cast("string"), F.lit(". "), F.col("asked.text"), F.lit("\nA"), F.col("number").cast("string"), F.lit(". "), F.col("reply"))
    out = _sections(rows, document, key=F.col("number").cast("string"), question=F.col("number"), text=body)
    flags = _flags(rows.filter(F.col("answered") != F.col("number")), document, F.concat(F.lit("answer numbered "), F.col("answered").cast("string"), F.lit(" under question "), F.col("number").cast("string")))
    twice = rows.groupBy("number").agg(F.count("*").alias("n")).filter("n > 1")
    return out, flags.unionByName(_flags(twice, document, F.concat(F.lit("question twice: "), F.col("number").cast("string"))))


def _proofs(rows: DataFrame, blocks: Column) -> DataFrame:
    """``rows`` with proof_texts and unparsed of the citation blocks, an array of strings."""
    joined = rows.withColumn("_p", citations.parsed(F.array_join(blocks, ";")))
    return joined.withColumns({"proof_texts": _distinct_refs(F.col("_p.refs")), "unparsed": F.col("_p.unparsed")}).drop("_p")


def chapters_json(files: DataFrame, document: str, amendments: DataFrame | None = None, expected: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Chapters as an array with sections or one text; proofs stand in the text in brackets. ``amendments``: (chapter, section, text)."""
    schema = "languages struct<eng struct<chapters array<struct<id int, title string, text string, sections array<struct<id int, text string>>>>>>"
    rows = files.select(F.explode(F.from_json("text", schema).getField("languages").getField("eng").getField("chapters")).alias("c"))
    parts = F.when(F.col("c.sections").isNotNull(), F.col("c.sections")).when(F.col("c.text").isNotNull(), F.array(F.struct(F.lit(1).alias("id"), F.col("c.text").alias("text"))))
    empty = _flags(rows.filter(parts.isNull()), document, F.concat(F.lit("chapter without text: "), F.col("c.id").cast("string")))
    rows = rows.select(F.col("c.id").alias("chapter"), tx.squeeze(F.col("c.title")).alias("title"), F.explode(parts).alias("s")).select("chapter", "title", F.col("s.id").alias("section"), tx.squeeze(F.col("s.text")).alias("text"))
    rows = _proofs(rows, citations.inline_blocks(F.col("text")))
    where = F.concat(F.col("chapter").cast("string"), F.lit("."), F.col("section").cast("string"))
    flags = empty.unionByName(_flags(rows.select("chapter", "section", F.explode("unparsed").alias("u")), document, F.concat(where, F.lit(": not resolved: "), F.col("u"))))
    if amendments is not None:
        rows = rows.join(amendments.select("chapter", "section", F.col("text").alias("amended")), ["chapter", "section"], "left")
    else:
        rows = rows.withColumn("amended", F.lit(None).cast("string"))
    if expected is not None:
        n = rows.agg(F.countDistinct("chapter").alias("n")).filter(F.col("n") != expected)
        flags = flags.unionByName(_flags(n, document, F.concat(F.col("n").cast("string"), F.lit(f" of {expected} chapters"))))
    out = _sections(rows, document, key=where, chapter=F.col("chapter"), section=F.col("section"), title=F.col("title"), text=F.col("text"), proof_texts=F.col("proof_texts"), amendment_1788_text=F.col("amended"))
    return out, flags


def amended_sections(files: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(chapter, section, text) of the wanted sections of a revised edition whose chapter titles give the original number in brackets; later denominational insertions are removed and flagged."""
    events = markup.events(files, ("div2", "p"))
    title = F.when(F.col("tag") == "div2", F.element_at("attrs", "title"))
    rows = ordered.carried_forward(events, ["path"], title, [F.col("pos")], "chapter_title").filter("tag = 'p'")
    number = F.coalesce(F.regexp_extract("chapter_title", _REVISED_CHAPTER, 1).try_cast("int"), F.regexp_extract("chapter_title", _CHAPTER_NUMBER, 1).try_cast("int"))
    rows = rows.select("pos", number.alias("chapter"), F.regexp_extract("text", _SECTION_NUMBER, 1).try_cast("int").alias("section"), F.trim(F.regexp_extract("text", _SECTION_NUMBER, 2)).alias("text"))
    rows = ordered.first_seen(rows.filter("chapter is not null and section is not null"), ["chapter", "section"], [F.col("pos")])
    hit = wanted.select("chapter", "section").join(rows, ["chapter", "section"], "left")
    where = F.concat(F.col("chapter").cast("string"), F.lit("."), F.col("section").cast("string"))
    flags = _flags(hit.filter(F.col("text").isNull()), "amendments", F.concat(F.lit("not found: "), where))
    flags = flags.unionByName(_flags(hit.filter(F.col("text").rlike(_INSERTION)), "amendments", F.concat(F.lit("later insertion removed: "), where)))
    return hit.filter(F.col("text").isNotNull()).select("chapter", "section", tx.squeeze(F.regexp_replace("text", _INSERTION, " ")).alias("text")), flags


def proof_lines(files: DataFrame) -> DataFrame:
    """(chapter, section, block) of a text with lines '## CHAPTER n: title', 'n. paragraph' and '(citations)'; a chapter without numbers has one paragraph."""
    rows = lines(files)
    chapter = F.regexp_extract("line", _CHAPTER_LINE, 1).try_cast("int")
    refs = F.regexp_extract("line", _CITED_LINE, 1)
    para = F.when(refs == "", F.regexp_extract("line", _PARAGRAPH_LINE, 1).try_cast("int"))
    rows = ordered.carried_forward(rows.withColumns({"_c": chapter, "block": refs, "_para": para}), ["path"], "_c", [F.col("lineno")], "chapter").filter("chapter is not null")
    rows = ordered.carried_forward(rows, ["path", "chapter"], "_para", [F.col("lineno")], "section").filter("block <> ''")
    last = rows.withColumn("section", F.coalesce("section", F.lit(1)))
    return ordered.first_seen(last, ["chapter", "section"], [F.col("lineno").desc()]).select("chapter", "section", "block")


def paragraphs_json(files: DataFrame, document: str, proofs: DataFrame, expected: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Chapters and paragraphs as maps; proofs come from another file, and what either side lacks is flagged."""
    schema = "chapters map<string, struct<title string, paragraphs map<string, string>>>"
    rows = files.select(F.explode(F.from_json("text", schema).getField("chapters")).alias("chapter", "c"))
    rows = rows.select(F.col("chapter").cast("int").alias("chapter"), tx.squeeze(F.col("c.title")).alias("title"), F.explode("c.paragraphs").alias("section", "text"))
    rows = rows.select("chapter", "title", F.col("section").cast("int").alias("section"), tx.squeeze(F.col("text")).alias("text"))
    sides = membership.reconciled(rows, proofs, ["chapter", "section"])
    where = F.concat(F.col("chapter").cast("string"), F.lit("."), F.col("section").cast("string"))
    flags = _flags(sides.filter("status <> 'both'"), document, F.concat(where, F.lit(": "), F.when(F.col("status") == "left_only", "no proofs").otherwise("proofs without a paragraph")))
    full = _proofs(rows.join(proofs, ["chapter", "section"], "left"), F.array(F.coalesce("block", F.lit(""))))
    flags = flags.unionByName(_flags(full.select("chapter", "section", F.explode("unparsed").alias("u")), document, F.concat(where, F.lit(": not resolved: "), F.col("u"))))
    if expected is not None:
        n = rows.agg(F.countDistinct("chapter").alias("n")).filter(F.col("n") != expected)
        flags = flags.unionByName(_flags(n, document, F.concat(F.col("n").cast("string"), F.lit(f" of {expected} chapters"))))
    return _sections(full, document, key=where, chapter=F.col("chapter"), section=F.col("section"), title=F.col("title"), text=F.col("text"), proof_texts=F.col("proof_texts")), flags


def articles_html(files: DataFrame, document: str, expected: int) -> tuple[DataFrame, DataFrame]:
    """Paragraphs headed by roman numerals. A numeral is a head only if it follows the last head's; that recurrence is run once per document."""
    page = files.withColumn("text", F.coalesce(F.get_json_object("text", "$.parse.text"), "text"))
    rows = markup.html_paragraphs(page)
    rows = rows.withColumns({"number": tx.roman_value(F.regexp_extract("text", _ARTICLE_HEAD, 1)), "rest": F.regexp_extract("text", _ARTICLE_HEAD, 2)})

    def accept(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        last, out = 0, []
        for n in pdf["number"]:
            last = int(n) if pd.notna(n) and int(n) == last + 1 else last
            out.append(last)
        heads = pd.Series(out, index=pdf.index)
        return pdf.assign(article=heads, is_head=heads.diff().fillna(heads) > 0)[["path", "pos", "text", "rest", "article", "is_head"]]

    # the paragraphs of one document: a few hundred rows
    rows = rows.groupBy("path").applyInPandas(accept, "path string, pos int, text string, rest string, article int, is_head boolean").filter("article > 0")
    first = Window.partitionBy("path", "article").orderBy("pos")
    rows = rows.withColumn("n", F.row_number().over(first)).withColumn("inline", F.first("rest").over(first))
    title = F.when((F.col("n") == 1), tx.present(F.col("rest"))).when((F.col("n") == 2) & (F.coalesce("inline", F.lit("")) == ""), F.col("text"))
    body = F.when((F.col("n") > 2) | ((F.col("n") == 2) & (F.coalesce("inline", F.lit("")) != "")), F.struct("n", "text"))
    rows = rows.groupBy("path", "article").agg(F.max(title).alias("title"), F.array_sort(F.collect_list(body)).alias("b"))
    rows = rows.withColumn("text", F.array_join(F.transform("b", lambda x: x["text"]), " "))
    out = _sections(rows, document, key=F.col("article").cast("string"), article=F.col("article"), title=F.coalesce("title", F.lit("")), text=F.col("text"))
    want = files.sparkSession.createDataFrame([("x", expected)], "k string, expected int")
    lost = ordered.missing_numbers(rows.withColumn("k", F.lit("x")), ["k"], "article", want)
    return out, _flags(lost, document, F.concat(F.lit("missing article "), F.col("missing").cast("string")))


def questions_by_day(files: DataFrame, document: str, days: int) -> tuple[DataFrame, DataFrame]:
    """Questions under numbered days. A day's number that breaks the sequence is taken as the next one, and flagged; proofs are counted once by book, chapter and verse."""
    rows = markup.events(files, ("p", "scripRef")).filter("tag <> '!error'")
    day = F.when(F.col("tag") == "p", F.regexp_extract("text", _DAY, 1).try_cast("int"))
    marks = ordered.repaired_sequence(rows.withColumn("marker", day).filter("marker is not null").select("path", "pos", "marker"), ["path"], "marker", [F.col("pos")], "lords_day")
    flags = _flags(marks.filter("repaired"), document, F.concat(F.lit("day "), F.col("marker").cast("string"), F.lit(" where "), F.col("lords_day").cast("string"), F.lit(" is due")))
    rows = rows.join(marks.select("path", "pos", F.col("lords_day").alias("_day")), ["path", "pos"], "left")
    rows = ordered.carried_forward(rows, ["path"], "_day", [F.col("pos")], "lords_day")
    pieces = F.split("text", r"(?=\bQuestion\s+\d{1,3}\.)")
    prose = rows.filter("tag = 'p'").select("path", "pos", "lords_day", "_day", F.posexplode(pieces).alias("i", "piece"))
    number = F.regexp_extract("piece", r"^Question\s+(\d{1,3})\.\s*", 1).try_cast("int")
    prose = prose.withColumns({"_q": number, "piece": F.trim(F.regexp_replace("piece", r"^Question\s+\d{1,3}\.\s*", ""))})
    prose = ordered.carried_forward(prose, ["path"], "_q", [F.col("pos"), F.col("i")], "question")
    lead = F.col("_q").isNull() & ((F.col("_day").isNotNull()) | F.col("question").isNull())
    texts = prose.filter(~lead & (F.col("piece") != "")).groupBy("path", "question").agg(F.array_sort(F.collect_list(F.struct("pos", "i", F.col("piece").alias("t")))).alias("t"))
    days_of = prose.filter("_q is not null").groupBy("path", "question").agg(F.max_by("lords_day", F.struct("pos", "i")).alias("lords_day"))
    asked = prose.filter("_q is not null").select("path", "pos", F.lit("p").alias("tag"), F.col("question").alias("_q"))
    refs = rows.join(asked.groupBy("path", "pos", "tag").agg(F.max("_q").alias("_q")), ["path", "pos", "tag"], "left")
    refs = ordered.carried_forward(refs, ["path"], "_q", [F.col("pos")], "question").filter("tag = 'scripRef' and question is not null")
    token = F.array_join(F.slice(F.split(F.regexp_replace(F.element_at("attrs", "osisRef"), "^Bible:", ""), r"\."), 1, 3), ".")
    refs = refs.withColumn("p", citations.osis_point(token)).filter("p is not null")
    refs = refs.groupBy("path", "question").agg(F.array_sort(F.collect_list(F.struct("pos", F.struct("p.book", "p.chapter", F.col("p.verse").alias("verse_start"), F.lit(None).cast("int").alias("verse_end")).alias("r")))).alias("r"))
    full = days_of.join(texts, ["path", "question"], "left").join(refs, ["path", "question"], "left")
    body = F.trim(F.concat(F.lit("Question "), F.col("question").cast("string"), F.lit(". "), F.array_join(F.transform(F.coalesce("t", F.array()), lambda x: x["t"]), " ")))
    proofs = _distinct_refs(F.transform(F.coalesce("r", F.array()), lambda x: x["r"]), with_end=False)
    out = _sections(full, document, key=F.col("question").cast("string"), question=F.col("question"), lords_day=F.col("lords_day"), text=body, proof_texts=proofs)
    n = full.agg(F.countDistinct("lords_day").alias("n")).filter(F.col("n") != days)
    return out, flags.unionByName(_flags(n, document, F.concat(F.col("n").cast("string"), F.lit(f" of {days} days"))))


def heads_of_doctrine(files: DataFrame, document: str, slugs: dict[str, str], expected: dict[str, tuple[int, int]]) -> tuple[DataFrame, DataFrame]:
    """Articles and rejections under heads, and a conclusion. ``expected``: slug -> (articles, rejections)."""
    rows = markup.events(files, ("div1", "div2", "p"))
    of = lambda tag: F.when(F.col("tag") == tag, F.element_at("attrs", "title"))
    rows = ordered.carried_forward(rows, ["path"], of("div1"), [F.col("pos")], "head_title")
    rows = ordered.carried_forward(rows, ["path"], F.when(F.col("tag") == "div1", F.lit("")).otherwise(of("div2")), [F.col("pos")], "part_title")
    table = F.create_map(*[F.lit(x) for pair in slugs.items() for x in pair])
    slug = F.element_at(table, F.regexp_extract("head_title", rf"^({'|'.join(sorted(slugs, key=len, reverse=True))})\s+Heads?\s+of\s+Doctrine", 1))
    closing = rows.filter((F.col("tag") == "div1") & F.lower("head_title").startswith("conclusion")).withColumn("body", F.trim(F.regexp_replace("text", r"^Conclusion\s*", ""))).filter("body <> ''")
    rejected = F.lower("part_title").contains("rejection")
    rows = rows.filter("tag = 'p'").withColumns({"slug": slug, "letter": F.when(rejected, "r").otherwise("a"), "mark": F.when(rejected, F.lit("PARAGRAPH")).otherwise(F.lit("ARTICLE"))})
    rows = rows.filter(F.col("slug").isNotNull() & (F.regexp_extract("text", _NUMBERED, 1) == F.col("mark")))
    rows = rows.withColumns({"number": F.regexp_extract("text", _NUMBERED, 2).cast("int"), "body": F.trim(F.regexp_extract("text", _NUMBERED, 3))})
    ranked = ordered.running_rank(rows, ["slug", "letter", "number"], [F.col("path"), F.col("pos")], "n")
    key = F.concat(F.lit("h"), F.col("slug"), F.lit("."), F.col("letter"), F.col("number").cast("string"))
    out = _sections(ranked.filter("n = 1"), document, key=key, title=F.regexp_replace("head_title", r"\.$", ""), text=F.col("body"))
    out = out.unionByName(_sections(closing, document, key=F.lit("conclusion"), title=F.lit("Conclusion"), text=F.col("body")))
    flags = _flags(ranked.filter("n > 1"), document, F.concat(key, F.lit(" twice")))
    want = files.sparkSession.createDataFrame([(s, letter, n) for s, pair in expected.items() for letter, n in zip("ar", pair)], "slug string, letter string, expected int")
    got = ranked.filter("n = 1").groupBy("slug", "letter").agg(F.count("*").alias("got"))
    off = want.join(got, ["slug", "letter"], "left").withColumn("got", F.coalesce("got", F.lit(0))).filter("got <> expected")
    return out, flags.unionByName(_flags(off, document, F.concat(F.lit("h"), F.col("slug"), F.lit("."), F.col("letter"), F.lit(": "), F.col("got").cast("string"), F.lit(" of "), F.col("expected").cast("string"))))
