"""Queries of the parsers on small inputs of each format, against rows written by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan.functions import citations
from quillspan.functions import text as tx
from quillspan.operators import validation
from quillspan.sources import commentaries, confessions, edges, files, lexicons, scans, usfm

c = F.col

EDGES = "From Verse\tTo Verse\tVotes\t#x\nGen.1.1\tEph.6.23-Eph.6.24\t2\nGen.1.1\tPs.2.3\t-1\nGen.1.2\tJohn.1.1\t0\nGen.1.1\tPs.2.3\tmany\nGen.1.1\tPs.2.3\nTob.1.1\tPs.2.3\t3\nGen.1.1\tTob.2.3\t3\n"
CITATIONS = ["Rom. 9:15, 18", "2 Timothy 3:15-17; Isaiah 8:20", "Gen. 2:7 with Eccles. 12:7", "Jude 4; 2 John 10, 11", "Lev. 18", "Tobit 1:1", "Job 14:4, Job 15:14"]
USFM = {
    "gen": "\\id GEN sample\n\\h Genesis\n\\c 1\n\\s1 Heading\n\\p\n\\v 1 One \\f + \\ft note\\f* two.\\v 2 B. \\v 3-4 C \\w word|strong=\"G1\"\\w*.\n\\q1 more\n\\v 5 He said, \\wj Go \\+w now|x\\+w*\\wj* then\n",
    "psa": "\\id PSA\n\\c 3\n\\d \\v 1 A Psalm\n\\q1 LORD, how\n\\v 2 b\n\\c 4\n\\d Michtam\n\\q \\v 1 Hear\n\\v 2 \\f + \\fr 4:2 \\ft Some add text.\\f*\n\\v x bad\n",
    "tob": "\\id TOB\n\\c 1\n\\v 1 no\n",
}
THML = """<ThML><ThML.body><div1 title="Romans"><div2 title="Chapter 9"><p>Lede one.</p><scripCom parsed="|Rom|9|0|0|0" passage="Romans 9"/><p>Intro.</p>
<p><scripCom parsed="|Rom|9|23|0|24" passage="Ro 9:23"/></p><p>On  twenty-three.</p><p>More.</p><scripCom parsed="|Tob|1|1|0|0"/><p>Still.</p></div2>
<div2 title="Chapter 9 again"><scripCom parsed="|Rom|9|23|0|24" passage="Ro 9:23"/><p>Second block.</p></div2></div1></ThML.body></ThML>"""
GREEK = """<lexicon><entry strongs="00025"><greek unicode="ἀγαπάω" translit="agapao"/><pronunciation strongs="ag-ap-ah'-o"/><strongs_derivation>perhaps from <greek unicode="ἄγαν"/> (or compare <strongsref language="HEBREW" strongs="05689"/>);</strongs_derivation>
<strongs_def>to <i>love</i></strongs_def><kjv_def>:--(be-)love(-ed). Compare <strongsref language="GREEK" strongs="05368"/>.</kjv_def></entry><entry strongs="00026"><greek unicode="ἀγάπη" translit="agape"/><strongs_def>love</strongs_def></entry>
<entry strongs="00026"><strongs_def>again</strongs_def></entry><entry strongs="02717">2717 Not Used</entry></lexicon>"""
HEBREW = """<lexicon xmlns="http://example.org/ns"><entry id="H1"><w pos="n" pron="awb" xlit="ab">אָב</w><source>a primitive word;</source><meaning><def>father</def>, compare <w src="H0007">7</w></meaning><usage>chief, (fore-) father.</usage></entry></lexicon>"""
BDB = """<lexicon><entry id="a.ae.ab"><w>אב</w><sense><def>father</def></sense><sense><def>head</def></sense></entry><entry id="a.ae.ac"><w>x</w></entry></lexicon>"""
INDEX = """<index><entry><xref bdb="a.ae.ab" strong="1"/></entry><entry><xref bdb="a.ae.ab" strong="2"/></entry><entry><xref bdb="a.ae.ac"/></entry></index>"""
SCRIPT = 'var strongsHebrewDictionary = {"H0001":{"lemma":"אָב","xlit":"ab","pron":"awb","strongs_def":"  father  ","kjv_def":"chief"},"X9":{"lemma":"y"}};'
BRIEF = "prose\nG0026\tG0026 =\tG0026\tἀγάπη\tagape\tG:N-F\tlove\tlove, <b>goodwill</b>\nG2424\tG2424G\tG2424\tἸησοῦς\tIesous\tN:N\tJesus\tJesus of N.\nG0026\tG0026\tG0026\tἀ\ta\tG\tx\tagain\n"
OSHB = '<osis><verse osisID="Gen.1.1"><w lemma="b/7225" morph="HR/Ncfsa">בְּ/רֵאשִׁית</w><w lemma="1254 a" morph="HVqp3ms">בָּרָא</w></verse><verse osisID="Matt.1.1"><w lemma="1">x</w></verse></osis>'
TAGNT = "# head\nJhn.1.1#01=NKO\tἘν (En)\tIn\tG1722=PREP\tἐν=in\tNA28\nJhn.1.1#02=NKO\tἀρχῇ (archē)\tbeginning\tG0746=N-DSF\tἀρχή=beginning\tNA28\nXyz.1.1#01=N\tx\tx\tG1=N\tx=x\tx\n"
WCF = '{"languages":{"eng":{"chapters":[{"id":1,"title":"Of  Scripture","sections":[{"id":1,"text":"Light of nature (Rom. 2:14, 15; Rom. 2:14; Lev. 18)."},{"id":2,"text":"Plain."}]},{"id":12,"title":"Of Adoption","text":"All those (Eph. 1:5)."},{"id":13,"title":"Void"}]}}}'
AMENDED = '<ThML><div2 title="Chapter 3 (1)"><p>1. Wrong.</p><p>2. Revised [PCUS added] text.</p></div2></ThML>'
LBCF = '{"chapters":{"1":{"title":"Of Scripture","paragraphs":{"1":"First.","2":"Second."}},"12":{"title":"Of Adoption","paragraphs":{"1":"Only."}}}}'
PROOFS = "## CHAPTER 1: OF SCRIPTURE\n1. First.\n(2 Timothy 3:15-17; Isaiah 8:20)\n3. Third.\n(Rom. 1:1)\n## CHAPTER 12: OF ADOPTION\nOnly.\n(Eph. 1:5; Tobit 2:2)\n"
WSC = "<ThML><p>Q1. What is first?</p><p>A1: This.</p><p>Q2: And then?</p><p>A3: That.</p></ThML>"
BELGIC = '{"parse":{"text":"<p>Front.</p><p>I. Of One</p><p>Body <i>one</i>.</p><p>V. not a head</p><p>Article II.</p><p>Of Two</p><p>Body two.</p>"}}'
HEIDELBERG = """<body><p>28. Lord's Day. Question 75. How? Answer: so. <scripRef osisRef="Bible:Matt.26.26"/></p><p>More <scripRef osisRef="Bible:Matt.26.26-Matt.26.28"/> of it.</p><p>2. Lord's Day.</p><p>Question 78. What? Question 79. Why?</p></body>"""
DORT = """<ThML><div1 type="section" title="First Head of Doctrine."><div2 type="subsection" title="Articles"><p>ARTICLE 1. As all men.</p><p>ARTICLE 2 In this.</p><p>ARTICLE 2 Again.</p></div2><div2 type="subsection" title="Rejection of Errors"><p>PARAGRAPH 1 Who teach.</p></div2></div1>
<div1 type="section" title="Conclusion"><p>Conclusion And this is it.</p></div1></ThML>"""
SCAN = (
    "This is a digital copy of a book that was kept.\nPSALM I.\n\nTitle words here.\nEXPOSITION.\n1. \"Blessed\" is the man that walk-\neth well. So Psalm xliv. 17, we read.\nPSALM THE FIRST. 3\n7\nVerse 2.— His delight. \n"
    "9. \"Too far\" for this psalm.\nPSALM III.\nHINTS TO THE PREACHER.\nVerse 1.— Lord.\nPSALM THE SECQND. 9\nEXPLANATORY NOTES.\nWhole.\nAbout Google Book Search trailing."
)


def _of(spark: SparkSession, **texts: str) -> DataFrame:
    return files.texts(spark, texts)


def _refs(col) -> F.Column:
    r = lambda x: F.concat(x["book"], F.lit("."), x["chapter"].cast("string"), F.lit("."), x["verse_start"].cast("string"), F.coalesce(F.concat(F.lit("-"), x["verse_end"].cast("string")), F.lit("")))
    return F.array_join(F.transform(col, r), " ")


def crossref_parse(spark: SparkSession, _: str) -> DataFrame:
    good, bad = edges.parse(_of(spark, x=EDGES))
    end = F.concat_ws(".", "tgt_end_book", "tgt_end_chapter", "tgt_end_verse")
    a = good.select(F.concat_ws(".", "src_book", "src_chapter", "src_verse").alias("item"), end.alias("detail"), c("votes").cast("long").alias("n"), c("rank").cast("long").alias("place"))
    return a.unionByName(bad.select(F.lit("reject").alias("item"), c("reason").alias("detail"), F.lit(None).cast("long").alias("n"), c("lineno").cast("long").alias("place")))


def scripref_parse(spark: SparkSession, _: str) -> DataFrame:
    rows = spark.createDataFrame([(x,) for x in CITATIONS], "block string").withColumn("p", citations.parsed("block"))
    return rows.select("block", _refs(c("p.refs")).alias("refs"), F.array_join("p.unparsed", "|").alias("unparsed"))


def usfm_parse(spark: SparkSession, _: str) -> DataFrame:
    verses, flags = usfm.verses(files.texts(spark, USFM))
    spans = F.array_join(F.transform("wj_spans", lambda s: F.concat(s[0].cast("string"), F.lit("-"), s[1].cast("string"))), " ")
    a = verses.select(F.concat(c("book"), F.lit(" "), c("chapter").cast("string"), F.lit(":"), c("verse_start").cast("string"), F.lit("-"), c("verse_end").cast("string")).alias("item"), "text", spans.alias("red"), F.coalesce("source_note", "superscription", F.lit("")).alias("extra"))
    return a.unionByName(flags.select(F.lit("flag").alias("item"), c("flag").alias("text"), F.lit("").alias("red"), F.lit("").alias("extra")))


def thml_parse(spark: SparkSession, _: str) -> DataFrame:
    rows, flags = commentaries.parse(_of(spark, v1=THML), "henry")
    return rows.select("key", "text", "passage", "chapter_level").unionByName(flags.select(F.lit("flag").alias("key"), c("flag").alias("text"), F.lit("").alias("passage"), F.lit(0).alias("chapter_level")))


def lexicon_parse(spark: SparkSession, _: str) -> DataFrame:
    parts = [
        lexicons.greek_xml(_of(spark, g=GREEK)), lexicons.hebrew_xml(_of(spark, h=HEBREW)), lexicons.linked_xml(_of(spark, b=BDB), _of(spark, i=INDEX)), lexicons.from_script(_of(spark, s=SCRIPT), "hebrew"), lexicons.brief_tsv(_of(spark, t=BRIEF)),
    ]
    out = None
    for rows, flags in parts:
        some = rows.select("lexicon", "language", c("strongs").alias("key"), "lemma", "definition", "derivation", "kjv_def", "not_used")
        some = some.unionByName(flags.select(F.lit("flag").alias("lexicon"), F.lit("").alias("language"), "key", c("flag").alias("lemma"), *[F.lit(None).cast("string").alias(n) for n in ("definition", "derivation", "kjv_def")], F.lit(False).alias("not_used")))
        out = some if out is None else out.unionByName(some)
    return out


def lex_keys(spark: SparkSession, _: str) -> DataFrame:
    rows = spark.createDataFrame([("G0025",), ("H08012",), ("G2424G",), ("x1",), ("c/1961",), ("6965 b",)], "raw string")
    return rows.select("raw", tx.strongs_key(c("raw"), "G").alias("plain"), tx.extended_key(c("raw")).alias("extended"), tx.base_key(tx.extended_key(c("raw"))).alias("base"), F.array_join(tx.lemma_keys(c("raw")), " ").alias("lemma_keys"), lexicons.sort_key(c("raw")).alias("sort_key"))


def tagged_parse(spark: SparkSession, _: str) -> DataFrame:
    a, fa = lexicons.tagged_xml(_of(spark, o=OSHB))
    b, fb = lexicons.tagged_tsv(_of(spark, t=TAGNT))
    show = lambda df: df.select(F.concat_ws(".", "book", "chapter", "verse", "position").alias("word"), "surface", F.array_join("strongs", " ").alias("keys"), "morph", "lemma", "gloss", "editions")
    lost = fa.unionByName(fb).select(F.lit("flag").alias("word"), c("flag").alias("surface"), c("key").alias("keys"), *[F.lit(None).cast("string").alias(n) for n in ("morph", "lemma", "gloss", "editions")])
    return show(a).unionByName(show(b)).unionByName(lost)


def _shown(parts: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    out = None
    for rows, flags in parts:
        some = rows.select("document", "key", "title", "text", _refs(c("proof_texts")).alias("proofs"), c("amendment_1788_text").alias("amended"), "lords_day")
        some = some.unionByName(flags.select("document", F.lit("flag").alias("key"), F.lit(None).cast("string").alias("title"), c("flag").alias("text"), F.lit(None).cast("string").alias("proofs"), F.lit(None).cast("string").alias("amended"), F.lit(None).cast("int").alias("lords_day")))
        out = some if out is None else out.unionByName(some)
    return out


def confession_parse(spark: SparkSession, _: str) -> DataFrame:
    wanted = spark.createDataFrame([(1, 2), (9, 9)], "chapter int, section int")
    amended, lost = confessions.amended_sections(_of(spark, a=AMENDED), wanted)
    wcf, wcf_flags = confessions.chapters_json(_of(spark, w=WCF), "wcf", amended, 33)
    return _shown([
        (wcf, wcf_flags.unionByName(lost)),
        confessions.paragraphs_json(_of(spark, b=LBCF), "lbcf", confessions.proof_lines(_of(spark, p=PROOFS))),
        confessions.catechism(_of(spark, q=WSC), "wsc", r"(?s)^Q(\d{1,3})[:.]\s*(.*)$", r"(?s)^A(\d{1,3})[:.]\s*(.*)$"),
    ])


def article_parse(spark: SparkSession, _: str) -> DataFrame:
    return _shown([
        confessions.articles_html(_of(spark, b=BELGIC), "belgic", 3),
        confessions.questions_by_day(_of(spark, h=HEIDELBERG), "heidelberg", 52),
        confessions.heads_of_doctrine(_of(spark, d=DORT), "dort", {"First": "1", "Second": "2"}, {"1": (2, 2)}),
    ])


def ocr_segment(spark: SparkSession, _: str) -> DataFrame:
    volume = spark.createDataFrame([("v1", SCAN, 1, 4)], "path string, text string, first int, last int")
    lengths = spark.createDataFrame([(1, 6), (2, 12), (3, 8)], "hymn int, n_verses int")
    rows, flags = scans.comments(volume, "treasury", "PSA", lengths)
    return rows.select("key", "component", "text").unionByName(flags.select(F.lit("flag").alias("key"), F.lit("").alias("component"), c("flag").alias("text")))


def roman_numerals(spark: SparkSession, _: str) -> DataFrame:
    rows = spark.createDataFrame([(x,) for x in ("I", "IV", "xlix", "CXIX", "VX", "abc")], "seen string")
    return rows.select("seen", tx.roman_value(c("seen")).alias("value"))


def tagged_stats(spark: SparkSession, _: str) -> DataFrame:
    words = lexicons.tagged_xml(_of(spark, o=OSHB))[0].unionByName(lexicons.tagged_tsv(_of(spark, t=TAGNT))[0])
    return validation.tagged_statistics(words, spark.createDataFrame([("H7225",), ("G1722",)], "strongs string"))


def omission_notes(spark: SparkSession, _: str) -> DataFrame:
    rows = usfm.omissions(_of(spark, a="\\id MAT\n\\c 18\n\\v 10 a \\f + \\fr 18:10 \\ft BYZ include \\fqa \\fv 11\\fv*For the Son came\\ft ; see \\ref Luke 19:10|LUK 19:10\\ref*.\\f*\n"))
    return rows.select("book", "chapter", "verse", "note")


QUERIES = {f.__name__: f for f in (tagged_stats, omission_notes, crossref_parse, scripref_parse, usfm_parse, thml_parse, lexicon_parse, lex_keys, tagged_parse, confession_parse, article_parse, ocr_segment, roman_numerals)}


def _values(columns: str, rows: list[tuple]) -> str:
    show = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    names = [x.split()[0] for x in columns.split(", ")]
    casts = ", ".join(f"{n}::{k} AS {n}" for n, k in (x.split() for x in columns.split(", ")))
    return f"SELECT {casts} FROM (VALUES {', '.join('(' + ', '.join(map(show, r)) + ')' for r in rows)}) t({', '.join(names)})"


SQL = {
    "tagged_stats": _values("n_words BIGINT, n_verses BIGINT, n_books BIGINT, n_keyed BIGINT, n_orphans BIGINT", [(4, 2, 2, 4, 2)]),
    "omission_notes": _values("book VARCHAR, chapter INTEGER, verse INTEGER, note VARCHAR", [("MAT", 18, 11, "For the Son came")]),
    "crossref_parse": _values("item VARCHAR, detail VARCHAR, n BIGINT, place BIGINT", [
        ("GEN.1.1", "EPH.6.24", 2, 1), ("GEN.1.1", "PSA.2.3", -1, 2), ("GEN.1.2", "JHN.1.1", 0, 1),
        ("reject", "non-integer votes", None, 5), ("reject", "too few columns", None, 6), ("reject", "unparseable source", None, 7), ("reject", "unparseable target", None, 8),
    ]),
    "scripref_parse": _values("block VARCHAR, refs VARCHAR, unparsed VARCHAR", [
        ("Rom. 9:15, 18", "ROM.9.15 ROM.9.18", ""), ("2 Timothy 3:15-17; Isaiah 8:20", "2TI.3.15-17 ISA.8.20", ""), ("Gen. 2:7 with Eccles. 12:7", "GEN.2.7 ECC.12.7", ""), ("Jude 4; 2 John 10, 11", "JUD.1.4 2JN.1.10 2JN.1.11", ""),
        ("Lev. 18", "", "Lev. 18"), ("Tobit 1:1", "", "Tobit 1:1"), ("Job 14:4, Job 15:14", "JOB.14.4 JOB.15.14", ""),
    ]),
    "usfm_parse": _values("item VARCHAR, text VARCHAR, red VARCHAR, extra VARCHAR", [
        ("GEN 1:1-1", "One two.", "", ""), ("GEN 1:2-2", "B.", "", ""), ("GEN 1:3-4", "C word. more", "", ""), ("GEN 1:5-5", "He said, Go now then", "9-15", ""),
        ("PSA 3:1-1", "LORD, how", "", "A Psalm"), ("PSA 3:2-2", "b", "", ""), ("PSA 4:1-1", "Hear", "", "Michtam"), ("PSA 4:2-2", "", "", "Some add text."),
        ("flag", "PSA 4:2 parsed empty", "", ""), ("flag", "PSA 4: unparseable verse number 'x'", "", ""), ("flag", "'TOB' is no book of the canon", "", ""),
    ]),
    "thml_parse": _values("key VARCHAR, text VARCHAR, passage VARCHAR, chapter_level INTEGER", [
        ("ROM.9.0#p1", "Lede one.", "Romans 9", 1), ("ROM.9.0#p2", "Intro.", "Romans 9", 1), ("ROM.9.23-24#p1", "On twenty-three.", "Ro 9:23", 0), ("ROM.9.23-24#p2", "More.", "Ro 9:23", 0), ("ROM.9.23-24#p3", "Still.", "Ro 9:23", 0),
        ("ROM.9.23-24#p1~2", "Second block.", "Ro 9:23", 0), ("flag", "anchor names no verse: |Tob|1|1|0|0", "", 0), ("flag", "1 keys repeat", "", 0),
    ]),
    "lexicon_parse": _values("lexicon VARCHAR, language VARCHAR, key VARCHAR, lemma VARCHAR, definition VARCHAR, derivation VARCHAR, kjv_def VARCHAR, not_used BOOLEAN", [
        ("strongs", "greek", "G25", "ἀγαπάω", "to love", "perhaps from ἄγαν (or compare H5689);", "(be-)love(-ed). Compare G5368.", False), ("strongs", "greek", "G26", "ἀγάπη", "love", None, None, False),
        ("strongs", "greek", "G2717", None, None, None, None, True), ("flag", "", "G26", "duplicate key, first kept", None, None, None, False),
        ("strongs", "hebrew", "H1", "אָב", "father, compare H7", "a primitive word;", "chief, (fore-) father.", False),
        ("bdb", "hebrew", "H1", "אב", "father; head", None, None, False), ("bdb", "hebrew", "", "x", None, None, None, False), ("flag", "", "a.ae.ac", "no key in the index", None, None, None, False),
        ("strongs", "hebrew", "H1", "אָב", "father", None, "chief", False), ("flag", "", "X9", "unparseable key", None, None, None, False),
        ("tbesg", "greek", "G26", "ἀγάπη", "love, goodwill", "G:N-F", "love", False), ("tbesg", "greek", "G2424G", "Ἰησοῦς", "Jesus of N.", "N:N", "Jesus", False), ("flag", "", "G26", "duplicate key, first kept", None, None, None, False),
    ]),
    "lex_keys": _values("raw VARCHAR, plain VARCHAR, extended VARCHAR, base VARCHAR, lemma_keys VARCHAR, sort_key INTEGER", [
        ("G0025", "G25", "G25", "G25", "H25", 25), ("H08012", "G8012", None, None, "H8012", 8012), ("G2424G", None, "G2424G", "G2424", "H2424", 1073741824), ("x1", None, None, None, "H1", 1073741824),
        ("c/1961", None, None, None, "H1961", 1073741824), ("6965 b", None, None, None, "H6965", 1073741824),
    ]),
    "tagged_parse": _values("word VARCHAR, surface VARCHAR, keys VARCHAR, morph VARCHAR, lemma VARCHAR, gloss VARCHAR, editions VARCHAR", [
        ("GEN.1.1.1", "בְּ/רֵאשִׁית", "H7225", "HR/Ncfsa", None, None, None), ("GEN.1.1.2", "בָּרָא", "H1254", "HVqp3ms", None, None, None), ("JHN.1.1.1", "Ἐν", "G1722", "PREP", "ἐν", "in", "NKO"), ("JHN.1.1.2", "ἀρχῇ", "G746", "N-DSF", "ἀρχή", "beginning", "NKO"),
        ("flag", "unknown book", "Xyz.1.1#01=N", None, None, None, None),
    ]),
    "confession_parse": _values("document VARCHAR, key VARCHAR, title VARCHAR, text VARCHAR, proofs VARCHAR, amended VARCHAR, lords_day INTEGER", [
        ("wcf", "1.1", "Of Scripture", "Light of nature (Rom. 2:14, 15; Rom. 2:14; Lev. 18).", "ROM.2.14 ROM.2.15", None, None), ("wcf", "1.2", "Of Scripture", "Plain.", "", "Revised text.", None), ("wcf", "12.1", "Of Adoption", "All those (Eph. 1:5).", "EPH.1.5", None, None),
        ("wcf", "flag", None, "chapter without text: 13", None, None, None), ("wcf", "flag", None, "1.1: not resolved: Lev. 18", None, None, None), ("wcf", "flag", None, "2 of 33 chapters", None, None, None),
        ("amendments", "flag", None, "not found: 9.9", None, None, None), ("amendments", "flag", None, "later insertion removed: 1.2", None, None, None),
        ("lbcf", "1.1", "Of Scripture", "First.", "2TI.3.15-17 ISA.8.20", None, None), ("lbcf", "1.2", "Of Scripture", "Second.", "", None, None), ("lbcf", "12.1", "Of Adoption", "Only.", "EPH.1.5", None, None),
        ("lbcf", "flag", None, "1.2: no proofs", None, None, None), ("lbcf", "flag", None, "1.3: proofs without a paragraph", None, None, None), ("lbcf", "flag", None, "12.1: not resolved: Tobit 2:2", None, None, None),
        ("wsc", "1", None, "Q1. What is first?\nA1. This.", None, None, None), ("wsc", "2", None, "Q2. And then?\nA2. That.", None, None, None), ("wsc", "flag", None, "answer numbered 3 under question 2", None, None, None),
    ]),
    "article_parse": _values("document VARCHAR, key VARCHAR, title VARCHAR, text VARCHAR, proofs VARCHAR, amended VARCHAR, lords_day INTEGER", [
        ("belgic", "1", "Of One", "Body one . V. not a head", None, None, None), ("belgic", "2", "Of Two", "Body two.", None, None, None), ("belgic", "flag", None, "missing article 3", None, None, None),
        ("heidelberg", "75", None, "Question 75. How? Answer: so. More of it.", "MAT.26.26", None, 28), ("heidelberg", "78", None, "Question 78. What?", "", None, 29), ("heidelberg", "79", None, "Question 79. Why?", "", None, 29),
        ("heidelberg", "flag", None, "day 2 where 29 is due", None, None, None), ("heidelberg", "flag", None, "2 of 52 days", None, None, None),
        ("dort", "h1.a1", "First Head of Doctrine", "As all men.", None, None, None), ("dort", "h1.a2", "First Head of Doctrine", "In this.", None, None, None), ("dort", "h1.r1", "First Head of Doctrine", "Who teach.", None, None, None),
        ("dort", "conclusion", "Conclusion", "And this is it.", None, None, None), ("dort", "flag", None, "h1.a2 twice", None, None, None), ("dort", "flag", None, "h1.r: 1 of 2", None, None, None),
    ]),
    "ocr_segment": _values("key VARCHAR, component VARCHAR, text VARCHAR", [
        ("PSA.1.0#titl1", "title", "PSALM I. Title words here."), ("PSA.1.0#expo1", "exposition", "EXPOSITION."), ("PSA.1.1#expo1", "exposition", '1. "Blessed" is the man that walketh well. So Psalm xliv. 17, we read.'),
        ("PSA.1.2#expo1", "exposition", 'Verse 2.— His delight. 9. "Too far" for this psalm.'), ("PSA.3.0#titl1", "title", "PSALM III."), ("PSA.3.0#hint1", "hints", "HINTS TO THE PREACHER."), ("PSA.3.1#hint1", "hints", "Verse 1.— Lord."),
        ("PSA.2.0#note1", "notes", "EXPLANATORY NOTES. Whole."), ("flag", "", "head recovered from a running header: 2"), ("flag", "", "no head found: 4"),
    ]),
    "roman_numerals": _values("seen VARCHAR, value INTEGER", [("I", 1), ("IV", 4), ("xlix", 49), ("CXIX", 119), ("VX", 5), ("abc", None)]),
}
