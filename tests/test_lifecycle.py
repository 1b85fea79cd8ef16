"""Whole lifecycles over small libraries: builders, reports, packs and the command line, on file:// URIs throughout."""

import json

import pytest

from quillspan import cli, shared
from quillspan.operators import incremental, membership, validation
from quillspan.plans import parser_queries as samples
from quillspan.plans import pipeline
from quillspan.sources import files

LIBRARY = {
    "translations": {"kjv": {"files": "kjv-*.usfm", "name": "One"}, "bsb": {"files": "bsb-*.usfm"}},
    "variants": [["MAT", 18, 11], ["MAT", 18, 12], ["LUK", 1, 1]],
    "confessions": {
        "wcf": {"layout": "chapters_json", "files": "wcf.json", "amended": "pca.xml", "wanted": [[1, 2]], "shortcode": "WCF"}, "lbcf": {"layout": "paragraphs_json", "files": "lbcf.json", "proofs": "lbcf.md"},
        "wsc": {"layout": "catechism", "files": "wsc.xml"}, "belgic": {"layout": "articles_html", "files": "belgic.json", "articles": 2}, "heidelberg": {"layout": "questions_by_day", "files": "heidelberg.xml", "days": 52},
        "dort": {"layout": "heads_of_doctrine", "files": "dort.xml", "heads": {"First": "1"}},
    },
    "commentaries": {"henry": {"layout": "anchored", "files": "henry.xml"}, "treasury": {"layout": "scans", "files": "tod*.txt", "book": "PSA", "ranges": {"tod1.txt": [1, 4]}}},
    "lexicons": {"greek": {"layout": "greek_xml", "files": "greek.xml"}, "hebrew": {"layout": "hebrew_xml", "files": "hebrew.xml"}, "bdb": {"layout": "linked_xml", "files": "bdb.xml", "index": "index.xml"}, "brief": {"layout": "brief_tsv", "files": "brief.txt"}, "script": {"layout": "script", "files": "script.js", "language": "hebrew"}},
    "tagged": {"oshb": {"layout": "tagged_xml", "files": "oshb.xml"}, "tagnt": {"layout": "tagged_tsv", "files": "tagnt.txt"}},
    "edges": {"tsk": {"files": "edges.txt"}},
}
SOURCES = {
    "kjv-mat.usfm": "\\id MAT\n\\c 18\n\\v 10 Ten.\n\\v 11 Eleven.\n\\v 12\n\\v 13 Thirteen.\n",
    "bsb-mat.usfm": "\\id MAT\n\\c 18\n\\v 10 Ten. \\f + \\fr 18:10 \\ft Some have \\fqa \\fv 11\\fv*For he came\\ft .\\f*\n\\v 13 Thirteen.\n\\v 14\n",
    "wcf.json": samples.WCF, "pca.xml": samples.AMENDED, "lbcf.json": samples.LBCF, "lbcf.md": samples.PROOFS, "wsc.xml": samples.WSC, "belgic.json": samples.BELGIC, "heidelberg.xml": samples.HEIDELBERG, "dort.xml": samples.DORT,
    "henry.xml": samples.THML, "tod1.txt": samples.SCAN, "greek.xml": samples.GREEK, "hebrew.xml": samples.HEBREW, "bdb.xml": samples.BDB, "index.xml": samples.INDEX, "brief.txt": samples.BRIEF, "script.js": samples.SCRIPT,
    "oshb.xml": samples.OSHB, "tagnt.txt": samples.TAGNT, "edges.txt": samples.EDGES,
}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("library")
    for name, body in SOURCES.items():
        (base / name).write_text(body, encoding="utf-8")
    (base / "library.json").write_text(json.dumps(LIBRARY), encoding="utf-8")
    uri = f"file://{base}"
    done = cli.run(spark, "build", [f"{uri}/library.json", uri, f"{uri}/tables"])
    return uri, done


def rows(spark, uri, name, *columns):
    return sorted(map(tuple, spark.read.parquet(f"{uri}/{name}.parquet").select(*columns).collect()), key=str)


def test_every_resource_is_built(built):
    assert set(built[1]) == {"translations", "confessions", "commentaries", "lexicons", "tagged", "edges"}
    assert all(min(n for k, n in counts.items() if k != "flags") > 0 for counts in built[1].values())


def test_disputed_verses_have_rows(spark, built):
    got = rows(spark, f"{built[0]}/tables", "verse", "translation", "verse_start", "text", "omitted", "source_note")
    assert got == [
        ("bsb", 10, "Ten.", False, None), ("bsb", 11, "", True, "For he came"), ("bsb", 12, "", True, None), ("bsb", 13, "Thirteen.", False, None), ("bsb", 14, "", False, None),
        ("kjv", 10, "Ten.", False, None), ("kjv", 11, "Eleven.", False, None), ("kjv", 12, "", True, None), ("kjv", 13, "Thirteen.", False, None),
    ]


def test_sections_are_numbered_by_document(spark, built):
    got = rows(spark, f"{built[0]}/tables", "section", "document", "ord", "key")
    assert [x for x in got if x[0] == "wcf"] == [("wcf", 0, "1.1"), ("wcf", 1, "1.2"), ("wcf", 2, "12.1")]
    assert {x[0] for x in got} == set(LIBRARY["confessions"])


def test_comments_words_and_entries(spark, built):
    tables = f"{built[0]}/tables"
    assert {x[0] for x in rows(spark, tables, "comments", "commentator")} == {"henry", "treasury"}
    assert {x[0] for x in rows(spark, tables, "word", "source_id")} == {"oshb", "tagnt"}
    assert {x[0] for x in rows(spark, tables, "entry", "source_id")} == set(LIBRARY["lexicons"])
    names = {x[:2]: x[2] for x in rows(spark, tables, "provenance", "resource", "id", "name")}
    assert names["translations", "kjv"] == "One" and len(names) == 18


def test_unknown_layouts_are_errors(spark, built):
    for build in (pipeline.sections_of, pipeline.entries_of):
        with pytest.raises(ValueError):
            build(spark, "x", {"layout": "none", "files": f"{built[0]}/wcf.json"}, str)


@pytest.mark.parametrize("resource", ["", *[f"-{r}" for r in cli.RESOURCES]])
def test_reports(spark, built, resource):
    report = cli.run(spark, f"validate{resource}", [f"{built[0]}/tables"])
    assert "totals" in report
    if resource == "-bibles":
        assert "verse: translations" in report and "section" not in report and "error_total=1" in report


def test_index_and_packs(spark, built):
    uri, _ = built
    assert cli.run(spark, "chunk", [f"{uri}/tables", f"{uri}/chunks"])["chunk"] > 10
    meta = cli.run(spark, "build-embeddings", [f"{uri}/chunks", f"{uri}/index"])
    again = cli.run(spark, "build-embeddings", [f"{uri}/chunks", f"{uri}/index2", f"{uri}/index", meta["revision"]])
    assert again["n_reused"] == meta["n_encoded"] and again["n_encoded"] == 0
    report = cli.run(spark, "validate-embeddings", [f"{uri}/chunks", f"{uri}/index"])
    assert "max_abs_diff=0.0" in report and "n_without_vector=0" in report
    sizes = cli.run(spark, "package", [f"{uri}/tables", f"{uri}/packs", "bsb", "wsc", f"{uri}/chunks", f"{uri}/index"])
    manifest = json.loads(files.whole_texts(spark, f"{uri}/packs/manifest.json").first()["text"])
    packs = {f["path"].split(".parquet")[0] for f in manifest["files"]}
    assert {f"bundled/{n}" for n in ("verse", "section", "search/chunk", "search/vector", "search/bm25_stats")} <= packs
    assert {f"on_demand/{n}" for n in ("verse", "section", "comments", "entry", "word", "crossref", "search/chunk", "search/vector")} <= packs
    assert sizes["total_bytes"] == sum(f["bytes"] for f in manifest["files"]) and not sizes["bundled"]["over_limit"]
    scope = {tuple(r) for r in spark.read.parquet(f"{uri}/packs/bundled/search/chunk.parquet").select("resource_type", "source").distinct().collect()}
    assert scope == {("scripture", "bsb"), ("confession", "wsc")}
    code = [x[0] for x in rows(spark, f"{uri}/chunks", "chunk", "anchor") if x[0].startswith("WCF ")]
    assert code == ["WCF 1.1", "WCF 1.2", "WCF 12.1"]


def test_commands_that_are_none(spark):
    assert cli.run(spark, "build-nothing", ["a", "b", "c"]) is None and cli.run(spark, "nothing", []) is None and cli.main([]) == 1


def test_snapshot_fetches_once(tmp_path, spark):
    library = {"edges": {"tsk": {"files": "edges.txt", "url": "x"}}}
    (tmp_path / "library.json").write_text(json.dumps(library))
    (tmp_path / "edges.txt").write_text("here")
    got = json.loads(cli.run(spark, "snapshot", [str(tmp_path / "library.json"), str(tmp_path)]))
    assert got["edges/tsk"]["bytes"] == 4 and (tmp_path / "manifest.json").exists()


def test_model_provenance(spark, tmp_path):
    import hashlib

    (tmp_path / "model").mkdir()
    for name in ("a.bin", "b.json"):
        (tmp_path / "model" / name).write_text(name)
    got = files.model_provenance(spark, str(tmp_path / "model"), "m", "r1").first()
    want = "\n".join(f"{n}:{hashlib.sha256(n.encode()).hexdigest()}" for n in ("a.bin", "b.json"))
    assert tuple(got) == ("m", "r1", 2, 11, hashlib.sha256(want.encode()).hexdigest())


def test_query_instruction():
    class Model(incremental.HashingEncoder):
        query_instruction = "find: "

    assert incremental.query_vector(Model(), "mercy") == [float(x) for x in Model().encode(["find: mercy"])[0]]
    assert incremental.query_vector(incremental.HashingEncoder(), "mercy") == [float(x) for x in Model().encode(["mercy"])[0]]


def test_malformed(spark):
    books = spark.createDataFrame([("GEN",)], "book string")
    df = spark.createDataFrame([("GEN", 1, 1), ("GEN", 0, 1), ("GEN", 99, 1), ("XXX", 1, 1), (None, 1, 1), ("GEN", 1, None)], "b string, c int, v int")
    assert membership.malformed(df, books, "b", "c", df["v"]).count() == 4


def test_entries_are_classified(spark):
    schema = "lexicon string, language string, strongs string, raw_key string, definition string, derivation string, kjv_def string, not_used boolean"
    entries = [
        ("strongs", "greek", "G1", None, "d", None, None, False), ("strongs", "greek", "G1", None, "e", None, None, False), ("strongs", "greek", "G2", None, None, "x", None, False), ("strongs", "greek", "G3", None, "", "", None, False),
        ("strongs", "greek", "G4", None, None, None, None, True), ("bdb", "hebrew", "", "a", None, None, None, False), ("bdb", "hebrew", "H1", "b", "x" * 4001, None, None, False),
    ]
    got = {r.lexicon: r.asDict() for r in validation.lexicon_statistics(spark.createDataFrame(entries, schema)).collect()}
    assert got["strongs"] | {"n_entries": 5, "n_linked": 5, "n_keys": 4, "n_duplicates": 1, "n_not_used": 1, "n_defined": 2, "n_long": 0, "n_meaning_elsewhere": 1, "n_no_meaning": 1, "n_stubs": 0} == got["strongs"]
    assert got["bdb"] | {"n_entries": 2, "n_linked": 1, "n_stubs": 1, "n_long": 1} == got["bdb"]


def test_shared_folder(spark, tmp_path):
    class Context:
        master = "spark://x:7077"

        @staticmethod
        def getConf():
            return {}

    class Session:
        conf = {}
        sparkContext = Context

    with pytest.raises(ValueError):
        shared.base_dir(Session)
    frame, path = shared.written(spark.range(3), "x")
    assert frame.count() == 3 and shared.exists(spark, path) and shared.exists(spark, f"{path}/*.parquet")
    shared.release(spark, path)
    assert not shared.exists(spark, path)
