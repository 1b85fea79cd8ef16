"""Command line: python -m quillspan.cli COMMAND ...

snapshot[-RESOURCE] LIBRARY SOURCES [force]   fetch the sources that a library file names, and write their manifest
build[-RESOURCE] LIBRARY SOURCES TABLES       sources -> tables; RESOURCE is bibles, confessions, commentaries, lexicons, tagged or crossrefs
validate[-RESOURCE] TABLES                    report of the tables' statistics and findings
all LIBRARY SOURCES TABLES                    snapshot, build, validate
snapshot-model FOLDER NAME REVISION           digest of a model's files
build-verses NAME=GLOB... TABLES              book files (or zips of them) of each translation -> verse table, without a library file
build-edges GLOB TABLES                       cross-reference lists -> crossref table, without a library file
chunk TABLES OUT                              resource tables -> chunks and skips
build-embeddings CHUNKS OUT [PRIOR REVISION]  chunks -> vectors and inverted index; with a prior index only what has changed is encoded
validate-embeddings CHUNKS INDEX              report of the index
package TABLES OUT TRANSLATION CONFESSION [CHUNKS INDEX]   bundled and on-demand packs with a manifest

Paths may be of any file system the session knows, except that sources are fetched to a local folder.
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import SparkSession

from quillspan import shared
from quillspan.plans import pipeline
from quillspan.session import local_session
from quillspan.sources import files
from quillspan.sources.tables import table

#: Names of commands -> parts of a library and tables.
RESOURCES = {"bibles": ("translations", "verse"), "confessions": ("confessions", "section"), "commentaries": ("commentaries", "comments"), "lexicons": ("lexicons", "entry"), "tagged": ("tagged", "word"), "crossrefs": ("edges", "crossref")}


def _library(spark: SparkSession, path: str) -> dict:
    return json.loads(files.whole_texts(spark, path).first()["text"])


def _snapshot(spark: SparkSession, library: str, folder: str, resource: str | None, force: bool) -> str:
    described = _library(spark, library)
    wanted = {}
    for name, (part, _) in RESOURCES.items():
        if resource in (None, name):
            wanted |= {f"{part}/{k}": {**v, "file": v["files"]} for k, v in described.get(part, {}).items() if "url" in v}
    return json.dumps(files.snapshot(wanted, folder, force), indent=2, sort_keys=True)


def run(spark: SparkSession, command: str, rest: list[str]) -> object | None:
    """The command's result, or None where there is no such command."""
    name, _, resource = command.partition("-")
    if resource and resource not in RESOURCES:
        name, resource = command, ""
    if name == "snapshot" and len(rest) in (2, 3):
        return _snapshot(spark, rest[0], rest[1], resource or None, rest[2:] == ["force"])
    if name == "build" and len(rest) == 3:
        return pipeline.build_library(spark, _library(spark, rest[0]), rest[1], rest[2], RESOURCES[resource][0] if resource else None)
    if name == "validate" and len(rest) == 1:
        return pipeline.validate(spark, rest[0], RESOURCES[resource][1] if resource else None)
    if name == "all" and len(rest) == 3:
        _snapshot(spark, rest[0], rest[1], None, False)
        pipeline.build_library(spark, _library(spark, rest[0]), rest[1], rest[2])
        return pipeline.validate(spark, rest[2])
    if name == "snapshot-model" and len(rest) == 3:
        return files.model_provenance(spark, *rest).first().asDict()
    if name == "build-verses" and len(rest) > 1:
        return pipeline.build_verses(spark, dict(x.split("=", 1) for x in rest[:-1]), rest[-1])
    if name == "build-edges" and len(rest) == 2:
        verse = table(spark, rest[1], "verse") if shared.exists(spark, f"{rest[1]}/verse.parquet") else None
        return pipeline.build_edges(spark, rest[0], verse, rest[1])
    if name == "chunk" and len(rest) == 2:
        return pipeline.extract(spark, *rest)
    if name in ("index", "build-embeddings") and len(rest) in (2, 4):
        return pipeline.index(spark, rest[0], rest[1], prior=rest[2] if len(rest) == 4 else None, prior_revision=rest[3] if len(rest) == 4 else "")
    if name == "validate-embeddings" and len(rest) == 2:
        return pipeline.validate_index(spark, *rest)
    if name == "package" and len(rest) in (4, 6):
        return pipeline.package(spark, *rest)
    return None


def main(args: list[str]) -> int:
    result = run(local_session(), args[0], args[1:]) if args else None
    print(__doc__ if result is None else result)
    return 1 if result is None else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
