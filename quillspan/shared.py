"""Intermediate tables in the folder all executors share.

Multi-pass operators cut their lineage with tables written here, so that a lost executor costs a
re-read and never a recomputation of everything before. The folder is the one the cluster names in
``spark.checkpoint.dir``. Only a local master may do without: there a folder of our own is taken, whereas
on a cluster each machine would write to a folder the others cannot see, so an unset name is an error.

Tables are deleted when the process ends, or as soon as an operator knows that nothing reads them again.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_own: dict[str, str] = {}
_written: dict[str, SparkSession] = {}


def base_dir(spark: SparkSession) -> str:
    named = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"{_KEY} must name a folder that all executors of {master} share")
    if "dir" not in _own:
        _own["dir"] = tempfile.mkdtemp(prefix="quillspan-")
        atexit.register(shutil.rmtree, _own["dir"], ignore_errors=True)
    return "file://" + _own["dir"]


def _located(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a folder or file."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or any that matches a pattern, is there."""
    fs, where = _located(spark, path)
    found = fs.globStatus(where)
    return found is not None and len(found) > 0


def write_text(spark: SparkSession, path: str, body: str) -> None:
    """A small file, through the session's Hadoop file system."""
    fs, where = _located(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(body.encode()))
    finally:
        out.close()


def release(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that nothing will read again."""
    for path in paths:
        _written.pop(path, None)
        fs, where = _located(spark, path)
        fs.delete(where, True)


@atexit.register
def _release_all() -> None:
    for path, spark in list(_written.items()):
        try:
            release(spark, path)
        except Exception:  # the session has ended before us
            return


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{base_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


def written(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a table in the shared folder; (the scan of it, its path)."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The scan of ``df`` written as a table in the shared folder."""
    return written(df, name, **options)[0]


def list_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> list[tuple[str, int]]:
    """(path, bytes) of the files directly in ``path``, through the session's Hadoop file system."""
    fs, where = _located(spark, path)
    return sorted(
        (s.getPath().toString(), s.getLen())
        for s in fs.listStatus(where)
        if s.getPath().getName().endswith(suffix) and s.getLen()
    )


def open_file(path: str):
    """pyarrow (filesystem, path) of a URI that ``list_files`` gave; runs on executors."""
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        return pafs.LocalFileSystem(), path[5:].replace("//", "/", 1) if path.startswith("file://") else path[5:]
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)
