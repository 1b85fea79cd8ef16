"""The N best items of every group, with files clustered by group and row groups skipped by their statistics.

1. The last delivery of every item is settled first, whatever groups its deliveries name.
2. Rows are then clustered by group into files, whose number follows the bytes. A group with more than a share
   of all rows (``HOT_SHARE``, so 1 / share groups at most) is spread over as many files as it fills.
   Within a file, groups of about the same size (a power of two of rows) lie together, their rows by
   descending score, in small row groups: a row group holds one layer of scores of many small groups, or of a large one.
3. A task per file takes the row groups in descending maximum score. Of each the group column alone is
   read first; if the row group's maximum lies strictly below the current N-th score of every group in it, the rest is
   skipped. Equal maxima are read, as the tie order may still decide. For groups spread over several files the current N-th score
   begins with what all footers together prove: a row group of one group with N or more rows and minimum m shows that
   the N-th score is m or more.
4. The tasks' partial results, at most N rows for each group and file, meet in one small window.

Scores, ties and items keep their types; any type with an order will do. Defined results: a row with a null or NaN
score takes no part; a NaN tie is a null one; a null in a group column is a value like any other; rows without an item have one
delivery each; tie columns order as given, nulls last; exact repeats of a row count once; of two deliveries with
the same time the higher score counts, then the first tie, then the first group; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspan import shared

ROW_GROUP_ROWS = 1024
#: Bytes of input for one clustered file.
FILE_BYTES = 128 << 20
#: Least share of all rows from which a group is spread over several files.
HOT_SHARE = 1e-4
#: Candidates held by a task before they are cut to the N best of each group.
_HELD = 1 << 20
_ORDER = [("grp", "ascending"), ("score", "descending"), ("tie", "ascending"), ("item", "ascending")]


def _group_key(columns: list[Column]) -> Column:
    """One string for the group; escaping keeps different groups apart."""
    parts = [F.coalesce(F.regexp_replace(c.cast("string"), r"([\\|])", r"\\$1"), F.lit("\\0")) for c in columns]
    return F.concat_ws("|", *parts)


def _within(codes: np.ndarray) -> np.ndarray:
    """How many equal codes stand before each."""
    order = np.argsort(codes, kind="stable")
    first = np.flatnonzero(np.r_[True, codes[order][1:] != codes[order][:-1]]) if len(codes) else np.zeros(0, np.int64)
    out = np.empty(len(codes), np.int64)
    out[order] = np.arange(len(codes)) - np.repeat(first, np.diff(np.r_[first, len(codes)]))
    return out


def _best(table: pa.Table, n: int) -> pa.Table:
    """The first n rows of each group."""
    table = table.combine_chunks().take(pc.sort_indices(table, sort_keys=_ORDER, null_placement="at_end"))
    codes = pc.rank(table.column("grp"), tiebreaker="min").to_numpy()
    return table.filter(pa.array(_within(codes) < n))


class _Groups:
    """The N best scores seen of every group of a file."""

    def __init__(self, n: int, floor: dict[str, object], kind: pa.DataType) -> None:
        self.n, self.code, self.floor = n, {}, floor
        self.dtype = np.int64 if pa.types.is_integer(kind) else np.float64 if pa.types.is_floating(kind) else object
        self.none = {np.int64: np.iinfo(np.int64).min, np.float64: -np.inf}.get(self.dtype)
        self.have = np.zeros(1024, np.int64)
        self.best = np.full((1024, n), self.none, self.dtype)  # in descending order
        self.full, self.nth = np.zeros(1024, bool), np.full(1024, self.none, self.dtype)

    def codes(self, names: list[str]) -> np.ndarray:
        out = np.empty(len(names), np.int64)
        for i, name in enumerate(names):
            at = self.code.get(name)
            if at is None:
                at = self.code[name] = len(self.code)
                if at == len(self.have):
                    self.have, self.full = np.r_[self.have, np.zeros(at, np.int64)], np.r_[self.full, np.zeros(at, bool)]
                    self.best = np.concatenate([self.best, np.full((at, self.n), self.none, self.dtype)])
                    self.nth = np.r_[self.nth, np.full(at, self.none, self.dtype)]
                if name in self.floor:
                    self.full[at], self.nth[at] = True, self.floor[name]
            out[i] = at
        return out

    def above(self, codes: np.ndarray, top: object) -> bool:
        """Whether the N-th score of all these groups lies strictly above ``top``."""
        return bool(self.full[codes].all()) and bool((self.nth[codes] > top).all())

    def _merge(self, of: np.ndarray, values: np.ndarray) -> None:
        groups, row = np.unique(of, return_inverse=True)
        if self.dtype is object:
            lists = [[x for x in self.best[g] if x is not None] for g in groups]
            for r, v in zip(row, values):
                lists[r].append(v)
            for g, found in zip(groups, lists):
                found = sorted(found, reverse=True)[: self.n]
                self.best[g, : len(found)] = found
        else:
            order = np.lexsort((-values if self.dtype is np.float64 else ~values, row))
            row, values = row[order], values[order]
            place = _within(row)
            first = place < self.n
            both = np.full((len(groups), 2 * self.n), self.none, self.dtype)
            both[:, : self.n] = self.best[groups]
            both[row[first], self.n + place[first]] = values[first]
            self.best[groups] = np.sort(both, 1)[:, : self.n - 1 : -1]
        np.add.at(self.have, of, 1)
        done = groups[self.have[groups] >= self.n]
        last = self.best[done, self.n - 1]
        higher = ~self.full[done]
        higher[~higher] = last[~higher] > self.nth[done[~higher]]
        self.full[done[higher]], self.nth[done[higher]] = True, last[higher]

    def candidates(self, of: np.ndarray, scores: pa.Array) -> np.ndarray:
        """Which rows may be among the N best of their groups."""
        values = scores.to_numpy(zero_copy_only=False).astype(self.dtype) if self.dtype is not object else np.array([*scores.to_pylist(), None], object)[:-1]
        self._merge(of, values)
        keep = ~self.full[of]
        full = np.flatnonzero(~keep)
        keep[full] = values[full] >= self.nth[of[full]]
        return keep


def _footer(meta) -> list[tuple[int, str | None, object, object, int]]:
    """(row group, its group if it has one only, least and greatest score, rows)."""
    where = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
    out = []
    for i in range(meta.num_row_groups):
        g, s = (meta.row_group(i).column(where[c]).statistics for c in ("grp", "score"))
        low, top = (s.min, s.max) if s is not None and s.has_min_max else (None, None)
        out.append((i, g.min if g is not None and g.has_min_max and g.min == g.max else None, low, top, meta.row_group(i).num_rows))
    return out


def top_of_file(path: str, n: int, floor: dict[str, object], skipped: list[int] | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of one clustered file that hold the n best of each of its groups."""
    import pyarrow.parquet as pq

    fs, name = shared.open_file(path)
    held: list[pa.Table] = []
    size = 0
    with fs.open_input_file(name) as f:
        file = pq.ParquetFile(f, read_dictionary=["grp"])
        groups = _Groups(n, floor, file.schema_arrow.field("score").type)
        tops = [(i, top) for i, _, _, top, _ in _footer(file.metadata)]
        tops = [x for x in tops if x[1] is None] + sorted((x for x in tops if x[1] is not None), key=lambda x: x[1], reverse=True)
        for i, top in tops:
            names = file.read_row_group(i, columns=["grp"]).column("grp").combine_chunks()
            names = names.chunk(0) if isinstance(names, pa.ChunkedArray) else names
            of = groups.codes(names.dictionary.to_pylist())[names.indices.to_numpy()]
            if top is not None and groups.above(of, top):
                if skipped is not None:
                    skipped.append(i)
                continue
            rest = file.read_row_group(i, columns=["item", "score", "tie"]).combine_chunks()
            keep = groups.candidates(of, rest.column("score").combine_chunks())
            held.append(pa.table({"grp": names.cast(pa.string()), **{c: rest.column(c) for c in ("item", "score", "tie")}}).filter(pa.array(keep)))
            size += len(held[-1])
            if size > _HELD:
                held = [_best(pa.concat_tables(held), n)]
                size = len(held[0])
    if size:
        yield from _best(pa.concat_tables(held), n).combine_chunks().to_batches()


def _proved(path: str, n: int, kind: pa.DataType) -> pa.RecordBatch:
    """(path, grp, low): what the row groups of one group alone prove of their group's N-th score."""
    import pyarrow.parquet as pq

    fs, name = shared.open_file(path)
    with fs.open_input_file(name) as f:
        rows = _footer(pq.ParquetFile(f).metadata)
    low: dict[str, object] = {}
    for _, group, least, _, count in rows:
        if group is not None and least is not None and count >= n:
            low[group] = max(low.get(group, least), least)
    return pa.RecordBatch.from_arrays([pa.array([path] * len(low), pa.string()), pa.array(list(low), pa.string()), pa.array(list(low.values()), kind)], names=["path", "grp", "low"])


def _file_count(df: DataFrame) -> int:
    """Files for the bytes that the optimizer expects, one for each core at least."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if size >= 1 << 60:  # not known
        return max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(cores, -(-size // FILE_BYTES))


def clustered(df: DataFrame, group: list[Column], item: str, score: str, tie: str, delivered: str | None) -> str:
    """Write the last delivery of every item, clustered by group, and return the table's path."""
    spark = df.sparkSession
    at = F.col(delivered) if delivered else F.lit(0)
    raw = df.select(_group_key(group).alias("grp"), F.col(item).alias("item"), F.col(score).alias("score"), F.col(tie).alias("tie"), at.alias("at"))
    for c in ("score", "tie"):
        if isinstance(raw.schema[c].dataType, (T.FloatType, T.DoubleType)):
            raw = raw.withColumn(c, F.when(~F.isnan(c), F.col(c)))
    rows = raw
    if delivered:
        order = [F.col("at").desc_nulls_last(), F.col("score").desc_nulls_last(), F.col("tie").asc_nulls_last(), F.col("grp")]
        # rows without an item are deliveries of their own
        own = F.when(F.col("item").isNull(), F.struct("grp", "score", "tie", "at"))
        rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("item", own).orderBy(*order))).filter("n = 1")
    else:
        rows = rows.distinct()
    rows = rows.filter(F.col("score").isNotNull()).select("grp", "item", "score", "tie")
    files = _file_count(raw)
    # sizes are for the layout only, so repeated deliveries may count
    total = max(1, raw.count())
    parts = F.when(F.col("rows") >= max(1, total * HOT_SHARE), F.ceil(F.col("rows") * files / total)).otherwise(1).cast("int")
    sizes = raw.groupBy("grp").agg(F.count("*").alias("rows")).withColumn("parts", parts)
    hot = sizes.filter("parts > 1").select(F.col("grp").alias("hot"), "parts")  # 1 / share rows at most
    spread = F.coalesce(F.pmod(F.xxhash64("item", "tie"), F.col("parts")), F.lit(0)).cast("int")
    rows = rows.join(F.broadcast(hot), F.col("grp") == F.col("hot"), "left").withColumn("part", spread).drop("hot", "parts")
    # joined by group and part, as the rows are placed: no group is gathered
    sizes = sizes.select(F.col("grp").alias("sized"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("sized_part"), "rows")
    rows = rows.repartition(files, "grp", "part").join(sizes, (F.col("grp") == F.col("sized")) & (F.col("part") == F.col("sized_part")), "left")
    rows = rows.sortWithinPartitions(F.floor(F.log2("rows")).desc(), F.col("score").desc(), "grp").select("grp", "item", "score", "tie")
    path = shared.new_path(spark, "clustered")
    rows.write.option("parquet.block.row.count.limit", ROW_GROUP_ROWS).option("parquet.page.size.row.check.min", "1000").parquet(path)
    return path


def top_n(df: DataFrame, group: list[Column], item: str, score: str, tie: str, n: int = 3, delivered: str | None = None) -> DataFrame:
    """(grp, item, score, tie, place): the first ``n`` of each group by score descending, tie, item."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = df.sparkSession
    path = clustered(df, group, item, score, tie, delivered)
    table = spark.read.parquet(path) if (files := [p for p, _ in shared.list_files(spark, path)]) else None
    if table is None:
        kinds = [T.StructField("grp", T.StringType()), *[T.StructField(name, df.schema[c].dataType) for name, c in (("item", item), ("score", score), ("tie", tie))]]
        return spark.createDataFrame([], T.StructType([*kinds, T.StructField("place", T.IntegerType())]))
    schema = T.StructType([table.schema[c] for c in ("grp", "item", "score", "tie")])
    arrow = to_arrow_schema(schema)
    slices = spark.createDataFrame([(p,) for p in files], "path string").repartition(len(files))

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                yield _proved(file, n, arrow.field("score").type)

    kind = schema["score"].dataType.simpleString()
    proved = slices.mapInArrow(floors, f"path string, grp string, low {kind}")
    several = proved.groupBy("grp").agg(F.max("low").alias("low"), F.count("*").alias("files")).filter("files > 1").select("grp", "low")  # groups that are spread
    per_file = proved.select("path", "grp").join(several, "grp").groupBy("path").agg(F.collect_list(F.struct("grp", "low")).alias("floor"))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for row in batch.to_pylist():
                for part in top_of_file(row["path"], n, {x["grp"]: x["low"] for x in row["floor"] or ()}):
                    yield part.cast(arrow) if part.schema != arrow else part

    part = slices.join(per_file, "path", "left").repartition(len(files)).mapInArrow(run, schema)
    order = Window.partitionBy("grp").orderBy(F.col("score").desc(), F.col("tie").asc_nulls_last(), F.col("item").asc())
    return part.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)
