"""Ordered computations as DataFrame -> DataFrame functions, keys and orders as parameters.

Orders must be total for the results to be defined: callers end them with a unique column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspan import shared


def running_rank(df: DataFrame, keys: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """1-based position within the key."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_seen(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of every key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def keep_longest(df: DataFrame, keys: list[str], text: str, order: list[Column]) -> DataFrame:
    """The row with the longest text of every key, the first of equals."""
    return first_seen(df, keys, [F.length(text).desc(), *order])


def occurrence_suffix(df: DataFrame, key: str, order: list[Column], out: str) -> DataFrame:
    """Repeated keys told apart: the n-th occurrence, from the second on, gets ``~n``."""
    ranked = running_rank(df, [key], order, "_n")
    return ranked.withColumn(out, F.when(F.col("_n") > 1, F.concat(F.col(key), F.lit("~"), F.col("_n").cast("string"))).otherwise(F.col(key))).drop("_n")


def pericopes(df: DataFrame, keys: list[str], order: list[Column], size: int = 10, least: int = 4, out: str = "window") -> DataFrame:
    """Windows of ``size`` rows; fewer than ``least`` left over join the last one. Never across keys."""
    by = Window.partitionBy(*keys)
    n, rn = F.count("*").over(by), F.row_number().over(by.orderBy(*order))
    full, rest = F.floor(n / size), n % size
    windows = F.when(n < size, 1).when(rest < least, full).otherwise(full + 1)
    at = F.least(F.floor((rn - 1) / size), windows - 1)
    return df.withColumns({out: at.cast("int"), "_rn": rn})


def rolled_up(df: DataFrame, keys: list[str], start: str, end: str, text: str, window: str = "window") -> DataFrame:
    """Windows of ``pericopes`` as one row each: first start, last end, the texts that are not empty joined."""
    parts = F.array_sort(F.collect_list(F.when(F.coalesce(F.col(text), F.lit("")) != "", F.struct("_rn", F.col(text).alias("t")))))
    return df.groupBy(*keys, window).agg(
        F.min_by(start, "_rn").alias(start), F.max_by(end, "_rn").alias(end), F.count("*").alias("n_rows"), F.array_join(F.transform(parts, lambda x: x["t"]), " ").alias(text)
    )


def gaps(df: DataFrame, keys: list[str], start: str, end: str | None = None, upto: DataFrame | None = None) -> DataFrame:
    """(keys, gap_start, gap_end): the runs of numbers from 1 that no number, or span from ``start`` to ``end``, covers.

    They reach to the greatest number covered, or to ``upto`` (keys, expected), whose keys may have no rows at all. No span is spread out.
    """
    spans = df.select(*keys, F.col(start).alias("_s"), F.col(end or start).alias("_e")).filter((F.col("_e") >= F.col("_s")) & (F.col("_e") >= 1)).distinct()
    if upto is not None:
        beyond = upto.filter("expected >= 1").select(*keys, (F.col("expected") + 1).cast(spans.schema["_s"].dataType).alias("_s"), (F.col("expected") + 1).cast(spans.schema["_e"].dataType).alias("_e"))
        spans = spans.join(beyond.select(*keys, F.col("_s").alias("_stop")), keys, "left").filter(F.col("_stop").isNull() | (F.col("_s") < F.col("_stop"))).drop("_stop").unionByName(beyond)
    by = Window.partitionBy(*keys).orderBy("_s", "_e")
    before = F.greatest(F.coalesce(F.max("_e").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.lit(0))
    return spans.withColumn("_before", before).filter(F.col("_s") > F.col("_before") + 1).select(*keys, (F.col("_before") + 1).alias("gap_start"), (F.col("_s") - 1).alias("gap_end"))


def missing_numbers(df: DataFrame, keys: list[str], number: str, expected: DataFrame | None = None) -> DataFrame:
    """(keys, missing): numbers from 1 to the expected count, or to the greatest seen, that are absent. Only what is missing is spread out."""
    runs = gaps(df.filter(F.col(number).isNotNull()), keys, number, upto=expected)
    return runs.select(*keys, F.explode(F.sequence(F.col("gap_start").cast("int"), F.col("gap_end").cast("int"))).alias("missing"))


def repaired_sequence(df: DataFrame, keys: list[str], marker: str, order: list[Column], out: str = "number") -> DataFrame:
    """Markers that must count up by one from the first: the right number, and whether the marker differs."""
    by = Window.partitionBy(*keys).orderBy(*order)
    number = F.first(marker).over(by.rowsBetween(Window.unboundedPreceding, 0)) + F.row_number().over(by) - 1
    return df.withColumns({out: number, "repaired": ~F.col(marker).eqNullSafe(number)})


def carried_forward(df: DataFrame, keys: list[str], value: str | Column, order: list[Column], out: str) -> DataFrame:
    """The last value that is not null so far. For keys of moderate size, such as a file's; see ``spread_forward``."""
    value = F.col(value) if isinstance(value, str) else value
    return df.withColumn(out, F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def anchored(df: DataFrame, keys: list[str], value: Column, order: list[Column], out: str) -> DataFrame:
    """As ``carried_forward``; rows before the first value take the next one."""
    by = Window.partitionBy(*keys).orderBy(*order)
    before = F.last(value, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(value, ignorenulls=True).over(by.rowsBetween(0, Window.unboundedFollowing))
    return df.withColumn(out, F.coalesce(before, after))


def _blocks(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``df`` with _block: rows are range-partitioned by keys and order, so a key that holds a third of all rows lies in many blocks, in their order. Written out, so blocks stay what they are."""
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return shared.materialize(df.repartitionByRange(parts, *keys, *order).withColumn("_block", F.spark_partition_id()), "blocks")


def _with_block_values(rows: DataFrame, keys: list[str], values: DataFrame) -> DataFrame:
    """``rows`` joined with ``values``, of which there is one row for a key and block."""
    renamed = values.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in values.columns if c not in keys and c != "_block"], F.col("_block").alias("_b"))
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_block") == F.col("_b")]
    return rows.join(renamed, on).drop(*[f"_k_{k}" for k in keys], "_b", "_block")


def spread_rank(df: DataFrame, keys: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    """As ``running_rank``, with no key in one task: ranks within blocks, shifted by the rows of the key's blocks before."""
    rows = _blocks(df, keys, order)
    counts = rows.groupBy(*keys, "_block").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_block").orderBy(*order)))
    return _with_block_values(ranked, keys, counts.withColumn("_before", before).drop("_n")).withColumn(out, F.col("_r") + F.col("_before")).drop("_r", "_before")


def spread_forward(df: DataFrame, keys: list[str], value: str | Column, order: list[Column], out: str, anchor: str | None = None) -> DataFrame:
    """As ``carried_forward``, and as ``anchored`` in the column ``anchor``, with no key in one task: within blocks, then what the key's other blocks end and begin with."""
    value = F.col(value) if isinstance(value, str) else value
    rows = _blocks(df.withColumn("_v", value), keys, order)
    by = Window.partitionBy(*keys, "_block").orderBy(*order)
    filled = rows.withColumn("_last", F.last("_v", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    place = filled.withColumn("_i", F.row_number().over(by)).filter(F.col("_v").isNotNull())
    ends = rows.select(*keys, "_block").distinct().join(
        place.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_block").alias("_b")).agg(F.min_by("_v", "_i").alias("_first_v"), F.max_by("_v", "_i").alias("_last_v")),
        [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_block") == F.col("_b")], "left",
    ).drop(*[f"_k_{k}" for k in keys], "_b")
    of_key = Window.partitionBy(*keys).orderBy("_block")
    carried = F.last("_last_v", ignorenulls=True).over(of_key.rowsBetween(Window.unboundedPreceding, -1))
    earliest = F.first("_first_v", ignorenulls=True).over(of_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = ends.withColumns({"_carried": carried, "_earliest": earliest}).drop("_first_v", "_last_v")
    both = _with_block_values(filled, keys, ends).withColumn(out, F.coalesce("_last", "_carried"))
    if anchor:
        both = both.withColumn(anchor, F.coalesce(F.col(out), F.col("_earliest")))
    return both.drop("_v", "_last", "_carried", "_earliest")


def segments(df: DataFrame, keys: list[str], position: str, end: Column, order: list[Column], out: str = "segment_end") -> DataFrame:
    """Each row's segment ends where the next begins, the last at ``end``."""
    return df.withColumn(out, F.coalesce(F.lead(position).over(Window.partitionBy(*keys).orderBy(*order)), end))


def dense_ids(df: DataFrame, order: list[str], out: str = "idx") -> DataFrame:
    """0-based dense numbers in the given order without a single-task sort.

    Rows are range-partitioned and sorted, numbered within their partition, and shifted by the rows of
    the partitions before, of which there is one count each. The numbered rows are written out first, so the partitions stay what they were.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    within = placed.withColumn("_m", F.monotonically_increasing_id())
    within = within.withColumns({"_p": F.shiftright("_m", 33), "_i": F.col("_m").bitwiseAND((1 << 33) - 1)}).drop("_m")
    within = shared.materialize(within, "dense")
    counts = within.groupBy("_p").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_p", before.alias("_before"))  # one row a partition
    return within.join(F.broadcast(offsets), "_p").withColumn(out, F.col("_before") + F.col("_i")).drop("_p", "_i", "_before")


def strided_sample(df: DataFrame, order: list[str], target: int = 400) -> DataFrame:
    """Every max(1, n // target)-th row in order, ``target`` at most."""
    numbered = dense_ids(df, order, "_at")
    n = df.agg(F.count("*").alias("_count"))
    stride = F.greatest(F.lit(1), F.floor(F.col("_count") / target))
    return numbered.join(F.broadcast(n), (F.col("_at") % stride == 0) & (F.col("_at") / stride < target)).drop("_at", "_count")


def even_sample(df: DataFrame, order: list[str], points: int = 12, forced: Column | None = None) -> DataFrame:
    """Rows at (i * n) // points, and those forced."""
    numbered = dense_ids(df, order, "_at")
    n = df.agg(F.count("*").alias("_count"))
    picks = n.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.floor(i * F.col("_count") / points))).alias("_pick")).distinct()
    marked = numbered.join(F.broadcast(picks), F.col("_at") == F.col("_pick"), "left")
    keep = F.col("_pick").isNotNull() if forced is None else F.col("_pick").isNotNull() | forced
    return marked.filter(keep).drop("_at", "_pick")


def at_shares(df: DataFrame, value: str, shares: dict[str, float]) -> DataFrame:
    """One row: the value at index floor(n * share) of the sorted values for each named share (the last at most); no interpolation.

    The values are numbered by ``dense_ids``, so no task holds them all.
    """
    numbered = dense_ids(df.filter(F.col(value).isNotNull()).select(value), [value], "_at")
    n = numbered.agg(F.count("*").alias("_count"))
    both = numbered.join(F.broadcast(n))
    picks = [F.max(F.when(F.col("_at") == F.least(F.floor(F.col("_count") * share), F.col("_count") - 1), F.col(value))).alias(name) for name, share in shares.items()]
    return both.agg(*picks)
