"""The best of every group: against SQL, brute force, and the row groups skipped."""

import random

import pytest
from pyspark.sql import functions as F

from quillspan import shared
from quillspan.llm import queries, top_n

SCHEMA = "g string, h int, item long, score int, tie int, at timestamp"


@pytest.mark.parametrize("name", ["p1_found", "p1_ranked"])
def test_query_equals_its_sql(name, same_rows):
    same_rows(queries.QUERIES[name], queries.SQL[name])


def best(rows, n=3):
    last = {}
    for r in set(rows):
        key = r[2]
        rank = lambda x: (str(x[5] or ""), x[3] if x[3] is not None else -(2**40), -(x[4] if x[4] is not None else 2**40), [-ord(ch) for ch in str((x[0], x[1]))])
        if key not in last or rank(r) > rank(last[key]):
            last[key] = r
    groups = {}
    for r in last.values():
        if r[3] is not None:
            groups.setdefault((r[0], r[1]), []).append(r)
    return {r[2] for g in groups.values() for r in sorted(g, key=lambda r: (-r[3], r[4] is None, r[4] or 0, r[2]))[:n]}


def got(spark, rows, n=3):
    df = spark.createDataFrame(rows, SCHEMA)
    return top_n.top_n(df, [F.col("g"), F.col("h")], "item", "score", "tie", n, "at")


def test_against_brute_force(spark):
    from datetime import datetime

    rng = random.Random(4)
    rows, i = [], 0
    for _ in range(1500):
        g = rng.choice(["hot"] * 5 + ["a", "b|", "b", None, "\\"])
        i += 1
        at = datetime(2024, 1, rng.randint(1, 28))
        rows.append((g, rng.choice([1, 2, None]), i, rng.choice([None, 0, 1, 1, 1, 2, -3]), rng.choice([None, 1, 2]), at))
        if rng.random() < 0.2:
            rows.append(rows[-1])
        if rng.random() < 0.2:
            rows.append((*rows[-1][:3], rng.choice([None, 5, 1]), rows[-1][4], datetime(2025, 1, 1)))
        if rng.random() < 0.1:
            rows.append(("moved", *rows[-1][1:5], datetime(2025, 2, i % 27 + 1)))
    assert {r.item for r in got(spark, rows).select("item").collect()} == best(rows)


def test_ties_and_places(spark):
    rows = [("g", 1, i, 7, None if i % 2 else 3, None) for i in range(9)]
    assert [(r.item, r.place) for r in got(spark, rows).orderBy("place").collect()] == [(0, 1), (2, 2), (4, 3)]


def test_empty_table_and_null_scores(spark):
    assert got(spark, []).count() == 0
    assert got(spark, [("g", 1, 1, None, None, None)]).count() == 0


def test_groups_with_like_keys_stay_apart(spark):
    rows = [("a|b", None, 1, 1, 1, None), ("a", None, 2, 1, 1, None), ("a\\", None, 3, 1, 1, None), (None, None, 4, 1, 1, None), ("", None, 5, 1, 1, None)]
    assert got(spark, rows).select("grp").distinct().count() == 5


def test_clashing_columns(spark):
    df = spark.createDataFrame([("g", 1, 2, 3, 4)], "grp string, item long, score int, tie int, at int")
    assert top_n.top_n(df, [F.col("grp")], "item", "score", "tie").count() == 1


def test_an_item_counts_in_its_last_group_only(spark):
    from datetime import datetime

    rows = [("a", 1, 1, 9, 1, datetime(2024, 1, 1)), ("b", 1, 1, 1, 1, datetime(2024, 2, 1)), ("a", 1, 2, 3, 1, datetime(2024, 1, 1))]
    assert sorted((r.grp, r.item) for r in got(spark, rows).collect()) == [("a|1", 2), ("b|1", 1)]


@pytest.mark.parametrize("kind, values", [("double", [0.2, 0.9, 0.5, float("nan"), None, -1.5]), ("string", ["b", "é", "a", "c", None, ""]), ("decimal(10,2)", None), ("date", None)])
def test_types_are_kept(spark, kind, values):
    from datetime import date
    from decimal import Decimal

    values = values or ([Decimal("0.20"), Decimal("0.90"), None, Decimal("-3")] if kind.startswith("dec") else [date(2020, 1, 1), None, date(2024, 5, 5), date(1999, 1, 1)])
    rows = [(f"i{i}", "g", v, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"item string, g string, score {kind}, tie {kind}")
    want = sorted((v for v in values if v is not None and v == v), reverse=True)[:2]
    found = top_n.top_n(df, [F.col("g")], "item", "score", "tie", 2).orderBy("place").collect()
    assert [r.score for r in found] == want and all(rows[int(r.item[1:])][2] == r.score for r in found)
    assert df.schema["score"].dataType == top_n.top_n(df, [F.col("g")], "item", "score", "tie", 2).schema["score"].dataType


def test_rows_without_an_item(spark):
    from datetime import datetime

    rows = [("g", 1, None, 5, 1, datetime(2024, 1, 1)), ("g", 1, None, 4, 1, datetime(2024, 1, 2)), ("g", 1, None, 4, 1, datetime(2024, 1, 2))]
    assert [r.score for r in got(spark, rows).orderBy("place").collect()] == [5, 4]


def read(spark, rows, n=3):
    path = top_n.clustered(rows, [F.col("g")], "id", "s", "t", None)
    skipped, kept, groups = [], 0, 0
    for f, _ in shared.list_files(spark, path):
        import pyarrow.parquet as pq

        groups += pq.ParquetFile(shared.open_file(f)[1]).metadata.num_row_groups
        kept += sum(len(p) for p in top_n.top_of_file(f, n, {}, skipped))
    return len(skipped), groups, kept


def test_row_groups_are_skipped(spark):
    n = 60_000
    rows = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.concat(F.lit("g"), F.col("id").cast("string"))).otherwise("hot").alias("g"), F.col("id"), (F.col("id") % 1000).alias("s"), F.lit(1).alias("t"))
    skipped, groups, kept = read(spark, rows)
    assert skipped >= 0.4 * groups and kept < n / 2
    assert {r.item for r in top_n.top_n(rows, [F.col("g")], "id", "s", "t").filter("grp = 'hot'").collect()} == {1999, 2999, 4999}


def test_row_groups_of_many_groups_are_skipped(spark):
    """Groups of 100 rows and, between them, some of two: no row group holds one group only."""
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 20 == 0, F.concat(F.lit("s"), (F.col("id") / 40).cast("int").cast("string"))).otherwise(F.concat(F.lit("m"), (F.col("id") % 997).cast("string"))).alias("g"),
        F.col("id"), (F.xxhash64("id") % 100_000).alias("s"), F.lit(1).alias("t"),
    )
    skipped, groups, kept = read(spark, rows)
    assert skipped >= 0.5 * groups
    want = rows.groupBy("g").agg(F.slice(F.sort_array(F.collect_list(F.struct("s", F.col("id"))), False), 1, 3).alias("x")).select(F.explode("x.id"))
    assert {r[0] for r in want.collect()} == {r.item for r in top_n.top_n(rows, [F.col("g")], "id", "s", "t").collect()}
