"""Similar vectors: exact with factor one, a stated recall beyond, and every odd row."""

import numpy as np
import pytest

from quillspan.llm import queries, vptree


def brute(rows, k=5):
    usable = {}
    for i, v in rows:
        if v is not None and len(v) == 64 and None not in v and np.isfinite(v).all() and any(v):
            usable[i] = np.asarray(v, np.float32).astype(float)
    names = sorted(usable)
    m = np.stack([usable[n] for n in names])
    m = (m / np.linalg.norm(m, axis=1, keepdims=True)).astype(np.float32).astype(float)
    s = np.round(np.minimum(m @ m.T, 1), 9)
    np.fill_diagonal(s, -9)
    return {n: [names[j] for j in sorted(range(len(names)), key=lambda j: (-s[i, j], names[j]))[:k] if j != i] for i, n in enumerate(names)}


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id string, vector array<float>")
    got = {}
    for r in vptree.similar(df, "id", "vector", **kw).orderBy("id", "place").collect():
        got.setdefault(r.id, []).append(r.neighbour)
    return got


def clustered(n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, 64))
    return [(f"v{i:05d}", [float(np.float32(x)) for x in rng.normal(size=64) * 0.7 + centres[i % 40]]) for i in range(n)]


def test_factor_one_is_exact(spark):
    rows = clustered(700)
    assert found(spark, rows, relax=1.0) == brute(rows)


def test_recall(spark):
    rows = clustered(3000)
    got, want = found(spark, rows), brute(rows)
    assert np.mean([len(set(got[n]) & set(want[n])) / 5 for n in want]) >= 0.95


def test_odd_rows(spark):
    one = [1.0] + [0.0] * 63
    rows = [("a", one), ("b", [x * 20 for x in one]), ("c", None), ("d", [0.0] * 64), ("e", [1.0] * 32), ("f", [None, *one[1:]]), ("g", [float("nan"), *one[1:]]), ("h", [float("inf"), *one[1:]]), (None, one), ("a", one), ("i", [-x for x in one])]
    assert found(spark, rows) == {"a": ["b", "i"], "b": ["a", "i"], "i": ["a", "b"]}


def test_empty_and_lonely(spark):
    assert found(spark, []) == {} and found(spark, [("a", [1.0] * 64)]) == {} and found(spark, [("c", None), ("d", [0.0] * 64)]) == {}


def test_a_third_are_copies(spark):
    rows = clustered(300) + [(f"h{i:04d}", [0.5] * 64) for i in range(400)] + [("h0001", [0.5] * 64)] * 50
    got, want = found(spark, rows, relax=1.0), brute(dict(rows).items())
    assert got == want


def test_small_shards_and_nodes(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 60)
    monkeypatch.setattr(vptree, "NODE_ROWS", 30)
    monkeypatch.setattr(vptree, "SAMPLE", 200)
    rows = clustered(600, 5) + [(f"n{i:03d}", [float(x) for x in np.float32([1.0] * 63 + [1 + i / 9])]) for i in range(150)]
    assert found(spark, rows, relax=1.0) == brute(rows)


def test_clashing_columns(spark):
    df = spark.createDataFrame([("a", [1.0] * 64, 1, 2), ("b", [1.0] * 63 + [2.0], 1, 2)], "chunk_id string, vector array<float>, id int, node int")
    assert vptree.similar(df, "chunk_id", "vector").columns == ["chunk_id", "place", "neighbour", "similarity"]
    assert vptree.similar(df, "chunk_id", "vector").count() == 2


def test_pairs_of_the_test_table(spark, data):
    rows = [(r.chunk_id, r.vector) for r in spark.read.parquet(f"{data}/embedding.parquet").collect()]
    want = brute(dict(rows).items())
    m = {i: np.asarray(v, float) / np.linalg.norm(v) for i, v in rows if i in want}
    pairs = {tuple(sorted((a, b))) for a, near in want.items() for b in near if round(float(m[a] @ m[b]), 6) >= 0.9}
    assert {tuple(r) for r in queries.p2_found(spark, data).collect()} == pairs


@pytest.mark.parametrize("n", [0, 1, 7])
def test_fit_keeps_the_count(n):
    assert len(vptree.fit_vantage_points(np.eye(8, dtype=np.float32), n + 1)) == n + 1


@pytest.mark.parametrize("shard_rows", [8192, 50])
def test_many_scaled_copies_order_by_id(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(vptree, "SHARD_ROWS", shard_rows)
    rng = np.random.default_rng(3)
    hot = rng.normal(size=64)
    scaled = [[float(x) for x in np.float32(hot * f)] for f in rng.uniform(0.1, 9, 150)]
    names = [f"h{i:04d}" for i in rng.permutation(190)]
    rows = clustered(300) + list(zip(names, scaled + [scaled[0]] * 40))  # some of them exact copies as well
    got = found(spark, rows, relax=1.0)
    first = sorted(names)
    assert {n: got[n] for n in names} == {n: [x for x in first[:6] if x != n][:5] for n in names}


def with_near_copies(n, seed=4):
    """Clustered vectors, and near copies of a fifth of them, of six to a group at times."""
    rng = np.random.default_rng(seed)
    rows = clustered(n, seed)
    for i in range(0, n, 5):
        for j in range(1 + 6 * (i % 50 == 0)):
            rows.append((f"w{i:05d}-{j}", [float(x) for x in np.float32(np.asarray(rows[i][1]) + rng.normal(size=64) * rng.uniform(0.05, 0.6))]))
    return rows


def pairs_from(rows, least, k=5):
    m = {i: np.asarray(v, float) / np.linalg.norm(v) for i, v in rows}
    return {(a, b) for a, near in brute(rows, k).items() for b in near if round(float(m[a] @ m[b]), 9) >= least}


@pytest.mark.parametrize("relax", [1.0, vptree.RELAX_LEAST])
def test_least_similarity_is_the_filter_of_all(spark, monkeypatch, relax):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 300)
    monkeypatch.setattr(vptree, "NODE_ROWS", 40)
    rows = with_near_copies(700) + [("one", [1.0] * 64), ("one as long", [2.0] * 64)]
    want = pairs_from(rows, 0.9)
    got = vptree.similar(spark.createDataFrame(rows, "id string, vector array<float>"), "id", "vector", relax=relax, least=0.9).collect()
    assert len(want) > 300 and {(r.id, r.neighbour) for r in got} == want and all(r.similarity >= 0.9 for r in got)


def test_least_similarity_compares_few_pairs(spark):
    rng = np.random.default_rng(6)  # no clusters, so that little can be pruned for the k best
    rows = [(f"v{i:05d}", [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(8000, 64)).astype(np.float32))]
    df = spark.createDataFrame(rows, "id string, vector array<float>")
    trees = vptree.build(df, 5, 64)
    every, few = (sum(vptree.search_shard(s, trees, 5, *how)[2] for s in range(len(trees.files))) for how in ((vptree.RELAX, 64), (vptree.RELAX_LEAST, 64, vptree.NEAR, 0.9)))
    assert few < every * 0.6  # 0.48 with the 20 roots of so few vectors


def test_shards_grow_with_the_vectors(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD_ROWS", 20)
    monkeypatch.setattr(vptree, "NODE_ROWS", 10)
    monkeypatch.setattr(vptree, "SHARDS", 4)
    rows = clustered(900, 9)
    trees = vptree.build(spark.createDataFrame(rows, "id string, vector array<float>"), 5, 64)
    assert len(trees.files) <= 8
    assert found(spark, rows, relax=1.0) == brute(rows)


def test_forest_finds_all_in_few_pairs(spark, monkeypatch):
    monkeypatch.setattr(vptree, "SHARDS", 1)
    monkeypatch.setattr(vptree, "SHARD_ROWS", 700)
    monkeypatch.setattr(vptree, "MOST_SHARD_ROWS", 700)
    monkeypatch.setattr(vptree, "GROUP_ROWS", 2000)
    rows = with_near_copies(2000, 8)
    df = spark.createDataFrame(rows, "id string, vector array<float>")
    trees = vptree.build(df, 5, 64, 0.9)
    sifted = sum(vptree.search_shard(s, trees, 5, vptree.RELAX_LEAST, 64, least=0.9)[2] for s in range(len(trees.files)))
    assert len(trees.forest.groups) > 1 and sifted < len(rows) ** 2 * 0.2  # 0.15 in a forest for so few vectors
    near = vptree.similar(df, "id", "vector", relax=vptree.RELAX_LEAST, least=0.9).collect()
    assert {(r.id, r.neighbour) for r in near} == pairs_from(rows, 0.9)


def test_forest_grows_less_than_its_vectors(spark):
    rng = np.random.default_rng(6)
    units = rng.normal(size=(32000, 64)).astype(np.float32)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    share = []
    for n in (2000, 32000):
        forest = vptree.fit_forest(units[:n], n, 0.9)
        cells = forest.cell(units[:n], range(forest.count))
        share.append(sum(float((np.bincount(c).astype(float) ** 2).sum()) for c in cells) / n**2)
    assert share[1] < share[0] / 3  # 0.019 and 0.116


def test_no_forest_where_too_many_trees_are_needed():
    units = np.random.default_rng(6).normal(size=(2000, 64)).astype(np.float32)
    assert vptree.fit_forest(units / np.linalg.norm(units, axis=1, keepdims=True), 1_000_000, 0.3) is None
