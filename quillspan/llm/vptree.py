"""The k most similar vectors for every vector, by vantage-point trees with relaxed pruning.

1. Root vantage points are fitted on a bounded sample. Every vector belongs to the ball of its nearest one; balls lying
   together form a shard, and a ball too large for one shard is divided among several.
2. Copies are collapsed, first within each task, then in the shard: a direction is searched once and
   stands for all its ids, of which the k + 1 smallest are all that any answer can hold. So a direction
   with a third of all rows is one row; its further ids are joined to its answer afterwards.
3. In a shard a vantage-point tree grows from every root: a node parts its vectors at the median of their angles to its
   vantage point, the nearer half inside, the farther outside; each half takes its farthest vector as the next
   vantage point, down to leaves of ``LEAF_ROWS``. So the depth follows the number of vectors, whatever that of the roots.
4. A task per shard answers the shard's own vectors. It searches its own trees first, then those of
   the other shards in the order of their distance. A half is pruned if the triangle inequality puts it farther away than
   the k-th best so far divided by the factor ``relax`` (below the roots, ``RELAX_HALVES`` at most): with factor one the search is exact; larger
   factors prune more and may miss some. Leaves are compared by one matrix product each. Vectors whose
   k-th best comes within ``near`` are searched a second time with factor one, so their answers are exact if the factor
   missed none of what brought them there.
5. Where only answers of a ``least`` similarity are wanted, its angle bounds every search from the start, in one pass with one factor at all
   depths. A ball is then pruned by planes too: its vectors are nearer to its vantage point than to any other, so they lie
   beyond the plane halfway between that and the query's own, whose distance is known. With factor one that is exact as well.
6. With a larger factor such answers come from a forest instead: at each level of a tree stand orthogonal vantage points and their
   opposites, and a vector goes to the nearest, down to a cell for every ``CELL_ROWS`` vectors. Vectors so near to each other fall into one
   cell of a tree with a known chance, so there are as many trees as leave one of ``MISSED`` at the least similarity apart in all, and fewer above it. A
   query sees its own cells only, so its cost grows far less than the vectors. What a cell holds is sifted by sketches of ``BITS`` signs before vectors are read.

The shards lie in the shared folder, each with its grown trees, and are read by the tasks that need them, so vectors are shuffled
once, whatever the number of trees a query visits. Their rows grow with the vectors, as every task may read all of them; a worker keeps a bounded number of rows.

Defined results: vectors that are null, of another length, all zero, or hold a null, NaN or infinity take no
part; length does not matter; equal similarities (to nine decimals) order by id, however many tie; exact repeats of a row count once; fewer than k others give fewer rows; an empty table gives none.
"""

from __future__ import annotations

import pickle
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan import shared

K = 5
DIMENSIONS = 64
#: Pruning factors of the roots and of the halves below them, which are less compact; with a factor of 1 both are exact.
#: Recall of the k best is measured in the tests and given in the README.
RELAX, RELAX_HALVES = 6.0, 2.0
#: The factor, at all depths, of a search of which only answers from a least similarity on are wanted.
RELAX_LEAST = 2.5
#: The root vantage points are fitted on so many vectors at most, a dozen for each root; all others are only assigned.
SAMPLE = 24_576
NODE_ROWS, LEAST_NODES, MOST_NODES = 384, 8, SAMPLE // 12
LEAF_ROWS = 192
#: Similarity of the k-th best from which a vector is searched again with factor one.
NEAR = 0.9
#: Every task reads the shards it cannot rule out, so their number is kept, while they grow from the least rows to the most that fit a worker.
SHARDS, SHARD_ROWS, MOST_SHARD_ROWS = 48, 8192, 1 << 17
#: Other directions kept for each vector, by similarity and then smallest id: the k best ids lie in the first k of them.
KEPT = 8
#: Angles near zero are known to so much, as units are rounded.
_SLACK = 1e-3
#: Pairs compared at once.
_PAIRS = 1 << 20
#: Pairs of a common cell sifted at once.
_SIFTED = 1 << 16
#: Balls whose cosines to all of a shard's vectors are held at once.
_BALLS = 32
#: Vectors for each cell of a forest's tree, and the share of pairs of just the least similarity that lie in no common cell.
CELL_ROWS, MISSED = 8, 2e-4
#: Trees beyond which a forest is no gain.
MOST_TREES = 256
#: Signs of a vector's sketch, and how many standard deviations more of them may differ than do on average at the least similarity.
BITS, DEVIATIONS = 256, 4.5
#: Vectors of the shards whose cells are held in one file, and trees that a task plants.
GROUP_ROWS, TREES_A_TASK = 1 << 22, 4
#: Rows of the shards that a worker keeps.
_CACHED_ROWS = 24 * 8192


def _directions(ids: pa.Array, vectors: pa.Array, dim: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, unit vectors, vectors scaled by powers of two, digests of these in two numbers each) of a batch's usable rows."""
    import hashlib

    length = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero((length == dim) & ids.is_valid().to_numpy(zero_copy_only=False))
    values = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)  # nulls become NaN
    big = np.abs(values).max(1) if len(rows) else np.zeros(0)
    good = np.isfinite(values).all(1) & (big > 0)
    rows, values = rows[good], values[good]
    raw = np.ascontiguousarray(np.ldexp(values, -np.frexp(big[good])[1][:, None]).astype(np.float32) + np.float32(0))
    digests = b"".join(hashlib.blake2b(r.tobytes(), digest_size=16).digest() for r in raw)
    return ids.take(pa.array(rows)), _units(raw), raw, np.frombuffer(digests, np.int64).reshape(-1, 2)


def _units(raw: np.ndarray) -> np.ndarray:
    wide = raw.astype(np.float64)
    return (wide / np.sqrt((wide**2).sum(1, keepdims=True))).astype(np.float32)


def _matrix(units, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(units), np.float32).reshape(-1, dim)


def fit_vantage_points(sample: np.ndarray, count: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Centres of ``count`` balls that cover the sample's directions, in an order in which neighbours lie together."""
    rng = np.random.default_rng(seed)
    points = sample[rng.choice(len(sample), min(count, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        own = (sample @ points.T).argmax(1)
        sums = np.zeros_like(points)
        np.add.at(sums, own, sample)
        norm = np.sqrt((sums**2).sum(1))
        points[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    order, left = [0], set(range(1, len(points)))
    near = points @ points.T
    while left:  # a chain from each point to its nearest one left
        at = near[order[-1]].copy()
        at[order] = -9
        order.append(int(at.argmax()))
        left.discard(order[-1])
    return points[order]


@dataclass
class Trees:
    """The roots of all shards' trees: vantage point, radius and shard of every ball."""

    points: np.ndarray
    node: np.ndarray  # number of the vantage point of each ball
    shard: np.ndarray
    radius: np.ndarray
    files: list[str]  # of each shard
    forest: Forest | None = None


@dataclass
class Forest:
    """Trees without backtracking: the vantage points of every level, and where the cells of each group of shards lie."""

    centre: np.ndarray
    sizes: tuple[int, ...]  # vantage points of each level, without their opposites
    frames: np.ndarray  # of every tree, side by side
    planes: np.ndarray  # of the sketches
    differ: tuple[int, int]  # signs that may differ of the first 64, and of all
    first: np.ndarray | None = None  # row in its group of every shard's first
    groups: tuple[tuple[int, ...], ...] = ()  # the shards of each
    folder: str = ""

    @property
    def cells(self) -> int:
        return int(np.prod([2 * d for d in self.sizes], dtype=np.int64))

    @property
    def count(self) -> int:
        return self.frames.shape[1] // sum(self.sizes)

    def file(self, group: int, tree: int) -> str:
        return f"{self.folder}/{group}-{tree}.arrow"

    def cell(self, units: np.ndarray, trees: range) -> np.ndarray:
        """The cell of every vector in each of some trees."""
        width = sum(self.sizes)
        out = np.zeros((len(trees), len(units)), np.int32)
        frames = np.ascontiguousarray(self.frames[:, trees.start * width : trees.stop * width])
        held = np.empty((2, 1024, frames.shape[1]), np.float32)
        for begin in range(0, len(units), 1024):
            some = slice(begin, min(begin + 1024, len(units)))
            at = np.arange(some.stop - begin)
            near = np.matmul(units[some] - self.centre, frames, out=held[0, : len(at)])
            size = np.abs(near, out=held[1, : len(at)])
            for i in range(len(trees)):
                c = i * width
                for d in self.sizes:
                    best = size[:, c : c + d].argmax(1)
                    out[i, some] = out[i, some] * (2 * d) + 2 * best + (near[at, c + best] < 0)
                    c += d
        return out

    def sketch(self, units: np.ndarray) -> np.ndarray:
        signs = [np.packbits(units[b : b + 8192] @ self.planes > 0, axis=1) for b in range(0, len(units), 8192)]
        return np.concatenate([np.zeros((0, BITS // 8), np.uint8), *signs])


def _frames(rng: np.random.Generator, sizes: tuple[int, ...], dim: int) -> np.ndarray:
    """Orthogonal vantage points for the levels of one tree."""
    return np.concatenate([np.linalg.qr(rng.normal(size=(dim, dim)))[0][:, :d] for d in sizes], 1).astype(np.float32)


def fit_forest(sample: np.ndarray, total: int, least: float, seed: int = 11) -> Forest | None:
    """As many trees as ``least`` calls for, by the share of pairs of just that similarity that fall into one cell; none if there would be too many."""
    rng, dim = np.random.default_rng(seed), sample.shape[1]
    left, sizes = max(2.0, min(total, GROUP_ROWS * 4) / CELL_ROWS), []  # a group's file lists every cell
    while left >= 2:
        sizes.append(int(min(1 << (dim.bit_length() - 1), 1 << int(np.log2(left / 2)))))
        left /= 2 * sizes[-1]
    planes = rng.normal(size=(dim, BITS)).astype(np.float32)
    apart = np.arccos(least) / np.pi
    differ = tuple(int(np.ceil(n * apart + DEVIATIONS * np.sqrt(n * apart * (1 - apart)))) for n in (64, BITS))
    forest = Forest(sample.mean(0), tuple(sizes), np.concatenate([_frames(rng, tuple(sizes), dim) for _ in range(8)], 1), planes, differ)
    x = sample[rng.integers(0, len(sample), 8192)].astype(np.float64)
    across = rng.normal(size=x.shape)
    across -= (across * x).sum(1, keepdims=True) * x
    y = least * x + np.sqrt(1 - least**2) * across / np.maximum(np.linalg.norm(across, axis=1, keepdims=True), 1e-9)
    met = float((forest.cell(x.astype(np.float32), range(8)) == forest.cell(y.astype(np.float32), range(8))).mean())
    count = int(np.ceil(np.log(MISSED) / np.log1p(-min(met, 0.999)))) if met > 0 else MOST_TREES + 1
    if count > MOST_TREES:
        return None
    forest.frames = np.concatenate([_frames(rng, tuple(sizes), dim) for _ in range(count)], 1)
    return forest


@dataclass
class Node:
    """A part of a ball, ``begin`` to ``end`` in the shard's order. Inner nodes have a vantage point, and for each half the least and greatest angle to it."""

    begin: int
    end: int
    point: np.ndarray | None = None
    halves: tuple[tuple[Node, float, float], ...] = ()

    def depth(self) -> int:
        return 1 + max((half.depth() for half, _, _ in self.halves), default=0)


def _angles(points: np.ndarray, units: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(points @ units.T, -1, 1))


def grow(units: np.ndarray, rows: np.ndarray, point: np.ndarray, begin: int, order: list[np.ndarray]) -> Node:
    """The tree of some rows; their order in the shard is appended to ``order``."""
    if len(rows) <= LEAF_ROWS:
        order.append(rows)
        return Node(begin, begin + len(rows))
    angle = _angles(point[None], units[rows])[0]
    by_angle = np.argsort(angle, kind="stable")
    middle = len(rows) // 2
    halves, at = [], begin
    for part in (by_angle[:middle], by_angle[middle:]):
        half = grow(units, rows[part], units[rows[part[-1]]], at, order)
        halves.append((half, float(angle[part[0]]) - _SLACK, float(angle[part[-1]]) + _SLACK))
        at = half.end
    return Node(begin, at, point, tuple(halves))


@dataclass
class Shard:
    """A shard's directions in the order of its trees. Local files are mapped, so that only what is looked at is read."""

    roots: dict[int, Node]
    node: np.ndarray  # the root of every row
    raw: np.ndarray
    ids: pa.Array  # the smallest ids of every direction
    norms: np.ndarray
    order: np.ndarray  # place of a direction's smallest id among the shard's
    sketches: np.ndarray | None = None

    @cached_property
    def vectors(self) -> np.ndarray:
        return self.units(0, len(self.raw))

    def units(self, begin: int, end: int) -> np.ndarray:
        return self.raw[begin:end] * (1 / self.norms[begin:end]).astype(np.float32)[:, None]

    def several(self) -> np.ndarray:
        """Whether each direction has several ids."""
        return pc.list_value_length(self.ids).to_numpy(zero_copy_only=False) > 1

    def names(self, rows: np.ndarray) -> np.ndarray:
        """The id of each direction that has one, else the list."""
        names = np.empty(len(rows), object)
        names[:] = [i[0] if len(i) == 1 else i for i in self.ids.take(pa.array(rows)).to_pylist()]
        return names

    @cached_property
    def least_ids(self) -> list:
        return pc.list_element(self.ids, 0).to_pylist()


def _write_batch(path: str, batch: pa.RecordBatch) -> None:
    fs, name = shared.open_file(path)
    fs.create_dir(name.rsplit("/", 1)[0])
    attempt = f"{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(attempt) as out, pa.ipc.new_file(out, batch.schema) as file:
        file.write_batch(batch)
    fs.move(attempt, name)


def _read_batch(path: str) -> pa.RecordBatch:
    import pyarrow.fs as pafs

    fs, name = shared.open_file(path)
    if isinstance(fs, pafs.LocalFileSystem):
        fs = pafs.LocalFileSystem(use_mmap=True)
    return pa.ipc.open_file(fs.open_input_file(name)).get_batch(0)


def _write_shard(folder: str, path: str, dim: int, points: np.ndarray, forest: Forest | None = None) -> list[tuple[int, float, int]]:
    """Grow the trees of a shard's table in ``folder``, unless a forest stands for them, and write the shard to ``path``; (root, radius, rows) of its balls."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    fs, name = shared.open_file(folder)
    files = [f.path for f in fs.get_file_info(pafs.FileSelector(name)) if f.size and f.path.endswith(".parquet")]
    t = pa.concat_tables([pq.read_table(f, filesystem=fs, columns=["node", "g1", "g2", "angle", "raw", "ids"], partitioning=None) for f in sorted(files)])
    t = t.sort_by([("node", "ascending"), ("g1", "ascending"), ("g2", "ascending")])
    node, raw = t.column("node").to_numpy(), _matrix(t.column("raw").to_pylist(), dim)
    units, order, roots, at = _units(raw), [], {}, 0
    for root in np.unique(node):
        rows = np.flatnonzero(node == root)
        if forest is None:
            roots[int(root)] = grow(units, rows, points[root], at, order)
        else:
            order.append(rows)
            roots[int(root)] = Node(at, at + len(rows))
        at = roots[int(root)].end
    rows = np.concatenate(order)
    ids = t.column("ids").combine_chunks().take(pa.array(rows))
    place = np.empty(len(rows), np.int64)
    place[pc.sort_indices(pc.list_element(ids, 0)).to_numpy()] = np.arange(len(rows))
    raw = np.ascontiguousarray(raw[rows])
    norms = np.sqrt((raw.astype(np.float64) ** 2).sum(1))
    columns = {"node": pa.array(node[rows]), "raw": pa.FixedSizeBinaryArray.from_buffers(pa.binary(dim * 4), len(rows), [None, pa.py_buffer(raw)]), "ids": ids, "norm": pa.array(norms), "order": pa.array(place)}
    if forest is not None:
        columns["sketch"] = pa.FixedSizeBinaryArray.from_buffers(pa.binary(BITS // 8), len(rows), [None, pa.py_buffer(forest.sketch(units[rows]))])
    batch = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns)).replace_schema_metadata({"roots": pickle.dumps(roots)})
    _write_batch(path, batch)
    angle = t.column("angle").to_numpy()
    return [(root, float(angle[node == root].max()), int(np.count_nonzero(node == root))) for root in roots]


def _plant_trees(trees: Trees, group: int, some: range, dim: int) -> None:
    """Write the cells of a group's vectors in some trees: where each cell begins, then the rows cell by cell."""
    forest = trees.forest
    cell = []
    for s in forest.groups[group]:
        found = _load(trees, s, dim)
        cell += [forest.cell(found.units(b, b + (1 << 16)), some) for b in range(0, len(found.raw), 1 << 16)]
    cell = np.concatenate(cell, 1)
    for i, tree in enumerate(some):
        begins = np.zeros(forest.cells + 1, np.int32)
        np.cumsum(np.bincount(cell[i], minlength=forest.cells), out=begins[1:])
        rows = np.argsort(cell[i], kind="stable").astype(np.int32)
        _write_batch(forest.file(group, tree), pa.RecordBatch.from_arrays([pa.array(np.r_[begins, rows])], names=["cells"]))


_shards: OrderedDict[str, Shard] = OrderedDict()


def _load(trees: Trees, shard: int, dim: int) -> Shard:
    """A shard with its trees."""
    path = trees.files[shard]
    if path in _shards:
        _shards.move_to_end(path)
        return _shards[path]
    batch = _read_batch(path)
    node, norms, order = (batch.column(c).to_numpy() for c in ("node", "norm", "order"))
    raw = np.frombuffer(batch.column("raw").buffers()[1], np.float32)[: batch.num_rows * dim].reshape(-1, dim)
    got = Shard(pickle.loads(batch.schema.metadata[b"roots"]), node, raw, batch.column("ids"), norms, order)
    if "sketch" in batch.schema.names:
        got.sketches = np.frombuffer(batch.column("sketch").buffers()[1], np.uint64)[: batch.num_rows * BITS // 64].reshape(-1, BITS // 64)
    _shards[path] = got
    while len(_shards) > 2 and sum(len(s.raw) for s in _shards.values()) > _CACHED_ROWS:
        _shards.popitem(last=False)
    return got


class _Best:
    """The best KEPT directions of every query so far, by similarity to nine decimals, then smallest id."""

    def __init__(self, n: int, least_id: Callable[[int, int], object]) -> None:
        self.least_id = least_id  # of (shard, row)
        self.sim = np.full((n, KEPT), -2.0)
        self.at = np.zeros((n, KEPT, 2), np.int32)  # shard and row there

    def add(self, q: np.ndarray, sim: np.ndarray, shard: int, row: np.ndarray, place_of_id: np.ndarray) -> None:
        sim = np.round(np.minimum(sim, 1.0), 9)
        order = np.lexsort((place_of_id, -sim, q))
        q, sim, row = q[order], sim[order], row[order]
        first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        size = np.diff(np.r_[first, len(q)])
        place = np.arange(len(q)) - np.repeat(first, size)
        use = place < KEPT
        rows = q[first]
        at = np.repeat(np.arange(len(rows)), size)[use]
        both = np.full((len(rows), 2 * KEPT), -2.0)
        where = np.zeros((len(rows), 2 * KEPT, 2), np.int32)
        both[:, :KEPT], where[:, :KEPT] = self.sim[rows], self.at[rows]
        both[at, KEPT + place[use]] = sim[use]
        where[at, KEPT + place[use], 0], where[at, KEPT + place[use], 1] = shard, row[use]
        top = np.argsort(-both, 1, kind="stable")
        ranked = np.take_along_axis(both, top[:, KEPT - 1 : KEPT + 1], 1)
        for i in np.flatnonzero((ranked[:, 0] == ranked[:, 1]) & (ranked[:, 0] > -1.5)):  # a tie at the cut
            have = [j for j in top[i] if both[i, j] > -1.5]
            have.sort(key=lambda j: (-both[i, j], self.least_id(int(where[i, j, 0]), int(where[i, j, 1]))))
            top[i, : len(have)] = have
        top = top[:, :KEPT]
        self.sim[rows] = np.take_along_axis(both, top, 1)
        self.at[rows] = np.take_along_axis(where, top[:, :, None], 1)


class _Search:
    """The search of some of a shard's vectors."""

    def __init__(self, shard: int, trees: Trees, k: int, dim: int, least: float = -1.0) -> None:
        self.shard, self.trees, self.k, self.dim = shard, trees, k, dim
        self.reach = np.inf if least <= -1 else float(np.arccos(least)) + _SLACK  # how far away an answer can be
        self.own = _load(trees, shard, dim)
        n = len(self.own.vectors)
        self.best = _Best(n, lambda s, row: (self.own if s == shard else _load(trees, s, dim)).least_ids[row])
        self.limit = np.full(n, np.inf, np.float32)  # how near a part must come to each query
        self.floor = np.full(n, -1.5 if least <= -1 else least - 1e-6, np.float32)  # the least similarity that can still matter to it
        self.raw = self.own.raw.astype(np.float64)
        self.compared = 0

    def _compare(self, found: Shard, other: int, a: int, b: int, q: np.ndarray) -> None:
        y = found.vectors[a:b]
        self.compared += len(q) * (b - a)
        step = int(np.clip(_PAIRS // (b - a), 1, 4096))
        for begin in range(0, len(q), step):
            some = q[begin : begin + step]
            sims = self.own.vectors[some] @ y.T
            least = self.floor[some]
            if other == self.shard:
                inside = np.flatnonzero((some >= a) & (some < b))
                sims[inside, some[inside] - a] = -2
            if b - a > KEPT and np.isinf(self.limit[some[0]]):
                kth = np.partition(sims, b - a - KEPT, 1)[:, b - a - KEPT]
                least = np.maximum(least, kth - np.float32(1e-6))
            i, j = np.divmod(np.flatnonzero(sims >= least[:, None]), b - a)
            if not len(i):
                continue
            rows = some[i]
            sim = np.empty(len(rows))
            for c in range(0, len(rows), 1 << 14):
                at = slice(c, c + (1 << 14))
                sim[at] = np.einsum("ij,ij->i", self.raw[rows[at]], found.raw[a + j[at]].astype(np.float64))
            sim /= self.own.norms[rows] * found.norms[a + j]
            self.best.add(rows, sim, other, a + j, found.order[a + j])
            new = rows[np.r_[True, rows[1:] != rows[:-1]]]
            full = new[self.best.sim[new, self.k - 1] > -2]
            self.limit[full] = np.minimum(self.limit[full], np.arccos(np.clip(self.best.sim[full, self.k - 1], -1, 1)) / self.relax)
            self.floor[new] = np.maximum(self.best.sim[new, KEPT - 1] - 1e-6, self.floor[new])

    def _visit(self, found: Shard, other: int, node: Node, q: np.ndarray, angle: np.ndarray | None) -> None:
        """Compare ``q``, at ``angle`` from the node's vantage point, with what the node cannot rule out; the half that is nearer to most comes first."""
        if node.point is None:
            self._compare(found, other, node.begin, node.end, q)
            return
        if angle is None:
            angle = _angles(node.point[None], self.own.vectors[q])[0]
        middle = node.halves[0][2]
        for half, least, most in node.halves if np.count_nonzero(angle < middle) * 2 >= len(q) else node.halves[::-1]:
            limit = self.limit[q] * self.inner
            near = q[(angle - most <= limit) & (least - angle <= limit)]
            if len(near):
                self._visit(found, other, half, near, None)

    def run(self, q: np.ndarray, relax: float) -> None:
        """Search the vectors numbered ``q``."""
        self.relax, trees = relax, self.trees
        self.inner = np.float32(relax / min(relax, RELAX_HALVES) if np.isinf(self.reach) else 1)
        to_root = -(trees.points @ self.own.vectors[q].mean(0))
        balls_of = np.split(np.argsort(trees.shard, kind="stable"), np.cumsum(np.bincount(trees.shard, minlength=len(trees.files)))[:-1])
        to_shard = np.array([to_root[trees.node[b]].mean() for b in balls_of])
        to_shard[self.shard] = -9
        for other in map(int, np.argsort(to_shard, kind="stable")):
            balls = balls_of[other][np.argsort(to_root[trees.node[balls_of[other]]], kind="stable")]
            if other == self.shard:  # each ball's own vectors before all others, so that the limits are near from the start
                for ball in balls:
                    root = self.own.roots[int(trees.node[ball])]
                    inside = q[(q >= root.begin) & (q < root.end)]
                    for leaf in _leaves(root):
                        mine = inside[(inside >= leaf.begin) & (inside < leaf.end)]
                        if len(mine):
                            self._compare(self.own, other, leaf.begin, leaf.end, mine)
                            self._elsewhere(root, leaf, mine)
            found = None
            for begin in range(0, len(balls), _BALLS):
                some_balls = balls[begin : begin + _BALLS]
                cosines = trees.points[trees.node[some_balls]] @ self.own.vectors[q].T
                beyond = self._beyond(trees.node[some_balls], cosines, q)
                for ball, cosine, out in zip(some_balls, cosines, beyond, strict=True):
                    near = np.flatnonzero(~out)
                    if other == self.shard:
                        near = near[self.own.node[q[near]] != trees.node[ball]]
                    to = np.arccos(np.clip(cosine[near], -1, 1))
                    inside = to - np.float32(trees.radius[ball]) <= self.limit[q[near]]
                    near, to = near[inside], to[inside]
                    if len(near):
                        found = found or (self.own if other == self.shard else _load(trees, other, self.dim))
                        root = found.roots[int(trees.node[ball])]
                        self._visit(found, other, root, q[near], to if root.point is not None else None)

    def _beyond(self, nodes: np.ndarray, cosines: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether each ball lies farther away than the limit by the plane that parts it from the query's own ball: a ball's vectors are nearer to its point than to any other."""
        if np.isinf(self.reach):  # limits as wide as those of the k best lie behind all planes
            return np.zeros(cosines.shape, bool)
        points = self.trees.points
        width = np.sqrt(np.maximum(2 - 2 * (points[nodes] @ points.T), 0))
        own = np.einsum("ij,ij->i", points[self.own.node[q]], self.own.vectors[q])
        edge = np.sin(np.minimum(self.limit[q] * self.inner + np.float32(_SLACK), np.float32(np.pi / 2)))
        return own - cosines > edge * width[:, self.own.node[q]] + np.float32(1e-5)

    def _elsewhere(self, root: Node, leaf: Node, q: np.ndarray) -> None:
        """The rest of the own tree of vectors that lie in ``leaf``."""
        node = root
        while node is not leaf:
            angle = _angles(node.point[None], self.own.vectors[q])[0]
            inner, outer = node.halves
            mine, other = (inner, outer) if leaf.end <= inner[0].end else (outer, inner)
            limit = self.limit[q] * self.inner
            near = (angle - other[2] <= limit) & (other[1] - angle <= limit)
            if near.any():
                self._visit(self.own, self.shard, other[0], q[near], None)
            node = mine[0]


def _leaves(node: Node) -> Iterator[Node]:
    if node.point is None:
        yield node
    for half, _, _ in node.halves:
        yield from _leaves(half)


def _runs(begins: np.ndarray, ends: np.ndarray, most: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(some runs, their lengths, all places from begin to end of each), of about so many places at a time."""
    sizes = ends - begins
    until = np.cumsum(sizes, dtype=np.int64)
    at, total = 0, int(until[-1]) if len(until) else 0
    shift, i = begins - (until - sizes), 0
    for j in np.unique(np.searchsorted(until, np.arange(most, total + most, most)).clip(0, len(until) - 1) + 1).tolist():
        if total > at:
            yield slice(i, j), sizes[i:j], np.arange(at, int(until[j - 1])) + np.repeat(shift[i:j], sizes[i:j])
        at, i = int(until[j - 1]), j


def search_forest(shard: int, trees: Trees, dim: int, least: float) -> tuple[Shard, _Best, int]:
    """(the shard, the best of its vectors from the least similarity on, pairs sifted)."""
    forest, own = trees.forest, _load(trees, shard, dim)
    n = len(own.raw)
    best = _Best(n, lambda s, row: (own if s == shard else _load(trees, s, dim)).least_ids[row])
    floor = np.full(n, least - 1e-6)
    home = next(g for g, shards in enumerate(forest.groups) if shard in shards)
    start, sifted = int(forest.first[shard]), 0

    def settle(q: np.ndarray, row: np.ndarray, shards: tuple[int, ...]) -> None:
        pair = np.unique(row.astype(np.int64) * n + q)
        row, q = np.divmod(pair, n)
        edges = np.r_[np.searchsorted(row, forest.first[list(shards)]), len(row)]
        for other, a, b in zip(shards, edges[:-1], edges[1:], strict=True):
            for c in range(a, b, 1 << 14):
                at = slice(c, min(c + (1 << 14), b))
                found, rows, some = _load(trees, other, dim), row[at] - forest.first[other], q[at]
                sim = np.einsum("ij,ij->i", own.raw[some].astype(np.float64), found.raw[rows].astype(np.float64)) / (own.norms[some] * found.norms[rows])
                known = ((best.at[some, :, 0] == other) & (best.at[some, :, 1] == rows[:, None]) & (best.sim[some] > -1.5)).any(1)
                use = (sim >= floor[some]) & ~known
                if use.any():
                    some, rows = some[use], rows[use]
                    best.add(some, sim[use], other, rows, found.order[rows])
                    floor[some] = np.maximum(floor[some], best.sim[some, KEPT - 1] - 1e-6)

    placed = []  # of every tree, its own vectors by cell, and their cells
    for group in (home, *(g for g in range(len(forest.groups)) if g != home)):
        shards = forest.groups[group]
        sketches = np.concatenate([_load(trees, s, dim).sketches for s in shards])
        first_word, own_word = np.ascontiguousarray(sketches[:, 0]), np.ascontiguousarray(own.sketches[:, 0])
        met, waiting, first_cell = [], 0, np.empty(len(sketches), np.int32)
        for tree in range(forest.count):
            begins, rows = _cells(forest, group, tree)
            if tree == 0 or group == home:
                all_cells = np.repeat(np.arange(forest.cells, dtype=np.int32), np.diff(begins))
            if group == home:
                mine = np.flatnonzero((rows >= start) & (rows < start + n))
                placed.append((rows[mine] - np.int32(start), all_cells[mine]))
            if tree == 0:
                first_cell[rows] = all_cells
                own_first = np.empty(n, np.int32)
                own_first[placed[0][0]] = placed[0][1]
            q, cell = placed[tree]
            words = own_word[q]
            for run, sizes, place in _runs(begins[cell], begins[cell + 1], _SIFTED):
                b = rows[place]
                sifted += len(b)
                like = np.flatnonzero(np.bitwise_count(np.repeat(words[run], sizes) ^ first_word[b]) <= forest.differ[0])
                a, b = np.repeat(q[run], sizes)[like], b[like]
                keep = np.bitwise_count(own.sketches[a] ^ sketches[b]).sum(1, dtype=np.int32) <= forest.differ[1]
                if group == home:
                    keep &= b != a + start
                if tree:  # those of a common first cell are settled there
                    keep &= own_first[a] != first_cell[b]
                met.append((a[keep], b[keep]))
                waiting += len(met[-1][0])
                if waiting > _PAIRS:
                    settle(*map(np.concatenate, zip(*met, strict=True)), shards)
                    met, waiting = [], 0
        if met:
            settle(*map(np.concatenate, zip(*met, strict=True)), shards)
    return own, best, sifted


def _cells(forest: Forest, group: int, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """(where each cell begins, and at last ends, rows of the group by cell)."""
    both = _read_batch(forest.file(group, tree)).column(0).to_numpy()
    return both[: forest.cells + 1], both[forest.cells + 1 :]


def search_shard(shard: int, trees: Trees, k: int, relax: float, dim: int, near: float = NEAR, least: float = -1.0) -> tuple[Shard, _Best, int]:
    """(the shard, the best of its vectors, pairs compared)."""
    if trees.forest is not None:
        return search_forest(shard, trees, dim, least)
    search = _Search(shard, trees, k, dim, least)
    n = len(search.own.vectors)
    search.limit[:] = search.reach / relax
    search.run(np.arange(n), relax)
    close = np.flatnonzero(search.best.sim[:, k - 1] >= near)
    if relax > 1 and least <= -1 and len(close):
        search.limit[:], search.floor[:] = np.inf, -1.5
        # what was found bounds what is to be found; it is then found anew
        search.limit[close] = np.arccos(np.clip(search.best.sim[close, k - 1], -1, 1)) + _SLACK
        search.best.sim[close] = -2.0
        search.run(close, 1.0)
    return search.own, search.best, search.compared


def answers(own: Shard, best: _Best, trees: Trees, k: int, dim: int) -> tuple[list, np.ndarray, list, np.ndarray, list]:
    """(ids, length of each one's list, ids in the lists, similarities in the lists, whether more copies exist), in rows."""
    sims = np.round(np.minimum(best.sim, 1.0), 9)
    good = best.sim > -1.5
    names = np.empty(best.sim.shape, object)
    for shard in np.unique(best.at[:, :, 0][good]):
        at = good & (best.at[:, :, 0] == shard)
        names[at] = _load(trees, int(shard), dim).names(best.at[:, :, 1][at])
    several = own.several()
    some = good.any(1) | several  # all others have no answer
    own_names = np.empty(len(good), object)
    own_names[some] = own.names(np.flatnonzero(some))
    # where all are single and no similarities tie, the rows are in their order already
    tied = ((sims[:, 1 : k + 2] == sims[:, : k + 1]) & good[:, 1 : k + 2]).any(1)
    plain = some & ~several & ~tied & ~np.vectorize(lambda x: isinstance(x, list), otypes=[bool])(names).any(1)
    first = good[plain][:, :k]
    ids, sizes, many = own_names[plain].tolist(), [first.sum(1)], [False] * int(plain.sum())
    listed, near = names[plain][:, :k][first].tolist(), [sims[plain][:, :k][first]]
    for q in np.flatnonzero(some & ~plain):
        mine = own_names[q] if several[q] else [own_names[q]]
        all_of = [(-1.0, i) for i in mine]
        for j in np.flatnonzero(good[q]):
            all_of += [(-float(sims[q, j]), i) for i in (names[q, j] if isinstance(names[q, j], list) else [names[q, j]])]
        all_of = sorted(all_of)[: k + 1]
        for i in mine:
            others = [(x, -d) for d, x in all_of if x != i][:k]
            ids.append(i)
            many.append(len(mine) > k)
            sizes.append([len(others)])
            listed += [x for x, _ in others]
            near.append([s for _, s in others])
    return ids, np.concatenate(sizes).astype(np.int64), listed, np.concatenate(near).astype(float), many


def _plan_shards(counts: dict[int, int], nodes: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(first shard, number of shards) of every node: neighbours share one of so many rows, large nodes get several."""
    first, parts = np.zeros(nodes, np.int64), np.ones(nodes, np.int64)
    at, filled = 0, 0
    for node in range(nodes):
        n = counts.get(node, 0)
        if n > rows:
            at += filled > 0
            first[node], parts[node] = at, -(-n // rows)
            at, filled = at + int(parts[node]), 0
            continue
        if filled and filled + n > rows:
            at, filled = at + 1, 0
        first[node] = at
        filled += n
    return first, parts


def build(df: DataFrame, k: int, dim: int, least: float = -1.0) -> Trees | None:
    """Shards and trees of all usable vectors of ``df``: (id, vector). With a ``least`` similarity they are held by a forest for it, if that is a gain."""
    spark = df.sparkSession
    kind = df.schema["id"].dataType.simpleString()
    total = df.count()
    usable = df.filter((F.size("vector") == dim) & F.col("id").isNotNull())
    # by the hash of the id: twice the sample at the most likely, of which the first are taken
    part = min(1.0, 2 * SAMPLE / max(total, 1))
    usable = usable.withColumn("h", F.xxhash64("id")).filter(F.pmod("h", F.lit(1 << 20)) < int(np.ceil(part * (1 << 20))))
    sample = usable.orderBy("h", "id").limit(SAMPLE).select("id", "vector").toArrow()
    if not total:
        return None
    units = np.concatenate([np.zeros((0, dim), np.float32), *(_directions(b.column(0), b.column(1), dim)[1] for b in sample.to_batches())])
    if not len(units):
        units = np.eye(1, dim, dtype=np.float32)  # a sample of unusable vectors only; all others meet at one point
    forest = fit_forest(units, total, least) if least > -1 else None
    # shards of a forest are any vectors, so one root does
    points = fit_vantage_points(np.unique(units, axis=0), int(np.clip(total // NODE_ROWS, LEAST_NODES, MOST_NODES)) if forest is None else 1)
    share = np.bincount((units @ points.T).argmax(1), minlength=len(points)) / len(units)
    first, parts = _plan_shards({i: int(np.ceil(s * total)) for i, s in enumerate(share)}, len(points), int(np.clip(total // SHARDS, SHARD_ROWS, max(SHARD_ROWS, MOST_SHARD_ROWS))))
    held = spark.sparkContext.broadcast((points, first, parts))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, first, parts = held.value
        few: dict[tuple[int, int], list] = {}
        for batch in batches:
            ids, unit, raw, g = _directions(batch.column(0), batch.column(1), dim)
            if not len(unit):
                continue
            if len(few) > 200_000:
                few.clear()
            names, new, keep = ids.to_pylist(), [], []
            for i, key in enumerate(map(tuple, g.tolist())):
                seen = few.get(key)
                new.append(seen is None)
                seen = few.setdefault(key, [])
                # of a direction's copies only those can matter that are among its smallest ids so far
                keep.append(names[i] not in seen and (len(seen) <= k or names[i] < seen[-1]))
                if keep[-1]:
                    seen.append(names[i])
                    seen.sort()
                    del seen[k + 1 :]
            at = np.flatnonzero(keep)
            sims = unit[at] @ points.T
            node = sims.argmax(1)
            angle = np.arccos(np.clip(sims[np.arange(len(node)), node].astype(np.float64), -1, 1))
            shard = first[node] + np.mod(g[at, 1], parts[node])
            once = [raw[i].tobytes() if new[i] else None for i in at]
            columns = [pa.array(shard.astype(np.int32)), pa.array(node.astype(np.int32)), pa.array(g[at, 0]), pa.array(g[at, 1]), pa.array(angle), pa.array(once, pa.binary()), ids.take(pa.array(at))]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "node", "g1", "g2", "angle", "raw", "id"])

    placed = df.mapInArrow(assign, f"shard int, node int, g1 long, g2 long, angle double, raw binary, id {kind}")
    # the grouping needs no further exchange: shards hold their directions whole
    placed = placed.repartition(int((first + parts).max()), "shard").groupBy("shard", "g1", "g2")
    directions = placed.agg(
        F.first("node").alias("node"), F.first("angle").alias("angle"), F.first("raw", ignorenulls=True).alias("raw"), F.slice(F.array_sort(F.collect_set("id")), 1, k + 1).alias("ids")
    )
    path = shared.new_path(spark, "shards")
    directions.write.partitionBy("shard").parquet(path)
    folders = [f"{path}/shard={shard}" for shard in range(int((first + parts).max()))]
    folders = [folder for folder in folders if shared.exists(spark, folder)]
    if not folders:
        return None
    grown = shared.new_path(spark, "trees")
    files = [f"{grown}/{i}.arrow" for i in range(len(folders))]

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                balls = _write_shard(folders[i], files[i], dim, held.value[0], forest)
                columns = [pa.array([i] * len(balls), pa.int32()), pa.array([b[0] for b in balls], pa.int32()), pa.array([b[1] for b in balls]), pa.array([b[2] for b in balls], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "node", "radius", "n"])

    balls = _numbered(spark, len(folders)).mapInArrow(plant, "shard int, node int, radius double, n long").orderBy("shard", "node").collect()  # one row a ball
    shared.release(spark, path)
    shard, node, radius, n = (np.array([r[c] for r in balls]) for c in ("shard", "node", "radius", "n"))
    trees = Trees(points, node, shard, radius + _SLACK, files, forest)
    if forest is not None:
        _plant_forest(spark, trees, np.bincount(shard, n, len(files)).astype(np.int64), dim)
    return trees


def _plant_forest(spark: SparkSession, trees: Trees, rows: np.ndarray, dim: int) -> None:
    """Write the cells of all trees, group by group of shards with so many ``rows``."""
    forest, groups, first, filled = trees.forest, [[]], [], 0
    for shard, n in enumerate(rows.tolist()):
        if filled and filled + n > GROUP_ROWS:
            groups.append([])
            filled = 0
        groups[-1].append(shard)
        first.append(filled)
        filled += n
    forest.groups, forest.first, forest.folder = tuple(map(tuple, groups)), np.array(first, np.int64), shared.new_path(spark, "forest")
    parts = [(g, t) for g in range(len(groups)) for t in range(0, forest.count, TREES_A_TASK)]
    held = spark.sparkContext.broadcast(trees)

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                group, tree = parts[i]
                _plant_trees(held.value, group, range(tree, min(tree + TREES_A_TASK, held.value.forest.count)), dim)
            yield batch

    _numbered(spark, len(parts)).mapInArrow(plant, "shard int").write.format("noop").mode("overwrite").save()


def _numbered(spark: SparkSession, n: int) -> DataFrame:
    """(shard) from 0, a task each."""
    return spark.range(0, n, 1, n).select(F.col("id").cast("int").alias("shard"))


def similar(df: DataFrame, id_col: str, vector_col: str, k: int = K, relax: float = RELAX, dim: int = DIMENSIONS, least: float = -1.0) -> DataFrame:
    """(id, place, neighbour, similarity): the ``k`` most similar vectors of every usable vector, as far as they are as similar as ``least``."""
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    raw = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    names = [F.col("id").alias(id_col), "place", "neighbour", "similarity"]
    trees = build(raw, k, dim, least if relax > 1 else -1.0)
    if trees is None:
        return spark.createDataFrame([], f"id {kind}, place int, neighbour {kind}, similarity double").select(*names)
    held = spark.sparkContext.broadcast(trees)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                own, best, _ = search_shard(shard, held.value, k, relax, dim, least=least)
                ids, n, listed, near, many = answers(own, best, held.value, k, dim)
                offsets = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(listed, ids_type), pa.array(near)], names=["id", "similarity"]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, ids_type), lists, pa.array(many, pa.bool_())], names=["id", "near", "many"])

    from pyspark.sql.pandas.types import to_arrow_type

    ids_type = to_arrow_type(df.schema[id_col].dataType)
    found = _numbered(spark, len(trees.files)).mapInArrow(search, f"id {kind}, near array<struct<id: {kind}, similarity: double>>, many boolean")
    found = shared.materialize(found, "similar")
    answered = found.select("id", "near")
    if not found.filter("many").isEmpty():
        answered = answered.unionByName(_further_copies(raw, found.filter("many").select("id", "near"), dim, kind))
    rows = answered.select("id", F.posexplode("near").alias("at", "x"))
    if least > -1:
        rows = rows.filter(F.col("x.similarity") >= least)
    return rows.select(F.col("id").alias(id_col), (F.col("at") + 1).alias("place"), F.col("x.id").alias("neighbour"), F.col("x.similarity").alias("similarity"))


def _further_copies(raw: DataFrame, listed: DataFrame, dim: int, kind: str) -> DataFrame:
    """(id, near) of the copies beyond the k + 1 listed of a direction: each has the answer of the last listed, which none of the first k of all that tie can be."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, _, _, g = _directions(batch.column(0), batch.column(1), dim)
            yield pa.RecordBatch.from_arrays([ids, pa.array(g[:, 0]), pa.array(g[:, 1])], names=["id", "g1", "g2"])

    copies = raw.mapInArrow(digest, f"id {kind}, g1 long, g2 long").distinct()
    nearest = copies.join(listed, "id").groupBy("g1", "g2").agg(F.max_by("near", "id").alias("near"))  # k + 1 ids at most
    rest = copies.join(listed.select("id").distinct(), "id", "left_anti").join(nearest, ["g1", "g2"])
    return rest.select("id", "near")
