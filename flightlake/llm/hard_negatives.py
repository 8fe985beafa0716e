"""Hard negatives from score windows, over a multiway hyperplane tree.

Vectors become whole numbers floor(scale * x); a row's score is its inner product
with the anchor.  With the largest norm M, a row x gets one more component
sqrt(M^2 - |x|^2) and an anchor q a zero there; then the squared distance is
|q|^2 + M^2 - 2 q.x, so a window of scores is an annulus of distances around q.

Tree: each node has up to ``ways`` split points, and a row belongs to the nearest
one (the cells are bounded by hyperplanes).  Split point i of a node stores, for
each sibling subtree j, the least and the largest distance from i to the rows of j,
over all rows.  Split points are fitted on a bounded sample (``SAMPLE_ROWS`` rows,
``SAMPLE_BYTES``), which bounds the tree (``SAMPLE_ROWS`` / 8 leaves); every row is
indexed.  A leaf's rows lie in buckets of ``LEAF_ROWS``, sorted by distance.

Search: a row of an asked annulus [a, b] lies at d(q, i) - b to d(q, i) + b from
split point i; subtrees whose stored range does not meet that, or lies nearer than
a, are left out.  What is left is compared exactly, row by row.  A search starts
with what the sample and a bucket of the anchor's own leaf hold, which narrows b.

Of rows with equal vector and label only the first k + 1 by vec_id are indexed: all
score alike, so no others can be among an anchor's first k, itself left out.

Anchors are rows whose vec_id is divisible by ``anchor_step``; positives of an anchor
are its first ``k`` other rows of the same label; negatives of the pair the first
``k`` rows of other labels with lower * positive <= negative score <= positive.
Higher scores come first, ties by vec_id (null last), then by stored row.

Rows take no part with a null label, a null vector, or a component that is null or
not finite, before or after scaling.  Shorter vectors are filled with zeros.  Scores
are exact whole numbers, held to the range of 64 bits.  Repeated rows are rows each;
an anchor's own row is never found.  An empty table gives an empty result.  Other
columns take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.operators.sizing import sample_rows
from flightlake.session import materialize

SCALE = 256
K = 5
ANCHOR_STEP = 100
RELABEL_STEP, LABELS = 7, 10
# Negatives score from 4/5 of the positive's score up to all of it.
LOWER = (4, 5)
LEAF_ROWS = 1024
WAYS = 16
SAMPLE_ROWS = 8192
SAMPLE_BYTES = 32 << 20
ASKS_AT_ONCE = 256

_LAST = np.iinfo(np.int64).max  # stands for a null vec_id; comes last
_MOST, _LEAST = np.iinfo(np.int64).max, np.iinfo(np.int64).min


@dataclass
class Node:
    splits: np.ndarray  # one lifted point per child
    children: list[int]  # node number, or -1 - leaf number
    low: np.ndarray = field(default=None)  # [split point, child]: least distance to the child's rows
    high: np.ndarray = field(default=None)


@dataclass
class Space:
    """What tasks need to know of the vectors."""

    dim: int
    most: float  # largest squared norm
    scores_exact: bool  # whether floating point holds every inner product exactly
    slack: float  # more than any rounding of a distance

    def matrix(self, blobs: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(blobs), "<f8").reshape(len(blobs), self.dim)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.most - (vectors**2).sum(1), 0))
        return np.column_stack([vectors, rest])

    def query(self, vectors: np.ndarray) -> np.ndarray:
        return np.column_stack([vectors, np.zeros(len(vectors))])

    def reach(self, vectors: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Distance at which a row has the score."""
        return np.sqrt(np.maximum((vectors**2).sum(1) + self.most - 2 * scores.astype(np.float64), 0))

    def scores(self, queries: np.ndarray, points: np.ndarray) -> np.ndarray:
        if self.scores_exact:
            return (queries @ points.T).astype(np.int64)
        whole = [[sum(int(a) * int(b) for a, b in zip(q, p)) for p in points] for q in queries]
        return np.array([[max(_LEAST, min(_MOST, s)) for s in row] for row in whole], np.int64).reshape(len(queries), len(points))


def distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (centers**2).sum(1) - 2 * points @ centers.T
    return np.sqrt(np.maximum(square, 0))


def far_apart(points: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` distinct points, each far from those chosen before it."""
    tried = points[np.unique(np.linspace(0, len(points) - 1, min(len(points), 3 * count)).astype(int))]
    chosen = [int(distances(tried, tried.mean(0)[None])[:, 0].argmin())]
    nearest = distances(tried, tried[chosen])[:, 0]
    while len(chosen) < count and nearest.max(initial=0) > 1e-6 * (1 + np.abs(tried).max()):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(tried, tried[chosen[-1:]])[:, 0])
    return tried[chosen]


class Tree:
    def __init__(self, sample: np.ndarray, ways: int, levels: int):
        self.nodes: list[Node] = []
        self.leaves = 0
        self._grow(sample, ways, levels)

    def _grow(self, points: np.ndarray, ways: int, levels: int) -> int:
        splits = far_apart(points, ways) if levels and len(points) else points[:0]
        if len(splits) < 2 and self.nodes:
            self.leaves += 1
            return -self.leaves
        if not len(splits):
            splits = np.zeros((1, points.shape[1]))
        node = Node(splits, [])
        self.nodes.append(node)
        number = len(self.nodes) - 1
        near = distances(points, splits).argmin(1) if len(points) else np.zeros(0, int)
        for child in range(len(splits)):
            node.children.append(self._grow(points[near == child], ways, levels - 1))
        return number

    def place(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, distance to its split point) of each lifted point."""
        leaf, r = np.zeros(len(points), np.int64), np.zeros(len(points))
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            number, rows = waiting.pop()
            if not len(rows):
                continue
            if number < 0:
                leaf[rows] = -1 - number
                continue
            node = self.nodes[number]
            far = distances(points[rows], node.splits)
            near = far.argmin(1)
            r[rows] = far[np.arange(len(rows)), near]
            waiting += [(child, rows[near == j]) for j, child in enumerate(node.children)]
        return leaf, r

    def path(self, leaf: int) -> list[tuple[int, int]]:
        """(node, child) on the way to a leaf."""
        above = {child: (number, j) for number, node in enumerate(self.nodes) for j, child in enumerate(node.children)}
        way, at = [], -1 - leaf
        while at:
            at, j = above[at]
            way.append((at, j))
        return way[::-1]

    def set_ranges(self, rows: list) -> None:
        for node in self.nodes:
            shape = len(node.splits), len(node.children)
            node.low, node.high = np.full(shape, np.inf), np.full(shape, -np.inf)
        for row in rows:
            node = self.nodes[row["node"]]
            node.low[row["split"], row["child"]] = row["low"]
            node.high[row["split"], row["child"]] = row["high"]

    def visit(self, queries: np.ndarray, near: np.ndarray, far: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(leaf, queries, their distances to its split point) that an annulus [near, far] can meet."""
        waiting = [(0, np.arange(len(queries)), np.zeros(len(queries)))]
        while waiting:
            number, rows, own = waiting.pop()
            if number < 0:
                yield -1 - number, rows, own
                continue
            node = self.nodes[number]
            d = distances(queries[rows], node.splits)[:, :, None]
            a, b = near[rows][:, None, None], far[rows][:, None, None]
            # written so that a distance that is no number eliminates nothing
            out = (d - b > node.high) | (d + b < node.low) | (d + node.high < a)
            gone = out.any(1) | (node.high < node.low).any(0)
            for j, child in enumerate(node.children):
                stay = ~gone[:, j]
                if stay.any():
                    waiting.append((child, rows[stay], d[stay, j, 0]))


_POINT = "vec_id long, label long, v binary, norm double"


def _scaler(dim: int, scale: int):
    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for vec_id, label, values in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "vector"))):
                whole = np.zeros(dim, "<f8")
                with np.errstate(over="ignore"):
                    whole[: len(values)] = np.floor(scale * np.asarray(values, np.float64))
                    norm = float(whole @ whole)
                if np.isfinite(whole).all():
                    rows.append((vec_id, label, whole.tobytes(), norm))
            kinds = pa.int64(), pa.int64(), pa.binary(), pa.float64()
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["vec_id", "label", "v", "norm"])

    return scaled


def _placer(tree: Tree, space: Space, as_query: bool, keep: list[str]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = space.matrix(batch.column("v").to_pylist())
            leaf, r = tree.place(space.query(vectors) if as_query else space.lifted(vectors))
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(r), *(batch.column(c) for c in keep)], names=["leaf", "r", *keep])

    return place


_BUCKET = "bucket long, leaf long, low double, high double, ids binary, rows binary, labels binary, vectors binary"


def _bucketer(limit: int):
    """Pack a partition sorted by leaf and distance into buckets."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held = TaskContext.get().partitionId(), 0, []

        def bucket() -> pa.RecordBatch:
            ids = np.array([_LAST if h[3] is None else h[3] for h in held], "<i8")
            rows, labels = (np.array([h[c] for h in held], "<i8") for c in (2, 4))
            values = [(task << 32) + number], [held[0][0]], [held[0][1]], [held[-1][1]], [ids.tobytes()], [rows.tobytes()], [labels.tobytes()], [b"".join(h[5] for h in held)]
            kinds = pa.int64(), pa.int64(), pa.float64(), pa.float64(), *[pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=[c.split()[0] for c in _BUCKET.split(", ")])

        for batch in batches:
            for point in zip(*(batch.column(c).to_pylist() for c in ("leaf", "r", "row", "vec_id", "label", "v"))):
                if held and (held[0][0] != point[0] or len(held) >= limit):
                    yield bucket()
                    number, held = number + 1, []
                held.append(point)
        if held:
            yield bucket()

    return pack


_RANGE = "node int, child int, lows array<double>, highs array<double>"


def _ranger(tree: Tree, space: Space):
    """A bucket's distances from all split points on its way."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaf, vectors in zip(batch.column("leaf").to_pylist(), batch.column("vectors")):
                points = space.lifted(np.frombuffer(vectors.as_py(), "<f8").reshape(-1, space.dim))
                rows = []
                for number, child in tree.path(leaf):
                    far = distances(points, tree.nodes[number].splits)
                    rows.append((number, child, far.min(0).tolist(), far.max(0).tolist()))
                kinds = pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["node", "child", "lows", "highs"])

    return measure


class Rows:
    """Rows to compare with: those of a bucket, or the sample."""

    def __init__(self, ids: bytes, rows: bytes, labels: bytes, vectors: bytes, space: Space):
        self.ids, self.rows, self.labels = (np.frombuffer(x, "<i8") for x in (ids, rows, labels))
        self.vectors = np.frombuffer(vectors, "<f8").reshape(len(self.ids), space.dim)
        self.space = space

    def best(self, asks: Asks, chosen: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ask, row, score), best first, of each chosen ask's k best rows that do not
        fall behind what is known for it."""
        got = self.space.scores(asks.vectors[chosen], self.vectors)
        low, high, last = (x[chosen][:, None] for x in (asks.low, asks.high, asks.last))
        ok = (got <= high) & ((got > low) | ((got == low) & (self.ids <= last)))
        ok &= (self.labels == asks.labels[chosen][:, None]) == asks.same[chosen][:, None]
        ok &= self.rows != asks.rows[chosen][:, None]
        a, x = np.nonzero(ok)
        s = got[a, x]
        order = np.lexsort((self.rows[x], self.ids[x], ~s, a))  # ~s falls as s grows, at any size
        a, x, s = a[order], x[order], s[order]
        keep = np.arange(len(a)) - np.searchsorted(a, a) < k
        return chosen[a[keep]], x[keep], s[keep]


class Asks:
    """Searches of one block; ``low`` and ``last`` bound what can still count."""

    FIELDS = ["rows", "parts", "labels", "same", "low", "high", "last"]

    def __init__(self, row: dict, space: Space):
        self.rows, self.parts, self.labels, same, self.low, self.high, self.last = (np.frombuffer(row[f], "<i8") for f in self.FIELDS)
        self.same = same.astype(bool)
        self.vectors = np.frombuffer(row["asked"], "<f8").reshape(-1, space.dim)
        self.space = space

    def annuli(self) -> tuple[np.ndarray, np.ndarray]:
        slack = self.space.slack
        near = np.where(self.high == _MOST, 0, np.maximum(self.space.reach(self.vectors, self.high) - slack, 0))
        return near, np.where(self.low == _LEAST, np.inf, self.space.reach(self.vectors, self.low) + slack)


_BLOCK = "block long, rows binary, parts binary, labels binary, same binary, low binary, high binary, last binary, asked binary"


def _packer(sample: dict, space: Space, k: int):
    """Pack asks, sorted by leaf, into blocks; the sample bounds each ask."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task, number = Rows(**sample, space=space), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, ASKS_AT_ONCE):
                part = batch.slice(at, ASKS_AT_ONCE)
                columns = {f: np.array(part.column(c).to_pylist(), "<i8") for f, c in zip(Asks.FIELDS, ("row", "part", "label", "same", "low", "high", "last"))}
                row = {f: v.tobytes() for f, v in columns.items()} | {"asked": b"".join(part.column("v").to_pylist())}
                asks = Asks(row, space)
                a, x, s = known.best(asks, np.arange(part.num_rows), k)
                ends = np.flatnonzero(np.append(a[1:] != a[:-1], True)) if len(a) else np.zeros(0, int)
                full = ends[np.diff(np.concatenate([[-1], ends])) == k]
                columns["low"][a[full]], columns["last"][a[full]] = s[full], known.ids[x[full]]
                row |= {"low": columns["low"].tobytes(), "last": columns["last"].tobytes()}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << 32) + number], pa.int64()), *(pa.array([row[f]], pa.binary()) for f in [*Asks.FIELDS, "asked"])],
                    names=["block", *Asks.FIELDS, "asked"],
                )
                number += 1

    return pack


def _visitor(tree: Tree, space: Space, home: bool):
    """Per block and leaf, the distances from its split point that some ask must look at."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asks = Asks(row, space)
                queries = space.query(asks.vectors)
                found = []
                if home:
                    found = [(int(leaf), -np.inf, np.inf) for leaf in np.unique(tree.place(queries)[0])]
                else:
                    near, far = asks.annuli()
                    for leaf, rows, own in tree.visit(queries, near, far):
                        found.append((leaf, float((own - far[rows]).min()), float((own + far[rows]).max())))
                kinds = pa.int64(), pa.float64(), pa.float64()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(found), pa.int64()), *(pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds))],
                    names=["block", "leaf", "near", "far"],
                )

    return visit


_FOUND = "row long, part long, vec_id long, found long, score long"


def _searcher(tree: Tree, space: Space, k: int, home: bool):
    """Exact comparison of a block's asks with a bucket."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                asks = Asks(row, space)
                queries = space.query(asks.vectors)
                if home:
                    meets = np.flatnonzero(tree.place(queries)[0] == row["leaf"])
                else:
                    number, child = tree.path(row["leaf"])[-1]
                    own = distances(queries, tree.nodes[number].splits[child][None])[:, 0]
                    near, far = asks.annuli()
                    meets = np.flatnonzero(~((own - far > row["b_high"]) | (own + far < row["b_low"]) | (own + row["b_high"] < near)))
                known = Rows(row["b_ids"], row["b_rows"], row["b_labels"], row["b_vectors"], space)
                a, x, s = known.best(asks, meets, k)
                ids = known.ids[x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asks.rows[a]), pa.array(asks.parts[a]), pa.array(ids, mask=ids == _LAST), pa.array(known.rows[x]), pa.array(s)],
                    names=["row", "part", "vec_id", "found", "score"],
                )

    return search


_ASK = ["row", "part", "label", "same", "low", "high", "last", "v"]


class HyperplaneTree:
    """The index over usable rows (row, vec_id, label, v, norm)."""

    def __init__(self, points: DataFrame, dim: int, k: int = K):
        self.k, self.points = k, points
        count, most = points.agg(F.count(F.lit(1)), F.coalesce(F.max("norm"), F.lit(0.0))).first()
        self.space = Space(dim, most, most < 2.0**53, 1e-6 * math.sqrt(most) + 1e-3)
        taken = sample_rows(points, min(SAMPLE_ROWS, max(1, SAMPLE_BYTES // (8 * dim))), "row").collect()
        self.sample = {
            "ids": np.array([_LAST if r["vec_id"] is None else r["vec_id"] for r in taken], "<i8").tobytes(),
            "rows": np.array([r["row"] for r in taken], "<i8").tobytes(),
            "labels": np.array([r["label"] for r in taken], "<i8").tobytes(),
            "vectors": b"".join(bytes(r["v"]) for r in taken),
        }
        sampled = self.space.lifted(self.space.matrix([bytes(r["v"]) for r in taken]))
        leaves = max(1, min(math.ceil(count / LEAF_ROWS), SAMPLE_ROWS // 8))
        levels = max(1, math.ceil(math.log(leaves) / math.log(WAYS) - 1e-9))
        self.tree = Tree(sampled, max(1, math.ceil(leaves ** (1 / levels) - 1e-9)), levels)

        alike = Window.partitionBy("label", "v").orderBy(F.asc_nulls_last("vec_id"), "row")
        indexed = points.withColumn("_n", F.row_number().over(alike)).where(F.col("_n") <= k + 1).drop("_n")
        keep = ["row", "vec_id", "label", "v"]
        placed = indexed.mapInArrow(_placer(self.tree, self.space, False, keep), "leaf long, r double, row long, vec_id long, label long, v binary")
        order = ["leaf", "r", F.asc_nulls_last("vec_id"), "row"]
        ranged = placed.repartitionByRange(max(1, math.ceil(count / LEAF_ROWS)), *order).sortWithinPartitions(*order)
        self.buckets = materialize(ranged.mapInArrow(_bucketer(LEAF_ROWS), _BUCKET), "buckets")
        measured = self.buckets.select("leaf", "vectors").mapInArrow(_ranger(self.tree, self.space), _RANGE)
        sides = measured.select("node", "child", F.posexplode(F.arrays_zip("lows", "highs")).alias("split", "d"))
        # at most one row per split point and sibling of the tree, whose size is bounded
        ranges = sides.groupBy("node", "child", "split").agg(F.min("d.lows").alias("low"), F.max("d.highs").alias("high"))
        self.tree.set_ranges(ranges.collect())

    def _blocks(self, asks: DataFrame, count: int) -> DataFrame:
        kinds = "leaf long, r double, row long, part long, label long, same boolean, low long, high long, last long, v binary"
        placed = asks.select(*_ASK).mapInArrow(_placer(self.tree, self.space, True, _ASK), kinds)
        order = ["leaf", "r", "row", "part"]
        ranged = placed.repartitionByRange(max(1, math.ceil(count / ASKS_AT_ONCE)), *order).sortWithinPartitions(*order)
        return materialize(ranged.mapInArrow(_packer(self.sample, self.space, self.k), _BLOCK), "asks")

    def _search(self, blocks: DataFrame, home: bool) -> DataFrame:
        reach = blocks.mapInArrow(_visitor(self.tree, self.space, home), "block long, leaf long, near double, far double")
        directory = self.buckets.select("leaf", "bucket", "low", "high")
        pairs = reach.join(directory, "leaf").where("not (near > high or far < low)").select("block", "leaf", "bucket")
        if home:  # one bucket of the leaf will do
            pairs = pairs.groupBy("block", "leaf").agg(F.min("bucket").alias("bucket"))
        held = self.buckets.select("bucket", *[F.col(c).alias(f"b_{c}") for c in ("low", "high", "ids", "rows", "labels", "vectors")])
        met = pairs.join(blocks, "block").join(held, "bucket")
        found = met.mapInArrow(_searcher(self.tree, self.space, self.k, home), _FOUND)
        first = Window.partitionBy("row", "part").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "found")
        return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= self.k)

    def search(self, asks: DataFrame) -> DataFrame:
        """(row, part, rank, vec_id, found, score) of the first k rows of each ask.

        An ask is (row, part, label, same, low, high, v): rows of the same label, or of
        all others, whose score lies in [low, high]; its own row does not count.
        """
        asks = materialize(asks.withColumn("last", F.lit(int(_LAST)).cast("long")), "asks")
        count = asks.count()
        near = self._search(self._blocks(asks, count), home=True).where(F.col("rank") == self.k)
        bounds = materialize(near.select("row", "part", F.col("score").alias("_low"), F.coalesce("vec_id", F.lit(int(_LAST))).alias("_last")), "bounds")
        narrowed = asks.join(bounds, ["row", "part"], "left").withColumn("last", F.coalesce("_last", "last")).withColumn("low", F.coalesce("_low", "low"))
        return self._search(self._blocks(narrowed, count), home=False)


def usable_points(vectors: DataFrame, label: Column, scale: int, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """(written rows that take part, number of components)."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector_column).cast("array<double>").alias("vector"))
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("label").isNotNull() & v.isNotNull() & ~odd)
    dim = max(1, rows.agg(F.max(F.size("vector"))).first()[0] or 1)
    scaled = rows.mapInArrow(_scaler(dim, scale), _POINT)
    return materialize(scaled.withColumn("row", F.monotonically_increasing_id()), "points"), dim


def mine(
    vectors: DataFrame,
    label: Column | None = None,
    k: int = K,
    anchor_step: int = ANCHOR_STEP,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    points, dim = usable_points(vectors, label if label is not None else F.col("label"), scale, id_column, vector_column)
    index = HyperplaneTree(points, dim, k)
    anchors = points.where(F.col("vec_id") % anchor_step == 0)
    bound = lambda x: F.lit(int(x)).cast("long")
    first = index.search(anchors.select("row", bound(0).alias("part"), "label", F.lit(True).alias("same"), bound(_LEAST).alias("low"), bound(_MOST).alias("high"), "v"))
    positives = materialize(
        first.join(anchors.select("row", "label", "v", F.col("vec_id").alias("anchor_id")), "row").select(
            "row", F.col("rank").cast("long").alias("part"), "label", "v", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        ),
        "positives",
    )
    # the least whole number not below 4/5 of a score; a negative score has no window
    least = F.expr(f"positive_score - positive_score div {LOWER[1]} * {LOWER[1] - LOWER[0]} - positive_score % {LOWER[1]} * {LOWER[1] - LOWER[0]} div {LOWER[1]}")
    asks = positives.where("positive_score >= 0").select(
        "row", "part", "label", F.lit(False).alias("same"), least.alias("low"), F.col("positive_score").alias("high"), "v"
    )
    negatives = index.search(asks).select("row", "part", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = positives.select("row", "part", "anchor_id", "positive_id", "positive_score")
    return negatives.join(named, ["row", "part"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def shifted_label(label: str = "label", vec_id: str = "vec_id") -> Column:
    """The label, moved on by one (of ten) where 7 divides the id."""
    value = F.col(label).cast("long")
    moved = F.coalesce(F.col(vec_id) % RELABEL_STEP == 0, F.lit(False))
    return F.when(moved, (value + 1) % LABELS).otherwise(value)
