"""Spark's random forest, grown level by level from counts that numpy makes per piece of rows.

The rows are binned once and dealt to pieces of ten bytes a row.  For each level, every
piece counts its rows per tree, open node, drawn feature, bin and class; the counts of a
few nodes meet in one task, which finds their best splits.  Only splits reach the driver.
The trees become a model of Spark's own, which scores, saves and loads as any other.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.classification import RandomForestClassifier as SparkForest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.session import scratch_dir

# Executors get the functions below with each task, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Candidate thresholds come from this many quantiles of all rows.
QUANTILES = 1000

# Rows that a task collects before it deals them to pieces.
_BUFFER_ROWS = 1 << 20
# Rows that are walked down a tree at a time: their arrays stay in the processor's cache.
_WALK_ROWS = 1 << 15
# Nodes whose counts meet in one group.
_BLOCK_NODES = 64
# A leaf's threshold: no bin is above it.
_STAY = 255

# How often a bagged row is drawn, Poisson(1) to 1 / 65536, looked up by 16 random bits.
_POISSON = np.repeat(
    np.arange(9, dtype=np.uint8),
    np.diff(np.floor(np.concatenate([[0], np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 8)])), [1]]) * 65536 + 0.5).astype(int)),
)


def thresholds(df: DataFrame, columns: list[str], bins: int) -> list[np.ndarray]:
    """Per column at most ``bins`` - 1 ascending thresholds: between all values if they are few, else at quantiles."""
    share = [i / QUANTILES for i in range(QUANTILES + 1)]
    found = df.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), share, 10 * QUANTILES).alias(c) for c in columns]).first()
    return [_cuts(np.array(found[c] or [], float), bins) for c in columns]


def _cuts(quantiles: np.ndarray, bins: int) -> np.ndarray:
    values, counts = np.unique(quantiles, return_counts=True)
    middles = (values[:-1] + values[1:]) / 2
    if len(values) <= bins:
        return middles
    # The last value whose share of the rows below it is nearest to each step.
    below = np.cumsum(counts)[:-1]
    steps = np.arange(1, bins) * len(quantiles) / bins
    right = np.clip(np.searchsorted(below, steps), 1, len(below) - 1)
    nearest = np.where(steps - below[right - 1] < below[right] - steps, right - 1, right)
    return middles[np.unique(nearest)]


def deal(df: DataFrame, columns: list[str], label: str, edges: list[np.ndarray], pieces: int) -> DataFrame:
    """The binned rows as (piece, rows), one row per piece; which rows a piece holds, and their order, depends on the rows alone."""

    def cut(parts: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(parts)
        piece = _hashed(rows) % np.uint64(pieces)
        order = np.argsort(piece, kind="stable")
        found, firsts = np.unique(piece[order], return_index=True)
        blobs = [part.tobytes() for part in np.split(rows[order], firsts[1:])]
        return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(blobs, pa.binary())], ["piece", "rows"])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        for batch in batches:
            rows = np.empty((batch.num_rows, len(columns) + 1), np.uint8)
            for i, edge in enumerate(edges):
                rows[:, i] = np.searchsorted(edge, batch.column(i).to_numpy(zero_copy_only=False))
            classes = batch.column(len(columns)).to_numpy(zero_copy_only=False)
            rows[:, -1] = classes
            if (rows[:, -1] != classes).any():
                raise ValueError("labels must be whole numbers from 0 to 255")
            parts.append(rows)
            if sum(map(len, parts)) >= _BUFFER_ROWS:
                yield cut(parts)
                parts = []
        if sum(map(len, parts)):
            yield cut(parts)

    def put_together(table: pa.Table) -> pa.Table:
        width = len(columns) + 1
        rows = np.frombuffer(b"".join(table.column("rows").to_pylist()), f"S{width}")
        return pa.table({"piece": table.column("piece").slice(0, 1), "rows": pa.array([np.sort(rows).tobytes()], pa.binary())})

    schema = "piece int, rows binary"
    cells = df.select(*[F.col(c).cast("double") for c in columns], F.col(label).cast("double"))
    return cells.mapInArrow(binned, schema).groupBy("piece").applyInArrow(put_together, schema)


def _hashed(rows: np.ndarray) -> np.ndarray:
    found = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        found = (found ^ column) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return found


@dataclass
class Tree:
    """Nodes in arrays, children next to each other after their parent; a leaf has no left child (0)."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    stats: np.ndarray
    open: np.ndarray

    @classmethod
    def root(cls, classes: int) -> Tree:
        feature, cut, left, first = np.zeros((4, 1), np.int64)
        return cls(feature, cut, left, np.full(1, -1.0), np.zeros((1, classes)), first)

    def steps(self) -> np.ndarray:
        """Per node feature, threshold bin and left child in one number; a leaf leads to itself."""
        leaf = self.left == 0
        left = np.where(leaf, np.arange(len(leaf)), self.left)
        return left << 16 | np.where(leaf, _STAY, self.bin) << 8 | self.feature

    def split(self, drawn: np.ndarray, best: np.ndarray, least_gain: float, last: bool) -> None:
        """Take in the best splits of the open nodes and open their children."""
        classes = self.stats.shape[1]
        where, cut, gain = best[:, 0].astype(int), best[:, 1].astype(int), best[:, 2]
        left, total = best[:, 3 : 3 + classes], best[:, 3 + classes :]
        self.stats[self.open] = total
        cut_now = np.flatnonzero((gain > 0) & (gain >= least_gain))
        nodes, first = self.open[cut_now], len(self.left)
        self.left[nodes] = first + 2 * np.arange(len(nodes))
        self.feature[nodes], self.bin[nodes], self.gain[nodes] = drawn[cut_now, where[cut_now]], cut[cut_now], gain[cut_now]
        stats = np.stack([left[cut_now], total[cut_now] - left[cut_now]], axis=1).reshape(-1, classes)
        more = np.zeros(len(stats), np.int64)
        self.feature, self.bin, self.left = (np.concatenate([a, more]) for a in (self.feature, self.bin, self.left))
        self.gain = np.concatenate([self.gain, np.full(len(stats), -1.0)])
        self.stats = np.concatenate([self.stats, stats])
        mixed = (stats > 0).sum(axis=1) > 1
        self.open = first + np.flatnonzero(mixed & (not last))

    def pruned(self) -> Tree:
        """Without splits whose leaves name the same class, as Spark leaves them out; nodes numbered anew."""
        left, named = self.left.copy(), self.stats.argmax(axis=1)
        while True:
            inner = np.flatnonzero(left)
            a = left[inner]
            alike = inner[(left[a] == 0) & (left[a + 1] == 0) & (named[a] == named[a + 1])]
            if not len(alike):
                break
            left[alike] = 0
        levels = [np.zeros(1, np.int64)]
        while len(levels[-1]):
            a = left[levels[-1]]
            a = a[a > 0]
            levels.append(np.stack([a, a + 1], axis=1).ravel())
        kept = np.concatenate(levels)
        place = np.zeros(len(left), np.int64)
        place[kept] = np.arange(len(kept))
        left = place[left[kept]]
        gain = np.where(left > 0, self.gain[kept], -1.0)
        return Tree(self.feature[kept], self.bin[kept], left, gain, self.stats[kept], np.zeros(0, np.int64))


@dataclass
class Growing:
    """What a task needs to count for the open nodes of one tree."""

    number: int
    depth: int
    steps: np.ndarray
    # Per node its place among the open ones, or -1.
    slot: np.ndarray
    # Per open node its drawn features.
    drawn: np.ndarray


def count_rows(rows: np.ndarray, piece: int, tree: Growing, bins: int, classes: int, seed: int, bag: bool) -> np.ndarray:
    """Drawn rows of a piece per open node, drawn feature, bin and class."""
    n, width = rows.shape
    flat = rows.ravel()
    times = np.ones(n, np.uint8)
    if bag:
        draws = np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFFFFFFFFFF, tree.number, piece]))
        times = _POISSON[draws.integers(0, 65536, n, np.uint16)]
    drawn = np.ascontiguousarray(tree.drawn.T)
    keys, weights = [], []
    for begin in range(0, n, _WALK_ROWS):
        part = times[begin : begin + _WALK_ROWS]
        base = np.flatnonzero(part)
        weight = part[base]
        base = (base + begin) * width
        node = np.zeros(len(base), np.int64)
        for _ in range(tree.depth):
            step = tree.steps.take(node)
            node = step >> 16
            node += flat.take(base + (step & 255)) > (step >> 8 & 255)
        slot = tree.slot.take(node)
        if (slot < 0).any():
            still = np.flatnonzero(slot >= 0)
            slot, base, weight = slot[still], base[still], weight[still]
        label = flat.take(base + (width - 1))
        cell = slot * (len(drawn) * bins)
        for i, features in enumerate(drawn):
            keys.append((cell + i * bins + flat.take(base + features.take(slot))) * classes + label)
            weights.append(weight)
    cells = len(tree.drawn) * len(drawn) * bins * classes
    return np.bincount(np.concatenate(keys), np.concatenate(weights), cells) if keys else np.zeros(cells)


def _narrow(counts: np.ndarray) -> bytes:
    """The counts in as few bytes each as they need."""
    top = counts.max(initial=0)
    return counts.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32).tobytes()


def _wide(blob: bytes, cells: int) -> np.ndarray:
    return np.frombuffer(blob, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(blob) // cells])


def best_splits(counts: np.ndarray, least_rows: int) -> np.ndarray:
    """Per node the place of the best drawn feature, its bin, the Gini gain, and rows per class left and together.

    ``counts`` has the axes node, drawn feature, bin and class.
    """
    left = counts.cumsum(axis=2, dtype=np.int64).astype(float)
    total = left[:, 0, -1]
    left = left[:, :, :-1]
    right = total[:, None, None] - left
    n, nl, nr = total.sum(-1), left.sum(-1), right.sum(-1)

    def purity(stats: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return (stats * stats).sum(-1) / np.maximum(rows, 1)

    gain = (purity(left, nl) + purity(right, nr) - purity(total, n)[:, None, None]) / np.maximum(n, 1)[:, None, None]
    gain = np.where((nl >= least_rows) & (nr >= least_rows), gain, -1.0).reshape(len(counts), -1)
    best = gain.argmax(axis=1)
    at = np.arange(len(counts))
    where, cut = np.divmod(best, left.shape[2])
    return np.column_stack([where, cut, gain[at, best], left[at, where, cut], total])


def _level(
    pieces: DataFrame, width: int, growing: list[Growing], bins: int, classes: int, seed: int, bag: bool, least_rows: int
) -> dict[int, np.ndarray]:
    """Per tree the best splits of its open nodes, in their order."""
    per_node = growing[0].drawn.shape[1] * bins * classes
    opened = {t.number: len(t.drawn) for t in growing}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = np.frombuffer(blob.as_buffer(), np.uint8).reshape(-1, width)
                for tree in growing:
                    counts = count_rows(rows, piece, tree, bins, classes, seed, bag)
                    blocks = [_narrow(counts[i : i + _BLOCK_NODES * per_node]) for i in range(0, len(counts), _BLOCK_NODES * per_node)]
                    number = np.full(len(blocks), tree.number, np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(np.arange(len(blocks), dtype=np.int32)), pa.array(blocks, pa.binary())], ["tree", "block", "counts"])

    def settle(table: pa.Table) -> pa.Table:
        tree, block = table.column("tree")[0].as_py(), table.column("block")[0].as_py()
        cells = min(_BLOCK_NODES, opened[tree] - block * _BLOCK_NODES) * per_node
        total = np.zeros(cells, np.int64)
        for blob in table.column("counts"):
            total += _wide(blob.as_buffer(), cells)
        best = best_splits(total.reshape(-1, per_node // (bins * classes), bins, classes), least_rows)
        return pa.table({"tree": pa.array([tree], pa.int32()), "block": pa.array([block], pa.int32()), "best": pa.array([best.tobytes()], pa.binary())})

    counted = pieces.mapInArrow(count, "tree int, block int, counts binary")
    found = counted.groupBy("tree", "block").applyInArrow(settle, "tree int, block int, best binary").collect()
    by_tree: dict[int, list] = {t.number: [] for t in growing}
    for row in sorted(found, key=lambda r: (r["tree"], r["block"])):
        by_tree[row["tree"]].append(np.frombuffer(bytes(row["best"])).reshape(-1, 3 + 2 * classes))
    return {number: np.concatenate(parts) for number, parts in by_tree.items()}


class RandomForestClassifier(SparkForest):
    """Spark's estimator with Spark's parameters; ``fit`` takes the pieces that :func:`deal` made of binned rows.

    Trees see each row by Poisson(1), or once where a single tree takes all features, as in Spark.
    """

    def __init__(self, edges: list[np.ndarray], classes: int, **params):
        super().__init__(**params)
        if self.getImpurity() != "gini" or self.getSubsamplingRate() != 1.0 or not self.getBootstrap():
            raise ValueError("only Gini impurity and plain bagging")
        if classes > 255 or self.getMaxBins() > _STAY:
            raise ValueError("at most 255 classes and bins")
        self.edges, self.classes = edges, classes

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        trees = [tree.pruned() for tree in self._grow(dataset)]
        return _as_model(self, trees, dataset.sparkSession)

    def _features_per_node(self) -> int:
        every, strategy = len(self.edges), self.getFeatureSubsetStrategy()
        if strategy == "all" or (strategy == "auto" and self.getNumTrees() == 1):
            return every
        if strategy not in ("auto", "sqrt"):
            raise ValueError("features per node: auto, sqrt or all")
        return int(np.ceil(np.sqrt(every)))

    def _grow(self, pieces: DataFrame) -> list[Tree]:
        every, some, seed = len(self.edges), self._features_per_node(), self.getSeed()
        bins = max(2, 1 + max(map(len, self.edges)))
        bag = self.getNumTrees() > 1 or some < every
        trees = [Tree.root(self.classes) for _ in range(self.getNumTrees())]
        for depth in range(self.getMaxDepth()):
            growing = []
            for number, tree in enumerate(trees):
                if len(tree.open):
                    draw = np.random.default_rng([seed & 0xFFFFFFFFFFFFFFFF, number, depth])
                    drawn = draw.permuted(np.tile(np.arange(every), (len(tree.open), 1)), axis=1)[:, :some]
                    slot = np.full(len(tree.left), -1)
                    slot[tree.open] = np.arange(len(tree.open))
                    growing.append(Growing(number, depth, tree.steps(), slot, drawn))
            if not growing:
                break
            best = _level(pieces, every + 1, growing, bins, self.classes, seed, bag, self.getMinInstancesPerNode())
            for tree in growing:
                trees[tree.number].split(tree.drawn, best[tree.number], self.getMinInfoGain(), depth + 1 == self.getMaxDepth())
        return trees


def _as_model(estimator: RandomForestClassifier, trees: list[Tree], spark: SparkSession) -> RandomForestClassificationModel:
    """Spark's model of these trees, through the files in which Spark saves one."""
    path = scratch_dir(spark, "forest")
    estimator.write().save(f"{path}/estimator")
    saved = json.loads(spark.read.text(f"{path}/estimator/metadata").first()[0])
    of_tree = {"featuresCol", "labelCol", "predictionCol", "probabilityCol", "rawPredictionCol", "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "impurity", "seed"}

    def metadata(kind: str, uid: str, wanted: set[str] | None, **more) -> str:
        params = {k: {p: v for p, v in saved[k].items() if wanted is None or p in wanted} for k in ("paramMap", "defaultParamMap")}
        return json.dumps({**saved, **params, "class": f"org.apache.spark.ml.classification.{kind}", "uid": uid, **more})

    size = {"numFeatures": len(estimator.edges), "numClasses": estimator.classes}
    forest = metadata("RandomForestClassificationModel", saved["uid"], None, **size, numTrees=len(trees))
    spark.createDataFrame([(forest,)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    about = [(i, metadata("DecisionTreeClassificationModel", f"{saved['uid']}_{i}", of_tree, **size), 1.0) for i in range(len(trees))]
    spark.createDataFrame(about, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    nodes = pa.concat_tables([_nodes(i, tree, estimator.edges) for i, tree in enumerate(trees)])
    spark.createDataFrame(nodes).write.parquet(f"{path}/model/data")
    return RandomForestClassificationModel.load(f"{path}/model")


def _nodes(number: int, tree: Tree, edges: list[np.ndarray]) -> pa.Table:
    """A tree's nodes as Spark saves them."""
    n, leaf = len(tree.left), tree.left == 0
    rows = tree.stats.sum(axis=1)
    shares = tree.stats / np.maximum(rows, 1)[:, None]
    inner = np.flatnonzero(~leaf)
    cuts = np.array([edges[f][b] for f, b in zip(tree.feature[inner], tree.bin[inner])], float)
    split = pa.StructArray.from_arrays(
        [
            pa.array(np.where(leaf, -1, tree.feature).astype(np.int32)),
            pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(~leaf)]).astype(np.int32), cuts),
            pa.array(np.full(n, -1, np.int32)),
        ],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
    )
    node = {
        "id": np.arange(n, dtype=np.int32),
        "prediction": tree.stats.argmax(axis=1).astype(float),
        "impurity": np.where(rows > 0, 1 - (shares * shares).sum(axis=1), 0.0),
        "impurityStats": pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * tree.stats.shape[1], tree.stats.ravel()),
        "rawCount": rows.astype(np.int64),
        "gain": tree.gain,
        "leftChild": np.where(leaf, -1, tree.left).astype(np.int32),
        "rightChild": np.where(leaf, -1, tree.left + 1).astype(np.int32),
        "split": split,
    }
    data = pa.StructArray.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in node.values()], list(node))
    return pa.table({"treeID": pa.array(np.full(n, number, np.int32)), "nodeData": data})
