"""Exact top-k by inner product over a pivot-distance index.

Vectors are scaled to integers.  With the largest norm M, x gets one more
component sqrt(M^2 - |x|^2) and a query q a zero there; then the squared distance
is |q|^2 + M^2 - 2 q.x, so the best inner products are the nearest points.

Index: each point is keyed by its nearest pivot and its distance r to it, and
the table is range-partitioned and sorted by (pivot, r).  Runs of up to
``RING_ROWS`` points of one pivot make an annulus (a ring with its least and
largest r).  Pivots are fitted on a bounded sample (``SAMPLE_ROWS``), every row is
indexed, and a frequent vector spreads over several rings.

Search: a query starts in the ring that holds its own row, whose k-th best score
bounds the rest: by the triangle inequality |d(q, p) - r| is at most d(q, x), so
rings beyond the distance of that score are never visited.  Queries go in
blocks; (block, ring) pairs come from an equi-join on the pivot.  Within a pair
the bound is applied again per query.

Rows take no part if the vector is null or holds a null or non-finite component.
Shorter vectors are filled with zeros.  Repeated rows are candidates each; a
query's own row is not.  Ties go to the smaller vec_id (null last), then to the
earlier stored row.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from flightlake.operators.sizing import sample_rows
from flightlake.session import materialize

SCALE = 64
K = 20
QUERY_STEP = 20
RING_ROWS = 4096
PIVOTS = 32
SAMPLE_ROWS = 4000
QUERIES_AT_ONCE = 256

_NONE = np.iinfo(np.int64).max


def _matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), "<i8").reshape(len(blobs), dim)


def _scores(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Integer inner products, through floating point where that is exact."""
    reach = max(1, int(np.abs(queries).max(initial=0))) * max(1, int(np.abs(points).max(initial=0))) * points.shape[1]
    if reach < 1 << 53:
        return (queries.astype(np.float64) @ points.T.astype(np.float64)).astype(np.int64)
    return queries @ points.T


def _scaler(dim: int, scale: int):
    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors, norms = [], [], []
            for vec_id, values in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist()):
                ints = np.zeros(dim, "<i8")
                ints[: len(values)] = np.floor(scale * np.asarray(values, np.float64))
                ids.append(vec_id)
                vectors.append(ints.tobytes())
                norms.append(int(ints @ ints))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(vectors, pa.binary()), pa.array(norms, pa.int64())], names=["vec_id", "v", "norm"]
            )

    return scaled


def fit_pivots(points: np.ndarray, count: int, rounds: int = 4) -> np.ndarray:
    """Centres of a few k-means rounds from evenly spaced points of the sample."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    centers = points[np.linspace(0, len(points) - 1, min(count, len(points))).astype(int)].copy()
    for _ in range(rounds):
        near = _distances(points, centers).argmin(1)
        for c in np.unique(near):
            centers[c] = points[near == c].mean(0)
    return np.unique(centers, axis=0)


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (centers**2).sum(1) - 2 * points @ centers.T
    return np.sqrt(np.maximum(square, 0))


def _lifted(vectors: np.ndarray, most: int) -> np.ndarray:
    """Points with the component that makes all norms equal."""
    points = vectors.astype(np.float64)
    rest = np.sqrt(np.maximum(most - (points**2).sum(1), 0))
    return np.column_stack([points, rest])


def _keyer(pivots: np.ndarray, dim: int, most: int):
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = _distances(_lifted(_matrix(batch.column("v").to_pylist(), dim), most), pivots)
            cell = far.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int32()), pa.array(far[np.arange(len(cell)), cell]), *(batch.column(c) for c in ("row", "vec_id", "v"))],
                names=["cell", "r", "row", "vec_id", "v"],
            )

    return key


_RING = "ring long, cell int, low double, high double, ids binary, rows binary, vectors binary"


def _ringer(limit: int):
    """Pack a sorted partition into rings."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, held = TaskContext.get().partitionId(), 0, []

        def ring() -> pa.RecordBatch:
            ids = np.array([_NONE if h[3] is None else h[3] for h in held], "<i8")
            rows = np.array([h[2] for h in held], "<i8")
            values = [(task << 32) + number], [held[0][0]], [held[0][1]], [held[-1][1]], [ids.tobytes()], [rows.tobytes()], [b"".join(h[4] for h in held)]
            kinds = pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["ring", "cell", "low", "high", "ids", "rows", "vectors"])

        for batch in batches:
            for point in zip(*(batch.column(c).to_pylist() for c in ("cell", "r", "row", "vec_id", "v"))):
                if held and (held[0][0] != point[0] or len(held) >= limit):
                    yield ring()
                    number, held = number + 1, []
                held.append(point)
        if held:
            yield ring()

    return pack


class Ring:
    def __init__(self, ids: bytes, rows: bytes, vectors: bytes, dim: int):
        self.ids = np.frombuffer(ids, "<i8")
        self.rows = np.frombuffer(rows, "<i8")
        self.vectors = np.frombuffer(vectors, "<i8").reshape(len(self.ids), dim)

    def best(self, queries: np.ndarray, own: np.ndarray, score: np.ndarray, last: np.ndarray, k: int):
        """(query, point, score), best first, of each query's k best points that do
        not fall behind (score, last id); ``own`` names the queries' own rows."""
        got = _scores(queries, self.vectors)
        ok = (got > score[:, None]) | ((got == score[:, None]) & (self.ids <= last[:, None]))
        ok &= self.rows != own[:, None]
        q, x = np.nonzero(ok)
        s = got[q, x]
        order = np.lexsort((self.rows[x], self.ids[x], -s, q))
        q, x, s = q[order], x[order], s[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        keep = rank < k
        return q[keep], x[keep], s[keep]


def _starter(dim: int, step: int, k: int):
    """The queries of each ring, with the bound that the ring itself gives."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ring = Ring(row["ids"], row["rows"], row["vectors"], dim)
                chosen = np.flatnonzero((ring.ids % step == 0) & (ring.ids != _NONE))
                for a in range(0, len(chosen), QUERIES_AT_ONCE):
                    part = chosen[a : a + QUERIES_AT_ONCE]
                    score = np.full(len(part), np.iinfo(np.int64).min)
                    last = np.full(len(part), _NONE)
                    q, x, s = ring.best(ring.vectors[part], ring.rows[part], score, last, k)
                    ends = np.flatnonzero(np.append(q[1:] != q[:-1], True)) if len(q) else np.zeros(0, int)
                    full = ends[np.diff(np.concatenate([[-1], ends])) == k]
                    score[q[full]], last[q[full]] = s[full], ring.ids[x[full]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["ring"]], pa.int64()),
                            *(pa.array([v.astype("<i8").tobytes()], pa.binary()) for v in (ring.ids[part], ring.rows[part], ring.vectors[part], score, last)),
                        ],
                        names=["ring", "ids", "rows", "vectors", "score", "last"],
                    )

    return start


_BLOCK = "ring long, ids binary, rows binary, vectors binary, score binary, last binary"


def _distance_bound(vectors: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """How far a point may lie that still reaches each query's score."""
    norm = (vectors.astype(np.float64) ** 2).sum(1)
    square = norm + most - 2 * score.astype(np.float64)
    # a little more, for rounding
    return np.sqrt(np.maximum(square, 0)) * (1 + 1e-9) + 1e-3


def _reacher(pivots: np.ndarray, dim: int, most: int):
    """Per block and pivot, the distances from the pivot that some query must look at."""

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                vectors = np.frombuffer(row["vectors"], "<i8").reshape(-1, dim)
                bound = _distance_bound(vectors, np.frombuffer(row["score"], "<i8"), most)[:, None]
                far = _distances(np.column_stack([vectors.astype(np.float64), np.zeros(len(vectors))]), pivots)
                low, high = (far - bound).min(0), (far + bound).max(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(pivots), pa.int64()), pa.array(range(len(pivots)), pa.int32()), pa.array(low), pa.array(high)],
                    names=["block", "cell", "near", "far"],
                )

    return reach


def _searcher(pivots: np.ndarray, dim: int, most: int, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ring = Ring(row["ids"], row["rows"], row["vectors"], dim)
                vectors = np.frombuffer(row["q_vectors"], "<i8").reshape(-1, dim)
                ids, own, score, last = (np.frombuffer(row[c], "<i8") for c in ("q_ids", "q_rows", "score", "last"))
                far = _distances(np.column_stack([vectors.astype(np.float64), np.zeros(len(vectors))]), pivots[row["cell"]][None])[:, 0]
                bound = _distance_bound(vectors, score, most)
                meets = np.flatnonzero((far - bound <= row["high"]) & (far + bound >= row["low"]))
                for a in range(0, len(meets), QUERIES_AT_ONCE):
                    part = meets[a : a + QUERIES_AT_ONCE]
                    q, x, s = ring.best(vectors[part], own[part], score[part], last[part], k)
                    q = part[q]
                    vec = pa.array(ring.ids[x], mask=ring.ids[x] == _NONE)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[q]), pa.array(own[q]), vec, pa.array(ring.rows[x]), pa.array(s)],
                        names=["query_id", "query_row", "vec_id", "row", "score"],
                    )

    return search


def top_k(
    vectors: DataFrame,
    k: int = K,
    query_step: int = QUERY_STEP,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The k best rows of each row whose id is divisible by ``query_step``."""
    v = F.col("vector")
    usable = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector"))
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = usable.where(v.isNotNull() & ~odd)
    dim = max(1, usable.agg(F.max(F.size("vector"))).first()[0] or 1)
    scaled = usable.mapInArrow(_scaler(dim, scale), "vec_id long, v binary, norm long")
    points = materialize(scaled.withColumn("row", F.monotonically_increasing_id()), "points")
    count, most = points.agg(F.count(F.lit(1)), F.coalesce(F.max("norm"), F.lit(0))).first()
    sample = sample_rows(points, SAMPLE_ROWS, "row").select("v").collect()
    pivots = fit_pivots(_lifted(_matrix([bytes(r["v"]) for r in sample], dim), most), PIVOTS)

    keyed = points.mapInArrow(_keyer(pivots, dim, most), "cell int, r double, row long, vec_id long, v binary")
    parts = max(1, math.ceil(count / RING_ROWS))
    ranged = keyed.repartitionByRange(parts, "cell", "r", "row").sortWithinPartitions("cell", "r", "row")
    rings = materialize(ranged.mapInArrow(_ringer(RING_ROWS), _RING), "rings")

    started = rings.select("ring", "ids", "rows", "vectors").mapInArrow(_starter(dim, query_step, k), _BLOCK)
    blocks = materialize(started.withColumn("block", F.monotonically_increasing_id()), "queries")
    reach = blocks.mapInArrow(_reacher(pivots, dim, most), "block long, cell int, near double, far double")
    directory = rings.select("ring", "cell", "low", "high")
    pairs = reach.join(directory, "cell").where("near <= high AND far >= low").select("block", "ring")
    asked = blocks.select(
        "block", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("vectors").alias("q_vectors"), "score", "last"
    )
    met = pairs.join(asked, "block").join(rings, "ring")
    found = met.mapInArrow(
        _searcher(pivots, dim, most, k), "query_id long, query_row long, vec_id long, row long, score long"
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
