"""Quality rules: base counts, and robust multivariate outliers per language and source.

Each text gives a vector of transformed statistics (log word length; square
roots of the shares of symbols, repeated words, upper case, punctuation,
stuttered words and lines seen before, without those that lie in repeated words),
shrunk towards its group's centre where the text is short.  Per (language, source) the minimum-covariance-determinant
estimate is sought by concentration: take mean and covariance of the half of
rows that lie nearest, repeat.  Three starts (medians, shortest halves, lower
quartiles) take ``STARTING_STEPS`` steps, the one with the least determinant goes
on until its determinant no longer falls.  The starts lie among the rows' middle:
a tight cluster of just under half the rows, whose determinant may be less still,
is not looked for.  Mean and covariance of all rows within
the quantile ``INNER`` of that estimate are then the final one, and a row whose
Mahalanobis distance is beyond the quantile of ``TAIL`` is rejected.  Covariances
have the squares of ``FLOOR`` added, also where determinants are compared.

All texts enter all estimates; equal vectors of one group count once, so that a
text copied many times does not make outliers of the others.  A step is one
aggregation by (group, start, distance bin): sums within a bin are enough to find
the nearest half and its moments, so no row is sorted or gathered, and a source
with a third of all rows is combined before the shuffle.  Every group is judged
by its own centre, however small it is.  Its covariance C of n vectors is shrunk
towards that P of its language, (n C + ``PRIOR_ROWS`` P) / (n + ``PRIOR_ROWS``), and a
language's in the same way towards the mean covariance within languages (weights n).

Words are maximal runs without space and 0x09-0x0D.  Null text has no words and
fails the base rules, as does an empty one; null languages and sources form
groups of their own; an empty table gives an empty result.  Other columns stay;
``judge_documents`` replaces a column named as a result column, ``keep_good`` leaves
columns of every name as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.llm import words as W
from flightlake.llm.arrow import slices, utf8_view
from flightlake.operators.sizing import broadcast_if_small
from flightlake.session import materialize

LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of the words
REPEAT_WINDOW = 8
STARTING_STEPS = 2
SETTLED = 1e-2  # least fall of a log determinant that counts
INNER = 0.975
TAIL = 2.5e-5
PRIOR_ROWS = 200  # rows that a parent's covariance counts as
SHRINK_WORDS = 20
DIMENSIONS = 7
# Least standard deviation of each statistic: what a clean text may vary by even
# where a group's texts are all alike (word length, symbols, repeats, upper case,
# punctuation, stutter, lines seen before).
FLOOR = (0.05, 0.1, 0.1, 0.03, 0.08, 0.1, 0.1)

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_MARK = np.isin(np.arange(256), np.frombuffer(b".,;:!?", np.uint8))
_HEAD = (np.arange(256) & 0xC0) != 0x80  # not a UTF-8 continuation byte
_STATS = T.StructType([T.StructField(c, T.LongType()) for c in _COUNTS] + [T.StructField("x", T.ArrayType(T.DoubleType()))])


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _line_counts(data: np.ndarray, offsets: np.ndarray, words: W.Words, repeated: np.ndarray) -> list[np.ndarray]:
    """Per text: lines with a word; those that equal an earlier line of the text; those of the latter with a word not ``repeated``."""
    breaks = np.flatnonzero(data == 10)
    begins = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([offsets[1:], breaks])
    begins, ends = np.sort(begins), np.sort(ends)
    signs = np.concatenate([[0], np.cumsum(W.IS_WORD[data])])
    filled = signs[ends] > signs[begins]
    begins, ends = begins[filled], ends[filled]
    text = np.searchsorted(offsets, begins, "right") - 1
    fresh = np.concatenate([[0], np.cumsum(~repeated)])
    beside = fresh[np.searchsorted(words.begins, ends)] > fresh[np.searchsorted(words.begins, begins)]
    keys = W.spans_hash(W._BYTE[0][data], begins, ends, W._BASE[0])
    order = np.lexsort((keys, text))
    keys, text, beside = keys[order], text[order], beside[order]
    again = np.zeros(len(keys), bool)
    again[1:] = (keys[1:] == keys[:-1]) & (text[1:] == text[:-1])
    return [np.bincount(chosen, minlength=len(offsets) - 1) for chosen in (text, text[again], text[again & beside])]


def _repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which words lie in a window that its text holds twice or more."""
    starts = W.window_starts(first, REPEAT_WINDOW)
    keys = W.window_hashes(hashes, starts, REPEAT_WINDOW)
    text = np.searchsorted(first, starts, "right") - 1
    order = np.lexsort((keys, text))
    same = (keys[order][1:] == keys[order][:-1]) & (text[order][1:] == text[order][:-1])
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return W.covered(starts[again], REPEAT_WINDOW, len(hashes))


def _upper(data: np.ndarray) -> np.ndarray:
    """Marks upper-case letters A-Z and, in two-byte UTF-8, Latin-1 and common Greek and Cyrillic ones."""
    upper = (data >= 65) & (data <= 90)
    if len(data) > 1:
        lead, tail = data[:-1], data[1:]
        latin = (lead == 0xC3) & (tail >= 0x80) & (tail <= 0x9E) & (tail != 0x97)
        greek = (lead == 0xCE) & (tail >= 0x91) & (tail <= 0xA9)
        cyrillic = (lead == 0xD0) & (tail >= 0x80) & (tail <= 0xAF)
        upper[:-1] |= latin | greek | cyrillic
    return upper


def text_stats(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The base counts and the vectors of statistics of texts that lie one after the other."""
    words = W.find_words(data, offsets)
    hashes = W.word_hashes(data, words)
    first = words.first
    n = np.diff(first)
    chars = _per_text(W.IS_WORD[data] & _HEAD[data], offsets)
    symbols = _per_text(_SYMBOL[data], offsets)
    repeats = _repeated_words(hashes, first)
    repeated = _per_text(repeats, first)
    stutter = np.zeros(len(hashes), bool)
    stutter[1:] = hashes[1:] == hashes[:-1]
    stutter[first[:-1][first[:-1] < len(hashes)]] = False
    lines, seen, seen_apart = _line_counts(data, offsets, words, repeats)
    some, wide = np.maximum(n, 1), np.maximum(chars, 1)
    vectors = np.stack(
        [
            np.log(wide / some),
            np.sqrt(symbols / some),
            np.sqrt(repeated / some),
            np.sqrt(_per_text(_upper(data), offsets) / wide),
            np.sqrt(_per_text(_MARK[data], offsets) / some),
            np.sqrt(_per_text(stutter, first) / some),
            np.sqrt(seen_apart / np.maximum(lines, 1)),
        ],
        axis=1,
    )
    return [n, chars, symbols, seen, repeated], vectors


def _measurer(text: str, name: str, columns: list[str]):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            counts, vectors = text_stats(*utf8_view(batch.column(text)))
            flat = pa.array(vectors.ravel())
            x = pa.ListArray.from_arrays(pa.array(np.arange(0, vectors.size + 1, DIMENSIONS), pa.int32()), flat)
            stats = pa.StructArray.from_arrays([*(pa.array(c, pa.int64()) for c in counts), x], names=[*_COUNTS, "x"])
            yield pa.RecordBatch.from_arrays(
                [stats if c == name else batch.column(c) for c in columns], names=columns
            )

    return measure


def measure(docs: DataFrame, text_column: str = "text", name: str = "quality") -> DataFrame:
    """The rows with a struct of base counts and the vector of statistics."""
    columns = [c for c in docs.columns if c != name] + [name]
    fields = [docs.schema[c] for c in columns[:-1]] + [T.StructField(name, _STATS)]
    return docs.mapInArrow(_measurer(text_column, name, columns), T.StructType(fields))


def base_failed(stats: Column) -> Column:
    repeated = 100 * stats["n_repeat_words"] > MOST_REPEATED * stats["n_words"]
    return (stats["n_words"] < LEAST_WORDS) | repeated


def chi_square_above(x: float, dimensions: int) -> float:
    """How probable a chi-square variable above ``x`` is."""
    odd = dimensions % 2
    above = math.erfc(math.sqrt(x / 2)) if odd else 0.0
    powers = [k + odd / 2 for k in range(dimensions // 2)]
    return above + math.exp(-x / 2) * sum((x / 2) ** k / math.gamma(k + 1) for k in powers)


def chi_square_quantile(dimensions: int, tail: float) -> float:
    """Where a chi-square variable exceeds with probability ``tail``."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        low, high = (x, high) if chi_square_above(x, dimensions) > tail else (low, x)
    return low


# Distance bins: sixteen to each doubling.
_BINS, _PER_OCTAVE, _LEAST = 480, 16, 2.0**-12
_GRAIN = 1000  # bins of the starting medians, per unit

_ESTIMATE = "key string, rows bigint, center array<double>, precision array<double>"
_STEP = "key string, start int, rows bigint, center array<double>, precision array<double>, spread double"
_STEP_COLUMNS = ["key", "start", "rows", "center", "precision", "spread"]


def _half(rows: int) -> int:
    """The number of rows that the determinant is taken of."""
    return min(rows, (rows + DIMENSIONS + 1) // 2)


def _starts(rows: pd.DataFrame) -> pd.DataFrame:
    """The starts of a group from (dim, cell, rows): medians, middles of the shortest halves, lower quartiles."""
    centers, spreads, total = [], [], 0
    for dim in range(DIMENSIONS):
        own = rows[rows["dim"] == dim].sort_values("cell")
        total = int(own["rows"].sum())
        values, below = own["cell"].to_numpy() / _GRAIN, own["rows"].cumsum().to_numpy()
        low, mid, high = (values[int(np.searchsorted(below, q * total))] for q in (0.25, 0.5, 0.75))
        ends = np.searchsorted(below, below - own["rows"].to_numpy() + _half(total))
        begins = np.flatnonzero(ends < len(values))
        widths = values[ends[begins]] - values[begins]
        at = int(np.argmin(widths))
        middle = (values[begins[at]] + values[ends[begins[at]]]) / 2
        # every statistic but the word length is a share of what poor text has more of
        centers.append((mid, middle, low if dim else mid))
        spreads.append((high - low, widths[at], high - low))
    variances = np.square(np.array(spreads) / 1.349) + np.square(FLOOR)[:, None]
    found = [
        (rows["key"].iloc[0], start, total, [float(c[start]) for c in centers], np.diag(1 / variances[:, start]).ravel().tolist(), math.inf)
        for start in range(variances.shape[1])
    ]
    return pd.DataFrame(found, columns=_STEP_COLUMNS)


def _covariance(rows: float, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    center = sums / rows
    upper = np.zeros((DIMENSIONS, DIMENSIONS))
    upper[np.triu_indices(DIMENSIONS)] = products / rows
    return center, upper + np.triu(upper, 1).T - np.outer(center, center)


def concentrate(bins: np.ndarray, counts: np.ndarray, sums: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Centre, precision and log determinant of the nearest half of rows, from sums per distance bin.

    Of the bin in which the half ends, a share of its sums is taken.
    """
    order = np.argsort(bins)
    below = np.cumsum(counts[order])
    total = int(below[-1])
    need = _half(total)
    last = int(np.searchsorted(below, need))
    share = np.ones(last + 1)
    share[last] = 1 - (below[last] - need) / counts[order[last]]
    near = order[: last + 1]
    center, covariance = _covariance(need, share @ sums[near], share @ products[near])
    covariance += np.diag(np.square(FLOOR))
    edge = _LEAST * 2 ** ((bins[order[last]] + 1) / _PER_OCTAVE)
    # The half's widest distance should be that of as large a share of a normal
    # distribution.  The floors make distances smaller, which is meant.
    scale = max(1.0, edge / chi_square_quantile(DIMENSIONS, 1 - need / (total + 1)))
    return center, np.linalg.inv(covariance * scale), float(np.linalg.slogdet(covariance)[1])


_X = [f"x{i}" for i in range(DIMENSIONS)]
_SUMS = [f"s{i}" for i in range(DIMENSIONS)]
_PRODUCTS = [f"p{i}_{j}" for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]


def _moments() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        *(F.sum(x).alias(s) for x, s in zip(_X, _SUMS)),
        *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)),
    ]


def _step(rows: pd.DataFrame) -> pd.DataFrame:
    center, precision, spread = concentrate(
        rows["bin"].to_numpy(), rows["rows"].to_numpy(), rows[_SUMS].to_numpy(), rows[_PRODUCTS].to_numpy()
    )
    first = rows.iloc[0]
    found = (first["key"], first["start"], int(rows["rows"].sum()), center.tolist(), precision.ravel().tolist(), spread)
    return pd.DataFrame([found], columns=_STEP_COLUMNS)


def _reweighted(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Estimates from the moments of the rows within the inner quantile."""
    inner = chi_square_quantile(DIMENSIONS, 1 - INNER)
    factor = INNER / (1 - chi_square_above(inner, DIMENSIONS + 2))  # what cutting there takes off a normal covariance
    for part in parts:
        found = []
        for key, total, rows, sums, products in zip(
            part["key"], part["total"], part["rows"], part[_SUMS].to_numpy(), part[_PRODUCTS].to_numpy()
        ):
            center, covariance = _covariance(rows, sums, products)
            precision = np.linalg.inv(covariance * factor + np.diag(np.square(FLOOR)))
            found.append((key, total, center.tolist(), precision.ravel().tolist()))
        yield pd.DataFrame(found, columns=["key", "rows", "center", "precision"])


def _shrunk(x: Column, center: Column, n_words: Column, i: int) -> Column:
    """A statistic's difference from the centre, less where a text is short."""
    return (x[i] - center[i]) * F.sqrt(n_words / (n_words + SHRINK_WORDS))


def _distance(x: Column, n_words: Column, center: Column, precision: Column) -> Column:
    off = [_shrunk(x, center, n_words, i) for i in range(DIMENSIONS)]
    terms = [
        off[i] * off[j] * precision[i * DIMENSIONS + j] * (1 if i == j else 2)
        for i in range(DIMENSIONS)
        for j in range(i, DIMENSIONS)
    ]
    return sum(terms[1:], terms[0])


def _keys(groups: list[Column]) -> list[Column]:
    """Keys of a row's groups, the finest first: all columns, all but the last, ..., the first (none only without columns)."""
    texts = [F.coalesce(F.concat(F.lit("="), g.cast("string")), F.lit("-")) for g in groups]
    return [F.concat_ws("\x1f", F.lit(str(k)), *texts[:k]) for k in range(len(groups), min(len(groups), 1) - 1, -1)]


def _placed(leveled: DataFrame, estimate: DataFrame) -> DataFrame:
    """Rows beside their groups' estimates: squared distance ``far``, and ``_X``, what shrinking leaves around the centre."""
    side = estimate.select("key", "start", "center", "precision")
    joined = leveled.join(broadcast_if_small(side), "key")
    far = _distance(F.col("x"), F.col("n"), F.col("center"), F.col("precision"))
    off = [_shrunk(F.col("x"), F.col("center"), F.col("n"), i) + F.col("center")[i] for i in range(DIMENSIONS)]
    return joined.select("key", "start", far.alias("far"), *(o.alias(x) for o, x in zip(off, _X)))


def _concentrated(leveled: DataFrame, estimate: DataFrame) -> DataFrame:
    """One concentration step of each estimate."""
    cell = F.floor(F.log2(F.greatest("far", F.lit(_LEAST)) / _LEAST) * _PER_OCTAVE)
    binned = _placed(leveled, estimate).withColumn("bin", F.least(cell, F.lit(_BINS - 1)).cast("int"))
    sums = binned.groupBy("key", "start", "bin").agg(*_moments())
    return sums.groupBy("key", "start").applyInPandas(_step, _STEP)


def _written(estimate: DataFrame, label: str = "estimate") -> DataFrame:
    """A written table of a few rows per group, in as many files as there are cores at most."""
    return materialize(estimate.coalesce(estimate.sparkSession.sparkContext.defaultParallelism), label)


def least_determinant(leveled: DataFrame) -> DataFrame:
    """Per ``key`` of rows (n, x, key) the settled estimate of least determinant: ``_STEP`` and ``moving`` (written)."""
    cells = leveled.select("key", F.posexplode("x").alias("dim", "v")).select(
        "key", "dim", F.floor(F.col("v") * _GRAIN + 0.5).alias("cell")
    )
    counted = cells.groupBy("key", "dim", "cell").agg(F.count(F.lit(1)).alias("rows"))
    tried = _written(counted.groupBy("key").applyInPandas(_starts, _STEP))
    for _ in range(STARTING_STEPS):
        tried = _written(_concentrated(leveled, tried))
    least = F.min_by(F.struct(*_STEP_COLUMNS[1:]), F.struct("spread", "start")).alias("best")
    best = _written(tried.groupBy("key").agg(least).select("key", "best.*", F.lit(True).alias("moving")))
    # every round lowers some determinant by a least amount, and floors bound them from below
    while not best.where("moving").isEmpty():
        after = _concentrated(leveled, best.where("moving"))
        all_of = F.struct(*_STEP_COLUMNS[1:])
        both = best.select("key", F.lit(0).alias("at"), all_of.alias("found")).unionAll(after.select("key", F.lit(1), all_of))
        pairs = both.groupBy("key").agg(F.min_by("found", "at").alias("old"), F.max_by("found", "at").alias("new"))
        falls = F.col("new.spread") < F.col("old.spread") - SETTLED
        chosen = pairs.select("key", falls.alias("moving"), F.when(falls, F.col("new")).otherwise(F.col("old")).alias("found"))
        best = _written(chosen.select("key", "found.*", "moving"))
    return best


def fit(measured: DataFrame, groups: list[str], name: str = "quality") -> DataFrame:
    """One estimate per group at each level (written)."""
    q = F.col(name)
    good = measured.where(~base_failed(q)).select(
        q["n_words"].cast("double").alias("n"), q["x"].alias("x"), F.array(*_keys([F.col(g) for g in groups])).alias("keys")
    )
    rows = materialize(good.distinct(), "statistics")
    leveled = rows.select("n", "x", F.explode("keys").alias("key"))
    best = least_determinant(leveled)
    near = _placed(leveled, best).where(F.col("far") <= chi_square_quantile(DIMENSIONS, 1 - INNER))
    totals = best.select("key", F.col("rows").alias("total"))
    sums = near.groupBy("key").agg(*_moments()).join(broadcast_if_small(totals), "key")
    estimate = _written(sums.mapInPandas(_reweighted, _ESTIMATE))
    return _toward_parents(estimate, rows)


def _covariances(precision: pd.Series) -> np.ndarray:
    return np.linalg.inv(np.stack(precision.to_numpy()).astype(float).reshape(-1, DIMENSIONS, DIMENSIONS))


def _covariance_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        yield part.assign(covariance=[c.ravel().tolist() for c in _covariances(part["precision"])]) if len(part) else part.assign(covariance=[])


def _blended(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        if not len(part):
            continue
        n = part["rows"].to_numpy(float)[:, None, None]
        own = _covariances(part["precision"])
        parent = np.stack(part["parent_covariance"].to_numpy()).astype(float).reshape(own.shape)
        mixed = np.linalg.inv((n * own + PRIOR_ROWS * parent) / (n + PRIOR_ROWS))
        yield part[["key", "rows", "center"]].assign(precision=[m.ravel().tolist() for m in mixed])


def _toward_parents(estimate: DataFrame, rows: DataFrame) -> DataFrame:
    """The estimates with their covariances shrunk towards their parents', level by level from the coarsest."""
    family = _written(rows.select("keys").distinct(), "family")
    levels = len((family.first() or {"keys": [None]})["keys"])
    with_covariance = "key string, rows bigint, center array<double>, precision array<double>, covariance array<double>"
    done = None
    for at in range(levels - 1, -1, -1):
        links = family.select(F.col("keys")[at].alias("key"), F.col("keys")[at + 1].alias("parent") if at + 1 < levels else F.lit(None).cast("string").alias("parent")).distinct()
        own = estimate.join(broadcast_if_small(links), "key")
        if done is None:  # the mean covariance within the coarsest groups, one row
            flat = own.mapInPandas(_covariance_of, with_covariance.replace(", covariance", ", parent string, covariance"))
            mean = flat.select(*(F.sum(F.col("rows") * F.col("covariance")[i]) / F.sum("rows") for i in range(DIMENSIONS**2))).first()
            side = own.withColumn("parent_covariance", F.array(*(F.lit(v).cast("double") for v in mean)))
        else:
            above = done.mapInPandas(_covariance_of, with_covariance).select(F.col("key").alias("parent"), F.col("covariance").alias("parent_covariance"))
            side = own.join(broadcast_if_small(above), "parent")
        blended = side.select("key", "rows", "center", "precision", "parent_covariance").mapInPandas(_blended, _ESTIMATE)
        done = _written(blended)
    return done


def judge(measured: DataFrame, estimate: DataFrame, groups: list[str], name: str = "quality") -> DataFrame:
    """The measured rows with ``base_failed`` and ``kept``."""
    out = measured.drop("base_failed", "kept", "_use", "_key")
    side = estimate.select(F.col("key").alias("_key"), F.struct("center", "precision").alias("_use"))
    # every row that passes the base rules is in its group's estimate
    out = out.withColumn("_key", _keys([F.col(g) for g in groups])[0]).join(broadcast_if_small(side), "_key", "left")
    q = F.col(name)
    out = out.withColumn("base_failed", base_failed(q))
    far = _distance(q["x"], q["n_words"].cast("double"), F.col("_use.center"), F.col("_use.precision"))
    inside = F.coalesce(far <= chi_square_quantile(DIMENSIONS, TAIL), F.lit(True))
    return out.withColumn("kept", ~F.col("base_failed") & inside).select(
        *(c for c in measured.columns if c not in ("base_failed", "kept")), "base_failed", "kept"
    )


def judge_documents(docs: DataFrame, groups: tuple[str, ...] = ("lang", "source"), text_column: str = "text") -> DataFrame:
    """doc_id, the base counts, ``base_failed`` and ``kept`` of every row, without the text."""
    slim = measure(docs.select("doc_id", F.col(text_column).alias("text"), *groups)).drop("text")
    measured = materialize(slim, "measured")
    judged = judge(measured, fit(measured, list(groups)), list(groups))
    return judged.select("doc_id", *(F.col(f"quality.{c}") for c in _COUNTS), "base_failed", "kept")


def keep_good(docs: DataFrame, groups: tuple[str, ...] = ("lang", "source"), text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns as they are."""
    plain = {c: f"column{i}" for i, c in enumerate(docs.columns)}  # no column has a name that is used here
    renamed = docs.toDF(*plain.values())
    text, by = plain[text_column], [plain[g] for g in groups]
    estimate = fit(measure(renamed.select(text, *by), text).drop(text), by)
    kept = judge(measure(renamed, text), estimate, by).where("kept")
    return kept.select(*plain.values()).toDF(*plain)
