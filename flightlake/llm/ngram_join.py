"""Exact Jaccard self-join of word n-gram sets, size-aware: light and heavy sets.

Texts with equal sets form one class, so copies cost one row each and are never
paired.  An n-gram that only one class holds cannot add to any overlap: the
exchange of ``blocks`` finds the shared ones, and a set that has too few of them
to reach the threshold with anybody leaves at once.  Then by size:

* light sets: all subsets of a fixed size c that an overlap can have are
  enumerated, for each such c.  Sets that share a c-subset overlap in c elements,
  which proves a link without looking at the sets again; within one subset the
  smallest set links to every set that links to any, so a star replaces pairs;
* heavy sets: inverted lists over as many of a set's n-grams as it may miss, and
  one more.  Each list first proposes its most shareable member to all others;
  what is linked is merged, and then lists are scanned for pairs of different
  components.  Sizes, shareable counts and a parity sketch (a lower bound of the
  symmetric difference) reject pairs before the sets are compared exactly.

The boundary is the size at which the summed costs of both ways are least.
N-grams that many sets hold come last in the order of the lists, which keeps
lists short; this order changes cost only.

Words are maximal runs without space and 0x09-0x0D after lower-casing A-Z.  With
fewer words than n the whole sequence is one n-gram; without words (or with null
text) a document is linked with nothing.  Ids may repeat or be null.  An empty
table gives an empty result.  Sets and n-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm import blocks as B
from flightlake.llm import words as W
from flightlake.llm.arrow import utf8_view
from flightlake.llm.components import connected
from flightlake.session import materialize

SIZE = 3
PERCENT = 90
# Lists longer than this come last in the order; so many are remembered.
LONG_LIST = 32
LONG_LISTS = 1 << 16
# Sizes up to which subsets are thought of at all.
MOST_LIGHT = 64
SKETCH_WORDS = 8

PROFILE = "doc_id bigint, block bigint, row int, n int, class bigint"
SETS = "class bigint, n int, g int, sketch array<bigint>, grams binary"


class Sets:
    """Distinct n-gram hashes of each text of a block, one text after the other."""

    def __init__(self, rows: pa.RecordBatch, size: int, text: str):
        data, offsets = utf8_view(rows.column(text))
        data = W.LOWER[data]
        words = W.find_words(data, offsets)
        hashes = W.word_hashes(data, words)
        first = words.first
        count = np.diff(first)
        starts = W.window_starts(first, size)
        grams = W.window_hashes(hashes, starts, size)
        text = np.searchsorted(first, starts, "right") - 1
        short = np.flatnonzero((count > 0) & (count < size))
        if len(short):
            whole = W.spans_hash(hashes, first[short], first[short + 1], W._BASE[0] ^ 0x5A5A5A5A)
            grams, text = np.concatenate([grams, whole]), np.concatenate([text, short])
        order = np.lexsort((grams, text))
        grams, text = grams[order], text[order]
        head = np.ones(len(grams), bool)
        head[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
        self.grams, self.text = grams[head], text[head]
        self.first = np.searchsorted(self.text, np.arange(len(count) + 1))
        self.n = np.diff(self.first)
        total = np.concatenate([[np.uint64(0)], np.cumsum(W.mix(self.grams.copy()), dtype=np.uint64)])
        key = W.mix(total[self.first[1:]] - total[self.first[:-1]] + self.n.astype(np.uint64))
        self.key = key.view(np.int64)


def _profiles(size: int, id_column: str, text: str):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in B.rows_of(batch):
                rows, block = B.open_block(row["data"]), row["block"]
                sets = Sets(rows, size, text)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(id_column).cast(pa.int64()), pa.array(np.full(rows.num_rows, block)),
                        pa.array(range(rows.num_rows), pa.int32()), pa.array(sets.n, pa.int32()), pa.array(sets.key),
                    ],
                    names=["doc_id", "block", "row", "n", "class"],
                )

    return profile


def _owned(sets: Sets, others: list[int] | None) -> np.ndarray:
    """Texts whose class this block speaks for: not another block's, the first of its class."""
    ok = sets.n > 0
    if others:
        ok &= ~np.isin(sets.key, np.asarray(others, np.int64))
    first = np.zeros(len(ok), bool)
    first[np.unique(sets.key, return_index=True)[1]] = True
    return ok & first


def _gram_keys(size: int, text: str, buckets: int, shift: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in B.rows_of(batch):
                sets, block = Sets(B.open_block(row["data"]), size, text), row["block"]
                own = np.repeat(_owned(sets, None), sets.n)
                keys, twice, _ = B.distinct(_cut(sets.grams[own], shift))
                yield from B.emitted(B.key_rows(block, keys, twice, buckets), B.KEY_NAMES, B.KEY_TYPES)

    return send


def _cut(grams: np.ndarray, shift: int) -> np.ndarray:
    return grams >> np.uint64(shift) << np.uint64(shift)


def sketch(grams: np.ndarray) -> np.ndarray:
    """Parity of how many grams fall on each bit; bits that differ bound the symmetric difference from below."""
    bit = (grams >> np.uint64(7)) % np.uint64(64 * SKETCH_WORDS)
    odd = np.bincount(bit.astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def may_miss(n: int, percent: int) -> int:
    """How many of a set's n elements a linked set may lack."""
    return n - -(-percent * n // 100)


def _shareable(size: int, text: str, buckets: int, shift: int, percent: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in B.rows_of(batch):
                sets = Sets(B.open_block(row["data"]), size, text)
                own = _owned(sets, None)
                keys, _, index = B.distinct(_cut(sets.grams[np.repeat(own, sets.n)], shift))
                shared = np.zeros(len(sets.grams), bool)
                if len(keys):
                    shared[np.repeat(own, sets.n)] = B.read_bits(row["bits"], keys, buckets)[index]
                own &= _owned(sets, row["others"])
                total = np.concatenate([[0], np.cumsum(shared)])
                g = total[sets.first[1:]] - total[sets.first[:-1]]
                least = -(-percent * sets.n // 100)
                out = []
                for i in np.flatnonzero(own & (g >= least)).tolist():
                    a, b = sets.first[i], sets.first[i + 1]
                    grams = sets.grams[a:b][shared[a:b]]
                    out.append((int(sets.key[i]), b - a, len(grams), sketch(sets.grams[a:b]).tolist(), grams.tobytes()))
                yield from B.emitted(out, ["class", "n", "g", "sketch", "grams"], [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.binary()])

    return keep


def _subsets(percent: int, boundary: int):
    """Rows (key, c, class, n) of light sets: one per subset of each size c an overlap can have."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, classes, ns = [], [], [], []
            for row in B.rows_of(batch):
                grams = W.mix(np.frombuffer(row["grams"], np.uint64).copy()).tolist()
                whole = sum(grams)
                for c in range(-(-percent * row["n"] // 100), row["g"] + 1):
                    for left in combinations(grams, row["g"] - c):
                        keys.append((whole - sum(left)) & 0xFFFFFFFFFFFFFFFF)
                        sizes.append(c)
                        classes.append(row["class"])
                        ns.append(row["n"])
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(classes, pa.int64()), pa.array(ns, pa.int32())],
                    names=["key", "c", "class", "n"],
                )

    return emit


def light_links(sets: DataFrame, percent: int, boundary: int) -> DataFrame:
    """Links between sets of at most ``boundary`` elements; a star within each subset."""
    rows = sets.where(F.col("n") <= boundary).select("class", "n", "g", "grams")
    rows = rows.mapInArrow(_subsets(percent, boundary), "key bigint, c int, class bigint, n int")
    hubs = rows.groupBy("key", "c").agg(F.min(F.struct("n", "class")).alias("hub"), F.count(F.lit(1)).alias("members"))
    hubs = hubs.where("members > 1").select("key", "c", F.col("hub.n").alias("hub_n"), F.col("hub.class").alias("hub"))
    linked = F.expr(f"class <> hub AND 100 * c >= {percent} * (n + hub_n - c)")
    return rows.join(hubs, ["key", "c"]).where(linked).select(F.col("class").alias("u"), F.col("hub").alias("v")).distinct()


def _lists(percent: int, last: np.ndarray | None, times: int):
    """Rows (gram, class) for the first grams of each set, long lists' grams last."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, classes = [], []
            for cls, n, g, raw in zip(*(batch.column(c).to_pylist() for c in ("class", "n", "g")), batch.column("grams")):
                own = np.frombuffer(raw.as_py(), np.uint64)
                if last is not None and len(last):
                    at = np.minimum(np.searchsorted(last, own), len(last) - 1)
                    late = last[at] == own
                    own = np.concatenate([own[~late], own[late]])
                take = own[: times * (may_miss(n, percent) - (n - g) + 1)]
                grams.append(take)
                classes.append(np.full(len(take), cls))
            if grams:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(grams).view(np.int64)), pa.array(np.concatenate(classes))], names=["gram", "class"]
                )

    return emit


def _possible(a: str, b: str, percent: int) -> str:
    """Whether two sets can still link, by sizes, shareable grams and sketches."""
    apart = " + ".join(f"bit_count({a}.sketch[{i}] ^ {b}.sketch[{i}])" for i in range(SKETCH_WORDS))
    both = f"least({a}.g, {b}.g)"
    return (
        f"{100 + percent} * {both} >= {percent} * ({a}.n + {b}.n)"
        f" AND {100 + percent} * ({apart}) <= {100 - percent} * ({a}.n + {b}.n)"
        f" AND 100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n)"
    )


def _compare(percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for row in B.rows_of(batch):
                a, b = np.frombuffer(row["ga"], np.uint64), np.frombuffer(row["gb"], np.uint64)
                at = np.searchsorted(a, b)
                at[at == len(a)] = 0
                both = int((a[at] == b).sum()) if len(a) else 0
                if 100 * both >= percent * (row["na"] + row["nb"] - both):
                    us.append(row["u"])
                    vs.append(row["v"])
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return compare


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (u, v) of classes whose sets reach the threshold."""
    one = sets.select(F.col("class").alias("u"), F.col("n").alias("na"), F.col("grams").alias("ga"))
    two = sets.select(F.col("class").alias("v"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    return pairs.join(one, "u").join(two, "v").select("u", "v", "na", "nb", "ga", "gb").mapInArrow(_compare(percent), "u bigint, v bigint")


def heavy_links(sets: DataFrame, percent: int, boundary: int) -> DataFrame:
    """Links with at least one set above ``boundary``, as far as components need them."""
    # Sets a little below the boundary can link with one above it.
    listed = sets.where(F.col("n") >= -(-percent * (boundary + 1) // 100))
    slim = listed.select("class", "n", "g", "grams")
    kind = "gram bigint, class bigint"
    long = slim.mapInArrow(_lists(percent, None, 3), kind).groupBy("gram").count().where(F.col("count") > LONG_LIST)
    long = materialize(long, "long_lists")
    # the longest ones, as far as a bounded number goes: by powers of two of their length
    octave = F.floor(F.log2("count")).cast("int").alias("octave")
    sizes = {r["octave"]: r["n"] for r in long.groupBy(octave).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, held = 64, 0
    for power in sorted(sizes, reverse=True):
        held += sizes[power]
        if held > LONG_LISTS:
            break
        least = power
    known = long.where(octave >= least).select("gram").collect()
    last = np.sort(np.array([r["gram"] for r in known], np.int64).view(np.uint64))
    lists = slim.mapInArrow(_lists(percent, last, 1), kind)
    lone = lists.groupBy("gram").count().where("count > 1").select("gram")
    facts = listed.select("class", "n", "g", "sketch")
    lists = materialize(lists.join(lone, "gram").join(facts, "class"), "lists")

    me = F.struct("class", "n", "g", "sketch")
    best = lists.groupBy("gram").agg(F.min(F.struct((F.col("n") - F.col("g")).alias("own"), me.alias("me"))).alias("best"))
    star = lists.alias("a").join(best.select("gram", F.col("best.me").alias("b")), "gram")
    star = star.where(f"a.class <> b.class AND {_possible('a', 'b', percent)}")
    # one proposal per set: the one it meets most often
    chosen = star.groupBy(F.col("a.class").alias("u"), F.col("b.class").alias("v")).count()
    chosen = chosen.groupBy("u").agg(F.max(F.struct("count", "v")).alias("p")).select("u", F.col("p.v").alias("v"))
    first = materialize(verified(chosen, listed, percent), "star")

    roots = connected(first)
    merged = lists.join(roots.withColumnRenamed("node", "class"), "class", "left")
    merged = merged.withColumn("root", F.coalesce("root", "class"))
    mixed = merged.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("gram")
    merged = materialize(merged.join(mixed, "gram"), "merged")
    pairs = merged.alias("a").join(merged.alias("b"), "gram").where(f"a.class < b.class AND a.root <> b.root AND {_possible('a', 'b', percent)}")
    pairs = pairs.select(F.col("a.class").alias("u"), F.col("b.class").alias("v")).distinct()
    return first.union(verified(pairs, listed, percent))


def subset_count(n: int, percent: int) -> int:
    return sum(comb(n, k) for k in range(may_miss(n, percent) + 1))


def choose_boundary(sizes: dict[int, int], percent: int) -> int:
    """The size up to which enumerating subsets costs less than lists and comparisons."""
    best, at, gain = 0, 0, 0
    for n in range(1, MOST_LIGHT + 1):
        gain += sizes.get(n, 0) * (may_miss(n, percent) + 1 + 2 * n - subset_count(n, percent))
        if gain > best:
            best, at = gain, n
    return at


def _grouped(stored: DataFrame, size: int, percent: int, id_column: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(profile of every row, class and root of every class that links)."""
    buckets = B.bucket_count(stored)
    # Keys are cut to 18 bits more than tell all n-grams apart; a false hit only costs time.
    shift = max(0, 64 - 18 - (buckets * (B.BUCKET_BYTES // 4)).bit_length())
    profile = materialize(stored.mapInArrow(_profiles(size, id_column, text), PROFILE), "profiles")
    full = profile.where("n > 0")
    owners = full.groupBy("class").agg(F.min("block").alias("owner"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    others = (
        full.join(owners.select("class", "owner"), "class").where("block <> owner")
        .groupBy("block").agg(F.collect_set("class").alias("others"))
    )
    bits = B.answers(B.shared_keys(stored.mapInArrow(_gram_keys(size, text, buckets, shift), B.KEYS)), "bits")
    told = stored.join(bits, "block", "left").join(others, "block", "left")
    sets = materialize(told.mapInArrow(_shareable(size, text, buckets, shift, percent), SETS), "sets")

    counted = sets.where(F.col("n") <= MOST_LIGHT).groupBy("n").count().collect()
    boundary = choose_boundary({r["n"]: r["count"] for r in counted}, percent)
    links = light_links(sets, percent, boundary).union(heavy_links(sets, percent, boundary))
    return profile, materialize(connected(links).withColumnRenamed("node", "class"), "roots")


def jaccard_components(
    docs: DataFrame,
    size: int = SIZE,
    percent: int = PERCENT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id and class of every row.

    Two rows link when 100 * |A n B| >= percent * |A u B|; ``component_id`` is the
    smallest id that links lead to, and ``class`` is equal for equal sets.
    """
    stored = B.to_blocks(docs.select(id_column, text_column), text_column)
    profile, roots = _grouped(stored, size, percent, id_column, text_column)
    classes = profile.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    least = classes.join(roots, "class").groupBy("root").agg(F.min("least").alias("component_id"))
    joined = roots.join(least, "root").select("class", "component_id")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component_id", "least"))
    named = classes.join(joined, "class", "left")
    return profile.join(named, "class", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), "class"
    )


def _keeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield B.open_block(batch.column("data")[i].as_py()).take(pa.array(sorted(batch.column("kept")[i].as_py())))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group that links lead
    through, the row with the smallest id stays (of equal ids the one stored first).
    Rows without words are linked with nothing and stay."""
    stored = B.to_blocks(docs, text_column)
    profile, roots = _grouped(stored, size, percent, id_column, text_column)
    roots = roots.select("class", "root")
    group = profile.where("n > 0").join(roots, "class", "left").withColumn("group", F.coalesce("root", "class"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "block", "row")).alias("f")
    kept = group.groupBy("group").agg(first).select("f.block", "f.row").union(profile.where("n = 0").select("block", "row"))
    told = kept.groupBy("block").agg(F.collect_list("row").alias("kept"))
    return stored.join(told, "block").select("data", "kept").mapInArrow(_keeper, docs.schema)
