import hashlib
import random
import zlib

import pytest

from flightlake.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, path string, digest int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row[:5]
    values = (doc_id, source, lang, n_chars, text)
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def climb(rows, place):
    """(siblings left and right) per level."""
    for level in rows[:-1]:
        first = place // 16 * 16
        yield level[first:place], level[place + 1 : first + 16]
        place //= 16


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    ordered = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in names}
    trees = {g: levels([leaf(r) for r in ordered[g]]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for number, g in enumerate(names):
        for place, row in enumerate(ordered[g]):
            path = [*climb(trees[g], place), *climb(top, number)]
            proof = h(*[d for left, right in path for d in left + right])
            folded = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[1]:
                lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1])
                folded = leaf((row[0], lower, *row[2:]))
            for left, right in path:
                folded = h(*left, folded, *right)
            out.append((row[0], leaf(row), trees[g][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def made(count, sources, seed):
    random.seed(seed)
    texts = ["Abc", "", None, "É x Y", "日本 A", "lower only", "Q" * 3000]
    return [
        (i * 3 - 50, random.choice(texts), random.choice(["en", None]), random.choice(sources), random.choice([None, 7, -1]), "p", 1)
        for i in range(count)
    ]


@pytest.mark.parametrize(
    "count,sources",
    [(1, ["a"]), (16, ["a"]), (17, ["a"]), (300, ["a"]), (2, ["a", None]), (700, ["big"] * 30 + [None, "", "é", "Z", "a"]), (400, [f"s{i}" for i in range(60)])],
)
def test_against_hashlib(spark, count, sources):
    rows = made(count, sources, count)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in M.audit(docs).collect()), key=str)
    assert got == brute(rows)


def test_repeated_rows_null_keys_and_none(spark):
    rows = [(None, "A", None, "a", 1, "", 0), (None, "B", None, "a", 1, "", 0)] + [(5, "Same", "en", "a", 4, "", 0)] * 40 + [(6, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert sorted((tuple(r) for r in M.audit(docs).collect()), key=str) == brute(rows)
    assert M.audit(docs.limit(0)).count() == 0
    assert M.build(docs.limit(0)).root is None


def test_some_leaves_only(spark):
    rows = made(400, ["a", "b", "c"], 1)
    manifest = M.build(spark.createDataFrame(rows, SCHEMA))
    few = manifest.leaves.where("key % 50 = 1")
    found = M.proofs(manifest, few)
    answer = found.select(M.fold(M.F.col("leaf"), M.F.col("proof")).alias("r")).distinct().collect()
    assert [r["r"] for r in answer] == [manifest.root] and found.count() == few.count() > 3
    # a record is stored once per digest, under the digest of its children
    bad = manifest.records.where("digest <> sha2(array_join(children, ''), 256)").count()
    assert bad == 0 and manifest.records.count() == manifest.records.select("digest").distinct().count()
