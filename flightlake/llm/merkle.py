"""Merkle manifest of a dataset, kept as a content-addressed graph.

Rows become leaves, the leaves of a group (ascending key) a tree of runs of
``FANOUT`` nodes, and the groups' roots, in group order, one more such tree.
The manifest stores one record per digest: the digests of its children.

A request names a leaf by the digits of its rank: those of its group among the
groups, then those of the leaf within its group.  Requests descend from the root
together: at each depth the nodes that some request passes are looked up by
digest, the child of each wanted digit is followed, and the children beside it
are collected as a segment of the path.  Requests with equal digits so far share
one row, so a root that every request passes is looked up once, and no node's
requests are ever gathered.  At the leaf the segments are reversed: a proof runs
from the leaf to the root.

A row's digest is the SHA-256 of its fields, each ``-`` if null, else its UTF-8
length in bytes, ``:`` and the value.  Rows with equal keys are ordered by their
digests; a null key comes first, as does a null group, which is a group of its
own.  A group of one row has that leaf as its root, and a table of one group has
that group's root as its root.  An empty table has no root (None) and no proofs.
Other columns take no part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.operators.numbering import number_rows
from flightlake.operators.sizing import broadcast_if_small
from flightlake.session import materialize

FANOUT = 16  # one hexadecimal digit of a rank chooses a child
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_SEGMENTS = "array<struct<left: string, right: string>>"


class Manifest(NamedTuple):
    leaves: DataFrame  # key, group_key, leaf, presented, tree, path
    groups: DataFrame  # tree, group_key, n, subroot
    records: DataFrame  # digest, children
    root: str | None


def digest_of(values: Sequence[Column]) -> Column:
    """SHA-256 over fields that are marked with their lengths."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _runs(nodes: DataFrame) -> DataFrame:
    """(tree, at, n, digest, children) of the runs one level above ``nodes``."""
    run = F.expr(f"at div {FANOUT}").alias("at")
    left = F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n")
    ordered = F.sort_array(F.collect_list(F.struct("at", "digest")))
    grouped = nodes.groupBy("tree", run, left).agg(ordered.alias("members"))
    children = F.transform("members", lambda m: m["digest"])
    return grouped.select("tree", "at", "n", F.sha2(F.array_join(children, ""), 256).alias("digest"), children.alias("children"))


def _grow(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(root of each tree, records of all levels) over nodes (tree, at, n, digest)."""
    roots, records = [], []
    while True:
        roots.append(nodes.where("n = 1").select("tree", "digest"))
        rest = nodes.where("n > 1")
        if rest.isEmpty():
            return reduce(DataFrame.union, roots), records
        nodes = materialize(_runs(rest), "nodes")
        records.append(nodes.select("digest", "children"))


def _digits(rank: Column, count: Column) -> Column:
    """``rank`` among ``count`` nodes as one hexadecimal digit per level."""
    return F.when(count > 1, F.lpad(F.hex(rank), F.length(F.hex(count - 1)), F.lit("0"))).otherwise("")


def build(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    presented: Mapping[str, Column] | None = None,
    where: Column | None = None,
) -> Manifest:
    """The manifest of ``docs``.

    ``presented`` gives other values of some fields; in rows that meet ``where``
    the leaf made from them is what a reader claims to have (column
    ``presented``, null elsewhere).
    """
    claimed = F.lit(None).cast("string")
    if presented:
        other = digest_of([presented.get(f, F.col(f)) for f in fields])
        claimed = F.when(F.coalesce(where, F.lit(False)) if where is not None else F.lit(True), other)
    rows = docs.select(
        F.col(group).alias("group_key"), F.col(key).alias("key"), digest_of([F.col(f) for f in fields]).alias("leaf"), claimed.alias("presented")
    )
    numbered = materialize(number_rows(rows, ["group_key", "key", "leaf"]), "leaves")
    spans = numbered.groupBy("group_key").agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = materialize(number_rows(materialize(spans, "groups"), ["first"], name="tree", unique=True), "groups")
    groups = groups.withColumn("tree", F.col("tree") - 1)
    trees = groups.count()
    place = F.col("row_no") - F.col("first")
    leaves = (
        numbered.withColumnRenamed("group_key", "_group")
        .join(broadcast_if_small(groups), F.col("_group").eqNullSafe(F.col("group_key")))
        .select("group_key", "key", "leaf", "presented", "tree", "n", place.alias("at"))
        .withColumn("path", F.concat(_digits(F.col("tree"), F.lit(trees)), _digits(F.col("at"), F.col("n"))))
    )
    subroots, records = _grow(leaves.select("tree", "at", "n", F.col("leaf").alias("digest")))
    subroots = materialize(subroots.withColumnRenamed("digest", "subroot"), "subroots")
    top = subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("at"), F.lit(trees).alias("n"), F.col("subroot").alias("digest"))
    root, above = _grow(top)
    found = root.first()
    empty = docs.sparkSession.createDataFrame([], "digest string, children array<string>")
    stored = materialize(reduce(DataFrame.union, records + above, empty).dropDuplicates(["digest"]), "records")
    with_roots = groups.join(subroots, "tree").select("tree", "group_key", "n", "subroot")
    return Manifest(leaves.drop("n", "at"), with_roots, stored, found["digest"] if found else None)


def _beside(children: Column, at: Column) -> Column:
    """The children left and right of the one at ``at``, each joined to one text."""
    left = F.array_join(F.slice(children, F.lit(1), at), "")
    right = F.array_join(F.slice(children, at + 2, F.lit(FANOUT)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (with the ``path`` of their leaves) and their proofs.

    ``proof`` lists per level, from the leaf up, the texts left and right of the
    node on the way; it is empty where the leaf is the root.
    """
    asked = requests.withColumn("_parent", F.when(F.length("path") > 0, F.expr("left(path, length(path) - 1)")))
    passed = materialize(asked.where("_parent is not null").select("_parent").distinct(), "asked")
    deepest = passed.agg(F.max(F.length("_parent"))).first()[0]
    none = F.array().cast(_SEGMENTS)
    opened: list[DataFrame] = []
    if deepest is not None:
        at = requests.sparkSession.createDataFrame([("", manifest.root)], "node string, digest string").withColumn("segments", none)
        for depth in range(deepest + 1):
            found = materialize(at.join(manifest.records, "digest").select("node", "children", "segments"), "passed")
            opened.append(found)
            wanted = passed.where(F.length("_parent") > depth).select(F.substring("_parent", 1, depth + 1).alias("node")).distinct()
            below = found.select("node", "children", "segments", F.posexplode("children").alias("digit", "digest"))
            at = below.select(
                F.concat("node", F.hex("digit")).alias("node"),
                "digest",
                F.array_append("segments", _beside(F.col("children"), F.col("digit"))).alias("segments"),
            ).join(wanted, "node", "left_semi")
    nodes = reduce(DataFrame.union, opened) if opened else requests.sparkSession.createDataFrame([], f"node string, children array<string>, segments {_SEGMENTS}")
    digit = F.conv(F.right("path", F.lit(1)), 16, 10).cast("int")
    own = F.array(_beside(F.col("children"), digit)).cast(_SEGMENTS)
    proof = F.when(F.col("children").isNull(), none).otherwise(F.concat(own, F.reverse("segments")))
    met = asked.join(nodes, F.col("_parent") == F.col("node"), "left")
    return met.withColumn("proof", proof).select(*requests.columns, "proof")


def proof_digest(proof: Column) -> Column:
    """SHA-256 of a proof's digests, one after the other."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` gives with the digests of its proof."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def check_all(manifest: Manifest) -> DataFrame:
    """Every leaf with its proof's digest, and the root that the presented leaf
    (else its own) folds to."""
    wanted = manifest.leaves.select("key", "leaf", "presented", "tree", "path")
    with_proofs = proofs(manifest, wanted)
    subroots = broadcast_if_small(materialize(manifest.groups.select("tree", "subroot"), "subroots"))
    root = F.lit(manifest.root).cast("string")
    folded = fold(F.coalesce("presented", "leaf"), F.col("proof"))
    judged = with_proofs.select("key", "leaf", "tree", proof_digest(F.col("proof")).alias("proof_sha256"), folded.alias("folded_root"))
    return judged.join(subroots, "tree").select(
        "key", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified")
    )


def tampering(text: str = "text") -> Column:
    """``text`` with A-Z in lower case, other characters as they are."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def audit(docs: DataFrame) -> DataFrame:
    """Every document's proof, checked against a copy in which the documents whose
    ``crc32`` of the decimal id 5 divides have lost their capitals."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    manifest = build(docs, presented={"text": tampering()}, where=chosen)
    return check_all(manifest).withColumnRenamed("key", "doc_id")
