"""Registered queries of the training-data operators, and SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm import (
    chunk_bpe, decontaminate, hard_negatives, html_text, lm_score, merkle, ngram_join, packing, pii, quality, substring_dedup, topk, warc,
)
from flightlake.session import configure

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        QUERIES[name] = lambda spark, sf: run(configure(spark), sf)
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_packing")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


@query("op3_substring_dedup")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return substring_dedup.digest(substring_dedup.remove_repeats(docs))


@query("op4_ngram_jaccard_join")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op6_quality_rules")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf, "documents"))


@query("op10_exact_top_k")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"))


@query(
    "op5_warc",
    r"""
    WITH sized AS (
      SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
             sha1(coalesce(html, '')) AS payload_digest
      FROM pages),
    kept AS (SELECT payload_digest, payload_bytes, max(page_id) AS best FROM sized WHERE payload_bytes >= 1000 GROUP BY ALL)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN best IS NULL OR best = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN best = page_id THEN NULL ELSE best END AS refers_to
    FROM sized LEFT JOIN kept USING (payload_digest, payload_bytes)
    """,
)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages"))


@query("op9_html_extraction")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    pages = html_text.extract(table(spark, sf, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


@query("op7_personal_data")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf, "documents").select("doc_id", "text")))


@query("op8_bpe_chunk_reuse")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return chunk_bpe.digest(chunk_bpe.encode(table(spark, sf, "documents").select("doc_id", "text")))


@query("op2_lm_scoring")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    good = table(spark, sf, "labels").where("quality = 1")
    return lm_score.score(table(spark, sf, "documents"), good)


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    "op11_decontamination",
    f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS g
      FROM i, unnest(range(1, greatest(len(w) - 10, 0) + 2)) t(p) WHERE len(w) > 0),
    places AS (
      SELECT doc_id, k, p, array_to_string(w[p : p + k - 1], ' ') AS g
      FROM d, (SELECT DISTINCT k FROM windows), unnest(range(1, len(w) - k + 2)) t(p)),
    found AS (SELECT doc_id, k, p, item_id FROM places JOIN windows USING (k, g)),
    hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM found) GROUP BY doc_id),
    named AS (
      SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.find_items(docs, table(spark, sf, "benchmark")))


@query(
    "op12_hard_negatives",
    """
    WITH v AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
             CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    positives AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
           other_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
    QUALIFY rank <= 5
    """,
)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf, "embeddings"), hard_negatives.shifted_label())


def _levels(name: str, keys: str, depth: int) -> str:
    """Node levels above ``{name}0`` ({keys}, pos, n, digest); a lone node stays as it is."""
    steps = []
    for level in range(depth):
        steps.append(f"""
    {name}{level + 1} AS (
      SELECT {keys}, (pos >> 4) AS pos, any_value((n + 15) >> 4) AS n,
             CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE any_value(digest) END AS digest
      FROM {name}{level} GROUP BY {keys}, pos >> 4)""")
    return ",".join(steps)


def _segments(name: str, match: str, place: str, depth: int) -> str:
    """Per level the siblings left and right of the node above a row."""
    parts = []
    for level in range(depth):
        node = f"({place} >> {4 * level})"
        run = f"{name}{level} s WHERE {match} AND s.n > 1 AND (s.pos >> 4) = ({node} >> 4)"
        parts.append(
            f"(SELECT struct_pack(l := coalesce(string_agg(digest, '' ORDER BY s.pos) FILTER (s.pos < {node}), ''), "
            f"r := coalesce(string_agg(digest, '' ORDER BY s.pos) FILTER (s.pos > {node}), ''), used := count(*) > 0) FROM {run})"
        )
    return "[" + ", ".join(parts) + "]"


def _marked(*fields: str) -> str:
    texts = [f"CAST({f} AS VARCHAR)" for f in fields]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({t})) || ':' || {t}, '-')" for t in texts) + ")"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_CRC = """xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
  lambda crc, b: list_reduce(range(8), lambda x, i: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(crc, b)),
  CAST(4294967295 AS BIGINT)))"""
# Up to 16^4 documents of a source and as many sources.
_DEPTH = 4


@query(
    "op13_merkle_manifest",
    f"""
    WITH rows AS (
      SELECT doc_id, source, {_marked("doc_id", "source", "lang", "n_chars", "text")} AS leaf,
             CASE WHEN {_CRC} % 5 = 0 THEN {_marked("doc_id", "source", "lang", "n_chars", _LOWERED)} END AS presented
      FROM documents),
    d0 AS (
      SELECT *, leaf AS digest, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             count(*) OVER (PARTITION BY source) AS n
      FROM rows),
    {_levels("d", "tree", _DEPTH)},
    t0 AS (SELECT 0 AS one, tree AS pos, (SELECT count(DISTINCT tree) FROM d0) AS n, digest FROM d{_DEPTH}),
    {_levels("t", "one", _DEPTH)},
    paths AS (
      SELECT d.doc_id, d.leaf, d.presented, f.digest AS subroot, r.digest AS root,
             list_filter({_segments("d", "s.tree = d.tree", "d.pos", _DEPTH)} || {_segments("t", "true", "d.tree", _DEPTH)}, lambda s: s.used) AS path
      FROM d0 d JOIN d{_DEPTH} f USING (tree), t{_DEPTH} r),
    folded AS (
      SELECT *, list_reduce(list_transform(path, lambda s: [s.l, s.r]), lambda h, s: [sha256(s[1] || h[1] || s[2])], [coalesce(presented, leaf)])[1] AS folded_root
      FROM paths)
    SELECT doc_id, leaf, subroot, root,
           sha256(coalesce(array_to_string(list_transform(path, lambda s: s.l || s.r), ''), '')) AS proof_sha256,
           folded_root, folded_root = root AS verified
    FROM folded
    """,
)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.audit(table(spark, sf, "documents"))
