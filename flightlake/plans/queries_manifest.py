"""Queries of the file-listing operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from flightlake.functions import checksums
from flightlake.functions.units import human_size, short_count
from flightlake.operators import manifest
from flightlake.operators.sizing import spread
from flightlake.plans import views
from flightlake.plans.catalog import query
from flightlake.session import scratch_dir

_HUMAN = """CASE WHEN {n} >= 1048576 THEN format('{{:g}}', round_even({n} / 1048576.0, 2)) || ' MiB'
  WHEN {n} >= 1024 THEN format('{{:g}}', round_even({n} / 1024.0, 2)) || ' KiB' ELSE CAST({n} AS VARCHAR) || ' B' END"""


@query(
    "g_listing",
    f"""SELECT "path", "size", {_HUMAN.format(n='"size"')} AS shown, CAST(1 AS BIGINT) AS objects FROM manifest
        UNION ALL SELECT 'TOTAL', s, {_HUMAN.format(n="s")}, n FROM
          (SELECT CAST(sum("size") AS BIGINT) AS s, CAST(count(*) AS BIGINT) AS n FROM manifest)""",
    "manifest",
)
def _(spark, sf):
    return manifest.listing(views.manifest(spark, sf))


@query(
    "g_listing_files",
    """SELECT "source" || '/' || lang AS folder, CAST(sum(strlen("text") + 1) AS BIGINT) AS bytes FROM documents GROUP BY 1""",
)
def _(spark, sf):
    """Documents written as text files, then listed from the file system."""
    root = scratch_dir(spark, "files")
    docs = views.table(spark, sf, "documents").select("source", "lang", F.col("text").alias("value"))
    docs.hint("rebalance", "source", "lang").write.partitionBy("source", "lang").text(root)
    files = manifest.list_files(spark, root).filter("path like '%.txt'")
    folder = F.regexp_replace(F.regexp_extract("path", r"^(.*)/[^/]*$", 1), "(source|lang)=", "")
    return files.groupBy(folder.alias("folder")).agg(F.sum("size").alias("bytes"))


# Pattern and the same rule as a plain regular expression.
_PATTERNS = {
    "src1*/en/*.txt": r"src1[^/]*/en/[^/]*\.txt",
    "src?/**/1*.txt": r"src[^/]/(.*/)?1.*\.txt",
    "**/9?.txt": r"(.*/)?9.\.txt",
    "src[0-4]/[!e]*/*": r"src[0-4]/[^e][^/]*/[^/]*",
    "*.txt": r"[^/]*\.txt",
}


@query(
    "g_wildcard",
    " UNION ALL ".join(
        f"""SELECT '{p}' AS pattern, "path" FROM manifest WHERE regexp_full_match("path", '{r}')""" for p, r in _PATTERNS.items()
    ),
    "manifest",
)
def _(spark, sf):
    objects = views.manifest(spark, sf)
    found = [manifest.wildcard(objects, p).select(F.lit(p).alias("pattern"), "path") for p in _PATTERNS]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows


@query(
    "g_exclude",
    """SELECT "path", "size" FROM manifest WHERE NOT regexp_full_match("path", 'src1.*|.*/fr/.*7\\.txt')""",
    "manifest",
)
def _(spark, sf):
    return manifest.exclude(views.manifest(spark, sf), ["src1*", "*/fr/*7.txt"]).select("path", "size")


@query(
    "g_du",
    """SELECT "path", "size" FROM manifest
       UNION ALL SELECT src || '/', CAST(sum("size") AS BIGINT) FROM manifest GROUP BY src
       UNION ALL SELECT src || '/' || lang || '/', CAST(sum("size") AS BIGINT) FROM manifest GROUP BY src, lang
       UNION ALL SELECT 'total', CAST(sum("size") AS BIGINT) FROM manifest""",
    "manifest",
)
def prefix_usage(spark, sf):
    return manifest.usage(views.manifest(spark, sf), total=True)


@query(
    "g_du_summary",
    """SELECT src AS "path", CAST(sum("size") AS BIGINT) AS "size" FROM manifest WHERE lang <> 'de' GROUP BY src
       UNION ALL SELECT 'total', CAST(sum("size") AS BIGINT) FROM manifest WHERE lang <> 'de'""",
    "manifest",
)
def _(spark, sf):
    return manifest.usage(views.manifest(spark, sf), ["*/de/"], summary_only=True, total=True)


@query(
    "g_human_size",
    f"""SELECT "path", {_HUMAN.format(n='("size" * 97)')} AS shown,
        CASE WHEN "size" * 97 >= 1000000 THEN printf('%.1f', CAST(round_even("size" * 97 / 1000000.0, 1) AS DOUBLE)) || 'm'
          WHEN "size" * 97 >= 1000 THEN printf('%.1f', CAST(round_even("size" * 97 / 1000.0, 1) AS DOUBLE)) || 'k'
          ELSE CAST("size" * 97 AS VARCHAR) END AS short
        FROM manifest""",
    "manifest",
)
def _(spark, sf):
    # Sizes are blown up so that three units occur.
    size = F.col("size") * 97
    return views.manifest(spark, sf).select(
        "path", human_size(size).alias("shown"), short_count(size).alias("short")
    )


@query(
    "g_hash",
    """SELECT doc_id, to_base64(unhex(md5("text"))) AS md5_base64, md5("text") AS md5_hex FROM documents""",
)
def _(spark, sf):
    content = F.col("text").cast("binary")
    docs = views.table(spark, sf, "documents").select("doc_id", content.alias("content"), content.alias("again"))
    short = manifest.hashes(docs).withColumnRenamed("md5", "md5_base64")
    both = manifest.hashes(short, "again", "hex").withColumnRenamed("md5", "md5_hex")
    return both.select("doc_id", "md5_base64", "md5_hex")


_CRC32C = f"""SELECT doc_id, "size", crc32c, to_base64(unhex(lpad(to_hex(crc32c), 8, '0'))) AS shown FROM (
  SELECT doc_id, "size", xor(list_reduce(list_prepend({checksums.START}, bytes), lambda c, b:
      xor(({checksums.byte_table()}::BIGINT[])[(xor(c, b) & 255) + 1], c >> 8)), {checksums.START}) AS crc32c
  FROM (SELECT doc_id, CAST(strlen("text") AS BIGINT) AS "size",
    list_transform(regexp_extract_all(hex(encode("text")), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS bytes FROM documents))"""


@query("g_crc32c", _CRC32C)
def _(spark, sf):
    content = F.col("text").cast("binary")
    docs = spread(views.table(spark, sf, "documents").select("doc_id", content.alias("content")))
    sized = docs.withColumn("size", F.octet_length("content").cast("bigint"))
    summed = manifest.hashes(sized, crc=checksums.crc32c).withColumnRenamed("crc", "crc32c")
    return summed.select("doc_id", "size", "crc32c", checksums.crc_text("crc32c").alias("shown"))


@query("g_crc32c_pieces", _CRC32C)
def _(spark, sf):
    """The same sums from pieces, which may lie in any order in any task."""
    docs = views.table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    pieces = manifest.in_pieces(spread(docs), size=4096).hint("rebalance", "start")
    summed = checksums.crc32c_of_pieces(pieces, "doc_id")
    return summed.select("doc_id", "size", "crc32c", checksums.crc_text("crc32c").alias("shown"))


def _plan_sql(removes: str, differs: str) -> str:
    return f"""SELECT * FROM (SELECT coalesce(s."path", t."path") AS "path",
      CASE WHEN t."path" IS NULL THEN 'copy' WHEN s."path" IS NULL THEN {removes} WHEN {differs} THEN 'copy'
        WHEN s."mtime" IS NOT NULL AND t."mtime" IS NULL THEN 'mtime' END AS action, s."size" AS copy_size
      FROM manifest s FULL JOIN manifest_copy t ON s."path" = t."path") WHERE action IS NOT NULL"""


@query(
    "g_rsync_plan",
    _plan_sql(
        "'remove'",
        """CASE WHEN s."mtime" IS NOT NULL AND t."mtime" IS NOT NULL THEN s."mtime" <> t."mtime" OR s."size" <> t."size"
           WHEN s."size" <> t."size" THEN true ELSE s."md5" <> t."md5" END""",
    ),
    "manifest", "manifest_copy",
)
def sync(spark, sf):
    return manifest.sync_plan(views.manifest(spark, sf), views.manifest_copy(spark, sf), delete_extras=True)


@query(
    "g_rsync_plan_keep",
    f"""SELECT * FROM ({_plan_sql("NULL", '''s."size" <> t."size" OR s."md5" <> t."md5"''')})
        WHERE NOT regexp_full_match("path", '.*/fr/.*')""",
    "manifest", "manifest_copy",
)
def _(spark, sf):
    return manifest.sync_plan(
        views.manifest(spark, sf), views.manifest_copy(spark, sf), exclude_patterns=["*/fr/*"], use_hashes=True
    )


@query(
    "g_lifecycle",
    """SELECT "path", "size", "mtime", "md5", CASE WHEN age > 365 THEN 'Delete' ELSE 'Review' END AS action FROM
       (SELECT *, date_diff('day', CAST(make_timestamp("mtime" * 1000000) AS DATE), DATE '2024-11-14') AS age FROM manifest)
       WHERE age > 360""",
    "manifest",
)
def _(spark, sf):
    rules = [("Delete", 365), ("Review", 360)]
    return manifest.lifecycle(views.manifest(spark, sf), rules, F.lit("2024-11-14").cast("timestamp"))


@query(
    "g_compose",
    """SELECT conv_id, string_agg("text", chr(10) ORDER BY turn) AS "text", CAST(count(*) AS BIGINT) AS parts
       FROM conversations GROUP BY conv_id""",
)
def _(spark, sf):
    return manifest.compose(views.table(spark, sf, "conversations"), "conv_id", "turn", "text", "\n")
