"""Operations on file listings: one row per object (path, size, mtime, md5, crc)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.functions.globs import matches_any, matches_wildcard
from flightlake.functions.units import human_size

# Fixed value: most parts that may be joined into one object.
COMPOSE_PARTS = 32

# Bytes of a piece whose checksum one row takes.
PIECE_BYTES = 1 << 16


def list_files(spark: SparkSession, root: str, hashes: bool = False) -> DataFrame:
    """Manifest of a folder tree; file contents are read only for hashes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    # Paths relative to the root, whatever scheme prefix the file system adds.
    base = root.rstrip("/") + "/"
    relative = F.substr(F.col("path"), F.instr("path", base) + F.lit(len(base)))
    columns = [
        relative.alias("path"),
        F.col("length").alias("size"),
        F.unix_seconds("modificationTime").alias("mtime"),
    ]
    if hashes:
        columns += [F.md5("content").alias("md5"), F.crc32("content").alias("crc")]
    return files.select(*columns)


def listing(manifest: DataFrame) -> DataFrame:
    """Objects with readable sizes, and a TOTAL row with their number and bytes."""
    rows = manifest.select("path", "size", human_size(F.col("size")).alias("shown"), F.lit(1).cast("bigint").alias("objects"))
    size = F.coalesce(F.sum("size"), F.lit(0)).alias("size")
    total = manifest.agg(size, F.count(F.lit(1)).alias("objects")).select(
        F.lit("TOTAL").alias("path"), "size", human_size(F.col("size")).alias("shown"), "objects"
    )
    return rows.unionByName(total)


def wildcard(manifest: DataFrame, pattern: str) -> DataFrame:
    return manifest.filter(matches_wildcard(F.col("path"), pattern))


def _prefixes(path: Column) -> Column:
    """All ancestor folders, ``a/`` and ``a/b/`` of ``a/b/c``."""
    levels = F.split(path, "/")
    depths = F.sequence(F.lit(1), F.size(levels) - 1)
    every = F.transform(depths, lambda n: F.concat(F.array_join(F.slice(levels, 1, n), "/"), F.lit("/")))
    return F.when(F.size(levels) > 1, every).otherwise(F.array().cast("array<string>"))


def exclude(manifest: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Without objects that match a pattern, or lie in a folder that does."""
    if not patterns:
        return manifest
    folder = F.exists(_prefixes(F.col("path")), lambda p: matches_any(p, list(patterns)))
    return manifest.filter(~matches_any(F.col("path"), list(patterns)) & ~folder)


def usage(manifest: DataFrame, patterns: Sequence[str] = (), summary_only: bool = False, total: bool = False) -> DataFrame:
    """Bytes of every object and every folder above it (``path, size``).

    Objects are summed per folder first, so only folders are spread over their
    ancestors.  ``summary_only`` keeps the top folders.
    """
    kept = exclude(manifest, patterns)
    folder = F.regexp_extract("path", r"^(.*/)?[^/]*$", 1)
    folders = kept.groupBy(folder.alias("folder")).agg(F.sum("size").alias("size"))
    spread = folders.select(F.explode(_prefixes(F.concat("folder", F.lit("x")))).alias("path"), "size")
    sums = spread.groupBy("path").agg(F.sum("size").alias("size"))
    if summary_only:
        rows = sums.filter(F.col("path").rlike(r"^[^/]*/$")).withColumn("path", F.rtrim("path", F.lit("/")))
    else:
        rows = sums.unionByName(kept.select("path", "size"))
    if total:
        everything = folders.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("size"))
        rows = rows.unionByName(everything.select(F.lit("total").alias("path"), "size"))
    return rows


def hashes(
    objects: DataFrame, content: str = "content", encoding: str = "base64", crc: Callable[[str], Column] = F.crc32
) -> DataFrame:
    """MD5 (base64 or hex) and a CRC of each object's bytes.

    CRC-32 is built in; ``checksums.crc32c`` is the sum that object stores list, at
    about a microsecond a byte.
    """
    md5 = F.md5(content)
    shown = F.base64(F.unhex(md5)) if encoding == "base64" else md5
    return objects.withColumns({"md5": shown, "crc": crc(content)}).drop(content)


def in_pieces(objects: DataFrame, content: str = "content", size: int = PIECE_BYTES) -> DataFrame:
    """Each object's bytes as rows ``start, content`` beside its other columns; an empty one is one piece, a null one too."""
    last = F.greatest(F.octet_length(content) - 1, F.lit(0))
    starts = F.coalesce(F.sequence(F.lit(0), last, F.lit(size)), F.array(F.lit(0)))
    cut = F.transform(starts, lambda s: F.struct(
        s.cast("bigint").alias("start"), F.substring(F.col(content), s + 1, F.lit(size)).alias("content")
    ))
    rest = [c for c in objects.columns if c != content]
    return objects.select(*rest, F.explode(cut).alias("_piece")).select(*rest, "_piece.*")


def sync_plan(
    source: DataFrame,
    target: DataFrame,
    delete_extras: bool = False,
    exclude_patterns: Sequence[str] = (),
    ignore_existing: bool = False,
    skip_older: bool = False,
    use_hashes: bool = False,
) -> DataFrame:
    """What makes ``target`` like ``source``: rows (path, action, copy_size).

    Actions are copy, remove and mtime (contents equal, time missing at the
    target).  Listings need ``path, size, mtime, md5`` and may have ``crc``.
    """
    def side(listing: DataFrame, prefix: str) -> DataFrame:
        kept = listing.filter(~matches_any(F.col("path"), list(exclude_patterns)))
        crc = F.col("crc") if "crc" in listing.columns else F.lit(None).cast("bigint")
        return kept.select(
            "path", F.struct("size", "mtime", "md5", crc.alias("crc")).alias(prefix)
        )

    both = side(source, "s").join(side(target, "t"), "path", "full_outer")
    s, t = (lambda f: F.col(f"s.{f}")), (lambda f: F.col(f"t.{f}"))
    timed = s("mtime").isNotNull() & t("mtime").isNotNull()
    differs = F.lit(False) if ignore_existing else (
        F.when(F.lit(skip_older) & timed & (s("mtime") < t("mtime")), F.lit(False))
        .when(F.lit(not use_hashes) & timed, (s("mtime") != t("mtime")) | (s("size") != t("size")))
        .when(s("size") != t("size"), F.lit(True))
        .when(s("md5").isNotNull() & t("md5").isNotNull(), s("md5") != t("md5"))
        .when(s("crc").isNotNull() & t("crc").isNotNull(), s("crc") != t("crc"))
        .otherwise(F.lit(False))
    )
    only_source, only_target = F.col("t").isNull(), F.col("s").isNull()
    action = (
        F.when(only_source, "copy")
        .when(only_target, F.lit("remove") if delete_extras else F.lit(None).cast("string"))
        .when(differs, "copy")
        .when(s("mtime").isNotNull() & t("mtime").isNull(), "mtime")
    )
    planned = both.select("path", action.alias("action"), F.when(~only_target, s("size")).alias("copy_size"))
    return planned.filter("action is not null")


def lifecycle(manifest: DataFrame, rules: Sequence[tuple[str, int]], now: Column) -> DataFrame:
    """Objects more than ``age`` days old, with the action of the first (action, age) rule that fits."""
    age = F.datediff(now, F.timestamp_seconds("mtime"))
    action = F
    for name, days in rules:
        action = action.when(age > days, F.lit(name))
    if not rules:
        return manifest.filter(F.lit(False)).withColumn("action", F.lit(None).cast("string"))
    return manifest.withColumn("action", action).filter("action is not null")


def compose(parts: DataFrame, target: str, position: str, text: str, separator: str = "") -> DataFrame:
    """Parts joined in order into one text per target; too many parts are an error.

    Parts are counted first, so no oversized group is ever gathered.
    """
    sizes = parts.groupBy(target).agg(F.count(F.lit(1)).alias("_parts"))
    if not sizes.filter(F.col("_parts") > COMPOSE_PARTS).isEmpty():
        raise ValueError(f"more than {COMPOSE_PARTS} parts for one target")
    ordered = F.sort_array(F.collect_list(F.struct(position, text)))
    return parts.groupBy(target).agg(
        F.array_join(F.transform(ordered, lambda p: p[text]), separator).alias(text),
        F.count(F.lit(1)).alias("parts"),
    )
