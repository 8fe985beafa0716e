"""Which files of a growing table hold rows of which insert request.

The log lies inside the table's folder under a hidden name, so whoever replaces the
table replaces it too.  It is filled from the files themselves before a request looks
for its rows: files written since (by whom ever, also by a request that was cut short)
are read once, one narrow column of them.  A file is therefore never passed over because
the log does not know it, and a later request reads only the files that hold rows of
the same request.  Entries are exact, one per file and request.  One request at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.operators import versions

_LOG = "_requests"


def _plain(name: str) -> str:
    """One spelling of a file's address: there are ``file:/a`` and ``file:///a``, and spaces as ``%20``."""
    return unquote(re.sub(r"^([A-Za-z0-9]+):/+", r"\1:/" if name.startswith("file:") else r"\1://", name))


def _entries(spark: SparkSession, files: Iterable[str]) -> DataFrame:
    """(file, request) of the given files; the request is null where rows have no insert id."""
    request = F.regexp_extract("insert_id", r"(?s)^(.*)_[0-9]+$", 1)
    return spark.read.schema("insert_id string").parquet(*files).select(
        F.col("_metadata.file_path").alias("file"), F.when(F.col("insert_id").isNotNull(), request).alias("request")
    ).distinct()


def files_of(stored: DataFrame, path: str, request: str) -> list[str]:
    """Files of the table at ``path`` that hold rows of ``request``; brings the log up to date.

    What reaches the driver are file names, which it lists anyway to plan a read.  The
    log is made anew once most of the files it names are gone.
    """
    spark, log = stored.sparkSession, f"{path}/{_LOG}"
    there = {_plain(f) for f in stored.select("insert_id").inputFiles()}
    known = versions.current(spark, log)
    logged = {_plain(r.file) for r in known.select("file").distinct().toLocalIterator()} if known is not None else set()
    if len(logged & there) < len(logged) / 2:
        known, logged = None, set()
    if there - logged:
        added = _entries(spark, sorted(there - logged))
        known = versions.replace((added if known is None else known.unionByName(added)).coalesce(1), log)
    if known is None:
        return []
    return sorted({_plain(r.file) for r in known.filter(F.col("request") == request).collect()} & there)
