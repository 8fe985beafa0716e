"""A stored aggregate that is refreshed by what is new in its table.

Every file of the table is aggregated once: its partial rows (one per file and group)
are kept.  A refresh lists the table's files, aggregates those that were added, and
merges their partial rows into the last version's groups.  Where files have gone, the
groups they took part in are made anew from the partial rows of the files that are
left, so least and largest values stay right and sums do not drift; a group without
rows vanishes.  No other file of the table is read again.

A version counts once its line is in the log; what a refresh that failed has left is
written over by the next.  Versions that were replaced longer ago than ``grace``
seconds are removed: nobody reads them any more.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from flightlake.operators.sizing import broadcast_if_small
from flightlake.operators.tables import existing
from flightlake.session import materialize, remove
from flightlake.sources.loads import file_path

_LOG = "version bigint, refreshed_at double"
_FILES = "file string, present boolean"


def _plain(uri: str) -> str:
    """A file's address in the form rows give it: without escapes, local ones with one slash."""
    return re.sub(r"^file:/+", "file:/", unquote(uri))


class Refresh(NamedTuple):
    version: int
    added: int  # files read
    removed: int  # files gone


class IncrementalView:
    """``aggregates`` maps a result column to (count, sum, min, max or avg; column)."""

    def __init__(
        self,
        source: str,
        path: str,
        keys: Sequence[str],
        aggregates: Mapping[str, tuple[str, str]],
        max_staleness: float = 0.0,
        grace: float = 3600.0,
    ):
        self.source, self.path, self.keys, self.aggregates = source, path, list(keys), dict(aggregates)
        self.max_staleness, self.grace = max_staleness, grace

    # partial values: how each is made from rows, and put together from others
    def _parts(self) -> dict[str, tuple[Column, Column]]:
        parts = {"_rows": (F.count(F.lit(1)), F.sum("_rows"))}
        for name, (kind, column) in self.aggregates.items():
            if kind in ("sum", "avg"):
                parts[f"{name}_sum"] = F.sum(column), F.sum(f"{name}_sum")
            if kind in ("count", "avg"):
                parts[f"{name}_count"] = F.count(column), F.sum(f"{name}_count")
            if kind in ("min", "max"):
                least = F.min if kind == "min" else F.max
                parts[f"{name}_{kind}"] = least(column), least(f"{name}_{kind}")
            if kind not in ("sum", "avg", "count", "min", "max"):
                raise ValueError(f"no such aggregate: {kind}")
        return parts

    def _merged(self, partial: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in partial.schema}
        return partial.groupBy(*self.keys).agg(*[merge.cast(kinds[n]).alias(n) for n, (_, merge) in self._parts().items()])

    def _log(self, spark: SparkSession) -> list[Row]:
        log = existing(spark, f"{self.path}/log")
        return log.orderBy("version").collect() if log is not None else []

    def _same(self, renamed: str) -> Column:
        same = F.lit(True)
        for key in self.keys:
            same = same & F.col(key).eqNullSafe(F.col(f"{renamed}{key}"))
        return same

    def refresh(self, spark: SparkSession, now: float) -> Refresh:
        """Take in the files that came and leave out those that went; a view without changes stays as it is."""
        log = self._log(spark)
        last = log[-1]["version"] if log else -1
        table = existing(spark, self.source)
        present = [_plain(f) for f in table.inputFiles()] if table is not None else []  # Spark's own listing
        if not present and not log:
            raise ValueError(f"no table at {self.source}")
        known = set(self._live(spark, last)) if log else set()
        added, gone = sorted(set(present) - known), sorted(known - set(present))
        if log and not added and not gone:
            self._write_log(spark, last, now)
            return Refresh(last, 0, 0)
        version = last + 1
        changes = [(f, True) for f in added] + [(f, False) for f in gone]
        spark.createDataFrame(changes, _FILES).write.mode("overwrite").parquet(f"{self.path}/files/version={version}")
        groups = [spark.read.parquet(f"{self.path}/groups-{last}")] if log else []
        if added:
            rows = spark.read.option("basePath", self.source).schema(table.schema).parquet(*added)
            made = rows.groupBy(file_path().alias("file"), *self.keys).agg(*[m.alias(n) for n, (m, _) in self._parts().items()])
            made.write.mode("overwrite").parquet(f"{self.path}/parts/version={version}")
        else:  # what a refresh that failed may have left
            remove(spark, f"{self.path}/parts/version={version}")
        parts = self._partials(spark, version)
        new = parts.where(F.col("version") == version).drop("file", "version")
        if gone:
            away = broadcast_if_small(spark.createDataFrame([(f,) for f in gone], "gone string"))
            if self.keys:
                touched = parts.join(away, F.col("file") == F.col("gone")).select(*[F.col(k).alias(f"_{k}") for k in self.keys]).distinct()
                touched = broadcast_if_small(materialize(touched, "touched"))
            left = parts.where(F.col("version") < version).join(away, F.col("file") == F.col("gone"), "left_anti").drop("file", "version")
            if self.keys:
                groups = [g.join(touched, self._same("_"), "left_anti") for g in groups] + [left.join(touched, self._same("_"), "left_semi")]
            else:
                groups = [left]
        merged = self._merged(_union([*groups, new])).where(F.col("_rows") > 0)
        merged.write.mode("overwrite").parquet(f"{self.path}/groups-{version}")
        self._write_log(spark, version, now)
        self._prune(spark, log, version, now)
        return Refresh(version, len(added), len(gone))

    def _partials(self, spark: SparkSession, version: int) -> DataFrame:
        """Partial rows up to this version, without those of files that had gone before it."""
        parts = spark.read.parquet(f"{self.path}/parts").where(F.col("version") <= version)
        files = spark.read.schema(f"{_FILES}, version bigint").parquet(f"{self.path}/files")
        gone = files.where((F.col("version") < version) & ~F.col("present")).groupBy(F.col("file").alias("_file")).agg(F.max("version").alias("_until"))
        ended = (F.col("file") == F.col("_file")) & (F.col("version") < F.col("_until"))
        return parts.join(broadcast_if_small(materialize(gone, "gone")), ended, "left_anti")

    def _live(self, spark: SparkSession, version: int) -> list[str]:
        files = spark.read.schema(f"{_FILES}, version bigint").parquet(f"{self.path}/files").where(F.col("version") <= version)
        live = files.groupBy("file").agg(F.max_by("present", "version").alias("present")).where("present")
        return [r["file"] for r in live.select("file").collect()]  # as long as Spark's own listing

    def _write_log(self, spark: SparkSession, version: int, now: float) -> None:
        spark.createDataFrame([(version, float(now))], _LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def _prune(self, spark: SparkSession, log: list[Row], version: int, now: float) -> None:
        replaced = {a["version"]: b["refreshed_at"] for a, b in zip(log, [*log[1:], Row(version=version, refreshed_at=now)]) if a["version"] != b["version"]}
        for old, since in replaced.items():
            if now - since > self.grace:
                remove(spark, f"{self.path}/groups-{old}")

    def read(self, spark: SparkSession, now: float) -> DataFrame:
        """The stored groups, refreshed first when they are staler than allowed."""
        log = self._log(spark)
        if not log or now - max(r["refreshed_at"] for r in log) > self.max_staleness:
            version = self.refresh(spark, now).version
        else:
            version = log[-1]["version"]
        stored = spark.read.parquet(f"{self.path}/groups-{version}")
        shown = []
        for name, (kind, _) in self.aggregates.items():
            value = F.col(f"{name}_sum") / F.col(f"{name}_count") if kind == "avg" else F.col(f"{name}_{kind}")
            shown.append(value.alias(name))
        return stored.select(*self.keys, *shown)


def _union(frames: list[DataFrame]) -> DataFrame:
    every = frames[0]
    for frame in frames[1:]:
        every = every.unionByName(frame)
    return every
