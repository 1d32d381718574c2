"""Tables that change in one step: immutable files, and a manifest for every version.

A manifest lists the files of a version. It is written to a hidden folder and renamed to the next
version's name, which is the commit: before it readers see the old version, after it the new one,
and a writer that fails at any step before has changed nothing. Of two writers that start from one
version the second finds the name taken and starts again, or fails if its change no longer holds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sinks.tables import fit_columns
from tidemark.storage import (
    exists,
    file_paths,
    folder_names,
    for_each,
    listed,
    make_folder,
    new_folder,
    remove_folder,
    rename_new,
    stored,
)

# One entry of a manifest: a file with its tag, the columns (as JSON), or an applied batch.
ENTRY = "kind string, tag string, path string"
FILE, COLUMNS, APPLIED = "file", "columns", "applied"
TAG = "_version_tag"
# The end of a file's path that a manifest lists: data, folder, tag and file.
PATH_PARTS = -4
# Keys of a delete that every task holds, and that one task holds of those that are dealt out,
# which are few beside the rows.
BROADCAST_KEYS = 1 << 17
TASK_KEYS = 1 << 21
ROWS_A_KEY = 4


class VersionConflict(RuntimeError):
    """Another writer committed first, and the change has to be made anew."""


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    root: str

    def version(self) -> int:
        """The newest version; 0 if there is none. A listing that fails raises."""
        if not exists(self.spark, f"{self.root}/manifests"):
            return 0
        names = folder_names(self.spark, f"{self.root}/manifests")
        return max((int(name[1:]) for name in names if name.startswith("v")), default=0)

    def entries(self, version: int | None = None) -> DataFrame:
        """The manifest of a version, the newest one by default."""
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(self._manifest(version))

    def read(self, version: int | None = None, tags: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version, or of some tags of it. Only file names pass the driver."""
        entries = self.entries(version)
        columns = self._columns(entries)
        if columns is None:
            raise FileNotFoundError(f"{self.root} has no version")
        files = entries.where(F.col("kind") == FILE)
        if tags is not None:
            files = files.where(F.col("tag").isin(list(tags)))
        return self._rows(files, columns)

    def append(self, df: DataFrame, tag: str = "", batch: str | None = None) -> int:
        """Add rows; return the new version. A ``batch`` that is applied already adds nothing."""
        return self._change(df, lambda files: files, F.lit(tag), batch)

    def replace(self, df: DataFrame, tag: str, batch: str | None = None) -> int:
        """Put ``df`` in the place of all rows of ``tag``; return the new version."""
        return self._change(
            df, lambda files: files.where(F.col("tag") != tag), F.lit(tag), batch
        )

    def merge(
        self, change: Callable[[DataFrame], DataFrame], tag: Column, tags: Sequence[str],
        rows: StructType, batch: str | None = None,
    ) -> int:
        """Put ``change`` of the rows of ``tags`` in their place, each row under its ``tag``.

        Files of other tags are not read or written. Another writer's commit in between means that
        the rows have changed, so the change is made anew.
        """
        while True:
            base = self.version()
            entries = self.entries(base)
            if batch is not None and self._applied(entries, batch):
                return base
            inside = F.col("tag").isin(list(tags))
            files = entries.where(F.col("kind") == FILE)
            old = self._rows(files.where(inside), self._columns(entries) or rows)
            try:
                return self._commit(
                    base, change(old), files.where(~inside), tag, entries, batch, rows
                )
            except VersionConflict:
                continue

    def delete(self, keys: DataFrame, columns: Sequence[str]) -> tuple[int, int]:
        """Delete the rows whose ``columns`` are among ``keys``; return the new version and the
        number of files rewritten.

        Only the columns are read to find the files that hold a key; only these files are rewritten.
        NULL is no key. Without such a file nothing is committed. Files are told apart by a hash of
        their path while they are looked for; two that had the same would both be rewritten.
        """
        base = self.version()
        entries = self.entries(base)
        kinds = self._columns(entries)
        files = entries.where(F.col("kind") == FILE)
        wanted = keys.select(*columns).dropna().distinct()
        wanted = stored(wanted, new_folder(self.spark, "keys"))
        rows = self._rows(files, kinds)
        wanted = self._streamed_past(wanted, rows)
        path = F.substring_index(F.col("_metadata.file_path"), "/", PATH_PARTS)
        held = rows.select(*columns, F.xxhash64(path).alias("_file"))
        held = held.join(wanted, list(columns), "left_semi").select("_file").distinct()
        touched = files.withColumn("_file", F.xxhash64("path")).join(held, "_file", "left_semi")
        touched = stored(touched.select("path"), new_folder(self.spark, "touched"))
        amount = touched.count()
        if not amount:
            return base, 0
        hit = files.join(touched, "path", "left_semi")
        left = self._rows(hit, kinds).join(wanted, list(columns), "left_anti").select(*kinds.names)
        others = files.join(touched, "path", "left_anti")
        tags = [row["tag"] for row in hit.select("tag").distinct().collect()]
        if len(tags) == 1:
            return self._commit(base, left, others, F.lit(tags[0]), entries, None, kinds), amount
        # A row keeps the tag of the file that it comes from.
        path = F.substring_index("_from", "/", PATH_PARTS)
        tagged = self._rows(hit, kinds).withColumn("_from", F.col("_metadata.file_path"))
        tagged = tagged.join(wanted, list(columns), "left_anti").withColumn("_path", path)
        named = hit.select(F.col("path").alias("_path"), F.col("tag").alias(TAG))
        left = tagged.join(named, "_path").select(*kinds.names, TAG)
        return self._commit(base, left, others, F.col(TAG), entries, None, kinds), amount

    def checkpoint(self, df: DataFrame, applied: DataFrame, base: int) -> int:
        """Put ``df`` in the place of all rows of version ``base``, and the names ``applied`` (tag)
        in that of its applied batches; fails if there is a later version."""
        names = applied.select(F.lit(APPLIED).alias("kind"), "tag", F.lit("").alias("path"))
        added = self._write(df, F.lit(""))
        if not self._publish(base, added, names, None, df.schema):
            raise VersionConflict(f"{self.root} has a version after {base}")
        return base + 1

    def expire(self, keep: int = 1) -> int:
        """Remove all versions but the ``keep`` newest, and files that only they list; return how
        many files went. Readers of a version that goes must have ended."""
        newest = self.version()
        names = sorted(
            name
            for name in folder_names(self.spark, f"{self.root}/manifests")
            if name.startswith("v") and int(name[1:]) <= newest - keep
        )
        if not names:
            return 0
        paths = [f"{self.root}/manifests/{name}" for name in names]
        stay = [self._manifest(v) for v in range(max(1, newest - keep + 1), newest + 1)]
        old, new = (self.spark.read.schema(ENTRY).parquet(*group) for group in (paths, stay))
        gone = old.where(F.col("kind") == FILE).select("path").distinct()
        gone = gone.join(new.select("path"), "path", "left_anti")
        gone = [row["path"] for row in gone.collect()]
        for_each(partial(remove_folder, self.spark), paths)
        for_each(lambda path: remove_folder(self.spark, f"{self.root}/{path}"), gone)
        return len(gone)

    def _streamed_past(self, wanted: DataFrame, rows: DataFrame) -> DataFrame:
        """``wanted`` (stored, distinct) marked so that a join of ``rows`` keeps it in memory and
        sorts none of ``rows``, whose sort takes the memory of a task for all rows dealt to it.

        Few keys go to all tasks. Others are dealt out with the rows, and a task holds its part,
        which adaptive execution merges to no more than a share of its target size. Where this part
        would be large, both sides are sorted, which spills.
        """
        count = wanted.count()
        if count <= BROADCAST_KEYS:
            return F.broadcast(wanted)
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if count <= TASK_KEYS * parts and ROWS_A_KEY * count <= rows.count():
            return wanted.hint("shuffle_hash")
        return wanted.hint("merge")

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifests/v{version:012d}"

    def _columns(self, entries: DataFrame) -> StructType | None:
        row = entries.where(F.col("kind") == COLUMNS).first()
        return StructType.fromJson(json.loads(row["path"])) if row else None

    def _applied(self, entries: DataFrame, batch: str) -> bool:
        return not entries.where((F.col("kind") == APPLIED) & (F.col("tag") == batch)).isEmpty()

    def _rows(self, files: DataFrame, columns: StructType) -> DataFrame:
        paths = [f"{self.root}/{row['path']}" for row in files.select("path").toLocalIterator()]
        if not paths:
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(*paths)

    def _change(
        self, df: DataFrame, kept: Callable[[DataFrame], DataFrame], tag: Column, batch: str | None
    ) -> int:
        """Commit rows that do not hang on those of the table; files are written once."""
        written = None
        while True:
            base = self.version()
            entries = self.entries(base)
            if batch is not None and self._applied(entries, batch):
                return base
            columns = self._columns(entries)
            df = fit_columns(df, columns) if columns else df
            written = written or self._write(df, tag)
            files = kept(entries.where(F.col("kind") == FILE)).unionByName(written)
            if self._publish(base, files, entries, batch, df.schema):
                return base + 1

    def _commit(self, base, df, files, tag, entries, batch, columns) -> int:
        # The columns of the table in their order, and the tag's own column if there is one.
        added = self._write(df, tag)
        if not self._publish(base, files.unionByName(added), entries, batch, columns):
            raise VersionConflict(f"{self.root} has a version after {base}")
        return base + 1

    def _write(self, df: DataFrame, tag: Column) -> DataFrame:
        """Write rows to a folder that no version lists yet; its files as manifest entries."""
        folder = f"data/{uuid.uuid4().hex}"
        rows = df.withColumn("tag", tag.cast("string")).drop(TAG)
        rows.write.partitionBy("tag").parquet(f"{self.root}/{folder}")
        paths = (f"{folder}/{path}" for path in file_paths(self.spark, f"{self.root}/{folder}"))
        entries = listed(self.spark, paths, "path")
        tag = F.regexp_extract("path", "/tag=([^/]*)/", 1)
        tag = F.when(tag == "__HIVE_DEFAULT_PARTITION__", F.lit("")).otherwise(tag)
        return entries.select(F.lit(FILE).alias("kind"), tag.alias("tag"), "path")

    def _publish(self, base, files, entries, batch, columns) -> bool:
        """Write the manifest of the next version beside and rename it; False if it is there."""
        applied = entries.where(F.col("kind") == APPLIED)
        rows = [(COLUMNS, "", columns.json())] + ([(APPLIED, batch, "")] if batch else [])
        manifest = files.unionByName(applied).unionByName(self.spark.createDataFrame(rows, ENTRY))
        make_folder(self.spark, f"{self.root}/manifests")
        beside = f"{self.root}/manifests/_{uuid.uuid4().hex}"
        manifest.coalesce(1).write.parquet(beside)
        if rename_new(self.spark, beside, self._manifest(base + 1)):
            return True
        remove_folder(self.spark, beside)
        return False
