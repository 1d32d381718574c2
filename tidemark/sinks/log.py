"""An append log of registry entries that is folded into checkpoints."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.storage import exists, file_paths, for_each, listed, remove_folder, write_as_file
from tidemark.versions import APPLIED, VersionedTable

# Entries of one checkpoint file.
FILE_ROWS = 1_000_000


@dataclass(frozen=True)
class RegistryLog:
    """Entries, each written to a file of its own, so writers never meet; `compact` folds them.

    A checkpoint is a version of a table with all entries folded so far and, as its watermark, the
    names of the files that it has folded and that may still be there. Those files are removed by
    the next compaction, so a reader that has resolved the version before still finds them.
    """

    spark: SparkSession
    root: str
    schema: StructType

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/checkpoint")

    def append(self, entry: DataFrame) -> None:
        """Add the one row of ``entry``."""
        write_as_file(entry, f"{self.root}/log/{uuid.uuid4().hex}.parquet")

    def read(self) -> DataFrame:
        """All entries: the newest checkpoint and the files that it does not hold."""
        version = self.table.version()
        tail = self._rows(self._unfolded(version))
        return self.table.read(version).unionByName(tail) if version else tail

    def files(self) -> int:
        """Files that `read` opens."""
        version = self.table.version()
        held = self.table.entries(version).where("kind = 'file'").count()
        return held + self._unfolded(version).count()

    def compact(self) -> int:
        """Fold all files that are there; return how many. A compaction that another one overtakes
        fails and changes nothing."""
        version = self.table.version()
        done = [row["tag"] for row in self._folded(version).collect()]
        new = self._unfolded(version)
        amount = new.count()
        if not amount and not done:
            return 0
        both = self._rows(new)
        if version:
            both = self.table.read(version).unionByName(both)
        parts = max(1, -(-both.count() // FILE_ROWS))
        self.table.checkpoint(both.coalesce(parts), new, version)
        for_each(partial(remove_folder, self.spark), (f"{self.root}/log/{name}" for name in done))
        return amount

    def _folded(self, version: int) -> DataFrame:
        return self.table.entries(version).where(F.col("kind") == APPLIED).select("tag")

    def _unfolded(self, version: int) -> DataFrame:
        folder = f"{self.root}/log"
        names = file_paths(self.spark, folder) if exists(self.spark, folder) else ()
        there = listed(self.spark, (name for name in names if "/" not in name), "tag")
        return there.join(self._folded(version), "tag", "left_anti")

    def _rows(self, names: DataFrame) -> DataFrame:
        paths = [f"{self.root}/log/{row['tag']}" for row in names.collect()]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)
