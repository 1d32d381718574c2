"""Group totals that are kept across runs, changed by every new file's own sums."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.projections import column
from tidemark.storage import new_folder, stored
from tidemark.versions import VersionedTable

COUNT, TOTAL = "rows", "total"


@dataclass(frozen=True)
class RunningTotals:
    """Rows and the sum of ``measure`` for every group of ``keys``, over all files ever applied.

    The groups lie in ``buckets`` by the hash of their keys, each a tag of a versioned table. A
    batch is summed on its own first, combined map-side, so a group enters as one row however many
    rows it has. Only buckets that the batch has groups of are read and written again; the new files
    and the batch's name are committed in one step, so a batch counts once, retried or not.
    """

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    measure: str
    buckets: int = 64

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(self.spark, self.root)

    def _bucket(self) -> Column:
        hashed = F.xxhash64(*[column(key) for key in self.keys])
        return F.pmod(hashed, F.lit(self.buckets)).cast("string")

    def _schema(self, rows: DataFrame) -> StructType:
        return rows.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias(COUNT), F.sum(column(self.measure)).alias(TOTAL)
        ).schema

    def apply(self, rows: DataFrame, batch: str) -> int:
        """Add the rows of one batch; return the table's version. NULL keys form one group, NULL
        measures are skipped, a group without a measure has the total NULL."""
        sums = rows.groupBy(*self.keys).agg(
            F.count(F.lit(1)).alias(COUNT), F.sum(column(self.measure)).alias(TOTAL)
        )
        sums = stored(sums, new_folder(self.spark, "sums"))
        touched = [row[0] for row in sums.select(self._bucket()).distinct().collect()]

        def added(old: DataFrame) -> DataFrame:
            both = old.unionByName(sums)
            return both.groupBy(*self.keys).agg(
                F.sum(COUNT).alias(COUNT), F.sum(TOTAL).cast(old.schema[TOTAL].dataType).alias(TOTAL)
            )

        return self.table.merge(added, self._bucket(), touched, self._schema(rows), batch)

    def apply_files(self, files: Iterable[str], schema: StructType) -> int:
        """Apply Parquet files one by one, each under its path; those applied before are left out.
        Return how many were new."""
        done = {
            row["tag"]
            for row in self.table.entries().where("kind = 'applied'").select("tag").collect()
        }
        new = [path for path in dict.fromkeys(files) if path not in done]
        for path in new:
            self.apply(self.spark.read.schema(schema).parquet(path), path)
        return len(new)

    def read(self) -> DataFrame:
        return self.table.read()

    def on_rows(self, rows: DataFrame, out: str) -> DataFrame:
        """``rows`` with the group's total over all runs. A key with most of the rows meets one row;
        adaptive execution splits it. An existing column ``out`` is replaced."""
        names = [f"_key{i}" for i in range(len(self.keys))]
        totals = self.read().select(
            *[column(key).alias(name) for key, name in zip(self.keys, names)],
            F.col(TOTAL).alias("_sum"),
        )
        same = [column(key).eqNullSafe(F.col(name)) for key, name in zip(self.keys, names)]
        return rows.drop(out).join(totals, reduce(and_, same), "left").select(
            *[column(name) for name in rows.columns if name != out], F.col("_sum").alias(out)
        )

