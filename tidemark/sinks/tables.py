"""Row sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, StructType

from tidemark.functions import check_name
from tidemark.operators.projections import column, stamp
from tidemark.operators.sketches import distinct_sketch
from tidemark.storage import exists, folder_names, remove_folder


def partition_folder(path: str, partition_name: str) -> str:
    return f"{path.rstrip('/')}/partition_name={check_name(partition_name)}"


def write_runs(df: DataFrame, path: str) -> None:
    """Write rows that carry their ``partition_name`` to the serving table.

    A new name is added, a name already there is replaced, all others stay. Rows are not
    shuffled: every task writes its own files, so a name with most of the rows is no
    bottleneck.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("partition_name")
        .parquet(path)
    )


def _columns_of(spark: SparkSession, path: str, except_for: str) -> StructType | None:
    """Columns of a serving table, from any one of its other runs; None without one."""
    if not exists(spark, path):
        return None
    own = partition_folder("", except_for).lstrip("/")
    runs = (n for n in folder_names(spark, path) if n.startswith("partition_name=") and n != own)
    run = next(runs, None)
    return spark.read.parquet(f"{path.rstrip('/')}/{run}").schema if run else None


# Type changes that keep every value; guessed types differ in this way between files.
WIDENED = {(IntegerType(), LongType()), (IntegerType(), DoubleType()), (FloatType(), DoubleType())}


def fit_columns(df: DataFrame, table: StructType) -> DataFrame:
    """``df`` with the columns of ``table``, matched by name.

    A column that ``df`` lacks becomes NULL, a narrower number is widened. A column that the
    table lacks, or of another type, is an error: the rows could not be read back together
    with the others.
    """
    present = {name.lower(): name for name in df.columns}
    extra = present.keys() - {f.name.lower() for f in table.fields}
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    other = [
        f.name
        for f in table.fields
        if f.name.lower() in present
        and kinds[f.name.lower()] != f.dataType
        and (kinds[f.name.lower()], f.dataType) not in WIDENED
    ]
    if extra or other:
        raise ValueError(f"table lacks {sorted(extra)}, has other types for {other}")
    return df.select(
        *[
            column(present[f.name.lower()]).cast(f.dataType).alias(f.name)
            if f.name.lower() in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in table.fields
        ]
    )


def fit_to_table(df: DataFrame, path: str, partition_name: str) -> DataFrame:
    """``df`` as `write_serving` writes it: with the columns of the table's other runs."""
    rows = df.drop("partition_name")
    table = _columns_of(df.sparkSession, path, partition_name)
    return fit_columns(rows, table) if table else rows


def write_serving(df: DataFrame, path: str, partition_name: str) -> int:
    """Write one run to the serving table and return its number of rows.

    Columns must fit those of the other runs. A rerun leaves no duplicates, and one without
    rows leaves none. The count rides on the write, in its last stage, so it costs no second
    pass and a retried task counts once. It comes before the stamp: a constant last column
    needs no sort by partition.
    """
    return _written(df, path, partition_name, [])["rows"]


def write_serving_sketched(
    df: DataFrame, path: str, partition_name: str, columns: Sequence[str]
) -> tuple[int, dict[str, bytes]]:
    """`write_serving`, and a sketch of the distinct values of each of ``columns``.

    The sketches ride on the write like the count; their size is bounded, and merging a retried
    task's changes nothing.
    """
    sketches = [distinct_sketch(column(c)).alias(f"sketch{i}") for i, c in enumerate(columns)]
    found = _written(df, path, partition_name, sketches)
    return found["rows"], {c: bytes(found[f"sketch{i}"]) for i, c in enumerate(columns)}


def _written(df: DataFrame, path: str, partition_name: str, metrics: list[Column]) -> dict:
    rows = fit_to_table(df, path, partition_name)
    written = Observation()
    counted = rows.observe(written, F.count(F.lit(1)).alias("rows"), *metrics)
    write_runs(stamp(counted, partition_name), path)
    found = written.get
    if found["rows"] == 0:
        remove_folder(df.sparkSession, partition_folder(path, partition_name))
    return found


def drop_partition(spark: SparkSession, path: str, partition_name: str) -> bool:
    """Delete the rows of one run, a folder; False if the table has none of it."""
    return remove_folder(spark, partition_folder(path, partition_name))


def write_snapshot(df: DataFrame, folder: str) -> None:
    """Headerless CSV copy of one run; an earlier copy is replaced."""
    df.write.mode("overwrite").csv(folder)


@dataclass(frozen=True)
class Relational:
    """A database; driver, user and password come in ``options``, never in code."""

    url: str
    options: Mapping[str, str] = field(default_factory=dict)
    connections: int = 16


def append_jdbc(df: DataFrame, table: str, target: Relational) -> None:
    """Append to a relational table, columns by name.

    ``connections`` bounds the open database sessions. Unlike `write_serving` this is a
    plain append: a rerun, or a task retried after its commit, adds the rows again.
    """
    settings = {"batchsize": "10000", "numPartitions": str(target.connections)}
    options = {**settings, **target.options, "url": target.url, "dbtable": table}
    df.write.format("jdbc").options(**options).mode("append").save()
