"""Headed, delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.casts import safe_cast
from tidemark.operators.projections import column, replace
from tidemark.storage import input_files


def _text_schema(names: list[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


def header_of(spark: SparkSession, path: str | list[str], sep: str = ",") -> tuple[list[str], bool]:
    """Column names of the files, and whether each file can be checked against them.

    Spark renames a repeated or empty header by position (``a,b,a`` becomes ``a0,b,a2``).
    Such names are not in the file, so its header cannot be compared with them.
    """
    names = spark.read.option("header", True).option("sep", sep).csv(path).columns
    renamed = [name for i, name in enumerate(names) if name.endswith(str(i))]
    if not renamed:
        return names, True
    # Look at the raw first line only when a name could be such a renamed one.
    first = spark.read.option("header", False).option("sep", sep).csv(path).first()
    return names, list(first or ()) == names


def first_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The first line of every file that is not blank: file_path, line."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    place = F.struct(
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    lines = lines.select(F.col("_metadata.file_path").alias("file_path"), place.alias("p"), "value")
    return lines.groupBy("file_path").agg(F.min_by("value", "p").alias("line"))


def check_same_header(
    spark: SparkSession, path: str | list[str], header: str | None = None
) -> str | None:
    """The first line that all files share, and that is ``header`` if given; otherwise an error.

    For repeated headers, which Spark renames and so cannot check. It passes over the files
    once more.
    """
    found = first_lines(spark, path).select("line").distinct().limit(2).collect()
    lines = {row["line"] for row in found} | ({header} if header is not None else set())
    if len(lines) > 1:
        raise ValueError(f"files differ in their header: {' | '.join(sorted(lines))}")
    return lines.pop() if lines else None


def cast_declared(df: DataFrame, declared: StructType) -> DataFrame:
    """Cast the declared non-string columns; text that does not fit becomes NULL."""
    present = {name.lower(): name for name in df.columns}
    absent = [f.name for f in declared.fields if f.name.lower() not in present]
    if absent:
        raise ValueError(f"columns not in the header: {', '.join(absent)}")
    typed = [f for f in declared.fields if not isinstance(f.dataType, StringType)]
    casts = {present[f.name.lower()]: f.dataType for f in typed}
    return replace(
        df, {name: safe_cast(column(name), StringType(), to) for name, to in casts.items()}
    )


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    declared: StructType | None = None,
    sep: str = ",",
    infer: bool = False,
) -> DataFrame:
    """Read headed files as text by header name, then cast the ``declared`` columns.

    Columns not declared stay text, and the order is that of the header. Short rows are
    filled with NULL, extra fields dropped. A file whose header differs from the first
    file's fails the read instead of swapping columns; of files with repeated names the
    first lines are compared. ``infer`` lets Spark guess all types
    from the data instead, at the price of a pass over it.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    names, comparable = header_of(spark, path, sep)
    if not comparable and len(input_files(reader.schema(_text_schema(names)).csv(path))) > 1:
        check_same_header(spark, path)
    if infer:
        guessed = reader.option("inferSchema", True).csv(path).schema
        checked = spark.read.option("header", True).option("sep", sep).schema(guessed)
        return checked.option("enforceSchema", not comparable).csv(path)
    text = reader.schema(_text_schema(names)).option("enforceSchema", not comparable).csv(path)
    return cast_declared(text, declared) if declared else text


def stream_csv(
    spark: SparkSession,
    folder: str,
    names: list[str],
    archive: str,
    files_per_batch: int | None = None,
    comparable: bool = True,
) -> DataFrame:
    """Stream the headed files of a landing folder as text; used files go to ``archive``.

    A file whose header differs from ``names`` fails its batch, if names are ``comparable``.
    """
    reader = (
        spark.readStream.schema(_text_schema(names))
        .option("header", True)
        .option("enforceSchema", not comparable)
        .option("cleanSource", "archive")
        .option("sourceArchiveDir", archive)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder)
