"""A corpus pipeline: documents to a clean, mixed and sharded training corpus.

Each stage takes the documents that the one before kept, as a stored table, and returns
documents again; the last one adds shard and slot. Columns: doc_id, text, lang, source and
whatever else the table has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, kept, numbered, table
from tidemark.llm.decontamination import is_contaminated, with_contamination
from tidemark.llm.language import UNDETERMINED, fit_language, with_language
from tidemark.llm.mixing import mix, word_count
from tidemark.llm.sharding import shard_rows
from tidemark.llm.simhash import near_groups, with_fingerprint
from tidemark.storage import new_folder, passing_folders, remove_folder, stored

# A text that every language clearly disclaims is rejected, besides those that none claims.
LEAST_SCORE = 0.25
SHARDS = 24


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the texts that are in one of the languages of the table.

    Learned from the stage's own documents with a language. NULL texts, texts without a letter
    and texts that no language claims go (less like the landmarks of their best language than
    the bound that its own texts give); all other rows stay as they are.
    """
    marked = with_language(docs, fit_language(docs), out=(out := free_name(docs, "_language")))
    good = (F.col(f"{out}.lang") != UNDETERMINED) & (F.col(f"{out}.score") >= LEAST_SCORE)
    return marked.where(good & F.col(f"{out}.claimed")).drop(out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near-duplicates: that with the smallest doc_id, of
    several rows with that id one; a NULL id comes last."""
    rows, row = numbered(docs)
    printed = with_fingerprint(rows, "text", "_fp", 4).select(
        F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row")).alias(
            "_place"
        ),
        "_fp",
    )
    grouped = near_groups(kept(printed, "fingerprints"), "_place", "_fp", 4)
    first = grouped.where(F.col("_place") == F.col("_group")).select(
        F.col("_place.row").alias(row)
    )
    return rows.join(first, row, "left_semi").drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which at least a twentieth of the words is from the benchmark."""
    out = free_name(docs, "_found")
    marked = with_contamination(docs, table(spark, sf_dir, "benchmark"), out=out)
    return marked.where(~is_contaminated(out)).drop(out)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mix sources to their target weights: a document comes once for every lap of its source
    in which the schedule takes words of it, whole. NULL and wordless texts are never taken.

    A source is over its target by no more than the words of one document, the one that its
    last block cuts.
    """
    rows, row = numbered(docs)
    mixed = mix(
        kept(
            rows.select(
                F.col(row).alias("_row"),
                F.col("doc_id").alias("_id"),
                F.col("source").alias("_source"),
                word_count(F.col("text")).alias("_size"),
                F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("_check"),
            ),
            "sizes",
        )
    )
    laps = mixed.pieces.groupBy(F.col("_row").alias(row)).agg(
        F.countDistinct("_lap").alias(times := free_name(docs, "_laps"))
    )
    names = [F.col(f"`{name}`") for name in docs.columns]
    joined = rows.join(laps, row)
    return joined.select(*names, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*names)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot in the shuffled corpus."""
    text = F.coalesce("text", F.lit(""))
    key = [F.col("doc_id"), F.crc32(text.cast("binary")), F.octet_length(text)]
    return shard_rows(docs, key, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# SQL cannot express the learned language stage; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each one's result is stored and read again.

    What a stage stored on its way goes once its result is stored, and that result once the next
    one's is; only the last stays.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        after = new_folder(spark, f"llm-{name}")
        with passing_folders(spark):
            docs = stored(stage(spark, docs, sf_dir), after)
        if before:
            remove_folder(spark, before)
        before = after
    return docs
