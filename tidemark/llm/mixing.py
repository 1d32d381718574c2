"""Mixing sources to target weights by a low-discrepancy schedule of equal word blocks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import before_bucket, bucket_of, kept

# The schedule's points are multiples of GOLDEN modulo POINTS: POINTS over the golden ratio,
# made odd, so that POINTS slots in a row meet every point once.
POINTS = 1 << 31
GOLDEN = 1_327_217_885
# Sources are found through this many equal cells of the points.
CELLS = 4_096
# Slots are ranked within chunks of this many first.
CHUNK = 1 << 16


@dataclass(frozen=True)
class Mix:
    """``sources``: _source, _position, _size, _target, _take, one row for each source.

    ``pieces``: what the schedule takes, one row for each slot and row of the input that it
    meets: _slot, _position, _row, _lap, _from (word within the text, from 0), _words.
    """

    sources: DataFrame
    pieces: DataFrame


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none in a NULL one."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    rows: DataFrame, weights: Sequence[float], budget: float, repeats: int
) -> DataFrame:
    """Targets of the sources, in words.

    The sources by code point, NULL last, weigh ``weights``, repeating. They share ``budget``
    times all words by weight; a target stops at ``repeats`` times the source's words, and
    what is left over is shared again. In the order of cap over weight the sources that stop
    come first, so running totals give the final shares without repeating anything. The two
    windows hold one row for each source, never rows of documents.
    """
    totals = rows.groupBy("_source").agg(F.sum("_size").alias("_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    listed = F.array(*[F.lit(float(w)) for w in weights])
    totals = totals.withColumn("_position", F.row_number().over(by_name) - 1)
    weight = F.element_at(listed, F.col("_position") % len(weights) + 1)
    totals = totals.withColumn("_weight", weight)
    totals = totals.withColumn("_cap", F.col("_size") * float(repeats))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), "_position")
    until = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    shared = F.sum("_size").over(everything) * float(budget)
    left = shared - (F.sum("_cap").over(until) - F.col("_cap"))
    stops = F.col("_cap") * F.sum("_weight").over(onwards) <= left * F.col("_weight")
    totals = totals.withColumns({"_stops": stops, "_shared": shared})
    rest = F.col("_shared") - F.sum(F.when(F.col("_stops"), F.col("_cap"))).over(everything)
    rest = F.coalesce(rest, F.col("_shared"))
    open_weight = F.sum(F.when(~F.col("_stops"), F.col("_weight"))).over(everything)
    target = F.when(F.col("_stops"), F.col("_cap")).otherwise(
        F.least(F.col("_cap"), F.col("_weight") * rest / open_weight)
    )
    totals = totals.withColumn("_target", target)
    return totals.select(
        "_source", "_position", "_size", "_target", F.round("_target").cast("long").alias("_take")
    )


def _slots(sources: DataFrame, block: int) -> DataFrame:
    """The schedule: _slot, _position, _rank (of the slot among those of its source).

    Slot i has the point i * GOLDEN modulo POINTS and belongs to the source in whose share of
    the points it falls. Shares are cut into cells, so slots meet their source in an equal
    join. Ranks are counted within chunks of slots, so a source with most of the slots is no
    bottleneck. A source that got too few slots has the rest appended at the end; it takes as
    many as its target needs and no more.
    """
    spark = sources.sparkSession
    need = sources.select(
        "_position",
        F.when(F.col("_take") <= F.col("_size"), F.ceil(F.col("_take") / block))
        .otherwise(
            F.ceil(F.col("_size") / block) + F.ceil((F.col("_take") - F.col("_size")) / block)
        )
        .cast("long")
        .alias("_need"),
    ).where("_need > 0")
    slots = need.agg(F.coalesce(F.sum("_need"), F.lit(0))).first()[0]
    total = slots_count(slots)
    across = Window.orderBy("_position")
    ends = F.floor(F.sum("_need").over(across) / total * POINTS).cast("long")
    shares = need.withColumn("_end", ends)
    shares = shares.withColumn("_start", F.lag("_end", 1, 0).over(across))
    cell = POINTS // CELLS
    first = F.floor(F.col("_start") / cell).cast("long")
    last = F.floor((F.col("_end") - 1) / cell).cast("long")
    cells = shares.where("_start < _end").withColumn("_cell", F.explode(F.sequence(first, last)))
    points = spark.range(total).select(
        F.col("id").alias("_slot"),
        F.pmod(F.col("id") % POINTS * GOLDEN, F.lit(POINTS)).alias("_point"),
    )
    points = points.withColumn("_cell", F.floor(F.col("_point") / cell).cast("long"))
    placed = points.join(cells, "_cell").where("_start <= _point and _point < _end")
    placed = placed.withColumn("_chunk", F.floor(F.col("_slot") / CHUNK).cast("long"))
    placed = placed.select("_slot", "_position", "_need", "_chunk")
    chunks = placed.groupBy("_position", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_position").orderBy("_chunk")
    chunks = chunks.withColumn("_earlier", F.sum("_n").over(earlier) - F.col("_n"))
    inside = Window.partitionBy("_position", "_chunk").orderBy("_slot")
    ranked = placed.withColumn("_inside", F.row_number().over(inside) - 1)
    ranked = ranked.join(chunks.drop("_n"), ["_position", "_chunk"])
    ranked = ranked.withColumn("_rank", F.col("_inside") + F.col("_earlier"))
    got = chunks.groupBy("_position").agg(F.sum("_n").alias("_got"))
    short = need.join(got, "_position", "left").withColumn(
        "_got", F.coalesce(F.col("_got"), F.lit(0))
    )
    short = short.where("_got < _need").select(
        "_position", F.explode(F.expr("sequence(_got, _need - 1)")).alias("_rank")
    )
    return (
        ranked.where("_rank < _need")
        .select("_slot", "_position", "_rank")
        .unionByName(short.withColumn("_slot", F.col("_rank") + total))
    )


def slots_count(slots: int) -> int:
    """At least one slot, so that shares of nothing stay defined."""
    return max(1, slots)


def mix(
    rows: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    budget: float = 1.5,
    repeats: int = 2,
    block: int = 256,
    seed: int = 17,
) -> Mix:
    """Mix ``rows`` (_row, _id, _source, _size, _check) to targets by source.

    The texts of a source are shuffled by a hash of ``seed``, id and checksum, laid end to
    end and cut into blocks of ``block`` words, the last one shorter. Slots of the schedule
    rank 0, 1, .. within their source and take its blocks in that order, from the start again
    once all are taken; the last slot takes what is left of the target, so a source's taken
    words are its target rounded to a whole word. ``repeats`` laps are all that any target
    needs, so no text is taken more than ``repeats`` times its size.

    NULL and empty texts have no words and are never taken. Rows that are alike in id, text
    and source are laid in the order of their numbers, so which of them is cut may differ
    when the table is laid out anew, but never how many words they give together. An empty
    table gives no sources and no pieces. Other columns are ignored.

    Only sums by source, bucket and chunk meet; nothing is ordered as a whole. The sources
    and the numbers of documents, not their texts, are shuffled.
    """
    # The targets need one small pass; every later step reads this table.
    sources = kept(source_targets(rows, weights, budget, repeats), "sources")
    known = sources.select(F.col("_source").alias("_name"), "_position")
    full = rows.where("_size > 0").join(known, F.col("_source").eqNullSafe(F.col("_name")))
    order = F.xxhash64(F.lit(seed), F.col("_id"), F.col("_check"))
    full = full.select("_row", "_id", "_position", "_size", "_check", order.alias("_hash"))
    full = full.withColumn("_bucket", bucket_of(F.col("_hash")))
    bucket = Window.partitionBy("_position", "_bucket").orderBy("_hash", "_id", "_check", "_row")
    inside = F.sum("_size").over(bucket) - F.col("_size")
    before = before_bucket(full, ["_position"], "_bucket", F.col("_size"))
    laid = full.withColumn("_inside", inside).join(before, ["_position", "_bucket"])
    laid = laid.select(
        "_row", "_position", "_size", (F.col("_inside") + F.col("_before")).alias("_start")
    )
    first = F.floor(F.col("_start") / block).cast("long")
    last = F.floor((F.col("_start") + F.col("_size") - 1) / block).cast("long")
    parts = laid.withColumn("_block", F.explode(F.sequence(first, last)))

    sized = sources.select("_position", F.col("_size").alias("_words"), "_take")
    slots = _slots(sources, block).join(sized, "_position")
    count = F.ceil(F.col("_words") / block).cast("long")
    slots = slots.withColumns(
        {
            "_lap": F.floor(F.col("_rank") / count).cast("long"),
            "_block": F.col("_rank") % count,
        }
    )
    # Words still wanted when this slot comes, from the start of its block.
    slots = slots.withColumn(
        "_stop",
        F.least(
            (F.col("_block") + 1) * block, F.col("_take") - F.col("_lap") * F.col("_words")
        ),
    ).select("_slot", "_position", "_lap", "_block", "_stop")

    begin = F.greatest(F.col("_start"), F.col("_block") * block)
    end = F.least(F.col("_start") + F.col("_size"), F.col("_stop"))
    pieces = parts.join(slots, ["_position", "_block"]).select(
        "_slot",
        "_position",
        "_row",
        "_lap",
        (begin - F.col("_start")).alias("_from"),
        (end - begin).alias("_words"),
    )
    return Mix(sources, pieces.where("_words > 0"))
