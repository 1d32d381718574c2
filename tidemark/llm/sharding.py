"""Reproducible shuffle into shards by a Feistel permutation of row numbers."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import before_bucket, bucket_of, free_name

ROUNDS = 6


def _permute(number: Column, left: int, right: int, seed: int) -> Column:
    """Feistel permutation of ``left`` * ``right`` numbers: each round adds a keyed hash of one
    half to the other half, modulo that half's size, which can be undone."""
    low = number % right
    high = ((number - low) / right).cast("long")
    for turn in range(ROUNDS):
        if turn % 2:
            mixed = F.pmod(F.xxhash64(high, F.lit(turn), F.lit(seed)), F.lit(right))
            low = (low + mixed) % right
        else:
            mixed = F.pmod(F.xxhash64(low, F.lit(turn), F.lit(seed)), F.lit(left))
            high = (high + mixed) % left
    return high * right + low


def permuted(number: Column, size: int, seed: int) -> Column:
    """Permutation of 0 .. ``size`` - 1, ``size`` below 2**52, as a column expression.

    The Feistel network works on the smallest near-square grid that holds all numbers. One
    that lands outside walks on along its cycle until it is inside again. There are fewer than
    sqrt(size) + 1 numbers outside, and a cycle passes each of them once, so that many steps
    always end the walk; all but one in sqrt(size) numbers need none.
    """
    left = max(1, isqrt(max(0, size - 1)) + 1)
    right = max(1, -(-size // left))
    outside = left * right - size
    first = _permute(number, left, right, seed)
    if outside == 0:
        return first
    steps = F.sequence(F.lit(0), F.lit(outside))
    walked = F.aggregate(
        steps,
        first,
        lambda at, _: F.when(at < size, at).otherwise(_permute(at, left, right, seed)),
    )
    return F.when(first < size, first).otherwise(walked)


def shard_rows(
    df: DataFrame,
    key: list[Column],
    shards: int,
    seed: int = 29,
    shard_out: str = "shard",
    slot_out: str = "slot",
) -> DataFrame:
    """``df`` with ``shard_out`` and ``slot_out``: shards differ by one row at most, slots of a
    shard are gapless from 0.

    Rows get global numbers in the order of a hash of ``key``: how many rows come in earlier
    buckets of the hash, plus the place within the bucket. The numbers are permuted; shard and
    slot are remainder and quotient of the new number by ``shards``, so they can be computed
    for any number without the data. Equal keys are ordered by nothing else, so ``key`` should
    tell rows apart; rows alike in it are exchangeable. NULLs in ``key`` are values like any
    other. An empty table gives no rows. A column named like an output is replaced.

    Rows are shuffled once, by bucket, with the columns that are asked for. Copies of a text
    have ids of their own and so fall into different buckets.
    """
    size = df.count()
    hashed, bucket, number = (free_name(df, name) for name in ("_hash", "_bucket", "_number"))
    rows = df.withColumn(hashed, F.xxhash64(F.lit(seed), *key))
    rows = rows.withColumn(bucket, bucket_of(F.col(hashed)))
    before = before_bucket(rows.select(bucket), [], bucket, F.lit(1))
    before = before.select(F.col(bucket), F.col("_before").alias(number))
    place = F.row_number().over(Window.partitionBy(bucket).orderBy(hashed, *key)) - 1
    inside = free_name(df, "_inside")
    rows = rows.withColumn(inside, place).join(before, bucket)
    rows = rows.withColumn(number, permuted(F.col(inside) + F.col(number), size, seed))
    shard = (F.col(number) % shards).cast("int")
    slot = F.floor(F.col(number) / shards).cast("long")
    names = [c for c in df.columns if c.lower() not in (shard_out.lower(), slot_out.lower())]
    return rows.select(
        *[F.col(f"`{name}`") for name in names], shard.alias(shard_out), slot.alias(slot_out)
    )
