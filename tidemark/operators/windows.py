"""Group totals repeated on every row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.operators.projections import column


def _fact(name: str) -> Column:
    return F.col(f"facts.`{name}`")


def window_total(df: DataFrame, keys: Sequence[str], measure: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``measure`` over all rows with equal ``keys``.

    NULL keys form one group, NULL measures are skipped, an all-NULL group gives NULL. An
    existing column ``out``, in any case, is replaced in its place.

    The sums are combined map-side, so a group enters the shuffle as one row for each task,
    and are joined back to the rows. No hint and no threshold: adaptive execution broadcasts
    few sums and splits a partition of rows that one key fills. For the split both sides of
    the join have to be shuffled for it, so the hash of the keys is a join key of its own: it
    adds nothing to their equality, but the sums' partitioning by the keys alone then does not
    do. ``df`` is scanned twice, its keys and measure and all of it; hand over a stored table.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    narrow = df.select(
        *[column(key).alias(name) for key, name in zip(keys, names)],
        column(measure).alias("_measure"),
    )
    kinds = [narrow.schema[name].dataType for name in names]
    # Texts that are equal under their collation may differ in bytes, and so in their hash.
    hashed = [i for i, k in enumerate(kinds) if not isinstance(k, StringType) or k == StringType()]
    sums = narrow.groupBy(*names).agg(F.sum("_measure").alias("_total"))
    same = [_fact(key).eqNullSafe(F.col(f"sums.{name}")) for key, name in zip(keys, names)]
    if hashed:
        sums = sums.withColumn("_hash", F.xxhash64(*[names[i] for i in hashed]))
        same.append(F.xxhash64(*[_fact(keys[i]) for i in hashed]) == F.col("sums._hash"))
    joined = df.alias("facts").join(sums.alias("sums"), reduce(and_, same), "left")
    total = F.col("sums._total").alias(out)
    replaced = [name for name in df.columns if name.lower() == out.lower()]
    columns = [total if name in replaced else _fact(name) for name in df.columns]
    return joined.select(*columns, *([] if replaced else [total]))
