"""The pipeline leaves its result and nothing else."""

from __future__ import annotations

import os
import random

import corpus_pipeline
from tidemark.storage import shared_root


def test_only_the_result_stays(spark, tmp_path):
    rng = random.Random(4)
    words = "the quick brown fox jumps over a lazy dog while seven judges sleep".split()
    rows = [(i, " ".join(rng.choices(words, k=40)), "en", f"s{i % 2}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items = spark.createDataFrame([(1, "some other words")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    root = f"{shared_root(spark)}/tidemark"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    result = corpus_pipeline.run(spark, str(tmp_path))
    left = set(os.listdir(root)) - before
    assert len(left) == 1 and left.pop().startswith("llm-sharding-")
    found = result.collect()
    assert result.columns == ["doc_id", "text", "lang", "source", "shard", "slot"]
    assert {r.doc_id for r in found} <= set(range(60)) and len(found) > 30
