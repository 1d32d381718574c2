from __future__ import annotations

import os

import pytest

from tidemark.storage import new_folder, passing_folders, stored


def test_passing_folders_go_at_the_end(spark):
    outside = new_folder(spark, "outside")
    with passing_folders(spark):
        inside, unused = new_folder(spark, "inside"), new_folder(spark, "unused")
        with passing_folders(spark):
            deeper = new_folder(spark, "deeper")
            stored(spark.range(3), deeper)
        assert not os.path.exists(deeper)
        stored(stored(spark.range(5), inside), outside)
        assert os.path.exists(inside) and not os.path.exists(unused)
    assert not os.path.exists(inside)
    assert spark.read.parquet(outside).count() == 5
    stored(spark.range(1), later := new_folder(spark, "later"))
    assert os.path.exists(later)


def test_passing_folders_go_after_a_failure(spark):
    with pytest.raises(ValueError, match="stop"), passing_folders(spark):
        stored(spark.range(5), inside := new_folder(spark, "inside"))
        raise ValueError("stop")
    assert not os.path.exists(inside)
