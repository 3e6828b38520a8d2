"""Helpers: hot keys, gatherings, shared folders."""

import pytest
from pyspark.sql import functions as F

from sluice.llm import common, repeats


@pytest.mark.parametrize("share, salts", [(1 << 20, 64), (10, 3), (1, 1)])
def test_spread_join_is_a_join(spark, monkeypatch, share, salts):
    monkeypatch.setattr(common, "HOT_SHARE", share)
    monkeypatch.setattr(common, "SALTS", salts)
    left = spark.range(0, 1000, 1, 5).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for least in (0, 30, 10_000):
        got = common.spread_join(left, right, "k", counts.filter(F.col("n") > least), "row")
        assert sorted(map(tuple, got.select("row", "k", "v").collect())) == sorted(map(tuple, left.join(right, "k").select("row", "k", "v").collect()))
    dealt = common.spread_join(left, right, "k", counts.filter("n > 300"), "row")
    assert dealt.count() == left.join(right, "k").count()


def test_bounds_of_hot_keys(monkeypatch):
    assert common.hot_bound(1000, 16) == 16
    monkeypatch.setattr(common, "HOT_KEYS", 10)
    assert common.hot_bound(1000, 16) == 100  # fewer than ten keys have more of 1,000 rows


def test_gatherings_grow_with_shards():
    assert repeats.gathered(32) == repeats.GATHER and repeats.gathered(1 << 20) == 1 << 22
    assert repeats.shards_of(100 * 10**12, 1 << 23) == 1 << 20 and repeats.shards_of(0, 1 << 23) == 32


def test_local_cluster_needs_a_shared_folder():
    class Other:
        class conf:  # noqa: N801
            get = staticmethod(lambda *a: None)

        class sparkContext:  # noqa: N801
            master = "local-cluster[3,2,1024]"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError):
        common.shared_dir(Other)
