"""Cluster sizing helper."""

from ventilake.session import sizing


def test_sizing_for_large_and_small_inputs():
    big = sizing(100 * 2**40, 8000)
    assert big["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (256 * 2**20))
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 2**20)
    small = sizing(10**6, 8)
    assert small["spark.sql.shuffle.partitions"] == "24"  # at least three waves of tasks
