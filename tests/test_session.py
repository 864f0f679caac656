"""Partition sizing for a data volume."""

from readyspark.session import PARTITION_BYTES, scale_conf


def test_partitions_fit_the_largest_shuffle():
    tb = 1 << 40
    c = scale_conf(10 * tb)
    n = int(c["spark.sql.shuffle.partitions"])
    assert n == -(-10 * tb // PARTITION_BYTES) == int(c["spark.sql.adaptive.coalescePartitions.initialPartitionNum"])
    assert 10 * tb / n <= PARTITION_BYTES
    assert c["spark.sql.files.maxPartitionBytes"] == c["spark.sql.adaptive.advisoryPartitionSizeInBytes"]


def test_small_data_keeps_the_default_floor():
    assert scale_conf(10 << 20)["spark.sql.shuffle.partitions"] == "200"
