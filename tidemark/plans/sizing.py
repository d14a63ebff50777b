"""Partition and bucket counts sized from the data, so tasks stay within executor memory.

Sizes come from file-system metadata (``getContentSummary``), never from reading data.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

TARGET_BUCKET_BYTES = 512 * 1024 * 1024      # one Silver bucket file (compressed parquet)
TARGET_SHUFFLE_BYTES = 256 * 1024 * 1024     # input bytes per initial shuffle partition
# Spark takes at most 100,000 buckets; every map task also writes an index entry for each
# shuffle partition.  Above these counts buckets and partitions grow instead (100 TiB of
# Bronze: 1.6 GiB a bucket, 2 GiB of input a partition, which sorts spill to disk).
MAX_BUCKETS = 65_536
MAX_SHUFFLE_PARTITIONS = 50_000


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes stored under ``path`` (0 when it does not exist)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def partitions_for(total_bytes: int, target_bytes: int, floor: int = 1, ceiling: int = MAX_SHUFFLE_PARTITIONS) -> int:
    """Enough partitions that none exceeds ``target_bytes``, at least ``floor`` and at most ``ceiling``."""
    return min(int(ceiling), max(int(floor), math.ceil(total_bytes / max(1, target_bytes))))


def silver_buckets(spark: SparkSession, bronze_path: str, target_bytes: int = TARGET_BUCKET_BYTES) -> int:
    """Bucket count that Silver needs: the session's shuffle width, or more when the Bronze
    feed (an upper bound of Silver's size) would make buckets larger than the target."""
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return partitions_for(path_bytes(spark, bronze_path), target_bytes, floor, MAX_BUCKETS)


def merge_width(stored: int | None, needed: int | None) -> int | None:
    """Bucket count of the next version of a bucketed table: the stored one while it suffices;
    else enough, and at least twice as many, so that re-bucketing stays rare as data grows."""
    if not stored or not needed or needed <= stored:
        return stored
    return min(MAX_BUCKETS, max(needed, 2 * stored))


def tune_shuffle_partitions(spark: SparkSession, paths: list[str], target_bytes: int = TARGET_SHUFFLE_BYTES) -> int:
    """Raise ``spark.sql.shuffle.partitions`` so a job over ``paths`` starts with at most
    ``target_bytes`` of input per shuffle partition (never lowers the session value; AQE
    coalesces partitions that turn out small).  Returns the value in effect."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = partitions_for(sum(path_bytes(spark, p) for p in paths), target_bytes, current)
    if n > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
