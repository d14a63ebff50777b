"""Newest-N rows of a table partitioned by day, reading its last partitions only.

The partition folders are listed (names only, one per day) and walked back from the newest,
twice as many each time, until the days taken hold ``n`` rows; counting stops at ``n``.  The
answer is a top-N over those days, whose filter prunes every older partition from the scan.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..plans.gold import latest_events
from .tables import _fs

NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def partition_days(spark: SparkSession, path: str, day: str) -> list[str]:
    """Values of the partition column, newest first; the null partition is not among them."""
    fs, root = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    values = [unquote(n.split("=", 1)[1]) for n in names if n.startswith(f"{day}=")]
    return sorted((v for v in values if v != NO_DAY), reverse=True)


def newest_partitions(spark: SparkSession, path: str, day: str, n: int, schema: StructType) -> DataFrame:
    """The rows of the fewest last days, in doublings, that hold ``n`` rows; all rows, those without
    a day too, if the table has no more."""
    table = spark.read.schema(StructType([*schema.fields, StructField(day, StringType())])).parquet(path)
    days, taken = partition_days(spark, path, day), 1
    while taken < 2 * len(days):
        newest = table.where(F.col(day) >= days[min(taken, len(days)) - 1])
        if newest.limit(n).count() == n:
            return newest
        taken *= 2
    return table


def latest_events_pruned(spark: SparkSession, path: str, day: str, schema: StructType, n: int = 20,
                         tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """The newest ``n`` events of a table partitioned by the date part of its event time."""
    return latest_events(newest_partitions(spark, path, day, n, schema), n, tiebreak).drop(day)
