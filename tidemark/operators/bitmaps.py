"""Exact distinct counts that can be merged: bitmaps over numbered values.

Values get dense numbers once.  A bitmap row holds which numbers of one 32,768-number bucket
occur in one finest period (Spark's ``bitmap_*`` functions; 4 KB a row).  Any coarser period is
the union of its bitmaps, so hours roll up to days and months without reading events again, and
a new hour only adds rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import with_position


def number_values(df: DataFrame, column: str) -> DataFrame:
    """``(column, number)``: every distinct value that is not null, numbered densely from 1 (where
    Spark's bitmap buckets begin) in ascending order, by ranges without a single-task window."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return with_position(values, [F.col(column).asc()], "number")


def period_bitmaps(df: DataFrame, period: Column, column: str, numbers: DataFrame) -> DataFrame:
    """``(period, bucket, bits)``, one row a period and bucket that occur.

    (period, value) pairs are made distinct before the join with the numbers, so a value that
    holds a third of all rows brings one row a period to it.  Null values count nowhere.
    """
    pairs = df.where(F.col(column).isNotNull()).select(period.alias("period"), column).distinct()
    numbered = pairs.join(numbers, column)
    return (numbered.groupBy("period", F.bitmap_bucket_number("number").alias("bucket"))
                    .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))


def roll_up(bitmaps: DataFrame, coarser: Column) -> DataFrame:
    """The same table for a coarser period, an expression of ``period``."""
    return (bitmaps.withColumn("_to", coarser).groupBy(F.col("_to").alias("period"), "bucket")
                   .agg(F.bitmap_or_agg("bits").alias("bits")))


def distinct_counts(bitmaps: DataFrame, name: str) -> DataFrame:
    """``(period, name)``: distinct values a period."""
    return bitmaps.groupBy("period").agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias(name))
