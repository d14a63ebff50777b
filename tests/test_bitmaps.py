"""Mergeable distinct counts against count(distinct)."""

from pyspark.sql import functions as F

from helpers import SF0001
from tidemark.operators import bitmaps
from tidemark.operators.refine import clean
from tidemark.plans import gold
from tidemark.plans.staging import stg_silver
from tidemark.spec import SALES_SEQ


def _hours(df, column="v"):
    return bitmaps.period_bitmaps(df, F.date_trunc("hour", F.col("at")), column, bitmaps.number_values(df, column))


def test_more_than_one_bucket_and_a_hot_value(spark):
    at = F.timestamp_seconds(F.col("id") * 37 % (5 * 86400))
    v = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 1000 == 1, F.lit(None)).otherwise(F.col("id").cast("string"))
    df = spark.range(120_000).select(at.alias("at"), v.alias("v"))
    hours = _hours(df)
    assert hours.select("bucket").distinct().count() > 1
    for level in ("hour", "day", "month"):
        up = hours if level == "hour" else bitmaps.roll_up(hours, F.date_trunc(level, F.col("period")))
        got = {(r.period, r.n) for r in bitmaps.distinct_counts(up, "n").collect()}
        assert got == {(r.p, r.n) for r in df.groupBy(F.date_trunc(level, F.col("at")).alias("p")).agg(F.count_distinct("v").alias("n")).collect()}


def test_numbers_are_dense_from_one(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("",)], "v string")
    assert {(r.v, r.number) for r in bitmaps.number_values(df, "v").collect()} == {("", 1), ("a", 2), ("b", 3)}


def test_nothing_but_nulls(spark):
    df = spark.sql("select timestamp'2024-01-01' as at, cast(null as string) as v")
    assert _hours(df).count() == 0


def test_days_equal_the_gold_table(spark):
    from tidemark.plans.queries import _feed_a

    stg = stg_silver(clean(_feed_a(spark, SF0001), SALES_SEQ))
    want = {(r.fecha, r.clientes_unicos) for r in gold.daily(stg, ordered=False).collect()}
    hours = _hours(stg.select(F.col("venta_timestamp").alias("at"), F.col("cliente_id").alias("v")))
    days = bitmaps.roll_up(hours, F.date_trunc("day", F.col("period")))
    assert {(r.period.date(), r.n) for r in bitmaps.distinct_counts(days, "n").collect()} == want
