"""Rules for tables far larger than the fixtures: widths, exact arithmetic, table kinds."""

import pytest
from helpers import day, ev, frame
from pyspark.sql import functions as F

from tidemark.functions.money import exact_sum, half_up_div, rounded_amount, rounded_ratio, to_micros
from tidemark.plans import gold, medallion, sizing
from tidemark.plans.queries import _split
from tidemark.plans.staging import stg_silver
from tidemark.session import checkpoint_root
from tidemark.sources import tables as T
from tidemark.spec import SALES_SEQ
from tidemark.streaming.refine_stream import refine_incremental

TIB = 1 << 40


def test_widths_stay_under_the_limits(spark, monkeypatch):
    monkeypatch.setattr(sizing, "path_bytes", lambda *_: 100 * TIB)
    assert sizing.silver_buckets(spark, "x") == sizing.MAX_BUCKETS < 100_000
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert sizing.tune_shuffle_partitions(spark, ["x"]) == sizing.MAX_SHUFFLE_PARTITIONS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sizing.merge_width(4, 64) == 64 and sizing.merge_width(4, 5) == 8 and sizing.merge_width(8, 5) == 8
    assert sizing.merge_width(None, 5) is None and sizing.merge_width(60_000, 61_000) == sizing.MAX_BUCKETS


def test_merge_rebuckets_when_bronze_grows(spark, tmp_lake):
    rows = [ev(f"k{i}", "INSERT", day(1)) for i in range(20)]
    medallion.refine_frame(frame(spark, rows), f"{tmp_lake}/s", SALES_SEQ, buckets=2)
    assert T.bucketing(spark, f"{tmp_lake}/s") == (2, "tx_id")
    medallion.refine_frame(frame(spark, [ev("k1", "DELETE", day(2)), ev("new", "INSERT", day(2))]), f"{tmp_lake}/s", SALES_SEQ, buckets=7)
    assert T.bucketing(spark, f"{tmp_lake}/s") == (7, "tx_id")
    assert sorted(r.tx_id for r in T.read_table(spark, f"{tmp_lake}/s").collect()) == sorted([f"k{i}" for i in range(20) if i != 1] + ["new"])


@pytest.mark.parametrize("den", [2, 999, 1_000_003, 50_000_001, 10**12 + 39])
def test_division_is_exact_for_large_divisors(spark, den):
    nums = [0, 1, den // 2, den - den // 2, den, 7 * den - den // 2 - 1, 7 * den - den // 2, 1234 * den - 1]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in nums], "n bigint").select(half_up_div("n", F.lit(den))).collect()]
    assert got == [(2 * n + den) // (2 * den) for n in nums]


def test_amounts_are_rounded_once(spark):
    df = spark.createDataFrame([(0.333, 300)], "p double, q int").select((to_micros("p") * F.col("q")).alias("m"))
    assert df.agg(exact_sum("m").alias("m")).select(rounded_amount("m"), rounded_ratio("m", F.lit(8))).first() == (99.9, 12.49)
    big = spark.range(3).select(F.lit(9 * 10**18).alias("m")).agg(exact_sum("m").alias("m"))
    assert big.select(rounded_amount("m")).first()[0] == 27e12


def test_split_keeps_events_without_a_time(spark):
    early, late = _split(frame(spark, [ev("a", "INSERT", day(1)), ev("b", "INSERT", None)]))
    assert early.count() + late.count() == 2


def test_existence_is_data_not_markers(spark, tmp_lake):
    frame(spark, [ev("a", "INSERT", day(1))]).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{tmp_lake}/b")
    fs, _ = T._fs(spark, tmp_lake)
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.delete(Path(f"{tmp_lake}/b/_SUCCESS"), False)
    assert medallion.refine(spark, f"{tmp_lake}/b", f"{tmp_lake}/s", SALES_SEQ).status == "created"
    fs.mkdirs(Path(f"{tmp_lake}/started/_spark_metadata"))
    assert medallion.refine(spark, f"{tmp_lake}/started", f"{tmp_lake}/s2", SALES_SEQ).status == "no_bronze"


def test_deleted_sales_stay_out_of_gold_and_keys_are_not_assumed_unique(spark, tmp_lake):
    rows = [ev("a", "INSERT", day(1)), ev("a", "DELETE", day(2)), ev("b", "INSERT", day(1))]
    frame(spark, rows).write.parquet(f"{tmp_lake}/b")
    refine_incremental(spark, f"{tmp_lake}/b", f"{tmp_lake}/state", f"{tmp_lake}/c", SALES_SEQ)
    medallion.refine(spark, f"{tmp_lake}/b", f"{tmp_lake}/s", SALES_SEQ)
    read = lambda p, g: T.read_table(spark, medallion.build_gold(spark, f"{tmp_lake}/{p}", f"{tmp_lake}/{g}", spec=SALES_SEQ)["gold_kpi_ventas"]).collect()
    assert read("state", "g1") == read("s", "g2") and sum(r.cantidad_transacciones for r in read("s", "g3")) == 1
    twice = frame(spark, rows[2:] * 2)
    assert [r.cantidad_transacciones for r in medallion.gold_frames(twice)["gold_kpi_ventas"].collect()] == [1]
    assert [r.cantidad_transacciones for r in gold.daily(stg_silver(twice)).collect()] == [1]


def test_commit_is_not_overwritten_and_leaves_nothing_aside(spark, tmp_lake):
    T.publish(spark.range(3), f"{tmp_lake}/t", "WRITE")
    with pytest.raises(Exception):
        T._write_commit(spark, f"{tmp_lake}/t", {"version": 0})
    assert T.versions(spark, f"{tmp_lake}/t") == [0] and T.read_table(spark, f"{tmp_lake}/t").count() == 3
    fs, p = T._fs(spark, f"{tmp_lake}/t/_commits")
    assert not [s for s in fs.listStatus(p) if s.getPath().getName().endswith(".tmp")]


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        checkpoint_root(Session())
