"""Snapshot tables, history, export, relation binding, views and inspection."""

import pytest

from helpers import day, ev, frame

from tidemark.plans.medallion import build_gold, refine_frame
from tidemark.sources import tables as T
from tidemark.spec import SALES_SEQ as S


@pytest.fixture()
def lake(spark, tmp_lake):
    rows = [ev("a", "INSERT", day(1)), ev("b", "INSERT", day(2), precio=3.0), ev("b", "DELETE", day(3))]
    silver = f"{tmp_lake}/silver"
    refine_frame(frame(spark, rows), silver, S, buckets=2)
    refine_frame(frame(spark, rows + [ev("c", "UPDATE", day(4))]), silver, S)
    build_gold(spark, silver, f"{tmp_lake}/gold")
    return tmp_lake


def test_versions_and_history(spark, lake):
    silver = f"{lake}/silver"
    assert T.versions(spark, silver) == [0, 1]
    h = T.history(spark, silver).collect()
    assert [r.version for r in h] == [1, 0] and [r.operation for r in h] == ["MERGE", "WRITE"]
    assert h[0].operationMetrics["num_insert"] == "1" and h[1].operationMetrics["num_output_rows"] == "1"
    assert sorted(r.tx_id for r in T.read_table(spark, silver, version=0).collect()) == ["a"]
    assert sorted(r.tx_id for r in T.read_table(spark, silver).collect()) == ["a", "c"]


def test_commit_cannot_be_taken_twice(spark, lake):
    rec = {"version": 1, "operation": "X", "timestamp": None, "operationMetrics": {}}
    with pytest.raises(Exception):
        T._write_commit(spark, f"{lake}/silver", rec)


def test_export_gold(spark, lake, tmp_lake):
    out = T.export_gold(spark, f"{lake}/gold", f"{tmp_lake}/export", "gold_kpi_producto")
    assert list(out) == ["gold_kpi_producto"]
    assert spark.read.parquet(out["gold_kpi_producto"]).count() == 1
    assert len(T.export_gold(spark, f"{lake}/gold", f"{tmp_lake}/export", "all")) == 3
    with pytest.raises(ValueError):
        T.export_gold(spark, f"{lake}/gold", f"{tmp_lake}/export", "gold_nope")
    with pytest.raises(FileNotFoundError):
        T.export_gold(spark, f"{tmp_lake}/empty", f"{tmp_lake}/export", "all")


def test_relations_views_and_inspection(spark, lake):
    from tidemark.operators.inspect import inspect_table
    from tidemark.plans.staging import register_views

    silver = f"{lake}/silver"
    assert T.resolve_relation(spark, silver).count() == 2
    names = register_views(spark, silver=silver)
    assert names == ["stg_silver_ventas"]
    assert spark.sql("select count(*) from stg_silver_ventas where venta_timestamp is not null").first()[0] == 2
    assert T.resolve_relation(spark, "stg_silver_ventas").count() == 2
    info = inspect_table(spark, silver, n=1)
    assert info["sample"].count() == 1
    sch = {r.column_name: (r.data_type, r.row_count) for r in info["schema"].collect()}
    assert sch["precio"] == ("double", 2) and sch["cantidad"] == ("int", 2)
    assert info["history"].count() == 2


def test_failed_attempt_leaves_no_trace(spark, lake):
    """An attempt that wrote data but never committed does not block or leak into the next."""
    silver = f"{lake}/silver"
    orphan = T._data(silver, 2, "deadbeef0000")
    T.read_table(spark, silver).write.parquet(orphan)          # crashed writer: data, no commit
    assert T.current_version(spark, silver) == 1
    v = T.publish(T.read_table(spark, silver).limit(1), silver, "WRITE")
    assert v == 2 and T.read_table(spark, silver).count() == 1


def test_bucket_count_grows_with_bronze_size(spark, lake):
    from tidemark.plans.sizing import partitions_for, path_bytes, silver_buckets

    assert partitions_for(10 * 2**30, 512 * 2**20, floor=8) == 20
    assert partitions_for(10, 512 * 2**20, floor=8) == 8
    size = path_bytes(spark, f"{lake}/silver")
    assert size > 0 and path_bytes(spark, f"{lake}/nope") == 0
    assert silver_buckets(spark, f"{lake}/silver", target_bytes=max(1, size // 40)) >= 40


def test_empty_inputs(spark, tmp_lake):
    from pyspark.sql import functions as F

    from tidemark.functions.ranking import with_position
    from tidemark.plans import gold

    empty = frame(spark, [])
    T.publish(empty, f"{tmp_lake}/e", "WRITE")
    assert T.read_table(spark, f"{tmp_lake}/e").count() == 0
    assert T.export_table(spark, f"{tmp_lake}/e", f"{tmp_lake}/x").count() == 0
    assert with_position(empty, [F.col("tx_id")]).count() == 0
    assert gold.product_ranking(gold.by_product(
        T.read_table(spark, f"{tmp_lake}/e").drop("seq").withColumnRenamed("timestamp", "venta_timestamp"))).count() == 0


def test_vacuum_keeps_newest_versions_and_history(spark, tmp_lake):
    path = f"{tmp_lake}/t"
    for i in range(4):
        T.publish(frame(spark, [ev(f"k{i}", "INSERT", day(1))]), path, "WRITE", bucket_by=(2, "tx_id") if i % 2 else None)
    orphan = T._data(path, 1, "0rphan000000")
    frame(spark, []).write.parquet(orphan)                 # never committed
    in_flight = T._data(path, 4, "inflight0000")
    frame(spark, []).write.parquet(in_flight)              # a writer still at work
    removed = T.vacuum(spark, path, retain_versions=2)
    assert len(removed) == 3 and all(r.startswith(("v00000000000000000000", "v00000000000000000001")) for r in removed)
    assert T.path_exists(spark, in_flight)
    assert [r.tx_id for r in T.read_table(spark, path).collect()] == ["k3"]
    assert [r.tx_id for r in T.read_table(spark, path, version=2).collect()] == ["k2"]
    assert T.history(spark, path).count() == 4


def test_tune_shuffle_partitions_only_raises(spark, lake):
    from tidemark.plans.sizing import tune_shuffle_partitions

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert tune_shuffle_partitions(spark, [f"{lake}/silver"]) == int(before)
        n = tune_shuffle_partitions(spark, [f"{lake}/silver"], target_bytes=64)
        assert n > int(before) and spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
