"""Latest per key in a state store, the batch-progress table, day partitions, bound relations."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import day, ev, frame, sort_rows
from tidemark.operators.refine import clean, latest_per_key
from tidemark.sources.binding import bound_sql, relation_name
from tidemark.sources.messages import to_messages, write_messages
from tidemark.sources.newest import latest_events_pruned, newest_partitions, partition_days
from tidemark.spec import FEED_SCHEMA, SALES_SEQ
from tidemark.streaming.ingest import EVENT_DAY, ingest_available
from tidemark.streaming.latest_stream import latest_by_state, latest_table, run_latest
from tidemark.streaming.progress import read_progress


def _events(n, seed):
    rng = random.Random(seed)
    ops = ["INSERT", "UPDATE", "DELETE", "UPSERT", None]
    return [ev(f"k{rng.randrange(12) if rng.random() < .6 else 0}", rng.choice(ops), day(1 + rng.randrange(9)), rng.choice([1.0, 0.0, None]), seq=seed * 1000 + i)
            for i in range(n)]


def test_state_store_equals_window_after_restarts(spark, tmp_lake):
    rows = []
    for step in range(3):
        more = _events(60, step) if step != 1 else []        # an empty batch in between
        rows += more
        frame(spark, more).coalesce(1).write.mode("append").parquet(f"{tmp_lake}/events")
        run_latest(spark, f"{tmp_lake}/events", f"{tmp_lake}/changes", f"{tmp_lake}/ckpt")
        want = latest_per_key(clean(frame(spark, rows), SALES_SEQ), SALES_SEQ)
        assert sort_rows(latest_table(spark, f"{tmp_lake}/changes")) == sort_rows(want)
    assert sort_rows(latest_by_state(frame(spark, rows))) == sort_rows(want)


def test_setting_is_put_back(spark, tmp_lake):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    frame(spark, _events(5, 7)).write.parquet(f"{tmp_lake}/events")
    run_latest(spark, f"{tmp_lake}/events", f"{tmp_lake}/changes", f"{tmp_lake}/ckpt")
    assert spark.conf.get(key, None) == before


def test_progress_rows_sum_to_the_feed(spark, tmp_lake):
    src, bronze, ckpt, seen = (f"{tmp_lake}/{n}" for n in ("topic", "bronze", "ckpt", "progress"))
    write_messages(to_messages(frame(spark, _events(90, 1))), f"{src}/a", files=3)
    args = dict(schema=FEED_SCHEMA, options={"maxFilesPerTrigger": "1"}, progress_path=seen)
    assert ingest_available(spark, bronze, ckpt, "parquet", f"{src}/*", **args) == 3
    broken = spark.sql("select cast(null as binary) as key, cast('{' as binary) as value, 's' as topic, 0 as partition, 0L as offset, current_timestamp() as timestamp")
    write_messages(broken, f"{src}/b")
    assert ingest_available(spark, bronze, ckpt, "parquet", f"{src}/*", **args) == 1
    assert ingest_available(spark, bronze, ckpt, "parquet", f"{src}/*", **args) == 0
    got = read_progress(spark, seen).orderBy("batch_id").collect()
    assert [r.batch_id for r in got] == [0, 1, 2, 3]
    assert sum(r.captured_rows for r in got) == 91 == spark.read.parquet(bronze).count()
    assert [r.rows_without_key for r in got] == [0, 0, 0, 1]


@pytest.fixture()
def by_day(spark, tmp_lake):
    rows = [ev(f"k{i}", "INSERT", day(1 + i % 9, i % 24), seq=i) for i in range(90)] + [ev("none", "INSERT", None, seq=99)]
    write_messages(to_messages(frame(spark, rows)), f"{tmp_lake}/topic")
    ingest_available(spark, f"{tmp_lake}/bronze", f"{tmp_lake}/ckpt", "parquet", f"{tmp_lake}/topic", schema=FEED_SCHEMA, by_day=True)
    return f"{tmp_lake}/bronze"


@pytest.mark.parametrize("n", [1, 10, 11, 25, 90, 91, 500])
def test_newest_from_last_days(spark, by_day, n):
    got = latest_events_pruned(spark, by_day, EVENT_DAY, FEED_SCHEMA, n, ("seq",)).collect()
    table = spark.read.schema(FEED_SCHEMA).parquet(by_day).drop(EVENT_DAY)
    assert got == table.orderBy(F.col("timestamp").desc(), F.col("seq").desc()).limit(n).collect()


def test_older_days_are_not_read(spark, by_day):
    assert partition_days(spark, by_day, EVENT_DAY)[0] == "2024-01-09"
    newest = newest_partitions(spark, by_day, EVENT_DAY, 15, FEED_SCHEMA)
    assert {f.split(f"{EVENT_DAY}=")[1][:10] for f in newest.select("tx_id", F.input_file_name().alias("f")).toPandas().f} == {"2024-01-08", "2024-01-09"}
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan, plan


def test_no_days_at_all(spark, tmp_lake):
    frame(spark, []).withColumn(EVENT_DAY, F.lit("x")).write.parquet(f"{tmp_lake}/none")
    assert latest_events_pruned(spark, f"{tmp_lake}/none", EVENT_DAY, FEED_SCHEMA, 5).count() == 0


def test_names_and_values_are_bound(spark, tmp_lake):
    odd = f"{tmp_lake}/it's -- odd"
    spark.range(5).write.parquet(odd)
    text = "select id, :say as say from identifier(:rel) where id >= :least"
    got = bound_sql(spark, text, {"rel": odd}, {"least": 3, "say": "'; drop"}).collect()
    assert sorted((r.id, r.say) for r in got) == [(3, "'; drop"), (4, "'; drop")]
    spark.range(2).createOrReplaceTempView("bound_range")
    assert bound_sql(spark, text, {"rel": "bound_range"}, {"least": 0, "say": None}).count() == 2
    with pytest.raises(ValueError):
        bound_sql(spark, text, {"rel": "x"}, {"rel": "y"})
    assert relation_name("db.t") == "db.t"
