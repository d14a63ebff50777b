"""Message positions: dense offsets by key, start positions, lost and repeated messages."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import offsets as of

SCHEMA = "topic string, partition int, offset long"


def runs(rows, start):
    out = []
    for slot in sorted({(t, p) for t, p, _ in rows}):
        got = sorted(o for t, p, o in rows if (t, p) == slot and o >= start.get(slot, 0))
        at, last = 0, start.get(slot)
        while at < len(got):
            end = at
            while end + 1 < len(got) and got[end + 1] <= got[end] + 1:
                end += 1
            first, final = got[at], got[end]
            out.append((*slot, first, final, first - (last if last is not None else first), end - at + 1 - (final - first + 1)))
            last, at = final + 1, end + 1
    return sorted(out)


@pytest.mark.parametrize("block", [3, 1000])
def test_report_against_plain_loops(spark, block):
    rng = random.Random(4)
    rows = [("t", p, o) for p in range(3) for o in range(60) if rng.random() > 0.25] + [("u", 0, 0)]
    rows += rng.sample(rows, 40)
    msgs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    start = {("t", 0): 7, ("t", 1): 0}
    table = spark.createDataFrame([(t, p, o) for (t, p), o in start.items()], "topic string, partition int, start_offset long")
    assert sorted(map(tuple, of.offset_report(msgs, table, block).collect())) == runs(rows, start)
    report = of.offset_report(msgs, block=block)
    assert sorted(map(tuple, report.collect())) == runs(rows, {})
    with pytest.raises(of.DataLoss):
        of.require_no_loss(report)
    of.require_no_loss(of.offset_report(msgs.where("topic = 'u'")))
    assert sorted(map(tuple, of.deliver_once(msgs).collect())) == sorted(set(rows))
    with pytest.raises(ValueError):
        of.from_positions(msgs, "latest")


def test_offsets_are_dense_and_keep_key_order(spark, tmp_lake):
    rng = random.Random(9)
    rows = [(None if i % 50 == 0 else "hot" if i % 3 == 0 else f"k{rng.randrange(20)}", i) for i in range(400)]
    rng.shuffle(rows)
    msgs = spark.createDataFrame(rows, "key string, seq long").withColumn("topic", F.lit("t")).repartition(6)
    got = of.with_offsets(msgs, "key", [F.col("seq").asc()], 4)
    by_slot, slot_of = {}, {}
    for r in got.collect():
        by_slot.setdefault(r.partition, []).append((r.offset, r.seq))
        slot_of.setdefault(r.key, set()).add(r.partition)
    assert all(len(s) == 1 for s in slot_of.values()) and slot_of[None] == {0}
    for found in by_slot.values():
        found.sort()
        assert [o for o, _ in found] == list(range(len(found))) and [s for _, s in found] == sorted(s for _, s in found)
    of.write_partitioned(got, f"{tmp_lake}/log", block=50)
    back = spark.read.parquet(f"{tmp_lake}/log")
    assert back.count() == 400
    in_file = back.groupBy(F.input_file_name().alias("f")).agg(F.count_distinct("partition", "block").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    assert all(r.n == 1 and r.rows <= 50 for r in in_file)
