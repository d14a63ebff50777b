"""Merge by key-hash partitions, and Gold from its change log, against full rebuilds."""

import os
import random

import pytest

from helpers import day, ev, frame

from tidemark.operators import partition_merge as pm
from tidemark.operators.refine import clean, current_rows, latest_per_key
from tidemark.plans import gold, gold_delta
from tidemark.plans.staging import stg_silver
from tidemark.spec import SALES_SEQ as S


def files(root, name="state"):
    return {os.path.relpath(os.path.join(d, f), root): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(f"{root}/{name}") for f in fs if f.endswith(".parquet")}


def local(path):
    return path.removeprefix("file:")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def full(spark, events):
    return current_rows(latest_per_key(clean(frame(spark, events), S), S), S)


def random_events(rng, n, keys, seq):
    ops = ["INSERT", "UPDATE", "UPDATE", "DELETE", "DELETE", None, "ODD"]
    return [ev(f"k{rng.randrange(keys)}", rng.choice(ops), day(rng.randrange(1, 5), rng.randrange(3)) if rng.random() > 0.05 else "no time", precio=rng.choice([0.333, 2.5, -1.0, 10.005]), cantidad=rng.randrange(0, 4),
               cliente=f"C{rng.randrange(4)}", producto=f"P{rng.randrange(3)}", seq=seq + i) for i in range(n)]


def test_batches_against_a_full_rebuild(spark, tmp_lake):
    rng, seen = random.Random(11), []
    for i in range(4):
        batch = random_events(rng, 30, 25, 100 * i)
        seen += batch
        if pm.merge_batch(frame(spark, batch), tmp_lake, i, S, parts=7):
            gold_delta.apply_batch(spark, tmp_lake, i, parts=5)
        if i == 2:                                   # replays change nothing, whichever step they begin at
            pm.merge_batch(frame(spark, batch), tmp_lake, i, S)
            gold_delta.apply_batch(spark, tmp_lake, i)
    want = full(spark, seen)
    assert rows(pm.current(spark, tmp_lake, S)) == rows(want)
    stg = stg_silver(want)
    for name, df in (("gold_kpi_ventas", gold.daily(stg, key_unique=True)), ("gold_kpi_ventas_hora", gold.hourly(stg, key_unique=True)), ("gold_kpi_producto", gold.by_product(stg, key_unique=True))):
        assert rows(gold_delta.read_gold(spark, tmp_lake, name)) == rows(df), name


def test_only_touched_partitions_are_read_and_written(spark, tmp_lake):
    first = [ev(f"k{i}", "INSERT", day(1), seq=i) for i in range(40)]
    pm.merge_batch(frame(spark, first), tmp_lake, 0, S, parts=16)
    root = local(tmp_lake)
    before = files(root)
    assert len({os.path.dirname(f) for f in before}) > 10
    which = pm.merge_batch(frame(spark, [ev("k3", "DELETE", day(2), seq=90), ev("k4", "UPDATE", day(2), precio=7.0, seq=91)]), tmp_lake, 1, S)
    assert 1 <= len(which) <= 2
    after = files(root)
    changed = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert {os.path.dirname(f) for f in changed} == {f"state/_parts=16/_part={p}" for p in which}
    assert {r.tx_id for r in pm.current(spark, tmp_lake, S).collect()} == {f"k{i}" for i in range(40) if i != 3}
    plan = pm.read_parts(spark, f"{tmp_lake}/state", which)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_part#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows(spark.read.parquet(f"{tmp_lake}/changes/batch=1").select("sign", "tx_id", "precio")) == [(-1, "k3", 10.0), (-1, "k4", 10.0), (1, "k4", 7.0)]


def test_merge_deals_each_side_once(spark, tmp_lake):
    latest = frame(spark, [ev("a", "INSERT", day(1))]).select(*pm.state_columns(S)).withColumn(pm.PART, pm.part_of("tx_id", 4))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pm._dealt_by_part(spark):
            plan = pm.merge_images(latest, latest, S)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") == 2 and "ENSURE_REQUIREMENTS" not in plan


def test_a_late_older_event_and_an_empty_batch(spark, tmp_lake):
    pm.merge_batch(frame(spark, [ev("a", "DELETE", day(3)), ev("b", "INSERT", day(1))]), tmp_lake, 0, S, parts=1)
    pm.merge_batch(frame(spark, [ev("a", "UPDATE", day(2))]), tmp_lake, 1, S)
    assert pm.merge_batch(frame(spark, [ev(None, "INSERT", day(5))]), tmp_lake, 2, S) == []
    assert {r.tx_id for r in pm.current(spark, tmp_lake, S).collect()} == {"b"}
    assert spark.read.parquet(f"{tmp_lake}/changes/batch=1").count() == 0


def test_a_lost_gold_write_is_made_up_for(spark, tmp_lake, monkeypatch):
    events = [ev(f"k{i}", "INSERT", day(1 + i % 3), cliente=f"C{i % 2}", seq=i) for i in range(12)]
    pm.merge_batch(frame(spark, events), tmp_lake, 0, S, parts=3)
    gold_delta.apply_batch(spark, tmp_lake, 0, parts=3)
    pm.merge_batch(frame(spark, [ev(f"k{i}", "DELETE", day(9), seq=50 + i) for i in range(0, 12, 3)]), tmp_lake, 1, S)
    write, calls = gold_delta.replace_parts, []

    def fails(df, path, parts):
        calls.append(path)
        if "sums/time" in path:
            raise OSError("lost")
        write(df, path, parts)

    monkeypatch.setattr(gold_delta, "replace_parts", fails)
    try:
        gold_delta.apply_batch(spark, tmp_lake, 1)
    except OSError:
        pass
    monkeypatch.setattr(gold_delta, "replace_parts", write)
    gold_delta.apply_batch(spark, tmp_lake, 1)
    stg = stg_silver(pm.current(spark, tmp_lake, S))
    assert rows(gold_delta.read_gold(spark, tmp_lake, "gold_kpi_ventas")) == rows(gold.daily(stg, key_unique=True))
    assert rows(gold_delta.read_gold(spark, tmp_lake, "gold_kpi_producto")) == rows(gold.by_product(stg, key_unique=True))


def _plans(monkeypatch, module):
    """The plans of what ``module`` writes by ``replace_parts``, by path."""
    write, plans = module.replace_parts, {}

    def noted(df, path, parts):
        plans[path] = df._jdf.queryExecution().executedPlan().toString()
        write(df, path, parts)

    monkeypatch.setattr(module, "replace_parts", noted)
    return plans


def test_the_state_is_shuffled_once(spark, tmp_lake, monkeypatch):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pm.merge_batch(frame(spark, [ev(f"k{i}", "INSERT", day(1), seq=i) for i in range(40)]), tmp_lake, 0, S, parts=5)
        plans = _plans(monkeypatch, pm)
        which = pm.merge_batch(frame(spark, [ev(f"k{i}", "UPDATE", day(2), seq=50 + i) for i in range(30)]), tmp_lake, 1, S)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plans[f"{tmp_lake}/state"].count("Exchange hashpartitioning") == 1
    assert len(files(local(tmp_lake))) == len(which) == 5      # each partition in one task, thus one file


def test_a_change_log_lost_after_the_merge_is_made_again(spark, tmp_lake):
    pm.merge_batch(frame(spark, [ev(f"k{i}", "INSERT", day(1), seq=i) for i in range(6)]), tmp_lake, 0, S, parts=3)
    batch = [ev("k1", "DELETE", day(2), seq=10), ev("k2", "UPDATE", day(2), precio=7.0, seq=11), ev("new", "INSERT", day(2), seq=12), ev("k3", "UPDATE", day(1), precio=9.0, seq=1)]
    pm.merge_batch(frame(spark, batch), tmp_lake, 1, S)
    log = rows(spark.read.parquet(f"{tmp_lake}/changes/batch=1"))
    assert [r[:2] for r in log] == [(-1, "k1"), (-1, "k2"), (1, "k2"), (1, "new")]
    os.remove(f"{local(tmp_lake)}/changes/batch=1/_SUCCESS")
    pm.merge_batch(frame(spark, batch), tmp_lake, 1, S)
    assert rows(spark.read.parquet(f"{tmp_lake}/changes/batch=1")) == log


def test_a_table_dealt_by_another_hash_is_refused(spark, tmp_lake):
    latest = frame(spark, [ev(f"k{i}", "INSERT", day(1)) for i in range(9)]).select(*pm.state_columns(S))
    pm.replace_parts(latest.withColumn(pm.PART, pm.part_of("tx_id", 7) + 1), f"{tmp_lake}/state", 7)
    with pytest.raises(ValueError):
        pm.merge_batch(frame(spark, [ev("a", "INSERT", day(1))]), tmp_lake, 0, S)


def test_sums_are_dealt_by_the_grain_in_one_shuffle(spark, tmp_lake, monkeypatch):
    plans = _plans(monkeypatch, gold_delta)
    for i in range(2):
        pm.merge_batch(frame(spark, [ev(f"k{j}", "UPDATE", day(1 + i, j % 4), cliente=f"C{j % 3}", seq=40 * i + j) for j in range(20)]), tmp_lake, i, S, parts=4)
        gold_delta.apply_batch(spark, tmp_lake, i, parts=4)
    for name in ("time", "product"):
        assert plans[f"{tmp_lake}/sums/{name}"].count("Exchange hashpartitioning") == 1, name
    stg = stg_silver(pm.current(spark, tmp_lake, S))
    assert rows(gold_delta.read_gold(spark, tmp_lake, "gold_kpi_ventas")) == rows(gold.daily(stg, key_unique=True))
