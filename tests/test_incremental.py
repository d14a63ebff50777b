"""Incremental refine: latest-event state with tombstones equals the full rescan."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import day, ev, frame

from tidemark.operators.refine import clean, current_rows, latest_per_key
from tidemark.sources.tables import current_version, read_table
from tidemark.spec import FEED_SCHEMA
from tidemark.spec import SALES_SEQ as S
from tidemark.streaming.refine_stream import merge_batch, refine_incremental, silver_view


def full_rescan(spark, rows):
    return {tuple(r) for r in current_rows(latest_per_key(clean(frame(spark, rows), S), S), S).collect()}


def test_late_older_event_does_not_resurrect_a_deleted_key(spark, tmp_lake):
    state = f"{tmp_lake}/state"
    merge_batch(frame(spark, [ev("a", "INSERT", day(1)), ev("a", "DELETE", day(3))]), state, S, buckets=4)
    assert silver_view(spark, state, S).count() == 0
    merge_batch(frame(spark, [ev("a", "UPDATE", day(2))]), state, S)        # older, arrives late
    assert silver_view(spark, state, S).count() == 0
    merge_batch(frame(spark, [ev("a", "INSERT", day(4), precio=9.0)]), state, S)   # newer: re-insert
    assert [r.precio for r in silver_view(spark, state, S).collect()] == [9.0]


def test_replayed_batch_and_empty_batch_change_nothing(spark, tmp_lake):
    state = f"{tmp_lake}/state"
    batch = frame(spark, [ev("a", "INSERT", day(1)), ev("b", "UPDATE", day(2))])
    merge_batch(batch, state, S, buckets=2)
    before = {tuple(r) for r in read_table(spark, state).collect()}
    merge_batch(batch, state, S)
    assert {tuple(r) for r in read_table(spark, state).collect()} == before
    assert merge_batch(frame(spark, [ev(None, "INSERT", day(5))]), state, S) is None     # no clean events
    assert current_version(spark, state) == 1


def test_stream_over_bronze_files(spark, tmp_lake):
    bronze, state, ckpt = f"{tmp_lake}/bronze", f"{tmp_lake}/state", f"{tmp_lake}/ckpt"
    assert refine_incremental(spark, bronze, state, ckpt, S) == "no_bronze"
    rows1 = [ev("a", "INSERT", day(1)), ev("b", "INSERT", day(1))]
    rows2 = [ev("b", "DELETE", day(2)), ev("c", "UPDATE", day(2)), ev("a", "UPDATE", day(0), precio=1.0)]
    frame(spark, rows1).write.parquet(bronze)
    refine_incremental(spark, bronze, state, ckpt, S)
    frame(spark, rows2).write.mode("append").parquet(bronze)
    refine_incremental(spark, bronze, state, ckpt, S)
    v = current_version(spark, state)
    refine_incremental(spark, bronze, state, ckpt, S)          # nothing new: no new version
    assert current_version(spark, state) == v
    assert {tuple(r) for r in silver_view(spark, state, S).collect()} == full_rescan(spark, rows1 + rows2)


event = st.tuples(st.integers(0, 5), st.sampled_from(["INSERT", "UPDATE", "DELETE", "UPSERT"]), st.integers(1, 9),
                  st.sampled_from([1.5, None]))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=20), st.integers(1, 3), st.randoms(use_true_random=False))
def test_any_batch_order_equals_full_rescan(spark, events, k, rnd):
    from tidemark.session import scratch_path

    rows = [ev(f"k{a}", op, day(d), precio=p, seq=i) for i, (a, op, d, p) in enumerate(events)]
    shuffled = rows[:]
    rnd.shuffle(shuffled)                                          # batches in any arrival order
    state = scratch_path(spark, "state")
    size = max(1, len(rows) // k)
    for i in range(0, len(shuffled), size):
        merge_batch(frame(spark, shuffled[i:i + size]), state, S, buckets=3)
    got = {tuple(r) for r in silver_view(spark, state, S).collect()} if current_version(spark, state) is not None else set()
    assert got == full_rescan(spark, rows)


def test_incremental_medallion_runs_with_retention(spark, tmp_lake):
    from tidemark.plans.medallion import run_medallion
    from tidemark.sources.tables import versions

    bronze, state, gold = f"{tmp_lake}/bronze", f"{tmp_lake}/state", f"{tmp_lake}/gold"
    frame(spark, [ev("a", "INSERT", day(1)), ev("b", "INSERT", day(1))]).write.parquet(bronze)
    run_medallion(spark, bronze, state, gold, S, incremental=True, retain_versions=1)
    frame(spark, [ev("b", "DELETE", day(2)), ev("c", "UPDATE", day(2))]).write.mode("append").parquet(bronze)
    out = run_medallion(spark, bronze, state, gold, S, incremental=True, retain_versions=1)
    assert sorted(r.tx_id for r in silver_view(spark, state, S).collect()) == ["a", "c"]
    assert versions(spark, state) == [0, 1]              # history kept, old data removed
    assert read_table(spark, out["gold"]["gold_kpi_ventas"]).count() == 2


def test_incremental_over_a_streaming_sink_bronze(spark, tmp_lake):
    """Bronze written by the capture stream (file sink with its metadata log) feeds the
    incremental refine; the result equals the batch refine over the same Bronze."""
    from tidemark.plans.medallion import refine
    from tidemark.sources.messages import to_messages, write_messages
    from tidemark.streaming.ingest import ingest_available

    src, bronze = f"{tmp_lake}/topic", f"{tmp_lake}/bronze"
    rows = [ev("a", "INSERT", day(1)), ev("a", "UPDATE", day(2), precio=4.0), ev("b", "INSERT", day(1)),
            ev("b", "DELETE", day(3)), ev("c", "INSERT", day(2), cantidad=0)]
    write_messages(to_messages(frame(spark, rows[:3])), f"{src}/1", files=1)
    ingest_available(spark, bronze, f"{tmp_lake}/ckpt-in", "parquet", f"{src}/*", schema=FEED_SCHEMA)
    refine_incremental(spark, bronze, f"{tmp_lake}/state", f"{tmp_lake}/ckpt-ref", S)
    write_messages(to_messages(frame(spark, rows[3:])), f"{src}/2", files=1)
    ingest_available(spark, bronze, f"{tmp_lake}/ckpt-in", "parquet", f"{src}/*", schema=FEED_SCHEMA)
    refine_incremental(spark, bronze, f"{tmp_lake}/state", f"{tmp_lake}/ckpt-ref", S)
    refine(spark, bronze, f"{tmp_lake}/silver", S)
    got = {tuple(r) for r in silver_view(spark, f"{tmp_lake}/state", S).collect()}
    assert got == {tuple(r) for r in read_table(spark, f"{tmp_lake}/silver").collect()} == full_rescan(spark, rows)
    assert {r[0] for r in got} == {"a"}


def test_backlog_in_bounded_micro_batches(spark, tmp_lake):
    bronze, state, ckpt = f"{tmp_lake}/bronze", f"{tmp_lake}/state", f"{tmp_lake}/ckpt"
    rows = [ev(f"k{i % 4}", "INSERT" if i % 3 else "DELETE", day(1 + i % 9), seq=i) for i in range(24)]
    frame(spark, rows).repartition(4).write.parquet(bronze)
    refine_incremental(spark, bronze, state, ckpt, S, options={"maxFilesPerTrigger": "1"})
    assert len(_versions(spark, state)) >= 2                # several commits, one per micro-batch
    assert {tuple(r) for r in silver_view(spark, state, S).collect()} == full_rescan(spark, rows)


def _versions(spark, path):
    from tidemark.sources.tables import versions

    return versions(spark, path)
