"""Clean / latest-per-key / merge on hand-built events: every row of the merge table."""

from helpers import as_set, day, ev, frame

from tidemark.operators.refine import clean, current_rows, latest_per_key, merge_action_counts, merge_changes
from tidemark.spec import SALES_SEQ

S = SALES_SEQ


def silver(spark, rows):
    return current_rows(latest_per_key(clean(frame(spark, rows), S), S), S)


def test_clean_drops_nulls_nonpositive_and_unknown_ops(spark):
    rows = [
        ev("a", "INSERT", day(1)),
        ev(None, "INSERT", day(1)),
        ev("b", "INSERT", day(1), precio=None),
        ev("c", "INSERT", day(1), precio=0.0),
        ev("d", "INSERT", day(1), cantidad=0),
        ev("e", "UPSERT", day(1)),
        ev("f", None, day(1)),
        ev("g", "INSERT", None),
        ev("h", "INSERT", day(1), sku=None),       # sku may be null
        ev("i", "DELETE", day(1)),
    ]
    got = {r.tx_id for r in clean(frame(spark, rows), S).collect()}
    assert got == {"a", "h", "i"}


def test_invalid_newest_event_falls_back_to_older_valid(spark):
    rows = [ev("a", "INSERT", day(1), precio=5.0), ev("a", "DELETE", day(2), precio=None)]
    out = silver(spark, rows).collect()
    assert [(r.tx_id, r.tipo_operacion, r.precio) for r in out] == [("a", "INSERT", 5.0)]


def test_latest_uses_tiebreak_desc(spark):
    rows = [ev("a", "INSERT", day(1), precio=1.0, seq=1), ev("a", "UPDATE", day(1), precio=2.0, seq=2)]
    out = latest_per_key(clean(frame(spark, rows), S), S).collect()
    assert len(out) == 1 and out[0].precio == 2.0


def test_first_load_drops_deletes_and_keeps_latest(spark):
    rows = [ev("a", "INSERT", day(1)), ev("a", "UPDATE", day(2), precio=3.0),
            ev("b", "INSERT", day(1)), ev("b", "DELETE", day(3)),
            ev("c", "UPDATE", day(1))]                        # update of unseen key = insert
    assert as_set(silver(spark, rows), ("tx_id", "tipo_operacion", "precio")) == {("a", "UPDATE", 3.0), ("c", "UPDATE", 10.0)}


def test_merge_outcome_table(spark):
    target = silver(spark, [ev("keep", "INSERT", day(1)), ev("upd", "INSERT", day(1)), ev("del", "INSERT", day(1))])
    changes = frame(spark, [
        ev("upd", "UPDATE", day(5), precio=99.0, cliente="CLI-9", producto="P9"),
        ev("del", "DELETE", day(5)),
        ev("new", "INSERT", day(5)),
        ev("newupd", "UPDATE", day(5)),
        ev("ghost", "DELETE", day(5)),
    ])
    merged = merge_changes(target, changes, S)
    got = {r.tx_id: r for r in merged.collect()}
    assert set(got) == {"keep", "upd", "new", "newupd"}
    assert (got["upd"].precio, got["upd"].cliente_id, got["upd"].producto, got["upd"].tipo_operacion) == \
        (99.0, "CLI-9", "P9", "UPDATE")                    # all columns replaced
    assert got["keep"].tipo_operacion == "INSERT"
    counts = {r.action: r.rows for r in merge_action_counts(target, changes, S).collect()}
    assert counts == {"keep": 1, "update": 1, "delete": 1, "insert": 2, "ignore": 1}


def test_reinsert_after_delete(spark):
    target = silver(spark, [ev("a", "INSERT", day(1))])
    step1 = merge_changes(target, frame(spark, [ev("a", "DELETE", day(2))]), S)
    assert step1.count() == 0
    step2 = merge_changes(step1, frame(spark, [ev("a", "INSERT", day(3), precio=7.0)]), S)
    assert [(r.tx_id, r.precio) for r in step2.collect()] == [("a", 7.0)]


def test_merge_with_only_invalid_changes_keeps_target(spark):
    target = silver(spark, [ev("a", "INSERT", day(1))])
    merged = merge_changes(target, frame(spark, [ev("a", "DELETE", day(2), precio=None)]), S)
    assert as_set(merged) == as_set(target)


def test_zero_clean_events_is_a_noop(spark, tmp_lake):
    from tidemark.plans.medallion import refine_frame
    from tidemark.sources.tables import table_exists

    res = refine_frame(frame(spark, [ev(None, "INSERT", day(1))]), f"{tmp_lake}/silver", S)
    assert res.status == "no_events"
    assert not table_exists(spark, f"{tmp_lake}/silver")


def test_missing_bronze_is_a_noop(spark, tmp_lake):
    from tidemark.plans.medallion import refine

    res = refine(spark, f"{tmp_lake}/nope", f"{tmp_lake}/silver", S)
    assert res.status == "no_bronze"


def test_zero_clean_events_leaves_existing_silver_unchanged(spark, tmp_lake):
    from tidemark.plans.medallion import refine_frame
    from tidemark.sources.tables import current_version, read_table

    path = f"{tmp_lake}/silver"
    assert refine_frame(frame(spark, [ev("a", "INSERT", day(1))]), path, S).status == "created"
    res = refine_frame(frame(spark, [ev("a", "DELETE", day(2), precio=None)]), path, S)
    assert res.status == "no_events" and current_version(spark, path) == 0
    assert [r.tx_id for r in read_table(spark, path).collect()] == ["a"]
