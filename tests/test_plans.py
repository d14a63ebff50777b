"""Physical-plan properties the design relies on."""

from helpers import SF0001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_partial_top1_before_shuffle(spark):
    import __spark_entry__ as e

    p = plan(e.queries()["dedup_latest"](spark, SF0001))
    assert "WindowGroupLimit" in p
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_top_n_is_take_ordered(spark):
    import __spark_entry__ as e

    df = e.queries()["latest_events"](spark, SF0001)
    df.collect()
    assert "TakeOrderedAndProject" in plan(df)


def test_filters_and_columns_reach_the_scan(spark):
    import __spark_entry__ as e

    df = e.queries()["clean_events"](spark, SF0001)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_orderkey)" in p
    assert "l_extendedprice" not in p           # unused lineitem columns are pruned


def test_merge_reuses_the_dedup_shuffle(spark, tmp_lake):
    from tidemark.operators.refine import clean, current_rows, latest_per_key, merge_changes
    from tidemark.sources import feeds
    from tidemark.spec import SALES_SEQ as S

    feed = feeds.change_feed_a(spark, SF0001)
    silver = current_rows(latest_per_key(clean(feed, S), S), S)
    silver.write.parquet(f"{tmp_lake}/s")
    merged = merge_changes(spark.read.parquet(f"{tmp_lake}/s"), latest_per_key(clean(feed, S), S), S,
                           source_is_latest=True)
    merged.write.format("noop").mode("overwrite").save()
    p = plan(merged)
    # one shuffle for the target, one for the changes (shared by dedup and join)
    assert p.count("Exchange hashpartitioning(tx_id") + p.count("Exchange hashpartitioning(_t_tx_id") <= 2


def test_gold_on_unique_key_silver_has_no_expand(spark):
    import __spark_entry__ as e

    for name in ("gold_daily", "gold_hourly", "gold_product"):
        p = e.queries()[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in p, name


def test_unique_key_count_equals_distinct_count(spark):
    from tidemark.plans import gold
    from tidemark.plans.queries import _feed_b, _silver
    from tidemark.plans.staging import stg_silver

    stg = stg_silver(_silver(_feed_b(spark, SF0001)))
    for fn in (gold.daily, gold.hourly, gold.by_product):
        a = sorted(map(tuple, fn(stg, ordered=False, key_unique=True).collect()), key=str)
        b = sorted(map(tuple, fn(stg, ordered=False, key_unique=False).collect()), key=str)
        assert a == b


def test_merge_reads_bucketed_silver_without_shuffling_it(spark, tmp_lake):
    from tidemark.operators.refine import clean, latest_per_key, merge_changes
    from tidemark.plans.medallion import refine_frame
    from tidemark.plans.queries import _feed_a, _split
    from tidemark.session import shuffle_width
    from tidemark.sources.tables import bucketing, read_table
    from tidemark.spec import SALES_SEQ as S

    first, second = _split(_feed_a(spark, SF0001))
    path = f"{tmp_lake}/silver"
    refine_frame(first, path, S, buckets=6)
    assert bucketing(spark, path) == (6, "tx_id")
    with shuffle_width(spark, 6):
        merged = merge_changes(read_table(spark, path), latest_per_key(clean(second, S), S), S, source_is_latest=True)
        merged.write.format("noop").mode("overwrite").save()
        p = plan(merged)
    assert p.count("Exchange hashpartitioning") == 1          # the changes' dedup shuffle only
    assert "Exchange hashpartitioning(_t_tx_id" not in p
    res = refine_frame(second, path, S)
    assert res.status == "merged" and bucketing(spark, path) == (6, "tx_id")
    assert read_table(spark, path).count() == read_table(spark, path).select("tx_id").distinct().count()


def test_incremental_merge_reads_state_in_place(spark, tmp_lake):
    from tidemark.operators.refine import clean, latest_per_key, upsert_newest
    from tidemark.plans.queries import _feed_a, _split
    from tidemark.session import shuffle_width
    from tidemark.sources.tables import read_table
    from tidemark.spec import SALES_SEQ as S
    from tidemark.streaming.refine_stream import merge_batch

    first, second = _split(_feed_a(spark, SF0001))
    state = f"{tmp_lake}/state"
    merge_batch(first, state, S, buckets=5)
    with shuffle_width(spark, 5):
        new = upsert_newest(read_table(spark, state), latest_per_key(clean(second, S), S), S)
        new.write.format("noop").mode("overwrite").save()
        p = plan(new)
    assert p.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in p
