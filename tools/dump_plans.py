"""Write PLANS.md: final (adaptive) physical plans of the key operators at a given sf.

Usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df, width: int = 150) -> str:
    run = df._jdf.queryExecution()
    run.toRdd().count()                       # runs this plan, so that it is the final one
    p = run.executedPlan().toString().split("+- == Initial Plan ==")[0]
    lines = []
    for line in p.split("\n"):
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        lines.append(line if len(line) <= width else line[: width - 3] + "...")
    return "\n".join(lines)


def main() -> None:
    from tidemark.operators.refine import clean, latest_per_key, merge_changes, upsert_newest
    from tidemark.plans import gold
    from tidemark.plans import queries as Q
    from tidemark.plans.medallion import build_gold, quality, refine_frame
    from tidemark.session import build_session, scratch_path, shuffle_width
    from tidemark.sources.tables import bucketing, read_table
    from tidemark.streaming.refine_stream import merge_batch

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[*]", shuffle_partitions=16)
    S = Q.SPEC
    out = [f"# Physical plans\n\nPhysical plans at `{sf}`, local mode, 16 shuffle partitions, generated by "
           "`tools/dump_plans.py` the final adaptive plans after running. Expression ids and plan ids are "
           "stripped; long lines are cut.\n"]

    def add(title: str, note: str, df) -> None:
        out.append(f"## {title}\n\n{note}\n\n```\n{tree(df)}\n```\n")

    add("dedup_latest", "Cleaning predicates at the scan; broadcast dimension "
        "joins (AQE, size-checked); partial top-1 (`WindowGroupLimit Partial`) before the only key shuffle.",
        Q.q_dedup_latest(spark, sf))

    first, second = Q._split(Q._feed_a(spark, sf))
    silver = scratch_path(spark, "plans-silver")
    refine_frame(first, silver, S)
    n = bucketing(spark, silver)[0]
    with shuffle_width(spark, n):
        merged = merge_changes(read_table(spark, silver), latest_per_key(clean(second, S), S), S,
                               source_is_latest=True)
        add("silver merge (refine job on bucketed Silver)", f"Silver is bucketed by `tx_id` into {n} buckets: "
            "the bucketed scan feeds the full outer sort-merge join directly; the only exchange is the changes' "
            "dedup shuffle.", merged)

    state = scratch_path(spark, "plans-state")
    merge_batch(first, state, S)
    n = bucketing(spark, state)[0]
    with shuffle_width(spark, n):
        add("incremental refine micro-batch (newest-wins upsert into the tombstone state)",
            "Same shape as the merge: the state is read in place, only the batch is shuffled.",
            upsert_newest(read_table(spark, state), latest_per_key(clean(second, S), S), S))

    stg = Q._stg_a(spark, sf)
    add("gold_daily", "Unique Silver keys counted with `count`, one distinct aggregate left: two hash "
        "aggregation levels keyed (fecha, cliente_id) then fecha, no `Expand`; range sort of the small result.",
        gold.daily(stg, key_unique=True))
    add("gold_product", "No distinct aggregation at all: partial + final hash aggregate by product.",
        gold.by_product(stg, ordered=False, key_unique=True))
    add("product_ranking", "Distributed positions: range-partitioned staging table, per-partition row numbers, "
        "broadcast per-partition offsets (one row per partition).",
        gold.product_ranking(gold.by_product(stg, ordered=False, key_unique=True)))

    root = scratch_path(spark, "plans-lake")
    feed = Q._feed_a(spark, sf)
    refine_frame(feed, f"{root}/silver", S)
    golds = {k: read_table(spark, p) for k, p in build_gold(spark, f"{root}/silver", f"{root}/gold").items()}
    add("dq_results (21 tests)", "`unique(tx_id)` "
        "aggregates bucketed Silver without a shuffle; one aggregation per model for all not-null tests.",
        quality(spark, feed, read_table(spark, f"{root}/silver"), golds))

    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
