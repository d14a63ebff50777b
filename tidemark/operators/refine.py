"""Refine a change feed into current state: clean → latest event per key → merge.

All three steps are declarative DataFrame operators:

* ``clean``  — null / range / membership predicates, pushed into the parquet scan.
* ``latest_per_key`` — ``row_number()`` over the key, newest first, keep 1.  Catalyst
  plans it as a partial top-1 (``WindowGroupLimit``) before the shuffle and a final one
  after it, so a hot key ships at most one row per input partition: a key holding a
  third of the feed does not land whole in one task.
* ``merge_changes`` — a keyed full outer join of current state and the latest changes
  with one action per key (keep / update / insert / delete / ignore).  Both sides have
  at most one row per key, so the join cannot fan out or skew; when the source comes
  straight from ``latest_per_key`` its shuffle on the key is reused by the join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..spec import BRONZE_TECHNICAL, SALES, ChangeSpec

# --- fixed values: merge outcome labels ---
KEEP, UPDATE, INSERT, DELETE, IGNORE = "keep", "update", "insert", "delete", "ignore"
SURVIVING_ACTIONS = (KEEP, UPDATE, INSERT)
REPLACE, STALE = "replace", "stale"
# --- end of fixed values ---


def clean(df: DataFrame, spec: ChangeSpec = SALES) -> DataFrame:
    """Drop events with a missing required field, a non-positive measure or an unknown op.

    Runs before deduplication: an invalid newest event is dropped and the next older
    valid one wins, also when the invalid one is a delete.
    """
    out = df.dropna(subset=list(spec.required))
    if spec.positive:
        out = out.filter(reduce(lambda a, b: a & b, [F.col(c) > 0 for c in spec.positive]))
    return out.filter(F.col(spec.op_col).isin(*spec.operations))


def newest_first(spec: ChangeSpec) -> list[Column]:
    return [F.col(c).desc() for c in spec.order_by]


def latest_per_key(df: DataFrame, spec: ChangeSpec = SALES, drop: tuple[str, ...] = tuple(BRONZE_TECHNICAL)) -> DataFrame:
    """Newest event of every key (ties broken by the spec's later order columns)."""
    w = Window.partitionBy(spec.key).orderBy(*newest_first(spec))
    ranked = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    return ranked.drop("_rn", *[c for c in drop if c in df.columns])


def current_rows(latest: DataFrame, spec: ChangeSpec = SALES) -> DataFrame:
    """First load: the latest events that are not deletes, business columns only."""
    return latest.filter(~spec.is_delete()).select(*spec.columns)


def _action(spec: ChangeSpec) -> Column:
    in_t, in_s = F.col("_in_t"), F.col("_in_s")
    is_del = F.col(spec.op_col).isin(*spec.delete_ops)
    # Clause conditions of the merge: delete when the op is a delete code, upsert when it
    # is any other known code; a null op matches no clause (target kept, source ignored).
    is_ups = ~is_del
    return (F.when(in_s.isNull(), F.lit(KEEP))
             .when(in_t.isNull() & is_ups, F.lit(INSERT))
             .when(in_t.isNull(), F.lit(IGNORE))
             .when(is_del, F.lit(DELETE))
             .when(is_ups, F.lit(UPDATE))
             .otherwise(F.lit(KEEP)))


def merge_plan(target: DataFrame, source: DataFrame, spec: ChangeSpec = SALES,
               source_is_latest: bool = False) -> DataFrame:
    """Full outer join of state and changes with the chosen action per key.

    Columns: the business columns of the resulting row (target values for ``keep``,
    source values otherwise) plus ``_action``.  ``source`` is reduced to its latest event
    per key first unless the caller says it already is.
    """
    src = source if source_is_latest else latest_per_key(clean(source, spec), spec)
    cols = list(spec.columns)
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols]).withColumn("_in_t", F.lit(True))
    s = src.select(*cols).withColumn("_in_s", F.lit(True))
    j = t.join(s, t[f"_t_{spec.key}"] == s[spec.key], "full_outer")
    act = _action(spec)
    j = j.withColumn("_action", act)
    out = [F.when(F.col("_action") == KEEP, F.col(f"_t_{c}")).otherwise(F.col(c)).alias(c) for c in cols]
    return j.select(*out, "_action")


def merge_changes(target: DataFrame, source: DataFrame, spec: ChangeSpec = SALES,
                  source_is_latest: bool = False, observation: Observation | None = None) -> DataFrame:
    """New current state after applying the changes to ``target``.

    Outcome per key: target row + delete → removed; target row + insert/update → all
    columns replaced; no target row + insert/update → inserted; no target row + delete →
    ignored; target row without a change → kept.  With an ``Observation`` the per-action
    counts are collected by the same job that writes the result (no second pass).
    """
    plan = merge_plan(target, source, spec, source_is_latest)
    if observation is not None:
        plan = plan.observe(observation, *[
            F.count_if(F.col("_action") == a).alias(f"num_{a}") for a in (KEEP, UPDATE, INSERT, DELETE, IGNORE)
        ])
    return plan.filter(F.col("_action").isin(*SURVIVING_ACTIONS)).drop("_action")


def merge_action_counts(target: DataFrame, source: DataFrame, spec: ChangeSpec = SALES,
                        source_is_latest: bool = False) -> DataFrame:
    """``(action, rows)`` — how many keys each merge clause touched."""
    plan = merge_plan(target, source, spec, source_is_latest)
    return plan.groupBy(F.col("_action").alias("action")).agg(F.count(F.lit(1)).alias("rows"))


def state_columns(spec: ChangeSpec) -> list[str]:
    """Columns of the latest-event state: business columns plus any order tie-breakers."""
    return list(spec.columns) + [c for c in spec.order_by if c not in spec.columns]


def upsert_newest(state: DataFrame, latest: DataFrame, spec: ChangeSpec = SALES,
                  observation: Observation | None = None) -> DataFrame:
    """Latest-event state after a batch: per key, the newer of the stored and the incoming
    latest event (deletes included, as tombstones).

    "Newer" compares the spec's order columns as one tuple, so merging batches one by one
    gives the latest event over all batches — the same as deduplicating everything at
    once, whatever order the batches arrive in, and re-merging a batch changes nothing.
    Both sides have at most one row per key; the join cannot fan out or skew.
    """
    cols = state_columns(spec)
    order = list(spec.order_by)
    t = state.select(*[F.col(c).alias(f"_t_{c}") for c in cols]).withColumn("_in_t", F.lit(True))
    s = latest.select(*cols).withColumn("_in_s", F.lit(True))
    j = t.join(s, t[f"_t_{spec.key}"] == s[spec.key], "full_outer")
    newer = F.struct(*[F.col(c) for c in order]) > F.struct(*[F.col(f"_t_{c}") for c in order])
    act = (F.when(F.col("_in_s").isNull(), F.lit(KEEP))
            .when(F.col("_in_t").isNull(), F.lit(INSERT))
            .when(newer, F.lit(REPLACE))
            .otherwise(F.lit(STALE)))
    j = j.withColumn("_action", act)
    if observation is not None:
        j = j.observe(observation, *[F.count_if(F.col("_action") == a).alias(f"num_{a}")
                                     for a in (KEEP, INSERT, REPLACE, STALE)])
    take_source = F.col("_action").isin(INSERT, REPLACE)
    return j.select(*[F.when(take_source, F.col(c)).otherwise(F.col(f"_t_{c}")).alias(c) for c in cols])


def current_from_state(state: DataFrame, spec: ChangeSpec = SALES) -> DataFrame:
    """Current-state rows of a latest-event state: tombstones dropped, business columns only."""
    return state.filter(~spec.is_delete()).select(*spec.columns)
