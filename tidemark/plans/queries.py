"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query starts from the warehouse tables under ``sf_dir`` (feed A from order
lines, feed B from raw events) and runs the library operators over all of them.
Queries that exercise writers (snapshots, streaming capture, catalog, export) write
under the session's shared checkpoint folder and return a batch read of what they wrote.
Time keys are returned as ``timestamp_ntz`` (UTC wall clock) so they compare with
zone-less timestamps elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality as dq
from ..operators import bitmaps, partition_merge
from ..operators.inspect import describe
from ..operators.refine import clean, current_rows, latest_per_key, merge_action_counts
from ..session import ensure_session, scratch_path
from ..sources import feeds
from ..sources.binding import bound_sql
from ..sources.messages import decode_messages, peek, read_messages, to_messages, write_messages
from ..sources.newest import latest_events_pruned
from ..sources.offsets import offset_report, with_offsets
from ..sources.rejects import rejected, with_reasons
from ..sources.tables import export_table, history, publish, read_table, save_as_table, table_exists
from ..spec import BRONZE_TECHNICAL, EVENT_COLUMNS, FEED_SCHEMA, SALES_SEQ
from ..streaming.ingest import EVENT_DAY, ingest_available
from ..streaming.latest_stream import latest_table, run_latest
from ..streaming.progress import read_progress
from ..streaming.refine_stream import refine_incremental, silver_view
from . import gold, gold_delta
from .medallion import build_gold, quality, refine, refine_frame, run_medallion
from .sizing import partitions_for, path_bytes
from .staging import enrich, register_views, stg_bronze, stg_silver

SPEC = SALES_SEQ
MERGE_SPLIT = "1998-06-01"      # split point of the two-batch merge queries
LATE_SPLIT = "1998-11-20"       # and of the third, small batch
TOPIC_PARTITIONS = 8
MERGE_PART_BYTES = 8 << 20      # order lines (compressed) a key-hash partition of the pruned merge
DISTINCT_TASK_BYTES = 4 << 20   # and a task of the distinct counts, which holds its keys in memory
DAMAGE_CUT, DAMAGE_BLANK, DAMAGE_TEXT = 11, 13, 17     # seq moduli of payloads damaged on the way


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _feed_a(spark, sf):
    return feeds.change_feed_a(ensure_session(spark), sf)


def _feed_b(spark, sf):
    return feeds.change_feed_b(ensure_session(spark), sf)


def _parts_a(spark, sf, target_bytes: int) -> int:
    """Tasks for all of feed A, each with the events of so many bytes of order lines."""
    size = path_bytes(spark, f"{sf.rstrip('/')}/lineitem.parquet")
    return partitions_for(size, target_bytes, spark.sparkContext.defaultParallelism)


def _silver(feed: DataFrame) -> DataFrame:
    return current_rows(latest_per_key(clean(feed, SPEC), SPEC), SPEC)


def _stg_a(spark, sf):
    return stg_silver(_silver(_feed_a(spark, sf)))


# ---- feed, messages, capture ------------------------------------------------------

def q_change_feed(spark, sf):
    """Feed A: every order line as a sales change event (with injected dirt)."""
    return _feed_a(spark, sf)


def q_feed_json_roundtrip(spark, sf):
    """Feed A encoded as keyed JSON messages and decoded back (permissive parse)."""
    return decode_messages(to_messages(_feed_a(spark, sf)), FEED_SCHEMA).drop("kafka_timestamp")


def q_feed_peek(spark, sf):
    """Bounded read of the landed topic (``kafka`` with start / end offsets in production),
    decoded, first 10 events in feed order."""
    msgs = read_messages(spark, "parquet", path=_land_messages(spark, sf))
    return peek(msgs, 10, order_by=[F.col("seq")]).drop("kafka_timestamp")


def _land_messages(spark, sf) -> str:
    """Feed B as message files in a fresh 'topic' directory, one file per partition."""
    src = scratch_path(spark, "topic")
    write_messages(to_messages(_feed_b(spark, sf)), src)
    return src


def q_bronze_ingest(spark, sf):
    """Feed B messages landed as files, captured by the streaming Bronze job (availableNow)."""
    src = _land_messages(spark, sf)
    bronze, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt")
    ingest_available(spark, bronze, ckpt, "parquet", src, schema=FEED_SCHEMA)
    return spark.read.parquet(bronze).drop(*BRONZE_TECHNICAL)


def q_bronze_restart(spark, sf):
    """Capture, restart on the same checkpoint with a new file, restart again with none:
    every message lands exactly once."""
    feed = _feed_b(spark, sf)
    src = scratch_path(spark, "topic")
    bronze, ckpt = scratch_path(spark, "bronze"), scratch_path(spark, "ckpt")
    early = feed.filter(F.col("timestamp") < F.lit("2024-01-16"))
    late = feed.filter(~(F.col("timestamp") < F.lit("2024-01-16")) | F.col("timestamp").isNull())
    write_messages(to_messages(early), f"{src}/part=0")
    ingest_available(spark, bronze, ckpt, "parquet", f"{src}/*", schema=FEED_SCHEMA)
    write_messages(to_messages(late), f"{src}/part=1")
    ingest_available(spark, bronze, ckpt, "parquet", f"{src}/*", schema=FEED_SCHEMA)
    ingest_available(spark, bronze, ckpt, "parquet", f"{src}/*", schema=FEED_SCHEMA)
    return spark.read.parquet(bronze).drop(*BRONZE_TECHNICAL)


def _damaged(messages: DataFrame) -> DataFrame:
    """Messages some of whose payloads were cut off, lost or hold a text where a number belongs."""
    value = F.col("value").cast("string")
    seq = F.get_json_object(value, "$.seq").cast("bigint")
    payload = (F.when(seq % DAMAGE_CUT == 0, F.expr("left(cast(value as string), length(cast(value as string)) - 1)"))
                .when(seq % DAMAGE_BLANK == 0, F.lit(" "))
                .when(seq % DAMAGE_TEXT == 0, F.regexp_replace(value, '"cantidad":([0-9]+)', '"cantidad":"$1 units"'))
                .otherwise(value))
    return messages.withColumn("value", payload.cast("binary"))


def q_rejected_events(spark, sf):
    """The reject table of feed A's messages, a part of them damaged: key and reasons of each
    message that cleaning would drop without a trace."""
    bad = rejected(with_reasons(_damaged(to_messages(_feed_a(spark, sf))), SPEC))
    return bad.select("key", F.concat_ws(",", "reasons").alias("reasons"))


def q_ingest_progress(spark, sf):
    """Feed B landed and captured in three parts of its days; the capture's batch-progress table."""
    root = scratch_path(spark, "lake")
    feed, at = _feed_b(spark, sf), F.col("timestamp")
    parts = [feed.where(at < "2024-01-11"), feed.where((at >= "2024-01-11") & (at < "2024-01-21")), feed.where((at >= "2024-01-21") | at.isNull())]
    for i, part in enumerate(parts):
        write_messages(to_messages(part), f"{root}/topic/part={i}")
        ingest_available(spark, f"{root}/bronze", f"{root}/ckpt", "parquet", f"{root}/topic/*", schema=FEED_SCHEMA,
                         progress_path=f"{root}/progress")
    return read_progress(spark, f"{root}/progress")


# ---- refine ------------------------------------------------------------------------

def q_clean_events(spark, sf):
    """Feed A without events missing a required field, non-positive, or with an unknown op."""
    return clean(_feed_a(spark, sf), SPEC)


def q_dedup_latest(spark, sf):
    """Latest valid event per key of feed A (time desc, seq desc)."""
    return latest_per_key(clean(_feed_a(spark, sf), SPEC), SPEC)


def q_dedup_stream(spark, sf):
    """Latest valid event per key of feed A from a state store: the stream runs over the early
    events, stops, and goes on from its checkpoint with the late ones."""
    first, second = _split(_feed_a(spark, sf))
    root = scratch_path(spark, "stream")
    for part in (second, first):        # late events first: arrival order doesn't matter
        part.write.mode("append").parquet(f"{root}/events")
        run_latest(spark, f"{root}/events", f"{root}/changes", f"{root}/ckpt", SPEC)
    return latest_table(spark, f"{root}/changes", SPEC)


def q_silver_initial(spark, sf):
    """First-load Silver of feed A: latest events that are not deletes."""
    return _silver(_feed_a(spark, sf))


def _split(feed: DataFrame):
    """Events before the split time, and all others (those without a time among them)."""
    early = F.col("timestamp") < F.lit(MERGE_SPLIT)
    return feed.filter(early), feed.filter(~early | F.col("timestamp").isNull())


def q_silver_merge(spark, sf):
    """Silver (bucketed by key) from the early events, then the late ones merged in as
    version 1 — the refine job run on two time-ordered batches."""
    first, second = _split(_feed_a(spark, sf))
    path = scratch_path(spark, "silver")
    refine_frame(first, path, SPEC)
    refine_frame(second, path, SPEC)
    return read_table(spark, path)


def _time_batches(feed: DataFrame) -> list[DataFrame]:
    """Feed A in three batches by event time, the last a small one; events without a time come last."""
    at = F.col("timestamp")
    return [feed.filter(at < MERGE_SPLIT), feed.filter((at >= MERGE_SPLIT) & (at < LATE_SPLIT)), feed.filter((at >= LATE_SPLIT) | at.isNull())]


def q_silver_merge_pruned(spark, sf):
    """Silver in key-hash partitions, three batches merged into it one by one; each reads and
    replaces only the partitions of its keys."""
    root, parts = scratch_path(spark, "lake"), _parts_a(spark, sf, MERGE_PART_BYTES)
    for i, batch in enumerate(_time_batches(_feed_a(spark, sf))):
        partition_merge.merge_batch(batch, root, i, SPEC, parts)
    return partition_merge.current(spark, root, SPEC)


def q_gold_delta(spark, sf):
    """Daily KPIs after three merged batches, each brought into Gold by its change log."""
    root, parts = scratch_path(spark, "lake"), _parts_a(spark, sf, MERGE_PART_BYTES)
    for i, batch in enumerate(_time_batches(_feed_a(spark, sf))):
        if partition_merge.merge_batch(batch, root, i, SPEC, parts):
            gold_delta.apply_batch(spark, root, i, parts)
    return gold_delta.read_gold(spark, root, "gold_kpi_ventas").orderBy("fecha")


def _numbered_b(spark, sf) -> DataFrame:
    feed = _feed_b(spark, sf)
    return with_offsets(feed.withColumn("topic", F.lit("sales")), "tx_id", [F.col("timestamp").asc(), F.col("seq").asc()], TOPIC_PARTITIONS)


def q_feed_partitioned(spark, sf):
    """Feed B dealt to topic partitions by key, with dense offsets in event order."""
    return _numbered_b(spark, sf).select("topic", "partition", "offset", "tx_id", "seq")


def q_offset_gaps(spark, sf):
    """A topic that lost some of feed B's messages and delivered others twice, read from offset 10
    on in partition 0: its runs of offsets, what is missing before each, and what came again."""
    sent = _numbered_b(spark, sf).select("topic", "partition", "offset", "seq")
    kept = sent.where(F.col("seq") % 11 != 0)
    again = kept.where(F.col("seq") % 7 == 0)
    start = spark.sql("select 'sales' as topic, 0 as partition, 10L as start_offset")
    return offset_report(kept.unionByName(again), start)


def q_silver_incremental(spark, sf):
    """Bronze landed in two batches of files; the incremental refine (a file stream over
    Bronze merging each micro-batch into the latest-event state) runs after each."""
    first, second = _split(_feed_a(spark, sf))
    root = scratch_path(spark, "lake")
    bronze, state, ckpt = f"{root}/bronze", f"{root}/state", f"{root}/checkpoints/refine"
    first.write.parquet(bronze)
    refine_incremental(spark, bronze, state, ckpt, SPEC)
    second.write.mode("append").parquet(bronze)
    refine_incremental(spark, bronze, state, ckpt, SPEC)
    return silver_view(spark, state, SPEC)


def q_merge_action_counts(spark, sf):
    """Keys per merge outcome when the late half of feed A is merged into the early Silver."""
    first, second = _split(_feed_a(spark, sf))
    return merge_action_counts(_silver(first), second, SPEC).withColumnRenamed("rows", "key_count")


def q_missing_table_noop(spark, sf):
    """Existence probe around the refine job: with no Bronze yet the run is a no-op and no
    Silver appears; once feed A has landed as Bronze the same call creates Silver."""
    root = scratch_path(spark, "lake")
    bronze, silver = f"{root}/bronze", f"{root}/silver"
    rows = []
    for case in ("bronze_missing", "bronze_landed"):
        if case == "bronze_landed":
            _feed_a(spark, sf).write.parquet(bronze)
        res = refine(spark, bronze, silver, SPEC)
        rows.append((case, res.status, table_exists(spark, silver)))
    return spark.createDataFrame(rows, "case string, status string, silver_exists boolean")


def q_table_history(spark, sf):
    """Commit history of Silver after a first load and one merge."""
    first, second = _split(_feed_a(spark, sf))
    bronze = scratch_path(spark, "bronze")
    silver = scratch_path(spark, "silver")
    publish(first, bronze, "WRITE")
    refine(spark, bronze, silver, SPEC)
    publish(first.unionByName(second), bronze, "WRITE")   # Bronze grows; refine rescans all of it
    refine(spark, bronze, silver, SPEC)
    return history(spark, silver)


# ---- staging and Gold --------------------------------------------------------------

def q_stg_bronze(spark, sf):
    """Untyped staging projection of Bronze (feed A)."""
    return stg_bronze(_feed_a(spark, sf))


def q_stg_silver(spark, sf):
    """Typed staging projection of Silver (feed A)."""
    return _ntz(_stg_a(spark, sf), "venta_timestamp")


def q_enriched_sales(spark, sf):
    """Typed Silver plus day, hour and line amount."""
    return _ntz(enrich(_stg_a(spark, sf)), "venta_timestamp", "hora")


def q_gold_daily(spark, sf):
    """Daily KPIs of Silver (feed A), sorted by day."""
    return gold.daily(_stg_a(spark, sf), key_unique=True)


def q_gold_daily_distinct(spark, sf):
    """Daily KPIs of all clean events of feed A (keys repeat): two real distinct counts."""
    return gold.daily(stg_silver(clean(_feed_a(spark, sf), SPEC)), key_unique=False, tasks=_parts_a(spark, sf, DISTINCT_TASK_BYTES))


def q_distinct_rollup(spark, sf):
    """Distinct customers of feed B's valid events per hour, day and month: hours are bitmaps,
    days and months unions of them."""
    events = clean(_feed_b(spark, sf), SPEC).select("cliente_id", F.to_timestamp("timestamp").alias("at"))
    path = scratch_path(spark, "bitmaps")
    numbers = bitmaps.number_values(events, "cliente_id")
    bitmaps.period_bitmaps(events, F.date_trunc("hour", F.col("at")), "cliente_id", numbers).write.parquet(path)
    hours = spark.read.parquet(path)
    days = bitmaps.roll_up(hours, F.date_trunc("day", F.col("period")))
    levels = {"hour": hours, "day": days, "month": bitmaps.roll_up(days, F.date_trunc("month", F.col("period")))}
    out = [bitmaps.distinct_counts(b, "clientes_unicos").withColumn("level", F.lit(k)) for k, b in levels.items()]
    return _ntz(out[0].unionByName(out[1]).unionByName(out[2]), "period")


BOUND_SALES = """select :bound_by as bound_by, producto, cast(sum(cantidad) as bigint) as unidades_vendidas
from identifier(:sales) where cantidad >= :least group by producto"""


def q_bound_relation(spark, sf):
    """One SQL text over Silver bound as a storage path, a temporary view and a catalog table."""
    path, token = scratch_path(spark, "bound"), scratch_path(spark, "t").rsplit("-", 1)[1]
    _silver(_feed_a(spark, sf)).write.parquet(path)
    view, table = f"bound_view_{token}", f"bound_table_{token}"
    spark.read.parquet(path).createOrReplaceTempView(view)
    save_as_table(spark.read.parquet(path), table, path=f"{scratch_path(spark, 'warehouse')}/{table}")
    ways = {"path": path, "view": view, "table": table}
    out = [bound_sql(spark, BOUND_SALES, {"sales": rel}, {"bound_by": how, "least": 10}) for how, rel in ways.items()]
    return out[0].union(out[1]).union(out[2])


def q_gold_incremental(spark, sf):
    """Daily Gold built from the path of a latest-event state (deletes included): the commit
    tells what the table holds, so deleted keys stay out."""
    root = scratch_path(spark, "lake")
    _feed_a(spark, sf).write.parquet(f"{root}/captured")
    refine_incremental(spark, f"{root}/captured", f"{root}/state", f"{root}/progress", SPEC)
    return read_table(spark, build_gold(spark, f"{root}/state", f"{root}/gold", spec=SPEC)["gold_kpi_ventas"])


def q_staging_views(spark, sf):
    """The typed staging view of Silver, published over a table path and read by SQL."""
    path = scratch_path(spark, "current")
    refine_frame(_feed_a(spark, sf), path, SPEC)
    register_views(spark, silver=path)
    return _ntz(spark.sql("select * from stg_silver_ventas"), "venta_timestamp")


def q_gold_hourly(spark, sf):
    """Hourly KPIs of Silver (feed B), sorted by hour."""
    return _ntz(gold.hourly(stg_silver(_silver(_feed_b(spark, sf))), key_unique=True), "hora")


def q_gold_product(spark, sf):
    """Per-product KPIs of Silver (feed A), by revenue."""
    return gold.by_product(_stg_a(spark, sf), key_unique=True)


def q_gold_catalog_read(spark, sf):
    """Daily KPIs saved as a catalog table and read back by name."""
    name = "gold_kpi_ventas_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    save_as_table(gold.daily(_stg_a(spark, sf), ordered=False, key_unique=True), name, path=scratch_path(spark, "warehouse"))
    return spark.table(name).orderBy("fecha")


def q_gold_export(spark, sf):
    """Product KPIs published as a Gold table, exported to another location, read back."""
    warehouse = scratch_path(spark, "warehouse")
    src = f"{warehouse}/gold_kpi_producto"
    publish(gold.by_product(_stg_a(spark, sf), ordered=False, key_unique=True), src, "CREATE OR REPLACE TABLE AS SELECT")
    return export_table(spark, src, f"{scratch_path(spark, 'export')}/gold/gold_kpi_producto")


def q_product_ranking(spark, sf):
    """Product KPIs with their position by revenue."""
    return gold.product_ranking(gold.by_product(_stg_a(spark, sf), ordered=False, key_unique=True))


def q_headline_kpis(spark, sf):
    """Totals over the daily table, with the guarded average ticket."""
    return gold.headline(gold.daily(_stg_a(spark, sf), ordered=False, key_unique=True))


def q_units_by_product(spark, sf):
    """Units sold per product, straight from Silver."""
    return gold.units_by_product(_silver(_feed_a(spark, sf)))


def q_latest_events(spark, sf):
    """The 20 newest Bronze events of feed B."""
    return gold.latest_events(_feed_b(spark, sf), 20, tiebreak=("seq",))


def q_latest_events_pruned(spark, sf):
    """The 20 newest events of feed B from a Bronze that the capture partitions by day."""
    bronze = scratch_path(spark, "bronze")
    ingest_available(spark, bronze, scratch_path(spark, "ckpt"), "parquet", _land_messages(spark, sf), schema=FEED_SCHEMA, by_day=True)
    return latest_events_pruned(spark, bronze, EVENT_DAY, FEED_SCHEMA, 20, tiebreak=("seq",))


def q_silver_preview(spark, sf):
    """The first 20 Silver rows by key."""
    return gold.preview(_silver(_feed_a(spark, sf)), 20, order_by=("tx_id",))


def q_layer_counts(spark, sf):
    """Rows per layer, each an aggregate of its own (a count observed below a shuffle would
    count the rows of re-run tasks again)."""
    feed = _feed_a(spark, sf)
    silver = _silver(feed)
    layers = {"bronze": feed, "silver": silver, "gold_daily": gold.daily(stg_silver(silver), ordered=False, key_unique=True)}
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("layer"), "row_count") for n, df in layers.items()]
    return counts[0].union(counts[1]).union(counts[2])


def q_inspect_schema(spark, sf):
    """Silver schema with row and null counts per column."""
    return describe(_silver(_feed_a(spark, sf)))


# ---- quality -----------------------------------------------------------------------

def q_dq_not_null(spark, sf):
    """Null counts of every event field of the dirty Bronze (feed A)."""
    return dq.not_null_failures(_feed_a(spark, sf), EVENT_COLUMNS)


def q_dq_unique(spark, sf):
    """Keys occurring more than once in the dirty Bronze (feed A)."""
    return dq.unique_failures(_feed_a(spark, sf), "tx_id").select(F.lit("tx_id").alias("column_name"), "failures")


def q_dq_accepted_values(spark, sf):
    """Operation codes outside INSERT / UPDATE in the dirty Bronze (feed A)."""
    f = dq.accepted_values_failures(_feed_a(spark, sf), "tipo_operacion", ["INSERT", "UPDATE"])
    return f.select(F.lit("tipo_operacion").alias("column_name"), "failures")


def q_dq_results(spark, sf):
    """The 21 column tests over the five models, as the scheduled run tests them: on
    materialised Silver and Gold tables."""
    feed = _feed_a(spark, sf)
    root = scratch_path(spark, "lake")
    silver_path = f"{root}/current"
    refine_frame(feed, silver_path, SPEC)
    golds = {n: read_table(spark, p) for n, p in build_gold(spark, silver_path, f"{root}/gold").items()}
    return quality(spark, feed, read_table(spark, silver_path), golds)


def q_medallion_end_to_end(spark, sf):
    """Feed B messages → Bronze (streaming) → Silver → Gold → tests; returns hourly Gold."""
    src = _land_messages(spark, sf)
    root = scratch_path(spark, "lake")
    bronze, silver, gold_root = f"{root}/captured", f"{root}/current", f"{root}/gold"
    ingest_available(spark, bronze, f"{root}/progress", "parquet", src, schema=FEED_SCHEMA)
    out = run_medallion(spark, bronze, silver, gold_root, SPEC)
    return _ntz(read_table(spark, out["gold"]["gold_kpi_ventas_hora"]), "hora")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "change_feed": q_change_feed,
    "feed_json_roundtrip": q_feed_json_roundtrip,
    "feed_peek": q_feed_peek,
    "bronze_ingest": q_bronze_ingest,
    "bronze_restart": q_bronze_restart,
    "rejected_events": q_rejected_events,
    "ingest_progress": q_ingest_progress,
    "clean_events": q_clean_events,
    "dedup_latest": q_dedup_latest,
    "dedup_stream": q_dedup_stream,
    "silver_initial": q_silver_initial,
    "silver_merge": q_silver_merge,
    "silver_merge_pruned": q_silver_merge_pruned,
    "gold_delta": q_gold_delta,
    "feed_partitioned": q_feed_partitioned,
    "offset_gaps": q_offset_gaps,
    "silver_incremental": q_silver_incremental,
    "merge_action_counts": q_merge_action_counts,
    "missing_table_noop": q_missing_table_noop,
    "table_history": q_table_history,
    "stg_bronze": q_stg_bronze,
    "stg_silver": q_stg_silver,
    "enriched_sales": q_enriched_sales,
    "gold_daily": q_gold_daily,
    "gold_daily_distinct": q_gold_daily_distinct,
    "distinct_rollup": q_distinct_rollup,
    "bound_relation": q_bound_relation,
    "gold_incremental": q_gold_incremental,
    "staging_views": q_staging_views,
    "gold_hourly": q_gold_hourly,
    "gold_product": q_gold_product,
    "gold_catalog_read": q_gold_catalog_read,
    "gold_export": q_gold_export,
    "product_ranking": q_product_ranking,
    "headline_kpis": q_headline_kpis,
    "units_by_product": q_units_by_product,
    "latest_events": q_latest_events,
    "latest_events_pruned": q_latest_events_pruned,
    "silver_preview": q_silver_preview,
    "layer_counts": q_layer_counts,
    "inspect_schema": q_inspect_schema,
    "dq_not_null": q_dq_not_null,
    "dq_unique": q_dq_unique,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_results": q_dq_results,
    "medallion_end_to_end": q_medallion_end_to_end,
}
