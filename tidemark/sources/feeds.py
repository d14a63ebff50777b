"""Change feeds derived from the warehouse tables (re-aimed event builder).

Each feed row is one sales change event plus ``seq``, a deterministic tie-breaker.
Feed A turns every order line into an event (day-grain times, repeated keys, injected
dirt); feed B turns every raw ``events`` row into one (microsecond times, natural dirt).
Everything is a declarative projection over joins, so Catalyst prunes columns into
the scans and AQE picks the join strategy from runtime sizes (a dimension side that
is small enough becomes a broadcast; otherwise the join stays a shuffle join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefmt import iso_utc

# --- fixed values: dirt injected into feed A (key moduli) and the op-code mappings ---
A_NULL_PRICE_MOD = 97       # l_orderkey % 97 = 0  -> precio null
A_ZERO_QTY_MOD = 89         # l_orderkey % 89 = 0  -> cantidad 0
A_BAD_OP_MOD = 83           # l_orderkey % 83 = 0  -> tipo_operacion 'UPSERT'
A_BAD_OP = "UPSERT"
A_OPS_BY_RETURNFLAG = {"N": "INSERT", "A": "UPDATE"}   # any other flag -> DELETE
B_OPS_BY_EVENT_TYPE = {"purchase": "INSERT", "click": "UPDATE", "error": "DELETE"}  # others kept as is
B_BUCKETS = 10              # k % 10 picks product / sku / key suffix
SEQ_PART_FACTOR = 100000    # seq = l_partkey * 100000 + l_suppkey
# Columns (and their stored types) the feeds read from the warehouse tables.
SCAN_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
# --- end of fixed values ---



def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a warehouse table with the declared schema of the columns the feeds use
    (no footer sampling on the driver; a type drift in the files fails the read)."""
    reader = spark.read.schema(SCAN_SCHEMAS[name]) if name in SCAN_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_fact(spark: SparkSession, sf_dir: str, name: str, columns: list[str], spread: int | None = None) -> DataFrame:
    """Scan the driving (fact) table of a feed.

    A table stored as a few unsplittable row groups runs the whole feed derivation in as few
    tasks; ``spread`` (default: the session's ``spark.tidemark.feed.spread``, unset = the scan as it
    is) deals its rows to that many partitions first.  It is never chosen by table size.
    """
    df = read_table(spark, sf_dir, name).select(*columns)
    n = spread or spark.conf.get("spark.tidemark.feed.spread", None)
    return df.repartition(int(n)) if n else df


def change_feed_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as change events: key ``orderkey-linenumber``, op from the return flag."""
    li = read_fact(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"])
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
           .join(part, li.l_partkey == part.p_partkey))
    k = F.col("l_orderkey")
    op = F.when((k % A_BAD_OP_MOD) == 0, F.lit(A_BAD_OP))
    for flag, code in A_OPS_BY_RETURNFLAG.items():
        op = op.when(F.col("l_returnflag") == flag, F.lit(code))
    op = op.otherwise(F.lit("DELETE"))
    return j.select(
        F.concat_ws("-", k.cast("string"), F.col("l_linenumber").cast("string")).alias("tx_id"),
        F.concat(F.lit("CLI-"), F.col("o_custkey").cast("string")).alias("cliente_id"),
        F.col("p_name").alias("producto"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("sku"),
        F.when((k % A_NULL_PRICE_MOD) == 0, F.lit(None).cast("double"))
         .otherwise(F.col("p_retailprice")).alias("precio"),
        F.when((k % A_ZERO_QTY_MOD) == 0, F.lit(0))
         .otherwise(F.col("l_quantity").cast("int")).alias("cantidad"),
        op.alias("tipo_operacion"),
        iso_utc("l_shipdate").alias("timestamp"),
        (F.col("l_partkey") * SEQ_PART_FACTOR + F.col("l_suppkey")).alias("seq"),
    )


def change_feed_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as change events: key ``user-bucket``, op from the event type."""
    ev = read_fact(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    k = F.from_json(F.col("props"), "k int").getField("k")
    e = ev.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))
    bucket = (F.col("k") % B_BUCKETS).cast("string")
    et = F.col("event_type")
    op: Column | None = None
    for etype, code in B_OPS_BY_EVENT_TYPE.items():
        op = (F.when(et == etype, F.lit(code)) if op is None else op.when(et == etype, F.lit(code)))
    op = op.otherwise(et)
    return e.select(
        F.concat_ws("-", F.col("user_id").cast("string"), bucket).alias("tx_id"),
        F.concat(F.lit("CLI-"), F.col("user_id").cast("string")).alias("cliente_id"),
        F.concat(F.lit("P"), bucket).alias("producto"),
        F.concat(F.lit("SKU-"), bucket).alias("sku"),
        F.col("value").alias("precio"),
        F.col("k").alias("cantidad"),
        op.alias("tipo_operacion"),
        iso_utc("ts", micros=True).alias("timestamp"),
        F.col("event_id").alias("seq"),
    )
