"""Gold KPI tables and the read-side reports built on them.

Amounts are summed as whole numbers at the price's scale and rounded half-up to cents
once, at the end; averages are exact half-up integer divisions.

Transactions are counted as ``count(distinct tx_id)``.  When the input is a Silver
table built by this engine (``key_unique=True``), every key appears exactly once and is
never null, so the distinct count equals ``count(tx_id)``: the time-grain tables then
keep a single distinct aggregate (customers), which Catalyst plans as two hash
aggregations keyed first by (grain, customer) — no 3x ``Expand`` of every row before
the shuffle — and the product table needs no distinct aggregation at all.  Either way a
hot day, hour or product is pre-aggregated per task before it is shuffled.

With two distinct counts a task's part of them is held in memory, in up to three rows an event.
``tasks`` deals the events to so many tasks first (apart from the join that made them, which
sorts in the same memory), so that this is bounded by the number given, whatever AQE merges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import cents_to_amount, exact_sum, half_up_ratio_amount, rounded_amount, rounded_ratio, to_cents, to_micros
from ..functions.ranking import with_position
from .staging import line_micros

# --- fixed values: Gold table columns (grain column first) ---
DAILY_COLUMNS = ["fecha", "cantidad_transacciones", "clientes_unicos", "unidades_vendidas", "ingresos_totales",
                 "ticket_promedio"]
HOURLY_COLUMNS = ["hora", "cantidad_transacciones", "clientes_unicos", "unidades_vendidas", "ingresos_totales",
                  "ticket_promedio"]
PRODUCT_COLUMNS = ["producto", "cantidad_transacciones", "unidades_vendidas", "ingresos_totales", "precio_promedio"]
# --- end of fixed values ---


def _tx_count(key_unique: bool) -> Column:
    return (F.count("tx_id") if key_unique else F.count_distinct("tx_id")).alias("cantidad_transacciones")


def _dealt(stg: DataFrame, tasks: int | None) -> DataFrame:
    """The columns that the time KPIs read, dealt by all of them: a hot key's events are spread."""
    used = stg.select("tx_id", "cliente_id", "precio", "cantidad", "venta_timestamp")
    return used.repartition(tasks, *used.columns) if tasks else stg


def _time_kpis(stg: DataFrame, grain: Column, name: str, ordered: bool, key_unique: bool, tasks: int | None = None) -> DataFrame:
    agg = (_dealt(stg, tasks).groupBy(grain.alias(name))
              .agg(_tx_count(key_unique),
                   F.count_distinct("cliente_id").alias("clientes_unicos"),
                   F.sum("cantidad").cast("bigint").alias("unidades_vendidas"),
                   exact_sum(line_micros()).alias("_micros")))
    out = agg.select(
        name, "cantidad_transacciones", "clientes_unicos", "unidades_vendidas",
        rounded_amount("_micros").alias("ingresos_totales"),
        rounded_ratio("_micros", "cantidad_transacciones").alias("ticket_promedio"),
    )
    return out.orderBy(name) if ordered else out


def daily(stg: DataFrame, ordered: bool = True, key_unique: bool = False, tasks: int | None = None) -> DataFrame:
    """KPIs per calendar day (UTC)."""
    return _time_kpis(stg, F.to_date("venta_timestamp"), "fecha", ordered, key_unique, tasks)


def hourly(stg: DataFrame, ordered: bool = True, key_unique: bool = False, tasks: int | None = None) -> DataFrame:
    """KPIs per hour (UTC)."""
    return _time_kpis(stg, F.date_trunc("hour", F.col("venta_timestamp")), "hora", ordered, key_unique, tasks)


def by_product(stg: DataFrame, ordered: bool = True, key_unique: bool = False) -> DataFrame:
    """KPIs per product; ``precio_promedio`` is the unweighted mean unit price."""
    agg = (stg.groupBy("producto")
              .agg(_tx_count(key_unique),
                   F.sum("cantidad").cast("bigint").alias("unidades_vendidas"),
                   exact_sum(line_micros()).alias("_micros"),
                   exact_sum(to_micros("precio")).alias("_price"),
                   F.count(F.lit(1)).alias("_rows")))
    out = agg.select(
        "producto", "cantidad_transacciones", "unidades_vendidas",
        rounded_amount("_micros").alias("ingresos_totales"),
        rounded_ratio("_price", "_rows").alias("precio_promedio"),
    )
    return out.orderBy(F.col("ingresos_totales").desc(), "producto") if ordered else out


def headline(gold_daily: DataFrame) -> DataFrame:
    """Totals over the daily table; ticket = revenue / transactions, 0 when none."""
    agg = gold_daily.agg(
        F.sum(to_cents("ingresos_totales")).cast("bigint").alias("_cents"),
        F.sum("unidades_vendidas").cast("bigint").alias("unidades_vendidas"),
        F.sum("cantidad_transacciones").cast("bigint").alias("cantidad_transacciones"),
    )
    cents = F.coalesce(F.col("_cents"), F.lit(0).cast("bigint"))
    n = F.coalesce(F.col("cantidad_transacciones"), F.lit(0).cast("bigint"))
    return agg.select(
        cents_to_amount(cents).alias("ingresos_totales"),
        F.coalesce(F.col("unidades_vendidas"), F.lit(0).cast("bigint")).alias("unidades_vendidas"),
        n.alias("cantidad_transacciones"),
        F.when(n != 0, half_up_ratio_amount(cents, n)).otherwise(F.lit(0.0)).alias("ticket_promedio"),
    )


def units_by_product(silver: DataFrame) -> DataFrame:
    """Units sold per product straight from Silver, most units first."""
    return (silver.groupBy("producto")
                  .agg(F.sum("cantidad").cast("bigint").alias("unidades_vendidas"))
                  .orderBy(F.col("unidades_vendidas").desc(), "producto"))


def latest_events(events: DataFrame, n: int = 20, tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Newest ``n`` events (distributed top-n: per-partition top-n, then one merge of n·P rows)."""
    order = [F.col("timestamp").desc()] + [F.col(c).desc() for c in tiebreak]
    return events.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 20, order_by: tuple[str, ...] = ()) -> DataFrame:
    """First ``n`` rows (ordered by the given columns when asked, for a stable preview)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def product_ranking(gold_product: DataFrame) -> DataFrame:
    """Product KPIs with their position by revenue (desc, then name; names are unique).

    Positions are computed distributed (range partitioning + per-partition offsets), so
    a large product catalogue never has to fit in one task.
    """
    return with_position(gold_product, [F.col("ingresos_totales").desc(), F.col("producto").asc()], "pos")
