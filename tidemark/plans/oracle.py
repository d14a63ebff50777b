"""Independent SQL (DuckDB dialect) for every registered query that has a SQL form.

The statements re-derive each result from the raw tables with plain SQL, so they share
no code with the DataFrame implementation.  Queries whose result is a side effect with
volatile content (commit history) have no entry.
"""

from __future__ import annotations

FEED_A = """
select concat_ws('-', cast(l_orderkey as varchar), cast(l_linenumber as varchar)) as tx_id,
       'CLI-' || cast(o_custkey as varchar)                                       as cliente_id,
       p_name                                                                      as producto,
       'SKU-' || cast(l_partkey as varchar)                                        as sku,
       case when l_orderkey % 97 = 0 then null else p_retailprice end              as precio,
       case when l_orderkey % 89 = 0 then 0 else cast(l_quantity as int) end       as cantidad,
       case when l_orderkey % 83 = 0 then 'UPSERT'
            when l_returnflag = 'N' then 'INSERT'
            when l_returnflag = 'A' then 'UPDATE' else 'DELETE' end                as tipo_operacion,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') || '+00:00'                       as "timestamp",
       l_partkey * 100000 + l_suppkey                                              as seq
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
"""

FEED_B = """
select concat_ws('-', cast(user_id as varchar), cast(k % 10 as varchar)) as tx_id,
       'CLI-' || cast(user_id as varchar)                                as cliente_id,
       'P' || cast(k % 10 as varchar)                                    as producto,
       'SKU-' || cast(k % 10 as varchar)                                 as sku,
       value                                                             as precio,
       k                                                                 as cantidad,
       case event_type when 'purchase' then 'INSERT' when 'click' then 'UPDATE'
                       when 'error' then 'DELETE' else event_type end    as tipo_operacion,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'                  as "timestamp",
       event_id                                                          as seq
from (select *, cast(props->>'k' as int) as k from events) e
"""


def _refine(feed: str, p: str) -> str:
    """CTEs {p}_clean, {p}_dedup, {p}_silver, {p}_stg over the CTE named ``feed``."""
    return f"""
{p}_clean as (
  select * from {feed}
  where tx_id is not null and cliente_id is not null and producto is not null
    and precio is not null and cantidad is not null and "timestamp" is not null
    and precio > 0 and cantidad > 0 and tipo_operacion in ('INSERT', 'UPDATE', 'DELETE')),
{p}_dedup as (
  select * exclude (rn) from (
    select *, row_number() over (partition by tx_id order by "timestamp" desc, seq desc) as rn
    from {p}_clean) x where rn = 1),
{p}_silver as (
  select tx_id, cliente_id, producto, sku, precio, cantidad, tipo_operacion, "timestamp"
  from {p}_dedup where tipo_operacion <> 'DELETE'),
{p}_stg as (
  select tx_id, cliente_id, producto, sku, cast(precio as double) as precio, cast(cantidad as int) as cantidad,
         tipo_operacion, try_cast("timestamp" as timestamp) as venta_timestamp
  from {p}_silver)"""


WITH_A = f"with feed_a as ({FEED_A}),{_refine('feed_a', 'a')}"
WITH_B = f"with feed_b as ({FEED_B}),{_refine('feed_b', 'b')}"
WITH_AB = f"with feed_a as ({FEED_A}), feed_b as ({FEED_B}),{_refine('feed_a', 'a')},{_refine('feed_b', 'b')}"

REVENUE = "sum(cast(precio as decimal(18, 6)) * cantidad)"
MICROS = f"cast({REVENUE} * 1000000 as hugeint)"
PRICE_MICROS = "cast(sum(cast(precio as decimal(18, 6))) * 1000000 as hugeint)"


def _time_kpis(grain: str, name: str, stg: str) -> str:
    return f"""select {grain} as {name},
       count(distinct tx_id) as cantidad_transacciones,
       count(distinct cliente_id) as clientes_unicos,
       cast(sum(cantidad) as bigint) as unidades_vendidas,
       cast(round({REVENUE}, 2) as double) as ingresos_totales,
       cast((2 * {MICROS} + 10000 * count(distinct tx_id)) // (20000 * count(distinct tx_id)) as double) / 100 as ticket_promedio
from {stg} group by 1"""


def _product_kpis(stg: str) -> str:
    return f"""select producto,
       count(distinct tx_id) as cantidad_transacciones,
       cast(sum(cantidad) as bigint) as unidades_vendidas,
       cast(round({REVENUE}, 2) as double) as ingresos_totales,
       cast((2 * {PRICE_MICROS} + 10000 * count(*)) // (20000 * count(*)) as double) / 100 as precio_promedio
from {stg} group by 1"""


GOLD_DAILY_A = _time_kpis("cast(venta_timestamp as date)", "fecha", "a_stg")
GOLD_HOURLY_A = _time_kpis("date_trunc('hour', venta_timestamp)", "hora", "a_stg")
GOLD_HOURLY_B = _time_kpis("date_trunc('hour', venta_timestamp)", "hora", "b_stg")
GOLD_PRODUCT_A = _product_kpis("a_stg")

EVENT_COLS = ["tx_id", "cliente_id", "producto", "sku", "precio", "cantidad", "tipo_operacion", "timestamp"]

SPLIT = "'1998-06-01'"
# Two-batch merge fixture: Silver from the early events, latest late events as changes.
WITH_SPLIT = f"""with feed_a as ({FEED_A}),
early as (select * from feed_a where "timestamp" < {SPLIT}),
late as (select * from feed_a where "timestamp" >= {SPLIT}),{_refine('early', 'e')},{_refine('late', 'l')}"""


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


def _not_null_rows(cols: list[str], rel: str, extra: str = "") -> list[str]:
    return [f"""select {extra}'{c}' as column_name, count(*) filter (where "{c}" is null) as failures from {rel}"""
            for c in cols]


def _dq_results() -> str:
    nn = lambda model, col, rel, sev="error": (
        f"select '{model}' as model, '{col}' as column_name, 'not_null' as test, '{sev}' as severity, "
        f"count(*) filter (where \"{col}\" is null) as failures from {rel}")
    uq = lambda model, col, rel: (
        f"select '{model}' as model, '{col}' as column_name, 'unique' as test, 'error' as severity, count(*) as failures "
        f"from (select \"{col}\" from {rel} where \"{col}\" is not null group by 1 having count(*) > 1) d")
    parts = [nn("stg_silver_ventas", c, "a_stg") for c in ("tx_id", "cliente_id", "producto", "precio", "cantidad")]
    parts.append(uq("stg_silver_ventas", "tx_id", "a_stg"))
    parts.append("select 'stg_silver_ventas' as model, 'tipo_operacion' as column_name, 'accepted_values' as test, "
                 "'error' as severity, count(distinct tipo_operacion) as failures from a_stg "
                 "where tipo_operacion is not null and tipo_operacion not in ('INSERT', 'UPDATE')")
    parts += [nn("stg_bronze_ventas", c, "feed_a", "warn") for c in ("tx_id", "precio")]
    for model, key, rel, m2, m3 in (("gold_kpi_ventas", "fecha", "g_daily", "cantidad_transacciones", "ingresos_totales"),
                                    ("gold_kpi_producto", "producto", "g_product", "unidades_vendidas", "ingresos_totales"),
                                    ("gold_kpi_ventas_hora", "hora", "g_hourly", "cantidad_transacciones",
                                     "ingresos_totales")):
        parts += [nn(model, key, rel), uq(model, key, rel), nn(model, m2, rel), nn(model, m3, rel)]
    body = _union(parts)
    return f"""{WITH_A},
g_daily as ({GOLD_DAILY_A}), g_hourly as ({GOLD_HOURLY_A}), g_product as ({GOLD_PRODUCT_A}),
results as ({body})
select *, case when failures = 0 then 'pass' else severity end as status from results"""


def _inspect() -> str:
    types = ["string", "string", "string", "string", "double", "int", "string", "string"]
    parts = [f"""select {i + 1} as position, '{c}' as column_name, '{t}' as data_type, count(*) as row_count,
       count(*) filter (where "{c}" is null) as null_count from a_silver"""
             for i, (c, t) in enumerate(zip(EVENT_COLS, types))]
    return f"{WITH_A}\n{_union(parts)}"


MERGE_ACTION = """case when s.tx_id is null then 'keep'
            when t.tx_id is null and s.tipo_operacion <> 'DELETE' then 'insert'
            when t.tx_id is null then 'ignore'
            when s.tipo_operacion = 'DELETE' then 'delete'
            else 'update' end"""

NUMBERED_B = f"""with feed_b as ({FEED_B}),
slotted as (select *, 'sales' as topic, coalesce(('0x' || substr(md5(tx_id), 1, 8))::bigint % 8, 0)::int as "partition" from feed_b),
numbered as (select *, row_number() over (partition by "partition" order by "timestamp", seq) - 1 as "offset" from slotted)"""

EVENT_LIST = ", ".join(f'"{c}"' for c in EVENT_COLS)

ORACLE: dict[str, str] = {
    "change_feed": FEED_A,
    "feed_json_roundtrip": FEED_A,
    "feed_peek": f"with feed_b as ({FEED_B}) select * from feed_b order by seq limit 10",
    "bronze_ingest": FEED_B,
    "bronze_restart": FEED_B,
    "rejected_events": f"""with feed_a as ({FEED_A}), sent as (
      select *, case when seq % 11 = 0 then 'malformed' when seq % 13 = 0 then 'empty' end as lost,
             seq % 11 <> 0 and seq % 13 <> 0 and seq % 17 = 0 as as_text from feed_a),
    judged as (select tx_id as key, coalesce(lost, concat_ws(',',
        case when as_text then 'type:cantidad' end, case when precio is null then 'missing:precio' end,
        case when not as_text and cantidad <= 0 then 'range:cantidad' end, case when precio <= 0 then 'range:precio' end,
        case when tipo_operacion not in ('INSERT', 'UPDATE', 'DELETE') then 'operation' end)) as reasons from sent)
    select key, reasons from judged where reasons <> ''""",
    "ingest_progress": f"""with feed_b as ({FEED_B}), parts as (
      select case when "timestamp" < '2024-01-11' then 0 when "timestamp" < '2024-01-21' then 1 else 2 end as part, tx_id from feed_b)
    select row_number() over (order by part) - 1 as batch_id, count(*) as captured_rows,
           count(*) filter (where tx_id is null) as rows_without_key from parts group by part""",
    "clean_events": f"{WITH_A} select * from a_clean",
    "dedup_latest": f"{WITH_A} select * from a_dedup",
    "dedup_stream": f"{WITH_A} select * from a_dedup",
    "silver_initial": f"{WITH_A} select * from a_silver",
    "silver_merge": f"{WITH_A} select * from a_silver",
    "silver_merge_pruned": f"{WITH_A} select * from a_silver",
    "gold_delta": f"{WITH_A} {GOLD_DAILY_A}",
    "feed_partitioned": f"""{NUMBERED_B} select topic, "partition", "offset", tx_id, seq from numbered""",
    "offset_gaps": f"""{NUMBERED_B},
sent as (select "partition", "offset", case when seq % 7 = 0 then 2 else 1 end as deliveries from numbered
         where seq % 11 <> 0 and ("partition" <> 0 or "offset" >= 10)),
runs as (select *, "offset" - row_number() over (partition by "partition" order by "offset") as run from sent),
spans as (select "partition", min("offset") as first_offset, max("offset") as last_offset, sum(deliveries)::bigint - count(*) as repeated from runs group by "partition", run)
select 'sales' as topic, "partition", first_offset, last_offset, repeated,
       first_offset - coalesce(lag(last_offset) over (partition by "partition" order by first_offset) + 1, case when "partition" = 0 then 10 end, first_offset) as lost
from spans""",
    "silver_incremental": f"{WITH_A} select * from a_silver",
    "merge_action_counts": f"""{WITH_SPLIT}
select {MERGE_ACTION} as action, count(*) as key_count
from e_silver t full outer join l_dedup s on t.tx_id = s.tx_id group by 1""",
    "stg_bronze": f"with feed_a as ({FEED_A}) select {EVENT_LIST} from feed_a",
    "stg_silver": f"{WITH_A} select * from a_stg",
    "enriched_sales": f"""{WITH_A}
select *, cast(venta_timestamp as date) as fecha, date_trunc('hour', venta_timestamp) as hora,
       cast(cast(precio as decimal(18, 6)) * cantidad as double) as monto_total
from a_stg""",
    "gold_daily": f"{WITH_A} {GOLD_DAILY_A}",
    "gold_daily_distinct": f"""{WITH_A}, x as (select *, try_cast("timestamp" as timestamp) as venta_timestamp from a_clean)
{_time_kpis("cast(venta_timestamp as date)", "fecha", "x")}""",
    "distinct_rollup": f"{WITH_B} " + _union([
        f"select '{k}' as level, cast(date_trunc('{k}', try_cast(\"timestamp\" as timestamp)) as timestamp) as period, "
        f"count(distinct cliente_id) as clientes_unicos from b_clean group by 2" for k in ("hour", "day", "month")]),
    "bound_relation": f"{WITH_A} " + _union([
        f"select '{k}' as bound_by, producto, cast(sum(cantidad) as bigint) as unidades_vendidas from a_silver "
        f"where cantidad >= 10 group by producto" for k in ("path", "view", "table")]),
    "gold_incremental": f"{WITH_A} {GOLD_DAILY_A}",
    "staging_views": f"{WITH_A} select * from a_stg",
    "missing_table_noop": """select 'bronze_missing' as "case", 'no_bronze' as status, false as silver_exists
union all select 'bronze_landed', 'created', true""",
    "gold_hourly": f"{WITH_B} {GOLD_HOURLY_B}",
    "gold_product": f"{WITH_A} {GOLD_PRODUCT_A}",
    "gold_catalog_read": f"{WITH_A} {GOLD_DAILY_A}",
    "gold_export": f"{WITH_A} {GOLD_PRODUCT_A}",
    "product_ranking": f"""{WITH_A}, g as ({GOLD_PRODUCT_A})
select *, row_number() over (order by ingresos_totales desc, producto) as pos from g""",
    "headline_kpis": f"""{WITH_A}, g as ({GOLD_DAILY_A}),
t as (select coalesce(cast(sum(cast(round(ingresos_totales * 100) as bigint)) as bigint), 0) as c,
             coalesce(cast(sum(unidades_vendidas) as bigint), 0) as u,
             coalesce(cast(sum(cantidad_transacciones) as bigint), 0) as n from g)
select cast(c as double) / 100 as ingresos_totales, u as unidades_vendidas, n as cantidad_transacciones,
       case when n <> 0 then cast((2 * c + n) // (2 * n) as double) / 100 else 0.0 end as ticket_promedio
from t""",
    "units_by_product": f"{WITH_A} select producto, cast(sum(cantidad) as bigint) as unidades_vendidas "
                        "from a_silver group by producto",
    "latest_events": f"""with feed_b as ({FEED_B}) select * from feed_b order by "timestamp" desc, seq desc limit 20""",
    "latest_events_pruned": f"""with feed_b as ({FEED_B}) select * from feed_b order by "timestamp" desc, seq desc limit 20
""",
    "silver_preview": f"{WITH_A} select * from a_silver order by tx_id limit 20",
    "layer_counts": f"""{WITH_A}, g as ({GOLD_DAILY_A})
select 'bronze' as layer, count(*) as row_count from feed_a
union all select 'silver' as layer, count(*) as row_count from a_silver
union all select 'gold_daily' as layer, count(*) as row_count from g""",
    "inspect_schema": _inspect(),
    "dq_not_null": f"with feed_a as ({FEED_A})\n" + _union(_not_null_rows(EVENT_COLS, "feed_a")),
    "dq_unique": f"""with feed_a as ({FEED_A})
select 'tx_id' as column_name, count(*) as failures
from (select tx_id from feed_a where tx_id is not null group by tx_id having count(*) > 1) d""",
    "dq_accepted_values": f"""with feed_a as ({FEED_A})
select 'tipo_operacion' as column_name, count(distinct tipo_operacion) as failures from feed_a
where tipo_operacion is not null and tipo_operacion not in ('INSERT', 'UPDATE')""",
    "dq_results": _dq_results(),
    "medallion_end_to_end": f"{WITH_B} {GOLD_HOURLY_B}",
}
