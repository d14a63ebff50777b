"""Staging views over Bronze and Silver, and the enriched sales projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import micros_to_amount, to_micros
from ..functions.timefmt import parse_event_time
from ..spec import EVENT_COLUMNS


def stg_bronze(bronze: DataFrame) -> DataFrame:
    """Untyped pass-through of the eight event fields; technical columns dropped."""
    return bronze.select(*EVENT_COLUMNS)


def stg_silver(silver: DataFrame) -> DataFrame:
    """Typed view: measures recast, event time parsed (malformed → null, not an error)."""
    return silver.select(
        "tx_id", "cliente_id", "producto", "sku",
        F.col("precio").cast("double").alias("precio"),
        F.col("cantidad").cast("int").alias("cantidad"),
        "tipo_operacion",
        parse_event_time("timestamp").alias("venta_timestamp"),
    )


def line_micros(price: str = "precio", qty: str = "cantidad"):
    """Line amount in whole millionths: price times quantity, not rounded to cents."""
    return to_micros(price) * F.col(qty).cast("bigint")


def enrich(stg: DataFrame) -> DataFrame:
    """Typed sales plus day, hour and line amount."""
    return stg.withColumns({
        "fecha": F.to_date("venta_timestamp"),
        "hora": F.date_trunc("hour", F.col("venta_timestamp")),
        "monto_total": micros_to_amount(line_micros()),
    })


def register_views(spark, bronze=None, silver=None) -> list[str]:
    """Publish the staging projections as temporary views (``stg_bronze_ventas``,
    ``stg_silver_ventas``) so SQL can be written against them.  ``bronze`` / ``silver``
    are DataFrames, catalog names or paths."""
    from ..sources.tables import resolve_relation

    names = []
    if bronze is not None:
        stg_bronze(resolve_relation(spark, bronze)).createOrReplaceTempView("stg_bronze_ventas")
        names.append("stg_bronze_ventas")
    if silver is not None:
        stg_silver(resolve_relation(spark, silver)).createOrReplaceTempView("stg_silver_ventas")
        names.append("stg_silver_ventas")
    return names
