"""Gold kept up to date from a merge's change log, at the cost of what changed.

A change log holds signed row images, so every KPI but the customers is a signed sum.  For the
customers the time tables keep a count per (hour, customer): one is counted while its
count is above zero, and stops being counted when its last sale goes.

Per grain two tables, partitioned by a hash of the grain's key like Silver: the running sums and the
Gold rows made from them.  A batch reads, adds to and replaces only the partitions its changes
touch: the changed rows and the stored sums are dealt by the grain's key, added and written in
one shuffle.  Rows that have fallen to zero stay in the files, so that a touched partition is never
empty, and are left out on reading.  A partition of the sums knows the last batch it has
taken, so a replayed batch is added to those partitions only that have missed it; the Gold rows
of all touched partitions are then made from the sums, anew on a replay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import exact_sum, rounded_amount, rounded_ratio, to_micros
from ..functions.timefmt import parse_event_time
from ..operators.partition_merge import PART, part_of, read_parts, replace_parts, staged, stored_parts, touched
from ..session import shuffle_width
from .gold import DAILY_COLUMNS, HOURLY_COLUMNS, PRODUCT_COLUMNS
from .staging import line_micros

_WHOLE = "decimal(38,0)"
TIME_KEYS, TIME_SUMS = ["fecha", "hora", "cliente_id"], ["n", "units", "micros"]
PRODUCT_KEYS, PRODUCT_SUMS = ["producto"], ["n", "units", "micros", "prices"]


def _signed(log: DataFrame) -> DataFrame:
    at = parse_event_time("timestamp")
    return log.select(F.col("sign").cast("bigint").alias("n"), "cliente_id", "producto", F.to_date(at).alias("fecha"), F.date_trunc("hour", at).alias("hora"),
                      (F.col("sign") * F.col("cantidad")).cast("bigint").alias("units"), (F.col("sign") * line_micros()).alias("micros"), (F.col("sign") * to_micros("precio")).alias("prices"))


def _summed(rows: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """Sums per ``keys`` of changed rows (whole amounts) and stored ones (decimals, ``<sum>_stored``)."""
    made = []
    for s in sums:
        if s in ("n", "units"):
            made.append(F.sum(s).cast("bigint").alias(s))
        else:
            new, stored = exact_sum(s).cast(_WHOLE), F.sum(f"{s}_stored").cast(_WHOLE)
            made.append(F.coalesce(new + stored, new, stored).cast(_WHOLE).alias(s))
    return rows.groupBy(*keys).agg(*made)


def _add(spark: SparkSession, path: str, log: DataFrame, keys: list[str], sums: list[str], batch_id: int, parts: int) -> tuple[list[int], int]:
    """Add a change log to the running sums at ``path``; the partitions that it touches."""
    grain, rows = keys[0], _signed(log)
    stored = stored_parts(spark, path, rows.schema[grain])
    n = stored or parts
    rows = rows.withColumn(PART, part_of(grain, n))
    which = touched(rows)
    missing = which
    if stored and which:
        # One batch number per partition: at most n rows.
        taken = {r[0] for r in read_parts(spark, path, which).groupBy(PART).agg(F.max("batch").alias("batch")).where(F.col("batch") >= batch_id).collect()}
        missing = [p for p in which if p not in taken]
    if not missing:
        return which, n
    whole = [s for s in sums if s not in ("n", "units")]
    rows = rows.where(F.col(PART).isin(missing)).select(*keys, *sums, *[F.lit(None).cast(_WHOLE).alias(f"{s}_stored") for s in whole])
    if stored:
        had = read_parts(spark, path, missing)
        rows = rows.unionByName(had.select(*keys, "n", "units", *[F.lit(None).cast("bigint").alias(s) for s in whole], *[F.col(s).alias(f"{s}_stored") for s in whole]))
    if keys != [grain]:          # else the sum itself deals the rows by the grain
        rows = rows.repartition(n, grain)
    with shuffle_width(spark, n):
        replace_parts(_summed(rows, keys, sums).withColumns({PART: part_of(grain, n), "batch": F.lit(batch_id).cast("bigint")}), path, n)
    return which, n


def _hours(sums: DataFrame) -> DataFrame:
    """Sums per hour.  A row is one customer's, so an hour's customers are its rows above zero."""
    return sums.groupBy(PART, "fecha", "hora").agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, F.col("cliente_id"))).alias("clientes_unicos"),
                                                   F.sum("units").alias("units"), F.sum("micros").cast(_WHOLE).alias("micros"))


def _days(hours: DataFrame, sums: DataFrame) -> DataFrame:
    """Sums per day of its hours, with the customers of the whole day."""
    buyers = sums.where((F.col("n") > 0) & F.col("cliente_id").isNotNull()).select(PART, "fecha", "cliente_id").distinct().groupBy(PART, "fecha").agg(F.count(F.lit(1)).alias("clientes_unicos"))
    rows = hours.select(PART, "fecha", "n", F.lit(0).cast("bigint").alias("clientes_unicos"), "units", "micros")
    none = {c: F.lit(None).cast(hours.schema[c].dataType) for c in ("n", "units", "micros")}
    return rows.unionByName(buyers.withColumns(none)).groupBy(PART, "fecha").agg(*[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in ("n", "clientes_unicos", "units", "micros")])


def _time_rows(agg: DataFrame, columns: list[str]) -> DataFrame:
    made = agg.withColumns({"cantidad_transacciones": F.col("n"), "unidades_vendidas": F.col("units"), "ingresos_totales": rounded_amount("micros"),
                            "ticket_promedio": F.when(F.col("n") > 0, rounded_ratio("micros", F.greatest("n", F.lit(1))))})
    return made.select(PART, *columns)


def _product_rows(sums: DataFrame) -> DataFrame:
    made = sums.withColumns({"cantidad_transacciones": F.col("n"), "unidades_vendidas": F.col("units"), "ingresos_totales": rounded_amount("micros"),
                             "precio_promedio": F.when(F.col("n") > 0, rounded_ratio("prices", F.greatest("n", F.lit(1))))})
    return made.select(PART, *PRODUCT_COLUMNS)


def apply_batch(spark: SparkSession, root: str, batch_id: int, parts: int | None = None) -> None:
    """Bring the Gold tables under ``root/gold`` up to date with ``root/changes/batch=<id>``.

    Batches are to be applied in the order of their numbers."""
    root = root.rstrip("/")
    log = spark.read.parquet(f"{root}/changes/batch={batch_id}")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name, keys, sums in (("time", TIME_KEYS, TIME_SUMS), ("product", PRODUCT_KEYS, PRODUCT_SUMS)):
        path = f"{root}/sums/{name}"
        which, n = _add(spark, path, log, keys, sums, batch_id, parts)
        if not which:
            continue
        new = read_parts(spark, path, which)
        if name == "time":
            hours = staged(_hours(new), "hours")
            replace_parts(_time_rows(_days(hours, new), DAILY_COLUMNS).repartition(PART), f"{root}/gold/gold_kpi_ventas", n)
            # An hour lies in its day's partition.
            replace_parts(_time_rows(hours, HOURLY_COLUMNS).repartition(PART), f"{root}/gold/gold_kpi_ventas_hora", n)
        else:
            replace_parts(_product_rows(new).repartition(PART), f"{root}/gold/gold_kpi_producto", n)


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A Gold table as it stands, without grains that have no sales left."""
    columns = {"gold_kpi_ventas": DAILY_COLUMNS, "gold_kpi_ventas_hora": HOURLY_COLUMNS, "gold_kpi_producto": PRODUCT_COLUMNS}[name]
    return spark.read.parquet(f"{root.rstrip('/')}/gold/{name}").where("cantidad_transacciones > 0").select(*columns)
