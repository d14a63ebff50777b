from pyspark.sql import functions as F

from tidemark.spec import FEED_SCHEMA

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
COLS = FEED_SCHEMA.names


def ev(tx, op, ts, precio=10.0, cantidad=1, cliente="CLI-1", producto="P1", sku="SKU-1", seq=0):
    return (tx, cliente, producto, sku, precio, cantidad, op, ts, seq)


def frame(spark, rows):
    return spark.createDataFrame(rows, FEED_SCHEMA)


def as_set(df, cols=("tx_id", "tipo_operacion", "timestamp", "precio")):
    return {tuple(r) for r in df.select(*cols).collect()}


def day(d, h=0):
    return f"2024-01-{d:02d}T{h:02d}:00:00+00:00"


def sort_rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).orderBy(*sorted(df.columns)).collect())


def count(df, cond):
    return df.filter(F.expr(cond)).count()
