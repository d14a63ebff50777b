"""Message encode / permissive decode, including malformed payloads."""

from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from helpers import day, ev, frame

from tidemark.sources.messages import decode_messages, to_messages
from tidemark.spec import EVENT_SCHEMA

RAW = StructType([StructField("value", BinaryType(), True)])


def decode(spark, payloads):
    df = spark.createDataFrame([(None if p is None else bytearray(p.encode()),) for p in payloads], RAW)
    return decode_messages(df, EVENT_SCHEMA).collect()


def test_roundtrip_preserves_rows_and_nulls(spark):
    rows = [ev("a", "INSERT", day(1), precio=1.5), ev("b", "DELETE", day(2), precio=None, sku=None)]
    df = frame(spark, rows)
    msgs = to_messages(df)
    assert [r.key.decode() for r in msgs.orderBy("key").collect()] == ["a", "b"]
    back = decode_messages(msgs).drop("kafka_timestamp")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_integer_price_and_numeric_key(spark):
    r = decode(spark, ['{"tx_id":5,"precio":1,"cantidad":2,"tipo_operacion":"INSERT","extra":1}'])[0]
    assert (r.tx_id, r.precio, r.cantidad, r.tipo_operacion) == ("5", 1.0, 2, "INSERT")
    assert "extra" not in r.asDict()


def test_malformed_payloads_give_all_null_fields(spark):
    for r in decode(spark, [None, "not json", '{"tx_id":"a","precio":', "[]"]):
        assert all(r[c] is None for c in EVENT_SCHEMA.names)


def test_wrongly_typed_field_is_null_alone(spark):
    rows = decode(spark, ['{"tx_id":"a","cantidad":2.0,"precio":3.0}', '{"tx_id":"b","cantidad":"3"}',
                          '{"tx_id":"c","precio":"9.5","cantidad":1}', '{"tx_id":"d","cantidad":99999999999}'])
    got = {r.tx_id: (r.precio, r.cantidad) for r in rows}
    assert got == {"a": (3.0, None), "b": (None, None), "c": (None, 1), "d": (None, None)}


def test_malformed_rows_are_removed_by_clean(spark):
    from tidemark.operators.refine import clean

    df = spark.createDataFrame([(bytearray(b"garbage"),)], RAW)
    assert clean(decode_messages(df, EVENT_SCHEMA)).count() == 0
    assert decode_messages(df, EVENT_SCHEMA).filter(F.col("tx_id").isNull()).count() == 1
