"""Reject table: which messages, and why, against what cleaning drops."""

import json

from tidemark.operators.refine import clean
from tidemark.sources.messages import decode_messages
from tidemark.sources.rejects import accepted, rejected, with_reasons
from tidemark.spec import FEED_SCHEMA, SALES_SEQ

GOOD = {"tx_id": "a", "cliente_id": "c", "producto": "p", "sku": "s", "precio": 1.5, "cantidad": 2,
        "tipo_operacion": "INSERT", "timestamp": "2024-01-01T00:00:00+00:00", "seq": 1}
CASES = {
    "good": (json.dumps(GOOD), []),
    "unknown field": (json.dumps({**GOOD, "more": [1]}), []),
    "no sku": (json.dumps({k: v for k, v in GOOD.items() if k != "sku"}), []),
    "sku of another type": (json.dumps({**GOOD, "sku": {"x": 1}}), []),
    "seq of another type": (json.dumps({**GOOD, "seq": "one"}), []),
    "delete": (json.dumps({**GOOD, "tipo_operacion": "DELETE"}), []),
    "none": (None, ["empty"]),
    "blank": (" \n\t", ["empty"]),
    "cut": (json.dumps(GOOD)[:-1], ["malformed"]),
    "word": ("hello", ["malformed"]),
    "number": ("3", ["malformed"]),
    "text price": (json.dumps({**GOOD, "precio": "cheap"}), ["type:precio"]),
    "half a unit": (json.dumps({**GOOD, "cantidad": 1.5}), ["type:cantidad"]),
    "no key": (json.dumps({**GOOD, "tx_id": None}), ["missing:tx_id"]),
    "no operation": (json.dumps({k: v for k, v in GOOD.items() if k != "tipo_operacion"}), ["missing:tipo_operacion"]),
    "free": (json.dumps({**GOOD, "precio": 0, "cantidad": -1}), ["range:precio", "range:cantidad"]),
    "upsert": (json.dumps({**GOOD, "tipo_operacion": "UPSERT"}), ["operation"]),
    "many": (json.dumps({**GOOD, "precio": "x", "cantidad": 0, "cliente_id": None, "tipo_operacion": "?"}),
             ["type:precio", "missing:cliente_id", "range:cantidad", "operation"]),
    "empty object": ("{}", ["missing:tx_id", "missing:cliente_id", "missing:producto", "missing:precio", "missing:cantidad",
                            "missing:tipo_operacion", "missing:timestamp"]),
}


def _messages(spark):
    return spark.createDataFrame([(k.encode(), v.encode() if v is not None else None) for k, (v, _) in CASES.items()], "key binary, value binary")


def test_reasons_of_each_case(spark):
    got = {r.key: r.reasons for r in with_reasons(_messages(spark)).collect()}
    assert got == {k: reasons for k, (_, reasons) in CASES.items()}


def test_accepted_is_what_cleaning_keeps(spark):
    judged = with_reasons(_messages(spark))
    kept = clean(decode_messages(_messages(spark)), SALES_SEQ).select(*FEED_SCHEMA.names)
    assert sorted(map(str, accepted(judged).collect())) == sorted(map(str, kept.collect()))
    assert rejected(judged).count() + accepted(judged).count() == len(CASES)


def test_payload_is_parsed_once(spark):
    plan = rejected(with_reasons(_messages(spark)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2, plan


def test_no_messages(spark):
    none = _messages(spark).limit(0)
    assert rejected(with_reasons(none)).count() == 0
