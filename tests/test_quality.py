"""Column tests: failure counts, severity, status and the gate."""

import pytest

from helpers import day, ev, frame

from tidemark.operators import quality as dq

from helpers import SF001


def test_counts_on_small_frame(spark):
    df = frame(spark, [ev("a", "INSERT", day(1)), ev("a", "UPSERT", day(1)), ev(None, "DELETE", day(1), precio=None),
                       ev("b", None, day(1)), ev("c", "DELETE", day(1))])
    nn = {r.column_name: r.failures for r in dq.not_null_failures(df, ["tx_id", "precio", "sku"]).collect()}
    assert nn == {"tx_id": 1, "precio": 1, "sku": 0}
    assert dq.unique_failures(df, "tx_id").first().failures == 1
    assert dq.accepted_values_failures(df, "tipo_operacion", ["INSERT", "UPDATE"]).first().failures == 2


def test_suite_status_and_gate(spark):
    df = frame(spark, [ev("a", "INSERT", day(1)), ev("a", "INSERT", day(2), precio=None)])
    checks = [dq.Check("m", "tx_id", "unique"), dq.Check("m", "precio", "not_null", severity=dq.WARN),
              dq.Check("m", "tipo_operacion", "accepted_values", values=("INSERT",))]
    res = {(r.column_name, r.test): (r.failures, r.status) for r in dq.run_suite({"m": df}, checks).collect()}
    assert res == {("tx_id", "unique"): (1, "error"), ("precio", "not_null"): (1, "warn"),
                   ("tipo_operacion", "accepted_values"): (0, "pass")}
    with pytest.raises(dq.QualityGateError):
        dq.gate(dq.run_suite({"m": df}, checks))
    ok = dq.run_suite({"m": df}, checks[1:])
    assert len(dq.gate(ok)) == 2                   # warn only: passes the gate


def test_reference_counts_on_dirty_bronze_sf001(spark):
    """Known failure counts of feed A Bronze at sf0.01."""
    import __spark_entry__ as e

    q = e.queries()
    nn = {r.column_name: r.failures for r in q["dq_not_null"](spark, SF001).collect()}
    assert nn["tx_id"] == 0 and nn["precio"] == 586
    assert q["dq_unique"](spark, SF001).first().failures == 11785
    assert q["dq_accepted_values"](spark, SF001).first().failures == 2


def test_medallion_suite_has_21_tests(spark):
    checks = dq.medallion_checks()
    assert len(checks) == 21
    assert sum(c.severity == dq.WARN for c in checks) == 2


def test_empty_suite(spark):
    df = frame(spark, [ev("a", "INSERT", day(1))])
    assert dq.run_suite({"m": df}, []).count() == 0


def test_precomputed_counts_replace_a_scan(spark):
    df = frame(spark, [ev("a", "INSERT", day(1), precio=None)])
    checks = [dq.Check("m", "precio", "not_null", severity=dq.WARN), dq.Check("m", "tx_id", "unique")]
    res = {(r.column_name, r.test): (r.failures, r.status)
           for r in dq.run_suite({"m": df}, checks, {("m", "precio", "not_null"): 7}).collect()}
    assert res == {("precio", "not_null"): (7, "warn"), ("tx_id", "unique"): (0, "pass")}


def test_one_pass_equals_the_tests_one_by_one(spark):
    """Nulls, repeats, zeros of either sign, instants and bytes, with and without a stored key."""
    rows = [("a", 0.0, 1, b"x", "p"), ("a", -0.0, None, b"x", "q"), ("b", None, 3, b"y", None), (None, 2.5, 3, None, "q"),
            (None, 2.5, 4, b"z", "r"), ("c", float("nan"), 5, b"w", "p"), ("c", float("nan"), 6, b"v", "p"), ("c", 7.0, 7, b"u", "s")]
    df = spark.createDataFrame(rows, "k string, d double, i int, b binary, s string").selectExpr("*", "timestamp_seconds(i) AS at", "array(i) AS many")
    names = df.columns
    checks = [dq.Check("m", c, t) for c in names for t in ("not_null", "unique")] + [dq.Check("m", "s", "accepted_values", values=("p",)), dq.Check("m", "i", "accepted_values", values=("3", "4"))]
    wanted = {(r.column_name, "not_null"): r.failures for r in dq.not_null_failures(df, names).collect()}
    wanted |= {(c, "unique"): dq.unique_failures(df, c).first().failures for c in names}
    wanted |= {("s", "accepted_values"): 3, ("i", "accepted_values"): 4}
    for stored in (None, {"m": "k"}, {"m": "i"}):
        for part, empty in ((df, False), (df.limit(0), True)):
            got = {(r.column_name, r.test): r.failures for r in dq.run_suite({"m": part}, checks, stored_by=stored).collect()}
            assert got == (dict.fromkeys(wanted, 0) if empty else wanted)


def test_each_model_is_read_once_and_stored_keys_stay(spark, tmp_lake):
    rows = [ev(f"k{i % 40}", "INSERT" if i % 9 else "DELETE", day(1 + i % 20)) for i in range(200)]
    spark.sql("CREATE DATABASE IF NOT EXISTS dq_once")
    frame(spark, rows).write.mode("overwrite").bucketBy(4, "tx_id").sortBy("tx_id").option("path", f"{tmp_lake}/dq_once").saveAsTable("dq_once.m")
    try:
        checks = [dq.Check("m", c, "not_null") for c in ("tx_id", "precio")] + [dq.Check("m", "tx_id", "unique"), dq.Check("m", "tipo_operacion", "accepted_values", values=("INSERT",))]
        res = dq.run_suite({"m": spark.table("dq_once.m")}, checks, stored_by={"m": "tx_id"})
        plan = res._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1
        assert "hashpartitioning(_k" not in plan and plan.count("hashpartitioning(_t") == 1
        assert {(r.column_name, r.test): r.failures for r in res.collect()} == {("tx_id", "not_null"): 0, ("precio", "not_null"): 0, ("tx_id", "unique"): 40, ("tipo_operacion", "accepted_values"): 1}
    finally:
        spark.sql("DROP TABLE dq_once.m")
        spark.sql("DROP DATABASE dq_once")
