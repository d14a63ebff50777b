"""Declarative data-quality tests as DataFrame aggregates.

Failure counts follow the usual column-test definitions:

* ``not_null(col)`` — rows where the column is null.
* ``unique(col)`` — distinct non-null values that occur more than once (a partial +
  final count per value, so a hot value is pre-aggregated before the shuffle).
* ``accepted_values(col, values)`` — distinct non-null values outside the list.

A suite reads each model once: every row is turned into the (test, value) pairs that its tests
have to count (a null, a value that isn't accepted, a value that has to be unique), the pairs are
counted, and one row of failures follows.  A ``unique`` test of the column that a model is stored
by counts its pairs bucket by bucket, so that no key is shuffled.

A suite result has one row per test ``(model, column_name, test, severity, failures,
status)`` with status ``pass`` / ``warn`` / ``error``; ``gate`` raises when an
error-severity test fails.  Nothing is collected except the one-row-per-test result.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ERROR, WARN = "error", "warn"
RESULT_SCHEMA = "model string, column_name string, test string, severity string, failures bigint, status string"


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                      # not_null | unique | accepted_values
    severity: str = ERROR
    values: tuple[str, ...] = field(default=())


def not_null_failures(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column_name, failures)`` for every column, from one aggregation pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").cast("bigint").alias("failures"))
                     for i, c in enumerate(columns)])
    return counts.select(F.inline(rows))


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """One row ``failures``: non-null values occurring more than once."""
    dup = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return dup.agg(F.count_if(F.col("_n") > 1).cast("bigint").alias("failures"))


def accepted_values_failures(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """One row ``failures``: distinct non-null values not in ``values``."""
    bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return bad.agg(F.count_distinct(column).cast("bigint").alias("failures"))


def _lit(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _pair_value(column: str, kind: T.DataType) -> str | None:
    """The column as text that is equal exactly where its values group together; None for types
    that have no such text here."""
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, T.TimestampType):
        return f"CAST(unix_micros({column}) AS STRING)"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return f"CAST({column} + 0.0 AS STRING)"             # -0.0 and 0.0 are one value
    if isinstance(kind, T.BinaryType):
        return f"hex({column})"
    return f"CAST({column} AS STRING)" if isinstance(kind, T.AtomicType) else None


def _unique_sql(view: str, model: str, c: Check) -> str:
    """A ``unique`` test on its own, for values that aren't plain."""
    col = _ident(c.column)
    return (f"SELECT {_lit(model)} AS model, {_lit(c.column)} AS column_name, 'unique' AS test, {_lit(c.severity)} AS severity, "
            f"count(*) AS failures FROM (SELECT {col} FROM {view} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)")


def _suite_sql(view: str, schema: T.StructType, model: str, checks: list[Check], stored_by: str | None = None) -> list[str]:
    """SQL branches ``(model, column_name, test, severity, failures)`` for one model: one that
    counts the (test, value) pairs of all its tests, and one for each test that has no such pairs."""
    kinds = {f.name.lower(): f.dataType for f in schema}
    parts, pairs, failures, rows = [], [], [], []
    for c in checks:
        col, i, none = _ident(c.column), len(rows), "CAST(NULL AS STRING)"
        if c.test == "not_null":
            when, value, count = f"{col} IS NULL", none, f"coalesce(sum(if(_t = {i}, _n, 0)), 0)"
        elif c.test == "accepted_values":
            values = ", ".join(_lit(v) for v in c.values)
            # Any text does, as the values are told apart by it alone: plain columns only.
            when, value, count = f"{col} IS NOT NULL AND {col} NOT IN ({values})", _pair_value(col, kinds[c.column.lower()]), f"count_if(_t = {i})"
        elif c.test == "unique" and c.column == stored_by:
            when, value, count = f"{col} IS NOT NULL", none, f"coalesce(sum(if(_t = {i}, _keys, 0)), 0)"
        elif c.test == "unique":
            when, value, count = f"{col} IS NOT NULL", _pair_value(col, kinds[c.column.lower()]), f"count_if(_t = {i} AND _n > 1)"
            if value is None:
                parts.append(_unique_sql(view, model, c))
                continue
        else:
            raise ValueError(f"unknown test {c.test!r}")
        if value is None:
            raise ValueError(f"{c.test} of {model}.{c.column}: not a plain column")
        pairs.append(f"if({when}, {i}, NULL), {value}")
        failures.append(f"{count} AS f{i}")
        rows.append(f"{_lit(c.column)}, {_lit(c.test)}, {_lit(c.severity)}, f{i}")
    if rows:
        key = f"{_ident(stored_by)} AS _k, " if stored_by else ""
        found = f"SELECT {key}stack({len(pairs)}, {', '.join(pairs)}) AS (_t, _v) FROM {view}"
        if stored_by:
            by_key = f"SELECT _k, _t, _v, count(*) AS _n FROM ({found}) WHERE _t IS NOT NULL GROUP BY _k, _t, _v"
            counted = f"SELECT _t, _v, sum(_n) AS _n, count_if(_n > 1) AS _keys FROM ({by_key}) GROUP BY _t, _v"
        else:
            counted = f"SELECT _t, _v, count(*) AS _n FROM ({found}) WHERE _t IS NOT NULL GROUP BY _t, _v"
        parts.append(f"SELECT {_lit(model)} AS model, column_name, test, severity, CAST(failures AS BIGINT) AS failures "
                     f"FROM (SELECT stack({len(rows)}, {', '.join(rows)}) AS (column_name, test, severity, failures) "
                     f"FROM (SELECT {', '.join(failures)} FROM ({counted})))")
    return parts


def run_suite(models: dict[str, DataFrame], checks: list[Check], precomputed: dict | None = None,
              stored_by: dict[str, str] | None = None) -> DataFrame:
    """Evaluate ``checks`` against ``models`` (name → DataFrame) into one result frame.

    The tests are composed into one SQL statement over temporary views of the models
    (one ``spark.sql`` call; Catalyst plans it exactly like the DataFrame form, without
    thousands of Python→JVM calls).  ``precomputed`` maps ``(model, column, test)`` to a
    failure count already measured by an earlier job over the same data (e.g. null
    counts observed while refining); those checks are reported from it instead of
    scanning the model again.  ``stored_by`` names the column that a model is bucketed by; its
    ``unique`` test is then counted in place (any other column gives the same result by a shuffle).
    """
    pre = precomputed or {}
    spark = next(iter(models.values())).sparkSession if models else None
    if spark is None:
        raise ValueError("no models to test")
    tag = uuid.uuid4().hex[:10]
    views, parts = [], []
    known = [c for c in checks if (c.model, c.column, c.test) in pre]
    if known:
        parts.append("SELECT * FROM VALUES " + ", ".join(
            f"({_lit(c.model)}, {_lit(c.column)}, {_lit(c.test)}, {_lit(c.severity)}, "
            f"CAST({int(pre[(c.model, c.column, c.test)])} AS BIGINT))" for c in known)
            + " AS t(model, column_name, test, severity, failures)")
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if (c.model, c.column, c.test) not in pre:
            by_model.setdefault(c.model, []).append(c)
    try:
        for i, (model, cs) in enumerate(by_model.items()):
            view = f"_dq_{tag}_{i}"
            models[model].createOrReplaceTempView(view)
            views.append(view)
            parts.extend(_suite_sql(view, models[model].schema, model, cs, (stored_by or {}).get(model)))
        if not parts:
            return spark.createDataFrame([], RESULT_SCHEMA)
        union = "\nUNION ALL\n".join(parts)
        return spark.sql(f"SELECT model, column_name, test, severity, failures, "
                         f"CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM ({union})")
    finally:
        for v in views:                  # the statement is analysed already; the views can go
            spark.catalog.dropTempView(v)


class QualityGateError(RuntimeError):
    pass


def collect_results(results: DataFrame) -> list[dict]:
    """The suite result — one row per test, so bounded by the number of tests — as dicts."""
    return [r.asDict() for r in results.collect()]


def gate(results: DataFrame) -> list[dict]:
    """Collect the (one row per test) results; raise if an error-severity test failed."""
    rows = collect_results(results)
    failed = [r for r in rows if r["status"] == ERROR]
    if failed:
        raise QualityGateError(f"{len(failed)} quality test(s) failed: " + ", ".join(
            f"{r['model']}.{r['column_name']}:{r['test']}={r['failures']}" for r in failed))
    return rows


# --- fixed values: the column tests declared on the five models ---
def medallion_checks() -> list[Check]:
    checks = [Check("stg_silver_ventas", c, "not_null") for c in ("tx_id", "cliente_id", "producto", "precio", "cantidad")]
    checks += [
        Check("stg_silver_ventas", "tx_id", "unique"),
        Check("stg_silver_ventas", "tipo_operacion", "accepted_values", values=("INSERT", "UPDATE")),
        Check("stg_bronze_ventas", "tx_id", "not_null", severity=WARN),
        Check("stg_bronze_ventas", "precio", "not_null", severity=WARN),
        Check("gold_kpi_ventas", "fecha", "not_null"),
        Check("gold_kpi_ventas", "fecha", "unique"),
        Check("gold_kpi_ventas", "cantidad_transacciones", "not_null"),
        Check("gold_kpi_ventas", "ingresos_totales", "not_null"),
        Check("gold_kpi_producto", "producto", "not_null"),
        Check("gold_kpi_producto", "producto", "unique"),
        Check("gold_kpi_producto", "unidades_vendidas", "not_null"),
        Check("gold_kpi_producto", "ingresos_totales", "not_null"),
        Check("gold_kpi_ventas_hora", "hora", "not_null"),
        Check("gold_kpi_ventas_hora", "hora", "unique"),
        Check("gold_kpi_ventas_hora", "cantidad_transacciones", "not_null"),
        Check("gold_kpi_ventas_hora", "ingresos_totales", "not_null"),
    ]
    return checks
# --- end of fixed values ---
