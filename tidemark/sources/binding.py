"""SQL text whose relations and values are bound as parameters.

``select ... from identifier(:sales) where cantidad >= :least`` runs unchanged over a table
path, a temporary view or a catalog table: relation names are bound through ``IDENTIFIER``,
values through parameter markers, so neither is ever pasted into the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def relation_name(relation: str) -> str:
    """The SQL name of a relation: a storage path becomes a Parquet path reference, a view or
    table name stays as it is."""
    if "/" in relation or ":" in relation:
        return "parquet.`" + relation.replace("`", "``") + "`"
    return relation


def bound_sql(spark: SparkSession, text: str, relations: dict[str, str], values: dict | None = None) -> DataFrame:
    """Run ``text`` with every ``identifier(:name)`` bound to a relation and every ``:value`` to a value."""
    values = values or {}
    if both := set(relations) & set(values):
        raise ValueError(f"bound as a relation and as a value: {sorted(both)}")
    return spark.sql(text, args={**values, **{k: relation_name(v) for k, v in relations.items()}})
