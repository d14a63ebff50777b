"""Table inspection: schema with row and null counts, in one aggregation pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def describe(df: DataFrame) -> DataFrame:
    """``(position, column_name, data_type, row_count, null_count)`` — one row per column."""
    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("_rows"),
                    *[F.count_if(F.col(f.name).isNull()).alias(f"_n{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString()).alias("data_type"),
                              F.col("_rows").cast("bigint").alias("row_count"),
                              F.col(f"_n{i}").cast("bigint").alias("null_count"))
                     for i, f in enumerate(fields)])
    return counts.select(F.inline(rows))


def inspect_table(spark, path: str, n: int = 20) -> dict:
    """Schema (with row / null counts), a sample of ``n`` rows and the version history of
    the table at ``path`` — all as DataFrames, nothing collected."""
    from ..sources.tables import current_version, history, read_table

    df = read_table(spark, path)
    out = {"schema": describe(df), "sample": df.limit(n)}
    if current_version(spark, path) is not None:
        out["history"] = history(spark, path)
    return out
