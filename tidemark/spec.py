"""Change-feed description: which column is the key, how events are ordered, which
operation codes exist and which fields must be present and positive.

The engine is generic over any keyed change feed; ``SALES`` is the preset for the
retail sales feed (eight event fields) that the rest of the package defaults to.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values: the sales change event (field names, types, operation codes) ---
EVENT_SCHEMA = StructType(
    [
        StructField("tx_id", StringType(), True),
        StructField("cliente_id", StringType(), True),
        StructField("producto", StringType(), True),
        StructField("sku", StringType(), True),
        StructField("precio", DoubleType(), True),
        StructField("cantidad", IntegerType(), True),
        StructField("tipo_operacion", StringType(), True),
        StructField("timestamp", StringType(), True),
    ]
)
EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]
REQUIRED_COLUMNS = ["tx_id", "cliente_id", "producto", "precio", "cantidad", "timestamp"]
POSITIVE_COLUMNS = ["precio", "cantidad"]
OPERATIONS = ["INSERT", "UPDATE", "DELETE"]
DELETE_OPERATIONS = ["DELETE"]
# Technical columns added by the Bronze capture.
BRONZE_TECHNICAL = ["kafka_timestamp", "ingestion_timestamp"]
# Gold tables: daily, hourly and per-product KPIs.
GOLD_TABLES = ("gold_kpi_ventas", "gold_kpi_ventas_hora", "gold_kpi_producto")
# --- end of fixed values ---

# The derived test feeds carry a deterministic tie-breaker next to the event fields.
SEQ_FIELD = StructField("seq", LongType(), True)
FEED_SCHEMA = StructType(EVENT_SCHEMA.fields + [SEQ_FIELD])


@dataclass(frozen=True)
class ChangeSpec:
    """How to read a keyed change feed.

    ``order_by`` lists the columns that define "newest" (all descending); the first is
    the event time, later ones are tie-breakers.  ``columns`` are the business columns
    kept in the current-state table (tie-breakers and technical columns are dropped).
    """

    key: str = "tx_id"
    order_by: tuple[str, ...] = ("timestamp",)
    op_col: str = "tipo_operacion"
    operations: tuple[str, ...] = tuple(OPERATIONS)
    delete_ops: tuple[str, ...] = tuple(DELETE_OPERATIONS)
    required: tuple[str, ...] = tuple(REQUIRED_COLUMNS)
    positive: tuple[str, ...] = tuple(POSITIVE_COLUMNS)
    columns: tuple[str, ...] = tuple(EVENT_COLUMNS)
    schema: StructType = field(default=EVENT_SCHEMA, compare=False)

    def with_tiebreak(self, *cols: str) -> ChangeSpec:
        """Same spec with extra descending tie-breaker columns (e.g. ``seq``)."""
        extra = [f for f in FEED_SCHEMA.fields if f.name in cols and f.name not in self.schema.names]
        return replace(self, order_by=tuple(self.order_by) + tuple(cols), schema=StructType(self.schema.fields + extra))

    def is_delete(self) -> Column:
        return F.col(self.op_col).isin(*self.delete_ops)


SALES = ChangeSpec()
# Sales preset with the deterministic ``seq`` tie-breaker used by the derived feeds.
SALES_SEQ = SALES.with_tiebreak("seq")
