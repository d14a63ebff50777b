"""Messages that cannot become valid events, with the reasons why.

The capture parses permissively, so a damaged payload turns into an all-null row that the
cleaning step drops without a trace.  Here the same messages are split: what cleaning would
keep, and a reject table of the raw payloads with an array of reasons.  A message is rejected
exactly if ``clean(decode_messages(...))`` drops it.  Both parts are projections of one parse;
nothing shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..spec import SALES_SEQ, ChangeSpec

BROKEN = "_broken"


def _one_if(cond: Column, reason: str) -> Column:
    return F.when(cond, F.lit(reason))


def with_reasons(messages: DataFrame, spec: ChangeSpec = SALES_SEQ) -> DataFrame:
    """``(key, value, data, reasons)`` per message; ``reasons`` is empty for a valid event.

    * ``empty``: no payload, or only white space; ``malformed``: not a JSON object;
    * ``type:<field>``: the field has a value that its type cannot hold;
    * ``missing:<field>``: a required field, or the operation, is absent or null;
    * ``range:<field>``: not above zero; ``operation``: an unknown operation code.

    Reasons come in that order, fields in the order of the schema.
    """
    value = F.col("value").cast("string")
    as_text = StructType([StructField(f.name, StringType()) for f in spec.schema] + [StructField(BROKEN, StringType())])
    payloads = messages.select(F.col("key").cast("string").alias("key"), value.alias("value"))
    # A generator of one row: filters on the reasons aren't pushed below it, where each of their
    # conditions would parse the payload anew.
    parsed = payloads.select("key", F.inline(F.array(F.struct(
        F.col("value"),
        F.from_json("value", spec.schema).alias("data"),
        # Any JSON value fits a string, so only what is no object at all ends in the broken column.
        F.from_json("value", as_text, {"columnNameOfCorruptRecord": BROKEN}).alias("_text"),
    ))))
    empty = F.coalesce(F.col("value").rlike(r"^\s*$"), F.lit(True))
    broken = ~empty & F.col(f"_text.{BROKEN}").isNotNull()
    whole = ~empty & ~broken
    needed = set(spec.required) | {spec.op_col}
    reasons = [_one_if(empty, "empty"), _one_if(broken, "malformed")]
    for f in spec.schema.names:
        reasons.append(_one_if(whole & F.col(f"_text.{f}").isNotNull() & F.col(f"data.{f}").isNull(), f"type:{f}"))
    for f in spec.schema.names:
        if f in needed:
            reasons.append(_one_if(whole & F.col(f"_text.{f}").isNull(), f"missing:{f}"))
    for f in spec.positive:
        reasons.append(_one_if(whole & ~(F.col(f"data.{f}") > 0), f"range:{f}"))
    reasons.append(_one_if(whole & ~F.col(f"data.{spec.op_col}").isin(*spec.operations), "operation"))
    # A wrong type in a field that cleaning does not look at is noted, but rejects nothing.
    noted = F.array_compact(F.array(*reasons))
    harmless = [f"type:{f}" for f in spec.schema.names if f not in needed and f not in spec.positive]
    fatal = F.array_except(noted, F.array(*[F.lit(h) for h in harmless])) if harmless else noted
    return parsed.select("key", "value", "data", F.when(F.size(fatal) > 0, noted).otherwise(F.array().cast("array<string>")).alias("reasons"))


def accepted(judged: DataFrame) -> DataFrame:
    """The valid events, as columns."""
    return judged.where(F.size("reasons") == 0).select("data.*")


def rejected(judged: DataFrame) -> DataFrame:
    """The reject table: ``(key, value, reasons)`` of every message that is no valid event."""
    return judged.where(F.size("reasons") > 0).select("key", "value", "reasons")
