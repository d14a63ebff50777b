"""Merge into a table partitioned by a key hash: a batch reads and writes only its keys' partitions.

The table holds the latest event of every key, deletes included (tombstones), as plain Parquet
under ``_parts=<n>/_part=<i>`` with ``_part`` Spark's own hash partition of the key.  One batch:

1. clean, latest per key; written once, bucketed by the key (the touched partitions are then known:
   at most n);
2. full outer join of these with the same partitions of the table, newest wins; the result
   replaces the touched partitions by Spark's dynamic partition overwrite.  A row that the
   batch changed keeps its former image and the batch's number until it is written again;
3. the change log of the batch, from these images: the live rows it takes away (sign -1) and
   puts in (+1).

Nothing else is read or written; the first batch goes from step 1 straight into the table.  As
tombstones stay, a touched partition is never empty, so the overwrite always replaces it.
Replays are safe: step 2 gives the same table and images again, and a change log that was written
whole is kept.  Batches are to be merged in the order of their numbers.

Both sides of the join are dealt by the key into as many tasks as there are partitions, so a task
holds whole partitions and writes them as they are: the table's rows are shuffled once.  A
partition is one task, so ``parts`` is to be chosen for the table's size (see
``sizing.partitions_for``); it is fixed when the table is made.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import scratch_path, shuffle_width
from ..sources.tables import path_exists, publish, read_table
from ..spec import SALES, ChangeSpec
from .refine import clean, current_from_state, latest_per_key, state_columns

PART, PARTS = "_part", "_parts"
#: The row that a table's row replaced, and the batch that did it (null once a later batch has written the partition).
OLD, BATCH = "_old", "_batch"


def part_of(key: Column | str, parts: int | Column) -> Column:
    """The task that Spark's hash partitioning by ``key`` into ``parts`` gives a row to."""
    return F.pmod(F.hash(key), parts if isinstance(parts, Column) else F.lit(parts)).cast("int")


def stored_parts(spark: SparkSession, path: str, key: StructField) -> int | None:
    """Number of key-hash partitions of the table at ``path``, None if there is no table."""
    if not path_exists(spark, path):
        return None
    schema = StructType([key, StructField(PARTS, IntegerType()), StructField(PART, IntegerType())])
    row = read_parts(spark, path, None, schema).select(PARTS, PART, part_of(key.name, F.col(PARTS))).limit(1).first()
    if row is not None and row[1] != row[2]:
        raise ValueError(f"{path} was dealt by another hash of {key.name}")
    return None if row is None else int(row[0])


def touched(changes: DataFrame) -> list[int]:
    """The partitions that ``changes`` has rows of: at most as many as the table has."""
    return sorted(r[0] for r in changes.select(PART).distinct().collect())


def read_parts(spark: SparkSession, path: str, which: list[int] | None = None, schema: StructType | None = None) -> DataFrame:
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return df if which is None else df.where(F.col(PART).isin(which))


def replace_parts(df: DataFrame, path: str, parts: int) -> None:
    """Replace the partitions that ``df`` has rows of; all others stay as they are.  Rows of one
    partition are to lie in one task, for one file a partition."""
    (df.withColumn(PARTS, F.lit(parts)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(PARTS, PART).parquet(path))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _dealt_by_part(spark: SparkSession):
    """Let a join on (partition, key) use inputs that are dealt by the key alone."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    old = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def merge_images(state: DataFrame, latest: DataFrame, spec: ChangeSpec = SALES, width: int | None = None, dealt: bool = False) -> DataFrame:
    """Per key of either side ``_part``, its stored event ``old`` and the one to store, ``new``
    (structs; ``old`` is null for a new key; they are equal if nothing changes), and what the state
    has of ``_old`` and ``_batch``.  ``dealt``: ``latest`` lies in buckets by key already."""
    cols, kept = state_columns(spec), [c for c in (OLD, BATCH) if c in state.columns]
    width = width or int(latest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = state.select(F.col(PART).alias("_t"), *[F.col(c).alias(f"_t_{c}") for c in cols], *kept).repartition(width, f"_t_{spec.key}")
    s = latest.select(F.col(PART).alias("_s"), *[F.col(c).alias(f"_s_{c}") for c in cols])
    s = s if dealt else s.repartition(width, f"_s_{spec.key}")
    side = lambda mark, names: F.struct(*[F.col(f"_{mark}_{c}").alias(c) for c in names])
    both = t.join(s, (F.col("_t") == F.col("_s")) & (F.col(f"_t_{spec.key}") == F.col(f"_s_{spec.key}")), "full_outer")
    newer = F.col("_s").isNotNull() & (F.col("_t").isNull() | (side("s", spec.order_by) > side("t", spec.order_by)))
    return both.select(F.coalesce("_t", "_s").alias(PART), F.when(F.col("_t").isNotNull(), side("t", cols)).alias("old"),
                       F.when(newer, side("s", cols)).otherwise(side("t", cols)).alias("new"), *kept)


def change_log(images: DataFrame, spec: ChangeSpec = SALES) -> DataFrame:
    """Signed row images: live rows taken away (-1) and put in (+1)."""
    changed = images.where(~F.col("old").eqNullSafe(F.col("new")))
    both = F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")))
    rows = changed.select(F.explode(both).alias("c")).select("c.sign", "c.row.*").where(F.col(spec.key).isNotNull())
    return rows.where(~spec.is_delete())


def merge_batch(batch: DataFrame, root: str, batch_id: int, spec: ChangeSpec = SALES, parts: int | None = None) -> list[int]:
    """Merge one batch of events into ``root/state`` and write its ``root/changes/batch=<id>``.
    Returns the partitions that were replaced (none if the batch has no valid event)."""
    spark = batch.sparkSession
    path, log = f"{root.rstrip('/')}/state", f"{root.rstrip('/')}/changes/batch={batch_id}"
    stored = stored_parts(spark, path, batch.schema[spec.key])
    n = stored or parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols, mark = state_columns(spec), F.lit(batch_id).cast("bigint")
    latest = latest_per_key(clean(batch, spec), spec).select(*cols).withColumn(PART, part_of(spec.key, n))
    kept = StructType([*latest.select(*cols).schema, StructField(OLD, latest.select(*cols).schema), StructField(BATCH, LongType()), StructField(PARTS, IntegerType()), StructField(PART, IntegerType())])
    with shuffle_width(spark, n):
        if stored:
            aside = scratch_path(spark, "latest")
            publish(latest, aside, "WRITE", bucket_by=(n, spec.key))
            latest = read_table(spark, aside)
            which = touched(latest)
            if not which:
                return []
            with _dealt_by_part(spark):
                images = merge_images(read_parts(spark, path, which, kept), latest, spec, n, dealt=True)
                changed, again = ~F.col("old").eqNullSafe(F.col("new")), F.col(BATCH) == mark
                replace_parts(images.select("new.*", F.when(changed, F.col("old")).when(again, F.col(OLD)).alias(OLD), F.when(changed | again, mark).alias(BATCH), PART), path, n)
        else:
            replace_parts(latest.select(*cols, F.lit(None).cast(kept[OLD].dataType).alias(OLD), mark.alias(BATCH), PART), path, n)
            which = touched(read_parts(spark, path, None, kept))
            if not which:
                return []
    if not path_exists(spark, f"{log}/_SUCCESS"):
        done = read_parts(spark, path, which, kept).where(F.col(BATCH) == mark)
        change_log(done.select(PART, F.col(OLD).alias("old"), F.struct(*cols).alias("new")), spec).write.mode("overwrite").parquet(log)
    return which


def current(spark: SparkSession, root: str, spec: ChangeSpec = SALES) -> DataFrame:
    """The live rows of the table."""
    return current_from_state(spark.read.parquet(f"{root.rstrip('/')}/state"), spec)
