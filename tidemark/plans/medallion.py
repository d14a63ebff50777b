"""Job flow of the medallion: capture → refine → Gold → quality, in that order.

``refine`` is the Bronze → Silver batch job: it rescans all of Bronze (so a run is
idempotent and independent of arrival order), cleans, keeps the latest event per key
and either creates Silver (first load) or merges into it as a new version.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import collect_results, gate, medallion_checks, run_suite
from ..operators.refine import clean, current_from_state, current_rows, latest_per_key, merge_changes
from ..session import ensure_session, shuffle_width
from ..sources.tables import bucketing, publish, read_table, table_exists, table_kind, vacuum
from ..spec import GOLD_TABLES, SALES, ChangeSpec
from . import gold
from .sizing import merge_width, silver_buckets, tune_shuffle_partitions
from .staging import stg_bronze, stg_silver



@dataclass
class RefineResult:
    status: str                      # no_bronze | no_events | created | merged
    version: int | None = None
    metrics: dict = field(default_factory=dict)


def refine_frame(bronze: DataFrame, silver_path: str, spec: ChangeSpec = SALES,
                 buckets: int | None = None) -> RefineResult:
    """Apply a Bronze DataFrame to the Silver table at ``silver_path``.

    One job per run: clean → latest per key → (merge with current Silver) → write the new
    version.  The number of clean events is observed by that same job; when it is zero
    the new version is discarded and Silver stays as it was (or is not created).

    Silver is stored bucketed by the key (``buckets`` files, default: the session's
    shuffle width when Silver is created; 0 = unbucketed).  Later versions keep the bucket
    count of the current one unless ``buckets`` asks for more; then the table is re-bucketed
    by the same job.  The job runs with its shuffle width equal to the
    bucket count, so the dedup shuffle of the changes lines up with the stored buckets:
    the merge join reads Silver in place and every task writes one bucket.

    The number of clean events is observed below the shuffle and only compared with zero:
    a re-run task may count twice there, which doesn't change that answer.
    """
    spark = bronze.sparkSession
    seen = Observation("clean_events")
    cleaned = clean(bronze, spec).observe(seen, F.count(F.lit(1)).alias("clean_events"))
    has_events = lambda: seen.get["clean_events"] > 0
    if table_exists(spark, silver_path):
        spec_b = bucketing(spark, silver_path)
        n = merge_width(spec_b[0] if spec_b else None, buckets)
        with shuffle_width(spark, n):
            obs = Observation("merge")
            latest = latest_per_key(cleaned, spec)
            merged = merge_changes(read_table(spark, silver_path), latest, spec, source_is_latest=True, observation=obs)
            v = publish(merged, silver_path, "MERGE", metrics_fn=lambda: obs.get,
                        bucket_by=(n, spec.key) if n else None, commit_if=has_events, kind="current")
        return RefineResult("merged", v, dict(obs.get)) if v is not None else RefineResult("no_events")
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) if buckets is None else buckets
    with shuffle_width(spark, n or None):
        obs = Observation("write")
        rows = current_rows(latest_per_key(cleaned, spec), spec).observe(obs, F.count(F.lit(1)).alias("num_output_rows"))
        v = publish(rows, silver_path, "WRITE", metrics_fn=lambda: obs.get, bucket_by=(n, spec.key) if n else None,
                    commit_if=has_events, kind="current")
    return RefineResult("created", v, dict(obs.get)) if v is not None else RefineResult("no_events")


def refine(spark: SparkSession, bronze_path: str, silver_path: str, spec: ChangeSpec = SALES,
           buckets: int | None = None) -> RefineResult:
    """Bronze path → Silver path; a missing Bronze is a no-op."""
    ensure_session(spark)
    if not table_exists(spark, bronze_path):
        return RefineResult("no_bronze")
    if buckets is None:
        buckets = silver_buckets(spark, bronze_path)
    return refine_frame(read_table(spark, bronze_path), silver_path, spec, buckets)


def current_silver(spark: SparkSession, path: str, spec: ChangeSpec = SALES) -> tuple[DataFrame, bool]:
    """Silver rows of the table at ``path`` and whether its keys are known to be unique: a
    latest-event state is read without its deleted keys; only tables that a refine job
    committed are known to hold one row per key."""
    kind = table_kind(spark, path)
    rows = read_table(spark, path)
    return (current_from_state(rows, spec) if kind == "state" else rows), kind in ("current", "state")


def gold_frames(silver: DataFrame, key_unique: bool = False) -> dict[str, DataFrame]:
    """The three Gold tables of a Silver table; ``key_unique`` if it surely holds one row per key."""
    stg = stg_silver(silver)
    return {
        "gold_kpi_ventas": gold.daily(stg, ordered=False, key_unique=key_unique),
        "gold_kpi_ventas_hora": gold.hourly(stg, ordered=False, key_unique=key_unique),
        "gold_kpi_producto": gold.by_product(stg, ordered=False, key_unique=key_unique),
    }


def build_gold(spark: SparkSession, silver, gold_root: str, key_unique: bool = False, spec: ChangeSpec = SALES) -> dict[str, str]:
    """Rebuild the three Gold tables from current Silver (a path, whose commit tells what it
    holds, or a DataFrame; full rebuild, new versions).

    The three tables are independent, so their jobs are submitted together and share the
    cluster instead of running back to back; each one is a separate, retryable job.
    """
    ensure_session(spark)
    if isinstance(silver, str):
        silver, key_unique = current_silver(spark, silver, spec)
    paths = {name: f"{gold_root.rstrip('/')}/{name}" for name in GOLD_TABLES}
    frames = gold_frames(silver, key_unique)
    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        futures = [pool.submit(publish, df, paths[name], "CREATE OR REPLACE TABLE AS SELECT")
                   for name, df in frames.items()]
        for f in futures:
            f.result()
    return paths


BRONZE_MODEL = "stg_bronze_ventas"


def quality(spark: SparkSession, bronze: DataFrame, silver: DataFrame, golds: dict[str, DataFrame]) -> DataFrame:
    models = {"stg_silver_ventas": stg_silver(silver), BRONZE_MODEL: stg_bronze(bronze), **golds}
    return run_suite(models, medallion_checks(), stored_by={"stg_silver_ventas": SALES.key})


def run_medallion(spark: SparkSession, bronze_path: str, silver_path: str, gold_root: str,
                  spec: ChangeSpec = SALES, enforce: bool = True, incremental: bool = False,
                  checkpoint: str | None = None, retain_versions: int | None = None,
                  stream_options: dict[str, str] | None = None, buckets: int | None = None) -> dict:
    """Refine, then build Gold, then test every layer; stop at the first failing step.

    As in the scheduled run, the tests come after Gold is built; an error-severity
    failure raises (``enforce``), a warn-severity one is only reported.  With
    ``incremental`` the refine reads only Bronze files not processed yet (``checkpoint``
    tracks them) and ``silver_path`` holds the latest-event state; Silver is its view.
    Every run writes full new versions of Silver and Gold and keeps the old ones; only when
    asked for, data of all but the newest ``retain_versions`` versions is removed at the end.
    The session's shuffle width is first raised to fit the Bronze size, if needed.
    """
    ensure_session(spark)
    tune_shuffle_partitions(spark, [bronze_path])
    if incremental:
        from ..streaming.refine_stream import refine_incremental, silver_view

        status = refine_incremental(spark, bronze_path, silver_path,
                                    checkpoint or f"{silver_path.rstrip('/')}/_checkpoint", spec, buckets,
                                    options=stream_options)
        res = RefineResult(status)
        if not table_exists(spark, silver_path):
            return {"refine": res, "gold": {}, "quality": []}
        silver = silver_view(spark, silver_path, spec)
    else:
        res = refine(spark, bronze_path, silver_path, spec, buckets)
        if res.status in ("no_bronze", "no_events") and not table_exists(spark, silver_path):
            return {"refine": res, "gold": {}, "quality": []}
        silver = read_table(spark, silver_path)
    paths = build_gold(spark, silver, gold_root, key_unique=True)      # both come from a refine job
    golds = {n: read_table(spark, p) for n, p in paths.items()}
    results = quality(spark, read_table(spark, bronze_path), silver, golds)
    rows = gate(results) if enforce else collect_results(results)
    if retain_versions:
        for p in [silver_path, *paths.values()]:
            vacuum(spark, p, retain_versions)
    return {"refine": res, "gold": paths, "quality": rows}
