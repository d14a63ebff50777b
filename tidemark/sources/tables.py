"""Versioned table snapshots on any Hadoop file system, plus catalog helpers.

A table at ``path`` is a set of immutable parquet snapshots ``path/data/v<N>-<attempt>``
and a commit log ``path/_commits/<N>.json`` of one JSON row each ``(version, timestamp,
operation, operationMetrics, data)``.  A writer first writes the new snapshot with
Spark into a directory of its own attempt, then creates the commit file naming that
directory, so readers only ever see committed versions.  The commit file is created
without overwrite, so two racing writers cannot both publish one version, and since
every attempt writes its own directory, a retry after a failure (or a racing writer)
never touches files of a committed version; an uncommitted attempt is simply unused.  Writing a
new version never overwrites the path it was computed from, which is what lets a merge
read version N while producing N+1.

A snapshot can be written *bucketed* by a key (Spark's own hash bucketing, one sorted
file per bucket).  The commit then records the bucket spec and schema, and readers
register the snapshot as an external bucketed catalog table, so a later join or
aggregation on that key reads it already partitioned: the keyed merge then shuffles only
the incoming changes, never the whole current state.

Directories written by a streaming file sink (Bronze) are plain parquet tables; they
are read through the sink's own metadata log by ``spark.read.parquet``.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StringType, StructField, StructType, TimestampType

from ..spec import GOLD_TABLES

COMMIT_SCHEMA = StructType(
    [
        StructField("version", LongType(), False),
        StructField("timestamp", TimestampType(), True),
        StructField("operation", StringType(), True),
        StructField("operationMetrics", MapType(StringType(), StringType()), True),
    ]
)


def _commits(path: str) -> str:
    return f"{path.rstrip('/')}/_commits"


def _data(path: str, version: int, attempt: str | None = None) -> str:
    base = f"{path.rstrip('/')}/data/v{version:020d}"
    return f"{base}-{attempt}" if attempt else base


def _data_of(path: str, rec: dict) -> str:
    return f"{path.rstrip('/')}/data/{rec['data']}" if rec.get("data") else _data(path, int(rec["version"]))


def _fs(spark: SparkSession, path: str):
    """Hadoop file system and path object for ``path`` (works for any configured scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, from the names of the commit files."""
    fs, p = _fs(spark, _commits(path))
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isFile() and name.endswith(".json") and name[:-5].isdigit():
            out.append(int(name[:-5]))
    return sorted(out)


def _commit_file(path: str, version: int) -> str:
    return f"{_commits(path)}/{version:020d}.json"


def _write_commit(spark: SparkSession, path: str, record: dict) -> None:
    """Written aside first, then renamed without overwriting: a listed commit is complete, and
    of two writers of one version the second fails."""
    fs, p = _fs(spark, _commit_file(path, record["version"]))
    _, aside = _fs(spark, f"{_commits(path)}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray((json.dumps(record) + "\n").encode("utf-8")))
    finally:
        out.close()
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    none = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(fs.makeQualified(p).toUri(), sc._jsc.hadoopConfiguration()).rename(fs.makeQualified(aside), fs.makeQualified(p), none)
    except Exception:
        fs.delete(aside, False)
        raise


def history(spark: SparkSession, path: str) -> DataFrame:
    """Commit log, newest first (``DESCRIBE HISTORY`` projection)."""
    paths = [_commit_file(path, v) for v in versions(spark, path)]
    if not paths:
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return (spark.read.schema(COMMIT_SCHEMA).json(paths)
            .select("version", "timestamp", "operation", "operationMetrics")
            .orderBy(F.col("version").desc()))


def current_version(spark: SparkSession, path: str) -> int | None:
    """Newest committed version, or None when the path holds no snapshot table."""
    vs = versions(spark, path)
    return vs[-1] if vs else None


def _is_plain_parquet(spark: SparkSession, path: str) -> bool:
    """Whether there is a data file under ``path`` (of a batch write or a streaming sink; names
    that start with ``_`` or ``.`` are not data).  A capture without rows yet has none."""
    fs, p = _fs(spark, path)
    todo = [p] if fs.exists(p) else []
    while todo:
        for st in fs.listStatus(todo.pop()):
            if st.getPath().getName()[0] in "_.":
                continue
            if st.isFile():
                return True
            todo.append(st.getPath())
    return False


def table_exists(spark: SparkSession, path: str) -> bool:
    """True for a committed snapshot table or a readable parquet directory (sink output)."""
    return current_version(spark, path) is not None or _is_plain_parquet(spark, path)


SNAPSHOT_DB = "tidemark_snapshots"


def read_commit(spark: SparkSession, path: str, version: int) -> dict:
    """The commit record of one version."""
    fs, p = _fs(spark, _commit_file(path, version))
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def table_kind(spark: SparkSession, path: str) -> str | None:
    """What the newest commit says the table holds: ``current`` rows (one per key, none deleted),
    a latest-event ``state`` (one per key, deletes included), or None when it says nothing."""
    v = current_version(spark, path)
    return None if v is None else read_commit(spark, path, v).get("kind")


def bucketing(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, str] | None:
    """``(buckets, key)`` of a bucketed snapshot, else None."""
    v = current_version(spark, path) if version is None else version
    if v is None:
        return None
    b = read_commit(spark, path, v).get("bucketing")
    return (int(b["buckets"]), b["key"]) if b else None


def _snapshot_table(data_dir: str) -> str:
    digest = hashlib.sha1(data_dir.rstrip("/").encode("utf-8")).hexdigest()[:24]
    return f"{SNAPSHOT_DB}.s_{digest}"


def _register_bucketed(spark: SparkSession, path: str, rec: dict) -> str:
    from pyspark.sql.types import StructType

    data_dir = _data_of(path, rec)
    name = _snapshot_table(data_dir)
    schema = StructType.fromJson(json.loads(rec["schema"]))
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    key, n = rec["bucketing"]["key"], int(rec["bucketing"]["buckets"])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {SNAPSHOT_DB}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet CLUSTERED BY (`{key}`) "
              f"SORTED BY (`{key}`) INTO {n} BUCKETS LOCATION '{data_dir}'")
    return name


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Current (or a given) snapshot; plain parquet directories are read as they are."""
    v = current_version(spark, path) if version is None else version
    if v is None:
        return spark.read.parquet(path)
    rec = read_commit(spark, path, v)
    if rec.get("bucketing"):
        return spark.table(_register_bucketed(spark, path, rec))
    reader = spark.read
    if rec.get("schema"):                    # committed schema: no footer sampling, empty snapshots read fine
        from pyspark.sql.types import StructType

        reader = reader.schema(StructType.fromJson(json.loads(rec["schema"])))
    return reader.parquet(_data_of(path, rec))


def publish(df: DataFrame, path: str, operation: str, metrics: dict[str, object] | None = None,
            metrics_fn=None, bucket_by: tuple[int, str] | None = None, commit_if=None, kind: str | None = None) -> int | None:
    """Write ``df`` as the next version of the table at ``path`` and commit it.

    ``bucket_by=(n, key)`` writes the snapshot hash-bucketed and sorted by ``key``.  When
    ``df`` is already hash-partitioned by ``key`` into ``n`` partitions (the output of a
    keyed shuffle of that width), every task writes exactly one bucket file, without an
    extra shuffle.  ``metrics_fn`` is called after the data write (e.g. to read an
    ``Observation`` filled by that same write) and is merged into the commit metrics.
    ``commit_if`` (called after the write) can veto the commit: the written files are
    then removed and None is returned, so the table is unchanged.  ``kind`` is recorded in
    the commit (see ``table_kind``).
    """
    spark = df.sparkSession
    cur = current_version(spark, path)
    version = 0 if cur is None else cur + 1
    attempt = uuid.uuid4().hex[:12]
    data_dir = _data(path, version, attempt)
    record: dict = {"version": version, "operation": operation, "data": data_dir.rsplit("/", 1)[1],
                    "schema": df.schema.json()}
    if kind:
        record["kind"] = kind
    if bucket_by:
        n, key = bucket_by
        record["bucketing"] = {"buckets": int(n), "key": key}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {SNAPSHOT_DB}")
        (df.write.mode("errorifexists").format("parquet").bucketBy(int(n), key).sortBy(key)
           .option("path", data_dir).saveAsTable(_snapshot_table(data_dir)))
    else:
        df.write.mode("errorifexists").parquet(data_dir)
    if commit_if is not None and not commit_if():
        if bucket_by:
            spark.sql(f"DROP TABLE IF EXISTS {_snapshot_table(data_dir)}")
        fs, p = _fs(spark, data_dir)
        fs.delete(p, True)
        return None
    m = {k: str(v) for k, v in (metrics or {}).items()}
    if metrics_fn is not None:
        m.update({k: str(v) for k, v in metrics_fn().items()})
    record["timestamp"] = datetime.now(timezone.utc).replace(tzinfo=None).isoformat(timespec="microseconds")
    record["operationMetrics"] = m
    _write_commit(spark, path, record)
    return version


def vacuum(spark: SparkSession, path: str, retain_versions: int = 3) -> list[str]:
    """Delete the data of all but the newest ``retain_versions`` committed versions, and
    attempts that were never committed, of a snapshot table.  Returns the removed dirs.

    Commit files are kept, so the history still lists every version.  Directories of
    versions newer than the current one (a writer still at work) are never touched.
    Readers still scanning a removed version fail, as with any retention window.
    """
    if retain_versions < 1:
        raise ValueError("retain_versions must be at least 1")
    vs = versions(spark, path)
    if not vs:
        return []
    keep = {read_commit(spark, path, v).get("data") for v in vs[-retain_versions:]}
    newest = vs[-1]
    fs, root = _fs(spark, f"{path.rstrip('/')}/data")
    if not fs.exists(root):
        return []
    removed = []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith("v") and name[1:21].isdigit()):
            continue
        if int(name[1:21]) > newest or name in keep:
            continue
        data_dir = f"{path.rstrip('/')}/data/{name}"
        spark.sql(f"DROP TABLE IF EXISTS {_snapshot_table(data_dir)}")
        fs.delete(st.getPath(), True)
        removed.append(name)
    return sorted(removed)


def export_table(spark: SparkSession, source: str, dest: str) -> DataFrame:
    """Copy the current snapshot of a table to ``dest`` (any Hadoop URI), replacing it.

    A missing source raises, as the copy script fails on a missing table.
    """
    if not table_exists(spark, source):
        raise FileNotFoundError(f"no table at {source}")
    df = read_table(spark, source)
    df.write.mode("overwrite").parquet(dest)
    return spark.read.schema(df.schema).parquet(dest)


def export_gold(spark: SparkSession, gold_root: str, dest_root: str, which: str = "all") -> dict[str, str]:
    """Copy one named Gold table, or ``all``, to ``<dest_root>/gold/<table>`` (replacing it).

    An unknown name or a missing table raises before anything is copied.
    """
    names = GOLD_TABLES if which == "all" else (which,)
    unknown = [n for n in names if n not in GOLD_TABLES]
    if unknown:
        raise ValueError(f"unknown Gold table {unknown[0]!r}; expected one of {GOLD_TABLES + ('all',)}")
    missing = [n for n in names if not table_exists(spark, f"{gold_root.rstrip('/')}/{n}")]
    if missing:
        raise FileNotFoundError(f"no table {missing[0]!r} under {gold_root}; build Gold first")
    out = {}
    for n in names:
        dest = f"{dest_root.rstrip('/')}/gold/{n}"
        export_table(spark, f"{gold_root.rstrip('/')}/{n}", dest)
        out[n] = dest
    return out


def resolve_relation(spark: SparkSession, relation) -> DataFrame:
    """A relation given as a DataFrame, a catalog table name or a storage path."""
    if isinstance(relation, DataFrame):
        return relation
    rel = str(relation)
    if "/" in rel or ":" in rel:
        return read_table(spark, rel)
    if not spark.catalog.tableExists(rel):
        raise ValueError(f"no table or view named {rel!r}")
    return spark.table(rel)


def save_as_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Full-rebuild materialisation into the catalog (external when a path is given)."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)


class ResultTooLarge(ValueError):
    pass


def to_pandas_bounded(df: DataFrame, max_rows: int = 100_000):
    """Collect a report-sized result (a Gold table, a top-N) to pandas.  A result of more than
    ``max_rows`` raises after at most one row more has reached the driver; it runs once."""
    out = df.limit(max_rows + 1).toPandas()
    if len(out) > max_rows:
        raise ResultTooLarge(f"more than {max_rows} rows; aggregate or limit before collecting")
    return out
