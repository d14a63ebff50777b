"""Command-line entry points for the jobs (``spark-submit -m``-style or ``python -m``).

    python -m tidemark.cli ingest  --bronze P --checkpoint P [--format kafka] [--option k=v ...] [--source P]
    python -m tidemark.cli refine  --bronze P --silver P [--buckets N]
    python -m tidemark.cli gold    --silver P --gold P
    python -m tidemark.cli test    --bronze P --silver P --gold P
    python -m tidemark.cli run     --bronze P --silver P --gold P          (refine → gold → test)
    python -m tidemark.cli inspect PATH [N]
    python -m tidemark.cli export  --gold P --dest P [TABLE|all]
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace

from pyspark.sql.types import StructType

from .session import build_session
from .spec import EVENT_SCHEMA, SALES


def _opts(pairs: list[str] | None) -> dict[str, str]:
    return dict(p.split("=", 1) for p in (pairs or []))


def main(argv: list[str] | None = None, spark=None) -> int:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--bronze", required=True)
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--format", default="kafka")
    a.add_argument("--source")
    a.add_argument("--option", action="append")
    a.add_argument("--available-now", action="store_true")
    a.add_argument("--schema", help="DDL of the message fields (default: the eight event fields)")
    for name in ("refine", "gold", "test", "run"):
        p = sub.add_parser(name)
        if name != "gold":
            p.add_argument("--bronze", required=name != "gold")
        p.add_argument("--silver", required=True)
        if name != "refine":
            p.add_argument("--gold", required=True)
        if name in ("refine", "run"):
            p.add_argument("--buckets", type=int)
            p.add_argument("--incremental", action="store_true",
                           help="read only new Bronze files; --silver then holds the latest-event state")
            p.add_argument("--checkpoint")
            p.add_argument("--option", action="append", help="file-stream option for --incremental, k=v")
        p.add_argument("--order-by", action="append", help="column that defines newest (repeat: tie-breakers)")
        if name == "run":
            p.add_argument("--retain", type=int, default=0, help="versions of each table kept (0 = all)")
    i = sub.add_parser("inspect")
    i.add_argument("path")
    i.add_argument("n", nargs="?", type=int, default=20)
    e = sub.add_parser("export")
    e.add_argument("--gold", required=True)
    e.add_argument("--dest", required=True)
    e.add_argument("table", nargs="?", default="all")
    args = ap.parse_args(argv)
    spark = spark or build_session(app=f"tidemark-{args.cmd}")

    from .plans import medallion as M
    from .plans.sizing import tune_shuffle_partitions
    from .sources import tables as T

    if args.cmd in ("refine", "test", "run"):
        tune_shuffle_partitions(spark, [args.bronze])    # shuffles sized from the Bronze bytes

    spec = replace(SALES, order_by=tuple(args.order_by)) if getattr(args, "order_by", None) else SALES
    if args.cmd == "ingest":
        from .streaming.ingest import ingest_available, start_bronze_ingest

        schema = StructType.fromDDL(args.schema) if args.schema else EVENT_SCHEMA

        if args.available_now:
            ingest_available(spark, args.bronze, args.checkpoint, args.format, args.source, _opts(args.option), schema)
        else:
            start_bronze_ingest(spark, args.bronze, args.checkpoint, args.format, _opts(args.option),
                                args.source, schema).awaitTermination()
    elif args.cmd == "refine":
        if args.incremental:
            from .streaming.refine_stream import refine_incremental

            status = refine_incremental(spark, args.bronze, args.silver,
                                        args.checkpoint or f"{args.silver.rstrip('/')}/_checkpoint",
                                        spec, buckets=args.buckets, options=_opts(args.option))
            print(json.dumps({"status": status}))
        else:
            res = M.refine(spark, args.bronze, args.silver, spec, buckets=args.buckets)
            print(json.dumps({"status": res.status, "version": res.version, "metrics": res.metrics}))
    elif args.cmd == "gold":
        print(json.dumps(M.build_gold(spark, args.silver, args.gold, spec=spec)))
    elif args.cmd == "test":
        golds = {n: T.read_table(spark, f"{args.gold.rstrip('/')}/{n}") for n in M.GOLD_TABLES}
        res = M.quality(spark, T.read_table(spark, args.bronze), M.current_silver(spark, args.silver, spec)[0], golds)
        from .operators.quality import gate

        for row in gate(res):
            print(json.dumps(row, default=str))
    elif args.cmd == "run":
        out = M.run_medallion(spark, args.bronze, args.silver, args.gold, spec, incremental=args.incremental,
                              checkpoint=args.checkpoint, buckets=args.buckets, retain_versions=args.retain or None,
                              stream_options=_opts(args.option))
        print(json.dumps({"refine": out["refine"].status, "gold": out["gold"],
                          "failed": [r for r in out["quality"] if r["status"] != "pass"]}, default=str))
    elif args.cmd == "inspect":
        from .operators.inspect import inspect_table

        info = inspect_table(spark, args.path, args.n)
        columns = info["schema"].collect()              # a row per column, from one pass
        for c in columns:
            print(f"{c['position']} {c['column_name']} {c['data_type']} nulls={c['null_count']}")
        print(f"rows: {columns[0]['row_count'] if columns else 0}")
        info["sample"].show(args.n, truncate=False)
        if "history" in info:
            info["history"].show(truncate=False)
    elif args.cmd == "export":
        print(json.dumps(T.export_gold(spark, args.gold, args.dest, args.table)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
