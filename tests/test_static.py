"""Source-level rules: no driver collection or Python UDFs in the library."""

import pathlib
import re

ROOT = pathlib.Path(__file__).resolve().parents[1] / "tidemark"
# The only places that bring rows to the driver: the one-row-per-test quality results,
# the pandas read of report-sized tables, the one-row-per-column inspection, and the numbers of
# the key-hash partitions that a batch touches (at most the table's fixed partition count).
ALLOWED_COLLECT = {("operators/quality.py", "collect_results"), ("sources/tables.py", "to_pandas_bounded"), ("cli.py", "main"),
                   ("operators/partition_merge.py", "touched"), ("plans/gold_delta.py", "_add")}


def _functions_with(pattern: str):
    hits = []
    for path in ROOT.rglob("*.py"):
        if path.parent.name == "llm":              # has rules and tests of its own
            continue
        current = None
        for line in path.read_text().splitlines():
            m = re.match(r"\s*def (\w+)\(", line)
            if m and not line.startswith(" " * 8):
                current = m.group(1)
            if re.search(pattern, line) and not line.lstrip().startswith("#"):
                hits.append((str(path.relative_to(ROOT)), current))
    return hits


def test_collect_only_where_bounded():
    hits = set(_functions_with(r"\.(collect|toPandas|toLocalIterator)\(")) - ALLOWED_COLLECT
    assert not hits, hits


def test_no_python_udfs():
    assert not _functions_with(r"\b(udf|pandas_udf|mapInPandas|applyInPandas)\b|\.rdd\.map")


def test_no_local_checkpoint():
    assert not _functions_with(r"localCheckpoint")


def test_driver_contract_keys():
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    assert set(e.QUERIES) - set(o) == {"table_history"}      # rows-only by nature
    assert all(callable(f) for f in q.values()) and all(isinstance(s, str) and s.strip() for s in o.values())
