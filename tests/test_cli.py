"""The job entry points, end to end on message files: ingest → run → inspect → export."""

from helpers import day, ev, frame

from tidemark.cli import main
from tidemark.sources.messages import to_messages, write_messages
from tidemark.sources.tables import read_table


def test_jobs_end_to_end(spark, tmp_lake, capsys):
    rows = [ev("a", "INSERT", day(1)), ev("b", "INSERT", day(1, 5), precio=2.5), ev("b", "DELETE", day(2)),
            ev("c", "UPDATE", day(2, 7), precio=None)]
    write_messages(to_messages(frame(spark, rows)), f"{tmp_lake}/topic/a", files=1)
    b, s, g = f"{tmp_lake}/bronze", f"{tmp_lake}/silver", f"{tmp_lake}/gold"
    assert main(["ingest", "--bronze", b, "--checkpoint", f"{tmp_lake}/ckpt", "--format", "parquet",
                 "--source", f"{tmp_lake}/topic/*", "--available-now"], spark) == 0
    assert main(["run", "--bronze", b, "--silver", s, "--gold", g], spark) == 0
    assert [r.tx_id for r in read_table(spark, s).collect()] == ["a"]
    assert read_table(spark, f"{g}/gold_kpi_ventas").count() == 1
    assert main(["refine", "--bronze", b, "--silver", s], spark) == 0           # rescan: merge, unchanged
    assert '"status": "merged"' in capsys.readouterr().out
    assert main(["inspect", s, "5"], spark) == 0
    assert "rows: 1" in capsys.readouterr().out
    assert main(["export", "--gold", g, "--dest", f"{tmp_lake}/out", "gold_kpi_producto"], spark) == 0
    assert spark.read.parquet(f"{tmp_lake}/out/gold/gold_kpi_producto").count() == 1


def test_incremental_run_matches_batch_run(spark, tmp_lake):
    rows = [ev("a", "INSERT", day(1)), ev("b", "INSERT", day(1, 5), precio=2.5), ev("b", "DELETE", day(2)),
            ev("c", "UPDATE", day(2, 7))]
    b = f"{tmp_lake}/bronze"
    frame(spark, rows).write.parquet(b)
    assert main(["run", "--bronze", b, "--silver", f"{tmp_lake}/s1", "--gold", f"{tmp_lake}/g1"], spark) == 0
    assert main(["run", "--bronze", b, "--silver", f"{tmp_lake}/s2", "--gold", f"{tmp_lake}/g2", "--incremental",
                 "--option", "maxFilesPerTrigger=1"],
                spark) == 0
    for t in ("gold_kpi_ventas", "gold_kpi_ventas_hora", "gold_kpi_producto"):
        a = sorted(map(tuple, read_table(spark, f"{tmp_lake}/g1/{t}").collect()))
        c = sorted(map(tuple, read_table(spark, f"{tmp_lake}/g2/{t}").collect()))
        assert a == c and a


def test_gold_and_test_commands(spark, tmp_lake, capsys):
    import json

    rows = [ev("a", "INSERT", day(1)), ev("b", "INSERT", day(2), precio=None)]
    b, s, g = f"{tmp_lake}/bronze", f"{tmp_lake}/silver", f"{tmp_lake}/gold"
    frame(spark, rows).write.parquet(b)
    assert main(["refine", "--bronze", b, "--silver", s, "--buckets", "2"], spark) == 0
    assert main(["gold", "--silver", s, "--gold", g], spark) == 0
    assert set(json.loads(capsys.readouterr().out.strip().splitlines()[-1])) == {
        "gold_kpi_ventas", "gold_kpi_ventas_hora", "gold_kpi_producto"}
    assert main(["test", "--bronze", b, "--silver", s, "--gold", g], spark) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert len(lines) == 21
    assert [r["status"] for r in lines if r["column_name"] == "precio" and r["model"] == "stg_bronze_ventas"] == ["warn"]
