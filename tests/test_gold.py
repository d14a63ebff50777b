"""Exact money arithmetic and Gold measures on hand-built rows."""

from pyspark.sql import functions as F

from helpers import day, frame, ev

from tidemark.functions.money import half_up_div, to_cents
from tidemark.plans import gold
from tidemark.plans.staging import stg_silver


def test_half_up_division_is_exact(spark):
    df = spark.createDataFrame([(5, 2), (7, 2), (1, 3), (2, 3), (10**17 + 1, 2)], "n long, d long")
    got = [r[0] for r in df.select(half_up_div("n", "d")).collect()]
    assert got == [3, 4, 0, 1, 5 * 10**16 + 1]


def test_cents_are_exact_for_two_decimal_prices(spark):
    # two-decimal prices whose binary value sits just below the cent (0.29 * 100 = 28.999...)
    df = spark.createDataFrame([(1.15,), (0.29,), (4.35,), (1234567.89,)], "p double")
    assert [r[0] for r in df.select(to_cents("p")).collect()] == [115, 29, 435, 123456789]


def test_daily_kpis(spark):
    rows = [ev("a", "INSERT", "2024-01-01T10:00:00+00:00", precio=1.10, cantidad=3, cliente="c1"),
            ev("b", "UPDATE", "2024-01-01T23:59:59+00:00", precio=2.25, cantidad=1, cliente="c1"),
            ev("c", "INSERT", "2024-01-02T00:00:00+00:00", precio=0.01, cantidad=1, cliente="c2")]
    d = {r.fecha.isoformat(): r for r in gold.daily(stg_silver(frame(spark, rows).drop("seq"))).collect()}
    r1 = d["2024-01-01"]
    assert (r1.cantidad_transacciones, r1.clientes_unicos, r1.unidades_vendidas) == (2, 1, 4)
    assert r1.ingresos_totales == 5.55 and r1.ticket_promedio == 2.78      # 555 / 2 = 277.5 -> 278
    h = gold.hourly(stg_silver(frame(spark, rows).drop("seq")))
    assert h.count() == 3


def test_product_mean_price_is_unweighted(spark):
    rows = [ev("a", "INSERT", "2024-01-01T00:00:00+00:00", precio=1.00, cantidad=10),
            ev("b", "INSERT", "2024-01-01T00:00:00+00:00", precio=2.01, cantidad=1)]
    r = gold.by_product(stg_silver(frame(spark, rows).drop("seq"))).first()
    assert r.precio_promedio == 1.51 and r.ingresos_totales == 12.01 and r.unidades_vendidas == 11


def test_headline_guards_zero_transactions(spark):
    empty = spark.createDataFrame([], "fecha date, cantidad_transacciones long, unidades_vendidas long, ingresos_totales double")
    r = gold.headline(empty).first()
    assert (r.ingresos_totales, r.cantidad_transacciones, r.ticket_promedio) == (0.0, 0, 0.0)


def test_malformed_event_time_gives_null_day_not_error(spark):
    rows = [ev("a", "INSERT", "not-a-time")]
    d = gold.daily(stg_silver(frame(spark, rows).drop("seq"))).collect()
    assert d[0].fecha is None
    assert frame(spark, rows).select(F.col("timestamp").try_cast("timestamp")).first()[0] is None


def test_with_position_matches_row_number(spark):
    from pyspark.sql import Window

    from tidemark.functions.ranking import with_position

    df = spark.range(0, 500).select((F.col("id") * 7919 % 101).alias("v"), F.col("id"))
    order = [F.col("v").desc(), F.col("id").asc()]
    got = {(r.id, r.pos) for r in with_position(df, order, partitions=7).collect()}
    want = {(r.id, r.pos) for r in df.withColumn("pos", F.row_number().over(Window.orderBy(*order))).collect()}
    assert got == want


def test_bounded_pandas_read(spark):
    import pytest

    from tidemark.sources.tables import ResultTooLarge, to_pandas_bounded

    assert len(to_pandas_bounded(spark.range(10), max_rows=10)) == 10
    with pytest.raises(ResultTooLarge):
        to_pandas_bounded(spark.range(11), max_rows=10)


def test_gold_columns_are_the_fixed_schema(spark):
    from tidemark.plans.queries import _stg_a

    from helpers import SF0001

    stg = _stg_a(spark, SF0001)
    assert gold.daily(stg).columns == gold.DAILY_COLUMNS
    assert gold.hourly(stg).columns == gold.HOURLY_COLUMNS
    assert gold.by_product(stg).columns == gold.PRODUCT_COLUMNS


def test_distinct_counts_in_a_given_number_of_tasks(spark):
    events = [ev(f"k{i % 7}" if i % 5 else None, "INSERT", day(1 + i % 3) if i % 11 else None, cliente=f"C{i % 4}" if i % 6 else None, seq=i) for i in range(60)]
    stg = stg_silver(frame(spark, events))
    for grain in (gold.daily, gold.hourly):
        dealt = grain(stg, tasks=6)
        plan = dealt._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan and ", 6)" in plan
        assert dealt.collect() == grain(stg).collect()
