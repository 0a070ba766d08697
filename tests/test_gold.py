import pytest
from helpers import dated, month
from pyspark.sql import functions as F

from quarterlake.operators import gold, quality


def test_no_solar_is_not_an_average_of_averages(spark):
    r = gold.monthly_summary(dated(month(spark)), "REF").first()
    assert (r.cuartos, r.A, r.B, r.C, r.Solar) == (96, 100, 10, 200, 10)
    assert r.NoSolar == pytest.approx((100 * 9 + 200 * 5) / 14)
    assert r.Total == pytest.approx(2000 / 24)


def test_long_day_weights_the_extra_hour(spark):
    r = gold.monthly_summary(dated(month(spark, 2025, 4, first=5, hours=range(25))), "REF").first()
    assert r.cuartos == 100 and r.NoSolar == pytest.approx((100 * 10 + 200 * 5) / 15)


def _pair(spark, a, b, hours_b=range(24)):
    return dated(month(spark, bus="REF", prices=a).unionByName(month(spark, bus="COMP", prices=b, hours=hours_b)))


@pytest.mark.parametrize(("a", "b", "risk", "pct"), [(50.0, 60.0, 10, 0.2), (60.0, 50.0, -10, -1 / 6), (0.0, 60.0, 60, None)])
def test_risk(spark, a, b, risk, pct):
    df = _pair(spark, a, b)
    rows = gold.risk_series(df, "REF", "COMP").collect()
    assert len(rows) == 96 and {r.riesgo_usd_mwh for r in rows} == {risk}
    assert all(r.riesgo_pct == (None if pct is None else pytest.approx(pct)) for r in rows)
    zero = gold.without_percentage(df, "REF").first()
    assert tuple(zero) == ((96, 96) if a == 0 else (0, 96))


def test_risk_is_an_inner_join_and_shares_averages(spark):
    assert gold.risk_series(_pair(spark, 1.0, 2.0, hours_b=[0, 1]), "REF", "COMP").count() == 8
    df = dated(month(spark, bus="REF", prices=lambda h: 10.0 if h % 2 else 30.0).unionByName(month(spark, bus="COMP", prices=40.0)))
    r = gold.range_risk_summary(df, "REF", "COMP", "2024-06-01", "2024-06-30").where("periodo = 'Rango completo' and bloque = 'B'").first()
    assert r.riesgo_pct == pytest.approx((40 - 20) / 20)


def test_month_and_range_families_agree(spark):
    df = dated(month(spark, days=3))
    a = gold.monthly_summary(df, "REF").first()
    b = gold.range_blocks(df, "REF", "2024-06-01", "2024-06-30").collect()
    assert [r.periodo for r in b] == ["2024-06", gold.TOTAL]
    for c in ("A", "B", "C", "Solar", "NoSolar", "Total"):
        assert a[c] == pytest.approx(b[0][c], abs=1e-12) == b[1][c]
    assert gold.range_blocks(df, "NONE", "2024-06-01", "2024-06-30").count() == 0


def test_wide_series(spark):
    df = dated(month(spark, bus="A.B", hours=[0, 24]))
    w = gold.wide_series(df, ["Z", "A.B"], "2024-06-01", "2024-06-01")
    assert w.columns[-2:] == ["Z", "A.B"] and [r.hora for r in w.collect()] == [0] * 4 + [24] * 4
    assert w.where("Z IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="two prices"):
        gold.wide_series(df.union(df), ["A.B"], "2024-06-01", "2024-06-01").collect()


def test_compare_buses(spark):
    df = _pair(spark, 1.0, 2.0)
    assert gold.compare_buses(df, ["REF", "COMP", "REF"]).columns == ["anio", "mes", "REF", "COMP"]
    with pytest.raises(ValueError):
        gold.compare_buses(df, [])


@pytest.mark.parametrize("buses", [["NONE"], ["REF", "NONE"]])
def test_empty_and_absent(spark, buses):
    df = dated(month(spark)).where("false") if buses == ["NONE"] else dated(month(spark))
    assert gold.bus_summary(df, buses).count() == len(buses) - 1
    assert quality.counters(df).first().filas == (0 if buses == ["NONE"] else 96)


def test_block_b_share(spark):
    s = gold.range_statistics(dated(month(spark)), "REF", "2024-06-01", "2024-06-01").where(F.col("bloque") == "B").first()
    assert (s.cuartos, s.promedio, s.desviacion, s.minimo, s.maximo, s.en_cero) == (40, 10, 0, 10, 10, 0)
