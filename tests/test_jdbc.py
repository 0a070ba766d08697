"""A series in a database (the embedded one that Spark brings): months read by partitions, loads that replace a month."""

import pytest
from helpers import month
from pyspark.sql import functions as F

from quarterlake.sources import jdbc

TYPES = "barra VARCHAR(60), fecha DATE, hora SMALLINT, minuto SMALLINT, cmg_usd_mwh DOUBLE"
COLUMNS = ["barra", "fecha", "hora", "minuto", "cmg_usd_mwh"]


@pytest.fixture
def url(spark, request):
    return f"jdbc:derby:memory:{request.node.name.replace('[', '_').replace(']', '')};create=true"


def rows(spark, *args, **kwargs):
    return month(spark, *args, **kwargs).select(*COLUMNS)


def key(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def test_round_trip_by_months(spark, url):
    june, july = rows(spark, 2024, 6, days=2).unionByName(rows(spark, 2024, 6, bus="Ñ'B")), rows(spark, 2024, 7, days=1)
    assert jdbc.replace_month(june.repartition(3), url, "cuarto", (2024, 6), TYPES) == 288
    assert jdbc.replace_month(july, url, "cuarto", (2024, 7), TYPES) == 96
    got = jdbc.read_months(spark, url, "cuarto", (2024, 5), (2024, 7))
    assert got.rdd.getNumPartitions() == 3 and key(got) == key(june.unionByName(july))
    one = jdbc.read_months(spark, url, "cuarto", (2024, 6), (2024, 6)).where(F.col("barra") == "Ñ'B").select("hora")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 96 and "EqualTo(barra,Ñ'B)" in plan and "cmg_usd_mwh" not in plan.split("ReadSchema")[1]
    assert sorted(map(tuple, jdbc.months_held(spark, url, "cuarto").collect())) == [(2024, 6, 288), (2024, 7, 96)]
    again = rows(spark, 2024, 6, prices=7.0)
    assert jdbc.replace_month(again, url, "cuarto", (2024, 6), TYPES) == 96
    assert key(jdbc.read_months(spark, url, "cuarto", (2024, 6), (2024, 7))) == key(again.unionByName(july))
    assert not jdbc.has_table(spark, url, "cuarto_carga") and jdbc.replace_month(again.where("false"), url, "cuarto", (2024, 6), TYPES) == 0


def test_a_load_that_fails_leaves_the_month(spark, url, monkeypatch):
    june = rows(spark, 2024, 6)
    jdbc.replace_month(june, url, "cuarto", (2024, 6), TYPES)
    with pytest.raises(Exception, match="outside"):
        jdbc.replace_month(rows(spark, 2024, 7), url, "cuarto", (2024, 6), TYPES)
    real = jdbc._send
    monkeypatch.setattr(jdbc, "_send", lambda c, sql, *v: real(c, sql, *v) + sql.startswith("INSERT"))
    with pytest.raises(OSError, match="arrived"):
        jdbc.replace_month(rows(spark, 2024, 6, prices=9.0), url, "cuarto", (2024, 6), TYPES)
    assert key(jdbc.read_months(spark, url, "cuarto", (2024, 6), (2024, 6))) == key(june)


def test_settings():
    text = "[postgres]\nhost = db\ndbname = cmg\nuser = u\npassword = p%x\n"
    assert jdbc.read_settings(text) == ("jdbc:postgresql://db:5432/cmg", {"user": "u", "password": "p%x"})
    assert jdbc.read_settings(text + "port = 6000\n")[0].endswith(":6000/cmg")
    for bad, said in (("[x]\n", "host, dbname, user, password"), (text.replace("user = u\n", ""), "user"), (text + "port = a\n", "no number")):
        with pytest.raises(ValueError, match=said):
            jdbc.read_settings(bad)
    assert jdbc.month_predicates("fecha", (2024, 12), (2025, 1))[0] == """"fecha" >= {d '2024-12-01'} AND "fecha" < {d '2025-01-01'}"""
