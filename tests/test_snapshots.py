"""The commit log of the serving tables: one state for readers, conflicts, expiry; changes told by content."""

from datetime import datetime, timedelta

import pytest
from helpers import month
from pyspark.sql import functions as F

from quarterlake.sources import control, silver, snapshots
from quarterlake.workflows import publishing

NOW = datetime(2026, 1, 1)
SCHEMA = "n int, k int"


def rows(spark, *n):
    return spark.createDataFrame([(x,) for x in n], "n int")


def held(spark, root, at=None):
    return sorted(tuple(r) for r in snapshots.read(spark, root, "t", SCHEMA, at or snapshots.snapshot(spark, root)).collect())


def test_commits_conflicts_and_expiry(spark, tmp_path):
    root = f"file://{tmp_path}/s"
    assert snapshots.snapshot(spark, root) == snapshots.EMPTY and held(spark, root) == []
    a, b = snapshots.Transaction(spark, root), snapshots.Transaction(spark, root)
    a.replace("t", "k=1", rows(spark, 1, 2))
    b.replace("t", "k=2", rows(spark, 3))
    assert held(spark, root) == [] and a.read("t", SCHEMA).count() == 2
    assert a.commit("one", NOW).version == 1 and b.commit("two", NOW + timedelta(1)).version == 2
    assert held(spark, root) == [(1, 1), (2, 1), (3, 2)] and held(spark, root, snapshots.snapshot(spark, root, 1)) == [(1, 1), (2, 1)]
    assert snapshots.as_of(spark, root, NOW).version == 1 and snapshots.as_of(spark, root, NOW - timedelta(1)) == snapshots.EMPTY
    c, d = snapshots.Transaction(spark, root), snapshots.Transaction(spark, root)
    c.append("t", "k=1", rows(spark, 9))
    d.replace("t", "k=1", rows(spark, 7))
    c.commit("more", NOW)
    with pytest.raises(snapshots.Conflict, match="k=1"):
        d.commit("late", NOW)
    d.abandon()
    e = snapshots.Transaction(spark, root)
    e.remove("t", "k=2")
    e.commit("less", NOW)
    assert held(spark, root) == [(1, 1), (2, 1), (9, 1)] and snapshots.Transaction(spark, root).commit("nothing", NOW).version == 4
    lost = snapshots.Transaction(spark, root)
    lost.replace("t", "k=5", rows(spark, 5))
    assert [f.split("/")[:2] for f in snapshots.expire(spark, root, 1)] == [["t", "k=2"]]
    assert snapshots.versions(spark, root) == [4] and held(spark, root) == [(1, 1), (2, 1), (9, 1)]
    with pytest.raises(ValueError, match="keeps"):
        snapshots.snapshot(spark, root, 1)
    assert snapshots.remove_orphans(spark, root, datetime.now() - timedelta(hours=1)) == []
    assert [f.split("/")[:2] for f in snapshots.remove_orphans(spark, root, datetime.now() + timedelta(hours=1))] == [["t", "k=5"]]
    assert held(spark, root) == [(1, 1), (2, 1), (9, 1)]


def test_one_of_two_creates_a_file(spark, tmp_path):
    path = f"file://{tmp_path}/x.json"
    assert control.create_text(spark, path, "a") and not control.create_text(spark, path, "b")
    assert control.read_bytes(spark, path) == b"a" and control.names(spark, f"file://{tmp_path}") == ["x.json"]


def state(spark, serving, at=None):
    """What a reader of several tables sees at one snapshot: averages from quarters, days and monthly tables, and the names."""
    at = at or snapshots.snapshot(spark, serving)
    quarters = publishing.read(spark, serving, "cuarto", at).join(publishing.read(spark, serving, "barra", at), "barra_id")
    return (
        sorted(tuple(r) for r in quarters.groupBy("nombre").agg(F.round(F.avg("cmg_usd_mwh"), 6)).collect()),
        sorted(tuple(r) for r in publishing.read(spark, serving, "mes_barra", at).join(publishing.read(spark, serving, "barra", at), "barra_id").select("nombre", F.round("Total", 6)).collect()),
        publishing.read(spark, serving, "dia", at).count(), [r["dias"] for r in publishing.read(spark, serving, "carga_mes", at).collect()],
    )


def test_a_reader_between_any_two_steps_sees_one_load(spark, tmp_path, monkeypatch):
    base, serving = f"file://{tmp_path}/silver", f"file://{tmp_path}/serving"
    silver.write_month(month(spark, prices=2.0, days=2), base, (2024, 6))
    publishing.publish_changed(spark, base, serving, NOW)
    before = state(spark, serving)
    assert before == ([("REF", 2.0)], [("REF", 2.0)], 2, [2])
    silver.write_month(month(spark, prices=6.0, days=3).unionByName(month(spark, bus="NEW", prices=1.0)), base, (2024, 6))
    real, seen = snapshots.Transaction._write, []

    def watched(self, *a):
        out = real(self, *a)
        seen.append(state(spark, serving))
        return out

    with monkeypatch.context() as m:
        m.setattr(snapshots.Transaction, "_write", watched)
        publishing.publish_changed(spark, base, serving, NOW)
    assert len(seen) == 9 and all(s == before for s in seen)
    after = state(spark, serving)
    assert after == ([("NEW", 1.0), ("REF", 6.0)], [("NEW", 1.0), ("REF", 6.0)], 3, [3])
    assert state(spark, serving, snapshots.snapshot(spark, serving, 1)) == before
    gone = snapshots.expire(spark, serving, 1)
    assert gone and state(spark, serving) == after and not any("barra/" in f and f.startswith("barra") for f in gone)


def test_equal_rows_publish_nothing(spark, tmp_path):
    base, serving = f"file://{tmp_path}/silver", f"file://{tmp_path}/serving"
    rows_ = month(spark, days=2).unionByName(month(spark, bus="B2", days=2))
    silver.write_month(rows_, base, (2024, 6))
    publishing.publish_changed(spark, base, serving, NOW)
    first = snapshots.snapshot(spark, serving)
    silver.write_month(rows_.orderBy(F.desc("minuto")), base, (2024, 6))
    assert len(publishing.pending_months(spark, base, serving)) == 1
    assert [r["accion"] for r in publishing.publish_changed(spark, base, serving, NOW)] == ["igual"]
    second = snapshots.snapshot(spark, serving)
    assert second.changed == ["carga_mes/anio=2024/mes=6"] and second.tables["cuarto"] == first.tables["cuarto"]
    assert publishing.pending_months(spark, base, serving) == [] and publishing.loaded_months(spark, serving)[2024, 6][1] == 1


def test_only_changed_bus_days_are_compared(spark, tmp_path, monkeypatch):
    base, serving = f"file://{tmp_path}/silver", f"file://{tmp_path}/serving"
    rows_ = month(spark, days=4)
    for i in range(1, 6):
        rows_ = rows_.unionByName(month(spark, bus=f"B{i}", days=4))
    silver.write_month(rows_, base, (2024, 6))
    publishing.publish_changed(spark, base, serving, NOW)
    one = (F.col("barra") == "B3") & (F.dayofmonth("fecha") == 2) & (F.col("hora") == 5) & (F.col("minuto") == 15)
    silver.write_month(rows_.withColumn("cmg_usd_mwh", F.col("cmg_usd_mwh") + F.when(one, 7.0).otherwise(0.0)), base, (2024, 6))
    real, compared = publishing.changed_quarters, []

    def counted(new, old, changed):
        a, b = real(new, old, changed)
        compared.append((a.count(), b.count(), b._jdf.queryExecution().executedPlan().toString()))
        return a, b

    monkeypatch.setattr(publishing, "changed_quarters", counted)
    assert publishing.publish_changed(spark, base, serving, NOW)[0]["revisiones"] == 1
    assert compared[0][:2] == (96, 96) and "In(fecha" in compared[0][2] or "EqualTo(fecha" in compared[0][2]
    r = publishing.read(spark, serving, "revision").first()
    assert (r["fecha"].day, r["cuartos"], r["cuartos_distintos"], r["dif_max_usd"], r["dif_prom_usd"]) == (2, 6 * 96, 1, 7.0, 7.0)
