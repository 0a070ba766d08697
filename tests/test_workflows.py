"""Ingest and publication from day files to serving tables, on made-up files."""

import hashlib
import zipfile
from datetime import date, datetime

import pytest
from helpers import month
from pyspark.sql import functions as F

from quarterlake.sources import bronze, control, silver
from quarterlake.workflows import ingest, publishing

HEADER = [*bronze.LEADING, *bronze.PRICES_NOW, *bronze.TRAILING]
NOW = datetime(2026, 10, 6, 12, 0)


def day_file(folder, day, kind="def", version=1, price=10.0, hours=range(24), buses=("BARRA_1", "BARRA_2"), member=True):
    f = day.strftime("%Y%m%d")
    name = f"Antecedentes_CMG_Real_{kind}{'' if version == 1 else f'-v{version}'}_{day:%y%m%d}.zip"
    lines = [";".join(HEADER)] + [f"{f};{h};{m};{b};1;X;1.0;{price};{price};950.5;NO" for b in buses for h in hours for m in (0, 15, 30, 45)]
    with zipfile.ZipFile(f"{folder}/{name}", "w") as z:
        if member:
            z.writestr(f"CmgBarrasComparativo_{f}_{f}_15.csv", "\n".join(lines))
        z.writestr(f"PromediosBarras_{f}_{f}_R.csv", "")
    raw = open(f"{folder}/{name}", "rb").read()
    return {"url": "u/" + name, "nombre": name, "tipo": kind, "version": version, "reemision": 0, "fecha_operacion": day, "fecha_publicacion": date(2025, 10, 1), "sha256": hashlib.sha256(raw).hexdigest(), "bytes": len(raw), "descargado_en": NOW}


def manifest(spark, folder, *entries):
    control.write_manifest(spark, folder, {e["nombre"]: e for e in entries})


def test_control_files(spark, tmp_path):
    path = f"file://{tmp_path}/a.json"
    assert control.read_json(spark, path, {"x": 0}) == {"x": 0}
    control.write_json(spark, path, {"x": 1})
    control.write_json(spark, path, {"x": "á"})
    assert control.read_json(spark, path, None) == {"x": "á"} and [n for n in control.names(spark, f"file://{tmp_path}") if "tmp" in n] == []
    control.write_text(spark, f"file://{tmp_path}/manifest.json", "{broken")
    assert control.read_manifest(spark, f"file://{tmp_path}").isEmpty() and control.read_json(spark, f"file://{tmp_path}/manifest.json", 7) == 7


def test_dialects():
    now, old = HEADER, [*bronze.LEADING, *bronze.PRICES_2024, *bronze.TRAILING]
    heard = lambda header: bronze.spoken(header, bronze.COMPARISONS, bronze.REVISED)
    assert heard(now) == (now, [*bronze.REQUIRED, *bronze.PRICES_NOW[1:]])
    assert heard(old) == (old, [*bronze.REQUIRED, *bronze.PRICES_2024[1:]])
    mixed = [bronze.PRICES_NOW[0] if c == bronze.PRICES_2024[0] else c for c in old]
    assert heard(mixed)[0] == mixed
    first = now[:7] + list(bronze.REVISED[:2]) + now[7:]
    assert heard(first)[0] == first and heard(first[::-1])[0] == first[::-1]
    assert heard([c for c in first if c != "USD"])[0] == [c for c in first if c != "USD"] + ["USD"]
    average = lambda header: bronze.spoken(header, bronze.AVERAGE_DIALECTS)
    assert average(["CMg[mills/kWh]"])[1][-1] == "CMg[mills/kWh]" and average([])[0][7] == "CMg[USD/MWh]"


def test_ingest_chooses_skips_and_keeps(spark, tmp_path):
    folder, base = str(tmp_path / "bronze"), f"file://{tmp_path}/silver"
    (tmp_path / "bronze").mkdir()
    url = "file://" + folder
    d1, d2 = date(2025, 9, 9), date(2025, 9, 10)
    pre, final = day_file(folder, d1, "pre", price=1.0), day_file(folder, d1, "def", price=2.0)
    broken = day_file(folder, d2, member=False)
    with pytest.raises(ValueError, match="no files"):
        ingest.ingest(spark, url, base, NOW)
    manifest(spark, url, pre, final, broken)
    reports, findings = ingest.ingest(spark, url, base, NOW)
    assert len(reports) == 1 and reports[0]["dias"] == 1 and reports[0]["filas_escritas"] == 192 and len(reports[0]["omitidos"]) == 1
    assert any(f["severidad"] == "critico" and f["nombre"] == broken["nombre"] for f in findings)
    got = silver.scan(spark, base)
    assert [tuple(r) for r in got.groupBy("fecha", "origen").agg(F.max("cmg_usd_mwh"), F.max("usd_clp")).collect()] == [(d1, "pagina_cen_def", 2.0, 950.5)]
    assert control.read_json(spark, f"{url}/estado.json", {}) == {}

    good = day_file(folder, d2, "pre", price=5.0)
    manifest(spark, url, pre, final, good)
    reports, _ = ingest.ingest(spark, url, base, NOW, keep_files=False)
    assert reports[0]["dias"] == 2 and reports[0]["dias_pre"] == 1 and reports[0]["omitidos"] == [] and ingest.totals(reports)["filas_escritas"] == 384
    left = [n for n in control.names(spark, url) if n.endswith(".zip")]
    assert left == [broken["nombre"]] and control.witnessed(spark, url, final) and not control.witnessed(spark, url, pre)
    assert ingest.ingest(spark, url, base, NOW) == ([], [])

    newer = day_file(folder, d2, "def", price=6.0)
    manifest(spark, url, pre, final, good, newer)
    reports, _ = ingest.ingest(spark, url, base, NOW)
    assert reports[0]["desde_silver"] == 1 and reports[0]["dias"] == 2
    assert {r["fecha"]: r["p"] for r in silver.scan(spark, base).groupBy("fecha").agg(F.max("cmg_usd_mwh").alias("p")).collect()} == {d1: 2.0, d2: 6.0}

    odd = day_file(folder, date(2025, 9, 11), "raro", price=1.0) | {"tipo": "desconocido"}
    manifest(spark, url, pre, final, good, newer, odd)
    reports, _ = ingest.ingest(spark, url, base, NOW)
    assert len(reports[0]["omitidos"]) == 1 and reports[0]["dias"] == 2


def test_a_day_of_another_shape_stays_out(spark, tmp_path):
    folder, base = str(tmp_path / "bronze"), f"file://{tmp_path}/silver"
    (tmp_path / "bronze").mkdir()
    short = day_file(folder, date(2025, 9, 9), hours=range(20))
    manifest(spark, "file://" + folder, short)
    reports, findings = ingest.ingest(spark, "file://" + folder, base, NOW)
    assert reports[0]["filas_escritas"] == 0 and not silver.base_exists(spark, base) and {f["tipo"] for f in findings if f["severidad"] == "critico"} == {"largo_inesperado"}


def test_union_of_no_days():
    with pytest.raises(ValueError):
        ingest.union_days([])


def test_publication_and_revisions(spark, tmp_path):
    folder, base, serving = str(tmp_path / "bronze"), f"file://{tmp_path}/silver", f"file://{tmp_path}/serving"
    (tmp_path / "bronze").mkdir()
    url = "file://" + folder
    d1, d2 = date(2025, 9, 9), date(2025, 9, 10)
    a, b = day_file(folder, d1, "def", price=2.0), day_file(folder, d2, "pre", price=5.0)
    manifest(spark, url, a, b)
    ingest.ingest(spark, url, base, NOW)
    done = publishing.publish_changed(spark, base, serving, NOW, url)
    assert [(r["accion"], r["filas"], r["dias"], r["revisiones"]) for r in done] == [("nuevo", 384, 2, 0)]
    assert publishing.pending_months(spark, base, serving) == [] and publishing.publish_changed(spark, base, serving, NOW, url) == []
    assert publishing.read(spark, serving, "carga_mes").select("filas", "dias", "dias_preliminar", "carga").first() == (384, 2, 1, 1)

    c = day_file(folder, d2, "def", price=8.0)
    manifest(spark, url, a, b, c)
    with pytest.raises(ValueError, match="ingest it first"):
        publishing.publish_changed(spark, base, serving, NOW, url, force=True)
    ingest.ingest(spark, url, base, NOW)
    done = publishing.publish_changed(spark, base, serving, NOW, url)
    assert [(r["accion"], r["revisiones"]) for r in done] == [("reemplazado", 1)]
    r = publishing.read(spark, serving, "revision").first()
    assert (r["fecha"], r["origen_antes"], r["origen_despues"], r["documento_antes"], r["documento_despues"], r["cuartos"], r["cuartos_distintos"], r["dif_max_usd"], r["dif_prom_usd"]) == (d2, 3, 2, b["nombre"], c["nombre"], 192, 192, 3.0, 3.0)
    assert publishing.publish_changed(spark, base, serving, NOW, url, force=True)[0]["revisiones"] == 0
    assert publishing.read(spark, serving, "revision").count() == 1 and publishing.read(spark, serving, "documento").count() == 3
    got = publishing.serving_series(spark, serving, "BARRA_2", d2, d2).collect()
    assert len(got) == 96 and {(x["version"], x["usd_clp"], x["cmg_usd_mwh"]) for x in got} == {("Definitivo", 950.5, 8.0)}
    view = publishing.monthly_view(publishing.read(spark, serving, "mes_barra"), publishing.read(spark, serving, "barra"), publishing.read(spark, serving, "carga_mes"))
    assert [(x["barra"], x["cuartos"], x["Total"], x["dias"], x["dias_preliminar"]) for x in view.orderBy("barra").collect()] == [("BARRA_1", 192, 5.0, 2, 0), ("BARRA_2", 192, 5.0, 2, 0)]


def test_a_publication_cut_short_is_done_again(spark, tmp_path, monkeypatch):
    base, serving = f"file://{tmp_path}/silver", f"file://{tmp_path}/serving"
    silver.write_month(month(spark, prices=1.0), base, (2024, 6))
    publishing.publish_changed(spark, base, serving, NOW)
    silver.write_month(month(spark, prices=4.0), base, (2024, 6))

    def stop(*a):
        raise RuntimeError("cut short")

    with monkeypatch.context() as m:
        m.setattr(publishing, "day_table", stop)
        with pytest.raises(RuntimeError):
            publishing.publish_changed(spark, base, serving, NOW)
    assert len(publishing.pending_months(spark, base, serving)) == 1
    publishing.publish_changed(spark, base, serving, NOW)
    r = publishing.read(spark, serving, "revision").collect()
    assert len(r) == 1 and r[0]["dif_max_usd"] == 3.0 and publishing.read(spark, serving, "mes_barra").first()["Total"] == 4.0


def test_removal_of_earlier_months(spark, tmp_path):
    base, serving = f"file://{tmp_path}/silver", f"file://{tmp_path}/serving"
    silver.write_month(month(spark, 2024, 5, "OLD"), base, (2024, 5))
    silver.write_month(month(spark, 2024, 6, "NEW"), base, (2024, 6))
    publishing.publish_changed(spark, base, serving, NOW)
    assert publishing.remove_earlier(spark, serving, (2024, 6)) == [(2024, 5)]
    assert [r["nombre"] for r in publishing.read(spark, serving, "barra").collect()] == ["NEW"]
    assert publishing.months_in_store(spark, serving) == [(2024, 6)] == list(publishing.loaded_months(spark, serving))
    assert publishing.read(spark, serving, "dia").count() == 1 and publishing.remove_earlier(spark, serving, (2024, 6)) == []
    with pytest.raises(Exception, match="twice"):
        silver.write_month(month(spark, 2024, 7).unionByName(month(spark, 2024, 7)), base, (2024, 7))
        publishing.publish_changed(spark, base, serving, NOW)


def test_commands(spark, tmp_path, capsys):
    from quarterlake.cli import main

    (tmp_path / "bronze").mkdir()
    folder, base, serving = f"file://{tmp_path}/bronze", f"file://{tmp_path}/silver", f"file://{tmp_path}/serving"
    assert main(["ingerir-pagina", base, folder], spark) == 1
    manifest(spark, folder, day_file(str(tmp_path / "bronze"), date(2025, 9, 9)))
    assert main(["ingerir-pagina", base, folder], spark) == 0 and main(["publicar", base, serving, "--bronze", folder], spark) == 0
    assert "filas=192" in capsys.readouterr().out
    assert main(["exportar-cmg", base, "BARRA_1", str(tmp_path / "out")], spark) == 0 and (tmp_path / "out" / "CMg_BARRA_1_2025-09_a_2025-09.csv").exists()
    assert main(["exportar-cmg", base, "NONE", str(tmp_path / "out")], spark) == 1 and main(["exportar-cmg", base, "BARRA_1", "x", "--formatos", "pdf"], spark) == 2
