"""The source's structure, coverage, site map, reports and exports."""

import json
from datetime import date, datetime, timezone
from pathlib import Path

import pytest
from helpers import dated, month

from quarterlake.functions import domain
from quarterlake.operators import gold, versions
from quarterlake.schema import MANIFEST
from quarterlake.sources import bronze, control
from quarterlake.workflows import reports, watch

NOW = datetime(2026, 10, 6, 12, 0)
INDEX = '<a href="https://e.org/x/2024-costo-marginal-real/">2024</a><a href="https://e.org/x/2025-costo-marginal-real-b/">2025</a><a href="/2026">no</a>'
PAGE = """<div><span class="informes-estudio-Titulo" title="Antecedentes Costo Marginal Real Definitivo">x</span>Fecha de publicación: 22/01/2026
<a href="https://e.org/wp-content/uploads/Antecedentes_CMG_Real_def_260115.zip">Descargar ZIP</a></div>"""
MAP = """<sitemapindex><sitemap><loc>https://e.org/documentos-sitemap1.xml</loc><lastmod>2026-01-01T00:00:00+00:00</lastmod></sitemap>
<sitemap><loc>https://e.org/documentos-sitemap2.xml</loc><lastmod>2026-03-01T00:00:00+00:00</lastmod></sitemap>
<sitemap><loc>https://e.org/documentos-sitemap3.xml</loc><lastmod>2026-02-01T00:00:00+00:00</lastmod></sitemap>
<sitemap><loc>https://e.org/page-sitemap.xml</loc><lastmod>2026-04-01T00:00:00+00:00</lastmod></sitemap></sitemapindex>"""
SUBMAP = """<urlset><url><loc>https://e.org/documentos/antecedentes-costo-marginal-real-v2-260831/</loc><lastmod>2026-02-15T10:00:00+00:00</lastmod></url>
<url><loc>https://e.org/documentos/otra-cosa-260831/</loc><lastmod>2026-02-15T10:00:00+00:00</lastmod></url>
<url><loc>https://e.org/documentos/antecedentes-costo-marginal-real-260830/</loc><lastmod>2026-01-15T00:00:00+00:00</lastmod></url></urlset>"""
BASE = {
    "indice_url": "i", "dia_url": "d", "sitemap_url": "s", "anios": [2024, 2025], "marcadores": {"boton": "Descargar ZIP"}, "dia": date(2026, 1, 15),
    "documentos": [{"nombre": "Antecedentes_CMG_Real_def_260115.zip", "etiqueta": "Antecedentes Costo Marginal Real Definitivo", "publicado": date(2026, 1, 22)}],
}


def fetch_of(**pages):
    return lambda url: pages.get(url, (404, ""))


def test_the_source_as_it_was(spark):
    fetch = fetch_of(i=(200, INDEX), d=(200, PAGE), s=(200, MAP))
    assert watch.preflight(spark, fetch, BASE) == []
    kinds = lambda f, b=BASE: [x["tipo"] for x in watch.preflight(spark, f, b)]
    assert kinds(fetch_of(i=(200, ""), d=(404, ""), s=(500, ""))) == ["base_indice_sin_anios", "base_dia_referencia_inaccesible", "base_sitemap_inaccesible"]
    changed = BASE | {"anios": [2023, 2024], "marcadores": {"a": "nowhere"}, "documentos": [BASE["documentos"][0] | {"etiqueta": "x", "publicado": None}, {"nombre": "gone.zip", "etiqueta": "", "publicado": None}]}
    assert sorted(kinds(fetch_of(i=(200, INDEX), d=(200, PAGE), s=(200, "<x/>")), changed)) == sorted(["base_indice_sin_anio", "base_marcador_ausente", "base_documento_ausente", "base_etiqueta_distinta", "base_fecha_publicacion_distinta", "base_sitemap_cambiado"])
    new = watch.preflight(spark, fetch, BASE | {"documentos": []})
    assert [x["tipo"] for x in new] == ["base_revision_en_referencia"] and not watch.stops_download(new)
    assert watch.stops_download(watch.structure_findings(spark, "anio", "", {"2024": "2024"}, []))
    with pytest.raises(OSError):
        watch.preflight(spark, fetch_of(), BASE)


def test_slugs_are_asked_for_only_when_needed():
    calls = []

    def fetch(url):
        calls.append(url)
        return 200, INDEX

    assert watch.refresh_slugs(fetch, "i", {2024: "-old"}, [2024]) == ({2024: "-old"}, False) and not calls
    assert watch.refresh_slugs(fetch, "i", {2024: "-old"}, [2025]) == ({2024: "-costo-marginal-real", 2025: "-costo-marginal-real-b"}, True)
    assert watch.refresh_slugs(fetch, "i", {2024: "-old"}, force=True)[1]


def test_revisions_of_the_site_map(spark):
    entries = bronze.sitemap_entries(spark.createDataFrame([(MAP,)], "xml string"))
    since = datetime(2026, 1, 1, tzinfo=timezone.utc)
    assert watch.changed_submaps(entries, since) == (["https://e.org/documentos-sitemap2.xml", "https://e.org/documentos-sitemap3.xml"], False)
    assert watch.changed_submaps(entries, since, 1) == (["https://e.org/documentos-sitemap2.xml"], True)
    pages = {"s": (200, MAP), "https://e.org/documentos-sitemap2.xml": (200, SUBMAP), "https://e.org/documentos-sitemap3.xml": (200, "<urlset/>")}
    found, cut = watch.search_revisions(spark, lambda u: pages.get(u, (404, "")), "s", datetime(2026, 1, 15, tzinfo=timezone.utc))
    assert [r["fecha"] for r in found.collect()] == [date(2026, 8, 31)] and not cut


def test_starting_point(spark, tmp_path):
    folder = f"file://{tmp_path}"
    assert watch.starting_point(spark, folder) is None
    entry = {f.name: None for f in MANIFEST} | {"nombre": "a", "descargado_en": datetime(2026, 2, 1, 3)}
    control.write_manifest(spark, folder, {"a": entry, "b": entry | {"nombre": "b", "descargado_en": datetime(2026, 1, 1)}})
    assert watch.starting_point(spark, folder) == datetime(2026, 1, 1, tzinfo=timezone.utc)
    watch.store_cursor(spark, folder, datetime(2026, 5, 1, tzinfo=timezone.utc))
    assert watch.starting_point(spark, folder) == datetime(2026, 5, 1, tzinfo=timezone.utc)


def test_coverage(spark):
    day = lambda d: (date(2024, 12, d),)
    present = spark.createDataFrame([day(1), day(2), day(5)], "fecha date")
    manifest = spark.createDataFrame([day(3), day(5)], "fecha_operacion date")
    first, last = date(2024, 12, 1), watch.last_expected(date(2025, 1, 5))
    assert last == date(2025, 1, 2)
    missing = watch.missing_by_cause(present, manifest, first, last)
    assert [tuple(r) for r in missing.collect()] == [("sin_descargar", date(2024, 12, 4), date(2024, 12, 4), 1), ("sin_descargar", date(2024, 12, 6), date(2025, 1, 2), 28), ("sin_ingerir", date(2024, 12, 3), date(2024, 12, 3), 1)]
    coverage = versions.coverage(present, manifest, first, last)
    assert [tuple(r) for r in watch.month_gaps(coverage).collect()] == [("2024-12", "incompleto", 3, 31), ("2025-01", "vacio", 0, 2)]
    lines = watch.status_lines(coverage, missing, first, last, 2)
    assert lines[0] == "cobertura: 3 de 33 dias (2024-12-01 a 2025-01-02)" and lines[1] == "faltantes: 30 dia(s)" and lines[-1] == "  ..."
    assert [r["tipo"] for r in watch.coverage_findings(missing).collect()] == ["dias_descargados_sin_ingerir"]
    whole = versions.coverage(present, manifest, first, date(2024, 12, 2))
    assert watch.status_lines(whole, missing.limit(0), first, date(2024, 12, 2))[1] == "faltantes: ninguno"
    assert versions.days_in_base(present).count() == 3


def test_ranges():
    assert domain.date_range([(2024, 2), (2023, 11)]) == (date(2023, 11, 1), date(2024, 2, 29))
    assert domain.range_text(date(2024, 1, 1), date(2024, 1, 1)) == "2024-01-01" and domain.months_text((2024, 1), (2024, 3)) == "2024-01 a 2024-03"
    got = domain.preset_ranges(date(2025, 3, 10), (date(2024, 8, 1), date(2025, 3, 5)))
    assert got == {"Mes pasado": (date(2025, 2, 1), date(2025, 2, 28)), "Este año": (date(2025, 1, 1), date(2025, 3, 5)), "Ultimos 12 meses": (date(2024, 8, 1), date(2025, 3, 5)), "Todo": (date(2024, 8, 1), date(2025, 3, 5))}
    assert domain.preset_ranges(date(2027, 3, 10), (date(2024, 8, 1), date(2025, 3, 5)))["Mes pasado"] == (date(2025, 3, 1), date(2025, 3, 5))


@pytest.mark.parametrize(("text", "want"), [("1,3", ("excel", "parquet")), ("csv; XLSX", ("excel", "csv")), ("todos", ("excel", "csv", "parquet")), ("", None), ("pdf", None), ("1 pdf", None)])
def test_formats(text, want):
    assert reports.read_formats(text) == want


def test_number_formats():
    of = {h: reports.number_format(h) for h in ("Fecha", "Fecha y hora", "Riesgo [%]", "A [USD/MWh]", "Tipo de cambio [CLP/USD]", "Cuartos en cero", "Barra")}
    assert list(of.values()) == ["dd-mm-yyyy", "dd-mm-yyyy hh:mm", "0.00%", "#,##0.00", "#,##0.00", "#,##0", None]


@pytest.fixture(scope="module")
def series(spark):
    return dated(month(spark, days=3).unionByName(month(spark, days=3, bus="COMP", prices=50.0))).cache()


@pytest.fixture(scope="module")
def by_day(spark):
    return spark.createDataFrame([(date(2024, 6, d), "Definitivo", 900.0 + d) for d in (1, 2, 3)], "fecha date, version string, usd_clp double")


def test_books(spark, series, by_day):
    a, z = date(2024, 6, 1), date(2024, 6, 2)
    book = reports.bus_book(series, "REF", a, z, by_day, NOW)
    assert list(book) == ["CMg 15 min", "Bloques", "Estadisticas", "Version por dia", "Info"] and book["CMg 15 min"].count() == 192
    info = dict(map(tuple, book["Info"].collect()))
    assert info["Desde"] == "01-06-2024" and info["Cuartos de hora"] == "192" and info["Generado"] == "06-10-2026 12:00" and info["Dias con datos"] == "2"
    assert "CMg [USD/MWh]" in reports.readable(book["CMg 15 min"]).columns and book["CMg 15 min"].first()["usd_clp"] == 901.0
    wide = reports.buses_book(series, ["REF", "NONE", "COMP"], a, z, by_day, NOW)
    assert wide["CMg 15 min"].count() == 192 and dict(map(tuple, wide["Info"].collect()))["Barras sin datos en el rango"] == "NONE"
    risk = reports.risk_book(series, "REF", "COMP", a, z, by_day, NOW)
    assert risk["Riesgo 15 min"].count() == 192 and risk["Riesgo 15 min"].first()["riesgo_usd_mwh"] == -50.0
    for bad in (lambda: reports.bus_book(series, "NONE", a, z, by_day, NOW), lambda: reports.buses_book(series, ["REF", "REF"], a, z, by_day, NOW), lambda: reports.risk_book(series, "REF", "REF", a, z, by_day, NOW),
                lambda: reports.risk_book(series, "REF", "NONE", a, z, by_day, NOW), lambda: reports.bus_book(series, "REF", z, a, by_day, NOW), lambda: reports.buses_book(series, ["REF", "COMP"], date(1990, 1, 1), date(2024, 6, 1), by_day, NOW)):
        with pytest.raises(ValueError):
            bad()


def test_exports(spark, series, tmp_path):
    paths = reports.export_series(series, "REF", (2024, 6), (2024, 6), str(tmp_path), ("csv", "parquet"))
    assert [Path(p).name for p in paths] == ["CMg_REF_2024-06_a_2024-06.csv", "CMg_REF_2024-06_a_2024-06_bloques.csv", "CMg_REF_2024-06_a_2024-06.parquet"]
    assert spark.read.parquet("file://" + paths[2]).count() == 288
    again = reports.export_series(series, "REF", (2024, 6), (2024, 6), str(tmp_path), ("parquet",))
    assert again[0].endswith("_v2.parquet")
    assert len(reports.export_risk(series, "REF", "COMP", (2024, 6), (2024, 6), str(tmp_path), ("csv",))) == 2
    columns, blocks = reports.write_all_buses(series, date(2024, 6, 1), date(2024, 6, 3), f"file://{tmp_path}/all.csv")
    lines = (tmp_path / "all.csv").read_bytes().decode("utf-8-sig").split("\n")
    assert columns == ["COMP", "REF"] and lines[0] == "Fecha;Hora;Minuto;Bloque;COMP;REF" and len(lines) == 290 and blocks.count() == 4
    with pytest.raises(ValueError):
        reports.export_series(series, "REF", (2024, 6), (2024, 6), str(tmp_path), ("pdf",))
    with pytest.raises(ValueError):
        reports.export_series(series, "NONE", (2024, 6), (2024, 6), str(tmp_path), ("csv",))
    assert gold.bus_exists(series, "REF") and not gold.bus_exists(series, "NONE")


def test_workbook(series, by_day, tmp_path):
    openpyxl = pytest.importorskip("openpyxl")
    book = reports.bus_book(series, "REF", date(2024, 6, 1), date(2024, 6, 1), by_day, NOW)
    assert reports.write_workbook(book, f"{tmp_path}/a.xlsx") == []
    sheet = openpyxl.load_workbook(f"{tmp_path}/a.xlsx")["CMg 15 min"]
    assert sheet["A1"].value == "Fecha" and sheet["A2"].number_format == reports.DATE and json.dumps(sheet.freeze_panes) == '"A2"'
