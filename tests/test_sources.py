import io
import tracemalloc
import zipfile
from datetime import date, datetime

import pyarrow as pa
import pytest
from helpers import month
from pyspark.sql import functions as F

from quarterlake.operators import publish, report
from quarterlake.schema import SERIES, conform, domain_violations
from quarterlake.sources import bronze, silver
from quarterlake.streaming import ingest

HEAD = "FECHA;HORA;MINUTO;BARRA;INFO_BARRA_ID;CMG_EN_LINEA[USD/MWh];CMG_REAL_PRE[USD/MWh];CMG_REAL_DEF[USD/MWh];USD;MODIFICADO"


def _zip(path, rows, head=HEAD, member="x/CmgBarrasComparativo_20250907_20250907_15_NUEVO.csv", tail=";;;;\n"):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("otro.csv", "a;b\n")
        z.writestr(member, "﻿" + head + "\n" + "".join(r + "\n" for r in rows) + tail)


def test_month_write_scan_and_replace(spark, tmp_path):
    base = f"file://{tmp_path}/silver"
    assert silver.written_months(spark, base) == [] and silver.month_rows(spark, base, (2024, 6)) == 0
    assert silver.write_month(month(spark).drop("usd_clp"), base, (2024, 6)) == 96
    assert silver.write_month(month(spark, 2024, 7), base, (2024, 7)) == 96
    assert silver.write_month(month(spark, days=2), base, (2024, 6)) == 192
    assert silver.written_months(spark, base) == [(2024, 6), (2024, 7)] == list(silver.available_range(spark, base))
    got = silver.scan(spark, base)
    assert silver.month_rows(spark, base, (2024, 6)) == 192 and got.where("usd_clp IS NOT NULL").count() == 0
    assert dict(got.dtypes)["fecha_hora"] == "timestamp_ntz"
    plan = got.where(silver.period_filter((2024, 6), (2024, 6)))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan
    with pytest.raises(Exception, match="outside"):
        silver.write_month(month(spark, 2024, 8), base, (2024, 6))
    assert silver.month_rows(spark, base, (2024, 6)) == 192
    with pytest.raises(ValueError, match="missing"):
        silver.write_month(month(spark).drop("hora"), base, (2024, 6))


def test_crash_recovery(spark, tmp_path):
    base = f"file://{tmp_path}/silver"
    silver.write_month(month(spark), base, (2024, 6))
    d = tmp_path / "silver/anio=2024"
    work = d.parent / "_work"
    work.mkdir(exist_ok=True)
    (d / "mes=6").rename(work / "2024-6__old")
    (work / "2024-6__tmp").mkdir()
    (work / "2024-7__tmp").mkdir()
    assert silver.recover(spark, base, (2024, 5)) == []
    assert len(silver.recover(spark, base)) == 3
    assert silver.month_rows(spark, base, (2024, 6)) == 96 and not list(work.iterdir())


def test_dynamic_overwrite(spark, tmp_path):
    base = f"file://{tmp_path}/silver"
    silver.write_months(month(spark).unionByName(month(spark, 2024, 7)), base)
    silver.write_months(month(spark, 2024, 7, days=2), base)
    assert silver.month_rows(spark, base, (2024, 6)) == 96 and silver.month_rows(spark, base, (2024, 7)) == 192


def test_history(spark, tmp_path):
    src, base = f"file://{tmp_path}/old", f"file://{tmp_path}/new"
    old = spark.createDataFrame([("REÑACA________110", date(2021, 4, 3), 24, 0, "A", 49.10532, None), ("X", date(2021, 4, 3), 9, 15, "A", 1.0, None)], "barra string, fecha date, hora smallint, minuto smallint, bloque string, cmg_usd_mwh float, fecha_hora timestamp_ntz")
    old.write.parquet(f"{src}/anio=2021/mes=4")
    old.write.parquet(f"{src}/anio=2024/mes=8")
    assert [r["filas"] for r in silver.migrate_history(spark, src, base)] == [2]
    a, b = silver.scan(spark, base).orderBy("barra").collect()
    assert (a.barra, a.bloque, a.es_hora_extra, a.fecha_hora, a.cmg_usd_mwh) == ("RENACA________110", "A", True, None, 49.10531997680664)
    assert (b.bloque, b.fecha_hora) == ("B", datetime(2021, 4, 3, 9, 15))


def test_zip_to_series(spark, tmp_path):
    rows = ["20250907;0;0;CAÑETE________023;1;9;8;7;950,5;", "20250907;1;15;CAÑETE________023;1;9;8,5;7,25;950,5;", "20250907;24;0;;1;9;8;7;x;"]
    _zip(tmp_path / "a.zip", rows)
    zips = bronze.zip_files(spark, f"file://{tmp_path}")
    raw = bronze.comparativo_rows(zips, "def")
    assert raw.count() == 3
    got = bronze.to_series(raw, "def").orderBy("hora").collect()
    assert [(r.barra, r.hora, r.cmg_usd_mwh, r.usd_clp, r.es_hora_extra) for r in got] == [("CANETE________023", 1, 7.25, 950.5, False), (None, 24, 7.0, None, True)]
    assert [r.cmg_usd_mwh for r in bronze.to_series(bronze.comparativo_rows(zips, "pre"), "pre").orderBy("hora").collect()] == [8.5, 8.0]
    f = bronze.fingerprints(zips).first()
    assert f.nombre == "a.zip" and f.sha256 == ingest.sha256_bytes((tmp_path / "a.zip").read_bytes())


def test_zip_findings_and_dialects(spark, tmp_path):
    _zip(tmp_path / "good.zip", [])
    _zip(tmp_path / "none.zip", [], member="otro/cosa.csv")
    _zip(tmp_path / "new.zip", [], head=HEAD + ";EXTRA")
    (tmp_path / "broken.zip").write_bytes(b"no zip")
    got = {(r.archivo.rsplit("/", 1)[-1], r.tipo) for r in bronze.zip_findings(bronze.zip_files(spark, f"file://{tmp_path}"), HEAD.split(";")).collect()}
    assert got == {("none.zip", "sin_comparativo"), ("new.zip", "columnas_nuevas"), ("broken.zip", "zip_corrupto")}
    assert bronze.price_column(["CMgP[mills/kWh]", "CMgR[mills/kWh]"], "def") == "CMgR[mills/kWh]"
    for header in (["CMG_REAL_DEF[USD/MWh]", "CMG_REAL_DEF v2[USD/MWh]"], ["CMG_REAL_DEF v2[USD/MWh]", "CMG_REAL_DEF[USD/MWh]"], ["CMG_REAL_DEF[USD/MWh]", "CMG_REAL_DEF_v2[USD/MWh]"]):
        assert bronze.price_column(["CMG_REAL_PRE v2[USD/MWh]", *header, "CMG_REAL_DEF[USD/MWh] old"], "def") == header[-1]
    with pytest.raises(ValueError):
        bronze.price_column(["A"], "def")


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "latin-1"])
def test_members_are_streamed_by_their_encoding(encoding):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("x/CmgBarrasComparativo_20250907_20250907_15.csv", "BARRA;FECHA\r\nCAÑETE;1\r\n;;\r\n \n;2".encode(encoding))
    with zipfile.ZipFile(raw) as z:
        lines = bronze.MemberLines(z, bronze.find_member(z))
        assert lines.header == ["BARRA", "FECHA"] and list(lines) == [(2, ["CAÑETE", "1"]), (5, ["", "2"])] and lines.empty == 2


def _peak(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_blocks_text_is_held_once_however_many_links_it_has():
    html = "<div>" + "palabra " * 25_000 + "".join(f"<a href='/{i}'>z</a>" for i in range(500)) + "</div>"
    found, peak = _peak(lambda: bronze.page_links(html))
    assert [href for href, _, _ in found] == [f"/{i}" for i in range(500)]
    assert {len(text) for _, _, text in found} == {8 * 25_000 + 2 * 500 - 1}
    assert peak < 20_000_000


def test_pages_leave_python_in_pieces_of_bounded_size(spark):
    html = "<div>fuera<div>" + "palabra " * 5_000 + "<a href='/a'>z</a><a href='/b'>z</a></div><a href='/c'>z</a><a href='/a'>z</a></div>"
    batch = pa.RecordBatch.from_pydict({"k": list(range(300)), "h": [html] * 300})
    sizes, peak = _peak(lambda: [(p.num_rows, p.nbytes) for p in bronze.block_pieces([batch], "page_id")])
    assert sum(n for n, _ in sizes) == 600 and max(b for _, b in sizes) < 2_000_000
    assert peak < 10_000_000
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>nada</p>")], "page_id long, html string")
    got = bronze.links(pages, "page_id").orderBy("n").collect()
    assert [(r.page_id, r.n, r.href, r.titulo, r.texto) for r in got] == [(1, i, *link) for i, link in enumerate(bronze.page_links(html))]
    assert [(r.href, len(r.texto)) for r in got] == [("/a", 40_003), ("/b", 40_003), ("/c", 40_013)]


def test_open_divs_end_where_the_next_open_one_starts():
    html = "<a href=r>r</a><div>a<a href=1>1</a><div>b</div>c<div>d<a href=2>2</a><div>e<a href=3>3</a></div>f"
    assert bronze.page_links(html) == [("r", "", "r"), ("1", "", "a 1 b c"), ("2", "", "d 2 e 3 f"), ("3", "", "e 3")]


def test_pages_and_sitemaps(spark):
    block = lambda title, name, day: f'<div style="x"><span class="informes-estudio-Titulo" title="{title}">t</span><span class="documentos-Publicar-Fecha"></span>Fecha de publicación: {day}<a href="/wp-content/uploads/{name}">ZIP</a></div>'
    html = "<div>" + block("Costo Marginal Real Definitivo v2", "Antecedentes_CMG_Real_def_250302_v2.zip", "05/04/2025") + block("Real Preliminar", "Antecedentes_CMG_Real_pre_250302.zip", "06/03/2025") + '<a href="/wp-content/uploads/otro.zip">o</a></div>'
    got = bronze.documents_of_pages(spark.createDataFrame([(date(2025, 3, 2), html), (date(2025, 3, 3), ""), (date(2025, 3, 4), None)], "dia date, html string"), "https://x").orderBy("tipo").collect()
    assert [(r.tipo, r.version, str(r.fecha_publicacion), r.nombre) for r in got] == [("def", 2, "2025-04-05", "Antecedentes_CMG_Real_def_250302_v2.zip"), ("pre", 1, "2025-03-06", "Antecedentes_CMG_Real_pre_250302.zip")]
    assert got[0].url.startswith("https://x/wp-content/")
    xml = "<urlset><url><loc><![CDATA[https://a/250302/]]></loc><lastmod>2026-01-02T03:04:05+00:00</lastmod></url><url><loc>https://b</loc><lastmod>never</lastmod></url></urlset>"
    e = bronze.sitemap_entries(spark.createDataFrame([(xml,)], "xml string"))
    assert [r.loc for r in e.collect()] == ["https://a/250302/"]
    assert [str(r.fecha) for r in bronze.revisions_after(e, F.lit("2026-01-01").cast("timestamp")).collect()] == ["2025-03-02"]
    assert bronze.revisions_after(e, F.lit("2026-01-02 03:04:05").cast("timestamp")).count() == 0


def test_site_maps_by_the_parser(spark):
    head = '<?xml version="1.0" encoding="UTF-8"?><?xml-stylesheet type="text/xsl" href="x.xsl"?>\n<!-- <url><loc>https://x/no</loc><lastmod>2026-01-01</lastmod></url> -->\n'
    urls = head + '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:image="http://www.google.com/schemas/sitemap-image/1.1"><url><loc><![CDATA[https://x/a?b=1&c=2]]></loc><lastmod><![CDATA[2026-10-08T12:00:00+00:00]]></lastmod><image:image><image:loc>https://x/i</image:loc></image:image></url>\n<url>\n<loc> https://x/d&amp;e </loc><!-- c --><lastmod>2026-10-07</lastmod></url><url><loc>https://x/bad</loc><lastmod>soon</lastmod></url><url><loc>https://x/none</loc></url></urlset>'
    maps = head + '<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"><sitemap><loc>https://x/m.xml</loc><lastmod>2026-10-08T01:00:00Z</lastmod></sitemap></sitemapindex>'
    pages = spark.createDataFrame([(urls,), (maps,), (None,), ("",), ("no xml",), ("<urlset/>",)], "xml string")
    got = sorted((r.loc, str(r.lastmod)) for r in bronze.sitemap_entries(pages).collect())
    assert got == [("https://x/a?b=1&c=2", "2026-10-08 12:00:00"), ("https://x/d&e", "2026-10-07 00:00:00"), ("https://x/m.xml", "2026-10-08 01:00:00")]


def test_one_bus_skips_the_row_groups_of_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(silver, "LOOKUP", silver.LOOKUP | {"parquet.block.size": "4096"})
    base = f"file://{tmp_path}/silver"
    rows = month(spark, 2024, 6, "B00")
    for i in range(1, 12):
        rows = rows.unionByName(month(spark, 2024, 6, f"B{i:02d}"))
    assert silver.write_month(rows, base, (2024, 6)) == 12 * 96 and silver.write_month(rows.where("barra < 'B02'"), base, (2024, 7 - 1)) == 192
    silver.write_month(rows, base, (2024, 6))

    def read(bus):
        df = silver.scan(spark, base).where(F.col("barra") == bus).select("barra", "cmg_usd_mwh")
        df.write.format("noop").mode("overwrite").save()
        n = df.count()
        plan = df._jdf.queryExecution().executedPlan()
        df._jdf.queryExecution().toRdd().count()
        leaves = plan.collectLeaves()
        return n, leaves.apply(0).metrics().apply("numOutputRows").value()

    all_rows = silver.scan(spark, base).count()
    assert read("B05")[0] == 96 and read("B05")[1] < all_rows / 2 and read("B05x") == (0, 0)


def test_publish(spark):
    s = month(spark, bus="B").unionByName(month(spark, bus="A"))
    known = spark.createDataFrame([(7, "B")], "barra_id int, nombre string")
    ids = publish.assign_ids(known, s.select(F.col("barra").alias("nombre")))
    assert sorted(tuple(r) for r in ids.collect()) == [(7, "B"), (8, "A")]
    facts = publish.encode(s, ids, publish.origins(spark))
    assert facts.count() == 192 and publish.serving_view(facts, ids, publish.origins(spark)).select("barra").distinct().count() == 2
    with pytest.raises(Exception, match="no number for"):
        publish.encode(s, known, publish.origins(spark)).collect()
    assert domain_violations(s).first() == (0, 0, 0, 0, 0)
    by_bus, by_block = publish.monthly_tables(s)
    assert by_bus.count() == 2 and by_block.count() == 6
    assert publish.consistent_days(s, "maestro_cmg_db").count() == 1 and publish.consistent_days(s, "x").count() == 0


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(date(2024, 6, 1), 1.234565, "a"), (None, None, None)], "fecha date, v double, t string")
    got = report.regional(df).collect()
    assert tuple(got[0])[0] == "01-06-2024" and tuple(got[0])[1].startswith("1,2345") and tuple(got[1]) == (None, None, None)
    report.write_csv(df, f"file://{tmp_path}/csv")
    report.write_parquet(df, f"file://{tmp_path}/pq")
    assert spark.read.parquet(f"file://{tmp_path}/pq").count() == 2
    p = tmp_path / "a.csv"
    p.write_text("x")
    assert report.unique_name(str(p)).endswith("a_v2.csv")


@pytest.mark.parametrize("placed", [True, False])
def test_one_file_equals_that_of_one_writer(spark, tmp_path, monkeypatch, placed):
    if not placed:
        monkeypatch.setattr(report, "_placed", lambda s, pieces, head, aside, size: report._passed_through(s, [p for p, _ in pieces], head, aside))
    monkeypatch.setattr(report, "COPY", 64)
    rows = [(date(2024, 6, 1 + i % 3), i, None if i % 7 == 0 else i / 8 + 0.000004, datetime(2024, 6, 1, i % 24, 15), None if i % 5 else 'ñ;"x"\n') for i in range(200)]
    rows += [(None, 1000, -0.00001, None, ""), (date(2024, 6, 3), 1001, 1e9, None, "a")]
    df = spark.createDataFrame(rows, "fecha date, n int, p double, t timestamp_ntz, s string").repartition(6)
    path = f"file://{tmp_path}/one.csv"
    assert report.write_one_csv(df, path, ["n"], {"p": "precio; x"}) == report.write_one_csv(df, path, ["n"], {"p": "precio; x"})

    def number(x):
        return "" if x is None else f"{x:.5f}".rstrip("0").replace(".", ",") + ("0" if f"{x:.5f}".endswith("00000") else "")

    cell = lambda s: "" if s is None else '"' + s.replace('"', '""') + '"' if set(s) & set(';"\n') else s
    lines = [";".join(("" if d is None else f"{d:%d-%m-%Y}", str(n), number(p), "" if t is None else f"{t:%d-%m-%Y %H:%M}", cell(s))) for d, n, p, t, s in sorted(rows, key=lambda r: r[1])]
    want = ('\ufefffecha;n;"precio; x";t;s\n' + "".join(x + "\n" for x in lines)).encode()
    assert (tmp_path / "one.csv").read_bytes() == want and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["one.csv"]
    report.write_one_csv(df.where("false"), path, ["n"])
    assert (tmp_path / "one.csv").read_bytes() == "\ufefffecha;n;p;t;s\n".encode()


def test_incremental_stream(spark, tmp_path):
    src, base, ck = (f"file://{tmp_path}/{x}" for x in ("src", "silver", "ck"))
    month(spark, days=2).write.parquet(f"{src}")
    ingest.ingest_available(spark, src, SERIES, base, ck)
    assert silver.month_rows(spark, base, (2024, 6)) == 192
    conform(month(spark, prices=7.0)).write.mode("append").parquet(src)
    ingest.ingest_available(spark, src, SERIES, base, ck)
    got = silver.scan(spark, base)
    assert got.count() == 192 and got.where("cmg_usd_mwh = 7").count() == 96
    ingest.ingest_available(spark, src, SERIES, base, ck)
    assert silver.scan(spark, base).count() == 192


def test_changed_months(spark):
    chosen = spark.createDataFrame([(date(2025, 3, 1), "b"), (date(2025, 3, 2), "a"), (date(2025, 4, 1), "c")], "fecha_operacion date, sha256 string")
    state = spark.createDataFrame([("2025-03", ingest.month_fingerprint(["a", "b"])), ("2025-04", ["x"])], "mes string, huella array<string>")
    assert [r.mes for r in ingest.changed_months(chosen, state).collect()] == ["2025-04"]
