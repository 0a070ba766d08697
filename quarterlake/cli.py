"""A thin command line: python -m quarterlake.cli COMMAND BASE ..."""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from quarterlake.functions import search
from quarterlake.functions.calendar import calendar
from quarterlake.functions.domain import format_month, parse_period
from quarterlake.operators import gold, quality, versions
from quarterlake.sources import control, silver
from quarterlake.workflows import ingest, publishing, reports, sync, watch

OK, FAILED, USAGE, LOOK = 0, 1, 2, 3
WORKFLOWS = (("ingerir-pagina", ("carpeta",)), ("publicar", ("servicio",)), ("migrar-historico", ("historia",)), ("exportar-cmg", ("barra", "carpeta")), ("exportar-riesgo", ("referencia", "comparada", "carpeta")))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="quarterlake")
    sub = p.add_subparsers(dest="command", required=True)
    for name, extra in (("estado", ()), ("barras", ("texto",)), ("buscar", ("texto",)), ("bloques", ("barra",)), ("riesgo", ("referencia", "comparada")), ("revisar", ()), ("vigilar", ("paginas", "registro")), *WORKFLOWS):
        c = sub.add_parser(name)
        c.add_argument("base")
        for e in extra:
            c.add_argument(e)
        c.add_argument("--periodo", default="")
        c.add_argument("--formatos", default="csv")
        c.add_argument("--forzar", action="store_true")
        c.add_argument("--bronze", default=None, help="folder of the day files, whose documents are published with their days")
    try:
        a = p.parse_args(argv)
    except SystemExit as e:
        return OK if e.code == 0 else USAGE
    spark = spark or SparkSession.builder.appName("quarterlake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command in ("ingerir-pagina", "publicar", "migrar-historico"):
        return _write(spark, a)
    try:
        first, last = parse_period(a.periodo, *silver.available_range(spark, a.base))
    except ValueError as e:
        print(e)
        return FAILED
    series = silver.scan(spark, a.base)
    if a.command == "estado":
        print(f"{format_month(first)} .. {format_month(last)}")
        gold.base_summary(series).show()
        print("\n".join(_coverage(spark, a.bronze, series)))
    elif a.command == "vigilar":
        found = sync.watch_source(spark, a.paginas, a.registro, a.bronze or a.registro, series, *_span(series))
        print("\n".join([*found["lines"], f"documentos: {found['documents']}, por descargar: {len(found['new'])}", *found["new"][:40]]))
        return LOOK if found["findings"] or found["new"] else OK
    elif a.command == "barras":
        gold.find_buses(series, a.texto).show(40, False)
    elif a.command == "buscar":
        search.search(series, a.texto).show(10, False)
    elif a.command == "bloques":
        gold.monthly_summary(series, a.barra, first, last).show(1200, False)
    elif a.command.startswith("exportar-"):
        formats = reports.read_formats(a.formatos)
        if formats is None:
            print(f"formatos: {', '.join(reports.FORMATS)}")
            return USAGE
        try:
            paths = reports.export_series(series, a.barra, first, last, a.carpeta, formats) if a.command == "exportar-cmg" else reports.export_risk(series, a.referencia, a.comparada, first, last, a.carpeta, formats)
        except ValueError as e:
            print(e)
            return FAILED
        print("\n".join(paths))
    elif a.command == "riesgo":
        gold.risk_summary(series, a.referencia, a.comparada, first, last).show(4000, False)
        gold.without_percentage(series, a.referencia, first, last).show()
    else:
        held = gold.in_period(series, first, last)
        lo, hi = held.selectExpr("min(fecha)", "max(fecha)").first()
        found = quality.summary(held, calendar(spark, lo, hi))
        print("\n".join(f"{k}: {v}" for k, v in found.items()))
        return LOOK if quality.has_problems(found) else OK
    return OK


def _span(series: DataFrame) -> tuple[date, date]:
    return tuple(series.selectExpr("min(fecha)", "max(fecha)").first())


def _coverage(spark: SparkSession, folder: str | None, series: DataFrame) -> list[str]:
    """Expected days against those of the series, and the missing ones by cause."""
    first, last = _span(series)
    manifest = control.read_manifest(spark, folder) if folder else spark.createDataFrame([], control.MANIFEST)
    return watch.status_lines(versions.coverage(series, manifest, first, last), watch.missing_by_cause(series, manifest, first, last), first, last)


def _write(spark: SparkSession, a: argparse.Namespace) -> int:
    """Commands that change the series or the serving tables; days left out ask to be looked at."""
    now = datetime.now()
    try:
        if a.command == "ingerir-pagina":
            rows, findings = ingest.ingest(spark, a.carpeta, a.base, now, force=a.forzar)
            print("\n".join(f"{r['anio']}-{r['mes']:02d}: {r['filas_escritas']} filas, {r['dias']} dias, omitidos: {'; '.join(r['omitidos']) or 'ninguno'}" for r in rows) or "sin cambios")
            return LOOK if any(r["omitidos"] for r in rows) or any(f["severidad"] == "critico" for f in findings) else OK
        rows = publishing.publish_changed(spark, a.base, a.servicio, now, a.bronze, force=a.forzar) if a.command == "publicar" else silver.migrate_history(spark, a.historia, a.base)
    except ValueError as e:
        print(e)
        return FAILED
    print("\n".join(" ".join(f"{k}={v}" for k, v in r.items()) for r in rows) or "sin cambios")
    return OK


if __name__ == "__main__":
    raise SystemExit(main())
