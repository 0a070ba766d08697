"""Reports and exports as named sheets of DataFrames, with readable headers, number formats and a sheet that explains the file; written as
workbook, text or Parquet."""

from __future__ import annotations

import os
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.functions.domain import Month, check_range, format_month, month_tranches
from quarterlake.functions.names import safe_name
from quarterlake.operators import gold, report

# Headers of the reports' columns by their names in the tables.
HEADERS = {
    "fecha": "Fecha",
    "hora": "Hora",
    "minuto": "Minuto",
    "fecha_hora": "Fecha y hora",
    "bloque": "Bloque",
    "cmg_usd_mwh": "CMg [USD/MWh]",
    "es_hora_extra": "Hora extra (abril)",
    "barra": "Barra",
    "origen": "Origen",
    "version": "Version",
    "usd_clp": "Tipo de cambio [CLP/USD]",
    "publicado": "Publicado",
    "cargado": "Cargado en la base",
    "periodo": "Periodo",
    "desde": "Desde",
    "hasta": "Hasta",
    "cuartos": "Cuartos de hora",
    "A": "A [USD/MWh]",
    "B": "B [USD/MWh]",
    "C": "C [USD/MWh]",
    "Solar": "Solar [USD/MWh]",
    "NoSolar": "NoSolar [USD/MWh]",
    "Total": "Total [USD/MWh]",
    "promedio": "Promedio [USD/MWh]",
    "desviacion": "Desv. estandar [USD/MWh]",
    "minimo": "Minimo [USD/MWh]",
    "maximo": "Maximo [USD/MWh]",
    "en_cero": "Cuartos en cero",
    "cmg_referencia": "CMg referencia [USD/MWh]",
    "cmg_comparada": "CMg comparada [USD/MWh]",
    "riesgo_usd_mwh": "Riesgo [USD/MWh]",
    "riesgo_pct": "Riesgo [%]",
    "riesgo_minimo": "Riesgo minimo [USD/MWh]",
    "riesgo_maximo": "Riesgo maximo [USD/MWh]",
    "ref_en_cero": "Cuartos con referencia en cero",
    "antes": "Antes",
    "despues": "Despues",
    "documento": "Documento del Coordinador",
    "detectado": "Detectado",
    "cuartos_distintos": "Cuartos que cambiaron",
    "dif_max_usd": "Cambio maximo [USD/MWh]",
    "dif_prom_usd": "Cambio promedio [USD/MWh]",
}
# What origins are called.
ORIGIN_WORDS = {"pagina_cen_def": "Definitivo", "pagina_cen_pre": "Preliminar", "maestro_cmg_db": "Maestro (historico)"}
# Number formats.
DATE, DATE_TIME, PRICE, WHOLE, SHARE = "dd-mm-yyyy", "dd-mm-yyyy hh:mm", "#,##0.00", "#,##0", "0.00%"
DATES = ("Fecha", "Desde", "Hasta", "Detectado", "Publicado", "Cargado en la base")
FORMATS = ("excel", "csv", "parquet")
ALIASES = {"1": "excel", "xlsx": "excel", "2": "csv", "3": "parquet"} | {f: f for f in FORMATS}
#: Cells of a wide sheet beyond which a workbook is no use; text has no such limit.
WORKBOOK_CELLS = 2_000_000
# What an info sheet says of a series, and how it is counted.
FACTS = {
    "Dias con datos": "count(DISTINCT fecha)",
    "Cuartos de hora": "count(1)",
    "CMg promedio [USD/MWh]": "round(avg(cmg_usd_mwh), 2)",
    "CMg minimo [USD/MWh]": "round(min(cmg_usd_mwh), 2)",
    "CMg maximo [USD/MWh]": "round(max(cmg_usd_mwh), 2)",
    "Cuartos en cero": "count_if(cmg_usd_mwh = 0)",
}
# What an info sheet says of the blocks.
BLOCKS = {"Bloques": "A: 23:00 a 07:59 | B: 08:00 a 17:59 | C: 18:00 a 22:59", "Solar": "promedio del bloque B", "NoSolar": "promedio de los cuartos de A y C juntos"}

Book = dict[str, DataFrame]


def read_formats(text: str) -> tuple[str, ...] | None:
    """'1,3' or 'excel csv' or 'todos': formats in their own order; none where a word is unknown or nothing is said."""
    words = text.lower().replace(";", " ").replace(",", " ").split()
    said = {f for w in words for f in (FORMATS if w == "todos" else (ALIASES.get(w),))}
    return None if None in said or not said else tuple(f for f in FORMATS if f in said)


def number_format(header: str) -> str | None:
    if header in DATES:
        return DATE
    if header == "Fecha y hora":
        return DATE_TIME
    if header == HEADERS["riesgo_pct"]:
        return SHARE
    if header.endswith(("[USD/MWh]", "[CLP/USD]")):
        return PRICE
    return WHOLE if header.startswith("Cuartos") else None


def readable(df: DataFrame) -> DataFrame:
    """Headers and origins in words; values stay."""
    words = F.create_map(*(F.lit(x) for pair in ORIGIN_WORDS.items() for x in pair))
    out = df.withColumns({c: F.coalesce(F.try_element_at(words, F.col(c)), F.col(c), F.lit("") if c != "origen" else F.lit(None)) for c in ("origen", "antes", "despues") if c in df.columns})
    return out.withColumnsRenamed({c: HEADERS[c] for c in df.columns if c in HEADERS})


#: How a kind of value is written in an info sheet; the first kind that fits counts (a time is a day, too).
WRITTEN = ((datetime, "{:%d-%m-%Y %H:%M}"), (date, "{:%d-%m-%Y}"), (object, "{}"))


def info_sheet(spark: SparkSession, facts: dict[str, object]) -> DataFrame:
    """Two columns that explain the file."""
    rows = [(name, next(how for kind, how in WRITTEN if isinstance(value, kind)).format(value)) for name, value in facts.items()]
    return spark.createDataFrame(rows, "Concepto string, Valor string")


def _facts(series: DataFrame) -> dict[str, object]:
    """What an info sheet says of a series; an empty one is an error."""
    found = series.selectExpr(*(f"{how} AS `{name}`" for name, how in FACTS.items())).first().asDict()
    if not found["Cuartos de hora"]:
        raise ValueError("no rows in that range")
    return found


def _between(series: DataFrame, first: date, last: date) -> DataFrame:
    """Days, and the month partitions that hold them."""
    months = (F.col("anio") * 100 + F.col("mes")).between(first.year * 100 + first.month, last.year * 100 + last.month)
    return series.where(months & F.col("fecha").between(F.lit(first), F.lit(last)))


def _by_day(versions: DataFrame, revisions: DataFrame | None) -> Book:
    return {"Version por dia": versions.orderBy("fecha")} | ({} if revisions is None else {"Revisiones": revisions})


def bus_book(series: DataFrame, bus: str, first: date, last: date, versions: DataFrame, now: datetime, have: tuple[date, date] | None = None, revisions: DataFrame | None = None) -> Book:
    """One bus: quarters with the version and rate of their day, block averages, statistics."""
    check_range(first, last, have)
    held = _between(series, first, last)
    mine = held.where(F.col("barra") == bus)
    facts = {"Barra": bus, "Desde": first, "Hasta": last} | _facts(mine) | BLOCKS | {"Generado": now}
    quarters = mine.select("fecha", "hora", "minuto", "fecha_hora", "bloque", "cmg_usd_mwh", "es_hora_extra").join(F.broadcast(versions), "fecha", "left").orderBy("fecha", "hora", "minuto")
    return {"CMg 15 min": quarters, "Bloques": gold.range_blocks(held, bus, first, last), "Estadisticas": gold.range_statistics(held, bus, first, last), **_by_day(versions, revisions), "Info": info_sheet(series.sparkSession, facts)}


def buses_book(series: DataFrame, buses: list[str], first: date, last: date, versions: DataFrame, now: datetime, have: tuple[date, date] | None = None, revisions: DataFrame | None = None) -> Book:
    """Several buses: one column each, and block averages."""
    if len(set(buses)) < 2:
        raise ValueError("two buses at least")
    check_range(first, last, have)
    days = (last - first).days + 1
    if days * 96 * len(set(buses)) > WORKBOOK_CELLS:
        raise ValueError(f"{len(set(buses))} buses over {days} days are too many cells for a workbook; write all buses as text")
    held, order = _between(series, first, last), sorted(set(buses))
    found = {r["barra"] for r in held.where(F.col("barra").isin(order)).select("barra").distinct().collect()}
    if not found:
        raise ValueError("no rows in that range")
    facts = {"Barras": ", ".join(order), "Desde": first, "Hasta": last, "Barras sin datos en el rango": ", ".join(b for b in order if b not in found) or "ninguna"} | BLOCKS | {"Generado": now}
    return {"CMg 15 min": gold.wide_series(held, order, first, last), "Bloques": gold.range_blocks_many(held, order, first, last), **_by_day(versions, revisions), "Info": info_sheet(series.sparkSession, facts)}


def write_all_buses(series: DataFrame, first: date, last: date, path: str, have: tuple[date, date] | None = None) -> tuple[list[str], DataFrame]:
    """All buses as one wide text file, and their block averages. Returns the columns and the averages."""
    check_range(first, last, have)
    held = _between(series, first, last)
    columns = [r["barra"] for r in held.select("barra").distinct().orderBy("barra").collect()]  # a few thousand names
    if not columns:
        raise ValueError("no rows in that range")
    report.write_one_csv(gold.wide_series(held, columns, first, last), path, gold.ORDER, HEADERS)
    return columns, gold.range_blocks_many(held, None, first, last)


def range_risk_series(series: DataFrame, reference: str, compared: str, first: date | None = None, last: date | None = None, versions: DataFrame | None = None) -> DataFrame:
    """Risk by quarter over a range of days, or without one over all days, with the version and the rate of each day. Unknown quarters meet nothing."""
    held = series if first is None and last is None else _between(series, first, last)
    out = gold.risk_series(held.dropna(subset=gold.ORDER), reference, compared)
    return out if versions is None else out.drop("version", "usd_clp").join(F.broadcast(versions), "fecha", "left").orderBy("fecha", "hora", "minuto")


def risk_book(series: DataFrame, reference: str, compared: str, first: date, last: date, versions: DataFrame, now: datetime, have: tuple[date, date] | None = None, revisions: DataFrame | None = None) -> Book:
    """Risk between two buses, by quarter, and by month and block."""
    if reference == compared:
        raise ValueError("the two buses are the same")
    check_range(first, last, have)
    quarters = range_risk_series(series, reference, compared, first, last, versions)
    risk: Column = F.col("riesgo_usd_mwh")
    r = quarters.agg(F.count(F.lit(1)).alias("n"), F.avg(risk).alias("m"), F.min(risk).alias("a"), F.max(risk).alias("z"), F.count_if(F.col("cmg_referencia") == 0).alias("c")).first()
    if not r["n"]:
        raise ValueError(f"{reference} and {compared} share no quarter in that range")
    facts = {"Referencia": reference, "Comparada": compared, "Formula": "riesgo = CMg(comparada) - CMg(referencia)", "Desde": first, "Hasta": last, "Cuartos en comun": r["n"], "Riesgo promedio [USD/MWh]": round(r["m"], 2), "Riesgo minimo [USD/MWh]": round(r["a"], 2), "Riesgo maximo [USD/MWh]": round(r["z"], 2), "Cuartos con referencia en cero": r["c"], "Generado": now}
    return {"Riesgo 15 min": quarters, "Resumen": gold.range_risk_summary(_between(series, first, last), reference, compared, first, last), **_by_day(versions, revisions), "Info": info_sheet(series.sparkSession, facts)}


def write_workbook(book: Book, path: str) -> list[str]:
    """Sheets with rows, with readable headers in bold, number formats and widths; rows stream through the driver, a sheet at a time.
    Names of sheets that are too long for a workbook come back."""
    import openpyxl
    from openpyxl.cell import WriteOnlyCell
    from openpyxl.styles import Font

    out, left_out = openpyxl.Workbook(write_only=True), []
    for name, df in book.items():
        n = df.limit(report.EXCEL_ROWS + 1).count()
        if n > report.EXCEL_ROWS:
            left_out.append(name)
        if not 0 < n <= report.EXCEL_ROWS:
            continue
        held = readable(df)
        sheet = out.create_sheet(name[: report.SHEET_NAME])
        sheet.freeze_panes = "A2"
        heads = []
        for h in held.columns:
            cell = WriteOnlyCell(sheet, value=h)
            cell.font = Font(bold=True)
            heads.append(cell)
        sheet.append(heads)
        formats = [number_format(h) for h in held.columns]
        for row in held.toLocalIterator():
            cells = [WriteOnlyCell(sheet, value=v) for v in row]
            for cell, f in zip(cells, formats, strict=True):
                if f:
                    cell.number_format = f
            sheet.append(cells)
    out.save(path)
    return left_out


def export(book: Book, main: str, summary: str, folder: str, name: str, formats: tuple[str, ...], split: Book | None = None) -> list[str]:
    """A book in the formats asked for, under names that are not taken; returns the paths. A workbook has the sheets of ``split`` in place
    of the main one."""
    if not formats or set(formats) - set(FORMATS):
        raise ValueError(f"formats: {', '.join(FORMATS)}")
    stem, out = f"{folder}/{safe_name(name)}", []
    os.makedirs(folder, exist_ok=True)
    if "excel" in formats:
        out.append(report.unique_name(stem + ".xlsx"))
        write_workbook((split or {main: book[main]}) | {k: v for k, v in book.items() if k != main}, out[-1])
    if "csv" in formats:
        for sheet, path in ((main, stem + ".csv"), (summary, f"{stem}_{safe_name(summary).lower()}.csv")):
            out.append(report.unique_name(path))
            report.write_csv(book[sheet], "file://" + out[-1])
    if "parquet" in formats:
        out.append(report.unique_name(stem + ".parquet"))
        report.write_parquet(book[main], "file://" + out[-1])
    return out


def export_series(series: DataFrame, bus: str, first: Month, last: Month, folder: str, formats: tuple[str, ...] = ("excel",)) -> list[str]:
    """A bus's quarters over months (a sheet a year), block averages, and an info sheet."""
    held = gold.series_of(series, bus, first, last)
    facts = {"barra": bus, "periodo": f"{format_month(first)} a {format_month(last)}"} | _facts(held) | BLOCKS
    years = report.sheets_by_year(held, list(range(first[0], last[0] + 1))) if "excel" in formats else {}
    book = {"serie": held, "Bloques": gold.monthly_summary(series, bus, first, last), "Info": info_sheet(series.sparkSession, facts)}
    return export(book, "serie", "Bloques", folder, f"CMg_{bus}_{format_month(first)}_a_{format_month(last)}", formats, years)


def export_risk(series: DataFrame, reference: str, compared: str, first: Month, last: Month, folder: str, formats: tuple[str, ...] = ("excel",)) -> list[str]:
    """Risk by quarter over months, its summary, and an info sheet."""
    held = gold.risk_series(series, reference, compared, first, last)
    if held.isEmpty():
        raise ValueError(f"{reference} and {compared} share no quarter in that range")
    zero, total = gold.without_percentage(series, reference, first, last).first()
    facts = {"referencia": reference, "comparada": compared, "periodo": f"{format_month(first)} a {format_month(last)}", "referencia_en_cero": f"{zero} de {total}"}
    book = {"serie": held, "Resumen": gold.risk_summary(series, reference, compared, first, last), "Info": info_sheet(series.sparkSession, facts)}
    return export(book, "serie", "Resumen", folder, f"Riesgo_{reference}_vs_{compared}_{format_month(first)}_a_{format_month(last)}", formats)
