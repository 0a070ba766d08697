"""Exports: regional CSV, Parquet, wide CSV, workbooks, finding reports. Bounded results only go through the driver."""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from quarterlake.sources import control
from quarterlake.sources.dayfiles import opened

EXCEL_ROWS = 1_048_575
SHEET_NAME = 31
#: Bytes that a part is copied by.
COPY = 8 << 20


def comma(column: Column, digits: int = 5) -> Column:
    """Rounded half to even, with a decimal comma."""
    return F.translate(F.bround(column, digits).cast(f"decimal(38,{digits})").cast("string"), ".", ",")


def regional(df: DataFrame, digits: int = 5) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.simpleString()
        out.append((comma(c, digits) if kind in ("double", "float") else F.date_format(c, "dd-MM-yyyy") if kind == "date" else c.cast("string")).alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """``;``-separated text with decimal commas, as a directory of part files, each with a header."""
    regional(df).write.mode("append" if append else "overwrite").option("sep", ";").option("header", True).option("encoding", "UTF-8").csv(path)


def _cell(f: StructField, digits: int) -> Column:
    """A value as text of a wide file: prices of at most so many decimals with a comma, days and times as spreadsheets of the region read them."""
    c, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
    if kind in ("double", "float"):
        fixed = F.bround(c.try_cast(f"decimal(38,{digits})"), digits).cast("string")
        text = F.translate(F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1"), ".", ",")
    elif kind == "date":
        text = F.date_format(c, "dd-MM-yyyy")
    elif kind.startswith("timestamp"):
        text = F.date_format(c, "dd-MM-yyyy HH:mm")
    else:
        text = c.cast("string")
    return F.coalesce(quoted(text), F.lit(""))


def quoted(text: Column) -> Column:
    return F.when(text.rlike('[;"\\n\\r]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)


def write_one_csv(df: DataFrame, path: str, order: Sequence[str], headers: dict[str, str] | None = None, digits: int = 5) -> int:
    """One ``;``-separated file in an order, with one header and a byte-order mark; returns its bytes. Rows are sorted by ranges and written as
    parts by their tasks; then the parts become one file without passing the driver: on a shared disk each is copied to its own place at
    once, elsewhere one task passes them through in small pieces. The file appears when it is whole."""
    spark, parts, aside = df.sparkSession, f"{path}.partes-{uuid.uuid4().hex}", f"{path}.tmp"
    line = F.array_join(F.array(*[_cell(f, digits) for f in df.schema.fields]), ";")
    df.orderBy(*order).select(line.alias("value")).write.option("compression", "none").text(parts)
    head = "\ufeff" + ";".join(_quote((headers or {}).get(c, c)) for c in df.columns) + "\n"
    fs, folder = control.file_system(spark, parts)
    held = sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    pieces, at = [], len(head.encode("utf-8"))
    for name, size in held:
        pieces.append((f"{parts}/{name}", at))
        at += size
    if fs.getScheme() == "file":
        joined = _placed(spark, pieces, head, aside, at)
    else:
        joined = _passed_through(spark, [p for p, _ in pieces], head, aside)
    if joined != at:
        raise OSError(f"{path}: {joined} of {at} bytes were written")
    fs.delete(folder, True)
    control.replace(spark, aside, path)
    return at


def _quote(text: str) -> str:
    return '"' + text.replace('"', '""') + '"' if set(text) & set(';"\n\r') else text


def _placed(spark: SparkSession, pieces: list[tuple[str, int]], head: str, aside: str, size: int) -> int:
    """Each part to its place in a file of the final size, a task each."""
    target = local_path(aside)
    with open(target, "wb") as out:
        out.write(head.encode("utf-8"))
        out.truncate(size)

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            done = 0
            for part, at in zip(pdf["part"], pdf["at"], strict=True):
                with open(local_path(part), "rb") as f, open(target, "r+b") as out:
                    out.seek(at)
                    while chunk := f.read(COPY):
                        out.write(chunk)
                        done += len(chunk)
            yield pd.DataFrame({"n": [done]})

    if not pieces:
        return size
    each = spark.createDataFrame(pieces, "part string, at long").repartition(len(pieces), "part")
    return len(head.encode("utf-8")) + each.mapInPandas(run, "n long").agg(F.sum("n")).first()[0]


def _passed_through(spark: SparkSession, parts: list[str], head: str, aside: str) -> int:
    """All parts through one task, a piece of COPY bytes at a time."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for target in pdf["target"]:
                where, p = opened(target)
                with where.open_output_stream(p) as out:
                    out.write(head.encode("utf-8"))
                    done = len(head.encode("utf-8"))
                    for part in parts:
                        source, q = opened(part)
                        with source.open_input_stream(q) as f:
                            while chunk := f.read(COPY):
                                out.write(chunk)
                                done += len(chunk)
                yield pd.DataFrame({"n": [done]})

    return spark.createDataFrame([(aside,)], "target string").mapInPandas(run, "n long").first()[0]


def local_path(path: str) -> str:
    return re.sub(r"^file:/*", "/", path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_excel(sheets: dict[str, DataFrame], path: str) -> list[str]:
    """Sheets of at most EXCEL_ROWS rows in one workbook; the names of those left out come back, and stand in a sheet of notes."""
    import openpyxl

    book = openpyxl.Workbook(write_only=True)
    left_out = []
    for name, df in sheets.items():
        rows = df.limit(EXCEL_ROWS + 1).collect()
        if len(rows) > EXCEL_ROWS:
            left_out.append(name)
            continue
        sheet = book.create_sheet(name[:SHEET_NAME])
        sheet.append(df.columns)
        for r in rows:
            sheet.append(list(r))
    if left_out:
        sheet = book.create_sheet("notas")
        sheet.append(["hojas omitidas por tamano"])
        for name in left_out:
            sheet.append([name])
    book.save(path)
    return left_out


def sheets_by_year(df: DataFrame, years: list[int]) -> dict[str, DataFrame]:
    return {str(y): df.where(F.year("fecha") == y) for y in years}


def unique_name(path: str) -> str:
    """The name itself, or with _v2, _v3 ... so that nothing is overwritten."""
    stem, ext = os.path.splitext(path)
    n, out = 1, path
    while os.path.exists(out):
        n += 1
        out = f"{stem}_v{n}{ext}"
    return out


#: Severities in the order of a report, and what each asks for.
SEVERITIES = {"critico": "do not ingest the files concerned", "advertencia": "ingest, and look at it", "info": "known, or taken on already"}


def write_findings(grouped: DataFrame, folder: str, title: str = "Hallazgos") -> str | None:
    """Grouped findings (a bounded number) as JSON and Markdown, a section a severity with its number of findings; returns the Markdown. Without
    findings nothing is written."""
    rows = [r.asDict() for r in grouped.collect()]
    if not rows:
        return None
    by = {s: sorted((r for r in rows if r["severidad"] == s), key=lambda r: (r["tipo"], r["detalle"] or "")) for s in (*SEVERITIES, *sorted({r["severidad"] for r in rows} - set(SEVERITIES)))}
    many = {s: sum(r["veces"] for r in held) for s, held in by.items()}
    lines = [f"# {title}", "", ", ".join(f"{n} {s}" for s, n in many.items()), ""]
    for severity, held in by.items():
        if held:
            lines += [f"## {severity} ({many[severity]})", "", *([SEVERITIES[severity], ""] if severity in SEVERITIES else [])]
            lines += [f"- {r['tipo']}: {r['detalle']} ({r['veces']})" + (f" -> {r['accion']}" if r.get("accion") else "") for r in held] + [""]
    text = "\n".join(lines)
    os.makedirs(folder, exist_ok=True)
    for name, body in (("hallazgos.json", json.dumps(rows, ensure_ascii=False, indent=1, default=str)), ("hallazgos.md", text)):
        with open(f"{folder}/{name}.tmp", "w", encoding="utf-8") as f:
            f.write(body)
        os.replace(f"{folder}/{name}.tmp", f"{folder}/{name}")
    return text
