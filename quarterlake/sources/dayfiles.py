"""Day files as a Spark data source: ``spark.read.format("dia_zip")`` over ZIPs with a comparison CSV.

A file is one piece of a partition and is never held: its directory is read, the member is inflated and decoded as a stream, and rows leave in
Arrow batches. The days that are asked for (by the day in the member's name) are options: members of other days are not inflated. They are no
pushed filters, as Spark 4.1 keeps a Python source's filters for later queries of the same DataFrame, which then miss rows. A schema with
some of the columns only makes those. Files are opened by Arrow's file systems, so the source reads what those reach (local disks, object stores)."""

from __future__ import annotations

import io
import json
import re
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quarterlake.sources.bronze import REQUIRED, MemberLines, find_member, price_column

FORMAT = "dia_zip"
ROWS_SCHEMA = "archivo string, dia date, linea bigint, FECHA string, HORA string, MINUTO string, BARRA string, valor string, USD string"
MEMBERS_SCHEMA = "archivo string, miembro string, dia date, codificacion string, cabecera array<string>, filas bigint, vacias bigint, error string"
#: Rows of a batch, and bytes of small files that one task reads.
ROWS, TASK_BYTES = 20_000, 64 << 20


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path on it."""
    return fs.FileSystem.from_uri(path if "://" in path else re.sub(r"^file:/*", "/", path))


def zipped(member: str, text: str) -> bytes:
    """A day file with one member."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(member, text)
    return out.getvalue()


def reachable(path: str) -> bool:
    """Whether Arrow can open the address; else files come through ``binaryFile``."""
    try:
        where, p = opened(path)
        return where.get_file_info(p).type != fs.FileType.NotFound
    except (pa.ArrowException, OSError, ValueError):
        return False


def day_of_member(member: str) -> date | None:
    """The first day in a member's name."""
    found = re.search(r"_(\d{8})_\d+_15", member)
    try:
        return datetime.strptime(found[1], "%Y%m%d").date() if found else None
    except ValueError:
        return None


@dataclass
class Files(InputPartition):
    """Some files that one task reads."""

    paths: list[str]


class DayFileReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema, self.kind, self.members = schema, options.get("tipo", "def"), options.get("modo", "filas") == "miembros"
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.task_bytes = int(options.get("maxbytes", TASK_BYTES))
        self.first, self.last = (date.fromisoformat(x) if (x := options.get(o)) else None for o in ("desde", "hasta"))

    def wanted(self, day: date | None) -> bool:
        """Whether a member of that day is asked for; one without a day in its name is, unless days are named."""
        return (self.first is None or (day is not None and day >= self.first)) and (self.last is None or (day is not None and day <= self.last))

    def partitions(self) -> list[Files]:
        found = []
        for path in self.paths:
            where, p = opened(path)
            prefix = path[: len(path) - len(p)] if path.endswith(p) else ""
            info = where.get_file_info(p)
            listed = [info] if info.type == fs.FileType.File else where.get_file_info(fs.FileSelector(p, recursive=False))
            found += [(prefix + x.path, x.size or 0) for x in listed if x.type == fs.FileType.File and (x.path.lower().endswith(".zip") or x is info)]
        out: list[Files] = []
        held = self.task_bytes
        for path, size in sorted(found):
            if held + size > self.task_bytes:
                out.append(Files([]))
                held = 0
            out[-1].paths.append(path)
            held += size
        return out

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        for path in partition.paths:
            where, p = opened(path)
            with where.open_input_file(p) as handle:
                if self.members:
                    yield from self._member_row(path, handle, schema)
                else:
                    yield from self._rows(path, handle, schema)

    def _rows(self, path: str, handle: pa.NativeFile, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        with zipfile.ZipFile(handle) as z:
            member = find_member(z)
            day = day_of_member(member)
            if not self.wanted(day):
                return
            lines = MemberLines(z, member)
            wanted = [n for n in schema.names if n in REQUIRED or n in ("valor", "USD")]
            of = {"valor": price_column(lines.header, self.kind) if "valor" in wanted else ""}
            at = [lines.header.index(c) if (c := of.get(n, n)) in lines.header or n != "USD" else -1 for n in wanted]
            held: list[list[Any]] = [[] for _ in wanted]
            numbers: list[int] = []

            def batch() -> pa.RecordBatch:
                columns: dict[str, Any] = dict(zip(wanted, held, strict=True)) | {"linea": numbers}
                fixed = {"archivo": path, "dia": day}
                return pa.RecordBatch.from_arrays([pa.array(columns[f.name] if f.name in columns else [fixed[f.name]] * len(numbers), f.type) for f in schema], schema=schema)

            for n, row in lines:
                numbers.append(n)
                for out, i in zip(held, at, strict=True):
                    out.append((row[i].strip() or None) if 0 <= i < len(row) else None)
                if len(numbers) == ROWS:
                    yield batch()
                    held, numbers = [[] for _ in wanted], []
            if numbers:
                yield batch()

    def _member_row(self, path: str, handle: pa.NativeFile, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        row: dict[str, Any] = dict.fromkeys(schema.names) | {"archivo": path}
        try:
            z = zipfile.ZipFile(handle)
            bad = z.testzip()
        except (zipfile.BadZipFile, zlib.error, OSError, ValueError) as e:  # Arrow's files refuse odd positions by ValueError
            z, bad = None, str(e)
        if z is None or bad:
            row["error"] = f"zip_corrupto: {bad}"
        else:
            try:
                member = find_member(z)
                row |= {"miembro": member, "dia": day_of_member(member)}
                if self.wanted(row["dia"]):
                    lines = MemberLines(z, member)
                    rows = sum(1 for _ in lines)
                    row |= {"codificacion": lines.encoding, "cabecera": lines.header, "filas": rows, "vacias": lines.empty}
            except ValueError as e:
                row["error"] = f"sin_comparativo: {e}"
        if self.wanted(row["dia"]):
            yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)


class DayFiles(DataSource):
    """Options: ``path``, or ``paths`` as JSON; ``desde`` and ``hasta``, the days asked for, both included; ``tipo`` def or pre; ``modo`` filas (a row a line) or miembros (a row a file, with its
    encoding, header, rows, empty lines and what is wrong with it); ``maxbytes`` of small files a task."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MEMBERS_SCHEMA if self.options.get("modo", "filas") == "miembros" else ROWS_SCHEMA

    def reader(self, schema: StructType) -> DayFileReader:
        return DayFileReader(schema, dict(self.options))


def reader(spark: SparkSession, paths: list[str] | str, first: date | None = None, last: date | None = None, **options: str) -> DataFrameReader:
    """A reader of the format, which is registered in the session, for members of a range of days."""
    spark.dataSource.register(DayFiles)
    held = {"path": paths} if isinstance(paths, str) else {"paths": json.dumps(paths)}
    held |= {name: day.isoformat() for name, day in (("desde", first), ("hasta", last)) if day is not None}
    return spark.read.format(FORMAT).options(**held, **options)


def day_rows(spark: SparkSession, paths: list[str] | str, kind: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """Raw rows of day files of one type, in the form of ``bronze.comparativo_rows``, with their day and line."""
    return reader(spark, paths, first, last, tipo=kind).load()


def member_table(spark: SparkSession, paths: list[str] | str, first: date | None = None, last: date | None = None) -> DataFrame:
    return reader(spark, paths, first, last, modo="miembros").load()


def empty_line_findings(members: DataFrame) -> DataFrame:
    """(archivo, severidad, tipo, detalle): members with lines of separators alone, as spreadsheets export them. They are no rows."""
    return members.where("vacias > 0").select("archivo", F.lit("info").alias("severidad"), F.lit("lineas_vacias").alias("tipo"), F.concat(F.col("vacias").cast("string"), F.lit(" lineas")).alias("detalle"))

