"""Day files to months of the series: the version of each day is chosen, unchanged months are skipped, files are checked, and days whose
file has gone are taken from the series as it stands. The driver holds one row a day of the manifest; all quarters stay in Spark."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.functions.calendar import calendar
from quarterlake.functions.domain import Month, format_month
from quarterlake.operators import drift, quality, versions
from quarterlake.schema import ORIGIN_DEFINITIVE, ORIGIN_PRELIMINARY
from quarterlake.sources import bronze, control, dayfiles, silver
from quarterlake.streaming.ingest import month_fingerprint

ORIGIN = {"def": ORIGIN_DEFINITIVE, "pre": ORIGIN_PRELIMINARY}
COUNTERS = ("filas", "dias_con_largo_incorrecto", "horas_incompletas", "claves_duplicadas", "filas_hora_fantasma")


def union_days(days: list[DataFrame]) -> DataFrame:
    """One table of all days; none at all is an error."""
    if not days:
        raise ValueError("there are no days to put together")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), days)


def months_to_do(chosen: dict[date, dict], doubtful: dict[date, list[str]]) -> list[Month]:
    """Months with a chosen or a doubtful day, in order."""
    return sorted({(d.year, d.month) for d in (*chosen, *doubtful)})


def chosen_files(manifest: DataFrame, start: date | None = versions.SOURCE_START) -> dict[date, dict]:
    return {r["fecha_operacion"]: r.asDict() for r in versions.choose_by_day(manifest, start).toLocalIterator()}


def file_findings(spark: SparkSession, folder: str, entries: list[dict]) -> DataFrame:
    """(nombre, severidad, tipo, detalle) of day files: damage and headers, members, and the shape of their day."""
    paths = [f"{folder}/{e['nombre']}" for e in entries]
    zips = spark.read.format("binaryFile").load(paths)
    name = drift.basename(F.col("archivo")).alias("nombre")
    whole = bronze.zip_findings(zips).select(name, "severidad", "tipo", "detalle")
    members = drift.member_findings(bronze.zip_members(zips)).select(name, "severidad", "tipo", "detalle")
    out = whole.unionByName(members)
    if dayfiles.reachable(folder):
        out = out.unionByName(dayfiles.empty_line_findings(dayfiles.member_table(spark, paths)).select(name, "severidad", "tipo", "detalle"))
    return out


def shape_findings(raw: DataFrame, days: DataFrame) -> DataFrame:
    """(nombre, severidad, tipo, detalle) of raw rows (archivo, FECHA, HORA, BARRA) against the day of their file (nombre, dia)."""
    named = raw.withColumn("archivo", drift.basename(F.col("archivo"))).join(F.broadcast(days.withColumnRenamed("nombre", "archivo")), "archivo")
    return quality.day_shape(named).select(F.col("archivo").alias("nombre"), "severidad", "tipo", "detalle")


def days_in_series(series: DataFrame, wanted: dict[date, str]) -> set[date]:
    """Of days with the origin they should have, those that the series holds with that origin alone."""
    if not wanted:
        return set()
    spark = series.sparkSession
    want = spark.createDataFrame(list(wanted.items()), "fecha date, esperado string")
    span = series.where(F.col("fecha").between(F.lit(min(wanted)), F.lit(max(wanted))))
    by_day = span.groupBy("fecha").agg(F.min("origen").alias("a"), F.max("origen").alias("b")).join(F.broadcast(want), "fecha")
    return {r["fecha"] for r in by_day.where("a = b AND a = esperado").select("fecha").collect()}


def ingest_month(spark: SparkSession, folder: str, base: str, month: Month, days: dict[date, dict], now: datetime) -> tuple[dict, list[dict], dict[date, dict]]:
    """One month: its report row, the findings, and the days that are in the series with their files. A day whose file is missing,
    damaged or of another shape is left out; without any day nothing is written, so that what was there stays."""
    here = set(control.names(spark, folder))
    present = {d: e for d, e in days.items() if e["nombre"] in here}
    gone = {d: e for d, e in days.items() if d not in present}
    kept = {d: e for d, e in gone.items() if control.witnessed(spark, folder, e)}
    left_out = [f"{d}: {e['nombre']} is in the manifest and not in the folder" for d, e in sorted(gone.items()) if d not in kept]
    findings: list[dict] = []
    if present:
        findings = [r.asDict() for r in file_findings(spark, folder, list(present.values())).collect()]
    broken = {f["nombre"]: f["tipo"] for f in findings if f["severidad"] == "critico"}
    readable = {d: e for d, e in present.items() if e["nombre"] not in broken}
    raws = {k: _raw(spark, folder, [e for e in readable.values() if e["tipo"] == k], k) for k in ORIGIN if any(e["tipo"] == k for e in readable.values())}
    if raws:
        of_day = spark.createDataFrame([(e["nombre"], d) for d, e in readable.items()], "nombre string, dia date")
        shapes = [r.asDict() for r in shape_findings(reduce(DataFrame.unionByName, raws.values()), of_day).collect()]
        findings += shapes
        broken |= {f["nombre"]: f["tipo"] for f in shapes if f["severidad"] == "critico"}
    left_out += [f"{d}: {e['nombre']}: {broken[e['nombre']]}" for d, e in sorted(present.items()) if e["nombre"] in broken]
    entered = {d: e for d, e in readable.items() if e["nombre"] not in broken}

    parts, ghosts = [], 0
    for kind, raw in raws.items():
        good = [e["nombre"] for e in entered.values() if e["tipo"] == kind]
        if good:
            rows = bronze.to_series(raw.where(drift.basename(F.col("archivo")).isin(good)), kind)
            parts.append(rows.withColumn("ingerido_en", F.lit(now).cast("timestamp_ntz")))
    ghosts = sum(int(f["detalle"].split(" ")[0]) for f in findings if f["tipo"] == "hora_fantasma" and f["nombre"] not in broken)
    from_series: set[date] = set()
    if kept and month in silver.written_months(spark, base):
        old = silver.scan(spark, base).where((F.col("anio") == month[0]) & (F.col("mes") == month[1]))
        from_series = days_in_series(old, {d: ORIGIN[e["tipo"]] for d, e in kept.items()})
        if from_series:
            parts.append(old.where(F.col("fecha").isin(sorted(from_series))).drop("anio", "mes"))
    left_out += [f"{d}: {e['nombre']} has a witness, and the series does not hold the day" for d, e in sorted(kept.items()) if d not in from_series]
    entered |= {d: kept[d] for d in from_series}
    report = {"anio": month[0], "mes": month[1], "dias": len(entered), "dias_pre": sum(e["tipo"] == "pre" for e in entered.values()), "desde_silver": len(from_series), "omitidos": left_out, "filas_escritas": 0, "filas_fantasma_en_origen": ghosts}
    if not parts:
        return report | dict.fromkeys(COUNTERS, 0), findings, {}
    report["filas_escritas"] = silver.write_month(union_days(parts), base, month)
    written = silver.scan(spark, base).where((F.col("anio") == month[0]) & (F.col("mes") == month[1]))
    found = quality.summary(written, calendar(spark, min(entered), max(entered)))
    return report | {k: found[k] for k in COUNTERS}, findings, entered


def _raw(spark: SparkSession, folder: str, entries: list[dict], kind: str) -> DataFrame:
    """Raw rows of day files, as a stream where Arrow reaches the folder, else from files that Spark loads whole."""
    paths = [f"{folder}/{e['nombre']}" for e in entries]
    if dayfiles.reachable(folder):
        return dayfiles.day_rows(spark, paths, kind).drop("dia", "linea")
    return bronze.comparativo_rows(spark.read.format("binaryFile").load(paths), kind)


def ingest(spark: SparkSession, folder: str, base: str, now: datetime, months: list[Month] | None = None, force: bool = False, keep_files: bool = True, start: date = versions.SOURCE_START) -> tuple[list[dict], list[dict]]:
    """All months whose files changed since they were last written; named months, or all with ``force``, are written anew. A month's
    fingerprint is stored only when every one of its days is in; else it is tried again. With ``keep_files`` false, files whose rows are
    in, and those of the same days that lost against them, give way to witnesses."""
    manifest = control.read_manifest(spark, folder)
    chosen = chosen_files(manifest, start)
    doubtful = {r["fecha_operacion"]: r["nombres"] for r in versions.doubtful_days(manifest).where(F.col("fecha_operacion") >= F.lit(start)).collect()}
    if not chosen and not doubtful:
        raise ValueError(f"no files since {start} in {folder}")
    silver.recover(spark, base)
    state_path = f"{folder}/{control.STATE_FILE}"
    state: dict[str, list[str]] = control.read_json(spark, state_path, {})
    reports, findings = [], []
    for month in months_to_do(chosen, doubtful):
        if months is not None and month not in months:
            continue
        in_month = lambda d: (d.year, d.month) == month  # noqa: B023, E731
        days = {d: e for d, e in chosen.items() if in_month(d)}
        unsure = [f"{d}: {', '.join(n)} of unknown type" for d, n in sorted(doubtful.items()) if in_month(d)]
        print_of = month_fingerprint([e["sha256"] for e in days.values()])
        if not force and months is None and not unsure and state.get(format_month(month)) == print_of:
            continue
        report, found, entered = ingest_month(spark, folder, base, month, days, now)
        report["omitidos"] = unsure + report["omitidos"]
        reports.append(report)
        findings += found
        if not keep_files and entered:
            _give_way(spark, folder, manifest, entered, set(doubtful), now)
        if not report["omitidos"]:
            state[format_month(month)] = print_of
            control.write_json(spark, state_path, state)
    return reports, findings


def _give_way(spark: SparkSession, folder: str, manifest: DataFrame, entered: dict[date, dict], doubtful: set[date], now: datetime) -> int:
    used = {e["nombre"] for e in entered.values()}
    rows = [r.asDict() for r in manifest.where(F.col("fecha_operacion").isin(sorted(set(entered) - doubtful))).collect()] if set(entered) - doubtful else []
    return sum(control.leave_witness(spark, folder, e, "silver" if e["nombre"] in used else "superado", now.isoformat(timespec="seconds")) for e in rows)


def totals(reports: list[dict]) -> dict[str, int]:
    """The sums of report rows."""
    return {k: sum(r[k] for r in reports) for k in ("filas_escritas", *COUNTERS)}
