"""Checks that report and never repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlake.functions.calendar import calendar, hour_exists, hours_of_day
from quarterlake.schema import FINDING, KEY, MAX_HOUR, MINUTES

DETAIL = 500


def wrong_length_days(series: DataFrame, days: DataFrame) -> DataFrame:
    """Days whose rows a bus, on average, differ from the calendar's quarters."""
    real = series.groupBy("fecha").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("barra").alias("barras")).withColumn("cuartos_por_barra", F.try_divide(F.col("n").cast("double"), F.col("barras")))
    both = real.join(F.broadcast(days), "fecha").where("cuartos_por_barra <> cuartos_esperados")
    return both.select("fecha", "cuartos_por_barra", "cuartos_esperados", (F.col("cuartos_por_barra") - F.col("cuartos_esperados")).alias("diferencia"), "barras", "es_dia_largo", "es_dia_corto").orderBy("fecha")


def wrong_length_days_by_bus(series: DataFrame, days: DataFrame) -> DataFrame:
    """The same for each bus, where opposite errors do not cancel out."""
    real = series.groupBy("fecha", "barra").agg(F.count(F.lit(1)).alias("cuartos"))
    return real.join(F.broadcast(days), "fecha").where("cuartos <> cuartos_esperados").select("fecha", "barra", "cuartos", "cuartos_esperados").orderBy("fecha", "barra")


def incomplete_hours(series: DataFrame, limit: int | None = DETAIL) -> DataFrame:
    """Hours of a bus without exactly the four quarters."""
    have = series.groupBy("fecha", "hora", "barra").agg(F.count(F.lit(1)).alias("cuartos"), F.sort_array(F.collect_list("minuto")).alias("minutos"), F.count_if(F.col("minuto").isNull() | ~F.col("minuto").isin(*MINUTES)).alias("odd"))
    out = have.where((F.col("cuartos") != 4) | (F.col("odd") > 0)).drop("odd").orderBy("fecha", "hora", "barra")
    return out if limit is None else out.limit(limit)


def duplicate_keys(series: DataFrame, limit: int | None = DETAIL) -> DataFrame:
    out = series.groupBy(*KEY).agg(F.count(F.lit(1)).alias("veces")).where("veces > 1").orderBy(F.desc("veces"), *KEY)
    return out if limit is None else out.limit(limit)


def ghost_hours(series: DataFrame) -> DataFrame:
    """Rows in hours that the clock did not show, and how many of them are zero."""
    held = series.where(F.col("hora").between(0, 23) & ~hour_exists(F.col("fecha"), F.col("hora").cast("int")))
    return held.groupBy("fecha", "hora").agg(F.count(F.lit(1)).alias("filas"), F.count_if(F.col("cmg_usd_mwh") == 0).alias("en_cero")).orderBy("fecha", "hora")


def drop_ghost_hours(series: DataFrame) -> DataFrame:
    """Rows whose day or hour could not be read stay: they are for the domain checks to report."""
    return series.where(F.coalesce(~F.col("hora").between(0, 23) | hour_exists(F.col("fecha"), F.col("hora").cast("int")), F.lit(True)))


def counters(series: DataFrame) -> DataFrame:
    """All scalar counters in one pass."""
    return series.agg(F.count(F.lit(1)).alias("filas"), F.count_if(~F.col("minuto").isin(*MINUTES)).alias("minutos_invalidos"), F.count_if(~F.col("hora").between(0, MAX_HOUR)).alias("horas_invalidas"), F.count_if(F.col("cmg_usd_mwh").isNull()).alias("valores_nulos"))


def summary(series: DataFrame, days: DataFrame) -> dict[str, int]:
    """True counts of everything, whatever the details' limit."""
    out = counters(series).first().asDict()
    out["dias_con_largo_incorrecto"] = wrong_length_days(series, days).count()
    out["horas_incompletas"] = incomplete_hours(series, None).count()
    out["claves_duplicadas"] = duplicate_keys(series, None).count()
    out["filas_hora_fantasma"] = ghost_hours(series).agg(F.coalesce(F.sum("filas"), F.lit(0))).first()[0]
    return out


def has_problems(found: dict[str, int]) -> bool:
    return any(n > 0 for k, n in found.items() if k != "filas")


def day_shape(rows: DataFrame, key: str = "archivo") -> DataFrame:
    """Findings on raw day files (archivo, dia, FECHA yyyyMMdd, HORA, BARRA): dates that are not the day's, hours from 1, hours above 24,
    the missing extra hour, ghost hours, an odd length, buses of another length than most (ties: the smaller)."""
    hour = F.col("HORA").cast("int")
    per_bus = rows.groupBy(key, "dia", "BARRA").agg(F.count(F.lit(1)).alias("n"))
    usual = per_bus.groupBy(key, "dia", "n").agg(F.count(F.lit(1)).alias("buses")).groupBy(key, "dia").agg(F.min(F.struct((-F.col("buses")).alias("b"), "n")).alias("m"), F.sum("buses").alias("all")).select(key, "dia", F.col("m.n").alias("usual"), (F.col("all") + F.col("m.b")).alias("others"))
    shape = rows.groupBy(key, "dia").agg(F.min(hour).alias("lo"), F.max(hour).alias("hi"), F.count_if(F.col("FECHA") != F.date_format("dia", "yyyyMMdd")).alias("other_dates"), F.count_if(~hour_exists(F.col("dia"), hour) & hour.between(0, 23)).alias("ghosts")).join(usual, [key, "dia"])
    h = hours_of_day(F.col("dia"))
    say = lambda cond, sev, kind, text: F.when(cond, F.struct(F.lit(sev).alias("severidad"), F.lit(kind).alias("tipo"), text.alias("detalle")))
    t = lambda *xs: F.concat(*(x.cast("string") if not isinstance(x, str) else F.lit(x) for x in xs))
    base1 = (F.col("lo") == 1) & (F.col("hi") == h) & (h != 23)
    found = F.array_compact(F.array(
        say(F.col("other_dates") > 0, "critico", "fechas_de_otro_dia", t(F.col("other_dates"), " filas de otra fecha")),
        say(base1, "critico", "horas_base_1", t("las horas van de 1 a ", F.col("hi"))),
        say((F.col("hi") > MAX_HOUR) & ~base1, "critico", "hora_fuera_de_rango", t("hora ", F.col("hi"))),
        say((h == 25) & (F.col("hi") < 24), "critico", "falta_hora_extra", t("el dia tiene 25 horas")),
        say(F.col("ghosts") > 0, "info", "hora_fantasma", t(F.col("ghosts"), " filas en horas que no existen")),
        say((F.col("usual") != 4 * h) & (F.col("ghosts") == 0), "critico", "largo_inesperado", t(F.col("usual"), " cuartos, se esperaban ", 4 * h)),
        say(F.col("others") > 0, "advertencia", "barras_con_otro_largo", t(F.col("others"), " barras")),
    ))
    return shape.select(key, "dia", F.explode(found).alias("f")).select(key, "dia", "f.*")


def header_findings(member: str, columns: list[str], expected: list[str], required: list[str]) -> list[dict]:
    """Missing required columns (critical), new or removed ones (warning), another order (info); empty names do not count."""
    have, want = [c for c in columns if c], [c for c in expected if c]
    out = []
    if lost := [c for c in required if c not in have]:
        out.append(finding("critico", "columnas_requeridas", f"{member}: faltan {', '.join(lost)}"))
    if new := [c for c in have if c not in want]:
        out.append(finding("advertencia", "columnas_nuevas", f"{member}: {', '.join(new)}"))
    if gone := [c for c in want if c not in have and c not in required]:
        out.append(finding("advertencia", "columnas_quitadas", f"{member}: {', '.join(gone)}"))
    if not out and have != want:
        out.append(finding("info", "columnas_en_otro_orden", member))
    return out


def finding(severity: str, kind: str, detail: str, evidence: str = "", action: str = "", file: str = "") -> dict:
    return dict(zip(FINDING.fieldNames(), (severity, kind, detail, evidence, action, file), strict=True))


def report(findings: DataFrame) -> DataFrame:
    """Groups of findings that differ in file names and dates only, the severest first."""
    masked = F.regexp_replace(F.regexp_replace("detalle", r"[\w.-]+\.(zip|csv|ZIP|CSV)", "<archivo>"), r"\d{4}-\d{2}-\d{2}", "<fecha>")
    rank = F.array_position(F.array(F.lit("critico"), F.lit("advertencia"), F.lit("info")), F.col("severidad"))
    out = findings.withColumn("detalle", masked).groupBy("severidad", "tipo", "detalle", "accion").agg(F.count(F.lit(1)).alias("veces"), F.sort_array(F.collect_set("archivo")).alias("archivos"))
    return out.orderBy(rank, "tipo", "detalle")


def expected_calendar(series: DataFrame) -> DataFrame:
    """The calendar of the series' own range."""
    first, last = series.agg(F.min("fecha"), F.max("fecha")).first()
    return calendar(series.sparkSession, first, last)
