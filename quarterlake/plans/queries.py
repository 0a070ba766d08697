"""Registered queries and their SQL. Dates come out as text, float results rounded to 6 digits, counts as long."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.functions import calendar, domain, names, search
from quarterlake.operators import gold, publish, quality, versions
from quarterlake.plans.adapters import BLOCK_SQL, EVENTS_SQL, ITEMS_SQL, MANIFEST_SQL, events_series, items_series, orders_manifest, table
from quarterlake.schema import domain_violations
from quarterlake.sources import bronze, dayfiles, silver, snapshots
from quarterlake.streaming import ingest
from quarterlake.streaming import versions as day_versions
from quarterlake.workflows import publishing, reports, watch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
FIRST, LAST = date(2024, 1, 3), date(2024, 1, 20)
SPAN_SQL = "fecha BETWEEN DATE '2024-01-03' AND DATE '2024-01-20'"
AVERAGES_SQL = """avg(cmg_usd_mwh) FILTER (bloque = 'A') AS "A", avg(cmg_usd_mwh) FILTER (bloque = 'B') AS "B", avg(cmg_usd_mwh) FILTER (bloque = 'C') AS "C",
  avg(cmg_usd_mwh) FILTER (bloque = 'B') AS "Solar", avg(cmg_usd_mwh) FILTER (bloque IN ('A', 'C')) AS "NoSolar", avg(cmg_usd_mwh) AS "Total\""""
ROUNDED = ("A", "B", "C", "Solar", "NoSolar", "Total")
#: Averages differ in their last digits by the order of summation: they are rounded in decimal, after those digits have gone.
R6 = "round(round({}, 10)::DECIMAL(38, 10), 6)::DOUBLE".format
STATS_SQL = f"""count(*) AS cuartos, {R6('avg(cmg_usd_mwh)')} AS promedio, round(stddev_samp(cmg_usd_mwh), 6) AS desviacion, round(min(cmg_usd_mwh), 6) AS minimo,
  round(max(cmg_usd_mwh), 6) AS maximo, count(*) FILTER (cmg_usd_mwh = 0) AS en_cero"""
RISK_SQL = f"""count(*) AS cuartos, {R6('avg(ref)')} AS cmg_referencia, {R6('avg(comp)')} AS cmg_comparada, {R6('avg(comp) - avg(ref)')} AS riesgo_usd_mwh,
  round(CASE WHEN avg(ref) <> 0 THEN (avg(comp) - avg(ref)) / avg(ref) END, 6) AS riesgo_pct, round(min(comp - ref), 6) AS riesgo_minimo,
  round(max(comp - ref), 6) AS riesgo_maximo, count(*) FILTER (ref = 0) AS ref_en_cero"""


def edge(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, floats rounded."""
    kinds = dict(df.dtypes)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kinds[c] == "timestamp_ntz" else F.col(f"`{c}`").cast("string")
    six = lambda x: F.coalesce(F.round(F.round(x, 10).try_cast("decimal(38,10)"), 6).cast("double"), F.round(x, 6))
    return df.select(*(six(F.col(f"`{c}`")).alias(c) if k == "double" else text(c).alias(c) if k in ("date", "timestamp_ntz") else F.col(f"`{c}`") for c, k in df.dtypes))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, sf_dir: edge(f(spark, sf_dir))
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def rounded(names_: tuple[str, ...] = ROUNDED) -> str:
    return ", ".join(f'{R6(chr(34) + n + chr(34))} AS "{n}"' for n in names_)


# Results -----------------------------------------------------------------------------------------------------------------------


@query(f"""WITH {ITEMS_SQL}, s AS (SELECT anio, mes, count(*) AS cuartos, {AVERAGES_SQL} FROM li WHERE barra = 'A.F' GROUP BY ALL)
SELECT anio, mes, cuartos, {rounded()}, make_date(anio, mes, 1)::VARCHAR AS fecha FROM s""")
def resumen_mensual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.monthly_summary(items_series(spark, sf_dir), "A.F")


@query(f"WITH {ITEMS_SQL} SELECT anio, mes, bloque, {STATS_SQL} FROM li WHERE barra = 'N.O' AND anio * 100 + mes BETWEEN 199603 AND 199807 GROUP BY ALL")
def bloques_detallado(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.monthly_block_detail(items_series(spark, sf_dir), "N.O", (1996, 3), (1998, 7))


@query(f"""WITH {ITEMS_SQL} SELECT anio, mes, round(avg(cmg_usd_mwh) FILTER (barra = 'A.F'), 6) AS "A.F", round(avg(cmg_usd_mwh) FILTER (barra = 'R.O'), 6) AS "R.O"
FROM li WHERE barra IN ('A.F', 'R.O') GROUP BY ALL""")
def comparar_barras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.compare_buses(items_series(spark, sf_dir), ["A.F", "R.O", "A.F"])


@query(f"""WITH {EVENTS_SQL}, b AS (SELECT * FROM ev WHERE barra = 'click' AND {SPAN_SQL}),
u AS (SELECT strftime(fecha, '%Y-%m') AS periodo, count(*) AS cuartos, {AVERAGES_SQL} FROM b GROUP BY 1 UNION ALL
SELECT 'Rango completo', count(*), {AVERAGES_SQL} FROM b HAVING count(*) > 0) SELECT periodo, cuartos, {rounded()} FROM u""")
def bloques_rango(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.range_blocks(events_series(spark, sf_dir), "click", FIRST, LAST)


@query(f"""WITH {ITEMS_SQL}, b AS (SELECT *, strftime(fecha, '%Y-%m') AS periodo FROM li WHERE fecha BETWEEN DATE '1996-01-15' AND DATE '1996-06-10'),
u AS (SELECT barra, periodo, count(*) AS cuartos, {AVERAGES_SQL} FROM b GROUP BY 1, 2 UNION ALL SELECT barra, 'Rango completo', count(*), {AVERAGES_SQL} FROM b GROUP BY 1)
SELECT barra, periodo, cuartos, {rounded()} FROM u""")
def bloques_varias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.range_blocks_many(items_series(spark, sf_dir), None, date(1996, 1, 15), date(1996, 6, 10))


@query(f"WITH {EVENTS_SQL} SELECT bloque, {STATS_SQL} FROM ev WHERE barra = 'view' AND {SPAN_SQL} GROUP BY ALL")
def estadisticas_bloque(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.range_statistics(events_series(spark, sf_dir), "view", FIRST, LAST)


@query(f"WITH {EVENTS_SQL} SELECT barra, fecha::VARCHAR AS fecha, hora, minuto, bloque, round(cmg_usd_mwh, 6) AS cmg_usd_mwh, es_hora_extra, strftime(fecha_hora, '%Y-%m-%d %H:%M:%S') AS fecha_hora FROM ev WHERE barra = 'click' AND anio = 2024 AND mes = 1")
def serie_quinceminutal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.series_of(events_series(spark, sf_dir), "click", (2024, 1), (2024, 1))


_PAIR_EV = f"""{EVENTS_SQL}, par AS (SELECT r.*, r.cmg_usd_mwh AS ref, c.cmg_usd_mwh AS comp FROM (SELECT * FROM ev WHERE barra = 'click') r
  JOIN (SELECT fecha, hora, minuto, cmg_usd_mwh FROM ev WHERE barra = 'view') c USING (fecha, hora, minuto))"""
_PAIR_LI = f"""{ITEMS_SQL}, par AS (SELECT r.*, r.cmg_usd_mwh AS ref, c.cmg_usd_mwh AS comp FROM (SELECT * FROM li WHERE barra = 'R.F') r
  JOIN (SELECT fecha, hora, minuto, cmg_usd_mwh FROM li WHERE barra = 'N.F') c USING (fecha, hora, minuto))"""
_RISK_ROWS = """SELECT fecha::VARCHAR AS fecha, hora, minuto, bloque, es_hora_extra, strftime(fecha_hora, '%Y-%m-%d %H:%M:%S') AS fecha_hora, round(ref, 6) AS cmg_referencia,
  round(comp, 6) AS cmg_comparada, round(comp - ref, 6) AS riesgo_usd_mwh, round(CASE WHEN ref <> 0 THEN (comp - ref) / ref END, 6) AS riesgo_pct FROM par"""


@query(f"WITH {_PAIR_EV} {_RISK_ROWS}")
def serie_riesgo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.risk_series(events_series(spark, sf_dir), "click", "view")


@query(f"WITH {_PAIR_LI} {_RISK_ROWS}")
def riesgo_cero_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.risk_series(items_series(spark, sf_dir), "R.F", "N.F")


@query(f"WITH {_PAIR_LI} SELECT anio, mes, make_date(anio, mes, 1)::VARCHAR AS fecha, bloque, {RISK_SQL} FROM par GROUP BY anio, mes, bloque")
def resumen_riesgo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.risk_summary(items_series(spark, sf_dir), "R.F", "N.F")


@query(f"""WITH {_PAIR_EV}, p AS (SELECT *, strftime(fecha, '%Y-%m') AS periodo FROM par WHERE {SPAN_SQL})
SELECT coalesce(periodo, 'Rango completo') AS periodo, bloque, {RISK_SQL} FROM p GROUP BY GROUPING SETS ((periodo, bloque), (bloque))""")
def resumen_riesgo_rango(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.range_risk_summary(events_series(spark, sf_dir), "click", "view", FIRST, LAST)


@query(f"WITH {ITEMS_SQL} SELECT count(*) FILTER (cmg_usd_mwh = 0) AS en_cero, count(*) AS total FROM li WHERE barra = 'R.F' AND anio * 100 + mes BETWEEN 199601 AND 199912")
def intervalos_sin_porcentaje(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.without_percentage(items_series(spark, sf_dir), "R.F", (1996, 1), (1999, 12))


@query(f"""WITH {EVENTS_SQL} SELECT fecha::VARCHAR AS fecha, hora, minuto, bloque, {", ".join(f"round(max(cmg_usd_mwh) FILTER (barra = '{b}'), 6) AS {b}" for b in ("purchase", "absent", "click", "view"))}
FROM ev WHERE barra IN ('purchase', 'click', 'view') AND {SPAN_SQL} GROUP BY fecha, hora, minuto, bloque""")
def serie_ancha(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.wide_series(events_series(spark, sf_dir), ["purchase", "absent", "click", "view"], FIRST, LAST)


@query(f"""WITH {ITEMS_SQL} SELECT barra, count(*) AS cuartos, min(fecha)::VARCHAR AS desde, max(fecha)::VARCHAR AS hasta, round(avg(cmg_usd_mwh), 6) AS promedio,
count(*) FILTER (es_hora_extra) AS cuartos_hora_extra FROM li WHERE barra IN ('A.F', 'N.O', 'none') GROUP BY 1""")
def resumen_barras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.bus_summary(items_series(spark, sf_dir), ["A.F", "N.O", "none"])


@query(f"""WITH {ITEMS_SQL} SELECT count(*) AS filas, count(DISTINCT barra) AS barras, max(anio * 12 + mes)::BIGINT - min(anio * 12 + mes) + 1 AS meses_del_rango,
count(DISTINCT anio * 12 + mes) AS meses_con_datos FROM li""")
def resumen_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.base_summary(items_series(spark, sf_dir))


@query(f"""WITH {EVENTS_SQL} SELECT count(*) AS cuartos, round(avg(cmg_usd_mwh), 6) AS promedio, round(min(cmg_usd_mwh), 6) AS minimo, round(max(cmg_usd_mwh), 6) AS maximo,
count(*) FILTER (cmg_usd_mwh = 0) AS en_cero, sum(es_hora_extra::INT)::BIGINT AS cuartos_hora_extra FROM ev""")
def estadisticas_exportacion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.export_statistics(events_series(spark, sf_dir))


@query(f"WITH {ITEMS_SQL} SELECT DISTINCT barra FROM li")
def barras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.buses(items_series(spark, sf_dir))


@query(f"WITH {ITEMS_SQL}, n AS (SELECT DISTINCT barra FROM li WHERE contains(upper(barra), 'F')) SELECT barra, (SELECT count(*) FROM n) AS total FROM n ORDER BY barra LIMIT 2")
def barras_por_texto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.find_buses(items_series(spark, sf_dir), "f", 2)


@query(f"WITH {ITEMS_SQL} SELECT barra, fecha::VARCHAR AS fecha, hora, minuto, cmg_usd_mwh FROM li WHERE anio * 100 + mes BETWEEN 199511 AND 199602")
def periodo_filtro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.in_period(items_series(spark, sf_dir), (1995, 11), (1996, 2)).select("barra", "fecha", "hora", "minuto", "cmg_usd_mwh")


# Calendar ----------------------------------------------------------------------------------------------------------------------

_DAYS_SQL = """dias AS (SELECT unnest(generate_series(a, z, INTERVAL 1 DAY))::DATE AS fecha
  FROM (SELECT min(l_shipdate::DATE)::TIMESTAMP AS a, max(l_shipdate::DATE)::TIMESTAMP AS z FROM lineitem))"""
_HOURS_SQL = "((epoch(timezone('America/Santiago', (fecha + 1)::TIMESTAMP)) - epoch(timezone('America/Santiago', fecha::TIMESTAMP))) / 3600)::INT"


@query(f"WITH {_DAYS_SQL}, h AS (SELECT fecha, {_HOURS_SQL} AS horas FROM dias) SELECT fecha::VARCHAR AS fecha, horas, horas * 4 AS cuartos_esperados, horas = 25 AS es_dia_largo, horas = 23 AS es_dia_corto FROM h")
def calendario_horas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the span that the table has."""
    return calendar.calendar(spark, *_span(spark, sf_dir))


def _span(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    day = F.to_date("l_shipdate")
    return tuple(table(spark, sf_dir, "lineitem").agg(F.min(day), F.max(day)).first())


@query(f"""WITH {_DAYS_SQL}, e AS (SELECT fecha, h::INT AS hora, timezone('America/Santiago', timezone('America/Santiago', fecha::TIMESTAMP + to_hours(h))) AS back FROM dias, range(0, 24) t(h))
SELECT fecha::VARCHAR AS fecha, hora FROM e WHERE hour(back) <> hora""")
def horas_inexistentes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar.days(spark, *_span(spark, sf_dir)).select("fecha", F.explode(calendar.missing_hours(F.col("fecha"))).alias("hora"))


@query(f"""WITH {ITEMS_SQL}, {_DAYS_SQL}, h AS (SELECT fecha, {_HOURS_SQL} AS horas FROM dias),
e AS (SELECT fecha, n::INT AS hora FROM h, range(0, 25) t(n)
  WHERE n = 24 AND horas = 25 OR n < 24 AND hour(timezone('America/Santiago', timezone('America/Santiago', fecha::TIMESTAMP + to_hours(n)))) = n)
SELECT e.fecha::VARCHAR AS fecha, e.hora, count(li.barra) AS cuartos FROM e LEFT JOIN li ON li.fecha = e.fecha AND li.hora = e.hora GROUP BY 1, 2""")
def horas_esperadas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hour that the clock shows in the table's span, and the quarters of the series in it."""
    hours = calendar.days(spark, *_span(spark, sf_dir)).select("fecha", F.explode(calendar.expected_hours(F.col("fecha"))).alias("hora")).withColumn("hora", F.col("hora").cast("int"))
    held = items_series(spark, sf_dir).groupBy("fecha", "hora").agg(F.count(F.lit(1)).alias("c"))
    return hours.join(held, ["fecha", "hora"], "left").select("fecha", "hora", F.coalesce("c", F.lit(0)).cast("long").alias("cuartos"))


@query(f"""WITH t AS (SELECT DISTINCT fecha, (o_orderkey % 26)::INT AS hora, (o_custkey % 4 * 15)::INT AS minuto FROM (SELECT o_orderdate::DATE AS fecha, o_orderkey, o_custkey FROM orders))
SELECT fecha::VARCHAR AS fecha, hora, minuto, {BLOCK_SQL} AS bloque, hora = 24 AS extra, CASE WHEN hora < 24 THEN strftime(fecha::TIMESTAMP + to_hours(hora) + to_minutes(minuto), '%Y-%m-%d %H:%M:%S') END AS fecha_hora FROM t""")
def hora24_fecha_hora(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("fecha"), (F.col("o_orderkey") % 26).cast("int").alias("hora"), (F.col("o_custkey") % 4 * 15).cast("int").alias("minuto")).distinct()
    hour = F.col("hora")
    return t.select("fecha", "hora", "minuto", domain.block_of_hour(hour).alias("bloque"), domain.extra_hour(hour).alias("extra"), domain.local_time(F.col("fecha"), hour, F.col("minuto")).alias("fecha_hora"))


# Checks: the series with defects that follow from its keys ---------------------------------------------------------------------

_DEFECTS_SQL = f"""{EVENTS_SQL}, bad AS (
  SELECT barra, fecha, hora, minuto, cmg_usd_mwh FROM ev WHERE NOT (hora = 7 AND minuto = 30) UNION ALL
  SELECT barra, fecha, hora, minuto, cmg_usd_mwh FROM ev WHERE hora = 3 AND barra = 'click' UNION ALL
  SELECT barra, fecha, 25, minuto, NULL FROM ev WHERE hora = 5 AND barra = 'view' UNION ALL
  SELECT barra, fecha, hora, 7, 0.0 FROM ev WHERE hora = 9 AND minuto = 0 AND barra = 'error' UNION ALL
  SELECT barra, DATE '2025-09-07', hora, minuto, CASE WHEN minuto = 0 THEN 0.0 ELSE cmg_usd_mwh END FROM ev WHERE fecha = DATE '2024-01-10')"""


def _defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["barra", "fecha", "hora", "minuto", "cmg_usd_mwh"]
    e = events_series(spark, sf_dir).select(*cols)
    price, hour, minute, bus = F.col("cmg_usd_mwh"), F.col("hora"), F.col("minuto"), F.col("barra")
    parts = [
        e.where(~((hour == 7) & (minute == 30))),
        e.where((hour == 3) & (bus == "click")),
        e.where((hour == 5) & (bus == "view")).withColumns({"hora": F.lit(25), "cmg_usd_mwh": F.lit(None).cast("double")}),
        e.where((hour == 9) & (minute == 0) & (bus == "error")).withColumns({"minuto": F.lit(7), "cmg_usd_mwh": F.lit(0.0)}),
        e.where(F.col("fecha") == F.lit(date(2024, 1, 10))).withColumns({"fecha": F.lit(date(2025, 9, 7)), "cmg_usd_mwh": F.when(minute == 0, 0.0).otherwise(price)}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_CAL_SQL = f"cal AS (SELECT fecha, horas, horas * 4 AS cuartos_esperados FROM (SELECT fecha, {_HOURS_SQL} AS horas FROM (SELECT d::DATE AS fecha FROM generate_series(DATE '2024-01-01', DATE '2025-12-31', INTERVAL 1 DAY) t(d))))"


def _calendar(spark: SparkSession) -> DataFrame:
    return calendar.calendar(spark, date(2024, 1, 1), date(2025, 12, 31))


@query(f"""WITH {_DEFECTS_SQL}, {_CAL_SQL}, r AS (SELECT fecha, count(*) / count(DISTINCT barra) AS cuartos_por_barra, count(DISTINCT barra) AS barras FROM bad GROUP BY 1)
SELECT fecha::VARCHAR AS fecha, round(cuartos_por_barra, 6) AS cuartos_por_barra, cuartos_esperados, round(cuartos_por_barra - cuartos_esperados, 6) AS diferencia, barras,
horas = 25 AS es_dia_largo, horas = 23 AS es_dia_corto FROM r JOIN cal USING (fecha) WHERE cuartos_por_barra <> cuartos_esperados""")
def dias_largo_incorrecto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.wrong_length_days(_defects(spark, sf_dir), _calendar(spark))


@query(f"""WITH {_DEFECTS_SQL}, {_CAL_SQL}, r AS (SELECT fecha, barra, count(*) AS cuartos FROM bad GROUP BY ALL)
SELECT fecha::VARCHAR AS fecha, barra, cuartos, cuartos_esperados FROM r JOIN cal USING (fecha) WHERE cuartos <> cuartos_esperados""")
def dias_largo_por_barra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.wrong_length_days_by_bus(_defects(spark, sf_dir), _calendar(spark))


@query(f"""WITH {_DEFECTS_SQL} SELECT fecha::VARCHAR AS fecha, hora, barra, count(*) AS cuartos, array_to_string(list_sort(list(minuto)), ',') AS minutos FROM bad
GROUP BY fecha, hora, barra HAVING count(*) <> 4 OR count(*) FILTER (minuto IS NULL OR minuto NOT IN (0, 15, 30, 45)) > 0 ORDER BY bad.fecha, hora, barra LIMIT 500""")
def horas_incompletas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.incomplete_hours(_defects(spark, sf_dir)).withColumn("minutos", F.array_join(F.col("minutos").cast("array<string>"), ","))


@query(f"WITH {_DEFECTS_SQL} SELECT barra, fecha::VARCHAR AS fecha, hora, minuto, count(*) AS veces FROM bad GROUP BY barra, bad.fecha, hora, minuto HAVING count(*) > 1 ORDER BY veces DESC, barra, bad.fecha, hora, minuto LIMIT 500")
def claves_duplicadas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(_defects(spark, sf_dir))


@query(f"""WITH {_DEFECTS_SQL} SELECT fecha::VARCHAR AS fecha, hora, count(*) AS filas, count(*) FILTER (cmg_usd_mwh = 0) AS en_cero FROM bad
WHERE hora BETWEEN 0 AND 23 AND hour(timezone('America/Santiago', timezone('America/Santiago', bad.fecha::TIMESTAMP + to_hours(hora)))) <> hora GROUP BY bad.fecha, hora""")
def hora_fantasma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.ghost_hours(_defects(spark, sf_dir))


@query(f"""WITH {_DEFECTS_SQL} SELECT count(*) AS filas, count(*) FILTER (minuto NOT IN (0, 15, 30, 45)) AS minutos_invalidos, count(*) FILTER (hora NOT BETWEEN 0 AND 24) AS horas_invalidas,
count(*) FILTER (cmg_usd_mwh IS NULL) AS valores_nulos FROM bad""")
def contadores_invalidos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.counters(_defects(spark, sf_dir))


@query()
def forma_dia(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _defects(spark, sf_dir).select(F.concat(F.date_format("fecha", "yyyyMMdd"), F.lit(".csv")).alias("archivo"), F.col("fecha").alias("dia"), F.date_format("fecha", "yyyyMMdd").alias("FECHA"), F.col("hora").cast("string").alias("HORA"), F.col("barra").alias("BARRA"))
    return quality.day_shape(raw)


# Versions and completeness -----------------------------------------------------------------------------------------------------


@query(f"""WITH {MANIFEST_SQL}, sure AS (SELECT fecha_operacion FROM man GROUP BY 1 HAVING bool_and(tipo IN ('def', 'pre'))),
k AS (SELECT *, row_number() OVER (PARTITION BY fecha_operacion ORDER BY CASE tipo WHEN 'def' THEN 2 WHEN 'pre' THEN 1 ELSE 0 END DESC, version DESC, reemision DESC, fecha_publicacion DESC, nombre DESC) AS r
FROM man SEMI JOIN sure USING (fecha_operacion))
SELECT fecha_operacion::VARCHAR AS fecha_operacion, tipo, version, reemision, fecha_publicacion::VARCHAR AS fecha_publicacion, nombre, sha256 FROM k WHERE r = 1""")
def elegir_por_dia(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.choose_by_day(orders_manifest(spark, sf_dir), None)


@query(f"WITH {MANIFEST_SQL} SELECT fecha_operacion::VARCHAR AS fecha_operacion, array_to_string(list_sort(list(nombre)), ',') AS nombres FROM man WHERE tipo = 'desconocido' GROUP BY man.fecha_operacion")
def dias_dudosos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.doubtful_days(orders_manifest(spark, sf_dir)).withColumn("nombres", F.array_join("nombres", ","))


_DEF_DAYS_SQL = f"{MANIFEST_SQL}, d AS (SELECT DISTINCT fecha_operacion AS fecha FROM man WHERE tipo = 'def')"


def _final_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_manifest(spark, sf_dir).where("tipo = 'def'").select(F.col("fecha_operacion").alias("fecha"))


@query(f"""WITH {_DEF_DAYS_SQL}, g AS (SELECT fecha, fecha - row_number() OVER (ORDER BY fecha)::INT AS k FROM d)
SELECT min(fecha)::VARCHAR AS desde, max(fecha)::VARCHAR AS hasta, count(*) AS dias FROM g GROUP BY k""")
def rangos_dias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.day_islands(_final_days(spark, sf_dir))


@query("""WITH m AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) - 1 AS i FROM orders GROUP BY 1 HAVING count(*) % 2 = 1),
g AS (SELECT i, i - row_number() OVER (ORDER BY i) AS k FROM m), r AS (SELECT min(i) AS a, max(i) AS b, count(*) AS meses FROM g GROUP BY k)
SELECT printf('%04d-%02d', (a // 12)::INT, (a % 12 + 1)::INT) AS desde, printf('%04d-%02d', (b // 12)::INT, (b % 12 + 1)::INT) AS hasta, meses FROM r""")
def rangos_meses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of months with an odd number of orders."""
    months = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("anio"), F.month("o_orderdate").alias("mes")).agg(F.count(F.lit(1)).alias("n"))
    return versions.month_islands(months.where("n % 2 = 1").select("anio", "mes"))


_SPAN = (date(1996, 1, 1), date(1996, 12, 31))
_SPAN_DAYS_SQL = "dias AS (SELECT d::DATE AS fecha FROM generate_series(DATE '1996-01-01', DATE '1996-12-31', INTERVAL 1 DAY) t(d))"


@query(f"""WITH {MANIFEST_SQL}, {_SPAN_DAYS_SQL}, b AS (SELECT fecha_operacion AS fecha, bool_or(tipo = 'def') AS final FROM man GROUP BY 1),
s AS (SELECT fecha, CASE WHEN final IS NULL AND DATE '1996-12-31' - fecha > 3 THEN 'sin_archivo' WHEN NOT final AND DATE '1996-12-31' - fecha > 25 THEN 'pre_sin_definitivo' END AS estado FROM dias LEFT JOIN b USING (fecha)),
g AS (SELECT *, fecha - row_number() OVER (PARTITION BY estado ORDER BY fecha)::INT AS k FROM s WHERE estado IS NOT NULL)
SELECT estado, min(fecha)::VARCHAR AS desde, max(fecha)::VARCHAR AS hasta, count(*) AS dias FROM g GROUP BY estado, k""")
def completitud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.completeness(orders_manifest(spark, sf_dir), *_SPAN, _SPAN[1])


@query(f"""WITH {MANIFEST_SQL}, {ITEMS_SQL}, {_SPAN_DAYS_SQL}, h AS (SELECT DISTINCT fecha, true AS have FROM li WHERE barra = 'A.F'), g AS (SELECT DISTINCT fecha_operacion AS fecha, true AS got FROM man),
c AS (SELECT fecha, have, CASE WHEN have THEN NULL WHEN fecha < DATE '1996-03-01' THEN 'maestro' WHEN got THEN 'sin_ingerir' ELSE 'sin_descargar' END AS causa FROM dias LEFT JOIN h USING (fecha) LEFT JOIN g USING (fecha))
SELECT strftime(fecha, '%Y-%m') AS periodo, count(*) AS esperados, count(*) FILTER (have) AS con_datos, count(*) FILTER (causa = 'maestro') AS maestro, count(*) FILTER (causa = 'sin_ingerir') AS sin_ingerir,
count(*) FILTER (causa = 'sin_descargar') AS sin_descargar FROM c GROUP BY 1""")
def cobertura(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.coverage(items_series(spark, sf_dir).where("barra = 'A.F'"), orders_manifest(spark, sf_dir), *_SPAN, start=date(1996, 3, 1))


@query(f"WITH {_DEF_DAYS_SQL}, {_SPAN_DAYS_SQL} SELECT fecha::VARCHAR AS fecha FROM dias ANTI JOIN d USING (fecha)")
def dias_faltantes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.missing_days(calendar.days(spark, *_SPAN), _final_days(spark, sf_dir))


@query(f"""WITH {MANIFEST_SQL}, {_SPAN_DAYS_SQL}, b AS (SELECT fecha_operacion AS fecha, bool_or(tipo = 'def') AS final FROM man GROUP BY 1)
SELECT least(coalesce(least((SELECT min(fecha) FROM dias ANTI JOIN b USING (fecha)), (SELECT min(fecha) FROM b WHERE NOT final AND fecha >= DATE '1996-01-01')), DATE '1996-12-31'), DATE '1996-12-31')::VARCHAR AS desde""")
def desde_sugerido(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.suggested_start(orders_manifest(spark, sf_dir), _SPAN[1], _SPAN[0])


_NEW_SQL = """nuevo AS (SELECT barra, fecha, hora, minuto, CASE WHEN minuto = 15 THEN cmg_usd_mwh + 1.5 ELSE cmg_usd_mwh END AS n FROM ev WHERE hora <> 4), viejo AS (SELECT barra, fecha, hora, minuto, cmg_usd_mwh AS o FROM ev WHERE hora <> 6)"""


@query(f"""WITH {EVENTS_SQL}, {_NEW_SQL}, j AS (SELECT coalesce(nuevo.fecha, viejo.fecha) AS dia, n, o FROM nuevo FULL JOIN viejo USING (barra, fecha, hora, minuto))
SELECT dia::VARCHAR AS fecha, count(*) FILTER (n IS NOT NULL AND o IS NOT NULL) AS cuartos, count(*) FILTER (n <> o) AS cuartos_distintos, round(max(abs(n - o)), 6) AS maxima,
round(avg(abs(n - o)) FILTER (n <> o), 6) AS media, count(*) FILTER (o IS NULL) AS agregados, count(*) FILTER (n IS NULL) AS quitados FROM j GROUP BY j.dia""")
def comparar_dias(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events_series(spark, sf_dir)
    new = e.where("hora <> 4").withColumn("cmg_usd_mwh", F.when(F.col("minuto") == 15, F.col("cmg_usd_mwh") + 1.5).otherwise(F.col("cmg_usd_mwh")))
    return versions.compare_versions(new, e.where("hora <> 6"))


_INVENTORY_SQL = "inv AS (SELECT d AS fecha, CASE day(d) % 3 WHEN 0 THEN 'pagina_cen_def' WHEN 1 THEN 'pagina_cen_pre' ELSE 'maestro_cmg_db' END AS origen, (900 + day(d))::DOUBLE AS usd_clp FROM (SELECT DISTINCT fecha_operacion AS d FROM man))"


@query(f"""WITH {MANIFEST_SQL}, {_INVENTORY_SQL}, doc AS (SELECT fecha_operacion AS fecha, tipo, version, reemision FROM man QUALIFY row_number() OVER (PARTITION BY fecha_operacion ORDER BY nombre) = 1)
SELECT fecha::VARCHAR AS fecha, coalesce(CASE tipo WHEN 'def' THEN 'Definitivo' WHEN 'pre' THEN 'Preliminar' END || CASE WHEN version > 1 THEN ' v' || version ELSE '' END || CASE WHEN reemision > 0 THEN '-' || reemision ELSE '' END,
CASE origen WHEN 'pagina_cen_def' THEN 'Definitivo' WHEN 'pagina_cen_pre' THEN 'Preliminar' END, 'Maestro (historico)') AS version, usd_clp FROM inv LEFT JOIN doc USING (fecha)""")
def version_por_dia(spark: SparkSession, sf_dir: str) -> DataFrame:
    man = orders_manifest(spark, sf_dir)
    day = F.dayofmonth("fecha")
    origin = F.when(day % 3 == 0, "pagina_cen_def").when(day % 3 == 1, "pagina_cen_pre").otherwise("maestro_cmg_db")
    inventory = man.select(F.col("fecha_operacion").alias("fecha")).distinct().select("fecha", origin.alias("origen"), (day + 900).cast("double").alias("usd_clp"))
    first = man.groupBy("fecha_operacion").agg(F.min_by(F.struct("tipo", "version", "reemision"), "nombre").alias("d")).select("fecha_operacion", "d.*")
    return publish.versions_by_day(inventory, first)


# Serving tables ----------------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey AS barra_id, c_name AS nombre FROM customer ANTI JOIN (SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') USING (c_custkey)")
def barras_huerfanas(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "orders").where("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("barra_id"))
    return publish.orphans(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("barra_id"), F.col("c_name").alias("nombre")), facts)


@query(f"WITH {MANIFEST_SQL} SELECT nombre, tipo FROM man WHERE tipo <> 'pre'")
def archivos_nuevos(spark: SparkSession, sf_dir: str) -> DataFrame:
    man = orders_manifest(spark, sf_dir)
    return versions.new_files(man.select("nombre", "tipo"), man.where("tipo = 'pre'"))


@query(f"""WITH {ITEMS_SQL}, b AS (SELECT barra, row_number() OVER (ORDER BY barra)::INT AS barra_id FROM (SELECT DISTINCT barra FROM li))
SELECT barra_id, fecha::VARCHAR AS fecha, hora, minuto, bloque, cmg_usd_mwh, 1::SMALLINT AS origen_id FROM li JOIN b USING (barra)""")
def codificar_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = items_series(spark, sf_dir).withColumn("origen", F.lit("maestro_cmg_db"))
    known = spark.sql("SELECT 1 AS barra_id, 'none' AS nombre WHERE false")
    return publish.encode(s, publish.assign_ids(known, s.select(F.col("barra").alias("nombre"))), publish.origins(spark))


@query("""WITH old AS (SELECT o_orderkey AS id, o_orderstatus AS estado, 'viejo' AS lado FROM orders), new AS (SELECT o_orderkey AS id, 'X' AS estado, 'nuevo' AS lado FROM orders WHERE o_custkey % 5 = 0
UNION ALL SELECT o_orderkey + 1000000000, 'Y', 'nuevo' FROM orders WHERE o_custkey % 7 = 0) SELECT * FROM old ANTI JOIN new USING (id) UNION ALL SELECT * FROM new""")
def upsert_documento(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    old = o.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("estado"), F.lit("viejo").alias("lado"))
    new = o.where("o_custkey % 5 = 0").select(F.col("o_orderkey").alias("id"), F.lit("X").alias("estado"), F.lit("nuevo").alias("lado"))
    more = o.where("o_custkey % 7 = 0").select((F.col("o_orderkey") + 1000000000).alias("id"), F.lit("Y").alias("estado"), F.lit("nuevo").alias("lado"))
    return publish.upsert(old, new.unionByName(more), ["id"])


@query("SELECT r_regionkey AS clave, r_name AS nombre, NULL::VARCHAR AS region FROM region UNION ALL SELECT n_nationkey, n_name, n_regionkey::VARCHAR FROM nation")
def union_por_nombre(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("clave"), F.col("r_name").alias("nombre"))
    b = table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("region"), F.col("n_name").alias("nombre"), F.col("n_nationkey").alias("clave"))
    return a.unionByName(b, allowMissingColumns=True)


@query(f"WITH {ITEMS_SQL}, s AS (SELECT barra, date_trunc('month', fecha)::DATE AS m, count(*) AS cuartos, {AVERAGES_SQL} FROM li GROUP BY 1, 2) SELECT barra, m::VARCHAR AS mes, cuartos, {rounded()} FROM s")
def mes_barra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.monthly_tables(items_series(spark, sf_dir).drop("mes"))[0]


@query(f"WITH {ITEMS_SQL} SELECT barra, date_trunc('month', fecha)::DATE::VARCHAR AS mes, bloque, {STATS_SQL} FROM li GROUP BY ALL")
def mes_bloque(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.monthly_tables(items_series(spark, sf_dir).drop("mes"))[1]


@query("""WITH reg AS (SELECT o_orderkey AS k, o_orderstatus AS tipo FROM orders WHERE o_orderstatus <> 'F'), fnd AS (SELECT o_orderkey AS k, o_orderpriority AS tipo FROM orders WHERE o_orderpriority <> '1-URGENT')
SELECT 'u' || coalesce(reg.k, fnd.k) AS url, coalesce(fnd.tipo, reg.tipo) AS tipo, CASE WHEN reg.k IS NULL THEN '2026-02-01' ELSE '2026-01-01' END AS primera, CASE WHEN fnd.k IS NULL THEN '2026-01-01' ELSE '2026-02-01' END AS ultima,
(CASE WHEN reg.k IS NULL THEN 0 ELSE 2 END + CASE WHEN fnd.k IS NULL THEN 0 ELSE 1 END)::BIGINT AS veces FROM reg FULL JOIN fnd ON reg.k = fnd.k""")
def nombres_no_reconocidos(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("url", F.concat(F.lit("u"), F.col("o_orderkey").cast("string")))
    reg = o.where("o_orderstatus <> 'F'").select("url", F.col("o_orderstatus").alias("tipo"), F.lit("2026-01-01").alias("primera"), F.lit("2026-01-01").alias("ultima"), F.lit(2).alias("veces"))
    return publish.seen_names(reg, o.where("o_orderpriority <> '1-URGENT'").select("url", F.col("o_orderpriority").alias("tipo"), F.lit("2026-02-01").alias("visto")))


@query(f"WITH {MANIFEST_SQL}, h AS (SELECT strftime(fecha_operacion, '%Y-%m') AS mes, 'reglas:2024-08-01,' || array_to_string(list_sort(list(sha256)), ',') AS huella FROM man GROUP BY 1) SELECT mes, huella FROM h WHERE mes >= '1998-01'")
def meses_cambiados(spark: SparkSession, sf_dir: str) -> DataFrame:
    man = orders_manifest(spark, sf_dir)
    state = man.where("fecha_operacion < DATE '1998-01-01'").groupBy(F.date_format("fecha_operacion", "yyyy-MM").alias("mes")).agg(F.concat(F.array(F.lit("reglas:2024-08-01")), F.sort_array(F.collect_list("sha256"))).alias("huella"))
    return ingest.changed_months(man, state).withColumn("huella", F.array_join("huella", ","))


@query(f"WITH {MANIFEST_SQL} SELECT nombre, sha256(nombre || tipo) AS huella FROM man")
def sha256_huella(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_manifest(spark, sf_dir).select("nombre", F.sha2(F.concat("nombre", "tipo").cast("binary"), 256).alias("huella"))


# Names, pages, search ----------------------------------------------------------------------------------------------------------

_RENAMES_SQL = ", ".join(f"('{a}', '{b}')" for a, b in domain.RENAMED.items())
_BUS_SQL = "CASE (p_partkey % 3)::INT WHEN 0 THEN 'REÑACA________110' WHEN 1 THEN 'TAP_CHAÑARES__110' ELSE upper(p_name) END"


@query(f"WITH r(a, b) AS (VALUES {_RENAMES_SQL}), p AS (SELECT p_partkey, {_BUS_SQL} AS barra FROM part) SELECT p_partkey, coalesce(b, barra) AS canonico FROM p LEFT JOIN r ON a = barra")
def canonico(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", domain.official_name(F.expr(_BUS_SQL)).alias("canonico"))


_FILE_SQL = """nombres AS (SELECT o_orderkey, 'Antecedentes_CMG_Real_' || CASE (o_orderkey % 6)::INT WHEN 0 THEN 'def_' || ymd WHEN 1 THEN 'pre_' || ymd || '_v2-1' WHEN 2 THEN 'prel_V3_' || ymd WHEN 3 THEN 'pre' || ymd
  WHEN 4 THEN 'def-v3_v2' ELSE 'otro_' || ymd END || '.zip' AS nombre, CASE (o_custkey % 4)::INT WHEN 0 THEN 'Costo Marginal Real Definitivo – V2' WHEN 1 THEN 'Costo Marginal Real Preliminar' WHEN 2 THEN 'sin datos' ELSE 'Real Definitivo v4' END AS etiqueta
  FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN YMD8 WHEN o_orderkey % 7 = 0 THEN '25406' ELSE YMD6 END AS ymd FROM orders))"""
_FILE_DUCK = _FILE_SQL.replace("YMD8", "strftime(o_orderdate, '%Y%m%d')").replace("YMD6", "'0' || substr(strftime(o_orderdate + INTERVAL 5 YEAR, '%Y%m%d'), 4, 5)")
_FILE_SPARK = _FILE_SQL.replace("YMD8", "date_format(o_orderdate, 'yyyyMMdd')").replace("YMD6", "'0' || substr(date_format(o_orderdate + INTERVAL 5 YEAR, 'yyyyMMdd'), 4, 5)")


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql("WITH " + _FILE_SPARK.replace("FROM orders", "FROM {orders}") + " SELECT * FROM nombres", orders=table(spark, sf_dir, "orders"))


_PARSED_SQL = """p AS (SELECT o_orderkey, nombre, etiqueta, CASE WHEN nombre LIKE '%Real\\_otro%' ESCAPE '\\' THEN 'desconocido' WHEN nombre LIKE '%Real\\_def%' ESCAPE '\\' THEN 'def' ELSE 'pre' END AS tn,
  CASE WHEN nombre LIKE '%\\_v2-1.zip' ESCAPE '\\' THEN 2 WHEN nombre LIKE '%prel\\_V3%' ESCAPE '\\' OR nombre LIKE '%def-v3%' THEN 3 ELSE 1 END AS vn, CASE WHEN nombre LIKE '%\\_v2-1.zip' ESCAPE '\\' THEN 1 ELSE 0 END AS reemision,
  CASE WHEN etiqueta LIKE '%Costo Marginal Real Definitivo%' THEN 'def' WHEN etiqueta LIKE '%Costo Marginal Real Preliminar%' THEN 'pre' END AS te, CASE WHEN etiqueta LIKE '%V2' THEN 2 WHEN etiqueta LIKE '%v4' THEN 4 ELSE 1 END AS ve FROM nombres)"""


@query(f"WITH {_FILE_DUCK}, {_PARSED_SQL} SELECT o_orderkey, coalesce(te, tn) AS tipo, (CASE WHEN te IS NULL THEN vn WHEN tn <> 'desconocido' THEN greatest(vn, ve) ELSE ve END)::INT AS version, reemision::INT AS reemision FROM p")
def clasificar_documento(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _names(spark, sf_dir).select("o_orderkey", names.classify(F.col("nombre"), F.col("etiqueta")).alias("c")).select("o_orderkey", "c.*")


@query(f"""WITH {_FILE_DUCK}, d AS (SELECT o_orderkey, CASE WHEN nombre LIKE '%otro%' OR nombre LIKE '%def-v3%' THEN '' ELSE regexp_extract(replace(nombre, '_v2-1', ''), '([0-9]+)[.]zip', 1) END AS digitos FROM nombres)
SELECT o_orderkey, digitos, CASE length(digitos) WHEN 8 THEN try_strptime(digitos, '%Y%m%d')::DATE::VARCHAR WHEN 6 THEN try_strptime('20' || digitos, '%Y%m%d')::DATE::VARCHAR END AS fecha FROM d""")
def fecha_del_nombre(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = _names(spark, sf_dir).select("o_orderkey", names.read_name(F.col("nombre"))["fecha"].alias("digitos"))
    return read.withColumn("fecha", names.date_of_digits(F.col("digitos")))


@query(r"""SELECT DISTINCT page_id, CASE WHEN x[1] IN ('"', chr(39)) THEN x[2:-2] ELSE x END AS href
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<[aA]\s(?:[^>]*\s)?[hH][rR][eE][fF]\s*=\s*("[^"]*"|\x27[^\x27]*\x27|[^\s"\x27>]+)', 1)) AS x FROM pages)""")
def enlaces_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link targets as a parser reads them, quoted or not."""
    return bronze.links(table(spark, sf_dir, "pages"), "page_id").select("page_id", "href")


@query("SELECT DISTINCT p_name AS nombre, trim(regexp_replace(translate(upper(p_name || ' Ñandú_é'), 'ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ', 'AAAAAAEEEEIIIIOOOOOUUUUNCY'), '[^0-9A-Z]+', ' ', 'g')) AS normalizado FROM part")
def normalizar(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("nombre")).distinct()
    return p.select("nombre", search.normalized_expr(F.concat("nombre", F.lit(" Ñandú_é"))).alias("normalizado"))


@query()
def buscar_difuso(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "part"), "sml widgt", 10, "p_name")


@query()
def buscar_menu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.menu_search(table(spark, sf_dir, "part"), "red wid", 15, "p_name")


@query()
def documentos_de_paginas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the pages by the parser, with their block's text."""
    return bronze.links(table(spark, sf_dir, "pages"), "page_id").select("page_id", "n", "href", "titulo", F.length("texto").cast("long").alias("n_texto"))


# The stored layout --------------------------------------------------------------------------------------------------------------

DATED_SQL = f"""{ITEMS_SQL}, s AS (SELECT *, CASE WHEN day(fecha) % 3 = 0 THEN 'pagina_cen_pre' WHEN day(fecha) % 3 = 1 THEN 'pagina_cen_def' ELSE 'maestro_cmg_db' END AS origen,
  CASE WHEN day(fecha) % 4 > 0 THEN (900 + day(fecha))::DOUBLE END AS usd_clp FROM li)"""


def dated_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items' series with an origin and a rate by day."""
    d = F.dayofmonth("fecha")
    origin = F.when(d % 3 == 0, "pagina_cen_pre").when(d % 3 == 1, "pagina_cen_def").otherwise("maestro_cmg_db")
    return items_series(spark, sf_dir).withColumn("origen", origin).withColumn("usd_clp", F.when(d % 4 > 0, (900 + d).cast("double"))).withColumn("ingerido_en", F.localtimestamp())


def stored(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The series written to a base of its own by the engine, and read back by it."""
    base = silver.scratch_base(spark)
    silver.write_months(dated_series(spark, sf_dir), base)
    return base, silver.scan(spark, base)


@query(f"WITH {ITEMS_SQL} SELECT anio, mes, count(*) AS filas, min(anio * 100 + mes) OVER () AS primero, max(anio * 100 + mes) OVER () AS ultimo FROM li GROUP BY anio, mes")
def meses_escritos(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, series = stored(spark, sf_dir)
    first, last = silver.available_range(spark, base)
    months = spark.createDataFrame(silver.written_months(spark, base), "anio int, mes int")
    counts = series.groupBy("anio", "mes").agg(F.count(F.lit(1)).alias("filas"))
    return months.join(counts, ["anio", "mes"]).withColumn("primero", F.lit(first[0] * 100 + first[1])).withColumn("ultimo", F.lit(last[0] * 100 + last[1]))


@query(f"WITH {ITEMS_SQL} SELECT true AS existe, count(*) AS filas FROM li WHERE anio = 1996 AND mes = 3")
def filas_del_mes(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = stored(spark, sf_dir)
    return spark.createDataFrame([(silver.base_exists(spark, base), silver.month_rows(spark, base, (1996, 3)))], "existe boolean, filas long")


@query(f"""WITH {ITEMS_SQL}, s AS (SELECT anio, mes, count(*) AS cuartos, {AVERAGES_SQL} FROM li WHERE barra = 'N.O' AND anio * 100 + mes BETWEEN 199602 AND 199710 GROUP BY ALL)
SELECT anio, mes, cuartos, {rounded()}, make_date(anio, mes, 1)::VARCHAR AS fecha FROM s""")
def resumen_almacenado(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.monthly_summary(stored(spark, sf_dir)[1], "N.O", (1996, 2), (1997, 10))


@query(f"""WITH {DATED_SQL} SELECT barra, fecha::VARCHAR AS fecha, hora, minuto, bloque, round(cmg_usd_mwh, 6) AS cmg_usd_mwh, es_hora_extra, strftime(fecha_hora, '%Y-%m-%d %H:%M:%S') AS fecha_hora,
round(usd_clp, 6) AS usd_clp, origen FROM s WHERE barra = 'R.F' AND anio = 1995 AND mes = 5""")
def serie_almacenada(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.series_of(stored(spark, sf_dir)[1], "R.F", (1995, 5), (1995, 5))


@query(f"""WITH {ITEMS_SQL} SELECT barra, fecha::VARCHAR AS fecha, hora, minuto, bloque, round(cmg_usd_mwh::FLOAT::DOUBLE, 4) AS cmg_usd_mwh, es_hora_extra, strftime(fecha_hora, '%Y-%m-%d %H:%M:%S') AS fecha_hora,
'maestro_cmg_db' AS origen FROM li""")
def historia_normalizada(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = items_series(spark, sf_dir).withColumn("cmg_usd_mwh", F.col("cmg_usd_mwh").cast("float"))
    return silver.from_history(old).drop("ingerido_en").withColumn("cmg_usd_mwh", F.round("cmg_usd_mwh", 4))


@query(f"""WITH {ITEMS_SQL}, nuevo AS (SELECT barra, fecha, hora, minuto, cmg_usd_mwh + 1 AS p FROM li WHERE fecha = DATE '1996-03-05' AND hora < 12)
SELECT barra, fecha::VARCHAR AS fecha, hora, minuto, round(cmg_usd_mwh, 6) AS cmg_usd_mwh FROM li WHERE anio = 1996 AND mes = 3 AND fecha <> DATE '1996-03-05' UNION ALL SELECT barra, fecha::VARCHAR, hora, minuto, round(p, 6) FROM nuevo""")
def mes_con_dia_nuevo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's rows replace that day in its month, by the engine's own rewrite."""
    base, series = stored(spark, sf_dir)
    new = series.where("fecha = DATE '1996-03-05' AND hora < 12 AND anio = 1996 AND mes = 3").withColumn("cmg_usd_mwh", F.col("cmg_usd_mwh") + 1).drop("anio", "mes")
    ingest.merge_day_rows(base)(new, 0)
    return silver.scan(spark, base).where("anio = 1996 AND mes = 3").select("barra", "fecha", "hora", "minuto", "cmg_usd_mwh")


@query(f"WITH {ITEMS_SQL}, b AS (SELECT min(fecha) AS a, max(fecha) AS z FROM li) SELECT strftime(m, '%Y-%m') AS periodo, m::DATE::VARCHAR AS desde, (m + INTERVAL 1 MONTH)::DATE::VARCHAR AS hasta FROM b, unnest(generate_series(date_trunc('month', a), date_trunc('month', z), INTERVAL 1 MONTH)) t(m)")
def meses_del_rango(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, z = items_series(spark, sf_dir).agg(F.min("fecha"), F.max("fecha")).first()
    rows = [(domain.format_month(m), *domain.month_bounds(m)) for m in domain.months_between((a.year, a.month), (z.year, z.month))]
    return spark.createDataFrame(rows, "periodo string, desde date, hasta date")


@query("""WITH o AS (SELECT o_orderdate::DATE AS f FROM orders), b AS (SELECT min(f) AS a, max(f) AS z FROM o)
SELECT max(greatest(date_trunc('month', f)::DATE, a))::VARCHAR AS desde, min(least(last_day(f), z))::VARCHAR AS hasta, count(*) AS filas FROM o, b GROUP BY date_trunc('month', f)""")
def tramos_por_mes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders' span cut by month, with the orders of each piece."""
    held = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("f"))
    pieces = spark.createDataFrame(domain.month_tranches(*held.agg(F.min("f"), F.max("f")).first()), "desde date, hasta date")
    counts = held.groupBy(F.trunc("f", "month").alias("m")).agg(F.count(F.lit(1)).alias("filas"))
    return pieces.join(counts, F.trunc("desde", "month") == F.col("m")).select("desde", "hasta", "filas")


@query(f"WITH {DATED_SQL} SELECT barra, fecha::VARCHAR AS fecha, hora, minuto, bloque, round(cmg_usd_mwh, 6) AS cmg_usd_mwh, origen FROM s WHERE anio = 1997")
def vista_servicio(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = dated_series(spark, sf_dir).where("anio = 1997")
    known = spark.sql("SELECT 7 AS barra_id, 'R.F' AS nombre")
    buses, origins = publish.assign_ids(known, s.select(F.col("barra").alias("nombre"))), publish.origins(spark)
    return publish.serving_view(publish.encode(s, buses, origins), buses, origins)


@query(f"WITH {DATED_SQL} SELECT fecha::VARCHAR AS fecha, min(origen) AS origen, round(max(usd_clp), 6) AS usd_clp FROM s GROUP BY 1")
def inventario_dias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.day_inventory(dated_series(spark, sf_dir))


@query(f"WITH {DATED_SQL} SELECT fecha::VARCHAR AS fecha FROM s GROUP BY fecha HAVING min(origen) = 'pagina_cen_pre' AND max(origen) = 'pagina_cen_pre'")
def dias_consistentes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.consistent_days(dated_series(spark, sf_dir), "pagina_cen_pre")


@query(f"WITH {DATED_SQL} SELECT DISTINCT fecha::VARCHAR AS fecha FROM s WHERE origen = 'pagina_cen_pre' AND fecha BETWEEN DATE '1995-02-03' AND DATE '1996-07-09'")
def dias_preliminares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.preliminary_days(publish.day_inventory(dated_series(spark, sf_dir)), date(1995, 2, 3), date(1996, 7, 9))


@query(f"WITH {DATED_SQL} SELECT fecha::VARCHAR AS fecha, max(usd_clp) AS usd_clp FROM s WHERE usd_clp IS NOT NULL GROUP BY 1")
def tipos_de_cambio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.exchange_rates(dated_series(spark, sf_dir))


@query(f"WITH {ITEMS_SQL} SELECT DISTINCT barra FROM li WHERE date_trunc('month', fecha) BETWEEN DATE '1995-05-01' AND DATE '1995-06-20'")
def barras_con_datos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.buses_with_data(publish.monthly_tables(items_series(spark, sf_dir).drop("mes"))[0], date(1995, 5, 10), date(1995, 6, 20))


@query(f"""WITH {DATED_SQL}, v AS (SELECT fecha, min(origen) AS o, max(usd_clp) AS t FROM s GROUP BY 1)
SELECT barra, s.fecha::VARCHAR AS fecha, hora, minuto, round(cmg_usd_mwh, 6) AS cmg_usd_mwh, CASE o WHEN 'pagina_cen_def' THEN 'Definitivo' WHEN 'pagina_cen_pre' THEN 'Preliminar' ELSE 'Maestro (historico)' END AS version, t AS usd_clp
FROM s JOIN v USING (fecha) WHERE anio = 1996 AND mes = 2""")
def serie_con_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarters of a month with each day's version and exchange rate."""
    s = dated_series(spark, sf_dir).where("anio = 1996 AND mes = 2")
    documents = spark.createDataFrame([], "fecha_operacion date, tipo string, version int, reemision int")
    versions_ = publish.versions_by_day(publish.day_inventory(s), documents)
    return publish.with_versions(s.select("barra", "fecha", "hora", "minuto", "cmg_usd_mwh"), versions_)


@query("""SELECT o_orderdate::DATE::VARCHAR AS fecha, o_orderkey AS id, CASE o_custkey % 3 WHEN 0 THEN 'pagina_cen_pre' WHEN 1 THEN 'maestro_cmg_db' ELSE 'pagina_cen_def' END AS despues,
CASE o_custkey % 4 WHEN 1 THEN 'maestro_cmg_db' WHEN 2 THEN 'pagina_cen_def' WHEN 3 THEN 'pagina_cen_pre' END AS antes FROM orders WHERE o_orderdate BETWEEN DATE '1996-01-05' AND DATE '1996-09-05'""")
def revisiones(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    after = F.when(F.col("o_custkey") % 3 == 0, 3).otherwise(F.col("o_custkey") % 3)
    before = F.when(F.col("o_custkey") % 4 > 0, F.col("o_custkey") % 4)
    changes = o.select(F.to_date("o_orderdate").alias("fecha"), F.col("o_orderkey").alias("id"), after.cast("smallint").alias("origen_despues"), before.cast("smallint").alias("origen_antes"))
    return publish.revisions(changes, publish.origins(spark), date(1996, 1, 5), date(1996, 9, 5))


@query(f"""WITH {ITEMS_SQL}, x AS (SELECT CASE WHEN l % 11 = 0 THEN NULL ELSE barra END AS barra, fecha, CASE WHEN l % 7 = 0 THEN 25 ELSE hora END AS hora, CASE WHEN l % 5 = 0 THEN 7 ELSE minuto END AS minuto, bloque,
CASE WHEN l % 3 = 0 THEN NULL ELSE cmg_usd_mwh END AS p FROM (SELECT *, year(fecha) * 372 + month(fecha) * 31 + day(fecha) + hora AS l FROM li))
SELECT count(*) FILTER (barra IS NULL) AS clave_nula, count(*) FILTER (hora NOT BETWEEN 0 AND 24) AS hora_fuera, count(*) FILTER (minuto NOT IN (0, 15, 30, 45)) AS minuto_fuera,
count(*) FILTER (coalesce(bloque, '') NOT IN ('A', 'B', 'C')) AS bloque_fuera, count(*) FILTER (p IS NULL) AS precio_nulo FROM x""")
def violaciones_dominio(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.year("fecha") * 372 + F.month("fecha") * 31 + F.dayofmonth("fecha") + F.col("hora")
    held = items_series(spark, sf_dir).withColumn("l", code)
    bad = held.withColumn("barra", F.when(F.col("l") % 11 > 0, F.col("barra"))).withColumn("hora", F.when(F.col("l") % 7 == 0, 25).otherwise(F.col("hora")))
    bad = bad.withColumn("minuto", F.when(F.col("l") % 5 == 0, 7).otherwise(F.col("minuto"))).withColumn("cmg_usd_mwh", F.when(F.col("l") % 3 > 0, F.col("cmg_usd_mwh")))
    return domain_violations(bad)


@query(f"""WITH {ITEMS_SQL}, q AS (SELECT barra, fecha, hora, count(*) AS n FROM li GROUP BY ALL), d AS (SELECT barra, fecha, count(*) AS n FROM li GROUP BY ALL)
SELECT (SELECT count(*) FROM li) AS filas, (SELECT count(*) FROM q WHERE n <> 4) AS horas_incompletas, 0 AS claves_duplicadas""")
def resumen_calidad(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = items_series(spark, sf_dir)
    found = quality.summary(series, quality.expected_calendar(series))
    return spark.createDataFrame([(found["filas"], found["horas_incompletas"], found["claves_duplicadas"])], "filas long, horas_incompletas long, claves_duplicadas int")


@query("""SELECT CASE o_custkey % 3 WHEN 0 THEN 'critico' WHEN 1 THEN 'advertencia' ELSE 'info' END AS severidad, o_orderstatus AS tipo, 'en <archivo> del <fecha>' AS detalle, 'ver' AS accion, count(*) AS veces, len(list(DISTINCT 'f' || o_orderkey % 5))::INT AS archivos
FROM orders GROUP BY 1, 2""")
def informe_hallazgos(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    severity = F.element_at(F.array(F.lit("critico"), F.lit("advertencia"), F.lit("info")), (F.col("o_custkey") % 3 + 1).cast("int"))
    detail = F.concat(F.lit("en archivo_"), F.col("o_orderkey").cast("string"), F.lit(".zip del "), F.to_date("o_orderdate").cast("string"))
    found = o.select(severity.alias("severidad"), F.col("o_orderstatus").alias("tipo"), detail.alias("detalle"), F.lit("").alias("evidencia"), F.lit("ver").alias("accion"), F.concat(F.lit("f"), (F.col("o_orderkey") % 5).cast("string")).alias("archivo"))
    return quality.report(found).withColumn("archivos", F.size("archivos"))


@query("""SELECT DISTINCT o_orderdate::DATE::VARCHAR AS fecha, day(o_orderdate) || '-' || list_value('enero', 'febrero', 'marzo', 'abril', 'mayo', 'junio', 'julio', 'agosto', 'septiembre', 'octubre', 'noviembre', 'diciembre')[month(o_orderdate)] || '-' || year(o_orderdate) AS slug,
CASE WHEN year(o_orderdate) >= 2000 THEN o_orderdate::DATE::VARCHAR ELSE ('20' || strftime(o_orderdate, '%y-%m-%d')) END AS dia_de_url FROM orders WHERE strftime(o_orderdate, '%m-%d') <> '02-29'""")
def direcciones_de_dia(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's address, and the day read back from a page's address (two digits of the year: this century)."""
    d = F.to_date("o_orderdate")
    days = table(spark, sf_dir, "orders").where(F.date_format(d, "MM-dd") != "02-29").select(d.alias("fecha")).distinct()
    url = F.concat(F.lit("https://www.example.org/cmg-999999-"), F.date_format("fecha", "yyMMdd"), F.lit("/"))
    return days.select("fecha", names.day_slug(F.col("fecha")).alias("slug"), names.day_of_url(url).alias("dia_de_url"))


@query("""WITH d AS (SELECT DISTINCT o_orderdate::DATE AS f FROM orders), s AS (SELECT f, year(f) || '-costo-' || CASE WHEN year(f) < 1998 THEN 'a' ELSE 'b' END AS y,
list_value('enero', 'febrero', 'marzo', 'abril', 'mayo', 'junio', 'julio', 'agosto', 'septiembre', 'octubre', 'noviembre', 'diciembre')[month(f)] AS m FROM d)
SELECT f::VARCHAR AS fecha, 'https://x/' || y || '/' AS anio, 'https://x/' || y || '/' || m || '-' || y || '/' AS mes,
'https://x/' || y || '/' || m || '-' || y || '/' || strftime(f, '%d') || '-' || m || '-' || y || '/' AS dia FROM s""")
def direcciones_de_paginas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of each day with an order, of its month and its year; years' addresses end in one of two ways."""
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("fecha")).distinct()
    ends = {y: "-costo-a" if y < 1998 else "-costo-b" for y in range(1990, 2010)}
    return days.select("fecha", names.page_addresses(F.col("fecha"), ends, "https://x").alias("p")).select("fecha", "p.*")


@query("SELECT o_orderkey AS id, CASE WHEN o_custkey % 4 < 3 THEN o_orderdate::DATE::VARCHAR END AS leida FROM orders")
def fechas_escritas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written in three ways, and one way that is not read."""
    d = F.to_date("o_orderdate")
    forms = F.array(F.date_format(d, "yyyy-MM-dd"), F.date_format(d, "dd-MM-yyyy"), F.concat(F.lit(" "), F.date_format(d, "dd/MM/yyyy")), F.date_format(d, "yyyy.MM"))
    text = F.element_at(forms, (F.col("o_custkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), domain.parse_date(text).alias("leida"))


@query("SELECT o_orderkey AS id, 'falta <archivo> del <fecha>' AS detalle FROM orders")
def detalle_enmascarado(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("falta def_"), F.col("o_orderkey").cast("string"), F.lit("_v2.zip del "), F.to_date("o_orderdate").cast("string"))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), names.masked(text).alias("detalle"))


def _days_without_midnight(first: int, last: int, zone: str = calendar.ZONE) -> list[date]:
    """Days whose clock starts at 01:00, by Python's copy of the zone's history: the SQL's side of the comparison."""
    z, utc = ZoneInfo(zone), ZoneInfo("UTC")
    every = (date(first, 1, 1) + timedelta(days=i) for i in range((date(last + 1, 1, 1) - date(first, 1, 1)).days))
    return [d for d in every if datetime(d.year, d.month, d.day, tzinfo=z).astimezone(utc).astimezone(z).hour != 0]


@query(f"""WITH {ITEMS_SQL} SELECT barra, fecha::VARCHAR AS fecha, hora, minuto FROM li
WHERE NOT (hora = 0 AND fecha IN ({', '.join(f"DATE '{d}'" for d in _days_without_midnight(1990, 2010))}))""")
def sin_horas_fantasma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.drop_ghost_hours(items_series(spark, sf_dir)).select("barra", "fecha", "hora", "minuto")


LOADS_SQL = """d AS (SELECT DISTINCT fecha, origen FROM s), k AS (SELECT year(fecha)::INT AS anio, month(fecha)::INT AS mes, count(*)::INT AS dias,
count(*) FILTER (origen = 'pagina_cen_pre')::INT AS dias_preliminar FROM d GROUP BY 1, 2)"""


@query(f"""WITH {DATED_SQL}, {LOADS_SQL}, m AS (SELECT barra, anio, mes, make_date(anio, mes, 1) AS f, count(*) AS cuartos, {AVERAGES_SQL} FROM s GROUP BY ALL)
SELECT barra, f::VARCHAR AS fecha, m.anio, m.mes, cuartos, {", ".join(f'{R6(chr(34) + c + chr(34))} AS "{c}"' for c in ROUNDED)}, dias, dias_preliminar
FROM m LEFT JOIN (SELECT * FROM k WHERE mes <> 7) k USING (anio, mes)""")
def vista_mensual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly averages with names beside each month's load record; months without a record stay."""
    s = dated_series(spark, sf_dir)
    buses, origins = publish.assign_ids(spark.createDataFrame([], "barra_id int, nombre string"), s.select(F.col("barra").alias("nombre"))), publish.origins(spark)
    encoded = publish.encode(s, buses, origins)
    by_bus = publish.monthly_tables(encoded.withColumnRenamed("barra_id", "barra"))[0].withColumnsRenamed({"barra": "barra_id", "mes": "fecha"})
    days = encoded.groupBy("fecha").agg(F.min("origen_id").alias("origen_id"))
    loads = days.groupBy(F.year("fecha").alias("anio"), F.month("fecha").alias("mes")).agg(F.count(F.lit(1)).cast("int").alias("dias"), F.count_if(F.col("origen_id") == 3).cast("int").alias("dias_preliminar"))
    return publishing.monthly_view(by_bus, buses, loads.where("mes <> 7"))


@query(f"""WITH {DATED_SQL}, n AS (SELECT *, cmg_usd_mwh + (CASE WHEN day(fecha) % 5 = 0 AND hora % 2 = 0 THEN hora + 1 ELSE 0 END) AS n FROM s WHERE hora < 20)
SELECT fecha::VARCHAR AS fecha, count(*) AS cuartos, count(*) FILTER (n <> cmg_usd_mwh) AS cuartos_distintos, round(max(abs(n - cmg_usd_mwh)), 6) AS dif_max_usd,
{R6('avg(abs(n - cmg_usd_mwh)) FILTER (n <> cmg_usd_mwh)')} AS dif_prom_usd, CASE day(fecha) % 3 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS origen_despues,
CASE WHEN day(fecha) % 6 = 1 THEN 3 WHEN day(fecha) % 3 = 0 THEN 3 WHEN day(fecha) % 3 = 1 THEN 2 ELSE 1 END AS origen_antes FROM n GROUP BY fecha
HAVING count(*) FILTER (n <> cmg_usd_mwh) > 0 OR day(fecha) % 6 = 1""")
def dias_revisados(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose prices or origin differ from what is loaded."""
    s = dated_series(spark, sf_dir)
    buses, origins = publish.assign_ids(spark.createDataFrame([], "barra_id int, nombre string"), s.select(F.col("barra").alias("nombre"))), publish.origins(spark)
    old = publish.encode(s, buses, origins)
    d = F.dayofmonth("fecha")
    new = old.where("hora < 20").withColumn("cmg_usd_mwh", F.col("cmg_usd_mwh") + F.when((d % 5 == 0) & (F.col("hora") % 2 == 0), F.col("hora") + 1).otherwise(0))
    before = old.groupBy("fecha").agg(F.min("origen_id").alias("origen_id")).withColumn("origen_id", F.when(d % 6 == 1, 3).otherwise(F.col("origen_id"))).withColumn("documento", F.lit(None).cast("string"))
    none = spark.createDataFrame([], "fecha date, documento string, publicado date")
    out = publishing.revised_days(new, old, before, none, datetime(2026, 1, 1))
    return out.select("fecha", "cuartos", "cuartos_distintos", "dif_max_usd", "dif_prom_usd", F.col("origen_despues").cast("int").alias("origen_despues"), F.col("origen_antes").cast("int").alias("origen_antes"))


@query(f"""WITH {EVENTS_SQL}, s AS (SELECT *, 'pagina_cen_def' AS origen FROM ev) SELECT barra, date_trunc('month', fecha)::DATE::VARCHAR AS fecha, anio, mes, count(*) AS cuartos,
{", ".join(f'{R6(x)} AS "{c}"' for c, x in (("A", "avg(cmg_usd_mwh) FILTER (bloque = 'A')"), ("B", "avg(cmg_usd_mwh) FILTER (bloque = 'B')"), ("C", "avg(cmg_usd_mwh) FILTER (bloque = 'C')"), ("Solar", "avg(cmg_usd_mwh) FILTER (bloque = 'B')"), ("NoSolar", "avg(cmg_usd_mwh) FILTER (bloque IN ('A', 'C'))"), ("Total", "avg(cmg_usd_mwh)")))},
(SELECT count(DISTINCT e.fecha)::INT FROM ev e WHERE e.anio = s.anio AND e.mes = s.mes) AS dias, 0 AS dias_preliminar FROM s GROUP BY barra, date_trunc('month', fecha), anio, mes""")
def publicado(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole publication of the events' months, read back through the serving view."""
    base, serving = silver.scratch_base(spark), silver.scratch_base(spark)
    series = events_series(spark, sf_dir).withColumn("origen", F.lit("pagina_cen_def")).withColumn("ingerido_en", F.localtimestamp())
    silver.write_months(series, base)
    publishing.publish_changed(spark, base, serving, datetime(2026, 1, 1))
    return publishing.monthly_view(*(publishing.read(spark, serving, t) for t in ("mes_barra", "barra", "carga_mes")))


@query(f"""WITH {EVENTS_SQL}, b AS (SELECT *, CASE WHEN day(fecha) % 5 = 0 THEN cmg_usd_mwh * 2 ELSE cmg_usd_mwh END AS doble FROM ev)
SELECT v::INT AS carga, barra, fecha::VARCHAR AS fecha, count(*) AS cuartos, {R6("avg(CASE v WHEN 1 THEN cmg_usd_mwh ELSE doble END)")} AS promedio,
CASE WHEN v = 2 AND day(fecha) % 5 = 0 THEN (SELECT count(*) FROM ev e WHERE e.fecha = b.fecha) END AS cuartos_revisados FROM b, range(1, 3) AS r(v) GROUP BY v, barra, b.fecha""")
def publicado_instantaneas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the events' month: the second doubles every fifth day. Each is read at its own snapshot."""
    base, serving = silver.scratch_base(spark), silver.scratch_base(spark)
    series = events_series(spark, sf_dir).withColumn("origen", F.lit("pagina_cen_def")).withColumn("ingerido_en", F.localtimestamp())
    twice = F.when(F.dayofmonth("fecha") % 5 == 0, 2).otherwise(1)
    reads = []
    for load in (1, 2):
        silver.write_months(series if load == 1 else series.withColumn("cmg_usd_mwh", F.col("cmg_usd_mwh") * twice), base)
        publishing.publish_changed(spark, base, serving, datetime(2026, 1, load))
    for load in (1, 2):
        at = snapshots.as_of(spark, serving, datetime(2026, 1, load))
        held = publishing.read(spark, serving, "cuarto", at).join(F.broadcast(publishing.read(spark, serving, "barra", at)), "barra_id")
        by_day = held.groupBy(F.lit(load).alias("carga"), F.col("nombre").alias("barra"), "fecha").agg(F.count(F.lit(1)).alias("cuartos"), F.avg("cmg_usd_mwh").alias("promedio"))
        revised = publishing.read(spark, serving, "revision", at).select("fecha", F.col("cuartos_distintos").alias("cuartos_revisados"))
        reads.append(by_day.join(F.broadcast(revised), "fecha", "left"))
    return reads[0].unionByName(reads[1]).select("carga", "barra", "fecha", "cuartos", "promedio", "cuartos_revisados")


@query(f"""WITH {EVENTS_SQL} SELECT barra, fecha::VARCHAR AS fecha, hora, minuto, bloque, round(cmg_usd_mwh, 6) AS cmg_usd_mwh, day(fecha)::DOUBLE AS usd_clp, 'pagina_cen_def' AS origen,
(row_number() OVER (PARTITION BY fecha ORDER BY barra, hora, minuto) * 2)::BIGINT AS linea FROM ev WHERE fecha BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""")
def series_de_archivos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as day files, which tasks write to the shared folder, and a range of days read back by the data source. Every other line of a
    file is one of separators alone."""
    folder = silver.scratch_base(spark)
    series = events_series(spark, sf_dir).select("barra", "fecha", "hora", "minuto", F.col("cmg_usd_mwh").alias("p"))
    series.groupBy("fecha").applyInPandas(_day_file(folder), "archivo string").collect()  # names, one a day
    first, last = date(2024, 1, 5), date(2024, 1, 25)
    raw = dayfiles.day_rows(spark, folder, "def", first, last)
    read = bronze.to_series(raw, "def").select("barra", "fecha", "hora", "minuto", "bloque", "cmg_usd_mwh", "usd_clp", "origen")
    lines = raw.select(F.col("BARRA").alias("barra"), F.col("dia").alias("fecha"), F.col("HORA").cast("short").alias("hora"), F.col("MINUTO").cast("short").alias("minuto"), (F.col("linea") - 1).alias("linea"))
    return read.join(lines, ["barra", "fecha", "hora", "minuto"]).withColumn("hora", F.col("hora").cast("int")).withColumn("minuto", F.col("minuto").cast("int"))


def _day_file(folder: str) -> Callable:
    def write(pdf):
        day = pdf["fecha"].iloc[0].strftime("%Y%m%d")
        rows = pdf.sort_values(["barra", "hora", "minuto"], kind="stable")
        text = "FECHA;HORA;MINUTO;BARRA;CMG_REAL_DEF[USD/MWh];USD\n" + "".join(f";;;;;\n{day};{h};{m};{b};{p!r};{int(day[6:])}\n" for b, h, m, p in zip(rows["barra"], rows["hora"], rows["minuto"], rows["p"].astype(float), strict=True))
        where, path = dayfiles.opened(f"{folder}/Antecedentes_CMG_Real_def_{day[2:]}.zip")
        where.create_dir(path.rpartition("/")[0], recursive=True)
        with where.open_output_stream(path) as out:
            out.write(dayfiles.zipped(f"CmgBarrasComparativo_{day}_{day}_15.csv", text))
        return pd.DataFrame({"archivo": [path]})

    return write


@query(f"""WITH {MANIFEST_SQL}, lim AS (SELECT min(fecha_operacion) AS a, max(fecha_operacion) AS z FROM man),
dias AS (SELECT unnest(generate_series(a::TIMESTAMP, z::TIMESTAMP, INTERVAL 1 DAY))::DATE AS f FROM lim),
k AS (SELECT *, row_number() OVER (PARTITION BY fecha_operacion ORDER BY CASE tipo WHEN 'def' THEN 2 WHEN 'pre' THEN 1 ELSE 0 END DESC, version DESC, reemision DESC, fecha_publicacion DESC, nombre DESC) AS r FROM man),
d AS (SELECT f, bool_or(tipo NOT IN ('def', 'pre')) AS dudoso, count(nombre) AS n, coalesce(bool_or(tipo = 'def'), false) AS final FROM dias LEFT JOIN man ON fecha_operacion = f GROUP BY 1)
SELECT f::VARCHAR AS fecha_operacion, CASE WHEN NOT dudoso THEN nombre END AS nombre, coalesce(dudoso, false) AS dudoso,
CASE WHEN n = 0 AND z - f > 3 THEN 'sin_archivo' WHEN n > 0 AND NOT final AND z - f > 25 THEN 'pre_sin_definitivo' END AS alarma FROM d, lim LEFT JOIN k ON fecha_operacion = f AND r = 1""")
def versiones_en_flujo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All published files in an order of arrival that their days and versions do not have, as a stream in three parts on one checkpoint."""
    root, source = silver.scratch_base(spark), silver.scratch_base(spark)
    man = orders_manifest(spark, sf_dir)
    first, last = man.agg(F.min("fecha_operacion"), F.max("fecha_operacion")).first()
    part = F.pmod(F.xxhash64("nombre"), F.lit(3))
    columns = [x.split(" ")[0] for x in day_versions.EVENTS.split(", ")]
    day_versions.ticks(spark, first, last, datetime(first.year, first.month, first.day)).write.mode("append").parquet(source)
    for i in range(3):
        seen = datetime(last.year, last.month, last.day) - timedelta(days=2 - i)
        man.where(part == i).withColumn("visto", F.lit(seen).cast("timestamp")).select(*columns).write.mode("append").parquet(source)
        day_versions.track(spark.readStream.schema(day_versions.EVENTS).parquet(source), root, f"{root}/_control")
    return day_versions.known_days(spark, root).select("fecha_operacion", "nombre", "dudoso", "alarma")


CAUSES_SQL = """have AS (SELECT fecha FROM li GROUP BY 1 HAVING count(*) % 7 <> 0), e AS (SELECT unnest(generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '1998-12-31', INTERVAL 1 DAY))::DATE AS f),
c AS (SELECT f, CASE WHEN f < DATE '1996-01-01' THEN 'maestro' WHEN f IN (SELECT o_orderdate::DATE FROM orders GROUP BY 1 HAVING count(*) % 2 = 1) THEN 'sin_ingerir' ELSE 'sin_descargar' END AS causa FROM e WHERE f NOT IN (SELECT fecha FROM have)),
g AS (SELECT *, f - (row_number() OVER (PARTITION BY causa ORDER BY f))::INT AS k FROM c), runs AS (SELECT causa, min(f) AS desde, max(f) AS hasta, count(*) AS dias FROM g GROUP BY causa, k)"""


def _gaps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Days of the series whose quarters are no multiple of seven, and files of the days with an odd number of orders."""
    present = items_series(spark, sf_dir).groupBy("fecha").agg(F.count(F.lit(1)).alias("n")).where("n % 7 <> 0")
    manifest = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("fecha_operacion")).agg(F.count(F.lit(1)).alias("n")).where("n % 2 = 1")
    return present.select("fecha"), manifest.select("fecha_operacion")


@query(f"WITH {ITEMS_SQL}, {CAUSES_SQL} SELECT causa, desde::VARCHAR AS desde, hasta::VARCHAR AS hasta, dias FROM runs")
def tramos_faltantes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of missing days by cause."""
    return watch.missing_by_cause(*_gaps(spark, sf_dir), date(1994, 1, 1), date(1998, 12, 31), date(1996, 1, 1))


@query(f"""WITH {ITEMS_SQL}, {CAUSES_SQL} SELECT 'advertencia' AS severidad, CASE causa WHEN 'maestro' THEN 'dias_sin_datos_maestro' ELSE 'dias_descargados_sin_ingerir' END AS tipo,
dias || ' dia(s)' AS detalle, CASE WHEN desde = hasta THEN desde::VARCHAR ELSE desde || ' a ' || hasta END AS evidencia FROM runs WHERE causa <> 'sin_descargar'""")
def hallazgos_cobertura(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watch.coverage_findings(watch.missing_by_cause(*_gaps(spark, sf_dir), date(1994, 1, 1), date(1998, 12, 31), date(1996, 1, 1)))


@query(f"""WITH {ITEMS_SQL}, have AS (SELECT fecha FROM li GROUP BY 1 HAVING count(*) % 7 <> 0), e AS (SELECT unnest(generate_series(TIMESTAMP '1991-06-01', TIMESTAMP '1998-12-31', INTERVAL 1 DAY))::DATE AS f)
SELECT * FROM (SELECT strftime(f, '%Y-%m') AS periodo, CASE WHEN count(fecha) = 0 THEN 'vacio' WHEN count(fecha) < count(*) THEN 'incompleto' END AS estado, count(fecha) AS con_datos, count(*) AS esperados
FROM e LEFT JOIN have ON f = fecha GROUP BY 1) WHERE estado IS NOT NULL""")
def meses_con_huecos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months without any day, or with some only."""
    return watch.month_gaps(versions.coverage(*_gaps(spark, sf_dir), date(1991, 6, 1), date(1998, 12, 31)))


@query("""WITH b AS (SELECT o_orderkey AS k, 'f' || (o_orderkey // 4) AS nombre, o_orderpriority AS etiqueta, o_orderdate::DATE AS d FROM orders),
was AS (SELECT nombre, min(etiqueta) AS e, min(d) AS d FROM b WHERE k % 4 < 2 GROUP BY 1), now AS (SELECT nombre, min(etiqueta) AS e, min(d) AS d FROM b WHERE k % 4 > 0 GROUP BY 1),
x AS (SELECT nombre, was.e AS e1, now.e AS e2, was.d AS d1, now.d AS d2 FROM was FULL JOIN now USING (nombre))
SELECT 'critico' AS severidad, 'base_documento_ausente' AS tipo, nombre AS detalle, '' AS evidencia FROM x WHERE e2 IS NULL
UNION ALL SELECT 'info', 'base_revision_en_referencia', nombre, '' FROM x WHERE e1 IS NULL
UNION ALL SELECT 'advertencia', 'base_etiqueta_distinta', nombre, e1 || ' -> ' || e2 FROM x WHERE e1 <> e2
UNION ALL SELECT 'advertencia', 'base_fecha_publicacion_distinta', nombre, d1 || ' -> ' || d2 FROM x WHERE d1 <> d2""")
def documentos_de_referencia(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known documents against those found: gone, changed, new."""
    o = table(spark, sf_dir, "orders").withColumn("nombre", F.concat(F.lit("f"), F.floor(F.col("o_orderkey") / 4).cast("string")))
    of = lambda held, day: held.groupBy("nombre").agg(F.min("o_orderpriority").alias("etiqueta"), F.min(F.to_date("o_orderdate")).alias(day))
    return watch.compare_documents(of(o.where("o_orderkey % 4 > 0"), "fecha_publicacion"), of(o.where("o_orderkey % 4 < 2"), "publicado"))


@query("""SELECT o_orderkey AS id, CASE o_custkey % 3 WHEN 0 THEN 'Preliminar' WHEN 1 THEN 'Definitivo' ELSE 'otro' END AS "Origen", CASE o_custkey % 4 WHEN 0 THEN '' ELSE 'Maestro (historico)' END AS "Antes",
round(o_totalprice, 2) AS "CMg [USD/MWh]" FROM orders""")
def encabezados(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers and origins in words."""
    c = F.col("o_custkey")
    held = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(c % 3 == 0, "pagina_cen_pre").when(c % 3 == 1, "pagina_cen_def").otherwise("otro").alias("origen"), F.when(c % 4 > 0, "maestro_cmg_db").alias("antes"), F.round(F.col("o_totalprice").cast("double"), 2).alias("cmg_usd_mwh"))
    return reports.readable(held)


@query("SELECT o_orderkey AS id, replace(format('{:,}', o_custkey::BIGINT * 9973), ',', '.') AS miles FROM orders")
def miles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), domain.thousands(F.col("o_custkey").cast("long") * 9973).alias("miles"))


@query(f"""WITH {DATED_SQL}, v AS (SELECT fecha, min(origen) AS o, max(usd_clp) AS t FROM s GROUP BY 1), a AS (SELECT * FROM s WHERE barra = 'R.F'), b AS (SELECT * FROM s WHERE barra = 'A.F')
SELECT a.fecha::VARCHAR AS fecha, a.hora, a.minuto, a.cmg_usd_mwh AS cmg_referencia, b.cmg_usd_mwh AS cmg_comparada, round(b.cmg_usd_mwh - a.cmg_usd_mwh, 6) AS riesgo_usd_mwh,
CASE o WHEN 'pagina_cen_def' THEN 'Definitivo' WHEN 'pagina_cen_pre' THEN 'Preliminar' ELSE 'Maestro (historico)' END AS version, t AS usd_clp
FROM a JOIN b USING (fecha, hora, minuto) JOIN v USING (fecha)""")
def riesgo_por_dias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk by quarter over all days that the table has, with each day's version and rate."""
    s = dated_series(spark, sf_dir)
    documents = spark.createDataFrame([], "fecha_operacion date, tipo string, version int, reemision int")
    by_day = publish.versions_by_day(publish.day_inventory(s), documents)
    out = reports.range_risk_series(s, "R.F", "A.F", versions=by_day)
    return out.select("fecha", "hora", "minuto", "cmg_referencia", "cmg_comparada", "riesgo_usd_mwh", "version", "usd_clp")


@query("""WITH m AS (SELECT o_orderdate::DATE AS d, CASE o_orderstatus WHEN 'O' THEN 2 WHEN 'F' THEN 1 ELSE 0 END AS r, substr(o_orderpriority, 1, 1)::INT AS v, (o_custkey % 3)::INT AS i, (o_orderdate::DATE + (o_orderkey % 10)::INT)::VARCHAR AS p, 'f' || o_orderkey AS n FROM orders)
SELECT n AS nombre, d::VARCHAR AS fecha_operacion FROM m ORDER BY m.d DESC, r DESC, v DESC, i DESC, p DESC, n DESC LIMIT 1""")
def ultimo_archivo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest version of the latest day."""
    return watch.latest_file(orders_manifest(spark, sf_dir))
