"""The driver's tables in the forms that the operators work on, and the same as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.functions.domain import block_of_hour, extra_hour, local_time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _canonical(df: DataFrame) -> DataFrame:
    day, hour, minute = F.col("fecha"), F.col("hora"), F.col("minuto")
    return df.select("barra", "fecha", "hora", "minuto", block_of_hour(hour).alias("bloque"), "cmg_usd_mwh", extra_hour(hour).alias("es_hora_extra"), local_time(day, hour, minute).alias("fecha_hora"), F.year(day).alias("anio"), F.month(day).alias("mes"))


def events_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean event value a quarter of an hour; a type is a bus. One month."""
    e = table(spark, sf_dir, "events")
    keys = [F.col("event_type").alias("barra"), F.to_date("ts").alias("fecha"), F.hour("ts").alias("hora"), (F.floor(F.minute("ts") / 15) * 15).cast("int").alias("minuto")]
    return _canonical(e.groupBy(*keys).agg(F.avg("value").alias("cmg_usd_mwh")))


def items_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least discount (in percent, with many exact zeros) a quarter; flag and status are a bus. Seven years."""
    li = table(spark, sf_dir, "lineitem")
    keys = [F.concat("l_returnflag", F.lit("."), "l_linestatus").alias("barra"), F.to_date("l_shipdate").alias("fecha"), (F.col("l_partkey") % 24).cast("int").alias("hora"), ((F.col("l_linenumber") % 4) * 15).cast("int").alias("minuto")]
    return _canonical(li.groupBy(*keys).agg(F.round(F.min("l_discount") * 100, 6).alias("cmg_usd_mwh")))


def orders_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as published files: status is the type (O = def, F = pre, P = unknown), the priority's digit the version."""
    o = table(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderstatus") == "O", "def").when(F.col("o_orderstatus") == "F", "pre").otherwise("desconocido")
    return o.select(F.to_date("o_orderdate").alias("fecha_operacion"), kind.alias("tipo"), F.substring("o_orderpriority", 1, 1).cast("int").alias("version"), (F.col("o_custkey") % 3).cast("int").alias("reemision"), F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 10).cast("int")).alias("fecha_publicacion"), F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("nombre"), F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"))


BLOCK_SQL = "CASE WHEN hora BETWEEN 8 AND 17 THEN 'B' WHEN hora BETWEEN 18 AND 22 THEN 'C' WHEN hora BETWEEN 0 AND 24 THEN 'A' END"
_TAIL_SQL = f"""SELECT barra, fecha, hora, minuto, {BLOCK_SQL} AS bloque, cmg_usd_mwh, hora = 24 AS es_hora_extra,
    CASE WHEN hora < 24 THEN fecha::TIMESTAMP + to_hours(hora) + to_minutes(minuto) END AS fecha_hora, year(fecha)::INT AS anio, month(fecha)::INT AS mes"""
EVENTS_SQL = f"""ev AS ({_TAIL_SQL} FROM (
  SELECT event_type AS barra, ts::DATE AS fecha, hour(ts)::INT AS hora, (minute(ts) // 15 * 15)::INT AS minuto, avg(value) AS cmg_usd_mwh FROM events GROUP BY ALL))"""
ITEMS_SQL = f"""li AS ({_TAIL_SQL} FROM (
  SELECT l_returnflag || '.' || l_linestatus AS barra, l_shipdate::DATE AS fecha, (l_partkey % 24)::INT AS hora, (l_linenumber % 4 * 15)::INT AS minuto, round(min(l_discount) * 100, 6) AS cmg_usd_mwh
  FROM lineitem GROUP BY ALL))"""
MANIFEST_SQL = """man AS (SELECT o_orderdate::DATE AS fecha_operacion, CASE o_orderstatus WHEN 'O' THEN 'def' WHEN 'F' THEN 'pre' ELSE 'desconocido' END AS tipo,
  substr(o_orderpriority, 1, 1)::INT AS version, (o_custkey % 3)::INT AS reemision, o_orderdate::DATE + (o_orderkey % 10)::INT AS fecha_publicacion, 'f' || o_orderkey AS nombre,
  sha256(o_orderkey::VARCHAR) AS sha256 FROM orders)"""
