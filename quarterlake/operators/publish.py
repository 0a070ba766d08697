"""The serving star as Parquet tables: dictionary encoding, upserts, revisions, monthly results, views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterlake.operators.gold import PRICE, block_averages
from quarterlake.operators.versions import version_label
from quarterlake.schema import ORIGINS


def origins(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"({i}S, '{n}')" for i, n in ORIGINS) + " AS t(origen_id, nombre)")


def assign_ids(known: DataFrame, names: DataFrame) -> DataFrame:
    """Known names keep their ids; new ones follow in order of name. A bus list is a few thousand rows."""
    new = names.select("nombre").distinct().join(known, "nombre", "left_anti")
    top = known.agg(F.coalesce(F.max("barra_id"), F.lit(0)).alias("m")).scalar()
    numbered = new.select((F.row_number().over(Window.orderBy("nombre")) + top).cast("int").alias("barra_id"), "nombre")
    return known.select(F.col("barra_id").cast("int").alias("barra_id"), "nombre").unionByName(numbered)


def encode(series: DataFrame, buses: DataFrame, spark_origins: DataFrame) -> DataFrame:
    """Names to numbers. A row without a partner raises, so no row is lost on the way."""
    held = series.join(F.broadcast(buses.withColumnRenamed("nombre", "barra")), "barra", "left").join(F.broadcast(spark_origins.withColumnRenamed("nombre", "origen")), "origen", "left")
    known = lambda c, what: F.when(F.col(c).isNotNull(), F.col(c)).otherwise(F.raise_error(F.concat(F.lit("no number for "), F.coalesce(F.col(what), F.lit("null")))))
    return held.select(known("barra_id", "barra").cast("int").alias("barra_id"), "fecha", "hora", "minuto", "bloque", PRICE, known("origen_id", "origen").cast("smallint").alias("origen_id"))


def upsert(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New rows replace those of the same key."""
    return existing.join(new.select(*key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)


def seen_names(registry: DataFrame, found: DataFrame) -> DataFrame:
    """Registry of unknown links by url (url, tipo, primera, ultima, veces): first and last sight and the number of sights."""
    a, b = registry.alias("a"), found.groupBy("url").agg(F.max("tipo").alias("tipo"), F.max("visto").alias("visto")).alias("b")
    return a.join(b, "url", "full_outer").select("url", F.coalesce("b.tipo", "a.tipo").alias("tipo"), F.coalesce("a.primera", "b.visto").alias("primera"), F.coalesce("b.visto", "a.ultima").alias("ultima"), (F.coalesce("a.veces", F.lit(0)) + F.col("b.visto").isNotNull().cast("int")).cast("long").alias("veces"))


def orphans(buses: DataFrame, facts: DataFrame, key: str = "barra_id") -> DataFrame:
    return buses.join(facts.select(key).distinct(), key, "left_anti")


def day_inventory(series: DataFrame) -> DataFrame:
    """Origin and exchange rate of each day."""
    return series.groupBy("fecha").agg(F.min("origen").alias("origen"), F.max("usd_clp").alias("usd_clp")).orderBy("fecha")


def consistent_days(series: DataFrame, expected: str) -> DataFrame:
    return series.groupBy("fecha").agg(F.min("origen").alias("a"), F.max("origen").alias("b")).where((F.col("a") == F.col("b")) & (F.col("a") == expected)).select("fecha")


def monthly_tables(series: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(month by bus, month by bus and block), both from the quarters."""
    month = F.trunc("fecha", "month").alias("mes")
    by_bus = series.groupBy("barra", month).agg(F.count(F.lit(1)).alias("cuartos"), *block_averages())
    by_block = series.groupBy("barra", month, "bloque").agg(F.count(F.lit(1)).alias("cuartos"), F.avg(PRICE).alias("promedio"), F.stddev_samp(PRICE).alias("desviacion"), F.min(PRICE).alias("minimo"), F.max(PRICE).alias("maximo"), F.count_if(F.col(PRICE) == 0).alias("en_cero"))
    return by_bus, by_block


def serving_view(facts: DataFrame, buses: DataFrame, spark_origins: DataFrame) -> DataFrame:
    """Quarters with names again."""
    return facts.join(F.broadcast(buses.withColumnRenamed("nombre", "barra")), "barra_id").join(F.broadcast(spark_origins.withColumnRenamed("nombre", "origen")), "origen_id").select("barra", "fecha", "hora", "minuto", "bloque", PRICE, "origen")


def versions_by_day(inventory: DataFrame, documents: DataFrame) -> DataFrame:
    """(fecha, version, usd_clp): the version's label from the day's document, where there is one."""
    docs = documents.select(F.col("fecha_operacion").alias("fecha"), "tipo", "version", "reemision")
    return inventory.join(docs, "fecha", "left").select("fecha", version_label().alias("version"), "usd_clp").orderBy("fecha")


def with_versions(series: DataFrame, versions: DataFrame) -> DataFrame:
    return series.join(versions, "fecha", "left")


def remove_before(series: DataFrame, first) -> DataFrame:
    return series.where(F.col("fecha") >= F.lit(first))


def revisions(changes: DataFrame, spark_origins: DataFrame, first, last) -> DataFrame:
    """Revisions (fecha, origen_antes, origen_despues, ...) of a day range with origins by name; the first load has none before."""
    after = spark_origins.select(F.col("origen_id").alias("origen_despues"), F.col("nombre").alias("despues"))
    before = spark_origins.select(F.col("origen_id").alias("origen_antes"), F.col("nombre").alias("antes"))
    held = changes.where(F.col("fecha").between(F.lit(first), F.lit(last)))
    return held.join(F.broadcast(after), "origen_despues").join(F.broadcast(before), "origen_antes", "left").drop("origen_antes", "origen_despues").orderBy("fecha")


def preliminary_days(inventory: DataFrame, first, last) -> DataFrame:
    return inventory.where(F.col("fecha").between(F.lit(first), F.lit(last)) & (F.col("origen") == "pagina_cen_pre")).select("fecha").orderBy("fecha")


def buses_with_data(by_bus: DataFrame, first, last) -> DataFrame:
    """From the monthly table, which is small: months that the range touches."""
    return by_bus.where((F.col("mes") >= F.trunc(F.lit(first).cast("date"), "month")) & (F.col("mes") <= F.lit(last))).select("barra").distinct().orderBy("barra")


def exchange_rates(series: DataFrame) -> DataFrame:
    return series.where("usd_clp IS NOT NULL").groupBy("fecha").agg(F.max("usd_clp").alias("usd_clp"))
