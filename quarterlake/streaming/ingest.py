"""Incremental ingest: files that arrive late reopen their months, without a watermark, as lateness has no bound."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.sources import silver

RULES = "2024-08-01"


def month_fingerprint(shas: list[str], rules: str = RULES) -> list[str]:
    """What a month was built from: the rules' date and the sorted hashes of its files."""
    return [f"reglas:{rules}", *sorted(shas)]


def changed_months(chosen: DataFrame, state: DataFrame, rules: str = RULES) -> DataFrame:
    """Months (AAAA-MM) of chosen files (fecha_operacion, sha256) whose fingerprint differs from the stored (mes, huella)."""
    now = chosen.groupBy(F.date_format("fecha_operacion", "yyyy-MM").alias("mes")).agg(F.concat(F.array(F.lit(f"reglas:{rules}")), F.sort_array(F.collect_list("sha256"))).alias("huella"))
    return now.join(state.withColumnRenamed("huella", "antes"), "mes", "left").where("antes IS NULL OR antes <> huella").select("mes", "huella")


def sha256_bytes(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def merge_day_rows(base: str):
    """A ``foreachBatch`` writer: each batch's days replace those days of their months; other days stay. Replaying a batch gives the
    same months."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        held = batch.persist()
        try:
            months = [(r["y"], r["m"]) for r in held.select(F.year("fecha").alias("y"), F.month("fecha").alias("m")).distinct().collect()]
            for month in sorted(months):
                new = held.where((F.year("fecha") == month[0]) & (F.month("fecha") == month[1]))
                if month in silver.written_months(spark, base):
                    old = spark.read.schema(silver.SERIES_READ).parquet(silver.month_path(base, month)).join(F.broadcast(new.select("fecha").distinct()), "fecha", "left_anti")
                    new = new.unionByName(old.drop("anio", "mes"), allowMissingColumns=True)
                silver.write_month(new, base, month)
        finally:
            held.unpersist()

    return write


def ingest_available(spark: SparkSession, source: str, schema, base: str, checkpoint: str) -> None:
    """All files that came since the last run, then stop; the checkpoint advances only after a batch's months are in place."""
    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(merge_day_rows(base)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
