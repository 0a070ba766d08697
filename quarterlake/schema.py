"""The stored contract: columns of the series, its keys, and the small serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types of the series' file columns; timestamps have no zone, so that the repeated hour and the missing one are never shifted.
SERIES = T.StructType([
    T.StructField("barra", T.StringType(), False),
    T.StructField("fecha", T.DateType(), False),
    T.StructField("hora", T.ShortType(), False),
    T.StructField("minuto", T.ShortType(), False),
    T.StructField("bloque", T.StringType()),
    T.StructField("cmg_usd_mwh", T.DoubleType()),
    T.StructField("es_hora_extra", T.BooleanType()),
    T.StructField("fecha_hora", T.TimestampNTZType()),
    T.StructField("usd_clp", T.DoubleType()),
    T.StructField("origen", T.StringType()),
    T.StructField("ingerido_en", T.TimestampNTZType()),
])
PARTITION = ("anio", "mes")
SERIES_READ = T.StructType([*SERIES.fields, T.StructField("anio", T.IntegerType()), T.StructField("mes", T.IntegerType())])
KEY = ("barra", "fecha", "hora", "minuto")
OPTIONAL = ("usd_clp",)
MINUTES = (0, 15, 30, 45)
MAX_HOUR = 24
ORIGIN_DEFINITIVE, ORIGIN_PRELIMINARY, ORIGIN_HISTORY = "pagina_cen_def", "pagina_cen_pre", "maestro_cmg_db"
#: The origins' numbers in the serving tables.
ORIGINS = ((1, ORIGIN_HISTORY), (2, ORIGIN_DEFINITIVE), (3, ORIGIN_PRELIMINARY))

MANIFEST = T.StructType([T.StructField(n, t) for n, t in (("url", T.StringType()), ("nombre", T.StringType()), ("tipo", T.StringType()), ("version", T.IntegerType()), ("reemision", T.IntegerType()), ("fecha_operacion", T.DateType()), ("fecha_publicacion", T.DateType()), ("sha256", T.StringType()), ("bytes", T.LongType()), ("descargado_en", T.TimestampNTZType()))])
FINDING = T.StructType([T.StructField(n, T.StringType()) for n in ("severidad", "tipo", "detalle", "evidencia", "accion", "archivo")])
SEVERITIES = ("critico", "advertencia", "info")


def conform(df: DataFrame) -> DataFrame:
    """The file columns in order and type. Optional columns may be absent and become null; any other absence is an error."""
    absent = [f.name for f in SERIES if f.name not in df.columns and f.name not in OPTIONAL]
    if absent:
        raise ValueError(f"columns are missing: {', '.join(absent)}")
    return df.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in SERIES))


def domain_violations(df: DataFrame) -> DataFrame:
    """One row of counts: what table constraints would reject (nulls in the key, hour, minute, block, null price)."""
    null_key = F.lit(False)
    for c in KEY:
        null_key = null_key | F.col(c).isNull()
    return df.agg(
        F.count_if(null_key).alias("clave_nula"),
        F.count_if(~F.col("hora").between(0, MAX_HOUR)).alias("hora_fuera"),
        F.count_if(~F.col("minuto").isin(*MINUTES)).alias("minuto_fuera"),
        F.count_if(~F.coalesce(F.col("bloque"), F.lit("")).isin("A", "B", "C")).alias("bloque_fuera"),
        F.count_if(F.col("cmg_usd_mwh").isNull()).alias("precio_nulo"),
    )
