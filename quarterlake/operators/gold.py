"""Results computed from the quarters themselves, never from averages of averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlake.functions.domain import Month, period_filter

PRICE = "cmg_usd_mwh"
TOTAL = "Rango completo"
ORDER = ("fecha", "hora", "minuto")


def in_period(series: DataFrame, first: Month | None, last: Month | None) -> DataFrame:
    return series if first is None or last is None else series.where(period_filter(first, last))


def block_averages(price: str = PRICE) -> list[Column]:
    """A, B, C, Solar (= B), NoSolar (A and C quarters together) and Total in one pass."""
    of = lambda *blocks: F.avg(F.when(F.col("bloque").isin(*blocks), F.col(price)))
    return [of("A").alias("A"), of("B").alias("B"), of("C").alias("C"), of("B").alias("Solar"), of("A", "C").alias("NoSolar"), F.avg(price).alias("Total")]


def series_of(series: DataFrame, bus: str, first: Month | None = None, last: Month | None = None) -> DataFrame:
    """One bus's quarters in order; the repeated hour comes after 23."""
    cols = ["barra", *ORDER, "bloque", PRICE, "es_hora_extra", "fecha_hora", *[c for c in ("usd_clp", "origen") if c in series.columns]]
    return in_period(series.where(F.col("barra") == bus), first, last).select(*cols).orderBy(*ORDER)


def monthly_summary(series: DataFrame, bus: str, first: Month | None = None, last: Month | None = None) -> DataFrame:
    held = in_period(series.where(F.col("barra") == bus), first, last)
    out = held.groupBy("anio", "mes").agg(F.count(F.lit(1)).alias("cuartos"), *block_averages())
    return out.withColumn("fecha", F.make_date("anio", "mes", F.lit(1))).orderBy("anio", "mes")


def block_statistics(held: DataFrame, by: Sequence[str]) -> DataFrame:
    return held.groupBy(*by).agg(F.count(F.lit(1)).alias("cuartos"), F.avg(PRICE).alias("promedio"), F.stddev_samp(PRICE).alias("desviacion"), F.min(PRICE).alias("minimo"), F.max(PRICE).alias("maximo"), F.count_if(F.col(PRICE) == 0).alias("en_cero")).orderBy(*by)


def monthly_block_detail(series: DataFrame, bus: str, first: Month | None = None, last: Month | None = None) -> DataFrame:
    return block_statistics(in_period(series.where(F.col("barra") == bus), first, last), ["anio", "mes", "bloque"])


def compare_buses(series: DataFrame, buses: Sequence[str], first: Month | None = None, last: Month | None = None) -> DataFrame:
    """One column of monthly averages a bus; a bus named twice is one column."""
    names = list(dict.fromkeys(buses))
    if not names:
        raise ValueError("no bus to compare")
    held = in_period(series.where(F.col("barra").isin(names)), first, last)
    return held.groupBy("anio", "mes").pivot("barra", names).agg(F.avg(PRICE)).orderBy("anio", "mes")


def _pair(series: DataFrame, reference: str, compared: str) -> DataFrame:
    """Only quarters that both buses have: half-empty rows would read as no risk. One scan of both buses; a quarter occurs once a bus."""
    is_ref, is_comp = F.col("barra") == reference, F.col("barra") == compared
    others = [c for c in series.columns if c not in (*ORDER, "barra", PRICE)]
    of_ref = [F.max(F.when(is_ref, F.col(c))).alias(c) for c in others]
    prices = [F.max(F.when(x, F.col(PRICE))).alias(c) for x, c in ((is_ref, "cmg_referencia"), (is_comp, "cmg_comparada"))]
    held = series.where(F.col("barra").isin(reference, compared)).groupBy(*ORDER).agg(*of_ref, *prices, F.bool_or(is_ref).alias("a"), F.bool_or(is_comp).alias("b"))
    return held.where("a AND b").drop("a", "b")


def risk_series(series: DataFrame, reference: str, compared: str, first: Month | None = None, last: Month | None = None) -> DataFrame:
    """Risk = compared - reference; its share is null where the reference is 0."""
    both = _pair(in_period(series, first, last), reference, compared)
    diff = F.col("cmg_comparada") - F.col("cmg_referencia")
    return both.select(*ORDER, "bloque", "es_hora_extra", "fecha_hora", "cmg_referencia", "cmg_comparada", diff.alias("riesgo_usd_mwh"), F.try_divide(diff, F.col("cmg_referencia")).alias("riesgo_pct")).orderBy(*ORDER)


def _risk_aggregates() -> list[Column]:
    ref, comp = F.avg("cmg_referencia"), F.avg("cmg_comparada")
    diff = F.col("cmg_comparada") - F.col("cmg_referencia")
    return [F.count(F.lit(1)).alias("cuartos"), ref.alias("cmg_referencia"), comp.alias("cmg_comparada"), (comp - ref).alias("riesgo_usd_mwh"), F.try_divide(comp - ref, ref).alias("riesgo_pct"), F.min(diff).alias("riesgo_minimo"), F.max(diff).alias("riesgo_maximo"), F.count_if(F.col("cmg_referencia") == 0).alias("ref_en_cero")]


def risk_summary(series: DataFrame, reference: str, compared: str, first: Month | None = None, last: Month | None = None) -> DataFrame:
    """By month and the reference's block; the share is that of the averages."""
    out = _pair(in_period(series, first, last), reference, compared).groupBy("anio", "mes", "bloque").agg(*_risk_aggregates())
    return out.withColumn("fecha", F.make_date("anio", "mes", F.lit(1))).orderBy("anio", "mes", "bloque")


def without_percentage(series: DataFrame, reference: str, first: Month | None = None, last: Month | None = None) -> DataFrame:
    held = in_period(series.where(F.col("barra") == reference), first, last)
    return held.agg(F.count_if(F.col(PRICE) == 0).alias("en_cero"), F.count(F.lit(1)).alias("total"))


def _between(series: DataFrame, first, last) -> DataFrame:
    return series.where(F.col("fecha").between(F.lit(first), F.lit(last)))


def _labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("periodo", F.coalesce("periodo", F.lit(TOTAL)))


def range_blocks(series: DataFrame, bus: str, first, last) -> DataFrame:
    """Months and the whole range (last) in one pass; no rows, no total."""
    held = _between(series.where(F.col("barra") == bus), first, last).withColumn("periodo", F.date_format("fecha", "yyyy-MM"))
    out = held.rollup("periodo").agg(F.count(F.lit(1)).alias("cuartos"), *block_averages()).where("cuartos > 0")
    return _labelled(out).orderBy(F.col("periodo") == TOTAL, "periodo")


def range_blocks_many(series: DataFrame, buses: Sequence[str] | None, first, last) -> DataFrame:
    held = _between(series if buses is None else series.where(F.col("barra").isin(list(buses))), first, last).withColumn("periodo", F.date_format("fecha", "yyyy-MM"))
    out = held.groupingSets([["barra", "periodo"], ["barra"]], "barra", "periodo").agg(F.count(F.lit(1)).alias("cuartos"), *block_averages())
    return _labelled(out).orderBy("barra", F.col("periodo") == TOTAL, "periodo")


def range_statistics(series: DataFrame, bus: str, first, last) -> DataFrame:
    return block_statistics(_between(series.where(F.col("barra") == bus), first, last), ["bloque"])


def range_risk_summary(series: DataFrame, reference: str, compared: str, first, last) -> DataFrame:
    held = _pair(_between(series, first, last), reference, compared).withColumn("periodo", F.date_format("fecha", "yyyy-MM"))
    out = held.groupingSets([["periodo", "bloque"], ["bloque"]], "periodo", "bloque").agg(*_risk_aggregates())
    return _labelled(out).orderBy(F.col("periodo") == TOTAL, "periodo", "bloque")


def base_summary(series: DataFrame) -> DataFrame:
    """Rows, buses, and the months of the span against those with data."""
    index = F.col("anio") * 12 + F.col("mes") - 1
    return series.agg(F.count(F.lit(1)).alias("filas"), F.count_distinct("barra").alias("barras"), (F.max(index) - F.min(index) + 1).cast("long").alias("meses_del_rango"), F.count_distinct("anio", "mes").alias("meses_con_datos"))


def bus_summary(series: DataFrame, buses: Sequence[str], first: Month | None = None, last: Month | None = None) -> DataFrame:
    held = in_period(series.where(F.col("barra").isin(list(buses))), first, last)
    return held.groupBy("barra").agg(F.count(F.lit(1)).alias("cuartos"), F.min("fecha").alias("desde"), F.max("fecha").alias("hasta"), F.avg(PRICE).alias("promedio"), F.count_if("es_hora_extra").alias("cuartos_hora_extra")).orderBy("barra")


def export_statistics(series: DataFrame) -> DataFrame:
    return series.agg(F.count(F.lit(1)).alias("cuartos"), F.avg(PRICE).alias("promedio"), F.min(PRICE).alias("minimo"), F.max(PRICE).alias("maximo"), F.count_if(F.col(PRICE) == 0).alias("en_cero"), F.sum(F.col("es_hora_extra").cast("long")).alias("cuartos_hora_extra"))


def wide_series(series: DataFrame, columns: Sequence[str], first, last) -> DataFrame:
    """One column a bus, in the given order; an absent bus is a column of nulls. Two prices for one quarter raise."""
    names = list(dict.fromkeys(columns))
    held = _between(series.where(F.col("barra").isin(names)), first, last)
    one = F.when(F.count(PRICE) > 1, F.raise_error(F.lit("a quarter of a bus has two prices"))).otherwise(F.first(PRICE, ignorenulls=True))
    keys = held.groupBy(*ORDER, "bloque", "barra").agg(one.cast("double").alias(PRICE))
    wide = keys.groupBy(*ORDER, "bloque").pivot("barra", names).agg(F.first(PRICE))
    return wide.orderBy(*ORDER)


def buses(series: DataFrame) -> DataFrame:
    return series.select("barra").distinct().orderBy("barra")


def find_buses(series: DataFrame, text: str, limit: int = 40) -> DataFrame:
    """Names that contain the text, in either case, with the number of all that do."""
    names = series.select("barra").distinct().where(F.upper("barra").contains(text.upper()))
    return names.select("barra", names.agg(F.count(F.lit(1))).scalar().alias("total")).orderBy("barra").limit(limit)


def bus_exists(series: DataFrame, bus: str) -> bool:
    """Stops at the first row."""
    return not series.where(F.col("barra") == bus).select(F.lit(1)).isEmpty()
