"""Which version of a day counts, what is missing, and runs of days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarterlake.functions.calendar import days

SOURCE_START = date(2024, 8, 1)
GRACE_DAYS, PRELIMINARY_DAYS = 3, 25


def version_order() -> Column:
    """def over pre, then version, re-issue and publication date: the greatest counts."""
    rank = F.when(F.col("tipo") == "def", 2).when(F.col("tipo") == "pre", 1).otherwise(0)
    return F.struct(rank.alias("r"), F.col("version").alias("v"), F.col("reemision").alias("i"), F.coalesce(F.col("fecha_publicacion").cast("string"), F.lit("")).alias("p"), F.col("nombre").alias("n"))


def doubtful_days(manifest: DataFrame) -> DataFrame:
    """Days with a file of unknown type, and those files."""
    odd = ~F.coalesce(F.col("tipo").isin("def", "pre"), F.lit(False))
    return manifest.where(odd).groupBy("fecha_operacion").agg(F.sort_array(F.collect_list("nombre")).alias("nombres"))


def choose_by_day(manifest: DataFrame, start: date | None = SOURCE_START) -> DataFrame:
    """The winning file of each day; days with a doubtful file are left out whole."""
    held = manifest if start is None else manifest.where(F.col("fecha_operacion") >= F.lit(start))
    known = F.coalesce(F.col("tipo").isin("def", "pre"), F.lit(False))
    best = held.groupBy("fecha_operacion").agg(F.max_by(F.struct(*[c for c in held.columns if c != "fecha_operacion"]), version_order()).alias("w"), F.bool_and(known).alias("sure"))
    return best.where("sure").select("fecha_operacion", "w.*").orderBy("fecha_operacion")


def day_islands(present: DataFrame, day: str = "fecha") -> DataFrame:
    """Runs of consecutive days; the work is done a year at a time, then runs that touch at new year are joined."""
    d = F.col(day)
    one = present.select(d.alias("d")).distinct()
    w = W.partitionBy(F.year("d")).orderBy("d")
    runs = one.withColumn("k", F.date_sub("d", F.row_number().over(w))).groupBy(F.year("d").alias("y"), "k").agg(F.min("d").alias("desde"), F.max("d").alias("hasta"))
    return _join_runs(runs, F.col("desde"), lambda before: F.date_add(before, 1)).withColumn("dias", (F.datediff("hasta", "desde") + 1).cast("long")).orderBy("desde")


def _join_runs(runs: DataFrame, start: Column, following) -> DataFrame:
    """A run for each start that does not follow another run's end: as few rows as there are runs."""
    w = W.orderBy("desde")
    fresh = F.coalesce((F.lag("hasta").over(w).isNull() | (start != following(F.lag("hasta").over(w)))).cast("int"), F.lit(1))
    held = runs.withColumn("fresh", fresh).withColumn("g", F.sum("fresh").over(w))
    return held.groupBy("g").agg(F.min("desde").alias("desde"), F.max("hasta").alias("hasta")).drop("g")


def month_islands(present: DataFrame) -> DataFrame:
    """Runs of consecutive months of (anio, mes)."""
    index = (F.col("anio") * 12 + F.col("mes") - 1).alias("i")
    w = W.partitionBy(F.floor(F.col("i") / 120)).orderBy("i")
    runs = present.select(index).distinct().withColumn("k", F.col("i") - F.row_number().over(w)).groupBy(F.floor(F.col("i") / 120), "k").agg(F.min("i").alias("desde"), F.max("i").alias("hasta"))
    label = lambda c: F.format_string("%04d-%02d", F.floor(F.col(c) / 12).cast("int"), (F.col(c) % 12 + 1).cast("int"))
    out = _join_runs(runs, F.col("desde"), lambda before: before + 1)
    return out.select(label("desde").alias("desde"), label("hasta").alias("hasta"), (F.col("hasta") - F.col("desde") + 1).cast("long").alias("meses")).orderBy("desde")


def missing_days(expected: DataFrame, present: DataFrame, day: str = "fecha") -> DataFrame:
    return expected.join(present.select(day).distinct(), day, "left_anti").orderBy(day)


def new_files(published: DataFrame, manifest: DataFrame) -> DataFrame:
    return published.join(manifest.select("nombre"), "nombre", "left_anti")


def suggested_start(manifest: DataFrame, yesterday: date, start: date = SOURCE_START) -> DataFrame:
    """The first day without a file, or with a preliminary one only, or yesterday: whichever is first."""
    spark = manifest.sparkSession
    by_day = manifest.groupBy("fecha_operacion").agg(F.bool_or(F.col("tipo") == "def").alias("final"))
    span = days(spark, start, yesterday) if start <= yesterday else days(spark, yesterday, yesterday)
    hole = span.join(by_day, F.col("fecha") == F.col("fecha_operacion"), "left_anti").agg(F.min("fecha").alias("d"))
    only_pre = by_day.where(~F.coalesce("final", F.lit(False)) & (F.col("fecha_operacion") >= F.lit(start))).agg(F.min("fecha_operacion").alias("d"))
    return hole.unionByName(only_pre).agg(F.least(F.coalesce(F.min("d"), F.lit(yesterday)), F.lit(yesterday)).alias("desde"))


def completeness(manifest: DataFrame, first: date, last: date, today: date) -> DataFrame:
    """Runs of days without any file (after the grace days) and with a preliminary one for too long."""
    by_day = manifest.groupBy(F.col("fecha_operacion").alias("fecha")).agg(F.bool_or(F.col("tipo") == "def").alias("final"))
    age = F.datediff(F.lit(today), F.col("fecha"))
    state = F.when(F.col("final").isNull() & (age > GRACE_DAYS), "sin_archivo").when(~F.col("final") & (age > PRELIMINARY_DAYS), "pre_sin_definitivo")
    held = days(manifest.sparkSession, first, last).join(by_day, "fecha", "left").select("fecha", state.alias("estado")).where("estado IS NOT NULL")
    w = W.partitionBy("estado").orderBy("fecha")
    return held.withColumn("k", F.date_sub("fecha", F.row_number().over(w))).groupBy("estado", "k").agg(F.min("fecha").alias("desde"), F.max("fecha").alias("hasta"), F.count(F.lit(1)).alias("dias")).drop("k").orderBy("desde", "estado")


def days_in_base(series: DataFrame) -> DataFrame:
    """The days that the series has; one column is read."""
    return series.select("fecha").distinct()


def day_causes(present: DataFrame, manifest: DataFrame, first: date, last: date, start: date = SOURCE_START) -> DataFrame:
    """Every expected day, whether the series has it, and the cause if it does not."""
    have = present.select("fecha", F.lit(True).alias("have")).distinct()
    got = manifest.select(F.col("fecha_operacion").alias("fecha"), F.lit(True).alias("got")).distinct()
    cause = F.when(F.col("have"), None).when(F.col("fecha") < F.lit(start), "maestro").when(F.col("got"), "sin_ingerir").otherwise("sin_descargar")
    return days(present.sparkSession, first, last).join(have, "fecha", "left").join(got, "fecha", "left").withColumn("causa", cause)


def coverage(present: DataFrame, manifest: DataFrame, first: date, last: date, start: date = SOURCE_START) -> DataFrame:
    """Expected days against those in the series, by month, with the causes of the missing ones."""
    each = day_causes(present, manifest, first, last, start)
    of = lambda kind: F.count_if(F.col("causa") == kind).alias(kind)
    return each.groupBy(F.date_format("fecha", "yyyy-MM").alias("periodo")).agg(F.count(F.lit(1)).alias("esperados"), F.count_if(F.col("have")).alias("con_datos"), of("maestro"), of("sin_ingerir"), of("sin_descargar")).orderBy("periodo")


def version_label() -> Column:
    """'Definitivo v2-1' from a document, else from the origin, else the history's."""
    name = F.when(F.col("tipo") == "def", "Definitivo").when(F.col("tipo") == "pre", "Preliminar")
    number = F.concat(F.when(F.col("version") > 1, F.concat(F.lit(" v"), F.col("version").cast("string"))).otherwise(""), F.when(F.col("reemision") > 0, F.concat(F.lit("-"), F.col("reemision").cast("string"))).otherwise(""))
    return F.coalesce(F.concat(name, number), F.when(F.col("origen") == "pagina_cen_def", "Definitivo").when(F.col("origen") == "pagina_cen_pre", "Preliminar"), F.lit("Maestro (historico)"))


def compare_versions(new: DataFrame, old: DataFrame) -> DataFrame:
    """By day: quarters in both, those whose price changed, the greatest and the mean change; and quarters on one side only."""
    key = ["barra", "fecha", "hora", "minuto"]
    both = new.select(*key, F.col("cmg_usd_mwh").alias("n"), F.lit(1).alias("in_new")).join(old.select(*key, F.col("cmg_usd_mwh").alias("o"), F.lit(1).alias("in_old")), key, "full_outer")
    shared = F.col("in_new").isNotNull() & F.col("in_old").isNotNull()
    changed = shared & (F.col("n") != F.col("o"))
    diff = F.abs(F.col("n") - F.col("o"))
    return both.groupBy("fecha").agg(F.count_if(shared).alias("cuartos"), F.count_if(changed).alias("cuartos_distintos"), F.max(F.when(shared, diff)).alias("maxima"), F.avg(F.when(changed, diff)).alias("media"), F.count_if(F.col("in_old").isNull()).alias("agregados"), F.count_if(F.col("in_new").isNull()).alias("quitados")).orderBy("fecha")
