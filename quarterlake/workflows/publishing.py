"""Changed months of the series to the serving tables, a month at a time.

Tables under the serving folder: ``cuarto`` (encoded quarters), ``dia``, ``mes_barra``, ``mes_bloque``, ``huella`` and ``carga_mes`` by month,
``documento`` and ``revision`` by month and load, ``barra`` by id. A month's tables are committed together (``sources.snapshots``): a reader
sees all of one load or all of the next, and one that was cut short was never there. Readers of several tables pass one snapshot to all.

Whether a month has changed is told by its content: ``huella`` has a digest of each bus and day that does not depend on the order of rows. Equal
rows written again publish nothing but the month's new mark; quarters are compared only for the buses and days whose digests differ."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.functions.domain import Month, format_month, month_bounds, month_index
from quarterlake.operators import publish, versions
from quarterlake.schema import ORIGIN_PRELIMINARY, ORIGINS
from quarterlake.sources import control, silver, snapshots
from quarterlake.streaming.ingest import month_fingerprint
from quarterlake.workflows.ingest import chosen_files

PRICE = "cmg_usd_mwh"
#: Columns of the serving tables, without the month's own.
SCHEMAS = {
    "barra": "barra_id int, nombre string",
    "cuarto": f"barra_id int, fecha date, hora smallint, minuto smallint, bloque string, {PRICE} double, origen_id smallint",
    "documento": "nombre string, fecha date, tipo string, version int, reemision int, publicado date, descargado_en timestamp_ntz, sha256 string, bytes bigint, url string, carga int",
    "dia": "fecha date, origen_id smallint, documento string, cargado_en timestamp_ntz, usd_clp double",
    "revision": "fecha date, origen_antes smallint, origen_despues smallint, documento_antes string, documento_despues string, publicado date, detectado_en timestamp_ntz, cuartos bigint, cuartos_distintos bigint, dif_max_usd double, dif_prom_usd double, carga int",
    "mes_barra": 'barra_id int, fecha date, cuartos bigint, A double, B double, C double, Solar double, NoSolar double, Total double',
    "mes_bloque": "barra_id int, fecha date, bloque string, cuartos bigint, promedio double, desviacion double, minimo double, maximo double, en_cero bigint",
    "huella": "barra_id int, fecha date, filas bigint, origen_id smallint, huella bigint",
    "carga_mes": "huella string, filas bigint, cargado_en timestamp_ntz, dias int, dias_preliminar int, carga int",
}
BY_MONTH = tuple(t for t in SCHEMAS if t != "barra")


def _schema(name: str) -> str:
    return SCHEMAS[name] + (", anio int, mes int" if name in BY_MONTH else "")


def read(spark: SparkSession, serving: str, name: str, at: snapshots.Snapshot | None = None) -> DataFrame:
    """A serving table by its fixed schema, at a snapshot or else the latest; no rows where nothing was published. Documents are the latest of
    each name."""
    out = snapshots.read(spark, serving, name, _schema(name), snapshots.snapshot(spark, serving) if at is None else at)
    if name == "documento":
        cols = [c for c in out.columns if c != "nombre"]
        out = out.groupBy("nombre").agg(F.max_by(F.struct(*cols), "carga").alias("d")).select("nombre", "d.*")
    return out


def _partition(month: Month, load: int | None = None) -> str:
    return f"anio={month[0]}/mes={month[1]}" + ("" if load is None else f"/carga={load}")


def _months(at: snapshots.Snapshot, table: str) -> list[Month]:
    """The months of a table's partitions."""
    keys = [dict(x.split("=") for x in p.split("/")) for p in at.partitions(table)]
    return sorted({(int(k["anio"]), int(k["mes"])) for k in keys})


def loaded_months(spark: SparkSession, serving: str, at: snapshots.Snapshot | None = None) -> dict[Month, tuple[str, int]]:
    """(fingerprint, number of loads) of every published month."""
    return {(r["anio"], r["mes"]): (r["huella"], r["carga"]) for r in read(spark, serving, "carga_mes", at).select("anio", "mes", "huella", "carga").collect()}


def months_in_store(spark: SparkSession, serving: str) -> list[Month]:
    return _months(snapshots.snapshot(spark, serving), "cuarto")


def pending_months(spark: SparkSession, base: str, serving: str, force: bool = False, first: Month | None = None) -> list[tuple[Month, str]]:
    """Months of the series whose files are not those that were published."""
    done = loaded_months(spark, serving)
    out = []
    for month in silver.written_months(spark, base):
        if first is not None and month_index(*month) < month_index(*first):
            continue
        mark = silver.month_fingerprint(spark, base, month)
        if mark is not None and (force or done.get(month, (None, 0))[0] != mark):
            out.append((month, mark))
    return out


def documents_of(spark: SparkSession, folder: str | None, month: Month) -> tuple[DataFrame, DataFrame]:
    """(all documents, the chosen one of each day) of a month. A series that lags behind its files is an error: a day would be said to
    come from a document whose rows are not there."""
    manifest = control.read_manifest(spark, folder) if folder else spark.createDataFrame([], control.MANIFEST)
    first, after = month_bounds(month)
    held = manifest.where((F.col("fecha_operacion") >= F.lit(first)) & (F.col("fecha_operacion") < F.lit(after)))
    chosen = chosen_files(held)
    if chosen and control.read_json(spark, f"{folder}/{control.STATE_FILE}", {}).get(format_month(month)) != month_fingerprint([e["sha256"] for e in chosen.values()]):
        raise ValueError(f"the series of {format_month(month)} does not hold what was downloaded; ingest it first")
    picked = [(d, e["nombre"], e["fecha_publicacion"]) for d, e in chosen.items()]
    return held, spark.createDataFrame(picked, "fecha date, documento string, publicado date")


def day_table(marks: DataFrame, rates: DataFrame, chosen: DataFrame, now: datetime) -> DataFrame:
    """What is loaded for each day: its origin, its document, its exchange rate."""
    by_day = marks.groupBy("fecha").agg(F.min("origen_id").alias("origen_id"))
    held = by_day.join(F.broadcast(rates), "fecha", "left").join(F.broadcast(chosen.select("fecha", "documento")), "fecha", "left")
    return held.select("fecha", "origen_id", "documento", F.lit(now).cast("timestamp_ntz").alias("cargado_en"), "usd_clp")


def bus_days(series: DataFrame) -> DataFrame:
    """(barra, fecha, filas, veces, sin_clave, origen, huella) of each bus and day, in one pass: rows, rows less distinct quarters, rows
    without a quarter, the least origin, and a digest that does not depend on the order of rows (a sum of 48-bit hashes)."""
    row = F.shiftrightunsigned(F.xxhash64("hora", "minuto", "bloque", PRICE, "origen", "usd_clp"), 16)
    slots = F.size(F.collect_set(F.col("hora") * 60 + F.col("minuto")))
    return series.groupBy("barra", "fecha").agg(
        F.count(F.lit(1)).alias("filas"), (F.count(F.lit(1)) - slots).alias("veces"), F.count_if(F.col("hora").isNull() | F.col("minuto").isNull()).alias("sin_clave"),
        F.min("origen").alias("origen"), F.sum(row).alias("huella"),
    )


def changed_bus_days(marks: DataFrame, before: DataFrame) -> DataFrame:
    """(barra_id, fecha) whose rows are new, gone or not those that are loaded."""
    key, a, b = ["barra_id", "fecha"], marks.alias("a"), before.alias("b")
    same = F.col("a.huella").eqNullSafe(F.col("b.huella")) & F.col("a.filas").eqNullSafe(F.col("b.filas")) & F.col("a.origen_id").eqNullSafe(F.col("b.origen_id"))
    return a.join(b, key, "full_outer").where(~same).select(*key)


def revised_days(new: DataFrame, old: DataFrame, days_before: DataFrame, chosen: DataFrame, now: datetime, same: DataFrame | None = None) -> DataFrame:
    """Days that were loaded and whose prices, origin or document changed: how many of the quarters in both, by how much. ``same`` has bus days
    (fecha, filas, origen_id) that are known to be equal, and whose quarters then need not be in ``new`` and ``old``."""
    key = ["barra_id", "fecha", "hora", "minuto"]
    both = new.select(*key, "origen_id", F.col(PRICE).alias("n")).join(old.select(*key, F.col(PRICE).alias("o")), key)
    gap, changed = F.abs(F.col("n") - F.col("o")), F.col("n") != F.col("o")
    by_day = both.groupBy("fecha").agg(F.min("origen_id").alias("origen_despues"), F.count(F.lit(1)).alias("cuartos"), F.count_if(changed).alias("cuartos_distintos"), F.max(gap).alias("dif_max_usd"), F.avg(F.when(changed, gap)).alias("dif_prom_usd"))
    if same is not None:
        equal = same.groupBy("fecha").agg(F.min("origen_id").alias("origen_igual"), F.sum("filas").alias("iguales"))
        nothing = F.lit(0)
        by_day = by_day.join(equal, "fecha", "full_outer").select(
            "fecha", F.least("origen_despues", "origen_igual").alias("origen_despues"), (F.coalesce("cuartos", nothing) + F.coalesce("iguales", nothing)).alias("cuartos"),
            F.coalesce("cuartos_distintos", nothing).alias("cuartos_distintos"), F.coalesce("dif_max_usd", F.lit(0.0)).alias("dif_max_usd"), "dif_prom_usd",
        )
    before = days_before.select("fecha", F.col("origen_id").alias("origen_antes"), F.col("documento").alias("documento_antes"))
    after = chosen.select("fecha", F.col("documento").alias("documento_despues"), "publicado")
    out = by_day.join(F.broadcast(before), "fecha", "left").join(F.broadcast(after), "fecha", "left")
    unchanged = (F.col("cuartos_distintos") == 0) & F.col("origen_antes").eqNullSafe(F.col("origen_despues")) & F.col("documento_antes").eqNullSafe(F.col("documento_despues"))
    names = [c.split(" ")[0] for c in SCHEMAS["revision"].split(", ")][:-1]
    return out.where(~unchanged).withColumn("detectado_en", F.lit(now).cast("timestamp_ntz")).select(*names)


def changed_quarters(new: DataFrame, old: DataFrame, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The quarters of the changed bus days alone. Their days and buses reach the scans as filters: quarters are stored by bus."""
    days = [r[0] for r in changed.select("fecha").distinct().collect()]  # days of one month
    bounds = changed.agg(F.min("barra_id").alias("a"), F.max("barra_id").alias("b")).first()
    held = [df.where(F.col("fecha").isin(days) & F.col("barra_id").between(bounds["a"] or 0, bounds["b"] or 0)) for df in (new, old)]
    return held[0].join(changed, ["barra_id", "fecha"], "left_semi"), held[1].join(changed, ["barra_id", "fecha"], "left_semi")


def publish_month(spark: SparkSession, base: str, serving: str, month: Month, mark: str, now: datetime, folder: str | None = None, force: bool = False) -> dict:
    """One month into all serving tables by one commit; returns what was done. A month whose rows and documents are those that are loaded only gets
    its new mark, unless ``force`` is set."""
    tx = snapshots.Transaction(spark, serving)
    days = bus_days(silver.scan(spark, base).where((F.col("anio") == month[0]) & (F.col("mes") == month[1]))).persist()
    try:
        return _publish(tx, base, month, mark, now, folder, force, days)
    except Exception:
        tx.abandon()
        raise
    finally:
        days.unpersist()


def _publish(tx: snapshots.Transaction, base: str, month: Month, mark: str, now: datetime, folder: str | None, force: bool, days: DataFrame) -> dict:
    spark, key = tx.spark, _partition(month)
    this = (F.col("anio") == month[0]) & (F.col("mes") == month[1])
    held = lambda name: tx.read(name, _schema(name)).where(this)
    series = silver.scan(spark, base).where(this)
    documents, chosen = documents_of(spark, folder, month)
    found = days.agg(F.sum(F.when(F.col("barra").isNull() | F.col("fecha").isNull(), F.col("filas")).otherwise(F.col("sin_clave"))).alias("bad"), F.max("veces").alias("twice"), F.sum("filas").alias("rows")).first()
    if found["bad"]:
        raise ValueError(f"{format_month(month)} has {found['bad']} rows without a bus, day or hour; ingest it again")
    if found["twice"]:
        raise ValueError(f"{format_month(month)} has quarters that occur twice")
    known = tx.read("barra", SCHEMAS["barra"])
    new_buses = publish.assign_ids(known, days.select(F.col("barra").alias("nombre"))).join(known, "nombre", "left_anti").select("barra_id", "nombre")
    if not new_buses.isEmpty():
        tx.append("barra", "", new_buses.coalesce(1))
    buses, origins = tx.read("barra", SCHEMAS["barra"]), publish.origins(spark)
    marks = days.join(F.broadcast(buses.withColumnRenamed("nombre", "barra")), "barra").join(F.broadcast(origins.withColumnRenamed("nombre", "origen")), "origen")
    marks = marks.select("barra_id", "fecha", "filas", "origen_id", "huella")

    there = key in tx.base.partitions("cuarto")
    load = loaded_months(spark, tx.root, tx.base).get(month, ("", 0))[1] + 1
    changed = changed_bus_days(marks, held("huella"))
    by_document = chosen.join(held("dia").select("fecha", F.col("documento").alias("antes")), "fecha", "full_outer").where(~F.col("documento").eqNullSafe(F.col("antes")))
    if there and not force and changed.isEmpty() and by_document.isEmpty():
        row = held("carga_mes").first()
        control_row = spark.createDataFrame([(mark, row["filas"], row["cargado_en"], row["dias"], row["dias_preliminar"], row["carga"])], SCHEMAS["carga_mes"])
        tx.replace("carga_mes", key, control_row.coalesce(1))
        tx.commit(f"{format_month(month)} unchanged", now)
        return {"anio": month[0], "mes": month[1], "accion": "igual", "filas": row["filas"], "dias": row["dias"], "revisiones": 0}

    encoded = publish.encode(series, buses, origins)
    docs = documents.select("nombre", F.col("fecha_operacion").alias("fecha"), "tipo", "version", "reemision", F.col("fecha_publicacion").alias("publicado"), "descargado_en", "sha256", "bytes", "url")
    tx.replace("documento", _partition(month, load), docs.coalesce(1))
    revised = 0
    if there:
        same = marks.join(changed, ["barra_id", "fecha"], "left_anti")
        revisions = revised_days(*changed_quarters(encoded, held("cuarto"), changed), held("dia"), chosen, now, same)
        tx.replace("revision", _partition(month, load), revisions.coalesce(1))
        revised = held("revision").where(F.col("carga") == load).count()
    tx.replace("cuarto", key, encoded.repartitionByRange("barra_id").sortWithinPartitions("barra_id", "fecha", "hora", "minuto"))
    tx.replace("huella", key, marks.repartitionByRange("barra_id").sortWithinPartitions("barra_id", "fecha"))
    tx.replace("dia", key, day_table(marks, publish.exchange_rates(series), chosen, now).coalesce(1))
    for name, rows in zip(("mes_barra", "mes_bloque"), publish.monthly_tables(held("cuarto").drop("anio", "mes").withColumnRenamed("barra_id", "barra")), strict=True):
        tx.replace(name, key, rows.withColumnRenamed("barra", "barra_id").withColumnRenamed("mes", "fecha"))
    counts = day_counts(held("dia")).first()
    control_row = spark.createDataFrame([(mark, found["rows"], now, counts["dias"], counts["dias_preliminar"], load)], SCHEMAS["carga_mes"])
    tx.replace("carga_mes", key, control_row.coalesce(1))
    tx.commit(f"{format_month(month)} load {load}", now)
    return {"anio": month[0], "mes": month[1], "accion": "reemplazado" if there else "nuevo", "filas": found["rows"], "dias": counts["dias"], "revisiones": revised}


def day_counts(days: DataFrame) -> DataFrame:
    """Days, and those of a preliminary origin, which may still change."""
    number = next(i for i, n in ORIGINS if n == ORIGIN_PRELIMINARY)
    return days.agg(F.count(F.lit(1)).cast("int").alias("dias"), F.count_if(F.col("origen_id") == number).cast("int").alias("dias_preliminar"))


def publish_changed(spark: SparkSession, base: str, serving: str, now: datetime, folder: str | None = None, force: bool = False, first: Month | None = None, remove: bool = False) -> list[dict]:
    """All pending months; with ``first`` only from there on, and with ``remove`` what is earlier goes first."""
    if first is not None and remove:
        remove_earlier(spark, serving, first, now)
    return [publish_month(spark, base, serving, m, mark, now, folder, force) for m, mark in pending_months(spark, base, serving, force, first)]


def remove_earlier(spark: SparkSession, serving: str, first: Month, now: datetime | None = None) -> list[Month]:
    """Months before ``first`` leave every table by one commit, and so do buses without any month. Earlier snapshots still have them."""
    tx = snapshots.Transaction(spark, serving)
    gone = set()
    for table in BY_MONTH:
        for partition in tx.base.partitions(table):
            k = dict(x.split("=") for x in partition.split("/"))
            if month_index(int(k["anio"]), int(k["mes"])) < month_index(*first):
                gone.add((int(k["anio"]), int(k["mes"])))
                tx.remove(table, partition)
    if gone:
        left = tx.read("barra", SCHEMAS["barra"]).join(tx.read("mes_barra", _schema("mes_barra")).select("barra_id").distinct(), "barra_id", "left_semi")
        tx.replace("barra", "", left.select("barra_id", "nombre").coalesce(1))
        tx.commit(f"months before {format_month(first)} removed", now or datetime.now())
    return sorted(gone)


def monthly_view(by_bus: DataFrame, buses: DataFrame, loads: DataFrame) -> DataFrame:
    """Monthly averages with names, and of each month its days and preliminary days, where it has a load record."""
    named = by_bus.select("barra_id", "fecha", "cuartos", "A", "B", "C", "Solar", "NoSolar", "Total").join(F.broadcast(buses), "barra_id")
    dated = named.withColumn("anio", F.year("fecha")).withColumn("mes", F.month("fecha"))
    return dated.join(F.broadcast(loads.select("anio", "mes", "dias", "dias_preliminar")), ["anio", "mes"], "left").select(F.col("nombre").alias("barra"), "fecha", "anio", "mes", "cuartos", "A", "B", "C", "Solar", "NoSolar", "Total", "dias", "dias_preliminar")


def monthly_block_view(by_block: DataFrame, buses: DataFrame) -> DataFrame:
    return by_block.join(F.broadcast(buses), "barra_id").select(F.col("nombre").alias("barra"), "fecha", "bloque", "cuartos", "promedio", "desviacion", "minimo", "maximo", "en_cero")


def serving_versions(spark: SparkSession, serving: str, first, last, at: snapshots.Snapshot | None = None) -> DataFrame:
    """(fecha, version, usd_clp) of a day range, by the document that each day was loaded from."""
    at = at or snapshots.snapshot(spark, serving)
    days = read(spark, serving, "dia", at).where(F.col("fecha").between(F.lit(first), F.lit(last)))
    docs = read(spark, serving, "documento", at).select(F.col("nombre").alias("documento"), "tipo", "version", "reemision")
    held = days.join(F.broadcast(publish.origins(spark).withColumnRenamed("nombre", "origen")), "origen_id").join(docs, "documento", "left")
    return held.select("fecha", versions.version_label().alias("version"), "usd_clp")


def serving_series(spark: SparkSession, serving: str, bus: str, first, last, at: snapshots.Snapshot | None = None) -> DataFrame:
    """A bus's quarters of a day range, each with its day's version and exchange rate, all of one snapshot."""
    at = at or snapshots.snapshot(spark, serving)
    quarters = read(spark, serving, "cuarto", at).where(F.col("fecha").between(F.lit(first), F.lit(last)) & _months_of(first, last))
    view = publish.serving_view(quarters, read(spark, serving, "barra", at).where(F.col("nombre") == bus), publish.origins(spark))
    return view.join(F.broadcast(serving_versions(spark, serving, first, last, at)), "fecha", "left").orderBy("fecha", "hora", "minuto")


def _months_of(first, last):
    """The month partitions that a range of days touches."""
    return (F.col("anio") * 100 + F.col("mes")).between(first.year * 100 + first.month, last.year * 100 + last.month)
