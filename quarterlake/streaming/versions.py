"""Versions of a day as a stream: files come in any order of day and version, and what counts is kept by day in Spark's state store.

A file's event time is when it was seen, which never goes back, so no file is late however old its day is. Two timers a day fire by that
clock: after the grace days without any file, and after the days that a preliminary file may stand alone. Days are made known by ticks (rows
without a name), so that one without a file has timers too."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quarterlake.functions.calendar import days
from quarterlake.operators.versions import GRACE_DAYS, PRELIMINARY_DAYS
from quarterlake.sources import snapshots

EVENTS = "fecha_operacion date, tipo string, version int, reemision int, fecha_publicacion date, nombre string, visto timestamp"
#: What is known of a day: the file that counts, whether a file of unknown type makes it doubtful, and what is overdue.
DAYS = "fecha_operacion date, nombre string, tipo string, version int, reemision int, fecha_publicacion date, dudoso boolean, alarma string"
TABLE, NO_FILE, ONLY_PRELIMINARY = "dia_version", "sin_archivo", "pre_sin_definitivo"
RANK = {"def": 2, "pre": 1}
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _order(nombre: str, tipo: str | None, version: int | None, reemision: int | None, publicado: date | None) -> tuple:
    """The order of versions, nulls first, as ``operators.versions.version_order`` has it."""
    least = lambda x: (x is not None, x if x is not None else 0)
    return RANK.get(tipo or "", 0), least(version), least(reemision), publicado.isoformat() if publicado else "", nombre


def deadline(day: date, grace: int) -> int:
    """The last millisecond of the last day that may pass, on the clock of file sightings."""
    return int(datetime.combine(day + timedelta(grace + 1), datetime.min.time(), timezone.utc).timestamp() * 1000) - 1


def alarm_at(day: date, clock: int, some: bool, final: bool) -> str | None:
    """What is overdue of a day by a clock in milliseconds."""
    if not some:
        return NO_FILE if clock >= deadline(day, GRACE_DAYS) else None
    return ONLY_PRELIMINARY if not final and clock >= deadline(day, PRELIMINARY_DAYS) else None


class DayVersions(StatefulProcessor):
    """State of one day; a row out whenever it changes, in order of ``paso`` within a batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("dia", "nombre string, tipo string, version int, reemision int, publicado date, dudoso boolean, alguno boolean, definitivo boolean, alarma string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        known = self.state.get()
        if known is None:
            for grace in (GRACE_DAYS, PRELIMINARY_DAYS):
                self.handle.registerTimer(deadline(key[0], grace))
        best, doubtful, some, final, _ = (tuple(known[:5]), *known[5:]) if known is not None else ((None,) * 5, False, False, False, None)
        for r in rows:
            if r.nombre is None:
                continue
            some, final, doubtful = True, final or r.tipo == "def", doubtful or r.tipo not in RANK
            this = (r.nombre, r.tipo, r.version, r.reemision, r.fecha_publicacion)
            if best[0] is None or _order(*this) > _order(*best):
                best = this
        new = (*best, doubtful, some, final, alarm_at(key[0], timerValues.getCurrentWatermarkInMs(), some, final))
        if known is None or tuple(known) != new:
            self.state.update(new)
            yield self._row(key, new, 0)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        known = tuple(self.state.get())
        alarm = alarm_at(key[0], max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()), *known[6:8])
        if alarm != known[8]:
            new = (*known[:8], alarm)
            self.state.update(new)
            yield self._row(key, new, 1)

    @staticmethod
    def _row(key: tuple, s: tuple, step: int) -> Row:
        shown = s[:5] if s[0] is not None and not s[5] else (None,) * 5
        return Row(fecha_operacion=key[0], nombre=shown[0], tipo=shown[1], version=shown[2], reemision=shown[3], fecha_publicacion=shown[4], dudoso=s[5], alarma=s[8], paso=step)

    def close(self) -> None:
        pass


def day_versions(events: DataFrame) -> DataFrame:
    """A stream of file sightings and ticks (EVENTS) to changes of days (DAYS, paso)."""
    held = events.withWatermark("visto", "0 seconds").groupBy("fecha_operacion")
    return held.transformWithState(DayVersions(), f"{DAYS}, paso int", "Update", "EventTime")


def ticks(spark: SparkSession, first: date, last: date, seen: datetime) -> DataFrame:
    """Expected days, and with the last of them the clock."""
    return days(spark, first, last).select(F.col("fecha").alias("fecha_operacion"), *[F.lit(None).cast(t).alias(n) for n, t in (x.split(" ") for x in EVENTS.split(", ")[1:-1])], F.lit(seen).cast("timestamp").alias("visto"))


def merge_days(root: str):
    """A ``foreachBatch`` writer: changed days replace what was known of them, by years, in one commit a batch. A batch that comes again
    finds its commit and does nothing."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        tx = snapshots.Transaction(spark, root)
        label = f"batch {number}"
        if any(snapshots.snapshot(spark, root, v).what == label for v in snapshots.versions(spark, root)):
            return
        last = Window.partitionBy("fecha_operacion").orderBy(F.desc("paso"))
        new = batch.withColumn("n", F.row_number().over(last)).where("n = 1").drop("n", "paso").persist()
        try:
            for year in sorted(r[0] for r in new.select(F.year("fecha_operacion")).distinct().collect()):
                mine = new.where(F.year("fecha_operacion") == year)
                old = tx.read(TABLE, f"{DAYS}, anio int").where(F.col("anio") == year).drop("anio")
                tx.replace(TABLE, f"anio={year}", old.join(mine, "fecha_operacion", "left_anti").unionByName(mine).coalesce(1))  # 366 rows at most
            tx.commit(label, datetime.now())
        finally:
            new.unpersist()

    return write


def track(events: DataFrame, root: str, checkpoint: str) -> None:
    """All sightings that came since the last run, then stop. State and progress are in the checkpoint, results in the table of ``root``."""
    spark = events.sparkSession
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        day_versions(events).writeStream.foreachBatch(merge_days(root)).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def known_days(spark: SparkSession, root: str, at: snapshots.Snapshot | None = None) -> DataFrame:
    return snapshots.read(spark, root, TABLE, f"{DAYS}, anio int", at or snapshots.snapshot(spark, root)).drop("anio")


def chosen_days(known: DataFrame) -> DataFrame:
    """The file that counts of each day that is sure, as ``operators.versions.choose_by_day`` has it."""
    return known.where("nombre IS NOT NULL").select("fecha_operacion", "nombre", "tipo", "version", "reemision", "fecha_publicacion").orderBy("fecha_operacion")


def overdue(known: DataFrame) -> DataFrame:
    """Runs of days with the same alarm, as ``operators.versions.completeness`` has them."""
    w = Window.partitionBy("alarma").orderBy("fecha_operacion")
    held = known.where("alarma IS NOT NULL").withColumn("k", F.date_sub("fecha_operacion", F.row_number().over(w)))
    return held.groupBy(F.col("alarma").alias("estado"), "k").agg(F.min("fecha_operacion").alias("desde"), F.max("fecha_operacion").alias("hasta"), F.count(F.lit(1)).alias("dias")).drop("k").orderBy("desde", "estado")
