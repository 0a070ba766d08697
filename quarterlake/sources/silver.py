"""The month-partitioned series on a Hadoop file system: scan, listing, atomic month replacement, crash recovery."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarterlake.functions.domain import Month, block_of_hour, extra_hour, local_time, official_name, period_filter
from quarterlake.schema import KEY, ORIGIN_HISTORY, SERIES_READ, conform

#: Months of the history that its own database covers.
HISTORY_FIRST, HISTORY_LAST = (2021, 1), (2024, 7)


#: Months are written sorted by bus, and each row group has a Bloom filter of its buses: a look-up of one bus, or of one that is not there, skips
#: the row groups of others.
LOOKUP = {"compression": "zstd", "parquet.bloom.filter.enabled#barra": "true", "parquet.bloom.filter.expected.ndv#barra": "5000"}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch_base(spark: SparkSession) -> str:
    """A new base in the folder that the cluster shares; a temporary one of this machine only where all runs on it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="quarterlake-")
    return f"{shared.rstrip('/')}/silver-{uuid.uuid4().hex}"


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def month_path(base: str, month: Month) -> str:
    return f"{base}/anio={month[0]}/mes={month[1]}"


def written_months(spark: SparkSession, base: str) -> list[Month]:
    """Months with files, from directory names alone."""
    out = []
    for year in _children(spark, base):
        if y := re.fullmatch(r"anio=(\d+)", year):
            for month in _children(spark, f"{base}/{year}"):
                if (m := re.fullmatch(r"mes=(\d+)", month)) and any(f.endswith(".parquet") for f in _children(spark, f"{base}/{year}/{month}")):
                    out.append((int(y[1]), int(m[1])))
    return sorted(out)


def base_exists(spark: SparkSession, base: str) -> bool:
    return bool(written_months(spark, base))


def available_range(spark: SparkSession, base: str) -> tuple[Month, Month]:
    months = written_months(spark, base)
    if not months:
        raise ValueError(f"no months under {base}")
    return months[0], months[-1]


def scan(spark: SparkSession, base: str) -> DataFrame:
    """The whole series by its fixed schema: older files without an optional column give nulls."""
    return spark.read.schema(SERIES_READ).option("basePath", base).parquet(base)


def month_rows(spark: SparkSession, base: str, month: Month) -> int:
    return scan(spark, base).where(period_filter(month, month)).count() if month in written_months(spark, base) else 0


def _aside(base: str, month: Month, what: str) -> str:
    """Where a month is written or kept while it is replaced: under a folder that scans of the base do not see."""
    return f"{base}/_work/{month[0]}-{month[1]}__{what}"


def write_month(df: DataFrame, base: str, month: Month) -> int:
    """Replace one month: written aside, sorted by key for row-group skipping, then swapped in by renames, so that readers see the old
    month or the new one. Rows of another month are an error. Other months, and what others write there, are not touched."""
    held = conform(df).repartitionByRange("barra").sortWithinPartitions(*KEY)
    strange = F.raise_error(F.concat(F.lit(f"a row is outside {month}: "), F.coalesce(F.col("fecha").cast("string"), F.lit("no date"))))
    return replace_month(held.withColumn("fecha", F.when((F.year("fecha") == month[0]) & (F.month("fecha") == month[1]), F.col("fecha")).otherwise(strange.cast("date"))), base, month)


def replace_month(rows: DataFrame, base: str, month: Month) -> int:
    """Swap a month's folder for these rows, whatever their columns."""
    spark = rows.sparkSession
    recover(spark, base, month)
    final, aside, old = month_path(base, month), _aside(base, month, "tmp"), _aside(base, month, "old")
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("filas")).write.mode("overwrite").options(**LOOKUP).parquet(aside)
    written = seen.get.get("filas", 0)  # counted by the write itself
    fs, p_final = _fs(spark, final)
    path = lambda x: spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x)
    fs.mkdirs(p_final.getParent())
    if fs.exists(p_final) and not fs.rename(p_final, path(old)):
        raise OSError(f"cannot move {final}")
    if not fs.rename(path(aside), p_final):
        fs.rename(path(old), p_final)
        raise OSError(f"cannot move {aside}")
    fs.delete(path(old), True)
    spark.catalog.refreshByPath(base)
    return written


def month_fingerprint(spark: SparkSession, base: str, month: Month) -> str | None:
    """What a month's files are, from their names, lengths and times alone: no data is read. None without files."""
    fs, p = _fs(spark, month_path(base, month))
    if not fs.exists(p):
        return None
    files = sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(p) if s.getPath().getName().endswith(".parquet"))
    return hashlib.sha256("\n".join(files).encode()).hexdigest() if files else None


def remove_month(spark: SparkSession, base: str, month: Month) -> None:
    fs, p = _fs(spark, month_path(base, month))
    fs.delete(p, True)
    spark.catalog.refreshByPath(base)


def recover(spark: SparkSession, base: str, month: Month | None = None) -> list[str]:
    """After a crash: unfinished months go; an old month whose successor is missing comes back. One month's only, if named."""
    done = []
    for name in _children(spark, f"{base}/_work"):
        if not (m := re.fullmatch(r"(\d+)-(\d+)__(tmp|old)", name)) or month not in (None, (int(m[1]), int(m[2]))):
            continue
        full = f"{base}/_work/{name}"
        fs, p = _fs(spark, full)
        _, target = _fs(spark, month_path(base, (int(m[1]), int(m[2]))))
        if m[3] == "tmp" or fs.exists(target):
            fs.delete(p, True)
        else:
            fs.mkdirs(target.getParent())
            fs.rename(p, target)
        done.append(full)
    return done


def write_months(df: DataFrame, base: str) -> None:
    """Many months at once by dynamic partition overwrite: exactly the months in ``df`` are replaced."""
    out = conform(df).withColumn("anio", F.year("fecha")).withColumn("mes", F.month("fecha"))
    out.repartition("anio", "mes").sortWithinPartitions("anio", "mes", *KEY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**LOOKUP).partitionBy("anio", "mes").parquet(base)


def history_months(spark: SparkSession, base: str) -> list[Month]:
    return [m for m in written_months(spark, base) if HISTORY_FIRST <= m <= HISTORY_LAST]


def from_history(df: DataFrame) -> DataFrame:
    """The history's rows in the series' form: official names, blocks computed anew, float prices as they are in double."""
    hour = F.col("hora").cast("int")
    return df.select(
        official_name(F.col("barra")).alias("barra"), "fecha", "hora", "minuto", block_of_hour(hour).alias("bloque"), F.col("cmg_usd_mwh").cast("double").alias("cmg_usd_mwh"),
        extra_hour(hour).alias("es_hora_extra"), local_time(F.col("fecha"), hour, F.col("minuto").cast("int")).alias("fecha_hora"), F.lit(ORIGIN_HISTORY).alias("origen"), F.localtimestamp().alias("ingerido_en"),
    )


def migrate_history(spark: SparkSession, source: str, base: str, checks=None) -> list[dict]:
    """Month by month: map, check, replace. One report row a month."""
    report = []
    for month in history_months(spark, source):
        rows = from_history(spark.read.option("basePath", source).parquet(month_path(source, month)))
        found = checks(rows) if checks else {}
        report.append({"anio": month[0], "mes": month[1], "filas": write_month(rows, base, month), **found})
    return report
