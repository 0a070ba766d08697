"""Series tables of a database: reads cut by months, and loads that replace a month in one transaction.

Tasks read and write over JDBC, each its own months or its own rows; the driver only sends statements. A load goes to a staging table first, which
may take long and harms nobody; then the database itself moves the rows, and readers see the old month or the new one."""

from __future__ import annotations

import configparser
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarterlake.functions.domain import Month, month_bounds, months_between

#: What an ini file's section must name, and the port where it names none.
SECTION, NEEDED, PORT = "postgres", ("host", "dbname", "user", "password"), 5432
#: Rows that a statement sends or fetches.
BATCH = 10_000


def read_settings(text: str) -> tuple[str, dict[str, str]]:
    """(url, properties) of an ini file's text; what it lacks is an error that says so."""
    ini = configparser.ConfigParser(interpolation=None)
    ini.read_string(text)
    held = {k: v.strip() for k, v in ini[SECTION].items()} if ini.has_section(SECTION) else {}
    if lost := [k for k in NEEDED if not held.get(k)]:
        raise ValueError(f"[{SECTION}] lacks {', '.join(lost)}")
    port = held.get("port") or str(PORT)
    if not port.isdigit():
        raise ValueError(f"[{SECTION}] port: {port!r} is no number")
    return f"jdbc:postgresql://{held['host']}:{port}/{held['dbname']}", {"user": held["user"], "password": held["password"]}


def month_predicates(column: str, first: Month, last: Month) -> list[str]:
    """A condition a month, in the escape syntax that JDBC drivers translate."""
    return [f""""{column}" >= {{d '{a}'}} AND "{column}" < {{d '{b}'}}""" for a, b in map(month_bounds, months_between(first, last))]


def read_months(spark: SparkSession, url: str, table: str, first: Month, last: Month, column: str = "fecha", properties: dict[str, str] | None = None) -> DataFrame:
    """Rows of a range of months, a partition a month; filters and columns of the query go to the database."""
    return spark.read.jdbc(url, table, predicates=month_predicates(column, first, last), properties={"fetchsize": str(BATCH)} | (properties or {}))


@contextmanager
def transaction(spark: SparkSession, url: str, properties: dict[str, str] | None = None) -> Iterator[Any]:
    """A connection whose statements count together or not at all."""
    jvm = spark.sparkContext._jvm
    held = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        held.setProperty(k, v)
    connection = jvm.java.sql.DriverManager.getConnection(url, held)
    connection.setAutoCommit(False)
    try:
        yield connection
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()


def _send(connection: Any, sql: str, *values: Any) -> int:
    statement = connection.prepareStatement(sql)
    try:
        for i, v in enumerate(values, 1):
            statement.setObject(i, v)
        return statement.executeUpdate()
    finally:
        statement.close()


def has_table(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> bool:
    """Asked of the catalogue, by the name as written and as databases fold it."""
    with transaction(spark, url, properties) as c:
        for name in (table, table.upper(), table.lower()):
            found = c.getMetaData().getTables(None, None, name, None)
            try:
                if found.next():
                    return True
            finally:
                found.close()
    return False


def months_held(spark: SparkSession, url: str, table: str, column: str = "fecha", properties: dict[str, str] | None = None) -> DataFrame:
    """(anio, mes, filas) of a table, counted by the database."""
    year, month = (f'{{fn {part}("{column}")}}' for part in ("YEAR", "MONTH"))
    query = f"(SELECT {year} AS anio, {month} AS mes, COUNT(*) AS filas FROM {table} GROUP BY {year}, {month}) m"
    found = spark.read.jdbc(url, query, properties=properties or {}).toDF("anio", "mes", "filas")
    return found.select(F.col("anio").cast("int").alias("anio"), F.col("mes").cast("int").alias("mes"), F.col("filas").cast("long").alias("filas"))


def replace_month(rows: DataFrame, url: str, table: str, month: Month, types: str, column: str = "fecha", properties: dict[str, str] | None = None) -> int:
    """Replace a month of a table, which is made if it is not there (``types``: its columns' types in the database). All rows must be of the
    month. The staged rows are counted by the write and by the database; if these differ, or anything fails, the table stays as it was."""
    spark, staging, (first, after) = rows.sparkSession, f"{table}_carga", month_bounds(month)
    inside = (F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(after))
    strange = F.raise_error(F.concat(F.lit(f"a row is outside {month}: "), F.coalesce(F.col(column).cast("string"), F.lit("no date"))))
    seen, held = Observation(), properties or {}
    checked = rows.withColumn(column, F.when(inside, F.col(column)).otherwise(strange.cast("date")))
    options = {"createTableColumnTypes": types, "batchsize": str(BATCH), **held}
    if not has_table(spark, url, table, held):
        rows.limit(0).write.options(**options).jdbc(url, table, properties=held)
    checked.observe(seen, F.count(F.lit(1)).alias("filas")).write.mode("overwrite").options(**options).jdbc(url, staging, properties=held)
    sent = seen.get.get("filas", 0)
    names = ", ".join(f'"{c}"' for c in rows.columns)
    date_of = spark.sparkContext._jvm.java.sql.Date
    with transaction(spark, url, held) as c:
        _send(c, f'DELETE FROM {table} WHERE "{column}" >= ? AND "{column}" < ?', date_of.valueOf(str(first)), date_of.valueOf(str(after)))
        moved = _send(c, f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}")
        if moved != sent:
            raise OSError(f"{table}: {sent} rows were written and {moved} arrived")
    with transaction(spark, url, held) as c:
        _send(c, f"DROP TABLE {staging}")
    return moved
