"""Every registered query of the engine against its SQL, on the smallest tables."""

import math
from datetime import date, datetime

import duckdb
import pytest

from quarterlake.plans.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: On the smallest tables these find nothing; on those of sf0.01 they do.
SPARSE = {"riesgo_por_dias", "hora_fantasma"}


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda x: round(x, 6) if isinstance(x, float) and not math.isnan(x) else x
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, con, name):
    got = QUERIES[name](spark, sf_dir)
    rows = got.collect()
    assert rows or name in SPARSE
    if name in SQL:
        want = con.execute(SQL[name])
        columns = [d[0] for d in want.description]
        assert sorted(got.columns) == sorted(columns)
        assert _rows(got.columns, rows) == _rows(columns, want.fetchall())
    else:
        assert len(got.columns) > 1


@pytest.mark.parametrize("name", sorted(SPARSE))
def test_sparse_queries_find_rows_in_larger_tables(spark, name):
    d = "/root/testdata/sf0.01"
    larger = duckdb.connect()
    for t in TABLES:
        larger.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    got, want = QUERIES[name](spark, d), larger.execute(SQL[name])
    columns, rows = [x[0] for x in want.description], got.collect()
    assert rows and _rows(got.columns, rows) == _rows(columns, want.fetchall())


def test_risk_by_days_has_every_day_of_the_table(spark, tmp_path):
    """Days of two earlier fixed ranges, and others; a line without a day or an hour is in no quarter. A range that is asked for still holds."""
    from quarterlake.plans import queries
    from quarterlake.workflows import reports

    days = [datetime(1993, 12, 20), datetime(1994, 2, 4), datetime(1995, 11, 20), datetime(1996, 2, 3), datetime(1998, 7, 4)]
    lines = [(part, 1, flag, "F", day, 0.05) for part, day in [*((7, d) for d in days), (7, None), (None, days[0])] for flag in "RA"]
    spark.createDataFrame(lines, "l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz, l_discount double").write.parquet(f"file://{tmp_path}/lineitem.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    got, want = QUERIES["riesgo_por_dias"](spark, f"file://{tmp_path}"), c.execute(SQL["riesgo_por_dias"])
    columns, rows = [x[0] for x in want.description], got.collect()
    assert [r["fecha"] for r in rows] == [str(d.date()) for d in days]
    assert _rows(got.columns, rows) == _rows(columns, want.fetchall())
    held = reports.range_risk_series(queries.dated_series(spark, f"file://{tmp_path}"), "R.F", "A.F", date(1995, 11, 20), date(1996, 2, 3))
    assert [r["fecha"] for r in held.collect()] == [date(1995, 11, 20), date(1996, 2, 3)]


def test_month_filters_prune_the_stored_layout(spark, sf_dir):
    """Months are partitions, and the bus and the columns reach the Parquet scan."""
    from quarterlake.operators import gold
    from quarterlake.plans import queries

    _, series = queries.stored(spark, sf_dir)
    plan = gold.monthly_summary(series, "N.O", (1996, 2), (1997, 10))._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    filters = next(x for x in plan.split("\n") if "PartitionFilters" in x)
    pushed = next(x for x in plan.split("\n") if "PushedFilters" in x)
    schema = next(x for x in plan.split("\n") if "ReadSchema" in x)
    assert "anio" in filters and "mes" in filters and "EqualTo(barra,N.O)" in pushed and "usd_clp" not in schema and "fecha_hora" not in schema


def test_readers_do_not_see_a_month_being_written(spark, tmp_path):
    from helpers import month
    from quarterlake.sources import silver

    base = f"file://{tmp_path}/silver"
    silver.write_month(month(spark), base, (2024, 6))
    month(spark, 2024, 7).write.parquet(f"{base}/_work/2024-7__tmp")
    assert silver.scan(spark, base).count() == 96 and silver.written_months(spark, base) == [(2024, 6)]
