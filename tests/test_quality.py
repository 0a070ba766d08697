from datetime import date

from helpers import dated, month
from pyspark.sql import functions as F

from quarterlake.functions.calendar import calendar
from quarterlake.operators import quality, versions


def _cal(spark):
    return calendar(spark, date(2024, 1, 1), date(2025, 12, 31))


def test_length_by_calendar(spark):
    long = month(spark, 2025, 4, first=5)
    assert [(r.diferencia, r.es_dia_largo) for r in quality.wrong_length_days(long, _cal(spark)).collect()] == [(-4, True)]
    short = month(spark, 2025, 9, first=7)
    assert [r.diferencia for r in quality.wrong_length_days(short, _cal(spark)).collect()] == [4]
    shifted = month(spark, 2024, 4, first=5, hours=range(25)).unionByName(month(spark, 2024, 4, first=6))
    assert [r.diferencia for r in quality.wrong_length_days(shifted, _cal(spark)).collect()] == [4, -4]
    assert quality.wrong_length_days(month(spark), _cal(spark)).count() == 0


def test_each_check_finds_its_defect_alone(spark):
    good = month(spark)
    assert not quality.has_problems(quality.summary(good, _cal(spark)))
    three = good.where("NOT (hora = 5 AND minuto = 15)")
    assert [(r.hora, r.cuartos, r.minutos) for r in quality.incomplete_hours(three).collect()] == [(5, 3, [0, 30, 45])]
    seven = good.withColumn("minuto", F.when((F.col("hora") == 5) & (F.col("minuto") == 15), 7).otherwise(F.col("minuto")).cast("short"))
    assert quality.incomplete_hours(seven).count() == 1 and quality.counters(seven).first().minutos_invalidos == 1
    twice = good.unionByName(good.where("hora = 3 AND minuto = 0"))
    assert [(r.hora, r.veces) for r in quality.duplicate_keys(twice).collect()] == [(3, 2)]
    assert quality.duplicate_keys(month(spark, hours=[23, 24])).count() == 0
    bad = good.withColumn("hora", F.lit(25).cast("short")).withColumn("cmg_usd_mwh", F.lit(None).cast("double"))
    assert quality.counters(bad).first()[2:] == (96, 96)


def test_ghost_hour(spark):
    s = month(spark, 2025, 9, first=7, prices=lambda h: 0.0 if h == 0 else 5.0)
    assert [tuple(r)[1:] for r in quality.ghost_hours(s).collect()] == [(0, 4, 4)]
    assert quality.drop_ghost_hours(s).count() == 92


def test_true_counts_beyond_the_detail_limit(spark):
    s = month(spark, days=25).where("minuto <> 45")
    assert quality.incomplete_hours(s).count() == 500 and quality.summary(s, _cal(spark))["horas_incompletas"] == 600


def test_day_shape(spark):
    def raw(day, hours, n=4, other=0):
        rows = [("f", day, day.strftime("%Y%m%d"), str(h), b) for h in hours for b in ("X", "Y") for _ in range(n)]
        return spark.createDataFrame(rows + [("f", day, "20000101", "3", "X")] * other, "archivo string, dia date, FECHA string, HORA string, BARRA string")

    kinds = lambda df: sorted(r.tipo for r in quality.day_shape(df).collect())
    assert kinds(raw(date(2025, 6, 1), range(24))) == []
    assert kinds(raw(date(2025, 6, 1), range(1, 25))) == ["horas_base_1"]
    assert kinds(raw(date(2025, 4, 5), range(24))) == ["falta_hora_extra", "largo_inesperado"]
    assert kinds(raw(date(2025, 9, 7), range(24))) == ["hora_fantasma"]
    assert kinds(raw(date(2025, 6, 1), range(24), other=1)) == ["barras_con_otro_largo", "fechas_de_otro_dia"]


def test_headers():
    want = ["FECHA", "HORA", "P"]
    kinds = lambda cols: [(x["severidad"], x["tipo"]) for x in quality.header_findings("m", cols, want, ["FECHA"])]
    assert kinds(want) == [] and kinds(["HORA", "FECHA", "P", ""]) == [("info", "columnas_en_otro_orden")]
    assert kinds(["HORA", "P", "Q"]) == [("critico", "columnas_requeridas"), ("advertencia", "columnas_nuevas")]


def _manifest(spark, rows):
    return spark.createDataFrame([(date.fromisoformat(d), t, v, i, p and date.fromisoformat(p), n) for d, t, v, i, p, n in rows], "fecha_operacion date, tipo string, version int, reemision int, fecha_publicacion date, nombre string")


def test_version_winner(spark):
    m = _manifest(spark, [
        ("2025-03-01", "pre", 3, 0, "2025-03-09", "a"), ("2025-03-01", "def", 1, 0, None, "b"), ("2025-03-02", "def", 2, 0, "2025-04-01", "c"), ("2025-03-02", "def", 2, 1, "2025-03-01", "d"),
        ("2025-03-03", "def", 3, 0, "2025-04-01", "e"), ("2025-03-03", "def", 3, 0, "2025-04-02", "f"), ("2025-03-04", "def", 1, 0, None, "g"), ("2025-03-04", "desconocido", 1, 0, None, "h"), ("2020-01-01", "def", 1, 0, None, "i"),
    ])
    assert [r.nombre for r in versions.choose_by_day(m).collect()] == ["b", "d", "f"]
    assert [tuple(r) for r in versions.doubtful_days(m).collect()] == [(date(2025, 3, 4), ["h"])]


def test_islands_across_new_year(spark):
    days = [date(2023, 12, 30), date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 3), date(2024, 1, 3)]
    got = versions.day_islands(spark.createDataFrame([(d,) for d in days], "fecha date")).collect()
    assert [tuple(r) for r in got] == [(date(2023, 12, 30), date(2024, 1, 1), 3), (date(2024, 1, 3), date(2024, 1, 3), 1)]
    months = spark.createDataFrame([(2019, 11), (2019, 12), (2020, 1), (2020, 3)], "anio int, mes int")
    assert [tuple(r) for r in versions.month_islands(months).collect()] == [("2019-11", "2020-01", 3), ("2020-03", "2020-03", 1)]


def test_completeness_and_start(spark):
    m = _manifest(spark, [("2025-03-01", "def", 1, 0, None, "a"), ("2025-03-02", "pre", 1, 0, None, "b"), ("2025-03-05", "def", 1, 0, None, "c")])
    got = versions.completeness(m, date(2025, 3, 1), date(2025, 3, 6), date(2025, 4, 1)).collect()
    assert [(r.estado, str(r.desde), r.dias) for r in got] == [("pre_sin_definitivo", "2025-03-02", 1), ("sin_archivo", "2025-03-03", 2), ("sin_archivo", "2025-03-06", 1)]
    assert str(versions.suggested_start(m, date(2025, 3, 6), date(2025, 3, 1)).first()[0]) == "2025-03-02"
    assert str(versions.suggested_start(m, date(2025, 3, 1), date(2025, 3, 1)).first()[0]) == "2025-03-01"


def test_compare_versions(spark):
    a, b = month(spark, prices=1.0), month(spark, prices=1.0, hours=range(23))
    new = a.withColumn("cmg_usd_mwh", F.when(F.col("hora") == 2, 3.0).otherwise(F.col("cmg_usd_mwh")))
    assert versions.compare_versions(new, b).first()[1:] == (92, 4, 2.0, 2.0, 4, 0)
    assert dated(a).count() == 96
