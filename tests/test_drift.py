from datetime import date

import pytest
from helpers import month
from pyspark.sql import functions as F

from quarterlake import cli
from quarterlake.functions.names import PREFIX
from quarterlake.operators import drift, publish
from quarterlake.sources import silver


def test_members(spark):
    rows = [("a.zip", "x/CmgBarrasComparativo_20250101_20250101_15.csv"), ("a.zip", "PromediosBarras20250101_20250101_R.csv"), ("a.zip", "Fpen_20250101_MOD_def.xlsx"), ("b.zip", "PromediosBarras_20250101_20250101_E.csv"), ("b.zip", "raro.bin"), ("b.zip", "CmgBarrasOtro.csv")]
    got = sorted(tuple(r) for r in drift.member_findings(spark.createDataFrame(rows, "archivo string, miembro string")).collect())
    assert got == [("b.zip", "advertencia", "miembro_nuevo", "CmgBarrasOtro.csv"), ("b.zip", "advertencia", "miembro_nuevo", "raro.bin"), ("b.zip", "critico", "falta_miembro", "comparativo")]


def test_documents(spark):
    d = date(2025, 3, 2)
    rows = [
        (d, PREFIX + "def_250302_v2.zip", "Antecedentes Costo Marginal Real Definitivo v2", date(2025, 4, 1)), (d, PREFIX + "def_250303.zip", "Costo Marginal Real Preliminar", None), (d, "x.zip", "nada", date(2025, 1, 1)), (d, PREFIX + "def_25406.zip", "Costo Marginal Real Definitivo", date(2025, 4, 1)),
    ]
    df = spark.createDataFrame(rows, "fecha_operacion date, nombre string, etiqueta string, fecha_publicacion date")
    got = {(r.nombre.removeprefix(PREFIX), r.tipo) for r in drift.document_findings(df).collect()}
    assert got == {("def_250303.zip", "nombre_y_etiqueta_distintos"), ("def_250303.zip", "fecha_de_otro_dia"), ("def_250303.zip", "sin_fecha_de_publicacion"), ("x.zip", "sin_tipo"), ("x.zip", "publicado_antes_del_dia"), ("def_25406.zip", "fecha_ilegible")}


def test_pages_years_and_baseline(spark):
    found = spark.createDataFrame([(date(2025, 1, 1), "/u/CMG_Real_x.zip"), (date(2025, 1, 1), "/u/otro.zip"), (date(2025, 1, 1), "/u/viejo.zip"), (date(2025, 1, 1), "/u/visto.zip")], "dia date, href string")
    name = lambda *n: spark.createDataFrame([(x,) for x in n], "nombre string")
    got = sorted((r.nombre, r.severidad) for r in drift.page_findings(found, name("visto.zip"), name("viejo.zip", "CMG_Real_x.zip")).collect())
    assert got == [("CMG_Real_x.zip", "critico"), ("otro.zip", "info")]
    years = lambda *y: spark.createDataFrame(list(y), "anio int, slug string")
    got = sorted((r.detalle, r.tipo) for r in drift.year_findings(years((2024, "a"), (2025, "b"), (2026, "c")), years((2024, "a"), (2025, "x"), (2023, "q"))).collect())
    assert got == [("2023", "anio_desaparecido"), ("2025", "anio_cambiado"), ("2026", "anio_nuevo")]
    assert "indice_vacio" in {r.tipo for r in drift.year_findings(years().limit(0) if False else spark.createDataFrame([], "anio int, slug string"), years((2024, "a"))).collect()}
    base = drift.load_baseline('marcadores = ["a", "b"]\n[indice]\nesperados = [2024]')
    exp = spark.createDataFrame([(k, v) for k, vs in base.items() for v in vs], "clave string, valor string")
    f = drift.baseline_findings(exp, exp.where("valor <> 'b'"))
    assert [(r.tipo, r.detalle) for r in f.collect()] == [("falta_marcadores", "b")] and drift.stops(f) and not drift.stops(f.limit(0))
    with pytest.raises(ValueError):
        drift.load_baseline('x = "text"')


def test_revisions_and_inventory(spark):
    o = publish.origins(spark)
    ch = spark.createDataFrame([(date(2025, 1, 1), None, 2), (date(2025, 1, 2), 3, 2), (date(2025, 2, 2), 3, 2)], "fecha date, origen_antes smallint, origen_despues smallint")
    got = publish.revisions(ch, o, date(2025, 1, 1), date(2025, 1, 31)).collect()
    assert [(r.antes, r.despues) for r in got] == [(None, "pagina_cen_def"), ("pagina_cen_pre", "pagina_cen_def")]
    s = month(spark).withColumn("usd_clp", F.lit(900.0))
    assert publish.day_inventory(s).first()[1:] == ("maestro_cmg_db", 900.0) and publish.preliminary_days(publish.day_inventory(s), date(2024, 6, 1), date(2024, 6, 2)).count() == 0
    assert publish.buses_with_data(publish.monthly_tables(s)[0], date(2024, 6, 15), date(2024, 7, 1)).first().barra == "REF"
    assert publish.exchange_rates(s).first().usd_clp == 900.0


def test_command_line(spark, tmp_path, capsys):
    base = f"file://{tmp_path}/s"
    assert cli.main(["estado", base], spark) == cli.FAILED and cli.main(["x"], spark) == cli.USAGE
    silver.write_month(month(spark), base, (2024, 6))
    assert cli.main(["estado", base], spark) == cli.OK and cli.main(["bloques", base, "REF"], spark) == cli.OK and cli.main(["revisar", base], spark) == cli.OK
    silver.write_month(month(spark, hours=range(23)), base, (2024, 6))
    assert cli.main(["revisar", base], spark) == cli.LOOK and "dias_con_largo_incorrecto: 1" in capsys.readouterr().out
