"""The data source over day files: rows, days pushed into it, members, and bounded memory."""

import resource
import subprocess
import sys
import zipfile
from datetime import date

import pytest
from test_workflows import day_file

from quarterlake.sources import bronze, dayfiles


@pytest.fixture
def folder(tmp_path):
    for d in (9, 10, 11):
        day_file(str(tmp_path), date(2025, 9, d), price=float(d))
    with zipfile.ZipFile(tmp_path / "z_pre.zip", "w") as z:
        z.writestr("carpeta/CmgBarrasComparativo_20250912_20250912_15_NUEVO.csv", "FECHA;HORA;MINUTO;BARRA;CMG_REAL_PRE[USD/MWh]\n20250912;0;0;CAÑETE;1,5\n;;;;\n  \n20250912;0;15;;2\n".encode("latin-1"))
    return tmp_path


def test_rows_are_those_of_whole_files(spark, folder):
    d9 = [p for p in sorted(map(str, folder.iterdir())) if "2509" in p]
    whole = bronze.comparativo_rows(spark.read.format("binaryFile").load(["file://" + p for p in d9]), "def")
    got = dayfiles.day_rows(spark, ["file://" + p for p in d9], "def")
    key = lambda df: sorted(map(tuple, df.selectExpr("regexp_replace(archivo, '.*/', '')", "FECHA", "HORA", "MINUTO", "BARRA", "valor", "USD").collect()), key=str)
    assert got.columns == ["archivo", "dia", "linea", "FECHA", "HORA", "MINUTO", "BARRA", "valor", "USD"]
    assert key(got) == key(whole) and len(key(got)) == 3 * 192
    pre = dayfiles.day_rows(spark, str(folder / "z_pre.zip"), "pre").collect()
    assert [(r.linea, r.BARRA, r.valor, r.USD, r.dia) for r in pre] == [(2, "CAÑETE", "1,5", None, date(2025, 9, 12)), (5, None, "2", None, date(2025, 9, 12))]


def test_days_and_columns_reach_the_source(spark, folder):
    (folder / "a_bad.zip").write_bytes((folder / "z_pre.zip").read_bytes())
    with zipfile.ZipFile(folder / "a_bad.zip", "w") as z:
        z.writestr("CmgBarrasComparativo_20240101_20240101_15.csv", "no header that is known\n")
    d = lambda n: date(2025, 9, n)
    held = dayfiles.reader(spark, f"file://{folder}", d(10), d(11), tipo="def").schema("valor string, dia date").load()
    assert {(r.valor, r.dia.day) for r in held.collect()} == {("10.0", 10), ("11.0", 11)} and held.columns == ["valor", "dia"]
    assert held.where("dia = DATE '2025-09-10'").count() == 192 and held.count() == 2 * 192  # filters leave nothing behind
    assert {r.dia.day for r in dayfiles.day_rows(spark, f"file://{folder}", "def", last=d(11), first=d(11)).collect()} == {11}
    with pytest.raises(Exception, match="no price column"):
        dayfiles.day_rows(spark, f"file://{folder}", "def", last=d(9)).collect()
    assert dayfiles.reader(spark, f"file://{folder}", d(9), d(11), maxbytes="1").load().rdd.getNumPartitions() == 5


def test_members(spark, folder):
    (folder / "b_broken.zip").write_bytes(b"no zip")
    with zipfile.ZipFile(folder / "c_none.zip", "w") as z:
        z.writestr("otro.csv", "a")
    got = {r.archivo.rsplit("/", 1)[-1]: r for r in dayfiles.member_table(spark, f"file://{folder}").collect()}
    pre = got["z_pre.zip"]
    assert (pre.dia, pre.codificacion, pre.filas, pre.vacias, pre.error) == (date(2025, 9, 12), "latin-1", 2, 2, None) and pre.cabecera[-1] == "CMG_REAL_PRE[USD/MWh]"
    assert got["b_broken.zip"].error.startswith("zip_corrupto") and got["c_none.zip"].error.startswith("sin_comparativo")
    found = dayfiles.empty_line_findings(dayfiles.member_table(spark, f"file://{folder}")).collect()
    assert [(r.tipo, r.detalle) for r in found] == [("lineas_vacias", "2 lineas")]
    assert dayfiles.member_table(spark, f"file://{folder}", date(2025, 9, 10), date(2025, 9, 10)).count() == 1
    assert dayfiles.reachable(f"file://{folder}") and not dayfiles.reachable(f"file://{folder}/no") and not dayfiles.reachable("viewfs://store/x")


def test_memory_does_not_grow_with_the_member(tmp_path):
    """Reading a member of 150 MB adds a few batches to the process, not the member."""
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("CmgBarrasComparativo_20250912_20250912_15.csv", "w", force_zip64=True) as out:
        out.write(b"FECHA;HORA;MINUTO;BARRA;CMG_REAL_DEF[USD/MWh];X\n")
        for _ in range(60):
            out.write(b"20250912;0;0;BARRA;1.5;" + b"x" * 100 + b"\n" + b"".join(b"20250912;0;15;B%d;1.5;%s\n" % (i, b"y" * 100) for i in range(20_000)))
    code = f"""
import resource, sys
sys.path.insert(0, {str(sys.path[0])!r}); sys.path.insert(0, "/root/repo")
from pyspark.sql.types import StructType
from quarterlake.sources import dayfiles
r = dayfiles.DayFileReader(StructType().add("BARRA", "string").add("valor", "string"), {{"path": "{tmp_path}"}})
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
n = sum(b.num_rows for p in r.partitions() for b in r.read(p))
print(n, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert int(out[-2]) == 60 * 20_001 and int(out[-1]) < 60_000 and resource  # kB
