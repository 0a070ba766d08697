from datetime import date

import pytest
from pyspark.sql import functions as F

from quarterlake.functions import calendar, domain, names, search

LONG = ["2021-04-03", "2022-04-02", "2023-04-01", "2024-04-06", "2025-04-05", "2026-04-04"]
SHORT = ["2021-09-05", "2022-09-11", "2023-09-03", "2024-09-08", "2025-09-07"]


def test_hours_of_measured_days(spark):
    got = {str(r.fecha): r for r in calendar.calendar(spark, date(2021, 1, 1), date(2026, 12, 31)).collect()}
    assert all(got[d].horas == 25 and got[d].cuartos_esperados == 100 and got[d].es_dia_largo for d in LONG)
    assert all(got[d].horas == 23 and got[d].cuartos_esperados == 92 and got[d].es_dia_corto for d in SHORT)
    assert all(got[d].horas == 24 for d in ("2025-06-15", "2026-01-01", "2025-12-31", "2024-02-29"))
    for year in range(2021, 2027):
        assert sorted(r.horas for d, r in got.items() if d.startswith(str(year)) and r.horas != 24) == [23, 25]


def test_missing_and_expected_hours(spark):
    df = spark.createDataFrame([(date(2025, 9, 7),), (date(2025, 4, 5),), (date(2025, 6, 1),)], "d date")
    short, long, plain = df.select(calendar.missing_hours(F.col("d")), calendar.expected_hours(F.col("d"))).collect()
    assert short[0] == [0] and short[1] == list(range(1, 24))
    assert long[0] == [] and long[1] == list(range(25))
    assert plain[0] == [] and plain[1] == list(range(24))


def test_inverted_days_raise(spark):
    with pytest.raises(ValueError):
        calendar.days(spark, date(2025, 1, 2), date(2025, 1, 1))


def test_blocks_and_times(spark):
    df = spark.range(-1, 27).select(F.col("id").cast("int").alias("h"))
    got = {r[0]: r[1] for r in df.select("h", domain.block_of_hour(F.col("h"))).collect()}
    assert [got[h] for h in (0, 7, 8, 17, 18, 22, 23, 24)] == ["A", "A", "B", "B", "C", "C", "A", "A"]
    assert got[-1] is None and got[25] is None
    at = df.where("h in (23, 24)").select(domain.local_time(F.lit(date(2025, 4, 5)), F.col("h"), F.lit(15)).cast("string")).collect()
    assert [r[0] for r in at] == ["2025-04-05 23:15:00", None]


def test_official_names(spark):
    rows = [(n,) for n in [*domain.RENAMED, "OTRA", None]]
    got = [r[0] for r in spark.createDataFrame(rows, "n string").select(domain.official_name(F.col("n"))).collect()]
    assert got == [*domain.RENAMED.values(), "OTRA", None]


def test_months():
    assert domain.from_index(domain.month_index(2024, 12)) == (2024, 12)
    assert domain.months_between((2023, 11), (2024, 2)) == [(2023, 11), (2023, 12), (2024, 1), (2024, 2)]
    assert domain.month_bounds((2024, 12)) == (date(2024, 12, 1), date(2025, 1, 1))
    assert domain.month_tranches(date(2024, 1, 30), date(2024, 3, 2)) == [(date(2024, 1, 30), date(2024, 1, 31)), (date(2024, 2, 1), date(2024, 2, 29)), (date(2024, 3, 1), date(2024, 3, 2))]
    with pytest.raises(ValueError):
        domain.months_between((2024, 2), (2024, 1))
    assert domain.solar_shortcut(7.5) == 7.5
    assert domain.no_solar_shortcut(100, 200) == pytest.approx((9 * 100 + 5 * 200) / 14)


@pytest.mark.parametrize(("text", "want"), [("", ((2021, 1), (2025, 6))), ("2023", ((2023, 1), (2023, 12))), ("2025-03", ((2025, 3), (2025, 6))), ("2025-01 a 2025-03", ((2025, 1), (2025, 3))), ("últimos 3", ((2025, 4), (2025, 6))), ("2025", ((2025, 1), (2025, 6)))])
def test_period_grammar(text, want):
    assert domain.parse_period(text, (2021, 1), (2025, 6)) == want


@pytest.mark.parametrize("text", ["2030", "2025-13", "x", "2025-03 a 2025-01", "ultimos 0", "1999-01"])
def test_bad_periods(text):
    with pytest.raises(ValueError):
        domain.parse_period(text, (2021, 1), (2025, 6))


def test_file_names(spark):
    p = names.PREFIX
    cases = {
        "def_260115.zip": ("def", 1, 0, "260115"), "pre_260401-1.zip": ("pre", 1, 1, "260401"), "def_260801_V2.zip": ("def", 2, 0, "260801"), "pre_260811_v2-1.zip": ("pre", 2, 1, "260811"),
        "prel_v2_250612.zip": ("pre", 2, 0, "250612"), "def_v2_260610-1.zip": ("def", 2, 1, "260610"), "def-v3_250225.zip": ("def", 3, 0, "250225"), "pre-v2_250220_.zip": ("pre", 2, 0, "250220"),
        "pre_251230_v2_.zip": ("pre", 2, 0, "251230"), "pre251116.zip": ("pre", 1, 0, "251116"), "pre.zip": ("pre", 1, 0, ""), "def-v3_v2.zip": ("def", 3, 0, ""), "pr_240907.zip": ("pre", 1, 0, "240907"),
        "otro.zip": ("desconocido", 1, 0, ""),
    }
    got = spark.createDataFrame([(p + n,) for n in cases], "n string").select(names.read_name(F.col("n")).alias("x")).select("x.*").collect()
    assert [tuple(r) for r in got] == list(cases.values())


def test_labels_and_dates(spark):
    rows = [("Antecedentes Costo Marginal Real Preliminar", "250203"), ("Costo Marginal Real Definitivo v2", "20250717"), ("costo  marginal real Definitivo – V2", "25406"), ("Informe definitivo", "250231")]
    got = spark.createDataFrame(rows, "l string, d string").select(names.label_info(F.col("l")).alias("i"), names.date_of_digits(F.col("d")).alias("d")).collect()
    assert [r.i and tuple(r.i) for r in got] == [("pre", 1), ("def", 2), ("def", 2), None]
    assert [r.d for r in got] == [date(2025, 2, 3), date(2025, 7, 17), None, None]
    both = spark.createDataFrame([(names.PREFIX + "def-v3_250225.zip", "Costo Marginal Real Preliminar v3"), (names.PREFIX + "def_v2_250201.zip", "Costo Marginal Real Definitivo"), ("x.zip", "Costo Marginal Real Definitivo v2"), (names.PREFIX + "pre.zip", "")], "n string, l string")
    assert [tuple(r[0]) for r in both.select(names.classify(F.col("n"), F.col("l"))).collect()] == [("pre", 3, 0), ("def", 2, 0), ("def", 2, 0), ("pre", 1, 0)]


def test_search(spark):
    buses = ["STA.ELVIRA____013", "STA.ELVIRA____220", "PEÑABLANCA____110", "A.BLANCAS_____013", "C.NAVIA_______220", "QUILLOTA______220"]
    df = spark.createDataFrame([(b,) for b in buses], "barra string")
    assert search.search(df, "santa elvira 220").first()[:3] == ("STA.ELVIRA____220", 95, True) or search.search(df, "santa elvira 220").first().barra == "STA.ELVIRA____220"
    assert search.search(df, "penablanca").first().barra == "PEÑABLANCA____110"
    assert search.search(df, "cerro navia").first().barra == "C.NAVIA_______220"
    assert [r.barra for r in search.menu_search(df, "elvira").collect()] == ["STA.ELVIRA____013", "STA.ELVIRA____220"]
    assert [r.barra for r in search.menu_search(df, "quilota 220").collect()][:1] == ["QUILLOTA______220"] and search.menu_search(df, " ").count() == 0
    assert search.menu_search(df, "013 elvira").first().puntaje < 2 and search.menu_search(df, "sta elvira 013").first().puntaje == 3
    assert search.normalized("PEÑABLANCA____110") == "PENABLANCA 110"
    assert search.read_numbers("1,3-4", 5) == [0, 2, 3] and search.read_numbers("9", 5) is None and search.read_numbers("todas", 2) == [0, 1]


@pytest.mark.parametrize("zone", ["UTC", "America/Santiago", "America/New_York", "Asia/Tokyo"])
def test_calendar_does_not_depend_on_the_session_zone(spark, zone):
    from quarterlake.functions import calendar

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {str(r.fecha): (r.horas, r.es_dia_largo, r.es_dia_corto) for r in calendar.calendar(spark, date(2024, 1, 1), date(2024, 12, 31)).collect()}
        assert got["2024-04-06"] == (25, True, False) and got["2024-09-08"] == (23, False, True)
        assert sum(h != 24 for h, _, _ in got.values()) == 2
        hours = calendar.days(spark, date(2024, 9, 7), date(2024, 9, 8)).select(calendar.missing_hours(F.col("fecha")).alias("m"), calendar.expected_hours(F.col("fecha")).alias("e")).collect()
        assert [r.m for r in hours] == [[], [0]] and [len(r.e) for r in hours] == [24, 23]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_search_rules(spark):
    df = spark.createDataFrame([("P.MONTT_____220",), ("NVA_P.MONTT___220",), ("ŽABRAN 110",), ("LA SUR 066",), ("POZO ALMONTE 220",)], "barra string")
    got = [tuple(r) for r in search.search(df, "puerto montt").collect()]
    assert [g[0] for g in got[:2]] == ["P.MONTT_____220", "NVA_P.MONTT___220"] and got[0][2] and got[0][1] == got[1][1]
    assert search.search(df, "montt 66").first().barra in ("P.MONTT_____220", "LA SUR 066") and search.menu_search(df, "žabran").first().puntaje > 2
    assert search.short_forms("MAR") == ["M", "MA", "MR"] and "RIO" not in search.short_forms("RIOS") and "SUR" not in search.short_forms("SUROR")


def test_the_letter_bound_loses_no_name(spark):
    """Names whose ratio reaches the threshold pass the bound; most others do not."""
    import random
    from difflib import SequenceMatcher

    r = random.Random(4)
    parts = ["QUILLOTA", "PENABLANCA", "NAVIA", "ELVIRA", "MONTT", "ALTO", "JAHUEL", "CRUCERO", "220", "110", "066", "013"]
    names = sorted({" ".join(r.sample(parts, r.randint(1, 3))) for _ in range(300)} | {"", "A", "Q" * 40})
    df = spark.createDataFrame([(n,) for n in names], "barra string")
    for asked in ("QUILOTA 22", "JAHUEL", "ELVIRRA 013", "ZZZ"):
        passed = {x.barra for x in df.where(search.can_be_alike(asked, F.col("barra"))).collect()}
        reached = {n for n in names if SequenceMatcher(None, asked, n).ratio() >= search.LEAST_RATIO}
        assert reached <= passed and len(passed) < 0.7 * len(names)


def test_addresses_of_pages(spark):
    df = spark.createDataFrame([(date(2026, 1, 5),), (None,)], "d date")
    got = df.select(names.page_addresses(F.col("d"), {2026: "-costo"}, "r").alias("p")).select("p.*").collect()
    assert tuple(got[0]) == ("r/2026-costo/", "r/2026-costo/enero-2026-costo/", "r/2026-costo/enero-2026-costo/05-enero-2026-costo/") and got[1].dia is None
    with pytest.raises(Exception, match="no address is known for the year 2026"):
        df.select(names.page_addresses(F.col("d"), {2025: "-x"}, "r")).collect()


def test_findings_by_severity(spark, tmp_path):
    from quarterlake.operators import report

    rows = [("info", "b", "x", 1, ""), ("critico", "a", "y", 2, "wait"), ("advertencia", "c", "z", 3, "")]
    df = spark.createDataFrame(rows, "severidad string, tipo string, detalle string, veces int, accion string")
    text = report.write_findings(df, str(tmp_path))
    assert [x for x in text.split("\n") if x.startswith("##")] == ["## critico (2)", "## advertencia (3)", "## info (1)"]
    assert "- a: y (2) -> wait" in text and (tmp_path / "hallazgos.md").read_text() == text and report.write_findings(df.where("false"), str(tmp_path / "no")) is None
    assert not (tmp_path / "no").exists()
