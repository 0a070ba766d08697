"""Published file names: templates, versions, dates, labels."""

from __future__ import annotations

import re
import tomllib

from pyspark.sql import Column
from pyspark.sql import functions as F

# What published names look like.
PREFIX, EXTENSION, MUST_CONTAIN = "Antecedentes_CMG_Real_", ".zip", "cmg_real"
TYPES = {"def": "def", "pre": "pre", "pr": "pre", "prel": "pre"}
TEMPLATES = (
    "{tipo}_{fecha}",
    "{tipo}_{fecha}-{reemision}",
    "{tipo}_{fecha}_v{version}",
    "{tipo}_{fecha}_v{version}-{reemision}",
    "{tipo}_v{version}_{fecha}",
    "{tipo}_v{version}_{fecha}-{reemision}",
    "{tipo}-v{version}_{fecha}",
    "{tipo}-v{version}_{fecha}_",
    "{tipo}_{fecha}_v{version}_",
    "{tipo}{fecha}",
    "{tipo}",
    "{tipo}-v{version}_v{version2}",
)
MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")
# Fixed value: the phrase of a page's label.
LABEL = r"(?i)Costo\s+Marginal\s+Real\s+(Preliminar|Definitivo)(?:\W*v(\d+))?"


def pattern(template: str, types: dict[str, str] = TYPES) -> str:
    """An anchored expression for a template; its fields are numbered in the order of ``fields``."""
    field = {"tipo": "(" + "|".join(sorted(types, key=lambda t: (-len(t), t))) + ")", "fecha": r"(\d+)", "version": r"(\d+)", "version2": r"(\d+)", "reemision": r"(\d+)"}
    body = "".join(field[part[1:-1]] if part.startswith("{") else re.escape(part) for part in re.findall(r"\{\w+\}|[^{]+", template))
    return f"(?i)^{re.escape(PREFIX)}{body}{re.escape(EXTENSION)}$"


def fields(template: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", template)


def load_catalog(text: str) -> list[str]:
    """Templates of a TOML catalog; each one's example must match it."""
    forms = tomllib.loads(text)["formas"]
    for f in forms:
        if not re.match(pattern(f["plantilla"]), f["ejemplo"]):
            raise ValueError(f"the example {f['ejemplo']!r} does not match {f['plantilla']!r}")
    return [f["plantilla"] for f in forms]


def read_name(name: Column, templates: tuple[str, ...] = TEMPLATES) -> Column:
    """struct(tipo, version, reemision, fecha): the first template that matches; unknown names give ("desconocido", 1, 0, "")."""
    out = F.struct(F.lit("desconocido").alias("tipo"), F.lit(1).alias("version"), F.lit(0).alias("reemision"), F.lit("").alias("fecha"))
    kinds = F.create_map(*(F.lit(x) for kv in TYPES.items() for x in kv))
    for t in reversed(templates):
        p, at = pattern(t), {f: i + 1 for i, f in enumerate(fields(t))}
        number = lambda f, none: F.regexp_extract(name, p, at[f]).try_cast("int") if f in at else F.lit(none)
        got = F.struct(
            kinds[F.lower(F.regexp_extract(name, p, at["tipo"]))].alias("tipo"),
            F.greatest(F.coalesce(number("version", 1), F.lit(1)), F.coalesce(number("version2", 1), F.lit(1))).alias("version"),
            F.coalesce(number("reemision", 0), F.lit(0)).alias("reemision"),
            (F.regexp_extract(name, p, at["fecha"]) if "fecha" in at else F.lit("")).alias("fecha"),
        )
        out = F.when(name.rlike(p), got).otherwise(out)
    return out


def date_of_digits(digits: Column) -> Column:
    """6 digits yyMMdd (of this century), 8 digits yyyyMMdd; anything else is not guessed."""
    return F.when(F.length(digits) == 6, F.try_to_date(F.concat(F.lit("20"), digits), "yyyyMMdd")).when(F.length(digits) == 8, F.try_to_date(digits, "yyyyMMdd"))


def label_info(label: Column) -> Column:
    """struct(tipo, version) of a page's label, null where it cannot be read."""
    kind = F.lower(F.regexp_extract(label, LABEL, 1))
    version = F.coalesce(F.regexp_extract(label, LABEL, 2).try_cast("int"), F.lit(1))
    return F.when(label.rlike(LABEL), F.struct(F.when(kind == "preliminar", "pre").otherwise("def").alias("tipo"), version.alias("version")))


def classify(name: Column, label: Column) -> Column:
    """struct(tipo, version, reemision): the label's type, the greater version, the name's re-issue; one source alone if the other
    cannot be read."""
    n, e = read_name(name), label_info(label)
    version = F.when(e.isNull(), n["version"]).when(n["tipo"] != "desconocido", F.greatest(e["version"], n["version"])).otherwise(e["version"])
    return F.struct(F.coalesce(e["tipo"], n["tipo"]).alias("tipo"), version.alias("version"), n["reemision"].alias("reemision"))


def is_candidate(href: Column) -> Column:
    return F.lower(href).contains(MUST_CONTAIN) & F.lower(href).endswith(EXTENSION)


def day_of_url(url: Column) -> Column:
    """The last yyMMdd of a page's address."""
    return date_of_digits(F.regexp_extract(url, r"(\d{6})(?!.*\d{6})", 1))


def day_slug(day: Column) -> Column:
    """15-enero-2026"""
    months = F.array(*(F.lit(m) for m in MONTHS))
    return F.concat_ws("-", F.dayofmonth(day).cast("string"), F.element_at(months, F.month(day)), F.year(day).cast("string"))


def page_addresses(day: Column, suffixes: dict[int, str], root: str) -> Column:
    """The addresses (anio, mes, dia) of the pages of a day's year, month and day. A year's part ends as the source says (``suffixes``); a year
    without one is an error, as an address made up would look like a day without a publication."""
    year, name = F.year(day), F.element_at(F.array(*(F.lit(m) for m in MONTHS)), F.month(day))
    ends = F.create_map(*(F.lit(x) for pair in sorted(suffixes.items()) for x in pair)) if suffixes else F.lit(None).cast("map<int,string>")
    end = F.coalesce(F.try_element_at(ends, year), F.raise_error(F.concat(F.lit("no address is known for the year "), year.cast("string"))))
    part = F.concat(year.cast("string"), F.when(day.isNotNull(), end))
    month = F.concat_ws("-", name, part)
    of_year = F.concat(F.lit(root), F.lit("/"), part, F.lit("/"))
    of_month = F.concat(of_year, month, F.lit("/"))
    of_day = F.concat(of_month, F.date_format(day, "dd"), F.lit("-"), month, F.lit("/"))
    return F.struct(of_year.alias("anio"), of_month.alias("mes"), of_day.alias("dia"))


def masked(detail: Column) -> Column:
    """File names and dates masked, so that findings which differ in them alone are one group."""
    return F.regexp_replace(F.regexp_replace(detail, r"[\w.-]+\.(?i:zip|csv)", "<archivo>"), r"\d{4}-\d{2}-\d{2}", "<fecha>")


def safe_name(name: str) -> str:
    """Without the characters that some file systems forbid."""
    return re.sub(r'[<>:"/\\|?*\x00-\x1f]', "_", name).rstrip(". ") or "_"
