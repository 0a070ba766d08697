"""Drift of the source: members of a ZIP, names against labels, known years, and the expected structure of its pages."""

from __future__ import annotations

import tomllib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterlake.functions import names

# Members that a day's ZIP must have, those that it may have, and annexes that have nothing to do with prices.
MANDATORY_MEMBERS = {"comparativo": r"^CmgBarrasComparativo_\d{8}_\d{8}_15(_NUEVO)?\.csv$", "promedios": r"^PromediosBarras_?\d{8}_\d{8}_[RPE]\.csv$"}
KNOWN_MEMBERS = (
    r"^(CMgBarrasMinuto_\d{8}_\d{8}\.zip|CMgxBarraMinuto_\d{8}(_\d{6,8})?\.(zip|csv))$",
    r"^Fpen_(\d{8}(_MOD)?(_(def|pre))?|Reales_\d{6}(_MOD_\w+)?)\.xlsx$",
    r"^FPen_Mapeo_Barras\.xlsx$",
    r"^Barras_Subsistemas_\d{8}(_[PR])?\.xlsx$",
    r"^DesignacionCentrales_SD\d+_\d{8}\.xlsx$",
    r"^Profundidad Costo de Falla.*\.xlsx$",
    r"^C.lculo CF Racionamiento.*\.xlsx$",
    r"^ValorDolar_\d{4}\.xlsx$",
    r"^R_CMg_\w+_MOD_\w+\.xlsx$",
)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def member_findings(members: DataFrame) -> DataFrame:
    """(archivo, miembro) rows -> mandatory kinds without a member (critical), members that no pattern knows (warning)."""
    name = basename(F.col("miembro"))
    held = members.select("archivo", name.alias("m")).where("m <> ''")
    has = lambda p: F.coalesce(F.bool_or(F.col("m").rlike(p)), F.lit(False))
    lost = held.groupBy("archivo").agg(F.array_compact(F.array(*(F.when(~has(p), F.lit(k)) for k, p in MANDATORY_MEMBERS.items()))).alias("k")).select("archivo", F.lit("critico").alias("severidad"), F.lit("falta_miembro").alias("tipo"), F.explode("k").alias("detalle"))
    known = F.lit(False)
    for p in (*MANDATORY_MEMBERS.values(), *KNOWN_MEMBERS):
        known = known | F.col("m").rlike(p)
    new = held.where(~known).select("archivo", F.lit("advertencia").alias("severidad"), F.lit("miembro_nuevo").alias("tipo"), F.col("m").alias("detalle"))
    return lost.unionByName(new)


def document_findings(docs: DataFrame) -> DataFrame:
    """Contradictions between a document's name, its label and its day (fecha_operacion, nombre, etiqueta, fecha_publicacion)."""
    n, e = names.read_name(F.col("nombre")), names.label_info(F.col("etiqueta"))
    own = names.date_of_digits(n["fecha"])
    day = F.col("fecha_operacion")
    unread = n["tipo"] == "desconocido"
    say = lambda cond, sev, kind: F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(sev).alias("severidad"), F.lit(kind).alias("tipo")))
    found = F.array_compact(F.array(
        say(unread & e.isNull(), "critico", "sin_tipo"),
        say(unread & e.isNotNull(), "advertencia", "nombre_no_reconocido"),
        say(~unread & e.isNull(), "advertencia", "etiqueta_no_reconocida"),
        say(~unread & ((n["tipo"] != e["tipo"]) | (n["version"] != e["version"])), "info", "nombre_y_etiqueta_distintos"),
        say((n["fecha"] != "") & own.isNull(), "info", "fecha_ilegible"),
        say(own.isNotNull() & (own != day), "advertencia", "fecha_de_otro_dia"),
        say(F.col("fecha_publicacion").isNull(), "info", "sin_fecha_de_publicacion"),
        say(F.col("fecha_publicacion") < day, "advertencia", "publicado_antes_del_dia"),
    ))
    return docs.select(day, "nombre", F.explode(found).alias("f")).select("fecha_operacion", "nombre", "f.*")


def page_findings(found: DataFrame, parsed: DataFrame, known: DataFrame) -> DataFrame:
    """ZIP links of day pages (dia, href) that the parser did not take: candidates are critical, other products information; what is not
    critical about files already known is left out."""
    zips = found.where(F.lower("href").endswith(".zip")).select("dia", "href", basename(F.col("href")).alias("nombre"))
    unseen = zips.join(parsed.select("nombre").distinct(), "nombre", "left_anti")
    critical = names.is_candidate(F.col("href"))
    out = unseen.select("dia", "nombre", F.when(critical, "critico").otherwise("info").alias("severidad"), F.when(critical, "zip_no_visto").otherwise("otro_producto").alias("tipo"))
    quiet = known.select("nombre", F.lit(True).alias("known")).distinct()
    return out.join(quiet, "nombre", "left").where("severidad = 'critico' OR known IS NULL").drop("known")


def year_findings(site: DataFrame, known: DataFrame) -> DataFrame:
    """Years (anio, slug) of the index against the known ones: new, changed, gone; an empty index is critical."""
    both = site.withColumnRenamed("slug", "now").join(known.withColumnRenamed("slug", "before"), "anio", "full_outer")
    kind = F.when(F.col("before").isNull(), "anio_nuevo").when(F.col("now").isNull(), "anio_desaparecido").when(F.col("now") != F.col("before"), "anio_cambiado")
    out = both.select(F.col("anio").cast("string").alias("detalle"), kind.alias("tipo")).where("tipo IS NOT NULL").withColumn("severidad", F.when(F.col("tipo") == "anio_nuevo", "info").otherwise("advertencia"))
    empty = site.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("").alias("detalle"), F.lit("indice_vacio").alias("tipo"), F.lit("critico").alias("severidad"))
    return out.unionByName(empty)


def load_baseline(text: str) -> dict[str, list[str]]:
    """Sets of things that the source's pages must hold, by name, from TOML."""
    out = {}
    for key, value in tomllib.loads(text).items():
        items = value.get("esperados") if isinstance(value, dict) else value
        if not isinstance(items, list) or not all(isinstance(x, (str, int)) for x in items):
            raise ValueError(f"{key}: a list of texts is expected")
        out[key] = [str(x) for x in items]
    return out


def baseline_findings(expected: DataFrame, present: DataFrame) -> DataFrame:
    """(clave, valor) that are expected and gone: each is critical, and stops the download."""
    gone = expected.join(present.select("clave", "valor").distinct(), ["clave", "valor"], "left_anti")
    return gone.select(F.lit("critico").alias("severidad"), F.concat(F.lit("falta_"), F.col("clave")).alias("tipo"), F.col("valor").alias("detalle"))


def stops(findings: DataFrame) -> bool:
    return not findings.where("severidad = 'critico'").isEmpty()


def must_be_looked_at(findings: DataFrame) -> bool:
    return not findings.where("severidad IN ('critico', 'advertencia')").isEmpty()
