"""Small control files beside the data, through Hadoop's file system: JSON written aside and renamed over the old one."""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.schema import MANIFEST

MANIFEST_FILE, STATE_FILE, CURSOR_FILE, SLUGS_FILE = "manifest.json", "estado.json", "sitemap.json", "slugs.json"
WITNESS = ".testigo.json"


def file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, none if it is not there."""
    fs, p = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_bytes(spark: SparkSession, path: str) -> bytes:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def _rename(spark: SparkSession, aside, path: str, how: str) -> None:
    jvm = spark.sparkContext._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = getattr(rename, how)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(aside, jvm.org.apache.hadoop.fs.Path(path), options)


def _write_aside(spark: SparkSession, path: str, text: str):
    fs, aside = file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return fs, aside


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Readers see the old text or the new one."""
    _, aside = _write_aside(spark, path, text)
    _rename(spark, aside, path, "OVERWRITE")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """The same for a file that must not be there yet: of several writers one gets True."""
    fs, aside = _write_aside(spark, path, text)
    try:
        _rename(spark, aside, path, "NONE")
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    return True


def replace(spark: SparkSession, aside: str, path: str) -> None:
    """A file that was written aside takes the place of another, or of none."""
    _rename(spark, file_system(spark, aside)[1], path, "OVERWRITE")


def read_json(spark: SparkSession, path: str, default: Any) -> Any:
    """The value; the default where the file is absent or cannot be read: work is then done again, never wrongly skipped."""
    if not exists(spark, path):
        return default
    try:
        return json.loads(read_bytes(spark, path).decode("utf-8"))
    except (ValueError, UnicodeDecodeError):
        return default


def write_json(spark: SparkSession, path: str, value: Any) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, indent=1, sort_keys=True))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.delete(p, True)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest, one JSON object by file name, as a table; absent or unreadable: no rows."""
    empty = spark.createDataFrame([], MANIFEST)
    path = f"{folder}/{MANIFEST_FILE}"
    if not exists(spark, path):
        return empty
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", f"map<string, {MANIFEST.simpleString()}>").alias("m"))
    rows = whole.select(F.explode("m").alias("k", "v")).select("k", "v.*")
    return rows.withColumn("nombre", F.coalesce("nombre", "k")).select(*MANIFEST.fieldNames())


def write_manifest(spark: SparkSession, folder: str, entries: dict[str, dict]) -> None:
    write_json(spark, f"{folder}/{MANIFEST_FILE}", {k: {c: None if v is None else v if isinstance(v, (int, str)) else v.isoformat() for c, v in e.items()} for k, e in entries.items()})


def leave_witness(spark: SparkSession, folder: str, entry: dict, use: str, now: str) -> bool:
    """A small witness in place of a file that is no longer needed: written first, so that a crash leaves a witness too many and never
    one too few. A file whose bytes are not those of the manifest stays. True if the file went."""
    path = f"{folder}/{entry['nombre']}"
    if not exists(spark, path):
        return False
    digest = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]
    if digest != entry["sha256"]:
        return False
    kept = {k: entry[k] if isinstance(entry[k], (int, str)) else str(entry[k]) for k in ("nombre", "sha256", "bytes", "fecha_operacion", "tipo")}
    write_json(spark, path + WITNESS, kept | {"uso": use, "procesado_en": now})
    return delete(spark, path)


def witnessed(spark: SparkSession, folder: str, entry: dict) -> bool:
    """Whether a witness says that this very file's rows are in the series."""
    w = read_json(spark, f"{folder}/{entry['nombre']}{WITNESS}", {})
    return isinstance(w, dict) and w.get("uso") == "silver" and w.get("sha256") == entry["sha256"]
