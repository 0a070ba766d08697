"""Documents of the source, kept up with the revisions of its pages, and one command's look at all of it.

Pages come as a stream whose offset is the revision cursor; each batch's documents replace what was known of the same names in one commit. A
batch that comes again, as its run was cut after the commit, finds the commit and does nothing."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.functions import names
from quarterlake.operators import versions
from quarterlake.sources import bronze, control, savedpages, snapshots
from quarterlake.workflows import watch

TABLE = "documento_publicado"
DOCUMENTS = "nombre string, fecha_operacion date, etiqueta string, tipo string, version int, reemision int, fecha_publicacion date, url string, revisado string"


def documents_of_revisions(pages: DataFrame, base_url: str = "") -> DataFrame:
    """(DOCUMENTS) of pages (loc, lastmod, html): of a name that several revisions have, the latest one's."""
    keyed = pages.select(F.concat_ws(" ", "lastmod", "loc").alias("dia"), "html")
    of = F.split("fecha_operacion", " ", 2)
    found = bronze.documents_of_pages(keyed, base_url).withColumn("revisado", of[0]).withColumn("fecha_operacion", names.day_of_url(of[1]))
    columns = [x.split(" ")[0] for x in DOCUMENTS.split(", ")]
    rest = [c for c in columns if c != "nombre"]
    return found.groupBy("nombre").agg(F.max_by(F.struct(*rest), F.struct("revisado", "url")).alias("d")).select("nombre", "d.*").select(*columns)


def known_documents(spark: SparkSession, root: str, at: snapshots.Snapshot | None = None) -> DataFrame:
    return snapshots.read(spark, root, TABLE, DOCUMENTS, at or snapshots.snapshot(spark, root))


def merge_documents(root: str, base_url: str = ""):
    """A ``foreachBatch`` writer."""

    def write(batch: DataFrame, number: int) -> None:
        spark, label = batch.sparkSession, f"revisions {number}"
        if any(snapshots.snapshot(spark, root, v).what == label for v in snapshots.versions(spark, root)):
            return
        tx = snapshots.Transaction(spark, root)
        new = documents_of_revisions(batch, base_url).persist()
        try:
            if not new.isEmpty():
                old = tx.read(TABLE, DOCUMENTS).join(new.select("nombre"), "nombre", "left_anti")
                tx.replace(TABLE, "", old.unionByName(new).coalesce(1))  # some files a day
                tx.commit(label, datetime.now())
        finally:
            new.unpersist()

    return write


def sync(spark: SparkSession, folder: str, root: str, checkpoint: str, base_url: str = "") -> DataFrame:
    """Read all revisions since the last run, then stop; returns what is known. The cursor moves on with Spark's checkpoint, after each
    batch's commit."""
    stream = savedpages.page_stream(spark, folder)
    query = stream.writeStream.foreachBatch(merge_documents(root, base_url)).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return known_documents(spark, root)


def to_download(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """Known documents of a known type that the manifest does not have."""
    return versions.new_files(known_documents(spark, root).where("tipo IN ('def', 'pre')"), control.read_manifest(spark, folder)).orderBy("fecha_operacion", "nombre")


def watch_source(spark: SparkSession, pages: str, root: str, folder: str, series: DataFrame, first: date, last: date, fetch: watch.Fetch | None = None, baseline: dict | None = None) -> dict:
    """The source against its baseline (where one is given), its revisions, what is to be downloaded, and the series' days: {"findings", "documents",
    "new", "lines"}. A critical finding of the baseline stops before the revisions are read, so that the cursor stays."""
    findings = watch.preflight(spark, fetch, baseline) if fetch and baseline else []
    if watch.stops_download(findings):
        return {"findings": findings, "documents": 0, "new": [], "lines": []}
    known = sync(spark, pages, root, f"{root}/_cursor")
    manifest = control.read_manifest(spark, folder)
    missing = watch.missing_by_cause(series, manifest, first, last)
    findings += [r.asDict() for r in watch.coverage_findings(missing).collect()]
    new = [r["nombre"] for r in to_download(spark, root, folder).select("nombre").collect()]  # some files a day
    return {"findings": findings, "documents": known.count(), "new": new, "lines": watch.status_lines(versions.coverage(series, manifest, first, last), missing, first, last)}
