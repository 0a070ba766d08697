"""Saved pages as a stream: ``spark.readStream.format("paginas_guardadas")`` over a folder of pages and the log of their revisions.

The log (``revisiones.jsonl``) has an address, the time of its last change and the file of its page a line; a revision is appended when its page is
saved. The stream's offset is the cursor of revisions: the last change that was read, and its address. Spark's checkpoint moves it on when a
batch's results are in place, so a run that is cut short begins at the same revision again."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from quarterlake.sources.dayfiles import opened

FORMAT, LOG = "paginas_guardadas", "revisiones.jsonl"
SCHEMA = "loc string, lastmod string, html string"
#: Pages that one task reads.
PER_TASK = 50


def revisions(folder: str, after: tuple[str, str] = ("", ""), to: tuple[str, str] | None = None) -> list[dict]:
    """Entries of the log after a cursor, in order of change and address; of one revision that is logged twice the later line. A last line that is
    not whole (its writer was cut short) does not count."""
    where, path = opened(f"{folder}/{LOG}")
    if where.get_file_info(path).type == fs.FileType.NotFound:
        return []
    with where.open_input_stream(path) as f:
        lines = f.read().decode("utf-8").split("\n")[:-1]
    held = {(e["lastmod"], e["loc"]): e for e in map(json.loads, filter(None, lines))}
    return [held[k] for k in sorted(held) if k > after and (to is None or k <= to)]


def append_revision(folder: str, loc: str, lastmod: str, name: str, html: str) -> None:
    """Save a page, then log it: what the log names is there. One writer a folder."""
    where, path = opened(f"{folder}/{name}")
    where.create_dir(path.rpartition("/")[0], recursive=True)
    with where.open_output_stream(path) as out:
        out.write(html.encode("utf-8"))
    where, path = opened(f"{folder}/{LOG}")
    before = b""
    if where.get_file_info(path).type != fs.FileType.NotFound:
        with where.open_input_stream(path) as f:
            before = f.read()
    before = before[: before.rfind(b"\n") + 1]
    with where.open_output_stream(path + ".tmp") as out:
        out.write(before + (json.dumps({"loc": loc, "lastmod": lastmod, "archivo": name}, ensure_ascii=False) + "\n").encode("utf-8"))
    where.move(path + ".tmp", path)


@dataclass
class Pages(InputPartition):
    entries: list[dict]


class PageStream(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder = options["path"]

    def initialOffset(self) -> dict:  # noqa: N802
        return {"lastmod": "", "loc": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        """The end of the log. A batch has no limit of its own: the source is not told where a query that starts again stands."""
        held = revisions(self.folder)
        return {k: held[-1][k] for k in ("lastmod", "loc")} if held else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        held = revisions(self.folder, *((o["lastmod"], o["loc"]) for o in (start, end)))
        return [Pages(held[i : i + PER_TASK]) for i in range(0, len(held), PER_TASK)]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        for e in partition.entries:
            where, path = opened(f"{self.folder}/{e['archivo']}")
            with where.open_input_stream(path) as f:
                html = f.read().decode("utf-8", "replace")
            yield pa.RecordBatch.from_pydict({"loc": [e["loc"]], "lastmod": [e["lastmod"]], "html": [html]}, pa.schema([(n, pa.string()) for n in ("loc", "lastmod", "html")]))

    def commit(self, end: dict) -> None:
        """Nothing is forgotten: the cursor is the checkpoint's."""


class SavedPages(DataSource):
    """Option ``path``: the folder."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> PageStream:  # noqa: N802
        return PageStream(dict(self.options))


def page_stream(spark: SparkSession, folder: str) -> DataFrame:
    spark.dataSource.register(SavedPages)
    return spark.readStream.format(FORMAT).option("path", folder).load()
