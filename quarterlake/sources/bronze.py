"""Daily source files: ZIP members, CSV dialects, pages and site maps."""

from __future__ import annotations

import codecs
import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from itertools import pairwise
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.functions import names
from quarterlake.functions.domain import block_of_hour, extra_hour, local_time, official_name
from quarterlake.operators.quality import drop_ghost_hours, finding, header_findings
from quarterlake.schema import FINDING, MANIFEST, ORIGIN_DEFINITIVE, ORIGIN_PRELIMINARY

MEMBER = re.compile(r"(?:^|/)CmgBarrasComparativo_\d+_\d+_15(?:_NUEVO)?\.csv$", re.I)
# The price column of each type, in every dialect. A later match wins, as new prices come last.
PRICE_COLUMN = {
    "def": re.compile(r"^(CMG_REAL_DEF([ _]v2)?\[USD/MWh\]|CMgR\[mills/kWh\])$"),
    "pre": re.compile(r"^(CMG_REAL_PRE([ _]v2)?\[USD/MWh\]|CMgP\[mills/kWh\])$"),
}
REQUIRED = ("FECHA", "HORA", "MINUTO", "BARRA")
# The comparison's header, its price columns by dialect, and columns that only some revisions have.
LEADING, TRAILING = (*REQUIRED, "INFO_BARRA_ID", "INFO_BARRA_NOMBRE"), ("USD", "MODIFICADO")
PRICES_NOW = ("CMG_EN_LINEA[USD/MWh]", "CMG_REAL_PRE[USD/MWh]", "CMG_REAL_DEF[USD/MWh]")
PRICES_2024 = ("CMgE[mills/kWh]", "CMgP[mills/kWh]", "CMgR[mills/kWh]")
REVISED = ("CMG_REAL_PRE v2[USD/MWh]", "CMG_REAL_DEF v2[USD/MWh]", "CMG_REAL_PRE_v2[USD/MWh]", "CMG_REAL_DEF_v2[USD/MWh]")
# The averages' header, with the price columns of each dialect.
AVERAGES = ("BARRA", "BARRA INFO ID", "BARRA INFO NOMBRE", "FECHA", "HORA", "MINUTO")
AVERAGES_NOW, AVERAGES_2024 = ("CMg[CLP/KWh]", "CMg[USD/MWh]"), ("CMg[$/KWh]", "CMg[mills/kWh]")
ROWS = 50_000
#: Characters of pages' blocks that leave Python at a time, and what a link counts beside its address.
PIECE, LINK = 1 << 20, 64


def zip_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)


def price_column(header: list[str], kind: str) -> str:
    found = [c for c in header if PRICE_COLUMN[kind].match(c.strip())]
    if not found:
        raise ValueError(f"no price column of type {kind!r} in {header}")
    return found[-1]


class Dialect(NamedTuple):
    """A header's columns in order, those that must be there, and those that tell this dialect from others of its table."""

    marks: tuple[str, ...]
    columns: tuple[str, ...]
    required: tuple[str, ...]


def _comparison(prices: tuple[str, ...], *marks: str) -> Dialect:
    return Dialect(marks, (*LEADING, *prices, *TRAILING), (*REQUIRED, *prices[1:]))


def _averages(prices: tuple[str, ...], *marks: str) -> Dialect:
    return Dialect(marks, (*AVERAGES, *prices, "INTERVALO", "REPORTE"), ("BARRA", "FECHA", "HORA", "MINUTO", prices[1]))


#: The dialects of each member; the last comparison mixes the first price column of the newer with the others of the older.
COMPARISONS = (_comparison(PRICES_NOW), _comparison(PRICES_2024, PRICES_2024[2]), _comparison((PRICES_NOW[0], *PRICES_2024[1:]), PRICES_2024[2], PRICES_NOW[0]))
AVERAGE_DIALECTS = (_averages(AVERAGES_NOW), _averages(AVERAGES_2024, AVERAGES_2024[1]))


def spoken(header: list[str], dialects: tuple[Dialect, ...], revised: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """(known, required) columns of the dialect most of whose marks a header has. Columns of revisions are known wherever they stand; a
    header with any of them may order its columns as it likes."""
    best = max((d for d in dialects if set(d.marks) <= set(header)), key=lambda d: len(d.marks))
    extra = [c for c in revised if c in header]
    known = sorted([*best.columns, *extra], key=lambda c: header.index(c) if c in header else len(header)) if extra else list(best.columns)
    return known, list(best.required)


def find_member(z: zipfile.ZipFile) -> str:
    """The first comparison CSV, in whatever folder."""
    member = next((n for n in z.namelist() if MEMBER.search(n)), None)
    if member is None:
        raise ValueError("no comparison CSV in the ZIP")
    return member


class MemberLines:
    """A member's header, and its lines with something in them as (number, cells), inflated and decoded as they are asked for. ``empty``
    counts the lines of separators alone that were passed over."""

    def __init__(self, z: zipfile.ZipFile, member: str) -> None:
        self.z, self.member, self.empty = z, member, 0
        self.encoding = self._encoding()
        with self._text() as text:
            self.header = [c.strip() for c in text.readline().rstrip("\n").split(";")]

    def _encoding(self) -> str:
        """UTF-8 if the whole member is; one pass without keeping anything."""
        decoder = codecs.getincrementaldecoder("utf-8-sig")()
        try:
            with self.z.open(self.member) as raw:
                while chunk := raw.read(1 << 20):
                    decoder.decode(chunk)
                decoder.decode(b"", True)
        except UnicodeDecodeError:
            return "latin-1"
        return "utf-8-sig"

    def _text(self) -> io.TextIOWrapper:
        return io.TextIOWrapper(self.z.open(self.member), self.encoding)

    def __iter__(self) -> Iterator[tuple[int, list[str]]]:
        self.empty = 0
        with self._text() as text:
            text.readline()
            for n, line in enumerate(text, 2):
                if line.strip("; \t\r\n"):
                    yield n, line.rstrip("\r\n").split(";")
                else:
                    self.empty += 1


def comparativo_rows(zips: DataFrame, kind: str) -> DataFrame:
    """Raw text rows of many day files of one type: archivo, FECHA, HORA, MINUTO, BARRA, valor, USD. One file is read by one task,
    and passed on in bounded pieces."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                z = zipfile.ZipFile(io.BytesIO(content))
                lines = MemberLines(z, find_member(z))
                header = lines.header
                at = [header.index(c) for c in (*REQUIRED, price_column(header, kind))] + [header.index("USD") if "USD" in header else -1]
                held: list[list[str | None]] = []
                for _, r in lines:
                    held.append([path, *((r[i].strip() or None) if 0 <= i < len(r) else None for i in at)])
                    if len(held) == ROWS:
                        yield pd.DataFrame(held, columns=["archivo", *REQUIRED, "valor", "USD"])
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=["archivo", *REQUIRED, "valor", "USD"])

    return zips.select("path", "content").mapInPandas(run, "archivo string, FECHA string, HORA string, MINUTO string, BARRA string, valor string, USD string")


def to_series(raw: DataFrame, kind: str) -> DataFrame:
    """Raw rows in the series' form, without hours that the clock did not show. Rows with data and no bus, and rows whose day,
    hour or minute cannot be read (null), stay, to be reported."""
    hour, minute = F.col("HORA").try_cast("int"), F.col("MINUTO").try_cast("int")
    day = F.try_to_date("FECHA", "yyyyMMdd")
    number = lambda c: F.regexp_replace(c, ",", ".").try_cast("double")
    out = raw.select(
        official_name(F.col("BARRA")).alias("barra"), day.alias("fecha"), hour.cast("short").alias("hora"), minute.cast("short").alias("minuto"), block_of_hour(hour).alias("bloque"), number(F.col("valor")).alias("cmg_usd_mwh"),
        extra_hour(hour).alias("es_hora_extra"), local_time(day, hour, minute).alias("fecha_hora"), number(F.col("USD")).alias("usd_clp"), F.lit(ORIGIN_DEFINITIVE if kind == "def" else ORIGIN_PRELIMINARY).alias("origen"), F.localtimestamp().alias("ingerido_en"),
    )
    return drop_ghost_hours(out)


def zip_findings(zips: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """Findings on each file: not a ZIP, damaged members, no comparison CSV, header drift against ``expected`` or, without it, against
    the dialect that the header speaks."""

    def look(path: str, content: bytes) -> list[dict]:
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                if bad := z.testzip():
                    return [finding("critico", "zip_corrupto", bad, file=path)]
                member = find_member(z)
                header = MemberLines(z, member).header
        except zipfile.BadZipFile as e:
            return [finding("critico", "zip_corrupto", str(e), file=path)]
        except ValueError as e:
            return [finding("critico", "sin_comparativo", str(e), file=path)]
        known, required = spoken(header, COMPARISONS, REVISED) if expected is None else (expected, list(REQUIRED))
        return [x | {"archivo": path} for x in header_findings(member, header, known, required)]

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            rows = [x for path, content in zip(pdf["path"], pdf["content"], strict=True) for x in look(path, content)]
            yield pd.DataFrame(rows, columns=FINDING.fieldNames())

    return zips.select("path", "content").mapInPandas(run, FINDING)


def zip_members(zips: DataFrame) -> DataFrame:
    """(archivo, miembro) of readable files, from their directories alone; folders' own entries do not count."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        rows += [(path, n) for n in z.namelist() if not n.endswith("/")]
                except zipfile.BadZipFile:
                    continue
            yield pd.DataFrame(rows, columns=["archivo", "miembro"])

    return zips.select("path", "content").mapInPandas(run, "archivo string, miembro string")


def fingerprints(zips: DataFrame) -> DataFrame:
    return zips.select(F.regexp_replace("path", "^.*/", "").alias("nombre"), F.sha2("content", 256).alias("sha256"), F.length("content").cast("long").alias("bytes"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest as a table; unreadable lines are left out."""
    return spark.read.schema(MANIFEST).option("mode", "DROPMALFORMED").json(path)


class _Block:
    """A div: where its texts start and end among those of the page, its title in parts, and the links that it is the nearest div of."""

    def __init__(self, start: int) -> None:
        self.start, self.end = start, start
        self.title: list[str] = []
        self.links: list[tuple[int, str]] = []


class _Page(HTMLParser):
    """Links of a page with the nearest enclosing div. The page's texts are kept once, in order: a div has those between its tags, and
    one that is left open those up to the next open one."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.divs = [_Block(0)]
        self.blocks: list[_Block] = []
        self.seen: set[str] = set()
        self.title_of: _Block | None = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        a, block = dict(attrs), self.divs[-1]
        if tag == "div":
            self.divs.append(_Block(len(self.texts)))
        elif tag == "a" and a.get("href") and a["href"] not in self.seen:
            if not block.links:
                self.blocks.append(block)
            block.links.append((len(self.seen), a["href"]))
            self.seen.add(a["href"])
        elif tag == "span" and "informes-estudio-Titulo" in (a.get("class") or "").split():
            self.title_of = block if not block.title else None
            if a.get("title"):
                block.title, self.title_of = [a["title"]], None

    def handle_endtag(self, tag: str) -> None:
        if tag == "div" and len(self.divs) > 1:
            self.divs.pop().end = len(self.texts)
        elif tag == "span":
            self.title_of = None

    def handle_data(self, data: str) -> None:
        self.texts.append(data)
        if self.title_of is not None and (part := data.strip()):
            self.title_of.title.append(part)

    def close(self) -> None:
        super().close()
        for block, inner in pairwise(self.divs):
            block.end = inner.start
        self.divs[-1].end = len(self.texts)


def page_blocks(html: str | None) -> Iterator[tuple[str, str, list[tuple[int, str]]]]:
    """(title, text, [(n, href)]) of every block with links, one at a time; a link that comes again is left out."""
    p = _Page()
    p.feed(html or "")
    p.close()
    for block in p.blocks:
        yield "".join(block.title), " ".join(" ".join(p.texts[block.start : block.end]).split()), block.links


def page_links(html: str | None) -> list[tuple[str, str, str]]:
    """(href, title, block text) of every distinct link, in order."""
    found = sorted((n, href, title, text) for title, text, held in page_blocks(html) for n, href in held)
    return [(href, title, text) for _, href, title, text in found]


def block_pieces(batches: Iterable[pa.RecordBatch], key: str, most: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Blocks of the pages (k, h) in pieces of about ``most`` characters, whatever the number of pages in a batch; a longer block is one piece."""
    pairs = pa.list_(pa.struct([("n", pa.int32()), ("href", pa.string())]))

    def piece(batch: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
        at, title, text, links = zip(*held, strict=True)
        each = [[{"n": n, "href": href} for n, href in x] for x in links]
        return pa.RecordBatch.from_arrays([batch.column("k").take(pa.array(at)), pa.array(title, pa.string()), pa.array(text, pa.string()), pa.array(each, pairs)], [key, "titulo", "texto", "enlaces"])

    for batch in batches:
        held, size = [], 0
        for at, html in enumerate(batch.column("h")):
            for title, text, links in page_blocks(html.as_py()):
                held.append((at, title, text, links))
                size += len(title) + len(text) + sum(len(href) + LINK for _, href in links)
                if size >= most:
                    yield piece(batch, held)
                    held, size = [], 0
        if held:
            yield piece(batch, held)


def links(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """(key, n, href, titulo, texto) of every page's links. A block's text leaves Python once, however many links the block has."""
    kind = pages.schema[key].dataType.simpleString()
    held = pages.select(F.col(key).alias("k"), F.col(html).alias("h"))
    blocks = held.mapInArrow(lambda batches: block_pieces(batches, key), f"{key} {kind}, titulo string, texto string, enlaces array<struct<n:int,href:string>>")
    return blocks.select(key, "titulo", "texto", F.inline("enlaces")).select(key, "n", "href", "titulo", "texto")


def documents_of_pages(pages: DataFrame, base_url: str = "") -> DataFrame:
    """Day pages (dia, html) -> published documents with type, version, re-issue and publication date."""
    held = links(pages, "dia").where(F.col("href").contains("/wp-content/uploads/") & names.is_candidate(F.col("href")))
    name = F.element_at(F.split("href", "/"), -1)
    kind = names.classify(name, F.col("titulo"))
    published = F.try_to_date(F.regexp_extract("texto", r"(?i)fecha de publicaci[oó]n:?\s*(\d{2}/\d{2}/\d{4})", 1), "dd/MM/yyyy")
    return held.select(F.col("dia").alias("fecha_operacion"), F.when(F.col("titulo") != "", F.col("titulo")).otherwise(F.substring("texto", 1, 120)).alias("etiqueta"), kind["tipo"].alias("tipo"), kind["version"].alias("version"), kind["reemision"].alias("reemision"), published.alias("fecha_publicacion"), F.when(F.col("href").startswith("http"), F.col("href")).otherwise(F.concat(F.lit(base_url), F.col("href"))).alias("url"), name.alias("nombre"))


#: A map of addresses or of maps; other elements, and those of other name spaces, are not read.
SITEMAP = "url array<struct<loc:string,lastmod:string>>, sitemap array<struct<loc:string,lastmod:string>>"


def sitemap_entries(pages: DataFrame, xml: str = "xml") -> DataFrame:
    """(loc, lastmod) of site maps, by Spark's XML parser; entries without an address or a readable date, and maps that are no XML, are left out."""
    parsed = pages.select(F.from_xml(F.col(xml), SITEMAP, {"mode": "PERMISSIVE"}).alias("m"))
    none = F.array().cast("array<struct<loc:string,lastmod:string>>")
    each = parsed.select(F.inline(F.concat(F.coalesce("m.url", none), F.coalesce("m.sitemap", none))))
    return each.select(F.trim("loc").alias("loc"), F.try_to_timestamp(F.trim("lastmod")).alias("lastmod")).where("loc <> '' AND lastmod IS NOT NULL")


def revisions_after(entries: DataFrame, cursor: Column) -> DataFrame:
    """Entries changed strictly after the cursor, with the day of their address."""
    return entries.where(F.col("lastmod") > cursor).select("loc", "lastmod", names.day_of_url(F.col("loc")).alias("fecha")).orderBy(F.desc("lastmod"), "loc")
