"""Media columns: write payloads as ISO base media containers and read codec, timing and keyframe byte ranges back."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import slices, table

WIDTH = 64  # bytes of one picture row: the payload is padded to a multiple of it
ROWS = 64  # rows of a full picture
FRAME = WIDTH * ROWS
KEY_EVERY = 8
CHUNK = 4
TIMESCALE, FRAME_TICKS = 25_000, 1_000
#: Boxes whose payload is boxes again.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"mvex", b"moof", b"traf"}


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 >= 1 << 32:
        return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body
    return struct.pack(">I4s", len(body) + 8, kind) + body


def _full(kind: bytes, body: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), body)


def pad_payload(data: bytes) -> bytes:
    """Bytes 0 up to a positive multiple of WIDTH."""
    return data + bytes(-len(data) % WIDTH if data else WIDTH)


_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def write_container(payload: bytes) -> bytes:
    """A movie with one track of raw 8-bit grey pictures, WIDTH wide; the last picture may have fewer rows."""
    if not payload or len(payload) % WIDTH:
        raise ValueError("the payload must be a positive multiple of WIDTH bytes")
    sizes = [min(FRAME, len(payload) - at) for at in range(0, len(payload), FRAME)]
    n, duration = len(sizes), len(sizes) * FRAME_TICKS
    chunks = [sizes[i : i + CHUNK] for i in range(0, n, CHUNK)]
    keys = list(range(1, n + 1, KEY_EVERY))
    wide = len(payload) + 4096 + 16 * n >= 1 << 32

    def tables(base: int) -> bytes:
        at, offsets = base, []
        for c in chunks:
            offsets.append(at)
            at += sum(c)
        runs = [(1, CHUNK, 1)] if len(chunks[-1]) == CHUNK or len(chunks) == 1 and n == CHUNK else ([(1, CHUNK, 1)] if len(chunks) > 1 else []) + [(len(chunks), len(chunks[-1]), 1)]
        entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", WIDTH, ROWS, 0x480000, 0x480000, 0, 1), bytes(32), struct.pack(">Hh", 8, -1))
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1) + entry),
            _full(b"stts", struct.pack(">III", 1, n, FRAME_TICKS)),
            _full(b"stss", struct.pack(f">I{len(keys)}I", len(keys), *keys)),
            _full(b"stsc", struct.pack(">I", len(runs)) + b"".join(struct.pack(">III", *r) for r in runs)),
            _full(b"stsz", struct.pack(f">II{n}I", 0, n, *sizes)),
            _full(b"co64", struct.pack(f">I{len(offsets)}Q", len(offsets), *offsets)) if wide else _full(b"stco", struct.pack(f">I{len(offsets)}I", len(offsets), *offsets)),
        )
        minf = _box(b"minf", _full(b"vmhd", bytes(8), flags=1), _box(b"dinf", _full(b"dref", struct.pack(">I", 1) + _full(b"url ", b"", flags=1))), stbl)
        mdia = _box(b"mdia", _full(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, duration, 0x55C4, 0)), _full(b"hdlr", bytes(4) + b"vide" + bytes(12) + b"grey\0"), minf)
        tkhd = _full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, duration) + bytes(8) + struct.pack(">HHHH", 0, 0, 0, 0) + _MATRIX + struct.pack(">II", WIDTH << 16, ROWS << 16), flags=3)
        mvhd = _full(b"mvhd", struct.pack(">IIIIIH", 0, 0, TIMESCALE, duration, 0x10000, 0x100) + bytes(10) + _MATRIX + bytes(24) + struct.pack(">I", 2))
        return _box(b"moov", mvhd, _box(b"trak", tkhd, mdia))

    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2mp41")
    mdat = _box(b"mdat", payload)
    head = len(ftyp) + len(tables(0)) + len(mdat) - len(payload)
    return ftyp + tables(head) + mdat


def walk_boxes(data: memoryview, begin: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path, payload begin, payload end) of every box, outer ones first; a box that does not fit its parent is an error."""
    todo = [(begin, len(data) if end is None else end, path)]
    while todo:
        at, stop, up = todo.pop()
        while at < stop:
            if stop - at < 8:
                raise ValueError(f"{stop - at} bytes left over in {b'/'.join(up)!r}")
            size, kind = struct.unpack_from(">I4s", data, at)
            head = 8
            if size == 1:
                (size,), head = struct.unpack_from(">Q", data, at + 8), 16
            elif size == 0:
                size = stop - at
            if size < head or at + size > stop:
                raise ValueError(f"box {kind!r} of {size} bytes does not fit at {at}")
            yield (*up, kind), at + head, at + size
            if kind in CONTAINERS:
                todo.append((at + head, at + size, (*up, kind)))
            at += size


@dataclass(frozen=True)
class Track:
    codec: str
    handler: str
    timescale: int
    duration: int
    samples: list[tuple[int, int]]  # offset and size
    times: list[int]
    keys: list[int]  # numbers of the keyframes, from 0

    def key_ranges(self) -> list[tuple[int, int]]:
        return [self.samples[k] for k in self.keys]

    def feature(self) -> str:
        ranges = ",".join(f"{at}+{n}" for at, n in self.key_ranges())
        return f"{self.codec.strip()};{self.handler};{self.timescale};{self.duration};{len(self.samples)};{ranges}"


def read_tracks(media: bytes) -> list[Track]:
    """Tracks by their sample tables; media payloads are not touched."""
    data = memoryview(media)
    tracks: list[dict[bytes, tuple[int, int]]] = []
    for path, begin, end in sorted(walk_boxes(data), key=lambda x: x[1] if x[0][-1] not in CONTAINERS else x[1] - 8):
        if path[-1] == b"trak":
            tracks.append({})
        elif tracks and b"trak" in path:
            tracks[-1].setdefault(path[-1], (begin, end))
    return [_track(data, t) for t in tracks]


def _ints(data: memoryview, box: tuple[int, int], skip: int, count: int, form: str = "I") -> tuple[int, ...]:
    if box[0] + skip + count * struct.calcsize(">" + form) > box[1]:
        raise ValueError("a table is longer than its box")
    return struct.unpack_from(f">{count}{form}", data, box[0] + skip)


def _track(data: memoryview, boxes: dict[bytes, tuple[int, int]]) -> Track:
    begin, _ = boxes[b"mdhd"]
    timescale, duration = struct.unpack_from(">QQIQ" if data[begin] == 1 else ">IIII", data, begin + 4)[2:4]
    handler = bytes(data[boxes[b"hdlr"][0] + 8 : boxes[b"hdlr"][0] + 12]).decode("latin-1")
    codec = bytes(data[boxes[b"stsd"][0] + 12 : boxes[b"stsd"][0] + 16]).decode("latin-1")
    one, n = _ints(data, boxes[b"stsz"], 4, 2)
    sizes = [one] * n if one else list(_ints(data, boxes[b"stsz"], 12, n))
    kind, form = (b"co64", "Q") if b"co64" in boxes else (b"stco", "I")
    chunks = _ints(data, boxes[kind], 8, _ints(data, boxes[kind], 4, 1)[0], form)
    runs = _ints(data, boxes[b"stsc"], 8, 3 * _ints(data, boxes[b"stsc"], 4, 1)[0])
    samples: list[tuple[int, int]] = []
    for i in range(0, len(runs), 3):
        last = runs[i + 3] - 1 if i + 3 < len(runs) else len(chunks)
        for c in range(runs[i] - 1, last):
            at = chunks[c]
            for size in sizes[len(samples) : len(samples) + runs[i + 1]]:
                samples.append((at, size))
                at += size
    stts = _ints(data, boxes[b"stts"], 8, 2 * _ints(data, boxes[b"stts"], 4, 1)[0])
    times, now = [], 0
    for i in range(0, len(stts), 2):
        for _ in range(stts[i]):
            times.append(now)
            now += stts[i + 1]
    keys = [k - 1 for k in _ints(data, boxes[b"stss"], 8, _ints(data, boxes[b"stss"], 4, 1)[0])] if b"stss" in boxes else list(range(len(samples)))
    if len(samples) != n or len(times) != n:
        raise ValueError("the sample tables disagree")
    return Track(codec, handler, timescale, duration, samples, times, keys)


def read_payload(media: bytes) -> bytes:
    """All samples of the first track in order."""
    return b"".join(media[at : at + n] for at, n in read_tracks(media)[0].samples)


def media_column(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, media): each text's UTF-8, padded, as a stored container. Null and empty texts give one row of zeros;
    null ids stay; repeated rows are stored each; an empty table gives an empty table; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array([write_container(pad_payload(x)) for x in texts], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {docs.schema[key].dataType.simpleString()}, n_bytes long, media binary")


def media_features(media: DataFrame) -> DataFrame:
    """Features of stored containers (doc_id, n_bytes, media), read back from their bytes.

    ``feature`` is codec;handler;timescale;duration in ticks;samples;keyframe byte ranges as offset+length from the start of
    the container. A null container gives nulls; one that is cut off or contradicts itself raises, as a lossless store must not
    lose payloads silently. Repeated rows are read each; an empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, stored in slices(batches, "media", 1 << 20):
            rows = []
            for x in stored:
                if not x:
                    rows.append((None,) * 7)
                    continue
                track = read_tracks(x)[0]
                payload = b"".join(x[at : at + n] for at, n in track.samples)
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(x), hashlib.sha256(x).hexdigest(), track.feature(), len(track.keys)))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *columns], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_keyframes"])

    kind = media.schema["doc_id"].dataType.simpleString()
    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_keyframes long")


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(media_column(table(spark, sf_dir, "documents")))
