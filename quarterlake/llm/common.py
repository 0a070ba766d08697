"""Helpers shared by the corpus operators: shared-folder tables, bounded Arrow slices, word hashing."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the word definition ``[^\x20\x09-\x0D]+``.
SPACE = b" \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
#: Python workers look at this many bytes of text at a time.
SLICE_BYTES = 1 << 20

_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. A temporary one of our own only where the session names none and all runs on this machine (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="quarterlake-"))
    return "file://" + _own_dir[0]


def _write(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared folder and read it back, so lost executors lose nothing."""
    return _write(df, tag)[0]


class Scratch:
    """Tables of one computation in the shared folder, which go when they are no longer needed."""

    def __init__(self, spark: SparkSession, tag: str) -> None:
        self.spark, self.tag, self.paths = spark, tag, {}

    def write(self, df: DataFrame, tag: str) -> DataFrame:
        out, path = _write(df, f"{self.tag}-{tag}")
        self.paths[id(out)] = out, path
        return out

    def drop(self, df: DataFrame) -> None:
        _, path = self.paths.pop(id(df))
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def close(self) -> None:
        for df, _ in list(self.paths.values()):
            self.drop(df)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with columns that are computed once: a later filter on them stays above, where pushing it down would put their
    whole expressions into it, and into each lambda within, once more."""
    made = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select(*[c for c in df.columns if c not in columns], F.inline_outer(F.array(made)))


def crc_of_id(col: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")))


def slices(batches: Iterable[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut Arrow batches into runs of rows with about ``most`` bytes of text (null: empty); one long text is one run."""
    for batch in batches:
        texts = [x or b"" for x in batch.column(text).cast(pa.large_binary()).to_pylist()]
        at, held = 0, 0
        for i, x in enumerate(texts):
            if i > at and held + len(x) > most:
                yield batch.slice(at, i - at), texts[at:i]
                at, held = i, 0
            held += len(x)
        if at < len(texts):
            yield batch.slice(at), texts[at:]


class WordHasher:
    """62-bit hashes of all words of many texts by numpy: two polynomials over randomly mapped bytes at random points of the field of
    2**31 - 1 elements, from prefix sums. Two given words of at most m bytes collide with a chance of (m / 2**31)**2."""

    P = (1 << 31) - 1
    #: Bytes hashed at a time, or one longer word.
    BLOCK = 1 << 17

    def __init__(self, gap: bytes = SPACE, fold: bool = True) -> None:
        rng = np.random.default_rng(20240601)
        self.points = [int(x) for x in rng.integers(1 << 20, self.P - 1, 2)]
        self.byte = rng.integers(1, self.P, (2, 256), dtype=np.uint64)
        if fold:
            self.byte[:, ord("A") : ord("Z") + 1] = self.byte[:, ord("a") : ord("z") + 1]
        self.gap = np.zeros(256, bool)
        self.gap[list(gap)] = True
        self.gap[10] = True  # texts are joined by it
        self.fold = fold
        self.power: list[np.ndarray] = [np.ones(1, np.uint64)] * 2
        self.inverse: list[np.ndarray] = [np.ones(1, np.uint64)] * 2

    def __getstate__(self) -> tuple[bytes, bool]:
        return bytes(np.flatnonzero(self.gap).astype(np.uint8)), self.fold

    def __setstate__(self, state: tuple[bytes, bool]) -> None:
        self.__init__(*state)

    def _powers(self, n: int) -> None:
        if len(self.power[0]) >= n:
            return
        for of, roots in ((self.power, self.points), (self.inverse, [pow(x, -1, self.P) for x in self.points])):
            for k, root in enumerate(roots):
                x = np.ones(1, np.uint64)
                while len(x) < n:
                    x = np.concatenate([x, x * np.uint64(pow(root, len(x), self.P)) % np.uint64(self.P)])
                of[k] = x

    def words(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """The joined texts, where words begin and end in them, and the offsets where each text's words begin."""
        raw = b"\n".join(texts) + b"\n"
        gap = self.gap[np.frombuffer(raw, np.uint8)]
        edge = np.flatnonzero(np.diff(gap, prepend=True))
        begin, end = edge[0::2], edge[1::2]
        ends = np.cumsum(np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts)))
        return raw, begin, end, np.concatenate([[0], np.searchsorted(begin, ends)])

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word hashes of all texts one after the other (A-Z lower-cased), and the offsets where each text's words begin."""
        (h,), offsets = self.prefixes(texts, (None,))
        return h, offsets

    def prefixes(self, texts: list[bytes], lengths: tuple[int | None, ...]) -> tuple[list[np.ndarray], np.ndarray]:
        """The same for the first bytes of each word, for several lengths; None: the whole word."""
        raw, begin, end, offsets = self.words(texts)
        return self.hashes(raw, begin, end, lengths), offsets

    def hashes(self, raw: bytes, begin: np.ndarray, end: np.ndarray, lengths: tuple[int | None, ...] = (None,)) -> list[np.ndarray]:
        buf, p, low = np.frombuffer(raw, np.uint8), np.uint64(self.P), np.uint64(31)
        found = [np.empty(len(begin), np.uint64) for _ in lengths]
        i = 0
        while i < len(begin):
            j = max(i + 1, int(np.searchsorted(end, begin[i] + self.BLOCK, "right")))
            at, to = begin[i:j] - begin[i], end[i:j] - begin[i]
            block = buf[begin[i] : end[j - 1]]
            self._powers(len(block) + 1)
            stops = [to if n is None else np.minimum(to, at + n) for n in lengths]
            parts: list[list[np.ndarray]] = [[] for _ in lengths]
            for byte, power, inverse in zip(self.byte, self.power, self.inverse, strict=True):
                x = byte[block]
                x *= power[: len(block)]
                sums = np.zeros(len(block) + 1, np.uint64)
                np.cumsum((x & p) + (x >> low), out=sums[1:])
                back = inverse[at]
                for part, stop in zip(parts, stops, strict=True):
                    part.append((sums[stop] - sums[at]) % p * back % p)
            for out, (x, y) in zip(found, parts, strict=True):
                out[i:j] = mix64(x << low | y)
            i = j
        return found


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the place of one of each, and each key's number among them."""
    order = np.argsort(keys)
    there = keys[order]
    first = np.concatenate([[True], there[1:] != there[:-1]])[: len(keys)]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(first) - 1
    return there[first], order[first], number


class WordTable:
    """What a pure function of words gave: ``learn`` maps words to numbers (uint32, one word's after the other's) and how many each has.
    Words are known by their hashes; at most ``most`` words and 16 times as many numbers stay from slice to slice, those in use longest."""

    def __init__(self, learn: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], most: int = 1 << 20) -> None:
        self.learn, self.most, self.hasher = learn, most, WordHasher(fold=False)
        self._start(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32))

    def _start(self, keys: np.ndarray, size: np.ndarray, values: np.ndarray) -> None:
        self.keys, self.row = keys, np.arange(len(keys))  # sorted keys, and the rows of their values
        self.new_keys, self.new_row = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # the same, of late
        self.size, self.values = size, values
        self.begin = np.cumsum(size) - size
        self.used = np.zeros(len(size), bool)

    @staticmethod
    def _find(keys: np.ndarray, row: np.ndarray, asked: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.full(len(asked), -1)
        at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return np.where(keys[at] == asked, row[at], -1)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The rows of all words of all texts in order, and the offsets where each text's words begin; ``begin``, ``size`` and ``values``
        hold for these rows until the next call."""
        if len(self.size) > self.most or len(self.values) > 16 * self.most:
            self._forget()
        raw, begin, end, offsets = self.hasher.words(texts)
        asked, one, number = grouped(self.hasher.hashes(raw, begin, end)[0])
        row = self._find(self.keys, self.row, asked)
        row = np.where(row < 0, self._find(self.new_keys, self.new_row, asked), row)
        new = np.flatnonzero(row < 0)
        if len(new):
            values, size = self.learn([raw[b:e] for b, e in zip(begin[one[new]].tolist(), end[one[new]].tolist(), strict=True)])
            row[new] = len(self.size) + np.arange(len(new))
            self.begin = np.concatenate([self.begin, len(self.values) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.values = np.concatenate([self.values, values])
            self.used = np.concatenate([self.used, np.zeros(len(new), bool)])
            self.new_keys, self.new_row = self._merged(self.new_keys, self.new_row, asked[new], row[new])
            if 4 * len(self.new_keys) > len(self.keys):
                self.keys, self.row = self._merged(self.keys, self.row, self.new_keys, self.new_row)
                self.new_keys, self.new_row = self.new_keys[:0], self.new_row[:0]
        known = np.ones(len(row), bool)
        known[new] = False
        self.used[row[known]] = True
        return row[number], offsets

    @staticmethod
    def _merged(keys: np.ndarray, row: np.ndarray, more: np.ndarray, more_row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(keys, more)
        return np.insert(keys, at, more), np.insert(row, at, more_row)

    def _forget(self) -> None:
        """Words that were not asked for again go, and long ones; all if that leaves more than half."""
        keys, row = self._merged(self.keys, self.row, self.new_keys, self.new_row)
        keep = self.used[row] & (self.size[row] <= 64)
        if 2 * int(keep.sum()) > self.most:
            keep[:] = False
        keys, row = keys[keep], row[keep]
        self._start(keys, self.size[row], self.gather(row)[0])

    def gather(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of rows one after the other, and where each row's end."""
        size = self.size[row]
        ends = np.cumsum(size)
        at = np.repeat(self.begin[row] - (ends - size), size)
        at += np.arange(len(at))
        return self.values[at], ends


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer: every bit of the result depends on every bit of the argument."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x94D049BB133111EB)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


#: Odd multipliers that keep the order of the words of an n-gram.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the n-grams of one word sequence; a shorter sequence is one n-gram."""
    k = min(n, len(words))
    if k == 0:
        return words
    out = words[: len(words) - k + 1] * _PLACES[0]
    for i in range(1, k):
        out = out + words[i : len(words) - k + 1 + i] * _PLACES[i]
    return mix64(out + np.uint64(k))
