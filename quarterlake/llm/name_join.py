"""Join of names within an edit distance by anagram keys.

The multiset of a name's letters ignores transpositions. If at most d edits turn one name into another, their multisets become equal when at
most d letters are deleted from each, so every name emits a key for each such multiset, keys are joined for equality, and a bit-parallel
distance verifies the order of the letters. A key that many names of both sides share is joined by pieces as well: of 2 d + 1 pieces of the
one name, d edits leave at least one as it is, moved by d places at most.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import Scratch, materialize, mix64, slices, table

#: A key with more pairs of names than this is joined by pieces as well. That changes the work, not the result.
HOT = 4096
#: Key rows and letters that leave a Python worker at a time, about.
ROWS, LETTERS = 1 << 17, 1 << 22
#: Pairs verified at a time.
BLOCK = 1 << 14


def letters(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all names, one after the other, and the length of each."""
    size = np.fromiter(map(len, names), np.int64, len(names))
    return np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64), size


def letter_hash(codes: np.ndarray) -> np.ndarray:
    return mix64(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def multiset_keys(names: list[str], deleted: int) -> tuple[np.ndarray, np.ndarray]:
    """(name's number, key) of the multiset of each name's letters and of those with at most ``deleted`` letters less. A key is a sum of the
    letters' hashes, so two multisets with one key cost a comparison and never a result."""
    codes, size = letters(names)
    of = np.repeat(np.arange(len(names)), size)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letter_hash(codes), dtype=np.uint64)])
    ends = np.cumsum(size)
    row, key = np.arange(len(names)), sums[ends] - sums[ends - size]
    pair = np.unique(of << 21 | codes)
    own, letter = pair >> 21, letter_hash(pair & 0x1FFFFF)
    first, count = np.searchsorted(own, np.arange(len(names))), np.bincount(own, minlength=len(names))
    rows, keys = [row], [key]
    for _ in range(deleted):
        n = count[row]
        at = np.repeat(first[row] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        row, key = np.repeat(row, n), np.repeat(key, n) - letter[at]
        order = np.lexsort((key, row))
        row, key = row[order], key[order]
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])])[: len(row)]
        row, key = row[new], key[new]
        rows.append(row)
        keys.append(key)
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (key[1:] != key[:-1])])[: len(row)]
    return row[new], key[new]


def keyed(names: DataFrame, deleted: int) -> DataFrame:
    """(key, name) of distinct names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in slices(batches, "name"):
            row, key = multiset_keys([x.decode("utf-8") for x in raw], deleted)
            column = batch.column("name")
            size = np.fromiter(map(len, raw), np.int64, len(raw))[row]
            cut = np.maximum(np.arange(len(row)) // ROWS, np.cumsum(size) // LETTERS)
            for part in np.split(np.arange(len(row)), np.flatnonzero(np.diff(cut)) + 1):
                yield pa.RecordBatch.from_arrays([pa.array(key[part].astype(np.int64)), column.take(pa.array(row[part]))], ["key", "name"])

    return names.mapInArrow(run, "key long, name string")


def osa_distance(x: str, y: str) -> int:
    """Restricted edit distance (no substring is edited twice) by bits of integers of any length."""
    places: dict[str, int] = {}
    for i, c in enumerate(x):
        places[c] = places.get(c, 0) | 1 << i
    full, last = (1 << len(x)) - 1, 1 << len(x) >> 1
    up, down, diagonal, before, distance = full, 0, 0, 0, len(x)
    for c in y:
        here = places.get(c, 0)
        swapped = (~diagonal & here) << 1 & before
        diagonal = ((((here & up) + up) ^ up) | here | down | swapped) & full
        plus, minus = down | full & ~(diagonal | up), diagonal & up
        distance += bool(plus & last) - bool(minus & last)
        plus, minus = plus << 1 | 1, minus << 1
        up, down, before = full & (minus | ~(diagonal | plus)), plus & diagonal, here
    return distance if x else len(y)


def osa_distances(x: list[str], y: list[str]) -> np.ndarray:
    """The same of many pairs at once; x of at most 64 letters each, in one word of bits each."""
    n, (xs, nx), (ys, ny) = len(x), letters(x), letters(y)
    a, b = np.full((n, 64), -1), np.full((n, int(ny.max(initial=0))), -2)
    a[np.arange(64) < nx[:, None]] = xs
    b[np.arange(b.shape[1]) < ny[:, None]] = ys
    one = np.uint64(1)
    last = one << np.maximum(nx - 1, 0).astype(np.uint64)
    up, down, diagonal, before = np.full(n, ~np.uint64(0)), *np.zeros((3, n), np.uint64)
    distance = nx.copy()
    for j in range(b.shape[1]):
        here = np.packbits(a == b[:, j : j + 1], axis=1, bitorder="little").view("<u8").ravel()
        swapped = (~diagonal & here) << one & before
        diagonal = (((here & up) + up) ^ up) | here | down | swapped
        plus, minus = down | ~(diagonal | up), diagonal & up
        distance += np.where(j < ny, (plus & last > 0).astype(np.int64) - (minus & last > 0), 0)
        plus, minus = plus << one | one, minus << one
        up, down, before = minus | ~(diagonal | plus), plus & diagonal, here
    return np.where(nx > 0, distance, ny)


def edit_distance(x: str, y: str) -> int:
    """Unrestricted Damerau-Levenshtein distance: dynamic programming that remembers where each letter was last seen."""
    far, seen = len(x) + len(y), {}
    rows = [[far] * (len(y) + 2), [far, *range(len(y) + 1)]]
    for i, c in enumerate(x, 1):
        row, match = [far, i], 0
        for j, d in enumerate(y, 1):
            k, m = seen.get(d, 0), match
            swap = rows[k][m] + (i - k - 1) + 1 + (j - m - 1) if k and m else far
            if c == d:
                match = j
            row.append(min(rows[i][j] + (c != d), row[j] + 1, rows[i][j + 1] + 1, swap))
        rows.append(row)
        seen[c] = i
    return rows[-1][-1]


def distances(x: list[str], y: list[str], most: int) -> np.ndarray:
    """Exact distances up to ``most``; more than that is any larger number. Up to 2 the restricted distance is the unrestricted one."""
    out = np.full(len(x), most + 1)
    near = np.flatnonzero(np.abs(np.fromiter(map(len, x), np.int64, len(x)) - np.fromiter(map(len, y), np.int64, len(y))) <= most)
    short = near[[len(x[i]) <= 64 for i in near]]
    out[short] = osa_distances([x[i] for i in short], [y[i] for i in short])
    for i in np.setdiff1d(near, short):
        out[i] = osa_distance(x[i], y[i])
    if most > 1:
        for i in near[out[near] > 2]:
            out[i] = edit_distance(x[i], y[i])
    return out


def verified(candidates: DataFrame, most: int) -> DataFrame:
    """(left_name, right_name, distance) of the pairs within ``most``. A pair is told under one of its keys only: that of what the multisets share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                x, y, key = batch.column("left_name").to_pylist(), batch.column("right_name").to_pylist(), batch.column("key").to_numpy()
                d = distances(x, y, most)
                keep = []
                for i in np.flatnonzero(d <= most).tolist():
                    common = "".join((Counter(x[i]) & Counter(y[i])).elements())
                    if letter_hash(letters([common])[0]).sum(dtype=np.uint64).astype(np.int64) == key[i]:
                        keep.append(i)
                rows = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("left_name").take(rows), batch.column("right_name").take(rows), pa.array(d[keep], pa.int32())], ["left_name", "right_name", "distance"])

    return candidates.select("key", "left_name", "right_name").mapInArrow(run, "left_name string, right_name string, distance int")


def pieces(n: F.Column, number: int) -> list[tuple[F.Column, F.Column]]:
    """Where each of ``number`` pieces of a name of ``n`` letters begins (from 0), and its length."""
    cut = [F.floor(n * i / number) for i in range(number + 1)]
    return [(a, b - a) for a, b in zip(cut[:-1], cut[1:], strict=True)]


def by_pieces(left: DataFrame, right: DataFrame, most: int) -> DataFrame:
    """Candidates (key, left_name, right_name) that share a key, and a piece of the right name at nearly the same place. A pair meets
    once for each such piece, and is told once."""
    number, n = 2 * most + 1, F.length("name")
    of = lambda size, i, start, length: F.struct(size.cast("int").alias("size"), F.lit(i).alias("piece"), F.substring("name", (start + 1).cast("int"), length.cast("int")).alias("part"))
    own = F.array(*[of(n, i, a, b) for i, (a, b) in enumerate(pieces(n, number))])
    moved = [(size, i, a + shift, b) for size in (n + k for k in range(-most, most + 1)) for i, (a, b) in enumerate(pieces(size, number)) for shift in range(-most, most + 1)]
    theirs = F.array(*[F.when((size > 0) & (a >= 0) & (a + b <= n), of(size, i, a, b)) for size, i, a, b in moved])
    right = right.select("key", F.col("name").alias("right_name"), F.inline(own))
    left = left.select("key", F.col("name").alias("left_name"), F.explode(F.array_distinct(theirs)).alias("p")).where("p IS NOT NULL").select("key", "left_name", "p.*")
    return left.hint("merge").join(right, ["key", "size", "piece", "part"]).select("key", "left_name", "right_name").distinct()


def near_names(left: DataFrame, right: DataFrame, most: int = 1) -> DataFrame:
    """(left_name, right_name, distance) of all pairs of distinct names (column ``name``) that at most ``most`` edits turn into one another:
    unrestricted Damerau-Levenshtein distance over code points.

    Work grows with the names and the pairs that share a key. Copies of a name are one name; nothing is collected or broadcast, and
    joins by sorting let Spark split a hot key's partition.

    Defined results: null and empty names take no part; repeated rows count as one; a very long name has a key for each of its
    distinct letters and is compared by integers of its length; empty tables give no pair; other columns are ignored.
    """
    scratch = Scratch(left.sparkSession, "names")
    sides = [scratch.write(keyed(df.select("name").where("name <> ''").distinct(), most), tag) for df, tag in ((left, "left"), (right, "right"))]
    a, b = (df.groupBy("key").agg(F.count(F.lit(1)).alias(n)) for df, n in zip(sides, ("n_left", "n_right"), strict=True))
    hot = scratch.write(a.hint("merge").join(b, "key").where(F.col("n_left") * F.col("n_right") > HOT).select("key"), "hot")
    x, y = (df.withColumnRenamed("name", n) for df, n in zip(sides, ("left_name", "right_name"), strict=True))
    plain = x.hint("merge").join(y, "key").hint("merge").join(hot, "key", "left_anti")
    halves = [df.hint("merge").join(hot, "key", "left_semi") for df in sides]
    found = verified(plain, most).unionByName(verified(by_pieces(*halves, most), most))
    out = materialize(found, "near-names")
    scratch.close()
    return out


def misspelt(vendors: DataFrame) -> DataFrame:
    """(vendor_id, name) with two neighbouring letters of some names exchanged, as a hash of the id says."""
    h, n = F.crc32(F.col("vendor_id").cast("string")), F.length("name")
    i = (F.pmod(h, F.greatest(n - 1, F.lit(1)))).cast("int")
    other = F.concat(F.expr("substring(name, 1, i)"), F.expr("substring(name, i + 2, 1)"), F.expr("substring(name, i + 1, 1)"), F.expr("substring(name, i + 3)"))
    name = F.when((F.col("h") % 2 == 0) & (n >= 2), other).otherwise(F.col("name"))
    return vendors.select("vendor_id", "name", h.alias("h"), i.alias("i")).select("vendor_id", name.alias("name"))


def clients_of_vendors(clients: DataFrame, vendors: DataFrame, most: int = 1) -> DataFrame:
    """(vendor_id, distance, n_clients, first_client_id, clients_crc) of each vendor and exact distance with a client.

    Each row of clients counts (a null id counts and adds nothing else); a vendor's rows of one name count as one, and a client that two
    names of one vendor find at one distance counts twice.
    """
    names = clients.where("name <> ''").groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("client_id").alias("first"), F.sum(F.crc32(F.col("client_id").cast("string"))).alias("crc"))
    vendors = vendors.where("name <> ''").select("vendor_id", "name").distinct()
    pairs = near_names(clients, vendors, most).withColumnsRenamed({"left_name": "name", "right_name": "vendor"})
    sums = [F.sum("n").alias("n"), F.min("first").alias("first"), F.sum("crc").alias("crc")]
    found = pairs.hint("merge").join(names, "name").groupBy("vendor", "distance").agg(*sums)
    each = vendors.withColumnRenamed("name", "vendor").hint("merge").join(found, "vendor").groupBy("vendor_id", "distance").agg(*sums)
    return each.select("vendor_id", "distance", F.col("n").alias("n_clients"), F.col("first").alias("first_client_id"), F.coalesce("crc", F.lit(0)).alias("clients_crc"))


def op11_name_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clients_of_vendors(table(spark, sf_dir, "clients"), misspelt(table(spark, sf_dir, "vendors")))


#: crc32 of decimal numbers, byte by byte from a table that bits make.
_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda c: ord(c)::BIGINT)), lambda crc, b: xor(crc >> 8, t[(xor(crc, b) & 255) + 1])), 4294967295::BIGINT)"
OP11_SQL = f"""
WITH crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY b) AS t FROM range(256) AS r(b)),
hashed AS (SELECT DISTINCT vendor_id, name, length(name) AS n, {_CRC.format("vendor_id")} AS h FROM vendors, crc_table WHERE name <> ''),
wrong AS (
  SELECT DISTINCT vendor_id, CASE WHEN h % 2 = 0 AND n >= 2
    THEN left(name, i) || substr(name, i + 2, 1) || substr(name, i + 1, 1) || substr(name, i + 3) ELSE name END AS v
  FROM (SELECT *, h % greatest(n - 1, 1) AS i FROM hashed)),
named AS (SELECT name AS c, count(*) AS n, min(client_id) AS first, sum({_CRC.format("client_id")}) AS crc FROM clients, crc_table WHERE name <> '' GROUP BY 1),
near AS (
  SELECT *, len(list_filter(range(1, least(length(c), length(v)) + 1), lambda i: left(c, i) = left(v, i))) AS p
  FROM named JOIN wrong ON abs(length(c) - length(v)) <= 1),
pairs AS (
  SELECT *, CASE WHEN c = v THEN 0
    WHEN substr(c, p + 2) = substr(v, p + 2) OR substr(c, p + 2) = substr(v, p + 1) OR substr(c, p + 1) = substr(v, p + 2) THEN 1
    WHEN substr(c, p + 1, 1) = substr(v, p + 2, 1) AND substr(c, p + 2, 1) = substr(v, p + 1, 1) AND substr(c, p + 3) = substr(v, p + 3) THEN 1 END AS d
  FROM near)
SELECT vendor_id, d::INTEGER AS distance, sum(n)::BIGINT AS n_clients, min(first) AS first_client_id, sum(crc)::BIGINT AS clients_crc
FROM pairs WHERE d IS NOT NULL GROUP BY 1, 2
"""
