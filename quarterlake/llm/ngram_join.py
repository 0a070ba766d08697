"""N-gram Jaccard self-join by T-occurrence search over inverted lists (DivideSkip), and its connected components.

Two sets with Jaccard similarity >= 3/4 share T = ceil(3 (|x| + |y|) / 7) shingles or more. One global order puts long lists last. A document's
L = T - SHARED last lists are its long ones: it does not post them. The others, its short lists, are merged: whoever occurs in fewer than
T - L of them cannot reach T. The long lists of those that do are probed: what is left of the one set is looked up in the other, sorted
one by binary search, and the whole overlap decides. An exact bound from parity bitmaps comes in between where lists are long.

Merging is by sorted runs in numpy, one shard of lists at a time; shards are as many as the postings fill.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import Scratch, WordHasher, materialize, mix64, ngram_hashes, slices, table
from quarterlake.llm.lm_scoring import merged

N = 5
#: T - L: in so many short lists two documents must meet (all, if a set has fewer shingles).
SHARED = 3
#: Share of distinct sets (by hash) whose lists tell which shingles are frequent. That only orders the lists; any order gives the same links.
RATE = 16
#: A list is long if it is seen so often in that share; at most LONG lists count as long, the longest.
SEEN, LONG = 2, 1 << 18
#: Postings that a shard of lists holds, about, and members of a list that are sorted in one shard: a longer list is dealt over several.
SHARD, PART = 1 << 19, 50_000
#: Sets that more than one row in HOT has are sent to the rows rather than met by a shuffle; there are fewer than HOT of them.
HOT = 1000
FLUSH = 1_000_000
#: Each document gathers with the leaders of so many of its short lists (those of least hash).
GATHER = 6
#: Lists of more members than this are held against the bitmap bound where they meet, dealt in parts of BLOCK members.
SHORT, BLOCK = 32, 2_000
#: So many partners of one document meet it in one place.
SALT = 200
#: Bits of the filter of ids whose texts are needed: 8 an id, at most 16 MiB.
MOST_BITS = 1 << 27

_hashers: list[WordHasher] = []


def shingle_sets(texts: list[bytes], n: int = N) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text; fewer words: the whole sequence as one; no words: none."""
    if not _hashers:
        _hashers.append(WordHasher())
    words, at = _hashers[0](texts)
    return [np.unique(ngram_hashes(words[a:b], n)) for a, b in zip(at[:-1], at[1:], strict=True)]


def shared_of(n: int) -> int:
    """T - L of a pair whose smaller set has n shingles."""
    return min(SHARED, n)


def short_length(n: int) -> int:
    """Short lists of a document: all but its L long ones, for the smallest partner that can reach 3/4 (T = 3 n / 4)."""
    return n - -(-3 * n // 4) + shared_of(n)


def smaller_length(n):
    """The same where the document is the smaller of the pair (T = 6 n / 7)."""
    return n - -(-6 * n // 7) + np.minimum(SHARED, n)


def parity_bitmap(shingles: np.ndarray) -> bytes:
    """Parity of the number of shingles in each of 2**k >= 2 n buckets. popcount(x ^ y) is at most the symmetric difference."""
    size = max(64, 1 << int(2 * len(shingles) - 1).bit_length()) if len(shingles) else 64
    counts = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def overlap_bound(x: bytes, y: bytes, total: int) -> int:
    """An upper bound of the overlap of two sets of ``total`` shingles together."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return (total - int(np.bitwise_count(a ^ b).sum())) // 2


def probed_overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Shingles of the smaller set found in the other by binary search."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    return int((y[at] == x).sum())


def long_lists(signed: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles (48 bits) with long lists in order, and their estimated lengths, LONG at most. Each distinct set of the sample counts
    once, as only one document of a set posts."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def chunks() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = np.searchsorted(keys, np.arange(1, 64, dtype=np.uint64) << np.uint64(42))
            rows = [(i, packed(k << np.uint64(16)), c.astype("<u4").tobytes()) for i, (k, c) in enumerate(zip(np.split(keys, cuts), np.split(counts, cuts), strict=True)) if len(k)]
            return _batch(rows, (pa.int32(), pa.binary(), pa.binary()), ["shard", "keys", "vals"])

        for batch in batches:
            for raw in batch.column("sample").to_pylist():
                held.append(unpacked(raw))
                if sum(map(len, held)) > FLUSH:
                    yield chunks()
                    held = []
        if held:
            yield chunks()

    def frequent(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, counts = merged(unpacked(b"".join(pdf["keys"])), np.frombuffer(b"".join(pdf["vals"]), "<u4").astype(np.int64))
        keep = counts >= SEEN
        return pd.DataFrame({"key": keys[keep].astype(np.int64), "seen": counts[keep]})

    once = signed.where("sample IS NOT NULL").groupBy("sig").agg(F.first("sample").alias("sample")).select("sample")
    found = once.mapInArrow(gather, "shard int, keys binary, vals binary").groupBy("shard").applyInPandas(frequent, "key long, seen long")
    rows = found.orderBy(F.desc("seen"), "key").limit(LONG).toPandas()
    keys = rows["key"].to_numpy(np.int64).astype(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows["seen"].to_numpy(np.int64)[order] * RATE


def _batch(rows: list[tuple], types: tuple, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def packed(keys: np.ndarray) -> bytes:
    """The top 48 bits of hashes."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def signature(shingles: np.ndarray) -> bytes | None:
    return np.array([shingles.sum(), mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum()], np.uint64).tobytes() if len(shingles) else None


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n, sig, sample): size of each set, a 128-bit signature of it, and for one set in RATE its shingles (48 bits), once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[bytes] = set()
        for batch, texts in slices(batches):
            sets = shingle_sets(texts)
            sigs = list(map(signature, sets))
            samples: list[bytes | None] = []
            for s, sig in zip(sets, sigs, strict=True):
                new = sig is not None and int.from_bytes(sig[:8], "little") % RATE == 0 and sig not in told
                samples.append(packed(s) if new else None)
                if new:
                    told.add(sig)
            columns = [batch.column("doc_id"), pa.array(list(map(len, sets)), pa.int64()), pa.array(sigs, pa.binary()), pa.array(samples, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "sig", "sample"])

    return docs.mapInArrow(run, "doc_id long, n long, sig binary, sample binary")


def short_lists(shingles: np.ndarray, long: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The shingles that a document posts, short lists first."""
    s = shingles
    if len(s) and len(long):
        key = s >> np.uint64(16)
        at = np.minimum(np.searchsorted(long, key), len(long) - 1)
        is_long = long[at] == key
        if is_long.any():
            s = np.concatenate([s[~is_long], s[is_long][np.argsort(rank[at[is_long]])]])
    return s[: short_length(len(s))]


def classes(docs: DataFrame, long: np.ndarray, length: np.ndarray) -> DataFrame:
    """(doc_id, n, bitmap, posts) of one document of each distinct set, the least id. Copies are combined before the shuffle."""
    rank = np.empty(len(long), np.int64)
    rank[np.lexsort((long, length))] = np.arange(len(long))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            rows = [(signature(s), i, len(s), parity_bitmap(s), packed(short_lists(s, long, rank))) for i, s in zip(ids, shingle_sets(texts), strict=True) if len(s) and i is not None]
            if rows:
                yield _batch(rows, (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()), ["sig", "doc_id", "n", "bitmap", "posts"])

    each = docs.mapInArrow(run, "sig binary, doc_id long, n long, bitmap binary, posts binary")
    return each.groupBy("sig").agg(F.min(F.struct("doc_id", "n", "bitmap", "posts")).alias("c")).select("c.*")


def met(reps: DataFrame, long: np.ndarray, length: np.ndarray, bits: int) -> DataFrame:
    """What the merged lists tell: the lists of two or more members (list, a = document, n << 1 | small, b = null), where small tells that
    the document may be the smaller of a pair that meets here; and in how many lists (n) a document ``a`` meets the leader ``b``, the smallest
    member that can reach 3/4 with it. A list of more than PART members is dealt over several shards: there a member alone stays, as
    others are elsewhere, and leaders are those of a shard."""
    split = length > PART
    keys48, parts48 = long[split], -(-length[split] // PART)
    room = min(1 << 20, max(1 << 16, 256 << bits))  # postings dealt at a time: a few hundred a shard

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = batch.column("doc_id").to_numpy(), batch.column("n").to_numpy()
            raw = batch.column("posts").to_pylist()
            if not raw:
                continue
            ends = np.cumsum([len(x) // 6 for x in raw])
            starts = np.unique(np.searchsorted(ends, np.arange(0, int(ends[-1]), room), "right"))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(raw)], strict=True):
                count = np.array([len(x) // 6 for x in raw[a:b]])
                keys = unpacked(b"".join(raw[a:b]))
                doc, n = np.repeat(ids[a:b], count), np.repeat(sizes[a:b], count)
                start = np.repeat(np.cumsum(count) - count, count)
                small = np.arange(len(keys)) - start < smaller_length(n)
                by_hash = np.lexsort((mix64(keys), start))
                flag = np.zeros(len(keys), bool)
                flag[by_hash] = np.arange(len(keys)) - start < GATHER
                shard, dealt = keys >> np.uint64(48 - bits), np.zeros(len(keys), bool)
                if len(keys48):
                    at = np.minimum(np.searchsorted(keys48, keys), len(keys48) - 1)
                    dealt = keys48[at] == keys
                    part = mix64(doc.astype(np.uint64)) % parts48[at].astype(np.uint64)
                    shard = np.where(dealt, mix64(keys * np.uint64(0x9E3779B97F4A7C15) + part) >> np.uint64(64 - bits), shard)
                order = np.argsort(shard, kind="stable")
                rows = []
                for i in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(order) else []:
                    step = np.diff(doc[i], prepend=doc[i[0]])
                    step = step.astype("<i4") if len(i) == 1 or np.abs(step).max() < 1 << 31 else step.astype("<i8")
                    sizes_ = (n[i] << 3 | dealt[i] << 2 | flag[i] << 1 | small[i]).astype("<u4").tobytes()
                    rows.append((int(shard[i[0]]), int(doc[i[0]]), step.tobytes(), (keys[i] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), (keys[i] >> np.uint64(32)).astype("<u2").tobytes(), sizes_))
                if rows:
                    yield _batch(rows, (pa.int32(), pa.int64(), *[pa.binary()] * 4), ["shard", "first", "steps", "low", "high", "sizes"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        docs = []
        for first, steps, low in zip(pdf["first"], pdf["steps"], pdf["low"], strict=True):
            docs.append(first + np.cumsum(np.frombuffer(steps, "<i4" if len(steps) == len(low) else "<i8").astype(np.int64)))
        doc = np.concatenate(docs)
        key = np.frombuffer(b"".join(pdf["high"]), "<u2").astype(np.int64) << 32 | np.frombuffer(b"".join(pdf["low"]), "<u4")
        size = np.frombuffer(b"".join(pdf["sizes"]), "<u4").astype(np.int64)
        order = np.argsort(key, kind="stable")
        k = key[order]
        same = k[1:] == k[:-1]
        order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same]) | (size[order] & 4 > 0)]
        key, doc, size = key[order], doc[order], size[order]
        own = pd.DataFrame({"list": key, "a": doc, "b": pd.array([pd.NA] * len(key), "Int64"), "n": size >> 3 << 1 | size & 1})
        gathering = size & 2 > 0
        a, b = leaders(key[gathering], doc[gathering], size[gathering] >> 3)
        if not len(a):
            return own
        pairs, times = np.unique(np.stack([a, b], 1), axis=0, return_counts=True)
        return pd.concat([own, pd.DataFrame({"list": np.zeros(len(pairs), np.int64), "a": pairs[:, 0], "b": pd.array(pairs[:, 1], "Int64"), "n": times})])

    chunks = reps.select("doc_id", "n", "posts").mapInArrow(post, "shard int, first long, steps binary, low binary, high binary, sizes binary")
    return chunks.groupBy("shard").applyInPandas(merge, "list long, a long, b long, n long")


def leaders(key: np.ndarray, doc: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each member of a list with the list's smallest one that can reach 3/4 with it."""
    order = np.lexsort((doc, n, key))
    k, d, m = key[order], doc[order], n[order]
    code = np.cumsum(np.concatenate([[0], k[1:] != k[:-1]])).astype(np.int64) << 32 if len(k) else k
    lead = np.searchsorted(code + m, code + -(-3 * m // 4))
    other = d[lead] != d
    return d[other], d[lead][other]


def forest(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The edges (x, y) of a forest that connects what they all connect, light ones first: each component takes its lightest edge, and
    components so joined go on."""
    _, number = np.unique(np.concatenate([x, y]), return_inverse=True)
    live = np.argsort(weight, kind="stable")
    x, y = number[: len(x)], number[len(x) :]
    mark = np.arange(number.max(initial=-1) + 1)
    chosen = [np.zeros(0, np.int64)]
    while True:
        live = live[mark[x[live]] != mark[y[live]]]
        if not len(live):
            return np.unique(np.concatenate(chosen))
        best = np.full(len(mark), len(live))
        np.minimum.at(best, mark[x[live]], np.arange(len(live)))
        np.minimum.at(best, mark[y[live]], np.arange(len(live)))
        edges = live[np.unique(best[best < len(live)])]
        chosen.append(edges)
        u, v = mark[x[edges]], mark[y[edges]]
        up = np.arange(len(mark))
        while True:
            low = np.minimum(up[u], up[v])
            if (low == up[u]).all() and (low == up[v]).all():
                break
            np.minimum.at(up, u, low)
            np.minimum.at(up, v, low)
            up = up[up]
        mark = up[mark]


def cross_pairs(key: np.ndarray, doc: np.ndarray, n: np.ndarray, label: np.ndarray, small: np.ndarray, once: np.ndarray, bitmap: list[bytes] | None, few: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of a list's members of different components whose sizes can reach 3/4, whose smaller member posts for that, and
    whose bitmaps, if given, allow it; with the number of lists. Of members with ``once`` those pairs are left out that both have it. With
    ``few`` only a forest of the pairs that look most alike."""
    order = np.lexsort((doc, n, key))
    key, label, small, size, once = key[order], label[order], small[order], n[order], once[order]
    if not len(order):
        return doc[:0], doc[:0], doc[:0]
    ids, at, node = np.unique(doc[order], return_index=True, return_inverse=True)
    code = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])).astype(np.int64) << 32
    i = np.flatnonzero(small)
    count = np.searchsorted(code + size, code[i] + 4 * size[i] // 3, "right") - i - 1
    reach = np.cumsum(count)
    found, done = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0
    while done < len(i):
        to = max(done + 1, int(np.searchsorted(reach, (reach[done - 1] if done else 0) + FLUSH, "right")))
        part, c = i[done:to], count[done:to]
        a = np.repeat(part, c)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(c) - c, c)
        keep = (label[a] != label[b]) & ~(once[a] & once[b])
        a, b = node[a[keep]], node[b[keep]]
        found.append(np.unique(np.minimum(a, b) << 32 | np.maximum(a, b), return_counts=True))
        if sum(len(x) for x, _ in found) > 4 * FLUSH:
            found = [_summed(found)]
        done = to
    pairs, times = _summed(found)
    a, b = pairs >> 32, pairs & 0xFFFFFFFF
    if bitmap is not None:
        apart = _apart(a, b, [bitmap[j] for j in order[at]])
        total = size[at][a] + size[at][b]
        keep = np.flatnonzero(7 * ((total - apart) // 2) >= 3 * total)
        if few:
            keep = keep[forest(label[at][a[keep]], label[at][b[keep]], apart[keep] / total[keep])]
        a, b, times = a[keep], b[keep], times[keep]
    return ids[a], ids[b], times


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return merged(np.concatenate([x for x, _ in found]), np.concatenate([c for _, c in found]))


def _apart(a: np.ndarray, b: np.ndarray, bitmaps: list[bytes]) -> np.ndarray:
    """A lower bound of the symmetric difference, of many pairs at once, by the lengths of their bitmaps."""
    length = np.array(list(map(len, bitmaps)))
    row = np.zeros(len(bitmaps), np.int64)
    folded: dict[tuple[int, int], np.ndarray] = {}
    for w in np.unique(length):
        of = np.flatnonzero(length == w)
        row[of] = np.arange(len(of))
        x = np.frombuffer(b"".join(bitmaps[j] for j in of), np.uint8).reshape(len(of), w)
        v = int(w)
        while True:
            folded[int(w), v] = x
            if v <= 8:
                break
            x, v = x[:, : v // 2] ^ x[:, v // 2 :], v // 2
    out = np.zeros(len(a), np.int64)
    for w, v in np.unique(np.stack([length[a], length[b]], 1), axis=0) if len(a) else []:
        where = np.flatnonzero((length[a] == w) & (length[b] == v))
        x, y = folded[int(w), int(min(w, v))], folded[int(v), int(min(w, v))]
        for s in range(0, len(where), 200_000):
            j = where[s : s + 200_000]
            out[j] = np.bitwise_count(x[row[a[j]]] ^ y[row[b[j]]]).sum(1, dtype=np.int64)
    return out


def candidates(lists: DataFrame, few: bool = False) -> DataFrame:
    """(a, b, times, need) of (list, place, doc_id, n, label, small, once, perhaps bitmap): pairs that meet, in how many lists of one
    partition, and in how many altogether they must. Lists are dealt by (list, place) and follow one another."""
    with_bitmaps = "bitmap" in lists.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(end: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            t = pa.Table.from_batches(held).combine_chunks()
            key, place = t.column("list").to_numpy(), t.column("place").to_numpy()
            cut = len(key) if end else int(np.flatnonzero((key == key[-1]) & (place == place[-1]))[0])
            held = t.slice(cut).to_batches()
            if not cut:
                return
            t = t.slice(0, cut)
            flags = [np.asarray(t.column(c).to_pylist(), bool) for c in ("small", "once")]
            code = np.cumsum(np.concatenate([[0], (key[1:cut] != key[: cut - 1]) | (place[1:cut] != place[: cut - 1])]))
            doc, n = t.column("doc_id").to_numpy(), t.column("n").to_numpy()
            a, b, times = cross_pairs(code, doc, n, t.column("label").to_numpy(), *flags, t.column("bitmap").to_pylist() if with_bitmaps else None, few)
            ids, at = np.unique(doc, return_index=True)
            need = np.minimum(SHARED, np.minimum(n[at[np.searchsorted(ids, a)]], n[at[np.searchsorted(ids, b)]])) if len(a) else a
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (a, b, times, need)], ["a", "b", "times", "need"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(x.num_rows for x in held) >= FLUSH // 4 or with_bitmaps and sum(x.nbytes for x in held) > 32 << 20:
                    yield from out(False)
        if held:
            yield from out(True)

    dealt = lists.repartition("list", "place").sortWithinPartitions("list", "place")
    return dealt.select("list", "place", "doc_id", "n", "label", "small", "once", *["bitmap"] * with_bitmaps).mapInArrow(run, "a long, b long, times long, need long")


def wanted_bits(ids: DataFrame, scratch: Scratch) -> tuple[int, Callable[[np.ndarray], np.ndarray]]:
    """A one-hash filter of ids (column doc_id): its number of bits, and a test of ``pmod(xxhash64(doc_id), bits)``. At most 16 MiB: with
    more ids it lets more through, which costs time and never a result."""
    n = ids.count()
    size = min(MOST_BITS, max(1 << 15, 1 << (8 * n).bit_length()))
    at = F.pmod(F.xxhash64("doc_id"), F.lit(size))
    maps = ids.select(at.alias("p")).groupBy((F.col("p") / 32768).cast("int").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("p") + 1)).alias("m"))
    raw = np.zeros(size // 8, np.uint8)
    for r in maps.collect():
        raw[r["k"] * 4096 : r["k"] * 4096 + len(r["m"])] = np.frombuffer(r["m"], np.uint8)
    sent = ids.sparkSession.sparkContext.broadcast(raw)
    return size, lambda p: sent.value[p >> 3] >> (p & 7).astype(np.uint8) & 1 > 0


def nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()


def links(pairs: DataFrame, docs: DataFrame, reps: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) that reach 3/4: first by the bitmap bound, then by probing whole sets. A pair meets at ``b``: its set is made once for SALT partners; the text of
    ``a`` goes there. Texts of other documents are left where they are."""
    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            total = x.column("n_a").to_numpy() + x.column("n_b").to_numpy()
            keep = [7 * overlap_bound(p, q, t) >= 3 * t for p, q, t in zip(x.column("bitmap_a").to_pylist(), x.column("bitmap_b").to_pylist(), total.tolist(), strict=True)]
            yield x.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = scratch.write(pairs.where("a <> b").select("a", "b"), "asked")
    known = scratch.write(reps.select("doc_id", "n", "bitmap").join(nodes(pairs), "doc_id", "left_semi"), "bitmaps")
    sides = pairs.join(known.toDF("a", "n_a", "bitmap_a"), "a").join(known.toDF("b", "n_b", "bitmap_b"), "b")
    pairs = scratch.write(sides.mapInArrow(bound, "a long, b long").distinct(), "pairs")
    ids = scratch.write(nodes(pairs), "ids")
    size, wanted = wanted_bits(ids, scratch)
    hubs = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("deg")).select("b", F.ceil(F.col("deg") / SALT).cast("int").alias("salts"))
    members = pairs.join(hubs.where("salts > 1"), "b", "left").select(F.col("a").alias("doc_id"), F.col("b").alias("home"), F.pmod(F.xxhash64("a"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"), F.lit(1).alias("guest"))
    homes = hubs.select(F.col("b").alias("doc_id"), F.col("b").alias("home"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("guest"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bytes]] = set()  # rows that repeat an id and its text go once from here
        for batch in batches:
            batch = batch.filter(pa.array(wanted(batch.column("p").to_numpy()), pa.bool_())).select(["doc_id", "text"])
            rows = [(i, hashlib.md5((t or "").encode("utf-8", "surrogatepass")).digest()) for i, t in zip(*batch.to_pydict().values(), strict=True)]
            new = [x not in seen and not seen.add(x) for x in rows]
            yield batch.filter(pa.array(new, pa.bool_()))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, hosts = None, []
        for batch, texts in slices(batches):
            found = []
            columns = [batch.column(c).to_pylist() for c in ("home", "salt", "guest", "doc_id")]
            for home, salt, guest, doc, s in zip(*columns, shingle_sets(texts), strict=True):
                if (home, salt) != place:
                    place, hosts = (home, salt), []
                if not guest:
                    if not any(np.array_equal(s, h) for h in hosts):
                        hosts.append(s)
                elif any(7 * probed_overlap(s, h) >= 3 * (len(s) + len(h)) for h in hosts if len(s) and len(h)):
                    found.append((doc, home))
            if found:
                yield _batch(found, (pa.int64(), pa.int64()), ["a", "b"])

    p = F.pmod(F.xxhash64("doc_id"), F.lit(size))
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", "text", p.alias("p")).mapInArrow(pick, "doc_id long, text string")
    both = texts.join(members.unionByName(homes), "doc_id")
    dealt = both.repartition("home", "salt").sortWithinPartitions("home", "salt", "guest").select("home", "salt", "guest", "doc_id", "text")
    return scratch.write(dealt.mapInArrow(probe, "a long, b long").distinct(), "links")


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, label) of every node of the edges (a, b): the smallest node that it is connected with. Large-star and small-star
    steps in turn; each is an aggregation that combines before the shuffle, and a join."""
    now = scratch.write(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        last, now = now, scratch.write(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
        scratch.drop(last)
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == mark:
            return scratch.write(now.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("doc_id"), F.col("v").alias("label")), "labels")
        mark = (state["n"], state["h"])


def labelled(df: DataFrame, found: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with the component of the document in ``column``; one without links is its own."""
    return df.join(found.select(F.col("doc_id").alias(column), F.col("label").alias(out)), column, "left").withColumn(out, F.coalesce(out, column))


def dealt_lists(lists: DataFrame, found: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of the lists that have several components. A long list is dealt in parts: members of its largest component are in one
    part each, the others in all."""
    marked = scratch.write(labelled(lists, found, "doc_id", "label"), "marked")
    each = marked.groupBy("list", "label").agg(F.count(F.lit(1)).alias("c"))
    mixed = each.groupBy("list").agg(F.count(F.lit(1)).alias("labels"), F.sum("c").alias("members"), F.max(F.struct("c", "label"))["label"].alias("top")).where("labels > 1")
    rows = marked.join(scratch.write(mixed.select("list", "members", "top"), "mixed"), "list")
    parts = F.greatest(F.lit(1), F.ceil(F.col("members") / BLOCK)).cast("int")
    own = F.array(F.pmod(F.xxhash64("doc_id"), parts).cast("int"))
    place = F.explode(F.when((F.col("label") == F.col("top")) | (parts == 1), own).otherwise(F.sequence(F.lit(0), parts - 1)))
    return rows.withColumn("place", place).withColumn("once", (F.col("place") > 0) & (F.col("label") != F.col("top")))


def crossing_links(lists: DataFrame, found: DataFrame, docs: DataFrame, reps: DataFrame, scratch: Scratch) -> DataFrame:
    """Edges that connect all components that have a link between them. Pairs of short lists are counted as they are; long lists first
    give a forest of the pairs that look most alike, then all pairs that are still in different components."""
    bitmaps = reps.select("doc_id", "bitmap")
    rows = dealt_lists(lists, found, scratch)
    short = scratch.write(candidates(rows.where(F.col("members") <= SHORT)).groupBy("a", "b").agg(F.sum("times").alias("times"), F.max("need").alias("need")), "short")
    long = scratch.write(rows.where(F.col("members") > SHORT).select("list", "doc_id", "n", "small", "label", "place", "once"), "long")
    tree = candidates(long.join(bitmaps, "doc_id"), few=True).select("a", "b")
    asked = scratch.write(short.where("times >= need").select("a", "b").unionByName(tree).distinct(), "first")
    edges = links(asked, docs, reps, scratch).unionByName(found.select(F.col("doc_id").alias("a"), F.col("label").alias("b")))
    found = components(edges, scratch)
    rows = dealt_lists(long.select("list", "doc_id", "n", "small").distinct(), found, scratch)
    every = candidates(rows.join(bitmaps, "doc_id")).unionByName(short).groupBy("a", "b").agg(F.sum("times").alias("times"), F.max("need").alias("need")).where("times >= need")
    apart = labelled(labelled(every.select("a", "b"), found, "a", "la"), found, "b", "lb").where("la <> lb").select("a", "b")
    more = links(apart.join(asked, ["a", "b"], "left_anti"), docs, reps, scratch)
    return more.unionByName(found.select(F.col("doc_id").alias("a"), F.col("label").alias("b")))


def class_members(signed: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The sets with more than one row in HOT (sig, rep), and (doc_id, n_shingles, rep, hot) of all rows: rep is the least id with the same
    set. Rows of hot sets, and rows without shingles, meet nothing by a shuffle."""
    each = signed.where("n > 0 AND doc_id IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("c"))
    each = scratch.write(each, "classes")
    total = each.agg(F.sum("c")).first()[0] or 0
    hot = scratch.write(each.where(F.col("c") * HOT > total).select("sig", "rep"), "hot")
    marked = signed.select("doc_id", F.col("n").alias("n_shingles"), "sig").join(F.broadcast(hot), "sig", "left")
    columns = ["doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep")]
    near = marked.where("rep IS NOT NULL OR sig IS NULL").select(*columns, F.col("rep").isNotNull().alias("hot"))
    far = marked.where("rep IS NULL AND sig IS NOT NULL").drop("rep").join(each.select("sig", "rep"), "sig", "left").select(*columns, F.lit(False).alias("hot"))
    return hot, scratch.write(near.unionByName(far), "members")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: the smallest id that a document reaches over links of Jaccard >= 3/4 of
    5-word shingle sets (64-bit hashes).

    Documents of one set are one class, so that copies cost a row each. Links are found in three steps: each document with a leader of
    its lists; then pairs of short lists that meet in T - L lists, and a forest of those in long lists, which gathers groups of near copies; then
    all pairs that meet in T - L lists and are still in different components, so no link between components is lost. A group of
    copies never becomes all its pairs.

    Defined results: null or empty texts = no shingles, own component; a null id gives a null component and links nothing; repeated
    rows are in one component, and rows of one id with different texts are one node; an empty table gives an empty table; other
    columns are ignored.
    """
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scratch = Scratch(docs.sparkSession, "join")
    signed = scratch.write(signatures(docs), "signed")
    volume = signed.agg(F.sum(F.col("n") / 4 + SHARED + 1)).first()[0] or 0
    bits = min(24, max(4, int(volume / SHARD).bit_length()))
    hot, members = class_members(signed, scratch)
    long, length = long_lists(signed)
    reps = scratch.write(classes(docs, long, length), "reps")
    merged_lists = scratch.write(met(reps, long, length, bits), "met")
    led = merged_lists.where("b IS NOT NULL").groupBy("a", "b").agg(F.sum("n").alias("n")).groupBy("a").agg(F.max(F.struct("n", "b"))["b"].alias("b"))
    found = components(links(led, docs, reps, scratch), scratch)
    lists = merged_lists.where("b IS NULL").select("list", F.col("a").alias("doc_id"), F.shiftright("n", 1).alias("n"), (F.col("n") % 2 == 1).alias("small"))
    more = crossing_links(lists, found, docs, reps, scratch)
    several = members.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x <> y").select("doc_id")
    same_id = members.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    labels = components(more.unionByName(same_id), scratch).withColumnRenamed("doc_id", "rep")
    hot_labels = scratch.write(hot.select("rep").join(labels, "rep"), "hot-labels")
    each = members.where("hot").join(F.broadcast(hot_labels), "rep", "left").unionByName(members.where("NOT hot").join(labels, "rep", "left"))
    out = each.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "rep")).alias("component_id"))
    out = materialize(out, "join")
    scratch.close()
    return out


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


OP1_SQL = """
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(words[i : i + 4], ' ')) AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM docs WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * o >= 75 * (p.n + q.n - o)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c, d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY 1) USING (doc_id)
"""
