"""Language-model scoring with a log-frequency Bloom filter of quantised n-gram counts."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import WordHasher, crc_of_id, materialize, mix64, slices, table

#: Bits of the filter for each stored (n-gram, level); a level is PROBES bits in each of two words of 64: about 0.5 % false answers.
BITS, PROBES = 12, 4
#: A filter of at most so many bytes is broadcast. A larger one stays in its shards, and the workers' n-grams meet it there by a
#: shuffle: the same bits an entry and the same scores at every size.
MAX_FILTER = 128 << 20
#: Bigrams are stored from this count on, words from 1: every pair seen is known.
LEAST_BIGRAM = 1
#: Weight of the pair's relative frequency against the word's (Jelinek-Mercer smoothing).
PAIR_SHARE = 0.2
#: Exact counts of at most so many words, the most frequent, are broadcast for the base score; rarer words meet theirs by a shuffle.
HEAD = 1 << 18
#: A worker passes its counts on when it has gathered so many n-grams.
GATHER = 2_000_000
END = np.uint64(0x8F1BBCDCBFA53E0B)
START = np.uint64(0xCA62C1D65BE0CD19)

_hashers: list[WordHasher] = []


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's tokens (words in lower-case A-Z, then the end) and the number of each text's first token."""
    if not _hashers:
        _hashers.append(WordHasher())
    words, offsets = _hashers[0](texts)
    n = np.diff(offsets)
    starts = np.concatenate([[0], np.cumsum(n + 1)])
    out = np.full(starts[-1], END, np.uint64)
    keep = np.ones(starts[-1], bool)
    keep[starts[1:] - 1] = False
    out[keep] = words
    return out, starts


def bigram_hashes(tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(contexts, hashes of context and token); the first token of a text has the start as its context."""
    before = np.concatenate([[START], tokens[:-1]]) if len(tokens) else tokens
    before = before.copy()
    before[starts[:-1]] = START
    return before, mix64(before * np.uint64(0x9E3779B97F4A7C15) + tokens * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(2))


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _chunks(kind: int, keys: np.ndarray, values: np.ndarray, bits: int, form: str) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Sorted keys cut by their top bits."""
    cuts = np.searchsorted(keys, (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)))
    for shard, (k, v) in enumerate(zip(np.split(keys, cuts), np.split(values, cuts), strict=True)):
        if len(k):
            yield kind, shard, k.tobytes(), v.astype(form).tobytes()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds, shards, keys, values = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(shards, pa.int32()), pa.array(keys, pa.binary()), pa.array(values, pa.binary())], ["kind", "shard", "keys", "vals"])


def count_ngrams(docs: DataFrame, bits: int) -> DataFrame:
    """Exact counts of words (kind 1) and word pairs (kind 2) over all rows, sharded by the top ``bits`` bits of their hashes:
    (kind, shard, keys, vals, segment), where keys are sorted uint64 and vals uint64 counts, kept for words only, and segment is the
    shard's part of the filter. Workers add counts up before the shuffle."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {1: [], 2: []}
        size = 0
        for _, texts in slices(batches):
            tokens, starts = token_hashes(texts)
            for kind, grams in ((1, tokens), (2, bigram_hashes(tokens, starts)[1])):
                k, n = np.unique(grams, return_counts=True)
                held[kind].append((k, n))
                size += len(k)
            if size > GATHER:
                for kind, parts in held.items():
                    yield _batch(list(_chunks(kind, *merged(*map(np.concatenate, zip(*parts, strict=True))), bits, "<u4")))
                held, size = {1: [], 2: []}, 0
        for kind, parts in held.items():
            if parts:
                yield _batch(list(_chunks(kind, *merged(*map(np.concatenate, zip(*parts, strict=True))), bits, "<u4")))

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        k = np.frombuffer(b"".join(pdf["keys"]), "<u8")
        n = np.frombuffer(b"".join(pdf["vals"]), "<u4").astype(np.uint64)
        k, n = merged(k, n)
        kind, total, distinct = int(pdf["kind"].iloc[0]), int(n.sum()), len(k)
        if kind == 2:
            k, n = k[n >= LEAST_BIGRAM], n[n >= LEAST_BIGRAM]
        levels = levels_of(n)
        entries, most = int((levels - below(kind)).sum()), int(levels.max(initial=0))
        segment = LogFrequencyFilter.segment(k, n, -(-max(64, entries * BITS) // 64) * 64, below(kind)) if entries else b""
        if kind == 2:
            k, n = k[:0], n[:0]
        return pd.DataFrame({"kind": [kind], "shard": [int(pdf["shard"].iloc[0])], "keys": [k.tobytes()], "vals": [n.tobytes()], "segment": [segment], "total": [total], "distinct": [distinct], "entries": [entries], "most": [most]})

    chunks = docs.select("text").mapInArrow(gather, "kind int, shard int, keys binary, vals binary")
    return chunks.groupBy("kind", "shard").applyInPandas(add, "kind int, shard int, keys binary, vals binary, segment binary, total long, distinct long, entries long, most int")


#: Least count of each level, a geometric series of two levels an octave without its repeated whole numbers: 1, 2, 4, 5, 8, 11, 16, ...
LEVELS = np.unique(np.floor(2 ** (np.arange(2 * 48) / 2))).astype(np.uint64)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """The number of levels that are stored for a count: the quantised logarithm."""
    return np.searchsorted(LEVELS, counts.astype(np.uint64), "right").astype(np.int64)


def count_of(levels: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level: 0, 1, 2.5, 4, 6, ..."""
    ends = np.concatenate([[0.5], LEVELS.astype(np.float64)])
    return np.where(levels > 0, (ends[levels] + ends[np.minimum(levels + 1, len(LEVELS))] - 1) / 2, 0.0)


def below(kind: int) -> int:
    """Levels that every stored n-gram of a kind has: they need not be stored."""
    return int(levels_of(np.array([LEAST_BIGRAM]))[0]) - 1 if kind == 2 else 0


@dataclass
class LogFrequencyFilter:
    """A Bloom filter in segments by the top bits of a key. A key is stored at all levels up to its count's; asking
    level after level until one is missing gives the quantised count. Never too small; too large with the filter's error rate."""

    bits: int
    offsets: np.ndarray  # first bit of each segment
    data: np.ndarray = field(repr=False)
    below: int = 0  # levels that are not stored
    most: int = len(LEVELS)  # highest level that any key has

    @staticmethod
    def _places(keys: np.ndarray, level: int, words: np.ndarray | np.uint64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The two words of a segment of ``words`` words that hold a key at a level, and a hash for its bits in each."""
        h = keys + np.uint64(0x9E3779B97F4A7C15 * level & (1 << 64) - 1)
        for salt in (0x632BE59BD9B4E019, 0xD1B54A32D192ED03):
            h = mix64(h ^ np.uint64(salt))
            yield ((h >> np.uint64(32)) * words >> np.uint64(32)).astype(np.int64), h

    @classmethod
    def segment(cls, keys: np.ndarray, counts: np.ndarray, size: int, below: int = 0) -> bytes:
        """The bits of a segment of ``size`` bits, a multiple of 64."""
        out = np.zeros(size, bool)
        levels = levels_of(counts) - below
        for q in range(1, int(levels.max(initial=0)) + 1):
            for word, h in cls._places(keys[levels >= q], q, np.uint64(size // 64)):
                for i in range(PROBES):
                    out[word * 64 + (h >> np.uint64(6 * i) & np.uint64(63)).astype(np.int64)] = True
        return np.packbits(out, bitorder="little").tobytes()

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Levels of keys; 0: not stored."""
        shard = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        return self.levels(keys, self.offsets[shard], (self.offsets[shard + 1] - self.offsets[shard]).astype(np.uint64))

    def levels(self, keys: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Levels of keys in the segments that begin at these bits; at most the highest stored level, however full a segment is."""
        data = self.data[: len(self.data) // 8 * 8].view("<u8")
        levels = np.zeros(len(keys), np.int64)
        left = np.flatnonzero(size > 0)
        q = 0
        while len(left) and q + self.below < self.most:
            q += 1
            there = np.ones(len(left), bool)
            for word, h in self._places(keys[left], q, size[left] >> np.uint64(6)):
                mask = np.zeros(len(left), np.uint64)
                for i in range(PROBES):
                    mask |= np.uint64(1) << (h >> np.uint64(6 * i) & np.uint64(63))
                there &= data[(begin[left] >> 6) + word] & mask == mask
            left = left[there]
            levels[left] = q + self.below
        return levels


@dataclass
class Model:
    words: LogFrequencyFilter | None  # None: the filters are in the segments
    pairs: LogFrequencyFilter | None
    n_tokens: int
    n_words: int
    head: np.ndarray = field(repr=False)
    head_counts: np.ndarray = field(repr=False)
    counts: DataFrame = field(repr=False)
    bits: int
    segments: DataFrame | None = field(default=None, repr=False)
    most: dict[int, int] = field(default_factory=dict)

    def scorer(self) -> Scorer:
        return Scorer(self.words, self.pairs, self.n_tokens, self.n_words, self.head, self.head_counts, self.bits)


@dataclass
class Scorer:
    """What the workers get."""

    words: LogFrequencyFilter | None
    pairs: LogFrequencyFilter | None
    n_tokens: int
    n_words: int
    head: np.ndarray
    head_counts: np.ndarray
    bits: int

    def token_scores(self, tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
        ids, at = np.unique(tokens, return_inverse=True)
        pairs, where = np.unique(bigram_hashes(tokens, starts)[1], return_inverse=True)
        return log_shares(self.words(ids), self.pairs(pairs), at, where, starts, int(np.searchsorted(ids, END)), self.n_tokens, self.n_words)


def log_shares(words: np.ndarray, pairs: np.ndarray, at: np.ndarray, where: np.ndarray, starts: np.ndarray, end: int, n_tokens: int, n_words: int) -> np.ndarray:
    """log10 p(token | token before): PAIR_SHARE c(pair) / c(before) + (1 - PAIR_SHARE) p(token), with p(token) = (c + 1) / (N + V + 1),
    counts from the filters' levels. A context never seen gives p(token). Texts seen are as many as ends (word ``end``)."""
    single, joint = count_of(words), count_of(pairs)[where]
    p = (single[at] + 1) / (n_tokens + n_words + 1)
    context = np.concatenate([[0.0], single[at[:-1]]]) if len(at) else single[at]
    context[starts[:-1]] = single[end] if len(single) else 0.0
    share = np.where(context > 0, PAIR_SHARE, 0.0)
    return np.log10(share * np.minimum(joint, context) / np.maximum(context, 1) + (1 - share) * p)


def _filter(counts: DataFrame, kind: int, bits: int, most: int) -> LogFrequencyFilter:
    parts = counts.where(F.col("kind") == kind)
    sizes = np.zeros(1 << bits, np.int64)
    for r in parts.select("shard", F.length("segment").alias("size")).collect():
        sizes[r["shard"]] = r["size"]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = np.zeros(offsets[-1] + 1, np.uint8)
    for r in parts.select("shard", "segment").toLocalIterator():  # one copy of the filter, not three
        data[offsets[r["shard"]] : offsets[r["shard"] + 1]] = np.frombuffer(r["segment"], np.uint8)
    return LogFrequencyFilter(bits, offsets * 8, data, below(kind), most)


def shard_bits(docs: DataFrame) -> int:
    """Shards grow with the input's partitions, so that the rows of a shard do not grow with the input."""
    return max(6, math.ceil(math.log2(2 * max(1, docs.rdd.getNumPartitions()))))


def train(docs: DataFrame, text: str = "text", max_filter: int = MAX_FILTER) -> Model:
    """Count the n-grams of all rows and store their quantised counts in filters, on the driver if both fit ``max_filter`` bytes."""
    bits = shard_bits(docs)
    counts = materialize(count_ngrams(docs.select(F.col(text).alias("text")), bits), "lm-counts")
    sums = {r["kind"]: r for r in counts.groupBy("kind").agg(F.sum("total").alias("total"), F.sum("distinct").alias("distinct"), F.sum("entries").alias("entries"), F.max("most").alias("most")).collect()}
    entries = sum(r["entries"] for r in sums.values())
    head, head_counts = _head(counts)
    one = sums.get(1)
    most = {kind: sums[kind]["most"] if kind in sums else 0 for kind in (1, 2)}
    fits = entries * BITS <= 8 * max_filter
    words, pairs = (_filter(counts, 1, bits, most[1]), _filter(counts, 2, bits, most[2])) if fits else (None, None)
    segments = None if fits else counts.select("kind", "shard", "segment")
    return Model(words, pairs, one["total"] if one else 0, one["distinct"] if one else 0, head, head_counts, counts, bits, segments, most)


def _head(counts: DataFrame, most: int = HEAD) -> tuple[np.ndarray, np.ndarray]:
    """Keys and exact counts of the words at or above the least count that at most ``most`` words reach."""

    def histogram(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for vals in pdf["vals"]:
                c, n = np.unique(np.minimum(np.frombuffer(vals, "<u8"), 1 << 20), return_counts=True)
                yield pd.DataFrame({"c": c.astype(np.int64), "n": n.astype(np.int64)})

    words = counts.where("kind = 1")
    have = sorted(((r["c"], r["n"]) for r in words.select("vals").mapInPandas(histogram, "c long, n long").groupBy("c").agg(F.sum("n").alias("n")).collect()), reverse=True)
    least, seen = 1 << 62, 0
    for c, n in have:
        seen += n
        if seen > most:
            break
        least = c

    def pick(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            for keys, vals in zip(pdf["keys"], pdf["vals"], strict=True):
                k, v = np.frombuffer(keys, "<u8"), np.frombuffer(vals, "<u8")
                yield pd.DataFrame({"keys": [k[v >= least].tobytes()], "vals": [v[v >= least].tobytes()]})

    rows = words.select("keys", "vals").mapInPandas(pick, "keys binary, vals binary").collect()
    keys, vals = np.frombuffer(b"".join(r["keys"] for r in rows), "<u8"), np.frombuffer(b"".join(r["vals"] for r in rows), "<u8")
    order = np.argsort(keys)
    return keys[order], vals[order]


def _shuffled_scores(both: DataFrame, model: Model) -> DataFrame:
    """(row, score): the distinct n-grams of each slice of texts go to their shards of the filter, and their levels return to it."""
    most, n_tokens, n_words = model.most, model.n_tokens, model.n_words

    def answer(asked: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(k, "<u8") for k in asked["keys"]]
        if not keys:
            return pd.DataFrame({"unit": [], "kind": [], "shard": [], "levels": []})
        kind = int(asked["kind"].iloc[0])
        data = np.frombuffer(b"".join(have["segment"]), np.uint8)
        every = np.concatenate(keys)
        part = LogFrequencyFilter(0, np.array([0, 8 * len(data)]), data, below(kind), most[kind])
        levels = part.levels(every, np.zeros(len(every), np.int64), np.full(len(every), 8 * len(data), np.uint64)).astype("u1")
        parts = np.split(levels, np.cumsum([len(k) for k in keys])[:-1])
        return pd.DataFrame({"unit": asked["unit"], "kind": asked["kind"], "shard": asked["shard"], "levels": [x.tobytes() for x in parts]})

    def score(texts: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        texts, got = texts.sort_values("row"), got.sort_values(["kind", "shard"])
        words, pairs = (np.frombuffer(b"".join(got.loc[got["kind"] == k, "levels"]), "u1").astype(np.int64) for k in (1, 2))
        ids, said = np.frombuffer(texts["keys"].iloc[0], "<u8"), [np.frombuffer(x, "<u4") for x in texts["said"]]
        starts, at = np.concatenate([[0], np.cumsum([len(x) for x in said])]), np.concatenate(said).astype(np.int64)
        where = np.unique(bigram_hashes(ids[at], starts)[1], return_inverse=True)[1]
        scores = log_shares(words, pairs, at, where, starts, int(np.searchsorted(ids, END)), n_tokens, n_words)
        return pd.DataFrame({"row": texts["row"], "score": np.add.reduceat(scores, starts[:-1])})

    asked = both.where("kind > 0").select("kind", "shard", "unit", "keys")
    levels = asked.groupBy("kind", "shard").cogroup(model.segments.groupBy("kind", "shard")).applyInPandas(answer, "unit long, kind int, shard int, levels binary")
    texts = both.where("row IS NOT NULL").select("row", "unit", "said", "keys")
    return texts.groupBy("unit").cogroup(levels.groupBy("unit")).applyInPandas(score, "row long, score double")


def score_documents(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(row, doc_id, held_out, n_tokens, n_known, base_score, score) of every row; ``held_out`` must be a column of ``docs``.

    ``score`` is the model's log10 probability of the text; a filter too large to broadcast is asked by shuffles of each slice's n-grams. ``base_score`` uses exact word counts: the most frequent words' are
    broadcast, other (word, row) pairs meet theirs in the shard of the word, and their sums return to the row.

    Defined results: null or empty text = the end token alone; null ids stay; repeated rows are scored each; an untrained model
    (no rows) knows nothing and has N = V = 0; an empty table gives an empty table; other columns are ignored.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model.scorer())
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Scorer = sent.value
        row = TaskContext.get().partitionId() << 36
        for batch, texts in slices(batches):
            tokens, starts = token_hashes(texts)
            n = np.diff(starts)
            count = len(texts)
            probes, unit, said = [], [None] * count, [None] * count
            ids = [None] * count
            if m.words is None:
                some, where = np.unique(tokens, return_inverse=True)
                pairs = np.unique(bigram_hashes(tokens, starts)[1])
                for k, grams in ((1, some), (2, pairs)):
                    probes += [(k, s, keys, None, row) for _, s, keys, _ in _chunks(k, grams, np.zeros(len(grams)), m.bits, "u1")]
                unit, ids[0] = [row] * count, some.tobytes()
                said = [x.astype("<u4").tobytes() for x in np.split(where, starts[1:-1])]
                scores = pa.nulls(count, pa.float64())
            else:
                scores = pa.array(np.add.reduceat(m.token_scores(tokens, starts), starts[:-1]))
            at = np.minimum(np.searchsorted(m.head, tokens), max(0, len(m.head) - 1))
            known = m.head[at] == tokens if len(m.head) else np.zeros(len(tokens), bool)
            logs = np.where(known, np.log10((m.head_counts[at] if len(m.head) else np.zeros(len(tokens))) + 1.0), 0.0)
            sums, n_known = np.add.reduceat(logs, starts[:-1]), np.add.reduceat(known.astype(np.int64), starts[:-1])
            owner = np.repeat(np.arange(len(texts), dtype=np.int64), n)[~known]
            tail = tokens[~known]
            order = np.argsort(tail, kind="stable")
            rows = [(0, s, k, v, None) for _, s, k, v in _chunks(0, tail[order], owner[order] + row, m.bits, "<i8")] + probes
            nulls = lambda t, c: pa.nulls(c, t)
            own = [pa.array(row + np.arange(count)), batch.column("doc_id"), batch.column("held_out"), pa.array(n.astype(np.int64)), pa.array(n_known), pa.array(sums), scores, pa.array(said, pa.binary())]
            main = [*own, nulls(pa.int32(), count), nulls(pa.int32(), count), pa.array(ids, pa.binary()), nulls(pa.binary(), count), pa.array(unit, pa.int64())]
            names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "sums", "score", "said", "kind", "shard", "keys", "rows", "unit"]
            yield pa.RecordBatch.from_arrays(main, names)
            if rows:
                other = [nulls(c.type, len(rows)) for c in own]
                types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
                yield pa.RecordBatch.from_arrays([*other, *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names)
            row += count

    source = docs.select(F.col(key).alias("doc_id"), "held_out", F.col(text).alias("text"))
    schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, sums double, score double, said binary, kind int, shard int, keys binary, rows binary, unit long"
    both = materialize(source.mapInArrow(run, schema), "lm-scores")
    main, tail = both.where("row IS NOT NULL").drop("said", "kind", "shard", "keys", "rows", "unit"), both.where("kind = 0").select("shard", "keys", "rows")
    if model.segments is not None:
        main = main.drop("score").join(_shuffled_scores(both, model), "row")

    def meet(asked: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
        k = np.frombuffer(b"".join(asked["keys"]), "<u8")
        row = np.frombuffer(b"".join(asked["rows"]), "<i8")
        ids, c = np.frombuffer(b"".join(have["keys"]), "<u8"), np.frombuffer(b"".join(have["vals"]), "<u8")
        if len(ids):
            at = np.minimum(np.searchsorted(ids, k), len(ids) - 1)
            found = ids[at] == k
            row, c = row[found], c[at[found]]
        else:
            row, c = row[:0], c[:0]
        rows, inverse = np.unique(row, return_inverse=True)
        return pd.DataFrame({"row": rows, "more_known": np.bincount(inverse, minlength=len(rows)).astype(np.int64), "more": np.bincount(inverse, np.log10(c + 1.0), len(rows))})

    words = model.counts.where("kind = 1").select("shard", "keys", "vals")
    more = tail.groupBy("shard").cogroup(words.groupBy("shard")).applyInPandas(meet, "row long, more_known long, more double")
    more = more.groupBy("row").agg(F.sum("more_known").alias("more_known"), F.sum("more").alias("more"))
    joined = main.join(more, "row", "left").fillna(0, ["more_known"]).fillna(0.0, ["more"])
    base = F.col("sums") + F.col("more") - F.col("n_tokens") * math.log10(model.n_tokens + model.n_words + 1)
    return joined.select("row", "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("more_known")).alias("n_known"), base.alias("base_score"), "score")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (crc_of_id("doc_id") % 7 == 2).alias("held_out"))
    model = train(docs.where(~F.col("held_out")))
    out = score_documents(docs, model)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
