"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import Scratch, WordHasher, crc_of_id, mix64, slices, table

#: Labelled rows that the machine is fitted to, at most (those of least hash of their id).
TRAIN_DOCS = 8_000
#: Terms are hashed to so many buckets; the fit keeps those that go with the label most clearly (chi-square), alone or two together.
BUCKET_BITS = 22
FEATURES, CHI_SQUARE, LEAST_DOCS = 768, 15.0, 8
#: Pairs are looked for among so many terms, the most frequent ones that not nearly all documents have; a pair must be clearer than
#: PAIR_CHI, among half a million of them, and than twice its members; the members of the clearest are kept, so many terms at most.
PAIR_TERMS, PAIR_CHI, PAIR_FEATURES = 1024, 45.0, 192
RANK = 8
#: Word beginnings, in bytes, and how often they must occur.
PREFIXES, LEVELS = (5, 6, 7, 8), (1, 2, 4)
#: Beginnings of so many bytes also make terms by their share of the words: one in so many words at least.
DENSE_PREFIX, DENSE = 6, (192, 128, 80)
SEED = 977

#: Bytes that end a term: everything in ASCII but letters and digits.
_GAPS = bytes(b for b in range(128) if not chr(b).isalnum())
_hashers: list[WordHasher] = []


def _leveled(pairs: np.ndarray, n: int, level: int) -> np.ndarray:
    """The pairs with other terms: those of beginnings of n bytes at a level."""
    shift, mask = np.uint64(64 - BUCKET_BITS), (1 << BUCKET_BITS) - 1
    return pairs & ~mask | (mix64((pairs & mask).astype(np.uint64) + np.uint64((n << 32) + (level << 40))) >> shift).astype(np.int64)


def document_terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document number, hashed term) pairs of many whole texts, lower-cased in ASCII. Terms are words, and word
    beginnings of several lengths that occur at least once, twice and four times, or in some share of all words: they carry over to inflected and joined words."""
    if not _hashers:
        _hashers.append(WordHasher(_GAPS))
    hashes, offsets = _hashers[0].prefixes(texts, (None, *PREFIXES))
    words = np.diff(offsets)
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), words)
    shift, mask = np.uint64(64 - BUCKET_BITS), (1 << BUCKET_BITS) - 1
    found = [np.unique(doc << BUCKET_BITS | (hashes[0] >> shift).astype(np.int64))]
    for n, h in zip(PREFIXES, hashes[1:], strict=True):
        pairs, count = np.unique(doc << BUCKET_BITS | (h >> shift).astype(np.int64), return_counts=True)
        for least in LEVELS:
            part = pairs[count >= least]
            found.append(_leveled(part, n, least))
        if n == DENSE_PREFIX:
            size = words[pairs >> BUCKET_BITS]
            found += [_leveled(pairs[count * one_in >= size], n, one_in << 8) for one_in in DENSE]
    pairs = np.unique(np.concatenate(found))
    return pairs >> BUCKET_BITS, pairs & mask


def chi_square(n: np.ndarray, pos: np.ndarray, total: float, all_pos: float) -> np.ndarray:
    """How clearly something that ``n`` documents have, ``pos`` of them labelled 1, goes with the label."""
    a, b, c, d = pos, n - pos, all_pos - pos, total - all_pos - (n - pos)
    return total * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1e-9)


def paired_terms(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Columns of ``x`` (documents by terms, 0 or 1) that tell the label two together, more than each alone."""
    together, with_label = x.T @ x, x.T @ (x * y[:, None])
    chi = chi_square(together.astype(np.float64), with_label.astype(np.float64), len(y), float(y.sum()))
    alone = np.diag(chi).copy()
    chi[(together < LEAST_DOCS) | (chi < PAIR_CHI) | (chi < 2 * np.maximum(alone[:, None], alone[None, :]))] = 0
    i, j = np.nonzero(np.triu(chi, 1))
    order = np.lexsort((j, i, -chi[i, j]))
    members = np.stack([i[order], j[order]], 1).ravel()
    _, first = np.unique(members, return_index=True)
    return members[np.sort(first)][:PAIR_FEATURES]


class FactorizationMachine:
    """logit = b + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j, for terms that are there (1) or not (0)."""

    def __init__(self, terms: np.ndarray, seed: int = SEED) -> None:
        r = np.random.default_rng(seed)
        self.terms = np.sort(terms)
        self.b, self.w, self.v = 0.0, np.zeros(len(terms)), r.normal(0, 0.02, (len(terms), RANK))

    def _columns(self, doc: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.terms):
            return doc[:0], term[:0]
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        known = self.terms[at] == term
        return doc[known], at[known]

    def logit(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        d, c = self._columns(doc, term)
        out = self.b + np.bincount(d, self.w[c], n) - 0.5 * np.bincount(d, (self.v[c] ** 2).sum(1), n)
        for k in range(RANK):
            out += 0.5 * np.bincount(d, self.v[c, k], n) ** 2
        return out

    def fit(self, doc: np.ndarray, term: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 256, rate: float = 0.1, l2: float = 2e-4, seed: int = SEED) -> FactorizationMachine:
        """AdaGrad on the logistic loss."""
        r = np.random.default_rng(seed)
        d, c = self._columns(doc, term)
        x = np.zeros((len(y), len(self.terms)), np.float32)
        x[d, c] = 1
        gw, gv, gb = np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6), 1e-6
        for _ in range(epochs):
            order = r.permutation(len(y))
            for i in range(0, len(y), batch):
                rows = order[i : i + batch]
                xb = x[rows]
                s = xb @ self.v
                z = self.b + xb @ self.w + 0.5 * ((s**2).sum(1) - xb @ (self.v**2).sum(1))
                e = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[rows]) / len(rows)
                dw = xb.T @ e + l2 * self.w
                dv = xb.T @ (e[:, None] * s) - (xb.T @ e)[:, None] * self.v + l2 * self.v
                db = float(e.sum())
                gw, gv, gb = gw + dw**2, gv + dv**2, gb + db**2
                self.w -= rate * dw / np.sqrt(gw)
                self.v -= 0.5 * rate * dv / np.sqrt(gv)
                self.b -= rate * db / np.sqrt(gb)
        return self


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", most: int = TRAIN_DOCS) -> FactorizationMachine:
    """Fit to at most ``most`` labelled documents outside the held-out fold (crc32 of the id mod 5 is 0). Terms are counted where the texts
    are; the driver gets the FEATURES clearest and the PAIR_TERMS most frequent ones, and which of these each document has. Ids labelled
    twice count as toxic if one label says so; null labels do not count; of several texts of one id one counts, that of least hash."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(crc_of_id("doc_id") % 5 != 0).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select(F.col("doc_id").alias("tox_id"), "toxic")
    picked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("tox_id"))
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text", "toxic")).alias("t")
    scratch = Scratch(docs.sparkSession, "toxic")
    picked = scratch.write(picked.groupBy("doc_id").agg(least).select(F.col("doc_id").cast("long").alias("doc_id"), "t.text", F.col("t.toxic").cast("long").alias("toxic")), "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            doc, term = document_terms(texts)
            toxic = np.asarray(batch.column("toxic").to_pylist()) > 0
            ids, number, n = np.unique(term, return_inverse=True, return_counts=True)
            pos = np.bincount(number, toxic[doc], len(ids)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(pos)], ["term", "n", "pos"])

    total, all_pos = picked.agg(F.count(F.lit(1)), F.coalesce(F.count_if(F.col("toxic") > 0), F.lit(0))).first()
    if not total:
        scratch.close()
        return FactorizationMachine(np.zeros(0, np.int64))
    counts = scratch.write(picked.mapInArrow(count, "term long, n long, pos long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).where(F.col("n") >= LEAST_DOCS), "terms")
    ad, bc = F.col("pos") * (total - all_pos - F.col("n") + F.col("pos")), (F.col("n") - F.col("pos")) * (all_pos - F.col("pos"))
    below = F.col("n").cast("double") * (total - F.col("n")) * F.lit(float(all_pos)) * F.lit(float(total - all_pos))
    clear = counts.withColumn("chi", F.lit(float(total)) * F.pow((ad - bc).cast("double"), F.lit(2.0)) / F.greatest(below, F.lit(1e-9)))
    ids = lambda df: np.array([r["term"] for r in df.select("term").collect()], np.int64)
    single = ids(clear.where(F.col("chi") >= CHI_SQUARE).orderBy(F.desc("chi"), "term").limit(FEATURES))
    frequent = ids(clear.where(F.col("n") <= 0.9 * total).orderBy(F.desc("n"), "term").limit(PAIR_TERMS))
    wanted = np.union1d(single, frequent)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            doc, term = document_terms(texts)
            at = np.minimum(np.searchsorted(wanted, term), max(0, len(wanted) - 1))
            there = wanted[at] == term if len(wanted) else np.zeros(len(term), bool)
            cuts = np.searchsorted(doc[there], np.arange(1, len(texts)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array([x.astype("<u2").tobytes() for x in np.split(at[there], cuts)], pa.binary())], ["doc_id", "toxic", "terms"])

    found = sorted(picked.mapInArrow(rows, "doc_id long, toxic long, terms binary").collect(), key=lambda x: x["doc_id"])
    scratch.close()
    y = np.array([float(x["toxic"] > 0) for x in found])
    doc = np.repeat(np.arange(len(found), dtype=np.int64), [len(x["terms"]) // 2 for x in found])
    term = np.frombuffer(b"".join(x["terms"] for x in found), "<u2").astype(np.int64)
    x = np.zeros((len(y), len(wanted)), np.float32)
    x[doc, term] = 1
    among = np.searchsorted(wanted, frequent)
    chosen = np.union1d(single, frequent[paired_terms(x[:, among], y.astype(np.float32))]) if len(frequent) else single
    del x
    return FactorizationMachine(chosen).fit(doc, wanted[term], y)


def toxicity_scores(docs: DataFrame, machine: FactorizationMachine, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text; nothing is shuffled.

    Defined results: a null or empty text has no terms and gets the machine's bias, as a text of unknown terms does; null ids
    stay; repeated rows are scored each; without labels every score is 0.5 from a bias of 0, predicted 1; an empty table gives
    an empty table; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            z = machine.logit(*document_terms(texts), len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], ["doc_id", "held_out", "score"])

    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("doc_id"), (crc_of_id(key) % 5 == 0).alias("held_out"), F.col(text).alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity_scores(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
