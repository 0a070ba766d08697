"""Language of a text by multinomial naive Bayes over hashed character n-grams.

N-grams of one to three characters of the lower-cased letters, with one space before each word, are hashed into BUCKETS numbers. Counts of all training
documents, by language, make a matrix of log probabilities in fixed point, which is broadcast: languages times BUCKETS numbers,
however large the corpus is. A batch of texts is scored sparsely: the matrix's rows at the n-grams that occur, added up by text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import crc_of_id, slices, table

ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
#: Added to each count.
SMOOTHING = 0.5
#: Languages known at most: those of most training documents. Bounds the matrix (at 64: 16 MiB).
LANGUAGES = 64
#: Log probabilities are whole multiples of 1 / SCALE, so that sums do not depend on the order.
SCALE = 1 << 16
#: Bytes of text looked at together.
SLICE = 1 << 18
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the buckets of all n-grams of all texts, one text's after the other's, and the offsets where each text's begin. A text
    without letters has none."""
    lowered = [f" {t.lower()} " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum(np.fromiter(map(len, lowered), np.int64, len(texts)))
    letter = letter_table()[codes]
    keep = letter.copy()  # of each gap the last character stays: the space before a word
    keep[:-1] |= letter[1:]
    keep[ends[:-1] - 1] = False
    count = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])]
    codes = np.where(letter, codes, 32)[keep].astype(np.uint64)
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        h = (h[:-1] if n > 1 else h) * np.uint64(0x100000001B3) + codes[n - 1 :]
        if n in ORDERS and len(h):
            x = (h ^ np.uint64(n << 56)) * np.uint64(0x9E3779B97F4A7C15)
            bucket = ((x ^ x >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(48)).astype(np.int64)
            first, last = count[:-1], np.maximum(count[1:] - n + 1, count[:-1])
            inside = np.zeros(len(codes) + 1, np.int64)
            np.add.at(inside, first, 1)
            np.add.at(inside, last, -1)
            yield bucket[np.cumsum(inside)[: len(bucket)] > 0], np.concatenate([[0], np.cumsum(last - first)])


def ngram_counts(train: DataFrame, languages: list[str]) -> DataFrame:
    """(lang, bucket, n) of training documents (lang, text), lang as its number; a task gives each pair once."""
    number = {x: i for i, x in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), np.int64)
        for batch, texts in slices(batches, most=SLICE):
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()])
            order = np.argsort(lang, kind="stable")
            edge = np.searchsorted(lang[order], np.arange(len(languages) + 1))
            for bucket, at in ngrams([texts[i].decode("utf-8") for i in order]):
                for i in np.unique(lang):
                    counts[i] += np.bincount(bucket[at[edge[i]] : at[edge[i + 1]]], minlength=BUCKETS)
        lang, bucket = np.nonzero(counts)
        for at in range(0, len(lang), 1 << 16):
            i, j = lang[at : at + (1 << 16)], bucket[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(counts[i, j])], ["lang", "bucket", "n"])

    each = train.where(F.col("lang").isin(languages)).select("lang", "text").mapInArrow(run, "lang int, bucket int, n long")
    return each.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Languages in order, their log priors, and the log probability of each bucket in each language, in fixed point."""

    def __init__(self, languages: list[str], documents: list[int], counts: np.ndarray) -> None:
        self.languages = languages
        smooth = counts + SMOOTHING
        fixed = lambda x: np.rint(np.log(x) * SCALE)
        self.matrix = fixed(smooth / smooth.sum(1, keepdims=True)).astype(np.int64)
        self.prior = fixed(np.array(documents) / max(sum(documents), 1)).astype(np.int64) if languages else np.zeros(0, np.int64)

    def __call__(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and its probability; ``und`` and 0 for a text without letters, or if no language was learned."""
        out = [(UNKNOWN, 0.0)] * len(texts)
        if not self.languages:
            return out
        sums, some = np.tile(self.prior, (len(texts), 1)), np.zeros(len(texts), bool)
        for bucket, at in ngrams(texts):
            there = at[1:] > at[:-1]
            for i, row in enumerate(self.matrix):
                if there.any():
                    sums[there, i] += np.add.reduceat(row[bucket], at[:-1][there])
            some |= there
        best = sums.argmax(1)  # ties: the first in order
        for row in np.flatnonzero(some).tolist():
            rest = math.fsum(math.exp(x / SCALE) for x in np.sort(sums[row] - sums[row, best[row]]).tolist())
            out[row] = self.languages[best[row]], 1 / rest
        return out


def learn(train: DataFrame) -> Model:
    """The model of all documents (lang, text) whose lang is among the LANGUAGES most frequent (ties: the first in order)."""
    train = train.where("lang IS NOT NULL AND text IS NOT NULL")
    known = train.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    known = sorted((r["lang"], r["n"]) for r in known)
    languages = [x for x, _ in known]
    counts = np.zeros((len(languages), BUCKETS))
    if languages:
        found = ngram_counts(train, languages).toPandas()  # languages times BUCKETS rows at most
        counts[found["lang"], found["bucket"]] = found["n"]
    return Model(languages, [n for _, n in known], counts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of (doc_id, held_out, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, most=SLICE):
            found = sent.value([t.decode("utf-8") for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs`` (doc_id, text, lang), learned from those that are not held out. The score
    is the posterior probability of the language.

    Defined results: texts that are null, empty or without a letter are ``und`` with score 0, as all are if nothing was learned; long
    texts are scored whole; ties go to the first language in order; a null lang teaches nothing; repeated rows teach as often as they occur and
    are predicted each; a null id is that of a row that is judged like others; an empty table gives an empty table; other columns are
    ignored. Equal texts have equal results.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", held_out.alias("held_out"))
    return predict(docs, learn(docs.where("NOT held_out")))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"), crc_of_id() % 4 == 2)
