"""Best-fit packing of tokenised documents, improved by swap-based local search."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import WordTable, materialize, slices, table

LIMIT = 2048
#: Pieces packed together by one task: a fixed size, so that tasks grow in number and not in length.
BLOCK = 16_384


class WordTokenizer:
    """Ids of whole texts. The tokenizer drops white space and never joins across it, so a
    text's ids are those of its words in order; a word's are those of its parts by the tokenizer's own splitting pattern.
    Words are encoded once and remembered, a bounded number of them."""

    #: Fixed value: the splitting pattern of the vocabulary file, as its ``pre_tokenizer`` states it.
    PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    SPECIAL = b"<|"
    MARKS = b".,;:!?"
    #: Stands for the end of a word: no UTF-8 text has this byte.
    END = b"\xff"

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        # printable Latin-1 bytes stand for themselves, the others for the characters from 256 on, in order
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        self.bytes_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        self.piece = self._merges().encode_single_piece
        self.marks = {b: self._encode(chr(b)) for b in self.MARKS}
        self.table = WordTable(self._learn)

    def _merges(self) -> Any:
        """The vocabulary's merges over bytes. Ids are in the order of the merges, so that an id is its merge's rank; the mark of a word's
        end is one byte more, which the tokens of a last byte take up before any other merge."""
        import tiktoken

        ranks = {}
        specials = set(self.tok.get_added_tokens_decoder())
        for token, i in self.tok.get_vocab().items():
            if i not in specials:
                last = len(token) > 4 and token.endswith("</w>")
                ranks[bytes(map(self.bytes_of.__getitem__, token[:-4] if last else token)) + self.END * last] = i
        return tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._core_bpe

    #: Letters of Latin-1, whose words are composed and printable, and a mark at the end.
    LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)[.,;:!?]?")

    def _encode(self, part: str) -> list[int]:
        """Ids of one normalised part, straight from the merges."""
        return self.piece(part.encode() + self.END)

    def _word(self, word: bytes) -> list[int]:
        """Ids of one word."""
        if word.isalpha():
            return self.piece(word.lower() + self.END)
        if word[-1:] in self.MARKS and word[:-1].isalpha():
            return self.piece(word[:-1].lower() + self.END) + self.marks[word[-1]]
        if self.SPECIAL in word:
            return self._whole(word)
        text = word.decode()
        low = text.lower()
        if not word.isascii():
            if (plain := self.LATIN.fullmatch(text)) is not None:
                ids = self._encode(low[: plain.end(1)])
                return ids if plain.end(1) == len(text) else ids + self.marks[word[-1]]
            # other letters are normalised as one word first, unless that changes nothing
            if not text.isprintable() or "Σ" in text or not unicodedata.is_normalized("NFC", text) or not unicodedata.is_normalized("NFC", low):
                return self._whole(word)
        return [i for part in self.PARTS.findall(low) for i in self._encode(part)]

    def _whole(self, word: bytes) -> list[int]:
        return self.tok.encode(word.decode(), add_special_tokens=False).ids

    def _learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found = list(map(self._word, words))
        return np.fromiter(chain.from_iterable(found), np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        row, offsets = self.table(texts)
        ids, ends = self.table.gather(row)
        return np.split(ids, np.concatenate([[0], ends])[offsets[1:-1]])


#: One a worker process, so that tasks share what was encoded.
_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, key: str = "doc_id") -> DataFrame:
    """Pieces of each document: its ids, then id 0; only longer documents are cut, into ``limit``-token pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = word_tokenizer(tokenizer_path)
        for batch, texts in slices(batches):
            rows: list[list] = [[], [], [], [], []]
            for doc, ids in zip(batch.column("doc_id").to_pylist(), tok(texts), strict=True):
                ids = ids.astype("<u4").tobytes() + b"\0\0\0\0"
                for piece, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    for column, x in zip(rows, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit_decreasing(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, int]:
    """Bin of each item: longest first, each into the fullest bin that still holds it."""
    order = np.argsort(-sizes, kind="stable")
    bins = np.empty(len(sizes), np.int64)
    by_free: list[list[int]] = [[] for _ in range(limit + 1)]
    mask, count = 0, 0
    for i in order:
        size = int(sizes[i])
        fits = mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                mask ^= 1 << free
        else:
            b, free, count = count, limit, count + 1
        bins[i] = b
        left = free - size
        if left:
            by_free[left].append(b)
            mask |= 1 << left
    return bins, count


def swap_search(sizes: np.ndarray, bins: np.ndarray, count: int, limit: int) -> np.ndarray:
    """Empty bins by local search: from each bin that the others' free space could take up, least filled first, move an
    item, or exchange one for one or two for one with a fuller bin, as long as that raises the sum of squared fills."""
    bins = bins.copy()
    fill = np.bincount(bins, sizes, count).astype(np.int64)
    emptied = True
    while emptied:
        emptied = False
        open_ = np.flatnonzero((fill > 0) & (fill < limit))
        room = int((limit - fill[open_]).sum())
        for s in open_[np.argsort(fill[open_], kind="stable")]:
            if not 0 < fill[s] <= room - (limit - fill[s]):
                continue
            pool = np.flatnonzero(np.isin(bins, np.flatnonzero((fill < limit) & (fill > 0))) & (bins != s))
            if _drain(int(s), sizes, bins, fill, limit, pool):
                emptied = True
                room -= limit
    return bins


def _drain(s: int, sizes: np.ndarray, bins: np.ndarray, fill: np.ndarray, limit: int, pool: np.ndarray) -> bool:
    """One source bin until it is empty (True) or no exchange helps."""
    while True:
        own = np.flatnonzero(bins == s)
        if not len(own):
            return True
        own = own[np.argsort(-sizes[own], kind="stable")]
        others = np.flatnonzero((fill > 0) & (fill < limit))
        others = others[others != s]
        free = limit - fill
        done = False
        for i in own:  # move: the fullest bin that takes it
            fits = others[free[others] >= sizes[i]]
            if len(fits) and fill[(t := fits[np.argmax(fill[fits])])] > fill[s] - sizes[i]:
                fill[t] += sizes[i]
                fill[s] -= sizes[i]
                bins[i] = t
                done = True
                break
        if done or not len(pool):
            if done:
                continue
            return False
        there = pool[(bins[pool] != s)]
        gifts = [((i,), int(sizes[i])) for i in own] + [((own[a], own[b]), int(sizes[own[a]] + sizes[own[b]])) for a in range(len(own)) for b in range(a + 1, len(own))]
        best = (0, None, None)
        space, level, size = free[bins[there]], fill[bins[there]], sizes[there]
        for items, total in gifts:
            gain = total - size
            ok = (gain > 0) & (gain <= space) & (level + gain > fill[s])
            if ok.any():
                j = int(np.argmax(np.where(ok, gain, 0)))
                if gain[j] > best[0]:
                    best = (int(gain[j]), items, int(there[j]))
        if best[1] is None:
            return False
        gain, items, j = best
        t = int(bins[j])
        bins[list(items)] = t
        bins[j] = s
        fill[t] += gain
        fill[s] -= gain


def pack_block(sizes: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece of a block."""
    bins = np.empty(len(sizes), np.int64)
    full = sizes >= limit
    part = np.flatnonzero(~full)
    got, count = best_fit_decreasing(sizes[part], limit)
    bins[part] = swap_search(sizes[part], got, count, limit) if len(part) else got
    bins[full] = count + np.arange(int(full.sum()))
    order = np.lexsort((np.arange(len(sizes)), bins))
    ends = np.cumsum(sizes[order])
    begins = ends - sizes[order]
    first = np.r_[True, np.diff(bins[order]) > 0] if len(order) else np.zeros(0, bool)
    offset = np.empty(len(sizes), np.int64)
    offset[order] = begins - np.maximum.accumulate(np.where(first, begins, 0)) if len(order) else 0
    return bins, offset


def pack_documents(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, key: str = "doc_id") -> DataFrame:
    """Pack tokenised documents into sequences of at most ``limit`` tokens: best fit decreasing, then swap search.

    Pieces are dealt by hash into blocks of about BLOCK pieces, each packed by one task; more data mean more blocks, and a
    block wastes at most part of one sequence. Within a sequence pieces lie in block order without gaps.

    Defined results: null or empty text = one piece of one token (id 0); null id stays null; repeated rows are packed each;
    an empty table gives no rows; other columns are ignored. Sequence ids are block * 2**32 + number in the block.
    """
    pieces = materialize(tokenized_pieces(docs, tokenizer_path, limit, key), "pack-pieces")
    n = pieces.count()
    blocks = max(1, round(n / BLOCK))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable", ignore_index=True)
        bins, offset = pack_block(pdf["length"].to_numpy(), limit)
        return pdf.assign(sequence_id=pdf["block"].astype("int64") * (1 << 32) + bins, offset=offset).drop(columns="block")

    # repeated rows of one document differ by a number that Spark gives within the materialised table
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(blocks)))
    return dealt.groupBy("block").applyInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op10_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))

