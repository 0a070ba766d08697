"""Secret scans: fixed patterns, and a character convolutional network over every candidate and its context."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import slices, table

# The base patterns. Byte patterns fold case for ASCII letters alone.
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "cnn")
_KEYWORDS = (b"passw", b"secret", b"token", b"api")

#: A candidate is a run of the value class ``[A-Za-z0-9+/_.=-]`` of at least LEAST characters that has a digit and a letter, or ``=`` within, or
#: stands right after ``:`` or ``=`` (and quotes or spaces), or has at least CANDIDATE characters: not every plain word.
LEAST, CANDIDATE = 6, 16
_CLASS = np.zeros(256, bool)
_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
_DIGIT, _LETTER, _LOOSE = np.zeros(256, bool), np.zeros(256, bool), np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True
_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_LOOSE[list(b" \"'")] = True

#: The network's view: bytes before, of the candidate, and after. A longer candidate is seen in steps, and its best score counts.
LEFT, BODY, RIGHT = 24, 48, 8
WIDE = LEFT + BODY + RIGHT
EMBED, FILTERS, KERNEL = 12, 32, 5
#: Smallest recall on held-out findings that the threshold must keep.
RECALL = 0.98
SEED = 4711


def base_spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) by bytes of the fixed patterns. Access keys and hex strings lie in ``runs``, which hold all long runs of the
    value class."""
    out = []
    lowered = text.lower()
    if any(k in lowered for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    for begin, end in runs:
        if end - begin >= 20:
            run = text[begin:end]
            if b"AKIA" in run:
                out += [(begin + m.start(), 1, begin + m.end()) for m in ACCESS.finditer(run) if m.end() - m.start() >= 20]
            if end - begin >= 24:
                out += [(begin + m.start(), 2, begin + m.end()) for m in HEX.finditer(run) if m.end() - m.start() >= 24]
    return sorted(out)


def candidate_runs(texts: list[bytes]) -> list[list[tuple[int, int]]]:
    """The candidates (begin, end) of each text, by bytes."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    edge = np.flatnonzero(np.diff(_CLASS[buf], prepend=False))
    begin, end = edge[0::2], edge[1::2]
    some = end - begin >= LEAST
    begin, end = begin[some], end[some]
    digits, letters, equals = (np.concatenate([[0], np.cumsum(x, dtype=np.int32)]) for x in (_DIGIT[buf], _LETTER[buf], buf == ord("=")))
    both = (digits[end] > digits[begin]) & (letters[end] > letters[begin]) | (equals[end - 1] > equals[begin + 1])
    # the last byte before a run that is neither a quote nor a space
    solid = np.flatnonzero(~_LOOSE[buf])
    at = np.searchsorted(solid, begin) - 1
    last = np.where(at >= 0, buf[solid[np.maximum(at, 0)]], 0) if len(solid) else np.zeros(len(begin), np.uint8)
    keep = both | (end - begin >= CANDIDATE) | (last == ord(":")) | ((last == ord("=")) & (begin > 0))
    begin, end = begin[keep], end[keep]
    starts = np.cumsum([0, *(len(x) + 1 for x in texts)])
    owner = np.searchsorted(starts, begin, "right") - 1
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for o, b, e in zip(owner.tolist(), (begin - starts[owner]).tolist(), (end - starts[owner]).tolist(), strict=True):
        out[o].append((b, e))
    return out


def views(text: bytes, begin: int, end: int) -> list[bytes]:
    """The candidate in its context as fixed-width windows; all of a long candidate is seen."""
    out = []
    for at in range(begin, max(begin + 1, end - BODY // 2), BODY // 2):
        stop = min(end, at + BODY)
        left, right = text[max(0, at - LEFT) : at], text[stop : stop + RIGHT]
        out.append(left.rjust(LEFT, b"\0") + text[at:stop].ljust(BODY, b"\0") + right.ljust(RIGHT, b"\0"))
    return out


class CharCnn:
    """Bytes -> embedding -> convolution -> ReLU -> maximum over the context and over the candidate -> logistic, in numpy."""

    def __init__(self, seed: int = SEED, kind: type = np.float64) -> None:
        r = np.random.default_rng(seed)
        self.p = {
            "e": r.normal(0, 0.3, (256, EMBED)),
            "w": r.normal(0, (KERNEL * EMBED) ** -0.5, (KERNEL * EMBED, FILTERS)),
            "b": np.zeros(FILTERS),
            "o": r.normal(0, 0.1, 4 * FILTERS),
            "c": np.zeros(1),
        }
        self.p = {k: v.astype(kind) for k, v in self.p.items()}
        self.threshold, self.scale, self.shift = 0.5, 1.0, 0.0

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        e = self.p["e"][x]
        win = np.lib.stride_tricks.sliding_window_view(e, KERNEL, axis=1).transpose(0, 1, 3, 2).reshape(len(x), WIDE - KERNEL + 1, KERNEL * EMBED)
        a = np.maximum(win @ self.p["w"] + self.p["b"], 0)
        parts = (slice(0, LEFT - KERNEL + 1), slice(LEFT - KERNEL + 1, LEFT), slice(LEFT, LEFT + BODY))
        top = [a[:, s].max(1) for s in parts]
        there = (x[:, LEFT : LEFT + BODY] > 0).sum(1, keepdims=True)
        mean = (a[:, parts[2]] * (np.arange(BODY)[None, :, None] < there[:, :, None])).sum(1) / np.maximum(there, 1).astype(a.dtype)
        h = np.concatenate([*top, mean], 1)
        return h @ self.p["o"] + self.p["c"][0], (win, a, h, parts, there)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i : i + 512])[0] for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability of a secret."""
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logit(x) + self.shift, -40, 40)))

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        z, (win, a, h, parts, there) = self._forward(x)
        d = ((1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(x)).astype(z.dtype)
        dh = d[:, None] * self.p["o"]
        da = np.zeros_like(a)
        rows, cols = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
        for k, s in enumerate(parts):
            at = a[:, s].argmax(1) + s.start
            da[rows, at, cols] += dh[:, k * FILTERS : (k + 1) * FILTERS]
        within = np.arange(BODY)[None, :, None] < there[:, :, None]
        da[:, parts[2]] += within * (dh[:, 3 * FILTERS :] / np.maximum(there, 1).astype(a.dtype))[:, None, :]
        da *= a > 0
        dwin = (da @ self.p["w"].T).reshape(len(x), -1, KERNEL, EMBED)
        seen = np.lib.stride_tricks.sliding_window_view(x, KERNEL, axis=1).ravel()
        de = np.stack([np.bincount(seen, dwin[..., j].ravel(), 256) for j in range(EMBED)], 1).astype(a.dtype)
        return {"e": de, "w": win.reshape(-1, win.shape[2]).T @ da.reshape(-1, FILTERS), "b": da.sum((0, 1)), "o": h.T @ d, "c": np.array([d.sum()])}

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 5, batch: int = 64, rate: float = 4e-3, seed: int = SEED) -> None:
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(a) for k, a in self.p.items()}
        t = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(x), batch):
                t += 1
                for k, g in self._gradient(x[order[i : i + batch]], y[order[i : i + batch]]).items():
                    m[k] += 0.1 * (g - m[k])
                    v[k] += 0.001 * (g * g - v[k])
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float = RECALL) -> None:
        """Platt scaling on held-out findings. Of all thresholds that keep the recall the one with the fewest false findings counts: the
        middle between the highest look-alike below the secret that the recall needs last and that secret."""
        z = self.logit(x).astype(np.float64)
        a, b = 1.0, 0.0
        for _ in range(200):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
            w = p * (1 - p) + 1e-9
            g = np.array([((p - y) * z).sum() + 0.01 * (a - 1), (p - y).sum()])
            hess = np.array([[(w * z * z).sum() + 0.01, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
            step = np.linalg.solve(hess, g)
            a, b = a - np.clip(step[0], -0.5, 0.5), b - np.clip(step[1], -0.5, 0.5)
        self.scale, self.shift = float(a), float(b)
        score = self.score(x)
        last = float(np.quantile(score[y == 1], 1 - recall, method="lower"))
        below = score[(y == 0) & (score < last)]
        self.threshold = (last + float(below.max(initial=0.0))) / 2


def labelled_findings(n: int, seed: int) -> tuple[list[tuple[bytes, int, int]], np.ndarray]:
    """Made-up findings with their labels: (text, begin, end) of candidates; half are secrets of many kinds, half look-alikes."""
    r = np.random.default_rng(seed)
    pick = lambda chars, k: "".join(r.choice(list(chars), k))
    one = lambda *xs: xs[r.integers(len(xs))]
    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    syllables = [a + b for a in ("b", "c", "d", "f", "g", "l", "m", "n", "p", "r", "s", "t", "v", "th", "sh", "st", "tr", "", "ch", "qu") for b in ("a", "e", "i", "o", "u", "er", "in", "an", "on", "en", "ou", "ing", "ment", "tion", "keit", "lich", "ble", "ly")]

    def word(least: int) -> str:
        w = ""
        while len(w) < least:
            w += syllables[r.integers(len(syllables))]
        return w

    def around() -> str:
        return " ".join(one(word(2), word(4), word(7), word(7) + ",", word(6) + ".", pick(dig, r.integers(1, 6))) for _ in range(5)) + " "

    def password() -> str:
        w = word(4)[: int(r.integers(3, 9))]
        return one(w + pick(dig, int(r.integers(1, 5))) + one("", word(2)), w.capitalize() + pick(dig, 4), pick(low + up + dig, int(r.integers(7, 16))), pick(dig, 1) + w + pick(up, 2) + pick(dig, 2), w + "-" + pick(low + dig, 6), w.replace("e", "3").replace("o", "0") + pick(dig, 2))

    def secret() -> tuple[str, str, str]:
        if r.random() < 0.35:  # short ones are told by what stands around them
            lead, end = one(("pwd: ", ""), ("pwd=", ""), ("pass: ", ""), ("passwort: ", ""), ("my password is ", "."), ("PIN and password ", ""), ("login " + word(4) + " / ", ""), ("PWD='", "'"), ("credentials: " + word(4) + ":", ""), (one("postgres", "mysql", "https", "ftp", "redis", "amqp") + "://" + word(4) + ":", "@" + word(5) + ".example.com"), ("--password ", ""), ("contraseña: ", ""), ("mot de passe : ", ""), ('"passphrase": "', '"'))
            return lead, (password() + "xyz123")[: int(r.integers(8, 16))] if r.random() < 0.1 else (password() + pick(dig, 4))[: max(6, int(r.integers(6, 16)))], end
        n_ = int(r.integers(18, 64))
        value = one(pick("0123456789abcdef", n_), pick("0123456789ABCDEF", n_), pick(low + up + dig, n_), pick(low + up + dig + "+/", n_) + one("", "=", "=="), pick(low + up + dig + "-_", n_), one("ghp_", "sk_live_", "xoxb-", "glpat-") + pick(low + up + dig, 24), "AKIA" + pick(up + dig, 16), "eyJ" + pick(low + up + dig, 30) + "." + pick(low + up + dig, 40))
        lead = one("", "", "key: ", "Authorization: Bearer ", "auth=", "credential \"", "client_secret = '", "pwd: ", "private key ", "access key ", "signature=")
        return lead, value, ""

    def plain() -> tuple[str, str, str]:
        if r.random() < 0.4:
            lead, value, end = one(
                ("", word(4) + pick(dig, 2), ""), ("in ", pick(dig, 4) + "-" + pick(dig, 2) + "-" + pick(dig, 2), ""), ("version ", "v" + pick(dig, 1) + "." + pick(dig, 2) + "." + pick(dig, 2) + "b", ""),
                ("", f"{word(4)}.{word(4)}{pick(dig, 2)}", "@" + word(5) + ".example.com"), (f"{word(6)}.{pick(dig, 2)}@", f"{word(4)}{pick(dig, 1)}.example.{one('com', 'org')}", ""), (f"://{word(4)}:{password()}@", f"{word(2)}.example.com/{word(3)}", ""), ("://", word(6), ":" + password() + "@" + word(5) + ".example.com"), ("see ", f"img_{pick(dig, 4)}.jpg", ""), ("section ", f"{word(4)}-{pick(dig, 1)}.{pick(dig, 1)}b", ""), ("at ", f"{pick(dig, 2)}h{pick(dig, 2)}min", ""),
                (word(5) + ": ", word(6), ""), (word(4) + " = ", word(6) + "/" + word(4), ""), ("Time: ", f"{pick(dig, 2)}h{pick(dig, 2)}.{pick(dig, 2)}", ""), ("", f"{pick(dig, 3)}.{pick(dig, 2)}EUR", ""), ("No: ", pick(dig, 8), ""), ("tel: ", f"{pick(dig, 3)}-{pick(dig, 7)}", ""),
                ("https://", f"{word(5)}.example.org/{word(4)}{pick(dig, 3)}", ""), ("Subject: ", word(7), ""), ("", f"{word(3)}{pick(dig, 1)}{word(3)}", ""), ("password: ", one("required", "forgotten", "unchanged", word(7)), ""), ("the token ", word(8), ""), ("", f"{word(6)}{pick(dig, 4)}", ""), ("<b>", f"{word(4)}{pick(dig, 1)}.html", ""),
            )
            return lead, (value + "00")[: max(6, len(value))], end
        value = one(word(16), word(16).capitalize(), word(18).upper(), word(20), word(16), pick(dig, int(r.integers(16, 20))), f"{word(5)}.{pick(dig, 2)}", f"www.{word(8)}.com/{word(6)}/{word(4)}", f"{word(6)}.{word(5)}.example.com", pick(dig, 16), word(14) + word(6) + one("", "."), f"{word(6)}_{word(7)}_{word(5)}", f"{word(6)}-{word(7)}-{word(5)}", one("=", "-", "_", ".", "=-", "a", "ha") * int(r.integers(16, 40)), f"/{word(4)}/{word(5)}/{word(6)}.{word(3)}", f"{word(7)}/{word(9)}", f"{pick(dig, 4)}-{pick(dig, 2)}-{pick(dig, 2)}T{pick(dig, 2)}", ".".join(pick(dig, 3) for _ in range(5)), word(9) + "." + word(9).capitalize())
        value = value if len(value) >= CANDIDATE else value + word(CANDIDATE - len(value))
        return one("", "", "", "the ", "of ", word(5) + " ", "see ", "http://", "<", "("), value, ""

    rows, labels = [], np.arange(n) % 2
    for y in labels:
        lead, value, end = secret() if y else plain()
        before = (one("", around(), around(), word(5) + ".\n") + lead).encode()
        rows.append((before + (value + end + one(" ", "\n", '" ', ", ", ". ", "! ", "") + one("", around())).encode(), len(before), len(before) + len(value)))
    return rows, labels.astype(float)


@lru_cache(maxsize=2)
def trained(n: int = 4000, seed: int = SEED) -> CharCnn:
    """The network, fitted to ``n`` labelled findings and calibrated on as many others."""
    def arrays(s: int) -> tuple[np.ndarray, np.ndarray]:
        rows, y = labelled_findings(n, s)
        seen = [views(*row) for row in rows]
        return np.frombuffer(b"".join(v for vs in seen for v in vs), np.uint8).reshape(-1, WIDE), np.repeat(y, list(map(len, seen)))

    net = CharCnn(seed, np.float32)
    net.fit(*arrays(seed))
    net.calibrate(*arrays(seed + 1))
    return net


def scan_texts(texts: list[bytes], net: CharCnn) -> list[list[tuple[int, int, int, float]]]:
    """(start, kind, end, score) by code points of all spans of each text: base spans, and candidates that no base span covers wholly and
    the network gives at least its threshold. A base span's score is its candidate's, or 1 without one."""
    runs = candidate_runs(texts)
    seen = [views(t, b, e) for t, rs in zip(texts, runs, strict=True) for b, e in rs]
    flat = net.score(np.frombuffer(b"".join(v for vs in seen for v in vs), np.uint8).reshape(-1, WIDE))
    cuts = np.cumsum([0, *map(len, seen)])
    best = iter([float(flat[a:b].max()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    out = []
    for text, rs in zip(texts, runs, strict=True):
        base = base_spans(text, rs)
        scored = [(b, e, next(best)) for b, e in rs]
        spans = []
        for s, k, e in base:
            spans.append((s, k, e, max((p for b, f, p in scored if b < e and s < f), default=1.0)))
        spans += [(b, 3, e, p) for b, e, p in scored if p >= net.threshold and not any(s <= b and e <= f for s, _, f in base)]
        spans.sort()
        if spans and not text.isascii():  # byte offsets to code points
            at = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
            spans = [(int(at[s]), k, int(at[e]), p) for s, k, e, p in spans]
        out.append(spans)
    return out


def find_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, spans array<struct<start, stop, kind, score>>) of every whole text, by start and then kind.

    Defined results: null or empty text = no spans; null ids stay; repeated rows are scanned each; an empty table gives an empty
    table; other columns are ignored. Nothing is shuffled: memory is bounded by a few MB of text, or one longer text.
    """
    net = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            rows = [[{"start": s, "stop": e, "kind": KINDS[k], "score": p} for s, k, e, p in spans] for spans in scan_texts(texts, net)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, spans array<struct<start:long,stop:long,kind:string,score:double>>")


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "<secret>") -> DataFrame:
    """All rows and columns of ``docs``; in ``text`` every found span, overlapping ones joined, becomes ``mark``. Null texts stay null, empty ones
    empty; null ids stay; repeated rows are redacted each; an empty table gives an empty table."""
    net = trained()
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches, text):
            new = []
            nulls = batch.column(text).is_null().to_pylist()
            for raw, spans, null in zip(texts, scan_texts(texts, net), nulls, strict=True):
                if null:
                    new.append(None)
                    continue
                t = raw.decode()
                out, at = [], 0
                for s, _, e, _ in spans:
                    if s >= at:
                        out += [t[at:s], mark]
                    at = max(at, e)
                new.append("".join(out) + t[at:])
            i = columns.index(text)
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if j == i else c for j, c in enumerate(batch.columns)], columns)

    return docs.mapInArrow(run, docs.schema)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    said = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"] != "cnn")
    return found.select("doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"), F.sha2(said(base).cast("binary"), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"), of("cnn").alias("n_cnn"))
