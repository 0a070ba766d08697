"""Quality rules: base text statistics and a hashed n-gram likelihood ratio, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import WORD_GAP, computed, table

#: Hash buckets of each multinomial.
BUCKETS = 1 << 16
#: Labelled documents of quality 1 that make up the trusted target, at most (those of least hash).
TARGET_DOCS = 20_000
#: A document goes if its mean log-likelihood ratio a n-gram is below this many nats.
THRESHOLD = -0.1
#: n-grams of the raw corpus's distribution that the target is smoothed with: a small target then tells little, not something wrong.
PRIOR = 16_384.0
WINDOW = 8
MIN_WORDS = 20


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def _ngram_buckets(docs: DataFrame, words: str, out: str) -> DataFrame:
    """Buckets of all n-grams of whole words, n = 1 and 2."""
    b = F.lit(BUCKETS)
    held = docs.withColumn("qr_each", F.transform(F.col(words), lambda w: F.xxhash64(w)))
    one = F.transform("qr_each", lambda h: F.pmod(h, b).cast("int"))
    pairs = F.when(F.size("qr_each") > 1, F.transform(F.sequence(F.lit(0), F.size("qr_each") - 2), lambda i: F.pmod(F.xxhash64(F.get("qr_each", i), F.get("qr_each", i + 1)), b).cast("int"))).otherwise(F.array().cast("array<int>"))
    return held.withColumn(out, F.concat(one, pairs)).drop("qr_each")


def target_ids(labels: DataFrame, most: int = TARGET_DOCS) -> DataFrame:
    """Ids of the trusted target: documents labelled quality 1, the ``most`` of least hash."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.lit(1).alias("qr_one"))
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select(F.col("doc_id").alias("qr_target_id"))


def ngram_weights(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", most: int = TARGET_DOCS) -> DataFrame:
    """One row of BUCKETS weights: log of the smoothed target probability over the raw corpus's. Counts cover every whole text.

    Combined before the shuffle: BUCKETS rows a task at most. Without any target n-gram all weights are 0."""
    ids = F.broadcast(target_ids(labels, most))  # at most ``most`` rows
    held = docs.select(F.col(key).alias("qr_key"), words_of(F.col(text)).alias("qr_words"))
    marked = held.join(ids, held.qr_key == ids.qr_target_id, "left").withColumn("qr_is_target", F.col("qr_target_id").isNotNull().cast("int"))
    each = _ngram_buckets(marked, "qr_words", "qr_grams").select("qr_is_target", F.explode_outer("qr_grams").alias("bucket")).where("bucket IS NOT NULL")  # explode would filter by size, and compute n-grams twice
    counts = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("qr_is_target").alias("target"))
    dense = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").fillna(0, ["raw", "target"])
    packed = dense.agg(F.sum("raw").alias("r"), F.sum("target").alias("t"), F.collect_list(F.struct("bucket", "raw", "target")).alias("all"))
    n = float(BUCKETS)
    p = lambda x: (x["raw"] + 1.0) / (F.col("r") + n)
    ratio = lambda x: F.when(F.col("t") > 0, F.log((x["target"] + PRIOR * p(x)) / (F.col("t") + PRIOR)) - F.log(p(x))).otherwise(F.lit(0.0))
    return packed.select(F.transform(F.sort_array("all"), ratio).alias("weights"))


def _repeat_words(docs: DataFrame, words: str, out: str) -> DataFrame:
    """Words covered by 8-word windows whose 64-bit hash occurs twice or more in the document."""
    held = docs.withColumn("qr_h", F.transform(words, lambda w: F.xxhash64(w)))
    window = lambda i: F.xxhash64(*(F.get("qr_h", i + k) for k in range(WINDOW)))
    none = F.array().cast("array<bigint>")
    held = held.withColumn("qr_w", F.when(F.size("qr_h") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("qr_h") - WINDOW), window)).otherwise(none)).drop("qr_h")
    twice = F.size(F.array_distinct("qr_w")) < F.size("qr_w")
    pairs = F.sort_array(F.transform("qr_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    held = held.withColumn("qr_s", F.when(twice, pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))).drop("qr_w")
    near = lambda x, k: F.coalesce(F.get("qr_s", k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("qr_s", k + 1)["h"] == x["h"], F.lit(False))
    at = F.sort_array(F.transform(F.filter("qr_s", near), lambda x: x["i"]))
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(at, start, lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])
    return held.withColumn(out, covered.cast("long")).drop("qr_s")


def quality_rules(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, target_docs: int = TARGET_DOCS) -> DataFrame:
    """Adds the rules' columns to each row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept.

    ``llr`` is the mean, over all n-grams of the whole text, of log P(n-gram | trusted target) - log P(n-gram | raw corpus);
    ``kept`` is false if the base rules fail or ``llr`` < ``threshold``. One pass counts the n-grams of every document, a
    second scores it; nothing but BUCKETS counts is shuffled, so a hot source or group changes nothing.

    Defined results: null text = no words, base_failed; empty text likewise; null ids are never in the target; repeated rows
    are judged each; labels that say quality 1 twice count once; no labels at all: only the base rules reject; an empty table
    gives an empty table; input columns that have an added name are replaced.
    """
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]
    # BUCKETS numbers, whatever the corpus; as a constant they are an array that the scoring expression indexes
    found = ngram_weights(docs, labels, text, key, target_docs).first()["weights"]
    weights = F.split(F.lit(",".join(map(repr, found))), ",").cast("array<double>")
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    held = docs.drop(*added).withColumn("qr_words", words_of(F.col(text))).withColumn("qr_lines", lines)
    held = _repeat_words(held, "qr_words", "n_repeat_words")
    held = _ngram_buckets(held, "qr_words", "qr_grams")
    total = F.aggregate("qr_grams", F.lit(0.0), lambda acc, g: acc + F.get(weights, g))
    held = held.select(
        *[c for c in docs.columns if c not in added],
        F.size("qr_words").cast("long").alias("n_words"),
        F.length(F.array_join("qr_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("qr_lines") - F.size(F.array_distinct("qr_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.coalesce(F.try_divide(total, F.size("qr_grams").cast("double")), F.lit(0.0)).alias("llr"),
    )
    held = computed(held, {c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr")})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return held.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("llr") >= threshold))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")
