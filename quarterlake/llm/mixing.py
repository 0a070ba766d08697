"""Mixing sources to target weights by Poisson replication, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import computed, table

#: A Poisson draw is a sum of draws of at most this mean, so that exp(-mean) keeps its precision.
PART_MEAN = 16.0
#: P(X > TERMS) is below 2**-53 for a mean of PART_MEAN.
TERMS = 80
#: Up to so many sources the table of rates (one row of TERMS doubles a source) is broadcast; beyond, a salted join.
BROADCAST_SOURCES = 2_000


def _uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5 of the seed and the parts."""
    key = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5, size: float = 1.0, by: str = "source") -> DataFrame:
    """One row a source: rows, target share and mean repetitions = share * size * total / rows.

    ``weights`` gives target weights by source (absent sources: 0); without it they are rows ** ``alpha``.
    ``size`` is the expected number of output rows as a multiple of the input's. A null source is its own source, "".
    """
    counted = docs.groupBy(F.coalesce(F.col(by).cast("string"), F.lit("")).alias("mix_source")).agg(F.count(F.lit(1)).alias("mix_rows"))
    if weights is None:
        raw = F.pow(F.col("mix_rows").cast("double"), F.lit(alpha))
    elif weights:
        raw = F.coalesce(F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))[F.col("mix_source")].cast("double"), F.lit(0.0))
    else:
        raw = F.lit(0.0)
    weighed = counted.withColumn("mix_weight", raw)
    total = weighed.agg(F.sum("mix_weight").alias("w"), F.sum("mix_rows").alias("n"))
    share = F.try_divide(F.col("mix_weight"), total.select("w").scalar())
    return weighed.select("mix_source", "mix_rows", share.alias("mix_share"), (share * F.lit(size) * total.select("n").scalar() / F.col("mix_rows")).alias("mix_rate"))


def _with_cdf(rates: DataFrame) -> DataFrame:
    """Adds the number of parts of each draw and the cumulative Poisson probabilities of a part."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("mix_rate") / PART_MEAN)).cast("int")
    out = rates.withColumn("mix_parts", parts).withColumn("mix_mean", F.col("mix_rate") / F.col("mix_parts"))
    p0 = F.exp(-F.col("mix_mean"))
    start = F.struct(p0.alias("p"), p0.alias("c"), F.array(p0).alias("all"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * F.col("mix_mean") / k.cast("double")
        return F.struct(p.alias("p"), (acc["c"] + p).alias("c"), F.array_append(acc["all"], acc["c"] + p).alias("all"))

    return out.withColumn("mix_cdf", F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda acc: acc["all"]))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, alpha: float = 0.5, size: float = 1.0, seed: int = 17, by: str = "source", key: str = "doc_id") -> DataFrame:
    """Replicate each row a Poisson-distributed number of times so that sources reach their target shares; shuffle globally.

    The count inverts the Poisson distribution of the source's mean repetitions at a uniform number hashed from
    (seed, id, part): a rerun, a lost executor or another partitioning changes nothing. Rows with count 0 go.
    Adds ``n_copies``, ``copy_no`` (from 1), ``repetition_rate`` and ``shuffle_key``; rows are dealt over the cluster
    by that key and sorted by it within partitions, which is a random global order.

    Defined results: null source = source ""; null id = the id ""; repeated rows with one id get the same count each;
    empty texts count as rows; an empty table gives an empty table; input columns that have an added name are replaced.
    A source without weight, or all weights 0, gives no rows. A hot source costs nothing extra: no row is grouped by source
    but for the counts, which are combined before the shuffle.
    """
    rates = source_rates(docs, weights, alpha, size, by).where("mix_rate > 0")
    n_sources = docs.select(F.col(by)).distinct().limit(BROADCAST_SOURCES + 1).count()
    table_ = _with_cdf(rates).select("mix_source", "mix_rate", "mix_parts", "mix_cdf")
    kept = [c for c in docs.columns if c not in ("n_copies", "copy_no", "repetition_rate", "shuffle_key")]
    left = docs.select(F.struct(*kept).alias("mix_row"), F.col(key).alias("mix_key"), F.coalesce(F.col(by).cast("string"), F.lit("")).alias("mix_source"))
    if n_sources <= BROADCAST_SOURCES:
        joined = left.join(F.broadcast(table_), "mix_source")
    else:  # salted: a hot source meets its rate in 64 places
        joined = left.withColumn("mix_salt", F.pmod(F.xxhash64("mix_key"), F.lit(64)).cast("int")).join(table_.withColumn("mix_salt", F.explode(F.array(*(F.lit(i) for i in range(64))))), ["mix_source", "mix_salt"]).drop("mix_salt")
    one = lambda j: F.size(F.filter(F.col("mix_cdf"), lambda c: c < _uniform(seed, F.col("mix_key"), j)))
    drawn = F.aggregate(F.sequence(F.lit(1), F.col("mix_parts")), F.lit(0), lambda acc, j: acc + one(j))
    single = F.size(F.filter(F.col("mix_cdf"), lambda c: c < F.col("mix_u")))
    hashed = computed(joined, {"mix_u": _uniform(seed, F.col("mix_key"), F.lit(1))})
    counted = computed(hashed, {"n_copies": F.when(F.col("mix_parts") == 1, single).otherwise(drawn)}).where("n_copies > 0")
    copies = counted.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("n_copies")))).withColumnRenamed("mix_rate", "repetition_rate")
    keyed = copies.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(f"order{seed}"), F.coalesce(F.col("mix_key").cast("string"), F.lit("")), F.col("copy_no").cast("string"))))
    dealt = keyed.select("mix_row", "repetition_rate", "n_copies", "copy_no", "shuffle_key").repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    return dealt.select("mix_row.*", "repetition_rate", "n_copies", "copy_no", "shuffle_key")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix_sources(table(spark, sf_dir, "documents"), alpha=0.5, size=1.0, seed=17)
    return out.select("doc_id", "source", "text", F.round("repetition_rate", 9).alias("repetition_rate"), "n_copies", "copy_no", "shuffle_key")


OP2_SQL = """
WITH counted AS (SELECT coalesce(source, '') AS s, count(*) AS n FROM documents GROUP BY 1),
total AS (SELECT sum(sqrt(n::DOUBLE)) AS w, sum(n)::DOUBLE AS n FROM counted),
rated AS (SELECT s, sqrt(counted.n::DOUBLE) / w * total.n / counted.n AS rate FROM counted, total),
parted AS (SELECT s, rate, greatest(1, ceil(rate / 16.0))::INT AS parts, rate / greatest(1, ceil(rate / 16.0)) AS mean FROM rated),
pmf AS (
  SELECT s, k, exp(CASE WHEN k = 0 THEN -mean ELSE -mean + k * ln(mean) - lgamma(k + 1) END) AS p
  FROM parted, range(0, 81) t(k)),
cdf AS (SELECT s, k, sum(p) OVER (PARTITION BY s ORDER BY k) AS c FROM pmf),
drawn AS (
  SELECT d.doc_id, d.source, d.text, q.rate, q.s, j,
    (('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, '') || ':' || j), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents d JOIN parted q ON q.s = coalesce(d.source, ''), generate_series(1, q.parts) t(j)),
summed AS (
  SELECT doc_id, source, text, rate, sum((SELECT count(*) FROM cdf WHERE cdf.s = drawn.s AND c < u))::INT AS n_copies
  FROM drawn GROUP BY ALL)
SELECT doc_id, source, text, round(rate, 9) AS repetition_rate, n_copies, i::INT AS copy_no,
  md5('order17:' || coalesce(doc_id::VARCHAR, '') || ':' || i) AS shuffle_key
FROM summed, generate_series(1, n_copies) t(i)
"""
