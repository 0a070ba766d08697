"""The corpus pipeline: quality rules, near-duplicate removal, secret redaction, source mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns documents' columns; the last one returns
packed pieces. ``run`` writes each stage's result as Parquet to the shared folder and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterlake.llm.common import materialize, table
from quarterlake.llm.mixing import mix_sources
from quarterlake.llm.ngram_join import near_duplicates
from quarterlake.llm.packing import pack_documents
from quarterlake.llm.quality import quality_rules
from quarterlake.llm.secrets import redact_secrets

#: DuckDB SQL for the rows of ``run``: there is none, as n-gram hashes, the network and the tokenizer are outside SQL; the tests hold
#: each stage against a brute-force version.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts go (no words); null ids are judged like others; repeated rows are judged each; an empty table gives an empty
    table; more columns, also ones named like the rules' own, stay as they are."""
    judged = quality_rules(docs.select(F.struct(*docs.columns).alias("whole"), F.col("doc_id"), F.col("text")), table(spark, sf_dir, "labels"))
    return judged.where("kept").select("whole.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group stays.

    Rows without an id stay all; of rows with one id, which are one document, the one of least text stays (nulls first); documents without
    words are groups of their own; an empty table gives an empty table; more columns stay as they are, ties between them go to the least."""
    firsts = near_duplicates(docs).where("doc_id = component_id").select("doc_id").distinct()
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    kept = docs.join(firsts, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("text", *rest)).alias("least")).select("doc_id", "least.*")
    return kept.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets become a mark; no document goes.

    Null texts stay null, with null n_chars; null ids stay; repeated rows are redacted each; an empty table gives an empty table; more columns
    stay as they are."""
    return redact_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources get shares of the square root of their rows: a row comes out as often as its Poisson draw says, in a random order.

    A null source is a source of its own; null ids draw as the empty id; repeated rows draw alike; an empty table gives an empty table; more
    columns stay, but for the operator's own names (n_copies, copy_no, repetition_rate, shuffle_key)."""
    return mix_sources(docs, alpha=0.5, size=1.0, seed=17).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens.

    Null and empty texts are one piece of one token; null ids stay null; repeated rows, as mixing makes them, are packed each; an empty table
    gives no pieces; more columns are left out."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", keep_good), ("near_duplicates", drop_near_duplicates), ("secrets", redact), ("mixing", mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
