"""The subpackage's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarterlake.llm.clustering import OP12_SQL, op12_centroid_clustering
from quarterlake.llm.language_id import op13_language_id
from quarterlake.llm.licenses import OP9_SQL, op9_license_scan
from quarterlake.llm.lm_scoring import op8_lm_scoring
from quarterlake.llm.media import op4_media_columns
from quarterlake.llm.mixing import OP2_SQL, op2_mix_sources
from quarterlake.llm.name_join import OP11_SQL, op11_name_join
from quarterlake.llm.ngram_join import OP1_SQL, op1_ngram_join
from quarterlake.llm.packing import op10_pack_documents
from quarterlake.llm.quality import op7_quality_rules
from quarterlake.llm.secrets import op6_secret_scan
from quarterlake.llm.token_counts import op3_token_counts
from quarterlake.llm.toxicity import op5_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_join": op1_ngram_join,
        "op2_mix_sources": op2_mix_sources,
        "op3_token_counts": op3_token_counts,
        "op4_media_columns": op4_media_columns,
        "op5_toxicity": op5_toxicity,
        "op6_secret_scan": op6_secret_scan,
        "op7_quality_rules": op7_quality_rules,
        "op8_lm_scoring": op8_lm_scoring,
        "op9_license_scan": op9_license_scan,
        "op10_pack_documents": op10_pack_documents,
        "op11_name_join": op11_name_join,
        "op12_centroid_clustering": op12_centroid_clustering,
        "op13_language_id": op13_language_id,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_join": OP1_SQL, "op2_mix_sources": OP2_SQL, "op9_license_scan": OP9_SQL, "op11_name_join": OP11_SQL, "op12_centroid_clustering": OP12_SQL}
