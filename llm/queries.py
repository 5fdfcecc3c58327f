"""Registry of this package's queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from llm.embedding_dedup import op1_embedding_dedup
from llm.language_id import op9_language_id
from llm.manifest import op11_manifest
from llm.mixing import op7_mixing
from llm.neighbours import op6_nearest
from llm.oracles import llm_oracles
from llm.packing import op3_packing
from llm.pii import op4_pii
from llm.quality import op2_quality
from llm.secrets_scan import op10_secrets
from llm.simhash import op8_simhash
from llm.token_alignment import op13_alignment
from llm.token_counts import op12_token_counts
from llm.url_filter import op5_urls

__all__ = ["llm_oracles", "llm_queries"]

Query = Callable[[SparkSession, str], DataFrame]


def llm_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_embedding_dedup, op2_quality, op3_packing, op4_pii, op5_urls, op6_nearest, op7_mixing, op8_simhash, op9_language_id, op10_secrets,
                                   op11_manifest, op12_token_counts, op13_alignment)}

