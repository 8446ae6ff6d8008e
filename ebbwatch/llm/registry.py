"""The corpus queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ebbwatch.llm.conversation_repair import op12_conversation_repair
from ebbwatch.llm.decontamination import op10_decontamination
from ebbwatch.llm.exact_dedup import op1_exact_dedup
from ebbwatch.llm.language_id import op5_language_id
from ebbwatch.llm.license_scan import op11_license_scan
from ebbwatch.llm.nearest import op2_nearest
from ebbwatch.llm.packing import op8_packing
from ebbwatch.llm.prefix_trie import op13_prefix_trie
from ebbwatch.llm.pseudonyms import op7_pseudonyms
from ebbwatch.llm.sharding import op4_sharding
from ebbwatch.llm.similarity_join import op9_similarity_join
from ebbwatch.llm.token_counts import op6_token_counts
from ebbwatch.llm.toxicity import op3_toxicity


def corpus_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_nearest": op2_nearest,
        "op3_toxicity": op3_toxicity,
        "op4_sharding": op4_sharding,
        "op5_language_id": op5_language_id,
        "op6_token_counts": op6_token_counts,
        "op7_pseudonyms": op7_pseudonyms,
        "op8_packing": op8_packing,
        "op9_similarity_join": op9_similarity_join,
        "op10_decontamination": op10_decontamination,
        "op11_license_scan": op11_license_scan,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_prefix_trie": op13_prefix_trie,
        "pipeline": corpus_pipeline.run,
    }

