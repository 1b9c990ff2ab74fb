"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm.conversations import op11_conversation_repair
from tablewright.llm.decontam import op9_benchmark_decontamination
from tablewright.llm.divergence import op12_source_divergence
from tablewright.llm.language_id import op8_language_id
from tablewright.llm.license_scan import op6_license_scan
from tablewright.llm.mixing import op13_source_mixing
from tablewright.llm.near_duplicates import op2_ngram_jaccard_join
from tablewright.llm.oracle import ORACLE as ORACLE
from tablewright.llm.packing import op3_lexical_packing
from tablewright.llm.pii import op10_pii_sanitisation
from tablewright.llm.quality_classifier import op5_quality_classifier
from tablewright.llm.quality_rules import op4_quality_rules
from tablewright.llm.secret_scan import op7_secret_scan
from tablewright.llm.sharding import op1_sharding

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_sharding, op2_ngram_jaccard_join, op3_lexical_packing, op4_quality_rules, op5_quality_classifier, op6_license_scan, op7_secret_scan, op8_language_id, op9_benchmark_decontamination,
        op10_pii_sanitisation, op11_conversation_repair, op12_source_divergence, op13_source_mixing,
    )
}
