"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from tessella.llm.decontam import OP5_SQL, op5_benchmark_decontamination
from tessella.llm.packing import op9_best_fit_packing
from tessella.llm.pii import op7_personal_data
from tessella.llm.quality import op4_quality_classifier
from tessella.llm.secrets import op8_secret_scan
from tessella.llm.simhash import op2_simhash_near_duplicates
from tessella.llm.sketches import op10_document_fingerprints
from tessella.llm.substrings import op3_suffix_array_dedup
from tessella.llm.tokens import op1_token_counts
from tessella.llm.toxicity import op6_toxicity_classifier

QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_simhash_near_duplicates": op2_simhash_near_duplicates,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_toxicity_classifier": op6_toxicity_classifier,
    "op7_personal_data": op7_personal_data,
    "op8_secret_scan": op8_secret_scan,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_document_fingerprints": op10_document_fingerprints,
}

ORACLE_SQL: dict[str, str] = {
    "op5_benchmark_decontamination": OP5_SQL,
}
