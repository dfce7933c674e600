"""Queries of this subpackage: name to (callable, SQL or None)."""

from __future__ import annotations

from courtflow.llm import (
    class_model,
    decontamination,
    jaccard,
    language,
    licenses,
    packing,
    periodic,
    pii,
    sharding,
    spelling,
    substrings,
    toxicity,
    vectors,
)

QUERIES = {
    "op1_license_scan": (licenses.op1_license_scan, None),
    "op2_sum_of_squares_packing": (packing.op2_sum_of_squares_packing, None),
    "op3_personal_data": (pii.op3_personal_data, None),
    "op4_toxicity": (toxicity.op4_toxicity, None),
    "op5_language_identification": (language.op5_language_identification, None),
    "op6_benchmark_decontamination": (decontamination.op6_benchmark_decontamination, None),
    "op7_hilbert_shards": (sharding.op7_hilbert_shards, None),
    "op8_ngram_jaccard_join": (jaccard.op8_ngram_jaccard_join, jaccard.OP8_SQL),
    "op9_embedding_near_dedup": (vectors.op9_embedding_near_dedup, vectors.OP9_SQL),
    "op10_substring_dedup": (substrings.op10_substring_dedup, substrings.OP10_SQL),
    "op11_spelling_variants": (spelling.op11_spelling_variants, spelling.OP11_SQL),
    "op12_periodic_runs": (periodic.op12_periodic_runs, periodic.OP12_SQL),
    "op13_class_model": (class_model.op13_class_model, None),
}
