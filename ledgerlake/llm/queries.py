"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from ledgerlake.llm import (
    decontamination,
    fixity,
    jaccard_join,
    language_model,
    licences,
    nearest,
    periodic_runs,
    quality,
    sentencepieces,
    sharding,
    spelling,
    toxicity,
    wrapper,
)

QUERIES = {
    "op1_decontamination": decontamination.op1_decontamination,
    "op2_language_model": language_model.op2_language_model,
    "op3_warc_fixity": fixity.op3_warc_fixity,
    "op4_wrapper": wrapper.op4_wrapper,
    "op5_hilbert_sharding": sharding.op5_hilbert_sharding,
    "op6_jaccard_join": jaccard_join.op6_jaccard_join,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_sentencepiece": sentencepieces.op8_sentencepiece,
    "op9_licences": licences.op9_licences,
    "op10_nearest": nearest.op10_nearest,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_quality_rules": quality.op12_quality_rules,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}
ORACLES = {
    "op1_decontamination": decontamination.OP1_SQL,
    "op3_warc_fixity": fixity.OP3_SQL,
    "op6_jaccard_join": jaccard_join.OP6_SQL,
    "op11_spelling_variants": spelling.OP11_SQL,
    "op13_periodic_runs": periodic_runs.OP13_SQL,
}
