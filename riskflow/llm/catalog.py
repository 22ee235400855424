"""Queries of the operators, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from riskflow.llm import (
    bottomk, collocations, dac, decontaminate, interpolation, language, lines, merkle, packing, quality,
    recompression, simhash, suffixindex,
)

QUERIES = {
    query.__name__: query
    for query in (
        quality.op1_quality_ranking,
        decontaminate.op2_template_contamination,
        simhash.op3_simhash_components,
        lines.op4_line_runs,
        interpolation.op5_interpolated_lm,
        bottomk.op6_bottomk_fingerprints,
        dac.op7_dac_tokens,
        packing.op8_nnls_packing,
        language.op9_language_mixture,
        recompression.op10_recompression_repeats,
        merkle.op11_merkle_manifest,
        suffixindex.op12_suffix_levels,
        collocations.op13_automata_collocations,
    )
}

ORACLES = {
    "op4_line_runs": lines.ORACLE,
    "op10_recompression_repeats": recompression.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_suffix_levels": suffixindex.ORACLE,
    "op13_automata_collocations": collocations.ORACLE,
}
