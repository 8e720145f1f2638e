"""The registered queries of this subpackage with the SQL that must give the same rows."""

from retentia.llm import (
    op1_wavelet, op2_language, op3_quality, op4_decontaminate, op5_near_dedup, op6_warc, op7_balltree, op8_token_counts, op9_pieces, op10_pii,
    op11_repair, op12_collocations, op13_licenses,
)

MODULES = [op1_wavelet, op2_language, op3_quality, op4_decontaminate, op5_near_dedup, op6_warc, op7_balltree, op8_token_counts, op9_pieces, op10_pii, op11_repair, op12_collocations, op13_licenses]


def load():
    """(queries, oracles) of all operators."""
    import corpus_pipeline

    queries, oracles = {"pipeline": corpus_pipeline.run}, {}
    for module in MODULES:
        queries |= module.QUERIES
        oracles |= module.ORACLES
    return queries, oracles
