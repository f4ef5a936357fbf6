"""The queries of this folder and their SQL, as the entry module registers them."""

from __future__ import annotations

from folioframe.llm import bpe, filter_audit, language, lexical, licenses, mixing, mtree, ngram_join, nn_descent, packing, pii, suffix_dedup, toxicity

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_pii": pii.op2_pii,
    "op3_nn_descent": nn_descent.op3_nn_descent,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_licenses": licenses.op5_licenses,
    "op6_ngram_join": ngram_join.op6_ngram_join,
    "op7_language": language.op7_language,
    "op8_mixing": mixing.op8_mixing,
    "op9_mtree": mtree.op9_mtree,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_lexical": lexical.op11_lexical,
    "op12_bpe": bpe.op12_bpe,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLES = {
    "op8_mixing": mixing.OP8_SQL,
    "op9_mtree": mtree.OP9_SQL,
    "op11_lexical": lexical.OP11_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
