"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import binslack, bpe, dualtree, linededup, ngramjoin, nsbounds, packing, pii, quality, search, suffixdedup, tokenfile, warc

QUERIES = {
    "op1_suffix_dedup": suffixdedup.op1_suffix_dedup,
    "op2_line_dedup": linededup.op2_line_dedup,
    "op3_pii": pii.op3_pii,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_packing": packing.op5_packing,
    "op6_ngram_join": ngramjoin.op6_ngram_join,
    "op7_maxscore_search": search.op7_maxscore_search,
    "op8_warc": warc.op8_warc,
    "op9_bpe": bpe.op9_bpe,
    "op10_token_files": tokenfile.op10_token_files,
    "op11_dual_tree": dualtree.op11_dual_tree,
    "op12_min_bin_slack": binslack.op12_min_bin_slack,
    "op13_ns_bounds": nsbounds.op13_ns_bounds,
}
SQL: dict[str, str] = {
    "op4_quality_rules": quality.SQL,
    "op7_maxscore_search": search.SQL,
    "op8_warc": warc.SQL,
    "op11_dual_tree": dualtree.SQL,
    "op13_ns_bounds": nsbounds.SQL,
}
