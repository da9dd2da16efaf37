"""Queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from ledgerline.llm import (bpe, decontaminate, line_dedup, lm, mtree, packing, prefix_trie, quality, repeats, runs, sharding,
                            simhash, url_filter)

QUERIES = {
    "op1_quality": quality.query,
    "op2_sharding": sharding.query,
    "op3_packing": packing.query,
    "op4_line_dedup": line_dedup.query,
    "op5_repeats": repeats.query,
    "op6_mtree": mtree.query,
    "op7_url_filter": url_filter.query,
    "op8_decontamination": decontaminate.query,
    "op9_language_model": lm.query,
    "op10_simhash": simhash.query,
    "op11_prefix_trie": prefix_trie.query,
    "op12_periodic_runs": runs.query,
    "op13_byte_bpe": bpe.query,
}

ORACLES = {
    "op4_line_dedup": line_dedup.ORACLE,
    "op6_mtree": mtree.ORACLE,
    "op7_url_filter": url_filter.ORACLE,
    "op8_decontamination": decontaminate.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
}
