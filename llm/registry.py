"""One registered query per operator, over the whole table it is meant for, and its SQL."""

from __future__ import annotations

from llm import decontamination, language, merkle, minhash, mixing, neighbours, prefix_trie, quality, relative_lz, secrets, suffix_lpf, token_counts, warc

QUERIES = {
    "op1_relative_lempel_ziv": relative_lz.query,
    "op2_language_profiles": language.query,
    "op3_pruned_graph": neighbours.query,
    "op4_suffix_array_lpf": suffix_lpf.query,
    "op5_source_mixing": mixing.query,
    "op6_benchmark_decontamination": decontamination.query,
    "op7_quality_resampling": quality.query,
    "op8_min_max_hashing": minhash.query,
    "op9_secret_scan": secrets.query,
    "op10_warc_transactions": warc.captures,
    "op11_token_counts": token_counts.query,
    "op12_prefix_trie": prefix_trie.query,
    "op13_merkle_manifest": merkle.query,
}

ORACLES = {
    "op1_relative_lempel_ziv": relative_lz.SQL,
    "op3_pruned_graph": neighbours.SQL,
    "op4_suffix_array_lpf": suffix_lpf.SQL,
    "op6_benchmark_decontamination": decontamination.SQL,
    "op8_min_max_hashing": minhash.SQL,
    "op10_warc_transactions": warc.CAPTURES_SQL,
    "op12_prefix_trie": prefix_trie.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
