"""The operators as queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from . import bpe, byte_bpe, classifier, hamming, langid, lloyd, ngram_join, packing, quality, runs, secrets, sharding, warc

QUERIES = {
    "op1_jump_hash_shards": sharding.query,
    "op2_warc_dictionary": warc.query,
    "op3_lexicon_bpe": bpe.query,
    "op4_markov_secrets": secrets.query,
    "op5_histogram_quality": quality.query,
    "op6_count_vector_join": ngram_join.query,
    "op7_ftrl_quality": classifier.query,
    "op8_hamming_top_k": hamming.query,
    "op9_backoff_language": langid.query,
    "op10_complement_packing": packing.query,
    "op11_fold_byte_bpe": byte_bpe.query,
    "op12_grammar_runs": runs.query,
    "op13_active_lloyd": lloyd.query,
}

ORACLES = {
    "op1_jump_hash_shards": sharding.SQL,
    "op2_warc_dictionary": warc.SQL,
    "op6_count_vector_join": ngram_join.SQL,
    "op8_hamming_top_k": hamming.SQL,
    "op13_active_lloyd": lloyd.SQL,
}
