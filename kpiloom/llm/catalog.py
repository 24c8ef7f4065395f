"""The queries of this package: name -> (spark, sf_dir) -> DataFrame, and
their oracle SQL where SQL can express them."""

from __future__ import annotations

from kpiloom.llm import url_filter
from kpiloom.llm.alignment import op12_merge_path_alignment
from kpiloom.llm.ann import op10_multi_index_hashing
from kpiloom.llm.byte_bpe import op8_byte_bpe
from kpiloom.llm.chat_tree import op5_chat_prefix_tree
from kpiloom.llm.decontamination import op2_spaced_seed_decontamination
from kpiloom.llm.language_id import op6_byte_cnn_language
from kpiloom.llm.runs import op13_suffix_class_runs
from kpiloom.llm.sharding import op1_stratified_interleave
from kpiloom.llm.simhash import op7_bitsliced_simhash
from kpiloom.llm.substring_dedup import op11_super_k_mer_dedup
from kpiloom.llm.token_count import op9_resync_token_counts
from kpiloom.llm.toxicity import op3_fm_toxicity
from kpiloom.llm.url_filter import op4_bloom_url_filter


def queries():
    found = [op1_stratified_interleave, op2_spaced_seed_decontamination, op3_fm_toxicity, op4_bloom_url_filter, op5_chat_prefix_tree,
             op6_byte_cnn_language, op7_bitsliced_simhash, op8_byte_bpe, op9_resync_token_counts, op10_multi_index_hashing,
             op11_super_k_mer_dedup, op12_merge_path_alignment, op13_suffix_class_runs]
    return {f.__name__: f for f in found}


def oracles() -> dict[str, str]:
    return {"op4_bloom_url_filter": url_filter.ORACLE}
