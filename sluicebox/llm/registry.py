"""Queries over the whole driver tables, one per operator, and the SQL that must agree where there is one."""

from __future__ import annotations

from sluicebox.llm import alignment, chat, gam, gbt, licenses, middle, mixing, packing, paragraphs, repeats, sharding, simhash, trie

QUERIES = {
    "op1_license_scan": licenses.license_labels,
    "op2_exact_dedup": trie.exact_owners,
    "op3_source_mix": mixing.mixed_sources,
    "op4_quality_rules": gbt.judge_documents,
    "op5_paragraph_dedup": paragraphs.repeated_paragraphs,
    "op6_substring_dedup": repeats.substring_repeats,
    "op7_best_fit_packing": packing.packed_documents,
    "op8_chat_rotation": chat.rotated_chats,
    "op9_simhash_dedup": simhash.simhash_classes,
    "op10_quality_classifier": gam.quality_classifier,
    "op11_feistel_shards": sharding.shard_documents,
    "op12_fill_in_middle": middle.middle_filled,
    "op13_token_alignment": alignment.aligned_documents,
}

SQL = {
    "op3_source_mix": mixing.SQL,
    "op8_chat_rotation": chat.SQL,
    "op11_feistel_shards": sharding.SQL,
    "op12_fill_in_middle": middle.SQL,
}
