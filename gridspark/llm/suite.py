"""The queries of this subpackage, and their SQL where SQL can express them."""

from gridspark.llm import (
    decontaminate,
    fingerprint,
    jaccard,
    minhash,
    mixing,
    ppm,
    prefix_trie,
    quality,
    secrets,
    sharding,
    spelling,
    substrings,
    warc,
)

QUERIES = {
    "op1_substring_dedup": substrings.op1_substring_dedup,
    "op2_jump_shards": sharding.op2_jump_shards,
    "op3_source_mix": mixing.op3_source_mix,
    "op4_ppm_scores": ppm.op4_ppm_scores,
    "op5_contaminations": decontaminate.op5_contaminations,
    "op6_quality": quality.op6_quality,
    "op7_warc": warc.op7_warc,
    "op8_secrets": secrets.op8_secrets,
    "op9_closed_syncmers": fingerprint.op9_closed_syncmers,
    "op10_near_duplicates": minhash.op10_near_duplicates,
    "op11_jaccard_join": jaccard.op11_jaccard_join,
    "op12_spelling_forms": spelling.op12_spelling_forms,
    "op13_conversation_trie": prefix_trie.op13_conversation_trie,
}

SQL = {
    "op1_substring_dedup": substrings.OP1_SQL,
    "op2_jump_shards": sharding.OP2_SQL,
    "op3_source_mix": mixing.OP3_SQL,
    "op7_warc": warc.OP7_SQL,
    "op11_jaccard_join": jaccard.OP11_SQL,
    "op12_spelling_forms": spelling.OP12_SQL,
    "op13_conversation_trie": prefix_trie.OP13_SQL,
}
