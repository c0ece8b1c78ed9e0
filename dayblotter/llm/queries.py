"""The queries of this subpackage and the SQL that checks those which SQL can express."""

from dayblotter.llm import (
    bpe,
    chat,
    mixing,
    neighbours,
    packing,
    prefix_trie,
    quality,
    secrets,
    sharding,
    simhash,
    substrings,
    urls,
    vector_codes,
)

QUERIES = {
    "op1_extendible_shards": sharding.op1_extendible_shards,
    "op2_chat_format": chat.op2_chat_format,
    "op3_url_filter": urls.op3_url_filter,
    "op4_simhash_dedup": simhash.op4_simhash_dedup,
    "op5_nearest": neighbours.op5_nearest,
    "op6_pack": packing.op6_pack,
    "op7_substring_dedup": substrings.op7_substring_dedup,
    "op8_mix": mixing.op8_mix,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_weak_quality": quality.op10_weak_quality,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_bpe": bpe.op13_bpe,
}

ORACLES = {
    "op1_extendible_shards": sharding.ORACLE,
    "op2_chat_format": chat.ORACLE,
    "op3_url_filter": urls.ORACLE,
    "op7_substring_dedup": substrings.ORACLE,
    "op9_secret_scan": secrets.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
}
