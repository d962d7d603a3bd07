"""The queries of this subpackage and the SQL that they are checked against."""

from __future__ import annotations

from . import (
    ann,
    chat,
    credentials,
    decontamination,
    fuzzy_lines,
    jaccard,
    language,
    lexical,
    mixing,
    packing,
    personal,
    quality,
    trie,
)

QUERIES = {
    "op1_nearest": ann.op1_nearest,
    "op2_chat_format": chat.op2_chat_format,
    "op3_quality": quality.op3_quality,
    "op4_jaccard_join": jaccard.op4_jaccard_join,
    "op5_language": language.op5_language,
    "op6_decontamination": decontamination.op6_decontamination,
    "op7_packed_ids": packing.op7_packed_ids,
    "op8_fuzzy_lines": fuzzy_lines.op8_fuzzy_lines,
    "op9_personal_data": personal.op9_personal_data,
    "op10_fair_mix": mixing.op10_fair_mix,
    "op11_owned_secrets": credentials.op11_owned_secrets,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_lexical_search": lexical.op13_lexical_search,
}
SQL = {
    "op1_nearest": ann.SQL,
    "op2_chat_format": chat.SQL,
    "op4_jaccard_join": jaccard.SQL,
    "op10_fair_mix": mixing.SQL,
    "op12_prefix_trie": trie.SQL,
    "op13_lexical_search": lexical.SQL,
}
