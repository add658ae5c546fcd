"""The registered queries of the subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tidewatch.llm import chat, decontaminate, licenses, minhash, mixing, rules, secrets, sharding, spans, tokens, turntrie, urls, vectorcodes

QUERIES = {
    "op1_mixing": mixing.query,
    "op2_licenses": licenses.query,
    "op3_chat": chat.query,
    "op4_secrets": secrets.query,
    "op5_rules": rules.query,
    "op6_minhash": minhash.query,
    "op7_sharding": sharding.query,
    "op8_tokens": tokens.query,
    "op9_decontaminate": decontaminate.query,
    "op10_urls": urls.query,
    "op11_codes": vectorcodes.query,
    "op12_trie": turntrie.query,
    "op13_spans": spans.query,
}

SQL = {
    "op1_mixing": mixing.SQL,
    "op3_chat": chat.SQL,
    "op4_secrets": secrets.SQL,
    "op5_rules": rules.SQL,
    "op10_urls": urls.SQL,
    "op11_codes": vectorcodes.SQL,
    "op12_trie": turntrie.SQL,
    "op13_spans": spans.SQL,
}
