"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from studyloom.llm import bpe, langid, linededup, lm, merkle, mixing, mpeg, neardup, pii, search, simhash, toxicity, urlfilter

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_pii": pii.op2_pii,
    "op3_fingerprints": simhash.op3_fingerprints,
    "op4_urlfilter": urlfilter.op4_urlfilter,
    "op5_mpeg": mpeg.op5_mpeg,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_langid": langid.op7_langid,
    "op8_bpe": bpe.op8_bpe,
    "op9_lm": lm.op9_lm,
    "op10_neardup": neardup.op10_neardup,
    "op11_merkle": merkle.op11_merkle,
    "op12_linededup": linededup.op12_linededup,
    "op13_search": search.op13_search,
}

ORACLE_SQL = {
    "op1_mixing": mixing.SQL,
    "op4_urlfilter": urlfilter.SQL,
    "op11_merkle": merkle.SQL,
    "op12_linededup": linededup.SQL,
    "op13_search": search.SQL,
}
