"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from . import decontaminate, language_model, minhash, mixing, quality_model, quality_rules, token_ids, toxicity, url_filter, warc

QUERIES = {
    "op1_url_filter": url_filter.query,
    "op2_token_ids": token_ids.query,
    "op3_toxicity": toxicity.query,
    "op4_quality_rules": quality_rules.query,
    "op5_mixing": mixing.query,
    "op6_language_model": language_model.query,
    "op7_minhash": minhash.query,
    "op8_decontaminate": decontaminate.query,
    "op9_quality_model": quality_model.query,
    "op10_warc": warc.query,
}
ORACLES = {"op1_url_filter": url_filter.ORACLE, "op4_quality_rules": quality_rules.ORACLE, "op5_mixing": mixing.ORACLE, "op7_minhash": minhash.ORACLE, "op10_warc": warc.ORACLE}
