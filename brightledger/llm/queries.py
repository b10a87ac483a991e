"""Registered queries of this package and their SQL twins."""

from __future__ import annotations

from brightledger.llm import languages, licenses, mixing, packing, pii, quality, resampling, simhash, tokens, toxicity, urls, variants, vectors

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_simhash": simhash.op2_simhash,
    "op3_quality": quality.op3_quality,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_token_counts": tokens.op5_token_counts,
    "op6_packing": packing.op6_packing,
    "op7_url_filter": urls.op7_url_filter,
    "op8_licenses": licenses.op8_licenses,
    "op9_pii": pii.op9_pii,
    "op10_vectors": vectors.op10_vectors,
    "op11_languages": languages.op11_languages,
    "op12_variants": variants.op12_variants,
    "op13_resampling": resampling.op13_resampling,
}

SQL: dict[str, str] = {
    "op1_mixing": mixing.SQL,
    "op3_quality": quality.SQL,
    "op7_url_filter": urls.SQL,
    "op8_licenses": licenses.SQL,
    "op12_variants": variants.SQL,
    "op13_resampling": resampling.SQL,
}
