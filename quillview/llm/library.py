"""The queries of this subpackage: name, function and, where SQL can say it, SQL."""

from __future__ import annotations

from . import ann, html_main, license_scan, minhash, mixing, quality, sentencepiece_codec, sharding, token_counts, token_records

QUERIES = {
    "op1_ann": ann.query,
    "op2_minhash": minhash.query,
    "op3_sentencepiece": sentencepiece_codec.query,
    "op4_token_records": token_records.query,
    "op5_html_main": html_main.query,
    "op6_sharding": sharding.query,
    "op7_license_scans": license_scan.query,
    "op8_quality_rules": quality.query,
    "op9_token_counts": token_counts.query,
    "op10_mixing": mixing.query,
}
ORACLES: dict[str, str] = {"op8_quality_rules": quality.ORACLE, "op10_mixing": mixing.ORACLE}
