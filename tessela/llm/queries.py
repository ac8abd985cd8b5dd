"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from tessela.llm import centroids, decontam, divergence, licenses, line_dedup, mixing, near_dup, pii, quality, secrets, simhash, toxicity, warc

QUERIES = {
    "op1_quality": quality.op1,
    "op2_mixing": mixing.op2,
    "op3_warc": warc.op3,
    "op4_decontam": decontam.op4,
    "op5_secrets": secrets.op5,
    "op6_line_dedup": line_dedup.op6,
    "op7_near_dup": near_dup.op7,
    "op8_licenses": licenses.op8,
    "op9_pii": pii.op9,
    "op10_toxicity": toxicity.op10,
    "op11_simhash": simhash.op11,
    "op12_centroids": centroids.op12,
    "op13_divergence": divergence.op13,
}
ORACLE_SQL = {
    "op3_warc": warc.OP3_SQL,
    "op6_line_dedup": line_dedup.OP6_SQL,
    "op7_near_dup": near_dup.OP7_SQL,
    "op12_centroids": centroids.OP12_SQL,
    "op13_divergence": divergence.OP13_SQL,
}
