"""The registered queries of this subpackage, and their DuckDB SQL where there is one."""

from __future__ import annotations

from plumbline.llm import decontamination, filter_audit, html_text, licenses, line_dedup, mixing, pii, quality_model, quality_rules, secrets, simhash, toxicity, vector_codes
from plumbline.llm.common import table

QUERIES = {
    "op1_secret_scan": lambda s, d: secrets.op1(table(s, d, "documents")),
    "op2_license_scan": lambda s, d: licenses.op2(table(s, d, "documents")),
    "op3_pii": lambda s, d: pii.op3(table(s, d, "documents")),
    "op4_quality_classifier": lambda s, d: quality_model.op4(table(s, d, "documents"), table(s, d, "labels")),
    "op5_decontamination": lambda s, d: decontamination.op5(table(s, d, "documents"), table(s, d, "benchmark")),
    "op6_toxicity": lambda s, d: toxicity.op6(table(s, d, "documents"), table(s, d, "labels")),
    "op7_mixing": lambda s, d: mixing.op7(table(s, d, "documents")),
    "op8_quality_rules": lambda s, d: quality_rules.op8(table(s, d, "documents")),
    "op9_simhash": lambda s, d: simhash.op9(table(s, d, "documents")),
    "op10_line_dedup": lambda s, d: line_dedup.op10(table(s, d, "documents")),
    "op11_filter_audit": lambda s, d: filter_audit.op11(table(s, d, "documents"), table(s, d, "labels")),
    "op12_html_text": lambda s, d: html_text.op12(table(s, d, "pages")),
    "op13_vector_codes": lambda s, d: vector_codes.op13(table(s, d, "embeddings")),
}

ORACLES = {
    "op2_license_scan": licenses.ORACLE,
    "op5_decontamination": decontamination.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op8_quality_rules": quality_rules.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}
