"""Query registry of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from cadastra.llm import decontaminate, editprint, langid, mixing, quality, setsketch, styletree, suffixtree, urlfilter, warc

QUERIES = {
    "op1_decontamination": decontaminate.op1,
    "op2_html_extraction": styletree.op2,
    "op3_url_filter": urlfilter.op3,
    "op4_lm_scoring": suffixtree.op4,
    "op5_language_id": langid.op5,
    "op6_near_dedup": setsketch.op6,
    "op7_warc": warc.op7,
    "op8_source_mixing": mixing.op8,
    "op9_quality": quality.op9,
    "op10_fingerprints": editprint.op10,
}

SQL = {"op1_decontamination": decontaminate.OP1_SQL, "op3_url_filter": urlfilter.OP3_SQL, "op6_near_dedup": setsketch.OP6_SQL, "op8_source_mixing": mixing.OP8_SQL}
