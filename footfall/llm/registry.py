"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from footfall.llm import sql
from footfall.llm.bpe import op10_byte_bpe
from footfall.llm.filter_audit import op11_filter_audit
from footfall.llm.fingerprints import op1_fingerprints
from footfall.llm.html_text import op8_html_text
from footfall.llm.jaccard_join import op5_jaccard_join
from footfall.llm.katz import op2_katz
from footfall.llm.line_dedup import op9_line_dedup
from footfall.llm.packing import op6_packing
from footfall.llm.quality import op3_quality_rules
from footfall.llm.runs import op13_periodic_runs
from footfall.llm.substring_dedup import op7_substring_dedup
from footfall.llm.token_files import op12_token_files
from footfall.llm.warc import op4_warc

QUERIES = [op1_fingerprints, op2_katz, op3_quality_rules, op4_warc, op5_jaccard_join, op6_packing, op7_substring_dedup, op8_html_text,
           op9_line_dedup, op10_byte_bpe, op11_filter_audit, op12_token_files, op13_periodic_runs]


def queries():
    return {f.__name__: f for f in QUERIES}


def oracle():
    return sql.oracle()
