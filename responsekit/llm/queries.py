"""Registered queries of this subpackage and the DuckDB SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from responsekit.llm.collocations import SQL as PHRASE_SQL
from responsekit.llm.collocations import op13_collocations
from responsekit.llm.decontaminate import SQL as LEAK_SQL
from responsekit.llm.decontaminate import op10_decontaminate
from responsekit.llm.license_scan import SQL as LICENSE_SQL
from responsekit.llm.license_scan import op2_license_passages, op2_license_scan
from responsekit.llm.line_dedup import SQL as LINE_SQL
from responsekit.llm.line_dedup import op12_line_dedup
from responsekit.llm.ngram_jaccard import SQL as JACCARD_SQL
from responsekit.llm.ngram_jaccard import op5_ngram_jaccard
from responsekit.llm.quality_qda import op9_quality_qda
from responsekit.llm.quality_rules import op3_quality_rules
from responsekit.llm.source_mix import op6_source_mix
from responsekit.llm.substring_dedup import SQL as REPEAT_SQL
from responsekit.llm.substring_dedup import op4_substring_dedup
from responsekit.llm.token_align import op11_token_align
from responsekit.llm.token_counts import op1_token_counts
from responsekit.llm.url_rules import SQL as URL_SQL
from responsekit.llm.url_rules import op7_url_filter
from responsekit.llm.warc import SQL as WARC_SQL
from responsekit.llm.warc import op8_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_license_scan": op2_license_scan,
    "op2_license_passages": op2_license_passages,
    "op3_quality_rules": op3_quality_rules,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_source_mix": op6_source_mix,
    "op7_url_filter": op7_url_filter,
    "op8_warc": op8_warc,
    "op9_quality_qda": op9_quality_qda,
    "op10_decontaminate": op10_decontaminate,
    "op11_token_align": op11_token_align,
    "op12_line_dedup": op12_line_dedup,
    "op13_collocations": op13_collocations,
}

SQL: dict[str, str] = {
    "op2_license_scan": LICENSE_SQL,
    "op4_substring_dedup": REPEAT_SQL,
    "op5_ngram_jaccard": JACCARD_SQL,
    "op7_url_filter": URL_SQL,
    "op8_warc": WARC_SQL,
    "op10_decontaminate": LEAK_SQL,
    "op12_line_dedup": LINE_SQL,
    "op13_collocations": PHRASE_SQL,
}
