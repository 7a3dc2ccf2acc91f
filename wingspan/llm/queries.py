"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wingspan.llm.chat import OP3_SQL, op3_chat_formatting
from wingspan.llm.decontaminate import op6_decontamination
from wingspan.llm.filter_audit import OP12_SQL, op12_filter_audit
from wingspan.llm.jaccard_join import op7_jaccard_join
from wingspan.llm.nearest import op13_nearest_neighbours
from wingspan.llm.packing import op2_best_fit_packing
from wingspan.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from wingspan.llm.quality_classifier import op4_quality_classifier
from wingspan.llm.quality_rules import op10_quality_rules
from wingspan.llm.secrets import op9_secret_scans
from wingspan.llm.substring_dedup import op8_substring_dedup
from wingspan.llm.suffix_dedup import op5_suffix_dedup
from wingspan.llm.token_counts import op1_token_counts

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_decontamination": op6_decontamination,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_secret_scans": op9_secret_scans,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_filter_audit": op12_filter_audit,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

#: Statements over whole tables. The other operators are too slow or cannot be
#: expressed in SQL; tests/llm holds most against brute force, but not op4's scores,
#: op9's spans and op10's verdicts.
LLM_ORACLE: dict[str, str] = {"op3_chat_formatting": OP3_SQL, "op11_prefix_trie": OP11_SQL, "op12_filter_audit": OP12_SQL}
