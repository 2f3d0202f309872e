"""Registered queries of the dealt operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chirpstat.llm.centroids import OP11_SQL, op11_centroids
from chirpstat.llm.decontaminate import op3_decontaminate
from chirpstat.llm.html_main import op6_html_main
from chirpstat.llm.jaccard_join import op9_jaccard_join
from chirpstat.llm.langid import op2_langid
from chirpstat.llm.lm_scoring import op5_lm_scoring
from chirpstat.llm.mixing import op7_mixing
from chirpstat.llm.part_codes import OP12_SQL, op12_part_codes
from chirpstat.llm.quality_rules import OP4_SQL, op4_line_cleaning
from chirpstat.llm.quality_zstd import op8_quality_zstd
from chirpstat.llm.suffix_dedup import op10_suffix_dedup
from chirpstat.llm.token_dac import op1_token_dac
from chirpstat.llm.vector_links import OP13_SQL, op13_vector_links

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_dac": op1_token_dac,
    "op2_langid": op2_langid,
    "op3_decontaminate": op3_decontaminate,
    "op4_line_cleaning": op4_line_cleaning,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_html_main": op6_html_main,
    "op7_mixing": op7_mixing,
    "op8_quality_zstd": op8_quality_zstd,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_centroids": op11_centroids,
    "op12_part_codes": op12_part_codes,
    "op13_vector_links": op13_vector_links,
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_cleaning": OP4_SQL,
    "op11_centroids": OP11_SQL,
    "op12_part_codes": OP12_SQL,
    "op13_vector_links": OP13_SQL,
}
