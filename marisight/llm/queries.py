"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marisight.llm.curve_packing import op11_curve_packing
from marisight.llm.extendible_sharding import OP4_SQL, op4_extendible_sharding
from marisight.llm.geometric_blocks import OP13_SQL, op13_geometric_blocks
from marisight.llm.jaccard_join import op3_jaccard_join
from marisight.llm.maxscore import OP5_SQL, op5_maxscore
from marisight.llm.media_columns import op7_media_columns
from marisight.llm.oracle_sql import OP1_SQL, OP3_SQL
from marisight.llm.page_differencing import op6_page_differencing
from marisight.llm.ppm_scoring import op10_ppm_scoring
from marisight.llm.quality_fm import op2_quality_fm
from marisight.llm.sentencepiece_codec import op9_sentencepiece
from marisight.llm.source_mixing import op8_source_mixing
from marisight.llm.substring_dedup import op1_substring_dedup
from marisight.llm.vector_whitening import op12_vector_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op10_ppm_scoring": op10_ppm_scoring,
    "op11_curve_packing": op11_curve_packing,
    "op12_vector_whitening": op12_vector_whitening,
    "op13_geometric_blocks": op13_geometric_blocks,
    "op2_quality_fm": op2_quality_fm,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_extendible_sharding": op4_extendible_sharding,
    "op5_maxscore": op5_maxscore,
    "op6_page_differencing": op6_page_differencing,
    "op7_media_columns": op7_media_columns,
    "op8_source_mixing": op8_source_mixing,
    "op9_sentencepiece": op9_sentencepiece,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op13_geometric_blocks": OP13_SQL,
    "op3_jaccard_join": OP3_SQL,
    "op4_extendible_sharding": OP4_SQL,
    "op5_maxscore": OP5_SQL,
}
