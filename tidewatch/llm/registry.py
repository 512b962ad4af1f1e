"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.decontaminate import OP11_SQL, op11_decontaminate
from tidewatch.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from tidewatch.llm.jaccard_join import op9_jaccard_join
from tidewatch.llm.language_id import op10_language_id
from tidewatch.llm.lm_scoring import op7_lm_scoring
from tidewatch.llm.mix import OP1_SQL, op1_mix
from tidewatch.llm.neighbours import op8_neighbours
from tidewatch.llm.quality_model import op4_quality_model
from tidewatch.llm.quality_rules import OP5_SQL, op5_quality_rules
from tidewatch.llm.sentencepiece_codec import op3_sentencepiece
from tidewatch.llm.url_filter import OP2_SQL, op2_url_filters
from tidewatch.llm.warc import OP6_SQL, op6_warc
from tidewatch.llm.whitening import op13_whitening

QUERIES = (
    op1_mix,
    op2_url_filters,
    op3_sentencepiece,
    op4_quality_model,
    op5_quality_rules,
    op6_warc,
    op7_lm_scoring,
    op8_neighbours,
    op9_jaccard_join,
    op10_language_id,
    op11_decontaminate,
    op12_hard_negatives,
    op13_whitening,
)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**{query.__name__: query for query in QUERIES}, "pipeline": corpus_pipeline.run}


def llm_oracles() -> dict[str, str]:
    return {
        "op1_mix": OP1_SQL,
        "op2_url_filters": OP2_SQL,
        "op5_quality_rules": OP5_SQL,
        "op6_warc": OP6_SQL,
        "op11_decontaminate": OP11_SQL,
        "op12_hard_negatives": OP12_SQL,
    }
