"""Registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from functools import wraps

from tracewarden.llm.collocations import OP12_SQL, op12_collocations
from tracewarden.llm.common import bounded_batches
from tracewarden.llm.decontamination import op1_decontamination
from tracewarden.llm.exact_dedup import OP11_SQL, op11_exact_dedup
from tracewarden.llm.language_model import op5_language_model
from tracewarden.llm.near_dedup import op7_near_dedup
from tracewarden.llm.packing import op6_packing
from tracewarden.llm.personal_data import op10_personal_data
from tracewarden.llm.quality_classifier import op4_quality_classifier
from tracewarden.llm.quality_rules import op9_quality_rules
from tracewarden.llm.sharding import op2_sharding
from tracewarden.llm.substring_dedup import op8_substring_dedup
from tracewarden.llm.token_alignment import op13_token_alignment
from tracewarden.llm.warc import OP3_SQL, op3_warc



def _bounded(query):
    @wraps(query)
    def run(spark, folder):
        bounded_batches(spark)
        return query(spark, folder)

    return run


QUERIES = {
    query.__name__: _bounded(query)
    for query in (
        op1_decontamination,
        op2_sharding,
        op3_warc,
        op4_quality_classifier,
        op5_language_model,
        op6_packing,
        op7_near_dedup,
        op8_substring_dedup,
        op9_quality_rules,
        op10_personal_data,
        op11_exact_dedup,
        op12_collocations,
        op13_token_alignment,
    )
}

ORACLE: dict[str, str] = {"op3_warc": OP3_SQL, "op11_exact_dedup": OP11_SQL, "op12_collocations": OP12_SQL}
