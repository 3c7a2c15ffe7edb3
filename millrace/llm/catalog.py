"""The queries of this package, each over its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    op1_bitplanes,
    op2_topk,
    op3_packing,
    op4_chat,
    op5_suffix_dedup,
    op6_seed_extend,
    op7_decontamination,
    op8_url_lists,
    op9_language,
    op10_jaccard_groups,
    op11_collocations,
    op12_quality,
    op13_alignment,
)
from millrace.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


def _ready(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


_MODULES = (
    op1_bitplanes, op2_topk, op3_packing, op4_chat, op5_suffix_dedup, op6_seed_extend,
    op7_decontamination, op8_url_lists, op9_language, op10_jaccard_groups,
    op11_collocations, op12_quality, op13_alignment,
)

QUERIES: dict[str, Query] = {m.__name__.rpartition(".")[2]: _ready(m.query) for m in _MODULES}

# The others are beyond SQL at this size (whole texts by windows) or at all (tokenizers, models,
# components); tests compare them with brute force.
SQL: dict[str, str] = {
    "op2_topk": op2_topk.ORACLE_SQL,
    "op7_decontamination": op7_decontamination.ORACLE_SQL,
    "op8_url_lists": op8_url_lists.ORACLE_SQL,
    "op11_collocations": op11_collocations.ORACLE_SQL,
}
