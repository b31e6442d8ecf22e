"""The numbered queries and their SQL, for the driver."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetwatt.llm.common import importable
from fleetwatt.llm.conversations import OP13_SQL, op13_conversation_repair
from fleetwatt.llm.decontamination import OP1_SQL, op1_decontamination
from fleetwatt.llm.language_id import op10_language_id
from fleetwatt.llm.lm_scoring import op9_lm_scoring
from fleetwatt.llm.merkle import OP11_SQL, op11_merkle_manifest
from fleetwatt.llm.nearest import op7_nearest
from fleetwatt.llm.ngram_join import op2_ngram_join
from fleetwatt.llm.packing import op4_packing
from fleetwatt.llm.passages import OP12_SQL, op12_passages
from fleetwatt.llm.pii import op3_pii
from fleetwatt.llm.quality import op6_quality_classifier
from fleetwatt.llm.repeats import op8_repeats
from fleetwatt.llm.secrets import op5_secret_scan

Query = Callable[[SparkSession, str], DataFrame]


def ready(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: ready(query)
    for query in (
        op1_decontamination,
        op2_ngram_join,
        op3_pii,
        op4_packing,
        op5_secret_scan,
        op6_quality_classifier,
        op7_nearest,
        op8_repeats,
        op9_lm_scoring,
        op10_language_id,
        op11_merkle_manifest,
        op12_passages,
        op13_conversation_repair,
    )
}

ORACLES: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op12_passages": OP12_SQL,
    "op13_conversation_repair": OP13_SQL,
}
