"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from greenlane.llm import archives, decontam, neardup, repair, urls
from greenlane.llm.archives import op8_warc
from greenlane.llm.decontam import op10_decontamination
from greenlane.llm.gam import op5_quality_gam
from greenlane.llm.lm import op7_lm_scores
from greenlane.llm.neardup import op4_near_duplicates
from greenlane.llm.periods import op12_periodic_runs
from greenlane.llm.pieces import op3_sentencepiece
from greenlane.llm.pii import op2_pii
from greenlane.llm.repair import op11_conversation_repair
from greenlane.llm.rules import op6_quality_rules
from greenlane.llm.secrets import op1_secret_scan
from greenlane.llm.tokenbin import op13_token_shards
from greenlane.llm.urls import op9_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_secret_scan, op2_pii, op3_sentencepiece, op4_near_duplicates, op5_quality_gam, op6_quality_rules, op7_lm_scores, op8_warc, op9_url_filter, op10_decontamination,
    op11_conversation_repair, op12_periodic_runs, op13_token_shards,
)}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
ORACLE: dict[str, str] = {
    "op4_near_duplicates": neardup.ORACLE_SQL,
    "op8_warc": archives.ORACLE_SQL,
    "op9_url_filter": urls.ORACLE_SQL,
    "op10_decontamination": decontam.ORACLE_SQL,
    "op11_conversation_repair": repair.ORACLE_SQL,
}
