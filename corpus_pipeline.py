"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again
as the next one's input, so a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.llm import common
from waybill.llm.bpe import bpe_stage
from waybill.llm.decontaminate import decontamination_stage
from waybill.llm.jaccard import jaccard_stage
from waybill.llm.language import language_stage
from waybill.llm.pii import pii_stage

STAGES = [
    ("language", language_stage),
    ("jaccard", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

#: Language ID, PII and BPE cannot be said in SQL: tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.scan(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return docs
