"""Corpus pipeline: the stages that turn raw documents into token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run`
writes it as Parquet in the shared scratch folder and rereads it as the next
stage's docs. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import op1_substring_dedup as op1
from eventlake.llm import op4_jaccard_join as op4
from eventlake.llm import op5_language as op5
from eventlake.llm import op8_bpe as op8
from eventlake.llm import op10_decontaminate as op10
from eventlake.session import scratch_dir

STAGES = [
    ("language", op5.stage),
    ("near_duplicates", op4.stage),
    ("substring_dedup", op1.stage),
    ("decontamination", op10.stage),
    ("bpe", op8.stage),
]

#: no SQL expresses the trained and automaton stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        at = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
