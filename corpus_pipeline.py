"""Corpus pipeline: the training-data stages in order, each stored before the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame with the
columns of ``documents``; the last one returns the bins of the documents that
are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnlake.llm.common import read_table, ready, store
from txnlake.llm.decontam import decontaminate_stage
from txnlake.llm.line_dedup import line_dedup_stage
from txnlake.llm.minhash import near_dedup_stage
from txnlake.llm.packing import pack_stage
from txnlake.llm.toxicity import drop_toxic

STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontaminate_stage),
    ("packing", pack_stage),
]

#: A trained score, signatures and best-fit bins can't be said in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result is written and read again."""
    ready(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
