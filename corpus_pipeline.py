"""The corpus pipeline: quality rules, toxicity, line deduplication, near-duplicate removal, packing.

Each stage gets the documents that its predecessor kept, and all but the last return documents. run() writes each stage's result as
Parquet into the folder that the executors share and reads it again, so that a lost executor never costs an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import op2_order_minhash, op3_toxicity, op6_rule_ledger, op7_retrieval_packing, op10_line_frequency
from millrace.llm.common import stored, table

STAGES = [
    ("quality_rules", op6_rule_ledger.stage),
    ("toxicity", op3_toxicity.stage),
    ("line_dedup", op10_line_frequency.stage),
    ("near_dedup", op2_order_minhash.stage),
    ("packing", op7_retrieval_packing.stage),
]

#: SQL can express neither the learned grammar, nor the sketches and their verification, nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
