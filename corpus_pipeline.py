"""From raw documents to a mixed training corpus, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm import decontamination, line_dedup, mixing, quality_rules, simhash
from plumbline.llm.common import materialize, table

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("line_dedup", line_dedup.stage),
    ("near_dedup", simhash.stage),
    ("decontamination", decontamination.stage),
    ("mixing", mixing.stage),
]

#: The near-duplicate stage has fingerprints by XXH64 and components, which DuckDB SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
