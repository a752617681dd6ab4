"""A training-data pipeline over documents: quality, near-duplicates, repeated strings, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; run() writes each stage's
result as Parquet in the shared folder and rereads it as the next one's docs. The last stage has no SQL form
(nor have the first three), hence ORACLE_SQL is None; tests compare the second and third stage with plain
versions over all pairs of texts and all windows, the first with its own scores, and the last by its ids and offsets.

Defined cases: null texts count as empty; rows without a doc_id pass the stages that compare documents; an empty table
gives no rows; what each stage does with repeated rows stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gavelframe.llm.common import materialize, table
from gavelframe.llm.near_dedup import near_dedup_stage
from gavelframe.llm.packing import packing_stage
from gavelframe.llm.quality import quality_stage
from gavelframe.llm.repeats import repeats_stage

STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("repeats", repeats_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
