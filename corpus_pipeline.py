"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

Edge cases: rows of null or blank text pass all stages but the last, which takes no words of them. Null ids: toxicity
judges each row, line dedup takes all of them for one document that comes first, near dedup keeps them, decontamination
drops them together. Rows that repeat an id are toxic each for itself, one document whose equal line numbers keep each other in
line dedup, one node in near dedup, and stand or fall together in decontamination. Ties: the smaller id stays. Without
labels nothing is toxic; empty tables give no rows. Extra columns are kept, whatever their names, but for those that
the last stage adds (size, source_size, target, taken, finish).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strandweave.llm.common import scratch_dir, table
from strandweave.llm.decontam import decontamination_stage
from strandweave.llm.line_dedup import line_dedup_stage
from strandweave.llm.mixing import mix_corpus
from strandweave.llm.near_dedup import near_dedup_stage
from strandweave.llm.toxicity import toxicity_stage

STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mix_corpus),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; stages before the last are written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    at = f"{scratch_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs.write.parquet(f"{at}/{k}")
            docs = spark.read.parquet(f"{at}/{k}")
    return docs


#: Trained models and tilings are not SQL; the whole pipeline is tested against a brute-force version of its stages.
ORACLE_SQL = None
