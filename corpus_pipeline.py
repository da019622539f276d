"""The training-data pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; its result is written as Parquet to the shared folder and read
again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from varlake.llm.common import stored
from varlake.llm.queries import drop_near_duplicates, drop_repeated_lines, keep_clean, pack

#: Quality classifier (op9), line dedup (op10), SimHash near-dedup (op7), best-fit packing (op4).
STAGES = [
    ("quality", keep_clean),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("packing", pack),
]

#: SQL can express none of the four; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
