"""From raw documents to token files: rules, near-duplicates, decontamination, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as the next one's
documents. All but the last return the columns that they were given.
"""

from pyspark.sql import DataFrame, SparkSession

from cartoloom.llm import common, decontaminate, minhash, mixing, quality_rules, token_files

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("near_duplicates", minhash.stage),
    ("decontamination", decontaminate.stage),
    ("mixing", mixing.stage),
    ("token_files", token_files.stage),
]

#: Near-duplicates by signatures and tokens have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
