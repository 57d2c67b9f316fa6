"""The corpus pipeline: language ID, line dedup, near-dedup, mixing and packing, one after the other over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each as Parquet below the shared folder and reads
it again, so that a stage starts from a table. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brookmart.llm.common import stored
from brookmart.llm.language import accepted
from brookmart.llm.line_dedup import without_repeated_lines
from brookmart.llm.mixing import mixed_documents
from brookmart.llm.packing import pack
from brookmart.llm.simhash import one_of_each


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter and texts whose language stays doubtful (score under one half) go; ``lang`` is left as it was."""
    return accepted(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document has go, and documents of which no word is left."""
    return without_repeated_lines(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays: three-word shingles, at most three bits apart, as in op8."""
    return one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's budget takes it."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in the sequences."""
    return pack(docs)


STAGES = [("language_id", language), ("line_dedup", lines), ("simhash_near_dedup", near), ("mixing", mixture), ("best_fit_packing", packed)]

# a recurrent network and XXH64 fingerprints are out of SQL's reach
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
