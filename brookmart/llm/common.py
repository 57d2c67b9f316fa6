"""Pieces that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart.session import fresh_dir

WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back.

    The plan behind it runs once, and a lost executor costs a reread instead of a recomputation.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of maximal runs without ASCII white space; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(text, UPPER, LOWER)


def ordered_id(doc_id: Column) -> Column:
    """The id as an order key: a missing id comes after every other."""
    return F.coalesce(doc_id.cast("long"), F.lit(2**63 - 1))
