"""JDBC queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brookmart.functions.text import camel_case


def read_query(spark: SparkSession, url: str, sql: str, to_camel: bool = False, **options: str) -> DataFrame:
    """The result of a database query, columns optionally renamed snake → camel.

    Large results need the reader's ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` options, else one task reads everything; they go with ``dbtable``, so the
    query becomes a derived table then.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if "partitionColumn" in options:
        reader = reader.option("dbtable", f"({sql}) AS q")
    else:
        reader = reader.option("query", sql)
    df = reader.load()
    return camel_columns(df) if to_camel else df


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel_case(c) for c in df.columns])
