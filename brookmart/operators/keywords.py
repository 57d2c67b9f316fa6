"""Keyword splitting."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runs of letters or of digits.
WORD = r"\p{L}+|\p{N}+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), 1)


def explode_words(df: DataFrame, text: str, alias: str = "keyword") -> DataFrame:
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.explode(words(F.col(text))).alias(alias))


def register_word_function(spark: SparkSession, name: str = "split_words") -> None:
    """A temporary SQL table function: ``FROM t, LATERAL split_words(t.item) AS w(word)``."""
    pattern = f"({WORD})".replace("\\", "\\\\")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(phrase STRING) RETURNS TABLE (word STRING)
        RETURN SELECT explode(regexp_extract_all(lower(phrase), '{pattern}', 1))""")


def dictionary_splitter(dictionary: list[str], max_words: int = 1_000_000):
    """An Arrow-batched column function: CJK runs are cut by longest match in ``dictionary``.

    Characters that start no listed word stand alone; other runs are words as in ``words``. The
    dictionary is shipped with the function, so its size is checked.
    """
    if len(dictionary) > max_words:
        raise ValueError(f"dictionary has {len(dictionary)} words, more than {max_words}")
    listed = frozenset(w.lower() for w in dictionary)
    longest = max((len(w) for w in listed), default=1)

    @F.pandas_udf("array<string>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import regex

        runs = regex.compile(r"\p{Han}+|[\p{L}--\p{Han}]+|\p{N}+", regex.V1)

        def cut(run: str) -> Iterator[str]:
            at = 0
            while at < len(run):
                size = next((n for n in range(min(longest, len(run) - at), 1, -1) if run[at:at + n] in listed), 1)
                yield run[at:at + size]
                at += size

        def phrase_words(phrase: str | None) -> list[str] | None:
            if phrase is None:
                return None
            out: list[str] = []
            for run in runs.findall(phrase.lower()):
                out.extend(cut(run) if regex.match(r"\p{Han}", run) else [run])
            return out

        for batch in batches:
            yield batch.map(phrase_words)

    return split
