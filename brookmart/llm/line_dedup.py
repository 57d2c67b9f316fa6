"""Line dedup: range-partitioned hashes, first occurrences streamed, keep bitmaps per document.

Only DataFrame functions. A line's key is the line stripped of ASCII white space with A-Z lower-cased; keys of at least
``min_chars`` code points that occur in two documents keep their lines in the document with the smallest id alone.

Texts are read twice (once for hashes, once to apply the bitmaps) and shuffled once; what is sorted are 128-bit hashes.

Hot lines: rows are ranged by (hash, salt of the document) and each range finds its first document; every later one is
decided there. First documents alone, at most ``spread`` for a hash, meet in the second pass.

Defined results: a null or empty text is one empty line; a null id counts as one document after all others; repeated rows
(same id) are one document and lose the same lines; extra columns, whatever their names, are carried in a struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookmart.llm.common import BLANKS, ascii_lower, ordered_id

SPREAD = 64


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keyed(docs: DataFrame) -> DataFrame:
    """Whole rows in a struct beside the keys that identify a document's text."""
    return docs.select(F.struct("*").alias("row")).select(
        "row", ordered_id(F.col("row.doc_id")).alias("doc"), F.xxhash64("row.text").alias("text_hash"))


def line_hashes(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """One row per line that takes part: document, position and two independent hashes of its key."""
    lines = _keyed(docs).select("doc", "text_hash", F.posexplode(_lines(F.col("row.text"))).alias("pos", "line"))
    keys = lines.withColumn("key", ascii_lower(F.btrim("line", F.lit(BLANKS)))).where(F.char_length("key") >= min_chars)
    return keys.select("doc", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def dropped_lines(docs: DataFrame, min_chars: int = 10, spread: int = SPREAD) -> DataFrame:
    """Positions of the lines that some earlier document has too."""
    hashes = line_hashes(docs, min_chars).withColumn("salt", F.pmod(F.xxhash64("doc", "text_hash"), F.lit(spread)).cast("int"))
    ranged = hashes.repartitionByRange("h1", "h2", "salt")
    near = Window.partitionBy("h1", "h2", "salt").orderBy("doc", "pos")
    local = ranged.withColumn("later", F.col("doc") > F.first("doc").over(near))
    # decided rows stay spread by their salt, first documents meet under one group
    local = local.withColumn("meet", F.when(F.col("later"), F.col("salt")).otherwise(-1))
    far = Window.partitionBy("h1", "h2", "meet").orderBy("doc", "pos")
    return (local.withColumn("first", F.first("doc").over(far))
            .where(F.col("later") | (F.col("doc") > F.col("first"))).select("doc", "text_hash", "pos"))


def drop_bitmaps(docs: DataFrame, min_chars: int = 10, spread: int = SPREAD) -> DataFrame:
    """One row per document that loses lines: ``drops``, the 64-bit words of its bitmap that are not all zero."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("pos", F.lit(64)).cast("int"))
    words = (dropped_lines(docs, min_chars, spread)
             .groupBy("doc", "text_hash", F.floor(F.col("pos") / 64).cast("int").alias("word"))
             .agg(F.bit_or(bit).alias("bits")))
    return words.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("word", "bits")).alias("drops"))


def _positions(drops: Column) -> Column:
    """Line numbers of a bitmap, in no order."""
    ones = lambda w: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(63)), lambda b: F.call_function("getbit", w["bits"], b) == 1),
        lambda b: w["word"] * 64 + b)
    return F.flatten(F.transform(drops, ones))


def dedup_lines(docs: DataFrame, min_chars: int = 10, spread: int = SPREAD) -> DataFrame:
    """Every document with what remains of it.

    Columns: ``row`` (the input's columns), ``n_lines``, ``n_dropped``, ``drops`` (null: nothing goes) and ``kept`` (text).
    """
    # a key that is 0 for every row asks for an exchange of the join's own on both sides, between which Spark splits hot keys
    meet = F.pmod(F.hash("doc"), F.lit(1)).alias("meet")
    bitmaps = drop_bitmaps(docs, min_chars, spread).select("*", meet).hint("shuffle_hash")
    lines = _lines(F.col("row.text"))
    keep = F.array_except(F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), _positions(F.col("drops")))
    return (_keyed(docs).select("*", meet).join(bitmaps, ["doc", "text_hash", "meet"], "left")
            .withColumn("n_lines", F.size(lines).cast("long"))
            .withColumn("n_dropped", F.coalesce(F.aggregate(
                "drops", F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w["bits"])), F.lit(0).cast("long")))
            .withColumn("kept", F.when(F.col("drops").isNull(), F.coalesce("row.text", F.lit("")))
                        .otherwise(F.array_join(F.transform(keep, lambda i: lines[i]), "\n")))
            .select("row", "n_lines", "n_dropped", "drops", "kept"))


def without_repeated_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """The documents with the remaining text; those that lines left without a single word go."""
    columns = [F.col("kept").alias(c) if c == "text" else F.char_length("kept").cast("long").alias(c) if c == "n_chars"
               else F.col("row")[c].alias(c) for c in docs.columns]
    words = F.length(F.btrim("kept", F.lit(BLANKS)))
    return dedup_lines(docs, min_chars).where((F.col("n_dropped") == 0) | (words > 0)).select(*columns)
