"""One query per operator over its whole table, and the same answer in DuckDB SQL where SQL can give it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart.llm.alignment import aligned_counts
from brookmart.llm.common import table
from brookmart.llm.language import identified
from brookmart.llm.line_dedup import dedup_lines
from brookmart.llm.materialise import materialised
from brookmart.llm.mixing import mix
from brookmart.llm.neighbours import nearest
from brookmart.llm.packing import pack
from brookmart.llm.phrases import collocations
from brookmart.llm.pieces import encoded
from brookmart.llm.quality import judged
from brookmart.llm.sharding import assign
from brookmart.llm.simhash import near_duplicates
from brookmart.llm.substrings import repeated_strings


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialised(table(spark, sf_dir, "documents"))


def op4_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_strings(table(spark, sf_dir, "documents")).drop("spans")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("text_hash")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents")).drop("vslot")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_counts(table(spark, sf_dir, "documents"))[0]


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encoded(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_nearest": op2_nearest,
    "op3_training_order": op3_training_order,
    "op4_suffix_arrays": op4_suffix_arrays,
    "op5_quality_rules": op5_quality_rules,
    "op6_mixing": op6_mixing,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_simhash": op8_simhash,
    "op9_language_id": op9_language_id,
    "op10_sharding": op10_sharding,
    "op11_alignment": op11_alignment,
    "op12_collocations": op12_collocations,
    "op13_sentencepiece": op13_sentencepiece,
}

ORACLES: dict[str, str] = {
    "op1_line_dedup": """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
firsts AS (SELECT k, min(doc_id) AS first_id FROM keyed WHERE length(k) >= 10 GROUP BY k),
marked AS (SELECT x.*, coalesce(x.doc_id > f.first_id, false) AS gone FROM keyed x LEFT JOIN firsts f ON x.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op12_collocations": r"""
WITH texts AS (SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT d, lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM texts),
listed AS (SELECT row_number() OVER () AS id, lang, regexp_extract_all(p, '[^ \x09]+') AS w FROM pieces),
grams AS (SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (
  SELECT lang, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM listed, (SELECT unnest(range(1, 5)) AS n) WHERE len(w) >= n)),
counts AS (SELECT lang, n AS k, phrase, count(*) AS f FROM grams GROUP BY ALL),
sizes AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM counts WHERE k > 1 AND f >= 30),
cuts AS (SELECT lang, phrase, k, f, unnest(range(1, k)) AS c, string_split(phrase, ' ') AS w FROM cand),
scored AS (SELECT x.lang, x.phrase, x.f AS a, c, y.f AS l, z.f AS r,
    CAST(CAST(2000000 AS HUGEINT) * x.f // (CAST(y.f AS HUGEINT) + z.f) AS BIGINT) AS score
  FROM cuts x JOIN counts y ON y.lang = x.lang AND y.phrase = array_to_string(w[:c], ' ')
  JOIN counts z ON z.lang = x.lang AND z.phrase = array_to_string(w[c + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
free AS (SELECT * FROM lowest x WHERE NOT EXISTS (
  SELECT 1 FROM cand y WHERE y.lang = x.lang AND y.phrase <> x.phrase AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ') AND 100 * y.f >= 80 * x.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""",
}
