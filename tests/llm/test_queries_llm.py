"""The registered queries and the pipeline."""

from __future__ import annotations

from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brookmart.llm.common import stored
from brookmart.llm.language import labelled
from brookmart.llm.queries import ORACLES, QUERIES
from check import compare, connect


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, sf_dir, QUERIES, ORACLES).startswith("ok")


CONTRACT = {
    "op1": "doc_id n_lines n_dropped kept_sha256", "op2": "query_id rank vec_id score",
    "op4": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op5": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op6": "doc_id size source_size target taken", "op7": "doc_id piece start length ids_crc32 sequence_id offset",
    "op8": "doc_id fingerprint component_id", "op9": "doc_id held_out lang_pred score",
    "op10": "doc_id size text_crc32 law shard slot grown_shard",
    "op11": "doc_id n_a n_b n_groups n_links groups_sha256 n_best count_sum", "op12": "lang rank phrase a l r n score",
    "op13": "doc_id n_tokens ids_sha256 decoded_sha256"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns(spark, sf_dir, name):
    columns = CONTRACT.get(name.split("_")[0], "").split()
    assert QUERIES[name](spark, sf_dir).columns[:len(columns)] == columns


def test_pipeline_stage_by_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages, rows = dict(corpus_pipeline.STAGES), lambda df: [(r.doc_id, r.text) for r in df.collect()]
    assert list(stages) == ["language_id", "line_dedup", "simhash_near_dedup", "mixing", "best_fit_packing"]

    first = stored(stages["language_id"](spark, docs, sf_dir), "t1")
    verdict = {r.doc_id: (r.lang_pred, r.score) for r in labelled(docs, [F.col("doc_id")]).select("row.doc_id", "lang_pred", "score").collect()}
    assert {d for d, _ in rows(first)} == {d for d, (lang, score) in verdict.items() if lang != "und" and score >= 0.5}

    second = stored(stages["line_dedup"](spark, first, sf_dir), "t2")
    want = Counter()
    before = rows(first)
    for (d, t), flags in zip(before, brute.kept_lines(before)):
        text = "\n".join(x for x, keep in zip(t.split("\n"), flags) if keep)
        if all(flags) or brute.WORDS.search(text):
            want[(d, text)] += 1
    assert Counter(rows(second)) == want

    third = stored(stages["simhash_near_dedup"](spark, second, sf_dir), "t3")
    before = rows(second)
    roots = brute.components([(d, brute.fingerprint(t)) for d, t in before])
    assert Counter(rows(third)) == Counter((d, t) for (d, t), c in zip(before, roots) if d == c)

    fourth = stored(stages["mixing"](spark, third, sf_dir), "t4")
    size, taken, most = Counter(), Counter(), Counter(r.doc_id for r in fourth.collect())
    for frame, total in ((third, size), (fourth, taken)):
        for r in frame.collect():
            total[r.source] += len(brute.WORDS.findall(r.text))
    for source, target in brute.mix_targets(dict(size)).items():
        assert 0 <= target - taken[source] < 0.02 * target + 1
    assert set(rows(fourth)) <= set(rows(third)) and max(most.values()) <= 3
    assert docs.columns == first.columns == second.columns == third.columns == fourth.columns

    last = stages["best_fit_packing"](spark, fourth, sf_dir)
    assert Counter(r.doc_id for r in last.where("piece = 0").collect()) == most
    assert corpus_pipeline.run(spark, sf_dir).count() == last.count()


def test_pipeline_over_odd_documents(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), "odd")
    assert docs.count() > 0
    docs = odd.where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), "none")
    assert docs.count() == 0
