"""A phrase that many documents hold in different surroundings."""

from __future__ import annotations

from collections import Counter

import brute
import pytest

from brookmart.llm import substrings


@pytest.mark.parametrize("phrase", ["a phrase of twenty-five b", "one phrase of forty-four bytes in every third"])
def test_hot_seed_is_not_one_group(spark, pairs, bag, monkeypatch, phrase):
    texts = [f"{i * 7919:06d} starts {i % 5} here {phrase} then {i % 3} goes on {i * 104729:08d}" for i in range(150)] + [phrase, phrase * 4]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (None, texts[8])], "doc_id long, text string").repartition(5)
    rows = pairs(frame)
    want = Counter((d, *r) for (d, _), r in zip(rows, brute.removed_bytes(rows)))
    largest = []
    settled = substrings._settled

    def watched(length, seed):
        one = settled(length, seed)

        def watch(group):
            if group.num_rows > 20 and max(Counter(group.column("h").to_pylist()).values()) > 20:
                raise AssertionError("a whole seed in one group")
            return one(group)

        largest.append(1)
        return watch

    monkeypatch.setattr(substrings, "_settled", watched)
    monkeypatch.setattr(substrings, "HOT", 20, raising=False)
    assert bag(substrings.repeated_strings(frame).drop("spans")) == want
    assert largest


def test_halves_of_a_hot_seed(spark, pairs, bag, monkeypatch):
    """A seed of many suffixes takes no row for each string where no string is that frequent."""
    phrase = "a phrase of twenty-five b"
    texts = [f"{i * 7919:06d} {i % 40:02d} starts {phrase} goes on {i % 30:02d} {i * 104729:08d}" for i in range(150)] + [phrase, None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    rows = pairs(frame)
    want = Counter((d, *r) for (d, _), r in zip(rows, brute.removed_bytes(rows)))
    names, stored = [], substrings.stored
    monkeypatch.setattr(substrings, "stored", lambda df, name: names.append(name) or stored(df, name))
    monkeypatch.setattr(substrings, "HOT", 20)
    assert bag(substrings.repeated_strings(frame).drop("spans")) == want
    assert "suffix-hot" in names and "suffix-least" not in names


def test_hot_passage_is_decided_by_halves(spark, pairs, bag, monkeypatch):
    """A passage in every text: a row for each half that it fills, not one for each of its strings, and no join on strings."""
    phrase = "a passage of seventy-two bytes stands in each text, behind another start"
    texts = [f"{i * 7919:06d} {i % 40:02d} {phrase} {i % 30:02d} {i * 104729:08d}" for i in range(150)]
    texts += [phrase, phrase[:-1], phrase[1:], phrase * 3, None, phrase[:49], f"{phrase}{texts[3]}"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, texts[90]), (None, texts[8])], "doc_id long, text string").repartition(5)
    rows = pairs(frame)
    want = Counter((d, *r) for (d, _), r in zip(rows, brute.removed_bytes(rows)))
    written, stored = [], substrings.stored

    def watched(df, name):
        out = stored(df, name)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(substrings, "stored", watched)
    monkeypatch.setattr(substrings, "HOT", 20)
    assert bag(substrings.repeated_strings(frame).drop("spans")) == want
    seeds = sum(n for name, n in written if name == "suffix-hot")
    assert seeds and "suffix-least" not in dict(written)
    assert max(n for name, n in written if name == "suffix-halves") <= 2 * seeds
