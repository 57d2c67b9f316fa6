"""SentencePiece encoding with spans, against the library."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from brookmart.llm import pieces
from brookmart.llm.queries import op13_sentencepiece

LETTERS = " \u2581a\u00e9\u65e5\U0001f600\n\t.,thein\u3000 Z\ufb01\u2460"
SOME = ["", "  ", "a", " a  b ", "\u2581", "x\u2581y \u2581 z", "<s></s><unk><0x41>", "\u65e5\u672c\u8a9e \u30c6\u30b9\u30c8", "\x00a\x01", "\t\n x\r\n", "\ufb01\u2460\uff21",
        "\U0001f1e9\U0001f1ea \U0001f468\u200d\U0001f469", "word " * 3000, "y" * 20000]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    return SOME + ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(30))) for _ in range(1500)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


def test_ids_and_spans(texts, library):
    own = pieces.PieceModel(pieces.model_path())
    assert own.divisible and own.plain
    for text, (ids, starts, stops) in zip(texts, own.encode(texts)):
        want = library.encode(text, return_type="proto").pieces
        offsets = np.cumsum([0, *(len(c.encode()) for c in text)])
        assert ids.tolist() == [p.id for p in want]
        assert starts.tolist() == offsets[[p.begin for p in want]].tolist() and stops.tolist() == offsets[[p.end for p in want]].tolist()


def test_chunks_are_forgotten(texts, library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_CHUNKS", 50)
    own = pieces.PieceModel(pieces.model_path())
    for text in texts:
        assert next(own.encode([text]))[0].tolist() == library.encode(text)


@pytest.mark.parametrize("dummy,remove,escape", [(True, True, True), (True, False, True), (False, True, False), (False, False, False)])
def test_compiled_character_map(texts, dummy, remove, escape):
    """A real compiled map: normalised text and the source of every character as the library gives them."""
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=dummy, remove_extra_whitespaces=remove, escape_whitespaces=escape)
    spec = dict(pieces.fields(dict(pieces.fields(library.serialized_model_proto()))[pieces.NORMALIZER]))
    rules = pieces.character_map(spec[pieces.CHARSMAP])
    assert len(rules) > 1000 and rules["\ufb01"] == "fi"
    own = pieces.Normaliser(rules, [], dummy, remove, escape)
    for text in texts[:800]:
        want, source = library.normalize(text, with_offsets=True)
        offsets = np.cumsum([0, *(len(c.encode()) for c in text)])
        got, bytes_of = own(text)
        assert got == want and bytes_of.tolist() == offsets[list(source)].tolist()


def test_symbols_stand_as_they_are():
    own = pieces.Normaliser({"a": "b", "ab": "c"}, ["<ab>"], dummy=False, remove_extra=False)
    assert own("a ab <ab>")[0] == "b\u2581c\u2581<ab>"


def test_query(spark, sf_dir, library):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = Counter()
    for d, t in rows:
        ids = [*library.encode(t), library.eos_id()]
        want[(d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))] += 1
    assert Counter(tuple(r) for r in op13_sentencepiece(spark, sf_dir).collect()) == want


def test_odd_rows(odd, library):
    rows = {}
    for r in pieces.encoded(odd).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert rows[3][0].ids == rows[4][0].ids == [library.eos_id()] and rows[3][0].decoded == ""
    assert len(rows[2]) == len(rows[None]) == 2 and rows[2][0] == rows[2][1]
    assert rows[4][0].starts == rows[4][0].stops == [0]
    assert pieces.encoded(odd.where("false")).count() == 0
