"""Encoder and decoder against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from carelake.llm import piece_codec as C
from carelake.llm.queries import queries
from tests.llm.helpers import docs

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = list("abcdefghijklmnopqrstuvwxyzAB 0123456789'!,.\n\t()-_#") + [
    "é", "ß", "漢", "🙂", "　", "́", "▁", "▁▁", "  ", "     ", "\r\n", "the", "ing", "tion", "\x00", "क", "ि", " th", "<s>", "<0x41>", "﻿"]


@pytest.fixture(scope="module")
def both():
    return C.load_model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_encode_equals_library(both):
    ours, library = both
    rng = random.Random(7)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(8000)]
    texts += ["", " ", "a" * 9000, " " * 3001 + "x", "ab" * 5000, "\n" * 500, "thes" * 800]
    for t in texts:
        ids = np.frombuffer(ours.encode(t), "<i4").tolist()
        assert ids == library.encode(t), t
        assert ours.decode(ids) == library.decode(ids), t
    for t in texts[:1500]:  # as one part, without cutting
        if t:
            whole = C.BLANK + t.replace(" ", C.BLANK)
            assert np.frombuffer(ours._part_ids(whole), "<i4").tolist() == library.encode(t)


def test_compatible_is_remerging(both):
    ours, _ = both
    rng = random.Random(8)
    whole = sorted(p for p in ours.halves)
    for _ in range(20000):
        pair = rng.choice(whole), rng.choice(whole)
        assert ours._compatible(pair) == (ours.merge(pair[0] + pair[1]) == list(pair)), pair


def test_decode_equals_library(both):
    ours, library = both
    rng = random.Random(9)
    for _ in range(4000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(3, 259) for _ in range(rng.randint(0, 9))]
        assert ours.decode(ids) == library.decode(ids), ids


def test_query(spark, both):
    _, library = both
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in queries()["op5_sentencepiece"](spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r.text or "") + [2]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert tuple(got[r.doc_id])[1:] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))


def test_edges(spark):
    frame = docs(spark, [(1, None), (1, None), (None, ""), (2, "x " * 20000)]).selectExpr("*", "1 as ids", "'d' as decoded")
    out = C.decode(C.encode(frame, PATH), PATH)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "decoded"]
    assert sorted((r.doc_id or 0, len(r.ids), r.decoded == (r.text or "")) for r in out.collect()) == [(0, 1, True), (1, 1, True), (1, 1, True), (2, 20002, True)]
    assert C.encode(docs(spark, []), PATH).count() == 0
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in C.decode(nulls, PATH).collect()] == ["", ""]
