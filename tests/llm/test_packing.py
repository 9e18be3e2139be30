"""Packing: ids equal the tokenizer library's; every id in one piece; windows near full."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from carelake.llm import packing as P
from carelake.llm.queries import queries
from tests.llm.helpers import docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_library(library):
    rng = random.Random(2)
    parts = list("abcXYZ 012'!,.\n\t éß漢🙂") + ["'s", "'ll", "  ", "<|endoftext|>", "\r\n", "　", "\x85", "\x1c", "²"]
    texts = ["", " ", "a" * 5000, " " * 900, "\n" * 70] + ["".join(rng.choices(parts, k=rng.randint(1, 50))) for _ in range(2000)]
    encoders = P.byte_bpe(PATH, public_tokenizers.PATTERN)
    for t in texts:
        assert P.token_ids(t, encoders).tolist() == library.encode(t, add_special_tokens=False).ids


def test_differencing_small():
    assert sorted(map(sorted, P.difference([8, 7, 6, 5, 4], 2))) in ([[0, 2], [1, 3, 4]], [[0, 3], [1, 2, 4]], [[0, 1], [2, 3, 4]], [[0, 4], [1, 2, 3]], [[0, 3, 4], [1, 2]], [[0, 2], [1, 3, 4]])
    sums = [sum([8, 7, 6, 5, 4][i] for i in p) for p in P.difference([8, 7, 6, 5, 4], 2)]
    assert abs(sums[0] - sums[1]) <= 2
    assert P.difference([5], 3) == [[0]] and P.difference([], 3) == []


def test_window_count_rises_with_capacity():
    assert len(P.pack_block([600, 600, 600], 1024)) == 3
    rng = random.Random(1)
    lengths = [rng.randint(1, 128) for _ in range(1500)]
    parts = P.pack_block(lengths, 1024)
    assert sorted(i for p in parts for i in p) == list(range(1500))
    assert max(sum(lengths[i] for i in p) for p in parts) <= 1024
    assert len(parts) <= sum(lengths) / 1024 * 1.05 + 1


def check(rows, texts, library):
    """rows of the query; texts: (doc_id, text) in any order, ids unique."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d, t in texts:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        at = 0
        for r in sorted(by_doc.pop(d), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not by_doc
    for own in by_seq.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    return sum(r.length for r in rows) / (1024 * len(by_seq)) if by_seq else 1


def test_query_packs_every_id_once(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = queries()["op2_packing"](spark, sf).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert check(rows, texts, library) > 0.95


def test_edges(spark, library):
    rows = [(1, None), (2, ""), (3, "x " * 5000), (None, "same"), (5, "same")]
    frame = docs(spark, rows).selectExpr("*", "1 as piece", "2 as block", "'s' as start", "3 as sequence_id")
    got = P.pack(frame, PATH, public_tokenizers.PATTERN)
    assert got.columns == ["doc_id", "lang", "source", "n_chars", "piece", "block",
                           "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    check(got.collect(), rows, library)
    assert P.pack(docs(spark, []), PATH, public_tokenizers.PATTERN).count() == 0
    again = P.pack(docs(spark, [(1, "a b"), (1, "a b"), (None, "a b")]), PATH, public_tokenizers.PATTERN).collect()
    assert len(again) == 3 and sorted(r.offset for r in again) == [0, 3, 6]


def test_added_tokens_as_in_the_library(spark):
    """The library in its default setting takes added tokens out of the text."""
    default = Tokenizer.from_file(PATH)
    rng = random.Random(4)
    parts = ["<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "a", "é", "'s", " word", "1"]
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "<|endoftext|><|endoftext|>"] + ["".join(rng.choices(parts, k=rng.randint(1, 20))) for _ in range(500)]
    encoders, added = P.byte_bpe(PATH, public_tokenizers.PATTERN), P.added_tokens(PATH)
    for t in texts:
        assert P.token_ids(t, encoders, added).tolist() == default.encode(t, add_special_tokens=False).ids
    assert 50256 in P.token_ids(texts[0], encoders, added)
    rows = list(enumerate(texts[:40]))
    check(P.pack(docs(spark, rows), PATH, public_tokenizers.PATTERN, carry=["doc_id"]).collect(), rows, default)
