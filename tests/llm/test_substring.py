"""Substring dedup against a plain window count."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from carelake.llm import substring_dedup as S
from carelake.llm.queries import queries
from tests.llm.helpers import compare, docs, write_tables


def plain(texts, window=35):
    """(n_words, n_removed, kept) by text."""
    words = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for t in texts]
    count = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def corpus(seed, n=120, vocab=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)]
    passages = [[rng.choice(words) for _ in range(rng.choice([34, 35, 36, 50, 90]))] for _ in range(6)]
    texts = []
    for _ in range(n):
        t = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            a = rng.randint(0, 3)
            t[rng.randint(0, len(t)):0] = p[a:]
        texts.append(rng.choice([" ", "\n", "\t "]).join(t))
    texts += [texts[3], texts[5], "a " * 200, "b " * 34 + "c", "a " * 36, None, "", " \n", "x y " * 60, texts[0] + " tail"]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain(spark, monkeypatch, seed):
    monkeypatch.setattr(S, "CHUNK_BYTES", 3000)  # several chunks and buckets
    texts = corpus(seed)
    frame = docs(spark, [(i, t) for i, t in enumerate(texts)]).selectExpr("*", "1 as chunk", "2 as n_words", "'k' as kept", "0 as size")
    got = {r.doc_id: r for r in S.remove_repeats(frame).selectExpr("_row.doc_id", "n_words", "n_removed", "kept", "removed").collect()}
    for i, want in enumerate(plain(texts)):
        assert (got[i].n_words, got[i].n_removed, got[i].kept) == want, i
        assert sum(x.end - x.begin for x in got[i].removed) == want[1]
    out = S.strip_documents(frame)
    assert out.columns == frame.columns
    by_id = {r.doc_id: r.text for r in out.collect()}
    for i, want in enumerate(plain(texts)):
        assert by_id[i] == (want[2] if want[1] else texts[i])


def test_reach_holds():
    """A symbol pair with its reach inside a passage is found wherever the passage is."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(8)]
    passage = [rng.choice(words) for _ in range(80)]
    seen = []
    for _ in range(30):
        left = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        right = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        w = S.Words([" ".join(left), " ".join(left + passage + right)])
        names, begin, end = S.symbol_pairs(w, 80)
        at = len(left) * 2 + 1
        inside = (begin >= at) & (end <= at + 80)
        seen.append(set(zip(names[inside].tolist(), (begin[inside] - at).tolist())))
    assert all(s == seen[0] for s in seen) and len(seen[0]) > 3


def test_empty_and_no_columns(spark):
    assert S.remove_repeats(docs(spark, [])).count() == 0
    assert S.strip_documents(docs(spark, []).select("text")).count() == 0
    assert S.strip_documents(docs(spark, [(1, "a b")]).select("text")).collect()[0].text == "a b"


def test_query_and_sql(spark, tmp_path):
    compare(spark, "op8_substring_dedup", "/root/testdata/sf0.001")
    sf = write_tables(spark, tmp_path, documents=docs(spark, [(None, "q " * 40), (1, None), (1, "z"), (2, "q " * 36)]))
    got = {r.n_words: r for r in queries()["op8_substring_dedup"](spark, sf).collect()}
    assert got[40].n_removed == 40 and got[36].n_removed == 36
    assert got[40].kept_sha256 == hashlib.sha256(b"").hexdigest()
