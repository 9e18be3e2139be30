"""SimHash against an all-pairs check on small tables."""

import random

import numpy as np
import pytest
import xxhash

from carelake.llm import simhash_dedup as S
from tests.llm.helpers import docs


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    """rows: (id, fingerprint) -> component id by position."""
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                group[max(top(i), top(j))] = min(top(i), top(j))
    out = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            out[top(i)] = min(d, out.get(top(i), d))
    return [out.get(top(i)) for i in range(len(rows))]


@pytest.mark.parametrize("text", ["", None, "one", "Two words", "É b C d e\x0bf\tg \n h", "a b c d " * 40, "x y z \x1c w v"])
def test_fingerprint(text):
    assert S.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_links_join_what_all_pairs_join():
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:
        x = b
        for _ in range(12):  # chains: each a few bits from the one before
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    values = np.array(fps, dtype=np.uint64)
    for block in (10**7, 20_000):  # the second is split by further bits
        S.VARIANTS, old = block, S.VARIANTS
        pairs = S._meet(values, np.full(len(fps), 2, dtype=np.int8), 64)
        S.VARIANTS = old
        assert all((fps[a] ^ fps[b]).bit_count() <= 4 for a, b in pairs)
        want = plain_components([(i, f) for i, f in enumerate(fps)])
        group = list(range(len(fps)))
        for a, b in S._forest(pairs, len(fps)):
            a, b = (next(x for x in _walk(group, i)) for i in (a, b))
            group[max(a, b)] = min(a, b)
        assert [next(_walk(group, i)) for i in range(len(fps))] == want


def _walk(group, i):
    while group[i] != i:
        i = group[i]
    yield i


def _rows():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    out = []
    for i in range(60):
        words = [rng.choice(vocab) for _ in range(rng.choice([1, 3, 30, 400]))]
        out.append((i * 7 % 61, " ".join(words)))
        if i % 3 == 0:
            words[rng.randrange(len(words))] = "changed"
            out.append((100 + i, "  ".join(words).upper()))
        if i % 5 == 0:
            out.append((200 + i, " ".join(words)))
    return out + [(None, None), (5000, ""), (None, " "), (7, "a b"), (7, "a b"), (None, "only null")]


def test_components_against_all_pairs(spark):
    rows = _rows()
    got = sorted(map(tuple, S.near_duplicates(docs(spark, rows)).collect()), key=str)
    fps = [plain_fingerprint(t) for _, t in rows]
    want = plain_components([(d, f) for (d, _), f in zip(rows, fps)])
    assert got == sorted([(d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, want)], key=str)


def test_filter_keeps_one_of_each(spark):
    rows = _rows()
    frame = docs(spark, rows).selectExpr("*", "1 as fp", "2 as _row_key", "3 as component")
    got = S.filter_documents(frame)
    assert got.columns == frame.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    groups = plain_components([(i, plain_fingerprint(t)) for i, (_, t) in enumerate(rows)])
    assert len(kept) == len(set(groups))
    best = {}
    for g, (d, _) in zip(groups, rows):
        best[g] = min(best.get(g, (True, 0)), (d is None, d or 0))
    assert sorted((d is None, d or 0) for d, _ in kept) == sorted(best.values())


def test_empty(spark):
    assert S.near_duplicates(docs(spark, [])).count() == 0
    assert S.filter_documents(docs(spark, [])).count() == 0


def test_odd_distances_are_refused(spark):
    with pytest.raises(ValueError, match="even"):
        S.near_links(spark.createDataFrame([(0,), (7,)], "fp long"), 2, 3)
