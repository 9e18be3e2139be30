"""The prefix trie against a plain version over whole prefixes."""

import random
import zlib
from hashlib import sha256

import pytest

from carelake.llm import conversation_trie as C
from carelake.llm.queries import queries
from tests.llm.helpers import compare, write_tables

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_rebuild(rows):
    own = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if c is not None:
            own.setdefault(c, []).append((r or "", x or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def plain_trie(seqs):
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        saved[p] = sum(saved[k] for k in below) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids.get(p, [])), leaves[p], saved[p],
                   sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def by_key(rows):
    return sorted(rows, key=lambda r: (r[0], r[1]))


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = by_key(tuple(r) for r in queries()["op13_conversation_trie"](spark, sf).collect())
    assert got == by_key(plain_trie(plain_rebuild(rows)))


def test_sql(spark):
    compare(spark, "op13_conversation_trie", "/root/testdata/sf0.01")


def test_odd_rows(spark, tmp_path):
    """Null and repeated turns, null role and text, ids without a base, turnless conversations, a hot conversation of
    copies, a long one, a long text, clashing names."""
    rng = random.Random(3)
    rows = [(300 + c, t, "user" if t % 2 == 0 else "assistant", f"text {t} {rng.randint(0, 1)}") for c in range(90) for t in range(rng.randint(1, 9))]
    rows += [(7000 + c, t, "user", f"same {t}") for c in range(100, 160) for t in range(6)]           # copies
    rows += [(c, 0, "user", "alone") for c in range(9901, 9931)]                                       # no base: some end up turnless
    rows += [(500, t, None, f"long {t}") for t in range(137)] + [(501, None, None, None), (501, 0, "user", "x" * 300_000)]
    rows += [(502, 3, "user", "again")] * 9 + [(None, 0, "user", "nobody"), (None, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as conv", "2 as depth", "3 as n", "4 as name", "5 as sym", "6 as base").repartition(7)
    want = plain_trie(plain_rebuild(rows))
    assert any(r[1] == 0 and r[7] != C.EMPTY for r in want)
    assert by_key(tuple(r) for r in queries()["op13_conversation_trie"](spark, write_tables(spark, tmp_path, conversations=frame)).collect()) == by_key(want)


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "x")], [(5, 0, "user", "x")], [(100, None, None, None)]])
def test_few(spark, tmp_path, rows):
    sf = write_tables(spark, tmp_path, conversations=spark.createDataFrame(rows, SCHEMA))
    assert by_key(tuple(r) for r in queries()["op13_conversation_trie"](spark, sf).collect()) == by_key(plain_trie(plain_rebuild(rows)))


def test_chunks_of_ids(spark):
    """More ends at one node than a chunk holds, over several ranges."""
    n = 3 * C.CHUNK + 17
    ends = spark.range(n).selectExpr("id as conv", "if(id % 7 = 0, 1L, 0L) as depth", "0L as name").repartition(5)
    got = {r.depth: r.ends_sha256 for r in C.end_digests(ends).collect()}
    for depth in (0, 1):
        assert got[depth] == sha256(",".join(str(c) for c in range(n) if (c % 7 == 0) == (depth == 1)).encode()).hexdigest()
