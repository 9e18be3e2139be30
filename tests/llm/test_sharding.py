"""Sharding: a permutation, gapless slots, computable places."""

import zlib
from collections import Counter

import numpy as np
import pytest

from carelake.llm import sharding as S
from carelake.llm.queries import SHARDS, queries
from tests.llm.helpers import compare, docs


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation_and_inverse(n):
    place = S.permute(np.arange(n), n)
    assert sorted(place.tolist()) == list(range(n))
    for row in range(0, n, max(1, n // 7)):
        p = int(place[row])
        assert S.row_at(p % 7, p // 7, n, 7) == row


def test_shuffles():
    place = S.permute(np.arange(10000), 10000)
    assert abs(np.corrcoef(place, np.arange(10000))[0, 1]) < 0.05
    assert (S.permute(np.arange(10000), 10000, seed=1) != place).mean() > 0.99
    big = S.permute(np.array([0, 1, (1 << 61) + 5]), 1 << 62)
    assert len(set(big.tolist())) == 3 and big.min() >= 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = queries()["op7_sharding"](spark, sf).collect()
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    # Plain version: sort, number, permute.
    plain = sorted(((r.doc_id is not None, r.doc_id), len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in rows)
    place = S.permute(np.arange(len(plain)), len(plain)).tolist()
    assert Counter(tuple(r) for r in got) == Counter(
        (i[1], size, crc, "rows", p % SHARDS, p // SHARDS, None) for (i, size, crc), p in zip(plain, place))
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    again = queries()["op7_sharding"](spark.newSession(), sf).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_sql(spark):
    compare(spark, "op7_sharding", "/root/testdata/sf0.001")


def test_repeated_rows_and_edges(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(S, "COPIES_AT_ONCE", 7)
    rows = [(None, None)] * 3 + [(1, "copy")] * 100 + [(1, "other"), (2, "")]
    frame = docs(spark, rows).selectExpr("*", "5 as slot", "6 as key", "7 as part", "8 as copies")
    out = S.assign_shards(frame, 4)
    assert [c for c in out.columns if c == "slot"] == ["slot"]
    got = out.collect()
    assert sorted(r.row_number for r in got) == list(range(105))
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values()) and len(by_shard) == 4
    assert sum(1 for r in got if r.doc_id is None and r.row_number < 3) == 3
    assert S.assign_shards(docs(spark, []), 4).count() == 0
    S.write_shards(docs(spark, rows), str(tmp_path / "s"), 4)
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("shard").count().count() == 4
