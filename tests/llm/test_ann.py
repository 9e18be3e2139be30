"""Neighbour search against brute force: recall, scores, ties and odd vectors."""

from pathlib import Path

import numpy as np

from carelake.llm import ann_graph as A
from carelake.llm.common import collect_written, parts_for
from carelake.llm.queries import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, wanted=5, every=50):
    """query -> [(vec_id, score)], all candidates in order."""
    good = {}
    size = None
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        size = size or len(v)
        if len(v) == size:
            good[i] = np.array(v, dtype=np.float32).astype(np.float64)
    ids = np.array(sorted(good))
    x = np.array([good[i] for i in ids.tolist()])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for k, q in enumerate(ids.tolist()):
        if q % every == 0:
            s = x @ x[k]
            order = [j for j in np.lexsort((ids, -np.round(s, 12))).tolist() if j != k]
            out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def measure(got, want, wanted=5):
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(by) == {q for q, near in want.items() if near}
    hits = total = 0
    for q, found in by.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, min(wanted, len(want[q])) + 1))
        scores = dict(want[q])
        assert all(abs(scores[v] - s) < 1e-12 for _, v, s in found)
        assert all(a[2] >= b[2] - 1e-12 for a, b in zip(found, found[1:]))
        hits += len({v for _, v, _ in found} & {v for v, _ in want[q][:wanted]})
        total += min(wanted, len(want[q]))
    return hits / max(1, total)


def test_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert measure(queries()["op1_ann_graph"](spark, sf).collect(), brute(rows)) >= 0.95


def test_odd_vectors_and_ties(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 8)).tolist()
    rows = [(i, v) for i, v in enumerate(base)]
    rows += [(100 + i, base[0]) for i in range(12)]          # one common vector, query 0 and 100 among its ids
    rows += [(50, base[3]), (50, base[3])]                   # a repeated row
    rows += [(200, None), (201, [0.0] * 8), (202, [None] + [1.0] * 7), (203, [float("nan")] * 8), (204, [float("inf")] + [1.0] * 7), (205, [1.0]), (None, base[4])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).selectExpr("*", "1 as node", "2 as q", "3 as u")
    got = A.nearest(frame).collect()
    assert measure(got, brute(rows)) == 1
    first = sorted((r.rank, r.vec_id) for r in got if r.query_id == 0)
    assert [v for _, v in first] == [100, 101, 102, 103, 104]  # equal vectors: smaller ids first


def test_few_and_none(spark):
    for rows in ([], [(0, [1.0, 2.0], 1)], [(0, [1.0, 2.0], 1), (7, [2.0, 1.0], 1)], [(0, None, 1)]):
        got = A.nearest(spark.createDataFrame(rows, SCHEMA)).collect()
        assert [r.vec_id for r in got] == ([7] if len(rows) == 2 else [])


def test_a_link_waits_until_its_hub_draws_it(spark):
    """Four nodes name hub 9, two are drawn in a round: the others wait, and come next."""
    graph = spark.createDataFrame([(u, 9, u / 10, True, True) for u in (1, 2, 3, 4)], "u long, v long, sim double, fresh boolean, waiting boolean")
    none = spark.createDataFrame([], A.EDGES)
    first = A._drawn(graph, 2, 0)
    graph = A._after_round(graph, first, none, 2)
    early = {r.v for r in first.collect()}
    assert {r.u for r in graph.where("waiting").collect()} == {1, 2, 3, 4} - early and not graph.where("fresh").count()
    second = A._drawn(graph, 2, 1).collect()
    assert {r.v for r in second} == {1, 2, 3, 4} - early and all(r.fresh for r in second)


def test_parallel_vectors_score_one(spark):
    """Equal directions, unequal vectors: no score above 1; equal queries walk once and leave themselves out."""
    rows = [(i, [0.1 * (i + 1), 0.3 * (i + 1), 0.7 * (i + 1)], 1) for i in range(40)] + [(50 * i, [1.0, 1.0, 0.0], 1) for i in range(2, 30)]
    got = A.nearest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert max(r.score for r in got) <= 1.0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r.vec_id)
    same = [50 * i for i in range(2, 30)]
    for q in same:
        assert by[q] == [i for i in same if i != q][:5]


def test_queries_outside_the_index(spark):
    """Vectors of no node begin at the seeds."""
    rng = np.random.default_rng(2)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((300, 6)).tolist())]
    vectors = spark.createDataFrame(rows, "node long, vec array<double>").cache()
    graph = A.build_graph(vectors, 300)
    asked = [(k, v, None) for k, v in enumerate(rng.standard_normal((5, 6)).tolist())]
    found = A.search(spark.createDataFrame(asked, "q long, vec array<double>, own long"), vectors, graph).collect()
    x = np.array([v for _, v in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    for r in found:
        assert r.nodes[:5] == np.argsort(-(x @ np.array(asked[r.q][1])))[:5].tolist()


def test_the_degree_grows_with_the_logarithm():
    assert A.degree(0) == A.degree(10_000) == 28
    assert [A.degree(n) for n in (20_000, 40_000, 10_240_000)] == [31, 34, 58]


def test_files_follow_the_rows_not_the_shuffle(spark):
    """Many shuffle partitions that are not coalesced: every table written has few files, the answers are whole."""
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.standard_normal((400, 6)).tolist())] + [(1000 + i, [1.0] * 6) for i in range(100)]
    held = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {c: spark.conf.get(c) for c in held}
    frame = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).coalesce(2)
    try:
        for c, v in held.items():
            spark.conf.set(c, v)
        with collect_written() as paths:
            got = A.nearest(frame)
            assert got.rdd.getNumPartitions() <= parts_for(spark, 500, A.VECTORS_EACH)
            got = got.collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    most = parts_for(spark, 400 * A.K, A.LINKS_EACH)
    assert len(paths) > 10 and 2 * most < 61
    files = {p: len(list(Path(p.removeprefix("file:")).glob("part-*"))) for p in paths}
    assert all(n <= most * (2 if "ann-links" in p else 1) for p, n in files.items()), files
    assert measure(got, brute(rows)) == 1


def test_passes_leave_few_rounds(spark):
    """Vectors at random, the hard case: two rounds at most, and near all of the neighbours are in the graph."""
    n = 6000
    x = np.random.default_rng(4).standard_normal((n, 24))
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "node long, vec array<double>").repartition(4).cache()
    with collect_written() as paths:
        graph = A.build_graph(vectors, n).toPandas()
    assert sum("ann-drawn" in p for p in paths) <= 2
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert not graph.duplicated(["u", "v"]).any() and graph.groupby("u").size().tolist() == [A.K] * n
    assert np.allclose((x[graph.u] * x[graph.v]).sum(axis=1), graph.sim)
    held = graph.groupby("u").v.apply(set)
    sims = x[:200] @ x.T
    sims[np.arange(200), np.arange(200)] = -2
    near = np.argsort(-sims, axis=1)[:, :A.K]
    assert sum(len(held[i] & set(near[i].tolist())) for i in range(200)) >= 0.95 * 200 * A.K


def test_lists_of_several_passes_meet():
    """The best of all lists of a node, a neighbour of two lists once."""
    import pyarrow as pa

    lists = pa.table({"u": [1, 1, 2], "vs": [[5, 6], [6, 7, 5], [1]], "sims": [[0.5, 0.9], [0.9, 0.7, 0.5], [0.1]]})
    got = [r for b in A._best_of_lists(2)(iter(lists.to_batches())) for r in b.to_pylist()]
    assert [(r["u"], r["v"], r["sim"]) for r in got] == [(1, 6, 0.9), (1, 7, 0.7), (2, 1, 0.1)]
