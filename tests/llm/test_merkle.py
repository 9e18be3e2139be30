"""The manifest against a plain recursive version; layout and proofs."""

import zlib
from hashlib import sha256

import numpy as np
import pytest

from carelake.llm import merkle_manifest as M
from carelake.llm.queries import queries
from tests.llm.helpers import compare, docs, write_tables

H = lambda parts: sha256("".join(parts).encode()).hexdigest()


def plain_leaf(r, text):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text))


def plain_tree(level):
    levels = [level]
    while len(level) > 1:
        level = [H(level[i:i + 3]) for i in range(0, len(level), 3)]
        levels.append(level)
    return levels


def plain_path(levels, i):
    out = []
    for level in levels[:-1]:
        a = i // 3 * 3
        run = level[a:a + 3]
        out.append((i - a, [d for j, d in enumerate(run) if j != i - a]))
        i //= 3
    return out


def plain(rows):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append((r.doc_id is not None, r.doc_id, plain_leaf(r, r.text), r))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in sources}
    crown = plain_tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (_, doc_id, leaf, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            path = plain_path(trees[s], i) + plain_path(crown, k)
            text = r.text
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            digest = plain_leaf(r, text)
            for place, others in path:
                digest = H([*others[:place], digest, *others[place:]])
            root = crown[-1][0]
            out.append((doc_id, leaf, trees[s][-1][0], root, H(d for _, o in path for d in o), digest, digest == root))
    return out


key = lambda rows: sorted(rows, key=repr)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5, 7])
def test_layout(levels):
    """Every node has a place of its own; an aligned bottom half is one stretch, laid out like a whole tree."""
    by_depth = [M.address(d, np.arange(3 ** d), levels) for d in range(levels)]
    assert sorted(np.concatenate(by_depth).tolist()) == list(range(M.nodes_in(levels)))
    top = levels // 2
    if top:
        size = M.nodes_in(levels - top)
        for b in range(3 ** top):
            inside = np.concatenate([by_depth[top + d][b * 3 ** d:(b + 1) * 3 ** d] for d in range(levels - top)])
            alike = np.concatenate([M.address(d, np.arange(3 ** d), levels - top) for d in range(levels - top)])
            assert (inside == M.nodes_in(top) + b * size + alike).all()


def test_layers():
    for h in range(M.MOST_LEVELS + 1):
        layers = M.layer_heights(h)
        assert sum(layers) == h and max(layers) <= M.BLOCK_HEIGHT and (h == 0 or min(layers) > 0)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_block_paths(n):
    digests = [sha256(bytes([i])).digest() for i in range(n)]
    nodes = M.fill_block(digests, 4)
    for i in range(n):
        path = M.block_path(nodes, 4, n, i)
        assert M.fold(digests[i], path) == nodes[:32]
        assert M.fold(sha256(b"other").digest(), path) != nodes[:32]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = queries()["op11_merkle_manifest"](spark, sf).collect()
    want = plain(spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert key(map(tuple, got)) == key(want)
    assert any(r.verified for r in got) and not all(r.verified for r in got)


def test_sql(spark):
    compare(spark, "op11_merkle_manifest", "/root/testdata/sf0.001")


def run(spark, rows, folder):
    frame = docs(spark, rows).selectExpr("*", "1 as tree", "2 as at", "'x' as digest", "3 as block", "4 as n", "5 as height").repartition(5)
    sf = write_tables(spark, folder, documents=frame)
    return queries()["op11_merkle_manifest"](spark, sf).collect(), plain(frame.collect())


ODD = [(i, f"line {i}\nmore", "en", "big") for i in range(40)] + [(7, "same\n", None, "big")] * 30 + [
    (None, None), (None, ""), (None, "a\nb", None, None), (3, "\n" * 200_000, "é", "ünï"), (-5, "x", "en", "one"), (9, "y", "en", "")]


def test_edges(spark, tmp_path):
    """Null columns, repeated rows, empty and long texts, a lone leaf, clashing names."""
    got, want = run(spark, ODD, tmp_path / "t")
    assert key(map(tuple, got)) == key(want)


@pytest.mark.parametrize("height", [1, 2])
def test_many_layers(spark, height):
    """Blocks of 3 or 9 leaves: several layers, the same tree."""
    frame = docs(spark, ODD).repartition(5)
    leaf = M.leaf(["doc_id", "source", "lang", "n_chars", "text"])
    rows = frame.select("doc_id", "source", leaf.alias("leaf"), leaf.alias("shown")).cache()
    made = M.build_manifest(rows, "source", ["doc_id"], "leaf", height)
    assert len(made.blocks) >= 3 - (height > 1)
    got = [(r.doc_id, r.digest.hex(), r.subroot, r.proof_sha256, r.folded_root) for r in M.prove(made, "shown", ["doc_id", "digest"]).collect()]
    want = plain(frame.collect())
    assert key(got) == key([(*w[:3], w[4], w[3]) for w in want]) and made.root.hex() == want[0][3]


@pytest.mark.parametrize("rows", [[], [(1, "only\n")], [(None, None)]])
def test_few(spark, tmp_path, rows):
    got, want = run(spark, rows, tmp_path / "t")
    assert key(map(tuple, got)) == key(want)


def test_hot_group_spans_partitions(spark):
    """One group over all partitions, and equal rows: places are gapless."""
    from carelake.llm.ordered import number_within

    rows = [("hot", 1)] * 500 + [("a", 3), ("a", 2), (None, 1), (None, None)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(6)
    placed, sizes = number_within(df, "g", ["v"], "places")
    got = {}
    for r in placed.collect():
        got.setdefault(r.g, []).append((r.at, r.v))
    assert sorted(at for at, _ in got["hot"]) == list(range(500))
    assert sorted(got["a"]) == [(0, 2), (1, 3)] and sorted(got[None]) == [(0, None), (1, 1)]
    assert {r.g: r.n for r in sizes.collect()} == {"hot": 500, "a": 2, None: 2}
