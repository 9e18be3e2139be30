"""The additive model: held-out accuracy, scores by plain lookups, odd rows."""

import zlib

import numpy as np
import pytest

from carelake.llm import quality_classifier as Q
from carelake.llm.queries import queries
from tests.llm.helpers import docs, write_tables

LABELS = "doc_id long, quality int, toxic int"


def plain_score(model, row):
    """One row, one table after another."""
    z, bins = model.base, []
    for value, edges, table in zip(row, model.edges, model.tables):
        bins.append(sum(1 for e in edges if e <= value))
        z += table[bins[-1]]
    for (a, b), grid in zip(model.pairs, model.grids):
        z += grid[bins[a] * Q.PAIR_BINS // (len(model.edges[a]) + 1), bins[b] * Q.PAIR_BINS // (len(model.edges[b]) + 1)]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in queries()["op12_quality_classifier"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    held = [(got[i], q) for i, q in labels.items() if got[i].held_out]
    for label in (0, 1):
        right = [r.predicted == q for r, q in held if q == label]
        assert len(right) > 50 and np.mean(right) >= 0.97, (label, len(right), np.mean(right))


def test_scores_are_sums_of_lookups(spark):
    rng = np.random.default_rng(5)
    x = rng.random((600, len(Q.MEASURES))).round(2)
    model = Q.fit(x, ((x[:, 0] > 0.5) != (x[:, 3] > 0.4)).astype(float))
    scores = model.score(x)
    assert np.allclose(scores, [plain_score(model, r) for r in x], atol=1e-12)
    assert (0, 3) in model.pairs  # only the pair tells the labels apart
    assert ((scores >= 0.5) == ((x[:, 0] > 0.5) != (x[:, 3] > 0.4))).mean() > 0.9


def test_query_adds_the_tables(spark, tmp_path):
    """Scores of the query are those of the plain version over the plain measures."""
    good = [(i, " ".join(f"word{(i * 7 + k) % 50}" for k in range(40)) + ".") for i in range(120)]
    bad = [(500 + i, "### " * 30 + f"x{i}") for i in range(60)]
    odd = [(900, None), (901, ""), (901, ""), (None, "word1 word2"), (902, "y " * 100_000), (903, "\n \n")]
    frame = docs(spark, good + bad + odd).selectExpr("*", "1 as words", "2 as score", "0 as quality", "true as held_out")
    labels = [(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in bad] + [(0, 0, 0), (1, None, 0), (2, 7, 0), (None, 1, 1), (3, 1, 1), (3, 1, 1)]
    sf = write_tables(spark, tmp_path, documents=frame, labels=spark.createDataFrame(labels, LABELS))
    got = queries()["op12_quality_classifier"](spark, sf).collect()
    assert len(got) == len(good) + len(bad) + len(odd)
    learned = [(Q.measure(t), int(i < 500)) for i, t in good + bad if zlib.crc32(str(i).encode()) % 5 and i != 0]
    learned.sort(key=lambda r: (r[1], r[0]))
    model = Q.fit(np.array([m for m, _ in learned]), np.array([q for _, q in learned], dtype=float))
    texts = {}
    for i, t in good + bad + odd:
        texts.setdefault(i, t or "")
    for r in got:
        assert abs(r.score - plain_score(model, Q.measure(texts[r.doc_id]))) < 1e-9
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].predicted == 1 for i, _ in good) and all(by_id[i].predicted == 0 for i, _ in bad)


def test_held_out_labels_and_names_teach_nothing(spark, tmp_path):
    rows = [(i, "fine words here and there " * 5 if i % 3 else "## ## !! " * 9, "en", "a") for i in range(200)]
    labels = [(i, int(i % 3 > 0), 0) for i in range(200)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, 1) for i, q, _ in labels]
    out = []
    for k, (rs, ls) in enumerate([(rows, labels), ([(i, t, None, "b") for i, t, _, _ in rows], turned)]):
        sf = write_tables(spark, tmp_path / str(k), documents=docs(spark, rs), labels=spark.createDataFrame(ls, LABELS))
        out.append(sorted((r.doc_id, r.score) for r in queries()["op12_quality_classifier"](spark, sf).collect()))
    assert out[0] == out[1]


@pytest.mark.parametrize("rows, labels, want", [([], [], []), ([(1, "a")], [], [0.5]), ([(1, "a"), (None, None)], [(1, 1, 0)], [2 / 3, 2 / 3])])
def test_few(spark, tmp_path, rows, labels, want):
    sf = write_tables(spark, tmp_path, documents=docs(spark, rows), labels=spark.createDataFrame(labels, LABELS))
    got = queries()["op12_quality_classifier"](spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert np.allclose([r.score for r in got.collect()], want)


def test_the_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(Q, "TRAIN_DOCS", 200)
    rows = [(i, f"text {i} " * (1 + i % 9)) for i in range(3000)] + [(7, "copy")] * 3000
    measured = Q.measure_documents(docs(spark, rows), {"doc_id": Q.F.col("doc_id")})
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(3000)], LABELS)
    assert 120 < Q.training_rows(measured, labels).count() < 300
