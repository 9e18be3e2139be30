"""Every pipeline stage against a plain version, each on its own input."""

import zlib
from collections import Counter

import duckdb
import pytest

import corpus_pipeline as P
from carelake.llm import common
from carelake.llm.oracle import quality
from tests.llm.helpers import docs
from tests.llm.test_packing import check, library  # noqa: F401
from tests.llm.test_simhash import plain_components, plain_fingerprint
from tests.llm.test_substring import plain

SF = "/root/testdata/sf0.001"


def plain_profile(texts, size=400):
    return [g for g, _ in sorted(plain_grams(texts).items(), key=lambda x: (-x[1], len(x[0]), x[0]))[:size]]


def plain_grams(texts):
    count = Counter()
    for t in texts:
        t = "".join(c if c.isalpha() else " " for c in t.lower())
        for w in t.split():
            w = f" {w} "
            count.update(g for n in (1, 2, 3) for g in (w[i:i + n] for i in range(len(w) - n + 1)) if g != " ")
    return count


def plain_language(profiles, text):
    top = plain_profile([text])
    if not top:
        return "und"
    cost = {lang: sum(abs(p.index(g) - i) if g in p else 400 for i, g in enumerate(top)) for lang, p in profiles.items()}
    return min(sorted(cost), key=cost.get)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input and the rows of every stage."""
    at, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    folder = tmp_path_factory.mktemp("stages")
    for i, (_, f) in enumerate(P.STAGES):
        path = f"{folder}/{i}"
        f(spark, at, SF).write.parquet(path)
        result = spark.read.parquet(path)
        out.append((at, result))
        at = result
    return out


def test_columns(stages):
    want = stages[0][0].dtypes
    assert all(result.dtypes == want for _, result in stages[:-1])


def test_quality(spark, stages):
    before, after = stages[0]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    kept = {r[0] for r in con.sql(f"SELECT doc_id FROM ({quality(P.LEAST_WORDS)}) WHERE kept").fetchall()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(kept)


def test_language(spark, stages):
    before, after = stages[1]
    rows = before.collect()
    by_lang = {}
    for r in rows:
        if r.lang and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            by_lang.setdefault(r.lang, []).append(r.text)
    profiles = {lang: plain_profile(t) for lang, t in by_lang.items()}
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in rows if plain_language(profiles, r.text) != "und")


def test_near_duplicates(stages):
    before, after = stages[2]
    rows = before.collect()
    groups = plain_components([(r.doc_id, plain_fingerprint(r.text)) for r in rows])
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(groups))


def test_passages(stages):
    before, after = stages[3]
    rows = before.collect()
    got = {r.doc_id: r for r in after.collect()}
    assert len(got) == len(rows)
    for r, (_, lost, kept) in zip(rows, plain([r.text for r in rows])):
        assert got[r.doc_id].text == (kept if lost else r.text)
        assert got[r.doc_id].n_chars == (len(kept) if lost else r.n_chars)


def test_packing(stages, library):  # noqa: F811
    before, after = stages[4]
    check(after.collect(), [(r.doc_id, r.text) for r in before.collect()], library)


def test_edges_through_all_stages(spark):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "12 34 ! " * 30, "xx", "s", 5),
            (3, " ".join(f"word{i}x" for i in range(60)), "en", "s", 9), (3, " ".join(f"word{i}x" for i in range(60)), "en", "s", 9)]
    for frame in (docs(spark, rows), docs(spark, [])):
        at = frame
        for _, f in P.STAGES:
            at = f(spark, at, SF).checkpoint()
        assert {r.doc_id for r in at.collect()} <= {3}


def test_run(spark, stages):
    got = P.run(spark, SF)
    assert got.columns == stages[4][1].columns
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in got.collect()) == Counter((r.doc_id, r.start, r.ids_crc32) for r in stages[4][1].collect())


def test_two_runs_at_once(spark, stages):
    """Runs in threads keep to their own scratch tables."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(2) as pool:
        runs = [f.result() for f in [pool.submit(lambda: Counter((r.doc_id, r.start, r.ids_crc32) for r in P.run(spark, SF).collect())) for _ in range(2)]]
    assert runs[0] == runs[1] == Counter((r.doc_id, r.start, r.ids_crc32) for r in stages[4][1].collect())


def test_clashing_columns_and_a_long_text(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(60)), "en", "s", 9) for i in range(30)] + [
        (99, " ".join(f"w{k % 30}x{k // 30}" for k in range(120_000)), "en", "s", 1)]
    frame = docs(spark, rows).selectExpr("*", "1 as lang_pred", "2 as score", "'x' as fingerprint", "3 as kept", "4 as chunk", "'y' as _row", "5 as m")
    at = frame
    for _, f in P.STAGES[:-1]:
        at = f(spark, at, SF).checkpoint()
        assert at.columns == frame.columns
    assert {r.doc_id for r in at.collect()} == {r[0] for r in rows}
