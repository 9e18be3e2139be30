"""Quality rules: counts against a plain version, sketches, odd rows, SQL."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from carelake.llm import quality_rules as Q
from tests.llm.helpers import compare, docs, write_tables


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def _texts():
    rng = random.Random(3)
    vocab = ["a", "bb", "é🙂", "#x", "d|", "e\x0bf"]
    out = [None, "", " \n\t", "one", "x\r\ny\n\ny\nx", "a b c d e f g h", "a b c d e f g h a", "w " * 9, "w " * 5000, "\n".join(["line"] * 50)]
    for _ in range(60):
        words = rng.choices(vocab, k=rng.randint(0, 40))
        block = rng.choices(vocab, k=rng.randint(8, 20))
        parts = words + block * rng.randint(0, 3) + words[:5] + block[:rng.randint(0, 10)]
        out.append("".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in parts))
    return out


def test_counts_against_plain(spark):
    texts = _texts()
    frame = docs(spark, list(enumerate(texts))).selectExpr("*", "1 as m", "2 as kept", "3 as g_lang", "4 as limits")
    out = Q.judge(frame)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "m", "g_lang", "limits", *Q.BASE, "base_failed", "kept"]
    for r in out.collect():
        want = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.kept and r.base_failed)
    assert Q.judge(docs(spark, [])).count() == 0 and Q.filter_documents(docs(spark, [])).count() == 0


def test_sketch_error_and_merging(spark):
    rng = random.Random(1)
    values = [int(rng.lognormvariate(6, 1.5)) for _ in range(5000)]
    rows = spark.createDataFrame([(i % 7, v) for i, v in enumerate(values)], "g int, v long")
    sketch = Q.build_sketches(rows, ["g"], ["v"])
    merged = Q.merge_sketches(sketch, [])
    whole = Q.build_sketches(rows, [], ["v"])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    got = Q.sketch_quantiles(merged, [], {"q": 75}).first().q
    true = sorted(values)[-(-75 * len(values) // 100) - 1]
    assert got <= true <= got * (1 + 2 ** -(Q.SKETCH_BITS - 1)) + 1


def test_clean_text_stays_and_junk_goes(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n)) + "."
    clean = [(i, prose(rng.randint(20, 300)), rng.choice(["en", None]), rng.choice(["hot", "hot", "s1", None])) for i in range(400)]
    junk = [(1000 + i, re.sub(" ", "$$$ ", prose(100)), "en", "hot") for i in range(20)]
    junk += [(2000 + i, prose(60).upper(), "en", "s1") for i in range(10)]
    kept = {r.doc_id for r in Q.filter_documents(docs(spark, clean + junk)).collect()}
    assert kept == {c[0] for c in clean}


def _prose(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(n)) + "."


@pytest.mark.parametrize("others", [0, 300])
def test_a_junk_heavy_source_loses_its_junk(spark, others):
    """30 % of a source is junk; with other sources around also a source that is junk throughout."""
    rng = random.Random(4)
    clean = [(i, _prose(rng, rng.randint(20, 200)), "en", "hot") for i in range(210)]
    clean += [(500 + i, _prose(rng, rng.randint(20, 200)), "en", f"s{i % 5}") for i in range(others)]
    junk = [(1000 + i, _prose(rng, 80).replace(" ", "$$ "), "en", "hot") for i in range(90)]
    if others:
        junk += [(2000 + i, _prose(rng, 80).upper(), "en", "bad") for i in range(60)]
    kept = {r.doc_id for r in Q.filter_documents(docs(spark, clean + junk)).collect()}
    assert kept == {c[0] for c in clean}


def test_every_measure_can_reject(spark):
    """A row above the fence of one measure alone, the base rules passed."""
    rng = random.Random(5)
    clean = [(i, "\n".join(_prose(rng, 8) for _ in range(12)), "en", "s") for i in range(100)]
    block, tail = _prose(rng, 14), lambda n: _prose(rng, n)
    odd = {"symbols": _prose(rng, 90).replace(" ", "# "), "dup_lines": "\n".join([tail(8) for _ in range(10)] + ["same one"] * 9),
           "repeats": f"{block} {tail(66)} {block} x", "upper": _prose(rng, 90).upper(), "word_length": " ".join("abcdefgh" * 4 for _ in range(5)) + " "
           + " ".join("".join(rng.choices("abcdefgh", k=30)) for _ in range(60))}
    rows = clean + [(1000 + k, t, "en", "s") for k, t in enumerate(odd.values())]
    for r in Q.judge(docs(spark, rows)).collect():
        assert r.kept == (r.doc_id < 1000), r.doc_id
        assert r.doc_id < 1000 or not r.base_failed, list(odd)[r.doc_id - 1000]


@pytest.mark.parametrize("n", [199, 200, 201])
def test_no_step_in_the_size_of_a_group(spark, n):
    """A limit moves with the rows of a group, not at a size of it."""
    rows = [(i, "en", "a", 40 if i % 2 else 200) for i in range(n)] + [(10_000 + i, "en", "b", 10) for i in range(5000)]
    frame = spark.createDataFrame(rows, "i int, g_lang string, g_source string, v long")
    wide = frame.select("g_lang", "g_source", *[Q.F.col("v").alias(m) for m in Q.MEASURES])
    own = {r.g_source: r for r in Q.fences(Q.build_sketches(wide, ["g_lang", "g_source"], list(Q.MEASURES)), ["g_lang", "g_source"]).collect()}
    both = spark.createDataFrame([(own["a"].rows, own["a"].limits, own["b"].limits)], "r1 long, l1 struct<%s>, l2 struct<%s>" % (
        (", ".join(f"{m}: bigint" for m in Q.MEASURES),) * 2))
    got = both.select(Q.drawn("r1", "l1", "l2").alias("x")).first().x
    a, b = own["a"].limits["symbols"], own["b"].limits["symbols"]
    assert got["symbols"] == min((n * a + Q.PRIOR * b) // (n + Q.PRIOR), Q.BOUND * b)


def test_no_python_in_the_plan(spark):
    plan = Q.judge(docs(spark, [(1, "a b")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("value", [0, 1, 127, 128, 255, 256, 257, 1000, 123456])
def test_bucket(spark, value):
    got = spark.range(1).select(Q.sketch_bucket(F.lit(value).cast("long")).alias("b")).first().b
    assert got == (value >> max(0, value.bit_length() - 8)) << max(0, value.bit_length() - 8)


def test_sql(spark, tmp_path):
    texts = _texts()
    rows = [(i % 50, t, ["en", None][i % 2], ["s", None, "t"][i % 3]) for i, t in enumerate(texts)]
    sf = write_tables(spark, tmp_path, documents=docs(spark, rows),
                      **{t: docs(spark, []) for t in ("embeddings", "conversations", "benchmark", "labels", "pages")})
    compare(spark, "op10_quality_rules", sf)
