"""Language ID: held-out accuracy, a plain version, odd texts."""

import base64
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from carelake.llm import common
from carelake.llm import language_id as L
from carelake.llm.queries import queries
from tests.llm.helpers import docs
from tests.llm.test_pipeline import plain_grams, plain_language, plain_profile


@pytest.mark.parametrize("text", ["", "abc", "Ab  c-d!é", "1 2 3", "漢字 かな x", "a" * 3000, "🙂 \x00 ß"])
def test_ngrams_equal_plain(text):
    grams, counts = L.ngram_counts(text)
    named = {"".join(map(chr, _points(int(g)))): int(c) for g, c in zip(grams, counts)}
    assert named == dict(plain_grams([text]))


def _points(g):
    """The code points of a packed n-gram."""
    points = []
    while g:
        points.append(g & ((1 << 21) - 1))
        g >>= 21
    return points[::-1]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = queries()["op6_language_id"](spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98


def test_odd_rows(spark):
    train = [(i, f"the cat sat on the mat number {i} and the dog", "en", "s", 1) for i in range(20)]
    train += [(100 + i, f"der hund und die katze sind nicht da {i} und", "de", None, 1) for i in range(20)]
    frame = docs(spark, train + [(200, "le chat", None, None, 0)])
    profiles = L.train_profiles(frame)
    assert {r.lang for r in profiles.collect()} == {"en", "de"}
    known = L.collect_profiles(profiles)
    odd = docs(spark, [(None, None), (1, ""), (1, ""), (2, "12 !?"), (3, "THE DOG AND THE CAT"), (4, "und die katze " * 20000)])
    out = L.predict_language(odd.selectExpr("*", "'x' as lang_pred", "1 as _row"), known)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_row", "lang_pred", "score"]
    got = sorted(((r.doc_id or 0, r.lang_pred) for r in out.collect()))
    assert got == [(0, "und"), (1, "und"), (1, "und"), (2, "und"), (3, "en"), (4, "de")]
    empty = L.collect_profiles(L.train_profiles(docs(spark, [])))
    assert empty.predict("text") == ("und", 0.0)
    assert L.predict_language(docs(spark, []), known).count() == 0


def test_any_number_of_languages(spark):
    """Over 500 languages, the old limit."""
    rows = [(i, f"{chr(0x4e00 + i)}{chr(0x4e00 + i)} {chr(0x4e00 + i)}", f"l{i:03d}") for i in range(501)]
    known = L.collect_profiles(L.train_profiles(docs(spark, rows)))
    assert len(known.langs) == 501 and known.predict(rows[500][1])[0] == "l500"


def test_repeats_count_once_in_the_sample(spark):
    """A row that is a third of a language: it may be drawn, once; the others are drawn as without it."""
    rows = [(i, f"text number {i}", "en") for i in range(2000)]
    alone = {tuple(r) for r in L._sample(docs(spark, rows), "text", "lang", "doc_id", 300).collect()}
    held = L._sample(docs(spark, rows + [rows[7]] * 1000), "text", "lang", "doc_id", 300).collect()
    assert {tuple(r) for r in held} == alone and len(held) == len(alone) and 220 < len(held) < 380


def test_profiles_and_least_scores_come_from_all_rows(spark):
    """More rows of a language than the old sample of 1500: profiles and medians are those of every
    distinct row; one that comes a thousand times counts once, and does not depend on partitioning."""
    rows = [(i, f"wort {chr(97 + i % 26)}{chr(97 + i // 26 % 26)} {chr(97 + i // 676)}x " * (1 + i % 3), "de") for i in range(4000)]
    rows += [(-1 - i, "the cat sat on the mat", "en") for i in range(3)]
    frame = docs(spark, rows + [rows[7]] * 1000).repartition(7)
    got = {(r.lang, r.gram): r.rank for r in L.train_profiles(frame).collect()}
    for lang in ("de", "en"):
        grams, counts = L._merged([L.ngram_counts(t) for _, t, x in rows if x == lang])
        top = L.ranked(grams, counts, L.PROFILE_SIZE)
        assert [g for _, g in sorted((n, g) for (x, g), n in got.items() if x == lang)] == [int(g) for g in top]
    known = L.collect_profiles(L.train_profiles(frame))
    scores = {lang: [known.predict(t)[1] for _, t, x in rows if x == lang] for lang in known.langs}
    pooled = np.median(sum(scores.values(), []))
    want = {x: L.SCORE_SHARE * (len(v) * np.median(v) + L.PRIOR_SCORED * pooled) / (len(v) + L.PRIOR_SCORED) for x, v in scores.items()}
    cuts = L.least_scores(frame, known)
    assert set(cuts) == set(want) and all(abs(cuts[x] - want[x]) <= 10.0 ** -L.SCORE_DIGITS for x in want)


def test_batches_to_python_are_bounded(spark):
    """Long rows come in batches of a few MB, not of 10,000 rows."""
    sizes = lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches)
    long = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat('x', 5000) as text")
    assert max(r.n for r in common.map_arrow(long, sizes, "n long").collect()) < 2 * common.BATCH_BYTES


def test_few_scored_rows_lean_on_all_languages(spark):
    """A language without held-out rows is judged by the median of the others, not by the constant."""
    words = {"en": "the cat sat on the mat and ran ", "de": "die katze sass auf der matte und lief "}
    train = [(i, words[lang] * 3, lang) for i, lang in enumerate(["en", "de"] * 20)]
    known = L.collect_profiles(L.train_profiles(docs(spark, train)))
    only_en = [(100 + i, words["en"] * 2, "en") for i in range(30)]
    cuts = L.least_scores(docs(spark, only_en), known)
    assert set(cuts) == {"en", "de"} and abs(cuts["de"] - cuts["en"]) < 1e-12 and cuts["de"] > 0.2
    assert L.least_scores(docs(spark, []), known) == {}


def test_plain_profile_agrees(spark):
    texts = {"en": ["the cat sat on the mat"] * 3, "de": ["die katze sass auf der matte"] * 3}
    frame = docs(spark, [(i, t, lang) for lang, ts in texts.items() for i, t in enumerate(ts)])
    known = L.collect_profiles(L.train_profiles(frame))
    profiles = {lang: plain_profile(ts) for lang, ts in texts.items()}
    for t in ("the mat", "katze auf", "cat der", "zzz"):
        assert known.predict(t)[0] == plain_language(profiles, t)


def test_without_labels_every_text_with_a_letter_stays(spark):
    rows = [(1, "the cat sat on the mat"), (2, "katze"), (3, None), (4, ""), (5, "12 !?"), (6, "漢字")]
    assert sorted(r.doc_id for r in L.filter_documents(docs(spark, rows)).collect()) == [1, 2, 6]
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    assert L.filter_documents(docs(spark, [(held, "the cat", "en")])).count() == 1


def test_texts_in_no_language_go(spark):
    clean = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    clean = clean.where("length(text) > 0 and text rlike '[a-z]'")
    rng = random.Random(6)
    text = lambda word, n: " ".join(word() for _ in range(n))
    words = {"letters": lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))),
             "hex": lambda: f"{rng.getrandbits(32):08x}", "base64": lambda: base64.b64encode(rng.randbytes(9)).decode()}
    junk = [text(w, n) for w in words.values() for n in (30, 100, 1000) for _ in range(5)]
    junk.append("Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
                "i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa i wolności")
    short = [" ".join(r.text.split()[:n]) for r in clean.where("doc_id % 10 = 0").collect() for n in (3, 5, 10)]
    rows = [(-1 - i, t) for i, t in enumerate(junk)] + [(10**6 + i, t) for i, t in enumerate(short)]
    want = clean.count() + len(short)
    kept = {r.doc_id for r in L.filter_documents(clean.union(docs(spark, rows)), train_on=clean).select("doc_id").collect()}
    assert not [d for d in kept if d < 0]
    assert len([d for d in kept if d >= 0]) == want
