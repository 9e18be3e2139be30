"""License scan against a plain version and its SQL."""

import re
from collections import Counter

import pytest

from carelake.llm import license_scan as L
from tests.llm.helpers import compare, docs, write_tables


def plain(text):
    text = text or ""
    words = lambda s: re.findall(r"[^\W_]+", s.lower())
    units = {tuple(words(u)) for u in [text, *text.split("\n"), *re.split(r"\n[ \t\r]*\n", text)]}
    found = []
    for u in units:
        a = Counter(zip(u, u[1:]))
        for name, t in L.TEMPLATES:
            w = words(t)
            b = Counter(zip(w, w[1:]))
            score = 2 * sum((a & b).values()) / max(1, sum(a.values()) + sum(b.values()))
            if score >= 0.8:
                found.append((score, sum(b.values()), name))
    best = max(found, default=(0.0, 0, None))
    return best[2], best[0], sorted({f[2] for f in found}), len(found)


MIT = [t for n, t in L.TEMPLATES if n == "MIT"][-1]
TEXTS = [
    None, "", "word", "Released under the MIT License.", "released UNDER the mit-license", "x\nLicensed under CC BY-NC 4.0.\ny z",
    "Prose here.\n\n" + MIT.replace(", ", ",\n") + "\n \nmore prose", MIT, MIT + " a few words more here", " ".join(MIT.split()[:60]),
    "Licensed under the Apache License, Version 2.0.\nAll rights reserved.\nAll rights reserved.", "all rights all rights reserved",
    "Licensed under the Apache License", "word " * 5000 + "\nThis work is licensed under the GNU General Public License, version 3.", "a b " * 30,
]


def test_against_plain(spark):
    frame = docs(spark, list(enumerate(TEXTS)) + [(0, None), (None, TEXTS[3])]).selectExpr("*", "1 as license", "2 as found", "3 as size")
    out = L.scan(frame)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "found", "size", "license", "score", "licenses", "n_matches"]
    for r in out.collect():
        assert (r.license, pytest.approx(r.score), r.licenses, r.n_matches) == plain(r.text), r.text
    assert L.scan(docs(spark, [])).count() == 0


def test_size_range_is_exact():
    for n in range(1, 200):
        low, high = L.size_range(n, 0.8)
        for m in range(1, 400):
            assert (low <= m <= high) == (2 * min(n, m) / (n + m) >= 0.8 - 1e-12)


def test_sql(spark, tmp_path):
    compare(spark, "op3_license_scan", "/root/testdata/sf0.001")
    sf = write_tables(spark, tmp_path, documents=docs(spark, list(enumerate(TEXTS)) + [(3, TEXTS[3])]),
                      **{t: docs(spark, []) for t in ("embeddings", "conversations", "benchmark", "labels", "pages")})
    rows = compare(spark, "op3_license_scan", sf)
    assert sum(rows.values()) == len(TEXTS) + 1
