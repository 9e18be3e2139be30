"""Language ID by rank-order profiles.

A profile is the ``profile_size`` most frequent letter n-grams (1 to 3 code
points; words padded with one blank on each side) of a language in rank order.
A text's own most frequent n-grams are ranked the same way; the out-of-place
distance to a profile adds up, over the text's ranked n-grams, how far each is
from its place there (``profile_size`` for one that is not in the profile), and
the nearest profile names the language.

Training reads the whole texts of all labelled rows, in the tasks that hold them; a
row repeated any number of times is one (``_distinct_rows``: only repeats are
shuffled), so profiles and least scores do not depend on partitioning. What is
shuffled otherwise is counts of n-grams. Profiles are at most ``profile_size`` rows of
three numbers for each language. Prediction reads every text whole, in the tasks that
hold it; no row is shuffled. A caller that wants a bounded training run can give
``train_docs``; no query does.

Defined results: ``und`` with score 0 for a text that is null or has no letter,
or if there is no profile (an empty training table); equal distances go to the
language first in order; equal n-gram counts rank by code points. Rows with a
null language are not trained on. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from carelake.llm.common import ROW, map_arrow, materialise, slices, unpack

PROFILE_SIZE = 400
HELD_GRAMS = 500_000  # of n-grams that a training task counts before it hands them on
PRIOR_SCORED = 10  # rows as many as the median of all languages counts for in one of them
SCORE_SHARE = 0.5  # of the median score: on sf0.01 clean texts, single words too, reach 0.43, medians are 0.66 to 0.71
SCORE_DIGITS = 4  # of the scores that medians are taken of
UNKNOWN = "und"
BITS = np.uint64(21)  # a code point
BLANK = np.uint64(32)


def _codes(text: str) -> np.ndarray:
    """Lower-case code points; runs of anything but letters become one 0."""
    text = text.lower()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    distinct = np.unique(points)
    odd = distinct[[not chr(c).isalpha() for c in distinct.tolist()]]
    points = np.where(np.isin(points, odd), 0, points) if len(odd) else points
    points = np.concatenate(([0], points, [0]))
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
    return points[keep].astype(np.uint64)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text as numbers, ascending, and their counts."""
    c = _codes(text)
    if len(c) < 3:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    letter = c != 0
    c = np.where(letter, c, BLANK)  # not 0, or " a" would have the number of "a"
    two = (c[:-1] << BITS) | c[1:]
    three = (two[:-1] << BITS) | c[2:]
    # A blank may begin or end an n-gram, not lie inside it.
    grams = np.concatenate([c[letter], two, three[letter[1:-1]]])
    return np.unique(grams, return_counts=True)


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first."""
    return grams[np.argsort(-counts, kind="stable")[:size]]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of n-grams, added up."""
    grams, at = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(at, weights=np.concatenate([c for _, c in parts]), minlength=len(grams)).astype(np.int64)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by language of a task's texts, handed on whenever ``HELD_GRAMS`` are held."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def handed_on() -> Iterator[pa.RecordBatch]:
        for lang, (grams, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n)],
                                             names=["lang", "gram", "n"])
        held.clear()

    for batch in slices(batches):
        by_lang: dict[str, list] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_lang.setdefault(lang, []).append(ngram_counts(text))
        for lang, parts in by_lang.items():
            held[lang] = _merged([*([held[lang]] if lang in held else []), *parts])
        if sum(len(grams) for grams, _ in held.values()) > HELD_GRAMS:
            yield from handed_on()
    yield from handed_on()


def train_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", id_: str = "doc_id",
                   train_docs: int | None = None, profile_size: int = PROFILE_SIZE) -> DataFrame:
    """Rows (lang, gram, rank), rank from 0, of all labelled rows (or of about
    ``train_docs`` of each language)."""
    rows = _distinct_rows(docs, text, lang, id_) if train_docs is None else _sample(docs, text, lang, id_, train_docs)
    counts = map_arrow(rows, _count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = W.partitionBy("lang").orderBy(F.desc("n"), "gram")
    # A limit on the row number itself is one that Spark applies before it shuffles by language, too.
    return counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= profile_size) \
        .select("lang", "gram", (F.col("place") - 1).alias("rank"))


def _labelled(docs: DataFrame, text: str, lang: str, id_: str) -> DataFrame:
    """(lang, text, id, mark) of the rows that have a language and a text."""
    return docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(id_).alias("id")) \
        .where("lang is not null and text is not null").withColumn("mark", F.xxhash64("id", "text"))


def _distinct_rows(docs: DataFrame, text: str, lang: str, id_: str) -> DataFrame:
    """(lang, text) of the distinct labelled rows (language, id and text).

    Marks (of id and text) that come more than once are few where ids are keys. They
    are written, so the planner knows their size; the texts of all other rows stay where
    they are, and only rows with such a mark are shuffled to be compared."""
    rows = _labelled(docs, text, lang, id_)
    often = rows.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select(F.col("mark").alias("often_mark"))
    often = materialise(often, "language-repeats")
    once = rows.join(often, F.col("mark") == F.col("often_mark"), "left_anti").select("lang", "text")
    again = rows.join(often, F.col("mark") == F.col("often_mark"), "left_semi")
    return once.unionAll(again.select("lang", "id", "text").distinct().select("lang", "text"))


def _sample(docs: DataFrame, text: str, lang: str, id_: str, most: int) -> DataFrame:
    """(lang, text) of about ``most`` labelled rows of each language."""
    rows = _labelled(docs, text, lang, id_)
    # Sizes by distinct marks (of id and text): texts are not shuffled.
    sizes = rows.select(F.col("lang").alias("size_lang"), "mark").distinct().groupBy("size_lang").agg(F.count("*").alias("rows"))
    # Written, its size is known to the planner: a few languages are broadcast and the texts stay where they are.
    sizes = materialise(sizes, "language-sizes")
    place = F.pmod(F.col("mark"), F.lit(1 << 40)) / float(1 << 40)
    drawn = rows.join(sizes, F.col("lang") == F.col("size_lang")).where(place * F.col("rows") < most)
    return drawn.select("lang", "id", "text").distinct().select("lang", "text")


class Profiles:
    """Profiles as arrays: for each known n-gram its rank in each language."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.unique(np.array([r[1] for r in rows], dtype=np.int64)).astype(np.uint64)
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, dtype=np.int32)
        column = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, rank in rows:
            self.ranks[column[lang], np.searchsorted(self.grams, np.uint64(gram))] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language, and 1 minus its distance's share of the largest distance."""
        if text is None or not self.langs:
            return UNKNOWN, 0.0
        top = ranked(*ngram_counts(text), self.size)
        if not len(top):
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, top)
        at[at == len(self.grams)] = 0
        known = self.grams[at] == top
        places = self.ranks[:, np.where(known, at, len(self.grams))]
        out = np.where(places < 0, self.size, np.abs(places - np.arange(len(top))))
        distance = out.sum(axis=1)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (len(top) * self.size))


def collect_profiles(profiles: DataFrame, size: int = PROFILE_SIZE) -> Profiles:
    """At most ``size`` rows for each language, whatever the corpus."""
    return Profiles([(r.lang, r.gram, r.rank) for r in profiles.collect()], size)


def predict_language(docs: DataFrame, profiles: Profiles, text: str = "text",
                     carry: list[str] | None = None) -> DataFrame:
    """All rows (the columns in ``carry``, or all) with ``lang_pred`` and ``score``."""
    model = docs.sparkSession.sparkContext.broadcast(profiles)
    carry = docs.columns if carry is None else carry
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW), F.col(text).alias("text"))
    schema = T.StructType([rows.schema[ROW], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in slices(batches):
            found = [known.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(ROW), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                names=[ROW, "lang_pred", "score"])

    return unpack(map_arrow(rows, run, schema), ["lang_pred", "score"])


def held_out(id_: str = "doc_id") -> Column:
    """Rows kept out of training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_).cast("string")) % 4 == 2, F.lit(False))


def least_scores(held: DataFrame, known: Profiles, text: str = "text", lang: str = "lang", id_: str = "doc_id") -> dict[str, float]:
    """For each language of a profile the score below which a text is in none:
    ``SCORE_SHARE`` of the median score of its labelled rows in ``held``, which
    the profiles were not trained on (all of them, repeats once, like training), drawn to
    the median over all languages as by ``PRIOR_SCORED`` rows: a language with few
    or none is judged by the others. No entries if there are no such rows at all."""
    rows = _distinct_rows(held, text, lang, id_).where(F.col("lang").isin(known.langs))
    scored = predict_language(rows, known, carry=["lang"]).where(F.col("lang_pred") != UNKNOWN)
    # Counted by score in steps of 10**-SCORE_DIGITS: a bounded table, whatever the number of rows.
    counts = materialise(scored.groupBy("lang", F.round("score", SCORE_DIGITS).alias("score")).agg(F.count("*").alias("k")), "language-scores")
    medians = counts.groupBy("lang").agg(F.sum("k").alias("n"), F.percentile("score", 0.5, F.col("k")).alias("mid"))
    pooled = counts.agg(F.percentile("score", 0.5, F.col("k"))).first()[0]
    if pooled is None:
        return {}
    own = {r.lang: (r.n, r.mid) for r in medians.collect()}
    drawn = lambda n, mid: (n * mid + PRIOR_SCORED * pooled) / (n + PRIOR_SCORED)
    return {lang: SCORE_SHARE * drawn(*own.get(lang, (0, 0.0))) for lang in known.langs}


def filter_documents(docs: DataFrame, train_on: DataFrame | None = None, min_score: float = 0.05) -> DataFrame:
    """The rows whose text has a language: not ``und``, and a score of at least
    that language's entry in ``least_scores`` (``min_score`` if there are none). If
    no row can be trained on, every row that has a letter."""
    train = docs if train_on is None else train_on
    known = collect_profiles(train_profiles(train.where(~held_out())))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").alias("text"))
    predicted = predict_language(row, known, carry=["doc"])
    # Without a profile no text can be told from another: those with a letter stay.
    kept = F.col("doc.text").rlike(r"\p{L}")
    if known.langs:
        cuts = least_scores(train.where(held_out()), known)
        least = F.create_map(*[F.lit(x) for lang in known.langs for x in (lang, cuts.get(lang, min_score))])
        kept = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least[F.col("lang_pred")])
    return predicted.where(kept).select(*[F.col("doc")[c].alias(c) for c in docs.columns])
