"""A quality classifier: a generalised additive model with pairwise interactions.

*Measures.* A text gives ``MEASURES``, a few numbers about words, characters and lines,
over its whole length. They are computed once for all rows and written.

*Fit.* Labelled rows that are not held out meet their measures by id; of those about
``TRAIN_DOCS`` distinct ones, drawn by a hash of the row, go to the driver (at most
that many rows of ``len(MEASURES)`` numbers, whatever the input's size). Every measure
is cut into at most ``BINS`` bins of equal counts. Boosting goes round the measures:
each step fits a tree of up to three leaves to what is still unexplained, on one
measure alone, and adds a small part of it to that measure's lookup table. Then the
pairs that explain most of the rest get tables of ``PAIR_BINS`` x ``PAIR_BINS``
cells, from trees of four leaves over both measures, in the same round.

*Scores.* A row's bins are looked up and the entries added, for a batch at once; the
logistic function of the sum is the score.

Defined results: null text is empty, and an empty text is scored like any other; label
rows with a null id or a label other than 0 and 1 are ignored, and so is an id with
both labels; repeated rows count once in the fit and are all scored; without labels
every score is 0.5, with one label only the smoothed share; null ids are not held
out and have no labels; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm.common import map_arrow, materialise, slices, text_of

TRAIN_DOCS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 150
PAIR_ROUNDS = 40
RATE = 0.1
CAUTION = 1.0   # added to the weight of every leaf

MEASURES = ["words", "word_chars", "distinct", "commonest", "repeated", "upper", "symbols", "digits", "calls", "stops", "high",
            "line_words", "dup_lines", "longest"]
_LETTERS_UP, _LETTERS_LOW = slice(65, 91), slice(97, 123)
_SYMBOLS = [ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measure(text: str) -> list[float]:
    """``MEASURES`` of a whole text: numbers, or shares of words, bytes or lines."""
    raw = text.encode()
    found = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    words = _WORD.findall(text)
    n, size = max(1, len(words)), max(1, len(raw))
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    up, low = int(found[_LETTERS_UP].sum()), int(found[_LETTERS_LOW].sum())
    return [float(np.log1p(len(words))), sum(map(len, words)) / n, len(counts) / n, max(counts.values(), default=0) / n,
            sum(map(str.__eq__, words, words[1:])) / n, up / max(1, up + low), int(found[_SYMBOLS].sum()) / size, int(found[48:58].sum()) / size,
            int(found[33] + found[63]) / n, int(found[46]) / n, int(found[128:].sum()) / size, float(np.log1p(len(words) / max(1, len(lines)))),
            1 - len(set(lines)) / max(1, len(lines)), float(np.log1p(max(map(len, words), default=0)))]


def _measure_rows(kept: list[str], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [measure(t) for t in batch.column("_text").to_pylist()]
            table = np.array(rows, dtype=np.float64).reshape(len(rows), len(MEASURES))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(np.ascontiguousarray(c)) for c in table.T)], names=names)

    return run


def measure_documents(docs: DataFrame, kept: dict[str, Column], text: str = "text") -> DataFrame:
    """Columns ``kept`` and the measures of every row, written."""
    rows = docs.select(*[c.alias(n) for n, c in kept.items()], text_of(text).alias("_text"))
    schema = T.StructType([*rows.drop("_text").schema, *[T.StructField(m, T.DoubleType()) for m in MEASURES]])
    return materialise(map_arrow(rows, _measure_rows(list(kept), schema.names), schema), "quality-measures")


@dataclass
class Model:
    """Log-odds as sums of table entries."""
    base: float
    edges: list[np.ndarray] = field(default_factory=list)     # of every measure, between its bins
    tables: list[np.ndarray] = field(default_factory=list)    # of every measure
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)     # of every pair

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], axis=1) if self.edges else np.zeros((len(x), 0), int)

    def coarse(self, bins: np.ndarray, f: int) -> np.ndarray:
        return bins[:, f] * PAIR_BINS // (len(self.edges[f]) + 1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        bins = self.bins(x)
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[bins[:, f]]
        for (a, b), grid in zip(self.pairs, self.grids):
            total += grid[self.coarse(bins, a), self.coarse(bins, b)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return logistic(self.log_odds(x))


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + CAUTION)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The best cut of a row of bins in two: (gain over none, bins on the left)."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gains))
    return float(gains[at]), at + 1


def _small_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A tree of up to three leaves over ordered bins: the value of every bin."""
    gain, at = _cut(g, h)
    cuts = [0, len(g)] if gain <= 0 else [0, at, len(g)]
    more = [(*_cut(g[a:b], h[a:b]), a) for a, b in zip(cuts, cuts[1:])]
    gain, at, start = max(more)
    if gain > 0 and len(cuts) == 3:
        cuts = sorted({*cuts, start + at})
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + CAUTION)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The better of both ways to cut by one measure, then each side by the other."""
    best, out = -1.0, np.zeros(g.shape)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for at in range(1, len(gg)):
            value, total = np.zeros(gg.shape), 0.0
            for a, b in ((0, at), (at, len(gg))):
                sg, sh = gg[a:b].sum(axis=0), hh[a:b].sum(axis=0)
                _, cut = _cut(sg, sh)
                for c, d in ((0, cut), (cut, len(sg))):
                    if c < d:
                        total += float(_gain(sg[c:d].sum(), sh[c:d].sum()))
                        value[a:b, c:d] = sg[c:d].sum() / (sh[c:d].sum() + CAUTION)
            if total > best:
                best, out = total, value.T if turned else value
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """The model of labels ``y`` (0, 1) by measures ``x`` (a row each)."""
    ones = float(y.sum())
    model = Model(float(np.log((ones + 1) / (len(y) - ones + 1))))
    if ones == 0 or ones == len(y):
        return model
    cuts = np.arange(1, BINS) / BINS
    model.edges = [np.unique(np.quantile(x[:, f], cuts, method="inverted_cdf")) for f in range(x.shape[1])]
    bins = model.bins(x)
    z = np.full(len(y), model.base)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]

    def pull() -> tuple[np.ndarray, np.ndarray]:
        p = logistic(z)
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f, table in enumerate(model.tables):
            g, h = pull()
            step = RATE * _small_tree(np.bincount(bins[:, f], g, len(table)), np.bincount(bins[:, f], h, len(table)))
            table += step
            z += step[bins[:, f]]
    cells = {}
    for a in range(x.shape[1]):
        for b in range(a):
            cells[b, a] = model.coarse(bins, b) * PAIR_BINS + model.coarse(bins, a)

    def grid_of(weights: np.ndarray, cell: np.ndarray) -> np.ndarray:
        return np.bincount(cell, weights, PAIR_BINS * PAIR_BINS).reshape(PAIR_BINS, PAIR_BINS)

    g, h = pull()
    model.pairs = sorted(cells, key=lambda k: (-_pair_tree(grid_of(g, cells[k]), grid_of(h, cells[k]))[0], k))[:PAIRS]
    model.grids = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for pair, grid in zip(model.pairs, model.grids):
            g, h = pull()
            step = RATE * _pair_tree(grid_of(g, cells[pair]), grid_of(h, cells[pair]))[1]
            grid += step
            z += step.ravel()[cells[pair]]
    return model


def held_out(id_: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_).cast("string")) % 5 == 0, F.lit(False))


def training_rows(measured: DataFrame, labels: DataFrame, id_: str = "doc_id", label: str = "quality") -> DataFrame:
    """(``_label``, measures) of about ``TRAIN_DOCS`` distinct labelled rows that are not held out."""
    known = labels.where(F.col(id_).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(id_).alias("_id")).agg(
        F.min(label).alias("_label"), F.max(label).alias("_most")).where("_label = _most").drop("_most")
    # Written, so that the join meets two plain shuffles: of such AQE can split an id with very many rows.
    known = materialise(known, "quality-labels")
    rows = materialise(measured.where(~held_out(id_)).join(known, F.col(id_) == F.col("_id")).select("_id", "_label", *MEASURES).distinct(),
                       "quality-labelled")
    share = TRAIN_DOCS / max(TRAIN_DOCS, rows.count())
    return rows.where(F.pmod(F.xxhash64("_id", *MEASURES), F.lit(1 << 30)) < int(share * (1 << 30))).drop("_id")


def train(measured: DataFrame, labels: DataFrame, id_: str = "doc_id", label: str = "quality") -> Model:
    sample = training_rows(measured, labels, id_, label).toArrow()
    y = sample.column("_label").to_numpy().astype(np.float64)
    x = np.stack([sample.column(m).to_numpy() for m in MEASURES], axis=1)
    order = np.lexsort((*x.T[::-1], y))  # sums do not depend on partitions
    return fit(x[order], y[order])


def score_documents(measured: DataFrame, model: Model) -> DataFrame:
    """``measured`` with ``score`` in place of the measures."""
    kept = [c for c in measured.columns if c not in MEASURES]
    schema = T.StructType([*measured.select(*kept).schema, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(m).to_numpy(zero_copy_only=False) for m in MEASURES], axis=1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(model.score(x))], names=schema.names)

    return map_arrow(measured, run, schema)
