"""Quality rules with adaptive thresholds.

Every text gets a few integer measures. Instead of one fixed cutoff for each,
a threshold per language and source is read from quantile sketches of the
corpus itself and joined back to the rows.

The sketch is a log-linear histogram: a value keeps its ``SKETCH_BITS`` leading
bits, so a quantile is off by at most 1 part in 2**(SKETCH_BITS-1). Two
sketches merge by adding counts, in any order and grouping, with the same
result: source sketches merge into language sketches and those into one of the
corpus. A sketch has
at most ``2**(SKETCH_BITS-1) * 64`` counts, however many rows it covers, and is
pre-aggregated before each shuffle, so a source with a third of all rows moves
no more than any other.

A limit comes from the lower half of a group, its median and first quartile: rows
with a defect, up to a half of the group, do not widen it. A group's limit is drawn to
that of the wider group as by ``PRIOR`` rows of it, so a small group has no limit of
its own making, and is at most ``BOUND`` times as wide: a source that is junk
throughout is judged by its language, a language by the corpus.

Only DataFrame functions are used.

Defined results: null or empty text has no words and fails the base rules; null
language or source is a group of its own; an empty table gives an empty result;
repeated rows are judged (and counted) one by one; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from carelake.llm.common import GAP_CHARS, ROW, let, materialise, text_of, unpack, words_of

SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
SKETCH_BITS = 8
PRIOR = 200
BOUND = 2
FENCE = 3
MIN_WORDS = 20

# Measures judged by an upper fence: name -> least spread taken for the fence, in
# the measure's own unit (thousandths). That of ``repeats`` leaves its fence room
# below the base rule of 300.
MEASURES = {"symbols": 100, "dup_lines": 100, "repeats": 90, "upper": 100, "word_length": 500}

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(words: Column) -> Column:
    """Words inside the 8-word windows that are found twice or more. Windows
    are compared by 64-bit hash within one text (a text of 100,000 words has a
    false match with probability below 1e-9)."""
    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            same = lambda e, at: F.coalesce(F.get(s, at)["h"] == e["h"], F.lit(False))
            twice = F.filter(s, lambda e, at: same(e, at - 1) | same(e, at + 1))
            return F.sort_array(F.transform(twice, lambda e: e["i"]))

        def total(p: Column) -> Column:
            step = lambda i, at: F.least(F.lit(WINDOW_WORDS), i - F.coalesce(F.get(p, at - 1), F.lit(-WINDOW_WORDS)))
            return F.aggregate(F.transform(p, step), F.lit(0), lambda a, x: a + x)

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)) \
            .otherwise(let(let(pairs, positions), total))

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW_WORDS - 1)),
                          lambda i: F.xxhash64(F.slice(words, i, WINDOW_WORDS)))
    return F.when(F.size(words) < WINDOW_WORDS + 1, F.lit(0)).otherwise(let(windows, covered))


def base_measures(text: Column) -> Column:
    """A struct of the base counts of one text."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(words_of(text), lambda words: F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(text, GAP_CHARS, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
                                      F.size(x).cast("long").alias("all"))).alias("lines"),
        _repeat_words(words).cast("long").alias("n_repeat_words"),
        (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_upper")))


def _measures() -> dict[str, Column]:
    """The judged measures, in thousandths. ``div`` by at least one."""
    per = lambda a, b: F.expr(f"({a}) * 1000 div greatest({b}, 1)")
    return {
        "symbols": per("m.n_symbols", "m.n_words"),
        # Five more lines in the divisor: one equal line in a text of three is no pattern.
        "dup_lines": per("m.lines.dup", "m.lines.all + 5"),
        "repeats": per("m.n_repeat_words", "m.n_words"),
        "upper": per("m.n_upper", "m.word_chars"),
        # Ten more words in the divisor: the mean of a short text varies more.
        "word_length": per("m.word_chars", "m.n_words + 10"),
    }


def sketch_bucket(value: Column) -> Column:
    """The value with all but its leading ``SKETCH_BITS`` bits cleared."""
    drop = F.greatest(F.lit(0), F.length(F.bin(value)) - SKETCH_BITS)
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def build_sketches(rows: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """One row (keys, measure, bucket, n) for each non-empty bucket."""
    long = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), sketch_bucket(F.col(m)).alias("bucket"))
                               for m in measures])).alias("s")
    return (rows.select(*keys, long).groupBy(*keys, "s.measure", "s.bucket").agg(F.count("*").alias("n")))


def merge_sketches(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser groups: counts of equal buckets add up."""
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketch: DataFrame, keys: list[str], probabilities: dict[str, int]) -> DataFrame:
    """Per (keys, measure): the row count and the named quantiles (percent)."""
    group = W.partitionBy(*keys, "measure")
    ranked = sketch.withColumns({
        "below": F.sum("n").over(group.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)),
        "rows": F.sum("n").over(group)})
    return ranked.groupBy(*keys, "measure").agg(
        F.first("rows").alias("rows"),
        *[F.min(F.when(F.col("below") * 100 >= F.col("rows") * p, F.col("bucket"))).alias(q)
          for q, p in probabilities.items()])


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Per group its row count and a struct of upper limits, by measure: the median
    plus ``FENCE`` times the spread, twice the distance from the first quartile."""
    q = sketch_quantiles(sketch, keys, {"q1": 25, "q2": 50})
    least = F.create_map(*[F.lit(x) for kv in MEASURES.items() for x in kv])
    limit = F.col("q2") + FENCE * F.greatest(2 * (F.col("q2") - F.col("q1")), least[F.col("measure")])
    limits = [F.max(F.when(F.col("measure") == m, limit)).alias(m) for m in MEASURES]
    return q.groupBy(*keys).agg(F.max("rows").alias("rows"), F.struct(*limits).alias("limits"))


def drawn(rows: str, limits: str, wider: str) -> Column:
    """Limits of a group of ``rows`` rows, drawn to those of the ``wider`` one and bounded by them."""
    one = lambda m: F.expr(f"least(({rows} * {limits}.{m} + {PRIOR} * {wider}.{m}) div ({rows} + {PRIOR}), {BOUND} * {wider}.{m})")
    return F.struct(*[one(m).alias(m) for m in MEASURES])


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
          min_words: int = MIN_WORDS, carry: list[str] | None = None) -> DataFrame:
    """All rows (the columns in ``carry``, or all) with ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, ``base_failed`` and ``kept``.

    ``base_failed``: under ``min_words`` words, or over 30 % of the words in repeated
    windows. ``kept``: not base_failed, and no measure above the fence of the
    row's language and source. Sketches count the rows that pass the base rules.
    The measures are taken in one pass over the texts and written."""
    carry = docs.columns if carry is None else carry
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW)
    measured = docs.select(row, F.col(lang).alias("g_lang"), F.col(source).alias("g_source"),
                           base_measures(text_of(text)).alias("m"))
    measured = measured.select(ROW, "g_lang", "g_source", *[
        (F.col("m.lines.dup") if c == "n_dup_lines" else F.col(f"m.{c}")).alias(c) for c in BASE],
        *[c.alias(f"x_{n}") for n, c in _measures().items()]) \
        .withColumn("base_failed", F.expr(f"n_words < {min_words} or 100 * n_repeat_words > 30 * n_words"))
    measured = materialise(measured, "quality-measures")

    names = {f"x_{m}": m for m in MEASURES}
    passing = measured.where("not base_failed").withColumnsRenamed(names)
    by_source = materialise(build_sketches(passing, ["g_lang", "g_source"], list(MEASURES)), "quality-sketches")
    by_lang = merge_sketches(by_source, ["g_lang"])
    overall = merge_sketches(by_source, [])
    f_source = fences(by_source, ["g_lang", "g_source"]).select(
        F.col("g_lang").alias("t_lang"), F.col("g_source").alias("t_source"), F.col("rows").alias("r1"), F.col("limits").alias("l1"))
    f_lang = fences(by_lang, ["g_lang"]).select(F.col("g_lang").alias("u_lang"), F.col("rows").alias("r2"), F.col("limits").alias("l2"))
    widest = fences(overall, []).first()  # one row of limits
    f_all = F.struct(*[F.lit(widest.limits[m]).cast("long").alias(m) for m in MEASURES]) if widest and widest.limits \
        else F.lit(None).cast("struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">")
    # One fence per (language, source) that occurs.
    chosen = (f_source.join(f_lang, F.col("t_lang").eqNullSafe(F.col("u_lang")), "left").withColumn("l3", f_all)
              .withColumn("l2", drawn("r2", "l2", "l3")).select("t_lang", "t_source", drawn("r1", "l1", "l2").alias("limits")))
    # Written, its size is known to the planner: few groups are broadcast, and
    # the rows with their texts stay where they are.
    chosen = materialise(chosen, "quality-fences")
    joined = measured.join(chosen, F.col("g_lang").eqNullSafe(F.col("t_lang"))
                           & F.col("g_source").eqNullSafe(F.col("t_source")), "left")
    over = F.lit(False)
    for m in MEASURES:
        over = over | (F.col(f"x_{m}") > F.col("limits")[m])
    judged = joined.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(over, F.lit(False)))
    return unpack(judged, [*BASE, "base_failed", "kept"])


def filter_documents(docs: DataFrame, min_words: int = MIN_WORDS, **columns) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns only."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                      F.col(columns.get("text", "text")).alias("text"),
                      F.col(columns.get("lang", "lang")).alias("lang"),
                      F.col(columns.get("source", "source")).alias("source"))
    kept = judge(row, min_words=min_words, carry=["doc"]).where("kept")
    return kept.select(*[F.col("doc")[c].alias(c) for c in docs.columns])
