"""Removal of repeated word passages by recompression.

A window is ``window`` (35) consecutive words of one text; every word covered by
a window whose words also start anywhere else in the corpus is removed.

*Recompression.* The words of a text are named by content hash, then renamed in
rounds: a run round gives every maximal run of one symbol a name made of the
symbol and the run's length; a pair round gives every symbol a coin (a bit of
its name) and joins each neighbouring pair with coins 0, 1 under a name made of
the two. Names are functions of content alone, so all tasks give equal things
equal names without a shared dictionary, and where a round joins depends only on
neighbouring symbols: equal passages get equal symbols but near their ends. How
far a symbol depends on what is around it is tracked (its reach).

*Shared symbols.* Pairs of neighbouring last-round symbols whose reach fits into
a window are counted over the corpus in a Spark round. A window that holds the
whole reach of a pair seen only once in the corpus cannot be repeated. So most
windows of text that is not repeated are ruled out.

*Verification.* The windows left are compared over the corpus by a 128-bit hash
of their words in a second Spark round (64 bits of it sort, all 128 decide), and
the words that the repeated ones cover are removed.

Both rounds send, for each chunk of texts, the sorted distinct hashes once, cut
into buckets by value, and get back one bit for each: is it also elsewhere? So a
passage in a third of all rows costs one hash for each chunk that has it, and no
group of equal passages is ever gathered or paired. Chunks are dealt by row key
and hold about ``CHUNK_BYTES`` of text; a text is never split. Symbols, windows
and positions are not kept between rounds but computed again from the texts.

Defined results: null or empty text has no words; a text with fewer words than
the window keeps all; repeated rows are texts of their own (so copies of 35 words
and more lose all words); an empty table gives an empty result; extra columns
pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm.common import ROW, map_arrow, materialise, release_shuffles, ship_package, slices

WINDOW = 35
ROUNDS = ("run", "pair", "pair", "pair", "pair")
CHUNK_BYTES = 2 << 20
BUCKET_CHUNKS = 4   # a bucket gets about as many hashes as so many chunks send
_FAR = -(1 << 40)
U = np.uint64
_A, _B, _C = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * _A
    return x ^ (x >> U(29))


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mix(a * _B + b * _C + (a >> U(31)))


class Words:
    """The words of some texts in one sequence, a separator after each text."""

    def __init__(self, texts: list[str | None]):
        self.words = [(t or "").encode().split() for t in texts]
        counts = np.array([len(w) for w in self.words], dtype=np.int64)
        self.begins = np.concatenate(([0], np.cumsum(counts + 1)))[:-1]
        n = int(counts.sum()) + len(texts)
        self.gap = np.zeros(n, dtype=bool)
        self.gap[self.begins + counts] = True
        digest = xxhash.xxh3_128_digest
        hashes = np.frombuffer(b"".join([digest(w) for ws in self.words for w in ws]), dtype="<u8").reshape(-1, 2)
        self.high, self.low = np.zeros(n, dtype=U), np.zeros(n, dtype=U)
        self.high[~self.gap], self.low[~self.gap] = hashes[:, 0], hashes[:, 1]


def recompress(names: np.ndarray, gap: np.ndarray, rounds=ROUNDS):
    """Symbols after the rounds: (names, reach begin, reach end, is separator).
    Equal word sequences over a reach give the symbol equal name and place."""
    n = len(names)
    begin, end = np.arange(n), np.arange(1, n + 1)
    for level, kind in enumerate(rounds):
        if len(names) < 2:
            break
        if kind == "run":
            joined = (names[1:] == names[:-1]) & ~gap[1:] & ~gap[:-1]
        else:
            coin = (names >> U(7 * level + 1)) & U(1)
            joined = (coin[:-1] == 0) & (coin[1:] == 1) & ~gap[1:] & ~gap[:-1]
        first = np.flatnonzero(np.concatenate(([True], ~joined)))
        last = np.concatenate((first[1:] - 1, [len(names) - 1]))
        length = last - first + 1
        if kind == "run":
            new = np.where(length > 1, _join(names[first], length.astype(U)), names[first])
        else:
            new = np.where(length > 1, _join(names[first], names[last]), names[first])
        # What a symbol is depends on its neighbours: they might have joined it.
        # The first symbol of all has none to its left: its reach fits nowhere.
        begin, end = np.where(first > 0, begin[first - 1], _FAR), end[np.minimum(last + 1, len(names) - 1)]
        names, gap = new, gap[first]
    return names, begin, end, gap


def symbol_pairs(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of neighbouring symbol pairs whose reach fits a window, with the reach."""
    names, begin, end, gap = recompress(words.high, words.gap)
    if len(names) < 2:
        return np.empty(0, U), np.empty(0, np.int64), np.empty(0, np.int64)
    inside = np.concatenate(([0], np.cumsum(words.gap)))
    fits = np.flatnonzero(~gap[1:] & ~gap[:-1] & (end[1:] - begin[:-1] <= window))
    fits = fits[inside[end[fits + 1]] == inside[begin[fits]]]  # the reach has no separator
    return _join(names[fits], names[fits + 1]), begin[fits], end[fits + 1]


def window_hashes(x: np.ndarray, window: int) -> np.ndarray:
    """A hash of each ``window`` consecutive entries, by doubling."""
    total, have, step, power = None, 0, 1, x
    while True:
        if window & step:
            if total is None:
                total, have = power, step
            else:
                size = len(x) - have - step + 1
                total, have = _join(total[:size], power[have:have + size]), have + step
        if have == window:
            return total
        power = _join(power[:-step], power[step:])
        step *= 2


def _cuts(sorted_names: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of values that hold something, ascending, and where each begins, with the end."""
    bucket = ((sorted_names >> U(32)) * U(buckets)) >> U(32)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.empty(0, np.int64)
    return bucket[first].astype(np.int64), np.concatenate((first, [len(bucket)]))


def _send(names: np.ndarray, check: np.ndarray | None, buckets: int) -> list[tuple[int, bytes, bytes]]:
    held, cuts = _cuts(names, buckets)
    return [(b, names[i:j].tobytes(), b"" if check is None else check[i:j].tobytes())
            for b, i, j in zip(held.tolist(), cuts.tolist(), cuts[1:].tolist())]


def _received(names: np.ndarray, buckets: int, answers: pa.Table) -> np.ndarray:
    """For each sorted distinct name: was it found in another chunk?"""
    found = np.zeros(len(names), dtype=bool)
    held, cuts = _cuts(names, buckets)
    for b, bits in zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist()):
        if bits is not None and b is not None and b >= 0:
            at = int(np.searchsorted(held, b))
            size = int(cuts[at + 1] - cuts[at])
            found[cuts[at]:cuts[at + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=size).astype(bool)
    return found


SENT = "chunk long, bucket long, names binary, check binary"


def _sent_table(chunk: int, parts: list[tuple[int, bytes, bytes]]) -> pa.Table:
    return pa.table([pa.array([chunk] * len(parts), pa.int64()), pa.array([p[0] for p in parts], pa.int64()),
                     pa.array([p[1] for p in parts], pa.binary()), pa.array([p[2] for p in parts], pa.binary())],
                    names=["chunk", "bucket", "names", "check"])


def elsewhere(sent: DataFrame) -> DataFrame:
    """One Spark round: for each chunk and bucket, a bit for each hash sent that
    another chunk has sent as well (no row where none was)."""
    def compare(bucket: pa.Table) -> pa.Table:
        chunks = bucket.column("chunk").to_pylist()
        parts = [np.frombuffer(x, U) for x in bucket.column("names").to_pylist()]
        names, check = np.concatenate(parts), None
        order = np.argsort(names)
        ordered = names[order]
        equal = ordered[1:] == ordered[:-1]
        if len(bucket.column("check")[0].as_py()):
            check = np.concatenate([np.frombuffer(x, U) for x in bucket.column("check").to_pylist()])
            if (equal & (check[order][1:] != check[order][:-1])).any():
                order = np.lexsort((check, names))
                ordered = names[order]
            by_check = check[order]
            equal = (ordered[1:] == ordered[:-1]) & (by_check[1:] == by_check[:-1])
        found = np.zeros(len(names), dtype=bool)
        found[order[1:][equal]] = True
        found[order[:-1][equal]] = True
        cuts = np.cumsum([0, *map(len, parts)]).tolist()
        bits = [np.packbits(found[i:j]).tobytes() if found[i:j].any() else None for i, j in zip(cuts, cuts[1:])]
        out = [(c, bucket.column("bucket")[0].as_py(), b) for c, b in zip(chunks, bits) if b is not None]
        return pa.table([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                        names=["chunk", "bucket", "bits"])

    return sent.groupBy("bucket").applyInArrow(compare, "chunk long, bucket long, bits binary")


def _gather(row_type: T.StructType):
    """Consecutive rows of a task as chunks: the carried rows in an array, the
    texts compressed together."""
    names = ["rows", "texts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def chunk() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            texts = table.select(["text"])
            with pa.ipc.new_stream(sink, texts.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(texts)
            rows = table.column(ROW).combine_chunks()
            rows = rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                                               pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=names)

        for batch in slices(batches, 64):
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= CHUNK_BYTES:
                yield chunk()
                held, size = [], 0
        if held:
            yield chunk()

    return run, T.StructType([T.StructField("rows", T.ArrayType(row_type)), T.StructField("texts", T.BinaryType())])


def _texts(chunk: pa.Table) -> list[str | None]:
    return pa.ipc.open_stream(chunk.column("texts")[0].as_py()).read_all().column("text").to_pylist()


def candidates(words: Words, window: int, once: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold no reach of a pair that is seen once."""
    n = len(words.gap) - window + 1
    if n <= 0:
        return np.empty(0, np.int64)
    gaps = np.concatenate(([0], np.cumsum(words.gap)))
    open_ = gaps[window:] == gaps[:n]
    lo, hi = np.clip(end[once] - window, 0, n), np.clip(begin[once] + 1, 0, n)
    change = np.bincount(lo, minlength=n + 1) - np.bincount(hi, minlength=n + 1)
    return np.flatnonzero(open_ & (np.cumsum(change)[:n] == 0))


def remove_repeats(docs: DataFrame, text: str = "text", carry: list[str] | None = None, window: int = WINDOW) -> DataFrame:
    """All rows: ROW (the carried columns; by default all but the text), the
    original text as ``text``, ``n_words``, ``n_removed``, ``removed`` (spans of
    words, end exclusive) and ``kept`` (the words left, joined by one space)."""
    spark = docs.sparkSession
    ship_package(spark)
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    # A struct needs a field: one of our own for tables of texts alone.
    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(True).alias("_"))
    rows = docs.select(row.alias(ROW), F.col(text).cast("string").alias("text"))
    gather, schema = _gather(rows.schema[ROW].dataType)
    chunks = materialise(map_arrow(rows, gather, schema).withColumn("chunk", F.monotonically_increasing_id()), "substring-chunks")
    buckets = max(1, -(-chunks.count() // BUCKET_CHUNKS))
    texts = chunks.select("chunk", "texts")

    def send_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            pairs, _, _ = symbol_pairs(Words(_texts(batch)), window)
            yield from _sent_table(batch.column("chunk")[0].as_py(), _send(np.unique(pairs), None, buckets)).to_batches()

    pairs = elsewhere(map_arrow(texts, send_pairs, SENT)).withColumn("kind", F.lit("pairs"))
    pairs = materialise(pairs, "substring-pairs")
    release_shuffles(spark)

    def open_windows(chunk: pa.Table, answers: pa.Table):
        """The windows of a chunk that may be repeated: texts' words, starts,
        number of each in the sorted distinct hashes, those (two parts)."""
        words = Words(_texts(chunk))
        pairs, begin, end = symbol_pairs(words, window)
        names, at, count = np.unique(pairs, return_inverse=True, return_counts=True)
        shared = (count > 1) | _received(names, buckets, answers.filter(pa.compute.equal(answers.column("kind"), "pairs")))
        starts = candidates(words, window, ~shared[at], begin, end)
        if not len(starts):
            return words, starts, starts, np.empty(0, U), np.empty(0, U)
        high, low = window_hashes(words.high, window)[starts], window_hashes(words.low, window)[starts]
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        new = np.concatenate(([True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])))
        which = np.empty(len(starts), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        return words, starts, which, high[new], low[new]

    def send_windows(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return _sent_table(0, [])
        _, _, _, high, low = open_windows(chunk, answers)
        return _sent_table(chunk.column("chunk")[0].as_py(), _send(high, low, buckets))

    sent = texts.groupBy("chunk").cogroup(pairs.groupBy("chunk")).applyInArrow(send_windows, SENT)
    repeats = materialise(elsewhere(sent).withColumn("kind", F.lit("windows")), "substring-windows")
    release_shuffles(spark)
    span = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([T.StructField(ROW, chunks.schema["rows"].dataType.elementType), T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("removed", span), T.StructField("kept", T.StringType())])

    def remove(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        kinds = [pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))]
        if not chunk.num_rows:
            return pa.table([chunk.column("rows").combine_chunks().flatten(), pa.array([], pa.string()), pa.array([], pa.int64()),
                             pa.array([], pa.int64()), pa.array([], kinds[0]), pa.array([], pa.string())], names=schema.names)
        words, starts, which, high, _ = open_windows(chunk, answers)
        repeated = (np.bincount(which, minlength=len(high)) > 1) | _received(
            high, buckets, answers.filter(pa.compute.equal(answers.column("kind"), "windows")))
        starts = starts[repeated[which]]
        change = np.bincount(starts, minlength=len(words.gap) + 1) - np.bincount(starts + window, minlength=len(words.gap) + 1)
        covered = np.cumsum(change) > 0
        n_words, n_removed, removed, kept = [], [], [], []
        for own, at in zip(words.words, words.begins.tolist()):
            gone = covered[at:at + len(own)]
            n_words.append(len(own))
            n_removed.append(int(gone.sum()))
            spans = []
            if n_removed[-1]:
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).tolist()
                spans = [{"begin": a, "end": b} for a, b in zip(edges[::2], edges[1::2])]
                own = [w for w, g in zip(own, gone.tolist()) if not g]
            removed.append(spans)
            kept.append(b" ".join(own).decode())
        return pa.table([chunk.column("rows").combine_chunks().flatten(), pa.array(_texts(chunk), pa.string()), pa.array(n_words, pa.int64()),
                         pa.array(n_removed, pa.int64()), pa.array(removed, kinds[0]), pa.array(kept, pa.string())], names=schema.names)

    return chunks.groupBy("chunk").cogroup(pairs.union(repeats).groupBy("chunk")).applyInArrow(remove, schema)


def strip_documents(docs: DataFrame, text: str = "text", length: str | None = None, window: int = WINDOW) -> DataFrame:
    """``docs`` with the words left as the text of the rows that lost some
    (joined by one space), and its length in the column ``length``; the other
    rows stay as they are."""
    others = [c for c in docs.columns if c != text]
    done = remove_repeats(docs, text, others, window)
    lost = F.col("n_removed") > 0
    new = {text: F.when(lost, F.col("kept")).otherwise(F.col("text"))}
    if length:
        old = F.col(ROW)[length]
        new[length] = F.when(lost, F.length("kept").cast(docs.schema[length].dataType)).otherwise(old)
    return done.select(*[new.get(c, F.col(ROW)[c] if c != text else None).alias(c) for c in docs.columns])
