"""Packing token pieces into fixed windows by multiway number differencing.

A document is its token ids and an end id. It is cut into full windows and a
rest; the rest is cut into pieces of at most ``max_piece`` tokens. Full windows
need no company. The other pieces are dealt by hash into blocks of about
``BLOCK_WINDOWS`` windows, so any number of pieces is packed by many tasks of
one size, and inside a block by Karmarkar-Karp differencing: every piece starts
as a partial partition (its length and empty windows); the two partial
partitions of largest imbalance are merged again and again, the fullest window
of one with the emptiest of the other, until one near-equal partition is left.
If a window exceeds the capacity the block gets one window more and starts anew.

Token ids are computed once, in the tasks that hold the texts; only the pieces
(a few numbers each) are written and shuffled. They are those of the
``tokenizers`` library in its default setting: an added token of the file that
a text holds is one id.

Defined results: a null text is empty (its one token is the end id); repeated
rows are packed one by one; an empty table gives an empty result; the text's
other columns are not read, except those named in ``carry``.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm.common import ROW, map_arrow, materialise, ship_package, slices, unpack

WINDOW = 1024
MAX_PIECE = 128
BLOCK_WINDOWS = 128
END_ID = 0


@lru_cache(maxsize=2)
def byte_bpe(path: str, pattern: str):
    """Encoders of a byte-level BPE vocabulary file (``tokenizers`` JSON).

    The merge ranks are the ids of the merged tokens, so the same ids come from
    a rank encoder. Without runs of white space the pattern needs no look-ahead,
    which is faster to match: (plain, full) encoders."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in printable}
    byte_of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in byte_of.values())}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if all(c in byte_of for c in token)}
    special = {token: i for token, i in vocabulary.items() if token.startswith("<|") and token.endswith("|>")}
    for token in special:
        ranks.pop(token.encode(), None)
    make = lambda pat: tiktoken.Encoding("byte-bpe", pat_str=pat, mergeable_ranks=ranks, special_tokens={})
    return make(pattern.replace(r"|\s+(?!\S)", "")), make(pattern)


_RUN = re.compile(r"\s\s")


@lru_cache(maxsize=2)
def added_tokens(path: str) -> tuple[re.Pattern, dict[str, int]] | None:
    """The file's added tokens, which the library takes out of a text before the
    rest is encoded: a pattern with them as its one group (of those that begin at
    one place the longest), and their ids."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens") or []
    odd = [t["content"] for t in added if t.get("single_word") or t.get("lstrip") or t.get("rstrip")]
    if odd:
        raise ValueError(f"added tokens with single_word, lstrip or rstrip: {odd}")
    ids = {t["content"]: t["id"] for t in added if t["content"]}
    longest = sorted(ids, key=len, reverse=True)
    return (re.compile("(" + "|".join(map(re.escape, longest)) + ")"), ids) if ids else None


def token_ids(text: str, encoders, added: tuple[re.Pattern, dict[str, int]] | None = None) -> np.ndarray:
    plain, full = encoders
    ids = []
    # With one group, every second part is an added token.
    for i, part in enumerate(added[0].split(text) if added else [text]):
        if i % 2:
            ids.append(added[1][part])
        elif part:
            ids += (full if _RUN.search(part) else plain).encode_ordinary(part)
    return np.array(ids, dtype="<u4")


def cut(n: int, window: int, max_piece: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: full windows, then a rest
    in near-equal parts of at most ``max_piece``."""
    whole = n // window
    pieces = [(i * window, window) for i in range(whole)]
    rest = n - whole * window
    if rest:
        parts = -(-rest // max_piece)
        ends = [rest * i // parts for i in range(parts + 1)]
        pieces += [(whole * window + a, b - a) for a, b in zip(ends, ends[1:])]
    return pieces


def difference(lengths: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp multiway differencing: positions of ``lengths`` in
    ``windows`` near-equal parts."""
    # (minus imbalance, tie, sums over the least, members); the longest parts only:
    # a partial partition keeps at most ``windows`` non-empty parts, largest first.
    heap = [(-n, i, [n], [[i]]) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    tie = len(heap)
    while len(heap) > 1:
        _, _, s1, m1 = heapq.heappop(heap)
        _, _, s2, m2 = heapq.heappop(heap)
        # Opposing imbalances: the largest of one meet the smallest of the other.
        over = len(s1) + len(s2) - windows
        if over <= 0:
            sums, members = s1 + s2, m1 + m2
        else:
            # Parts beyond the non-empty ones are empty (sum 0), at the end.
            big1, big2 = len(s1) - over, len(s2) - over
            joined = [(s1[big1 + k] + s2[len(s2) - 1 - k], m1[big1 + k] + m2[len(s2) - 1 - k]) for k in range(over)]
            sums = s1[:big1] + s2[:big2] + [s for s, _ in joined]
            members = m1[:big1] + m2[:big2] + [m for _, m in joined]
        order = sorted(range(len(sums)), key=lambda k: -sums[k])
        sums, members = [sums[k] for k in order], [members[k] for k in order]
        if len(sums) == windows:
            least = sums[-1]
            spread = sums[0] - least
        else:
            spread = sums[0]
        heapq.heappush(heap, (-spread, tie, sums, members))
        tie += 1
    return heap[0][3] if heap else []


def pack_block(lengths: list[int], window: int) -> list[list[int]]:
    """Windows of at most ``window`` tokens; one window more while any exceeds it."""
    count = max(1, -(-sum(lengths) // window))
    while True:
        parts = difference(lengths, count)
        if all(sum(lengths[i] for i in part) <= window for part in parts):
            return parts
        count += 1


PIECE = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")])


def pieces(docs: DataFrame, tokenizer: str, pattern: str, carry: list[str], text: str = "text",
           window: int = WINDOW, max_piece: int = MAX_PIECE) -> DataFrame:
    """One row per piece: ROW (the carried columns), start, length, ids_crc32, doc_tokens."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias(ROW), F.col(text).alias("text"))
    schema = T.StructType([rows.schema[ROW], *PIECE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders, added = byte_bpe(tokenizer, pattern), added_tokens(tokenizer)
        for batch in slices(batches):
            at, out = [], []
            for i, t in enumerate(batch.column("text").to_pylist()):
                ids = np.append(token_ids(t or "", encoders, added), np.uint32(END_ID)).astype("<u4")
                raw = memoryview(ids.tobytes())
                for start, length in cut(len(ids), window, max_piece):
                    at.append(i)
                    out.append((start, length, zlib.crc32(raw[4 * start:4 * (start + length)]), len(ids)))
            table = pa.RecordBatch.from_arrays([batch.column(ROW)], names=[ROW]).take(pa.array(at, pa.int64()))
            numbers = np.array(out, dtype=np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([table.column(0), *[pa.array(numbers[:, k]) for k in range(4)]],
                                             names=[ROW, *PIECE.names])

    return map_arrow(rows, run, schema)


def pack(docs: DataFrame, tokenizer: str, pattern: str, carry: list[str] | None = None, text: str = "text",
         window: int = WINDOW, max_piece: int = MAX_PIECE) -> DataFrame:
    """All pieces with ``sequence_id`` and ``offset`` (in the sequence). Even
    sequence ids are full windows of one document, odd ones come from blocks."""
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    cut_up = pieces(docs, tokenizer, pattern, carry, text, window, max_piece)
    cut_up = materialise(cut_up.withColumn("piece", F.monotonically_increasing_id()), "packing-pieces")
    full = F.col("length") == window
    outputs = [*PIECE.names, "sequence_id", "offset"]
    alone = cut_up.where(full).withColumns({"sequence_id": F.col("piece") * 2, "offset": F.lit(0).cast("long")})

    small = cut_up.where(~full)
    tokens = small.agg(F.sum("length")).first()[0] or 0
    blocks = max(1, -(-tokens // (window * BLOCK_WINDOWS)))
    ship_package(docs.sparkSession)
    dealt = small.withColumn("block", F.pmod(F.xxhash64("piece"), F.lit(blocks)))
    schema = T.StructType([f for f in dealt.schema if f.name != "block"]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = schema.names[:-2]

    def fill(key: tuple, block: pa.Table) -> pa.Table:
        block = block.sort_by([("length", "descending"), ("piece", "ascending")])
        lengths = block.column("length").to_pylist()
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        for k, part in enumerate(pack_block(lengths, window)):
            filled = 0
            for i in sorted(part):
                sequence[i], offset[i] = ((k * blocks + key[0].as_py()) << 1) | 1, filled
                filled += lengths[i]
        return pa.table([*[block.column(n) for n in names], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                        names=schema.names)

    packed = dealt.groupBy("block").applyInArrow(fill, schema)
    return unpack(alone, outputs).unionByName(unpack(packed, outputs))
