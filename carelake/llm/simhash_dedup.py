"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's fingerprint has 64 bits: bit i is set if it is set in over half of the
hashes of its word shingles. Two fingerprints at most ``max_bits`` (4) apart
have a common variant within half of that (2) of each. So every fingerprint
emits all variants within half the radius, equal variants meet, and the
fingerprints that share one are linked, after a check of their distance.

The 2,081 variants of a fingerprint are not shuffled one by one. It emits the
variants of its leading ``p`` bits with the number of bits spent there; a task
that gets such a prefix completes the variants of the other bits, sorts them
and links equal ones. The meeting variants are the same, with 37 (p = 8) to 137
(p = 16) small rows shuffled for each distinct fingerprint. ``p`` grows with the
number of fingerprints so that a prefix holds about ``GROUP_ROWS`` rows; a
fuller one is worked off by further bits, which bounds the memory.

Fingerprints that share a variant are all within the radius of each other's
neighbourhood of it, so each is linked to the first one only: no pairs are
listed inside a group of copies, and no link is lost. Equal fingerprints are one
node. Components come from rounds of joins.

Defined results: null or empty text has fingerprint zero, linked like any other;
texts with fewer words than a shingle hash the whole sequence; rows with a null
id are in the component of their text and never name it (a component of null
ids only has a null id); repeated rows stay; an empty table gives an empty
result; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm.common import KEY, ROW, map_arrow, materialise, release_shuffles, ship_package, slices
from carelake.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
GROUP_ROWS = 40_000
BLOCK = 1 << 16       # shingles whose bits are counted at once
VARIANTS = 4_000_000  # variants sorted at once


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)).tolist()
    ends = ends.tolist()
    n = max(1, len(words) - shingle_words + 1)
    last = ends[min(shingle_words, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, BLOCK):
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(starts[at:min(at + BLOCK, n)], last[at:at + BLOCK])], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprints(rows: DataFrame, text: str, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The other columns of ``rows`` and ``fp``."""
    kept = [c for c in rows.columns if c != text]
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = [fingerprint(t, shingle_words) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(fps, pa.int64())], names=[*kept, "fp"])

    return map_arrow(rows, run, schema)


def _masks(bits: int, most: int) -> list[np.ndarray]:
    """For each number of bits flipped, up to ``most``: the masks that flip so many of ``bits``."""
    return [np.array([sum(1 << b for b in c) for c in combinations(range(bits), k)], dtype=np.uint64) for k in range(most + 1)]


def _flipped(values: np.ndarray, left: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All variants of ``bits``-bit values with at most ``left`` flips each:
    variants, positions of their values, flips spent."""
    out, at, spent = [], [], []
    everyone = np.arange(len(values))
    for k, masks in enumerate(_masks(bits, int(left.max(initial=0)))):
        own = everyone[left >= k]
        out.append((values[own][:, None] ^ masks[None, :]).ravel())
        at.append(np.repeat(own, len(masks)))
        spent.append(np.full(len(own) * len(masks), k, dtype=np.int8))
    return np.concatenate(out), np.concatenate(at), np.concatenate(spent)


def _meet(values: np.ndarray, left: np.ndarray, bits: int) -> np.ndarray:
    """Pairs (first, other) of positions whose values share a variant: each
    variant links the positions that have it to the first of them."""
    n = len(values)
    if n < 2:
        return np.empty((0, 2), dtype=np.int64)
    index_bits = max(1, (n - 1).bit_length())
    emitted = sum(int((left >= k).sum()) * len(m) for k, m in enumerate(_masks(bits, int(left.max()))))
    if bits > 8 and (bits + index_bits > 64 or emitted > VARIANTS):
        rest = np.uint64(bits - 8)
        head, at, spent = _flipped(values >> rest, left, 8)
        order = np.argsort(head, kind="stable")
        head, at, spent = head[order], at[order], spent[order]
        cuts = np.concatenate(([0], np.flatnonzero(head[1:] != head[:-1]) + 1, [len(head)]))
        tails, found = values & ((np.uint64(1) << rest) - np.uint64(1)), []
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if j - i > 1:
                own = np.sort(at[i:j], kind="stable")
                by = np.argsort(at[i:j], kind="stable")
                pairs = _meet(tails[own], left[own] - spent[i:j][by], bits - 8)
                found.append(own[pairs])
        pairs = np.concatenate(found) if found else np.empty((0, 2), dtype=np.int64)
    else:
        variants, at, _ = _flipped(values, left, bits)
        if bits + index_bits <= 64:
            packed = np.sort((variants << np.uint64(index_bits)) | at.astype(np.uint64))
            variants, at = packed >> np.uint64(index_bits), (packed & np.uint64((1 << index_bits) - 1)).astype(np.int64)
        else:
            order = np.lexsort((at, variants))
            variants, at = variants[order], at[order]
        begins = np.concatenate(([True], variants[1:] != variants[:-1]))
        first = at[np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))]
        pairs = np.stack([first[~begins], at[~begins]], axis=1)
    if not len(pairs):
        return pairs
    packed = np.unique(pairs[:, 0] * n + pairs[:, 1])
    return np.stack([packed // n, packed % n], axis=1)


def _forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """The pairs that join two parts when taken in order (a spanning forest)."""
    parent = list(range(n))
    kept = []
    for a, b in pairs.tolist():
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if a != b:
            parent[max(a, b)] = min(a, b)
            kept.append(True)
        else:
            kept.append(False)
    return pairs[np.array(kept, dtype=bool)]


def prefix_bits(rows: int, radius: int) -> int:
    """The shortest prefix (a multiple of 4) that leaves about GROUP_ROWS rows to a group."""
    for p in range(8, 33, 4):
        balls = sum(len(m) for m in _masks(p, radius))
        if rows * balls <= GROUP_ROWS << p:
            return p
    return 32


def near_links(fps: DataFrame, count: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``): enough that
    two of them are connected if and only if steps of at most ``max_bits`` join them."""
    ship_package(fps.sparkSession)
    if max_bits % 2:
        raise ValueError("max_bits must be even: variants are as far from both fingerprints")
    radius = max_bits // 2
    bits = prefix_bits(count, radius)
    masks = F.array(*[F.struct(F.lit(int(m)).cast("long").alias("m"), F.lit(k).cast("byte").alias("spent"))
                      for k, group in enumerate(_masks(bits, radius)) for m in group])
    emitted = fps.select("fp", F.explode(masks).alias("x")).select(
        F.shiftrightunsigned("fp", 64 - bits).bitwiseXOR(F.col("x.m")).alias("prefix"), F.col("x.spent").alias("spent"), "fp")

    def link(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy().astype(np.int64)
        order = np.argsort(fp, kind="stable")
        fp, spent = fp[order], group.column("spent").to_numpy()[order]
        tails = fp.view(np.uint64) & np.uint64((1 << (64 - bits)) - 1)
        pairs = _meet(tails, radius - spent, 64 - bits)
        apart = np.bitwise_count(fp[pairs[:, 0]].view(np.uint64) ^ fp[pairs[:, 1]].view(np.uint64))
        pairs = _forest(pairs[apart <= max_bits], len(fp))
        return pa.table({"a": pa.array(fp[pairs[:, 0]]), "b": pa.array(fp[pairs[:, 1]])})

    return emitted.groupBy("prefix").applyInArrow(link, "a long, b long").distinct()


def near_components(fingerprints: DataFrame, value: str, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component): for each distinct fingerprint the least ``value`` (nulls
    last) among the rows of its component."""
    spark = fingerprints.sparkSession
    nodes = materialise(fingerprints.groupBy("fp").agg(F.min(value).alias("least")), "simhash-nodes")
    links = materialise(near_links(nodes.select("fp"), nodes.count(), max_bits), "simhash-links")
    release_shuffles(spark)
    roots = components(links, "simhash")
    rooted = materialise(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                         .select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = materialise(rooted.groupBy("root").agg(F.min("least").alias("component")), "simhash-components")
    return materialise(rooted.join(least, "root").select("fp", "component"), "simhash-members")


def near_duplicates(docs: DataFrame, text: str = "text", id_: str = "doc_id", shingle_words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id."""
    marked = materialise(with_fingerprints(docs.select(F.col(id_).alias("doc_id"), F.col(text).alias("text")), "text", shingle_words),
                         "simhash-fingerprints")
    members = near_components(marked, "doc_id", max_bits)
    return marked.join(members, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def filter_documents(docs: DataFrame, text: str = "text", id_: str = "doc_id", shingle_words: int = SHINGLE_WORDS,
                     max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, with its own columns: the one with the least
    id (nulls last; of rows with that id, one)."""
    keyed = docs.select(F.monotonically_increasing_id().alias(KEY), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW),
                        F.col(text).alias("text"))
    rows = materialise(with_fingerprints(keyed, "text", shingle_words), "simhash-rows")
    rank = F.struct(F.col(f"{ROW}.{id_}").isNull().alias("no_id"), F.col(f"{ROW}.{id_}").alias("id"), F.col(KEY).alias("key"))
    members = near_components(rows.select("fp", rank.alias("rank")), "rank", max_bits)
    dropped = rows.select(KEY, "fp").join(members, "fp").where(F.col("component.key") != F.col(KEY)).select(KEY)
    kept = rows.join(materialise(dropped, "simhash-dropped"), KEY, "left_anti")
    return kept.select(*[F.col(ROW)[c].alias(c) for c in docs.columns])
