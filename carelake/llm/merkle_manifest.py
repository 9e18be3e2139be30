"""A Merkle manifest of a dataset in van Emde Boas layout.

Every row is a leaf, every group (source) a tree of ``FAN`` children a node, and the
groups' roots are the leaves of one more tree. A level joins runs of ``FAN``
consecutive nodes (the last run: fewer, even one) until one node is left.

*Layout.* A tree is split at half its height into a top and aligned bottom
subtrees, those again, and so on (``layer_heights``). Down to ``BLOCK_HEIGHT`` the
pieces are rows of the manifest table, (tree, layer, block, nodes): a block is one
aligned subtree of at most ``FAN ** BLOCK_HEIGHT`` bottom nodes, whose root is a
bottom node of a block in the next layer. Inside a block the same recursion goes
on down to single nodes: ``address`` is arithmetic on (depth, index) alone, so a
node, its run and the nodes above it lie in few stretches of any block size.

*Construction* goes over block roots: the leaves are dealt out by block, a task
fills a block at its addresses, the roots are the nodes of the next layer. A
group of any size is so many blocks, and no task holds more than one.

*Proofs* go down: the siblings of a block's bottom node are read at their
addresses, and a block hands its path to the blocks below, one row for each. At
the leaves a task has a block, its path and the block's rows.

Leaves get their places by ``ordered.number_within``: texts are hashed where they
are read and never move. A hash is lowercase hex of SHA-256 over the children's
hex text; the table stores its 32 bytes.

Defined results: a null group is a tree of its own and comes first; rows of a group
are in the order of id (null first), then of leaf, and repeated rows are leaves of
their own; null columns are marked as such in a leaf; a lone leaf is its group's
root, a lone group's root the root; an empty table has no rows and no root; extra
columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import map_arrow, materialise
from carelake.llm.ordered import number_within

FAN = 3
BLOCK_HEIGHT = 6   # at most 729 bottom nodes and 35 KB in a block
MOST_LEVELS = 39   # FAN ** 39 leaves are over 2 ** 61
SIZE = 32


def layer_heights(height: int, most: int = BLOCK_HEIGHT) -> list[int]:
    """Heights of the block layers of a tree, from the bottom: halves of halves."""
    if height <= most:
        return [height]
    top = height // 2
    return layer_heights(height - top, most) + layer_heights(top, most)


def nodes_in(levels: int) -> int:
    return (FAN ** levels - 1) // (FAN - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Where nodes at ``depth`` (0: the root) with ``index`` from the left lie in the
    layout of a subtree with ``levels`` levels: the top half first, then one
    bottom subtree after another, each laid out alike."""
    at = np.zeros(len(index), dtype=np.int64)
    while levels > 1:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = FAN ** (depth - top)
        at += nodes_in(top) + index // below * nodes_in(levels - top)
        index, depth, levels = index % below, depth - top, levels - top
    return at


@cache
def addresses(height: int) -> list[list[int]]:
    """Byte positions of the nodes of a block, by level from the bottom."""
    return [(address(height - level, np.arange(FAN ** (height - level)), height + 1) * SIZE).tolist() for level in range(height + 1)]


def join_run(run: list[bytes]) -> bytes:
    return sha256("".join(d.hex() for d in run).encode()).digest()


def fill_block(digests: list[bytes], height: int) -> bytes:
    """The nodes of a block over ``digests``, laid out; places without a node stay zero."""
    nodes = bytearray(nodes_in(height + 1) * SIZE)
    for level, places in enumerate(addresses(height)):
        if level:
            digests = [join_run(digests[i:i + FAN]) for i in range(0, len(digests), FAN)]
        for at, digest in zip(places, digests):
            nodes[at:at + SIZE] = digest
    return bytes(nodes)


def block_path(nodes: bytes, height: int, count: int, index: int) -> bytes:
    """The siblings of bottom node ``index`` of a block with ``count`` of them, level by
    level: a byte (4 x siblings + own place in the run), then the siblings from the left."""
    path = bytearray()
    for places in addresses(height)[:height]:
        first = index - index % FAN
        others = [places[i] for i in range(first, min(first + FAN, count)) if i != index]
        path.append(4 * len(others) + index - first)
        for at in others:
            path += nodes[at:at + SIZE]
        index, count = index // FAN, -(-count // FAN)
    return bytes(path)


def fold(digest: bytes, path: bytes) -> bytes:
    """The digest at the end of a path, from that of a leaf."""
    at = 0
    while at < len(path):
        others, place = divmod(path[at], 4)
        run = [path[i:i + SIZE] for i in range(at + 1, at + 1 + others * SIZE, SIZE)]
        run.insert(place, digest)
        digest, at = join_run(run), at + 1 + others * SIZE
    return digest


def siblings(path: bytes) -> str:
    """The hex digests of a path, in order."""
    out, at = [], 0
    while at < len(path):
        end = at + 1 + path[at] // 4 * SIZE
        out.append(path[at + 1:end].hex())
        at = end
    return "".join(out)


def leaf(columns: list[str | Column]) -> Column:
    """The digest of a row: each value with its length in bytes, ``-`` for null."""
    value = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    parts = [F.coalesce(F.concat(F.octet_length(value(c)).cast("string"), F.lit(":"), value(c)), F.lit("-")) for c in columns]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _span(height: Column, layer: int, most: int) -> Column:
    """Bottom nodes of a full block in a layer of a tree."""
    spans = [FAN ** heights[layer] if layer < len(heights := layer_heights(h, most)) else 1 for h in range(MOST_LEVELS + 1)]
    return F.element_at(F.array(*[F.lit(s).cast("long") for s in spans]), height + 1)


def _layers(height: Column, most: int) -> Column:
    return F.element_at(F.array(*[F.lit(len(layer_heights(h, most))) for h in range(MOST_LEVELS + 1)]), height + 1)


def _height(count: Column) -> Column:
    """Levels above ``count`` leaves."""
    powers = F.array(*[F.lit(FAN ** k).cast("long") for k in range(MOST_LEVELS)])
    return F.size(F.filter(powers, lambda p: p < count))


BLOCKS = "tree long, height int, block long, count int, nodes binary, root binary"


def _fill(layer: int, most: int):
    def done(key: tuple, digests: list[bytes]) -> tuple:
        height = layer_heights(key[1], most)[layer]
        nodes = fill_block(digests, height)
        return (key[0], key[1], key[2], len(digests), nodes, nodes[:SIZE])  # the root lies first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tree", "height", "block", "count", "nodes", "root"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        table = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        key, digests, rows = None, [], []
        for batch in batches:
            for tree, height, block, digest in zip(*(batch.column(c).to_pylist() for c in ("tree", "height", "block", "digest"))):
                if (tree, height, block) != key:
                    if key is not None:
                        rows.append(done(key, digests))
                    key, digests = (tree, height, block), []
                digests.append(digest)
            if rows:
                yield table(rows)
                rows = []
        if key is not None:
            yield table([done(key, digests)])

    return run


def build_blocks(nodes: DataFrame, tallest: int, name: str, most: int = BLOCK_HEIGHT) -> list[DataFrame]:
    """The block tables, one for each layer, over bottom ``nodes`` (tree, height, at,
    digest) of trees with at most ``tallest`` levels above them."""
    out = []
    for layer in range(max(len(layer_heights(h, most)) for h in range(tallest + 1))):
        placed = nodes.select("tree", "height", F.floor(F.col("at") / _span(F.col("height"), layer, most)).alias("block"), "at", "digest")
        sorted_ = placed.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
        out.append(materialise(map_arrow(sorted_, _fill(layer, most), BLOCKS), f"{name}-blocks"))
        nodes = out[-1].where(_layers(F.col("height"), most) > layer + 1).select("tree", "height", F.col("block").alias("at"), F.col("root").alias("digest"))
    return out


def tree_roots(blocks: list[DataFrame], most: int = BLOCK_HEIGHT) -> DataFrame:
    """(tree, root) from the last layer of every tree."""
    out = None
    for layer, table in enumerate(blocks):
        last = table.where(_layers(F.col("height"), most) == layer + 1).select("tree", "root")
        out = last if out is None else out.union(last)
    return out


PATHS = "tree long, height int, block long, path binary"


def _hand_down(layer: int, most: int):
    """Paths of the bottom nodes of blocks with paths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, height, block, count, nodes, above in zip(*(batch.column(c).to_pylist() for c in ("tree", "height", "block", "count", "nodes", "path"))):
                own = layer_heights(height, most)[layer]
                first = block * FAN ** own
                paths = [block_path(nodes, own, count, i) + above for i in range(count)]
                yield pa.RecordBatch.from_arrays([pa.array([tree] * count, pa.int64()), pa.array([height] * count, pa.int32()),
                                                  pa.array(range(first, first + count), pa.int64()), pa.array(paths, pa.binary())],
                                                 names=["tree", "height", "block", "path"])

    return run


def hand_down(blocks: DataFrame, paths: DataFrame, layer: int, most: int = BLOCK_HEIGHT) -> DataFrame:
    """The paths (PATHS) of the bottom nodes of one layer; their places are the blocks below."""
    held = blocks.join(paths.select("tree", "block", "path"), ["tree", "block"]).select("tree", "height", "block", "count", "nodes", "path")
    return map_arrow(held, _hand_down(layer, most), PATHS)


def block_paths(blocks: list[DataFrame], above: DataFrame, most: int = BLOCK_HEIGHT) -> DataFrame:
    """The paths (PATHS) of the blocks in the lowest layer; ``above`` (tree, path) are those of the trees."""
    paths = None
    for layer in range(len(blocks) - 1, -1, -1):
        top = blocks[layer].where(_layers(F.col("height"), most) == layer + 1).join(above, "tree").select("tree", "height", "block", "path")
        paths = top if paths is None else top.union(hand_down(blocks[layer + 1], paths, layer + 1, most))
    return paths


@dataclass
class Manifest:
    rows: DataFrame           # what was carried, tree, height, at, digest
    trees: DataFrame          # group, n, tree, subroot, path (to the root)
    blocks: list[DataFrame]   # one table a layer
    root: bytes | None
    block_height: int = BLOCK_HEIGHT


def build_manifest(rows: DataFrame, group: str, order: list[str], digest: str, most: int = BLOCK_HEIGHT) -> Manifest:
    """The manifest of ``rows`` (read from a written table) with their leaf in
    ``digest``, one tree for each ``group`` in the order of ``order``, then of leaf; blocks
    of at most ``most`` levels above their bottom."""
    placed, sizes = number_within(rows, group, [*order, digest], "merkle-rows")
    one = materialise(sizes.withColumn("_all", F.lit(0)), "merkle-groups")
    trees = materialise(number_within(one, "_all", [group], "merkle-trees")[0].select(
        F.col(group).alias("_group"), "n", F.col("at").alias("tree"), _height(F.col("n")).alias("height")), "merkle-trees")
    tallest = trees.agg(F.max("height"), F.count("*")).first()
    leaves = materialise(placed.join(trees.drop("n"), F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
                         .withColumnRenamed(digest, "digest"), "merkle-leaves")
    blocks = build_blocks(leaves.select("tree", "height", "at", "digest"), tallest[0] or 0, "merkle", most)
    roots = tree_roots(blocks, most)
    upper = _height(F.lit(tallest[1]).cast("long"))
    crown = build_blocks(roots.select(F.lit(0).cast("long").alias("tree"), upper.alias("height"), F.col("tree").alias("at"), F.col("root").alias("digest")),
                         int(next(h for h in range(MOST_LEVELS) if FAN ** h >= tallest[1])), "merkle-crown", most)
    root = tree_roots(crown, most).first()
    paths = hand_down(crown[0], block_paths(crown, crown[-1].select("tree", F.lit(b"").alias("path")), most), 0, most).select(F.col("block").alias("tree"), "path")
    named = materialise(trees.join(roots.withColumnRenamed("root", "subroot"), "tree").join(paths, "tree"), "merkle-named")
    return Manifest(leaves, named, blocks, root.root if root else None, most)


def _verify(shown: str, kept: list[str], names: list[str], most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes = above = subroot = None
        proof_above, ends = "", {}
        for batch in batches:
            is_leaf, proofs, folded, subroots = [], [], [], []
            wanted = ("height", "count", "nodes", "path", "subroot", "at", shown)
            for height, count, block, path, group_root, at, digest in zip(*(batch.column(c).to_pylist() for c in wanted)):
                is_leaf.append(block is None)
                if block is not None:
                    nodes, above, subroot, full, tall = block, path, group_root, count, layer_heights(height, most)[0]
                    proof_above, ends = siblings(path), {}
                    continue
                own = block_path(nodes, tall, full, at % FAN ** tall)
                proofs.append(sha256((siblings(own) + proof_above).encode()).hexdigest())
                end = fold(digest, own)
                if end not in ends:  # most rows of a block end at its root
                    ends = {end: fold(end, above)} | (ends if len(ends) < 1000 else {})
                folded.append(ends[end].hex())
                subroots.append(subroot.hex())
            rows = batch.filter(pa.array(is_leaf, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), pa.array(subroots, pa.string()), pa.array(proofs, pa.string()),
                                              pa.array(folded, pa.string())], names=names)

    return run


def prove(manifest: Manifest, shown: str, kept: list[str]) -> DataFrame:
    """Columns ``kept`` of the manifest's rows with ``subroot``, ``proof_sha256`` (over the
    siblings on the way to the root) and ``folded_root``: the root as it follows from
    the digest in ``shown`` and those siblings."""
    lowest = manifest.blocks[0]
    paths = block_paths(manifest.blocks, manifest.trees.select("tree", "path"), manifest.block_height)
    held = lowest.join(paths.select("tree", "block", "path"), ["tree", "block"]).join(manifest.trees.select("tree", "subroot"), "tree")
    rows = manifest.rows.withColumn("block", F.floor(F.col("at") / _span(F.col("height"), 0, manifest.block_height)))
    streams = rows.select("tree", "block", F.lit(1).alias("kind"), "at", "height", shown, *[c for c in kept if c != shown]).unionByName(
        held.select("tree", "block", F.lit(0).alias("kind"), "height", "count", "nodes", "path", "subroot"), allowMissingColumns=True)
    together = streams.repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "at")
    outputs = ["subroot", "proof_sha256", "folded_root"]
    fields = [f"`{c}` {t}" for c, t in rows.select(*kept).dtypes] + [f"{c} string" for c in outputs]
    return map_arrow(together, _verify(shown, kept, [*kept, *outputs], manifest.block_height), ", ".join(fields))
