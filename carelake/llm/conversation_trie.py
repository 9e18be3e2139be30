"""The prefix trie of conversations, by van Emde Boas recursion over its depth.

A conversation is a sequence of turns; every distinct prefix is a node. The range
of depths is cut at half: the prefixes up to the cut are named, the trie above
the cut and the forests below it (one under each name) are tries of half the
height, cut again in their turn. All pieces of one height are worked on together,
so as many Spark rounds as the longest conversation's length has bits build the
trie:

* *Pieces.* One pass gives each run of ``2 ** j`` turns that lies between the root of
  a piece and its cut two 64-bit fingerprints (an exclusive or of hashes of
  (turn, place), so a conversation of any length is summed up before the shuffle).
* *Naming.* At depth ``lo + 2 ** j`` a prefix is the name at ``lo`` and the run between;
  those that are equal get the least conversation in their group as their name.
  Groups are summed up before the shuffle; names return to the conversations
  by a join, one name to a row, whose rows stream through a task.
* *Totals.* Upwards every piece adds the totals of its lower forests to the roots
  they hang on; downwards from the root the whole totals below a cut are
  grafted on the nodes half a piece above it. Each is one sum a height.

The ids that end at a node are hashed as one chain in their order: sorted ranges
join up to ``CHUNK`` ids to a text each, and the node's chain runs over those.

Defined results: null conversation ids take no part; turns are in the order of
``turn`` (null first), ties by a digest of role and text; repeated rows are turns of
their own; null role or text is empty; turns are told apart by 128 bits of a digest of
both, whole texts; an empty table has no nodes; other columns are not read. A
conversation without turns (it can only come about by sharing heads) ends at the root.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import map_arrow, materialise, text_of
from carelake.llm.ordered import number_within

CHUNK = 4096
EMPTY = sha256(b"").hexdigest()


def ordered_turns(conversations: DataFrame, id_: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns (conv, depth from 1, sym, chars) and conversations (conv, n)."""
    said, who = text_of(text), text_of(role)
    sym = F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said))
    rows = materialise(conversations.select(F.col(id_).cast("long").alias("conv"), F.col(turn).alias("turn"), sym.alias("sym"),
                                            F.char_length(said).cast("long").alias("chars")).where("conv is not null"), "trie-turns")
    placed, sizes = number_within(rows, "conv", ["turn", "sym"], "trie-places")
    return placed.select("conv", (F.col("at") + 1).alias("depth"), "sym", "chars"), sizes


def share_heads(turns: DataFrame, sizes: DataFrame, base: Column, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation rebuilt: the first ``heads`` (at most ``most``) turns of the
    conversation ``base`` (all if fewer, none if absent), then its own after as many.
    Both are expressions over ``conv``."""
    sizes = materialise(sizes, "trie-sizes")
    wanted = sizes.select("conv", "n", base.cast("long").alias("base"), heads.cast("long").alias("heads"))
    known = sizes.select(F.col("conv").alias("base"), F.col("n").alias("n_base"))
    plan = materialise(wanted.join(known, "base", "left").select(
        "conv", "base", "heads", "n", F.least("heads", F.coalesce("n_base", F.lit(0))).alias("taken")), "trie-plan")
    lent = turns.where(F.col("depth") <= most).withColumnRenamed("conv", "base").join(plan.select("conv", "base", "taken"), "base").where(
        F.col("depth") <= F.col("taken")).select("conv", "depth", "sym", "chars")
    own = turns.join(plan.select("conv", "heads", "taken"), "conv").where(F.col("depth") > F.col("heads")).select(
        "conv", (F.col("depth") - F.col("heads") + F.col("taken")).alias("depth"), "sym", "chars")
    return own.union(lent), plan.select("conv", (F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("heads"))).alias("n"))


def _runs(turns: DataFrame, rounds: int) -> DataFrame:
    """(conv, j, lo, x, y): fingerprints of the whole runs of ``2 ** j`` turns after ``lo``."""
    place = F.col("depth") - 1
    each = turns.select("conv", "sym", place.alias("place"), F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("j")).where(
        "(shiftright(place, j) & 1) = 0").withColumn("lo", F.expr("shiftleft(shiftright(place, j), j)"))
    mark = lambda k: F.bit_xor(F.xxhash64(F.lit(k), "sym", F.col("place") - F.col("lo")))
    return each.groupBy("conv", "j", "lo").agg(mark(1).alias("x"), mark(2).alias("y"), F.count("*").alias("n")).where(
        "n = shiftleft(1L, j)").drop("n")


def name_prefixes(turns: DataFrame, sizes: DataFrame, rounds: int, root: int) -> DataFrame:
    """(conv, depth, name, base): the name of every prefix of every conversation, and
    of its prefix at the root of the piece whose cut it lies on."""
    runs = materialise(_runs(turns, rounds), "trie-runs") if rounds else None
    names = sizes.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("name"), F.lit(None).cast("long").alias("base"))
    for j in range(rounds - 1, -1, -1):
        above = names.select("conv", F.col("depth").alias("lo"), F.col("name").alias("base"))
        prefixes = runs.where(F.col("j") == j).join(above, ["conv", "lo"])
        key = ["lo", "base", "x", "y"]
        book = prefixes.groupBy(*key).agg(F.min("conv").alias("name"))
        cut = prefixes.join(book, key).select("conv", (F.col("lo") + (1 << j)).alias("depth"), "name", "base")
        names = names.union(materialise(cut, "trie-names"))
    return names


def _sum(parts: DataFrame) -> DataFrame:
    return parts.groupBy("depth", "name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("base").alias("base"))


def subtree_totals(nodes: DataFrame, names: DataFrame, rounds: int) -> DataFrame:
    """(depth, name, leaves, saved): sums over whole subtrees of ``nodes`` (depth, name, base, leaves, saved)."""
    pieces = [nodes]  # pieces[j]: totals within pieces of height 2 ** j, at their roots
    for j in range(rounds):
        last, on_cut = pieces[-1], F.col("depth") % (2 << j) != 0
        hung = last.where(on_cut).select((F.col("depth") - (1 << j)).alias("depth"), F.col("base").alias("name"), "leaves", "saved",
                                         F.lit(None).cast("long").alias("base"))
        pieces.append(materialise(_sum(last.where(~on_cut).select("depth", "name", "leaves", "saved", "base").union(hung)), "trie-pieces"))
    whole = pieces[-1].select("depth", "name", "leaves", "saved")
    ways = names.select(F.col("conv").alias("name"), F.col("depth").alias("up"), F.col("name").alias("above"))
    for j in range(rounds - 1, -1, -1):
        grafts = whole.where("depth > 0").withColumn("up", F.col("depth") - (1 << j)).join(ways, ["name", "up"]).select(
            F.col("up").alias("depth"), F.col("above").alias("name"), "leaves", "saved")
        own = pieces[j].where(F.col("depth") % (2 << j) != 0).select("depth", "name", "leaves", "saved")
        whole = whole.union(materialise(_sum(own.union(grafts).withColumn("base", F.lit(None).cast("long"))).drop("base"), "trie-whole"))
    return whole


ENDS = "depth long, name long, first long, ids string"


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted (depth, name, conv) rows as texts of ids."""
    held, key = [], None
    for batch in batches:
        rows = []
        for depth, name, conv in zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "conv"))):
            if (depth, name) != key or len(held) == CHUNK:
                if held:
                    rows.append((*key, held[0], ",".join(map(str, held))))
                held, key = [], (depth, name)
            held.append(conv)
        yield _table(rows, ["depth", "name", "first", "ids"])
    if held:
        yield _table([(*key, held[0], ",".join(map(str, held)))], ["depth", "name", "first", "ids"])


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n in ("ids", "ends_sha256") else pa.int64()) for c, n in zip(columns, names)], names=names)


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["depth", "name", "ends_sha256"]
    key = chain = None
    for batch in batches:
        rows = []
        for depth, name, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "name", "ids"))):
            if (depth, name) != key:
                if key is not None:
                    rows.append((*key, chain.hexdigest()))
                key, chain = (depth, name), sha256(ids.encode())
            else:
                chain.update(b"," + ids.encode())
        yield _table(rows, names)
    if key is not None:
        yield _table([(*key, chain.hexdigest())], names)


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, name, ends_sha256) of the conversations (depth, name, conv) that end at a node."""
    keys = ["depth", "name", "conv"]
    texts = map_arrow(ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys), _join_ids, ENDS)
    return map_arrow(texts.repartition("depth", "name").sortWithinPartitions("depth", "name", "first"), _chain,
                     "depth long, name long, ends_sha256 string")


OUTPUT = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")


def build_trie(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """A row for every node (OUTPUT) over ``turns`` (conv, depth from 1 without gaps, sym,
    chars) and all conversations ``sizes`` (conv, n)."""
    turns, sizes = materialise(turns, "trie-rebuilt"), materialise(sizes, "trie-lengths")
    top = sizes.agg(F.min("conv"), F.max("n")).first()
    if top[0] is None:
        return sizes.sparkSession.createDataFrame([], OUTPUT)
    rounds = int(top[1]).bit_length()
    names = name_prefixes(turns, sizes, rounds, top[0])
    counted = names.groupBy("depth", "name").agg(F.count("*").alias("n_convs"), F.max("base").alias("base"))
    parents = names.select(F.col("conv").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    last = turns.select(F.col("conv").alias("name"), "depth", "chars")
    known = materialise(counted.join(parents, ["depth", "name"], "left").join(last, ["depth", "name"], "left").select(
        "depth", "name", "base", "parent", "n_convs", ((F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0))).alias("saved")), "trie-known")
    children = known.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = materialise(known.join(children, ["depth", "name"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).withColumn(
        "leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")), "trie-nodes")
    totals = subtree_totals(nodes.select("depth", "name", "leaves", "saved", "base"), names, rounds).select(
        "depth", "name", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    ends = end_digests(names.join(sizes.withColumnRenamed("n", "depth"), ["conv", "depth"]))
    return nodes.join(totals, ["depth", "name"]).join(ends, ["depth", "name"], "left").select(
        F.col("name").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
