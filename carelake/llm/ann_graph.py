"""Approximate nearest neighbours by cosine: an NN-descent graph and greedy search.

*Index.* Equal vectors are one node. Every node gets ``K`` neighbours, first from
sorted passes (nodes next to each other by random hyperplane signs and a
projection are compared in blocks), then by NN-descent. A pass moves every vector
once, a round once for each neighbour, so blocks are large and passes are many:
they leave little to the rounds. Each round brings every
node's neighbours and reverse neighbours together with their vectors, compares
those of which at least one is new to it, and every node keeps its ``k`` best.
Rounds end when few lists change. A node's group has at most ``2 k`` rows, so no
hub or dense region makes a group large; joins on hubs can be split. Of a hub's
reverse neighbours ``k`` are drawn in each round, those that wait first: a link
waits at its far end until it was drawn there, and is new there until then. A
group offers ``k`` neighbours to a node, as many as the node can keep, so none
of its best is lost.

*Search.* All queries walk together: each keeps the best nodes in its beam, expands
the best ones not yet expanded through one join with the graph and one with the
vectors, and ends when all nodes in its beam are expanded; no number of steps
cuts it short (a node is expanded once for a query, so the walk ends). A node leads to
its neighbours and to as many that have it as theirs, the nearest. A query whose
vector is in the index begins at its node, any other at a bounded sample of
``SEEDS`` nodes; equal queries walk as one. ``BEAM`` is the same at every size and the
neighbours grow with the logarithm of the nodes (``degree``), so a query looks at
little more vectors in a large index than in a small one.
Scores are computed from the original vectors in double precision.

Defined results: vectors that are null, zero, of another length than most (of
equals the shorter) or that hold a null or non-finite component take no part, as
query or candidate; ties go to the smaller id; null ids take no part; with fewer
candidates than wanted all are returned; repeated rows (same id and vector) count
once; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from carelake.llm.common import map_arrow, materialise, parts_for, release_shuffles, ship_package

K = 28
BLOCK = 2048
AT_ONCE = 256      # rows of a block that are compared at once
PASSES = 16
STOP_SHARE = 0.01   # of all list entries changed
SEEDS = 64
BEAM = 128

SIZED_FOR = 10_000  # nodes that K is for
MORE = 3            # neighbours more for each doubling beyond

# Rows of a written file, about: a step writes little, and there are many steps.
LINKS_EACH, VECTORS_EACH, QUERIES_EACH = 50_000, 4_000, 64

EDGES = "u long, v long, sim double"
LISTS = "u long, vs array<long>, sims array<double>"


def degree(count: int) -> int:
    """Neighbours of a node in a graph of ``count``: grows with the logarithm, as a
    list of fixed length finds fewer of the nearest the more nodes there are."""
    return K + round(MORE * math.log2(max(1.0, count / SIZED_FOR)))


def _matrix(column) -> np.ndarray:
    """Vectors of equal length as rows, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; divided by the largest component first, so
    that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=1e-300)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def valid_vectors(table: DataFrame, id_: str, vector: str) -> DataFrame:
    """Distinct (id, vec) that take part."""
    vec = F.col(vector)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = table.select(F.col(id_).cast("long").alias("id"), vec.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull()).where(
        finite & F.exists("vec", lambda x: x != 0))
    common = rows.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").first()
    return rows.where(F.size("vec") == (common.n if common else 0))


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches in key order. Groups are small."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        keys = table.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if cut:
            yield table.slice(0, cut)
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest


def _edges(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    u, v, s = (np.concatenate([p[k] for p in parts]) if parts else np.empty(0) for k in range(3))
    return pa.RecordBatch.from_arrays([pa.array(u.astype(np.int64)), pa.array(v.astype(np.int64)), pa.array(s.astype(np.float64))], names=["u", "v", "sim"])


def _best(sims: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (row, column) of the ``most`` largest entries of each row; -inf is none."""
    most = min(most, sims.shape[1])
    at = np.argpartition(-sims, most - 1, axis=1)[:, :most]
    rows = np.repeat(np.arange(len(sims)), most)
    cols = at.ravel()
    real = np.isfinite(sims[rows, cols])
    return rows[real], cols[real]


def _sort_keys(vectors: DataFrame, bits: int, passes: int) -> DataFrame:
    """``vectors`` with ``keys``, a number for each pass: the signs at random
    hyperplanes, then (behind the point) the place on one more random line."""
    keyed = T.StructType([*vectors.schema, T.StructField("keys", T.ArrayType(T.DoubleType()))])

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unit(_matrix(batch.column("vec"))) if batch.num_rows else np.empty((0, 1))
            keys = np.empty((len(x), passes))
            for p in range(passes):
                y = x @ np.random.default_rng(1000 + p).standard_normal((x.shape[1], bits + 1))
                keys[:, p] = (y[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64)) + np.arctan(y[:, bits]) / np.pi
            ends = pa.array(np.arange(0, keys.size + 1, passes, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))], names=keyed.names)

    return map_arrow(vectors, key, keyed)


def _lists(u: np.ndarray, v: np.ndarray, sims: np.ndarray) -> pa.RecordBatch:
    """One row for each run of equal ``u``."""
    starts = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1]))) if len(u) else np.empty(0, np.int64)
    ends = pa.array(np.concatenate((starts, [len(u)])).astype(np.int32))
    return pa.RecordBatch.from_arrays([pa.array(u[starts].astype(np.int64)), pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int64))),
                                       pa.ListArray.from_arrays(ends, pa.array(sims.astype(np.float64)))], names=["u", "vs", "sims"])


def _sorted_pass(keyed: DataFrame, number: int, k: int, parts: int) -> DataFrame:
    """Lists of the nearest inside blocks of nodes that are close by the pass's key."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(block: pa.Table) -> Iterator[pa.RecordBatch]:
            x, ids = _unit(_matrix(block.column("vec"))), block.column("node").to_numpy()
            for at in range(0, len(x), AT_ONCE):
                sims = x[at:at + AT_ONCE] @ x.T
                np.fill_diagonal(sims[:, at:], -np.inf)
                a, b = _best(sims, k)
                yield _lists(ids[at + a], ids[b], sims[a, b])

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            whole = max(0, table.num_rows // BLOCK - 1) * BLOCK  # the last block takes the rest
            for at in range(0, whole, BLOCK):
                yield from links(table.slice(at, BLOCK))
            rest = table.slice(whole)
        if rest is not None and rest.num_rows > 1:
            yield from links(rest)

    ranged = keyed.select("node", "vec", F.col("keys")[number].alias("key")).repartitionByRange("key").sortWithinPartitions("key", "node")
    return map_arrow(ranged.select("node", "vec").coalesce(parts), compare, LISTS)


def _best_of_lists(k: int):
    """Links (u, v, sim): the ``k`` best of all lists of a node, each neighbour once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "u"):
            lists, u = table.column("vs").combine_chunks(), table.column("u").to_numpy()
            v, sims = lists.flatten().to_numpy(), table.column("sims").combine_chunks().flatten().to_numpy()
            rows = np.concatenate(([0], np.flatnonzero(u[1:] != u[:-1]) + 1, [len(u)]))
            cuts = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))))[rows].tolist()
            found = []
            for node, i, j in zip(u[rows[:-1]].tolist(), cuts, cuts[1:]):
                ids, at = np.unique(v[i:j], return_index=True)
                best = np.argsort(-sims[i:j][at], kind="stable")[:k]
                found.append((np.full(len(best), node), ids[best], sims[i:j][at][best]))
            yield _edges(found)

    return run


def _keep_best(edges: DataFrame, k: int) -> DataFrame:
    own = W.partitionBy("u").orderBy(F.desc("sim"), "v")
    return edges.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k).drop("rank")


def _local_join(offers: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _grouped(batches, "u"):
            x, u = _unit(_matrix(table.column("vec"))), table.column("u").to_numpy()
            ids, fresh, worst = (table.column(c).to_numpy(zero_copy_only=False) for c in ("v", "fresh", "worst"))
            cuts = np.concatenate(([0], np.flatnonzero(u[1:] != u[:-1]) + 1, [len(u)])).tolist()
            found = []
            for i, j in zip(cuts, cuts[1:]):
                if j - i > 1:
                    sims = x[i:j] @ x[i:j].T
                    new = fresh[i:j]
                    sims[~(new[:, None] | new[None, :]) | (sims <= worst[i:j][:, None])] = -np.inf
                    np.fill_diagonal(sims, -np.inf)
                    a, b = _best(sims, offers)
                    if len(a):
                        found.append((ids[i:j][a], ids[i:j][b], sims[a, b]))
            if found:
                yield _edges(found)

    return run


def _drawn(graph: DataFrame, k: int, step: int) -> DataFrame:
    """(u, v, fresh): at most ``k`` reverse neighbours v of every node u, those that wait first."""
    own = W.partitionBy("u").orderBy(F.desc("fresh"), F.xxhash64("v", F.lit(step)))
    reverse = graph.select(F.col("v").alias("u"), F.col("u").alias("v"), F.col("waiting").alias("fresh"))
    return reverse.withColumn("n", F.row_number().over(own)).where(F.col("n") <= k).drop("n")


def _after_round(graph: DataFrame, drawn: DataFrame, offers: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of lists and offers. Offers are fresh and wait; a link of
    the graph is fresh no more and waits on if it was not drawn."""
    took_part = drawn.select(F.col("v").alias("u"), F.col("u").alias("v"), F.lit(None).cast("double").alias("sim"),
                             F.lit(False).alias("fresh"), F.lit(False).alias("waiting"))
    merged = graph.select("u", "v", "sim", F.lit(False).alias("fresh"), "waiting").union(took_part).union(
        offers.select("u", "v", "sim", F.lit(True).alias("fresh"), F.lit(True).alias("waiting"))).groupBy("u", "v").agg(
        F.max("sim").alias("sim"), F.min("fresh").alias("fresh"), F.min("waiting").alias("waiting"))
    return _keep_best(merged, k)


def build_graph(vectors: DataFrame, count: int, k: int = K) -> DataFrame:
    """(u, v, sim): the ``k`` best neighbours found of every node of ``vectors`` (node, vec)."""
    spark = vectors.sparkSession
    bits = max(0, (max(1, count // (2 * BLOCK))).bit_length() - 1)
    parts = parts_for(spark, count * k, LINKS_EACH)
    one = count < 2 * BLOCK  # block: a pass compares all
    passes, tasks = (1, 1) if one else (PASSES, parts_for(spark, count, 2 * BLOCK))
    keyed = materialise(_sort_keys(vectors, bits, passes), "ann-keys", parts_for(spark, count, VECTORS_EACH))
    lists = functools.reduce(DataFrame.union, [_sorted_pass(keyed, p, k, tasks) for p in range(passes)])
    first = map_arrow(lists.repartition("u").sortWithinPartitions("u"), _best_of_lists(k), EDGES)
    graph = materialise(first.withColumns({"fresh": F.lit(True), "waiting": F.lit(True)}), "ann-graph", parts)
    for step in itertools.count():  # lists only get better, so changes end
        drawn = materialise(_drawn(graph, k, step), "ann-drawn", parts)
        near = graph.select("u", "v", "fresh").union(drawn).groupBy("u", "v").agg(F.max("fresh").alias("fresh"))
        worst = graph.groupBy("u").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(F.lit(-2.0)).alias("worst"))
        carried = vectors.join(worst, F.col("node") == F.col("u"), "left").select(
            F.col("node").alias("v"), "vec", F.coalesce("worst", F.lit(-2.0)).alias("worst"))
        gathered = near.join(carried, "v").select("u", "v", "fresh", "worst", "vec")
        offers = map_arrow(gathered.repartition("u").sortWithinPartitions("u", "v"), _local_join(k), EDGES)
        graph = materialise(_after_round(graph, drawn, offers, k), "ann-graph", parts)
        changed = graph.where("fresh").count()
        release_shuffles(spark)
        if changed <= STOP_SHARE * count * k:
            break
    return graph.select("u", "v", "sim")


STATE = T.StructType([T.StructField("q", T.LongType()), T.StructField("seen", T.ArrayType(T.LongType())),
                      T.StructField("nodes", T.ArrayType(T.LongType())), T.StructField("sims", T.ArrayType(T.DoubleType())),
                      T.StructField("open", T.ArrayType(T.BooleanType()))])


def _merged(q: int, vec: np.ndarray, seen: np.ndarray, nodes: np.ndarray, sims: np.ndarray, is_open: np.ndarray, ids: np.ndarray,
            x: np.ndarray, beam: int) -> dict:
    """The state of a query after ``ids`` with vectors ``x`` are looked at."""
    ids, at = np.unique(ids, return_index=True)
    new = ~np.isin(ids, seen)
    ids, at = ids[new], at[new]
    if len(ids):
        sims = np.concatenate([sims, np.clip(_unit(x[at]) @ _unit(vec[None, :])[0], -1, 1)])
        nodes, is_open = np.concatenate([nodes, ids]), np.concatenate([is_open, np.ones(len(ids), dtype=bool)])
        order = np.lexsort((nodes, -sims))[:beam]
        nodes, sims, is_open, seen = nodes[order], sims[order], is_open[order], np.concatenate([seen, ids])
    return {"q": q, "seen": seen, "nodes": nodes, "sims": sims, "open": is_open}


def _state_table(rows: list[dict]) -> pa.Table:
    kinds = {"q": pa.int64(), "seen": pa.list_(pa.int64()), "nodes": pa.list_(pa.int64()), "sims": pa.list_(pa.float64()), "open": pa.list_(pa.bool_())}
    return pa.table([pa.array([r[c] for r in rows], kind) for c, kind in kinds.items()], names=list(kinds))


def search(queries: DataFrame, vectors: DataFrame, graph: DataFrame, k: int = K, beam: int = BEAM) -> DataFrame:
    """State rows of all ``queries`` (q, vec, own: its node or null)."""
    spark = vectors.sparkSession
    expand = beam // 4  # nodes a query expands in one step
    ship_package(spark)
    parts, few = parts_for(spark, graph.count(), LINKS_EACH), parts_for(spark, queries.count(), QUERIES_EACH)
    back = materialise(graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "sim").join(graph.select("u", "v"), ["u", "v"], "left_anti"), "ann-back", parts)
    drawn = W.partitionBy("u").orderBy(F.desc("sim"), "v")
    # Out-links all, in-links as many again, the nearest.
    extra = back.withColumn("n", F.row_number().over(drawn)).where(F.col("n") <= k).drop("n", "sim")
    links = materialise(graph.select("u", "v").union(extra).groupBy("u").agg(F.collect_list("v").alias("vs")), "ann-links", 2 * parts)
    sample = vectors.orderBy(F.xxhash64("node"), "node").limit(SEEDS).collect() if queries.where("own is null").limit(1).count() else []
    seed_ids = np.array([r.node for r in sample], dtype=np.int64)
    seeds = [np.array(r.vec, dtype=np.float64) for r in sample]

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none, no = np.empty(0, np.int64), np.empty(0, bool)
        for batch in batches:
            rows = []
            for q, own, vec in zip(batch.column("q").to_pylist(), batch.column("own").to_pylist(), _matrix(batch.column("vec")) if batch.num_rows else []):
                ids, x = (seed_ids, seeds) if own is None else (np.array([own]), [vec])
                rows.append(_merged(q, vec, none, none, np.empty(0), no, ids, np.array(x).reshape(len(ids), -1), beam))
            yield from _state_table(rows).to_batches()

    def look(state: pa.Table, offers: pa.Table) -> pa.Table:
        if not state.num_rows:
            return _state_table([])
        seen, nodes, sims, is_open, vec = (state.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)  # of one row
                                           for c in ("seen", "nodes", "sims", "open", "vec"))
        is_open, vec = is_open.copy(), vec.astype(np.float64)
        is_open[np.flatnonzero(is_open)[:expand]] = False
        x = _matrix(offers.column("vec")) if offers.num_rows else np.empty((0, len(vec)))
        return _state_table([_merged(state.column("q")[0].as_py(), vec, seen, nodes, sims, is_open, offers.column("v").to_numpy(), x, beam)])

    done = None
    state = materialise(map_arrow(queries.select("q", "own", "vec"), begin, STATE), "ann-states", few)
    asked = queries.select("q", "vec")
    while True:
        going = state.where(F.exists("open", lambda o: o))
        ended = state.where(~F.exists("open", lambda o: o))
        done = ended if done is None else done.union(ended)
        if going.isEmpty():
            return done
        first = F.slice(F.filter("nodes", lambda n, i: F.get("open", i)), 1, expand)
        asks = going.select(F.col("q").alias("asker"), F.explode(first).alias("u"))
        # A query takes its links in one row, so that only vectors it has not seen are sent to it.
        led = asks.join(links, "u").groupBy("asker").agg(F.flatten(F.collect_list("vs")).alias("vs"))
        unseen = led.join(going.select(F.col("q").alias("asker"), "seen"), "asker").select("asker", F.explode(F.array_except("vs", "seen")).alias("v"))
        offers = unseen.join(vectors.withColumnRenamed("node", "v"), "v").select("asker", "v", "vec")
        state = materialise(going.join(asked, "q").groupBy("q").cogroup(offers.groupBy("asker")).applyInArrow(look, STATE), "ann-states", few)
        release_shuffles(spark)


def nearest(table: DataFrame, wanted: int = 5, id_: str = "vec_id", vector: str = "embedding", query: Column | None = None) -> DataFrame:
    """For every row that is a query: (query_id, rank, vec_id, score), the
    ``wanted`` nearest found among all other rows."""
    spark = table.sparkSession
    rows = materialise(valid_vectors(table, id_, vector), "ann-rows")
    parts = parts_for(spark, rows.count(), VECTORS_EACH)
    # Of equal vectors the least ids are all that any answer can name.
    least = W.partitionBy("vec").orderBy("id")
    members = materialise(rows.distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= wanted + 1)
                          .withColumn("node", F.min("id").over(W.partitionBy("vec"))), "ann-members", parts)
    vectors = materialise(members.where("n = 1").select("node", "vec"), "ann-vectors", parts)
    count = vectors.count()
    k = degree(count)
    graph = build_graph(vectors, count, k)
    is_query = F.col("id") % 50 == 0 if query is None else query
    asked = materialise(rows.where(is_query).distinct().join(vectors.select("node", F.col("vec").alias("same")), F.col("vec") == F.col("same")).select(
        F.col("id").alias("query_id"), F.col("node").alias("q")), "ann-queries", parts)
    walkers = materialise(asked.select("q").distinct().join(vectors, F.col("q") == F.col("node")).select("q", "vec", F.col("node").alias("own")), "ann-walkers", parts)
    found = search(walkers, vectors, graph, k)
    near = found.select("q", F.explode(F.slice(F.arrays_zip("nodes", "sims"), 1, wanted + 1)).alias("x")).select("q", "x.nodes", "x.sims")
    named = near.join(members.select("node", F.col("id").alias("vec_id")), F.col("nodes") == F.col("node"))
    # One more than wanted for every vector, so that each of its ids can leave itself out.
    order = W.partitionBy("q").orderBy(F.desc("sims"), "vec_id")
    lists = named.withColumn("n", F.row_number().over(order)).where(F.col("n") <= wanted + 1).groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("n", "vec_id", "sims"))).alias("best"))
    others = F.filter("best", lambda x: x["vec_id"] != F.col("query_id"))
    answers = asked.join(lists, "q").select("query_id", F.posexplode(F.slice(others, 1, wanted)).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), "x.vec_id", F.col("x.sims").alias("score"))
    return answers.coalesce(parts)
