"""Approximate nearest neighbours by cosine in robust-pruned directed graphs, one per shard.

A shard's graph grows in batches. A greedy search in the graph so far proposes neighbours for a
new vector: those in its beam at the end. Of these the nearest is kept, and it removes all that
are nearer to it than to the vector by a factor (``relax``), then the next, up to ``degree``:
edges point in diverse directions, the factor leaves some longer ones. Edges are also
drawn backwards, and lists that grow beyond ``degree`` are pruned in the same way. Vectors
that the entry point does not reach get a further edge from their nearest reachable one.

A query goes to every shard. There a beam search follows the graph from the entry point;
what is in the beam at the end is measured again in double precision on the original vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecall.llm.common import Scratch

#: Nodes of a beam that are followed in one step.
STEP = 4
#: Cells of the table of nodes that the searches of a batch have seen.
SEEN_CELLS = 1 << 22
BUILD_BATCH = 256


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors scaled by powers of two so that nothing overflows, and their lengths; in doubles."""
    vectors = vectors.astype(np.float64)
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    scaled = np.ldexp(vectors, -exponent[:, None])
    return scaled, np.sqrt(np.einsum("ij,ij->i", scaled, scaled))


class Graph:
    """A directed graph over unit vectors, by the number of the vector."""

    def __init__(self, x: np.ndarray, links: np.ndarray, start: int):
        self.x, self.links, self.start = x, links, start

    def beam_search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes that a walk finds for each query, nearest first, and their distances.

        Distances are ``1 - cosine``. Places that remain empty have node -1 at infinity.
        """
        at_once = max(1, SEEN_CELLS // max(1, len(self.x)))
        parts = [self._search(queries[i : i + at_once], beam) for i in range(0, len(queries), at_once)]
        return tuple(np.concatenate(p) for p in zip(*parts))

    def _search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        count = len(queries)
        nodes = np.full((count, beam), -1, np.int64)
        far = np.full((count, beam), np.inf, np.float32)
        done = np.ones((count, beam), bool)
        nodes[:, 0], far[:, 0], done[:, 0] = self.start, 1 - queries @ self.x[self.start], False
        seen = np.zeros((count, len(self.x)), bool)
        seen[:, self.start] = True
        stamp = np.zeros((count, len(self.x)), np.int32)
        open_ = np.arange(count)
        while len(open_):
            # The nearest nodes not yet followed.
            order = np.argsort(done[open_], axis=1, kind="stable")[:, :STEP]
            follow = ~np.take_along_axis(done[open_], order, 1)
            node = np.take_along_axis(nodes[open_], order, 1)
            done[open_[:, None], order] = True
            near = np.where(follow[:, :, None], self.links[np.maximum(node, 0)], -1).reshape(len(open_), -1)
            row, column = np.nonzero((near >= 0) & ~seen[open_[:, None], np.maximum(near, 0)])
            query, to = open_[row], near[row, column]
            # A node that several edges of this step lead to counts once.
            stamp[query, to] = column
            once = stamp[query, to] == column
            row, column, query, to = row[once], column[once], query[once], to[once]
            seen[query, to] = True
            fresh = np.full(near.shape, np.inf, np.float32)
            fresh[row, column] = 1 - np.einsum("ij,ij->i", self.x[to], queries[query])
            all_far = np.concatenate([far[open_], fresh], axis=1)
            all_nodes = np.concatenate([nodes[open_], np.where(np.isinf(fresh), -1, near)], axis=1)
            all_done = np.concatenate([done[open_], np.isinf(fresh)], axis=1)
            best = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            far[open_] = np.take_along_axis(all_far, best, 1)
            nodes[open_] = np.take_along_axis(all_nodes, best, 1)
            done[open_] = np.take_along_axis(all_done, best, 1)
            open_ = open_[(~done[open_]).any(axis=1)]
        return nodes, far

    def far_from(self, at: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Distances of each vector ``at`` to its row of ``nodes``; infinite for -1."""
        far = 1 - np.einsum("bcd,bd->bc", self.x[np.maximum(nodes, 0)], self.x[at])
        return np.where(nodes >= 0, far, np.inf)

    def prune(self, at: np.ndarray, nodes: np.ndarray, far: np.ndarray, degree: int, relax: float) -> np.ndarray:
        """Diverse neighbours of each vector ``at`` among its row of ``nodes``."""
        order = np.argsort(far, axis=1, kind="stable")
        nodes, far = np.take_along_axis(nodes, order, 1), np.take_along_axis(far, order, 1)
        around = self.x[np.maximum(nodes, 0)]
        between = relax * (1 - np.matmul(around, around.transpose(0, 2, 1)))
        alive = (nodes >= 0) & (nodes != at[:, None])
        out = np.full((len(at), degree), -1, np.int64)
        rows = np.arange(len(at))
        for k in range(degree):
            pick = alive.argmax(axis=1)
            some = alive[rows, pick]
            if not some.any():
                break
            out[some, k] = nodes[some, pick[some]]
            gone = between[rows, pick] <= far
            gone[rows, pick] = True
            alive &= ~gone
        return out

    def _link_back(self, source: np.ndarray, links: np.ndarray, relax: float) -> None:
        """Edges from the new neighbours back to ``source``."""
        degree = self.links.shape[1]
        origin, target = np.repeat(source, degree), links.ravel()
        origin, target = origin[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        origin, target = origin[order], target[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        incoming = np.full((len(nodes), count.max(initial=0)), -1, np.int64)
        incoming[np.repeat(np.arange(len(nodes)), count), np.arange(len(target)) - np.repeat(first, count)] = origin
        own = self.links[nodes]
        incoming[(incoming[:, :, None] == own[:, None, :]).any(axis=2)] = -1
        both = np.concatenate([own, incoming], axis=1)
        both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
        fits = (both >= 0).sum(axis=1) <= degree
        self.links[nodes[fits]] = both[fits, :degree]
        nodes, both = nodes[~fits], both[~fits]
        for i in range(0, len(nodes), BUILD_BATCH):
            at, some = nodes[i : i + BUILD_BATCH], both[i : i + BUILD_BATCH]
            self.links[at] = self.prune(at, some, self.far_from(at, some), degree, relax)

    def _reached(self) -> np.ndarray:
        reached = np.zeros(len(self.x), bool)
        reached[self.start] = True
        edge = np.array([self.start])
        while len(edge):
            to = np.unique(self.links[edge])
            edge = to[(to >= 0) & ~reached[np.maximum(to, 0)]]
            reached[edge] = True
        return reached

    def _connect(self, beam: int) -> None:
        """Further edges until the entry point reaches every node."""
        while not (reached := self._reached()).all():
            lost = np.flatnonzero(~reached)
            nearest = self.beam_search(self.x[lost], beam)[0][:, 0]
            # One edge for each of these nodes in a round, in a further column.
            nearest, first = np.unique(nearest, return_index=True)
            more = np.full((len(self.x), 1), -1, np.int64)
            more[nearest, 0] = lost[first]
            self.links = np.concatenate([self.links, more], axis=1)

    @classmethod
    def build(cls, x: np.ndarray, degree: int, beam: int, relax: float) -> Graph:
        start = int((x @ x.mean(axis=0)).argmax())
        graph = cls(x, np.full((len(x), degree), -1, np.int64), start)
        order = np.random.default_rng(len(x)).permutation(len(x))
        order = order[order != start]
        at, size = 0, 1
        while at < len(order):
            new = order[at : at + size]
            nodes, far = graph.beam_search(x[new], beam)
            links = graph.prune(new, nodes, far, degree, relax)
            graph.links[new] = links
            graph._link_back(new, links, relax)
            at, size = at + size, min(BUILD_BATCH, 2 * size)
        graph._connect(beam)
        return graph


# --- over tables -------------------------------------------------------------------------


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    rows = vectors.combine_chunks()
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(rows), -1)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that take part, each once."""
    kind = vectors.schema[vector_col].dataType.simpleString()
    vector = vectors[vector_col] if kind in ("array<float>", "array<double>") else vectors[vector_col].cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = vectors[id_col].isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    return vectors.where(good).select(vectors[id_col].alias("vec_id"), vector.alias("vector")).distinct()


def index_vectors(
    rows: DataFrame,
    ids_per_vector: int,
    scratch: Scratch,
    rows_per_shard: int = 8192,
    degree: int = 32,
    beam: int = 64,
    relax: float = 1.4,
) -> tuple[DataFrame, int]:
    """The graphs of all shards as a table with a row per vector, and the number of shards.

    ``rows`` are ``vec_id, vector``. Equal vectors are one node with its ``ids_per_vector`` smallest
    ids, so that no number of copies makes a shard large or a neighbourhood full of them. Shards
    are drawn by the hash of the vector and hold vectors of one length.

    Columns: ``dims, shard, node, vector, ids, links, start``.
    """
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    nodes = scratch.write(
        rows.withColumn("place", place)
        .where(F.col("place") <= ids_per_vector)
        .groupBy("vector")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids")),
        "nodes",
    )
    shards = max(1, math.ceil(nodes.count() / rows_per_shard))
    dealt = nodes.select(
        F.size("vector").alias("dims"), F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), "vector", "ids"
    )
    kind, id_kind = (nodes.schema[c].dataType.simpleString() for c in ("vector", "ids"))

    def build(table: pa.Table) -> pa.Table:
        first = np.array([ids[0] for ids in table.column("ids").to_pylist()])
        table = table.take(pa.array(np.argsort(first, kind="stable")))
        scaled, length = unit(_matrix(table.column("vector")))
        graph = Graph.build((scaled / length[:, None]).astype(np.float32), degree, beam, relax)
        n, width = graph.links.shape
        filled = graph.links >= 0
        ends = np.concatenate([[0], np.cumsum(filled.sum(axis=1))]).astype(np.int32)
        links = pa.ListArray.from_arrays(pa.array(ends), pa.array(graph.links[filled].astype(np.int32)))
        node = np.arange(n, dtype=np.int32)
        out = table.select(["dims", "shard", "vector", "ids"])
        out = out.add_column(2, "node", pa.array(node))
        return out.append_column("links", links).append_column("start", pa.array(node == graph.start))

    schema = f"dims int, shard int, node int, vector {kind}, ids {id_kind}, links array<int>, start boolean"
    return scratch.write(dealt.groupBy("dims", "shard").applyInArrow(build, schema), "graph"), shards


def search_index(
    index: DataFrame, shards: int, queries: DataFrame, k: int, beam: int = 128, queries_at_once: int = 16384
) -> DataFrame:
    """The ``k`` best of what each shard finds for ``queries`` (``vec_id, vector``).

    Queries are cut into blocks; each block meets each shard in a task of its own. A shard
    gives ``k`` rows per query, ranked before they are shuffled.

    Returns ``query_id, rank, vec_id, score``.
    """
    blocks = max(1, math.ceil(queries.count() / queries_at_once))
    asked = queries.select(
        F.size("vector").alias("dims"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).cast("int").alias("block"),
        F.col("vec_id").alias("query_id"),
        F.xxhash64("vector").alias("asked"),
        "vector",
    )
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    id_type = index.schema["ids"].dataType.elementType.simpleString()

    def search(shard: pa.Table, block: pa.Table) -> pa.Table:
        names = ["query_id", "asked", "vec_id", "score"]
        id_kind = block.schema.field("query_id").type
        kinds = [id_kind, pa.int64(), id_kind, pa.float64()]
        if not shard.num_rows or not block.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names)
        shard = shard.sort_by("node")
        scaled, length = unit(_matrix(shard.column("vector")))
        lists = shard.column("links").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        links = np.full((shard.num_rows, max(1, sizes.max(initial=0))), -1, np.int64)
        links[np.arange(links.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
        start = int(np.flatnonzero(shard.column("start").to_numpy())[0])
        graph = Graph((scaled / length[:, None]).astype(np.float32), links, start)
        asked_for, asked_length = unit(_matrix(block.column("vector")))
        nodes, _ = graph.beam_search((asked_for / asked_length[:, None]).astype(np.float32), max(beam, 2 * k))
        ids = shard.column("ids").to_pylist()
        first = np.array([x[0] for x in ids])
        query_ids, rows = block.column("query_id").to_pylist(), []
        digests = block.column("asked").to_pylist()
        for i, own in enumerate(query_ids):
            found = nodes[i][nodes[i] >= 0]
            score = np.einsum("ij,j->i", scaled[found], asked_for[i]) / (length[found] * asked_length[i])
            # Each node but the query's own gives one row at least.
            best = np.lexsort((first[found], -score))[: k + 1]
            near = sorted((-score[b], x) for b in best for x in ids[found[b]] if x != own)[:k]
            rows += [(own, digests[i], x, -s) for s, x in near]
        columns = zip(*rows) if rows else [()] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    keys = ["dims", "shard", "block"]
    found = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        search, f"query_id {id_type}, asked bigint, vec_id {id_type}, score double"
    )
    by_query = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    beam: int = 128,
    rows_per_shard: int = 8192,
) -> DataFrame:
    """The ``k`` vectors nearest by cosine to each row that ``is_query`` (a condition on ``vec_id``) names.

    Every vector is indexed, every query searches every shard, so that a query costs in
    proportion to the number of shards: ``rows_per_shard`` should grow with the table as far as
    memory allows (about 1 KB a row). Candidates are all rows but those with the query's id.
    Equal vectors are found together or not at all, and named by their smallest ids; equal
    scores go to the smaller id. With no more than ``beam`` distinct vectors in a shard nothing is missed.

    Null vectors, those of zeros only and those that hold null or non-finite components take no
    part, nor do rows without id, which could not be named. Vectors of different lengths are
    not compared. Rows that repeat count once; an id with two different vectors is asked for
    both. An empty table gives no rows; other columns are not read.

    Returns ``query_id, rank, vec_id, score``, the score in double precision on the original vectors.
    """
    scratch = Scratch(vectors.sparkSession, "neighbours")
    rows = scratch.write(usable(vectors, id_col, vector_col), "usable")
    index, shards = index_vectors(rows, k + 1, scratch, rows_per_shard)
    return search_index(index, shards, rows.where(is_query), k, beam)
