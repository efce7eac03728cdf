"""Exact top-k inner products by dual-tree search on cover trees (operator 2).

Vectors become integers, floor(256 * x). The upper level of the tree is a set
of at most PIVOTS centres, chosen farthest-first from a bounded sample; every
vector belongs to its nearest centre, whose covering radius is the largest
distance of its members. A centre's vectors are dealt over blocks of at most
about BLOCK rows and BLOCK_BYTES bytes (a hot vector's copies too), one block in
memory at a time (three times its bytes: the vectors, their order, as doubles).

1. Seed: each query is searched in one block of its own centre; its kth score
   there is a lower bound.
2. A query goes on to the blocks of every centre whose bound
   <q, c> + |q| * radius reaches that score.
3. In a block the data are one cover tree and each batch of queries another:
   node pairs are visited best bound first, and a pair goes when
   <cq, cd> + rq |cd| + rd |cq| + rq rd is below the worst kth score of the
   query node. Leaf pairs are scored by one matrix product.
4. The best k of a query's partial results win; ties go to the smaller id.

The trees hold at most FAN children a node (radii are the real covering radii,
so bounds stay exact for any data); of equal vectors in a block only the k + 1
smallest ids can matter.

Edge cases: vectors null, empty, or with a null or non-finite component take
no part, as query or candidate, nor do rows with a null id; vectors of another
length than the query's are no candidates of it; fewer than k candidates: all
of them; rows sharing an id are separate candidates, none of them the query's
own, and as queries one for each distinct vector; zero vectors and ties are
ordinary; scores are exact up to 2**53 and modulo 2**64 beyond; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import few_by_hash, materialise, table
from .textscan import mix64

K = 5
SCALE = 256
EVERY = 50
PIVOTS = 32
SAMPLE = 1024
BLOCK, BLOCK_BYTES = 131_072, 1 << 26
LEAF, FAN = 128, 8
NONE = np.iinfo(np.int64).min


def eligible(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, x (doubles) of the rows that take part."""
    parts = F.col(vec_col).cast("array<double>")
    fine = (F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0)
            & F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return vectors.filter(fine).select(F.col(id_col).cast("long").alias("id"), parts.alias("x"))


def integer_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """id, v (binary, int64 components) of ``eligible`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            x = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            x = np.clip(x, -(2.0 ** 63), 2.0 ** 63 - 1024).astype(np.int64)
            cuts = np.cumsum([0, *lists.value_lengths().to_pylist()])
            packed = [x[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["id", "v"])

    return rows.mapInArrow(run, "id long, v binary")


def block_rows(length: int) -> int:
    """Rows a block of vectors of ``length`` bytes is dealt."""
    return max(1, min(BLOCK, BLOCK_BYTES // length))


def unpack(column) -> np.ndarray:
    """Rows of equally long packed vectors as one int64 matrix."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.int64).reshape(len(rows), -1)


def spread_out(points: np.ndarray, count: int, enough: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Farthest-first centres: (their rows, nearest centre of each point,
    distance to it). Stops when all points are within ``enough``."""
    far = int(np.argmax(((points - points.mean(0)) ** 2).sum(1)))
    chosen, owner = [far], np.zeros(len(points), np.int64)
    reach = ((points - points[far]) ** 2).sum(1)
    while len(chosen) < min(count, len(points)) and reach.max() > enough ** 2:
        far = int(np.argmax(reach))
        d = ((points - points[far]) ** 2).sum(1)
        closer = d < reach
        owner[closer], reach[closer] = len(chosen), d[closer]
        chosen.append(far)
    return np.array(chosen), owner, np.sqrt(reach)


class Node:
    __slots__ = ("rows", "centre", "norm", "radius", "children")

    def __init__(self, points: np.ndarray, rows: np.ndarray, centre: np.ndarray, radius: float, leaf: int):
        self.rows, self.centre, self.radius, self.children = rows, centre, radius, []
        self.norm = float(np.sqrt(centre @ centre))
        if len(rows) > leaf and radius > 0:
            mine = points[rows]
            chosen, owner, reach = spread_out(mine, FAN, radius / 2)
            for i, c in enumerate(chosen):
                of = owner == i
                child = Node(points, rows[of], mine[c], float(reach[of].max()) * (1 + 1e-12), leaf)
                self.children.append(child)


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> Node:
    centre = points.mean(0)
    radius = float(np.sqrt(((points - centre) ** 2).sum(1).max())) * (1 + 1e-12)
    return Node(points, np.arange(len(points)), centre, radius, leaf)


class BlockIndex:
    """Cover tree over one block's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        # Equal vectors meet by a hash; one that shares it splits them, and more is kept.
        odd = mix64(np.arange(1, vectors.shape[1] + 1)) | np.uint64(1)
        order = np.lexsort((ids, mix64(vectors.view(np.uint64) @ odd)))
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(1)
        first = np.flatnonzero(new)
        place = np.arange(len(ids)) - first[np.cumsum(new) - 1]
        keep = place <= k  # of equal vectors, the k + 1 smallest ids
        self.ids, self.vectors, self.k = ids[keep], vectors[keep], k
        self.points = self.vectors.astype(np.float64)
        self.tree = cover_tree(self.points)
        self.largest = float(np.abs(self.points).max(initial=0))

    def search(self, ids: np.ndarray, vectors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of each query's best k here, NONE where fewer; only
        scores of at least ``least`` (a known kth score, or NONE) are sure."""
        points = vectors.astype(np.float64)
        exact = self.largest * float(np.abs(points).max(initial=0)) * points.shape[1] < 2.0 ** 53
        best = np.full((len(ids), self.k), NONE, np.int64)
        best_id = np.full((len(ids), self.k), np.iinfo(np.int64).max, np.int64)
        worst = least.astype(np.float64)  # what a candidate must reach
        root = cover_tree(points, 64)

        def bound(q: Node, d: Node) -> float:
            b = float(q.centre @ d.centre) + q.radius * d.norm + d.radius * q.norm + q.radius * d.radius
            return b + 1e-9 * (abs(b) + q.norm * d.norm + 1)

        todo = [(bound(root, self.tree), root, self.tree)]
        while todo:
            b, q, d = todo.pop()
            if b < worst[q.rows].min():
                continue
            if q.children and (not d.children or q.radius >= d.radius):
                todo += sorted(((bound(c, d), c, d) for c in q.children), key=lambda x: x[0])
                continue
            if d.children:
                todo += sorted(((bound(q, c), q, c) for c in d.children), key=lambda x: x[0])
                continue
            if exact:
                scores = (points[q.rows] @ self.points[d.rows].T).astype(np.int64)
            else:
                scores = vectors[q.rows] @ self.vectors[d.rows].T
            theirs = np.broadcast_to(self.ids[d.rows], scores.shape)
            open_ = theirs != ids[q.rows][:, None]
            hit = ((scores >= worst[q.rows][:, None]) & open_).any(1)
            if not hit.any():
                continue
            rows = q.rows[hit]
            s = np.concatenate([best[rows], np.where(open_[hit], scores[hit], NONE)], 1)
            i = np.concatenate([best_id[rows], np.where(open_[hit], theirs[hit], np.iinfo(np.int64).max)], 1)
            order = np.lexsort((i, ~s), axis=1)[:, :self.k]  # ~s: descending without overflow
            best[rows], best_id[rows] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
            kth = best[rows, -1]
            worst[rows] = np.where(kth > NONE, np.maximum(worst[rows], kth), worst[rows])
        return best, best_id


def _queue(data: DataFrame, queries: DataFrame, parts: int) -> DataFrame:
    """Data and queries of each block together, the data first."""
    d = data.select("block", F.lit(0).alias("kind"), "id", "v", F.lit(None).cast("long").alias("least"), F.lit(0).cast("long").alias("query"))
    q = queries.select("block", F.lit(1).alias("kind"), "id", "v", "least", "query")
    return d.unionByName(q).repartition(parts, "block").sortWithinPartitions("block", "kind")


def _search(queue: DataFrame, k: int) -> DataFrame:
    """query_id, query, vec_id, score, kth (the query's kth score here, if it has k)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, index, ids, parts = None, None, [], []
        for batch in batches:
            keys = batch.column(0).to_pylist()
            kinds = batch.column(1).to_numpy()
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or kinds[i] != kinds[i - 1]), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if keys[a] != block:
                    block, index, ids, parts = keys[a], None, [], []
                if kinds[a] == 0:
                    ids.append(part.column(2).to_numpy())
                    parts.append(unpack(part.column(3)))
                    continue
                if index is None:
                    if not ids:
                        continue
                    index = BlockIndex(np.concatenate(ids), np.concatenate(parts), k)
                    ids, parts = [], []
                own = part.column(2).to_numpy()
                least = part.column(4).fill_null(int(NONE)).to_numpy()
                score, theirs = index.search(own, unpack(part.column(3)), least)
                row, col = np.nonzero(score > NONE)
                kth = score[:, -1][row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[row]), pa.array(part.column(5).to_numpy()[row]), pa.array(theirs[row, col]),
                     pa.array(score[row, col]), pa.array(kth, mask=kth == NONE)],
                    ["query_id", "query", "vec_id", "score", "kth"])

    return queue.mapInArrow(run, "query_id long, query long, vec_id long, score long, kth long")


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query
    (``is_query`` is a condition on the column ``id``) among all other rows."""
    spark = vectors.sparkSession
    rows = eligible(vectors, id_col, vec_col)
    whole = integer_vectors(rows)
    sample = integer_vectors(few_by_hash(rows, "pivot", "id", SAMPLE)).orderBy(F.xxhash64("id"), "v").limit(SAMPLE).collect()
    centres: dict[int, np.ndarray] = {}
    for length in {len(r["v"]) for r in sample}:
        points = np.array([np.frombuffer(r["v"], np.int64) for r in sample if len(r["v"]) == length], np.float64)
        centres[length] = points[spread_out(points, PIVOTS)[0]]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nearest centre (by length and number) and the distance to it."""
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column(1).to_pylist()], np.int64)
            pivot, reach = np.zeros(len(lengths), np.int32), np.full(len(lengths), np.inf)
            for length in np.unique(lengths):
                of = np.flatnonzero(lengths == length)
                if int(length) in centres:
                    x = unpack(batch.column(1).take(pa.array(of))).astype(np.float64)
                    d = np.stack([((x - c) ** 2).sum(1) for c in centres[int(length)]], 1)
                    pivot[of], reach[of] = d.argmin(1), np.sqrt(d.min(1)) * (1 + 1e-9)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lengths), pa.array(pivot), pa.array(reach)], ["id", "v", "length", "pivot", "reach"])

    placed = materialise(whole.mapInArrow(place, "id long, v binary, length long, pivot int, reach double"))
    # One row per centre: bounded by PIVOTS times the number of vector lengths.
    found = placed.groupBy("length", "pivot").agg(F.count("*").alias("n"), F.max("reach").alias("radius")).collect()
    blocks = {(r["length"], r["pivot"]): -(-r["n"] // block_rows(r["length"])) for r in found}
    radius = {(r["length"], r["pivot"]): r["radius"] for r in found}
    parts = 2 * sum(blocks.values())

    name = F.concat_ws(":", "length", "pivot", "salt")
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    salts = F.element_at(F.create_map(*[x for (a, b), n in blocks.items() for x in (F.lit(f"{a}:{b}"), F.lit(n))]),
                         F.concat_ws(":", "length", "pivot"))
    dealt = placed.withColumn("salt", F.pmod(F.xxhash64("id", F.lit("block")), salts)).withColumn("block", name)
    data = dealt.select("block", "id", "v")
    queries = dealt.filter(is_query).withColumn("query", F.xxhash64("v")).dropDuplicates(["id", "v"])
    seeds = materialise(_search(_queue(data, queries.withColumn("least", F.lit(None).cast("long")), parts), k))
    lower = seeds.groupBy(F.col("query_id").alias("id"), "query").agg(F.min("kth").alias("least"))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The blocks a query must still see: those of every centre whose bound
        reaches its kth score, less the one it was seeded in."""
        for batch in batches:
            lengths = batch.column(3).to_numpy()
            for of in np.unique(lengths).tolist():
                mine = batch.take(pa.array(np.flatnonzero(lengths == of)))
                q = unpack(mine.column(2)).astype(np.float64)
                norm, least = np.sqrt((q * q).sum(1)), mine.column(4).fill_null(int(NONE)).to_numpy()
                seen = mine.column(5).to_numpy(zero_copy_only=False)
                for (length, pivot), n in blocks.items():
                    if length != of:
                        continue
                    bound = q @ centres[of][pivot] + norm * radius[of, pivot] if of in centres else np.full(len(q), np.inf)
                    reached = bound + 1e-9 * (np.abs(bound) + norm + 1) >= least
                    for block in (f"{of}:{pivot}:{s}" for s in range(n)):
                        part = mine.take(pa.array(np.flatnonzero(reached & (seen != block))))
                        if len(part):
                            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in (0, 1, 2, 4)), pa.array([block] * len(part))],
                                                             ["id", "query", "v", "least", "block"])

    onward = (queries.join(lower, ["id", "query"], "left").select("id", "query", "v", "length", "least", "block")
              .mapInArrow(route, "id long, query long, v binary, least long, block string"))
    rest = _search(_queue(data, onward, parts), k)
    best = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    return (seeds.unionByName(rest).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % EVERY == 0)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""
