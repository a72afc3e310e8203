"""Approximate nearest neighbours by inner product, with a permutation index.

A vector is represented by its nearest pivots in order of nearness, and posted under each
of them with its place in that order. Vectors that see the pivots in a similar order lie
near each other: a query walks the posting lists of its own first pivots, adds up how far
each place is from its own (the footrule distance, a pivot that is not posted counting as
the place behind the last), and only the vectors of least distance are scored exactly.

Pivots are a bounded sample: of each of ``PIVOTS`` buckets of a hash of the vector, the
vector of the smallest hash, so copies of one vector are one pivot at most. All rows are
indexed. Rows are dealt to shards of bounded size, each with posting lists of its own;
every query visits every shard, in blocks. Equal vectors of a shard are posted once, so
a large group of copies takes no places from others.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import batch, mapped, prepare
from quayside.session import stage

#: Pivots, those a vector is posted under, and those of a query that are looked up.
PIVOTS, PREFIX, DEPTH = 512, 128, 64
#: The share of a shard's vectors that is scored exactly, and the least number of them.
SHARE, LEAST = 1 / 8, 256
#: Rows of a block of queries and of a shard.
QUERY_ROWS, SHARD_ROWS = 2048, 8192


class Index(NamedTuple):
    """``rows``: vec_id, vector, order (16-bit pivot numbers, nearest first) and shard, as written to the shared folder."""

    rows: DataFrame
    shards: int
    prefix: int


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` in double precision.

    Rows without vec_id are left out, and vectors that are null, empty or zero, or hold
    null or non-finite components.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
        .filter(finite & F.exists("vector", lambda x: x != 0))
    )


def matrix(column: pa.Array | pa.ChunkedArray, dims: int) -> np.ndarray:
    """A row per vector; shorter ones end in zeros."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(rows.offsets.to_numpy())
    out = np.zeros((len(rows), dims))
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(rows)), sizes), at] = rows.flatten().to_numpy(zero_copy_only=False)
    return out


def choose_pivots(rows: DataFrame, count: int) -> list[list[float]]:
    """At most ``count`` different vectors, the same ones however the rows are dealt."""
    hashed = rows.select(F.xxhash64("vector").alias("hash"), "vector")
    least = hashed.groupBy(F.pmod("hash", F.lit(count)).alias("bucket")).agg(F.min("hash").alias("hash"))
    chosen = [r.hash for r in least.select("hash").collect()]
    return sorted(list(r.vector) for r in hashed.filter(F.col("hash").isin(chosen)).select("vector").distinct().collect()[:count])


def ordered(pivots: np.ndarray, prefix: int):
    """Rows with ``order``: the numbers of the nearest pivots, ties to the smaller number."""
    unit = pivots / np.linalg.norm(pivots / np.abs(pivots).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(pivots).max(axis=1, keepdims=True)

    def run(batches):
        for rows in batches:
            vectors = matrix(rows.column("vector"), pivots.shape[1])
            near = (vectors / np.abs(vectors).max(axis=1, keepdims=True)) @ unit.T
            order = np.argsort(-near, axis=1, kind="stable")[:, :prefix].astype("<i2")
            yield batch(vec_id=rows.column("vec_id"), vector=rows.column("vector"), order=pa.array([x.tobytes() for x in order], pa.binary()), shard=rows.column("shard"))

    return run


def build_index(vectors: DataFrame, pivots: int = PIVOTS, prefix: int = PREFIX, shard_rows: int = SHARD_ROWS) -> Index:
    """Index every usable row of ``vectors`` (vec_id, embedding); other columns are dropped."""
    prepare(vectors.sparkSession)
    rows = usable(vectors)
    n, dims = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    shards = max(-(-n // shard_rows), 1)
    shard = F.pmod(F.xxhash64("vec_id", "vector", F.monotonically_increasing_id()), F.lit(shards))
    chosen = choose_pivots(rows, pivots)
    table = np.zeros((max(len(chosen), 1), dims or 1))
    for place, vector in enumerate(chosen):
        table[place, : len(vector)] = vector
    prefix = min(prefix, len(table))
    schema = "vec_id long, vector array<double>, order binary, shard long"
    dealt = rows.select("vec_id", "vector", shard.alias("shard"))
    return Index(stage(mapped(dealt, ordered(table if n else table + 1, prefix), schema), "permutations"), shards, prefix)


class Shard:
    """Posting lists of the different vectors of one shard, and the ids that share each."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, orders: np.ndarray, pivots: int, k: int):
        keys = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.shape[1] * 8))).ravel()
        _, same = np.unique(keys, return_inverse=True)
        by = np.lexsort((ids, same))
        heads = np.flatnonzero(np.diff(same[by], prepend=-1))
        by_id = np.argsort(ids[by[heads]], kind="stable")  # ties of the distance go to the smaller id
        sizes = np.diff(heads, append=len(ids))[by_id]
        #: One vector has at most so many answers to a query, its own rows among them.
        self.most = k + int(np.unique(ids, return_counts=True)[1].max())
        self.starts, self.sizes, self.members = heads[by_id], np.minimum(sizes, self.most), ids[by]
        first = by[heads[by_id]]
        self.columns = np.ascontiguousarray(vectors[first].T)
        orders = orders[first]
        self.prefix = orders.shape[1]
        flat = orders.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.rows, self.places = by_pivot // self.prefix, (by_pivot % self.prefix).astype(np.int32)
        self.lists = np.concatenate([[0], np.cumsum(np.bincount(flat, minlength=pivots))])

    def nearest(self, order: np.ndarray, count: int) -> np.ndarray:
        """Numbers of the ``count`` vectors of least footrule distance."""
        distance = np.full(len(self.starts), int((self.prefix - np.arange(len(order))).sum()), np.int32)
        for place, pivot in enumerate(order.tolist()):
            here = slice(self.lists[pivot], self.lists[pivot + 1])
            distance[self.rows[here]] -= self.prefix - place - np.abs(self.places[here] - place)
        return np.argsort(distance, kind="stable")[:count]

    def search(self, own: int, vector: np.ndarray, order: np.ndarray, k: int, count: int) -> tuple[np.ndarray, np.ndarray]:
        found = self.nearest(order, count)
        scores = np.zeros(len(found))
        for x, column in zip(vector.tolist(), self.columns, strict=True):  # in the order of the components: equal vectors score alike
            scores += x * column[found]
        sizes = self.sizes[found]
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.starts[found], sizes)
        ids, scores = self.members[at], np.repeat(scores, sizes)
        ids, scores = ids[ids != own], scores[ids != own]
        best = np.lexsort((ids, -scores))[:k]
        return ids[best], scores[best]


def search_shard(k: int, prefix: int, depth: int, share: float, least: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def orders(column: pa.ChunkedArray) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), "<i2").reshape(-1, prefix)

    def run(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        if len(queries) and len(rows):
            dims = max(len(v) for side in (queries, rows) for v in side.column("vector"))
            asked, own = orders(queries.column("order")), orders(rows.column("order"))
            pivots = int(max(asked.max(), own.max())) + 1
            shard = Shard(rows.column("vec_id").to_numpy(), matrix(rows.column("vector"), dims), own, pivots, k)
            count = max(least, int(share * len(shard.starts)))
            vectors = matrix(queries.column("vector"), dims)
            for i, query in enumerate(queries.column("vec_id").to_pylist()):
                ids, scores = shard.search(query, vectors[i], asked[i, :depth], k, count)
                out.append(batch(query_id=np.full(len(ids), query), vec_id=ids, score=scores))
        return pa.Table.from_batches(out, schema)

    return run


def search(index: Index, queries: DataFrame, k: int = 20, depth: int = DEPTH, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found for each of ``queries``, which are rows of the index."""
    m = queries.count()
    blocks = max(-(-m // QUERY_ROWS), 1)

    def numbers(n: int) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))

    block = F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.lit(blocks))
    asked = queries.select("vec_id", "vector", "order", block.alias("block"), F.explode(numbers(index.shards)).alias("shard"))
    dealt = index.rows.select("vec_id", "vector", "order", "shard", F.explode(numbers(blocks)).alias("block"))
    found = (
        asked.groupBy("block", "shard")
        .cogroup(dealt.groupBy("block", "shard"))
        .applyInArrow(search_shard(k, index.prefix, min(depth, index.prefix), share, least), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest found among all other rows.

    ``is_query`` tells queries by ``vec_id``. The score is the inner product of the
    original vectors, summed in the order of the components; ties go to the smaller
    vec_id. Rows left out by ``usable`` neither ask nor answer. Vectors of different
    lengths are compared as if the shorter ended in zeros. Rows that repeat a vec_id are
    candidates each; such a query is asked once, by the smallest of its vectors, and rows
    with its own id never answer it. An empty table gives no rows.
    """
    index = build_index(vectors)
    rows = index.rows.filter(is_query).groupBy("vec_id").agg(F.min(F.struct("vector", "order")).alias("it"))
    return search(index, rows.select("vec_id", "it.vector", "it.order"), k)
