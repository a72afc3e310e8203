"""Exact top-k search by inner product, as branch and bound over a vertical layout.

Queries and candidates are dealt as blocks of bounded size; each pair of blocks is one
group. Within it vectors lie dimension by dimension. Products are accumulated over one
block of dimensions after the other. What the other dimensions can still add is at most
the product of the remaining lengths, so a candidate whose sum and bound stay below the
k-th best score known is given up, and the survivors are compacted for the next block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import batch, prepare

#: Rows of a block.
QUERY_ROWS, CANDIDATE_ROWS = 2048, 8192
#: Dimensions that are added at a time.
STEP = 16


def integer_vectors(vectors: DataFrame, scale: float) -> DataFrame:
    """``vec_id, vector``: floor(scale * x) of each component, as whole doubles.

    Vectors that are null, or hold null or non-finite components, are left out, and so
    are rows without vec_id.
    """
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("numbers", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (
        vectors.filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .select(F.col("vec_id").cast("long").alias("vec_id"), numbers.alias("numbers"))
        .filter(finite)
        .select("vec_id", F.transform("numbers", lambda x: x * scale).alias("vector"))
    )


def vertical(column: pa.ChunkedArray) -> np.ndarray:
    """One column per vector; shorter ones end in zeros."""
    rows = column.combine_chunks()
    sizes = np.diff(rows.offsets.to_numpy())
    values = np.floor(rows.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((int(sizes.max(initial=0)), len(rows)))
    at = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[at, np.repeat(np.arange(len(rows)), sizes)] = values
    return out


def remaining(block: np.ndarray) -> list[np.ndarray]:
    """Lengths of the vectors from dimension 0, STEP, 2 * STEP, ... on."""
    square = np.cumsum((block.astype(np.float64) ** 2)[::-1], axis=0)[::-1]
    return [np.sqrt(square[d]) for d in range(0, len(block), STEP)] + [np.zeros(block.shape[1])]


def best(query: np.ndarray, rests: list[float], block: np.ndarray, lengths: list[np.ndarray], ids: np.ndarray, alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best columns among ``alive``, ties to the smaller id."""
    sums = np.zeros(len(alive), block.dtype)
    bar = -np.inf
    whole = block  # the first step reads all columns in place
    for number, d in enumerate(range(0, len(query), STEP)):
        part = whole[d : d + STEP] if len(alive) == block.shape[1] else block[d : d + STEP, alive]
        sums = sums + query[d : d + STEP] @ part
        bound = rests[number + 1] * lengths[number + 1][alive]
        highest = sums.astype(np.float64) + bound * (1 + 1e-9) + 1e-6
        if number == 0 and len(alive) > k:  # whole scores of the most promising give the first bar
            seeds = alive[np.argpartition(-highest, k - 1)[:k]]
            bar = float(min(query @ block[:, seeds]))
        live = highest >= bar * (1 - 1e-15 if bar > 0 else 1 + 1e-15)
        alive, sums = alive[live], sums[live]
    order = np.lexsort((ids[alive], -sums))[:k] if sums.dtype != object else np.array(sorted(range(len(alive)), key=lambda i: (-sums[i], ids[alive[i]]))[:k], int)
    return ids[alive[order]], sums[order]


def search_blocks(k: int):
    def run(key: tuple, queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[pa.RecordBatch] = []
        if len(queries) and len(candidates):
            q, block = vertical(queries.column("vector")), vertical(candidates.column("vector"))
            dims = max(len(q), len(block))
            q, block = (np.pad(x, ((0, dims - len(x)), (0, 0))) for x in (q, block))
            ids = candidates.column("vec_id").to_numpy()
            if dims and np.abs(q).max() * np.abs(block).max() * dims >= 2.0**53:  # beyond exact doubles
                q, block = (np.array([[int(v) for v in row] for row in x], object) for x in (q, block))
            lengths, rests = remaining(block), remaining(q)
            for i, own in enumerate(queries.column("vec_id").to_pylist()):
                alive = np.flatnonzero(ids != own)
                found, scores = best(q[:, i], [float(r[i]) for r in rests], block, lengths, ids, alive, k)
                if scores.dtype == object:
                    scores = np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in scores], np.int64)
                out.append(batch(query_id=np.full(len(found), own), vec_id=found, score=scores.astype(np.int64)))
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        return pa.Table.from_batches(out, schema)

    return run


def numbers(n: int) -> Column:
    """0 to n - 1, as 64-bit numbers like the remainders of hashes."""
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest scores among all other rows.

    ``is_query`` tells queries by ``vec_id``. Vectors of different lengths are compared
    as if the shorter ended in zeros; a sum beyond 64 bits is given as the nearest number
    of 64 bits. Rows that repeat a vec_id are candidates each; a query is asked once, and rows with its own id never
    answer it.
    """
    spark = prepare(vectors.sparkSession)
    rows = integer_vectors(vectors, scale)
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n, m = rows.count(), queries.count()
    slices, blocks = max(-(-n // CANDIDATE_ROWS), 1), max(-(-m // QUERY_ROWS), 1)
    place = F.xxhash64(F.lit("place"), "vec_id")
    asked = queries.select(
        "vec_id", "vector", F.pmod(place, F.lit(blocks)).alias("block"), F.explode(numbers(slices)).alias("slice")
    )
    spread = F.pmod(F.xxhash64("vec_id", "vector", F.monotonically_increasing_id()), F.lit(slices))
    dealt = rows.select("vec_id", "vector", spread.alias("slice")).select(
        "vec_id", "vector", F.explode(numbers(blocks)).alias("block"), "slice"
    )
    found = (
        asked.groupBy("block", "slice")
        .cogroup(dealt.groupBy("block", "slice"))
        .applyInArrow(search_blocks(k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


