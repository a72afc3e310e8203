"""Approximate nearest neighbours next to brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quayside.llm import permutation
from quayside.llm.queries import op13_permutation_index, table

VECTORS = "vec_id long, embedding array<double>"


def inner(a, b):
    total = 0.0
    for x, y in zip(a, b, strict=False):
        total += x * y
    return total


def nearest_by_hand(rows, k, every):
    rows = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    asked = {}
    for i, v in sorted(rows):
        if i % every == 0:
            asked.setdefault(i, v)
    return {q: sorted(((-inner(v, w), i) for i, w in rows if i != q))[:k] for q, v in asked.items()}


def lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.1"])
def test_recall_of_the_tables(spark, scale):
    folder = f"/root/testdata/{scale}"
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in table(spark, folder, "embeddings").select("vec_id", "embedding").collect()]
    want, got = nearest_by_hand(rows, 20, 20), lists(op13_permutation_index(spark, folder).collect())
    assert set(got) == set(want) and all(len(got[q]) == 20 and got[q] == sorted(got[q]) for q in want)
    scores = dict(rows)
    assert all(-s == inner(scores[q], scores[i]) for q in got for s, i in got[q])
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.93 * 20 * len(want)


def test_several_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(permutation, "QUERY_ROWS", 40)
    draw = random.Random(3)
    rows = [(i, [draw.gauss(0, 1) for _ in range(8)]) for i in range(1500)]
    index = permutation.build_index(spark.createDataFrame(rows, VECTORS).repartition(5), pivots=64, prefix=32, shard_rows=300)
    assert index.shards == 5 and index.rows.count() == 1500
    assert {len(r.order) for r in index.rows.collect()} == {64}
    asked = index.rows.filter("vec_id % 10 = 0").drop("shard")
    want = nearest_by_hand(rows, 20, 10)
    got = lists(permutation.search(index, asked, least=60).collect())
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.93 * 20 * len(want)
    assert lists(permutation.search(index, asked, share=1).collect()) == want


def test_copies_take_no_places(spark):
    """Two thirds of all rows are one vector, and its copies with the smallest ids answer first."""
    draw = random.Random(4)
    one = [1.0, 0.5, -0.25, 0.0]
    rows = [(i, one if i % 3 else [draw.gauss(0, 1) for _ in range(4)]) for i in range(900)]
    rows += [(20, one)] * 30
    docs = spark.createDataFrame(rows, VECTORS)
    assert len(permutation.choose_pivots(permutation.usable(docs), 512)) > 100
    got = lists(permutation.nearest(docs, F.col("vec_id") % 20 == 0).collect())
    want = nearest_by_hand(rows, 20, 20)
    assert set(got) == set(want) and got[40] == want[40] and got[20] == want[20]
    assert sum(len(set(got[q]) & set(want[q])) for q in want) >= 0.95 * 20 * len(want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (20, [1.0, 2.0, 3.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
        (None, [1.0, 1.0]), (7, [-1.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (0, [1.0, 2.0]), (40, [0.0]), (-20, [5.0, 5.0]), (9, [1e300, 1e-300]),
    ]
    vectors = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], VECTORS + ", vector string, `order` int")
    got = lists(permutation.nearest(vectors, F.col("vec_id") % 20 == 0).collect())
    assert got == nearest_by_hand(rows, 20, 20) and set(got) == {0, 20, -20}
    assert permutation.nearest(vectors.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert permutation.nearest(vectors.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).collect() == []
