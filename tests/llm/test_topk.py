import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from delayhouse.llm import topk


def brute_force(rows, k):
    """Best rows of each query from (identifier, integers) rows, by all products."""
    asked = {}
    for i, v in rows:
        if i % 20 == 0:
            asked[i] = min(asked.get(i, v), v)
    for q, v in asked.items():
        found = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v)]
        for rank, (score, i) in enumerate(sorted(found)[:k], 1):
            yield q, rank, i, -score


def integers(v):
    return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(64 * x) for x in v]


def search(spark, rows, **options):
    given_rows = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, value string")
    usable = given_rows.filter(F.col("vec_id").isNotNull() & topk.usable(F.col("embedding")))
    vectors = usable.select("vec_id", topk.integers(F.col("embedding")).alias("value"))
    found = topk.top_k(spark, vectors, vectors.filter("vec_id % 20 = 0"), **options).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)


def test_ties_odd_vectors_and_repeats(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(3)], 1, "x") for i in range(150)]
    rows += [(60, [0.5, 0.5, 0.5], 1, "x"), (7, [0.25, 0.5, 0.0], 1, "x"), (7, [0.25, 0.5, 0.0], 1, "x"), (-20, [1.0, -1.0, 3.0], 1, "x")]
    rows += [(300, None, 1, "x"), (301, [None, 1.0, 1.0], 1, "x"), (302, [float("nan"), 1.0, 1.0], 1, "x"), (303, [float("inf"), 1.0, 1.0], 1, "x")]
    rows += [(None, [1.0, 1.0, 1.0], 1, "x"), (320, [1.0, 2.0], 1, "x"), (321, [3.0, -2.0], 1, "x"), (340, [], 1, "x"), (341, [], 1, "x")]
    plain = [(i, integers(v)) for i, v, _, _ in rows if i is not None and integers(v) is not None]
    assert search(spark, rows) == sorted(brute_force(plain, 20))
    assert search(spark, []) == []


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 70)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 3)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.4) for _ in range(8)], 1, "x") for i in range(400)]
    assert search(spark, rows, k=5) == sorted(brute_force([(i, integers(v)) for i, v, _, _ in rows], 5))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 130), st.integers(1, 6), st.integers(1, 25))
def test_slices_add_up_and_select(seed, n, width, k):
    rng = np.random.default_rng(seed)
    values = rng.integers(-40, 40, (n, width)) // int(rng.integers(1, 30))
    query = rng.integers(-9, 9, width)
    lowest, plain = topk.slice_rows(values)
    ids = np.arange(n) * 2
    found, scores = topk.Block(ids, lowest, plain).top(4, query, k)
    expected = sorted((-int(s), int(i)) for i, s in zip(ids, values @ query) if i != 4)[:k]
    assert sorted(zip((-scores).tolist(), found.tolist())) == expected


def test_documents_recall_is_complete(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, integers(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.query(spark, sf).collect())
    assert got == sorted(brute_force([r for r in rows if r[1] is not None], 20))
