import re

import pytest

from delayhouse.llm import mixing

from .messy import documents, nothing, texts


def water_fill(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Targets by the contract's words: give out by weight, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * per >= cap * sizes[s]}
        if not full:
            return target | {s: weight[s] * per for s in open_}
        for s in full:
            target[s] = cap * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, given_rows):
    sizes = {}
    for _, text, source in given_rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    goal = water_fill(sizes)
    source_of = {i: (s, size(t)) for i, t, s in given_rows}
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        source, words = source_of[r.doc_id]
        assert r.size == words and r.source_size == sizes[source]
        assert r.target == pytest.approx(goal[source], rel=1e-9) and 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for source in sizes:
        largest = max(n for s, n in source_of.values() if s == source)
        assert abs(taken[source] - goal[source]) <= 2 * largest + 1
    return taken, goal


def mixed(spark, docs):
    from pyspark.sql import functions as F

    result = mixing.mix(spark, mixing.sized(docs))
    return result.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")).collect()


def test_documents(spark):
    sf = "/root/testdata/sf0.01"
    given_rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = mixing.query(spark, sf).collect()
    taken, goal = check(rows, given_rows)
    assert len(rows) == len(given_rows) and sum(taken.values()) == pytest.approx(sum(goal.values()), rel=0.02)
    assert sorted(rows) == sorted(mixing.query(spark, sf).collect())


def test_odd_rows(spark):
    docs = documents(spark).filter("doc_id is not null").dropDuplicates(["doc_id"])
    kept = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    check(mixed(spark, docs), kept)
    assert len(mixed(spark, documents(spark))) == len(texts())
    assert mixed(spark, nothing(spark)) == []


def test_repeated_rows_have_all_columns(spark):
    docs = documents(spark)
    out = mixing.repeated(spark, docs)
    assert out.columns == docs.columns
    counts = {}
    for r in out.collect():
        counts[str(r)] = counts.get(str(r), 0) + 1
    assert max(counts.values()) <= 4  # a row that is there twice, each at most twice
    assert {r.doc_id for r in out.collect()} <= {i for i, _, _ in texts()}


def test_many_sources_are_ordered_in_runs(spark):
    """As many sources as documents: no window goes over all of them, and places and sums are those of one sorted list."""
    import random

    from pyspark.sql import functions as F

    from delayhouse.session import Stages

    rng = random.Random(6)
    sizes = {f"s{i:06d}": rng.choice([0, 1, 5, 1000]) for i in range(30_000)} | {None: 7}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(7)
    got = {r.source_key: r.target for r in mixing.targets(frame).collect()}
    want = {("n" if s is None else "s" + s): t for s, t in water_fill(sizes).items()}
    assert got == pytest.approx(want)
    with Stages(spark) as stages:
        placed = mixing._in_runs(stages, frame, [F.col("source").asc_nulls_last()], ["source_size"])
        rows = sorted(placed.collect(), key=lambda r: r.place)
        assert [r.place for r in rows] == list(range(len(sizes))) and rows[-1].source is None
        assert rows[-1].before_source_size == sum(sizes.values()) - 7
        text = placed._jdf.queryExecution().executedPlan().toString()
    over = [line for line in text.split("\n") if "Window [" in line]
    assert sum("[run#" not in line for line in over) <= 1  # over the runs' totals alone


@pytest.mark.parametrize("sizes", [{"a": 0, "b": 0}, {"a": 100}, {"a": 1, "b": 1000, None: 10}, {"x": 5, "y": 5, "z": 5, "zz": 5, None: 0}])
def test_targets_fill_like_water(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source_key: r.target for r in mixing.targets(frame).collect()}
    want = {("n" if s is None else "s" + s): t for s, t in water_fill(sizes).items()}
    assert got == pytest.approx(want)
