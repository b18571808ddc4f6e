import math
from collections import Counter

import pytest

from delayhouse.llm.lm_scoring import ADDED, INTERPOLATION, query, score_documents

from .messy import documents, nothing, texts


def brute_force(rows, targets):
    """Scores of (identifier, text) rows by the formulas, with dictionaries."""
    size = len({w for _, t in rows for w in (t or "").split()}) + 1

    def pairs(text):
        tokens = [0, *(text or "").split(), 0]
        return list(zip(tokens, tokens[1:]))

    def model(chosen):
        two = Counter(p for _, t in chosen for p in pairs(t))
        before, alone = Counter(), Counter()
        for (a, b), n in two.items():
            before[a] += n
            alone[b] += n
        total = sum(alone.values())

        def loss(a, b):
            word = (alone[b] + ADDED) / (total + ADDED * size)
            follows = two[a, b] / before[a] if before[a] else word
            return -math.log(INTERPOLATION * follows + (1 - INTERPOLATION) * word)

        return loss

    target, background = model([r for r in rows if r[0] in targets]), model(rows)
    for doc_id, text in rows:
        every = pairs(text)
        of_target, of_background = (sum(m(*p) for p in every) / len(every) for m in (target, background))
        yield str(doc_id), len(every) - 1, of_target, of_background, of_background - of_target


def same(got, expected):
    got = sorted((str(r.doc_id), r.n_tokens, r.target_loss, r.background_loss, r.score) for r in got)
    expected = sorted(expected)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], abs=1e-5)


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality == 1}
    same(query(spark, sf).collect(), brute_force(rows, good))


def test_odd_rows(spark):
    targets = spark.createDataFrame([(1,), (2,), (2,), (None,), (99,)], "doc_id long")
    rows = [(i, t) for i, t, _ in texts()]
    same(score_documents(spark, documents(spark), targets).collect(), brute_force(rows, {1, 2}))
    same(score_documents(spark, documents(spark), targets.limit(0)).collect(), brute_force(rows, set()))
    assert score_documents(spark, nothing(spark), targets).collect() == []


def test_rare_words_and_unspaced_texts_are_told_apart(spark):
    """More words than any fixed list, each rarer than the common ones, of one shape; and texts without white space."""
    rare = ["".join("abcdefghij"[int(d)] for d in f"{i:06d}") for i in range(4000)]
    rows = [(i, " ".join(["the"] * 3 + rare[i % 2000 : i % 2000 + 1] * 2)) for i in range(4000)]
    rows += [(5000, f"the {rare[3]} the"), (5001, f"the {rare[3999]} the"), (5002, "x" * 80 + "a"), (5003, "x" * 80 + "b")]
    rows += [(5004, "天地玄黃" * 30), (5005, "天地玄黃" * 20 + "宇宙洪荒" * 10)]
    targets = [*range(1000), 5002, 5004]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = score_documents(spark, docs, spark.createDataFrame([(i,) for i in targets], "doc_id long")).collect()
    spaced = [r for r in got if r.doc_id < 5004]
    loss = {r.doc_id: r.score for r in got}
    assert loss[5000] > loss[5001] and loss[5002] > loss[5003] and loss[5004] > loss[5005]
    split = [(i, " ".join(t) if i >= 5004 else t) for i, t in rows]
    same(spaced + [r for r in got if r.doc_id >= 5004], brute_force(split, set(targets)))


def test_counts_of_many_blocks_are_added_up(spark, monkeypatch):
    monkeypatch.setattr("delayhouse.llm.lm_scoring.BLOCK", 2000)
    rows = [(i, t) for i, t, _ in texts()]
    targets = spark.createDataFrame([(1,), (2,)], "doc_id long")
    same(score_documents(spark, documents(spark), targets).collect(), brute_force(rows, {1, 2}))
