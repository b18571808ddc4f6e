"""Spelling variants against brute force."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from delayhouse.llm import spelling as s

from . import messy

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    form, nears = {}, {}
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        nears[w] = len(others)
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
    found = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        found.append((w, form.get(w), root, n, nears[w], words[form[w]] if w in form else None))
    return sorted(found, key=repr)


def prose(seed, words, size):
    rng = random.Random(seed)
    known = ["".join(rng.choice("abehintéÿ") for _ in range(rng.randint(5, 9))) for _ in range(words)]
    known += ["".join(rng.choice("ab") for _ in range(rng.randint(5, 8))) for _ in range(words)]
    weights = [1 / (1 + rng.random() * 50) for _ in known]

    def text():
        found = []
        for w in rng.choices(known, weights, k=size):
            if rng.random() < 0.1:
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + "A" + w[i + 1 :]])
            found.append(w.title() if rng.random() < 0.1 else w)
        return rng.choice([" ", ", ", "-", "3"]).join(found)

    return [(i, text()) for i in range(40)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = prose(seed, 120, 300)
    want = brute(rows)
    assert sum(r[1] is not None for r in want) > 50 and any(r[2] != (r[1] or r[0]) for r in want)  # chains of several forms
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = s.variants(spark, docs)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in messy.rows()]
    docs = messy.documents(spark).withColumnRenamed("piece", "word").withColumnRenamed("length", "n")
    assert sorted(map(tuple, s.variants(spark, docs).collect()), key=repr) == brute(rows)
    assert s.variants(spark, messy.nothing(spark)).count() == 0


def test_neighbourhoods_hold_every_edit():
    rng = random.Random(4)
    for length in (1, 2, 5, 9, 24):
        word = [rng.randint(1, 4) for _ in range(length)]
        edits = [word] + [word[:i] + word[i + 1 :] for i in range(length)]
        edits += [word[:i] + [c] + word[i + 1 :] for i in range(length) for c in range(1, 5)]
        edits += [word[:i] + [c] + word[i:] for i in range(length + 1) for c in range(1, 5)]
        want = {int(s.codes(np.array([e], np.uint64).reshape(1, -1))[0]) for e in edits}
        assert set(s.neighbourhood(np.array([word], np.uint64), 4)[0].tolist()) == want


def test_symbols_share_the_letters():
    assert [s.symbols_for(n) for n in (0, 4**9, 4**9 + 1, 10**9)] == [4, 4, 5, 10]
    found = s.dealt([("e", 50), ("a", 30), ("i", 25), ("o", 10)], 2)
    assert found == {"e": 1, "a": 2, "i": 2, "o": 1}


def test_no_join_is_sent_through_the_driver(spark, monkeypatch):
    """The planner takes generated codes to be as small as the words they come from; they are many times as many."""
    plans = []
    add, last = s.Stages.add, s.staged
    text = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(s.Stages, "add", lambda self, df, name, **o: text(df) or add(self, df, name, **o))
    monkeypatch.setattr(s, "staged", lambda df, name: text(df) or last(df, name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        assert s.variants(spark, spark.createDataFrame(prose(1, 120, 300), "doc_id long, text string")).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum("Join" in p for p in plans) >= 3
    assert not any("Broadcast" in p for p in plans)
