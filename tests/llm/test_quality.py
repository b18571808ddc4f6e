import zlib

import numpy as np

from delayhouse.llm import quality

from .messy import documents, nothing, texts

SF = "/root/testdata/sf0.01"


def test_held_out_labels_are_met(spark):
    rows = {r.doc_id: r for r in quality.query(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    held = [(rows[i].predicted, q) for i, q in labels.items() if rows[i].held_out]
    assert len(held) > 80 and np.mean([p == q for p, q in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - quality, quality) as quality", "toxic")
    for a, b in zip(quality.fit(spark, docs, labels), quality.fit(spark, docs, turned)):
        assert np.array_equal(a, b)


def test_odd_rows_and_labels(spark):
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 0), (3, None), (None, 1), (10, 1), (9, 0), (13, 0), (999, 1)], "doc_id long, quality int"
    )
    docs = documents(spark)
    model = quality.fit(spark, docs, labels)
    got = quality.classify(spark, docs, model).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _, _ in texts())
    empty = {r.score for r in got if r.doc_id in (4, 5, 6)}
    assert empty == {round(float(model.mean), 6)}
    assert len({r.score for r in got if r.doc_id == 2}) == 1
    kept = quality.accepted(spark, docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.predicted)


def test_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(spark, documents(spark), labels)
    assert {r.score for r in quality.classify(spark, documents(spark), model).collect()} == {0.5}
    assert quality.classify(spark, nothing(spark), quality.fit(spark, nothing(spark), labels)).collect() == []


def test_neighbours_vote_as_by_brute_force(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(spark, docs, labels)
    words = quality.WordTerms()
    rows = [quality.term_weights(r.text, words) for r in docs.limit(60).collect()]
    vectors = model.projected(rows)
    for vector, score in zip(vectors, model.scores(rows)):
        near = sorted(zip((model.labelled @ vector).tolist(), model.labels), reverse=True)[: quality.NEIGHBOURS]
        weights = [max(s, 0) ** quality.POWER for s, _ in near]
        assert abs(sum(w * q for w, (_, q) in zip(weights, near)) / sum(weights) - score) < 1e-3


def test_the_sample_is_bounded(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    assert len(quality.fit(spark, docs, labels, most=50).labels) == 50


def judged(spark, good, bad):
    """Share of right predictions for held-out texts, made by calling good() or bad()."""
    docs = [(i, (good if i % 2 else bad)()) for i in range(240)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(240)], "doc_id long, quality int")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    rows = quality.classify(spark, table, quality.fit(spark, table, labels)).collect()
    held = [r.predicted == r.doc_id % 2 for r in rows if r.held_out]
    assert len(held) > 40
    return np.mean(held)


def test_words_of_one_shape_are_told_apart(spark):
    rng = np.random.default_rng(1)
    words = ["".join(w) for w in rng.choice(list("abcdefghij"), (200, 7))]
    assert judged(spark, lambda: " ".join(rng.choice(words[:120], 60)), lambda: " ".join(rng.choice(words[80:], 60))) > 0.9


def test_unspaced_texts_are_read_whole(spark):
    rng = np.random.default_rng(2)
    start = "".join(rng.choice(list("abcdefgh"), 100))
    han = [chr(0x4E00 + i) for i in range(60)]
    blob = lambda letters: lambda: start + "".join(rng.choice(list(letters), 400))
    assert judged(spark, blob("klmnop"), blob("pqrstu")) > 0.9
    text = lambda chars: lambda: "".join(rng.choice(han, 80)) + "".join(rng.choice(chars, 200))
    assert judged(spark, text(han[:35]), text(han[25:])) > 0.9
