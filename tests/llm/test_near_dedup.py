import random

import numpy as np

from delayhouse.llm.components import connected
from delayhouse.llm import near_dedup
from delayhouse.llm.near_dedup import (
    LEAST_ESTIMATE, Shingles, _functions, deduplicated, estimates, may_reach, minima, near_duplicates, packed, parity, query,
)

from .messy import documents, nothing, texts


def shingles(text, width):
    words = (text or "").encode().lower().split()
    width = min(width, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else frozenset()


def brute_force(rows, width):
    """(identifier, set size, component) of each row, by all pairs and union-find."""
    sets = [shingles(t, width) for _, t in rows]
    above = list(range(len(rows)))

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            known = sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None
            if known and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                above[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(doc_id, len(s), least.get(root(i))) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))]


def check(result, rows, width=2):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in result]
    assert sorted(map(str, got)) == sorted(map(str, brute_force(rows, width)))
    assert all(r.kept == (r.doc_id == r.component_id) for r in result)


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    check(query(spark, sf).collect(), [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()])


def test_odd_rows(spark):
    for width in (2, 5):
        check(near_duplicates(spark, documents(spark), width).collect(), [(i, t) for i, t, _ in texts()], width)
    assert near_duplicates(spark, nothing(spark)).collect() == []


def test_a_large_group_of_edited_copies(spark, monkeypatch):
    """Copies edited so much that many pairs are below the threshold: connections through third documents must be found."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(5000)]
    origin = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(700):
        copy = list(origin)
        for _ in range(rng.choice([0, 2, 5, 8, 9, 10, 12, 20])):
            copy[rng.randrange(150)] = rng.choice(words)
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = []
    original = near_dedup._unresolved

    def counted(labelled, held, add):
        def kept(df, name):
            found = add(df, name)
            told.append((name, found.count()))
            return found

        links = original(labelled, held, kept)
        told.append(("links", links.count()))
        return links

    monkeypatch.setattr(near_dedup, "_unresolved", counted)
    for block in (256, 32):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        told.clear()
        check(near_duplicates(spark, docs, 2).collect(), rows)
        # Plausible pairs of so large a group are hundreds of thousands; what blocks hand on is rows and forests.
        assert dict(told)["links"] < 20 * len(rows) and dict(told)["near-involved"] > 0
    check(near_duplicates(spark, docs).collect(), rows, 5)


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = deduplicated(spark, docs, 2)
    assert kept.columns == docs.columns
    components = {c for _, _, c in brute_force([(i, t) for i, t, _ in texts()], 2) if c is not None}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted([*map(str, components), "None", "None"])


def test_sketches_estimate_and_bound():
    rng, functions = np.random.default_rng(4), _functions()
    errors = []
    for _ in range(300):
        both = rng.integers(0, 2**63, 400, np.uint64)
        a = np.unique(np.concatenate([both, rng.integers(0, 2**63, 50, np.uint64)]))
        b = np.unique(np.concatenate([both, rng.integers(0, 2**63, 50, np.uint64)]))
        signatures = packed(np.array([minima(a, functions), minima(b, functions)])).view(np.uint64)
        errors.append(estimates(signatures[:1], signatures[1:])[0] - 0.8)
        slots = [parity(x).view(np.uint64)[None] for x in (a, b)]
        assert may_reach(np.array([len(a) + len(b)]), *slots)[0]
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.045 and min(errors) > LEAST_ESTIMATE - 0.8


def test_words_are_split_and_lowered_as_the_contract_says():
    of = Shingles(2).of
    assert (of("A\x0bb\tC") == of("a B\rc")).all() and len(of("É x")) == 1
    assert of("É x")[0] != of("é x")[0] and len(of("a　b")) == 1 and len(of("a b")) == 1
    assert len(of("")) == 0 and len(of(" \n")) == 0


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(5000, 5000), (7001, 7000), (None, 3)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(40)} | {7000: 7000, 7001: 7000}
    assert got == expected
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def test_identifiers_with_several_texts(spark):
    rng = random.Random(8)
    first, second, third = (" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(80)) for _ in range(3))
    near = first + " end"
    rows = [(1, first), (1, None), (2, first), (2, second), (2, ""), (3, second), (4, third), (4, second), (1, third), (1, near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(near_duplicates(spark, docs, 2).collect(), rows)
    kept = sorted((r.doc_id, r.text or "") for r in deduplicated(spark, docs, 2).collect())
    assert [r for r in kept if not r[1]] == [(1, ""), (2, "")]
    left = [r for r in kept if r[1]]
    assert len(left) == 3 and {(1, third), (2, second)} < set(left) and left[0][0] == 1 and set(left) & {(1, first), (1, near)}
    again = spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(2)
    assert sorted((r.doc_id, r.text or "") for r in deduplicated(spark, again, 2).collect()) == kept


def test_texts_of_one_identifier_meet_only_themselves(spark):
    """An identifier with many texts: as many rows are read for their sets as there are texts, not their square."""
    rng = random.Random(9)
    base = [rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(60)]
    rows = [(1, " ".join([*base, f"end{i}"])) for i in range(60)] * 2
    check(near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 2).collect(), rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sketched = near_dedup.sketches(docs, 2)
    wanted = sketched.select("doc_id", "text_key", sketched["set_key"].alias("node")).distinct()
    assert near_dedup.contents(docs, wanted, 2).count() == 60


def test_words_remembered_are_bounded_by_their_bytes():
    found = Shingles(2)
    for i in range(6):
        found.of(f"{i}" + "x" * 2**20)
    assert sum(map(len, found.words)) <= near_dedup.REMEMBERED + 2**20 + 9
