import hashlib
import random

from delayhouse.llm import fingerprints as fp

from .messy import documents, nothing, texts


def expected(rows):
    """n_chars and digest of the edited text of each row, from the contract."""
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 3
        changed = text[: len(text) - cut] + following[:cut]
        yield doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), fp._written(fp.fingerprints([changed]))[0]


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    given_rows = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()), reverse=True)
    got = fp.query(spark, sf).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.edited_fingerprint) for r in got) == sorted(expected(given_rows))
    alone = {i: fp._written(fp.fingerprints([t]))[0] for i, t in given_rows}
    assert all(r.fingerprint == alone[r.doc_id] for r in got)
    assert sum(r.near_edited > r.near_next for r in got) >= 0.98 * len(got)
    assert sum(0.4 < r.near_edited for r in got) > 0.9 * len(got)


def test_odd_rows(spark):
    got = fp.fingerprint_documents(documents(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _, _ in texts())
    by_text = {}
    for r in got:
        by_text.setdefault((str(r.doc_id), r.n_chars), set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert len({r.fingerprint for r in got if r.doc_id in (11, 16, -3)}) == 1
    row = next(r for r in got if r.doc_id == 5)  # empty, followed by an empty one
    assert (row.n_chars, row.near_next, set(row.fingerprint)) == (0, 1.0, {"0"})
    unique = [i for i, _, _ in texts() if i is not None and i > 3]
    ordered = [(i, next(t or "" for j, t, _ in texts() if j == i)) for i in sorted(unique, reverse=True)]
    want = dict((i, (n, sha)) for i, n, sha, _ in expected(ordered) if i > min(unique))
    assert all((r.n_chars, r.edited_sha256) == want[r.doc_id] for r in got if r.doc_id in want)
    assert fp.fingerprint_documents(nothing(spark)).collect() == []


def test_one_document_follows_itself(spark):
    row = fp.fingerprint_documents(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and row.near_next == 1.0


def test_offsets_do_not_matter():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    other = "".join(rng.choice("abcdefgh ") for _ in range(4000))
    moved, strange, own = fp.fingerprints(["zz" * 7 + "q" + text, other, text])
    assert fp.likeness(own, moved) > 0.85 > 0.2 > fp.likeness(own, strange)
    assert fp.likeness(own, own) == 1


def test_parsing_together_equals_parsing_alone():
    some = [t or "" for _, t, _ in texts()] + ["a", "ab", "aaaa", "aaab" * 50, "\U0001f600" * 9]
    together = fp._written(fp.fingerprints(some))
    assert together == [fp._written(fp.fingerprints([t]))[0] for t in some]
