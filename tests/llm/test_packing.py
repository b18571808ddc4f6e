import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from delayhouse.llm.packing import Identifiers, best_fit, pack_documents, plan, query

from .messy import documents, nothing, texts

LIBRARY = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
IDENTIFIERS = Identifiers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [2]


def expected_pieces(documents_):
    """doc_id, piece, start, length, checksum of each piece, straight from the contract."""
    for doc_id, text in documents_:
        ids = ids_of(text)
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield doc_id, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())


def check(rows, documents_):
    got = Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert got == Counter(expected_pieces(documents_))
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    return len(sequences), sum(r.length for r in rows)


def test_documents(spark):
    sf = "/root/testdata/sf0.001"
    given_rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    used, tokens = check(query(spark, sf).collect(), given_rows)
    assert used <= -(-tokens // 1024) + 4


def test_odd_rows(spark):
    check(pack_documents(spark, documents(spark)).collect(), [(i, t) for i, t, _ in texts()])
    assert pack_documents(spark, nothing(spark)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab \x1c\x85\xa0　​.,\n\t'sllve12é"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_identifiers_equal_the_library(text):
    assert IDENTIFIERS.of(text).tolist() == ids_of(text)[:-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_a_plan_places_everything_once(lengths):
    counts = np.bincount(np.array(lengths, int), minlength=65)
    for made in (plan(counts), best_fit(counts)):
        placed = Counter()
        for pattern, n in made:
            assert sum(pattern) <= 64 and n > 0
            for length in pattern:
                placed[length] += n
        assert placed == Counter(lengths)


def test_patterns_fill_sequences():
    rng = np.random.default_rng(3)
    lengths = np.minimum(rng.lognormal(5.5, 0.9, 20_000).astype(int) + 1, 1023)
    counts = np.bincount(lengths, minlength=1025)
    assert sum(n for _, n in plan(counts)) <= 1.002 * lengths.sum() / 1024 + 1
