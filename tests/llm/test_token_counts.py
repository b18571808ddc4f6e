import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from delayhouse.llm.token_counts import PieceCounts, count_tokens, query

from .messy import documents, nothing, texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
COUNTS = PieceCounts(MODEL)


def test_every_document_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    given_texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = query(spark, sf).collect()
    assert len(got) == len(given_texts)
    for row in got:
        text = given_texts[row.doc_id]
        n = len(LIBRARY.encode(text))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), n, n > 4096)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab Th▁.,\n\t(){}='eé漢\U0001f600 10"), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_any_text_equals_the_library(text):
    assert COUNTS.tokens(text) == len(LIBRARY.encode(text))


def test_odd_rows(spark):
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in count_tokens(documents(spark), MODEL).collect())
    assert got == sorted((str(i), len((t or "").encode()), len(LIBRARY.encode(t or ""))) for i, t, _ in texts())
    assert count_tokens(nothing(spark), MODEL).collect() == []


def test_a_long_word_is_merged_in_few_steps():
    assert COUNTS.tokens("ab" * 50_000) == len(LIBRARY.encode("ab" * 50_000))
