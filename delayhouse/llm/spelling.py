"""Spelling variants by generation over a reduced alphabet.

Words are counted over all texts. Each letter of the vocabulary is hashed to one of a few symbols, so that many words share a
reduced word. For every distinct reduced word all words within one edit of it are generated, as 64-bit codes, and joined to the
reduced vocabulary: two words within one edit of each other have reduced words within one edit, so no pair is missed. What
meets is verified on the original strings. Fewer symbols mean less to generate and more to verify; their number grows
slowly with the vocabulary (``symbols_for``), and letters are dealt to them by frequency, so that no symbol takes most.

A word's form is the nearest spelling that is far more frequent, its root the end of the chain of forms; chains are followed by
doubling, and end because the count at least doubles at each step.

Defined cases: null and empty texts have no words; a null identifier counts as an empty string; repeated rows count each; a
run is counted whole, however long; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Stages, staged
from .common import table

SHORTEST, LEAST = 5, 3
#: One of so many occurrences loses a code point, and how much more frequent a form must be.
EDITED = 97
RATIO = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-z\\u00C0-\\u00FF]"
#: Base of the codes of reduced words, and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)


# ---- words -----------------------------------------------------------------------------------------------------------


def edited(run: Column, doc_id: Column) -> Column:
    """The run, without one of its code points if the checksum of identifier and run says so."""
    checksum = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    place = (checksum % F.length(run)).cast("int")
    without = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(checksum % EDITED == 0, without).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n of all words that are long and frequent enough."""
    # A shorter run cannot become a long enough word.
    runs = F.regexp_extract_all(F.col("text"), F.lit(f"{RUN}{{{SHORTEST},}}"), F.lit(0))
    found = docs.select(F.col("doc_id").alias("doc_id"), F.explode(runs).alias("run"))
    word = edited(F.translate("run", UPPER, LOWER), F.col("doc_id"))
    counted = found.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("n") >= LEAST) & (F.length("word") >= SHORTEST))


# ---- reduced words ---------------------------------------------------------------------------------------------------


def symbols_for(words: int) -> int:
    """As many as make the words of nine letters outnumber the vocabulary, but at least four."""
    k = 4
    while k**9 < words:
        k += 1
    return k


def dealt(letters: list[tuple[str, int]], symbols: int) -> dict[str, int]:
    """A symbol (from 1) for each letter: the most frequent first, always to the symbol that has the least so far."""
    load, found = [0] * symbols, {}
    for letter, n in sorted(letters, key=lambda x: (-x[1], x[0])):
        least = load.index(min(load))
        found[letter] = least + 1
        load[least] += n
    return found


def codes(reduced: np.ndarray) -> np.ndarray:
    """A code for each row of symbols; rows of other lengths have other codes, but for chance."""
    with np.errstate(over="ignore"):
        return (reduced * _powers(reduced.shape[1])).sum(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.r_[np.uint64(1), np.full(n, BASE, np.uint64)], dtype=np.uint64)[:n]


def neighbourhood(reduced: np.ndarray, symbols: int) -> np.ndarray:
    """Codes of everything within one edit of each row of symbols, itself included; some more than once."""
    m, length = reduced.shape
    power = _powers(length + 1)
    every = np.arange(1, symbols + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        each = reduced * power[:length]
        before = np.concatenate([np.zeros((m, 1), np.uint64), np.cumsum(each, 1, dtype=np.uint64)], 1)
        whole = before[:, -1:]
        after = whole - before  # from each place on
        deleted = before[:, :-1] + after[:, 1:] * np.uint64(INVERSE)
        steps = every[None, None, :] * power[None, :, None]
        replaced = (whole - each)[:, :, None] + steps[:, :length]
        inserted = (before + after * np.uint64(BASE))[:, :, None] + steps
    return np.concatenate([deleted, replaced.reshape(m, -1), inserted.reshape(m, -1)], 1)


def _by_length(words: pa.Array, symbol: dict[str, int]):
    """(places, matrix of symbols) of the words of each length."""
    every = words.to_pylist()
    lengths = np.array([len(w) for w in every], np.int64)
    table_ = np.zeros(256, np.uint64)
    for letter, s in symbol.items():
        table_[ord(letter)] = s
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        points = np.frombuffer("".join([every[i] for i in at]).encode("latin-1"), np.uint8)
        yield at, table_[points].reshape(len(at), length)


def coded(words: DataFrame, symbol: dict[str, int]) -> DataFrame:
    """The rows (word, n) with the code of the reduced word."""

    def add(batches):
        for batch in batches:
            found = np.zeros(batch.num_rows, np.uint64)
            for at, reduced in _by_length(batch.column("word"), symbol):
                found[at] = codes(reduced)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], [*batch.schema.names, "code"])

    return words.select("word", "n").mapInArrow(add, "word string, n long, code long")


def generated(words: DataFrame, symbol: dict[str, int], symbols: int) -> DataFrame:
    """(code, near): for each word the codes within one edit of its own."""

    def generate(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                piece = batch.slice(start, 2048)
                for _, reduced in _by_length(piece.column("word"), symbol):
                    step = max(1, 2**21 // (reduced.shape[1] * symbols))
                    for low in range(0, len(reduced), step):
                        part = reduced[low : low + step]
                        near = np.sort(neighbourhood(part, symbols), 1)
                        new = np.ones(near.shape, bool)
                        new[:, 1:] = near[:, 1:] != near[:, :-1]
                        own = np.repeat(codes(part), new.sum(1))
                        columns = [pa.array(x.view(np.int64)) for x in (own, near[new])]
                        yield pa.RecordBatch.from_arrays(columns, ["code", "near"])

    return words.select("word").mapInArrow(generate, "code long, near long")


# ---- the operator ----------------------------------------------------------------------------------------------------


def near_words(stages: Stages, words: DataFrame) -> DataFrame:
    """word, n_near and best (its near word of largest n, as (-n, word)) of all words that have a near one."""
    size = words.count()
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").agg(F.count(F.lit(1)).alias("n"))
    symbols = symbols_for(size)
    symbol = dealt([(r["letter"], r["n"]) for r in letters.collect() if r["letter"]], symbols)
    held = stages.add(coded(words, symbol), "spelling-coded")
    one_each = held.groupBy("code").agg(F.min("word").alias("word"))
    reached = generated(one_each, symbol, symbols)
    other = held.select(F.col("code").alias("near"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    # The planner takes what is generated to be as small as the words it comes from, and written words to be as small as their
    # compressed files; neither may be sent to the driver on that account.
    met = reached.hint("merge").join(other.hint("merge"), "near").drop("near").join(held.hint("merge"), "code")
    found = met.filter(F.levenshtein("word", "other", 1) == 1)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best"))


def roots(stages: Stages, links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each chain of forms."""
    now = stages.add(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(further.hint("merge"), "root", "left")
        now = stages.add(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if now.filter("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def variants(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of the vocabulary of ``docs``."""
    with Stages(spark) as stages:
        words = stages.add(vocabulary(docs), "spelling-words")
        near = near_words(stages, words)
        form = lambda c: F.when(-F.col("best.n") >= RATIO * F.col("n"), c)
        judged = words.join(near.hint("merge"), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            form(F.col("best.word")).alias("form"), form(-F.col("best.n")).alias("form_n"),
        )
        judged = stages.add(judged, "spelling-judged")
        ends = roots(stages, judged.filter("form is not null"))
        result = judged.join(ends.hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))
        return staged(result.select("word", "form", "root", "n", "n_near", "form_n"), "spelling")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return variants(spark, table(spark, sf_dir, "documents"))
