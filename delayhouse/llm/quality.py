"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A document is a vector of term weights: its whole words, their shapes (runs of letters, digits and signs), the characters and character
trigrams of long words and of scripts written without spaces, over their whole length, and how often words and lines repeat. Terms are
hashed into ``TERMS`` places and weighted by inverse document frequency. The singular vectors of the labelled documents' term matrix span a space of ``DIMENSIONS``; every
document is projected into it, held against all labelled vectors by exact cosine products in blocks, and the labels of its
nearest neighbours are averaged, weighted by a power of their similarity.

The classifier is fitted on at most ``MOST_LABELLED`` labelled documents, those whose hashed identifiers are smallest; hence the
labelled vectors and the projection have a fixed bound and are broadcast. Every document is scored, from its whole text
and nothing else.

Defined cases: a null or empty text, or one without a known term, has no direction and gets the mean label; without any label
the score is 0.5; several labels of a document are averaged, null ones ignored; a null identifier is scored, belongs to no fold
(held_out false) and is never learnt from; repeated rows are scored each; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import operator
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UNSPACED, few_rows, table, texts

MOST_LABELLED = 4000
DIMENSIONS = 64
NEIGHBOURS = 15
POWER = 8
TERMS = 2**16
#: Words with more characters than this are taken apart into characters and trigrams, as are those of unspaced scripts.
LONG_WORD = 16
#: Words remembered by a task, and documents of a block of products.
REMEMBERED = 150_000
BLOCK = 512


# ---- terms -----------------------------------------------------------------------------------------------------------


def _term(name: str) -> int:
    from zlib import crc32

    return crc32(name.encode("utf-8", "surrogatepass")) % TERMS


#: Marks the code of a word that is taken apart.
_PIECES = TERMS * (TERMS + 1)


class WordTerms(dict):
    """The term of a word's shape, above it that of the word itself (0 if it is signs alone), above that whether to take it apart."""

    runs = [(re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), "a"), (re.compile("[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"\d+"), "0")]
    same = re.compile(r"(.)\1+")

    def __missing__(self, word: str) -> int:
        shape = word
        for run, letter in self.runs:
            shape = run.sub(letter, shape)
        shape = self.same.sub(r"\1", shape)
        core = word.strip(".,;:!?$%&*#|\"'()").lower()
        found = _term(f"shape {shape}")
        if core:
            found += TERMS * (_term(f"word {core}") + 1)
        if len(word) > LONG_WORD or not word.isascii() and UNSPACED.search(word):
            found += _PIECES
        if len(self) < REMEMBERED and len(word) <= 4 * LONG_WORD:
            self[word] = found
        return found


def pieces(word: str) -> np.ndarray:
    """Terms of all characters and character trigrams, the word's ends counting as a character."""
    points = np.frombuffer(f" {word.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    mixed = (points[:-2] * np.uint64(0x9E3779B1) + points[1:-1]) * np.uint64(0x85EBCA6B) + points[2:]
    mixed = np.concatenate([mixed, points[1:-1]]) + np.uint64(1)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return (mixed >> np.uint64(48)).astype(np.int64) % TERMS


def term_weights(text: str, words: WordTerms) -> tuple[np.ndarray, np.ndarray]:
    """Terms of a text in ascending order, and their weights."""
    every = text.split()
    if not every:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    n = len(every)
    codes = np.fromiter(map(words.__getitem__, every), np.int64, n)
    long = np.flatnonzero(codes >= _PIECES)
    codes %= _PIECES
    whole = codes // TERMS
    terms, counts = np.unique(np.concatenate([codes % TERMS, whole[whole > 0] - 1]), return_counts=True)
    weights = np.sqrt(counts / n)
    if len(long):
        parts, counts = np.unique(np.concatenate([pieces(every[i]) for i in long]), return_counts=True)
        terms, weights = np.concatenate([terms, parts]), np.concatenate([weights, np.sqrt(counts / len(text))])
    lines = [line for line in text.split("\n") if line.strip()]
    again = sum(map(operator.eq, every, every[1:])) / n
    eighths = lambda share: int(share * 8)
    names = [
        f"distinct words {eighths(len(set(every)) / n)}", f"distinct lines {eighths(len(set(lines)) / max(1, len(lines)))}",
        f"repeated words {min(8, int(again * 32))}", f"words {n.bit_length()}",
    ]
    terms, weights = np.concatenate([terms, list(map(_term, names))]), np.concatenate([weights, [0.5, 0.5, 0.5, 0.3]])
    terms, at = np.unique(terms, return_inverse=True)
    return terms, np.bincount(at, weights).astype(np.float32)


# ---- the model -------------------------------------------------------------------------------------------------------


class Model(NamedTuple):
    """What is broadcast: at most (TERMS + MOST_LABELLED) x DIMENSIONS numbers."""

    projection: np.ndarray  # terms x dimensions, inverse document frequencies included
    labelled: np.ndarray  # unit vectors
    labels: np.ndarray
    mean: float

    def projected(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        vectors = np.array([weights @ self.projection[terms] for terms, weights in rows], np.float32)
        vectors = vectors.reshape(len(rows), self.projection.shape[1])
        return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        found = np.full(len(rows), self.mean)
        k = min(NEIGHBOURS, len(self.labels))
        if not k:
            return found
        for start in range(0, len(rows), BLOCK):
            cosine = self.projected(rows[start : start + BLOCK]) @ self.labelled.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, 1).astype(float), 0) ** POWER
            total = weight.sum(1)
            some = np.flatnonzero(total > 1e-9)
            found[start + some] = (weight * self.labels[near]).sum(1)[some] / total[some]
        return np.round(np.clip(found, 0, 1), 6)


class Sparse:
    """A matrix of few entries that are sorted by row; products go through them in pieces."""

    PIECE = 25_000

    def __init__(self, row: np.ndarray, column: np.ndarray, value: np.ndarray, rows: int):
        self.row, self.column, self.value, self.rows = row, column, value, rows

    def __matmul__(self, other: np.ndarray) -> np.ndarray:
        out = np.zeros((self.rows, other.shape[1]), np.float32)
        for i in range(0, len(self.row), self.PIECE):
            row = self.row[i : i + self.PIECE]
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            each = other[self.column[i : i + self.PIECE]] * self.value[i : i + self.PIECE, None]
            out[row[starts]] += np.add.reduceat(each, starts)
        return out

    def turned(self, columns: int) -> Sparse:
        order = np.argsort(self.column, kind="stable")
        return Sparse(self.column[order], self.row[order], self.value[order], columns)


def fitted(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> Model:
    """The leading right singular vectors of the weighted term matrix, by subspace iteration, and the projected rows."""
    if not rows:
        return Model(np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, 0.5)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(terms) for terms, _ in rows])
    column, value = (np.concatenate([r[i] for r in rows]) for i in (0, 1))
    present = np.bincount(column, minlength=TERMS)
    rarity = np.where(present >= min(2, len(rows)), np.log(1 + len(rows) / np.maximum(present, 1)), 0).astype(np.float32)
    value = value * rarity[column]
    norms = np.sqrt(np.bincount(row, value.astype(float) ** 2, len(rows)))
    value = (value / np.maximum(norms, 1e-9)[row]).astype(np.float32)
    # Only terms that have weight are columns of the matrix.
    used, column = np.unique(column[value > 0], return_inverse=True)
    if not len(used):
        return Model(np.zeros((TERMS, 1), np.float32), np.zeros((len(rows), 1), np.float32), labels, labels.mean())
    matrix = Sparse(row[value > 0], column.astype(np.int32), value[value > 0], len(rows))
    del row, column, value
    turned = matrix.turned(len(used))
    wanted = min(DIMENSIONS, len(rows), TERMS)
    space = np.random.default_rng(7).standard_normal((TERMS, min(wanted + 16, len(rows), TERMS)), np.float32)[used]
    for _ in range(5):
        space = np.linalg.qr(turned @ (matrix @ space))[0].astype(np.float32)
    _, _, rotated = np.linalg.svd(matrix @ space, full_matrices=False)
    projection = np.zeros((TERMS, wanted), np.float32)
    directions = (space @ rotated.T)[:, :wanted]
    projection[used, : directions.shape[1]] = rarity[used, None] * directions
    model = Model(projection, np.zeros((0, wanted), np.float32), labels, labels.mean())
    return model._replace(labelled=model.projected(rows))


def fold(doc_id: Column) -> Column:
    """0, 1 or 2 by the identifier's text; 1 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """The model of at most ``most`` labelled documents outside the held-out fold."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 1))
    chosen = (
        usable.groupBy("doc_id").agg(F.avg("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    # A bounded side, and one text per identifier, so that what is collected is bounded too.
    sample = texts(docs).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])

    def read(batches):
        words = WordTerms()
        for batch in few_rows(batches):
            rows = [term_weights(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.string()), batch.column("quality").cast(pa.float64()),
                pa.array([t.astype(np.uint16).tobytes() for t, _ in rows], pa.binary()),
                pa.array([w.astype(np.float32).tobytes() for _, w in rows], pa.binary()),
            ], ["doc_id", "quality", "terms", "weights"])

    # Packed: as lists of numbers the sample would take the driver some hundred megabytes.
    found = sample.mapInArrow(read, "doc_id string, quality double, terms binary, weights binary").collect()
    found.sort(key=lambda r: r["doc_id"])
    rows = [(np.frombuffer(r["terms"], np.uint16), np.frombuffer(r["weights"], np.float32)) for r in found]
    return fitted(rows, np.array([r["quality"] for r in found], float))


def _scorer(spark: SparkSession, model: Model):
    parts = spark.sparkContext.broadcast(tuple(model))

    def score(batch: pa.RecordBatch, words: WordTerms) -> np.ndarray:
        rows = [term_weights(t or "", words) for t in batch.column("text").to_pylist()]
        return Model(*parts.value).scores(rows)

    return score


def classify(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    identifier = docs.schema["doc_id"].dataType.simpleString()
    score = _scorer(spark, model)

    def scored(batches):
        words = WordTerms()
        for batch in few_rows(batches):
            found = score(batch, words)
            columns = [batch.column("doc_id"), pa.array(found, pa.float64()), pa.array(found >= 0.5).cast(pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "predicted"])

    result = texts(docs).mapInArrow(scored, f"doc_id {identifier}, score double, predicted int")
    return result.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score", "predicted")


def accepted(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """The rows that are predicted good, with all their columns."""
    score = _scorer(spark, model)

    def kept(batches):
        words = WordTerms()
        for batch in few_rows(batches):
            yield batch.filter(pa.array(score(batch, words) >= 0.5))

    return docs.mapInArrow(kept, docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    return classify(spark, docs, fit(spark, docs, table(spark, sf_dir, "labels")))
