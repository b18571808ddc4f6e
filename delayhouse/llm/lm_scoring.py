"""Cross-entropy difference between a target and a background language model.

Both models are word bigrams, interpolated with smoothed word frequencies, of the same order, smoothing and vocabulary, so
they differ in their counts only: the background's come from all documents, the target's from those marked as target.
The vocabulary is every word of all documents, whole and of any length; a character of a script that is written without spaces
is a word of its own. A document's losses are mean negative log probabilities per token, its end counting as a token; its score
is background less target loss, higher the more it resembles the target.

Documents are gathered into blocks of ``BLOCK`` characters, written once as word numbers. A block's distinct words and bigrams
(grams), counted within it, are shuffled by hash into buckets, where the counts of all blocks are added up; a gram that other
blocks have too is answered to each of them, any other count is known to be the block's own. So what is shuffled grows
with the corpus, a frequent gram comes once from a block, and a task holds a bucket or a block at a time.

Grams are told apart by 64-bit hashes. Word pieces are not made: a long run without spaces in a script that has them is one word.

Defined cases: a null or empty text is its end alone; without any target document the target model is the smoothing alone; null
identifiers are scored and are no target; repeated rows count and are scored each; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Stages, staged
from .common import UNSPACED, few_rows, table, texts

#: Weight of the bigrams against the words, and what is added to every word's count.
INTERPOLATION = 0.7
ADDED = 0.5
#: Characters of a block, characters of the corpus for each bucket, and the fewest buckets.
BLOCK = 8_000_000
BUCKET = 2**25
LEAST_BUCKETS = 2048
#: Most partitions that blocks are dealt to when they are scored.
PARTITIONS = 20_000
#: Rows are megabytes wide, so Parquet has to look at their size after each, and to cut row groups early.
WIDE_ROWS = {"parquet.block.size": 16 * 2**20, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1}

def words_of(text: str) -> list[str]:
    """Words at white space, characters of unspaced scripts one by one."""
    return (text if text.isascii() else UNSPACED.sub(r" \g<0> ", text)).split()


class Numbers(dict):
    """Words of a block by first appearance; 0 is a text's boundary."""

    def __init__(self):
        super().__init__({"": 0})

    def __missing__(self, word: str) -> int:
        found = self[word] = len(self)
        return found

    def of(self, text: str) -> np.ndarray:
        words = words_of(text)
        numbers = np.zeros(len(words) + 2, np.int32)
        numbers[1:-1] = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        return numbers


def _bytes(x: np.ndarray) -> bytes:
    """By place of the byte, which compresses better."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes() if len(x) else b""


def _numbers(raw: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


# ---- blocks ----------------------------------------------------------------------------------------------------------

_BLOCK = "block string, hashes binary, tokens binary, lengths binary, targets binary"


def blocks(marked: DataFrame) -> DataFrame:
    """Blocks of rows (doc_id, text, target); a document is never cut."""
    identifier = marked.schema["doc_id"].dataType.simpleString()

    def gathered(batches):
        import uuid

        from xxhash import xxh3_64_intdigest

        words, tokens, targets, ids, size = Numbers(), [], [], [], 0

        def told():
            hashes = np.fromiter((xxh3_64_intdigest(w.encode()) for w in words), np.uint64, len(words))
            lengths = np.array([len(t) for t in tokens], np.int64)
            row = [_bytes(x) for x in (hashes, np.concatenate(tokens), lengths, np.array(targets, np.uint8))]
            columns = [pa.array([uuid.uuid4().hex]), *(pa.array([x], pa.binary()) for x in row)]
            every = pa.concat_arrays(ids)
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every))
            sums = [pa.array([n], pa.int64()) for n in ((lengths - 1)[np.array(targets, bool)].sum(), (lengths - 1).sum(), size)]
            names = ["block", "hashes", "tokens", "lengths", "targets", "doc_ids", "n_target", "n_background", "n_chars"]
            return pa.RecordBatch.from_arrays(columns + sums, names)

        for batch in few_rows(batches, 8):
            for text, target in zip(batch.column("text").to_pylist(), batch.column("target").to_pylist(), strict=True):
                tokens.append(words.of(text))
                targets.append(target)
                size += len(text)
            # A copy, as the column would keep its whole batch of texts.
            ids.append(batch.column("doc_id").take(pa.array(range(batch.num_rows))))
            if size >= BLOCK:
                yield told()
                words, tokens, targets, ids, size = Numbers(), [], [], [], 0
        if tokens:
            yield told()

    return marked.mapInArrow(gathered, f"{_BLOCK}, doc_ids array<{identifier}>, n_target long, n_background long, n_chars long")


class Grams:
    """Words and bigrams of a block in order of their keys; keys of words are odd."""

    def __init__(self, hashes: bytes, tokens: bytes, lengths: bytes, targets: bytes):
        hashes, tokens, self.lengths = _numbers(hashes, np.uint64), _numbers(tokens, np.int32), _numbers(lengths, np.int64)
        inside = np.ones(len(tokens), bool)
        inside[np.cumsum(self.lengths) - 1] = False
        pairs = tokens[:-1].astype(np.int64) << 32
        pairs |= tokens[1:]
        pairs = pairs[inside[:-1]]
        del tokens, inside
        codes, cells = np.unique(pairs, return_inverse=True)
        self.cells = cells.astype(np.int32)
        del pairs, cells
        self.first, self.second = (codes >> 32).astype(np.int32), (codes & 0xFFFFFFFF).astype(np.int32)
        of_target = np.repeat(np.frombuffer(targets, np.uint8).astype(bool), self.lengths - 1)
        self.words = len(hashes)
        n = len(codes)
        del codes
        pairs = [np.bincount(c, minlength=n) for c in (self.cells[of_target], self.cells)]
        alone = [np.bincount(self.second, p, self.words).astype(np.int64) for p in pairs]
        turned = hashes[self.second]
        turned = (turned << np.uint64(1)) | (turned >> np.uint64(63))
        pair_keys = _mixed(_mixed(hashes[self.first]) + turned) & ~np.uint64(1)
        keys = np.concatenate([_mixed(hashes) | np.uint64(1), pair_keys])
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        #: Of the target and the background.
        self.counts = np.array([np.concatenate([a, p])[self.order] for a, p in zip(alone, pairs)])

    def buckets(self, bits: int):
        """(bucket, start, end) of the keys' leading bits."""
        bucket = (self.keys >> np.uint64(64 - bits)).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
        return [(int(bucket[low]), low, high) for low, high in zip(cuts, cuts[1:])]

    def losses(self, model: int, total: int, size: int) -> np.ndarray:
        """Mean loss of each document by the counts of all blocks."""
        counts = np.empty(len(self.order))
        counts[self.order] = self.counts[model]
        alone, pairs = counts[: self.words], counts[self.words :]
        word = (alone[self.second] + ADDED) / (total + ADDED * size)
        after = alone[self.first]
        follows = np.divide(pairs, after, out=word.copy(), where=after > 0)
        del counts, alone, pairs, after
        follows *= INTERPOLATION
        follows += (1 - INTERPOLATION) * word
        each = -np.log(follows)[self.cells]
        n = self.lengths - 1
        return np.add.reduceat(each, np.cumsum(n) - n) / n


# ---- counts of all blocks --------------------------------------------------------------------------------------------


def _asked(bits: int):
    """Each block's counts, a row per bucket."""

    def asked(batches):
        for batch in few_rows(batches, 1):
            row = batch.to_pylist()[0]
            block = row.pop("block")
            grams = Grams(**row)
            parts = grams.buckets(bits)
            columns = [pa.array([b for b, _, _ in parts], pa.int32()), pa.array([block] * len(parts))]
            keys = [_bytes(np.diff(grams.keys[i:j], prepend=np.uint64(0))) for _, i, j in parts]
            columns += [pa.array(keys, pa.binary())]
            columns += [pa.array([_bytes(n[i:j]) for _, i, j in parts], pa.binary()) for n in grams.counts]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "keys", "target", "background"])

    return asked


def _by(batches, column: str):
    """Lists of rows that follow each other and agree in ``column``."""
    rows = []
    for batch in few_rows(batches):
        for row in batch.to_pylist():
            if rows and rows[0][column] != row[column]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _added(batches):
    """For each block and bucket the counts that other blocks add to; and a row per bucket with its number of words."""
    names = ["block", "bucket", "places", "target", "background", "words"]
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    for rows in _by(batches, "bucket"):
        bucket = rows[0]["bucket"]
        parts = [np.cumsum(_numbers(r["keys"], np.uint64), dtype=np.uint64) for r in rows]
        ends = np.cumsum([len(p) for p in parts])
        keys, at = np.unique(np.concatenate(parts), return_inverse=True)
        own = np.array([np.concatenate([_numbers(r[c], np.int64) for r in rows]) for c in ("target", "background")])
        every = np.array([np.bincount(at, n, len(keys)).astype(np.int64)[at] for n in own])
        found = [(None, bucket, None, None, None, int((keys & np.uint64(1)).sum()))]
        for row, part, end in zip(rows, parts, ends):
            low = end - len(part)
            places = np.flatnonzero(every[1, low:end] != own[1, low:end])
            if len(places):
                told = (_bytes(x) for x in (places.astype(np.int32), *every[:, low:end][:, places]))
                found.append((row["block"], bucket, *told, None))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)


def _scored(bits: int, totals: tuple[int, int], size: int):
    """Documents of each block, from its own row followed by the answers to it."""
    names = ["doc_id", "n_tokens", "target_loss", "background_loss", "score"]

    def told(block: pa.RecordBatch, grams: Grams) -> pa.RecordBatch:
        target, background = (grams.losses(i, totals[i], size) for i in (0, 1))
        found = [pa.array(x) for x in (grams.lengths - 2, target, background, background - target)]
        return pa.RecordBatch.from_arrays([block.column("doc_ids").flatten(), *found], names)

    def scored(batches):
        block = grams = None
        for batch in few_rows(batches, 64):
            own = np.asarray(batch.column("bucket")) < 0
            answers = batch.select(["bucket", "places", "target", "background"]).to_pylist()
            for i, row in enumerate(answers):
                if own[i]:
                    if block is not None:
                        yield told(block, grams)
                    block = batch.slice(i, 1)
                    grams = Grams(*(block.column(c)[0].as_py() for c in ("hashes", "tokens", "lengths", "targets")))
                    starts = {bucket: low for bucket, low, _ in grams.buckets(bits)}
                    continue
                places = starts[row["bucket"]] + _numbers(row["places"], np.int32)
                for model, column in enumerate(("target", "background")):
                    grams.counts[model, places] = _numbers(row[column], np.int64)
        if block is not None:
            yield told(block, grams)

    return scored


def score_documents(spark: SparkSession, docs: DataFrame, targets: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and score; ``targets`` holds the identifiers of the target documents."""
    identifier = docs.schema["doc_id"].dataType.simpleString()
    # The targets grow with the corpus, so they are never broadcast: the plan is the same at every size.
    chosen = targets.select("doc_id").filter("doc_id is not null").distinct().withColumn("target", F.lit(True)).hint("merge")
    marked = texts(docs).join(chosen, "doc_id", "left").withColumn("target", F.coalesce("target", F.lit(False)))
    content = ["hashes", "tokens", "lengths", "targets"]
    with Stages(spark) as stages:
        held = stages.add(blocks(marked), "lm-blocks", **WIDE_ROWS)
        totals = held.agg(F.sum("n_target"), F.sum("n_background"), F.sum("n_chars"), F.count(F.lit(1))).first()
        bits = max(LEAST_BUCKETS, -(-(totals[2] or 0) // BUCKET) - 1).bit_length()
        asked = held.select("block", *content).mapInArrow(
            _asked(bits), "bucket int, block string, keys binary, target binary, background binary"
        )
        added = asked.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
            _added, "block string, bucket int, places binary, target binary, background binary, words long"
        )
        added = stages.add(added, "lm-counts", **WIDE_ROWS)
        size = added.agg(F.sum("words")).first()[0]
        own = held.select("block", F.lit(-1).alias("bucket"), *content, "doc_ids")
        answers = added.filter("block is not null").drop("words")
        scored = (
            own.unionByName(answers, allowMissingColumns=True)
            # By number, so that small partitions are not put together again, and more than blocks, so that few meet in one.
            .repartition(min(max(1, 4 * totals[3]), PARTITIONS), "block").sortWithinPartitions("block", "bucket")
            .mapInArrow(
                _scored(bits, (totals[0] or 0, totals[1] or 0), size or 0),
                f"doc_id {identifier}, n_tokens long, target_loss double, background_loss double, score double",
            )
        )
        return staged(scored, "lm-scores")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored for their likeness to those labelled good."""
    targets = table(spark, sf_dir, "labels").filter("quality = 1")
    return score_documents(spark, table(spark, sf_dir, "documents"), targets)
