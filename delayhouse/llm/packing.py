"""Packing documents into sequences by length patterns and non-negative least squares.

Only the histogram of piece lengths, at most ``capacity`` numbers, decides. All patterns of one to three lengths that fill
a sequence exactly are enumerated; repeat counts that rebuild the histogram in the least-squares sense, none negative,
are found by accelerated projected gradients; they are rounded down and capped by what is there; what remains is packed
best-fit, longest first, again on counts. The plan says which ranks of a length go where, and every piece looks up
its own place by its rank among the pieces of its length.

Ranks are made in two levels (within a hash bucket of a length, then over the buckets), so a length that most
pieces share is no single task.

Defined cases: a null or empty text is the end mark alone, one token; repeated rows are packed each; a null identifier stays
null; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import few_rows, staged, table, texts

CAPACITY = 1024
END_ID = 2
#: Hash buckets of a length.
BUCKETS = 256
PIECE = "doc_id {0}, piece int, start long, length long, ids_crc32 long"


# ---- token pieces ----------------------------------------------------------------------------------------------------


class Identifiers:
    """Token ids of texts as little-endian 32-bit numbers, as ``tokenizers`` gives them for a byte-level BPE file.

    The vocabulary is read from that file, and merged by ``tiktoken``, which is several times faster. It joins any
    pair that spells an entry where the file lists one pair for each entry; the ids are the same, since at the rank of an entry all lower
    merges within its spelling are done, which leaves the listed pair. A text with the string of a special token goes to
    ``tokenizers`` itself.
    """

    def __init__(self, tokenizer: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Byte-level files write a byte as a printable character: itself, or the next free one from 256 on.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        entries = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {bytes(map(byte_of.__getitem__, entry)): rank for entry, rank in entries.items()}
        self.encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


def pieces(
    docs: DataFrame, tokenizer: str, pattern: str, end_id: int = END_ID, capacity: int = CAPACITY
) -> DataFrame:
    """The token pieces of every whole text; a text of over ``capacity`` tokens is cut, its first piece being the shorter."""
    identifier = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def cut(batches):
        identifiers, end = Identifiers(tokenizer, pattern), np.array([end_id], "<u4").tobytes()
        for batch in few_rows(batches):
            owners, numbers, starts, lengths, sums = [], [], [], [], []
            for owner, text in enumerate(batch.column("text").to_pylist()):
                ids = memoryview(identifiers.of(text).tobytes() + end)
                total = len(ids) // 4
                first = (total - 1) % capacity + 1
                bounds = [0, *range(first, total + 1, capacity)]
                n = len(bounds) - 1
                owners += repeat(owner, n)
                numbers += range(n)
                starts += bounds[:-1]
                lengths += [first, *repeat(capacity, n - 1)]
                sums += [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(bounds, bounds[1:])]
            columns = [batch.column("doc_id").take(pa.array(owners, pa.int64())), pa.array(numbers, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (starts, lengths, sums)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return texts(docs).mapInArrow(cut, PIECE.format(identifier))


# ---- the plan, on the histogram of lengths ---------------------------------------------------------------------------


def patterns(counts: np.ndarray) -> np.ndarray:
    """Patterns of one to three present lengths that fill a sequence; one row of three lengths each, 0 for none."""
    capacity = len(counts) - 1
    present = np.flatnonzero(counts[1:]) + 1
    here = np.zeros(capacity + 1, bool)
    here[present] = True
    found = [np.array([[0, 0, capacity]])] if here[capacity] else []
    rest = capacity - present
    pair = here[rest] & (present <= rest) & (rest > 0)
    found.append(np.stack([np.zeros(pair.sum(), int), present[pair], rest[pair]], 1))
    for a in present[present <= capacity // 3]:
        b = present[(present >= a) & (2 * present <= capacity - a)]
        c = capacity - a - b
        fits = here[c]
        found.append(np.stack([np.full(fits.sum(), a), b[fits], c[fits]], 1))
    return np.concatenate(found).astype(int) if found else np.zeros((0, 3), int)


def repeat_counts(rows: np.ndarray, counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative repeat counts whose lengths come nearest to the histogram, relative to its spread."""
    if not len(rows):
        return np.zeros(0)
    target = counts.astype(float)
    target[0] = 0
    weight = 1 / np.sqrt(np.maximum(target, 1))
    weight[0] = 0

    def lengths_of(x):
        return sum(np.bincount(rows[:, j], x, len(counts)) for j in range(3))

    # A bound of the largest curvature for each pattern by itself (row sums of the absolute normal matrix).
    load = weight**2 * lengths_of(np.ones(len(rows)))
    step = 1 / np.maximum(load[rows].sum(1), 1e-12)
    x = seen = np.zeros(len(rows))
    momentum = 1.0
    for _ in range(steps):
        gap = weight**2 * (lengths_of(seen) - target)
        following = np.maximum(seen - step * gap[rows].sum(1), 0)
        growth = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        seen = following + (momentum - 1) / growth * (following - x)
        x, momentum = following, growth
    return x


def best_fit(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each length into the fullest sequences that still take it; sequences alike are handled together."""
    capacity = len(counts) - 1
    open_by_gap: dict[int, list[list]] = {}
    gaps: list[int] = []

    def put(pattern, n):
        gap = capacity - sum(pattern)
        if gap not in open_by_gap:
            open_by_gap[gap] = []
            bisect.insort(gaps, gap)
        open_by_gap[gap].append([pattern, n])

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                if left >= each:
                    put((length,) * each, left // each)
                if left % each:
                    put((length,) * (left % each), 1)
                break
            kinds = open_by_gap[gaps[at]]
            pattern, n = kinds.pop()
            if not kinds:
                del open_by_gap[gaps.pop(at)]
            fits = capacity - sum(pattern)
            each = fits // length
            filled = min(n, left // each)
            if filled:
                put(pattern + (length,) * each, filled)
            left -= filled * each
            if filled < n and left:  # one sequence takes the last few
                put(pattern + (length,) * left, 1)
                left, filled = 0, filled + 1
            if filled < n:
                put(pattern, n - filled)
    return [(p, n) for kinds in open_by_gap.values() for p, n in kinds]


def plan(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences); every piece of the histogram is placed."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    rows = patterns(left)
    wanted = np.floor(repeat_counts(rows, left) + 0.5).astype(np.int64)
    made = []
    for k in np.argsort(-wanted, kind="stable"):
        if wanted[k] <= 0:
            break
        pattern = tuple(int(n) for n in rows[k] if n)
        n = min([int(wanted[k]), *(int(left[length]) // pattern.count(length) for length in set(pattern))])
        if n > 0:
            made.append((pattern, n))
            for length in pattern:
                left[length] -= n
    return made + best_fit(left)


def places(planned: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, ...]:
    """Runs of a plan by length, then rank: bounds of each length, and first rank, first sequence and offset of each run."""
    used = np.zeros(capacity + 1, np.int64)
    runs, first = [], 0
    for pattern, n in planned:
        offset = 0
        for length in pattern:
            runs.append((length, used[length], first, offset))
            used[length] += n
            offset += length
        first += n
    ordered = np.array(sorted(runs), np.int64).reshape(-1, 4)
    bounds = np.searchsorted(ordered[:, 0], np.arange(capacity + 2))
    return bounds, *(np.ascontiguousarray(ordered[:, i]) for i in (1, 2, 3))


def look_up(runs: tuple[np.ndarray, ...], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset by length and rank."""
    bounds, ranks, sequences, offsets = runs
    sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    for n in np.unique(length):
        at, low = np.flatnonzero(length == n), bounds[n]
        run = low + np.searchsorted(ranks[low : bounds[n + 1]], rank[at], "right") - 1
        sequence[at] = sequences[run] + rank[at] - ranks[run]
        offset[at] = offsets[run]
    return sequence, offset


# ---- the job ---------------------------------------------------------------------------------------------------------


def pack(spark: SparkSession, cut: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS) -> DataFrame:
    """``pieces`` rows plus sequence_id and offset. ``cut`` is read twice and should be a written table."""
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    groups = staged(dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("members")), "pack-groups")
    counts = np.zeros(capacity + 1, np.int64)
    for row in groups.groupBy("length").agg(F.sum("members").alias("members")).collect():  # at most one row per length
        counts[row["length"]] = row["members"]
    runs = spark.sparkContext.broadcast(places(plan(counts), capacity))  # its size depends on the capacity alone
    earlier = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = groups.select("length", "bucket", F.coalesce(F.sum("members").over(earlier), F.lit(0)).alias("bucket_start"))
    place = W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        dealt.withColumn("rank_in_bucket", F.row_number().over(place) - 1)
        .join(starts, ["length", "bucket"])
        .select(*cut.columns, (F.col("bucket_start") + F.col("rank_in_bucket")).alias("rank"))
    )
    kept = cut.columns
    names = [*kept, "sequence_id", "offset"]

    def placed(batches):
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "rank"))
            found = [pa.array(x) for x in look_up(runs.value, length, rank)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *found], names)

    schema = ", ".join(f"{name} {kind}" for name, kind in cut.dtypes) + ", sequence_id long, offset long"
    return ranked.mapInArrow(placed, schema)


def pack_documents(
    spark: SparkSession, docs: DataFrame, tokenizer: str | None = None, pattern: str | None = None, capacity: int = CAPACITY
) -> DataFrame:
    """All pieces of all documents with their places. Vocabulary file (a path that every executor has) and split pattern
    are those of the public byte-level vocabulary unless given."""
    import public_tokenizers

    tokenizer, pattern = tokenizer or public_tokenizers.path("byte_bpe_50k.json"), pattern or public_tokenizers.PATTERN
    return pack(spark, staged(pieces(docs, tokenizer, pattern, capacity=capacity), "pack-pieces"), capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed."""
    return pack_documents(spark, table(spark, sf_dir, "documents"))
