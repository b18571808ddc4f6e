"""Document fingerprints by locally consistent parsing.

A text is parsed bottom-up. On each level, runs of one symbol become one symbol; three rounds of deterministic coin tossing
give every symbol a label below 8 that differs from its left neighbour's (twice the place of the lowest bit in which the two
differ, plus that bit); symbols with a locally largest label begin a phrase; a phrase's name is the hash of its
symbols and is a symbol of the next level. A boundary depends on a few neighbours only, so equal substrings of any
offset have the same phrases but near their ends.

The fingerprint holds, for each level, the smallest names in a fixed number of slots. The share j of slots that agree
among those that either of two fingerprints fills estimates the phrases in common among all phrases of both; their likeness
is 2j / (1 + j), the common part of two texts of like length.

A document and the next one, by descending identifier, are brought together by one range-partitioned sort; only the last
document of every partition is completed afterwards, from the first of the following partition.

Defined cases: a null text is empty; an empty text has an empty fingerprint, alike to another empty one (1) and to nothing
else (0); a single document is its own successor; null identifiers come last; rows that share an identifier are ordered by a hash of
their texts, so repeated rows follow each other; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import few_rows, staged, table, texts

#: Slots of the levels, from phrases of about 3 characters to phrases of about 100.
SLOTS = (4, 20, 28, 12)
#: Characters that are parsed together, to bound memory; a longer text is parsed alone.
TOGETHER = 1 << 18
_EMPTY = np.uint32(0xFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _factors() -> np.ndarray:
    return np.random.default_rng(11).integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def _lowest_bits() -> np.ndarray:
    return np.array([(n & -n).bit_length() - 1 if n else 7 for n in range(256)], np.uint8)


def _before(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Left neighbours; the complement at the start of a text, so that the lowest bit differs."""
    left = np.empty_like(values)
    left[1:] = values[:-1]
    left[starts] = ~values[starts]
    return left


def labels(names: np.ndarray, starts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Three rounds of coin tossing."""
    differing = names ^ _before(names, starts)
    lowest = differing & (~differing + names.dtype.type(1))
    found = np.bitwise_count(lowest - names.dtype.type(1)) << np.uint8(1)
    found |= (names & lowest) != 0
    for _ in range(2):
        place = places[found ^ _before(found, starts)]
        found = (place << np.uint8(1)) | ((found >> place) & np.uint8(1))
    return found


def one_level(names: np.ndarray, starts: np.ndarray, factors: np.ndarray, places: np.ndarray):
    """Names of the phrases, and where the phrases of each text start. No text is empty."""
    fresh = np.empty(len(names), bool)
    fresh[1:] = names[1:] != names[:-1]
    fresh[starts] = True
    if not fresh.all():
        first = np.flatnonzero(fresh)
        length = np.diff(first, append=len(names))
        starts = np.searchsorted(first, starts)
        names = names[first]
        again = length > 1
        names[again] = (names[again] + length[again].astype(names.dtype) * names.dtype.type(0x9E3779B1)) * names.dtype.type(0x85EBCA6B)
    label = labels(names, starts, places)
    left, right = np.empty_like(label), np.empty_like(label)
    left[1:], right[:-1] = label[:-1], label[1:]
    right[-1] = 0
    right[starts[1:] - 1] = 0
    cut = (label > left) & (label >= right)
    cut[starts] = True
    first = np.flatnonzero(cut)
    length = np.diff(first, append=len(names))
    place = np.arange(len(names)) - np.repeat(first, length)
    spelled = np.add.reduceat((names.astype(np.uint64) + np.uint64(1)) * factors[place & 63], first)
    return _mixed(spelled + length.astype(np.uint64)), np.searchsorted(first, starts)


def _together(found: list[np.ndarray], factors: np.ndarray, places: np.ndarray) -> np.ndarray:
    sizes = np.array([len(f) for f in found])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    names = np.concatenate(found)
    slots = np.full((len(found), sum(SLOTS)), _EMPTY)
    offset = 0
    for n in SLOTS:
        names, starts = one_level(names, starts, factors, places)
        owner = np.repeat(np.arange(len(found)), np.diff(starts, append=len(names)))
        mixed = _mixed(names ^ np.uint64(0x5851F42D4C957F2D))
        slot = ((mixed >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
        np.minimum.at(slots, (owner, slot.astype(np.int64) + offset), mixed.astype(np.uint32))
        offset += n
    return np.where(slots == _EMPTY, 0, slots % np.uint32(65535) + 1).astype(">u2")


def fingerprints(texts: list[str]) -> np.ndarray:
    """One row of slots per text; 0 is an empty slot."""
    factors, places = _factors(), _lowest_bits()
    result = np.zeros((len(texts), sum(SLOTS)), ">u2")
    waiting, at, size = [], [], 0
    for i, text in enumerate(texts):
        if text:
            waiting.append(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
            at.append(i)
            size += len(text)
        if waiting and (size >= TOGETHER or i == len(texts) - 1):
            result[at] = _together(waiting, factors, places)
            waiting, at, size = [], [], 0
    return result


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 for rows of two fingerprints; 1 if both are empty."""
    filled = ((a > 0) | (b > 0)).sum(-1)
    agreeing = ((a == b) & (a > 0)).sum(-1)
    return np.where(filled > 0, 2 * agreeing / np.maximum(filled + agreeing, 1), 1.0)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the next."""
    replaced = len(text) // 3
    return text[: len(text) - replaced] + following[:replaced]


def _written(rows: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in rows]


def _read(written: list[str]) -> np.ndarray:
    return np.array([np.frombuffer(bytes.fromhex(w), ">u2") for w in written], ">u2").reshape(len(written), sum(SLOTS))


_COMPARED = "edited_sha256 string, edited_fingerprint string, near_edited double, near_next double"


def _compared(own: list[str], found: np.ndarray, following: list[str], found_next: np.ndarray) -> list[pa.Array]:
    """The four last columns for texts and their successors."""
    changed = [edited(a, b) for a, b in zip(own, following, strict=True)]
    found_changed = fingerprints(changed)
    return [
        pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], pa.string()),
        pa.array(_written(found_changed), pa.string()),
        pa.array(likeness(found, found_changed), pa.float64()), pa.array(likeness(found, found_next), pa.float64()),
    ]


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and their edited texts."""
    identifier = docs.schema["doc_id"].dataType.simpleString()
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc()]
    names = ["doc_id", "n_chars", "fingerprint", *(c.split()[0] for c in _COMPARED.split(", ")), "first", "last", "text"]

    def rows(ids, own, found, compared, first, last):
        """Rows of a partition; the text goes along with its first and its last row."""
        n = len(own)
        flags = [[first and i == 0 for i in range(n)], [last and i == n - 1 for i in range(n)]]
        carried = [t if f or z else None for t, f, z in zip(own, *flags)]
        return pa.RecordBatch.from_arrays([
            ids, pa.array([len(t) for t in own], pa.int64()), pa.array(_written(found), pa.string()), *compared,
            *(pa.array(f, pa.bool_()) for f in flags), pa.array(carried, pa.string()),
        ], names)

    def walk(batches):
        """A partition in order: every text meets the next; the last one stays open."""
        held, first = None, True
        for batch in few_rows(batches):
            ids, own = batch.column("doc_id"), batch.column("text").to_pylist()
            found = fingerprints(own)
            if held:
                ids = pa.concat_arrays([held[0], ids])
                own, found = held[1] + own, np.concatenate([held[2], found])
            n = len(own) - 1
            if n:
                yield rows(ids[:n], own[:n], found[:n], _compared(own[:n], found[:n], own[1:], found[1:]), first, False)
                first = False
            held = ids[n:], own[n:], found[n:]
        if held:
            nothing = [pa.nulls(1, pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.float64()), pa.nulls(1, pa.float64())]
            yield rows(*held, nothing, first, True)

    schema = f"doc_id {identifier}, n_chars long, fingerprint string, {_COMPARED}, first boolean, last boolean, text string"
    walked = staged(
        texts(docs).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(walk, schema)
        .withColumn("part", F.spark_partition_id()), "fingerprints",
    )

    # One row per partition from here on.
    after = F.coalesce(F.lead("part").over(W.orderBy("part")), F.min("part").over(W.partitionBy()))
    following = walked.filter("first").select("part").select("part", after.alias("next_part"))
    heads = walked.filter("first").select(
        F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fingerprint")
    )
    tails = walked.filter("last").select("doc_id", "n_chars", "fingerprint", "text", "part")
    pairs = tails.join(following, "part").join(heads, "next_part")

    def complete(batches):
        for batch in few_rows(batches):
            own, ahead, found, found_next = (
                batch.column(c).to_pylist() for c in ("text", "next_text", "fingerprint", "next_fingerprint")
            )
            columns = [batch.column(c) for c in ("doc_id", "n_chars", "fingerprint")]
            yield pa.RecordBatch.from_arrays([*columns, *_compared(own, _read(found), ahead, _read(found_next))], names[:7])

    completed = pairs.mapInArrow(complete, f"doc_id {identifier}, n_chars long, fingerprint string, {_COMPARED}")
    return walked.filter("not last").select(names[:7]).unionByName(completed)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents."""
    return fingerprint_documents(table(spark, sf_dir, "documents"))
