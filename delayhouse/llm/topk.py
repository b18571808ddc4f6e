"""Exact top-k search by inner product over a bit-sliced index.

Every component becomes an integer; of up to ``BLOCK_ROWS`` rows, bit b of component d is one bitmap (a slice). The score of
all rows of a block against one query is a sum of slices: a component counts once for each set bit of the query's
component, at that bit's weight, and with its slices inverted where that is negative. Three slices of a weight
become a sum and a carry until one slice is left for each weight. The top rows are then read from the most significant slice
of the sum downward: rows that are ahead for certain, and rows still equal to the k-th; the latter are resolved by
the smaller identifier. Scores are exact integers.

Every query meets every block: blocks of queries are joined to blocks of rows, and each pair hands on k rows per query.

Defined cases: vectors that are null or hold a null or non-finite component take no part; vectors of different length are not
compared; a row without identifier takes no part; repeated rows are separate candidates, but one query; a query's own
identifier is never a candidate of it; fewer than k candidates are all returned; an empty table gives an empty result; other columns
are ignored. Components are at most 2^40 in size and scores must fit into 63 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import staged, table

TOP = 20
QUERY_STEP = 20
SCALE = 64
BLOCK_ROWS = 65_536
BLOCK_QUERIES = 128


# ---- one block of rows -----------------------------------------------------------------------------------------------


def slice_rows(values: np.ndarray) -> tuple[int, np.ndarray]:
    """Smallest value, and bitmaps (bit, component, word) of what each value lies above it."""
    lowest = int(values.min()) if values.size else 0
    above = (values - lowest).astype(np.uint64)
    bits = int(above.max()).bit_length() if values.size else 0
    words = -(-len(values) // 64)
    found = np.zeros((bits, values.shape[1], words), np.uint64)
    for bit in range(bits):
        plane = np.zeros((values.shape[1], 64 * words), np.uint8)
        plane[:, : len(values)] = ((above >> np.uint64(bit)) & np.uint64(1)).T
        found[bit] = np.packbits(plane, axis=1, bitorder="little").view(np.uint64)
    return lowest, found


def add_slices(at: list[list[np.ndarray]]) -> list[np.ndarray | None]:
    """The sum of bitmaps given by weight, as one bitmap for each weight."""
    total, weight = [], 0
    while weight < len(at):
        column = at[weight]
        if len(column) > 1 and weight + 1 == len(at):
            at.append([])
        while len(column) > 2:
            a, b, c = column.pop(), column.pop(), column.pop()
            either = a ^ b
            column.append(either ^ c)
            at[weight + 1].append((a & b) | (either & c))
        if len(column) == 2:
            a, b = column
            column[:] = [a ^ b]
            at[weight + 1].append(a & b)
        total.append(column[0] if column else None)
        weight += 1
    return total


def weighted_sum(query: np.ndarray, plain: np.ndarray, inverted: np.ndarray) -> list[np.ndarray | None]:
    """The slices of the sum over components of |query| times the value, or times the inverted value if negative."""
    bits = len(plain)
    at: list[list[np.ndarray]] = [[] for _ in range(bits + int(np.abs(query).max(initial=0)).bit_length())]
    for d in np.flatnonzero(query):
        size, source = abs(int(query[d])), inverted if query[d] < 0 else plain
        for j in range(size.bit_length()):
            if size >> j & 1:
                for bit in range(bits):
                    at[j + bit].append(source[bit, d])
    return add_slices(at)


def positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def select_top(total: list[np.ndarray | None], candidates: np.ndarray, k: int) -> np.ndarray:
    """Rows of the k largest sums among the candidates; ties to the lower position."""
    ahead, equal = np.zeros_like(candidates), candidates
    for slice_ in reversed(total):
        if slice_ is None:
            continue
        set_here = equal & slice_
        reached = ahead | set_here
        n = int(np.bitwise_count(reached).sum())
        if n > k:
            equal = set_here
        else:
            ahead, equal = reached, equal & ~slice_
            if n == k:
                return positions(ahead)
    first = positions(ahead)
    return np.concatenate([first, positions(equal)[: k - len(first)]])


class Block:
    """Rows of equal length, sorted by identifier."""

    def __init__(self, ids: np.ndarray, lowest: int, plain: np.ndarray):
        self.ids, self.lowest, self.plain, self.inverted = ids, lowest, plain, ~plain
        bitmap = np.zeros(-(-len(ids) // 64) * 64, np.uint8)
        bitmap[: len(ids)] = 1
        self.everyone = np.packbits(bitmap, bitorder="little").view(np.uint64)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Identifiers and scores of the k best rows but the query's own."""
        total = weighted_sum(query, self.plain, self.inverted)
        candidates = self.everyone
        low, high = np.searchsorted(self.ids, [own, own + 1])
        if low < high:
            candidates = candidates.copy()
            for p in range(low, high):
                candidates[p >> 6] &= ~(np.uint64(1) << np.uint64(p & 63))
        rows = select_top(total, candidates, k)
        scores = np.zeros(len(rows), np.int64)
        for weight, slice_ in enumerate(total):
            if slice_ is not None:
                scores += ((slice_[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << weight
        most = (1 << len(self.plain)) - 1
        return self.ids[rows], scores + int(query.sum()) * self.lowest + int(query[query < 0].sum()) * most


# ---- the job ---------------------------------------------------------------------------------------------------------


def integers(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def _tables(batches):
    """Rows of a partition, at most a block at a time."""
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += batch.num_rows
        while n >= BLOCK_ROWS:
            rows = pa.Table.from_batches(waiting)
            yield rows.slice(0, BLOCK_ROWS)
            waiting, n = rows.slice(BLOCK_ROWS).to_batches(), n - BLOCK_ROWS
    if n:
        yield pa.Table.from_batches(waiting)


def _by_length(rows: pa.Table):
    """(identifiers, values) sorted by identifier, for each length of vectors."""
    ids, vectors = np.asarray(rows.column("vec_id")), rows.column("value").to_pylist()
    lengths = np.array([len(v) for v in vectors])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        values = np.array([vectors[i] for i in at], np.int64).reshape(len(at), length)
        if np.abs(values).max(initial=0) > 1 << 40:
            raise ValueError("a component is too large")
        order = np.argsort(ids[at], kind="stable")
        yield int(length), ids[at][order], values[order]


_INDEX = "length int, bits int, lowest long, ids binary, slices binary"


def _indexed(batches):
    for rows in _tables(batches):
        for length, ids, values in _by_length(rows):
            lowest, found = slice_rows(values)
            row = [[length], [len(found)], [lowest], [ids.astype(np.int64).tobytes()], [found.tobytes()]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, kinds)], ["length", "bits", "lowest", "ids", "slices"]
            )


def _gathered(batches):
    for rows in _tables(batches):
        for length, ids, values in _by_length(rows):
            row = [[length], [ids.astype(np.int64).tobytes()], [values.tobytes()]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.binary(), pa.binary()))], ["length", "queries", "asked"]
            )


def _searched(k: int):
    def search(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, length = np.frombuffer(row["ids"], np.int64), row["length"]
                shape = (row["bits"], length, -(-len(ids) // 64))
                block = Block(ids, row["lowest"], np.frombuffer(row["slices"], np.uint64).reshape(shape))
                queries = np.frombuffer(row["queries"], np.int64)
                asked = np.frombuffer(row["asked"], np.int64).reshape(len(queries), length)
                found = [block.top(int(own), query, k) for own, query in zip(queries, asked)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(queries, [len(x) for x, _ in found])),
                    pa.array(np.concatenate([x for x, _ in found])), pa.array(np.concatenate([s for _, s in found])),
                ], ["query_id", "vec_id", "score"])

    return search


def top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs are (vec_id, value) with integer components."""
    vectors, queries = staged(vectors, "topk-rows"), queries.groupBy("vec_id").agg(F.min("value").alias("value"))
    queries = staged(queries, "topk-asked")
    row_blocks = max(1, -(-vectors.count() // BLOCK_ROWS))
    query_blocks = max(1, -(-queries.count() // BLOCK_QUERIES))
    index = vectors.repartition(row_blocks).mapInArrow(_indexed, _INDEX)
    # Numbered by the partition that the rows were dealt to, and written once, so the numbers stay.
    gathered = queries.repartition(query_blocks).mapInArrow(_gathered, "length int, queries binary, asked binary")
    gathered = staged(gathered.withColumn("query_block", F.spark_partition_id()), "topk-queries")
    pairs = (
        staged(index, "topk-index")
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
        .join(gathered, ["query_block", "length"])
        .withColumn("pair", F.xxhash64("query_block", "ids"))
        .repartition(max(spark.sparkContext.defaultParallelism, row_blocks * query_blocks), "pair")
        .drop("pair", "query_block")
    )
    found = pairs.mapInArrow(_searched(k), "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best rows for every 20th vector."""
    given = table(spark, sf_dir, "embeddings")
    vectors = given.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), integers(F.col("embedding")).alias("value"))
    return top_k(spark, vectors, vectors.filter(F.col("vec_id") % QUERY_STEP == 0))


ORACLE = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as value from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id as vec_id, list_dot_product(q.value, c.value)::bigint as score
  from vectors q join vectors c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0),
ranked as (
  select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
  from scored)
select * from ranked where rank <= 20
"""
