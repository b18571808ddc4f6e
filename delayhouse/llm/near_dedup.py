"""Near-duplicate documents by b-bit MinHash.

A document is the set of its distinct shingles of ``width`` words, kept as 64-bit hashes. Equal sets are one node. Of 128 minima per
node, four at a time make 32 band keys; nodes that share a key are candidates. Of each minimum the lowest four bits are
kept and packed; the share of equal four-bit fields, corrected for chance collisions, estimates the similarity
of a candidate pair by bit counts. Pairs that pass are confirmed on their full sets.

Only connections matter, so a bucket is not expanded into pairs: first every member is held against the smallest
member; then, with the components found, only members outside a bucket's largest component are held against the rest of it,
in blocks. Members with a plausible partner get their sets, and meet in the same blocks again, where links are confirmed at once: a
pair whose ends confirmed links already join is skipped, so a block hands on a spanning forest, fewer links than members. A second sketch (parity of the set per hash slot) gives a lower bound of the symmetric difference, which drops
most pairs below the threshold without a chance of dropping one above it.

Misses: a pair at similarity 0.8 shares no band with probability (1 - 0.8^4)^32 = 5e-8, and its estimate, of standard
deviation 0.037, falls below 0.66 with probability 1e-4; both shrink quickly above 0.8.

Defined cases: null, empty and white-space texts have 0 shingles, are linked with nothing and are kept; fewer words than ``width`` are
one shingle; a row without identifier is linked with nothing, has a null component and is kept; repeated rows share
their component; rows that share an identifier but not a set are linked each by its own set, so that two components can bear
one identifier, and of a component one text stays; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import Stages
from .common import few_rows, staged, table, texts
from .components import connected

#: Words of a shingle, unless a caller wants another width.
WIDTH = 5
#: Similarity as a fraction, bands x rows of minima, bits kept of each, and the estimate below which a pair is dropped.
SIMILARITY = (80, 100)
BANDS, ROWS = 32, 4
BITS = 4
LEAST_ESTIMATE = 0.66
PARITY_BITS = 2048
#: Members of a bucket that meet in one block, where a large set counts as one more for each ``LARGE`` shingles.
BLOCK = 256
LARGE = 4096
#: Bytes of words remembered by a task.
REMEMBERED = 2**21


# ---- sketches --------------------------------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingles:
    """Sorted distinct hashes of the shingles of a text, A-Z lower-cased, words split at ASCII white space."""

    def __init__(self, width: int):
        self.width, self.words, self.held = width, {}, 0

    def of(self, text: str) -> np.ndarray:
        from xxhash import xxh3_64_intdigest

        words, known = text.encode().lower().split(), self.words
        if self.held > REMEMBERED:
            known.clear()
            self.held = 0
        for word in words:
            if word not in known:
                known[word] = xxh3_64_intdigest(word)
                self.held += len(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        if width < 1:
            return hashes
        n = len(words) - width + 1
        found = _mixed(hashes[:n])
        for i in range(1, width):
            next_ = hashes[i : i + n]
            found = _mixed(found + ((next_ << np.uint64(1)) | (next_ >> np.uint64(63))))
        return np.unique(found)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240501)
    n = BANDS * ROWS
    return draw.integers(0, 2**32, n, np.uint32), draw.integers(0, 2**31, n, np.uint32) * np.uint32(2) + np.uint32(1)


def minima(hashes: np.ndarray, functions) -> np.ndarray:
    """The minimum of every hash function over a set."""
    shift, factor = functions
    high = (hashes >> np.uint64(32)).astype(np.uint32)[:, None]
    parts = [((high[i : i + 2048] ^ shift) * factor).min(0) for i in range(0, len(high), 2048)]
    return np.min(parts, 0) if len(parts) > 1 else parts[0]


def packed(lowest: np.ndarray) -> np.ndarray:
    """The low bits of each row of minima, two to a byte."""
    low = (lowest & np.uint32(2**BITS - 1)).astype(np.uint8)
    return low[:, ::2] | (low[:, 1::2] << np.uint8(BITS))


def band_keys(lowest: np.ndarray) -> np.ndarray:
    """One key per row of minima and band."""
    wide = lowest.reshape(len(lowest), BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :]
    for row in range(ROWS):
        key = _mixed(key ^ wide[:, :, row]) + np.uint64(row)
    return key.view(np.int64)


def parity(hashes: np.ndarray) -> np.ndarray:
    """Per slot, whether an odd number of members falls into it."""
    slots = np.bincount((hashes & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits((slots & 1).astype(np.uint8))


def _binary(rows) -> pa.Array:
    return pa.array([None if r is None else r.tobytes() for r in rows], pa.binary())


def set_key(hashes: np.ndarray) -> bytes | None:
    """What stands for a set; null for the empty one."""
    return hashlib.blake2b(hashes, digest_size=16).digest() if len(hashes) else None


def text_key(text: Column) -> Column:
    """What stands for a text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key and bands of every whole text; the last two null for an empty set."""
    identifier = docs.schema["doc_id"].dataType.simpleString()

    def sketched(batches):
        shingles, functions = Shingles(width), _functions()
        for batch in few_rows(batches):
            sizes, keys, lowest = [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingles.of(text)
                sizes.append(len(hashes))
                keys.append(set_key(hashes))
                if len(hashes):
                    lowest.append(minima(hashes, functions))
            flat = band_keys(np.array(lowest)).ravel() if lowest else np.zeros(0, np.int64)
            full = np.array([n > 0 for n in sizes], bool)
            offsets = np.concatenate([[0], np.cumsum(full * BANDS)])
            bands = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))
            columns = [batch.column("doc_id"), batch.column("text_key")]
            columns += [pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), bands]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "n_shingles", "set_key", "bands"])

    return texts(docs).withColumn("text_key", text_key(F.col("text"))).mapInArrow(
        sketched, f"doc_id {identifier}, text_key binary, n_shingles long, set_key binary, bands array<long>"
    )


def contents(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node (a set's key), n, signature, parity and members (sorted hashes) of the wanted sets (doc_id, text_key, node)."""

    def filled(batches):
        shingles, functions = Shingles(width), _functions()
        last = None  # the join leaves rows of one identifier and text together: repeated ones are told once
        for batch in few_rows(batches):
            nodes, sets = [], []
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if node != last:
                    last = node
                    nodes.append(node)
                    sets.append(shingles.of(text))
            signatures = packed(np.array([minima(s, functions) for s in sets])) if sets else []
            columns = [pa.array(nodes, pa.binary()), pa.array([len(s) for s in sets], pa.int64())]
            columns += [_binary(signatures), _binary([parity(s) for s in sets]), _binary(sets)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "signature", "parity", "members"])

    keyed = texts(docs).withColumn("text_key", text_key(F.col("text")))
    return keyed.join(wanted.hint("merge"), ["doc_id", "text_key"]).mapInArrow(
        filled, "node binary, n long, signature binary, parity binary, members binary"
    )


# ---- comparisons -----------------------------------------------------------------------------------------------------


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarities from packed low bits: the share of equal fields, less what chance makes equal."""
    x = a ^ b
    x = x | (x >> np.uint64(1))
    x = (x | (x >> np.uint64(2))) & np.uint64(0x1111111111111111)
    differing = np.bitwise_count(x).sum(-1, dtype=np.int64)
    equal = 1 - differing / (BANDS * ROWS)
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


def may_reach(sizes: np.ndarray, parity_a: np.ndarray, parity_b: np.ndarray) -> np.ndarray:
    """Whether pairs can still be similar: slots of differing parity are a lower bound of the symmetric difference."""
    num, den = SIMILARITY
    odd = np.bitwise_count(parity_a ^ parity_b).sum(-1, dtype=np.int64)
    return odd * (den + num) <= sizes * (den - num)


def _pairs_of(a: pa.Array, b: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a, b], ["a", "b"])


def _plausible(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        near = estimates(*(_matrix(batch.column(c), np.uint64) for c in ("signature_a", "signature_b"))) >= LEAST_ESTIMATE
        sizes = np.asarray(batch.column("n_a")) + np.asarray(batch.column("n_b"))
        near &= may_reach(sizes, *(_matrix(batch.column(c), np.uint64) for c in ("parity_a", "parity_b")))
        keep = pa.array(near)
        yield _pairs_of(batch.column("a").filter(keep), batch.column("b").filter(keep))


def _confirmed(batches):
    for batch in few_rows(batches):
        sides = [[np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("members_a", "members_b")]
        keep = pa.array(list(map(similar, *sides)), pa.bool_())
        yield _pairs_of(batch.column("a").filter(keep), batch.column("b").filter(keep))


def _beside(pairs: DataFrame, held: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns of both ends of each pair."""
    for end in ("a", "b"):
        own = held.select(F.col("node").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in columns))
        pairs = pairs.join(own, end)
    return pairs


def _confirm(pairs: DataFrame, held: DataFrame) -> DataFrame:
    kind = dict(pairs.dtypes)["a"]
    return _beside(pairs, held, ["members"]).mapInArrow(_confirmed, f"a {kind}, b {kind}")


BLOCK_KEY = ("key", "member_block", "probe_block")


def _by_block(batches):
    """The rows of one block after the other. Rows come sorted by block."""
    rest = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([rest, rows]) if rest is not None else rows
        if not rows.num_rows:
            continue
        block = np.stack([np.asarray(rows.column(c)) for c in BLOCK_KEY])
        cuts = np.flatnonzero((block[:, 1:] != block[:, :-1]).any(0)) + 1
        bounds = [0, *cuts.tolist()]
        for low, high in zip(bounds, bounds[1:]):
            yield rows.slice(low, high - low)
        rest = rows.slice(bounds[-1])
    if rest is not None and rest.num_rows:
        yield rest


def _plausible_in(rows: pa.Table):
    """Places of plausible pairs of a block: probes against members of other components."""
    probe, component = np.asarray(rows.column("probe")), np.asarray(rows.column("component"))
    signature, parities = (_matrix(rows.column(c), np.uint64) for c in ("signature", "parity"))
    size = np.asarray(rows.column("n"))
    asks, told = np.flatnonzero(probe), np.flatnonzero(~probe)
    for start in range(0, len(asks), 64):
        ask = asks[start : start + 64]
        near = estimates(signature[ask][:, None], signature[told][None]) >= LEAST_ESTIMATE
        i, j = np.nonzero(near & (component[ask][:, None] != component[told][None]))
        i, j = ask[i], told[j]
        keep = may_reach(size[i] + size[j], parities[i], parities[j])
        yield i[keep], j[keep]


def _involved(batches):
    """The rows of each block that have a plausible partner in it, without their sketches."""
    for rows in _by_block(batches):
        some = np.zeros(rows.num_rows, bool)
        for i, j in _plausible_in(rows):
            some[i] = some[j] = True
        if some.any():
            yield from rows.select([*BLOCK_KEY, "node", "component", "probe"]).filter(pa.array(some)).combine_chunks().to_batches()


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets reach the similarity, by their full members."""
    num, den = SIMILARITY
    both = len(np.intersect1d(x, y, assume_unique=True))
    return den * both >= num * (len(x) + len(y) - both)


def _forest(batches):
    """Confirmed links that join the components of each block, none whose ends others join already."""
    for rows in _by_block(batches):
        _, start = np.unique(np.asarray(rows.column("component")), return_inverse=True)
        parent = list(range(int(start.max()) + 1))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        members = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("members")]
        found = []
        for pairs in _plausible_in(rows):
            for i, j in zip(*(x.tolist() for x in pairs)):
                a, b = root(start[i]), root(start[j])
                if a != b and similar(members[i], members[j]):
                    parent[a] = b
                    found.append((i, j))
        if found:
            node = rows.column("node").combine_chunks()
            a, b = (node.take(pa.array(x)) for x in zip(*found))
            yield _pairs_of(pc.min_element_wise(a, b), pc.max_element_wise(a, b))


def _unresolved(labelled: DataFrame, held: DataFrame, add) -> DataFrame:
    """Confirmed links (a, b) between the components that share a bucket; rows are (key, node, component, weight)."""
    parts = labelled.groupBy("key", "component").agg(F.sum("weight").alias("n"))
    mixed = (
        parts.groupBy("key")
        .agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("parts"))
        .filter("parts > 1")
        .select("key", F.col("main.component").alias("main"), "size", (F.col("size") - F.col("main.n")).alias("probes"))
    )
    blocks = {c: F.ceil(F.col(c) / BLOCK).cast("int") for c in ("size", "probes")}
    open_rows = labelled.join(mixed, "key").withColumns({"member_blocks": blocks["size"], "probe_blocks": blocks["probes"]})
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    members = open_rows.select(
        "key", "node", "component", F.lit(False).alias("probe"),
        F.pmod(F.xxhash64("node"), "member_blocks").cast("int").alias("member_block"), every("probe_blocks").alias("probe_block"),
    )
    probes = open_rows.filter("component <> main").select(
        "key", "node", "component", F.lit(True).alias("probe"),
        every("member_blocks").alias("member_block"), F.pmod(F.xxhash64("node"), "probe_blocks").cast("int").alias("probe_block"),
    )
    kind = dict(labelled.dtypes)["node"]
    rows = members.unionByName(probes)
    dealt = lambda df, columns: (
        df.join(held.select("node", *columns), "node").repartition(*BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY)
    )
    shape = f"key long, member_block int, probe_block int, node {kind}, component {kind}, probe boolean"
    involved = add(dealt(rows, ["n", "signature", "parity"]).mapInArrow(_involved, shape), "near-involved")
    return dealt(involved, ["n", "signature", "parity", "members"]).mapInArrow(_forest, f"a {kind}, b {kind}").distinct()


# ---- the operator ----------------------------------------------------------------------------------------------------


def _linked(spark: SparkSession, docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """The sketches, and (set_key, doc_id, text_key): the smallest row of the component of each set."""
    sketched = staged(sketches(docs, width), "near-sketches")
    linkable = sketched.filter("doc_id is not null and set_key is not null")
    with Stages(spark) as stages:
        least = F.min(F.struct("doc_id", "text_key")).alias("least")
        weight = (1 + F.floor(F.first("n_shingles") / LARGE)).cast("int").alias("weight")
        nodes = linkable.groupBy(F.col("set_key").alias("node")).agg(least, F.first("bands").alias("bands"), weight)
        nodes = stages.add(nodes, "near-nodes")
        kind = dict(nodes.dtypes)["node"]

        keys = nodes.select("node", "weight", F.explode("bands").alias("key"))
        shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("leader")).filter("size > 1")
        hits = stages.add(keys.join(shared.drop("size"), "key"), "near-hits")
        wanted = nodes.select("node", "least.*").join(hits.select("node").distinct(), "node", "left_semi")
        held = stages.add(contents(docs, wanted, width), "near-sets")

        led = hits.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        near = _beside(led, held, ["n", "signature", "parity"]).mapInArrow(_plausible, f"a {kind}, b {kind}")
        links = stages.add(_confirm(near, held), "near-links")
        so_far = connected(links, stages.add)
        labelled = hits.drop("leader").join(so_far, "node", "left")
        labelled = stages.add(labelled.withColumn("component", F.coalesce("component", "node")), "near-labelled")
        more = stages.add(_unresolved(labelled, held, stages.add), "near-links")

        components = connected(links.unionByName(more), stages.add)
        named = nodes.select("node", "least").join(components, "node", "left")
        named = stages.add(named.withColumn("component", F.coalesce("component", "node")), "near-named")
        smallest = named.groupBy("component").agg(F.min("least").alias("smallest"))
        named = named.join(smallest, "component").select(F.col("node").alias("set_key"), "smallest.*")
        return sketched, staged(named, "near-named")


def near_duplicates(spark: SparkSession, docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per document."""
    sketched, named = _linked(spark, docs, width)
    linkable = sketched.filter("doc_id is not null and set_key is not null")
    columns = ["doc_id", "n_shingles", "component_id"]
    alone = sketched.filter("doc_id is null or set_key is null").withColumn("component_id", F.col("doc_id"))
    named = named.select("set_key", F.col("doc_id").alias("component_id"))
    result = linkable.join(named, "set_key").select(columns).unionByName(alone.select(columns))
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(spark: SparkSession, docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One text of each group, and one empty text of each identifier, with all columns; rows without identifier all stay."""
    sketched, named = _linked(spark, docs, width)
    empty = sketched.filter("doc_id is not null and set_key is null").groupBy("doc_id").agg(F.min("text_key").alias("text_key"))
    kept = named.select("doc_id", "text_key").distinct().unionByName(empty)
    rows = docs.filter("doc_id is not null").select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("doc_id"), text_key(F.col("text")).alias("text_key")
    )
    one = rows.join(kept, ["doc_id", "text_key"], "left_semi").dropDuplicates(["doc_id", "text_key"])
    return one.select("row.*").unionByName(docs.filter("doc_id is null"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents, by shingles of two words."""
    return near_duplicates(spark, table(spark, sf_dir, "documents"), width=2)
