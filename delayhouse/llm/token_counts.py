"""Token counts of a byte-pair vocabulary by merging with a heap and a linked list.

A text starts as one symbol per character; a character outside the vocabulary stands for its bytes. All adjacent pairs
whose joint spelling is in the vocabulary wait in a heap; the pair of lowest rank (ties: the leftmost) is popped and
joined, its neighbours in the linked list form new pairs, and outdated heap entries are skipped. The count is the number
of first symbols less the merges; no identifiers are made.

Merges never cross a boundary between two characters that stand side by side in no vocabulary entry, so a text is cut at
such places and every piece is merged alone; pieces that recur within a task are counted once (a bounded memory).

Defined cases: a null or empty text has 0 bytes and 0 tokens; a null identifier stays null; repeated rows are counted
each; other columns are ignored; an empty table gives an empty result; texts of any length are counted whole, in
n log n steps for a piece of n characters.
"""

from __future__ import annotations

import heapq
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import few_rows, table, texts

#: A document above this many tokens is over the limit.
TOKEN_LIMIT = 4096
#: Pieces remembered by a task.
REMEMBERED = 400_000
SPACE = "▁"


class PieceCounts(dict):
    """Tokens of a piece of text; a missing piece is merged and remembered."""

    def __init__(self, model: str):
        from sentencepiece import sentencepiece_model_pb2 as formats

        proto = formats.ModelProto()
        with open(model, "rb") as file:
            proto.ParseFromString(file.read())
        kinds = formats.ModelProto.SentencePiece
        normal = [p for p in proto.pieces if p.type == kinds.NORMAL]
        spec = proto.normalizer_spec
        plain = spec.name == "identity" and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        if not plain or proto.trainer_spec.model_type != 2 or any(p.type == kinds.USER_DEFINED for p in proto.pieces):
            raise ValueError("a byte-pair model without normalisation and user-defined pieces is needed")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.rank = {p.piece: -p.score for p in normal}
        self.fallback = proto.trainer_spec.byte_fallback
        self.adjacent = {p[i : i + 2] for p in self.rank for i in range(len(p) - 1)}
        # A space that follows anything but a space starts a new piece, unless the vocabulary joins the two.
        joined = any(a != SPACE and b == SPACE for a, b in self.adjacent)
        self.cut = re.compile("(?s).+" if joined else f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall

    def __missing__(self, piece: str) -> int:
        parts, start, adjacent = [], 0, self.adjacent
        for i in range(1, len(piece)):
            if piece[i - 1 : i + 1] not in adjacent:
                parts.append(piece[start:i])
                start = i
        if parts:
            parts.append(piece[start:])
            count = sum(map(self.__getitem__, parts))
        else:
            count = self.merged(piece)
        if len(self) < REMEMBERED:
            self[piece] = count
        return count

    def weight(self, symbol: str) -> int:
        return 1 if symbol in self.rank or not self.fallback else len(symbol.encode())

    def merged(self, piece: str) -> int:
        """First symbols less merges."""
        rank, symbols = self.rank, list(piece)
        last = len(symbols)
        count = sum(map(self.weight, symbols))
        before, behind = list(range(-1, last - 1)), list(range(1, last + 1))
        heap = []
        for i in range(last - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in rank:
                heap.append((rank[pair], i, i + 1, pair))
        heapq.heapify(heap)
        while heap:
            _, left, right, pair = heapq.heappop(heap)
            if behind[left] != right or symbols[left] is None or symbols[left] + symbols[right] != pair:
                continue
            count -= self.weight(symbols[left]) + self.weight(symbols[right]) - 1
            symbols[left], symbols[right] = pair, None
            after = behind[left] = behind[right]
            if after < last:
                before[after] = left
                joint = pair + symbols[after]
                if joint in rank:
                    heapq.heappush(heap, (rank[joint], left, after, joint))
            ahead = before[left]
            if ahead >= 0:
                joint = symbols[ahead] + pair
                if joint in rank:
                    heapq.heappush(heap, (rank[joint], ahead, left, joint))
        return count

    def tokens(self, text: str) -> int:
        if not text:
            return 0
        return sum(map(self.__getitem__, self.cut(self.prefix + text.replace(" ", SPACE))))


def count_tokens(docs: DataFrame, model: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text; ``model`` is a path that every executor has."""
    identifier = docs.schema["doc_id"].dataType.simpleString()

    def counted(batches):
        counts = PieceCounts(model)
        for batch in few_rows(batches):
            found = [counts.tokens(t) for t in batch.column("text").to_pylist()]
            if len(counts) >= REMEMBERED:
                counts.clear()
            size = pc.binary_length(batch.column("text")).cast(pa.int64())
            over = pa.array([n > limit for n in found], pa.bool_())
            columns = [batch.column("doc_id"), size, pa.array(found, pa.int64()), over]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    schema = f"doc_id {identifier}, n_bytes long, n_tokens long, over_limit boolean"
    return texts(docs).mapInArrow(counted, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
