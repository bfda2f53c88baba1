"""Byte-level BPE by a tree of joins, and decoding by concatenation up the tree.

Encodings of byte strings form a monoid: the join of two encodings is the
encoding of the joined bytes. A long string is cut in halves, each half encoded
recursively, and the halves joined by re-encoding a window of tokens around the
seam. The window grows on a side until that side is stable. Stability is
proved by pairs: a token sequence is the encoding of its bytes exactly when
every two neighbours are, since a merge that breaks the sequence would start
within one pair; so a seam is settled once the pairs at both edges of the
window re-encode to themselves, and nothing beyond can change.

The ranks file is a parameter. Special tokens are not recognised. A null text
counts as empty and has no ids; repeated rows are encoded each; other columns
are ignored. Memory is bounded by a batch of texts, a bounded cache of matches
and the vocabulary.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lunario.llm.common import whole_text

#: Bytes that are encoded at once, without cutting.
LEAF = 16
#: Matches whose ids a task remembers, and characters of the longest of them.
CACHE, SHORT = 200_000, 64
#: Tokens that are decoded at once.
CHUNK = 4096


class _Remembered(dict):
    """Ids by match; computes what is missing and forgets all when full."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, match: str) -> tuple[int, ...]:
        ids = tuple(self.find(match.encode("utf-8")))
        if len(match) <= SHORT:
            if len(self) >= CACHE:
                self.clear()
            self[match] = ids
        return ids


class ByteBPE:
    """Encoder and decoder for one table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.written = {rank: str(rank) for rank in self.tokens}
        self.pattern = regex.compile(pattern)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.matches = _Remembered(self.encode_match)

    @classmethod
    def from_file(cls, path: str, pattern: str) -> ByteBPE:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(a): int(b) for a, b in pairs}, pattern)

    def merge(self, data: bytes) -> list[int]:
        """Lowest rank first, leftmost among equals, with a heap of candidate pairs."""
        ranks = self.ranks
        size = len(data)
        stop = list(range(1, size + 1))  # end of the part that starts here
        before = list(range(-1, size - 1))
        heap = []
        for i in range(size - 1):
            rank = ranks.get(data[i : i + 2])
            if rank is not None:
                heap.append((rank, i, i + 2))
        heapq.heapify(heap)
        while heap:
            rank, i, end = heapq.heappop(heap)
            middle = stop[i]
            # Outdated if a part has gone or grown since: the ends no longer fit.
            if middle == 0 or middle >= size or stop[middle] != end:
                continue
            stop[i] = end
            stop[middle] = 0
            if end < size:
                before[end] = i
                wider = ranks.get(data[i : stop[end]])
                if wider is not None:
                    heapq.heappush(heap, (wider, i, stop[end]))
            if before[i] >= 0:
                wider = ranks.get(data[before[i] : end])
                if wider is not None:
                    heapq.heappush(heap, (wider, before[i], end))
        found, i = [], 0
        while i < size:
            found.append(ranks[data[i : stop[i]]])
            i = stop[i]
        return found

    def stable(self, a: int, b: int) -> bool:
        """Whether the two tokens, side by side, are the encoding of their bytes."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            known = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
            self.pairs[a, b] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the joined bytes of two encodings; the empty list is neutral."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            seam = left[-i:] + right[:j]
            window = self.merge(b"".join([self.tokens[t] for t in seam]))
            left_done = i >= len(left) or self.stable(left[-i - 1], window[0])
            right_done = j >= len(right) or self.stable(window[-1], right[j])
            if left_done and right_done:
                return left[: max(0, len(left) - i)] + window + right[j:]
            i = i if left_done else min(2 * i, len(left))
            j = j if right_done else min(2 * j, len(right))

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of the bytes: the tree over their halves."""
        if len(data) <= LEAF:
            return self.merge(data) if data else []
        half = len(data) // 2
        return self.join(self.encode_bytes(data[:half]), self.encode_bytes(data[half:]))

    def encode_match(self, data: bytes) -> list[int]:
        """Ids of one match of the pattern; one that is a token as a whole stays whole."""
        rank = self.ranks.get(data)
        return self.encode_bytes(data) if rank is None else [rank]

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text; matches of the pattern do not interact."""
        return list(chain.from_iterable(map(self.matches.__getitem__, self.pattern.findall(text))))

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of the ids, joined pairwise up the tree."""
        tokens = self.tokens
        level = [
            b"".join(map(tokens.__getitem__, ids[i : i + CHUNK])) for i in range(0, len(ids), CHUNK)
        ]
        while len(level) > 1:
            level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0] if level else b""


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBPE:
    """The coder of a task's process; read once per process."""
    return ByteBPE.from_file(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): one row per document."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for batch in batches:
            ids = [coder.encode(text.as_py()) for text in batch["text"]]
            listed = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], listed], ["doc_id", "ids"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        coded, "doc_id bigint, ids array<int>"
    )


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes) from (doc_id, ids); null ids count as none."""

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for batch in batches:
            data = pa.array([coder.decode(ids.as_py()) for ids in batch["ids"]], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], data], ["doc_id", "bytes"])

    none = F.array().cast("array<int>")
    return encoded.select("doc_id", F.coalesce("ids", none).alias("ids")).mapInArrow(
        plain, "doc_id bigint, bytes binary"
    )


def round_trip(docs: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """Encodes and decodes each text: its number of tokens and the digests of both results."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
        + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids
    )

    kinds = [pa.int64(), pa.string(), pa.string()] + [pa.list_(pa.int32())] * keep_ids

    def row(coder: ByteBPE, text: str) -> tuple:
        ids = coder.encode(text)
        written = " ".join(map(coder.written.__getitem__, ids))
        written = hashlib.sha256(written.encode()).hexdigest()
        decoded = hashlib.sha256(coder.decode(ids)).hexdigest()
        return (len(ids), written, decoded) + ((ids,) if keep_ids else ())

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path, pattern)
        for batch in batches:
            rows = [row(coder, text.as_py()) for text in batch["text"]]
            columns = [
                pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)
            ]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], schema.names)

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(coded, schema)
