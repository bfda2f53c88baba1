"""SentencePiece encoding by backtracking over longest matches, and decoding.

A model of merge type joins the best-scored neighbouring pair of a text's
symbols, leftmost first, until no pair is a piece. Its result is found without
running the merges over the text: a sequence of pieces is the encoding exactly
when every piece encodes to itself and every two neighbours, re-merged, stay
apart, since the first merge across a border would also happen in that pair
alone. So an automaton names the longest piece at each place, a piece is taken
if it is compatible with the one before, else its next shorter prefix is tried,
and a place where none fits is marked in a bitfield of failed positions and its
last piece given up. As a prefix has one encoding only, a marked place is never
tried again, so the work is linear in the text.

Texts are cut where no piece reaches across: between characters that are never
joined through pieces, such as letters and punctuation, and before space signs.
The ids of short segments are remembered.

The model file is a parameter. Models with user-defined or unused pieces, or
with text normalisation, are refused. A null text counts as empty and has the
end id only; repeated rows are encoded each; other columns are ignored. Memory
is bounded by a batch of texts, two bounded caches and the vocabulary.
"""

from __future__ import annotations

import codecs
import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lunario.llm.common import whole_text

#: Segments and pairs of pieces that a task remembers; longer segments are not kept.
CACHE = 300_000
SHORT = 64

# Fixed values of the public model format.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_SURFACE = " ⁇ "


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"unknown field kind {kind} in the model file")
        size = varint() if kind == 2 else 8 if kind == 1 else 4
        yield key >> 3, data[at : at + size]
        at += size


def _single_bytes(error: UnicodeDecodeError) -> tuple[str, int]:
    """Every byte outside valid UTF-8 becomes one replacement character."""
    return "�", error.start + 1


codecs.register_error("single_bytes", _single_bytes)


class _Remembered(dict):
    """Ids by segment; computes what is missing and forgets all when full."""

    def __init__(self, find):
        super().__init__()
        self.find = find

    def __missing__(self, segment: str) -> tuple[int, ...]:
        ids = tuple(self.find(segment))
        if len(segment) <= SHORT:
            if len(self) >= CACHE:
                self.clear()
            self[segment] = ids
        return ids


class PieceBPE:
    """Encoder and decoder of one model.

    ``pieces`` lists (text, score, kind) by id. ``prefix`` puts a space sign
    before a text that is not empty. ``end`` is the end id.
    """

    def __init__(self, pieces: list[tuple[str, float, int]], prefix: bool = True, end: int = 2):
        kinds = [kind for _, _, kind in pieces]
        if USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.pieces, self.prefix, self.end = pieces, prefix, end
        self.ids = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.scores = {text: pieces[i][1] for text, i in self.ids.items()}
        self.bytes = {int(text[1:-1], 16): i for i, (text, _, kind) in enumerate(pieces) if kind == BYTE}
        self.unknown = kinds.index(UNKNOWN)
        self.controls = {i for i, kind in enumerate(kinds) if kind == CONTROL}
        self.written = [str(i) for i in range(len(pieces))]
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known = _Remembered(self.encode_segment)
        self._match()
        self._cut()
        self._surfaces()

    @classmethod
    def from_file(cls, path: str) -> PieceBPE:
        pieces, prefix, merges, end = [], True, False, 2
        with open(path, "rb") as file:
            data = file.read()
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:  # trainer
                trainer = dict(_fields(value))
                merges = trainer.get(3) == 2
                end = trainer.get(42, 2)
                if trainer.get(24, 0):
                    raise ValueError("models with the space sign as a suffix are not supported")
            elif number == 3:  # normalizer
                rules = dict(_fields(value))
                prefix = bool(rules.get(3, 1))
                if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
                    raise ValueError("models that normalise text are not supported")
        if not merges:
            raise ValueError("not a model of merge type")
        return cls(pieces, prefix, end)

    def _match(self) -> None:
        """The automaton over reversed pieces, and each piece's next shorter prefix."""
        reachable = {text for text in self.ids if self.merge(text) == [text]}
        reachable |= set(chain.from_iterable(self.ids))
        self.automaton = ahocorasick.Automaton()
        self.shorter: dict[str, str | None] = {}
        for text in reachable:
            self.automaton.add_word(text[::-1], text)
            prefixes = (text[:size] for size in range(len(text) - 1, 0, -1))
            self.shorter[text] = next((p for p in prefixes if p in reachable), None)
        self.automaton.make_automaton()

    def _cut(self) -> None:
        """The pattern of segments that no piece reaches across.

        Characters that are neighbours in some piece form groups; a segment is a
        run of one group, with the space signs before it. A vocabulary that has
        space signs after other characters treats them as any character.
        """
        inside = any(SPACE in text.lstrip(SPACE) for text in self.ids)
        group: dict[str, str] = {}

        def first(character: str) -> str:
            while group.setdefault(character, character) != character:
                character = group[character]
            return character

        for text in self.ids:
            body = text if inside else text.lstrip(SPACE)
            for character in body:
                group[first(character)] = first(body[0])
        groups: dict[str, list[str]] = {}
        for character in sorted(group):
            groups.setdefault(first(character), []).append(character)
        before = "" if inside else f"{SPACE}*"
        runs = [re.escape("".join(members)) for members in groups.values() if len(members) > 1]
        alone = re.escape("".join(members[0] for members in groups.values() if len(members) == 1))
        parts = [f"{before}[{run}]+" for run in runs] + [f"{before}[{alone}]"] * bool(alone)
        self.segments = re.compile("|".join([*parts, f"{SPACE}+", "."]), re.DOTALL)

    def _surfaces(self) -> None:
        """Bytes that each id decodes to."""
        self.surface = []
        for text, _, kind in self.pieces:
            if kind == BYTE:
                self.surface.append(bytes([int(text[1:-1], 16)]))
            elif kind == CONTROL:
                self.surface.append(b"")
            else:
                shown = UNKNOWN_SURFACE if kind == UNKNOWN else text.replace(SPACE, " ")
                self.surface.append(shown.encode())

    def merge(self, text: str) -> list[str]:
        """The merges themselves, for pieces and pairs of pieces: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best = place = None
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, place = score, i
            if place is None:
                break
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether two pieces stay apart when their text is merged anew."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(left + right) == [left, right]
        return known

    def longest(self, segment: str) -> list[str]:
        """The longest piece that starts at each place; an unknown character stands for itself."""
        found = list(segment)
        last, size = -1, len(segment) - 1
        for end, piece in self.automaton.iter(segment[::-1]):
            if end != last:  # the longest match of an end comes first
                found[size - end] = piece
                last = end
        return found

    def backtrack(self, segment: str) -> list[str]:
        """Pieces of a segment that is not empty."""
        size, longest, shorter = len(segment), self.longest(segment), self.shorter
        failed = bytearray((size >> 3) + 1)
        taken: list[str] = []
        place, piece = 0, longest[0]
        while True:
            while piece is not None:
                end = place + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and (
                    not taken or self.compatible(taken[-1], piece)
                ):
                    break
                piece = shorter.get(piece)
            if piece is None:
                failed[place >> 3] |= 1 << (place & 7)
                piece = taken.pop()
                place -= len(piece)
                piece = shorter.get(piece)
                continue
            taken.append(piece)
            place = end
            if place == size:
                return taken
            piece = longest[place]

    def encode_segment(self, segment: str) -> list[int]:
        ids: list[int] = []
        for piece in self.backtrack(segment):
            found = self.ids.get(piece)
            if found is not None:
                ids.append(found)
            elif self.bytes:
                ids.extend(self.bytes[byte] for byte in piece.encode())
            else:
                ids.append(self.unknown)
        return ids

    def encode(self, text: str, add_end: bool = True) -> list[int]:
        """Ids of a whole text, with the end id."""
        if not text:
            return [self.end] if add_end else []
        signed = text.replace(" ", SPACE)
        found = self.segments.findall(SPACE + signed if self.prefix else signed)
        ids = list(chain.from_iterable(map(self.known.__getitem__, found)))
        if not self.bytes:
            ids = [a for a, b in zip(ids, [None, *ids]) if a != self.unknown or b != a]
        return ids + [self.end] if add_end else ids

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: control ids vanish, the added space sign goes, byte ids join to UTF-8."""
        if ids and ids[-1] == self.end:
            ids = ids[:-1]
        runs = [ids]
        if not self.controls.isdisjoint(ids):
            runs = [[]]
            for i in ids:
                if i in self.controls:
                    runs.append([])
                else:
                    runs[-1].append(i)
        runs = [run for run in runs if run]
        texts = [
            b"".join(map(self.surface.__getitem__, run)).decode("utf-8", "single_bytes")
            for run in runs
        ]
        if runs and self.prefix and self.pieces[runs[0][0]][0].startswith(SPACE):
            texts[0] = texts[0][1:]
        return "".join(texts)


@lru_cache(maxsize=2)
def load(path: str) -> PieceBPE:
    """The coder of a task's process; read once per process."""
    return PieceBPE.from_file(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): one row per document, with the end id."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        for batch in batches:
            ids = pa.array([coder.encode(text.as_py()) for text in batch["text"]], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], ids], ["doc_id", "ids"])

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        coded, "doc_id bigint, ids array<int>"
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids count as none."""

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        for batch in batches:
            texts = pa.array([coder.decode(ids.as_py()) for ids in batch["ids"]], pa.string())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], texts], ["doc_id", "text"])

    none = F.array().cast("array<int>")
    return encoded.select("doc_id", F.coalesce("ids", none).alias("ids")).mapInArrow(
        plain, "doc_id bigint, text string"
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encodes and decodes each text: its number of ids and the digests of both results."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    kinds = [pa.int64(), pa.string(), pa.string()]

    def row(coder: PieceBPE, text: str) -> tuple[int, str, str]:
        ids = coder.encode(text)
        written = " ".join(map(coder.written.__getitem__, ids))
        written = hashlib.sha256(written.encode()).hexdigest()
        decoded = hashlib.sha256(coder.decode(ids).encode()).hexdigest()
        return len(ids), written, decoded

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = load(path)
        for batch in batches:
            rows = [row(coder, text.as_py()) for text in batch["text"]]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], schema.names)

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(coded, schema)
