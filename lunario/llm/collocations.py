"""Phrase collocations, counted by a multikey three-way quicksort of suffix pointers.

Every word of a piece of text starts a suffix of at most ``longest`` words. A
task gathers the suffixes of about ``CHUNK`` words, counts equal ones once, and
routes them by their leading words: single words by the word, longer suffixes
by their first two words. So all suffixes that share a phrase meet in one
bucket, whose number follows the size of the corpus. There, pointers to the
suffixes are sorted by a three-way quicksort that goes one word deeper with
each equal part: the size of an equal part is the count of its phrase, and a
part below the least count is abandoned, as no phrase in it can reach it.

A pair of words that holds more than a share of all positions is hot. Such
pairs are routed by all their words, and the counts of their shorter phrases,
which then lie in several buckets, are added up at the end. A first pass finds
them: a pair with a share of 1/K of all chunks together has it in some chunk,
so chunks report their pairs above 1/(2K), and at most 2K sums can reach it.

Null texts count as empty, a null language as ``und``; empty texts have no
words, so a table without words gives no rows. Repeated rows count as often as
they occur; ids and other columns are not read. Counts are exact below 10^15
words of a language. Ties of rank are settled by the phrase, so reruns agree.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lunario.llm.common import shuffle_width, staged, whole_text

#: Words whose suffixes a task counts before it hands them on.
CHUNK = 1 << 20
#: Bytes of text per bucket.
BUCKET = 32 << 20
#: Buckets that a chunk deals to directly; beyond, rows are dealt twice.
FAN = 2048
#: A pair with more than one in this many positions is hot, at most; the table of
#: hot pairs that every task gets has at most twice as many rows.
SHARES = 1 << 15
#: Parts of fewer pointers are sorted at once.
SMALL = 32

# Fixed values of the contract: what ends a piece, and lower case for A-Z only.
BREAKS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + BREAKS, b"abcdefghijklmnopqrstuvwxyz" + b"." * len(BREAKS)
)
STOP = b"."
#: Texts are tokenised in stretches of so many bytes.
STRETCH = 1 << 22
BETWEEN = re.compile(rb"[ \t.,;:!?\n\x0b-\r]")


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text in stretches; ``STOP`` stands between pieces and after the last."""
    at = 0
    while at < len(text):
        cut = BETWEEN.search(text, at + STRETCH)
        end = cut.start() if cut else len(text)
        yield text[at:end].translate(FOLD).replace(STOP, b" . ").split()
        at = end
    yield [STOP]


class _Numbers(dict):
    """Numbers words by first use; the stop is number 0."""

    def __init__(self):
        super().__init__({STOP: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _chunks(
    batches: Iterator[pa.RecordBatch], reach: int
) -> Iterator[tuple[str, list[bytes], np.ndarray, int]]:
    """(lang, words by number, numbers of the words, ahead) of bounded chunks; 0 stands between pieces.

    The last ``ahead`` words, ``reach`` at most, only follow the others: the
    text goes on, and they come again as the first words of a later chunk.
    """
    kept: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
    held = 0

    def flushed(unfinished: str | None) -> Iterator[tuple[str, list[bytes], np.ndarray, int]]:
        nonlocal held
        rest = None
        for lang, (numbers, parts) in kept.items():
            words, ids = list(numbers), np.concatenate(parts)
            ahead = min(reach, len(ids)) if lang == unfinished else 0
            if ahead:
                rest = [words[i] for i in ids[-ahead:].tolist()]
            yield lang, words, ids, ahead
        kept.clear()
        held = 0
        if rest:
            add(unfinished, rest)

    def add(lang: str, words: list[bytes]) -> None:
        nonlocal held
        numbers, parts = kept.setdefault(lang, (_Numbers(), []))
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        held += len(words)

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
            for words in words_of(text.as_buffer().to_pybytes()):
                add(lang, words)
                if held >= CHUNK:
                    yield from flushed(lang)
    yield from flushed(None)


def _suffixes(ids: np.ndarray, longest: int, ahead: int) -> np.ndarray:
    """One row per word: it and the words after it in its piece, then zeros."""
    size = len(ids) - ahead
    padded = np.concatenate([ids, np.zeros(longest, ids.dtype)])
    rows = np.stack([padded[k : k + size] for k in range(longest)], axis=1)
    for k in range(1, longest):
        rows[rows[:, k - 1] == 0, k] = 0
    return rows[rows[:, 0] != 0]


def _counted(
    rows: np.ndarray, words: int, times: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Different rows of numbers below ``words``, and how often each occurs."""
    code, bound = rows[:, 0].astype(np.int64), words
    for k in range(1, rows.shape[1]):
        if bound > (1 << 62) // words:
            code = np.unique(code, return_inverse=True)[1]
            bound = len(code)
        code = code * words + rows[:, k]
        bound *= words
    if times is None:
        _, first, counts = np.unique(code, return_index=True, return_counts=True)
        return rows[first], counts
    _, first, at = np.unique(code, return_index=True, return_inverse=True)
    sums = np.zeros(len(first), np.int64)
    np.add.at(sums, at, times)
    return rows[first], sums


def _mixed(*parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the hashes in each row."""
    mixed = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        mixed = (mixed ^ part) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(w) | zlib.adler32(w) << 32 for w in words], np.uint64)


class _Packer:
    """Packs rows of word numbers with just the words that they use."""

    def __init__(self, words: list[bytes], lang: str):
        self.words = words
        self.hashes = _word_hashes(words) ^ np.uint64(zlib.crc32(lang.encode()))
        self.seen = np.zeros(len(words), bool)
        self.place = np.zeros(len(words), np.uint32)

    def pack(self, rows: np.ndarray, counts: np.ndarray) -> bytes:
        self.seen[rows] = True
        used = np.flatnonzero(self.seen)
        self.seen[used] = False
        self.place[used] = np.arange(len(used), dtype=np.uint32)
        small = np.uint16 if len(used) < 1 << 16 else np.uint32
        wide = np.uint8 if counts.max() < 1 << 8 else np.uint64
        head = np.array([len(rows), rows.shape[1], small().itemsize, wide().itemsize], np.int64)
        body = self.place[rows].T.astype(small).tobytes() + counts.astype(wide).tobytes()
        return head.tobytes() + body + b" ".join([self.words[i] for i in used.tolist()])


def _unpack(blob: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    size, width, small, wide = np.frombuffer(blob, np.int64, 4).tolist()
    at = 32 + size * width * small
    rows = np.frombuffer(blob, f"u{small}", size * width, 32).reshape(width, size).T
    counts = np.frombuffer(blob, f"u{wide}", size, at)
    return blob[at + size * wide :].split(b" "), rows, counts.astype(np.int64)


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text")
    )


def hot_pairs(docs: DataFrame, shares: int) -> tuple[DataFrame, list[tuple[str, bytes, bytes]]]:
    """Words per language, and the pairs that hold more than one in ``shares`` positions of all."""

    def tallied(batches):
        for lang, words, ids, ahead in _chunks(batches, 1):
            rows, counts = _counted(_suffixes(ids, 2, ahead), len(words))
            total = int(counts.sum())
            often = (counts * 2 * shares > total) & (rows[:, 1] != 0)
            rows, counts = rows[often].tolist(), counts[often].tolist()
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * (1 + len(rows)), pa.string()),
                    "a": pa.array([None] + [words[a] for a, _ in rows], pa.binary()),
                    "b": pa.array([None] + [words[b] for _, b in rows], pa.binary()),
                    "n": pa.array([total, *counts], pa.int64()),
                }
            )

    tallies = staged(
        _named(docs)
        .mapInArrow(tallied, "lang string, a binary, b binary, n bigint")
        .groupBy("lang", "a", "b")
        .agg(F.sum("n").alias("n")),
        "collocations-tallies",
    )
    totals = tallies.where("a IS NULL").select("lang", "n").where("n > 0")
    words = totals.agg(F.sum("n")).first()[0] or 0
    # Each sum is a lower bound of its pair's count, so at most 2 * shares can pass.
    hot = tallies.where(F.col("a").isNotNull() & (F.col("n") * 2 * shares > F.lit(words)))
    return totals, [(r["lang"], bytes(r["a"]), bytes(r["b"])) for r in hot.select("lang", "a", "b").collect()]


PACKED = "bucket bigint, lang string, kind int, packed binary"
#: Routing: single words by the word, suffixes by two words, those of hot pairs by all words.
SINGLE, PAIRED, HOT = 1, 2, 3


def _dealt(
    packer: _Packer, kind: int, rows: np.ndarray, counts: np.ndarray, buckets: int, keys: int
) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, kind, packed rows); only ``bucket % keys`` counts, so there are ``keys`` at most."""
    depth = rows.shape[1] if kind == HOT else kind
    mixed = _mixed(*[packer.hashes[rows[:, k]] for k in range(depth)])
    bucket = (mixed % np.uint64(buckets) % np.uint64(keys)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bounds = np.flatnonzero(np.diff(bucket[order])) + 1
    for mine in np.split(order, bounds) if len(order) else []:
        yield int(bucket[mine[0]]), kind, packer.pack(rows[mine], counts[mine])


def _batch(lang: str, packed: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    buckets, kinds, blobs = zip(*packed) if packed else ((), (), ())
    columns = {
        "bucket": pa.array(buckets, pa.int64()),
        "lang": pa.array([lang] * len(packed), pa.string()),
        "kind": pa.array(kinds, pa.int32()),
        "packed": pa.array(blobs, pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def _gathered(
    batches: Iterator[pa.RecordBatch], size: int | None
) -> Iterator[tuple[str, int, list[bytes], np.ndarray, np.ndarray]]:
    """(lang, kind, words, rows, counts) of packed rows, up to about ``size`` rows at a time, else all."""
    groups: dict[tuple[str, int], tuple[_Numbers, list, list]] = {}
    held = 0

    def merged():
        while groups:
            (lang, kind), (numbers, rows, counts) = groups.popitem()
            yield lang, kind, list(numbers), np.concatenate(rows), np.concatenate(counts)

    for batch in batches:
        columns = (batch[name].to_pylist() for name in ("lang", "kind", "packed"))
        for lang, kind, blob in zip(*columns, strict=True):
            numbers, rows, counts = groups.setdefault((lang, kind), (_Numbers(), [], []))
            words, local, times = _unpack(blob)
            to = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
            rows.append(to[local])
            counts.append(times)
            held += len(times)
            if size and held >= size:
                yield from merged()
                held = 0
    yield from merged()


def _routed(docs: DataFrame, longest: int, buckets: int, hot: list[tuple[str, bytes, bytes]]) -> DataFrame:
    """(bucket, lang, kind, packed): suffixes counted per chunk and routed by their leading words.

    A chunk deals to ``FAN`` keys at most, so that packed rows stay large; with
    more buckets, the rows of a key are counted again and dealt to its buckets.
    """
    of_lang: dict[str, set[tuple[bytes, bytes]]] = {}
    for lang, a, b in hot:
        of_lang.setdefault(lang, set()).add((a, b))
    keys = min(buckets, FAN)

    def chunk(lang, words, rows, counts):
        packer = _Packer(words, lang)
        single, at = np.unique(rows[:, 0], return_inverse=True)
        sums = np.bincount(at, counts).astype(np.int64)
        yield from _dealt(packer, SINGLE, single[:, None], sums, buckets, keys)
        paired = rows[:, 1] != 0
        rows, counts = rows[paired], counts[paired]
        pairs = []
        if lang in of_lang:
            number = {word: i for i, word in enumerate(words)}
            found = ((number.get(a), number.get(b)) for a, b in of_lang[lang])
            pairs = [a * len(words) + b for a, b in found if a is not None and b is not None]
        is_hot = np.isin(rows[:, 0].astype(np.int64) * len(words) + rows[:, 1], pairs)
        for kind, chosen in ((PAIRED, ~is_hot), (HOT, is_hot)):
            yield from _dealt(packer, kind, rows[chosen], counts[chosen], buckets, keys)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids, ahead in _chunks(batches, longest - 1):
            rows, counts = _counted(_suffixes(ids, longest, ahead), len(words))
            if len(rows):
                yield _batch(lang, list(chunk(lang, words, rows, counts)))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, kind, words, rows, counts in _gathered(batches, CHUNK):
            rows, counts = _counted(rows, len(words), counts)
            dealt = _dealt(_Packer(words, lang), kind, rows, counts, buckets, buckets)
            yield _batch(lang, list(dealt))

    routed = _named(docs).mapInArrow(packed, PACKED)
    return routed if keys == buckets else routed.groupBy("bucket").applyInArrow(again, PACKED)


def multikey_quicksort(
    rows: np.ndarray, counts: np.ndarray, least: int, whole: int = 1
) -> Iterator[tuple[int, int, int]]:
    """(pointer, depth, count) of each phrase of ``least`` occurrences, from equal parts.

    ``rows`` are suffixes as word numbers, 0 after the end; ``counts`` says how
    often each occurs. Phrases shorter than ``whole`` words are counted in part
    here and in part elsewhere, so nothing that holds one is abandoned.
    """
    columns = [np.ascontiguousarray(rows[:, k]) for k in range(rows.shape[1])]
    work = [(np.arange(len(rows)), 0)]
    while work:
        pointers, depth = work.pop()
        need = least if depth + 1 >= whole else 1
        keys, times = columns[depth][pointers], counts[pointers]
        if len(pointers) <= SMALL:
            # Too few to halve: equal parts at once, the rare ones abandoned uncut.
            sizes: dict[int, int] = {}
            for key, n in zip(keys.tolist(), times.tolist(), strict=True):
                sizes[key] = sizes.get(key, 0) + n
            equal = [(pointers[keys == k], n) for k, n in sizes.items() if k and n >= need]
        else:
            pivot = np.partition(keys[:: len(keys) // 9][:9], 4)[4]
            same, less = keys == pivot, keys < pivot
            size, below = int(times[same].sum()), int(times[less].sum())
            equal = [(pointers[same], size)] if pivot and size >= need else []
            if below >= need:
                work.append((pointers[less], depth))
            if int(times.sum()) - size - below >= need:
                work.append((pointers[keys > pivot], depth))
        for part, size in equal:
            yield int(part[0]), depth + 1, size
            if depth + 1 < len(columns):
                work.append((part, depth + 1))


def phrase_counts(docs: DataFrame, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, n) of phrases of up to ``longest`` words with ``least``
    occurrences, words joined by spaces; and (lang, n) of all words."""
    spark = docs.sparkSession
    volume = _named(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_width(spark), -(-volume // BUCKET))
    totals, hot = hot_pairs(docs, min(SHARES, buckets))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, kind, words, rows, counts in _gathered(batches, None):
            whole = longest if kind == HOT else 1
            found = [
                (b" ".join([words[w] for w in rows[pointer, :depth].tolist()]).decode(), depth, size)
                for pointer, depth, size in multikey_quicksort(rows, counts, least, whole)
                if kind == SINGLE or depth > 1
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(found), pa.string()),
                    "phrase": pa.array([phrase for phrase, _, _ in found], pa.string()),
                    "size": pa.array([depth for _, depth, _ in found], pa.int32()),
                    "n": pa.array([size for _, _, size in found], pa.int64()),
                }
            )

    routed = _routed(docs, longest, buckets, hot)
    frequent = (
        routed.groupBy("bucket")
        .applyInArrow(counted, "lang string, phrase string, size int, n bigint")
        .groupBy("lang", "phrase", "size")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
    )
    return staged(frequent, "collocations-frequent"), totals


def _part(first: Column, size: Column) -> Column:
    """Words of the phrase from place ``first`` (from 1), joined."""
    return F.array_join(F.slice(F.split("phrase", " "), first, size), " ")


def collocations(
    docs: DataFrame, longest: int = 3, least: int = 10, covered: int = 50, top: int = 2000
) -> DataFrame:
    """Each language's first ``top`` phrases by the score of their weakest cut.

    A phrase of 2 to ``longest`` words is a candidate from ``least``
    occurrences on; it is dropped if a longer candidate that holds its words in
    a row has ``covered`` percent of its occurrences or more.
    """
    frequent, totals = phrase_counts(docs, longest, least)
    candidates = frequent.where("size > 1")
    wide = "decimal(16,0)"
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang",
        "phrase",
        "size",
        F.col("n").alias("a"),
        "k",
        _part(F.lit(1), F.col("k")).alias("first"),
        _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"),
    )
    # Parts of a phrase occur at least as often as it does, so all are in the table.
    for side, name in (("first", "l"), ("rest", "r")):
        part = frequent.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
        cuts = cuts.join(part, ["lang", side])
    score = f"(cast(a as {wide}) * a * 1000000) div (cast(l as {wide}) * r)"
    weakest = (
        cuts.withColumn("score", F.expr(score))
        .groupBy("lang", "phrase", "size", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    held = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), F.col("size") - size + 1), lambda first: _part(first, size)
            ),
        )
    )
    holders = (
        candidates.where("size > 2")
        .select("lang", F.col("n").alias("holder"), F.explode(F.array_distinct(held)).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("holder").alias("holder"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        weakest.join(holders, ["lang", "phrase"], "left")
        .where(F.col("holder").isNull() | (F.col("holder") * 100 < F.col("a") * covered))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
