"""Long repeated byte strings, by enhanced suffix arrays over parts of the corpus.

A byte goes when it lies in a string of ``LENGTH`` bytes that starts anywhere
else too, in the same document or another. All such strings are covered by the
maximal repeats of at least that length, with all their occurrences.

Equal strings have equal k-gram hashes, hence the same least one. Neighbouring
window starts that share its first place form a segment (``SPAN`` starts at
most), and all starts of a string lie in different segments of one least hash:
its bucket. So the corpus is dealt by that hash:

1. Light rows (bucket, segment hash, place) are counted; a bucket met once
   holds no repeat and goes.
2. Segments of equal bytes form a class. A class met twice is repeated as a
   whole. A bucket that also has a class met once is contested, and only of
   its classes one copy each is fetched.
3. A contested bucket's suffixes (window starts) are sorted and the common
   prefixes of neighbours scanned with a stack: each interval of the common
   prefix tree at least ``LENGTH`` deep, whose suffixes are preceded by
   different bytes (or open a segment), is a maximal repeat of the bucket.
4. A bucket of more than ``CLASSES`` classes is settled by counting the hash of
   each of its windows instead, which gathers nothing in one task.

That gives the bytes that repeats cover, which ``cleaned`` removes; classes and
the windows of step 4 are settled by 64-bit hash there. The maximal repeats
themselves, of any length and with all occurrences, come from ``occurrences``:

5. All repeats that start with one window have it as their first ``LENGTH``
   bytes. Only windows met more than once and preceded by different bytes (or
   opening a text) can open one; their places form a node.
6. The suffixes of a node, up to the end of their covered stretch, are sorted
   and scanned as in step 3, on bytes.
7. A node too large for one task is compared with one of its own suffixes. The
   common prefixes with it give all groups along that suffix; places that leave
   it at one depth by one byte, or outlast the compared block, form the next
   nodes.

A null text counts as empty. Rows equal in id and text are occurrences of each other. Ids may repeat
with other texts (told apart by the text's 64-bit hash); other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lunario.llm.common import NO_ID, shuffle_width, staged, text_hash, whole_text

LENGTH = 200
#: Bytes of a k-gram, and k-grams that start in a window.
GRAM = 32
SPAN = LENGTH - GRAM + 1
#: Bytes handled at once.
PIECE = 2 << 20
#: Classes of a bucket, or suffixes of a node, that are sorted in one task.
CLASSES = 2048
#: Bytes of a node's suffixes in one task; least bytes compared at once in a larger node.
NODE_BYTES = 32 << 20
BLOCK = 4096
#: Of a place: start, count and the byte before plus one (0: opens its text) in one number.
COUNT_BITS, BEFORE_BITS = 10, 9
#: Odd multipliers of the k-gram hash, drawn once.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def _least_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least k-gram hash of the window at each start, and whether the window's first k-gram has it.

    ``data`` has at least ``LENGTH`` bytes.
    """
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(data),), (1,))
    n = len(data) - GRAM + 1
    h = words[:n] * MIX[0]
    for k in range(1, GRAM // 8):
        h += words[8 * k : 8 * k + n] * MIX[k]
    h ^= h >> np.uint64(29)
    h *= MIX[1]
    h ^= h >> np.uint64(32)
    blocks = -(-n // SPAN)
    filled = np.full(blocks * SPAN, np.iinfo(np.uint64).max, dtype=np.uint64)
    filled[:n] = h
    grid = filled.reshape(blocks, SPAN)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    starts = len(data) - LENGTH + 1
    least = np.minimum(ahead[:starts], behind[SPAN - 1 : SPAN - 1 + starts])
    return least, h[:starts] == least


def segments(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, count, least hash) of the segments of texts laid end to end, which end at ``ends``."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return none, none, none.astype(np.uint64)
    least, leaves = _least_hashes(data)
    starts = np.arange(len(least))
    text = np.searchsorted(ends, starts, side="right")
    inside = starts + LENGTH <= ends[text]
    fresh = np.ones(len(least), dtype=bool)
    fresh[1:] = (least[1:] != least[:-1]) | leaves[:-1] | (text[1:] != text[:-1]) | ~inside[:-1]
    first = np.flatnonzero(fresh & inside)
    if not len(first):
        return none, none, none.astype(np.uint64)
    # A segment goes on to the next fresh start or the last whole window of its text.
    after = np.append(first[1:], len(least))
    stop = np.minimum(after, ends[text[first]] - LENGTH + 1)
    return first, stop - first, least[first]


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[list[tuple[int, int, int]], np.ndarray, np.ndarray]]:
    """Texts of a batch laid end to end in buffers of about ``PIECE`` bytes.

    Gives (row, offset in its text, byte before plus one) of each part, the bytes and the parts' ends.
    A longer text is cut; parts overlap so that each window is in one of them.
    """
    parts, data, size = [], [], 0
    for i in range(batch.num_rows):
        whole = batch["text"][i].as_py().encode("utf-8")
        for at in range(0, max(1, len(whole) - LENGTH + 1), PIECE):
            some = whole[at : at + PIECE + LENGTH - 1]
            if len(some) < LENGTH:
                continue
            parts.append((i, at, whole[at - 1] + 1 if at else 0))
            data.append(some)
            size += len(some)
            if size >= PIECE:
                yield parts, np.frombuffer(b"".join(data), np.uint8), np.cumsum([*map(len, data)])
                parts, data, size = [], [], 0
    if parts:
        yield parts, np.frombuffer(b"".join(data), np.uint8), np.cumsum([*map(len, data)])


def _light(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, class, key, hash, place) of every segment of a task's texts."""
    for batch in batches:
        keys = batch["key"].to_numpy(zero_copy_only=False)
        told = batch["hash"].to_numpy(zero_copy_only=False)
        for parts, data, ends in _pieces(batch):
            first, count, least = segments(data, ends)
            if not len(first):
                continue
            view = memoryview(data)
            stops = first + count + LENGTH - 1
            hashes = [
                xxhash.xxh3_64_intdigest(view[a:b])
                for a, b in zip(first.tolist(), stops.tolist(), strict=True)
            ]
            text = np.searchsorted(ends, first, side="right")
            row, offset, opening = np.array(parts).T[:, text]
            begin = np.concatenate([[0], ends[:-1]])[text]
            start = first - begin + offset
            before = np.where(first > begin, data[first - 1].astype(np.int64) + 1, opening)
            place = (start << (COUNT_BITS + BEFORE_BITS)) | (count << BEFORE_BITS) | before
            kinds = np.array(hashes, np.uint64).view(np.int64)
            columns = [least.view(np.int64), kinds, keys[row], told[row], place]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], ["bucket", "class", "key", "hash", "place"]
            )


def _start(place: str = "place"):
    return F.shiftright(place, COUNT_BITS + BEFORE_BITS)


def _count(place: str = "place"):
    return F.shiftright(place, BEFORE_BITS).bitwiseAND(F.lit((1 << COUNT_BITS) - 1))


def _before(place: str = "place"):
    return F.col(place).bitwiseAND(F.lit((1 << BEFORE_BITS) - 1))


def maximal_repeats(texts: list[bytes], counts: list[int], least: int = LENGTH) -> list[tuple[int, list[tuple[int, int]]]]:
    """Maximal repeats of a bucket: (length, [(text, offset), ...]) with all occurrences.

    Suffixes start at the first ``counts[i]`` offsets of text i. The first one
    counts as preceded by a byte of its own, so a repeat that opens a text is
    always given.
    """
    where = [(i, at) for i, n in enumerate(counts) for at in range(n)]
    left = [0 if at == 0 else texts[i][at - 1] + 1 for i, at in where]
    found = _intervals([texts[i][at:] for i, at in where], left, least)
    return [(depth, [where[k] for k in members]) for depth, members in found]


def _intervals(suffixes: list[bytes], before: list[int], least: int = LENGTH) -> list[tuple[int, list[int]]]:
    """(depth, suffixes) of the maximal repeats that open some of the suffixes.

    ``before`` has the byte before each suffix plus one; 0, the opening of a
    text, differs from all others.
    """
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    found = []
    # Open intervals: depth, first suffix, the byte before all of them (None: they differ).
    stack: list[list] = []
    left = [before[k] or None for k in order]
    for rank in range(1, len(order) + 1):
        depth = 0
        if rank < len(order):
            a, b = suffixes[order[rank - 1]], suffixes[order[rank]]
            if a[:least] == b[:least] and min(len(a), len(b)) >= least:
                depth = least + _common(a, b, least)
        first, same = rank - 1, left[rank - 1]
        while stack and stack[-1][0] > depth:
            deep, low, byte = stack.pop()
            byte = byte if byte == same else None
            if byte is None:
                found.append((deep, order[low:rank]))
            first, same = low, byte
        if depth and stack and stack[-1][0] == depth:
            stack[-1][2] = stack[-1][2] if stack[-1][2] == same else None
        elif depth:
            stack.append([depth, first, same])
    return found


def _common(a: bytes, b: bytes, start: int) -> int:
    """Bytes that two strings share from ``start`` on."""
    low, high = start, min(len(a), len(b))
    if a[start:high] == b[start:high]:
        return high - start
    while high - low > 1:
        middle = (low + high) // 2
        if a[start:middle] == b[start:middle]:
            low = middle
        else:
            high = middle
    return low - start


STRETCHES = "bucket bigint, class bigint, offset int, length int"


def _stretches(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    names = ["bucket", "class", "offset", "length"]
    columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names)


def _spans(groups: list[tuple[int, list[tuple[int, int]]]]) -> Iterator[tuple[int, int, int]]:
    """(text, offset, length) of the stretches of each text that the groups cover together."""
    ends: dict[int, dict[int, int]] = {}
    for length, members in groups:
        for i, at in members:
            of = ends.setdefault(i, {})
            of[at] = max(of.get(at, 0), at + length)
    for i, of in ends.items():
        begin = stop = -1
        for at in sorted(of):
            if at > stop:
                if stop >= 0:
                    yield i, begin, stop - begin
                begin, stop = at, of[at]
            stop = max(stop, of[at])
        yield i, begin, stop - begin


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches that the repeats of a task's buckets, which come one after another, cover in each class."""

    def settle(bucket: int, rows: list) -> list[tuple]:
        groups = maximal_repeats([r[2] for r in rows], [r[1] for r in rows])
        return [(bucket, rows[i][0], at, length) for i, at, length in _spans(groups)]

    now, rows, out = None, [], []
    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("bucket", "class", "count", "bytes"))
        for bucket, *rest in zip(*columns, strict=True):
            if bucket != now and rows:
                out += settle(now, rows)
                rows = []
                if len(out) > 10_000:
                    yield _stretches(out)
                    out = []
            now = bucket
            rows.append(rest)
    if rows:
        out += settle(now, rows)
    if out:
        yield _stretches(out)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, class, offset, copies, window hash, byte before plus one) of every window of some classes.

    The byte before a class is not known here: -1.
    """
    names = ["bucket", "class", "offset", "copies", "window", "before"]
    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("bucket", "class", "count", "bytes", "copies"))
        for bucket, klass, count, data, copies in zip(*columns, strict=True):
            hashes = [xxhash.xxh3_64_intdigest(data[at : at + LENGTH]) for at in range(count)]
            window = pa.array(np.array(hashes, np.uint64).view(np.int64))
            before = pa.array([-1, *(byte + 1 for byte in data[: count - 1])], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket] * count, pa.int64()), pa.array([klass] * count, pa.int64()),
                 pa.array(range(count), pa.int32()), pa.array([copies] * count, pa.int64()), window, before], names,
            )


WINDOWS = "bucket bigint, class bigint, offset int, copies bigint, window bigint, before int"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the wanted segments of each text."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
    names = ["bucket", "class", "count", "copies", "bytes"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names)

    for batch in batches:
        rows = []
        for text, wanted in zip(batch["text"], batch["wanted"], strict=True):
            data = text.as_py().encode("utf-8")
            for w in wanted.as_py():
                some = data[w["start"] : w["start"] + w["count"] + LENGTH - 1]
                rows.append((w["bucket"], w["class"], w["count"], w["copies"], some))
            if len(rows) > 10_000:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)


def _merged(packed: list[int]) -> tuple[list[int], list[int]]:
    """Begins and ends of the stretches that packed spans cover together."""
    begins, ends = [], []
    for begin, length in sorted((p >> 20, p & ((1 << 20) - 1)) for p in packed):
        if not ends or begin > ends[-1]:
            begins.append(begin)
            ends.append(begin + length)
        ends[-1] = max(ends[-1], begin + length)
    return begins, ends


PLACES = "node bigint, key bigint, hash bigint, start bigint, before int, copies bigint, depth bigint, reach bigint"
TAILS = "node bigint, key bigint, hash bigint, start bigint, before int, depth bigint, reach bigint, block bigint, tail binary"
SHARED = "node bigint, key bigint, hash bigint, start bigint, before int, reach bigint, shared bigint, next int"
MEMBERS = "key bigint, hash bigint, start bigint, length bigint, bucket bigint, repeat bigint"
KINDS = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    columns = [pa.array([r[k] for r in rows], KINDS[kind]) for k, (_, kind) in enumerate(fields)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def _reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of texts with the bytes left to them in their covered stretch."""
    for batch in batches:
        for key, told, wanted, spans in zip(*(batch[c].to_pylist() for c in ("key", "hash", "wanted", "spans")), strict=True):
            begins, ends = _merged(spans)
            rows = [
                (w["node"], key, told, w["start"], w["before"], w["copies"], 0,
                 ends[bisect_right(begins, w["start"]) - 1] - w["start"])
                for w in wanted
            ]
            yield _rows(rows, PLACES)


def _tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of each place from its depth on, a block of them at most."""
    for batch in batches:
        for key, told, text, wanted in zip(batch["key"], batch["hash"], batch["text"], batch["wanted"], strict=True):
            data, rows, size = text.as_py().encode("utf-8"), [], 0
            for w in wanted.as_py():
                some = data[w["start"] + w["depth"] : w["start"] + min(w["reach"], w["depth"] + w["block"])]
                rows.append((w["node"], key.as_py(), told.as_py(), w["start"], w["before"], w["depth"],
                             w["reach"], w["block"], some))
                size += len(some)
                if size > PIECE:
                    yield _rows(rows, TAILS)
                    rows, size = [], 0
            if rows:
                yield _rows(rows, TAILS)


def _sorted_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of the maximal repeats of a task's nodes, which come one after another."""

    def settle(node: int, rows: list) -> Iterator[pa.RecordBatch]:
        out = []
        for n, (length, members) in enumerate(_intervals([r[4] for r in rows], [r[3] for r in rows])):
            out += [(*rows[k][:3], length, node, n) for k in members]
            if len(out) > 10_000:
                yield _rows(out, MEMBERS)
                out = []
        if out:
            yield _rows(out, MEMBERS)

    now, rows = None, []
    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("node", "key", "hash", "start", "before", "tail"))
        for node, *rest in zip(*columns, strict=True):
            if node != now and rows:
                yield from settle(now, rows)
                rows = []
            now = node
            rows.append(rest)
    if rows:
        yield from settle(now, rows)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many bytes each place shares with its node's leader, and what comes next.

    ``next`` is the next byte plus one, 0 where the place's stretch ends and 257
    where the whole block is shared and both may go on.
    """
    for batch in batches:
        rows = []
        columns = ("node", "key", "hash", "start", "before", "reach", "depth", "block", "tail", "leader")
        for *place, depth, block, tail, leader in zip(*(batch[c].to_pylist() for c in columns), strict=True):
            n = _common(tail, leader, 0)
            after = 257 if n == block else tail[n] + 1 if n < len(tail) else 0
            rows.append((*place, depth + n, after))
        yield _rows(rows, SHARED)


class Repeats:
    """The staged tables of one run: survivors (segments) and classes, and what follows from them."""

    def __init__(self, docs: DataFrame):
        width = shuffle_width(docs.sparkSession)
        self.texts = docs.select(
            F.coalesce("doc_id", F.lit(NO_ID)).alias("key"),
            text_hash().alias("hash"),
            whole_text().alias("text"),
        )
        light = self.texts.mapInArrow(_light, "bucket bigint, class bigint, key bigint, hash bigint, place bigint")
        often = light.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        self.segments = staged(light.join(often.select("bucket"), "bucket"), "repeat-segments")
        classes = self.segments.groupBy("bucket", "class").agg(
            F.count(F.lit(1)).alias("copies"), F.min(F.struct("key", "hash", "place")).alias("one")
        )
        self.classes = staged(classes.select("bucket", "class", "copies", "one.*"), "repeat-classes")
        self.width = width

    def _stretches(self) -> DataFrame:
        """What repeats cover of each class: (bucket, class, offset, length)."""
        whole = self.classes.where("copies > 1").select(
            "bucket", "class", F.lit(0).alias("offset"),
            (_count() + F.lit(LENGTH - 1)).cast("int").alias("length"),
        )
        buckets = (
            self.classes.groupBy("bucket")
            .agg(F.count(F.lit(1)).alias("classes"), F.min("copies").alias("least"))
            .where("classes > 1 AND least = 1")
        )
        wanted = self._wanted(self.classes.join(buckets, "bucket"), "classes")
        small = self._fetched(wanted.where(F.col("w.classes") <= CLASSES))
        sorted_groups = (
            small.repartition(self.width, "bucket")
            .sortWithinPartitions("bucket")
            .mapInArrow(_sorted_buckets, STRETCHES)
        )
        large = staged(self._fetched(wanted.where(F.col("w.classes") > CLASSES)), "repeat-large")
        windows = large.mapInArrow(_windows, WINDOWS)
        twice = windows.groupBy("bucket", "window").agg(F.sum("copies").alias("n")).where("n > 1")
        counted = windows.join(twice, ["bucket", "window"]).select(
            "bucket", "class", "offset", F.lit(LENGTH).alias("length")
        )
        return whole.unionByName(sorted_groups).unionByName(counted)

    @staticmethod
    def _wanted(classes: DataFrame, *more: str) -> DataFrame:
        """The place of one copy of each class, and what the class carries."""
        return classes.select(
            "key", "hash",
            F.struct(
                "bucket", "class", "copies", *more,
                _start().alias("start"), _count().cast("int").alias("count"),
            ).alias("w"),
        )

    def _fetched(self, wanted: DataFrame) -> DataFrame:
        """One copy of the bytes of the wanted classes; a text is read for all of its own."""
        by_text = wanted.groupBy("key", "hash").agg(F.collect_list("w").alias("wanted"))
        found = self.texts.join(by_text, ["key", "hash"])
        # Rows equal in id and text each give the same bytes: one of them is enough.
        return found.mapInArrow(
            _cut, "bucket bigint, class bigint, count int, copies bigint, bytes binary"
        ).dropDuplicates(["bucket", "class"])

    def _covered(self) -> DataFrame:
        """Packed spans that repeats cover of each text: key, hash, spans."""
        found = self.segments.join(self._stretches(), ["bucket", "class"])
        start = _start() + F.col("offset")
        return found.groupBy("key", "hash").agg(
            F.collect_set(F.shiftleft(start, 20) + F.col("length")).alias("spans")
        )

    def _places(self) -> DataFrame:
        """Places of the windows that can open a maximal repeat, in nodes of one window."""
        fetched = staged(self._fetched(self._wanted(self.classes)), "repeat-bytes")
        windows = fetched.mapInArrow(_windows, WINDOWS)
        edges = self.segments.groupBy("bucket", "class").agg(
            F.min(_before()).alias("low"), F.max(_before()).alias("high")
        )
        known = [F.when(F.col("before") < 0, F.col(c)).otherwise(F.col("before")).alias(c) for c in ("low", "high")]
        heads = (
            windows.join(edges, ["bucket", "class"])
            .select("bucket", "window", "copies", *known)
            .groupBy("bucket", "window")
            .agg(F.sum("copies").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
            .where("n > 1 AND (low = 0 OR low < high)")
            .select("bucket", "window")
        )
        own = windows.join(heads, ["bucket", "window"]).drop("copies")
        before = F.when(F.col("before") < 0, _before()).otherwise(F.col("before")).cast("int")
        places = (
            self.segments.join(own, ["bucket", "class"])
            .select(
                F.col("window").alias("node"), "key", "hash",
                (_start() + F.col("offset")).alias("start"), before.alias("before"),
            )
            .groupBy("node", "key", "hash", "start", "before")
            .agg(F.count(F.lit(1)).alias("copies"))
        )
        by_text = places.groupBy("key", "hash").agg(
            F.collect_list(F.struct("node", "start", "before", "copies")).alias("wanted")
        )
        return by_text.join(self._covered(), ["key", "hash"]).mapInArrow(_reached, PLACES)

    def _suffixes(self, places: DataFrame) -> DataFrame:
        """Bytes of the places, once for each row of their text."""
        by_text = places.groupBy("key", "hash").agg(
            F.collect_list(F.struct("node", "start", "before", "depth", "reach", "block")).alias("wanted")
        )
        return self.texts.join(by_text, ["key", "hash"]).mapInArrow(_tails, TAILS)

    def occurrences(self) -> DataFrame:
        """Every occurrence of every maximal repeat: key, hash, start, length, bucket, repeat.

        A group is named by ``bucket`` and ``repeat``. A document that comes as
        several equal rows has a row for each.
        """
        groups = []
        places = staged(self._places(), "repeat-places")
        while True:
            nodes = (
                places.groupBy("node")
                .agg(
                    F.sum("copies").alias("n"), F.sum(F.col("copies") * F.col("reach")).alias("size"),
                    F.min("before").alias("low"), F.max("before").alias("high"),
                )
                .where("n > 1 AND (low = 0 OR low < high)")
                .select(
                    "node", ((F.col("n") <= CLASSES) & (F.col("size") <= NODE_BYTES)).alias("small"),
                    F.greatest(F.lit(BLOCK), F.floor(F.lit(NODE_BYTES) / F.col("n"))).alias("block"),
                )
            )
            open_ = staged(places.join(nodes, "node"), "repeat-nodes")
            whole = open_.where("small").withColumns({"depth": F.lit(0), "block": F.col("reach")})
            groups.append(
                self._suffixes(whole)
                .repartition(self.width, "node")
                .sortWithinPartitions("node")
                .mapInArrow(_sorted_nodes, MEMBERS)
            )
            large = open_.where("NOT small")
            if large.isEmpty():
                break
            shared = self._along_leaders(large)
            groups.append(self._branches(shared))
            further = shared.where("next > 0").groupBy(
                F.xxhash64("node", "shared", "next").alias("node"), "key", "hash", "start", "before",
                F.col("shared").alias("depth"), "reach",
            )
            further = further.agg(F.count(F.lit(1)).alias("copies"))
            places = staged(further.select(*places.columns), "repeat-places")
        return reduce(DataFrame.unionByName, groups)

    def _along_leaders(self, places: DataFrame) -> DataFrame:
        """Places of large nodes with the bytes they share with one suffix of their node."""
        tails = staged(self._suffixes(places), "repeat-tails")
        drawn = F.xxhash64("key", "hash", "start", "depth")
        leaders = tails.groupBy("node").agg(F.min_by("tail", drawn).alias("leader"))
        return staged(tails.join(leaders, "node").mapInArrow(_compared, SHARED), "repeat-shared")

    @staticmethod
    def _branches(shared: DataFrame) -> DataFrame:
        """Members of the groups along the leaders: all places that share a depth where one leaves."""
        depths = shared.groupBy("node", "shared").agg(
            F.count(F.lit(1)).alias("n"), F.min("before").alias("low"), F.max("before").alias("high"),
            F.max(F.col("next") < 257).alias("leaves"),
        )
        deeper = Window.partitionBy("node").orderBy(F.desc("shared"))
        found = (
            depths.select(
                "node", F.col("shared").alias("length"), "leaves", F.sum("n").over(deeper).alias("n"),
                F.min("low").over(deeper).alias("low"), F.max("high").over(deeper).alias("high"),
            )
            .where(f"leaves AND length >= {LENGTH} AND n > 1 AND (low = 0 OR low < high)")
            .select("node", "length")
        )
        return shared.join(found, "node").where("shared >= length").select(
            "key", "hash", "start", "length", F.col("node").alias("bucket"), (-F.col("length")).alias("repeat")
        )

    def cleaned(self, keep_text: bool = False) -> DataFrame:
        """Per document what is removed and the digest of what is left; with ``kept`` bytes if asked for."""
        spans = self._covered()
        names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_text
        kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * keep_text

        def row(key: int, text: str, packed: list[int] | None) -> tuple:
            data = text.encode("utf-8")
            ends, kept, removed, at = 0, [], 0, 0
            n = 0
            for start, length in sorted((p >> 20, p & ((1 << 20) - 1)) for p in packed or []):
                if start > at or not n:
                    kept.append(data[at:start])
                    n += 1
                    at = start
                ends = start + length
                if ends > at:
                    removed += ends - at
                    at = ends
            kept.append(data[at:])
            left = b"".join(kept)
            digest = hashlib.sha256(left).hexdigest()
            return (key, len(data), removed, n, digest) + ((left,) if keep_text else ())

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    row(key.as_py(), text.as_py(), packed.as_py())
                    for key, text, packed in zip(batch["key"], batch["text"], batch["spans"], strict=True)
                ]
                columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(columns, names)

        schema = "key bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
        joined = self.texts.join(spans, ["key", "hash"], "left")
        cleaned = joined.mapInArrow(clean, schema + ", kept binary" * keep_text)
        doc_id = F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id")
        return cleaned.select(doc_id, *names[1:])


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return Repeats(docs).cleaned(keep_text)
