"""Language-model scores of whole documents: a trained recurrent model beside a unigram base.

Learning documents are those whose crc32 of the id, as text, leaves a remainder
other than ``HELD_OUT`` by ``FOLDS``. All of them are learned from once: each
round takes a part of them, every task goes through its share by truncated
backpropagation from the common parameters, and the parameters are averaged by
tokens. The model knows a bounded number of frequent words; the words of its
rarer class are weighed by their learning counts, one added.

Those counts grow with the corpus and never meet in one place: tasks send the
64-bit hashes of their documents' rarer words, packed by hash range, to the
range's task, which counts the learning ones and sends each word's count back
to its chunk of documents. Ranges are as many as the corpus needs to keep one
small.

A null text counts as empty: one end token. A null id is not held out. Rows that
repeat in id and text have the same scores. Without learning documents the
model stays as drawn and the base is that of unseen tokens. Other columns are
ignored.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections import Counter
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lunario.llm import recurrent
from lunario.llm.common import shuffle_width, staged, whole_text

FOLDS, HELD_OUT = 7, 2
#: Ids of the model: the end and the frequent words.
KNOWN = 1024
#: Words that a task's search for frequent ones counts at least; it sends the ``SENT * KNOWN`` first.
COUNTERS = 1 << 19
SENT = 4
SUMMARY = "word string, n bigint, texts bigint"
#: Tasks' parameters are averaged in groups first.
MERGE_GROUPS = 64
ROUNDS = 2
#: Tokens that a task lays out in lanes at once.
CHUNK = 1 << 21
#: Hashes that a range may hold, and ranges at least.
RANGE_HASHES = 1 << 19
#: Values per row when parameters are averaged.
PIECE = 4096


def _marked(docs: DataFrame) -> DataFrame:
    crc = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    return docs.select(
        "doc_id",
        whole_text().alias("text"),
        F.coalesce(F.pmod(crc, F.lit(FOLDS)) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.pmod(F.coalesce(crc, F.lit(0)) / FOLDS, F.lit(ROUNDS)).cast("int").alias("round"),
    )


def _words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased; both rules of ``bytes`` know ASCII alone."""
    return text.lower().split()


def _without_rarest(table: Counter) -> Counter:
    """One Misra-Gries step for many words at once: the count of rank ``COUNTERS`` + 1 is taken off all."""
    counts = np.fromiter(table.values(), np.int64, len(table))
    off = int(np.partition(counts, len(counts) - COUNTERS - 1)[len(counts) - COUNTERS - 1])
    return Counter({word: n - off for word, n in table.items() if n > off})


def _summaries(learning: DataFrame, known: int) -> DataFrame:
    """(word, n, texts): frequent words of each task, and its tokens and texts in a row without word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, texts, tokens = Counter(), 0, 0
        for batch in batches:
            for text in batch["text"].cast(pa.binary()):
                words = _words(text.as_py())
                table.update(words)
                texts, tokens = texts + 1, tokens + len(words)
                if len(table) > 2 * COUNTERS:
                    table = _without_rarest(table)
        top = heapq.nsmallest(SENT * known, table.items(), key=lambda item: (-item[1], item[0]))
        out = [(word.decode("utf-8"), n, 0) for word, n in top] + [(None, tokens, texts)]
        yield _batch(out, SUMMARY)

    return learning.select("text").mapInArrow(count, SUMMARY)


def frequent_words(learning: DataFrame, known: int = KNOWN) -> tuple[list[str], list[int], int, int]:
    """The ``known - 1`` most frequent words or fewer, their estimated counts, all words and all texts."""
    parts = staged(_summaries(learning, known), "lm-words")
    total = parts.where("word IS NULL").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")).first()
    top = (
        parts.where("word IS NOT NULL")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(known - 1)
        .collect()
    )
    return [r["word"] for r in top], [r["n"] for r in top], total["n"] or 0, total["texts"] or 0


def _ids(text: bytes, index: dict[bytes, int], known: int) -> tuple[np.ndarray, list[bytes]]:
    """Model ids of a text, its end included, and its words."""
    words = _words(text)
    ids = np.zeros(len(words) + 1, np.int32)
    ids[:-1] = np.fromiter(map(index.get, words, repeat(known)), np.int32, len(words))
    return ids, words


def _index(words: list[str]) -> dict[bytes, int]:
    return {w.encode("utf-8"): i for i, w in enumerate(words, start=1)}


def _chunks(batches: Iterator[pa.RecordBatch], index: dict, known: int, rare: bool) -> Iterator[list]:
    """(doc_id, held_out, ids, hashes) of rows in lists of about ``CHUNK`` tokens.

    Asked for ``rare``, rows have their marks and the hashes of their rarer words.
    A text is never cut; no row holds on to its batch.
    """
    rows, tokens = [], 0
    for batch in batches:
        for i, text in enumerate(batch["text"].cast(pa.binary())):
            ids, words = _ids(text.as_py(), index, known)
            doc_id = held_out = hashes = None
            if rare:
                some = compress(words, (ids == known).tolist())
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, some), np.uint64)
                doc_id, held_out = batch["doc_id"][i].as_py(), batch["held_out"][i].as_py()
            rows.append((doc_id, held_out, ids, hashes))
            tokens += len(ids)
            if tokens >= CHUNK:
                yield rows
                rows, tokens = [], 0
    if rows:
        yield rows


def _train(learning: DataFrame, words: list[str], known: int, start: np.ndarray) -> DataFrame:
    """(piece, tokens, values): parameters after each task's share, in pieces; piece -1 has counts."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, model = _index(words), recurrent.Recurrent(known)
        model.load(start)
        trainer, tokens = recurrent.Trainer(model), 0
        counts = np.zeros(known + 1, dtype=np.float64)
        for rows in _chunks(batches, index, known, rare=False):
            texts = [ids for _, _, ids, _ in rows]
            trainer.fit(texts)
            ids = np.concatenate(texts)
            counts += np.bincount(ids, minlength=known + 1)
            tokens += len(ids)
        if not tokens:
            return
        values = model.flat().astype(np.float64)
        pieces = [values[i : i + PIECE] for i in range(0, len(values), PIECE)]
        names = ["piece", "tokens", "values"]
        for piece, some in [(-1, counts), *enumerate(pieces)]:
            yield pa.RecordBatch.from_arrays(
                [pa.array([piece], pa.int32()), pa.array([tokens], pa.int64()),
                 pa.array([some.tobytes()], pa.binary())], names,
            )

    return learning.select("text").mapInArrow(fit, "piece int, tokens bigint, values binary")


def _combined(pieces: DataFrame) -> DataFrame:
    """Sums counts and averages parameters by tokens, first within groups of tasks."""

    def join(frame):
        tokens = frame["tokens"].to_numpy()
        total = 0.0
        for values, n in zip(frame["values"], tokens, strict=True):
            part = np.frombuffer(values, dtype=np.float64)
            total = total + (part if frame["piece"].iloc[0] < 0 else part * (n / tokens.sum()))
        first = frame.head(1).copy()
        first["tokens"], first["values"] = tokens.sum(), [total.tobytes()]
        return first[["piece", "tokens", "values"]]

    schema = "piece int, tokens bigint, values binary"
    grouped = pieces.withColumn("g", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    return (
        grouped.groupBy("piece", "g")
        .applyInPandas(join, schema)
        .groupBy("piece")
        .applyInPandas(join, schema)
    )


def train(docs: DataFrame, known: int = KNOWN) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Frequent words, parameters, and counts by model id over all learning documents."""
    learning = _marked(docs).where(~F.col("held_out"))
    words, estimates, n_words, n_texts = frequent_words(learning, known)
    model = recurrent.Recurrent(known)
    if words:
        around = np.zeros(known)
        around[0] = n_texts
        around[1 : len(words) + 1] = estimates
        model.set_biases(around, max(1.0, n_words - sum(estimates)))
    values, counts = model.flat(), np.zeros(known + 1)
    for number in range(ROUNDS):
        part = learning.where(F.col("round") == number)
        found = {r["piece"]: r for r in _combined(_train(part, words, known, values)).collect()}
        if found:
            counts += np.frombuffer(found.pop(-1)["values"], dtype=np.float64)
            ordered = [np.frombuffer(found[k]["values"]) for k in sorted(found)]
            values = np.concatenate(ordered)
    return words, values, counts


def _packed(values, kind) -> bytes:
    return np.asarray(values, dtype=kind).tobytes()


#: Rows of documents have range -1; rows of words have the places of their documents in the chunk.
PARTS = "range int, chunk bigint, places binary, hashes binary, documents binary"


def _scored(docs: DataFrame, words: list[str], values: np.ndarray, counts: np.ndarray, ranges: int) -> DataFrame:
    """Chunks of documents with their model scores, and their rarer words by hash range.

    A chunk is named by its task and number, which a task that runs again gives
    alike, so rows that repeat stay apart without being compared.
    """
    known = len(counts) - 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, model = _index(words), recurrent.Recurrent(known)
        model.load(values)
        log_counts = np.log10(counts + 1)
        log_counts[known] = 0.0
        seen = counts > 0
        seen[known] = False
        task = TaskContext.get().partitionId()
        for number, rows in enumerate(_chunks(batches, index, known, rare=True)):
            scores = recurrent.score(model, [ids for _, _, ids, _ in rows]) / math.log(10)
            chunk = (task << 32) | number
            documents = [
                (doc_id, held_out, len(ids), float(one),
                 float(log_counts[ids].sum()), int(seen[ids].sum()), len(rare))
                for (doc_id, held_out, ids, rare), one in zip(rows, scores, strict=True)
            ]
            out = [(-1, chunk, None, None, pickle.dumps(documents))]
            places = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[3]) for r in rows])
            hashes = np.concatenate([r[3] for r in rows])
            # The held-out mark travels as the sign of the place.
            held = np.array([d[1] for d in documents], dtype=bool)[places]
            places = np.where(held, -1 - places, places)
            into = (hashes % np.uint64(ranges)).astype(np.int32)
            order = np.argsort(into, kind="stable")
            cuts = np.flatnonzero(np.diff(into[order], prepend=-1))
            for some in np.split(order, cuts[1:]) if len(order) else []:
                out.append(
                    (int(into[some[0]]), chunk, _packed(places[some], "<i4"), _packed(hashes[some], "<u8"), None)
                )
            yield _batch(out, PARTS)

    return docs.select("doc_id", "text", "held_out").mapInArrow(score, PARTS)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = [pa.array([r[k] for r in rows], kinds[t]) for k, t in enumerate(types)]
    return pa.RecordBatch.from_arrays(columns, list(names))


COUNTED = "chunk bigint, places binary, times binary, documents binary, distinct bigint, learned bigint"


def _counted(parts: DataFrame, ranges: int) -> DataFrame:
    """Learning counts of every rarer word, sent back to its chunk.

    A task holds the packed hashes of one range at a time, about ``RANGE_HASHES``.
    A row without chunk tells the distinct and all learned hashes of a range.
    """

    def count(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        places = [np.frombuffer(r[2], dtype="<i4") for r in rows]
        hashes = np.concatenate([np.frombuffer(r[3], dtype="<u8") for r in rows])
        learning = np.concatenate(places) >= 0
        learned, times = np.unique(hashes[learning], return_counts=True)
        found = np.zeros(len(hashes), dtype=np.int64)
        if len(learned):
            at = np.minimum(np.searchsorted(learned, hashes), len(learned) - 1)
            found = np.where(learned[at] == hashes, times[at], 0)
        ends = np.cumsum([len(p) for p in places])
        out = [
            (r[1], r[2], _packed(some, "<i8"), None, 0, 0)
            for r, some in zip(rows, np.split(found, ends[:-1]), strict=True)
        ]
        out.append((None, None, None, None, len(learned), int(times.sum())))
        yield _batch(out, COUNTED)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            names = [c.split()[0] for c in PARTS.split(", ")]
            for r in zip(*(batch[c].to_pylist() for c in names), strict=True):
                if r[0] < 0:
                    yield _batch([(r[1], None, None, r[4], 0, 0)], COUNTED)
                    continue
                if rows and r[0] != rows[0][0]:
                    yield from count(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield from count(rows)

    # Rows of documents are dealt by chunk, rows of words by their range.
    placed = F.when(F.col("range") < 0, F.pmod(F.xxhash64("chunk"), F.lit(ranges))).otherwise(F.col("range"))
    return (
        parts.repartition(ranges, placed.cast("int"))
        .sortWithinPartitions("range")
        .mapInArrow(task, COUNTED)
    )


SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _finished(counted: DataFrame, tokens: int, base: float, within: float) -> DataFrame:
    """Scores of the documents of each chunk, from the counts of their rarer words."""

    def finish(rows: list[tuple]) -> pa.RecordBatch:
        documents = next(pickle.loads(r[2]) for r in rows if r[2] is not None)
        logs, seen = np.zeros(len(documents)), np.zeros(len(documents))
        for _, places, _, times in ((r[0], r[1], r[2], r[3]) for r in rows if r[2] is None):
            place = np.frombuffer(places, dtype="<i4")
            place = np.where(place < 0, -1 - place, place)
            c = np.frombuffer(times, dtype="<i8")
            logs += np.bincount(place, weights=np.log10(c + 1.0), minlength=len(documents))
            seen += np.bincount(place, weights=c > 0, minlength=len(documents))
        return _batch(
            [
                (doc_id, held, n, known + int(s), tokens, log + rare_log - n * base,
                 model + rare_log - rare * within)
                for (doc_id, held, n, model, log, known, rare), rare_log, s in zip(documents, logs.tolist(), seen, strict=True)
            ],
            SCORES,
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for r in zip(*(batch[c].to_pylist() for c in ("chunk", "places", "documents", "times")), strict=True):
                if rows and r[0] != rows[0][0]:
                    yield finish(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield finish(rows)

    width = shuffle_width(counted.sparkSession)
    return (
        counted.where("chunk IS NOT NULL")
        .select("chunk", "places", "documents", "times")
        .repartition(width, "chunk")
        .sortWithinPartitions("chunk")
        .mapInArrow(task, SCORES)
    )


def scores(docs: DataFrame, known: int = KNOWN) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    words, values, counts = train(docs, known)
    tokens = int(counts.sum())
    ranges = max(shuffle_width(docs.sparkSession), math.ceil(counts[known] / RANGE_HASHES))
    counted = staged(_counted(_scored(_marked(docs), words, values, counts, ranges), ranges), "lm-counts")
    rare = counted.where("chunk IS NULL").agg(
        F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("learned"), F.lit(0))
    ).first()
    distinct = int((counts[:known] > 0).sum()) + rare[0]
    base = math.log10(tokens + distinct + 1)
    within = math.log10(rare[1] + rare[0] + 1)
    return _finished(counted, tokens, base, within)
