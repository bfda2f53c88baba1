"""Quality classifier by importance resampling over hashed n-grams.

Two generative models, each one probability per hashed bucket of word unigrams
and bigrams, are counted: the raw model over all documents, the target model
over labelled good ones. A document's log weight is the mean over its n-grams of
log target minus log raw, for a text of ``LENGTH`` n-grams, so that chance does
not add up in long texts; a few neutral n-grams steady short ones. Adding
Gumbel noise and keeping the k largest keys samples k documents in proportion
to their weights, without replacement.

k is the number of documents whose weight reaches the cut that best separates
the labelled documents, so what is unlike the target goes and clean text stays.
The noise is a hash of id and text: reruns agree.

The target model is fitted on one half (by id hash) of the labelled documents,
on ``TARGET_ROWS`` of them at most; the cut is judged on the other half. Raw
counts, weights and sampling cover all documents.
A null or blank text has no n-grams and weight 0. Without labels of both kinds
every document is kept. Repeated rows share weight and key, so ties at the
k-th key are kept together. Other columns are carried by ``resampled`` only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lunario.llm.common import carried, staged, text_hash, whole_text

BUCKETS = 10_000
#: Labelled good documents that the target model is fitted on, at most.
TARGET_ROWS = 50_000
SEED = 20
#: N-grams of the text that a weight stands for, and neutral ones that every text has besides.
LENGTH = 500
NEUTRAL = 50
#: Bins of a histogram pass, and rows that a last bin may hold to be sorted.
BINS = 4096
FINE = 10_000


def ngram_buckets(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of each unigram and bigram of a text, repeats included."""
    hashes = np.array([zlib.crc32(w) for w in text.encode("utf-8").split()], dtype=np.uint64)
    pairs = hashes[:-1] * np.uint64(31) + hashes[1:]
    return (np.concatenate([hashes, pairs]) % np.uint64(buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, target_ids: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Counts per bucket, raw in row 0 and target in row 1; a table of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            for text, good in zip(batch["text"], batch["good"], strict=True):
                one = np.bincount(ngram_buckets(text.as_py(), buckets), minlength=buckets)
                total[0] += one
                if good.as_py():
                    total[1] += one
        some = np.flatnonzero(total[0])
        columns = [pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "raw", "target"])

    marked = docs.select("doc_id", whole_text().alias("text")).join(
        F.broadcast(target_ids.withColumn("good", F.lit(True))), "doc_id", "left"
    )
    counted = (
        marked.select("text", F.coalesce("good", F.lit(False)).alias("good"))
        .mapInArrow(count, "bucket bigint, raw bigint, target bigint")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    )
    found = np.zeros((2, buckets), dtype=np.int64)
    for row in counted.collect():
        found[:, row["bucket"]] = row["raw"], row["target"]
    return found


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """Log target minus log raw probability per bucket, one added to every count."""
    if not counts[1].any():
        return np.zeros(counts.shape[1])
    smooth = counts + 1.0
    logs = np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))
    return logs[1] - logs[0]


def weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """(doc_id, text_hash, n_ngrams, log_weight) per document."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_buckets(text.as_py(), len(ratio)) for text in batch["text"]]
            columns = [
                batch["doc_id"],
                batch["text_hash"],
                pa.array([len(f) for f in found], pa.int64()),
                pa.array(
                    [LENGTH * float(ratio[f].sum()) / (len(f) + NEUTRAL) for f in found],
                    pa.float64(),
                ),
            ]
            names = ["doc_id", "text_hash", "n_ngrams", "log_weight"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", whole_text().alias("text"), text_hash().alias("text_hash")).mapInArrow(
        weigh, "doc_id bigint, text_hash bigint, n_ngrams bigint, log_weight double"
    )


def best_cut(weighed: DataFrame, labels: DataFrame) -> float:
    """Weight that best separates labelled good from bad documents, by balanced accuracy.

    Weights are counted in bins of a few percent (of their inverse hyperbolic
    sine), so the driver receives a table whose size does not follow the input.
    """
    scaled = F.round(F.asinh("log_weight") * 40).cast("int")
    counts = (
        weighed.join(labels.where("quality IS NOT NULL"), "doc_id")
        .groupBy(scaled.alias("bin"))
        .agg(
            F.sum((F.col("quality") == 1).cast("long")).alias("good"),
            F.sum((F.col("quality") == 0).cast("long")).alias("bad"),
        )
        .toPandas()
        .sort_values("bin")
    )
    good, bad = counts["good"].to_numpy(), counts["bad"].to_numpy()
    if not good.sum() or not bad.sum():
        return float("-inf")
    # At each edge: bad ones below it are caught, good ones from it on are kept.
    caught = np.concatenate([[0], np.cumsum(bad)[:-1]]) / bad.sum()
    kept = 1 - np.concatenate([[0], np.cumsum(good)[:-1]]) / good.sum()
    edge = int(np.argmax(caught + kept))
    return float(np.sinh((counts["bin"].to_numpy()[edge] - 0.5) / 40))


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column by histograms of its narrowing range."""
    value = F.col(column)
    low, high = rows.agg(F.min(value), F.max(value)).first()
    while low < high:
        width = (high - low) / BINS
        part = rows.where(value.between(low, high))
        place = F.least(F.floor((value - low) / width), F.lit(BINS - 1)).alias("bin")
        counts = (
            part.groupBy(place)
            .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("a"), F.max(value).alias("b"))
            .orderBy(F.desc("bin"))
            .collect()
        )
        for one in counts:
            if k <= one["n"]:
                break
            k -= one["n"]
        if one["n"] <= FINE:
            last = rows.where(value.between(one["a"], one["b"])).select(column).collect()
            return sorted((r[0] for r in last), reverse=True)[k - 1]
        low, high = one["a"], one["b"]
    return low


def decisions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_ngrams, log_weight, gumbel_key, kept, text_hash."""
    fitted = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(2)) == 0
    good = labels.where("quality = 1 AND toxic = 0 AND doc_id IS NOT NULL").where(fitted)
    target = good.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_ROWS)
    ratio = log_ratio(bucket_counts(docs, target))
    uniform = F.xxhash64("doc_id", "text_hash", F.lit(SEED)) / F.lit(2.0**64) + F.lit(0.5)
    noise = -F.log(-F.log(F.least(F.greatest(uniform, F.lit(1e-18)), F.lit(1 - 1e-16))))
    weighed = staged(
        weights(docs, ratio).withColumn("gumbel_key", F.col("log_weight") + noise), "weights"
    )
    cut = best_cut(weighed, labels.where(~fitted).select("doc_id", "quality"))
    size = weighed.where(F.col("log_weight") >= F.lit(cut)).count()
    total = weighed.count()
    least = kth_largest(weighed, "gumbel_key", size) if 0 < size < total else float("-inf")
    kept = F.col("gumbel_key") >= F.lit(least)
    return weighed.select("doc_id", "n_ngrams", "log_weight", "gumbel_key", kept.alias("kept"), "text_hash")


def resampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the sample keeps, with all their columns."""
    chosen = (
        decisions(docs, labels)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.sum(F.col("kept").cast("int")).alias("copies"), F.count(F.lit(1)).alias("rows")
        )
    )
    return carried(docs, chosen)
