"""Document fingerprints: bottom-k sketches of five-word shingles, in DataFrame functions only.

A sketch is the sorted array of the ``K`` smallest distinct 64-bit hashes of a
text's shingles. Sketches of parts merge into the sketch of the whole
(``merged``), and two sketches estimate resemblance, containment and the number
of distinct shingles; all are exact below ``K`` shingles.

A null text counts as empty and has the empty sketch; a text of one to four
words has one shingle, the whole sequence. Two empty sketches are alike (1), an
empty and another one are not (0). Equal texts have equal sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lunario.llm.common import NO_ID, staged, whole_text, with_next, words_of

SHINGLE = 5
#: Hashes kept; the standard error of a resemblance r is sqrt(r (1 - r) / K).
K = 64


def _shingle_hashes(words: Column) -> Column:
    count = F.size(words)
    positions = F.sequence(F.lit(1), F.greatest(count - (SHINGLE - 1), F.lit(1)))
    hashes = F.transform(positions, lambda i: F.xxhash64(F.slice(words, i, SHINGLE)))
    return F.when(count > 0, hashes).otherwise(F.array().cast("array<bigint>"))


def sketch_of(words: Column, k: int = K) -> Column:
    """Bottom-k sketch of an array of words."""
    return F.slice(F.sort_array(F.array_distinct(_shingle_hashes(words))), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of the shingle sets of two sketches."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merged_parts(parts: DataFrame, key: str, sketch: str = "sketch", k: int = K) -> DataFrame:
    """Sketches of documents from sketches of their parts: one row per ``key``.

    Hashes are combined by distinct aggregation, so a document of many parts
    is not gathered in one array before it is cut to ``k``.
    """
    from pyspark.sql.window import Window

    hashes = parts.select(key, F.explode(sketch).alias("h")).distinct()
    smallest = hashes.withColumn(
        "n", F.row_number().over(Window.partitionBy(key).orderBy("h"))
    ).where(F.col("n") <= k)
    found = smallest.groupBy(key).agg(F.sort_array(F.collect_list("h")).alias(sketch))
    empty = F.array().cast("array<bigint>")
    return (
        parts.select(key).distinct().join(found, key, "left")
        .withColumn(sketch, F.coalesce(sketch, empty))
    )


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all shingles of two texts."""
    union = merged(a, b, k)
    common = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below ``k``, else from the k-th smallest hash."""
    rank = (F.element_at(sketch, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    estimate = F.lit(float(k - 1)) / rank
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise(estimate)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that are also in ``b``."""
    both = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    share = F.least(both / distinct_shingles(a, k), F.lit(1.0))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(share)


def printed(sketch: Column) -> Column:
    """The sketch as text: 16 hex digits per hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """Adds nothing but: one row per document with its sketch, size and distinct shingle count."""
    return (
        docs.select("doc_id", whole_text().alias("text"))
        .select("doc_id", "text", words_of(F.col("text")).alias("words"))
        .select(
            "doc_id",
            F.length("text").cast("long").alias("n_chars"),
            sketch_of(F.col("words"), k).alias("sketch"),
        )
    )


def compared_with_next(docs: DataFrame, k: int = K) -> DataFrame:
    """Sketches of each text and of its edited form, and their likeness.

    The edited form replaces the last quarter of a text by the beginning of the
    next document's. Each document is sent to its predecessor as just that
    beginning and its sketch; whole texts are shuffled once, by id. Documents
    that share an id follow the next larger id, which is represented by the
    least (beginning, sketch) among its rows; a null id comes before all others.
    """
    texts = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), whole_text().alias("text")
    )
    sizes = texts.groupBy("key").agg(F.max(F.length("text")).alias("size"))
    ring = staged(
        with_next(sizes, "key").select(
            F.col("next_key").alias("key"),
            F.col("key").alias("to_key"),
            F.floor(F.col("size") / 4).cast("int").alias("share"),
        ),
        "ring",
    )
    sent = (
        texts.join(ring, "key")
        .withColumn("words", words_of(F.col("text")))
        .select(
            F.col("to_key").alias("key"),
            F.struct(
                F.expr("substring(text, 1, share)").alias("head"),
                sketch_of(F.col("words"), k).alias("sketch"),
            ).alias("after"),
        )
        .groupBy("key")
        .agg(F.min("after").alias("after"))
    )
    size = F.length("text")
    cut = F.floor(size / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), size - cut),
        F.substring(F.col("after.head"), F.lit(1), cut),
    )
    both = (
        texts.join(sent, "key")
        .select("key", "text", F.col("after.sketch").alias("next_sketch"), edited.alias("edited"))
        .select(
            "key",
            F.length("text").cast("long").alias("n_chars"),
            F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
            words_of(F.col("text")).alias("words"),
            words_of(F.col("edited")).alias("edited_words"),
            "next_sketch",
        )
        .select(
            "key", "n_chars", "edited_sha256", "next_sketch",
            sketch_of(F.col("words"), k).alias("sketch"),
            sketch_of(F.col("edited_words"), k).alias("edited_sketch"),
        )
    )
    a, b = F.col("sketch"), F.col("edited_sketch")
    return both.select(
        F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"),
        "n_chars",
        "edited_sha256",
        printed(a).alias("fingerprint"),
        printed(b).alias("edited_fingerprint"),
        resemblance(a, b, k).alias("near_edited"),
        resemblance(a, F.col("next_sketch"), k).alias("near_next"),
        containment(a, b, k).alias("contained_in_edited"),
        distinct_shingles(a, k).alias("n_shingles"),
    )
