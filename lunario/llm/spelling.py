"""Spelling variants: words one edit apart, found by generation over a reduced alphabet.

Letters are hashed to a few symbols. Two words one edit apart have reduced words
that are equal or one edit apart, so every word generates the full one-edit
neighbourhood of its reduced word, the neighbourhoods are joined with the
reduced vocabulary, and what meets is verified on the original strings. The
number of symbols depends on the length of the word looked for: it is the
smallest with more possible reduced words than the vocabulary has words of that
length, and than ``ROOM``, so the words that meet by chance stay few per word
however large the vocabulary is.

A neighbourhood grows with the square of a word's length in bytes. For words
looked for above ``LONG`` code points another key is used: one edit leaves the
first or the last ``LONG / 2`` code points of both words alike, so words meet
by those and their length, and are verified likewise.

Null and empty texts have no words; a null id counts as an empty string in the
hash that plants variants. Repeated rows count as often as they occur. A word
that is near no other has ``n_near`` 0, no form, and itself as root. Of near
words with equal counts the smallest is the form. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lunario.llm.common import staged, whole_text

# Fixed values of the contract.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
SHORTEST, LEAST, PLANTED = 5, 3, 97
FOLD = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

#: Longest word, in code points, that is looked for by its neighbourhood.
LONG = 40
#: Possible reduced words of one length, at least.
ROOM = 1 << 20
#: Symbols of the reduced alphabets.
SYMBOLS = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Different words that a task counts before it hands them on.
HELD = 400_000
#: Texts above this many code points are read run by run instead of at once.
LARGE = 1 << 20


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, planted: int = PLANTED) -> DataFrame:
    """(word, n): lower-cased runs of letters, one code point lost where the hash says so."""
    # Runs below the shortest word can give none; a longer run is matched whole.
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % shortest)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for key, text in zip(batch["key"].to_pylist(), batch["text"], strict=True):
                text = text.as_py()
                found = runs.findall(text) if len(text) < LARGE else (m[0] for m in runs.finditer(text))
                start = zlib.crc32(key.encode())
                for run, times in Counter(found).items():
                    word = run.lower() if run.isascii() else run.translate(FOLD)
                    hashed = zlib.crc32(word.encode(), start)
                    if hashed % planted == 0:
                        lost = hashed % len(word)
                        word = word[:lost] + word[lost + 1 :]
                        if len(word) < shortest:
                            continue
                    counts[word] += times
                if len(counts) >= HELD:
                    yield handed()
                    counts.clear()
        yield handed()

    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    return (
        docs.select(key.alias("key"), whole_text().alias("text"))
        .mapInArrow(counted, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
    )


def alphabet_sizes(words: DataFrame) -> list[int]:
    """Number of symbols for reduced words of each length from 0 to ``LONG``."""
    size = F.length("word")
    counts = dict(words.where(size <= LONG).groupBy(size.alias("size")).count().collect())
    sizes = [1]
    for length in range(1, LONG + 1):
        room = max(ROOM, counts.get(length, 0))
        fits = (q for q in range(2, len(SYMBOLS)) if q**length >= room)
        sizes.append(next(fits, len(SYMBOLS)))
    return sizes


def _alphabet(size: int) -> str:
    """The symbol of each letter, by the letter's hash."""
    return "".join(SYMBOLS[zlib.crc32(letter.encode()) % size] for letter in LETTERS)


def _reduced(length: Column, sizes: list[int]) -> tuple[Column, Column]:
    """The word in the alphabet for reduced words of ``length``, and that alphabet's symbols."""
    alphabets = F.array(*[F.lit(_alphabet(size)) for size in sizes[1:]])
    symbols = F.array(*[F.lit(SYMBOLS[:size]) for size in sizes[1:]])
    reduced = F.call_function("translate", "word", F.lit(LETTERS), F.element_at(alphabets, length))
    return reduced, F.element_at(symbols, length)


def _spliced(reduced: Column, symbols: Column, lost: int) -> Column:
    """All words with one symbol put in at each place, in place of ``lost`` symbols."""
    places = F.sequence(F.lit(0), F.length(reduced) - lost)
    each = F.split(symbols, "")
    return F.flatten(
        F.transform(
            places,
            lambda place: F.transform(
                each,
                lambda symbol: F.concat(
                    F.substring(reduced, F.lit(1), place), symbol, F.substring(reduced, place + 1 + lost, F.length(reduced))
                ),
            ),
        )
    )


def _shortened(reduced: Column) -> Column:
    """All words with one symbol less."""
    return F.transform(
        F.sequence(F.lit(0), F.length(reduced) - 1),
        lambda place: F.concat(
            F.substring(reduced, F.lit(1), place), F.substring(reduced, place + 2, F.length(reduced))
        ),
    )


def _half_keys(length: Column) -> Column:
    """Keys of a long word: its first and its last code points, with the length looked for."""
    half = LONG // 2
    return F.array(
        F.concat(F.lit("<"), F.substring("word", 1, half), length.cast("string")),
        F.concat(F.lit(">"), F.substring("word", -half, half), length.cast("string")),
    )


def near_words(words: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words one edit apart, once."""
    sizes = alphabet_sizes(words)
    sought = (
        words.withColumn("size", F.length("word"))
        .withColumn("length", F.explode(F.sequence(F.col("size") - 1, F.col("size") + 1)))
        .where(F.col("length") >= shortest)
    )
    short = sought.where(F.col("length") <= LONG)
    reduced, symbols = _reduced(F.col("length"), sizes)
    short = short.withColumn("reduced", reduced).withColumn("symbols", symbols)
    reduced, symbols = F.col("reduced"), F.col("symbols")
    neighbourhood = (
        F.when(F.col("length") < F.col("size"), _shortened(reduced))
        .when(F.col("length") == F.col("size"), _spliced(reduced, symbols, 1))
        .otherwise(_spliced(reduced, symbols, 0))
    )
    probes = short.select("word", "n", F.explode(F.array_distinct(neighbourhood)).alias("key"))
    probes = probes.unionByName(
        sought.where(F.col("length") > LONG).select("word", "n", F.explode(_half_keys(F.col("length"))).alias("key"))
    )
    own, _ = _reduced(F.least(F.length("word"), F.lit(LONG)), sizes)
    keys = F.when(F.length("word") <= LONG, F.array(own)).otherwise(_half_keys(F.length("word")))
    table = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.explode(keys).alias("key"))
    # Long words alike at both ends meet twice; the first meeting counts.
    half = LONG // 2
    again = F.col("key").startswith(">") & (F.substring("word", 1, half) == F.substring("near", 1, half))
    one_edit = F.levenshtein("word", "near", 1) == 1
    return probes.join(table, "key").where(one_edit & ~again).select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the end of the chain, by pointer jumping.

    The count at least doubles with each form, so chains are short and there is no circle.
    """
    found = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = staged(found.join(ahead, "root", "left"), "spelling-roots")
        found = jumped.select("word", F.coalesce("further", "root").alias("root"))
        if jumped.where("further IS NOT NULL").isEmpty():
            return found


def variants(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, planted: int = PLANTED) -> DataFrame:
    """Each word with its form, the root of its forms and the number of its near words."""
    words = staged(vocabulary(docs, shortest, least, planted), "spelling-words")
    nearest = (
        near_words(words, shortest)
        .groupBy("word", "n")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
        .select("word", "n_near", F.when(-F.col("best.m") >= 2 * F.col("n"), F.col("best")).alias("best"))
        .select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.m")).alias("form_n"))
    )
    nearest = staged(nearest, "spelling-nearest")
    found = words.join(nearest, "word", "left").join(roots(nearest.where("form IS NOT NULL")), "word", "left")
    return found.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
