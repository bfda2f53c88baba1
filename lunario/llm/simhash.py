"""SimHash near-duplicates: fingerprints of word shingles, linked through BK-trees.

A BK-tree keeps each node's children under their Hamming distance to it; a
search of radius r at distance d follows only the edges d - r to d + r. Equal
fingerprints are one node, however many documents share them.

Fingerprints within r bits agree in one of r + 1 bit bands, so a shard is the
distinct fingerprints that agree in one band, and every linked pair meets in a
shard. The trees of all shards grow with the corpus and have no bound, so they
are not broadcast from the driver: shuffles carry each shard to the task that
builds its tree and searches it with the shard's own fingerprints. A shard of
over ``SHARD`` nodes is cut into blocks by hash, and each pair of blocks is a
cell of its own, so no task's tree grows with the corpus.

A cell hands on a spanning set of its links (at most one per node), which keeps
who reaches whom; components come from these.

A null or blank text has fingerprint 0 and is linked like any other. Repeated
rows share their component. Other columns are carried by ``deduplicated`` only;
the one document of a component that stays is the one with the smallest id,
then the smallest text hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lunario.llm.common import carried, shuffle_width, staged, text_hash, whole_text
from lunario.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Nodes of a shard that one tree may hold.
SHARD = 4096


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is set if it is in over half of the shingle hashes."""
    words = text.encode("utf-8").lower().split()
    if not words:
        return 0
    parts = [
        b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))
    ]
    hashes = np.array([xxhash.xxh64_intdigest(p, SEED) for p in parts], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65536):
        block = hashes[start : start + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, one row per row of ``docs``."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle) for t in batch["text"]]
            fp = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], fp, batch["text_hash"]], ["doc_id", "fp", "text_hash"]
            )

    light = docs.select("doc_id", whole_text().alias("text"), text_hash().alias("text_hash"))
    return light.mapInArrow(signed, "doc_id bigint, fp bigint, text_hash bigint")


class BKTree:
    """BK-tree over distinct 64-bit values; built and searched by whole sets of values.

    Nodes are indices into ``values``; ``edges[n]`` maps a distance to a child.
    """

    def __init__(self, values: np.ndarray):
        self.values = values
        self.edges: list[dict[int, int]] = [{} for _ in values]
        pending = [np.arange(len(values))] if len(values) else []
        while pending:
            group = pending.pop()
            root, rest = group[0], group[1:]
            distance = np.bitwise_count(values[rest] ^ values[root])
            order = np.argsort(distance, kind="stable")
            rest, distance = rest[order], distance[order]
            cuts = np.flatnonzero(np.diff(distance)) + 1
            for part in np.split(rest, cuts) if len(rest) else []:
                edge = int(np.bitwise_count(values[part[0]] ^ values[root]))
                self.edges[root][edge] = int(part[0])
                if len(part) > 1:
                    pending.append(part)

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, indices of the queries within ``radius`` of it)."""
        if not len(self.values) or not len(queries):
            return
        pending = [(0, np.arange(len(queries)))]
        while pending:
            node, some = pending.pop()
            distance = np.bitwise_count(queries[some] ^ self.values[node]).astype(np.int64)
            near = some[distance <= radius]
            if len(near):
                yield node, near
            for edge, child in self.edges[node].items():
                follow = some[np.abs(distance - edge) <= radius]
                if len(follow):
                    pending.append((child, follow))


def _spanning(values: np.ndarray, tree: np.ndarray, query: np.ndarray, radius: int) -> np.ndarray:
    """Root value of each value, after linking the values at ``query`` to those at ``tree``."""
    label = np.arange(len(values))
    for node, near in BKTree(values[tree]).search(values[query], radius):
        joined = np.unique(label[np.append(query[near], tree[node])])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]
    return label


def _cells(frame: pd.DataFrame, carried: pd.DataFrame | None) -> tuple[list, pd.DataFrame]:
    """Whole cells of a sorted batch, and the rows of its last cell, which may go on."""
    if carried is not None:
        frame = pd.concat([carried, frame], ignore_index=True)
    keys = frame[["band", "value", "i", "j"]].to_numpy()
    ends = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
    starts = np.concatenate([[0], ends])
    whole = [(s, e) for s, e in zip(starts[:-1], starts[1:], strict=True) if e - s > 1]
    fps, blocks = frame["fp"].to_numpy().view(np.uint64), frame["block"].to_numpy()
    cells = [(keys[s], fps[s:e], blocks[s:e]) for s, e in whole]
    return cells, frame.iloc[starts[-1] :]


def _linked(radius: int):
    def cell_links(key: np.ndarray, fps: np.ndarray, blocks: np.ndarray) -> tuple:
        fps, first = np.unique(fps, return_index=True)
        blocks = blocks[first]
        tree, query = np.flatnonzero(blocks == key[2]), np.flatnonzero(blocks == key[3])
        label = _spanning(fps, tree, query, radius)
        moved = label != np.arange(len(fps))
        return fps[moved].view(np.int64), fps[label[moved]].view(np.int64)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried = None
        for frame in batches:
            if len(frame):
                cells, carried = _cells(frame, carried)
                found = [cell_links(*cell) for cell in cells]
                for a, b in found:
                    if len(a):
                        yield pd.DataFrame({"a": a, "b": b})
        if carried is not None and len(carried) > 1:
            key = carried[["band", "value", "i", "j"]].to_numpy()[0]
            fps = carried["fp"].to_numpy().view(np.uint64)
            a, b = cell_links(key, fps, carried["block"].to_numpy())
            yield pd.DataFrame({"a": a, "b": b})

    return search


def links(distinct: DataFrame, radius: int = RADIUS, shard: int = SHARD) -> DataFrame:
    """(a, b): spanning links of the distinct fingerprints ``fp`` within ``radius`` bits."""
    bands = radius + 1
    width, over = divmod(64, bands)
    parts, low = [], 0
    for band in range(bands):
        bits = width + (band < over)
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << bits) - 1))
        parts.append(F.struct(F.lit(band).alias("band"), value.cast("bigint").alias("value")))
        low += bits
    banded = distinct.select("fp", F.explode(F.array(*parts)).alias("p")).select("fp", "p.*")
    large = (
        banded.groupBy("band", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > shard)
        .select("band", "value", F.ceil(F.col("n") / shard).cast("int").alias("blocks"))
    )
    blocked = (
        banded.join(large, ["band", "value"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(
            "band", "value", "fp", "block",
            F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        )
    )
    cell = ["band", "value", "i", "j"]
    return (
        blocked.repartition(shuffle_width(distinct.sparkSession), *cell)
        .sortWithinPartitions(*cell)
        .mapInPandas(_linked(radius), "a bigint, b bigint")
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD
) -> DataFrame:
    """One row per document: doc_id, fp, text_hash, component_id (smallest id reachable)."""
    marked = staged(fingerprints(docs, shingle), "simhash")
    classes = staged(
        marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-classes"
    )
    roots = staged(components(links(classes.select("fp"), radius, shard)), "simhash-roots")
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "text_hash", "root", "component_id")


def deduplicated(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, shard: int = SHARD
) -> DataFrame:
    """One row of ``docs`` per component, with all its columns."""
    marked = staged(near_duplicates(docs, shingle, radius, shard), "simhash-named")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    texts = marked.groupBy("doc_id", "text_hash", "root").agg(F.count(F.lit(1)).alias("rows"))
    first = (
        texts.withColumn("rank", rank)
        .groupBy("root")
        .agg(F.min(F.struct("rank", "rows")).alias("f"))
        .select("f.rank.doc_id", "f.rank.text_hash", F.lit(1).alias("copies"), "f.rows")
    )
    return carried(docs, staged(first, "simhash-kept"))
