"""Deterministic sharded WARC writer, and a reader of what it wrote.

Records are sorted by page id and cut into shards by running payload bytes; a
shard is written by one task, as one or more gzip files that are rolled by
their compressed size. Headers, record ids, lengths and digests are made anew
from the payload, so a task that runs again writes the same bytes. A file is
written under a temporary name and renamed when complete; the manifest, a table
that Spark commits, lists the files that count. Readers trust it alone.

Records with equal payloads: the one of smallest page id is a response, the
others are revisits that name it. A null page id comes last; null html is the
empty payload; rows equal in id and payload are one response and revisits of
it; a null url is written as ``urn:page:<id>``. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lunario.llm.common import shuffle_width, staged
from lunario.session import fresh_path

#: Payload bytes of a shard (more if there would be over ``MAX_SHARDS``), compressed bytes of a file.
SHARD_BYTES = 32 << 20
MAX_SHARDS = 10_000
FILE_BYTES = 16 << 20
#: Payloads shorter than this are always written out.
LEAST_REVISIT = 0
#: One date for all records: a writer's clock would make reruns differ.
DATE = "2024-01-01T00:00:00Z"
RECORD_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
LAST_ID = 2**63 - 1

MANIFEST = "shard int, file string, records bigint, bytes bigint, sha256 string"


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, digest: str, repeat: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(RECORD_IDS, f'{page_id}/{digest}/{repeat}')}>"


def _block(kind: str, headers: list[tuple[str, str]], body: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers)]
    lines += [f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + body + b"\r\n\r\n"


def _record(page_id, url, payload: bytes, digest: str, repeat: int, refers_to) -> bytes:
    """One record; ``refers_to`` is None for a response, else (id of the response's page,)."""
    target = f"urn:page:{page_id}" if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    status += b"Content-Length: %d\r\n\r\n" % len(payload)
    body = status + (payload if refers_to is None else b"")
    headers = [
        ("WARC-Record-ID", _record_id(page_id, digest, repeat)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", f"sha1:{_digest(body)}"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(payload))),
        ("X-Page-Id", "" if page_id is None else str(page_id)),
    ]
    if refers_to is None:
        return _block("response", headers, body)
    first = refers_to[0]
    headers += [
        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ("WARC-Refers-To", _record_id(first, digest, 0)),
        ("X-Refers-To-Page-Id", "" if first is None else str(first)),
    ]
    return _block("revisit", headers, body)


class _Shard:
    """Files of one shard, in order; each is renamed into place when it is full."""

    def __init__(self, root: str, shard: int):
        self.store, self.root = fs.FileSystem.from_uri(root)
        self.shard, self.rolls, self.out = shard, 0, None

    def add(self, record: bytes) -> Iterator[dict]:
        if self.out is None:
            self.name = f"part-{self.shard:05d}-{self.rolls:04d}.warc.gz"
            self.temporary = f"{self.root}/_temporary/{self.name}.{uuid.uuid4().hex}"
            self.out = self.store.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.sum = 0, 0, hashlib.sha256()
        member = gzip.compress(record, 6, mtime=0)
        self.out.write(member)
        self.sum.update(member)
        self.size += len(member)
        self.records += 1
        if self.size >= FILE_BYTES:
            yield from self.close()

    def close(self) -> Iterator[dict]:
        if self.out is None:
            return
        self.out.close()
        final = f"{self.root}/{self.name}"
        try:
            self.store.move(self.temporary, final)
        except OSError:
            # Stores that do not overwrite: another attempt has left the same bytes.
            if self.store.get_file_info(final).size != self.size:
                raise
            self.store.delete_file(self.temporary)
        yield {
            "shard": self.shard, "file": self.name, "records": self.records,
            "bytes": self.size, "sha256": self.sum.hexdigest(),
        }
        self.out, self.rolls = None, self.rolls + 1


def _writing(root: str):
    """Writes the sorted rows of a task; yields a manifest row per file."""

    def manifest(rows: list[dict]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = ["shard", "file", "records", "bytes", "sha256"]
        columns = [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = page = None
        for batch in batches:
            # One row at a time becomes Python objects, so payloads are not held twice.
            for i in range(batch.num_rows):
                row = {name: batch[name][i].as_py() for name in batch.schema.names}
                done = []
                if shard is None or shard.shard != row["shard"]:
                    done += shard.close() if shard else []
                    shard, page = _Shard(root, row["shard"]), None
                if page is None or page[0] != row["page_id"]:
                    page = (row["page_id"], {}, {})
                _, revisits, written = page
                if row["marker"]:
                    revisits[row["digest"]] = (row["refers_to"],)
                else:
                    payload = (row["html"] or "").encode("utf-8")
                    digest = _digest(payload)
                    repeat = written.get(digest, 0)
                    written[digest] = repeat + 1
                    refers = revisits.get(row["digest"])
                    if refers is None and repeat and len(payload) >= LEAST_REVISIT:
                        refers = (row["page_id"],)
                    done += shard.add(
                        _record(row["page_id"], row["url"], payload, digest, repeat, refers)
                    )
                if done:
                    yield manifest(done)
        if shard:
            yield manifest(list(shard.close()))

    return write


def _shard_bounds(light: DataFrame) -> list[int]:
    """First order key of each shard after the first; at most ``MAX_SHARDS`` values.

    The running sum of bytes in key order is formed inside key ranges and then
    across them; its values do not depend on where the ranges are cut.
    """
    spark = light.sparkSession
    ids = light.groupBy("key").agg(F.sum(F.col("size") + 1024).alias("bytes"))
    ranged = staged(
        ids.repartitionByRange(shuffle_width(spark), "key").withColumn(
            "range", F.spark_partition_id()
        ),
        "warc-ranges",
    )
    sums = ranged.groupBy("range").agg(F.sum("bytes").alias("all"))
    order = Window.partitionBy(F.lit(0)).orderBy("range")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "range",
        F.coalesce(F.sum("all").over(before), F.lit(0)).alias("offset"),
        F.sum("all").over(Window.partitionBy(F.lit(0))).alias("total"),
    )
    inside = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    target = F.greatest(F.lit(SHARD_BYTES), F.ceil(F.col("total") / MAX_SHARDS))
    placed = ranged.withColumn("run", F.coalesce(F.sum("bytes").over(inside), F.lit(0))).join(
        offsets, "range"
    )
    shard = F.floor((F.col("run") + F.col("offset")) / target).alias("shard")
    firsts = placed.groupBy(shard).agg(F.min("key").alias("key")).orderBy("key").collect()
    return [row["key"] for row in firsts[1:]]


def _order_key() -> Column:
    return F.coalesce("page_id", F.lit(LAST_ID))


def write(pages: DataFrame, root: str | None = None) -> tuple[DataFrame, str]:
    """Writes the archive below ``root`` (a new shared folder by default): its manifest and root."""
    spark = pages.sparkSession
    root = root or fresh_path(spark, "llm-warc")
    store, place = fs.FileSystem.from_uri(root)
    store.create_dir(f"{place}/_temporary", recursive=True)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        "page_id", _order_key().alias("key"), "url", "html", F.sha1(payload).alias("digest")
    )
    light = staged(
        rows.select("page_id", "key", "digest", F.octet_length(F.coalesce("html", F.lit(""))).alias("size")),
        "warc-digests",
    )
    bounds = np.array(_shard_bounds(light), dtype=np.int64)

    @F.pandas_udf("int")
    def shard_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(), side="right").astype(np.int32))

    first = (
        light.where(F.col("size") >= LEAST_REVISIT)
        .groupBy("digest")
        .agg(F.min(F.struct("key", "page_id")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    markers = (
        light.join(first, "digest")
        .where("key <> first.key")
        .select("page_id", "key", "digest", F.col("first.page_id").alias("refers_to"))
        .distinct()
    )
    none = F.lit(None)
    both = rows.select(
        "*", none.cast("bigint").alias("refers_to"), F.lit(False).alias("marker")
    ).unionByName(
        markers.select("*", none.cast("string").alias("url"), none.cast("string").alias("html"), F.lit(True).alias("marker"))
    )
    tasks = max(shuffle_width(spark), len(bounds) + 1)
    manifest = (
        both.withColumn("shard", shard_of("key"))
        .repartitionById(tasks, F.col("shard"))
        .sortWithinPartitions("shard", "key", F.desc("marker"), "url", "digest")
        .mapInArrow(_writing(root), MANIFEST)
    )
    return staged(manifest, "warc-manifest"), root


def records(source, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, body) of each record of an open, unpacked archive, read in order."""
    while line := source.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"{name}: no record where one should start: {line[:40]!r}")
        headers = {}
        while (line := source.readline().rstrip(b"\r\n")):
            key, _, value = line.decode("utf-8").partition(": ")
            headers[key] = value
        body = source.read(int(headers["Content-Length"]))
        if source.read(4) != b"\r\n\r\n" or len(body) != int(headers["Content-Length"]):
            raise ValueError(f"{name}: a record is cut off")
        if headers["WARC-Block-Digest"] != f"sha1:{_digest(body)}":
            raise ValueError(f"{name}: a block does not match its digest")
        yield headers, body


READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"


def read(manifest: DataFrame, root: str, payloads: bool = False) -> DataFrame:
    """One row per record of the files that the manifest lists; with ``html`` if asked for.

    Files are streamed record by record, and digests are checked. A revisit has
    the digest and length of the payload that it refers to, and null html.
    """
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]

    def number(text: str | None) -> int | None:
        return int(text) if text else None

    def row(headers: dict[str, str], body: bytes) -> tuple:
        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
        payload = body[body.index(b"\r\n\r\n") + 4 :]
        if kind == "response" and digest != _digest(payload):
            raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
        found = (
            number(headers["X-Page-Id"]), int(headers["X-Payload-Length"]), digest, kind,
            number(headers.get("X-Refers-To-Page-Id")), headers["WARC-Target-URI"],
        )
        html = payload.decode("utf-8") if kind == "response" else None
        return found + ((html,) if payloads else ())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        typed = [*kinds, pa.string()] if payloads else kinds
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(typed)]
        return pa.RecordBatch.from_arrays(columns, [*names, "html"] if payloads else names)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = fs.FileSystem.from_uri(root)
        for listed in batches:
            for file in listed["file"].to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{place}/{file}", compression=None) as raw:
                    with gzip.GzipFile(fileobj=raw) as source:
                        for headers, body in records(source, file):
                            rows.append(row(headers, body))
                            size += len(body) if payloads else 256
                            if size > 8 << 20:
                                yield batch(rows)
                                rows, size = [], 0
                if rows:
                    yield batch(rows)

    files = manifest.select("file").repartition(shuffle_width(manifest.sparkSession), "file")
    return files.mapInArrow(unpack, READ + (", html string" if payloads else ""))


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes the archive and reads it back: one row per page."""
    return read(*write(pages)).drop("url")
