"""Scoring of a stream of request files.

A request holds all the months it needs, so scoring is a stateless projection of
the stream: no watermark, no state store. The Parquet sink and its checkpoint
write each micro-batch exactly once across failures; where a batch feeds two
tables, its number names a folder in each that a replay replaces.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lunario.schema import FULL, Layout
from lunario.operators.requests import log_rows, rejected_requests, score_requests
from lunario.session import stage_table
from lunario.sources.requests import append_log, with_request_ids


def stream_score(
    requests: DataFrame,
    model: PipelineModel,
    log_path: str,
    checkpoint_path: str,
    *,
    once: bool = False,
    layout: Layout = FULL,
) -> StreamingQuery:
    """Append the log rows of every valid request; ``once`` drains what is there and stops."""
    scored = score_requests(requests, model, layout)
    return _append(log_rows(scored, layout), log_path, checkpoint_path, once)


def stream_rejects(
    requests: DataFrame,
    reject_path: str,
    checkpoint_path: str,
    *,
    once: bool = False,
    layout: Layout = FULL,
) -> StreamingQuery:
    """Append (request_id, reason) of every invalid request."""
    rejected = rejected_requests(requests, layout)
    return _append(rejected, reject_path, checkpoint_path, once)


def stream_log_and_rejects(
    requests: DataFrame,
    model: PipelineModel,
    log_path: str,
    reject_path: str,
    checkpoint_path: str,
    *,
    once: bool = False,
    layout: Layout = FULL,
) -> StreamingQuery:
    """Log and rejects of one stream: each micro-batch reads the inbox once.

    A batch is staged, then both of its sides replace the folder of the batch's
    number. A batch that runs again after a failure, whether before, between or
    after the two writes, leaves the same rows once.
    """

    def write(batch: DataFrame, number: int) -> None:
        sent = stage_table(with_request_ids(batch), "stream-batch")
        append_log(log_rows(score_requests(sent, model, layout), layout), log_path, str(number))
        append_log(rejected_requests(sent, layout), reject_path, str(number))

    writer = requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _append(rows: DataFrame, path: str, checkpoint_path: str, once: bool) -> StreamingQuery:
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint_path)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
