"""Reconcile requests as they arrive, with Structured Streaming.

The reference's transforms run on whatever driving DataFrame the host hands
them.  When requests arrive continuously, each micro-batch is such a
DataFrame: ``foreachBatch`` runs the same set-based ``match_requests`` on it
against the current snapshot.  Each micro-batch overwrites its own
``batch_id=<n>`` folder, so one that is replayed after a failure replaces its
output, also when it now has no rows.  The checkpoint location is required: only
a stream that is restarted from its own checkpoint continues its batch numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from movrec.operators.requests import match_requests


def write_batch(result: DataFrame, path: str, batch_id: int) -> None:
    result.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def start_request_stream(
    requests_stream: DataFrame,
    snapshot: Callable[[], DataFrame],
    sink_path: str,
    checkpoint_location: str,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start a stream that reconciles every micro-batch of requests.

    ``snapshot`` is called per micro-batch so each batch sees the current
    movement snapshot.
    """
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(match_requests(batch, snapshot()), sink_path, batch_id)

    writer = requests_stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
