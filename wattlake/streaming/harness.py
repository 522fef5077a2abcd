"""Runs a stream through stops on purpose (T11, T13): what a restart reads, and that batches never overlap."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame

STOPPED = "stopped on purpose"


def run_with_stops(
    stream: Callable[[], DataFrame], work: Callable[[DataFrame, int], object], checkpoint: str,
    stop_at: Collection[int] = (), interval: str = "0 seconds",
) -> list[tuple[int, float, float]]:
    """Run ``work(batch, epoch)`` on all that ``stream()`` has, every ``interval``; ``(epoch, begin, end)`` of every batch run.

    After the work of each epoch in ``stop_at`` the query dies before it can
    commit the batch; it is started again from the checkpoint, which repeats the epoch.
    """
    spans: list[tuple[int, float, float]] = []
    left = set(stop_at)

    def batch_fn(batch: DataFrame, epoch: int) -> None:
        begin = time.monotonic()
        work(batch, epoch)
        spans.append((epoch, begin, time.monotonic()))
        if epoch in left:
            left.discard(epoch)
            raise RuntimeError(STOPPED)

    while True:
        query = (
            stream().writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint)
            .trigger(processingTime=interval).start()
        )
        try:
            query.processAllAvailable()
            return spans
        except StreamingQueryException as ex:
            if STOPPED not in str(ex):
                raise
        finally:
            query.stop()
