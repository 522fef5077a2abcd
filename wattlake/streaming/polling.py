"""Polling source whose position is the engine's checkpoint.

``spark.readStream.format("wattlake_poll")`` polls a table that grows by time. The
offset is the newest time seen; the engine logs it before a batch and commits it
after, so a restart neither loses nor repeats rows and nothing else needs saving.
A poll asks for the rows newer than the position within the look-back window, cut
into time ranges that executors read side by side.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

_UNIX = dt.datetime(1970, 1, 1)


class _Range(InputPartition):
    """Rows with ``low < time <= high``, in microseconds since 1970."""

    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _Poller(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], names: list[str]):
        self.path, self.names = options["path"], names
        self.time = options.get("timecolumn", "time")
        self.lookback = int(float(options.get("lookbackminutes", 30)) * 60_000_000)
        self.slices = int(options.get("slices", 8))
        self.as_of = options.get("asof")

    def _rows(self) -> ds.Dataset:
        if "://" in self.path or self.path.startswith("file:"):
            system, path = pafs.FileSystem.from_uri(self.path)
        else:
            system, path = pafs.LocalFileSystem(), self.path
        return ds.dataset(path, filesystem=system, format="parquet", exclude_invalid_files=False)

    def _bounds(self, low: int, high: int):
        """The filter of a range, as the table's own type of time."""
        kind = self._rows().schema.field(self.time).type
        at = lambda x: pa.scalar(x, pa.timestamp("us")).cast(pa.timestamp(kind.unit, kind.tz) if kind.tz is None else kind)
        return (ds.field(self.time) > at(low)) & (ds.field(self.time) <= at(high))

    def _now(self) -> int:
        now = dt.datetime.fromisoformat(self.as_of) if self.as_of else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        return (now - _UNIX) // dt.timedelta(microseconds=1)

    def initialOffset(self) -> dict:
        return {"position": -1}

    def latestOffset(self) -> dict:
        """The newest time at or before now: the one column of the window is read."""
        now = self._now()
        newest = -1
        for batch in self._rows().to_batches(columns=[self.time], filter=self._bounds(now - self.lookback - 1, now)):
            if batch.num_rows:
                newest = max(newest, pc.max(batch.column(0)).cast(pa.timestamp("us")).cast(pa.int64()).as_py())
        return {"position": newest}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        high = end["position"]
        low = max(start["position"], self._now() - self.lookback - 1)
        if high <= low:
            return [_Range(0, 0)]
        step = -(-(high - low) // self.slices)
        return [_Range(a, min(a + step, high)) for a in range(low, high, step)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if partition.high > partition.low:
            yield from self._rows().to_batches(columns=self.names, filter=self._bounds(partition.low, partition.high))

    def commit(self, end: dict) -> None:
        """Nothing to do: the engine holds the position."""


class PollSource(DataSource):
    """Options: ``path`` (Parquet folder), ``timeColumn``, ``lookbackMinutes``, ``slices``, ``asOf`` (else the clock)."""

    @classmethod
    def name(cls) -> str:
        return "wattlake_poll"

    def schema(self) -> str:
        raise NotImplementedError("give the rows' schema with .schema(...)")

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Poller(dict(self.options), list(schema.names))
