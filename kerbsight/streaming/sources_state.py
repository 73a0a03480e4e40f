"""Last position and status of every image source, as state that a stream keeps; late images are counted, not lost.

``transformWithState`` keeps one small row for each source. Whether an image is late is decided in that state, by the
latest time that the source has shown, as Spark's own watermark would leave late rows out without a word. A timer tells
when a source has been silent for too long.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = "last_time timestamp, gps_lat double, gps_lon double, n long, n_late long, n_unplaced long"
STATUS = f"source string, status string, {STATE}"
_FIELDS = ["last_time", "gps_lat", "gps_lon", "n", "n_late", "n_unplaced"]


class SourceStatus(StatefulProcessor):
    """For each source: its latest image, how many came, how many too late, how many without a position.

    ``delay`` is how far behind the source's latest image another may be; later ones count in ``n_late`` alone and move
    nothing. Images without a time count as late. After ``silence`` of processing time without images, where that is
    given, a source is told as silent once; with its next image it is active again.
    """

    def __init__(self, delay: timedelta, silence: timedelta | None = None):
        self.delay, self.silence = delay, silence and int(silence.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at, lat, lon, n, late, unplaced = self.last.get() if self.last.exists() else (None, None, None, 0, 0, 0)
        at = None if at is None else pd.Timestamp(at)
        batch = pd.concat(list(rows), ignore_index=True)
        times = pd.to_datetime(batch["image_timestamp"])
        known = at
        newest = times.max()
        # The bound is what earlier batches have shown: within one batch rows have no order.
        good = times.notna() if known is None else times.notna() & (times >= known - self.delay)
        late += int((~good).sum())
        n += int(good.sum())
        there = good & batch["gps_lat"].notna() & batch["gps_lon"].notna()
        unplaced += int((good & ~there).sum())
        placed = batch[there].assign(_t=times[there]).sort_values(["_t", "gps_lat", "gps_lon"])
        if len(placed) and (lat is None or known is None or placed["_t"].iloc[-1] >= known):
            lat, lon = float(placed["gps_lat"].iloc[-1]), float(placed["gps_lon"].iloc[-1])
        if pd.notna(newest) and (known is None or newest > known):
            known = newest
        values = (None if known is None else known.to_pydatetime(), lat, lon, n, late, unplaced)
        self.last.update(values)
        if self.silence:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.silence)
        yield self._row(key, "active", values)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        yield self._row(key, "silent", self.last.get())

    def _row(self, key, status: str, values) -> pd.DataFrame:
        return pd.DataFrame([(key[0], status, *values)], columns=["source", "status", *_FIELDS])

    def close(self) -> None:
        pass


def source_status(images: DataFrame, delay: timedelta = timedelta(hours=1), silence: timedelta | None = None, source_col: str = "customer") -> DataFrame:
    """``(source, status, last_time, gps_lat, gps_lon, n, n_late, n_unplaced)`` of a stream of frames, a row for each change.

    The last row of a source holds. Write it in update mode. The session needs RocksDB as state store:
    ``spark.sql.streaming.stateStore.providerClass`` set to Spark's RocksDBStateStoreProvider. With ``silence`` timers wait
    for their time, so such a stream must go on: a trigger of ``availableNow`` would never end.
    """
    keyed = images.selectExpr(f"coalesce(cast(`{source_col}` as string), '') as source", "image_timestamp", "gps_lat", "gps_lon")
    return keyed.groupBy("source").transformWithStateInPandas(statefulProcessor=SourceStatus(delay, silence), outputStructType=STATUS, outputMode="Update", timeMode="ProcessingTime" if silence else "None")
