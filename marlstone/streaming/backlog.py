"""Streams that take a backlog in parts: so many files at a time, in order of time, going on where they stopped; and timers that tell which workers went quiet."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..sources.tables import stored

_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def in_order(df: DataFrame, place: str, ts: str, slices: int) -> None:
    """Adds the rows of df to a folder as one file for each slice of time, the earliest first, so that a file source, which goes by the age of files, meets them in order of time.

    Rows are dealt out by time once; each slice is then written from the files of that table that hold it. Rows without a time come first."""
    dealt = stored(df.repartitionByRange(slices, F.col(ts).asc_nulls_first()).sortWithinPartitions(F.col(ts).asc_nulls_first()), "slices")
    path = F.col("_metadata.file_path")
    for r in dealt.groupBy(path.alias("file")).agg(F.min(ts).alias("first")).orderBy(F.col("first").asc_nulls_first(), "file").collect():
        dealt.sparkSession.read.schema(dealt.schema).parquet(r.file).coalesce(1).write.mode("append").parquet(place)


def limited(spark: SparkSession, place: str, schema, files: int) -> DataFrame:
    """The folder as a stream of at most so many files a batch; what waits stays in the folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(place)


def go_on(df: DataFrame, mode: str, place: str, handle: Callable[[DataFrame, int], None], batches: int | None = None) -> int:
    """Run from where the last start with this place stopped to the end of what is there, or for about so many batches; tells how many were run.

    handle(batch, number) must be safe to repeat: a batch that was cut off comes again under its number."""
    done = []

    def told(batch: DataFrame, number: int) -> None:
        if batches is None or len(done) < batches:
            handle(batch, number)
            done.append(number)
        else:
            raise _Stopped

    query = df.writeStream.outputMode(mode).option("checkpointLocation", f"{place}/state").trigger(availableNow=True).foreachBatch(told).start()
    try:
        query.awaitTermination()
    except Exception:  # noqa: BLE001 - the stop that was asked for reaches us as the stream's failure
        if batches is None or len(done) < batches:
            raise
    return len(done)


class _Stopped(Exception):
    pass


class _Beats(StatefulProcessor):
    """Of each worker the last sign of life, how many there were since it was last reset, and a timer for when it counts as quiet."""

    def __init__(self, after_ms: int):
        self.after = after_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("beats", "last long, n long")

    def _row(self, key, last: int, n: int) -> pd.DataFrame:
        return pd.DataFrame({"worker": [key[0]], "last": [pd.Timestamp(last, unit="us")], "n": [n]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times = sorted(int(x) for part in rows for x in part["us"])
        last, n = self.state.get() if self.state.exists() else (None, 0)
        for t in times:
            if last is not None and t - last > self.after * 1000:
                yield self._row(key, last, n)
                n = 0
            last, n = t if last is None else max(last, t), n + 1
        self.state.update((last, n))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(-(-last // 1000) + self.after)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            last, n = self.state.get()
            self.state.clear()
            yield self._row(key, last, n)

    def close(self) -> None:
        pass


def quiet(events: DataFrame, worker: str, ts: str, after_ms: int, late: str) -> DataFrame:
    """(worker, last, n): a worker that gave no sign for longer than after_ms is reset, by a timer once the watermark has passed, or by the next sign; n: its signs since the reset before."""
    stream = events.withWatermark(ts, late).select(F.col(worker).alias("worker"), ts, F.unix_micros(ts).alias("us"))
    return stream.groupBy("worker").transformWithStateInPandas(_Beats(after_ms), "worker long, last timestamp, n long", "Append", "EventTime")


class rocks_state:
    """Timers need the state store on RocksDB; the session's own is set again afterwards."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(_PROVIDER, None)
        self.spark.conf.set(_PROVIDER, _ROCKS)

    def __exit__(self, *_) -> None:
        if self.before is None:
            self.spark.conf.unset(_PROVIDER)
        else:
            self.spark.conf.set(_PROVIDER, self.before)
