"""Streaming forms (an extension): incremental discovery, and windows over the event stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: state on disk, of which a batch reads only the keys it holds
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstOfKey(StatefulProcessor):
    """Passes on one row of each key: the first in order of a batch's rows, once for ever."""

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        if self.seen.exists():
            for _ in rows:  # to their end, as Spark asks
                pass
            return
        first: pd.DataFrame | None = None
        for part in rows:
            both = part if first is None else pd.concat([first, part])
            first = both.sort_values(self.order, kind="stable").head(1) if len(both) else first
        if first is not None:
            self.seen.update((True,))
            yield first

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:  # noqa: N802, N803
        self.seen.update((True,))

    def close(self) -> None:
        pass


def first_seen(stream: DataFrame, key: str = "publication_id", order: list[str] | None = None, known: DataFrame | None = None) -> DataFrame:
    """Rows of ``stream`` whose key never came before, and is not in ``known`` (read when the stream first starts).

    Of several rows of a key in a batch the first by ``order`` (default: the key's
    batch order) is taken; a null key is a key. The state holds keys alone.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    initial = known.select(key).distinct().groupBy(key) if known is not None else None
    return stream.groupBy(key).transformWithStateInPandas(FirstOfKey(order or [key]), stream.schema, "Append", "None", initial)


def discover_new(stream: DataFrame, state_folder: str, checkpoint: str, *, known: DataFrame | None = None, order: list[str] | None = None) -> StreamingQuery:
    """Append publications with new ids to the table ``state_folder``, exactly once by key.

    Keys are kept in the state store of ``checkpoint``, so a batch reads the state
    of its own keys and nothing of the history; the file sink's log makes each
    batch's files count once. Read the table by its folder, not its files.
    """
    new = first_seen(stream, order=order, known=known)
    return new.writeStream.format("parquet").option("path", state_folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by type in windows; rows later than ``late`` are dropped when streaming."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("window.start").alias("start"), "event_type", "n", "value")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "user_id", "n")
