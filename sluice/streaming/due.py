"""Items that fall due, over a stream: each key has one item at most, which fires once when its time
has come; a later message of its key replaces it before that, or takes it back.

The state is a row and a timer for each key (transformWithState on RocksDB), so a restart from the
checkpoint goes on where it was, and no task holds more than the keys it works on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE = "due long, item string"
OUT = "key string, due timestamp, item string"
_FIRED = "key string, due_ms long, item string"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Due(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getValueState("held", STATE)

    def _set(self, new: tuple[int, str] | None) -> None:
        if self.held.exists():
            self.handle.deleteTimer(self.held.get()[0])
        if new is None:
            self.held.clear()
        else:
            self.held.update(new)
            self.handle.registerTimer(new[0])

    @staticmethod
    def _fired(key, items: list[tuple[int, str]]) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]] * len(items), "due_ms": [d for d, _ in items], "item": [i for _, i in items]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        """Messages of a key in the order of their time; what was due before one of them has fired."""
        held, fired = (tuple(self.held.get()) if self.held.exists() else None), []
        every = pd.concat(rows).sort_values(["at", "number"], kind="stable")
        for at, due, item in zip(every["at_ms"], every["due_ms"], every["item"], strict=True):
            if held and held[0] <= at:
                fired.append(held)
                held = None
            held = None if pd.isna(due) else (int(due), item)
        if held and held[0] <= timerValues.getCurrentWatermarkInMs():
            fired.append(held)
            held = None
        self._set(held)
        if fired:
            yield self._fired(key, fired)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.held.exists() and self.held.get()[0] <= timerValues.getCurrentWatermarkInMs():
            item = tuple(self.held.get())
            self.held.clear()
            yield self._fired(key, [item])

    def close(self) -> None:
        pass


def due_items(messages: DataFrame, late: str = "0 seconds") -> DataFrame:
    """(key, due, item): what fires. messages: a stream of (key string, at timestamp, number long, due
    timestamp, item string): at is a message's own time, number orders messages of one time; a null
    due takes the key's item back. An item fires once, when a message of its key or the watermark is
    at its time or past it; one that is due at once fires at the next of them. Messages that are
    later than `late` are dropped. Times count in milliseconds. Rows with a null key or at are left out.
    """
    set_provider(messages.sparkSession)
    ms = lambda c: F.unix_millis(c)
    some = messages.filter("key is not null and at is not null").withWatermark("at", late).select("key", "at", "number", ms(F.col("at")).alias("at_ms"), ms(F.col("due")).cast("double").alias("due_ms"), "item")
    fired = some.groupBy("key").transformWithStateInPandas(statefulProcessor=Due(), outputStructType=_FIRED, outputMode="append", timeMode="eventTime")
    return fired.select("key", F.timestamp_millis("due_ms").alias("due"), "item")


def set_provider(spark: SparkSession) -> None:
    """Timers need the state store that keeps keys in order."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
