"""Change events of a fetch log, as a stream with state per url."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: The state store that keyed state and timers need; a session setting, to be in force when the stream starts.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class _Changes(StatefulProcessor):
    """Holds the last content and time of a url, and a timer that forgets them."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long, id long, sha string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.last.get() if self.last.exists() else None
        first = held
        for r in sorted(((r["at"], r["id"], r["content_sha"]) for r in rows), key=lambda r: r[:2]):
            if held is not None and r[:2] <= (held[0], held[1]):
                continue  # late or seen before
            yield Row(url=key[0], id=r[1], state="new" if held is None else "unchanged" if held[2] == r[2] else "changed")
            held = r
        if held is not first:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(held[0] // 1000 + self.idle_ms)
            self.last.update(tuple(held))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def change_events(fetches: DataFrame, late: str, idle_ms: int) -> DataFrame:
    """(url, id, state) of a stream (id, url, fetched_at, content_sha): `new`, `changed` or `unchanged` against the url's fetch before.

    Within a micro-batch the fetches of a url go by time, ties by id. One that is not newer than what its url has seen gives no event,
    nor does one beyond the watermark, which trails the newest fetch by `late`. When the watermark has passed a url's last fetch by `idle_ms`, its
    state goes, and its next fetch is `new`; so state holds active urls alone. Rows without a url or time are no fetches. A url's fetches of one micro-batch are
    sorted in memory: bound the batch by the source's options.
    """
    rows = fetches.where("url is not null and fetched_at is not null").withWatermark("fetched_at", late)
    keyed = rows.select("url", "id", "fetched_at", "content_sha", F.unix_micros("fetched_at").alias("at")).groupBy("url")
    return keyed.transformWithState(_Changes(idle_ms), "url string, id long, state string", "Append", "EventTime")


def write_changes(source: DataFrame, target: str, checkpoint: str, late: str, idle_ms: int):
    """Stream change events of `source` to Parquet until the input is used up."""
    spark = source.sparkSession
    before = spark.conf.get(STATE_STORE[0])
    spark.conf.set(*STATE_STORE)
    try:
        events = change_events(source, late, idle_ms)
        return events.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(STATE_STORE[0], before)
