"""State by battle, with timers: when it left the live list, when it ended, and whether its rankings have settled."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: ``at`` is when something was seen. seen: the battle is on the live list; end: its document says that it ended, at ``ended_at`` (the last update where it
#: has no end; null: when the document was read); rows: its rankings were read.
EVENTS = "battle_id long, kind string, at timestamp, ended_at timestamp"
ACTIONS = "battle_id long, action string, at timestamp"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_MINUTE = 60_000


class Battle(StatefulProcessor):
    """Actions of one battle, all times in event time.

    missing: not seen for ``absent``, so its document is to be read, again after each ``absent`` until it says the end; end: it ended; request: its rankings are to
    be read, ``wait`` after the end and again after each ``wait``, until rows are read ``wait`` after the end or later; settled: they were.
    The state goes ``keep`` after that, so that a late look at the live list does not bring it back.
    """

    def __init__(self, wait: int, absent: int, keep: int):
        self.wait, self.absent, self.keep = wait, absent, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("battle", "seen long, ended long, read long, settled boolean")

    def _held(self) -> list:
        got = self.state.get()
        return list(got) if got is not None else [None, None, None, False]

    def _only(self, at: int) -> None:
        """The one timer of a battle."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at)

    def _out(self, key, actions: list[tuple[str, int]]) -> Iterator[pd.DataFrame]:
        if actions:
            yield pd.DataFrame({"battle_id": [key[0]] * len(actions), "action": [a for a, _ in actions], "at": pd.to_datetime([t for _, t in actions], unit="ms")})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        seen, ended, read, settled = self._held()
        was, out = ended, []
        for batch in rows:
            at, end = (batch[c].fillna(batch["at"]).astype("datetime64[us]").astype("int64") // 1000 for c in ("at", "ended_at"))
            for kind, ms, end_ms in zip(batch["kind"], at, end, strict=True):
                if kind == "seen":
                    seen = max(seen or ms, ms)
                elif kind == "end":
                    ended = end_ms if ended is None else ended  # the first word on it counts
                elif kind == "rows":
                    read = max(read or ms, ms)
        if ended is not None and was is None:
            out.append(("end", int(ended)))
        now = timerValues.getCurrentWatermarkInMs()
        if ended is not None and not settled:
            if read is not None and read >= ended + self.wait:
                settled = True
                out.append(("settled", int(read)))
                self._only(max(int(read), now) + self.keep)
            elif was is None:
                self._only(max(int(ended) + self.wait, now + 1))
        elif ended is None and seen is not None:
            self._only(max(int(seen) + self.absent, now + 1))
        self.state.update((None if seen is None else int(seen), None if ended is None else int(ended), None if read is None else int(read), settled))
        yield from self._out(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        at = expiredTimerInfo.getExpiryTimeInMs()
        _, ended, _, settled = self._held()
        if settled:
            self.state.clear()
            return
        self.handle.registerTimer(max(at, timerValues.getCurrentWatermarkInMs()) + (self.absent if ended is None else self.wait))
        yield from self._out(key, [("missing" if ended is None else "request", at)])

    def close(self) -> None:
        pass


def battle_actions(events: DataFrame, wait: int = 5, absent: int = 2, keep: int = 7 * 24 * 60, late: str = "10 minutes") -> DataFrame:
    """The actions of a stream of ``EVENTS``; times in minutes. Run it in append mode on the RocksDB state store (``STORE``). Events
    without a battle, a kind or a time do nothing; what was seen ``late`` before the newest is too late."""
    known = events.where("battle_id is not null and kind is not null and at is not null").withWatermark("at", late)
    processor = Battle(wait * _MINUTE, absent * _MINUTE, keep * _MINUTE)
    return known.groupBy("battle_id").transformWithStateInPandas(processor, ACTIONS, outputMode="append", timeMode="eventTime")
