"""Live sessions: every change of a session as it happens, and its end once it has been idle long enough."""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemill.operators.ordered import micros
from tidemill.streaming.panes import BUCKETS, bucket_of, key_schema, key_text, unpacked

OPEN, CLOSED, MERGED = "open", "closed", "merged"


class _Tracker(StatefulProcessor):
    """State per bucket of keys: each key's open sessions (start, last time, last tie, last action, actions), by start, and the number of its changes so far.

    A session is open until the watermark is ``idle`` past its last row. So a key has at most as many open sessions as
    idle times fit into the watermark's delay and a micro-batch, and one more. The state of a bucket is read once per micro-batch or timer and
    written once: a call to the state store per key and session would cost more than the work.
    """

    def __init__(self, idle: int):
        self.idle = idle * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.users = handle.getListState("users", "k string, held string")

    def _held(self) -> dict[str, list]:
        return {k: json.loads(text) for k, text in self.users.get()}

    def _keep(self, held: dict[str, list]) -> None:
        self.users.put([(k, json.dumps(value, separators=(",", ":"))) for k, value in held.items()])
        ends = [session[1] for _, sessions in held.values() for session in sessions]
        if ends:  # the timer of a bucket's first end sets the next
            self.handle.registerTimer(-(-(min(ends) + self.idle) // 1000))

    def _emit(self, rows: list) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["k", "start", "last", "actions", "last_action", "change", "state"], dtype=object)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self._held()
        for batch in rows:
            out = []
            batch = batch.sort_values(["k", "at_us", "tie"])
            texts = batch["action"].astype(object).where(batch["action"].notna(), None)
            for k, at, tie, action in zip(batch["k"].tolist(), batch["at_us"].tolist(), batch["tie"].tolist(), texts.tolist()):
                change, sessions = held.get(k) or (0, [])
                after = bisect_right(sessions, at, key=itemgetter(0))
                # open sessions are more than idle apart, so a row meets none but its neighbours
                lo = after - 1 if after and at <= sessions[after - 1][1] + self.idle else after
                hi = after + 1 if after < len(sessions) and sessions[after][0] - self.idle <= at else after
                met = sessions[lo:hi]
                start, last = min([at, *[s[0] for s in met]]), max([at, *[s[1] for s in met]])
                newest = max([(at, tie, action), *[tuple(s[1:4]) for s in met]], key=lambda s: s[:2])
                sessions[lo:hi] = [[start, last, newest[1], newest[2], 1 + sum(s[4] for s in met)]]
                for gone, *_ in met:
                    if gone != start:
                        change += 1
                        out.append((k, gone, None, None, None, change, MERGED))
                change += 1
                out.append((k, start, last, sessions[lo][4], newest[2], change, OPEN))
                held[k] = [change, sessions]
            yield self._emit(out)
        self._keep(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held, out = self._held(), []
        for k, value in held.items():
            change, sessions = value
            for start, last, _, action, actions in sessions:
                if last + self.idle <= passed:
                    change += 1
                    out.append((k, start, last, actions, action, change, CLOSED))
            value[:] = change, [s for s in sessions if s[1] + self.idle > passed]
        self._keep(held)
        yield self._emit(out)

    def close(self) -> None:
        pass


def session_changes(df: DataFrame, key: str, ts: str, tie: str, action: str, idle: int, delay: str, buckets: int = BUCKETS) -> DataFrame:
    """(key, session_start, last_seen, actions, last_action, change, state): one row per change of a key's sessions.

    Every row opens or changes a session (``open``). A row that arrives late may join two sessions or move a start back: the start
    that is no more gets a row ``merged``. Once the watermark (``delay`` behind the newest time) is ``idle`` seconds past a
    session's last row it is ``closed`` and its state dropped; a later row starts anew. ``change`` numbers a key's changes.
    Keys are dealt to ``buckets``, a number that a checkpoint keeps; a task holds the open sessions of a bucket, so many millions of keys want
    more. Start it in a session with RocksDB state, or in ``session.rocksdb_state``.
    """
    rows = df.select(key_text(df, key).alias("k"), F.col(ts).cast("timestamp").alias("event_time"), micros(ts).alias("at_us"), F.col(tie).cast("long").alias("tie"),
                     F.col(action).cast("string").alias("action")).withWatermark("event_time", delay)
    out = rows.withColumn("bucket", bucket_of(F.col("k"), buckets)).groupBy("bucket").transformWithStateInPandas(
        _Tracker(idle), "k string, start long, last long, actions long, last_action string, change long, state string", "Append", "EventTime")
    return out.select(unpacked("k", key_schema(df, key))["k"].alias(key), F.timestamp_micros("start").alias("session_start"),
                      F.timestamp_micros("last").alias("last_seen"), "actions", "last_action", "change", "state")


def latest_sessions(changes: DataFrame, key: str) -> DataFrame:
    """The sessions that a log of changes leaves: the newest change per session, merged ones left out."""
    newest = changes.groupBy(key, "session_start").agg(
        F.max(F.struct("change", "last_seen", "actions", "last_action", "state")).alias("n"))
    return newest.where(F.col("n.state") != MERGED).select(key, "session_start", "n.last_seen", "n.actions", "n.last_action", "n.state")
