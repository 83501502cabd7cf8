"""Stateful work per key, as streams and as their batch twins."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemill.operators import ordered as O


def split_late(df: DataFrame, ts: str, arrival: Sequence[str], delay: int, chunk: int | Column | None = None) -> DataFrame:
    """Add ``late``: the row is behind the newest time that arrived before it, minus the delay.

    The running maximum is taken in arrival order over the whole table, cut into sorted ranges.
    """
    seen = O.running(df, [], list(arrival), {"_seen": ("max", F.col(ts))}, chunk, inclusive=False)
    behind = O.micros(ts) < O.micros("_seen") - delay * 1_000_000
    return seen.withColumn("late", F.coalesce(behind, F.lit(False))).drop("_seen")


def dedup_stream(df: DataFrame, ids: Sequence[str], ts: str, horizon: str, eager: bool = True) -> DataFrame:
    """Each id once until it has been silent for longer than the horizon.

    A row counts if its id was not seen in the horizon before it, be that row kept or not; of rows of one time the smallest
    counts. A stream gives the same rows with ``eager=False``, each when its id has been silent for long enough, in whatever order rows
    arrive within the horizon. An eager stream gives a row at once and forgets an id by its kept row: an id that
    keeps coming for longer than the horizon may then count more than once.
    """
    at = F.col(ts).cast("timestamp")
    if df.isStreaming and eager:
        return df.withWatermark(ts, horizon).dropDuplicatesWithinWatermark(list(ids))
    if df.isStreaming:
        marked = df.withColumn("_at", at).withWatermark("_at", horizon)
        silent = F.session_window("_at", f"{horizon} 1 microsecond")  # a step of just the horizon is no silence
        return marked.groupBy(silent.alias("_w"), *ids).agg(F.min(F.struct("_at", F.struct(*df.columns).alias("row"))).alias("_first")).select("_first.row.*")
    one = df.groupBy(*ids, at.alias("_at")).agg(F.min(F.struct(*df.columns)).alias("_row"))
    before = O.previous(one, list(ids), ["_at"], {"_before": "_at"})
    fresh = F.col("_before").isNull() | (F.col("_before") + F.expr(f"INTERVAL {horizon}") < F.col("_at"))
    return before.where(fresh).select("_row.*")


def rolling_reduce(df: DataFrame, keys: Sequence[str], order: Sequence[str], specs: Mapping[str, tuple[str, Column]],
                   chunk: int | Column | None = None) -> DataFrame:
    """Running reduce, one output per input."""
    return O.running(df, keys, order, specs, chunk)


def publish_every_n(df: DataFrame, key: str, order: Sequence[str], value: Column, n: int, chunk: int | Column | None = None) -> DataFrame:
    """A summary at each nth row of a key: count and running total so far."""
    out = O.running(df, [key], order, {"alert_count": ("count", F.lit(1)), "total": ("sum", value)}, chunk)
    return out.where(F.col("alert_count") % n == 0)


BUCKETS = 1024  # groups that the keys of a keyed state machine are dealt to; part of a stream's checkpoint
NULL_BUCKET = -1


@dataclass
class _Rows:
    """A bucket's rows of a micro-batch: keys one after the other, each in order, and the state its keys had before.

    ``code`` numbers the keys, ``start`` and ``last`` are the places of a key's first and last row, ``before`` has per key one value of
    each state column (zero or None for a new key).
    """
    rows: pd.DataFrame
    code: np.ndarray
    start: np.ndarray
    last: np.ndarray
    before: dict[str, np.ndarray]

    @property
    def place(self) -> np.ndarray:
        """Each row's place within its key, from 0."""
        return np.arange(len(self.code)) - self.start[self.code]

    def running(self, name: str, how: str) -> np.ndarray:
        return getattr(self.rows[name].groupby(self.code), how)().to_numpy()

    def previous(self, values: np.ndarray, before: np.ndarray) -> np.ndarray:
        """The value of the row before, which for a key's first row is the state's."""
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[self.start] = before
        return out


def _packed(held: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(held, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pd.DataFrame:
    with pa.ipc.open_stream(pa.py_buffer(bytes(blob))) as reader:
        return reader.read_pandas()


def _take(rows: pd.DataFrame, key: str, order: Sequence[str], held: pd.DataFrame | None, fresh: Mapping[str, object], one_key: bool) -> tuple[_Rows, pd.Series]:
    """The rows dealt to their keys, and the keys by code."""
    labels = pd.Series(0, index=rows.index) if one_key else rows[key]
    code, keys = pd.factorize(labels, use_na_sentinel=False)
    by = rows.assign(_code=code).sort_values(["_code", *[x for c in order for x in (_flag(c), c) if x in rows]], ignore_index=True)
    code = by["_code"].to_numpy()
    start = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    at = np.full(len(keys), -1) if held is None else pd.Index(held["k"]).get_indexer(pd.Index(keys))
    before = {}
    for name, none in fresh.items():
        values = np.full(len(keys), none, dtype=object if none is None else "int64")
        if held is not None:
            values[at >= 0] = held[name].to_numpy()[at[at >= 0]]
        before[name] = values
    return _Rows(by, code, start, np.r_[start[1:], len(code)] - 1, before), pd.Series(keys)


def _flag(col: str) -> str:
    return f"_null_{col}"


def _in_buckets(df: DataFrame, key: str, order: Sequence[str], more: Mapping[str, Column], output: str, fresh: Mapping[str, object],
                step: Callable[[_Rows], tuple[pd.DataFrame, dict[str, np.ndarray]]], timeout: str, idle_ms: int | None, buckets: int) -> DataFrame:
    """A state machine per key, run over all keys of a bucket together.

    A call per key and micro-batch costs milliseconds, whatever it does, so keys are dealt to ``buckets`` by hash, and ``step`` works on the columns
    of a bucket: it gives the output and each key's new state. The state of a bucket is one Arrow table, with a row per key and
    ``until``, the millisecond at which the key is forgotten. A task holds one bucket's rows of a micro-batch, which the source's limit
    per trigger bounds, and its keys; more keys want more buckets, a number that a checkpoint must keep. Work that has to be in
    event-time order over micro-batches, or must not hold a micro-batch, goes by panes (``panes``).

    Whole numbers that may be null travel as number and flag, as pandas would make floats of them; the NULL key has a bucket of its own.
    """
    whole = [c for c in order if isinstance(df.schema[c].dataType, T.IntegralType)]
    kinds = {c: df.schema[c].dataType.simpleString() for c in (key, *order)}

    def forget(held: pd.DataFrame, state: GroupState) -> None:
        if timeout != GroupStateTimeout.NoTimeout:
            event = timeout == GroupStateTimeout.EventTimeTimeout
            now = state.getCurrentWatermarkMs() if event else state.getCurrentProcessingTimeMs()
            held = held[held["until"] > now]
        if held.empty:
            state.remove()
            return
        state.update((_packed(held),))
        if timeout == GroupStateTimeout.EventTimeTimeout:
            state.setTimeoutTimestamp(int(held["until"].min()))
        elif timeout == GroupStateTimeout.ProcessingTimeTimeout:
            state.setTimeoutDuration(int(held["until"].min()) - now)

    def run(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = _unpacked(state.get[0]) if state.exists else None
        if state.hasTimedOut:
            forget(held, state)
            return
        taken, keys = _take(pd.concat(list(batches), ignore_index=True), key, order, held, fresh, k[0] == NULL_BUCKET)
        out, after = step(taken)
        if idle_ms is not None and timeout == GroupStateTimeout.ProcessingTimeTimeout:
            after["until"] = np.full(len(keys), state.getCurrentProcessingTimeMs() + idle_ms)
        now = pd.DataFrame({"k": keys, **after})
        forget(now if held is None else pd.concat([held[~held["k"].isin(keys)], now], ignore_index=True), state)
        yield out

    bucket = F.when(F.col(key).isNull(), F.lit(NULL_BUCKET).cast("long")).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets).cast("long")))
    flags = {_flag(c): F.col(c).isNull() for c in whole}
    rows = df.select(bucket.alias("_bucket"), key, *[F.coalesce(c, F.lit(0).cast(kinds[c])).alias(c) if c in whole else F.col(c) for c in order],
                     *[f.alias(c) for c, f in flags.items()], *[c.alias(name) for name, c in more.items()])
    return rows.groupBy("_bucket").applyInPandasWithState(run, output, "held binary", "append", timeout)


def _idle(idle_ms: int | None) -> str:
    """The timeout of state that is dropped after so long without rows; None keeps it, as totals since ever need.

    Such a stream did not come to an end with ``availableNow`` in a trial: start it with another trigger.
    """
    return GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout


def publish_every_n_stream(df: DataFrame, key: str, order: Sequence[str], cents: str, n: int, idle_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The same as a state machine: (count, total) per key lives in the state store.

    ``cents`` is an integer column; a missing one adds nothing.
    """
    def step(r: _Rows) -> tuple[pd.DataFrame, dict[str, np.ndarray]]:
        count = r.place + 1 + r.before["count"][r.code]
        total = r.running("_cents", "cumsum") + r.before["total"][r.code]
        out = pd.DataFrame({key: r.rows[key], "alert_count": count, "total_cents": total})
        return out[count % n == 0], {"count": count[r.last], "total": total[r.last]}

    kind = df.schema[key].dataType.simpleString()
    return _in_buckets(df, key, order, {"_cents": F.coalesce(F.col(cents).cast("long"), F.lit(0).cast("long"))},
                       f"{key} {kind}, alert_count long, total_cents long", {"count": 0, "total": 0}, step, _idle(idle_ms), idle_ms, buckets)


def count_window_stream(df: DataFrame, key: str, order: Sequence[str], cents: str, n: int, idle_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Windows of n records per key over a stream; the state holds the count and the open window's sum. A missing value adds nothing."""
    def step(r: _Rows) -> tuple[pd.DataFrame, dict[str, np.ndarray]]:
        count = r.place + r.before["count"][r.code]
        number = count // n
        first = np.flatnonzero(np.r_[True, (r.code[1:] != r.code[:-1]) | (number[1:] != number[:-1])])  # a row per key and window
        sums = np.add.reduceat(r.rows["_cents"].to_numpy(), first)
        sums[np.searchsorted(first, r.start)] += r.before["pending"]
        ends = np.r_[first[1:], len(count)] - 1
        full = count[ends] % n == n - 1
        out = pd.DataFrame({key: r.rows[key].to_numpy()[first], "window_no": number[first], "total_cents": sums})
        open_ = np.where(full, 0, sums)[np.searchsorted(ends, r.last)]
        return out[full], {"count": count[r.last] + 1, "pending": open_}

    kind = df.schema[key].dataType.simpleString()
    return _in_buckets(df, key, order, {"_cents": F.coalesce(F.col(cents).cast("long"), F.lit(0).cast("long"))},
                       f"{key} {kind}, window_no long, total_cents long", {"count": 0, "pending": 0}, step, _idle(idle_ms), idle_ms, buckets)


def rolling_reduce_stream(df: DataFrame, key: str, order: Sequence[str], value: str, idle_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Running maximum, minimum and sum of a whole-number column, one output per input of a keyed stream.

    Missing values are left out; until a key's first value all three are NULL.
    """
    v, kinds = F.col(value).cast("long"), {c: df.schema[c].dataType.simpleString() for c in (key, *order)}
    whole = [c for c in order if isinstance(df.schema[c].dataType, T.IntegralType)]
    flags = [_flag(c) for c in whole]
    reduced = {"highest": ("cummax", np.maximum), "lowest": ("cummin", np.minimum), "total": ("cumsum", np.add)}
    neutral = {"highest": np.iinfo("int64").min, "lowest": np.iinfo("int64").max, "total": 0}

    def step(r: _Rows) -> tuple[pd.DataFrame, dict[str, np.ndarray]]:
        known = r.running("_known", "cumsum") + r.before["known"][r.code]
        out, after = r.rows.copy(), {"known": known[r.last]}
        for name, (how, merge) in reduced.items():
            before = np.where(r.before["known"] > 0, r.before[name], neutral[name])
            running = merge(r.running(f"_{name}", how), before[r.code])
            after[name] = running[r.last]
            out[name] = pd.Series(running).astype("Int64").mask(known == 0)
        return out[[key, *order, *flags, *reduced]], after

    named = ", ".join([f"{c} {kinds[c]}" for c in (key, *order)] + [f"{c} boolean" for c in flags] + [f"{c} long" for c in reduced])
    more = {"_known": v.isNotNull().cast("long"), **{f"_{name}": F.coalesce(v, F.lit(neutral[name]).cast("long")) for name in reduced}}
    out = _in_buckets(df, key, order, more, named, {"known": 0, "highest": 0, "lowest": 0, "total": 0}, step, _idle(idle_ms), idle_ms, buckets)
    return out.select(key, *[F.when(~F.col(_flag(c)), F.col(c)).alias(c) if c in whole else F.col(c) for c in order], *reduced)


def fraud_agent_stream(df: DataFrame, key: str, ts: str, tie: str, place: str, limit: int, seconds: int, buckets: int = BUCKETS) -> DataFrame:
    """Alerts (``tie``, rule) of a keyed agent whose state expires.

    Per key the state holds the current window of ``seconds`` with its count, the last place and when it was seen. A row
    beyond ``limit`` in its window gives ``high_frequency``; one at another place than the row at most ``seconds`` before
    it ``place_change``, if both places are known. Once the watermark is ``seconds`` past a key's last row its state is dropped. Rows of a key are
    taken in order of time within a micro-batch, and micro-batches must follow each other in time. The stream needs a
    watermark on ``ts``.
    """
    width, kind, flag, whole = seconds * 1_000_000, df.schema[tie].dataType.simpleString(), _flag(tie), isinstance(df.schema[tie].dataType, T.IntegralType)

    def step(r: _Rows) -> tuple[pd.DataFrame, dict[str, np.ndarray]]:
        at = np.maximum(r.rows[ts].to_numpy("datetime64[us]").astype("int64"), -2 ** 62)
        places = r.rows["_place"].astype(object).where(r.rows["_place"].notna(), None).to_numpy()
        window, seen = at // width, r.before["count"] > 0
        first = np.flatnonzero(np.r_[True, (r.code[1:] != r.code[:-1]) | (window[1:] != window[:-1])])
        runs = np.diff(np.r_[first, len(window)])
        of = r.code[first]
        held = np.where(window[first] == r.before["window"][of], r.before["count"][of], 0)
        number = np.arange(len(window)) + np.repeat(1 + held - first, runs)
        was = r.previous(places, r.before["place"])
        gone = at - r.previous(at, np.where(seen, r.before["at"], -2 ** 62))
        both = pd.notna(was) & pd.notna(places)
        moved = both & (was != places) & (gone <= width)
        alerts = [pd.DataFrame({tie: r.rows[tie][flags], flag: r.rows[flag][flags] if whole else False, "rule": rule})
                  for flags, rule in ((number > limit, "high_frequency"), (moved, "place_change"))]
        after = {"window": window[r.last], "count": number[r.last], "place": places[r.last], "at": at[r.last]}
        return pd.concat(alerts), {**after, "until": after["at"] // 1000 + seconds * 1000 + 1}

    out = _in_buckets(df, key, [ts, tie], {"_place": F.col(place).cast("string")}, f"{tie} {kind}, {flag} boolean, rule string",
                      {"window": 0, "count": 0, "place": None, "at": 0}, step, GroupStateTimeout.EventTimeTimeout, None, buckets)
    return out.select(F.when(~F.col(flag), F.col(tie)).alias(tie), "rule")


def session_tracker(df: DataFrame, key: str, ts: str, tie: str, action: str, idle: int, chunk: int | Column | None = None) -> DataFrame:
    """Sessions per user with their last action, action count, start and last time seen.

    On a stream (with a watermark) a session comes out when it is over, without its number.
    """
    newest = F.struct(F.col(ts).alias("ts"), F.col(tie).alias("tie"), F.col(action).alias("action"))
    if df.isStreaming:
        live = df.groupBy(F.session_window(ts, f"{idle} seconds").alias("w"), key).agg(
            F.count("*").alias("actions"), F.max(newest).alias("_newest"))
        return live.select(key, F.col("w.start").alias("session_start"), F.col("_newest.ts").alias("last_seen"), "actions",
                           F.col("_newest.action").alias("last_action"))
    out = O.sessions(df, [key], ts, idle, {"actions": ("count", F.lit(1)), "_newest": ("max", newest)}, chunk, "last_event")
    return out.select(key, "session_no", "session_start", F.col("session_end").alias("last_seen"), "actions",
                      F.col("_newest.action").alias("last_action"))
