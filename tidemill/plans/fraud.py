"""Fraud rules on card transactions, in batch and on a stream, and the summary per user."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions import scalar as S
from tidemill.functions.exact import dec
from tidemill.operators.aggregates import last_n_reasons
from tidemill.operators.ordered import cut, micros, null_safe_join, running_sets
from tidemill.session import materialize
from tidemill.streaming.panes import BUCKETS, PaneWork, in_panes, key_text, packed, starts_of, unpacked


@dataclass(frozen=True)
class Limits:
    """Thresholds; a rule fires above its limit. Windows are in seconds, and trail by ``parts`` sub-buckets (1: fixed windows)."""
    count: int = 5
    count_window: int = 300
    value: float = 5000.0
    total: float = 10000.0
    total_window: int = 600
    merchants: int = 4
    full_value: float = 10000.0
    total_span: float = 25000.0
    parts: int = 1


def _bucket(at: Column, limits: Limits, seconds: int) -> Column:
    """The sub-bucket of a window that a time (in microseconds) falls in."""
    return F.floor(at / (seconds * 1_000_000 // limits.parts)).cast("long")


def alerts(rows: DataFrame, limits: Limits) -> DataFrame:
    """Alert rows (id, user, ts, rule, detail, risk) of transactions with their history columns was, n, merchants and total."""
    total, amount = F.col("total").cast("double"), F.col("amount")

    def rule(when: Column, name: str, detail: Column, risk: Column) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("rule"), detail.cast("string").alias("detail"), risk.cast("double").alias("risk")))
    fired = F.filter(F.array(
        rule(F.col("was").isNotNull() & (F.col("was") != F.col("country")), "country_hop", F.concat("was", F.lit(" -> "), "country"), F.lit(0.7)),
        rule(amount > limits.value, "high_value", F.format_number(amount, 2), S.risk_value(amount, limits.full_value)),
        rule(total > limits.total, "spending_velocity", F.format_number(total, 2), S.risk_velocity(total, limits.total, limits.total_span)),
        rule(F.col("n") > limits.count, "high_frequency", F.col("n"), S.risk_frequency(F.col("n"))),
        rule(F.col("merchants") > limits.merchants, "merchant_diversity", F.col("merchants"), F.lit(0.5))), lambda a: a.isNotNull())
    return rows.select("id", "user", "ts", F.explode(fired).alias("a")).select("id", "user", "ts", "a.rule", "a.detail", "a.risk")


def _over_parts(folded: DataFrame, bucket: str, parts: int) -> DataFrame:
    """Each row of a (user, bucket) once for every later bucket whose window still holds it."""
    later = F.explode(F.sequence(F.col(bucket) + 1, F.col(bucket) + parts - 1))
    return folded.withColumn(bucket, later)


def with_history(txns: DataFrame, limits: Limits = Limits(), chunk: int | Column | None = None) -> DataFrame:
    """Transactions with what their user did until then: ``was`` (country of the row before), ``n`` and ``merchants`` (rows and different
    merchants in the count window) and ``total`` (spent in the total window), the row included.

    One sorted copy of the transactions is written; all columns run over it together. A running count of different merchants is a
    running count of marks set at first occurrences.
    """
    order, at = ["ts", "id"], micros("ts")
    rows = txns.select("id", "user", "ts", "amount", "country", "merchant", _bucket(at, limits, limits.count_window).alias("b1"),
                       _bucket(at, limits, limits.total_window).alias("b2"))
    copy = cut(rows, ["user"], order, chunk)
    firsts = copy.groupBy("user", "b1", "merchant").agg(F.min(F.struct("ts", "id", "b2", "_chunk")).alias("f"))
    extra = []
    if limits.parts > 1:
        seen = F.lag("b1").over(Window.partitionBy("user", "merchant").orderBy("b1"))  # a merchant has a row per bucket at most
        firsts = firsts.withColumn("seen", seen)
        windows = copy.groupBy("user", "b1").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ts", "id", "b2", "_chunk")).alias("f"))
        members = _over_parts(firsts.select("user", "b1", "merchant"), "b1", limits.parts).distinct().groupBy("user", "b1").agg(F.count(F.lit(1)).alias("m"))
        counts = _over_parts(windows.select("user", "b1", "n"), "b1", limits.parts).groupBy("user", "b1").agg(F.sum("n").alias("n"))
        base = null_safe_join(null_safe_join(windows.select("user", "b1", "f"), counts, ["user", "b1"]), members, ["user", "b1"])
        sums = copy.groupBy("user", "b2").agg(F.sum(dec("amount", 2)).alias("s"), F.min(F.struct("ts", "id", "b1", "_chunk")).alias("f"))
        spent = _over_parts(sums.select("user", "b2", "s"), "b2", limits.parts).groupBy("user", "b2").agg(F.sum("s").cast("decimal(18,2)").alias("s"))
        spent = null_safe_join(sums.select("user", "b2", "f"), spent, ["user", "b2"])
        extra = [base.select("user", "b1", "f.ts", "f.id", "f.b2", "f._chunk", F.lit(0).alias("kind"), "n", "m"),
                 spent.select("user", "b2", "f.ts", "f.id", "f.b1", "f._chunk", F.lit(0).alias("kind"), "s")]
        firsts = firsts.where(F.col("seen").isNull() | (F.col("seen") <= F.col("b1") - limits.parts))
    one, money = F.lit(1).cast("long"), lambda c: F.col(c).cast("decimal(28,2)").alias("s")
    marked = copy.withColumns({"kind": F.lit(1), "n": one}).withColumn("s", money("amount")).unionByName(
        firsts.select("user", "b1", "f.ts", "f.id", "f.b2", "f._chunk", F.lit(0).alias("kind"), one.alias("m")), allowMissingColumns=True)
    for more in extra:
        marked = marked.unionByName(more, allowMissingColumns=True)
    history = running_sets(marked, ["user"], [*order, "kind"], {
        "_was": ((), "before", F.when(F.col("kind") == 1, F.struct(F.col("country").alias("place")))), "_n": (("b1",), "sum", F.col("n")),
        "merchants": (("b1",), "sum", F.col("m")), "total": (("b2",), "sum", F.col("s"))})
    return history.where("kind = 1").select("id", "user", "ts", "amount", "country", "merchant", F.col("_was.place").alias("was"),
                                            F.col("_n").alias("n"), "merchants", "total")


class _History(PaneWork):
    """Held per user: the last country, a ring of sub-buckets each for counts and sums, and each merchant's last sub-bucket.

    A trailing window costs its sub-buckets and not its rows; sub-buckets that have left it are evicted as later rows
    come, and all of them once the watermark has passed the window.
    """

    def __init__(self, limits: Limits, pane_seconds: int):
        super().__init__(pane_seconds, ["at_us", "tie"])
        self.parts = limits.parts
        self.count_width, self.total_width = (s * 1_000_000 // limits.parts for s in (limits.count_window, limits.total_window))

    def decode(self, text: str) -> list:
        place, counts, sums, merchants = json.loads(text)
        return [place, deque(counts), deque(sums), merchants]

    def encode(self, value: list) -> str:
        place, counts, sums, merchants = value
        return json.dumps([place, list(counts), list(sums), merchants], separators=(",", ":"))

    def work(self, rows: pd.DataFrame, held: dict) -> Iterator[pd.DataFrame]:
        cols = [rows[c].tolist() for c in ("at_us", "place", "merchant", "cents")]
        out: list[tuple] = []
        starts = starts_of(rows["k"]).tolist()
        for lo, hi in zip(starts, [*starts[1:], len(rows)]):
            k = rows["k"].iat[lo]
            was, *rings, seen = held.get(k) or [None, deque(), deque(), {}]
            inside = [sum(v for _, v in ring) for ring in rings]
            for at, place, merchant, cents in zip(*[c[lo:hi] for c in cols]):
                buckets = at // self.count_width, at // self.total_width
                for n, (ring, bucket, value) in enumerate(zip(rings, buckets, (1, cents))):
                    while ring and ring[0][0] <= bucket - self.parts:
                        inside[n] -= ring.popleft()[1]
                    if not ring or ring[-1][0] != bucket:
                        ring.append([bucket, 0])
                        if n == 0:
                            seen = {m: b for m, b in seen.items() if b > bucket - self.parts}
                    ring[-1][1] += value
                    inside[n] += value
                seen["-" if merchant is None else "+" + merchant] = buckets[0]
                out.append((was, inside[0], len(seen), inside[1]))
                was = place
            held[k] = [was, *rings, seen]
        yield pd.DataFrame(out, columns=["was", "n", "merchants", "total_cents"]).assign(body=rows["body"])[["body", "was", "n", "merchants", "total_cents"]]

    def evict(self, held: dict, passed: int) -> int | None:
        ends = []
        for value in held.values():
            for ring, width in zip(value[1:3], (self.count_width, self.total_width)):
                while ring and (ring[0][0] + self.parts) * width <= passed:
                    ring.popleft()
                ends += [(ring[-1][0] + self.parts) * width] if ring else []
            value[3] = {m: b for m, b in value[3].items() if (b + self.parts) * self.count_width > passed}
        return max(ends, default=None)


def with_history_stream(txns: DataFrame, limits: Limits, delay: str, pane_seconds: int, buckets: int = BUCKETS) -> DataFrame:
    """``with_history`` on a stream: the same columns for the same rows, whatever order they arrive in within ``delay``.

    A row comes out when the watermark has passed its pane. The last country of a user is kept; all other state leaves with
    its window. Amounts are money with two digits.
    """
    cols = ["id", "user", "ts", "amount", "country", "merchant"]
    cents = F.coalesce((dec("amount", 2) * 100).cast("long"), F.lit(0))
    rows = txns.select(key_text(txns, "user").alias("k"), F.col("ts").cast("timestamp").alias("event_time"), micros("ts").alias("at_us"), F.col("id").cast("long").alias("tie"),
                       F.col("country").cast("string").alias("place"), F.col("merchant").cast("string").alias("merchant"), cents.alias("cents"),
                       packed(cols).alias("body")).withWatermark("event_time", delay)
    out = in_panes(rows, _History(limits, pane_seconds), "body string, was string, n long, merchants long, total_cents long", buckets)
    total = (F.col("total_cents").cast("decimal(28,0)") / 100).cast("decimal(28,2)").alias("total")
    out = out.select(unpacked("body", txns.select(*cols).schema).alias("r"), "was", "n", "merchants", total)
    return out.select(*[F.col(f"r.{c}").alias(c) for c in cols], "was", "n", "merchants", "total")


def fraud_rules(txns: DataFrame, limits: Limits = Limits(), chunk: int | Column | None = None) -> DataFrame:
    """Alert rows of five rules over (id, user, ts, amount, country, merchant), see ``with_history`` and ``alerts``.

    With ``limits.parts`` 1 counts and sums run inside fixed windows per user; with more, a window is that many
    sub-buckets and trails the row.
    """
    return alerts(with_history(txns, limits, chunk), limits)


def fraud_rules_stream(txns: DataFrame, limits: Limits, delay: str, pane_seconds: int) -> DataFrame:
    return alerts(with_history_stream(txns, limits, delay, pane_seconds), limits)


def fraud_summary(alerts: DataFrame, last: int = 5) -> DataFrame:
    """Alerts per user with total and mean risk and the last reasons. The alerts are stored, as they are read twice."""
    kept = materialize(alerts.select("user", "ts", "id", "rule", "risk"), "alerts")
    return last_n_reasons(kept, "user", ["ts", "id", "rule"], "rule", "risk", last)
