"""Shop analytics: session funnel, page counts, carts kept as events, dashboard and alerts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.exact import dec
from tidemill.operators.ordered import micros, previous, session_ids
from tidemill.operators.relational import top_n
from tidemill.plans.reports import answer, stack
from tidemill.session import hadoop_fs, materialize
from tidemill.sinks.files import write_partitioned


# ---- funnel

def funnel(df: DataFrame, user: str, ts: str, step: str, steps: Sequence[str], gap: int, chunk: int | Column | None = None) -> DataFrame:
    """Sessions that reach each step, with step and total conversion in percent.

    A step counts when its first occurrence in the session follows that of the step before.
    """
    rows = session_ids(df.select(user, ts, step), [user], ts, gap, chunk)
    firsts = rows.groupBy(user, "session_no").agg(*[F.min(F.when(F.col(step) == s, F.col(ts))).alias(f"_t{i}") for i, s in enumerate(steps)])
    reached, tests = F.col("_t0").isNotNull(), []
    for i in range(len(steps)):
        if i:
            reached = reached & (F.col(f"_t{i}") > F.col(f"_t{i - 1}"))
        tests.append(F.count_if(reached).alias(f"n{i}"))
    wide = firsts.agg(*tests)
    rows_ = [F.struct(F.lit(i + 1).alias("step_no"), F.lit(s).alias("step"), F.col(f"n{i}").alias("sessions"),
                      (F.col(f"n{i}") * 100.0 / F.nullif(F.col(f"n{max(i - 1, 0)}"), F.lit(0))).alias("step_pct"),
                      (F.col(f"n{i}") * 100.0 / F.nullif(F.col("n0"), F.lit(0))).alias("total_pct")) for i, s in enumerate(steps)]
    return wide.select(F.explode(F.array(*rows_)).alias("r")).select("r.*")


def transition_matrix(df: DataFrame, user: str, order: Sequence[str], step: str, gap: int, chunk: int | Column | None = None) -> DataFrame:
    """Counts of step pairs that follow each other within a session."""
    prev = previous(df.select(user, *order, step), [user], order, {"from_step": step, "_at": order[0]}, chunk)
    near = micros(order[0]) - micros("_at") <= gap * 1_000_000
    return prev.where(F.col("from_step").isNotNull() & near).groupBy("from_step", F.col(step).alias("to_step")).agg(F.count("*").alias("n"))


def page_and_referrer_counts(df: DataFrame, ts: str, size: str, page: str, referrer: str) -> DataFrame:
    """Views per page and referrals per source in each window, from one pass."""
    both = F.explode(F.array(F.struct(F.lit("page").alias("kind"), F.col(page).alias("name")),
                             F.struct(F.lit("referrer").alias("kind"), F.col(referrer).alias("name")))).alias("x")
    rows = df.select(ts, both).where("x.name IS NOT NULL")
    return (rows.groupBy(F.window(ts, size).alias("w"), "x.kind", "x.name").agg(F.count("*").alias("n"))
            .select(F.col("w.start").alias("window_start"), "kind", "name", "n"))


# ---- carts

def cart_state(events: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The events of (cart, product, type, quantity, unit_price, code, .., ts, id) until a time, folded to what a cart can be told from.

    Per (cart, product) the newest add, removal and quantity change, per (cart, code) the newest discount event, per cart its last
    time. All are maxima: states of two stretches of time fold to the state of both, and a cart of any length is never
    drawn together.
    """
    rows = events if as_of is None else events.where(F.col("ts") <= as_of)
    at = F.struct("ts", "id")

    def newest(kind: str, value: Column) -> Column:
        return F.when(F.col("type") == kind, F.struct(at.alias("at"), value.alias("v")))
    entry = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
    entries = F.filter(F.array(entry("cart", F.lit(None).cast("string")), F.when(F.col("product").isNotNull(), entry("item", F.col("product").cast("string"))),
                               F.when(F.col("code").isNotNull(), entry("code", F.col("code").cast("string")))), lambda e: e.isNotNull())
    item, code = F.col("e.kind") == "item", F.col("e.kind") == "code"
    told = rows.withColumn("e", F.explode(entries))
    return fold_cart_states(told.select(
        "cart", "e.kind", "e.name", F.col("ts").alias("last"), F.when(item, newest("cart.item_added", F.struct(F.col("quantity").alias("q"), F.col("unit_price").alias("p")))).alias("a"),
        F.when(item, newest("cart.item_removed", F.lit(0))).alias("r"), F.when(item, newest("cart.item_quantity_changed", F.col("quantity"))).alias("c"),
        F.when(code, F.struct(at.alias("at"), "type", "discount_type", "discount_value")).alias("d")))


def fold_cart_states(states: DataFrame) -> DataFrame:
    return states.groupBy("cart", "kind", "name").agg(*[F.max(c).alias(c) for c in ("last", "a", "r", "c", "d")])


def _items(state: DataFrame) -> DataFrame:
    """(cart, product, quantity, unit_price): the newest add and removal of a product decide whether it is there, the newest add or later
    quantity change gives its quantity."""
    there = F.col("a").isNotNull() & (F.col("r").isNull() | (F.col("a.at") > F.col("r.at")))
    quantity = F.when(F.col("c.at") > F.col("a.at"), F.col("c.v")).otherwise(F.col("a.v.q"))
    items = state.where((F.col("kind") == "item") & there).select("cart", F.col("name").alias("product"), quantity.alias("quantity"), F.col("a.v.p").alias("unit_price"))
    return items.where("quantity > 0")


def cart_totals(state: DataFrame) -> DataFrame:
    """Subtotal, discount and total per cart from its folded state; carts without items have 0. The newest event of each code applies it."""
    carts = state.where("kind = 'cart'").select("cart", F.col("last").alias("last_updated"))
    sums = _items(state).groupBy("cart").agg(F.sum("quantity").alias("item_count"), F.count("*").alias("unique_items"),
                                             F.sum(dec("unit_price", 2) * F.col("quantity")).cast("decimal(18,2)").alias("subtotal"))
    discounts = state.where("kind = 'code' AND d.type = 'cart.discount_applied'").select("cart", F.col("name").alias("code"), "d.discount_type", "d.discount_value")
    pct = F.sum(F.when(F.col("discount_type") == "percentage", dec("discount_value", 2)))
    fixed = F.sum(F.when(F.col("discount_type") == "fixed", dec("discount_value", 2)))
    # a cart has few codes; the list is ordered so that it does not depend on arrival
    off = discounts.groupBy("cart").agg(F.coalesce(pct, dec(F.lit(0), 2)).alias("pct"), F.coalesce(fixed, dec(F.lit(0), 2)).alias("fixed"),
                                        F.array_join(F.sort_array(F.collect_set("code")), ",").alias("discounts"))
    zero = F.lit(0).cast("decimal(18,2)")
    out = carts.join(sums, "cart", "left").join(off, "cart", "left")
    subtotal = F.coalesce("subtotal", zero)
    discount = F.round(F.least(subtotal, subtotal * F.coalesce("pct", zero) / 100 + F.coalesce("fixed", zero)), 2)
    return out.select("cart", F.coalesce("item_count", F.lit(0)).cast("bigint").alias("item_count"),
                      F.coalesce("unique_items", F.lit(0)).alias("unique_items"), subtotal.cast("double").alias("subtotal"),
                      discount.cast("double").alias("discount"), (subtotal - discount).cast("double").alias("total"),
                      F.coalesce("discounts", F.lit("")).alias("discounts"), "last_updated")


def cart_replay(events: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Carts as they were at a time, from all events until then."""
    return cart_totals(cart_state(events, as_of))


def save_cart_snapshots(events: DataFrame, path: str, times: Sequence[str]) -> None:
    """The folded state at each of some times, in a directory each; every one is made of the one before and the events since."""
    spark, before, since = events.sparkSession, None, None
    for time in sorted(times):
        until = F.lit(time).cast(events.schema["ts"].dataType)
        fresh = cart_state(_since(events, since, until))
        state = fresh if before is None else fold_cart_states(before.unionByName(fresh))
        name = dt.datetime.fromisoformat(time).strftime("%Y%m%dT%H%M%S")
        state.write.mode("overwrite").parquet(f"{path}/at={name}")
        before, since = spark.read.parquet(f"{path}/at={name}"), until


def _since(events: DataFrame, after: Column | None, until: Column) -> DataFrame:
    """Events in (after, until]. Where the events are partitioned by ``day``, only the days of that stretch are read."""
    rows = events.where(F.col("ts") <= until)
    rows = rows if after is None else rows.where(F.col("ts") > after)
    if "day" in events.columns:
        rows = rows.where(F.col("day") <= F.to_date(until))
        rows = rows if after is None else rows.where(F.col("day") >= F.to_date(after))
    return rows


def cart_replay_from(path: str, events: DataFrame, as_of: str) -> DataFrame:
    """``cart_replay`` by way of the newest snapshot that is not after ``as_of``: that and the later events are all that is read."""
    spark = events.sparkSession
    fs, root = hadoop_fs(spark, path)
    named = [s.getPath().getName().removeprefix("at=") for s in fs.listStatus(root)] if fs.exists(root) else []
    wanted = dt.datetime.fromisoformat(as_of).strftime("%Y%m%dT%H%M%S")
    usable = [n for n in named if n[:1].isdigit() and n <= wanted]
    until = F.lit(as_of).cast(events.schema["ts"].dataType)
    if not usable:
        return cart_totals(cart_state(_since(events, None, until)))
    newest = max(usable)
    after = F.lit(str(dt.datetime.strptime(newest, "%Y%m%dT%H%M%S"))).cast(events.schema["ts"].dataType)
    saved = spark.read.parquet(f"{path}/at={newest}")
    return cart_totals(fold_cart_states(saved.unionByName(cart_state(_since(events, after, until)))))


def cart_read_model(events: DataFrame, path: str) -> DataFrame:
    """The cart summary kept as a table."""
    cart_replay(events).write.mode("overwrite").parquet(path)
    return events.sparkSession.read.parquet(path)


# ---- dashboard and alerts

def save_dashboard_tables(orders: DataFrame, path: str) -> None:
    """Aggregates the dashboard reads, from (ts, id, customer, category, status, amount), in one pass over the orders.

    One table per grain: minutes by category and status, and days by customer. Neither grows with customers times minutes.
    """
    rows = orders.select(F.to_date("ts").alias("day"), F.date_trunc("minute", F.col("ts")).alias("minute"), "category", "status", "customer", "amount")
    folded = rows.groupingSets([["day", "minute", "category", "status"], ["day", "customer"]], "day", "minute", "category", "status", "customer").agg(
        F.when(F.grouping("customer") == 1, "minute").otherwise("customer").alias("grain"), F.count("*").alias("orders"), F.sum(dec("amount", 2)).alias("revenue"))
    write_partitioned(folded, f"{path}/folded", ["grain", "day"])


def revenue_dashboard(orders: DataFrame, path: str, as_of: str, back: int, top: int = 10, latest: int = 20) -> DataFrame:
    """Panels over the ``back`` seconds before ``as_of``: per minute, totals, category, status, customers, latest.

    Panels by minute, category and status come from one pass over the saved minutes. Customers come from the saved whole days, and from the
    orders for what the range has of a day at its ends. The list of latest orders reads the orders. ``as_of`` is taken to the minute.
    """
    end = dt.datetime.fromisoformat(as_of)
    start = end - dt.timedelta(seconds=back)
    midnight = dt.datetime.combine(start.date(), dt.time())
    whole_from = midnight if midnight == start else midnight + dt.timedelta(days=1)
    whole_to = max(dt.datetime.combine(end.date(), dt.time()), whole_from)
    at = lambda t: F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")
    within = lambda c, lo, hi: (F.col(c).cast("timestamp_ntz") >= at(lo)) & (F.col(c).cast("timestamp_ntz") < at(hi))
    saved = orders.sparkSession.read.parquet(f"{path}/folded")
    recent = saved.where((F.col("grain") == "minute") & F.col("day").between(F.lit(start.date()), F.lit(end.date())) & within("minute", start, end))
    sums = [F.sum("revenue").cast("double").alias("revenue"), F.sum("orders").alias("orders")]
    panels = recent.groupingSets([["minute"], ["category"], ["status"], []], "minute", "category", "status").agg(F.grouping_id().alias("g"), *sums)
    stamp = F.date_format("minute", "yyyy-MM-dd HH:mm")

    def row(question: str, label: Column, value: Column) -> Column:
        return F.struct(F.lit(question).alias("question"), label.cast("string").alias("label"), value.cast("double").alias("value"))
    revenue, count = F.col("revenue"), F.col("orders")
    answers = (F.when(F.col("g") == 0b011, F.array(row("orders_per_minute", stamp, count), row("revenue_per_minute", stamp, revenue)))
               .when(F.col("g") == 0b101, F.array(row("category", F.col("category"), revenue)))
               .when(F.col("g") == 0b110, F.array(row("status", F.col("status"), count)))
               .otherwise(F.array(row("total", F.lit("orders"), count), row("total", F.lit("revenue"), revenue), row("total", F.lit("mean_order"), revenue / count))))
    panels = panels.select(F.explode(answers).alias("a")).select("a.*")

    customers = saved.where((F.col("grain") == "customer") & (F.col("day") >= F.lit(whole_from.date())) & (F.col("day") < F.lit(whole_to.date()))).select(
        "customer", "revenue")
    ends = [(lo, hi) for lo, hi in ((start, min(whole_from, end)), (whole_to, end)) if lo < hi]
    if ends:
        edge = reduce(Column.__or__, [within("ts", lo, hi) for lo, hi in ends])
        customers = customers.unionByName(orders.where(edge).groupBy("customer").agg(F.sum(dec("amount", 2)).alias("revenue")))
    customers = top_n(customers.groupBy("customer").agg(sums[0]), [F.col("revenue").desc(), F.col("customer")], top)
    newest = top_n(orders.where(within("ts", start, end)).select("id", "ts", "amount"), [F.col("ts").desc(), F.col("id").desc()], latest)
    return stack([panels, answer(customers, "top_customers", F.col("customer"), F.col("revenue")),
                  answer(newest, "latest_orders", F.col("id"), F.col("amount"))])


def period_metrics(orders: DataFrame, size: str) -> DataFrame:
    """Orders, revenue and cancellations per period, silent periods included.

    The orders are folded once and the short list of periods is stored, as all that follows reads it several times.
    """
    from tidemill.operators.timewindows import gap_fill, tumbling
    per = tumbling(orders, "ts", size, orders=F.count("*"), revenue=F.sum(dec("amount", 2)),
                   cancelled=F.count_if(F.col("status") == "cancelled")).drop("window_end")
    per = materialize(per, "periods")
    filled = gap_fill(per, "window_start", size, {"orders": 0, "cancelled": 0})
    return filled.withColumn("revenue", F.coalesce("revenue", F.lit(0).cast("decimal(18,2)")))


def alert_states(periods: DataFrame, rules: Mapping[str, tuple[Column, int]], as_of: Sequence[Column]) -> DataFrame:
    """State of each rule at each of some times: normal, pending, or firing once its condition has held long enough.

    ``rules`` maps a name to (condition on a period, number of periods). The length of the
    current run is the number of periods after the last one that did not meet the condition.
    """
    flags = periods.select("window_start", *[F.coalesce(cond, F.lit(False)).alias(n) for n, (cond, _) in rules.items()])
    every = flags.unpivot(["window_start"], list(rules), "rule", "hit").withColumn("as_of", F.explode(F.array(*as_of)))
    long = every.where(F.col("window_start") < F.col("as_of"))
    last_ok = long.groupBy("as_of", "rule").agg(F.max(F.when(~F.col("hit"), F.col("window_start"))).alias("ok"))
    runs = long.join(last_ok, ["as_of", "rule"]).groupBy("as_of", "rule").agg(
        F.count_if(F.col("ok").isNull() | (F.col("window_start") > F.col("ok"))).alias("periods"))
    need = reduce(lambda w, kv: w.when(F.col("rule") == kv[0], F.lit(kv[1][1])), rules.items(), F.when(F.lit(False), F.lit(0)))
    state = F.when(F.col("periods") == 0, "normal").when(F.col("periods") < need, "pending").otherwise("firing")
    return runs.select("as_of", "rule", "periods", state.alias("state"))


def low_stock(stock: DataFrame, item: str, quantity: str, limit: float = 10) -> DataFrame:
    return stock.where(F.col(quantity) < limit).select(item, quantity)
