"""Warehouse models: staging, customer dimension, order facts and the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.exact import dec
from tidemill.functions.scalar import surrogate_key


def staging_model(df: DataFrame, renames: Mapping[str, str], cents: Sequence[str] = (), casts: Mapping[str, str] | None = None) -> DataFrame:
    """Rename, bring cents to whole units, and set types."""
    out = df.select(*renames).withColumnsRenamed(dict(renames))
    out = out.withColumns({c: (F.col(c) / F.lit(100.0)) for c in cents}) if cents else out
    return out.withColumns({c: F.col(c).try_cast(t) for c, t in (casts or {}).items()}) if casts else out


def dim_customers(customers: DataFrame, orders: DataFrame, key: str, order_key: str, order_date: str, order_id: str) -> DataFrame:
    """Customers with first and latest order date and order count, 0 where there is none."""
    per = orders.groupBy(F.col(order_key).alias(key)).agg(
        F.min(order_date).alias("first_order"), F.max(order_date).alias("most_recent_order"),
        F.count(order_id).alias("number_of_orders"))
    return customers.join(per, key, "left").withColumn("number_of_orders", F.coalesce("number_of_orders", F.lit(0)))


def fct_orders(orders: DataFrame, payments: DataFrame, key: str, pay_key: str, amount: str, success: Column) -> DataFrame:
    """Orders with the total of their successful payments, 0 where there is none."""
    paid = payments.groupBy(F.col(pay_key).alias(key)).agg(F.sum(F.when(success, dec(amount, 2))).alias("amount"))
    return orders.join(paid, key, "left").withColumn("amount", F.coalesce("amount", F.lit(0)).cast("double"))


def star_schema(sales: DataFrame, dims: Mapping[str, tuple[DataFrame, Sequence[str]]],
                measures: Sequence[str]) -> dict[str, DataFrame]:
    """One dimension per source table and group of columns, keyed by a hash of them, and the facts.

    Keys are computed from the row, so the fact table needs no join to find them, and each
    dimension reads only its own table.
    """
    out = {name: table.select(*cols).distinct().select(surrogate_key(*[F.col(c) for c in cols]).alias(f"{name}_key"), *cols)
           for name, (table, cols) in dims.items()}
    keys = [surrogate_key(*[F.col(c) for c in cols]).alias(f"{name}_key") for name, (_, cols) in dims.items()]
    out["fct_sales"] = sales.select(*keys, *measures)
    return out
