"""Saved summaries that follow inserts, updates and deletes, and still know minimum, maximum and distinct counts.

A change is a signed row: plus the new row, minus the old one. Counts and sums retract by themselves. Minimum, maximum and distinct
count do not, so for the columns that need them the summary keeps a counted multiset: how often each group holds each
value. A batch folds to one row per group and one per (group, value); only those are looked up, added to and written again, as a
delta of the saved table, so a batch costs what it changes. A batch is named by a tag and counts once, however often it is applied.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.ordered import null_safe_join
from tidemill.operators.versioned import VersionedTable
from tidemill.session import materialize


class RetractableSummary:
    """Per group of ``keys``: ``n`` rows, ``sums`` (name -> column over a signed row), and min, max and distinct of ``values`` columns.

    Sums should be of DECIMAL or whole numbers, so that what is added can be taken away without a rest. A NULL key is a
    group; NULL values are in no minimum, maximum or distinct count.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], sums: Mapping[str, Column], values: Sequence[str] = (),
                 compact_every: int = 20):
        self.keys, self.sums, self.values, self.compact_every = list(keys), dict(sums), list(values), compact_every
        self._totals = VersionedTable(spark, f"{path}/totals", self.keys)
        self._multisets = {v: VersionedTable(spark, f"{path}/values_{v}", [*self.keys, v]) for v in self.values}

    def apply(self, signed: DataFrame, tag: str) -> None:
        """Take in a batch of signed rows (keys, columns, ``sign`` 1 or -1). More removals than there are rows are an error."""
        if self.values:
            needed = [f.name for f in signed.schema.fields]
            signed = materialize(signed.select(*needed), "signed")
        sign = F.col("sign").cast("long")
        totals = signed.groupBy(*self.keys).agg(F.sum(sign).alias("n"), *[F.sum(c * sign).alias(name) for name, c in self.sums.items()])
        self._fold(self._totals, totals, ["n", *self.sums], tag)
        for v, table in self._multisets.items():
            counts = signed.where(F.col(v).isNotNull()).groupBy(*self.keys, v).agg(F.sum(sign).alias("n"))
            self._fold(table, counts.where("n <> 0"), ["n"], tag)

    def _fold(self, table: VersionedTable, delta: DataFrame, numbers: Sequence[str], tag: str) -> None:
        if table.has_tag(tag):
            return
        types = {f.name: f.dataType for f in delta.schema.fields}
        if table.exists():
            saved = table.read()
            types = {f.name: f.dataType for f in saved.schema.fields}
            touched = null_safe_join(saved, delta.select(*table.keys), table.keys)
            delta = touched.unionByName(delta).groupBy(*table.keys).agg(*[F.sum(c).alias(c) for c in numbers])
        enough = F.assert_true(F.col("n") >= 0, F.lit("more rows are taken away than there are"))
        out = delta.where(enough.isNull()).select(*[F.col(c).cast(types[c]).alias(c) for c in types])
        table.upsert(out, tag)
        if table.deltas() >= self.compact_every:
            table.write(table.read().where("n <> 0"))

    def read(self) -> DataFrame:
        """(keys, n, sums, min_<value>, max_<value>, distinct_<value>) of the groups that have rows."""
        out = self._totals.read().where("n > 0")
        for v, table in self._multisets.items():
            folded = table.read().where("n > 0").groupBy(*self.keys).agg(
                F.min(v).alias(f"min_{v}"), F.max(v).alias(f"max_{v}"), F.count(v).alias(f"distinct_{v}"))
            folded = folded.withColumnsRenamed({k: f"_r_{k}" for k in self.keys})
            on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in self.keys]
            out = out.join(folded, on, "left").drop(*[f"_r_{k}" for k in self.keys]).withColumn(
                f"distinct_{v}", F.coalesce(f"distinct_{v}", F.lit(0).cast("long")))
        return out
