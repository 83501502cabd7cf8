"""A Parquet table kept as numbered, immutable snapshots.

Each write makes a new directory, which counts once Spark's own ``_SUCCESS`` marker is in
it. A reader never sees a half-written table, a failed writer leaves the last snapshot in
place, and older snapshots can still be read. One writer at a time is assumed.

A keyed table may also take small changes as deltas: only the changed rows are written,
and a reader lays the newest row of each key over the last snapshot. ``compact`` folds
them into a new snapshot, so that the cost of a change does not grow with the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.relational import top_n_per_group
from tidemill.session import hadoop_fs


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ()):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    def _entries(self) -> list[tuple[int, str, bool]]:
        """(number, directory name, committed) in rising order; v.. is a snapshot, d.. a delta."""
        fs, root = hadoop_fs(self.spark, self.path)
        if not fs.exists(root):
            return []
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path
        out = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if status.isDirectory() and name[0] in "vd" and name[1:9].isdigit():
                out.append((int(name[1:9]), name, fs.exists(jpath(status.getPath(), "_SUCCESS"))))
        return sorted(out)

    def _committed(self) -> list[tuple[int, str]]:
        return [(n, name) for n, name, done in self._entries() if done]

    def versions(self) -> list[int]:
        return [n for n, _ in self._committed()]

    def exists(self) -> bool:
        return bool(self._committed())

    def read(self, version: int | None = None) -> DataFrame:
        """The table now, or as it was after a version."""
        done = [(n, name) for n, name in self._committed() if version is None or n <= version]
        if not done:
            raise FileNotFoundError(f"no committed version below {self.path}")
        base = max((n for n, name in done if name[0] == "v"), default=0)
        snapshot = [name for n, name in done if n == base]
        deltas = [(n, name) for n, name in done if n > base]
        table = self.spark.read.parquet(f"{self.path}/{snapshot[0]}") if snapshot else None
        if not deltas:
            return table
        changes = None
        for n, name in deltas:
            one = self.spark.read.parquet(f"{self.path}/{name}").withColumn("_version", F.lit(n))
            changes = one if changes is None else changes.unionByName(one)
        newest = top_n_per_group(changes, self.keys, [F.col("_version").desc()], 1, "_rn").drop("_version", "_rn")
        if table is None:
            return newest
        changed = newest.select(*[F.col(k).alias(f"_n_{k}") for k in self.keys])
        same = [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in self.keys]  # a NULL key is a key like others
        return table.join(changed, same, "left_anti").unionByName(newest)

    def _write(self, df: DataFrame, kind: str, tag: str | None) -> int:
        number = max((n for n, _, _ in self._entries()), default=0) + 1
        name = f"{kind}{number:08d}" + (f"-{tag}" if tag else "")
        df.write.mode("errorifexists").parquet(f"{self.path}/{name}")
        return number

    def write(self, df: DataFrame, tag: str | None = None) -> int:
        """Write the next snapshot. ``tag`` marks what it holds, e.g. a stream's batch."""
        return self._write(df, "v", tag)

    def upsert(self, df: DataFrame, tag: str | None = None) -> int:
        """Write changed rows (one per key) as a delta."""
        if not self.keys:
            raise ValueError("a table without keys takes no deltas")
        return self._write(df, "d", tag)

    def deltas(self) -> int:
        """Number of deltas since the last snapshot."""
        done = self._committed()
        base = max((n for n, name in done if name[0] == "v"), default=0)
        return sum(n > base for n, _ in done)

    def compact(self) -> int:
        return self.write(self.read())

    def has_tag(self, tag: str) -> bool:
        return any(name.endswith(f"-{tag}") for _, name in self._committed())

    def expire(self, keep: int) -> None:
        """Drop what only versions older than the newest ``keep`` snapshots need."""
        fs, _ = hadoop_fs(self.spark, self.path)
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path
        done = self._committed()
        kept = [n for n, name in done if name[0] == "v"][-keep:]
        for n, name in done:
            if kept and n < kept[0]:
                fs.delete(jpath(f"{self.path}/{name}"), True)
