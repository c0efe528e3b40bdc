"""A progress table kept as a log: triggers append changes, readers resolve them, compaction rewrites touched buckets.

    path/base/c=<n>/bucket=<k>          rows of bucket k with the changes up to trigger n (c=-1: as created)
    path/changes/batch=<n>/bucket=<k>   changes of trigger n

A folder counts once it is complete (it has its _SUCCESS file), so a trigger or compaction that broke off is not seen, and
its repetition overwrites it. What a trigger writes is its changes, not the table.
"""

from pyspark.sql import functions as F

from unitgrid.operators.contract import apply_updates
from unitgrid.schema import TERMINAL
from unitgrid.session import numbered

CHANGE = "gid_3 string, month long, field string, state string, error string, batch long"


def settle(updates, order=("ts", "seq")):
    """One update per (gid, month, field): the first finished state, else the newest."""
    done = F.col("state").isin(*TERMINAL)
    pick = F.struct("state", "error")
    return (updates.groupBy("gid_3", "month", "field")
            .agg(F.coalesce(F.min_by(pick, F.when(done, F.struct(*order))),
                            F.max_by(pick, F.struct(*order))).alias("r"))
            .select("gid_3", "month", "field", "r.state", "r.error"))


def by_month(updates):
    """Updates of a whole unit (NULL month) as one for each month that has none of its own."""
    every = F.when(F.col("month").isNull(), F.array(*[F.lit(m).cast("long") for m in range(1, 13)])).otherwise(F.array("month"))
    rows = updates.select("gid_3", "field", "state", "error", F.col("month").isNotNull().alias("own"), F.explode(every).alias("month"))
    return (rows.groupBy("gid_3", "month", "field").agg(F.max_by(F.struct("state", "error"), "own").alias("r"))
            .select("gid_3", "month", "field", "r.state", "r.error"))


class LogTable:
    """Log-structured table of unit-months."""

    def __init__(self, spark, path, schema, buckets=32):
        self.spark, self.path, self.schema, self.buckets = spark, path, schema, buckets

    def _bucketed(self, df):
        return df.withColumn("bucket", F.pmod(F.xxhash64("gid_3"), F.lit(self.buckets))).repartition("bucket")

    def exists(self):
        return bool(numbered(self.spark, f"{self.path}/base", "c=", complete=True))

    def create(self, table):
        self._bucketed(table).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/c=-1")

    def append(self, updates, batch):
        """Write the settled updates of trigger `batch`; a repetition overwrites them."""
        rows = by_month(updates).withColumn("batch", F.lit(batch).cast("long"))
        self._bucketed(rows).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/changes/batch={batch}")

    def _newest(self):
        """{bucket: number of the newest complete version that holds it}."""
        found = {}
        for c in numbered(self.spark, f"{self.path}/base", "c=", complete=True):
            found |= dict.fromkeys(numbered(self.spark, f"{self.path}/base/c={c}", "bucket="), c)
        return found

    def open_changes(self):
        """{bucket: [trigger, ...]} of the changes that no version holds yet."""
        newest, left = self._newest(), {}
        for n in numbered(self.spark, f"{self.path}/changes", "batch=", complete=True):
            for k in numbered(self.spark, f"{self.path}/changes/batch={n}", "bucket="):
                if n > newest.get(k, -1):
                    left.setdefault(k, []).append(n)
        return left

    def _resolved(self, newest, left):
        """Rows of the buckets in `newest` with the changes in `left`. Only listed folders are read."""
        read = lambda schema, paths: self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        base = read(self.schema, [f"{self.path}/base/c={c}/bucket={k}" for k, c in sorted(newest.items())])
        changes = read(CHANGE, [f"{self.path}/changes/batch={n}/bucket={k}" for k, batches in sorted(left.items()) for n in batches])
        return apply_updates(base, settle(changes, ["batch"]))

    def read(self):
        """The table with all complete changes applied."""
        return self._resolved(self._newest(), self.open_changes())

    def compact(self):
        """Write the buckets that have open changes anew; the others stay where they are. Returns their numbers."""
        newest, left = self._newest(), self.open_changes()
        touched = sorted(k for k in left if k in newest)
        if touched:
            last = max(n for k in touched for n in left[k])
            rows = self._resolved({k: newest[k] for k in touched}, {k: left[k] for k in touched})
            self._bucketed(rows).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/c={last}")
        return touched
