"""Global order, ranks and running sums without a single-task window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from unitgrid.functions.text import natural_key
from unitgrid.session import materialize

_ROW_BITS = 33     # layout of monotonically_increasing_id: partition number above 33 bits of row number


def _positions(df, order):
    """Range-sort, then pin every row's partition and place in it.

    `order` must be total (end it with a unique column), which also lets range boundaries fall inside
    a run of equal leading values.
    """
    placed = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    placed = materialize(placed, "order")
    return (placed.withColumn("_part", F.shiftright("_mid", _ROW_BITS))
            .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).drop("_mid"))


def _offsets(totals, value):
    """Exclusive running sum over partitions; one row per partition, so bounded by their number."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_part", F.coalesce(F.sum(value).over(before), F.lit(0)).alias("_offset"))


def rank_rows(df, order, name="rank"):
    """Row number in the global order `order`: range sort, per-partition counts, offsets."""
    placed = _positions(df, order)
    counts = placed.groupBy("_part").agg((F.max("_pos") + 1).alias("_n"))
    return (placed.join(F.broadcast(_offsets(counts, "_n")), "_part")
            .withColumn(name, F.col("_offset") + F.col("_pos") + 1).drop("_part", "_pos", "_offset"))


def rank_in_groups(df, group, order, name="rank"):
    """Row number inside each group: one range sort by group and order; a group of any size stays spread over its partitions.

    A partition's share of a group starts where the earlier partitions' shares end, so the join is on (partition, group).
    """
    placed = _positions(df, [*group, *order])
    shares = placed.groupBy("_part", *group).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("_part", *group, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(shares, ["_part", *group]).withColumn(name, F.col("_pos") + F.col("_shift") + 1).drop("_part", "_pos", "_shift")


def running_sum(df, order, value, name):
    """Inclusive running sum of an integer column in the global order `order`."""
    placed = _positions(df.withColumn("_v", value), order)
    totals = placed.groupBy("_part").agg(F.sum("_v").alias("_n"))
    here = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return (placed.withColumn("_sum", F.sum("_v").over(here)).join(F.broadcast(_offsets(totals, "_n")), "_part")
            .withColumn(name, F.col("_offset") + F.col("_sum")).drop("_part", "_pos", "_offset", "_sum", "_v"))


def natural_order(df, gid="gid_3", then=(), name="rank"):
    """Rank by natural key of `gid`, then by the columns `then`."""
    return rank_rows(df.withColumn("_key", natural_key(gid)), ["_key", *then], name).drop("_key")


def nulls_first_order(df, columns, name="rank"):
    """Rank by several columns, NULLs before values."""
    return rank_rows(df, [F.col(c).asc_nulls_first() for c in columns], name)


def head_per_group(df, group, order, n):
    """First n rows of each group; the rank limit is applied before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def head(df, order, n):
    """First n rows of the whole table (take-ordered: each task keeps n rows)."""
    return df.orderBy(*order).limit(n)


def pilot_sample(admin, n, types=("phường", "xã"), kind="type_3", gid="gid_3"):
    """n units alternating between the given types in natural order, topped up from the rest.

    Only the first n of each type can be picked, so each pool is a take-ordered of n rows.
    """
    keyed = admin.withColumn("_key", natural_key(gid)).withColumn("_type", F.lower(F.trim(kind)))
    pools = None
    for slot, name in enumerate(types):
        pool = keyed.filter(F.col("_type") == name).orderBy("_key").limit(n)
        pool = pool.withColumn("_turn", F.row_number().over(Window.orderBy("_key"))).withColumn("_slot", F.lit(slot))
        pools = pool if pools is None else pools.unionByName(pool)
    rest = (keyed.filter(~F.coalesce(F.col("_type").isin(*types), F.lit(False))).orderBy("_key").limit(n)
            .withColumn("_turn", F.lit(n + 1)).withColumn("_slot", F.lit(len(types))))
    return (pools.unionByName(rest).orderBy("_turn", "_slot", "_key").limit(n)
            .drop("_turn", "_slot", "_key", "_type"))
