"""Keys, duplicates, set operations and dimension joins."""

from functools import reduce

from pyspark.sql import functions as F

from unitgrid.operators.ordering import rank_rows
from unitgrid.schema import ADMIN_COLUMNS, FIELDS, TERMINAL


def keep_last(df, key, order):
    """One row per key, the last in `order`; max_by combines before the shuffle."""
    return _pick(df, key, order, F.max_by)


def keep_first(df, key, order):
    return _pick(df, key, order, F.min_by)


latest_by = keep_last


def _pick(df, key, order, chooser):
    rest = [c for c in df.columns if c not in key]
    best = chooser(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(*key).agg(best).select(*key, *[F.col("_r")[c].alias(c) for c in rest])


def drop_exact(df):
    """Exact duplicate rows collapse."""
    return df.distinct()


def duplicate_keys(df, key):
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def unknown_keys(df, dim, key="gid_3"):
    """Distinct key values absent from the dimension."""
    return df.filter(F.col(key).isNotNull()).select(key).distinct().join(dim.select(key), key, "left_anti")


def same_keys(left, right):
    """Join condition of paired columns in which NULL equals NULL."""
    return reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(left, right)])


def one_per_key(df, key, what):
    """The same rows; a key that occurs twice stops the job. One group-by, whose placement serves a join on the key."""
    rest = [c for c in df.columns if c not in key]
    rows = df.groupBy(*key).agg(F.count("*").alias("_n"), F.first(F.struct(F.lit(0).alias("_"), *rest)).alias("_r"))
    message = F.concat(F.lit(f"{what}: repeated key "), F.concat_ws("/", *[F.col(k).cast("string") for k in key]))
    good = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return rows.filter(good).select(*[F.col(c) if c in key else F.col("_r")[c].alias(c) for c in df.columns])


def enrich_admin(df, admin):
    """Names by gid: incoming name columns are replaced by the dimension's. A gid twice in `admin` stops the job."""
    own = [c for c in df.columns if c == "gid_3" or c not in ADMIN_COLUMNS]
    return df.select(*own).join(one_per_key(admin.select(*ADMIN_COLUMNS), ["gid_3"], "administrative table"), "gid_3", "left")


# Rows of a task that is about to write each of them many times.
SPREAD_ROWS = 10_000


def spread(df, key, rows=SPREAD_ROWS):
    """The same rows, placed by `key` in tasks of about `rows` rows each; counts `df` once.

    For rows that are multiplied next: a small file is one task, however many rows it grows into.
    """
    return df.repartition(max(1, -(-df.count() // rows)), *key)


def placed(df, key, rows, per_task=6 * SPREAD_ROWS):
    """The same rows, placed by `key` in tasks that are not merged by their compressed bytes, if `rows`, their number, is large.

    For rows that are joined next: long tables of keys and flags shrink so much that one task of merged partitions would sort
    millions of them. A small table is left as it is.
    """
    tasks = -(-rows // per_task)
    return df.repartition(tasks, *key) if tasks > 8 else df


def month_grid(units, year, months=range(1, 13), columns=("gid_3",)):
    """Every unit with every month of a year."""
    every = F.explode(F.array(*[F.lit(m).cast("long") for m in months]))
    return units.select(*columns, F.lit(year).cast("long").alias("year"), every.alias("month"))


def complete_grid(df, units, year, months=range(1, 13)):
    """Every unit gets every month; absent months have NULL metrics. A key twice on either side stops the job."""
    grid = month_grid(one_per_key(units.select("gid_3"), ["gid_3"], "units"), year, months)
    return grid.join(one_per_key(df, ["gid_3", "year", "month"], "table"), ["gid_3", "year", "month"], "left")


def reconcile_keys(left, right, key):
    """One row: keys missing on the right, extra on the right, and duplicated on the right."""
    def counted(df, name):
        return df.groupBy(*key).agg(F.count("*").alias(name))
    both = counted(left, "nl").join(counted(right, "nr"), key, "full")
    return both.agg(
        F.count_if(F.col("nr").isNull()).alias("missing"),
        F.count_if(F.col("nl").isNull()).alias("extra"),
        F.coalesce(F.sum(F.col("nr") - 1), F.lit(0)).alias("duplicated"))


def key_except(a, b, key):
    return a.select(*key).subtract(b.select(*key))


def key_intersect(a, b, key):
    return a.select(*key).intersect(b.select(*key))


def union_all(frames):
    """Union by name; columns missing on one side are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def month_complete(df, key="gid_3", months=12):
    """Distinct months per unit and whether all are there."""
    return (df.groupBy(key).agg(F.count_distinct("month").alias("months"))
            .withColumn("complete", F.col("months") == months))


def needed(progress, field, gids=None, month=None):
    """Units with unfinished work in a field, optionally restricted to a unit table and a month."""
    rows = progress.filter(~F.col(field).isin(*TERMINAL))
    if month is not None:
        rows = rows.filter(F.col("month") == month)
    rows = rows.select("gid_3").distinct()
    return rows if gids is None else rows.join(gids.select("gid_3"), "gid_3", "left_semi")


def in_provinces(df, provinces, column="gid_1"):
    return df.filter(F.col(column).isin(*provinces))


def resolve_ids(wanted, known, gid="gid_3"):
    """Match ids exactly, by base, by base + `_1`, else any id of the same base (smallest).

    One equi-join on the base (the id without its trailing version), then the best-ranked candidate
    per wanted id through min_by, which combines before the shuffle.
    """
    base = lambda c: F.regexp_replace(F.trim(c), r"_\d+$", "")
    w = wanted.select(F.trim(gid).alias("wanted")).distinct().withColumn("base", base(F.col("wanted")))
    k = known.select(F.col(gid).alias("resolved")).distinct().withColumn("base", base(F.col("resolved")))
    rank = (F.when(F.col("resolved") == F.col("wanted"), 1).when(F.col("resolved") == F.col("base"), 2)
            .when(F.col("resolved") == F.concat("base", F.lit("_1")), 3).otherwise(4))
    pairs = w.join(k, "base", "left").withColumn("rank", F.when(F.col("resolved").isNotNull(), rank))
    best = F.min_by(F.struct("resolved", "rank"), F.struct("rank", "resolved"))
    return (pairs.groupBy("wanted").agg(best.alias("b"))
            .select("wanted", F.col("b.resolved").alias("resolved"), F.col("b.rank").alias("rank")))


def listed(df, group, value, chunk=1000, order=None):
    """Values of each group in order, as lists of `chunk` values numbered from 0; the last list of a group may be shorter.

    All values are ranked in one global range sort and numbered within their group, so a list holds
    consecutive values whatever the group's size, and a large group becomes many rows.
    """
    order = order if order is not None else F.col(value)
    ranked = rank_rows(df.select(*group, F.col(value), order.alias("_order")), [*group, "_order", value], "_rank")
    firsts = ranked.groupBy(*group).agg(F.min("_rank").alias("_first")).toDF(*[f"_g{i}" for i in range(len(group))], "_first")
    numbered = (ranked.join(firsts, same_keys(group, [f"_g{i}" for i in range(len(group))]))
                .withColumn("chunk", F.floor((F.col("_rank") - F.col("_first")) / chunk)))
    items = F.sort_array(F.collect_list(F.struct("_rank", F.col(value))))
    return numbered.groupBy(*group, "chunk").agg(F.transform(items, lambda s: s[value]).alias(value + "s"), F.count("*").alias("n"))


def state_counts(progress, fields=FIELDS):
    """Units-months per field and state."""
    return (progress.unpivot([], list(fields), "field", "state").groupBy("field", "state")
            .agg(F.count("*").alias("n")))


def distinct_counts(df, columns):
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def newest(df, group, ts):
    return df.groupBy(*group).agg(F.max(ts).alias("newest"))
