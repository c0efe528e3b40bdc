"""Plumbing that the operators share: batches of texts, column names, parameters read from the session."""

import sys

from pyspark.sql import functions as F

from unitgrid.session import ship_by_value


def ship(*modules):
    """Send the task functions of these modules with the job; executors need not have the package."""
    for name in ("unitgrid.llm.textpack", *modules):
        if name in sys.modules:
            ship_by_value(name)


def partitions(spark):
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def portions(docs, text, batch_mb=2, bucket_mb=6):
    """(batches, buckets) for the texts of `docs`, from their measured bytes.

    A batch holds about `batch_mb` MB of text and a bucket the keys of about `bucket_mb` MB, whatever the session's number of
    partitions, so what meets in one Python worker does not depend on a setting.
    """
    size = docs.agg(F.sum(F.octet_length(quoted(text)))).first()[0] or 0
    return tuple(max(1, -(-size // (mb * 1_000_000))) for mb in (batch_mb, bucket_mb))


def others(df, *taken):
    """Columns of df but for `taken` (exact names)."""
    return [c for c in df.columns if c not in taken]


def quoted(name):
    return F.col("`" + name.replace("`", "``") + "`")


def rest_struct(df, *taken):
    """The other columns of df as one struct, so that their names clash with nothing."""
    names = others(df, *taken)
    if not names:
        return F.struct(F.lit(None).cast("string").alias("_"))
    return F.struct(*[quoted(c).alias(c) for c in names])


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
