"""Registry of the queries over the driver tables and their SQL twins."""

from unitgrid.functions.numbers import round_half
from unitgrid.plans import sqlviews

QUERIES = {}
ORACLES = {}


def query(name, sql=None, views=()):
    """Register a query; `sql` is its DuckDB twin, prefixed with the CTEs of `views`.

    `sql` may start with more CTEs, `name AS (...), ... SELECT`.
    """
    def add(fn):
        from unitgrid.plans.views import Views
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sqlviews.statement(views, sql)
        return fn
    return add


def rounded(df, digits=6):
    """Round every double column, so that sums taken in another order compare equal."""
    return df.withColumns({c: round_half(c, digits) for c, t in df.dtypes if t == "double"})


