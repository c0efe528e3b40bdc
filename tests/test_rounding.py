"""Roundings on ties: as the SQL twins round, by scaling."""

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
from check_oracle import canonical  # noqa: E402
from unitgrid.functions.numbers import round_half  # noqa: E402


def test_round_half_scales_first(spark):
    values = [-67.1078125, 2.5, -2.5, 0.25, 1.005, float("inf"), 1e305, None, 123456789.0]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double").select(
        "i", round_half("x", 6).alias("a"), round_half("x", 2).alias("b"), round_half("x", 1).alias("c")).orderBy("i").collect()
    con = duckdb.connect()
    want = [con.execute("SELECT round(?::DOUBLE, 6), round(?::DOUBLE, 2), round(?::DOUBLE, 1)", [v, v, v]).fetchone() for v in values]
    assert [tuple(r[1:]) for r in got] == want


@pytest.mark.parametrize("name", ["night_index_table", "night_from_export", "d5_merge_valid", "night_merged"])
def test_growth_on_ties(spark, sf_dir, tmp_path, name):
    """Totals of 6.4 before odd ten-thousandths put the growth on ties of the seventh decimal."""
    for t in ("region", "nation", "customer"):
        os.symlink(f"{sf_dir}/{t}.parquet", tmp_path / f"{t}.parquet")
    units = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    month = F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m")
    total = F.when(F.col("m") % 2 == 1, 6.4).otherwise((21001 + F.col("c_custkey") * 98 + F.col("m") * 8) / 10000.0)
    rows = units.select("c_custkey", month).select(
        (F.col("c_custkey") * 12 + F.col("m")).alias("o_orderkey"), F.col("c_custkey").alias("o_custkey"),
        F.round(total * 73331.0, 2).alias("o_totalprice"),
        F.make_date(F.lit(1996), "m", F.lit(3)).cast("timestamp_ntz").alias("o_orderdate"))
    rows.coalesce(1).write.parquet(str(tmp_path / "orders"))
    part = next(f for f in os.listdir(tmp_path / "orders") if f.endswith(".parquet"))
    os.symlink(tmp_path / "orders" / part, tmp_path / "orders.parquet")
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    df = entry.queries()[name](spark, str(tmp_path))
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, result.fetchall())
