"""Registered queries against their SQL twins on the smallest driver tables."""

import glob
import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
from check_oracle import canonical  # noqa: E402
from unitgrid.plans import catalog  # noqa: E402

SAMPLE = ["e3_composite_large", "e17_listed_by_province", "f7_segments_gaps", "d13_lines_on_outlines", "k6_null_metadata", "j2_null_metadata", "a7_rows_per_file",
          "a6_read_polygons", "e20_empty_bands", "night_index_table", "k2_normalize", "c8_cloud_filter_or_all", "d8_count_scenes", "d11_resolve_ids", "e3_composite_median",
          "d10_cut_windows", "d13_clip_line_length", "f5_failure_streaks", "g1_natural_order", "j5_components_8", "i9_slug"]


@pytest.fixture(scope="module")
def con(sf_dir):
    db = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return db


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"a7_read_manifest", "j9_road_metrics", "j10_skeleton", "j12_analyze_images"}


def test_all_twins_parse(con):
    for name, sql in entry.oracle_sql().items():
        con.execute("EXPLAIN " + sql)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_twin(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, result.fetchall())
