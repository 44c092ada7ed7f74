"""Every query that has SQL gives the same rows as the SQL."""

import math

import numpy as np
import pytest

import __spark_entry__
from voxtile.operators import thinning
from voxtile.plans import catalog

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def same(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    return round(float(x), 5) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(same(r[i]) for i in order) for r in data), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows_as_sql(spark, sf, db, name):
    df = catalog.QUERIES[name](spark, sf)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    r = db.execute(catalog.ORACLES[name])
    want = rows([c[0] for c in r.description], r.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_every_query_but_one_has_sql():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"thinned_mask"}


def test_thinned_mask_against_the_whole_array(spark, sf, db):
    """Skeletons have no SQL: the query, tile by tile, against one array of all voxels."""
    points = np.array(db.execute("select distinct l_partkey % 24, l_suppkey % 24, l_orderkey // 100 from lineitem where l_quantity > 20").fetchall())
    mask = np.zeros(points.max(axis=0) + 1, bool)
    mask[tuple(points.T)] = True
    got = sorted(tuple(r) for r in catalog.QUERIES["thinned_mask"](spark, sf).collect())
    assert got == [tuple(p) for p in np.argwhere(thinning.thin(mask))]


def test_entry(spark):
    out = __spark_entry__.entry(spark)
    assert out.count() > 0 and "A+count" in out.columns


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("name", ["coloc_pairs", "coloc_overlap", "point_in_region", "resolve_labels", "points_to_grid"])
def test_joins_have_keys(spark, sf, name):
    assert "CartesianProduct" not in (p := plan(catalog.QUERIES[name](spark, sf)))
    assert "BroadcastNestedLoopJoin" not in p or name == "coloc_overlap"  # its octave table has a row for each power of two


@pytest.mark.parametrize("name", ["region_collapse", "merge_stains_wide", "group_contrast_two_level", "histogram", "percentiles_7", "feature_paint"])
def test_no_python_in_the_plan(spark, sf, name):
    assert not any(x in plan(catalog.QUERIES[name](spark, sf)) for x in ("Python", "Pandas", "Arrow"))


def test_columns_are_pruned(spark, sf):
    p = plan(catalog.QUERIES["histogram"](spark, sf))
    assert "ReadSchema: struct<value:double>" in p
