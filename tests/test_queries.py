"""Every query against its SQL in another engine, over whole tables."""

import pytest
from compare import connect, spark_rows, sql_rows

from gridweave.plans.oracle import ORACLE
from gridweave.plans.queries import QUERIES
from gridweave.sources import tables as t

SF = "/root/testdata/sf0.001"
WITHOUT_SQL = {"multivariate_correction"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    names, rows = spark_rows(QUERIES[name](spark, SF))
    want_names, want = sql_rows(con, ORACLE[name])
    assert names == want_names
    assert rows == want


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pair_of_everything(spark, name):
    """No plan compares or pairs all rows of two sides."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_most_of_the_flagship_is_interpolated(spark):
    """The result differs from the target's own values in more than half of the rows."""
    sf = "/root/testdata/sf0.01"
    own = t.target_field(spark, sf).selectExpr(
        "date_format(time, 'yyyy-MM-dd HH:mm:ss') AS time", "lev_idx", "lat", "lon", "value AS own"
    )
    out = QUERIES["interp3d_v2"](spark, sf).join(own, ["time", "lev_idx", "lat", "lon"])
    changed = out.where("abs(value - own) > 1e-4").count()
    assert changed > 0.5 * out.count() > 0


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
