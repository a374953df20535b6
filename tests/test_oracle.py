"""Every registered query against its SQL, on the smallest folder, and the shape of its plan."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import check_oracle  # noqa: E402

from lakestead.registry.oracle import ORACLE  # noqa: E402
from lakestead.registry.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
# Row-at-a-time Python, and joins that pair all rows with all rows.
SLOW_NODES = ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def database():
    return check_oracle.database(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in SLOW_NODES:
        assert node not in plan
    got = check_oracle.rows_of(df.columns, df.collect())
    want = check_oracle.run_sql(database, ORACLE[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
