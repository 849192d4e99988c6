"""Every catalogue query with an SQL oracle matches DuckDB exactly (small scale factor)."""

import pytest

from sf_paths import SF_SMALL
from oracle_compare import compare, duck
from tessera.plans.registry import ORACLE, QUERIES, load_all

load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, con, name):
    ok, ns, nd, _, detail = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert ok, f"{name}: spark={ns} duck={nd} {detail}"
