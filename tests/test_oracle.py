"""Every registered query on the smallest tables, against its SQL twin where it has one."""

import compare
import pytest

import headwater.plans  # noqa: F401
from headwater.plans.registry import REGISTRY


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_matches_sql(spark, duck, sf_dir, name):
    status, detail = compare.compare(spark, duck, REGISTRY[name], sf_dir)
    assert status != "FAIL", detail
