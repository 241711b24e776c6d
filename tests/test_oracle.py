"""Every query with an SQL twin gives the twin's rows; the others give rows at all."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from compare import connect, differences

from panelcast.catalog import load, views
from panelcast.catalog.registry import PLACES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = load()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLES[name], duck, PLACES[name]) == []


MULTIPLICATIVE = {"forecast_hw_mul", "future_predict", "rolling_origin_hw_mul"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    n = len(QUERIES[name](spark, SF_DIR).collect())
    if name in MULTIPLICATIVE:
        # Series with a month of zero have no multiplicative model; the smallest tables have such months.
        usable = views.monthly(spark, SF_DIR).groupBy("series_id").agg({"value": "min"}).where("`min(value)` > 0")
        assert (n > 0) == (usable.count() > 0)
    else:
        assert n > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_both_sides_round_alike(name):
    """A query's SQL rounds to the query's own places (or coarser): ``differences`` would let one unit pass."""
    import re

    places = {int(p) for p in re.findall(r"\bround\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*, (-?\d+)\)", ORACLES[name].rpartition("\nSELECT")[2])}
    assert all(p <= PLACES[name] for p in places), (name, places)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
