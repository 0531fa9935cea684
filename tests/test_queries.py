"""Every registered query against its SQL cross-check."""

import os

import pytest

import __spark_entry__ as entry
from airlane.plans import ORACLES, QUERIES
import compare

SF_DIR = os.environ.get("AIRLANE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = compare.connect(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_a_cross_check():
    assert set(ORACLES) == set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = entry.queries()[name](spark, SF_DIR)
    problem = compare.difference(frame, db, entry.oracle_sql()[name])
    assert problem is None, problem


BITES = ["area_filter_wide", "area_by_cells", "redact_documents", "live_list_page5", "aircraft_history_page10", "history_top20_all",
         "route_points_20", "feed_search_top5", "live_retained_6h", "redact_json_members"]


@pytest.mark.parametrize("name", BITES)
def test_limits_bite(spark, name):
    """These queries return something, and less than everything where they cut."""
    sf_dir = "/root/testdata/sf0.01"
    assert not entry.queries()[name](spark, sf_dir).isEmpty()
    whole = {"live_list_page5": "live_list", "history_top20_all": "history_topn_all", "route_points_20": "route_points",
             "aircraft_history_page10": "aircraft_history", "feed_search_top5": "feed_top300", "live_retained_6h": "live_retained"}
    if name in whole:
        assert entry.queries()[name](spark, sf_dir).count() < entry.queries()[whole[name]](spark, sf_dir).count()


def test_entry(spark):
    row = entry.entry(spark).collect()
    assert len(row) == 1
    assert row[0].total_aircraft == row[0].airborne + row[0].on_ground + row[0].unknown_ground_state
