"""Registered queries against their SQL answers. All of them with TIDESPAN_ALL=1, else one per family."""

import os

import pytest

import __spark_entry__ as entry
import catalog
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
SOME = [
    "campaign_counts", "repetitive_hopping", "session_capped", "pivot", "snapshot_hopping", "percentile_discrete",
    "full_outer_join", "sessionize_ties", "detect_star", "adjust_late", "from_changelog_open", "string_last_index",
    "stream_restart", "stream_snapshot", "rules_engine", "time_slices",
]
NAMES = sorted(catalog.ORACLES) if os.environ.get("TIDESPAN_ALL") else SOME


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    problem, _ = compare(duck, entry.queries()[name](spark, SF), entry.oracle_sql()[name])
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_an_answer():
    from catalog import ORACLES, QUERIES

    assert set(QUERIES) == set(ORACLES) <= set(entry.queries())
