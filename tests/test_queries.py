"""Every registered query against its SQL twin at the smallest scale."""

import compare
import pytest

from screenline.plans import catalog

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.queries(), catalog.oracles()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert compare.difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).columns


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_prior_texts_of_every_paper_in_every_pass(spark, con):
    """Of papers that were not imported in the pass, too."""
    want = con.sql(
        "WITH i AS (SELECT event_type AS r, CAST(week(ts) AS INTEGER) AS p, user_id AS u, max(value) AS v FROM events GROUP BY ALL),"
        " f AS (SELECT r, u, min(CASE WHEN v > 60 THEN p END) AS a, min(CASE WHEN u % 7 = 0 THEN p END) + 1 AS b FROM i GROUP BY ALL)"
        " SELECT count(*) FROM f JOIN (SELECT DISTINCT r, p FROM i) q ON q.r = f.r AND (a < q.p OR b < q.p)"
    ).fetchall()[0][0]
    assert QUERIES["prior_usable"](spark, SF).count() == want


def test_progress_counts_every_event(spark, con):
    """Of the last hours, too."""
    assert QUERIES["stream_progress"](spark, SF).agg({"n": "sum"}).first()[0] == con.sql("SELECT count(*) FROM events").fetchall()[0][0]
