"""Every registered query against its SQL, in full."""

import pytest

import __spark_entry__ as entry_module
from oracle import difference, duck
from tallyboard.plans import catalog, oracles
from tallyboard.plans.inputs import messages
from tallyboard.session import configure

SF_DIR = "/root/testdata/sf0.01"
QUERIES = catalog.all_queries()
ORACLES = oracles.all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).limit(1).count() == 1


def test_known_figures(spark):
    board = QUERIES["leaderboard"](spark, SF_DIR).cache()
    assert board.count() == 18101
    assert board.select("key").distinct().count() == 369
    assert board.where("key = 'leaderboard:work:2024-W1' and user_id = '0'").first().score == 323.82
    counts = {r.category: r.n for r in _categories(spark).collect()}
    assert counts == {
        "Documentation": 2275,
        "Development": 2014,
        "Entertainment": 1982,
        "Uncategorized": 1225,
        "SNS": 833,
        "Finance": 661,
        "Browsing": 652,
        "Education": 231,
        "E-commerce & Shopping": 127,
    }
    board.unpersist()


def _categories(spark):
    from pyspark.sql import functions as F

    from tallyboard.operators.classify import classify
    from tallyboard.plans.inputs import category_patterns

    done = classify(messages(configure(spark), SF_DIR), category_patterns(spark))
    return done.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
