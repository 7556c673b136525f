"""Every registered query against its SQL, and the known figures of the readings."""

import pytest

import __spark_entry__ as entry
from fleetgauge.operators.latest import latest_per_device
from fleetgauge.operators.rollup import hourly_device_mean
from fleetgauge.plans import catalogue, oracle
from fleetgauge.plans.readings import UNIQUE, readings, timed_readings

# Queries of operators that may be taken away are tested with them.
QUERIES = catalogue.registered()
ORACLE = oracle.statements()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, duck):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    ours = sorted(map(repr, (tuple(r[c] for c in columns) for r in result.collect())))
    reply = duck.execute(ORACLE[name])
    names = [d[0] for d in reply.description]
    assert sorted(names) == columns
    theirs = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in reply.fetchall())
    assert ours == theirs


def test_entry_has_rows(spark):
    assert not entry.entry(spark).isEmpty()


def test_known_figures(spark, sf_dir):
    counts = {r["route"]: r["readings"] for r in catalogue.route_counts(spark, sf_dir).collect()}
    assert counts == {"fail": 209, "dataerr": 198, "data": 621, "unrouted": 22}
    assert readings(spark, sf_dir).count() == 1050
    newest = latest_per_device(timed_readings(spark, sf_dir), UNIQUE)
    row = newest.selectExpr("count(*) n", "sum(sensor1) s", "sum(motor3) m").first()
    assert (row.n, round(row.s, 2), row.m) == (15, 680.95, 10519.0)
    means = hourly_device_mean(catalogue._data_by_hour(spark, sf_dir))
    row = means.selectExpr("count(*) n", "sum(sensor1_avg) s").first()
    assert (row.n, round(row.s, 4)) == (571, 20376.0183)
