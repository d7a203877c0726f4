"""Fixture-only model operators (F12): payroll fan-out, delivery minutes, SLOs, roster, lineage."""

import datetime as dt

from ledgerflow.operators import models as M


def test_payroll_fanout(spark):
    w = spark.createDataFrame([("E1", "Asha"), ("E2", "Ravi")], "employee_id string, name string")
    c = spark.createDataFrame([("E1", 100.0), ("E1", 120.0), ("E2", 90.0)], "employee_id string, salary double")
    got = {(r.employee_id, r.salary): r._fanout for r in M.fct_payroll_ledger(w, c).collect()}
    assert got[("E1", 100.0)] == 2 and got[("E2", 90.0)] == 1 and len(got) == 3


def test_delivery_minute_boundaries(spark):
    ts = dt.datetime
    o = spark.createDataFrame([("O1", ts(2024, 1, 1, 10, 0, 0), ts(2024, 1, 1, 10, 0, 59), ts(2024, 1, 1, 10, 1, 1))],
                              "order_id string, placed_at timestamp, picked_up_at timestamp, delivered_at timestamp")
    r = spark.createDataFrame([], "order_id string, rating int")
    row = M.fct_deliveries(o, r).first()
    assert row.delivery_minutes == 1 and row.total_minutes == 1 and row.rating == 0


def test_slos(spark):
    m = spark.createDataFrame([("freshness_hours", 30.0), ("quality_pct", 99.95), ("row_count_change_pct", -25.0)],
                              "name string, value double")
    got = {r.name: r.met for r in M.evaluate_slos(m).collect()}
    assert got == {"freshness_hours": False, "quality_pct": True, "row_count_change_pct": False,
                   "runtime_minutes": False}


def test_roster(spark):
    ents = spark.createDataFrame([("a",), ("b",), ("c",)], "team string")
    exp = spark.createDataFrame([("d6",), ("d7",)], "item string")
    found = spark.createDataFrame([("a", "d6"), ("a", "d7"), ("a", "x"), ("b", "d6"), ("c", "d6"), ("c", "d7")],
                                  "team string, item string")
    got = [(r.team, r.tier) for r in M.completeness_roster(ents, exp, found, "team", "item").collect()]
    assert got == [("a", "master"), ("c", "complete"), ("b", "partial")]


def test_lineage_closure(spark):
    e = spark.createDataFrame([("fct.gmv", "int.gmv"), ("int.gmv", "stg.amount"), ("stg.amount", "raw.amount")],
                              "target string, source string")
    got = {(r.target, r.source) for r in M.lineage_closure(e).collect()}
    assert ("fct.gmv", "raw.amount") in got and len(got) == 6
