"""The one-scan suite and the repair loop against plain Python; every branch occurs in the registered rows."""

import random
import re
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from explain_plans import plan_text
from ledgerflow.operators import quality as Q
from ledgerflow.operators.repair_loop import repair_loop
from ledgerflow.plans.catalog import REGISTRY
from ledgerflow.plans.dirty_queries import CATALOGUE, REPAIR_SUITE

from .conftest import SF_SMALL

SCHEMA = "id string, code int, amount string, kind string"


def _rows(seed: int, n: int) -> list[tuple]:
    rnd = random.Random(seed)
    return [(rnd.choice([None, None, "", f"I{rnd.randrange(30)}"]), rnd.choice([None, rnd.randrange(40)]),
             rnd.choice(["5", "-2", "1,000", " ", None, "x", "70"]), rnd.choice(["A", "B", "Z", None])) for _ in range(n)]


CHECKS = [Q.not_null("id"), Q.unique("id"), Q.unique("code"), Q.between("amount", 0, 60), Q.in_set("kind", ("A", "B")),
          Q.Check("duplicate_count_max", "id", {"max": 0}), Q.Check("duplicate_values_max", "code", {"max": 0}),
          Q.Check("mean_between", "amount", {"lo": 0, "hi": 100}), Q.Check("min_at_least", "amount", {"lo": 0}),
          Q.Check("row_count_between", None, {"lo": 1}), Q.Check("missing_count_max", "amount", {"max": 0}), Q.not_null("absent")]


@pytest.mark.parametrize("n", [0, 1, 300])
def test_suite_of_two_keys_equals_plain_python(spark, n):
    rows = _rows(n, n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {(r.check_name, r.column_name): r for r in Q.run_suite(df, CHECKS).collect()}
    ids, codes = Counter(r[0] for r in rows), Counter(r[1] for r in rows)
    nums = [float(r[2]) for r in rows if r[2] in ("5", "-2", "70")]
    failed = {
        (CHECKS[0].label, "id"): sum(r[0] is None or not r[0].strip() for r in rows),
        (CHECKS[1].label, "id"): sum(v for v in ids.values() if v > 1),
        (CHECKS[2].label, "code"): sum(v for v in codes.values() if v > 1),
        (CHECKS[3].label, "amount"): sum(r[2] != "5" for r in rows),
        (CHECKS[4].label, "kind"): sum(r[3] not in ("A", "B") for r in rows)}
    for key, expect in failed.items():
        assert (got[key].failed_row_count, got[key].passed) == (expect, expect == 0)
    seen = {
        "duplicate_count_max": sum(v - 1 for k, v in ids.items() if k is not None),
        "duplicate_values_max": sum(v > 1 for k, v in codes.items() if k is not None),
        "mean_between": round(sum(nums) / len(nums), 4) if nums else None, "min_at_least": min(nums, default=None),
        "row_count_between": n, "missing_count_max": sum(r[2] is None or not r[2].strip() for r in rows)}
    for r in got.values():
        if r.check_name in seen:
            assert r.observed_value == pytest.approx(seen[r.check_name])
    assert got[(CHECKS[-1].label, "absent")].error and len(got) == len(CHECKS)


def test_duplicate_flags_of_null_keys(spark):
    rows = _rows(7, 400)
    for c, i in (("id", 0), ("code", 1)):
        flagged = Q.with_duplicate_flags(spark.createDataFrame(rows, SCHEMA).repartition(4), [c]).collect()
        counts = Counter(r[i] for r in rows)
        assert Counter((tuple(r[:4]), r[4]) for r in flagged) == Counter((r, counts[r[i]] > 1) for r in rows)
    lone = spark.createDataFrame([(None, 1, "1", "A"), ("a", 1, "1", "A")], SCHEMA)
    assert [r[4] for r in Q.with_duplicate_flags(lone, ["id"]).collect()] == [False, False]


def test_profile_and_top_values(spark):
    rows = _rows(3, 500)
    df = spark.createDataFrame(rows, SCHEMA)
    top = {}
    for r in sorted(Q.top_values(df, 3).collect(), key=lambda r: r.value_rank):
        top.setdefault(r.column_name, []).append((r.value, r.n))
    for i, c in enumerate(df.columns):
        counts = Counter(str(r[i]) for r in rows if r[i] is not None and str(r[i]).strip())
        assert top[c] == sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
        p = {r.column_name: r for r in Q.profile(df).collect()}[c]
        assert p.unique_count == len({r[i] for r in rows if r[i] is not None}) and p.total_rows == 500
    empty = Q.profile(df.limit(0)).collect()
    assert {(r.column_name, r.total_rows, r.unique_count) for r in empty} == {(c, 0, 0) for c in df.columns}


@pytest.mark.parametrize("name,scans", [("q13_suite_transactions", 1), ("q13_suite_dirty", 1), ("q1_profile_bronze", 1),
                                        ("q14_quarantine_split", 2), ("q16_load_decision", 2), ("q16_load_decision_per_day", 1),
                                        ("p11_reasons_dirty", 1), ("q12_model_tests", 1), ("q18_null_rate_per_column", 1)])
def test_fact_scans(spark, name, scans):
    text = plan_text(REGISTRY[name].build(spark, SF_SMALL))
    assert len(re.findall(r"^Location: .*lineitem", text, re.M)) == scans


@pytest.mark.parametrize("name,column,values", [
    ("q20_issue_classes", "issue_found", 12), ("q21_rules_dirty", "rule", 5), ("q16_load_decision_per_day", "load_decision", 3),
    ("q22_row_decisions", "decision", 3), ("p11_reasons_dirty", "route", 4), ("q15_fix_log", "fix", 2), ("p3_silver_dirty", "quality_flag", 2),
    ("a15_hourly_volume_after_outage", "volume_flag", 3), ("r7_error_alarm_above_mean", "alarm", 2), ("r3_sla_breaches_small_limits", "breach", 2),
    ("b14_terminal_risk_score", "decision", 2), ("u4_method_sets_booked", "in_silver", 2), ("g3_tiers_of_contact_tables", "dataset_classification", 4),
    ("g6_pii_surface", "detection_method", 2)])
def test_every_branch_occurs(spark, name, column, values):
    # the outage of the smallest tables holds five events
    sf = SF_SMALL.replace("0.001", "0.01") if name.startswith("r3") else SF_SMALL
    assert REGISTRY[name].build(spark, sf).select(column).distinct().count() == values


def _dirty(spark):
    rows = [("T1", "10.0", "COMPLETED", "INR"), ("T2", "1,000.5", "FAILED", None), (" ", "5", "PENDING", "INR"), ("T4", "n/a", "COMPLETED", "USD"),
            ("T5", "-3", "COMPLETED", "USD"), ("T6", "7", "LOST", "INR"), ("T7", "8", "COMPLETED", "XYZ")]
    return spark.createDataFrame(rows, "transaction_id string, amount string, status string, currency string").withColumn("a.b", F.lit(1))


def test_repair_loop_rounds(spark, tmp_dir):
    out, state = repair_loop(_dirty(spark), REPAIR_SUITE, CATALOGUE, tmp_dir)
    log = {(r.attempt, r.column_name, r.action): (r.failed_before, r.rows_changed, r.rows_after) for r in state.collect()}
    assert log == {(1, "channel", "add_column"): (None, 7, 5), (1, "amount", "cast_column"): (3, 2, 5), (1, "transaction_id", "drop_bad_rows"): (1, 1, 5),
                   (1, "status", "drop_bad_rows"): (1, 1, 5), (1, "currency", "fill_default"): (2, 1, 5), (2, "channel", "fill_default"): (5, 5, 3),
                   (2, "amount", "drop_bad_rows"): (2, 2, 3), (2, "currency", "escalate"): (1, 0, 3), (3, None, "unresolved"): (1, 0, 3)}
    assert sorted(tuple(r) for r in out.select("transaction_id", "amount", "currency", "channel").collect()) == [
        ("T1", 10.0, "INR", "WEB"), ("T2", 1000.5, "INR", "WEB"), ("T7", 8.0, "XYZ", "WEB")]


def test_repair_loop_goes_on_after_a_crash(spark, tmp_dir):
    whole, again = tmp_dir + "/whole", tmp_dir + "/again"
    _out, state = repair_loop(_dirty(spark), REPAIR_SUITE, CATALOGUE, whole)
    shutil.copytree(whole + "/state/1", again + "/state/1")          # attempt 2 wrote its rows, not its state
    for attempt in ("1", "2"):
        shutil.copytree(f"{whole}/rows/{attempt}", f"{again}/rows/{attempt}")
    out, resumed = repair_loop(_dirty(spark), REPAIR_SUITE, CATALOGUE, again)
    assert sorted(map(str, resumed.collect())) == sorted(map(str, state.collect()))
    assert out.count() == 3
    _out, same = repair_loop(_dirty(spark), REPAIR_SUITE, CATALOGUE, again)   # a finished loop changes nothing
    assert sorted(map(str, same.collect())) == sorted(map(str, state.collect()))


def test_repair_loop_limits(spark, tmp_dir):
    _out, state = repair_loop(_dirty(spark), REPAIR_SUITE, CATALOGUE, tmp_dir + "/one", max_attempts=1)
    assert [r.action for r in state.where("attempt = 2").collect()] == ["escalate", "unresolved"]
    _out, state = repair_loop(_dirty(spark), REPAIR_SUITE, {}, tmp_dir + "/none")
    assert [r.action for r in state.collect()].count("escalate") == 5 and state.where("action = 'unresolved'").count() == 1
    clean = spark.createDataFrame([], "channel string, transaction_id string, amount string, status string, currency string")
    _out, state = repair_loop(clean, REPAIR_SUITE, CATALOGUE, tmp_dir + "/empty")
    assert [r.action for r in state.collect()] == ["validated"]
