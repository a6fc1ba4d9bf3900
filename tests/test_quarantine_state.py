"""Quarantine as kept counts: merged loads equal one load."""

import random

import pytest
from pyspark.sql import functions as F

from lendscope.operators import profile
from lendscope.operators.quarantine import quarantined_ids
from lendscope.operators.quarantine_state import QuarantineState

CUSTOMERS = "member_id string, name string, income float"


def ids(df):
    return sorted(str(r.member_id) for r in df.collect())


def changes(df):
    return sorted((str(r.member_id), r.change) for r in df.collect())


def brute(customers, details):
    def many(rows):
        seen = {}
        for r in rows:
            seen[r[0]] = seen.get(r[0], 0) + 1
        return {k for k, n in seen.items() if n > 1}
    return many(set(customers)) | many(details)


def frames(spark, customers, details):
    return {"customers": spark.createDataFrame(customers, CUSTOMERS),
            "details": spark.createDataFrame(details, "member_id string, n int")}


def test_loads_and_retractions_against_brute_force(spark, tmp_path):
    rnd = random.Random(4)
    state = QuarantineState(spark, f"{tmp_path}/state", distinct=["customers"])
    customers, details, before, loads = [], [], set(), []
    for k in range(5):
        c = [(f"m{rnd.randrange(30)}", rnd.choice("ab"), 1.0) for _ in range(12)]
        d = [(f"m{rnd.randrange(60)}", rnd.randrange(3)) for _ in range(10)]
        sign = 1
        if k == 3:  # take a load back
            c, d = loads[1]
            sign = -1
            for r in c:
                customers.remove(r)
            for r in d:
                details.remove(r)
        else:
            loads.append((c, d))
            customers += c
            details += d
        got = changes(state.merge(f"load-{k}", frames(spark, c, d), sign))
        now = brute(customers, details)
        assert got == sorted([(m, "enter") for m in now - before] + [(m, "leave") for m in before - now])
        assert ids(state.quarantined()) == sorted(now)
        before = now
        if k == 2:
            state.compact("compacted")
            assert ids(state.quarantined()) == sorted(now)
    whole = frames(spark, sorted(set(customers)), details)
    assert ids(quarantined_ids(whole)) == sorted(before)


def test_the_same_load_twice_counts_once(spark, tmp_path):
    state = QuarantineState(spark, f"{tmp_path}/state")
    load = {"details": spark.createDataFrame([("a", 1), ("b", 1)], "member_id string, n int")}
    assert changes(state.merge("x", load)) == []
    assert changes(state.merge("x", load)) == []  # a retry
    assert ids(state.quarantined()) == []
    assert changes(state.merge("y", load)) == [("a", "enter"), ("b", "enter")]


def test_null_ids_empty_loads_and_names(spark, tmp_path):
    state = QuarantineState(spark, f"{tmp_path}/state", distinct=["customers"])
    assert state.quarantined().count() == 0
    load = frames(spark, [(None, "a", None), (None, "b", None), ("x", None, 1.0), ("x", None, 1.0)], [("y", None)])
    assert changes(state.merge("one", load)) == [("None", "enter")]  # x twice is one distinct row
    assert changes(state.merge("none", {n: d.limit(0) for n, d in load.items()})) == []
    assert changes(state.merge("two", {"details": load["details"]})) == [("y", "enter")]
    with pytest.raises(ValueError):
        state.compact("two")


def test_a_merge_reads_no_table_again(spark, tmp_path):
    """The plan of a load's changes scans kept counts only."""
    state = QuarantineState(spark, f"{tmp_path}/state")
    big = spark.range(1000).select(F.concat(F.lit("m"), F.col("id")).alias("member_id"))
    state.merge("one", {"t": big})
    out = state.merge("two", {"t": big.limit(3)})
    plan = out._jdf.queryExecution().toString()
    assert "Range (0, 1000" not in plan and str(tmp_path) in plan and out.count() == 3


def test_key_collisions_are_found_without_collecting(spark):
    rows = [("k1", "a", None), ("k1", "a", None), ("k2", "a", None), ("k2", None, "a"), ("k3", "x", "y"),
            (None, "p", "q"), (None, "p", "r"), ("k4", None, None), ("k4", None, None)]
    df = spark.createDataFrame(rows, "key string, u string, v string")
    got = {r.key: r.n_rows for r in profile.key_collisions(df, "key", ["u", "v"]).collect()}
    assert got == {"k2": 2, None: 2}
    assert tuple(profile.key_audit(df, "key", ["u", "v"]).first()) == (9, 5, 4, 2, 4)
    assert "collect_" not in profile.key_collisions(df, "key", ["u", "v"])._jdf.queryExecution().toString()
    empty = profile.key_audit(df.limit(0), "key", ["u", "v"]).first()
    assert empty.n_keys == 0 and empty.n_colliding_rows == 0
