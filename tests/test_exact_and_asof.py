"""Exact sums, as-of joins and survivors by field."""

from __future__ import annotations

import datetime as dt
import math
import random
import struct
from fractions import Fraction

import pytest

from tallyfolio.functions.exact import exact_sums
from tallyfolio.operators.asof import as_of, session_as_of
from tallyfolio.operators.merge import survivors


def bits(x):
    return struct.pack("<d", x).hex()


def test_sums_have_the_same_bits_for_any_spread(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 12) for _ in range(3000)] + [0.1, -0.1, 1e25, -1e25, 2.0**-90]
    rows = [(i % 3, x) for i, x in enumerate(values)]
    found = []
    for n in (1, 7, 64):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k int, x double").repartition(n)
        found.append({r["k"]: bits(r["x"]) for r in exact_sums(df, ["k"], ["x"]).collect()})
    assert found[0] == found[1] == found[2]
    for k in range(3):
        want = float(sum(Fraction(x) for key, x in rows if key == k))
        got = struct.unpack("<d", bytes.fromhex(found[0][k]))[0]
        assert abs(got - want) <= 2 * math.ulp(want)


def test_sums_that_cancel_and_odd_values(spark):
    nan, inf = float("nan"), float("inf")
    groups = {
        "cancel": [1e20, 0.1, -1e20], "negative": [-0.1, -0.2, 1e-5], "null": [None, None], "some": [None, 2.5],
        "nan": [nan, 1.0], "inf": [inf, 1.0], "both": [inf, -inf], "zero": [0.0, -0.0], "one": [0.1],
    }
    df = spark.createDataFrame([(k, x) for k, xs in groups.items() for x in xs], "k string, x double")
    got = {r["k"]: r["x"] for r in exact_sums(df, ["k"], ["x"]).collect()}
    assert got["cancel"] == 0.1 and got["null"] is None and got["some"] == 2.5 and got["zero"] == 0.0 and got["one"] == 0.1
    assert got["negative"] == float(Fraction(-0.1) + Fraction(-0.2) + Fraction(1e-5))
    assert math.isnan(got["nan"]) and got["inf"] == inf and math.isnan(got["both"])


@pytest.mark.parametrize("value", [1e-40, 1e30])
def test_a_value_out_of_range_is_an_error(spark, value):
    with pytest.raises(Exception, match="x has"):
        exact_sums(spark.createDataFrame([(1, value)], "k int, x double"), ["k"], ["x"]).collect()


def test_as_of_equals_brute_force(spark):
    rng = random.Random(2)
    base = dt.datetime(2024, 1, 1)
    left = [(i, rng.choice("ab"), base + dt.timedelta(minutes=rng.randint(0, 20_000) if i % 2 else 7_000)) for i in range(300)]
    left += [(300, "c", base), (301, "a", None), (302, None, base)]
    right = [(rng.choice("ab"), base + dt.timedelta(minutes=rng.randint(3_000, 15_000)), float(i)) for i in range(40)] + [("a", None, 1.0)]
    frames = spark.createDataFrame(left, "id int, k string, t timestamp_ntz"), spark.createDataFrame(right, "k string, u timestamp_ntz, v double")
    for seconds in (3_600, 86_400, 10_000_000):
        got = {r["id"]: r["v"] for r in as_of(*frames, "t", "u", ["v"], ["k"], seconds).collect()}
        want = {}
        for i, k, t in left:
            before = [(u, v) for key, u, v in right if key == k and u is not None and t is not None and u <= t]
            want[i] = max(before)[1] if before else None
        assert got == want


def test_sessions_of_weekends_and_days_before_all(spark):
    sessions = spark.createDataFrame([(dt.date(2024, 1, n),) for n in (4, 5, 8)], "date date")
    rows = spark.createDataFrame([(dt.date(2024, 1, n),) for n in (3, 4, 5, 6, 7, 8, 20)], "day date")
    got = {r["day"].day: r["session"] and r["session"].day for r in session_as_of(rows, sessions, "day").selectExpr("day", "cast(session AS date) session").collect()}
    assert got == {3: None, 4: 4, 5: 5, 6: 5, 7: 5, 8: 8, 20: 8}
    assert session_as_of(rows.limit(0), sessions, "day").isEmpty()
    assert session_as_of(rows, sessions.limit(0), "day").filter("session IS NOT NULL").isEmpty()


def test_survivors_keep_each_fields_newest_value(spark):
    rows = [("k", 1, "f1", 1.0, "x"), ("k", 2, "f2", None, "y"), ("k", 3, "f3", 2.0, None), ("m", 1, "f1", None, None), (None, 1, "f1", 5.0, "n")]
    df = spark.createDataFrame(rows, "id string, place int, file string, a double, b string")
    got = {r["id"]: tuple(r)[1:] for r in survivors(df, ["id"], ["place"], "file").collect()}
    assert got == {"k": (2.0, "y", "f3", "f2"), "m": (None, None, None, None), None: (5.0, "n", "f1", "f1")}
