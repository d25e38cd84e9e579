"""Relational building blocks against brute-force expectations."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from postura.operators import any_key_join, distinct_counts, labelled_rows, month_spine, top_per_key


def _left(spark):
    rows = [
        ("c1", "10", "10", None),  # two equal keys matching one failure: one row per failure
        ("c2", "11", None, "12"),
        ("c3", "99", None, None),  # no match: kept once with NULLs
        ("c4", None, None, None),  # no keys at all: kept once with NULLs
        ("c5", "12", "10", "c5"),
        ("c5", "12", "10", "c5"),  # equal but for its number: each copy matches on its own
    ]
    return spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "n int, id string, k1 string, k2 string, k3 string")


def _right(spark):
    rows = [("10", "a"), ("10", "b"), ("11", "c"), ("12", "d"), ("c5", "e"), (None, "z")]
    return spark.createDataFrame(rows, "key string, v string")


def _brute(left, right):
    out = Counter()
    for l in left:
        keys = {k for k in (l.k1, l.k2, l.k3) if k is not None}
        hits = [r for r in right if r.key is not None and r.key in keys]
        for r in hits:
            out[(l.id, r.v)] += 1
        if not hits:
            out[(l.id, None)] += 1
    return out


def test_any_key_join_matches_or_semantics(spark):
    left, right = _left(spark), _right(spark)
    keys = [F.col("k1"), F.col("k2"), F.col("k3")]
    got = Counter((r.id, r.v) for r in any_key_join(left, "n", keys, right, "key").collect())
    assert got == _brute(left.collect(), right.collect())


def test_any_key_join_restricts_its_right_side(spark):
    left, right, seen = _left(spark), _right(spark), []

    def restricted(keys):
        seen.append(keys)
        return right.join(keys, "key", "left_semi")

    out = any_key_join(left, "n", [F.col("k1"), F.col("k2"), F.col("k3")], restricted, "key")
    assert out.columns == ["n", "id", "k1", "k2", "k3", "v"]
    assert Counter((r.id, r.v) for r in out.collect()) == _brute(left.collect(), right.collect())
    assert sorted(r.key for r in seen[0].collect()) == ["10", "11", "12", "99", "c5"]


def test_any_key_join_plans_no_nested_loop(spark):
    df = any_key_join(_left(spark), "n", [F.col("k1"), F.col("k2")], _right(spark), "key")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_distinct_counts_against_count_distinct(spark):
    rows = [(i % 3 if i % 7 else None, f"a{i % 5}" if i % 4 else None, i % 11 if i % 6 else None, i if i % 10 else None) for i in range(200)] + [(9, None, None, None)]
    df = spark.createDataFrame(rows, "k int, a string, b int, x int")
    got = distinct_counts(df, ["k"], {"n_a": "a", "n_b": "b"}, {"s": F.col("x"), "n": F.lit(1)})
    want = df.groupBy("k").agg(F.count_distinct("a").alias("n_a"), F.count_distinct("b").alias("n_b"), F.sum("x").alias("s"), F.count(F.lit(1)).alias("n"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert "Expand [" not in got._jdf.queryExecution().executedPlan().toString()
    assert distinct_counts(df.limit(0), ["k"], {"n_a": "a"}, {"n": F.lit(1)}).collect() == []


def test_top_per_key_desc_nulls_first_and_tiebreak(spark):
    rows = [
        ("a", dt.datetime(2001, 1, 1), 1),
        ("a", None, 2),  # NULL date is "latest" under DESC NULLS FIRST
        ("a", dt.datetime(2001, 1, 2), 3),
        ("b", dt.datetime(2001, 1, 2), 4),
        ("b", dt.datetime(2001, 1, 2), 5),  # tie on date: higher id wins
        ("b", dt.datetime(2000, 1, 2), 6),
    ]
    df = spark.createDataFrame(rows, "k string, d timestamp_ntz, id long")
    got = top_per_key(df, ["k"], [F.col("d").desc_nulls_first(), F.col("id").desc()], k=2, rank_col="rk")
    assert sorted((r.k, r.rk, r.id) for r in got.collect()) == [("a", 1, 2), ("a", 2, 3), ("b", 1, 5), ("b", 2, 4)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_labelled_rows(spark):
    df = spark.createDataFrame([(3, 4)], "x long, y long")
    got = labelled_rows(df, [("first", F.col("x")), ("second", F.col("y"))], ("metric", "value")).collect()
    assert [(r.metric, r.value) for r in got] == [("first", 3), ("second", 4)]


def test_month_spine_mid_month(spark):
    rows = month_spine(spark, "2001-07-15 12:00:00").orderBy("idx").collect()
    assert len(rows) == 12
    assert rows[0].datemonth == dt.datetime(2000, 8, 15, 12) and rows[-1].datemonth == dt.datetime(2001, 7, 15, 12)
    assert rows[0].month == "Aug 00" and rows[-1].mkey == "0701"
    assert [r.ym for r in rows] == list(range(rows[0].ym, rows[0].ym + 12))


def test_month_spine_month_end_steps_cumulatively(spark):
    rows = month_spine(spark, "2001-03-31 00:00:00").orderBy("idx").collect()
    assert [r.ym for r in rows] == list(range(rows[0].ym, rows[0].ym + 12))
    # each instant is one month after the previous one, the day clamped and carried on
    assert rows[0].datemonth == dt.datetime(2000, 4, 30)
    assert [r.datemonth.day for r in rows] == [30] * 10 + [28, 28]


def test_month_instants_edge_cases():
    from postura.operators.spine import add_months, month_instants

    assert add_months(dt.datetime(2000, 1, 31, 5), 1) == dt.datetime(2000, 2, 29, 5)
    assert add_months(dt.datetime(2000, 3, 31), -13) == dt.datetime(1999, 2, 28)
    got = month_instants("2001-07-15 12:00:00")
    assert len(got) == 12 and got[0] == dt.datetime(2000, 8, 15, 12) and got[-1] == dt.datetime(2001, 7, 15, 12)
    assert len(month_instants("2000-02-29 23:59:59.5")) == 12
