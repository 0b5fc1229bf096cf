"""Skew-safe running sums and lags equal plain windows, with forced hot-key splits."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from schemelens.operators import ordered


def _data(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    rows = [(i, 0 if rnd.random() < 0.6 else rnd.randint(1, 20), rnd.randint(0, 500), rnd.randint(1, 9),
             rnd.choice("ABCD")) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k long, t long, v long, s string")


def test_running_sum_matches_window(spark):
    df = _data(spark)
    got = ordered.running_sum(df, "k", ["t", "id"], "v", "cum", pieces=40)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("cum", F.sum("v").over(w))
    assert sorted(got.select("id", "cum").collect()) == sorted(exp.select("id", "cum").collect())
    # the hot key really was split
    assert ordered.in_pieces(df, "k", ["t", "id"], 40).filter("k = 0").select(ordered.PIECE).distinct().count() > 20


def test_exclusive_running_sum(spark):
    df = _data(spark, seed=2)
    got = ordered.running_sum(df, "k", ["t", "id"], "v", "cum", inclusive=False, pieces=50)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("cum", F.coalesce(F.sum("v").over(w), F.lit(0)))
    assert sorted(got.select("id", "cum").collect()) == sorted(exp.select("id", "cum").collect())


def test_lag_matches_window(spark):
    df = _data(spark, seed=3)
    got = ordered.lag(df, "k", ["t", "id"], "s", "prev", default="START", pieces=60)
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = df.withColumn("prev", F.lag("s", 1, "START").over(w))
    assert sorted(got.select("id", "prev").collect()) == sorted(exp.select("id", "prev").collect())


def test_far_away_order_values(spark):
    rows = [(i, 0, i, 1, "A") for i in range(2000)] + [(5000 + j, 0, 10 ** 15 + j, 1, "B") for j in range(3)] + \
           [(9000 + j, 0, -(10 ** 15) - j, 1, "C") for j in range(3)]
    df = spark.createDataFrame(rows, "id long, k long, t long, v long, s string")
    got = ordered.running_sum(df, "k", ["t", "id"], "v", "cum", pieces=40)
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("cum", F.sum("v").over(w))
    assert sorted(got.select("id", "cum").collect()) == sorted(exp.select("id", "cum").collect())


def test_one_key_and_one_priority_with_most_rows(spark):
    """Pieces follow quantiles of the whole order key: ties in its first column and a hot key do not fill one piece."""
    n = 20_000
    df = spark.range(n).selectExpr("id", "if(id % 10 < 9, 0, id % 7) as k", "if(id % 10 < 9, 44, id % 90) as prio",
                                   "id % 5 as t", "id % 11 as v")
    order = [-F.col("prio"), F.col("t"), F.col("id")]
    sizes = [r["count"] for r in ordered.in_pieces(df, "k", order, 20).groupBy(ordered.PIECE).count().collect()]
    assert len(sizes) >= 19 and max(sizes) < 2 * n / 20
    got = ordered.running_sum(df, "k", order, "v", "cum", pieces=20)
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    assert sorted(got.select("id", "cum").collect()) == sorted(df.withColumn("cum", F.sum("v").over(w)).select("id", "cum").collect())


def test_null_keys_and_null_values(spark):
    rows = [(i, None if i % 3 == 0 else i % 2, None if i % 5 == 0 else i % 4, i, None if i % 7 == 0 else "ABC"[i % 3])
            for i in range(600)]
    df = spark.createDataFrame(rows, "id long, k long, t long, v long, s string")
    got = ordered.running_sum(df, "k", ["t", "id"], "v", "cum", pieces=30)
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = df.withColumn("cum", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(got.select("id", "cum").collect()) == sorted(exp.select("id", "cum").collect())
    got = ordered.lag(df, "k", ["t", "id"], "s", "prev", default="START", pieces=30)
    exp = df.withColumn("prev", F.lag("s", 1, "START").over(w))
    assert dict(got.select("id", "prev").collect()) == dict(exp.select("id", "prev").collect())


def test_empty_table(spark):
    df = spark.createDataFrame([], "id long, k long, t long, v long, s string")
    assert ordered.running_sum(df, "k", ["t", "id"], "v", "cum").collect() == []
    assert ordered.lag(df, "k", ["t", "id"], "s", "prev").collect() == []


def test_running_state_matches_a_walk(spark):
    rnd = random.Random(9)
    rows = [(i, None if i % 50 == 49 else 0 if rnd.random() < 0.6 else rnd.randint(1, 40), rnd.randint(0, 500),
             rnd.choice("XY") if rnd.random() < (0.0015 if i % 3 else 0.1) else None) for i in range(4000)]
    rows += [(10_000 + i, 99, i, None) for i in range(300)] + [(11_000, 99, 299, "X"), (11_001, 99, 500, "Y")]  # open over many pieces
    df = spark.createDataFrame(rows, "id long, k long, t long, s string")
    exp, state = {}, {}
    for i, k, t, s in sorted(rows, key=lambda r: (r[2], r[0])):
        exp[i] = state.get(k)
        if state.get(k) is None:
            state[k] = s
    got = ordered.running_state(df, "k", ["t", "id"], "s", "before", pieces=60)
    assert got.columns == ["id", "k", "t", "s", "before"]
    assert {r.id: r.before for r in got.collect()} == exp and len(exp) == len(rows)
    assert exp[11_001] == "X" and exp[11_000] is None
    # on given pieces, for some of their rows
    some = ordered.in_pieces(df, "k", ["t", "id"], 60).filter("id % 2 = 0 or s is not null")
    got = {r.id: r.before for r in ordered.running_state(some, "k", ["t", "id"], "s", "before").collect()}
    assert got == {i: b for i, b in exp.items() if i in got} and len(got) < len(exp)
    assert ordered.running_state(df.limit(0), "k", ["t", "id"], "s", "before").collect() == []
