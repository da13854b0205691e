"""Hot-key splitting gives the same answers as the plain window."""

import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators.profiles import set_state_profile
from tidemark.operators.split_window import (
    FirstNonNull, Lag, LastNonNullBefore, LastNonNullUpTo, Lead, LaterNonNull, RowNumber,
    RunningXor, SplitPolicy, SplitWindow,
)

from .test_fixtures import profiles

TINY = SplitPolicy(hot_rows=1, chunk_rows=1)


def _frame(spark):
    rows = []
    for g, n in (("a", 40), ("b", 3), ("c", 1), ("d", 25)):
        for i in range(n):
            v = None if (i * 7 + len(g)) % 4 == 0 else float(i * 3 % 11)
            rows.append((g, i // 3, i, v, 1 if (i * 5) % 7 == 0 else 0))
    return spark.createDataFrame(rows, "g string, t int, i int, v double, f int")


def _ops():
    return dict(
    rn=RowNumber(), first=FirstNonNull(F.col("v")), upto=LastNonNullUpTo(F.col("v")),
    before=LastNonNullBefore(F.col("v")), lag1=Lag(F.col("v")), lag3=Lag(F.col("v"), 3),
    lead1=Lead(F.col("v")), lead2=Lead(F.col("f"), 2),
    later=LaterNonNull(F.when(F.col("f") == 1, F.col("i"))),
    )


def _run(df, policy):
    ops = _ops()
    sw = SplitWindow(df, ["g"], ["t", "i"], policy)
    out = sw.finish(sw.add(sw.prepare(df), **ops))
    return sw.split, {(r["g"], r["i"]): tuple(r[k] for k in ops) for r in out.collect()}


@pytest.mark.parametrize("policy", [TINY, SplitPolicy(hot_rows=5, chunk_rows=4)])
def test_split_equals_plain(spark, policy):
    df = _frame(spark)
    split, got = _run(df, policy)
    plain_split, want = _run(df, None)
    assert split and not plain_split
    assert got == want


def test_no_hot_key_keeps_plain_plan(spark):
    df = _frame(spark)
    sw = SplitWindow(df, ["g"], ["t", "i"], SplitPolicy(hot_rows=1000))
    assert not sw.split


@pytest.mark.parametrize("lookback,want", [
    ("running", {"K1": 105, "K2": 205, "K3": 301, "K4": 401, "K5": 503, "K6": 601, "K7": 702,
                 "K8": 804}),
    ("adjacent", {"K1": 105, "K2": 205, "K3": 301, "K4": 401, "K5": 503, "K6": 604, "K7": 703,
                  "K8": 801}),
])
def test_profiles_with_one_row_chunks(spark, lookback, want):
    out = set_state_profile(
        prefix="P", df=profiles(spark), unique_fields=["Key"], state_profile="StateProfile",
        escheat_date_field_name="EscheatDate", escheat_due_date_field_name="EscheatDueDate",
        state_profiles_prefix="SP_", lookback=lookback, policy=TINY,
    )
    assert {r["Key"]: r["StateProfile"] for r in out.collect()} == want


def test_null_key_is_split_like_any_other(spark):
    rows = [(None if i % 2 else "k", i // 2, i, float(i % 5) if i % 3 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, t int, i int, v double")
    ops = lambda: dict(rn=RowNumber(), prev=LastNonNullBefore(F.col("v")),
                       nxt=Lead(F.col("v")), later=LaterNonNull(F.col("v")))
    sw = SplitWindow(df, ["g"], ["t", "i"], SplitPolicy(hot_rows=10, chunk_rows=6))
    prepared = sw.prepare(df)
    null_chunks = {r[0] for r in prepared.where(F.col("g").isNull()).select("__tm_chunk").collect()}
    assert len(null_chunks) > 1 and -1 not in null_chunks
    got = {r["i"]: (r["rn"], r["prev"], r["nxt"], r["later"])
           for r in sw.finish(sw.add(prepared, **ops())).collect()}
    plain = SplitWindow(df, ["g"], ["t", "i"], None)
    want = {r["i"]: (r["rn"], r["prev"], r["nxt"], r["later"])
            for r in plain.add(df, **ops()).collect()}
    assert got == want


def test_composite_keys(spark):
    rows = [(g % 2, g // 2, t, i, float(i % 7) if i % 4 else None)
            for i, (g, t) in enumerate((g, t) for g in range(4) for t in range(15))]
    df = spark.createDataFrame(rows, "a int, b int, t int, i int, v double")
    ops = lambda: dict(rn=RowNumber(), prev=LastNonNullBefore(F.col("v")),
                       nxt=Lead(F.col("v"), 2), later=LaterNonNull(F.col("v")))
    res = {}
    for label, policy in (("plain", None), ("split", SplitPolicy(hot_rows=5, chunk_rows=4))):
        sw = SplitWindow(df, ["a", "b"], ["t", "i"], policy)
        assert sw.split == (policy is not None)
        res[label] = {r["i"]: (r["rn"], r["prev"], r["nxt"], r["later"])
                      for r in sw.finish(sw.add(sw.prepare(df), **ops())).collect()}
    assert res["plain"] == res["split"]


@pytest.mark.parametrize("first", ["day", "text"])
def test_tied_and_text_orders_are_split_evenly(spark, first):
    """One key, 20,000 rows, nine in ten on one day: chunks follow the whole order."""
    df = spark.range(20000).select(F.lit("k").alias("g"), "id", F.when(F.col("id") % 10 > 0, F.lit("2024-05-01")).otherwise(
        F.concat(F.lit("2024-06-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0"))).alias("text"))
    df = df.withColumn("day", F.to_date("text"))
    sw = SplitWindow(df, ["g"], [first, "id"], SplitPolicy(hot_rows=1000, chunk_rows=500))
    chunks = sw.prepare(df).groupBy("__tm_chunk").count().agg(F.count("*"), F.max("count")).first()
    assert sw.split and chunks[0] >= 30 and chunks[1] <= 1000
    got = sw.finish(sw.add(sw.prepare(df), rn=RowNumber(), prev=Lag(F.col("id"))))
    plain = SplitWindow(df, ["g"], [first, "id"], None)
    want = plain.finish(plain.add(plain.prepare(df), rn=RowNumber(), prev=Lag(F.col("id"))))
    assert got.exceptAll(want).count() == 0 and got.count() == 20000

def test_keys_are_required(spark):
    import pytest

    with pytest.raises(ValueError):
        SplitWindow(_frame(spark), [], ["t"], None)


def test_rows_that_all_tie_are_split_and_peers_agree(spark):
    """20,000 rows of one key, all on one day: no partition holds many of them, and
    the first non-null of the peers reaches every row, wherever it lies."""
    df = spark.range(20000).select(F.lit("k").alias("g"), F.lit(1).alias("t"), "id",
                                   F.when(F.col("id") == 13777, F.lit(5.0)).alias("v"))
    sw = SplitWindow(df, ["g"], ["t"], SplitPolicy(hot_rows=1000, chunk_rows=2000))
    x = sw.prepare(df)
    sizes = [r["count"] for r in x.groupBy("__tm_chunk").count().collect()]
    assert sw.split and len(sizes) >= 8 and max(sizes) <= 4000
    out = sw.finish(sw.add(x, rn=RowNumber(), first=FirstNonNull(F.col("v"))))
    got = out.agg(F.count_distinct("rn"), F.min("rn"), F.max("rn"), F.min("first"), F.count("first")).first()
    assert tuple(got) == (20000, 1, 20000, 5.0, 20000)


def test_peers_over_several_partitions(spark):
    """Ties of all lengths, with few non-null values, in partitions of one row."""
    import random

    rnd = random.Random(11)
    rows = [(rnd.choice("ab"), rnd.choice([None, 1, 1, 2, 3]), i, float(i % 5) if rnd.random() < 0.15 else None) for i in range(90)]
    # among peers any first value may win, so equal ones a peer group
    rows = [(g, t, i, None if v is None else float(t or 0)) for g, t, i, v in rows]
    df = spark.createDataFrame(rows, "g string, t int, i int, v double")
    res = {}
    for label, policy in (("plain", None), ("split", TINY), ("some", SplitPolicy(hot_rows=1, chunk_rows=7))):
        sw = SplitWindow(df, ["g"], ["t"], policy)
        res[label] = {r["i"]: r["f"] for r in sw.finish(sw.add(sw.prepare(df), f=FirstNonNull(F.col("v")))).collect()}
    assert res["plain"] == res["split"] == res["some"]


def test_running_xor(spark):
    df = _frame(spark).withColumn("x", F.when(F.col("i") % 5 > 0, F.xxhash64("g", "i")))
    res = {}
    for label, policy in (("plain", None), ("split", TINY)):
        sw = SplitWindow(df, ["g"], ["t", "i"], policy)
        res[label] = {(r["g"], r["i"]): r["h"] for r in sw.finish(sw.add(sw.prepare(df), h=RunningXor(F.col("x")))).collect()}
    want, rows = {}, sorted((r["g"], r["i"], r["x"]) for r in df.collect())
    for g, i, x in rows:
        want[g, i] = want.get((g, i - 1), 0) ^ (x or 0)
    assert res["plain"] == res["split"] == want


def test_a_chain_of_rounds_has_one_exchange_of_the_rows(spark):
    df = _frame(spark)
    sw = SplitWindow(df, ["g"], ["t", "i"], SplitPolicy(hot_rows=5, chunk_rows=4))
    x = sw.add(sw.prepare(df), a=RowNumber())
    x = sw.add(x.where(F.col("a") != 3), b=Lag(F.col("a")))
    out = sw.finish(sw.add(x, c=LastNonNullBefore(F.col("b"))))
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"(?<!Broadcast)Exchange \w+", plan)
    assert exchanges == ["Exchange shufflepartitionidpassthrough"] and plan.count("Sort [") == 1
    assert out.count() == 66
