"""Distributed order statistics equal brute force."""

import hashlib
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from creditloom.functions.lookup import lookup_join
from creditloom.functions.order import exact_medians, running_totals
from creditloom.operators.splits import early_stop_holdout, stratified_folds, stratified_split


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(2_000).select(F.col("id").alias("loan_id"), (F.col("id") % 12 == 0).cast("int").alias("target"))


def ranked(seed, target):
    keys = [i for i in range(2_000) if (i % 12 == 0) == bool(target)]
    return sorted(keys, key=lambda i: (hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), i))


def by_key(df, col):
    return {r["loan_id"]: r[col] for r in df.collect()}


def test_split_equals_ranking(labelled):
    got = by_key(stratified_split(labelled), "split")
    for target in (0, 1):
        order = ranked(42, target)
        test, val = math.ceil(len(order) * 2 / 10), math.ceil(len(order) / 10)
        assert [got[k] for k in order] == ["test"] * test + ["val"] * val + ["train"] * (len(order) - test - val)


def test_split_ignores_partitioning_and_order(labelled):
    other = labelled.orderBy(F.desc("loan_id")).repartition(13)
    assert by_key(stratified_split(labelled), "split") == by_key(stratified_split(other), "split")


def test_folds_are_equal_runs(labelled):
    got = by_key(stratified_folds(labelled, 5), "fold")
    for target in (0, 1):
        order = ranked(42, target)
        folds = [got[k] for k in order]
        assert folds == sorted(folds)
        sizes = [folds.count(f) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


def test_more_folds_than_rows(spark, rows):
    few = rows([(1, 0), (2, 0), (3, 1)], "loan_id bigint, target int")
    assert sorted(r["fold"] for r in stratified_folds(few, 5).where("target = 0").collect()) == [0, 1]


def test_holdout_share(labelled):
    counts = early_stop_holdout(labelled).groupBy("target").agg(F.count_if("is_holdout").alias("n")).collect()
    assert {r["target"]: r["n"] for r in counts} == {1: math.ceil(167 / 10), 0: math.ceil(1833 / 10)}


@pytest.mark.parametrize("edges", [None, [], [5.0], [0.0, 100.0, 100.5, 1e6]])
def test_running_totals(spark, edges):
    df = spark.range(400).select((F.col("id") % 2).alias("g"), (F.col("id") * F.col("id") % 1009 + F.col("id") / 1e3).alias("x"),
                                 (F.col("id") % 7).alias("n"))
    got = running_totals(df, "x", ["n"], by=["g"], edges=edges, last=["n"]).collect()
    for g in (0, 1):
        mine = sorted((r for r in got if r["g"] == g), key=lambda r: r["x"])
        total, before = 0, None
        for r in mine:
            total += r["n"]
            assert r["n_through"] == total and r["prev_n"] == before
            before = r["n"]
        assert {r["n_total"] for r in mine} == {total} and len(mine) == 200


def test_medians(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 9) for _ in range(3_001)]
    skewed = [0.0 if i % 3 else -float(i) for i in range(3_001)]
    holes = [None if i % 4 == 0 else float(i % 10) for i in range(3_001)]
    even = [None] * 2_999 + [-0.0, 5e-324]
    wide = [math.inf if i % 2 else -1e300 for i in range(3_001)]
    named = {"a": values, "b": skewed, "c": holes, "d": [None] * 3_001, "e": even, "f": wide, "g": [-v for v in values]}
    df = spark.createDataFrame(list(zip(*named.values())), ", ".join(f"{c} double" for c in named)).repartition(4)
    got = exact_medians(df, list(named))
    assert got == {c: statistics.median(v for v in vs if v is not None) if c != "d" else None for c, vs in named.items()}


def test_lookup_join_beyond_the_size_limit(rows):
    big = rows([(1,), (2,), (None,)], "k int")
    table = rows([(1, "a"), (None, "n")], "k int, v string")
    for limit in (100, 1):
        joined = lookup_join(big, table, ["k"], max_rows=limit)
        assert sorted(map(str, ((r["k"], r["v"]) for r in joined.collect()))) == ["(1, 'a')", "(2, None)", "(None, 'n')"]
