"""Split joins, medians and numbering against plain Spark, with one key holding a third of the rows."""

import statistics

import pytest
from pyspark.sql import functions as F

from arealens import skew
from conftest import rows


def lopsided(spark, n=3000):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500)
    return spark.range(n).select(F.col("id").alias("rid"), key.cast("bigint").alias("k"), (F.col("id") * 37 % 1000).cast("double").alias("v"))


def test_hot_keys_finds_the_third(spark, force_split):
    found = skew.hot_keys(lopsided(spark), ["k"])
    expect = spark.range(1).select(F.xxhash64(F.lit(7).cast("bigint"))).first()[0]
    assert found == [expect]


def test_hot_keys_of_small_samples_are_not_sought(spark):
    assert skew.hot_keys(lopsided(spark), ["k"]) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_join(spark, force_split, how):
    facts = lopsided(spark)
    dim = spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    advice = skew.advise(facts, dim, "k")
    assert advice.hot and not advice.small
    got = skew.spread_join(facts, dim, "k", how, advice, splits=8)
    assert rows(got, *sorted(got.columns)) == rows(facts.join(dim, "k", how), *sorted(got.columns))


def test_spread_join_splits_a_key_hot_on_both_sides(spark, force_split):
    left = lopsided(spark, 600)
    right = lopsided(spark, 300).select("k", F.col("rid").alias("other"))
    advice = skew.advise(left, right, "k", unique=False)
    assert set(advice.hot) & set(advice.hot_right)
    got = skew.spread_join(left, right, "k", advice=advice, splits=16)
    assert rows(got, "k", "rid", "other") == rows(left.join(right, "k"), "k", "rid", "other")


def test_spread_join_key_hot_on_the_right_only(spark, force_split):
    left = spark.range(500).select(F.col("id").alias("k"))
    right = lopsided(spark, 900).select("k", "rid")
    advice = skew.advise(left, right, "k", unique=False)
    assert advice.hot_right and not advice.hot
    got = skew.spread_join(left, right, "k", advice=advice)
    assert rows(got, "k", "rid") == rows(left.join(right, "k"), "k", "rid")


def test_small_side_is_broadcast_after_a_check(spark):
    advice = skew.advise(lopsided(spark), spark.range(10).withColumnRenamed("id", "k"), "k")
    assert advice.small


def test_right_side_cannot_be_split_in_an_outer_join(spark):
    df = spark.range(3).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        skew.spread_join(df, df, "k", "left", skew.JoinAdvice(hot_right=(1,)))


@pytest.mark.parametrize("forced", [False, True])
def test_exact_median(spark, request, forced):
    if forced:
        request.getfixturevalue("force_split")
    df = lopsided(spark, 4000).withColumn("k", F.when(F.col("k") != 11, F.col("k")))
    df = df.withColumn("u", F.when(F.col("rid") % 5 != 0, F.col("v")))
    got = {r["k"]: (r["m"], r["n"]) for r in skew.exact_median(df, ["k"], {"m": "v", "n": "u"}).collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault(r["k"], []).append((r["v"], r["u"]))
    assert set(got) == set(groups)
    for k, vals in groups.items():
        known = [u for _, u in vals if u is not None]
        assert got[k][0] == statistics.median(v for v, _ in vals)
        assert got[k][1] == (statistics.median(known) if known else None)


def test_exact_median_of_a_large_group_with_many_values(spark):
    df = spark.range(200_000).select(F.lit(1).alias("g"), (F.pmod(F.col("id") * 7919, F.lit(200_000)) / 3).alias("v"))
    assert skew.exact_median(df, ["g"], {"m": "v"}).first()["m"] == pytest.approx((99_999 + 100_000) / 2 / 3)


@pytest.mark.parametrize("forced", [False, True])
def test_group_totals_match_windows(spark, request, forced):
    if forced:
        request.getfixturevalue("force_split")
    df = lopsided(spark, 1500).withColumn("k", F.when(F.col("k") != 11, F.col("k")))
    got = skew.with_group_totals(df, ["k"], {"t": F.sum("v")})
    sums = {}
    for r in df.collect():
        sums[r["k"]] = sums.get(r["k"], 0) + r["v"]
    assert {r["rid"]: r["t"] for r in got.collect()} == {r["rid"]: sums[r["k"]] for r in df.collect()}


def test_number_rows_is_dense_and_ordered(spark):
    df = lopsided(spark, 1000).repartition(7)
    got = skew.number_rows(df, [F.col("v").desc(), F.col("rid")], "i", start=1).collect()
    expect = sorted(df.collect(), key=lambda r: (-r["v"], r["rid"]))
    assert [r["rid"] for r in sorted(got, key=lambda r: r["i"])] == [r["rid"] for r in expect]
    assert sorted(r["i"] for r in got) == list(range(1, 1001))


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 3, "b"), (2, 1, "c")], "k int, o int, s string")
    assert rows(skew.first_per_key(df, ["k"], [F.col("o")])) == [(1, 3, "b"), (2, 1, "c")]
    assert rows(skew.first_per_key(df, ["k"], [F.col("o")], last=True)) == [(1, 5, "a"), (2, 1, "c")]


def test_attach_scalars(spark):
    df = spark.range(3)
    total = df.agg(F.sum("id").alias("t"))
    assert rows(skew.attach_scalars(df, total, {"all": "t"})) == [(0, 3), (1, 3), (2, 3)]


def test_equal_rows_of_a_hot_key_are_spread(spark, force_split):
    facts = spark.range(900).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 300).cast("bigint").alias("k"), F.lit(1).alias("v"))
    dim = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    advice = skew.advise(facts, dim, "k")
    a, _ = skew._salted(facts, dim, ["k"], ["k"], advice, 9)
    assert a.where("k = 7").select("__salt_l").distinct().count() == 9
    got = skew.spread_join(facts, dim, "k", advice=advice)
    assert rows(got, "k", "v", "w") == rows(facts.join(dim, "k"), "k", "v", "w")


@pytest.mark.parametrize("digits,ranked", [(2, 1), (3, 2), (16, 5), (4096, 1)])
def test_exact_median_narrows_by_digits(spark, monkeypatch, digits, ranked):
    monkeypatch.setattr(skew, "MEDIAN_DIGITS", digits)
    monkeypatch.setattr(skew, "MEDIAN_RANKED", ranked)
    huge, tiny = 1.7e308, 5e-324
    groups = {1: [0.0, tiny, 2 * tiny, 1.0], 2: [-huge, huge, 1.0, 2.0, 3.0], 3: [float("-inf"), 1.0, 5.0, float("inf")], 4: [7.0] * 9, 5: [-1.0, 1.0],
              6: [2.0 ** k for k in range(-40, 41, 8)], 7: [float("-inf")] * 3 + [4.0], 8: [3.0], None: [1.0, 2.0, 2.0, 9.0], 9: [float("nan"), None]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k int, v double")
    got = {r.k: r.m for r in skew.exact_median(df, ["k"], {"m": "v"}).collect()}
    want = {k: statistics.median([v for v in vs if v is not None and v == v] or [None]) for k, vs in groups.items()}
    assert got == want


def test_no_task_sees_more_of_a_group_than_a_bound(spark, monkeypatch):
    """One group of all rows, all distinct: what is ranked in a window is counted."""
    monkeypatch.setattr(skew, "MEDIAN_DIGITS", 64)
    monkeypatch.setattr(skew, "MEDIAN_RANKED", 50)
    seen = []
    ranked, narrowed = skew._ranked, skew._narrowed
    monkeypatch.setattr(skew, "_ranked", lambda long, state, group, few: (seen.append(skew._left_of(long, state, group, few).count()), ranked(long, state, group, few))[1])
    monkeypatch.setattr(skew, "_narrowed", lambda *a: (seen.append("digit"), narrowed(*a))[1])
    df = spark.range(60_000).select(F.lit(1).alias("g"), F.exp(F.pmod(F.col("id") * 7919, F.lit(60_000)) / 4000).alias("v"))
    got = skew.exact_median(df, ["g"], {"m": "v"}).first()["m"]
    import math
    assert got == pytest.approx((math.exp(29_999 / 4000) + math.exp(30_000 / 4000)) / 2)
    assert seen.count("digit") <= 4 and seen[-1] <= 50


def test_few_but_long_rows_are_not_small(spark):
    df = spark.range(100).select("id", F.array_repeat(F.struct(F.lit(1.0).alias("x"), F.lit(2.0).alias("y")), 1000).alias("edges"))
    assert skew.is_small(df)
    assert not skew.is_small(df, size=100 * 1000 * 16)
    assert not skew.is_small(df, rows=99)
    assert skew.is_small(df.select("id"), size=800)


def test_row_bytes_takes_nulls_and_nested_values(spark):
    df = spark.createDataFrame([(None, None, None, None), ("abc", {"k": "vv"}, [["a"], []], (1, "xy"))],
                               "s string, m map<string,string>, a array<array<string>>, t struct<n:int,u:string>")
    small, large = (r[0] for r in df.select(skew.row_bytes(df).alias("b")).orderBy("b").collect())
    assert 0 < small < large
