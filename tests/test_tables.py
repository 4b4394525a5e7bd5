"""Joins, summaries, access and skims on small frames."""

import math

import pytest
from pyspark.sql import functions as F

from arealens.operators import access, aggregate, joins
from arealens.specs import MEDIAN, AggCol, CalcSpec, Col, Consolidation, DomainCol, FeatureSpec, Melt, TableSpec, apply_calcs
from conftest import rows


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, 10.0, "a"), (2, 20.0, "b"), (3, None, "c")], "k int, v double, s string")


def test_extend(spark, base):
    more = spark.createDataFrame([(1, 5.0)], "key int, w double")
    assert rows(joins.extend(base, more, "k", "key"), "k", "w") == [(1, 5.0), (2, None), (3, None)]
    clash = more.withColumnRenamed("w", "v")
    with pytest.raises(ValueError):
        joins.extend(base, clash, "k", "key")
    assert rows(joins.extend(base, clash, "k", "key", append_only=False), "k", "v") == [(1, 5.0), (2, None), (3, None)]


def test_join_attributes_leaves_known_fields_and_fills_matched_nulls(spark, base):
    right = spark.createDataFrame([(1, 9.0, None), (2, 8.0, 7.0)], "k int, v double, w double")
    assert rows(joins.join_attributes(base, right, "k", "k"), "k", "v", "w") == [(1, 10.0, 0.0), (2, 20.0, 7.0), (3, None, None)]
    assert joins.join_attributes(base, right, "k", "k", ["v"]) is base


def test_join_specs_goes_by_name(spark, base):
    out = joins.join_specs({"Parcels": base}, {"X_PARCELS": base.select("k", F.lit(1).alias("x")), "Y_blocks": base.select("k", F.lit(2).alias("y"))},
                           [FeatureSpec("Parcels", "k")], [TableSpec("X_PARCELS", "k"), TableSpec("Y_blocks", "k")])
    assert out["Parcels"].columns == ["k", "v", "s", "x"]


def test_merge_many_suffixes_the_last_of_an_odd_number(spark):
    a, b, c = (spark.createDataFrame([(1, float(i))], "k int, t double") for i in range(3))
    assert joins.merge_many([a, b, c], "k", ("_A", "_B", "_C")).columns == ["k", "t_A", "t_B", "t_C"]
    only = c.withColumnRenamed("t", "z")
    assert joins.merge_many([a, b, only], "k", ("_A", "_B", "_C")).columns == ["k", "t_A", "t_B", "z_C"]
    assert joins.merge_many([a, only], "k", ("_A", "_B")).columns == ["k", "t", "z"]


def test_patch_update_add_reindex(spark):
    local = spark.createDataFrame([(1, 5)], "k int, hh int")
    regional = spark.createDataFrame([(1, 9, 3), (2, 8, 4)], "k int, hh int, enrol int")
    assert rows(joins.patch(local, regional, "k"), "k", "hh", "enrol") == [(1, 5, 3), (2, 8, 4)]
    newer = spark.createDataFrame([(2, None, 1), (3, 0, 0)], "k int, hh int, enrol int")
    assert rows(joins.update(regional, newer, "k")) == [(1, 9, 3), (2, 8, 1)]
    assert rows(joins.add_by_key(local, regional, "k"), "k", "hh", "enrol") == [(1, 14, None), (2, None, None)]
    assert rows(joins.reindex(regional.select("k"), local, "k")) == [(1, 5), (2, 0)]


def test_difference_keeps_base_rows_and_is_antisymmetric(spark):
    a = spark.createDataFrame([(1, 2.0, "x"), (2, 5.0, "y")], "k int, v double, s string")
    b = spark.createDataFrame([(1, 3.5, "x"), (3, 1.0, "z")], "k int, v double, s string")
    assert rows(joins.difference(b, a, "k")) == [(1, 1.5), (2, -5.0)]
    assert rows(joins.difference(a, b, "k")) == [(1, -1.5), (3, -1.0)]


def test_stack_years_and_pseudo_year(spark, base):
    out = joins.stack_years({2019: base, "NearTerm": base.select("k")})
    assert rows(out, "k", "v", "Year")[0] == (1, 10.0, 2019)
    assert {r[2] for r in rows(out, "k", "v", "Year")} == {2019, 9998}


def test_sources_are_flagged(spark, base):
    jobs = spark.createDataFrame([(1, 4)], "g int, jobs int")
    out = joins.enrich_sources(base.select("k"), "k", {"JOBS_SRC": [("LODES", jobs, "g")], "DEM_SRC": [("ACS", None, "g")]})
    assert rows(out, "k", "jobs", "JOBS_SRC", "DEM_SRC") == [(1, 4, "LODES", "EXTRAP"), (2, None, "LODES", "EXTRAP"), (3, None, "LODES", "EXTRAP")]


def test_clean_parcels(spark):
    shapes = spark.createDataFrame([("000000000007", (1.0, 2.0)), ("000000000007", (0.0, 1.0)), ("000000000008", None)], "PARCELNO string, geometry struct<x:double,y:double>")
    table = spark.createDataFrame([("7", 100.0)], "PARCEL_ID string, JUST double")
    out, pieces = joins.clean_parcels(shapes, table, "PARCELNO", "PARCEL_ID", renames={"JUST": "JV"})
    assert rows(out, "FOLIO", "NumPieces", "JV") == [("000000000007", 2, 100.0)]
    assert pieces.count() == 2


# --- summaries ------------------------------------------------------------

def test_summarize_fills_before_aggregating(spark):
    df = spark.createDataFrame([("n", 4.0, 2.0), ("n", None, 3.0), (None, 6.0, 1.0)], "g string, v double, w double")
    out = aggregate.summarize(df, Col("g", default="none", rename="grp"),
                              [AggCol("v", method="mean"), AggCol("w", method=MEDIAN, rename="mid"), AggCol("v", rename="n", method="size")],
                              [Consolidation("p", ("v", "w"), fold="product"), Consolidation("t", ("v", "w"))])
    assert rows(out, "grp", "v", "mid", "n", "p", "t") == [("n", 2.0, 2.5, 2, 8.0, 9.0), ("none", 6.0, 1.0, 1, 6.0, 7.0)]


def test_summarize_melts_and_orders(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 10.0), (1, 4.0, None, 20.0)], "g int, a double, b double, m double")
    out = aggregate.summarize(df, Col("g"), AggCol("m"), (), Melt("L", "V", ("a", "b"), domain=DomainCol("D", {"a": 1})))
    assert rows(out, "g", "L", "D", "m", "V") == [(1, "a", 1, 30.0, 6.0), (1, "b", -1, 30.0, 3.0)]


def test_summarize_names_missing_columns(spark):
    with pytest.raises(ValueError, match="nope"):
        aggregate.summarize(spark.range(1), Col("id"), AggCol("nope"))
    with pytest.raises(ValueError):
        aggregate.summarize(spark.range(1), "id", ())


def test_summaries_of_one_table_share_an_aggregation(spark):
    data = [(1, "a", 1.0, 10.0, None), (1, "b", None, 20.0, 3.0), (2, "a", 4.0, 30.0, 5.0), (None, "b", 2.0, 1.0, 1.0), (2, "a", 6.0, 2.0, 8.0)]
    df = spark.createDataFrame(data, "k int, g string, m double, a double, b double")
    parts = [
        aggregate.Summary([Col("k", default=-1)], [AggCol("m"), AggCol("a", rename="mid", method="median")]),
        aggregate.Summary([Col("k", default=9), Col("g", rename="grp", domain=DomainCol("D", {"a": 1}))], [AggCol("m", method="mean"), AggCol("g", rename="n", method="size")]),
        aggregate.Summary([Col("g")], [AggCol("b", rename="mid_b", method="median")], [], Melt("L", "V", ("a", "b"), domain=DomainCol("LD", {"b": 2}))),
        aggregate.Summary([], [AggCol("a")]),
    ]
    together = aggregate.summarize_all(df, parts)
    for part, got in zip(parts, together):
        alone = aggregate.summarize(df, *part)
        assert got.columns == alone.columns and rows(got) == rows(alone) and got.count()
    assert rows(together[0]) == [(-1, 2.0, 1.0), (1, 1.0, 15.0), (2, 10.0, 16.0)]
    assert rows(together[2]) == [("a", "a", -1, 5.0, 42.0), ("a", "b", 2, 5.0, 13.0), ("b", "a", -1, 2.0, 21.0), ("b", "b", 2, 2.0, 4.0)]
    assert rows(together[3]) == [(63.0,)]


def test_summaries_read_their_table_once(spark, tmp_path):
    spark.range(100).select((F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    calls = []
    cut, aggregate.cut = aggregate.cut, lambda d: (calls.append(d._jdf.queryExecution().executedPlan().toString()), cut(d))[1]
    try:
        aggregate.summarize_all(df, [aggregate.Summary([Col("k")], [AggCol("v")]), aggregate.Summary([Col("k"), Col("g")], [AggCol("v", method="mean")])])
    finally:
        aggregate.cut = cut
    assert len(calls) == 1 and calls[0].count("FileScan") == 1 and calls[0].count("Exchange") == 1


def test_summarize_takes_a_column_function(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 5.0)], "g int, v double")
    out = aggregate.summarize(df, Col("g"), AggCol("v", method=lambda c: F.max(c) - F.min(c)))
    assert rows(out) == [(1, 3.0)]


def test_calc_specs_expand(spark):
    spec = CalcSpec(("T",), "{0}in30{1}", lambda c, a, m: c(f"{a}15{m}") + c(f"{a}30{m}"), (("J", "H"), ("W",)))
    df = spark.createDataFrame([(1, 2, 3, 4)], "J15W int, J30W int, H15W int, H30W int")
    out = apply_calcs(df, "T", [spec])
    assert rows(out, "Jin30W", "Hin30W") == [(3, 7)]
    assert apply_calcs(df, "Other", [spec]).columns == df.columns


def test_mean_then_sum_and_criteria(spark):
    from arealens.predicates import any_of

    df = spark.createDataFrame([(1, "p", 4.0, 7), (1, "p", 6.0, 7), (1, "q", 1.0, 8)], "a int, i string, v double, lu int")
    assert rows(aggregate.mean_then_sum(df, "a", "i", ["v"])) == [(1, 6.0)]
    assert rows(aggregate.criteria_sums(df, "a", "i", "lu", "v", {"x": any_of(7), "y": any_of(9)})) == [(1, 5.0, 0.0)]


def test_diversity_bounds(spark):
    even = spark.createDataFrame([(1, c, 2.0) for c in "abcd"] + [(2, "a", 5.0)], "g int, lu string, w double")
    out = {r["g"]: r for r in aggregate.diversity(even, "g", "lu", "w", 4).collect()}
    assert out[1]["Shannon"] == pytest.approx(1) and out[1]["ENP"] == pytest.approx(1) and out[1]["BergerParker"] == pytest.approx(1)
    assert out[1]["Simpson"] == pytest.approx(1 - 4 * 2 / 56)
    assert out[2]["Shannon"] == pytest.approx(0) and out[2]["ENP"] == pytest.approx(0) and out[2]["Simpson"] == pytest.approx(0)


def test_simpson_is_null_for_a_total_of_one(spark):
    df = spark.createDataFrame([(1, "a", 1.0)], "g int, lu string, w double")
    assert aggregate.diversity(df, "g", "lu", "w", 3).first()["Simpson"] is None


def test_crosswalk_refuses_od(spark):
    df = spark.createDataFrame([("1", 2)], "w_geocode string, C01 int")
    with pytest.raises(ValueError):
        aggregate.crosswalk_roll_up(df, df, "w_geocode", "w_geocode", "bg", "OD")


def test_correlation_of_constant_is_left_out(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 4.0, 1.0), (3.0, 6.0, 1.0)], "x double, y double, c double")
    out = aggregate.correlations(df, "y", ["x", "c"]).collect()
    assert [(r["Variable"], round(r["r"], 9)) for r in out] == [("x", 1.0)]


# --- access ---------------------------------------------------------------

@pytest.fixture
def skim(spark):
    data = [(1, 1, 5.0), (1, 2, 20.0), (1, 3, 70.0), (2, 1, 15.0), (2, 3, None), (3, 9, 1.0)]
    return spark.createDataFrame(data, "o long, d long, t double")


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(1, 10.0), (2, 4.0), (3, 6.0)], "id long, jobs double")


def test_access_by_destination(spark, skim, zones):
    out = {r["o"]: r for r in access.access_summary(skim, zones, "o", "d", "t", "id", ["jobs"]).collect()}
    assert set(out) == {1, 2}
    assert (out[1]["jobs15Min"], out[1]["jobs30Min"], out[1]["jobs45Min"], out[1]["jobs60Minp"]) == (10.0, 4.0, None, 6.0)
    assert out[1]["AvgMinjobs"] == (50 + 80 + 420) / 20
    # null impedance is in the overflow bin, and in the denominator of the mean
    assert (out[2]["jobs30Min"], out[2]["jobs60Minp"], out[2]["AvgMinjobs"]) == (10.0, 6.0, 150 / 16)


def test_access_bins_add_up_and_infinite_times_leave_the_mean(spark, skim, zones):
    more = skim.union(spark.createDataFrame([(1, 2, float("inf"))], skim.schema))
    r = access.access_summary(more, zones, "o", "d", "t", "id", ["jobs"]).where("o = 1").first()
    assert sum(r[f"jobs{b}"] or 0 for b in ("15Min", "30Min", "45Min", "60Min", "60Minp")) == 24
    assert r["AvgMinjobs"] == (50 + 80 + 420) / 20
    with pytest.raises(ValueError):
        access.access_summary(skim, zones, "o", "d", "t", "id", ["jobs"], join_by="X")


def test_access_with_hot_zone_is_the_same(spark, force_split, zones):
    data = [(i, 1 if i % 3 else 2, float(i % 70)) for i in range(900)]
    big = spark.createDataFrame(data, "o long, d long, t double").withColumn("o", F.col("o") % 5)
    got = access.access_summary(big, zones, "o", "d", "t", "id", ["jobs"])
    from arealens.skew import JoinAdvice

    assert rows(got) == rows(access.access_summary(big, zones, "o", "d", "t", "id", ["jobs"], advice=JoinAdvice()))


def test_travel_stats(spark, zones):
    od = spark.createDataFrame([(1, 2, 4.0, 10.0, 2.0), (1, 3, 1.0, float("inf"), 5.0), (5, 1, 2.0, 1.0, 1.0)], "o long, d long, n double, m double, l double")
    zones = zones.withColumn("hh", F.lit(0.0))
    out = {r["id"]: r for r in access.travel_stats(od, zones, "o", "d", "n", "m", "l", "id", "hh", "jobs").collect()}
    assert out[1]["AVG_DIST_FROM"] == 13 / 5 and out[1]["AVG_TIME_FROM"] == 40 / 5 and out[1]["VMT_PER_ACT_FROM"] == 1.3
    assert out[1]["TRIPS_PER_ACT_TO"] == 0.2
    assert out[5]["VMT_PER_ACT_FROM"] == 0.0 and out[5]["AVG_DIST_TO"] is None


def test_best_transit_time(spark):
    def frame(*r):
        return spark.createDataFrame(list(r), "o int, d int, TIME double")

    trips = spark.createDataFrame([(1, 2, 3.0)], "o int, d int, TRIPS double")
    out = access.best_transit_time(frame((1, 2, 9.0)), frame((1, 2, 0.0)), frame((1, 2, 25.0), (1, 3, 0.0)), trips, ["o", "d"])
    assert rows(out, "o", "d", "TIME_AU", "TIME_LOC", "TIME_PRM", "TIME_TR", "TRIPS") == [
        (1, 2, 9.0, math.inf, 25.0, 25.0, 3.0), (1, 3, None, None, math.inf, math.inf, None)]


@pytest.mark.parametrize("forced", [False, True])
def test_join_legs(spark, request, forced):
    if forced:
        request.getfixturevalue("force_split")
    walk = spark.createDataFrame([(1, 10, 2.0), (1, 11, 5.0), (2, 12, 1.0), (3, 12, 9.0)], "OName long, DName long, Minutes double")
    ride = spark.createDataFrame([(10, 12, 8.0), (11, 12, 1.0), (12, 10, 3.0)], "OName long, DName long, Minutes double")
    assert rows(access.join_legs(walk, ride, cutoff=12.0)) == [(1, 2, 7.0), (2, 1, 6.0)]
    assert (3, 1, 14.0) in rows(access.join_legs(walk, ride))
    only = spark.createDataFrame([(1,)], "z long")
    assert rows(access.join_legs(walk, ride, cutoff=12.0, origins=only)) == [(1, 2, 7.0)]


def test_join_legs_reads_long_plans_once(spark):
    skim = spark.range(400).groupBy((F.col("id") % 20).alias("OName"), (F.col("id") % 7).alias("DName"), (F.col("id") % 2).alias("k")).agg(F.min("id").alias("Minutes"))
    out = access.join_legs(skim.where("k = 0"), skim.where("k = 1"), cutoff=300.0)
    # Only the written legs are left in the plan, not the aggregate they come from.
    assert "Range" not in out._jdf.queryExecution().optimizedPlan().toString()
    known = skim.collect()
    walk, ride = ([(r.OName, r.DName, r.Minutes) for r in known if r.k == k and r.Minutes <= 300] for k in (0, 1))
    best = {}
    for o, d, m in ((a[0], c[0], a[2] + b[2] + c[2]) for a in walk for b in ride if a[1] == b[0] for c in walk if b[1] == c[1]):
        if m <= 300:
            best[o, d] = min(best.get((o, d), m), m)
    assert best and {(r.OName, r.DName): r.Minutes for r in out.collect()} == best



@pytest.mark.parametrize("kind", ["long", "string"])
def test_join_legs_shuffle_no_paths(spark, monkeypatch, kind):
    """Small blocks, null zones and times, a busy stop, equal rows; paths are reduced where they are joined."""
    import random

    for name, value in (("LEAVE_ROWS", 70), ("RUN_CELLS", 50), ("RUN_PATHS", 16), ("TASK_PAIRS", 200)):
        monkeypatch.setattr(access, name, value)
    rng = random.Random(3)
    zone = lambda n: None if n == 13 else n if kind == "long" else f"z{n}"
    minutes = lambda: rng.choice([None, *range(1, 9), 2.5, float("nan"), float("inf")])
    walk = [(zone(rng.randrange(40)), zone(rng.choice([5, rng.randrange(30)])), m if (m := minutes()) is None else float(m)) for _ in range(400)]
    ride = [(zone(rng.randrange(30)), zone(rng.choice([5, rng.randrange(30)])), m if (m := minutes()) is None else float(m)) for _ in range(200)]
    schema = f"OName {kind}, DName {kind}, Minutes double"
    out = access.join_legs(spark.createDataFrame(walk, schema), spark.createDataFrame(ride, schema), cutoff=9.0)
    assert out.columns == ["OName", "DName", "Minutes"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan.splitlines()[0] + plan.splitlines()[1] + plan.splitlines()[2]
    best, short = {}, lambda rows: [r for r in rows if r[2] is not None and r[2] <= 9]
    for o, board, t1 in short(walk):
        for start, alight, t2 in short(ride):
            if board is not None and board == start:
                for d, off, t3 in short(walk):
                    if alight is not None and alight == off and t1 + t2 + t3 <= 9:
                        best[o, d] = min(best.get((o, d), 99), t1 + t2 + t3)
    got = out.collect()
    assert best and len(got) == len(best) and {(r.OName, r.DName): r.Minutes for r in got} == best


def test_long_access(spark):
    df = spark.createDataFrame([(1, 5.0, None)], "id int, HH15MinW double, HH30MinW double")
    out = access.long_access(df, ["id"], ["HH"], (15, 30), "Walk", 2019)
    assert rows(out) == [(1, "HH", 15, 0, 5.0, 2019), (1, "HH", 30, 15, 0.0, 2019)]
    assert list(access.access_columns(["HH"], (15,), "Bike")) == ["HH15Min", "AvgMinHH"]


def test_regional_zone_table_is_consolidated(spark):
    from arealens.plans import report_specs as rs

    names = ["MAZ", *rs.REGIONAL_RENAMES, *dict.fromkeys(i for c in rs.REGIONAL_SUMS for i in c.inputs)]
    df = spark.createDataFrame([tuple(range(len(names)))], names)
    out = aggregate.consolidate(df, ["MAZ"], rs.REGIONAL_RENAMES, rs.REGIONAL_SUMS)
    assert out.columns == ["MAZ", "HH", "TotalJobs", "HCJobs", "RsrcJobs", "ConsJobs", "EdJobs", "IndJobs", "OffJobs", "OthJobs", "EnrollAdlt", "EnrollK12"]
    assert out.first()["EnrollK12"] == sum(names.index(i) for i in rs.REGIONAL_SUMS[-1].inputs)
    with pytest.raises(ValueError):
        aggregate.consolidate(df.drop("emp_retail"), ["MAZ"], {}, rs.REGIONAL_SUMS)


def test_stack_years_rewrites_a_wrong_year(spark):
    stale = spark.createDataFrame([(1, 2018)], "k int, Year int")
    assert rows(joins.stack_years({2019: stale}), "k", "Year") == [(1, 2019)]
    assert rows(joins.stack_years({2019: stale}, keep_year=True), "k", "Year") == [(1, 2018)]


def test_crosswalks_with_a_hot_block_and_equal_rows(spark, force_split):
    flows = spark.range(600).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 20).cast("string")).alias("w"),
                                    (F.col("id") % 4).cast("string").alias("h"), F.lit(1).alias("S000"))
    cross = spark.createDataFrame([("hot", "A"), *[(str(i), "A" if i < 10 else "B") for i in range(20)]], "blk string, lev string")
    got = aggregate.od_crosswalk_roll_up(flows, cross, ("w", "h"), "blk", "lev", ["S000"])
    want = {}
    for r in flows.collect():
        k = ("A" if r["w"] == "hot" or int(r["w"]) < 10 else "B", "A")
        want[k] = want.get(k, 0) + 1
    assert {(r["lev1"], r["lev2"]): r["S000"] for r in got.collect()} == want
    one = aggregate.crosswalk_roll_up(flows.withColumnRenamed("S000", "C000"), cross, "w", "blk", "lev")
    assert sum(r["C000"] for r in one.collect()) == 600


def test_merged_layers_get_new_ids(spark):
    a = spark.createDataFrame([(2,), (1,)], "id int")
    got = joins.merge_layers({"b": a, "a": a}, "layer", "new", ["layer", "id"])
    assert rows(got, "new", "layer", "id") == [(1, "a", 1), (2, "a", 2), (3, "b", 1), (4, "b", 2)]


def test_years_share_members_and_joins(spark, tmp_path, monkeypatch):
    """Snapshots of several years are those built alone, also where a parcel is repeated in several years, and find members and join tables once."""
    from arealens.plans.queries import reports, rounded

    made = {
        "region": spark.createDataFrame([(i, f"r{i}") for i in range(3)], "r_regionkey long, r_name string"),
        "nation": spark.createDataFrame([(0,)], "n_nationkey long"),
        "customer": spark.createDataFrame([(i, i % 5, 100.0 + i, "A") for i in range(40)], "c_custkey long, c_nationkey long, c_acctbal double, c_mktsegment string"),
        "supplier": spark.createDataFrame([(i, i % 5, 10.0 * i) for i in range(6)], "s_suppkey long, s_nationkey long, s_acctbal double"),
        "part": spark.createDataFrame([(i, i % 7) for i in range(9)], "p_partkey long, p_size int"),
        "orders": spark.createDataFrame([(i % 110, (i * 7) % 40, "P" if i % 9 == 0 else "O", 1000.0 + 3 * i, f"{1996 + i % 3}-05-01 00:00:00") for i in range(120)] + [
            (None, 3, "O", 5.0, "1996-01-01 00:00:00"), (7, None, "O", 5.0, "1997-01-01 00:00:00"), (8, 3, "O", 5.0, None)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string").withColumn("o_orderdate", F.to_timestamp("o_orderdate")),
    }
    for name, df in made.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    calls = []
    located, tables = reports._located_layers, reports._parcel_tables
    monkeypatch.setattr(reports, "_located_layers", lambda *a: calls.append("members") or located(*a))
    monkeypatch.setattr(reports, "_parcel_tables", lambda *a: calls.append("tables") or tables(*a))
    together = reports.build_years(spark, str(tmp_path), ["AttrByLU"], [1996, 1997])
    assert sorted(calls) == ["members", "tables"]
    for year, snap in together.items():
        alone = reports.build(spark, str(tmp_path), ["AttrByLU"], year, year)["AttrByLU"]
        assert snap["AttrByLU"].columns == alone.columns
        want = rows(rounded(alone))
        assert want and rows(rounded(snap["AttrByLU"])) == want
