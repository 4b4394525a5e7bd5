"""Models, shares, allocation, permits and energy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from arealens.operators import allocate, energy, model, permits
from arealens.operators.aggregate import totals_check
from conftest import rows


@pytest.mark.parametrize("t,df,p", [(2.0, 10, 0.036694017385370), (-1.0, 5, 0.818391266175439), (0.0, 7, 0.5), (3.0, 100, 0.001703957671665), (12.7062, 1, 0.025)])
def test_t_tail(t, df, p):
    assert model.t_tail(t, df) == pytest.approx(p, rel=1e-5)


def test_choose_predictors_raises_the_cutoff():
    values = {"a": (0.1, 0.22), "b": (0.2, 0.14), "c": (-0.9, 1.99)}
    assert model.choose_predictors(values) == ["b"]
    assert model.choose_predictors({"c": (-0.9, 1.99)}) == ["c"]
    assert model.choose_predictors({}) == []


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(3)
    x, z = rng.random(80) * 10, rng.random(80) * 10
    y = 3 * x + 5 + rng.normal(0, 0.01, 80)
    return spark.createDataFrame([(i, 2014 + i % 4, float(a), float(b), float(-a), 1.0, float(c)) for i, (a, b, c) in enumerate(zip(x, z, y))],
                                 "g int, Year int, x double, z double, neg double, one double, y double")


def test_fit_leaves_out_negative_correlations_and_constants(spark, panel):
    fitted = {r["Variable"]: r["y"] for r in model.fit_models(panel, {"y": [2014, 2015, 2016, 2017]}, ["x", "neg", "one"]).collect()}
    assert set(fitted) == {"x"} and fitted["x"] == pytest.approx(3, abs=0.01)
    with_constant = {r["Variable"]: r["y"] for r in model.fit_models(panel, {"y": [2014, 2015]}, ["x", "one"], intercept=True).collect()}
    assert with_constant[model.INTERCEPT] == pytest.approx(5, abs=0.05)


def test_apply_clips_at_zero(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, -4.0, 1.0)], "g int, a double, b double")
    coefficients = spark.createDataFrame([("a", 2.0), ("b", 1.0), (model.INTERCEPT, 1.0)], "Variable string, Jobs double")
    assert rows(model.apply_models(df, coefficients, ["g"])) == [(1, 5.0), (2, 0.0)]


def test_neighbour_fill_spreads_and_stops(spark):
    counts = spark.createDataFrame([(1, 1.0, 3.0), (2, 0.0, 0.0), (3, 0.0, 0.0), (4, 0.0, 0.0), (5, 2.0, 2.0)], "g int, a double, b double")
    touch = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 2), (5, 2), (2, 5)], "src int, nbr int")
    shares = model.area_shares(counts, ["g"], ["a", "b"])
    out = rows(model.fill_from_neighbours(shares, touch, ["g"], ["a", "b"]))
    assert out == [(1, 0.25, 0.75), (2, 0.375, 0.625), (3, 0.375, 0.625), (4, None, None), (5, 0.5, 0.5)]
    places = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 2.0, 0.0), (4, 9.0, 0.0), (5, 8.0, 0.0)], "g int, x double, y double")
    rest = model.fill_from_nearest(model.fill_from_neighbours(shares, touch, ["g"], ["a", "b"]), places, ["g"], ["a", "b"])
    assert rows(rest)[3] == (4, 0.5, 0.5)


def test_carry_forward_stays_in_the_area(spark):
    df = spark.createDataFrame([(1, 2014, 0.5), (1, 2015, None), (2, 2014, None), (2, 2015, 0.1), (2, 2016, None)], "g int, y int, s double")
    assert rows(model.carry_forward(df, ["g"], "y", ["s"])) == [(1, 2014, 0.5), (1, 2015, 0.5), (2, 2014, None), (2, 2015, 0.1), (2, 2016, 0.1)]


def test_donor_years_take_the_earlier_on_ties(spark):
    wanted = spark.createDataFrame([(2013,), (2016,), (2020,)], "Year int")
    seen = spark.createDataFrame([(2014,), (2018,)], "Year int")
    assert rows(model.donor_years(wanted, seen)) == [(2013, 2014), (2016, 2014), (2020, 2018)]


def test_extrapolation_fills_the_missing_year(spark, panel):
    frames = {y: panel.where(F.col("Year") == y).drop("Year") for y in (2014, 2015, 2016, 2017)}
    frames[2017] = frames[2017].drop("y")
    out = model.extrapolate_years(frames, {"y": [2014, 2015, 2016]}, "g", ["x"]).where("Year = 2017").collect()
    assert out and all(r["y"] == pytest.approx(3 * r["x"] + 5, abs=0.2) for r in out)


# --- allocation -----------------------------------------------------------

PARCELS = [
    # area, parcel, land use, building area, land
    ("lu", 1, 29, 30.0, 1.0), ("lu", 2, 29, 10.0, 1.0), ("lu", 3, 11, 60.0, 1.0),
    ("nr", 4, 11, 20.0, 1.0), ("nr", 5, 1, 80.0, 1.0),
    ("ad", 6, 1, 25.0, 1.0), ("ad", 7, 99, 75.0, 1.0),
    ("liv", 8, 99, 40.0, 1.0), ("liv", 9, -1, 60.0, 1.0),
    ("land", 10, 99, 0.0, 3.0), ("land", 11, 29, -5.0, 1.0),
]
VALUES = dict(CNS06=100.0, Total_Hispanic=50.0, Total_Non_Hisp=30.0, Drove=10.0)


@pytest.mark.parametrize("forced", [False, True])
def test_cascade_uses_the_first_positive_level(spark, request, forced):
    if forced:
        request.getfixturevalue("force_split")
    parcels = spark.createDataFrame(PARCELS, "g string, p int, lu int, liv double, land double")
    names = sorted({r[0] for r in PARCELS})
    areas = spark.createDataFrame([(n, *VALUES.values()) for n in names], "g string, " + ", ".join(f"{k} double" for k in VALUES))
    out = allocate.allocate_to_parcels(parcels, areas, "g", "p", "lu", "liv", "land", ("CNS06",), ("Total_Hispanic", "Total_Non_Hisp"),
                                       ("Total_Hispanic", "Total_Non_Hisp"), ("Drove",))
    got = {r["p"]: r for r in out.collect()}
    jobs = {1: 75, 2: 25, 3: 0, 4: 100, 5: 0, 6: 100, 7: 0, 8: 40, 9: 60, 10: 75, 11: 25}
    people = {1: 24, 2: 8, 3: 48, 4: 0, 5: 80, 6: 80, 7: 0, 8: 32, 9: 48, 10: 60, 11: 20}
    assert {p: r["CNS06_PAR"] for p, r in got.items()} == pytest.approx(jobs)
    assert {p: r["Total_Population"] for p, r in got.items()} == pytest.approx(people)
    assert {p: r["Total_Commutes"] for p, r in got.items()} == pytest.approx({p: v / 8 for p, v in people.items()})
    check = totals_check(areas, out, "g", {k: f"{k}_PAR" for k in VALUES})
    assert all(r["Off"] == 0 and r["Max"] < 1e-9 for r in check.collect())


def test_near_term_adds_to_permit_parcels_only(spark):
    parcels = spark.createDataFrame([("a", 1, 29, 10.0, 1.0, 1), ("a", 2, 29, 30.0, 1.0, 0)], "g string, p int, lu int, liv double, land double, PERMIT int")
    base = spark.createDataFrame([("a", 100.0)], "g string, CNS06 double")
    later = spark.createDataFrame([("a", 160.0)], "g string, CNS06 double")
    kinds = dict(sectors=("CNS06",), groups=(), totals=(), modes=())
    now = allocate.allocate_to_parcels(parcels, base, "g", "p", "lu", "liv", "land", **kinds)
    out = allocate.near_term_allocation(now, base, later, parcels, "g", "p", "lu", "liv", "land", **kinds)
    assert rows(out, "p", "CNS06_PAR", "Year") == [(1, 85.0, 9998), (2, 75.0, 9998)]


# --- permits --------------------------------------------------------------

def test_clean_permits(spark):
    raw = spark.createDataFrame(
        [("P1", "12", "MAIN", "C", "$ 1,000", "$10", "710PD", 5.0), ("SMPL", "13", "MAIN", "C", "$1", "$1", "710", 1.0),
         ("P2", "14", "A SAMPLE", "C", "$1", "$1", "710", 1.0), ("P3", "15", "MAIN", "Z", "$1", "$1", "999", 1.0), ("P4", "16", "MAIN", "Z", "$1", "$1", "710", 2.0)],
        "PROC_NUM string, FOLIO string, ADDRESS string, STATUS string, CONST_COST string, ADMIN_COST string, CAT_CODE string, UNITS_VAL double")
    categories = spark.createDataFrame([("710", "Office", "sq. ft.", 17)], "CAT_CODE string, LANDUSE string, UNITS string, DOR_UC int")
    uses = spark.createDataFrame([(17, "Office")], "DOR_UC int, GN_VA_LU string")
    out = permits.clean_permits(raw, categories, uses)
    assert rows(out, "PROC_NUM", "FOLIO", "STATUS", "COST", "PED_ORIENTED", "GN_VA_LU") == [
        ("P1", "0" * 11 + "12", "Collected", 1010.0, 1, "Office"), ("P4", "0" * 11 + "16", None, 2.0, 0, "Office")]


def test_units_and_short_term_update(spark):
    parcels = spark.createDataFrame(
        [("a", 1, 100.0, 10.0, 30.0, 2, 0.0, 43560.0), ("b", 1, 300.0, 10.0, 5.0, 1, 2.0, 87120.0), ("c", 9, 50.0, 1.0, 1.0, 1, 0.0, 1.0)],
        "FOLIO string, DOR_UC int, TOT_LVG_AREA double, LND_VAL double, JV double, NO_BULDNG int, NO_RES_UNTS double, LND_SQFOOT double")
    rows_in = [("a", 1, "unit", 3.0, 100.0), ("a", 9, "screen", 1.0, 0.0), ("b", 1, "sq. ft.", 40.0, 1.0), ("b", 1, "unit", -1.0, 9.0), ("z", 5, "seat", 2.0, 1.0)]
    wanted = spark.createDataFrame(rows_in, "FOLIO string, DOR_UC int, UNITS string, UNITS_VAL double, COST double")
    reference = permits.unit_reference(parcels, wanted, "DOR_UC", "TOT_LVG_AREA", "UNITS")
    assert rows(reference) == [(1, "sq. ft.", 1.0, -1.0), (1, "unit", 150.0, -1.0), (5, "seat", -1.0, -1.0), (9, "screen", -1.0, 50.0)]
    out = permits.short_term_parcels(parcels, wanted, reference)
    got = {r["FOLIO"]: r for r in out.collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a["TOT_LVG_AREA"], a["UPDT_LVG_AREA"], a["NO_RES_UNTS"], a["JV"], a["NO_BULDNG"], a["PERMIT"], a["DOR_UC"]) == (600.0, 500.0, 3.0, 110.0, 1, 1, 1)
    assert (b["TOT_LVG_AREA"], b["JV"], b["NO_RES_UNTS"]) == (340.0, 11.0, 2.0)
    assert (c["TOT_LVG_AREA"], c["PERMIT"], c["NO_BULDNG"], c["UPDT_LVG_AREA"]) == (50.0, 0, 1, 0.0)
    assert set(got) == {"a", "b", "c"}


# --- energy ---------------------------------------------------------------

def test_energy_overlap_against_a_scan(spark):
    levels = [("Division", "South Atlantic", 10.0, 1.0), ("Division", "Mountain", 99.0, 1.0), ("Housing unit", "Mobile homes", 12.0, 0.5), ("Year", "Before 1950", 11.0, 2.0), ("SQFT", "Fewer than 1,000", 9.0, 1.5)]
    estimates = spark.createDataFrame([(*r, "Total Energy", "Total") for r in levels], "Category string, Level string, Estimate double, SE double, Fuel string, End_Use string")
    out = energy.energy_by_type(estimates, 0.01).collect()
    assert len(out) == 1
    dists = [(m, s) for _, name, m, s in levels if name != "Mountain"]
    low, high = min(m - 3 * s for m, s in dists), max(m + 3 * s for m, s in dists)
    grid = [low + i * 0.01 for i in range(int((high - low) / 0.01 + 1e-9) + 1)]
    best = max(grid, key=lambda x: min(math.exp(-((x - m) / s) ** 2 / 2) / s for m, s in dists))
    assert out[0]["Energy"] == pytest.approx(best, abs=1e-9)
    homes = spark.createDataFrame([(1, "02", 500.0, 1900, 1), (2, "02", 1500.0, 1900, 1), (3, "05", 500.0, 1900, 1), (4, "02", 999.5, 1900, 1)], "f int, lu string, a double, y int, u int")
    assert rows(energy.energy_to_parcels(homes, energy.energy_by_type(estimates, 0.01), "f", "lu", "a", "y", "u")) == [
        (1, pytest.approx(best)), (2, 0.0), (3, 0.0), (4, 0.0)]
