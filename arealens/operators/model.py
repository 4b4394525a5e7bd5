"""Area models: predictors by correlation test, linear fits, predictions, shares with neighbour fill, forecasts."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from arealens.functions.scalar import clip_zero
from arealens.operators.aggregate import pearson
from arealens.operators.joins import replace_rows
from arealens.operators.spatial import nearest
from arealens.predicates import area_criteria
from arealens.session import cut
from arealens.skew import spread_join

# Model variables, responses and the categories of each share group.
BASE_YEAR = 2013
SECTORS = tuple(f"CNS{i:02d}" for i in range(1, 21))
SECTOR_AREAS = tuple(c for c in area_criteria() if c.startswith("CNS_"))
PREDICTORS = ("LND_VAL", "LND_SQFOOT", "JV", "TOT_LVG_AREA", "NO_BULDNG", "NO_RES_UNTS", "RES_par", *SECTOR_AREAS,
              "Total_Emp_Area", "Since_2013")
HISPANIC = ("Total_Hispanic", "Total_Non_Hisp")
GROUPS = ("White_Hispanic", "Black_Hispanic", "Asian_Hispanic", "Multi_Hispanic", "Other_Hispanic",
          "White_Non_Hisp", "Black_Non_Hisp", "Asian_Non_Hisp", "Multi_Non_Hisp", "Other_Non_Hisp")
COMMUTE_MODES = ("Drove", "Carpool", "Transit", "NonMotor", "Work_From_Home", "AllOther")
SHARE_GROUPS: dict[str, tuple[str, ...]] = {"Emp": SECTORS, "Pop_Tot": HISPANIC, "Pop_Sub": GROUPS, "Comm": COMMUTE_MODES}
TOTAL_OF_GROUP = {"Emp": "Total_Employment", "Pop_Tot": "Total_Population", "Pop_Sub": "Total_Population",
                  "Comm": "Total_Commutes"}
INTERCEPT = "(Intercept)"


def add_model_inputs(df: DataFrame, year: Column | int, sectors: Sequence[str] = SECTOR_AREAS) -> DataFrame:
    """Years since 2013 and the total building area of the job sectors."""
    year = year if isinstance(year, Column) else F.lit(int(year))
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in sectors])
    return df.withColumns({"Since_2013": (year - BASE_YEAR).cast("double"), "Total_Emp_Area": total})


# --- fitting --------------------------------------------------------------

def t_tail(t: float, df: float) -> float:
    """Upper tail of Student's t, by the continued fraction of the incomplete beta function."""
    if math.isinf(t):
        return 0.0 if t > 0 else 1.0
    x = df / (df + t * t)
    a, b = df / 2, 0.5
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if 0 < x < 1 else 0.0

    def fraction(p: float, q: float, z: float) -> float:
        tiny = 1e-300
        c, d = 1.0, 1.0 / max(abs(1 - (p + q) * z / (p + 1)), tiny) * (1 if 1 - (p + q) * z / (p + 1) > 0 else -1)
        h = d
        for m in range(1, 500):
            for term in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)),
                         -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
                d = 1 / ((1 + term * d) or tiny)
                c = (1 + term / c) or tiny
                h *= c * d
            if abs(c * d - 1) < 1e-14:
                break
        return h

    if x >= 1:
        both = 1.0
    elif x < (a + 1) / (a + b + 2):
        both = front * fraction(a, b, x) / a
    else:
        both = 1 - front * fraction(b, a, 1 - x) / b
    return both / 2 if t > 0 else 1 - both / 2


def correlation_p_values(df: DataFrame, response: str, predictors: Sequence[str], two_sided: bool = False) -> dict[str, tuple[float, float]]:
    """Correlation and p-value per predictor; predictors without variation are left out.

    The default takes twice the upper tail, so that a negative correlation is never
    significant. One row of correlations reaches the driver.
    """
    return _screen(df, {response: F.lit(True)}, predictors, two_sided)[response]


def _screen(df: DataFrame, responses: Mapping[str, Column], predictors: Sequence[str],
            two_sided: bool) -> dict[str, dict[str, tuple[float, float]]]:
    """`correlation_p_values` of many responses, each on the rows its condition takes, in one aggregate."""
    sums = []
    for i, (response, taken) in enumerate(responses.items()):
        sums.append(F.count(F.when(taken, 1)).alias(f"n{i}"))
        sums += [pearson(F.when(taken, F.col(p)), F.when(taken, F.col(response))).alias(f"r{i}_{j}") for j, p in enumerate(predictors)]
    row = df.agg(*sums).first()
    found: dict[str, dict[str, tuple[float, float]]] = {}
    for i, response in enumerate(responses):
        free, out = row[f"n{i}"] - 2, {}
        for j, p in enumerate(predictors):
            r = row[f"r{i}_{j}"]
            if r is None or r != r or free <= 0:
                continue
            t = r * math.sqrt(free / (1 - r * r)) if abs(r) < 1 else math.copysign(math.inf, r)
            out[p] = (r, 2 * t_tail(abs(t) if two_sided else t, free))
        found[response] = out
    return found


def _least_squares(df: DataFrame, responses: Mapping[str, Column], chosen: Mapping[str, Sequence[str]]) -> dict[str, dict[str, float]]:
    """Coefficients and constant per response from means and covariances, which one aggregate gives for all.

    What reaches the driver is a square of numbers per response, as wide as its chosen
    predictors. Where predictors depend on each other, the shortest solution is taken.
    """
    fitted = {r: list(chosen[r]) for r in responses if chosen[r]}
    sums = []
    for i, (response, names) in enumerate(fitted.items()):
        values = [F.when(responses[response], F.col(n).cast("double")) for n in [*names, response]]
        sums += [F.avg(v).alias(f"m{i}_{j}") for j, v in enumerate(values)]
        sums += [F.covar_pop(v, w).alias(f"c{i}_{j}_{k}") for j, v in enumerate(values) for k, w in enumerate(values) if j <= k]
    if not sums:
        return {}
    row = df.agg(*sums).first()
    out: dict[str, dict[str, float]] = {}
    for i, (response, names) in enumerate(fitted.items()):
        wide = len(names)
        square = np.array([[row[f"c{i}_{min(j, k)}_{max(j, k)}"] for k in range(wide)] for j in range(wide)])
        with_response = np.array([row[f"c{i}_{j}_{wide}"] for j in range(wide)])
        scale = np.sqrt(np.diag(square))
        unit = square / np.outer(scale, scale)
        if np.linalg.matrix_rank(unit, tol=1e-10) == wide:
            slopes = np.linalg.solve(unit, with_response / scale) / scale
        else:
            slopes = np.linalg.pinv(square, hermitian=True) @ with_response
        out[response] = dict(zip(names, map(float, slopes)))
        out[response][INTERCEPT] = row[f"m{i}_{wide}"] - sum(v * row[f"m{i}_{j}"] for j, v in enumerate(map(float, slopes)))
    return out


def choose_predictors(p_values: Mapping[str, tuple[float, float]], start: float = 0.05, step: float = 0.05) -> list[str]:
    """Predictors up to the p-value cutoff, which rises by `step` until one qualifies."""
    if not p_values:
        return []
    least = min(p for _, p in p_values.values())
    cutoff = start
    while least > cutoff:
        cutoff += step
    return [name for name, (_, p) in p_values.items() if p <= cutoff]


def fit_models(df: DataFrame, responses: Mapping[str, Sequence[int]], predictors: Sequence[str], year: str = "Year",
               two_sided: bool = False, intercept: bool = False) -> DataFrame:
    """One linear model per response on its observed years, as a table of coefficients (0 where not used).

    Two aggregates serve all responses: one screens the predictors, one gives the sums of the fits.

    With `intercept`, the constant is kept as a row of its own; by default it is fitted
    and then left out, so that predictions are inputs times coefficients.
    """
    filled = df.withColumns({p: F.coalesce(F.col(p).cast("double"), F.lit(0.0)) for p in predictors})
    filled = filled.withColumns({r: F.coalesce(F.col(r).cast("double"), F.lit(0.0)) for r in responses})
    taken = {r: F.col(year).isin([int(y) for y in years]) for r, years in responses.items()}
    screened = _screen(filled, taken, predictors, two_sided)
    fits = _least_squares(filled, taken, {r: choose_predictors(p) for r, p in screened.items()})
    found = {r: {n: c for n, c in fits.get(r, {}).items() if intercept or n != INTERCEPT} for r in responses}
    names = [p for p in [*predictors, INTERCEPT] if any(p in f for f in found.values())]
    schema = T.StructType([T.StructField("Variable", T.StringType())] + [T.StructField(r, T.DoubleType()) for r in responses])
    rows = [(n, *[found[r].get(n, 0.0) for r in responses]) for n in names]
    return df.sparkSession.createDataFrame(rows, schema)


def apply_models(df: DataFrame, coefficients: DataFrame, key: Sequence[str]) -> DataFrame:
    """Predictions from a coefficient table, negative ones as 0. The table has one row per model variable."""
    rows = [r.asDict() for r in coefficients.collect()]
    responses = [c for c in coefficients.columns if c != "Variable"]

    def prediction(response: str) -> Column:
        terms = [
            F.lit(float(r[response])) if r["Variable"] == INTERCEPT
            else F.coalesce(F.col(r["Variable"]).cast("double"), F.lit(0.0)) * F.lit(float(r[response]))
            for r in rows
        ]
        return clip_zero(reduce(lambda a, b: a + b, terms, F.lit(0.0)))

    return df.select(*key, *[prediction(r).alias(r) for r in responses])


def residuals(predicted: DataFrame, prediction: str, label: str) -> DataFrame:
    return predicted.withColumn("Error", F.col(prediction) - F.col(label))


# --- shares ---------------------------------------------------------------

def area_shares(df: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Share of each variable in the row's total; null where the total is 0."""
    values = {v: F.coalesce(F.col(v).cast("double"), F.lit(0.0)) for v in variables}
    total = reduce(lambda a, b: a + b, values.values())
    return df.select(*keys, *[F.try_divide(c, total).alias(v) for v, c in values.items()])


def fill_from_neighbours(shares: DataFrame, touch: DataFrame, keys: Sequence[str], variables: Sequence[str],
                         max_rounds: int | None = None) -> DataFrame:
    """Areas without shares take the mean of the touching areas that have them, scaled to add up to 1.

    Repeats until no area gains shares. Areas no filled area can reach keep null. `touch`
    is (src, nbr) on the first key; further keys, as a year, must be equal.
    """
    area, *same = list(keys)
    state = cut(shares)
    missing = reduce(lambda a, b: a | b, [F.col(v).isNull() for v in variables])
    left = state.where(missing).count()
    rounds = 0
    while left and (max_rounds is None or rounds < max_rounds):
        valid = state.where(~missing).withColumnRenamed(area, "nbr")
        around = (
            state.where(missing).select(*keys).join(touch.withColumnRenamed("src", area), area)
            .join(valid, ["nbr", *same])
        )
        means = around.groupBy(*keys).agg(*[F.avg(v).alias(v) for v in variables])
        total = reduce(lambda a, b: a + b, [F.col(v) for v in variables])
        filled = means.select(*keys, *[F.try_divide(F.col(v), total).alias(v) for v in variables])
        state = cut(replace_rows(state, filled, keys))
        now = state.where(missing).count()
        rounds += 1
        if now == left:
            break
        left = now
    return state


def fill_from_nearest(shares: DataFrame, places: DataFrame, keys: Sequence[str], variables: Sequence[str], x: str = "x",
                      y: str = "y") -> DataFrame:
    """Areas still without shares take those of the nearest area that has them in the same year.

    `places` holds x and y per area (first key).
    """
    area, *same = list(keys)
    missing = reduce(lambda a, b: a | b, [F.col(v).isNull() for v in variables])
    placed = shares.join(places.select(area, x, y), area)
    wanted = placed.where(missing).withColumn("__id", F.struct(*keys))
    donors = placed.where(~missing).withColumnsRenamed({x: "__tx", y: "__ty", area: "__donor"})
    found = nearest(wanted, donors, "__id", x, y, "__tx", "__ty", "__donor", list(variables), by=same)
    filled = found.select(*[F.col("__id")[k].alias(k) for k in keys], *variables)
    return replace_rows(shares, filled, keys)


def donor_years(wanted: DataFrame, observed: DataFrame, year: str = "Year", out: str = "DonorYear") -> DataFrame:
    """Observed year closest to each wanted year, the earlier one on ties. Both are short lists of years."""
    seen = observed.select(F.col(year).alias("__y")).distinct().agg(F.array_sort(F.collect_list("__y")).alias("__ys"))
    listed = wanted.select(year).distinct().withColumn("__ys", seen.scalar())
    nearest_year = F.array_min(F.transform("__ys", lambda y: F.struct(F.abs(y - F.col(year)).alias("d"), y.alias("y"))))
    return listed.select(year, nearest_year["y"].alias(out))


def shares_with_donors(shares: DataFrame, wanted: DataFrame, keys: Sequence[str], year: str = "Year") -> DataFrame:
    """Shares for wanted years, taken from the closest observed year."""
    donors = donor_years(wanted, shares, year)
    return spread_join(shares.withColumnRenamed(year, "DonorYear"), donors, "DonorYear").select(
        *keys, year, "DonorYear", *[c for c in shares.columns if c not in (*keys, year)])


def carry_forward(df: DataFrame, area: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Nulls take the area's last known value. One row per area and year, so a window holds an area's years only."""
    past = Window.partitionBy(*area).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(past) for c in columns})


def renormalise(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Columns of a row scaled to add up to 1; null where they add up to 0."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    return df.select(*keys, *[F.try_divide(F.col(c), total).alias(c) for c in columns])


def levels_from_shares(totals: DataFrame, shares: DataFrame, keys: Sequence[str], groups: Mapping[str, Sequence[str]],
                       total_of: Mapping[str, str]) -> DataFrame:
    """Predicted totals split to sub-categories: share times total."""
    joined = totals.join(shares, list(keys))
    parts = {v: F.col(v) * F.col(total_of[g]) for g, vs in groups.items() for v in vs}
    return joined.select(*keys, *[c for c in totals.columns if c not in keys], *[c.alias(v) for v, c in parts.items()])


def model_areas(enriched: DataFrame, touch: DataFrame, coefficients: DataFrame, key: str, year: int,
                shares_from: Mapping[str, DataFrame] | None = None,
                groups: Mapping[str, Sequence[str]] = SHARE_GROUPS, total_of: Mapping[str, str] = TOTAL_OF_GROUP) -> DataFrame:
    """Totals and sub-categories of every area in a year.

    Predictions come from the coefficients; each share group from its observed or donor
    table (`shares_from`, by group name), with neighbours filling areas without counts.
    """
    totals = apply_models(add_model_inputs(enriched, year), coefficients, [key])
    shares = None
    for name, variables in groups.items():
        source = (shares_from or {}).get(name, enriched)
        part = fill_from_neighbours(area_shares(source, [key], variables), touch, [key], variables)
        shares = part if shares is None else shares.join(part, key)
    return levels_from_shares(totals, shares, [key], groups, total_of)


# --- yearly extrapolation -------------------------------------------------

def extrapolate_years(frames: Mapping[int, DataFrame], observed: Mapping[str, Sequence[int]], key: str,
                      predictors: Sequence[str], year: str = "Year") -> DataFrame:
    """Missing years predicted in order: each predicted year joins the training rows of the next.

    `observed` gives the years with data per response. Years and responses are driver
    lists; every fit and prediction is a Spark job over all areas.
    """
    known = {r: sorted(ys) for r, ys in observed.items()}

    def stack(parts: Sequence[DataFrame]) -> DataFrame:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    written = cut(stack([df.withColumn(year, F.lit(int(y))) for y, df in frames.items()]))
    plain: list[int] = []
    predicted: list[DataFrame] = []

    def so_far() -> DataFrame:
        return stack([written.where(F.col(year).isin(plain)), *predicted])

    for y in sorted(frames):
        absent = {r: ys for r, ys in known.items() if y not in ys}
        if not absent or not (plain or predicted):
            plain.append(int(y))
            continue
        fits = fit_models(so_far(), absent, predictors, year, two_sided=True, intercept=True)
        frame = written.where(F.col(year) == int(y))
        predicted.append(cut(frame.drop(*absent).join(apply_models(frame, fits, [key]), key)))
        for r in absent:
            known[r] = sorted([*known[r], y])
    return so_far()


def extrapolate_constant_shares(frames: Mapping[int, DataFrame], observed: Mapping[str, Sequence[int]], touch: DataFrame,
                                places: DataFrame, key: str, predictors: Sequence[str],
                                groups: Mapping[str, Sequence[str]], total_of: Mapping[str, str], year: str = "Year") -> DataFrame:
    """Totals for all years from one model each (with constant), sub-categories by the last known shares.

    Shares without counts come from touching areas of the year, then from the nearest
    one; years without observation carry the area's last shares forward.
    """
    stacked = cut(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                         [df.withColumn(year, F.lit(int(y))) for y, df in frames.items()]))
    keys = [key, year]
    fits = fit_models(stacked, observed, predictors, year, two_sided=True, intercept=True)
    totals = cut(apply_models(stacked, fits, keys))
    out = totals
    for name, variables in groups.items():
        seen = stacked.where(F.col(year).isin([int(y) for y in observed[total_of[name]]]))
        shares = fill_from_neighbours(area_shares(seen, keys, variables), touch, keys, variables, max_rounds=1)
        shares = cut(fill_from_nearest(shares, places, keys, variables))
        every = totals.select(*keys).join(shares, keys, "left")
        out = out.join(carry_forward(every, [key], year, variables), keys)
    parts = {v: F.col(v) * F.col(total_of[g]) for g, vs in groups.items() for v in vs}
    return out.select(*keys, *[c for c in totals.columns if c not in keys], *[c.alias(v) for v, c in parts.items()])
