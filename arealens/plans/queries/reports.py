"""Snapshot and trend queries over the whole report plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from arealens.operators.joins import join_specs
from arealens.operators.spatial import point_in_polygon
from arealens.plans import report, report_specs as rs
from arealens.plans.queries import register, rounded
from arealens.plans.queries.places import INSIDE, boxes
from arealens.plans.standins import run_sql, table, view, with_views
from arealens.session import cut, shelved

YEAR = 2019
K = "o_orderkey"
SECTOR_COLS = {f"CNS{i:02d}_PAR": f"CAST({K} % {i + 1} AS DOUBLE)" for i in range(1, 21)}
MODE_COLS = {f"{m}_PAR": f"CAST({K} % {k} AS DOUBLE)" for m, k in
             (("Drove", 9), ("Carpool", 5), ("Transit", 7), ("NonMotor", 6), ("Work_From_Home", 4), ("AllOther", 3))}
# Attributes of parcels as one SQL each, read by Spark as layer and tables and by the check SQL.
PARCEL_COLS = {"FOLIO": K, "cust": "o_custkey", "Yr": "CAST(year(o_orderdate) AS INT)", "LND_SQFOOT": "o_totalprice * 2",
               "TOT_LVG_AREA": f"CASE WHEN {K} % 7 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END", "JV": "o_totalprice * 3", "TV_NSD": "o_totalprice * 2.5",
               "LND_VAL": "o_totalprice * 1.25", "NO_RES_UNTS": "CAST(o_custkey % 4 AS DOUBLE)", "DOR_UC": "CAST(o_custkey % 103 AS INT)"}
ECON_COLS = {"Total_Employment": f"CAST({K} % 11 AS DOUBLE)", "Total_Population": f"CAST({K} % 13 AS DOUBLE)", "Total_Commutes": f"CAST({K} % 17 AS DOUBLE)", **SECTOR_COLS, **MODE_COLS}
CONT_COLS = {"Developable_Area": f"CAST({K} % 29 AS DOUBLE) / 8", "Max_Contiguity": f"CAST({K} % 19 AS DOUBLE) / 16", "Max_Scaled_Area": f"CAST({K} % 31 AS DOUBLE) / 4"}
CENT_COLS = {"CentIdx": f"CAST({K} % 23 AS DOUBLE) / 4"}
_BIN = "CASE WHEN {0} <= 5 THEN '0 to 5 minutes' WHEN {0} <= 10 THEN '5 to 10 minutes' WHEN {0} <= 15 THEN '10 to 15 minutes' WHEN {0} <= 20 THEN '15 to 20 minutes' WHEN {0} <= 25 THEN '20 to 25 minutes' WHEN {0} <= 30 THEN '25 to 30 minutes' ELSE 'over 30 minutes' END"
WALK_COLS = {"min_time_stn_walk": f"CAST({K} % 40 AS DOUBLE)", "min_time_park_walk": f"CAST({K} % 35 AS DOUBLE)",
             "bin_stn_walk": _BIN.format(f"({K} % 40)"), "bin_park_walk": _BIN.format(f"({K} % 35)")}
IDEAL_COLS = {"min_time_stn": f"CAST({K} % 20 AS DOUBLE)", "min_time_park": f"CAST({K} % 18 AS DOUBLE)"}
BLOCK_COLS = {"GEOID10": "c_custkey", "IMP_PCT": "CAST(c_custkey % 101 AS DOUBLE)", "TotalArea": "CAST(100 + c_custkey % 50 AS DOUBLE)", "NonDevArea": "CAST(c_custkey % 10 AS DOUBLE)",
              "DevOSArea": "CAST(c_custkey % 11 AS DOUBLE)", "DevLowArea": "CAST(c_custkey % 12 AS DOUBLE)", "DevMedArea": "CAST(c_custkey % 13 AS DOUBLE)",
              "DevHighArea": "CAST(c_custkey % 14 AS DOUBLE)", "TOT_LVG_AREA": "c_acctbal + 1000"}
PERIODS = list(rs.PERIOD_ORDER.mapping)[:5]
_PERIOD = "CASE p_partkey % 6 " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PERIODS)) + " ELSE 'OTHER' END"
TRANSIT_COLS = {"TRANSIT_ID": "p_partkey", "TIME_PERIOD": _PERIOD, "ON": "CAST(p_size AS DOUBLE)", "OFF": "CAST(p_partkey % 9 AS DOUBLE)", "TOTAL": "CAST(p_size + p_partkey % 9 AS DOUBLE)",
                "px": "CAST((p_partkey * 37) % 1000 AS DOUBLE) + CAST(0.5 AS DOUBLE)", "py": "CAST((p_partkey * 91) % 1000 AS DOUBLE) + CAST(0.5 AS DOUBLE)"}
ACCESS = {f"{a}{b}Min": f"CAST((s_suppkey * {i + 3} + {b}) % 97 AS DOUBLE)" for i, a in enumerate(rs.ACTIVITIES) for b in (15, 30, 45, 60)} | {
    f"AvgMin{a}": f"CAST((s_suppkey * {i + 5}) % 61 AS DOUBLE)" for i, a in enumerate(rs.ACTIVITIES)}
TRIP_COLS = {"VMT_ALL": "CAST(s_suppkey % 71 AS DOUBLE)", **{a.name: f"CAST((s_suppkey * {i + 2}) % 41 AS DOUBLE)" for i, a in enumerate(rs.TRIP_RATES)}}
BIKE_COLS = {b: f"CAST((r_regionkey * {i + 3}) % 7 AS DOUBLE)" for i, b in enumerate(rs.BIKE_TYPES)}


def _select(cols: dict[str, str], source: str, tick: str = '"') -> str:
    return "SELECT " + ", ".join(f"{e} AS {tick}{n}{tick}" for n, e in cols.items()) + f" FROM {source}"


def _read(spark, sf, cols, source):
    return run_sql(spark, sf, _select(cols, source, "`"))


def _located(spark, sf, points, key, x, y):
    """(area, key) for points in the overlapping summary areas."""
    areas = boxes(view(spark, sf, "v_areas"), "area").withColumnRenamed("area", "SummID")
    return point_in_polygon(points.select(key, x, y), areas, x, y, "rings").select("SummID", key)


def _located_layers(spark, sf, layers):
    """The same for several layers of points in one join, written once since several summaries read it. `layers` holds (points, key, x, y)."""
    every = None
    for i, (points, key, x, y) in enumerate(layers):
        own = points.select(F.lit(i).alias("layer"), F.col(key).cast("bigint").alias("id"), F.col(x).alias("x"), F.col(y).alias("y"))
        every = own if every is None else every.unionByName(own)
    areas = boxes(view(spark, sf, "v_areas"), "area").withColumnRenamed("area", "SummID")
    found = cut(point_in_polygon(every, areas, "x", "y", "rings").select("layer", "SummID", "id"))
    return [found.where(F.col("layer") == i).select("SummID", F.col("id").alias(key)) for i, (_, key, _, _) in enumerate(layers)]


def _in_summary_areas(spark, sf):
    """Census blocks, zones and stops in the summary areas."""
    return _located_layers(spark, sf, [
        (view(spark, sf, "v_points"), "id", "x", "y"), (view(spark, sf, "v_targets"), "target", "tx", "ty"),
        (_read(spark, sf, TRANSIT_COLS, "part"), "TRANSIT_ID", "px", "py")])


def _parcel_tables(spark, sf):
    """Tables of parcels that are the same in every year."""
    return {
        "EconDemog_parcels": _read(spark, sf, {"FOLIO": K, **ECON_COLS}, "orders"),
        "Contiguity_parcels": _read(spark, sf, {"FOLIO": K, **CONT_COLS}, "orders"), "Centrality_parcels": _read(spark, sf, {"FOLIO": K, **CENT_COLS}, "orders"),
        "WalkTime_parcels": _read(spark, sf, {"FOLIO": K, **WALK_COLS}, "orders WHERE o_orderstatus <> 'P'"),
        "WalkTimeIdeal_parcels": _read(spark, sf, {"FOLIO": K, **IDEAL_COLS}, "orders"),
    }


def build_years(spark, sf, outputs, years):
    """Snapshots of the parcels of several order years. Members of areas are found once, and parcels joined to their tables once, for all of them."""
    years = list(years)
    chosen = _read(spark, sf, PARCEL_COLS, "orders").where(F.col("Yr").isin(years))
    parcels = shelved(join_specs({rs.PARCELS.name: chosen}, _parcel_tables(spark, sf), [rs.PARCELS], rs.TABLES)[rs.PARCELS.name])
    located = _in_summary_areas(spark, sf)
    return {y: build(spark, sf, outputs, y, y, located, parcels) for y in years}


def build(spark, sf, outputs=None, year: int | str = YEAR, only_year: int | None = None, located=None, joined=None):
    """The snapshot of the stand-in layers and tables; `only_year` takes the parcels of one order year.

    `located` are the members of `_in_summary_areas`, `joined` the parcels with the columns of `_parcel_tables`, where several snapshots share them.
    """
    parcels = _read(spark, sf, PARCEL_COLS, "orders")
    # Land uses and members come from the parcels as read: joins repeat those that a table holds several times.
    layer = parcels if joined is None else joined
    if only_year is not None:
        parcels, layer = (df.where(F.col("Yr") == only_year) for df in (parcels, layer))
    from arealens.sources.lookups import land_uses

    uses = parcels.select("FOLIO", "DOR_UC").join(F.broadcast(land_uses(spark)), "DOR_UC").select("FOLIO", "GN_VA_LU")
    blocks = table(spark, sf, "customer").select(F.col("c_custkey").alias("GEOID10"))
    areas = table(spark, sf, "region").select(
        F.col("r_regionkey").alias("SummID"), F.col("r_name").alias("Name"), F.when(F.col("r_regionkey") < 2, "Green").otherwise("North").alias("Corridor"))
    suppliers = {"MAZ": "s_suppkey"}
    stops = _read(spark, sf, TRANSIT_COLS, "part")
    layers = {
        "Parcels": layer, "Census_Blocks": blocks, "SummaryAreas": areas,
        "MAZ": _read(spark, sf, suppliers, "supplier"), "TAZ": _read(spark, sf, {"TAZ": "s_suppkey"}, "supplier"),
        "nodes_bike": _read(spark, sf, {"NODE_ID": "c_custkey", "CentIdx": "CAST(c_custkey % 43 AS DOUBLE)"}, "customer"),
        "TransitRidership": stops.drop("px", "py"), "Park_points": _read(spark, sf, {"PARK_PT_ID": "s_suppkey", "TOTACRE": "s_acctbal"}, "supplier"),
    }
    tables = {
        **({} if joined is not None else _parcel_tables(spark, sf)), "LandUseCodes_parcels": uses,
        "Imperviousness_census_blocks": _read(spark, sf, BLOCK_COLS, "customer"), "TripStats_TAZ": _read(spark, sf, {"TAZ": "s_suppkey", **TRIP_COLS}, "supplier"),
        "BikeFac_summaryareas": _read(spark, sf, {"SummID": "r_regionkey", **BIKE_COLS}, "region"),
        **{f"Access_{s}_{m}": _read(spark, sf, {s.upper(): "s_suppkey", **ACCESS}, "supplier") for s, m in (("maz", "Walk"), ("maz", "Bike"), ("taz", "Auto"), ("taz", "Transit"))},
    }
    in_areas, near, stops_in = _in_summary_areas(spark, sf) if located is None else located
    by_block = parcels.select("FOLIO", F.col("cust").alias("id"))
    members = {
        ("Census_Blocks", "Parcels"): parcels.select(F.col("cust").alias("GEOID10"), "FOLIO"),
        ("SummaryAreas", "Parcels"): in_areas.join(by_block, "id").select("SummID", "FOLIO"),
        ("SummaryAreas", "Census_Blocks"): in_areas.withColumnRenamed("id", "GEOID10"),
        ("SummaryAreas", "nodes_bike"): in_areas.withColumnRenamed("id", "NODE_ID"),
        ("SummaryAreas", "MAZ"): near.withColumnRenamed("target", "MAZ"), ("SummaryAreas", "TAZ"): near.withColumnRenamed("target", "TAZ"),
        ("SummaryAreas", "Park_points"): near.withColumnRenamed("target", "PARK_PT_ID"),
        ("SummaryAreas", "TransitRidership"): stops_in,
        ("Census_Blocks", "TransitRidership"): stops.select((F.col("TRANSIT_ID") % 100).alias("GEOID10"), "TRANSIT_ID"),
    }
    return report.snapshot(layers, tables, members, year, outputs)


# --- check SQL ------------------------------------------------------------

_LU = """CASE WHEN "DOR_UC" IN (0, 10, 40, 70, 80) THEN 'Vacant/Undeveloped' WHEN "DOR_UC" IN (1, 2, 4) THEN 'Single-family'
 WHEN "DOR_UC" = 3 OR "DOR_UC" BETWEEN 5 AND 8 THEN 'Multifamily' WHEN "DOR_UC" BETWEEN 11 AND 16 OR "DOR_UC" IN (21, 22) OR "DOR_UC" BETWEEN 25 AND 34 OR "DOR_UC" = 39 THEN 'Commercial/Retail'
 WHEN "DOR_UC" BETWEEN 17 AND 19 OR "DOR_UC" IN (23, 24) THEN 'Office' WHEN "DOR_UC" BETWEEN 41 AND 49 THEN 'Industrial/Manufacturing' ELSE 'Other' END"""


def _walked(t: str) -> str:
    return (f"CASE WHEN min_time_{t} IS NULL THEN -1.0 WHEN min_time_{t} = 0 THEN 1.0 WHEN min_time_{t}_walk IS NULL THEN -2.0 WHEN min_time_{t}_walk = 0 THEN 1.0 "
            f"WHEN min_time_{t}_walk < min_time_{t} THEN 1.0 ELSE min_time_{t}_walk / min_time_{t} END AS DirIdx_{t}, CASE WHEN min_time_{t}_walk <= 15 THEN 1.0 ELSE 0.0 END AS {t}_in_15")


_WALK_NULL = {n: f"CASE WHEN o_orderstatus <> 'P' THEN {e} END" for n, e in WALK_COLS.items()}
PAR_SQL = f"""p0 AS ({_select({**PARCEL_COLS, **ECON_COLS, **CONT_COLS, "CentIdx_PAR": CENT_COLS["CentIdx"], **_WALK_NULL, **IDEAL_COLS}, "orders")}),
 par AS (SELECT *, {_LU} AS "GN_VA_LU", CASE WHEN "DOR_UC" IN (0, 10, 40, 70, 80) THEN "LND_SQFOOT" ELSE 0.0 END AS "VAC_AREA", CASE WHEN "NO_RES_UNTS" > 0 THEN "LND_SQFOOT" ELSE 0.0 END AS "RES_AREA",
  CASE WHEN "Total_Employment" > 0 THEN "LND_SQFOOT" ELSE 0.0 END AS "NRES_AREA", {_walked("stn")}, {_walked("park")}, "TV_NSD" / nullif("LND_SQFOOT", 0) AS "TV_SF", "JV" / nullif("LND_SQFOOT", 0) AS "JV_SF",
  "LND_VAL" / nullif("LND_SQFOOT", 0) AS "LV_SF" FROM p0),
 ar AS (SELECT r_regionkey AS "SummID", r_name AS "Name", CASE WHEN r_regionkey < 2 THEN 'Green' ELSE 'North' END AS "Corridor", r_regionkey FROM region),
 pin AS (SELECT area AS "SummID", id FROM v_points JOIN v_areas ON {INSIDE}), ap AS (SELECT pin."SummID", par.* FROM pin JOIN par ON id = cust)"""


def _sums(*names: str, places: int = 4) -> str:
    return ", ".join(f'round(sum("{n}"), {places}) AS "{n}"' for n in names)


_GROUPS = {"RsrcJobs": (1, 2), "IndJobs": (5, 6, 8), "ConsJobs": (7, 17, 18), "OffJobs": (9, 10, 11, 12, 13, 20), "OthJobs": (3, 4, 14, 19)}
_GROUP_SUMS = {g: "sum(" + " + ".join(f"CNS{i:02d}_PAR" for i in ns) + ")" for g, ns in _GROUPS.items()}
_AREA_SUMS = ("Total_Population", "NO_RES_UNTS", "JV", "TV_NSD", "LND_VAL", "LND_SQFOOT", "Total_Commutes", "Developable_Area", "VAC_AREA", "RES_AREA", "NRES_AREA", "Total_Employment")
_WIDE = f"""{", ".join(f'sum("{n}") AS "{n}"' for n in _AREA_SUMS)}, sum("Transit_PAR") AS "Transit", sum("NonMotor_PAR") AS "NonMotor", sum("AllOther_PAR") AS "AllOther",
 sum("Drove_PAR") AS "Drove", median("Max_Contiguity") AS "Median_Contiguity", sum("Max_Scaled_Area") AS "Scaled_Area", sum("CNS16_PAR") AS "HCJobs", sum("CNS15_PAR") AS "EdJobs", {", ".join(f'{e} AS "{g}"' for g, e in _GROUP_SUMS.items())}"""
_RATIOS = """"NO_RES_UNTS" / nullif("RES_AREA" / 43560.0, 0) AS "RES_DENS", "Total_Employment" / nullif("RES_AREA" / 43560.0, 0) AS "NRES_DENS", "Total_Employment" / nullif("NO_RES_UNTS", 0) AS "JHRatio",
 coalesce(100.0 * ("Transit" + "NonMotor" + "AllOther") / nullif("Total_Commutes", 0), 0.0) AS "SHR_NONAUTO", "TV_NSD" / nullif("LND_SQFOOT", 0) AS "TV_SF", "JV" / nullif("LND_SQFOOT", 0) AS "JV_SF", "LND_VAL" / nullif("LND_SQFOOT", 0) AS "LV_SF" """
_CHECK = [*_AREA_SUMS, "Transit", "NonMotor", "AllOther", "Drove", "Median_Contiguity", "Scaled_Area", "HCJobs", "EdJobs", *_GROUPS,
          "RES_DENS", "NRES_DENS", "JHRatio", "SHR_NONAUTO", "TV_SF", "JV_SF", "LV_SF"]
_AREA_MORE = ["TOT_LVG_AREA", "min_time_stn_walk", "min_time_park_walk", "DirIdx_stn", "DirIdx_park", "CentIdxFA",
              "BlockArea", "DevHighArea", "IMP_PCT", "BlockFlrAr", "DevHiFlrAr", "HH15MinW", "TotalJobs30MinB", "AvgMinHHT", "TotalJobs60MinA", "VMT_ALL", "AVG_TIME_FROM", "VMT_PER_ACT_TO", "CentIdx_raw", "ON", "OFF", "TOTAL",
              "Park_Acres", "FAR", "CentIdx", "GRID_DENS", "TotalJobsin30W", "HHin30A", "W_JHBal", "Prop_stn15", "SHR_RES_UNTS", "SHR_JOBS", "SHR_LVG_AREA", "TV_IDX", "LV_IDX"]


def _mean(column: str) -> str:
    return f'avg({ACCESS[column]})'


AREA_SQL = f"""WITH {PAR_SQL}, w AS (SELECT "SummID", count(*) AS "NParcels", {_WIDE}, sum("TOT_LVG_AREA") AS "TOT_LVG_AREA", avg(coalesce(min_time_stn_walk, 0.0)) AS min_time_stn_walk,
  avg(coalesce(min_time_park_walk, 0.0)) AS min_time_park_walk, median(DirIdx_stn) AS "DirIdx_stn", median(DirIdx_park) AS "DirIdx_park", CAST(sum(stn_in_15) AS BIGINT) AS stn_in_15, CAST(sum(park_in_15) AS BIGINT) AS park_in_15,
  sum("TOT_LVG_AREA" * "CentIdx_PAR") AS "CentIdxFA" FROM ap GROUP BY 1),
 bl AS ({_select(BLOCK_COLS, "customer")}), b AS (SELECT "SummID", count(*) AS "NBlocks", sum("TotalArea") AS "BlockArea", sum("DevHighArea") AS "DevHighArea", avg("IMP_PCT") AS "IMP_PCT", sum("TotalArea" * "TOT_LVG_AREA") AS "BlockFlrAr",
  sum("DevHighArea" * "TOT_LVG_AREA") AS "DevHiFlrAr", avg(CAST(id % 43 AS DOUBLE)) AS "CentIdx_raw" FROM pin JOIN bl ON id = "GEOID10" GROUP BY 1),
 tin AS (SELECT area AS "SummID", target AS s_suppkey FROM v_targets JOIN v_areas ON tx >= xmin AND tx < xmax AND ty >= ymin AND ty < ymax),
 s AS (SELECT "SummID", {_mean("HH15Min")} AS "HH15MinW", {_mean("HH30Min")} AS hh30, {_mean("TotalJobs15Min")} AS tj15, {_mean("TotalJobs30Min")} AS "TotalJobs30MinB", {_mean("AvgMinHH")} AS "AvgMinHHT", {_mean("TotalJobs60Min")} AS "TotalJobs60MinA",
  sum({TRIP_COLS["VMT_ALL"]}) AS "VMT_ALL", avg({TRIP_COLS["AVG_TIME_FROM"]}) AS "AVG_TIME_FROM", avg({TRIP_COLS["VMT_PER_ACT_TO"]}) AS "VMT_PER_ACT_TO", sum(s_acctbal) AS "Park_Acres" FROM tin JOIN supplier USING (s_suppkey) GROUP BY 1),
 st AS ({_select(TRANSIT_COLS, "part")}), t AS (SELECT area AS "SummID", sum("ON") AS "ON", sum("OFF") AS "OFF", sum("TOTAL") AS "TOTAL" FROM st JOIN v_areas ON px >= xmin AND px < xmax AND py >= ymin AND py < ymax GROUP BY 1),
 r AS (SELECT sum("NO_RES_UNTS") AS u, sum("Total_Employment") AS j, sum("TOT_LVG_AREA") AS l, sum("TV_NSD") AS tv, sum("LND_VAL") AS lv, sum("LND_SQFOOT") AS ls FROM par),
 x AS (SELECT ar."SummID", ar."Name", ar."Corridor", w.* EXCLUDE ("SummID"), {_RATIOS}, b.* EXCLUDE ("SummID"), s.* EXCLUDE ("SummID"), t.* EXCLUDE ("SummID"), "TOT_LVG_AREA" / nullif("LND_SQFOOT", 0) AS "FAR",
  "CentIdxFA" / nullif("TOT_LVG_AREA", 0) AS "CentIdx", "NBlocks" / ("LND_SQFOOT" / (43560.0 * 640.0)) AS "GRID_DENS", tj15 + "TotalJobs30MinB" AS "TotalJobsin30W", "HH15MinW" + hh30 AS "HHin30A",
  (tj15 + "TotalJobs30MinB") / nullif("HH15MinW" + hh30, 0) AS "W_JHBal", 100.0 * stn_in_15 / "NParcels" AS "Prop_stn15", "NO_RES_UNTS" / u AS "SHR_RES_UNTS", "Total_Employment" / j AS "SHR_JOBS", "TOT_LVG_AREA" / l AS "SHR_LVG_AREA",
  ("TV_NSD" / "LND_SQFOOT") / (tv / ls) AS "TV_IDX", ("LND_VAL" / "LND_SQFOOT") / (lv / ls) AS "LV_IDX" FROM ar LEFT JOIN w USING ("SummID") LEFT JOIN b USING ("SummID") LEFT JOIN s USING ("SummID") LEFT JOIN t USING ("SummID"), r)
SELECT "SummID", "Name", "Corridor", "NParcels", "NBlocks", stn_in_15, park_in_15, {", ".join(f'round("{c}", 4) AS "{c}"' for c in (*_CHECK, *_AREA_MORE))} FROM x"""


@register("snapshot_areas", with_views("v_points v_areas v_targets", AREA_SQL))
def snapshot_areas(spark, sf):
    out = build(spark, sf, ["SummaryAreas"])["SummaryAreas"]
    return rounded(out.select("SummID", "Name", "Corridor", "NParcels", "NBlocks", "stn_in_15", "park_in_15", *_CHECK, *_AREA_MORE))


@register("snapshot_blocks", with_views("v_points v_areas", f"""
WITH {PAR_SQL}, w AS (SELECT cust AS "GEOID10", {_WIDE} FROM par GROUP BY 1),
 t AS (SELECT p_partkey % 100 AS "GEOID10", sum(p_size) AS "ON" FROM part GROUP BY 1), x AS (SELECT c_custkey AS "GEOID10", w.* EXCLUDE ("GEOID10"), {_RATIOS} FROM customer LEFT JOIN w ON c_custkey = w."GEOID10")
SELECT x."GEOID10", {", ".join(f'round("{c}", 4) AS "{c}"' for c in _CHECK)}, CAST(t."ON" AS DOUBLE) AS "ON" FROM x LEFT JOIN t ON x."GEOID10" = t."GEOID10" """))
def snapshot_blocks(spark, sf):
    out = build(spark, sf, ["Census_Blocks"])["Census_Blocks"]
    return rounded(out.select("GEOID10", *_CHECK, "ON"))


def _long(name: str):
    return lambda spark, sf: rounded(build(spark, sf, [name])[name])


_LU_DOM = "CASE \"GN_VA_LU\" " + " ".join(f"WHEN '{n}' THEN {i}" for n, i in rs.LAND_USE_ORDER.mapping.items()) + " ELSE -1 END"
_WALK_DOM = "CASE {0} " + " ".join(f"WHEN '{n}' THEN {i}" for n, i in rs.WALK_ORDER.mapping.items()) + " ELSE -1 END"
_HEAD = 'a."SummID", a."Name", a."Corridor"'
_VIEWS = "v_points v_areas v_targets"

register("long_attributes_by_land_use", with_views(_VIEWS, f"""
WITH {PAR_SQL}, g AS (SELECT {_HEAD}, "GN_VA_LU", {_LU_DOM} AS "LU_CAT_DOM", CAST({YEAR} AS DOUBLE) AS "Year", {_sums("NO_RES_UNTS", "TOT_LVG_AREA", "JV", "TV_NSD", "LND_SQFOOT")},
 round(median("JV_SF"), 4) AS "JV_SF", round(median("TV_SF"), 4) AS "TV_SF", round(median("LV_SF"), 4) AS "LV_SF", sum("TOT_LVG_AREA" * "CentIdx_PAR") AS f, sum("TOT_LVG_AREA") AS l FROM ap JOIN ar a USING ("SummID") GROUP BY 1, 2, 3, 4, 5)
SELECT * EXCLUDE (f, l), round(f, 4) AS "CentIdxFA", round(f / nullif(l, 0), 4) AS "CentIdx" FROM g"""))(_long("AttrByLU"))


def _melt_sql(label: str, value: str, parts: dict[str, str], extra: str, source: str, views: str) -> str:
    rows = " UNION ALL ".join(f"""SELECT {_HEAD}, '{n}' AS "{label}", CAST({YEAR} AS DOUBLE) AS "Year", {extra}, round({e}, 4) AS "{value}" FROM {source} JOIN ar a USING ("SummID") GROUP BY 1, 2, 3""" for n, e in parts.items())
    return with_views(views, f"WITH {PAR_SQL} {rows}")


register("long_commutes_by_mode", _melt_sql("CommMode", "Commutes", {m[:-4]: f'sum("{m}")' for m in MODE_COLS},
                                            'round(sum("Total_Commutes"), 4) AS "Total_Commutes"', "ap", _VIEWS))(_long("CommutesByMode"))
register("long_jobs_by_sector", _melt_sql("Sector", "Jobs", {**_GROUP_SUMS, "EdJobs": 'sum("CNS15_PAR")', "HCJobs": 'sum("CNS16_PAR")'},
                                          'round(sum("Total_Employment"), 4) AS "Total_Employment"', "ap", _VIEWS))(_long("JobsBySector"))
register("long_walk_to_stations", with_views(_VIEWS, f"""
WITH {PAR_SQL}, q AS (SELECT *, coalesce(bin_stn_walk, '') AS bn FROM ap)
SELECT {_HEAD}, "GN_VA_LU", {_LU_DOM} AS "LU_CAT_DOM", bn AS bin_stn_walk, {_WALK_DOM.format("bn")} AS "WALK_DOM", CAST({YEAR} AS DOUBLE) AS "Year", {_sums("TOT_LVG_AREA", "NO_RES_UNTS")},
 count(*) AS "NParcels", CAST(sum(stn_in_15) AS BIGINT) AS stn_in_15 FROM q JOIN ar a USING ("SummID") GROUP BY 1, 2, 3, 4, 5, 6, 7"""))(_long("WalkTimeToStations"))
register("long_walk_to_parks", with_views(_VIEWS, f"""
WITH {PAR_SQL}, q AS (SELECT *, coalesce(bin_park_walk, '') AS bn FROM ap)
SELECT {_HEAD}, bn AS bin_park_walk, {_WALK_DOM.format("bn")} AS "WALK_DOM", CAST({YEAR} AS DOUBLE) AS "Year", {_sums("TOT_LVG_AREA", "NO_RES_UNTS")},
 count(*) AS "NParcels", CAST(sum(park_in_15) AS BIGINT) AS park_in_15 FROM q JOIN ar a USING ("SummID") GROUP BY 1, 2, 3, 4, 5"""))(_long("WalkTimeToParks"))

_FLOORS = {"BlockFlrAr": "TotalArea", "NonDevFlrAr": "NonDevArea", "DevOSFlrAr": "DevOSArea", "DevLowFlrAr": "DevLowArea", "DevMedFlrAr": "DevMedArea", "DevHiFlrAr": "DevHighArea"}
register("long_area_by_status", with_views(_VIEWS, f"WITH {PAR_SQL}, bl AS ({_select(BLOCK_COLS, 'customer')}), g AS (SELECT {_HEAD}, sum(\"TotalArea\") AS \"TotalArea\", "
         + ", ".join(f'sum("{c}" * "TOT_LVG_AREA") AS "{n}"' for n, c in _FLOORS.items()) + ", " + ", ".join(f'sum("{c}") AS "{c}"' for c in list(_FLOORS.values())[1:])
         + ' FROM pin JOIN bl ON id = "GEOID10" JOIN ar a USING ("SummID") GROUP BY 1, 2, 3) ' + " UNION ALL ".join(
             f'SELECT "SummID", "Name", "Corridor", \'{c}\' AS "DevStatus", {i} AS "DEV_ST_DOM", CAST({YEAR} AS DOUBLE) AS "Year", round("TotalArea", 4) AS "TotalArea", '
             + ", ".join(f'round("{n}", 4) AS "{n}"' for n in _FLOORS) + f', round("{c}", 4) AS "Area", round(CASE WHEN "BlockFlrAr" = 0 THEN 0.0 ELSE "{f}" / "BlockFlrAr" END, 4) AS "FA_SHR" FROM g'
             for i, (f, c) in enumerate(list(_FLOORS.items())[1:], 1))))(_long("AreaByDevStatus"))
_PERIOD_DOM = 'CASE "TIME_PERIOD" ' + " ".join(f"WHEN '{n}' THEN {i}" for n, i in rs.PERIOD_ORDER.mapping.items()) + " ELSE -1 END"
register("long_transit_by_period", with_views(_VIEWS, f"""
WITH {PAR_SQL}, st AS ({_select(TRANSIT_COLS, "part")}), t AS (SELECT area AS "SummID", st.* FROM st JOIN v_areas ON px >= xmin AND px < xmax AND py >= ymin AND py < ymax)
""" + " UNION ALL ".join(f"""SELECT {_HEAD}, "TIME_PERIOD", '{c}' AS "ON_OFF", {_PERIOD_DOM} AS "TRANSIT_DOM", CAST({YEAR} AS DOUBLE) AS "Year", sum("TOTAL") AS "TOTAL", sum("{c}") AS "Value"
 FROM t JOIN ar a USING ("SummID") GROUP BY 1, 2, 3, 4, 5, 6""" for c in ("ON", "OFF"))))(_long("TransitByTimeOfDay"))
register("long_bike_miles", with_views(_VIEWS, f"WITH {PAR_SQL} " + " UNION ALL ".join(
    f"""SELECT {_HEAD}, '{b}' AS "Bike_Fac", {" + ".join(BIKE_COLS.values())} AS "Total_Miles", {e} AS "Bike_Miles" FROM ar a""" for b, e in BIKE_COLS.items())))(_long("BikeFacilityMilesByTier"))
register("long_access_walk", with_views(_VIEWS, f"""
WITH {PAR_SQL}, tin AS (SELECT area AS "SummID", target AS s_suppkey FROM v_targets JOIN v_areas ON tx >= xmin AND tx < xmax AND ty >= ymin AND ty < ymax)
""" + " UNION ALL ".join(f"""SELECT {_HEAD}, '{a}' AS "Activity", {b} AS "TimeBin", {lo} AS from_time, round({_mean(f"{a}{b}Min")}, 4) AS value, {YEAR} AS "Year" FROM tin JOIN ar a USING ("SummID") GROUP BY 1, 2, 3"""
                        for a in rs.ACTIVITIES for b, lo in ((15, 0), (30, 15), (45, 30), (60, 45)))))(_long("ActivityByTime_Walk"))


# --- trends ---------------------------------------------------------------

def _by_use(year: int) -> str:
    return f"""SELECT a."SummID", a."Name", a."Corridor", "GN_VA_LU", {_LU_DOM} AS "LU_CAT_DOM", sum("NO_RES_UNTS") AS u, sum("JV") AS jv, median("JV_SF") AS med FROM ap JOIN ar a USING ("SummID") WHERE "Yr" = {year} GROUP BY 1, 2, 3, 4, 5"""


def _trend(spark, sf, name, years=(1996, 1998)):
    return report.trend(build_years(spark, sf, [name], years))


@register("trend_attributes_diff", with_views(_VIEWS, f"""
WITH {PAR_SQL}, b AS ({_by_use(1996)}), t AS ({_by_use(1998)})
SELECT b."SummID", b."Name", b."Corridor", b."GN_VA_LU", b."LU_CAT_DOM", round(coalesce(t.u, 0) - b.u, 2) AS "NO_RES_UNTS", round(coalesce(t.jv, 0) - b.jv, 2) AS "JV", round(coalesce(t.med, 0) - b.med, 4) AS "JV_SF"
FROM b LEFT JOIN t ON b."SummID" = t."SummID" AND b."GN_VA_LU" = t."GN_VA_LU" """))
def trend_attributes_diff(spark, sf):
    out = _trend(spark, sf, "AttrByLU")["AttrByLU_diff"]
    return out.select("SummID", "Name", "Corridor", "GN_VA_LU", "LU_CAT_DOM", F.round("NO_RES_UNTS", 2).alias("NO_RES_UNTS"), F.round("JV", 2).alias("JV"), F.round("JV_SF", 4).alias("JV_SF"))


@register("trend_attributes_by_year", with_views(_VIEWS, f"""
WITH {PAR_SQL} SELECT "SummID", "GN_VA_LU", CAST("Yr" AS INT) AS "Year", round(sum("NO_RES_UNTS"), 2) AS "NO_RES_UNTS", round(sum("JV"), 2) AS "JV"
FROM ap JOIN ar a USING ("SummID") GROUP BY 1, 2, 3"""))
def trend_attributes_by_year(spark, sf):
    # Every year that the parcels hold.
    first, last = run_sql(spark, sf, "SELECT min(year(o_orderdate)), max(year(o_orderdate)) FROM orders").first()
    return rounded(_trend(spark, sf, "AttrByLU", range(first, last + 1))["AttrByLU_byYear"].select("SummID", "GN_VA_LU", "Year", "NO_RES_UNTS", "JV"), 2)


@register("trend_areas_diff", with_views(_VIEWS, f"""
WITH {PAR_SQL}, s AS (SELECT "SummID", "Yr", sum("NO_RES_UNTS") AS u, sum("TOT_LVG_AREA") AS l, count(*) AS n FROM ap GROUP BY 1, 2)
SELECT b."SummID", round(t.u - b.u, 2) AS "NO_RES_UNTS", round(t.l - b.l, 2) AS "TOT_LVG_AREA", t.n - b.n AS "NParcels" FROM (SELECT * FROM s WHERE "Yr" = 1996) b JOIN (SELECT * FROM s WHERE "Yr" = 1998) t USING ("SummID")"""))
def trend_areas_diff(spark, sf):
    return rounded(_trend(spark, sf, "SummaryAreas")["SummaryAreas_diff"].select("SummID", "NO_RES_UNTS", "TOT_LVG_AREA", "NParcels"), 2)


@register("near_term_trend", with_views(_VIEWS, f"""
WITH {PAR_SQL}, s AS (SELECT "SummID", "Yr", sum("JV") AS jv FROM ap GROUP BY 1, 2)
SELECT b."SummID" AS "RowID", round(t.jv - b.jv, 2) AS "JV" FROM (SELECT * FROM s WHERE "Yr" = 1997) b JOIN (SELECT * FROM s WHERE "Yr" = 1998) t USING ("SummID")"""))
def near_term_trend(spark, sf):
    out = report.near_term_trend(build(spark, sf, ["SummaryAreas"], 1997, 1997), build(spark, sf, ["SummaryAreas"], "NearTerm", 1998), 1997)
    return rounded(report.rename_keys(out)["SummaryAreas_diff"].select("RowID", "JV"), 2)


@register("land_use_diversity", with_views("v_points v_areas", f"""
WITH {PAR_SQL}, cl AS (SELECT "SummID", CASE WHEN "DOR_UC" IN (1, 2, 4) THEN 'sf' WHEN "DOR_UC" = 3 OR "DOR_UC" BETWEEN 5 AND 8 THEN 'mf' WHEN "DOR_UC" IN (11, 12, 13, 15, 16, 29, 30) THEN 'shopping' WHEN "DOR_UC" = 14 THEN 'grocery'
  WHEN "DOR_UC" BETWEEN 17 AND 19 OR "DOR_UC" IN (23, 24) THEN 'office' WHEN "DOR_UC" IN (21, 22) THEN 'restaurant' WHEN "DOR_UC" BETWEEN 25 AND 28 THEN 'auto' WHEN "DOR_UC" BETWEEN 31 AND 35 OR "DOR_UC" IN (37, 38) THEN 'entertainment'
  WHEN "DOR_UC" = 39 THEN 'lodging' WHEN "DOR_UC" BETWEEN 41 AND 49 THEN 'industrial' WHEN "DOR_UC" IN (72, 83, 84) THEN 'education' WHEN "DOR_UC" IN (73, 85) THEN 'healthcare' WHEN "DOR_UC" BETWEEN 86 AND 89 THEN 'civic' END AS lu,
  "TOT_LVG_AREA" / 1000 AS w FROM ap), s AS (SELECT "SummID", lu, sum(w) AS n FROM cl WHERE lu IS NOT NULL AND w > 0 GROUP BY 1, 2), st AS (SELECT *, sum(n) OVER (PARTITION BY "SummID") AS t FROM s),
 rg AS (SELECT lu, sum(n) AS n FROM s GROUP BY 1), rt AS (SELECT *, sum(n) OVER () AS t FROM rg),
 g AS (SELECT "SummID", -sum(n / t * ln(n / t)) / ln(13.0) AS sh, (1 / sum((n / t) * (n / t)) - 1) / 12.0 AS enp FROM st GROUP BY 1), r AS (SELECT -sum(n / t * ln(n / t)) / ln(13.0) AS sh, (1 / sum((n / t) * (n / t)) - 1) / 12.0 AS enp FROM rt)
SELECT "SummID", round(g.sh, 6) AS "Shannon", round(g.enp, 6) AS "ENP", round(g.sh / r.sh, 6) AS "Shannon_Adj", round(g.enp / r.enp, 6) AS "ENP_Adj" FROM g, r"""))
def land_use_diversity(spark, sf):
    from arealens.operators.aggregate import diversity
    from arealens.sources.lookups import RELEVANT_CLASSES, land_uses

    parcels = _read(spark, sf, PARCEL_COLS, "orders")
    classes = land_uses(spark).where(F.col("DIV_CLASS").isin(list(RELEVANT_CLASSES))).select("DOR_UC", "DIV_CLASS")
    located = _located(spark, sf, view(spark, sf, "v_points"), "id", "x", "y").withColumnRenamed("id", "cust").join(parcels, "cust")
    rows = located.join(F.broadcast(classes), "DOR_UC").select("SummID", "DIV_CLASS", (F.col("TOT_LVG_AREA") / 1000).alias("w"))
    return rounded(diversity(rows, "SummID", "DIV_CLASS", "w", len(RELEVANT_CLASSES), regional=True).select("SummID", "Shannon", "ENP", "Shannon_Adj", "ENP_Adj"), 6)
