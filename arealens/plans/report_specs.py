"""The shipped report: layers, joined tables, summaries, calculated fields and trend comparisons."""

from __future__ import annotations

from arealens.functions.indicators import (
    area_if_active, area_if_vacant, class_floor_share, directness, grid_density, non_auto_share, per_acre, share_within,
    within,
)
from arealens.functions.scalar import density, divide, percent, sum_or_zero
from arealens.operators.access import TIME_BREAKS, access_columns
from arealens.specs import MEDIAN, AggCol, CalcSpec, Col, Consolidation, DiffSpec, DomainCol, FeatureSpec, Melt, SummarySpec, TableSpec

# Names of layers, fields, categories and report tables.
MODES = ("Auto", "Transit", "Walk", "Bike")
NON_MOTOR_MODES = ("W", "B")
ACTIVITIES = ("TotalJobs", "ConsJobs", "HCJobs", "EnrollAdlt", "EnrollK12", "HH")
TARGETS = ("stn", "park")
REGION_COLUMNS = ("NO_RES_UNTS", "Total_Employment", "TOT_LVG_AREA", "JV", "TV_NSD", "LND_VAL", "LND_SQFOOT")

BLOCKS = FeatureSpec("Census_Blocks", "GEOID10", "Polygons")
PARCELS = FeatureSpec("Parcels", "FOLIO", "Polygons")
MAZ = FeatureSpec("MAZ", "MAZ", "Polygons")
TAZ = FeatureSpec("TAZ", "TAZ", "Polygons")
AREAS = FeatureSpec("SummaryAreas", "SummID", "Polygons")
NODES = FeatureSpec("nodes_bike", "NODE_ID", "Networks")
TRANSIT = FeatureSpec("TransitRidership", "TRANSIT_ID", "Points")
PARKS = FeatureSpec("Park_points", "PARK_PT_ID", "Points")
BIKE_FACILITIES = FeatureSpec("bike_facilities", "FacID", "Networks")
LAYERS = (BLOCKS, PARCELS, MAZ, TAZ, AREAS, NODES, TRANSIT, PARKS, BIKE_FACILITIES)


def _access_table(scale: FeatureSpec, mode: str) -> TableSpec:
    names = access_columns(ACTIVITIES, TIME_BREAKS, mode)
    return TableSpec(f"Access_{scale.name.lower()}_{mode}", scale.key, tuple(names), names)


TABLES = (
    _access_table(MAZ, "Walk"), _access_table(MAZ, "Bike"), _access_table(TAZ, "Auto"), _access_table(TAZ, "Transit"),
    TableSpec("Centrality_parcels", "FOLIO", None, {"CentIdx": "CentIdx_PAR"}),
    TableSpec("Contiguity_parcels", "FOLIO"),
    TableSpec("Diversity_summaryareas", "SummID"),
    TableSpec("BikeFac_summaryareas", "SummID"),
    TableSpec("EconDemog_parcels", "FOLIO"),
    TableSpec("Imperviousness_census_blocks", "GEOID10"),
    TableSpec("LandUseCodes_parcels", "FOLIO"),
    TableSpec("TripStats_TAZ", "TAZ"),
    TableSpec("WalkTime_parcels", "FOLIO"),
    TableSpec("WalkTimeIdeal_parcels", "FOLIO"),
)


# --- jobs by group --------------------------------------------------------

def _sectors(*numbers: int) -> tuple[str, ...]:
    return tuple(f"CNS{n:02d}_PAR" for n in numbers)


JOB_GROUPS = (
    Consolidation("RsrcJobs", _sectors(1, 2)),
    Consolidation("IndJobs", _sectors(5, 6, 8)),
    Consolidation("ConsJobs", _sectors(7, 17, 18)),
    Consolidation("OffJobs", _sectors(9, 10, 11, 12, 13, 20)),
    Consolidation("OthJobs", _sectors(3, 4, 14, 19)),
)
ZONE_AGGS = (
    AggCol("NO_RES_UNTS", rename="HH"), AggCol("Total_Employment", rename="TotalJobs"),
    AggCol("CNS16_PAR", rename="HCJobs"), AggCol("CNS15_PAR", rename="EdJobs"),
)
# Columns of the regional zone table: renamed ones, and sums of several.
REGIONAL_RENAMES = {"HH": "HH", "emp_total": "TotalJobs", "emp_health": "HCJobs", "emp_ag": "RsrcJobs"}
REGIONAL_SUMS = (
    Consolidation("ConsJobs", ("emp_retail", "emp_amusement", "emp_hotel", "emp_restaurant_bar",
                               "emp_personal_svcs_retail", "emp_state_local_gov_ent")),
    Consolidation("EdJobs", ("emp_pvt_ed_k12", "emp_pvt_ed_post_k12_oth", "emp_public_ed")),
    Consolidation("IndJobs", ("emp_mfg_prod", "emp_mfg_office", "emp_whsle_whs", "emp_trans")),
    Consolidation("OffJobs", ("emp_prof_bus_svcs", "emp_personal_svcs_office", "emp_state_local_gov_white",
                              "emp_own_occ_dwell_mgmt", "emp_fed_gov_accts", "emp_st_lcl_gov_accts", "emp_cap_accts")),
    Consolidation("OthJobs", ("emp_const_non_bldg_prod", "emp_const_non_bldg_office", "emp_utilities_prod",
                              "emp_utilities_office", "emp_const_bldg_prod", "emp_const_bldg_office",
                              "emp_prof_bus_svcs_bldg_maint", "emp_religious", "emp_pvt_hh", "emp_scrap_other",
                              "emp_fed_non_mil", "emp_fed_mil", "emp_state_local_gov_blue")),
    Consolidation("EnrollAdlt", ("collegeEnroll", "otherCollegeEnroll", "AdultSchEnrl")),
    Consolidation("EnrollK12", ("EnrollGradeKto8", "EnrollGrade9to12", "PrivateEnrollGradeKto8")),
)

# --- wide summaries -------------------------------------------------------

COMMUTES = tuple(AggCol(f"{m}_PAR", rename=m) for m in
                 ("Drove", "Carpool", "Transit", "NonMotor", "Work_From_Home", "AllOther"))
VALUES = tuple(AggCol(c) for c in ("JV", "TV_NSD", "LND_VAL", "LND_SQFOOT"))
LAND = (
    AggCol("Developable_Area"), AggCol("VAC_AREA"), AggCol("RES_AREA"), AggCol("NRES_AREA"),
    AggCol("Max_Contiguity", rename="Median_Contiguity", method=MEDIAN), AggCol("Max_Scaled_Area", rename="Scaled_Area"),
)
JOBS = (AggCol("Total_Employment"), AggCol("CNS16_PAR", rename="HCJobs"), AggCol("CNS15_PAR", rename="EdJobs"))


def _product(name: str, *inputs: str) -> Consolidation:
    return Consolidation(name, inputs, fold="product")


FLOOR_BY_CLASS = tuple(_product(n, c, "TOT_LVG_AREA") for n, c in (
    ("BlockFlrAr", "TotalArea"), ("NonDevFlrAr", "NonDevArea"), ("DevOSFlrAr", "DevOSArea"),
    ("DevLowFlrAr", "DevLowArea"), ("DevMedFlrAr", "DevMedArea"), ("DevHiFlrAr", "DevHighArea"),
))
CENTRAL_FLOOR = _product("CentIdxFA", "TOT_LVG_AREA", "CentIdx_PAR")
RIDERS = (AggCol("ON"), AggCol("OFF"), AggCol("TOTAL"))


def _wide(target: FeatureSpec, source: FeatureSpec, aggs, consolidate=()) -> SummarySpec:
    return SummarySpec(target, source, (Col(target.key),), tuple(aggs), tuple(consolidate))


def _access_means(*modes: str) -> tuple[AggCol, ...]:
    return tuple(AggCol(n, method="mean") for m in modes for n in access_columns(ACTIVITIES, TIME_BREAKS, m).values())


TRIP_RATES = tuple(AggCol(f"{c}_{end}", method="mean") for end in ("FROM", "TO")
                   for c in ("AVG_TIME", "AVG_DIST", "TRIPS_PER_ACT", "VMT_PER_ACT"))

ENRICH = (
    _wide(BLOCKS, PARCELS,
          (AggCol("Total_Population"), AggCol("NO_RES_UNTS"), *VALUES, AggCol("Total_Commutes"), *COMMUTES, *LAND, *JOBS),
          JOB_GROUPS),
    _wide(AREAS, PARCELS,
          (AggCol("FOLIO", rename="NParcels", method="size", default="0"), AggCol("Total_Population"), AggCol("NO_RES_UNTS"),
           AggCol("TOT_LVG_AREA"), *VALUES, AggCol("Total_Commutes"), *COMMUTES, *LAND,
           AggCol("min_time_stn_walk", method="mean"), AggCol("min_time_park_walk", method="mean"),
           AggCol("DirIdx_stn", method=MEDIAN), AggCol("DirIdx_park", method=MEDIAN),
           AggCol("stn_in_15"), AggCol("park_in_15"), *JOBS),
          (*JOB_GROUPS, CENTRAL_FLOOR)),
    _wide(AREAS, BLOCKS,
          (AggCol("GEOID10", rename="NBlocks", method="size", default="0"), AggCol("TotalArea", rename="BlockArea"),
           AggCol("NonDevArea"), AggCol("DevOSArea"), AggCol("DevLowArea"), AggCol("DevMedArea"), AggCol("DevHighArea"),
           AggCol("IMP_PCT", method="mean")),
          FLOOR_BY_CLASS),
    _wide(AREAS, MAZ, _access_means("Walk", "Bike")),
    _wide(AREAS, TAZ, (*_access_means("Auto", "Transit"), AggCol("VMT_ALL"), *TRIP_RATES)),
    _wide(AREAS, NODES, (AggCol("CentIdx", rename="CentIdx_raw", method="mean"),)),
    _wide(AREAS, TRANSIT, RIDERS),
    _wide(BLOCKS, TRANSIT, RIDERS),
    _wide(AREAS, PARKS, (AggCol("TOTACRE", rename="Park_Acres"),)),
)

# --- long summaries -------------------------------------------------------

LAND_USE_ORDER = DomainCol("LU_CAT_DOM", {
    "Vacant/Undeveloped": 1, "Single-family": 2, "Multifamily": 3, "Industrial/Manufacturing": 4,
    "Commercial/Retail": 5, "Office": 6, "Other": 7,
})
DEVELOPMENT_ORDER = DomainCol("DEV_ST_DOM", {
    "NonDevArea": 1, "DevOSArea": 2, "DevLowArea": 3, "DevMedArea": 4, "DevHighArea": 5,
})
PERIOD_ORDER = DomainCol("TRANSIT_DOM", {
    "EARLY AM 02:45AM-05:59AM": 1, "AM PEAK 06:00AM-08:30AM": 2, "MIDDAY 08:30AM-02:59PM": 3,
    "PM PEAK 03:00PM-05:59PM": 4, "EVENING 06:00PM-07:59PM": 5, "LATE NIGHT 08:00PM-03:00AM": 6,
})
WALK_ORDER = DomainCol("WALK_DOM", {f"{m} to {m + 5} minutes": i for i, m in enumerate(range(0, 30, 5), 1)})
AREA_GROUP = (Col("SummID"), Col("Name", default=""), Col("Corridor", default=""))
YEAR = AggCol("Year", method="mean", default=-9999)
BIKE_TYPES = ("Bike_Lane", "Paved_Path", "Sidewalk", "Wide_Curb_Lane", "Paved_Shoulder", "Sidepath")
JOB_LABELS = ("RsrcJobs", "IndJobs", "ConsJobs", "OffJobs", "EdJobs", "HCJobs", "OthJobs")
MODE_LABELS = ("Drove", "Carpool", "Transit", "NonMotor", "Work_From_Home", "AllOther")
LAND_USE = Col("GN_VA_LU", default="Unknown", domain=LAND_USE_ORDER)
PARCEL_COUNT = AggCol("FOLIO", rename="NParcels", method="size", default="0")

ELONGATE = (
    SummarySpec(AREAS, PARCELS, (*AREA_GROUP, LAND_USE),
                (YEAR, *(AggCol(c) for c in ("NO_RES_UNTS", "TOT_LVG_AREA", "JV", "TV_NSD", "LND_SQFOOT")),
                 *(AggCol(c, method=MEDIAN) for c in ("JV_SF", "TV_SF", "LV_SF"))),
                (CENTRAL_FLOOR,), None, "AttrByLU"),
    SummarySpec(AREAS, AREAS, AREA_GROUP, (YEAR, AggCol("Total_Commutes")), (),
                Melt("CommMode", "Commutes", MODE_LABELS), "CommutesByMode"),
    SummarySpec(AREAS, AREAS, AREA_GROUP, (YEAR, AggCol("Total_Employment")), (),
                Melt("Sector", "Jobs", JOB_LABELS), "JobsBySector"),
    SummarySpec(AREAS, PARCELS, (*AREA_GROUP, LAND_USE, Col("bin_stn_walk", default="", domain=WALK_ORDER)),
                (YEAR, AggCol("TOT_LVG_AREA"), AggCol("NO_RES_UNTS"), PARCEL_COUNT, AggCol("stn_in_15")),
                (), None, "WalkTimeToStations"),
    SummarySpec(AREAS, PARCELS, (*AREA_GROUP, Col("bin_park_walk", default="", domain=WALK_ORDER)),
                (YEAR, AggCol("TOT_LVG_AREA"), AggCol("NO_RES_UNTS"), PARCEL_COUNT, AggCol("park_in_15")),
                (), None, "WalkTimeToParks"),
    SummarySpec(AREAS, BLOCKS, AREA_GROUP, (YEAR, AggCol("TotalArea")), FLOOR_BY_CLASS,
                Melt("DevStatus", "Area", tuple(DEVELOPMENT_ORDER.mapping), domain=DEVELOPMENT_ORDER), "AreaByDevStatus"),
    SummarySpec(AREAS, TRANSIT, (*AREA_GROUP, Col("TIME_PERIOD", default="", domain=PERIOD_ORDER)),
                (YEAR, AggCol("TOTAL")), (), Melt("ON_OFF", "Value", ("ON", "OFF")), "TransitByTimeOfDay"),
    SummarySpec(AREAS, AREAS, AREA_GROUP, (), (Consolidation("Total_Miles", BIKE_TYPES),),
                Melt("Bike_Fac", "Bike_Miles", BIKE_TYPES), "BikeFacilityMilesByTier"),
)

# --- calculated fields ----------------------------------------------------

PARCEL, BLOCK, AREA = PARCELS.name, BLOCKS.name, AREAS.name

PRECALCS = (
    CalcSpec((PARCEL,), "VAC_AREA", lambda c: area_if_vacant(c("LND_SQFOOT"), c("GN_VA_LU"))),
    CalcSpec((PARCEL,), "RES_AREA", lambda c: area_if_active(c("LND_SQFOOT"), c("NO_RES_UNTS"))),
    CalcSpec((PARCEL,), "NRES_AREA", lambda c: area_if_active(c("LND_SQFOOT"), c("Total_Employment"))),
    CalcSpec((PARCEL,), "DirIdx_{0}", lambda c, t: directness(c(f"min_time_{t}_walk"), c(f"min_time_{t}")), (TARGETS,)),
    CalcSpec((PARCEL,), "TV_SF", lambda c: divide(c("TV_NSD"), c("LND_SQFOOT"))),
    CalcSpec((PARCEL,), "JV_SF", lambda c: divide(c("JV"), c("LND_SQFOOT"))),
    CalcSpec((PARCEL,), "LV_SF", lambda c: divide(c("LND_VAL"), c("LND_SQFOOT"))),
    CalcSpec((PARCEL,), "{0}_in_15", lambda c, t: within(c(f"min_time_{t}_walk")), (TARGETS,)),
)


def _in_30(c, activity: str, mode: str):
    return sum_or_zero(c(f"{activity}15Min{mode}"), c(f"{activity}30Min{mode}"))


FLOOR_PARTS = {"NonDevArea": "NonDevFlrAr", "DevOSArea": "DevOSFlrAr", "DevLowArea": "DevLowFlrAr",
               "DevMedArea": "DevMedFlrAr", "DevHighArea": "DevHiFlrAr"}
CALCS = (
    CalcSpec((PARCEL, BLOCK, AREA), "RES_DENS", lambda c: per_acre(c("NO_RES_UNTS"), c("RES_AREA"))),
    CalcSpec((PARCEL, BLOCK, AREA), "NRES_DENS", lambda c: per_acre(c("Total_Employment"), c("RES_AREA"))),
    CalcSpec((PARCEL, BLOCK, AREA), "FAR", lambda c: divide(c("TOT_LVG_AREA"), c("LND_SQFOOT"))),
    CalcSpec((BLOCK, AREA), "JHRatio", lambda c: divide(c("Total_Employment"), c("NO_RES_UNTS"))),
    CalcSpec((AREA, "AttrByLU"), "CentIdx", lambda c: divide(c("CentIdxFA"), c("TOT_LVG_AREA"))),
    CalcSpec((AREA,), "GRID_DENS", lambda c: grid_density(c("NBlocks"), c("LND_SQFOOT"))),
    CalcSpec((BLOCK, AREA), "SHR_NONAUTO",
             lambda c: non_auto_share(c("Transit"), c("NonMotor"), c("AllOther"), c("Total_Commutes"))),
    CalcSpec((AREA,), "{0}in30{1}", _in_30, (ACTIVITIES, tuple(m[0] for m in MODES))),
    CalcSpec((MAZ.name,), "{0}in30{1}", _in_30, (ACTIVITIES, NON_MOTOR_MODES)),
    CalcSpec((AREA, MAZ.name), "{0}_JHBal", lambda c, m: divide(c(f"TotalJobsin30{m}"), c(f"HHin30{m}")), (NON_MOTOR_MODES,)),
    CalcSpec((AREA,), "Prop_{0}15", lambda c, t: share_within(c(f"{t}_in_15"), c("NParcels")), (TARGETS,)),
    CalcSpec((BLOCK, AREA), "TV_SF", lambda c: divide(c("TV_NSD"), c("LND_SQFOOT"))),
    CalcSpec((BLOCK, AREA), "JV_SF", lambda c: divide(c("JV"), c("LND_SQFOOT"))),
    CalcSpec((BLOCK, AREA), "LV_SF", lambda c: divide(c("LND_VAL"), c("LND_SQFOOT"))),
    CalcSpec(("AreaByDevStatus",), "FA_SHR", lambda c: class_floor_share(
        c("DevStatus"), {k: c(v) for k, v in FLOOR_PARTS.items()}, c("BlockFlrAr"))),
)
# Defined with the report but not part of it.
EXTRA_CALCS = (
    *(CalcSpec((AREA, "AreaByDevStatus"), f"{n}_FA_SHR", lambda c, col=col: percent(c(col), c("BlockFlrAr")))
      for n, col in (("NONDEV", "NonDevFlrAr"), ("DEVOS", "DevOSFlrAr"), ("DEVLOW", "DevLowFlrAr"),
                     ("DEVMED", "DevMedFlrAr"), ("DEVHI", "DevHiFlrAr"))),
    CalcSpec((AREA,), "PARK_AC_PER1000", lambda c: density(c("Park_Acres"), c("Total_Population"), 1000)),
)
# Regional references: share of the region, and value per land over the region's.
REGION_SHARES = {"SHR_RES_UNTS": "NO_RES_UNTS", "SHR_JOBS": "Total_Employment", "SHR_LVG_AREA": "TOT_LVG_AREA"}
REGION_INDICES = {"TV_IDX": "TV_NSD", "JV_IDX": "JV", "LV_IDX": "LND_VAL"}

# --- trends ---------------------------------------------------------------

AREA_INDEX = ("SummID", "Name", "Corridor")
ACCESS_INDEX = ("Activity", "TimeBin", "from_time")
DIFF_TABLES = (
    *(DiffSpec(f"ActivityByTime_{m}", (*AREA_INDEX, *ACCESS_INDEX)) for m in ("Auto", "Transit", "Bike", "Walk")),
    DiffSpec("AreaByDevStatus", (*AREA_INDEX, "DevStatus", "DEV_ST_DOM")),
    DiffSpec("AttrByLU", (*AREA_INDEX, "GN_VA_LU", "LU_CAT_DOM")),
    DiffSpec("BikeFacilityMilesByTier", (*AREA_INDEX, "Bike_Fac")),
    DiffSpec("CommutesByMode", (*AREA_INDEX, "CommMode")),
    DiffSpec("JobsBySector", (*AREA_INDEX, "Sector")),
    DiffSpec("TransitByTimeOfDay", (*AREA_INDEX, "TIME_PERIOD", "TRANSIT_DOM", "ON_OFF")),
    DiffSpec("WalkTimeToParks", (*AREA_INDEX, "bin_park_walk", "WALK_DOM")),
    DiffSpec("WalkTimeToStations", (*AREA_INDEX, "GN_VA_LU", "bin_stn_walk", "LU_CAT_DOM", "WALK_DOM")),
)
DIFF_FEATURES = (
    DiffSpec(AREA, AREA_INDEX, "SummID"), DiffSpec(BLOCK, ("GEOID10",), "GEOID10"),
    DiffSpec(MAZ.name, ("MAZ",), "MAZ"), DiffSpec(TAZ.name, ("TAZ",), "TAZ"),
)
LONG_FEATURES = (AREA,)
# The common area key is renamed in every published table.
FINAL_KEY = ("SummID", "RowID")
