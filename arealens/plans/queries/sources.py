"""Readers on text columns, catalogs, census derivations and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from arealens.functions import scalar as sc
from arealens.plans.queries import register, rounded
from arealens.plans.standins import run_sql, table, view, with_views
from arealens.skew import first_per_key
from arealens.sources import catalog as cat
from arealens.sources import readers as rd


@register("json_properties", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE json_valid(props)""")
def json_properties(spark, sf):
    schema = T.StructType([T.StructField("k", T.LongType())])
    good, _ = rd.screen_json(table(spark, sf, "events").select("event_id", "props"), "props", schema)
    return good.select("event_id", "k")


@register("json_screen", """
SELECT CASE WHEN event_id % 10 = 0 THEN 'bad' ELSE 'good' END AS kind, count(*) AS n FROM events GROUP BY 1""")
def json_screen(spark, sf):
    # every tenth text loses its closing brace
    broken = F.when(F.col("event_id") % 10 == 0, F.regexp_replace("props", r"\}$", "")).otherwise(F.col("props"))
    rows = table(spark, sf, "events").select("event_id", broken.alias("props"))
    good, bad = rd.screen_json(rows, "props", T.StructType([T.StructField("k", T.LongType())]))
    return good.select(F.lit("good").alias("kind")).unionByName(bad.select(F.lit("bad").alias("kind"))).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


FEATURES = T.StructType([T.StructField("name", T.StringType()), T.StructField("bal", T.DoubleType()), T.StructField("skip", T.IntegerType())])


@register("json_features", """
SELECT row_number() OVER (ORDER BY c_custkey, part) - 1 AS "ProcessID", name, bal, 'Point' AS geometry_type,
 concat('[', CAST(c_custkey AS VARCHAR), ',', CAST(c_nationkey AS VARCHAR), ']') AS coordinates FROM
 (SELECT c_custkey, c_nationkey, 0 AS part, c_name AS name, c_acctbal AS bal FROM customer
  UNION ALL SELECT c_custkey, c_nationkey, 1, c_mktsegment, c_acctbal * 2 FROM customer)""")
def json_features(spark, sf):
    # one document of two features per customer
    def feature(name, bal):
        return F.struct(F.struct(name.alias("name"), bal.alias("bal"), F.lit(1).alias("skip")).alias("properties"),
                        F.struct(F.lit("Point").alias("type"), F.array("c_custkey", F.col("c_nationkey").cast("bigint")).alias("coordinates")).alias("geometry"))

    both = F.array(feature(F.col("c_name"), F.col("c_acctbal")), feature(F.col("c_mktsegment"), F.col("c_acctbal") * 2))
    docs = table(spark, sf, "customer").select("c_custkey", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), both.alias("features"))).alias("text"))
    return rd.geojson_features(docs, "text", FEATURES, exclude=["skip"], order=["c_custkey"])


@register("json_lists", "SELECT o_orderkey AS id, o_totalprice AS price FROM orders UNION ALL SELECT o_custkey, o_totalprice * 2 FROM orders")
def json_lists(spark, sf):
    lists = F.struct(F.array("o_orderkey", "o_custkey").alias("id"), F.array(F.col("o_totalprice"), F.col("o_totalprice") * 2).alias("price"))
    docs = table(spark, sf, "orders").select(F.to_json(lists).alias("text"))
    return rd.json_table(docs, "text", T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DoubleType())]))


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@register("flatten_maps", "SELECT c_custkey AS id, " + ", ".join(
    f"""CASE WHEN c_mktsegment = '{s}' THEN c_nationkey END AS "by/{s}/nation", CASE WHEN c_mktsegment = '{s}' THEN c_acctbal END AS "by/{s}/sums/bal" """ for s in _SEGMENTS) + " FROM customer")
def flatten_maps(spark, sf):
    """A map of structs that hold maps, its keys taken from the data."""
    entry = F.struct(F.col("c_nationkey").alias("nation"), F.create_map(F.lit("bal"), F.col("c_acctbal")).alias("sums"))
    nested = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.create_map(F.col("c_mktsegment"), entry).alias("by"))
    return rd.flatten_columns(nested)


@register("flatten_paths", """SELECT c_custkey AS "id", c_nationkey AS "place/nation", c_mktsegment AS "place/market/segment" FROM customer""")
def flatten_paths(spark, sf):
    nested = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.struct(F.col("c_nationkey").alias("nation"), F.struct(F.col("c_mktsegment").alias("segment")).alias("market")).alias("place"))
    return rd.flatten_columns(nested)


@register("null_substitution", """
SELECT o_orderkey, CASE WHEN o_totalprice > 250000 THEN -1.0 ELSE o_totalprice END AS price, CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE o_orderstatus END AS status FROM orders""")
def null_substitution(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_totalprice") <= 250000, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), F.lit(1).alias("unused"))
    return rd.read_table(rows, ["o_orderkey", "price", "status"], {"price": -1.0, "status": "none"})


@register("skip_nulls", "SELECT o_orderkey, o_totalprice AS price FROM orders WHERE o_totalprice <= 250000")
def skip_nulls(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_totalprice") <= 250000, F.col("o_totalprice")).alias("price"))
    return rd.read_table(rows, skip_nulls=True)


MATRIX = """SELECT l_returnflag AS "Category", l_linestatus AS "Level", {0}(l_quantity) AS "Electricity|Total", {0}(l_discount * 100) AS "Electricity|Heating1" FROM lineitem GROUP BY 1, 2"""


@register("matrix_to_long", f"""
WITH e AS ({MATRIX.format("avg")}), r AS ({MATRIX.format("stddev_pop")}),
 el AS (SELECT "Category", "Level", 'Total' AS "End_Use", "Electricity|Total" AS v FROM e UNION ALL SELECT "Category", "Level", 'Heating', "Electricity|Heating1" FROM e),
 rl AS (SELECT "Category", "Level", 'Total' AS "End_Use", "Electricity|Total" AS v FROM r UNION ALL SELECT "Category", "Level", 'Heating', "Electricity|Heating1" FROM r)
SELECT el."Category", el."Level", 'Electricity' AS "Fuel", el."End_Use", round(el.v, 6) AS "Estimate", round(rl.v, 6) AS "RSE", round(rl.v / 100 * el.v, 6) AS "SE"
FROM el JOIN rl ON el."Category" = rl."Category" AND el."Level" = rl."Level" AND el."End_Use" = rl."End_Use" """)
def matrix_to_long(spark, sf):
    def wide(fn):
        g = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("Category"), F.col("l_linestatus").alias("Level"))
        return g.agg(fn("l_quantity").alias("Electricity|Total"), fn(F.col("l_discount") * 100).alias("Electricity|Heating1"))

    return rounded(rd.matrix_to_long(wide(F.avg), wide(F.stddev_pop)), 6)


@register("file_tags", """
SELECT page_id, array_to_string(list_slice(string_split(concat('AVERAGE_RIDERSHIP_PER_STOP_PER_TRIP_WEEKDAY_', CAST(1000 + page_id % 900 AS VARCHAR), '_2015_APR_standard.XLS'), '_'), 8, 10), '_') AS tag FROM pages""")
def file_tags(spark, sf):
    name = F.concat(F.lit("/raw/x/AVERAGE_RIDERSHIP_PER_STOP_PER_TRIP_WEEKDAY_"), (1000 + F.col("page_id") % 900).cast("string"), F.lit("_2015_APR_standard.XLS"))
    return table(spark, sf, "pages").select("page_id", rd.file_tag(name).alias("tag"))


# --- catalog --------------------------------------------------------------

URLS = """SELECT o_orderkey, concat('host/Map Data/', CASE o_custkey % 6 WHEN 0 THEN 'dade' WHEN 1 THEN 'PALM_BEACH' WHEN 2 THEN 'saintlucie' WHEN 3 THEN 'St. Johns'
  WHEN 4 THEN concat('x ', CAST(10 + o_custkey % 80 AS {text}), ' y') ELSE 'none' END, '/', CASE WHEN o_orderkey % 5 = 0 THEN 'final' ELSE CAST(year(o_orderdate) AS {text}) END, '/a.zip') AS url FROM orders"""


@register("url_catalog", f"""
WITH u AS (SELECT *, o_custkey % 6 AS k, 10 + o_custkey % 80 AS num FROM ({URLS.format(text="VARCHAR").replace("SELECT o_orderkey,", "SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INT) AS yr,")})),
 nm AS (SELECT * FROM (VALUES {", ".join(f"({n}, '{c}')" for n, c in cat.county_numbers().items())}) t(num, county))
SELECT 'GIS' AS file, CASE WHEN o_orderkey % 5 = 0 THEN 9999 ELSE yr END AS year,
 CASE k WHEN 0 THEN 'Miami-Dade' WHEN 1 THEN 'Palm Beach' WHEN 2 THEN 'St. Lucie' WHEN 3 THEN 'St. Johns' WHEN 4 THEN coalesce(nm.county, '') ELSE '' END AS county, url
FROM u LEFT JOIN nm ON u.num = nm.num""")
def url_catalog(spark, sf):
    urls = run_sql(spark, sf, URLS.format(text="STRING")).withColumn("file", F.lit("GIS"))
    return cat.file_catalog(urls)


@register("page_years", """
SELECT page_id, CASE WHEN regexp_extract(url, '[0-9]{4}') = '' THEN 9999 ELSE CAST(regexp_extract(url, '[0-9]{4}') AS INT) END AS year FROM pages""")
def page_years(spark, sf):
    return table(spark, sf, "pages").select("page_id", cat.file_year(F.col("url")).alias("year"))


@register("catalog_filter", f"""
SELECT o_orderkey, 'GIS' AS file FROM orders WHERE (o_custkey % 6 IN (0, 1) OR (o_custkey % 6 = 4 AND 10 + o_custkey % 80 IN (23, 60))) AND o_orderkey % 5 <> 0 AND year(o_orderdate) IN (1996, 1997)""")
def catalog_filter(spark, sf):
    urls = run_sql(spark, sf, URLS.format(text="STRING")).withColumn("file", F.lit("GIS"))
    listed = cat.file_catalog(urls.withColumn("file", F.concat("file", F.lit("#"), F.col("o_orderkey").cast("string"))))
    kept, _ = cat.available(listed, [1996, 1997, 1900], ["Miami-Dade", "Palm Beach", "Atlantis"])
    parts = F.split("file", "#")
    return kept.select(parts[1].cast("bigint").alias("o_orderkey"), parts[0].alias("file"))


# --- dates, text ----------------------------------------------------------

@register("date_parts", """
SELECT event_id, CAST(day(ts) AS INT) AS "DAY", CAST(month(ts) AS INT) AS "MONTH", CAST(year(ts) AS INT) AS "YEAR" FROM events""")
def date_parts(spark, sf):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    ts = sc.date_from_unix(millis)
    return table(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in sc.date_parts(ts).items()])


@register("date_parts_text", """
SELECT o_orderkey, CAST(day(o_orderdate) AS INT) AS "DAY", CAST(month(o_orderdate) AS INT) AS "MONTH", CAST(year(o_orderdate) AS INT) AS "YEAR" FROM orders""")
def date_parts_text(spark, sf):
    formats = ("yyyy-MM-dd", "M/d/yyyy", "yyyy/MM/dd", "MMM d, yyyy")
    written = F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", formats[0]))
    for i, f in enumerate(formats[1:], 1):
        written = written.when(F.col("o_orderkey") % 4 == i, F.date_format("o_orderdate", f))
    ts = sc.date_from_text(F.col("written"))
    rows = table(spark, sf, "orders").select("o_orderkey", written.alias("written"))
    return rows.select("o_orderkey", *[c.alias(n) for n, c in sc.date_parts(ts).items()])


@register("text_functions", """
SELECT p_partkey, lpad(CAST(p_partkey AS VARCHAR), 13, '0') AS padded, concat(p_brand, '-long-name') AS kept,
 CASE WHEN contains(p_name, 'ring') THEN 1 ELSE 0 END AS flagged, CASE WHEN contains(p_name, 'ring') THEN substr(p_name, 1, length(p_name) - 2) ELSE p_name END AS trimmed,
 CASE p_type WHEN 'ECONOMY' THEN 'Economy class' WHEN 'PROMO' THEN 'Promotion' END AS label, round(p_retailprice, 2) AS price, split_part(p_name, ' ', 1) AS first_word,
 CASE WHEN contains(p_name, ' ') THEN substr(p_name, strpos(p_name, ' ') + 1) END AS rest, round(p_retailprice / 43560, 8) AS acres FROM part""")
def text_functions(spark, sf):
    c = F.col
    text = F.concat(F.lit("$ "), F.format_number("p_retailprice", 2))
    first, rest = sc.split_once(c("p_name"), " ")
    return table(spark, sf, "part").select(
        "p_partkey", sc.zero_pad(c("p_partkey"), 13).alias("padded"), sc.zero_pad(F.concat("p_brand", F.lit("-long-name")), 5).alias("kept"),
        sc.flag_contains(c("p_name"), "ring").alias("flagged"), sc.drop_suffix_if(c("p_name"), "ring").alias("trimmed"),
        sc.code_text(c("p_type"), {"ECONOMY": "Economy class", "PROMO": "Promotion"}).alias("label"), F.round(sc.money(text), 2).alias("price"),
        first.alias("first_word"), rest.alias("rest"), F.round(sc.field_arithmetic("p_retailprice / 43560"), 8).alias("acres"))


@register("sentinels", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CASE WHEN l_tax = 0 THEN 0.0 ELSE 1 / l_tax END AS back, CASE WHEN l_quantity < 25 THEN 0.0 ELSE l_quantity - 25 END AS clipped,
 CASE WHEN l_linenumber = 3 THEN NULL ELSE l_linenumber END AS line, CASE WHEN l_tax = 0 THEN l_discount ELSE (l_tax + l_discount) / 2 END AS mean FROM lineitem""")
def sentinels(spark, sf):
    c = F.col
    inf = F.when(c("l_tax") == 0, F.lit(float("inf"))).otherwise(F.try_divide(F.lit(1.0), c("l_tax")))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", sc.infinite_to_zero(inf).alias("back"), sc.clip_zero(c("l_quantity") - 25).alias("clipped"),
        sc.recode(c("l_linenumber"), 3, None).alias("line"), sc.row_mean(F.when(c("l_tax") != 0, c("l_tax")), c("l_discount")).alias("mean"))


# --- census ---------------------------------------------------------------

@register("acs_race", """
SELECT c_nationkey, CAST(count(*) - sum(w) - sum(b) - sum(a) - sum(m) AS BIGINT) AS Other_Non_Hisp, CAST(2 * count(*) - sum(w) - sum(b) - sum(a) - sum(m) AS BIGINT) AS Other_Hispanic,
 lpad(CAST(c_nationkey AS VARCHAR), 3, '0') || '12' AS "GEOID10" FROM
 (SELECT c_nationkey, CAST(c_mktsegment = 'BUILDING' AS BIGINT) AS w, CAST(c_mktsegment = 'MACHINERY' AS BIGINT) AS b, CAST(c_mktsegment = 'HOUSEHOLD' AS BIGINT) AS a,
  CAST(c_mktsegment = 'FURNITURE' AS BIGINT) AS m FROM customer) GROUP BY 1""")
def acs_race(spark, sf):
    seg = {"003E": "BUILDING", "004E": "MACHINERY", "006E": "HOUSEHOLD", "009E": "FURNITURE"}
    hisp = {"013E": "BUILDING", "014E": "MACHINERY", "016E": "HOUSEHOLD", "019E": "FURNITURE"}
    count = lambda s: F.sum(F.when(F.col("c_mktsegment") == s, 1).otherwise(0))
    raw = table(spark, sf, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("B03002_002E"), (2 * F.count(F.lit(1))).alias("B03002_012E"),
        *[count(s).alias(f"B03002_{k}") for k, s in {**seg, **hisp}.items()])
    named = cat.derive_race(cat.rename_codes(raw, cat.RACE_TABLE, cat.RACE_CODES))
    return named.select("c_nationkey", "Other_Non_Hisp", "Other_Hispanic",
                        sc.geoid(sc.zero_pad(F.col("c_nationkey"), 3), F.lit("12")).alias("GEOID10"))


@register("acs_commute", """
WITH m AS (SELECT s_nationkey AS bg, CAST(count(*) AS DOUBLE) AS t, sum(CASE l_linenumber WHEN 1 THEN 1 ELSE 0 END) AS a, sum(CASE l_linenumber WHEN 2 THEN 1 ELSE 0 END) AS mc,
  sum(CASE l_linenumber WHEN 3 THEN 1 ELSE 0 END) AS cp, sum(CASE l_linenumber WHEN 4 THEN 1 ELSE 0 END) AS tr, sum(CASE l_linenumber WHEN 5 THEN 1 ELSE 0 END) AS bw,
  sum(CASE l_linenumber WHEN 6 THEN 1 ELSE 0 END) AS tx, sum(CASE l_linenumber WHEN 7 THEN 1 ELSE 0 END) AS wfh FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)
SELECT bg, CAST(a + mc AS BIGINT) AS "Drove", CAST(bw + bw AS BIGINT) AS "NonMotor", CAST(tx + tx AS BIGINT) AS "AllOther", round((a + mc) / t, 6) AS "SOV_Share", round(cp / t, 6) AS "HOV_Share",
 round(tr / t, 6) AS "PT_Share", round(2 * bw / t, 6) AS "NM_Share", round(2 * tx / t, 6) AS "Oth_Share", round(wfh / t, 6) AS "WFH_Share" FROM m""")
def acs_commute(spark, sf):
    line = {"Drove_alone": 1, "Motorcycle": 2, "Carpool": 3, "Transit": 4, "Bicycle": 5, "Walk": 5, "Taxi": 6, "Other": 6, "Work_From_Home": 7}
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    raw = rows.groupBy(F.col("s_nationkey").alias("bg")).agg(
        F.count(F.lit(1)).alias("Total_Commutes"), *[F.sum(F.when(F.col("l_linenumber") == v, 1).otherwise(0)).alias(n) for n, v in line.items()])
    return rounded(cat.derive_commute(raw).drop("Total_Commutes", *line), 6)


@register("state_codes", """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN '12' WHEN 'MACHINERY' THEN '48' WHEN 'HOUSEHOLD' THEN '72' END AS fips FROM customer""")
def state_codes(spark, sf):
    named = F.when(F.col("c_mktsegment") == "BUILDING", "fl").when(F.col("c_mktsegment") == "MACHINERY", "Texas").when(
        F.col("c_mktsegment") == "HOUSEHOLD", "puerto rico").otherwise("nowhere")
    return cat.state_codes(table(spark, sf, "customer").select("c_custkey", named.alias("state")), "state").select("c_custkey", "fips")


@register("request_check", """
SELECT o_orderkey, CASE WHEN yr NOT BETWEEN 2014 AND 2018 OR (st = 'AK' AND yr > 2016) THEN 'year' WHEN st = 'zz' THEN 'state' WHEN ft = 'xyz' THEN 'file_type' END AS refused FROM
 (SELECT o_orderkey, CAST(year(o_orderdate) + 17 AS INT) AS yr, CASE o_custkey % 3 WHEN 0 THEN 'fl' WHEN 1 THEN 'AK' ELSE 'zz' END AS st, CASE WHEN o_orderkey % 4 = 0 THEN 'xyz' ELSE 'WAC' END AS ft FROM orders)""")
def request_check(spark, sf):
    rows = run_sql(spark, sf, """SELECT o_orderkey, CAST(year(o_orderdate) + 17 AS INT) AS year, CASE o_custkey % 3 WHEN 0 THEN 'fl' WHEN 1 THEN 'AK' ELSE 'zz' END AS state,
      CASE WHEN o_orderkey % 4 = 0 THEN 'xyz' ELSE 'WAC' END AS file_type, 'S000' AS segment, '' AS part, 'JT00' AS job_type, 'bgrp' AS agg_geo FROM orders""")
    return cat.check_requests(rows).select("o_orderkey", "refused")


@register("street_classes", """
WITH s AS (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'trunk' WHEN 1 THEN 'primary_link' WHEN 2 THEN 'Secondary' WHEN 3 THEN 'cycleway' WHEN 4 THEN 'living_street' WHEN 5 THEN 'tertiary' WHEN 6 THEN 'path' ELSE 'primary cycleway' END AS highway FROM part)
SELECT p_partkey, CASE WHEN highway LIKE '%ycleway%' OR highway LIKE '%iving%' OR highway LIKE '%esidential%' OR highway LIKE '%ath%' THEN 4
 WHEN highway LIKE '%econdary%' THEN 2 WHEN highway LIKE '%runk%' OR highway LIKE '%rimary%' THEN 1 ELSE 3 END AS bikability, CASE WHEN highway LIKE '%ycleway%' THEN 1 ELSE 0 END AS cycleway FROM s""")
def street_classes(spark, sf):
    kinds = ["trunk", "primary_link", "Secondary", "cycleway", "living_street", "tertiary", "path", "primary cycleway"]
    highway = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("p_partkey") % 8 + 1).cast("int"))
    return table(spark, sf, "part").select("p_partkey", sc.bikeability(highway).alias("bikability"), sc.cycleway(highway).alias("cycleway"))


@register("edge_minutes", with_views("v_edges", """
SELECT src, dst, round(cost * 100 / 80.0, 6) AS "Minutes" FROM v_edges UNION ALL SELECT dst, src, round(cost * 100 / 80.0, 6) FROM v_edges WHERE src % 3 <> 0"""))
def edge_minutes(spark, sf):
    from arealens.operators.network import allowed_edges, two_way

    edges = view(spark, sf, "v_edges").withColumns({"oneway": (F.col("src") % 3 == 0).cast("int"), "lts": (F.col("src") % 4 + 1).cast("int")})
    both = two_way(allowed_edges(edges, "lts", (1, 2, 3, 4)), oneway="oneway")
    return both.select("src", "dst", F.round(sc.edge_minutes(F.col("cost") * 100), 6).alias("Minutes"))


@register("distinct_latest", """
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def distinct_latest(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    return first_per_key(rows, ["user_id"], [F.col("ts"), F.col("event_id")], last=True).drop("ts")
