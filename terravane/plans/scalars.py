"""Scalar functions over the driver's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.functions import scalar
from terravane.plans.catalog import query, t


@query("""SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS key, trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '-', 'g'), '-') AS slug, p_brand FROM part""")
def scalar_keys(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "part").select("p_partkey", scalar.normalize_key(F.col("p_name"), ascii_only=True).alias("key"), scalar.slug(F.col("p_type")).alias("slug"), "p_brand")


@query("SELECT c_custkey, sha1(lower(trim(c_name)) || '|' || c_mktsegment)[1:16] AS stable_id FROM customer")
def scalar_stable_id(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "customer").select("c_custkey", scalar.stable_id(F.col("c_name"), F.lit(""), F.col("c_mktsegment")).alias("stable_id"))


@query("""SELECT o_orderkey, (year(o_orderdate) - 1) || '-' || lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0') AS label, CAST(year(o_orderdate) AS INTEGER) AS end_year,
CAST(2002 - year(o_orderdate) - CASE WHEN strftime(o_orderdate, '%m%d') > '0630' THEN 1 ELSE 0 END AS INTEGER) AS age FROM orders""")
def scalar_seasons_and_ages(spark: SparkSession, d: str) -> DataFrame:
    label = scalar.season_label(F.year("o_orderdate"))
    return t(spark, d, "orders").select(
        "o_orderkey", label.alias("label"), scalar.season_end_year(label).alias("end_year"), scalar.age_on(F.to_date("o_orderdate"), F.lit("2002-06-30").cast("date")).alias("age")
    )


@query("""SELECT event_id, coalesce(CAST(trunc(TRY_CAST(regexp_extract(props, '([0-9.]+)', 1) AS DOUBLE)) AS BIGINT), 0) AS number, CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS day FROM events""")
def scalar_lenient(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").select("event_id", scalar.lenient_int(F.regexp_extract("props", "([0-9.]+)", 1)).alias("number"), scalar.parse_date(F.date_format("ts", "yyyy-MM-dd")).alias("day"))


@query("""SELECT s_suppkey, list_aggregate(list_sort(list_filter(string_split(regexp_replace(lower(s_name), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '')), 'string_agg', ' ') AS key,
'POINT(' || s_nationkey || ' ' || (s_suppkey % 90) || ')' AS wkt, CAST(s_suppkey % 90 AS DOUBLE) AS lat, CAST(s_nationkey AS DOUBLE) AS lon FROM supplier""")
def scalar_names_and_points(spark: SparkSession, d: str) -> DataFrame:
    wkt = F.concat(F.lit("POINT("), F.col("s_nationkey").cast("string"), F.lit(" "), (F.col("s_suppkey") % 90).cast("string"), F.lit(")"))
    point = scalar.wkt_point(wkt)
    return t(spark, d, "supplier").select("s_suppkey", scalar.name_key(F.col("s_name"), ascii_only=True).alias("key"), wkt.alias("wkt"), point["lat"].alias("lat"), point["lon"].alias("lon"))


@query("""WITH p AS (SELECT c_custkey, (c_custkey * 37 % 2000) / 10.0 - 100 AS lat, (c_custkey * 101 % 3600) / 10.0 - 180 AS lon FROM customer)
SELECT CASE WHEN lat BETWEEN -90 AND 90 THEN '2:' || CAST(floor((lat + 90) / 2.5) AS BIGINT) || ':' || CAST(floor((lon + 180) / 2.5) AS BIGINT) END AS cell, count(*) AS people FROM p GROUP BY 1""")
def grid_cell_occupancy(spark: SparkSession, d: str) -> DataFrame:
    lat, lon = (F.col("c_custkey") * 37 % 2000) / 10.0 - 100, (F.col("c_custkey") * 101 % 3600) / 10.0 - 180
    return t(spark, d, "customer").groupBy(scalar.grid_cell(lat, lon, 2).alias("cell")).agg(F.count("*").alias("people"))


@query(r"""WITH p AS (SELECT page_id, url, html, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title FROM pages)
SELECT page_id, lower(strip_accents(title)) AS searched, regexp_replace(lower(strip_accents(translate(title, 'øØłŁđĐðÐ', 'oOlLdDdD'))), '[^a-z0-9]', '', 'g') AS key, substr(sha256(url), 1, 24) AS cached, string_split(url, '/')[-1] AS segment, nullif(title, '') AS page,
replace(replace(replace(replace(replace(substr(html, 1, 200), '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), chr(39), '&#39;') AS escaped FROM p""")
def page_texts(spark: SparkSession, d: str) -> DataFrame:
    """Titles folded for search and as keys, and told back from the address of a page that they name; urls as cache keys and by their last segment; markup escaped."""
    title = F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1))
    address = F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.replace(F.url_encode(title), F.lit("+"), F.lit("_")), F.lit("?x=1#y"))
    return t(spark, d, "pages").select(
        "page_id", scalar.search_text(title).alias("searched"), scalar.normalize_key(title, premapped=True).alias("key"), scalar.cache_key(F.col("url")).alias("cached"), scalar.last_segment(F.col("url")).alias("segment"),
        scalar.page_title(address).alias("page"), scalar.escape_html(F.substring("html", 1, 200)).alias("escaped"),
    )


@query(r"""WITH c AS (SELECT c_custkey AS k, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS seg, c_nationkey AS n, c_name FROM customer)
SELECT k, 'Cust' || k || ' JR ' || seg || CASE WHEN k % 2 = 0 THEN ' van' ELSE '' END AS named, 'Cust' || k || ' ' || seg AS last_first, seg || ' Cust' || k AS eased, CASE k % 3 WHEN 0 THEN 'Ann ' || seg WHEN 1 THEN seg ELSE 'Ann' END AS whole,
'N' || n AS code, CASE n WHEN 3 THEN 'Third' WHEN 4 THEN 'Fourth' ELSE 'N' || n END AS nation, CASE WHEN k % 2 = 0 THEN substr(sha1('x' || k), 1, 16) ELSE 'wiki-' || substr(sha1(regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g')), 1, 16) END AS person_id FROM c""")
def customer_names(spark: SparkSession, d: str) -> DataFrame:
    """Surnames in capitals, with and without particles, joined parts, codes at the end of texts and ids by address or name."""
    k, loud = F.col("c_custkey"), F.upper("c_mktsegment")
    name = F.concat(F.lit("Cust"), k.cast("string"))
    nation = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    url = F.when(k % 2 == 0, F.concat(F.lit("http://x.com/fighter/"), F.substring(F.sha1(F.concat(F.lit("x"), k.cast("string")).cast("binary")), 1, 16), F.lit("/"))).otherwise(F.lit("http://x.com/fighter/none"))
    return t(spark, d, "customer").select(
        k.alias("k"), scalar.given_name_first(F.concat(loud, F.when(k % 2 == 0, " van ").otherwise(" "), name, F.lit(" JR"))).alias("named"), scalar.capitals_last(F.concat_ws(" ", loud, name)).alias("last_first"),
        scalar.ease_capitals(F.concat_ws("  ", loud, name)).alias("eased"),
        scalar.full_name(F.when(k % 3 == 1, "Not applicable").otherwise(" Ann"), F.when(k % 3 < 2, F.initcap(F.lower("c_mktsegment")))).alias("whole"),
        scalar.last_word(F.concat(F.lower(nation), F.lit("  "), nation, F.lit(" "))).alias("code"), scalar.recode(nation, {"N3": "Third", "N4": "Fourth"}).alias("nation"), scalar.url_or_name_id(url, F.col("c_name")).alias("person_id"),
    )


@query("""WITH p AS (SELECT p_partkey AS k, p_brand, p_size, ['Relays', 'Combined events', 'Race walks', 'Road', 'Jumps', 'Throws', 'Track'] AS kinds FROM part)
SELECT k, kinds[k % 7 + 1] AS kind, CASE WHEN k % 4 = 0 THEN 'Numbered PPV' ELSE 'Fight Night' END AS card, CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN p_brand ELSE p_brand || '|' || k END AS parts, (k % 3) || CASE WHEN k % 3 = 1 THEN ' part' ELSE ' parts' END AS counted, 'In ' || p_brand || ': ' || p_size AS told FROM p""")
def part_events(spark: SparkSession, d: str) -> DataFrame:
    """Families of events by their names, lists in texts, nouns after counts and filled templates."""
    k = F.col("p_partkey")
    event = F.element_at(F.array(*[F.lit(x) for x in ("4x100 Relay", "Decathlon", "20km Race Walk", "Half Marathon", "Long Jump", "Shot Put", "800m")]), (k % 7 + 1).cast("int"))
    text = F.when(k % 3 == 0, " ; ;").when(k % 3 == 1, F.concat(F.lit(" "), "p_brand", F.lit(" ;"))).otherwise(F.concat("p_brand", F.lit(";;  "), k.cast("string")))
    return t(spark, d, "part").select(
        k.alias("k"), scalar.discipline(F.concat("p_brand", F.lit(" Women's "), event)).alias("kind"), scalar.event_type(F.concat(F.when(k % 4 == 0, "UFC ").otherwise("UFC Fight Night "), k.cast("string"))).alias("card"),
        F.array_join(scalar.split_list(text), "|").alias("parts"), scalar.count_word(k % 3, "part", "parts").alias("counted"), scalar.fill_template(F.lit("In {where}: {n}"), {"where": F.col("p_brand"), "n": F.col("p_size")}).alias("told"),
    )


@query("""WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, CAST(floor(o_totalprice) AS BIGINT) % 50 AS n FROM orders)
SELECT k, CASE WHEN k % 7 < 6 THEN day END AS day, CAST(CASE WHEN k % 3 > 0 THEN 2005 - year(day) - CASE WHEN strftime(day, '%m%d') > '0228' THEN 1 ELSE 0 END ELSE 2005 - year(day) END AS INTEGER) AS age, k % 3 > 0 AS exact,
CASE WHEN k % 4 > 0 THEN n ELSE 0 END AS landed, CASE WHEN k % 4 > 0 THEN n + 7 ELSE 0 END AS attempted, CASE WHEN k % 4 > 0 THEN 0 ELSE n END AS whole, CASE WHEN k % 4 > 1 THEN -n WHEN k % 4 = 1 THEN n ELSE 0 END AS signed FROM o""")
def order_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates in six forms and a placeholder, ages with and without a birth date, counts as ``x of y`` and whole numbers."""
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    n = F.floor("o_totalprice").cast("long") % 50
    said = F.element_at(F.array(*[F.date_format(day, f) for f in ("yyyy-MM-dd", "d/M/yyyy", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy", "yyyyMMdd")], F.lit("19000000")), (k % 7 + 1).cast("int"))
    age = scalar.age_at(F.when(k % 3 > 0, day), F.year(day), F.lit("2005-02-28").cast("date"))
    of = F.when(k % 4 > 0, F.concat(n.cast("string"), F.lit(" Of "), (n + 7).cast("string"), F.lit(" (x)"))).otherwise(F.lit("--"))
    return t(spark, d, "orders").select(
        k.alias("k"), scalar.parse_date(said).alias("day"), age["age"].alias("age"), age["exact"].alias("exact"), scalar.landed(of).alias("landed"), scalar.attempted(of).alias("attempted"),
        scalar.whole_int(F.when(k % 4 > 0, F.concat(n.cast("string"), F.lit(".0"))).otherwise(F.concat(F.lit(" "), n.cast("string")))).alias("whole"),
        scalar.first_int(F.when(k % 4 > 1, F.concat(F.lit("at -"), n.cast("string"), F.lit("x"))).when(k % 4 == 1, F.concat(n.cast("string"), F.lit(" -1"))).otherwise("none"), signed=True).alias("signed"),
    )


@query("""WITH c AS (SELECT c_custkey AS k, c_nationkey AS n, c_acctbal AS b FROM customer)
SELECT k, CASE k % 4 WHEN 0 THEN 'Q' || n WHEN 1 THEN 'Q' || (n + 1) WHEN 2 THEN NULL END AS entity, CASE WHEN k % 4 < 2 THEN '19' || lpad(CAST(k % 90 + 10 AS VARCHAR), 2, '0') || '-01-02' END AS born, CASE WHEN k % 4 = 0 THEN b END AS lat, CASE k % 3 WHEN 0 THEN 'English ' || k WHEN 1 THEN 'Deutsch ' || k END AS label,
CASE k % 5 WHEN 0 THEN 'Perth' WHEN 1 THEN 'Turin' WHEN 2 THEN 'Rome ' || k WHEN 3 THEN NULL ELSE 'Wa' END AS city, CASE k % 5 WHEN 0 THEN 'AU' WHEN 1 THEN 'Italy, EU' END AS hint, n * 2 - 45.0 >= -44.5 AND n * 2 - 45.0 <= -9 AND 113 + n <= 154.5 AS inside,
CASE WHEN k % 6 = 0 THEN 'unresolved' WHEN k % 2 = 0 AND k % 3 > 0 THEN 'base' ELSE 'venue' END AS precision FROM c""")
def entity_claims(spark: SparkSession, d: str) -> DataFrame:
    """Claims and labels of entities in JSON, names of cities as they are searched, boxes and the first known coordinates."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    snak = lambda value, rank="normal": F.concat(F.lit(f'{{"rank":"{rank}","mainsnak":{{"snaktype":"value","datavalue":{{"value":'), value, F.lit("}}}"))
    item = lambda x: F.concat(F.lit('{"id":"Q'), x.cast("string"), F.lit('"}'))
    claims = F.when(k % 4 == 0, snak(item(n))).when(k % 4 == 1, F.concat(snak(item(n)), F.lit(","), snak(item(n + 1), "preferred"))).when(k % 4 == 2, F.lit('{"rank":"normal","mainsnak":{"snaktype":"novalue"}}')).otherwise("")
    born = F.when(k % 4 < 2, snak(F.concat(F.lit('{"time":"+19'), F.lpad((k % 90 + 10).cast("string"), 2, "0"), F.lit('-01-02T00:00:00Z"}')))).otherwise("")
    at = F.when(k % 4 == 0, snak(F.concat(F.lit('{"latitude":'), F.col("c_acctbal").cast("string"), F.lit(',"longitude":1}')))).otherwise("")
    label = F.when(k % 3 == 0, F.concat(F.lit('"fr":{"value":"F"},"en":{"value":"English '), k.cast("string"), F.lit('"}'))).when(k % 3 == 1, F.concat(F.lit('"fr":{"value":""},"de":{"value":"Deutsch '), k.cast("string"), F.lit('"}'))).otherwise("")
    doc = F.concat(F.lit('{"claims":{"P19":['), claims, F.lit('],"P569":['), born, F.lit('],"P625":['), at, F.lit(']},"labels":{'), label, F.lit("}}"))
    city = scalar.city_search_name(F.element_at(F.array(F.lit("Perth  wa"), F.lit("Turin, Italy, EU"), F.concat(F.lit(" Rome "), k.cast("string")), F.lit("Unknown"), F.lit("Wa")), (k % 5 + 1).cast("int")), F.array(F.lit("unknown")))
    one = F.lit(1.0)
    first = scalar.first_coordinates([("base", F.when(k % 2 == 0, one), F.when(k % 3 > 0, one)), ("venue", F.when(k % 6 > 0, one), one)])
    return t(spark, d, "customer").withColumn("doc", doc).select(
        k.alias("k"), scalar.claim_entity(F.col("doc"), "P19").alias("entity"), scalar.claim_date(F.col("doc")).alias("born"), scalar.claim_coordinates(F.col("doc"))["lat"].alias("lat"), scalar.entity_label(F.col("doc")).alias("label"),
        city["name"].alias("city"), city["country"].alias("hint"), scalar.inside_box(n * 2 - 45.0, F.lit(113.0) + n).alias("inside"), first["precision"].alias("precision"),
    )


@query("""WITH c AS (SELECT DISTINCT c_custkey % 60 AS i, (c_custkey * 37) % 60 AS j FROM customer) SELECT '1:' || i % 36 || ':' || j AS cell, CAST(i % 36 * 5.0 - 90 AS DOUBLE) AS south, CAST(j * 5.0 - 180 AS DOUBLE) AS west,
round(6371.0088 * 6371.0088 * radians(5.0) * (sin(radians(i % 36 * 5.0 - 85)) - sin(radians(i % 36 * 5.0 - 90))), 3) AS area FROM c""")
def grid_cell_shapes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    cells = t(spark, d, "customer").select((k % 60).alias("i"), (k * 37 % 60).alias("j")).distinct().select(F.concat_ws(":", F.lit(1), F.col("i") % 36, "j").alias("cell"))
    corner = F.get(scalar.cell_ring(F.col("cell")), F.lit(0))
    return cells.select("cell", corner["lat"].alias("south"), corner["lon"].alias("west"), F.round(scalar.cell_area(F.col("cell")), 3).alias("area"))
