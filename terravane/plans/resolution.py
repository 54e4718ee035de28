"""Entity resolution queries over the driver's tables: customers are asked for, suppliers and parts are what they may be."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.functions import scalar
from terravane.operators import areas, resolve
from terravane.plans.catalog import query, t


def _day(nation: str):
    return F.date_add(F.lit("2024-01-01").cast("date"), F.col(nation) * 7)


def _bouts(spark: SparkSession, d: str) -> DataFrame:
    """A customer is a bout of its number and a corner, on its nation's day."""
    number = F.regexp_replace("c_name", "^[A-Za-z]+#", "no ")
    return t(spark, d, "customer").select(
        F.col("c_custkey").alias("left_id"), F.col("c_custkey").alias("left_order"), number.alias("a"), F.concat(F.lit("corner "), (F.col("c_custkey") % 97).cast("string")).alias("b"), _day("c_nationkey").alias("day")
    )


def _details(spark: SparkSession, d: str) -> DataFrame:
    number = F.regexp_replace("s_name", "^[A-Za-z]+#", "no ")
    return t(spark, d, "supplier").select(
        F.col("s_suppkey").alias("right_id"), F.col("s_suppkey").alias("right_order"), F.concat(F.lit("corner "), (F.col("s_suppkey") % 97).cast("string")).alias("c"), number.alias("d"), _day("s_nationkey").alias("on")
    )


@query()
def fuzzy_match_cascade(spark: SparkSession, d: str) -> DataFrame:
    """All customers matched one to one with suppliers: the same two names on any day, then a common name within two days, then a similarity of 0.55 within two days.

    Customers choose in the order of their keys. Sequential choice has no SQL; tests hold the query against a plain loop over whole tables.
    """
    return resolve.match_cascade(_bouts(spark, d), _details(spark, d)).select("left_id", "right_id", "tier", F.round("cost", 9).alias("cost"))


BOUTS_SQL = """f AS (SELECT c_custkey AS left_id, 'no ' || regexp_replace(c_name, '^[A-Za-z]+#', '') AS a, 'corner ' || (c_custkey % 97) AS b, DATE '2024-01-01' + c_nationkey * 7 AS day FROM customer),
s AS (SELECT s_suppkey AS right_id, 'corner ' || (s_suppkey % 97) AS c, 'no ' || regexp_replace(s_name, '^[A-Za-z]+#', '') AS d, DATE '2024-01-01' + s_nationkey * 7 AS "on" FROM supplier)"""


@query(f"""WITH {BOUTS_SQL}, p AS (SELECT left_id, right_id, abs(date_diff('day', day, "on")) AS days,
  CASE WHEN least(a, b) = least(c, d) AND greatest(a, b) = greatest(c, d) THEN 1 WHEN (a IN (c, d) OR b IN (c, d)) AND abs(date_diff('day', day, "on")) <= 2 THEN 2 END AS tier FROM f, s WHERE a IN (c, d) OR b IN (c, d)),
r AS (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY tier, days, right_id) AS k FROM p WHERE tier IS NOT NULL)
SELECT left_id, right_id, CAST(tier AS INTEGER) AS tier, CAST(days AS INTEGER) AS days FROM r WHERE k = 1""")
def exact_and_window_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Each customer's first candidate by the exact and the date-window passes."""
    return resolve.first_candidates(_bouts(spark, d), _details(spark, d))


@query("""WITH r AS (SELECT s_suppkey AS roster_id, lower(replace(s_name, '#', '')) || CASE WHEN s_suppkey % 7 = 0 THEN 'jr' ELSE '' END AS full_key, lower(replace(s_name, '#', '')) AS bare FROM supplier),
q AS (SELECT c_custkey AS short_id, CASE c_custkey % 5 WHEN 0 THEN 'Supplier#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') WHEN 1 THEN 'S. ' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') WHEN 2 THEN 'X ' || lpad(CAST(c_custkey AS VARCHAR), 5, '0') WHEN 3 THEN 'S ' || (c_custkey % 10) ELSE 'Two words ' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS name FROM customer),
p AS (SELECT *, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS key, lower(regexp_extract(name, '^([A-Za-z])\\.?\\s+(.+)$', 1)) AS ini, regexp_replace(lower(regexp_extract(name, '^([A-Za-z])\\.?\\s+(.+)$', 2)), '[^a-z0-9]', '', 'g') AS sur,
      CASE WHEN contains(name, ' ') THEN regexp_replace(lower(regexp_extract(name, '(\\S+)$', 1)), '[^a-z0-9]', '', 'g') END AS last FROM q),
c AS (SELECT short_id, roster_id, 2 AS tier FROM p JOIN r ON key = full_key UNION ALL SELECT short_id, roster_id, 3 FROM p JOIN r ON sur <> '' AND starts_with(bare, ini) AND ends_with(bare, sur)
      UNION ALL SELECT short_id, roster_id, 4 FROM p JOIN r ON sur <> '' AND ends_with(bare, sur) UNION ALL SELECT short_id, roster_id, 5 FROM p JOIN r ON last <> '' AND ends_with(bare, last)),
n AS (SELECT short_id, tier, count(DISTINCT roster_id) AS candidates, min(roster_id) AS roster_id FROM c GROUP BY 1, 2), b AS (SELECT *, row_number() OVER (PARTITION BY short_id ORDER BY tier) AS k FROM n)
SELECT p.short_id, CASE WHEN candidates = 1 THEN roster_id END AS roster_id, CAST(tier AS INTEGER) AS tier, coalesce(candidates, 0) AS candidates, CASE WHEN candidates = 1 THEN 'matched' WHEN candidates > 1 THEN 'ambiguous' ELSE 'unmatched' END AS status
FROM p LEFT JOIN (SELECT * FROM b WHERE k = 1) b USING (short_id)""")
def name_variant_match(spark: SparkSession, d: str) -> DataFrame:
    """Short names made of customers' keys looked for in a roster of suppliers, some of them juniors."""
    n = lambda width: F.lpad(F.col("c_custkey").cast("string"), width, "0")
    kind = F.col("c_custkey") % 5
    name = (
        F.when(kind == 0, F.concat(F.lit("Supplier#"), n(9))).when(kind == 1, F.concat(F.lit("S. "), n(7))).when(kind == 2, F.concat(F.lit("X "), n(5)))
        .when(kind == 3, F.concat(F.lit("S "), (F.col("c_custkey") % 10).cast("string"))).otherwise(F.concat(F.lit("Two words "), n(8)))
    )
    short = t(spark, d, "customer").select(F.col("c_custkey").alias("short_id"), name.alias("name")).withColumn("key", scalar.normalize_key(F.col("name"), ascii_only=True))
    junior = F.when(F.col("s_suppkey") % 7 == 0, "jr").otherwise("")
    roster = t(spark, d, "supplier").select(F.col("s_suppkey").alias("roster_id"), F.concat(scalar.normalize_key(F.col("s_name"), ascii_only=True), junior).alias("full_key"))
    return resolve.name_variants(short, roster)


@query("""WITH p AS (SELECT c_custkey AS person, c_nationkey AS k, min(o_orderdate)::DATE AS dob FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2),
e AS (SELECT c_custkey AS entity, c_nationkey AS k, c_mktsegment AS kind, min(o_orderdate)::DATE AS entity_dob FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2, 3)
SELECT person, entity, CAST(dob AS VARCHAR) AS dob FROM p JOIN e USING (k) WHERE kind = 'BUILDING' AND dob = entity_dob""")
def validated_identities(spark: SparkSession, d: str) -> DataFrame:
    """Entities of a person's nation are the person only where they are of the right kind and share the birth date (here the first order's)."""
    first = t(spark, d, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("dob"))
    c = t(spark, d, "customer")
    people = c.join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.col("c_custkey").alias("person"), F.col("c_nationkey").alias("k"), "dob")
    entities = c.join(first, F.col("c_custkey") == F.col("o_custkey")).select(F.col("c_custkey").alias("entity"), F.col("c_nationkey").alias("k"), F.col("c_mktsegment").alias("kind"), F.col("dob").alias("entity_dob"))
    # the date is known to be equal in the end, so it is part of the join's key and no nation's pairs are built
    met = resolve.validated_entities(people.withColumn("_d", F.col("dob")), entities.withColumn("_d", F.col("entity_dob")), ["k", "_d"], "dob", "entity_dob", F.col("kind") == "BUILDING")
    return met.select("person", "entity", F.col("dob").cast("string").alias("dob"))


@query("""WITH RECURSIVE a AS (SELECT c_custkey AS title, CASE WHEN c_custkey % 50 = 0 THEN c_custkey + 7 ELSE c_custkey - c_custkey % 10 - 3 END AS target FROM customer WHERE c_custkey % 3 <> 1),
w AS (SELECT c_custkey AS start, c_custkey AS title, [CAST(c_custkey AS BIGINT)] AS seen, false AS looped FROM customer UNION ALL
  SELECT start, a.target, list_append(seen, a.target), list_contains(seen, a.target) FROM w JOIN a ON w.title = a.title WHERE NOT looped)
SELECT start AS title, max_by(title, len(seen)) AS final, max_by(looped, len(seen)) AS looped FROM w GROUP BY 1""")
def redirect_chains(spark: SparkSession, d: str) -> DataFrame:
    """Redirects between customers' keys, chains and cycles among them."""
    k = F.col("c_custkey")
    step = t(spark, d, "customer").where(k % 3 != 1).select(k.alias("title"), F.when(k % 50 == 0, k + 7).otherwise(k - k % 10 - 3).alias("target"))
    return resolve.resolve_redirects(t(spark, d, "customer").select(k.alias("title")), step)


@query("""WITH d AS (SELECT n_nationkey AS o, 'C' || n_nationkey AS code, r_name AS continent, n_name AS a, 'Republic of ' || n_name AS b, 'Land ' || (n_nationkey // 2) AS c FROM nation JOIN region ON n_regionkey = r_regionkey),
l AS (SELECT o, 0 AS i, code, continent, regexp_replace(lower(a), '[^a-z0-9]', '', 'g') AS key FROM d UNION ALL SELECT o, 1, code, continent, regexp_replace(lower(b), '[^a-z0-9]', '', 'g') FROM d UNION ALL SELECT o, 2, code, continent, regexp_replace(lower(c), '[^a-z0-9]', '', 'g') FROM d),
m AS (SELECT key, max_by(code, o * 10 + i) AS code, max_by(continent, o * 10 + i) AS continent FROM l GROUP BY 1),
q AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'REPUBLIC-OF ' || n_name WHEN 1 THEN n_name WHEN 2 THEN 'Land ' || (c_nationkey // 2) ELSE 'Monaco' END AS country FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, country, coalesce(code, regexp_replace(lower(country), '[^a-z0-9]', '', 'g')) AS country_code, coalesce(continent, CASE WHEN country = 'Monaco' THEN 'Europe' END, 'Unclassified') AS continent FROM q LEFT JOIN m ON m.key = regexp_replace(lower(country), '[^a-z0-9]', '', 'g')""")
def country_alias_join(spark: SparkSession, d: str) -> DataFrame:
    n, r = t(spark, d, "nation"), t(spark, d, "region")
    dim = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("o"), F.concat(F.lit("C"), F.col("n_nationkey").cast("string")).alias("code"), F.col("r_name").alias("continent"),
        F.col("n_name").alias("a"), F.concat(F.lit("Republic of "), "n_name").alias("b"), F.concat(F.lit("Land "), F.floor(F.col("n_nationkey") / 2).cast("string")).alias("c"),
    )
    kind = F.col("c_custkey") % 4
    country = F.when(kind == 0, F.concat(F.lit("REPUBLIC-OF "), "n_name")).when(kind == 1, F.col("n_name")).when(kind == 2, F.concat(F.lit("Land "), F.floor(F.col("c_nationkey") / 2).cast("string"))).otherwise("Monaco")
    rows = t(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", country.alias("country"))
    return resolve.country_codes(rows, "country", dim, ["a", "b", "c"], lambda c: scalar.country_key(c, ascii_only=True), "o", {"monaco": "Europe"})


@query("""WITH l AS (SELECT p_partkey, unnest([p_name, p_brand || ' ' || p_type]) AS label FROM part), k AS (SELECT regexp_replace(lower(label), '[^a-z0-9]', '', 'g') AS key, count(DISTINCT p_partkey) AS n, min(p_partkey) AS p FROM l GROUP BY 1),
q AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'nowhere ' || s_suppkey ELSE 'brand#' || (s_suppkey % 25) || ' ECONOMY' END AS college FROM supplier)
SELECT s_suppkey, college, CASE WHEN n = 1 THEN p END AS p_partkey, CASE WHEN n = 1 THEN 'matched' WHEN n > 1 THEN 'ambiguous college program' ELSE 'college program unavailable' END AS status FROM q LEFT JOIN k ON key = regexp_replace(lower(college), '[^a-z0-9]', '', 'g')""")
def college_program_match(spark: SparkSession, d: str) -> DataFrame:
    parts = t(spark, d, "part").select("p_partkey", "p_name", F.concat("p_brand", F.lit(" "), "p_type").alias("display"))
    college = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("nowhere "), F.col("s_suppkey").cast("string"))).otherwise(F.concat(F.lit("brand#"), (F.col("s_suppkey") % 25).cast("string"), F.lit(" ECONOMY")))
    asked = t(spark, d, "supplier").select("s_suppkey", college.alias("college"))
    return resolve.labelled_match(asked, parts, "college", ["p_name", "display"], "p_partkey", lambda c: scalar.normalize_key(c, ascii_only=True), "college program")


@query("""WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN 'C' || (c_custkey % 5) END AS up, CASE WHEN c_custkey % 3 <> 0 THEN 'C' || (c_custkey % 10 // 2) END AS low, 'area' || (c_custkey % 11) AS adm1_code FROM customer)
SELECT c_custkey, CASE WHEN up <> low THEN NULL ELSE coalesce(up, low) END AS adm0_code, CASE WHEN up <> low THEN NULL ELSE adm1_code END AS adm1_code, coalesce(up <> low, false) AS level_mismatch FROM a""")
def cross_level_consistency(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = t(spark, d, "customer").select(
        "c_custkey", F.when(k % 4 != 0, F.concat(F.lit("C"), (k % 5).cast("string"))).alias("adm0_code"),
        F.when(k % 3 != 0, F.concat(F.lit("C"), F.floor(k % 10 / 2).cast("string"))).alias("adm0_code_adm2"), F.concat(F.lit("area"), (k % 11).cast("string")).alias("adm1_code"),
    )
    return resolve.consistent_levels(rows, "adm0_code", "adm0_code_adm2", ["adm1_code"])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE n_name END AS label FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey < 20""")
def map_lookup_combine_first(spark: SparkSession, d: str) -> DataFrame:
    names = t(spark, d, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = t(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("label"))
    return resolve.map_lookup(rows, "c_nationkey", names, "n_name", "label").select("c_custkey", "label")


@query("""WITH c AS (SELECT n_nationkey AS cell, n_nationkey * 13.0 - 170 AS x, n_nationkey * 5.0 - 60 AS y FROM nation), g AS (SELECT r_regionkey AS land, r_regionkey * 55.0 - 150 AS x0, r_regionkey * 55.0 - 110 AS x1, -50.0 AS y0, 10.0 + r_regionkey * 10 AS y1 FROM region)
SELECT cell, land FROM c JOIN g ON x <= x1 AND x + 9 >= x0 AND y <= y1 AND y + 9 >= y0""")
def polygon_intersections(spark: SparkSession, d: str) -> DataFrame:
    """Cells of nine degrees against lands; all are boxes here, so that SQL can tell the answer."""

    def box(x0, x1, y0, y1):
        corner = lambda x, y: F.struct(x.cast("double").alias("lon"), y.cast("double").alias("lat"))
        return F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1))

    x, y = F.col("n_nationkey") * 13.0 - 170, F.col("n_nationkey") * 5.0 - 60
    cells = t(spark, d, "nation").select(F.col("n_nationkey").alias("cell"), box(x, x + 9, y, y + 9).alias("ring"))
    r = F.col("r_regionkey")
    lands = t(spark, d, "region").select(r.alias("land"), box(r * 55.0 - 150, r * 55.0 - 110, F.lit(-50.0), r * 10 + 10.0).alias("ring"))
    return areas.polygons_intersect(cells, lands, "cell", "land")


@query("""SELECT l_orderkey, l_linenumber, o_custkey, l_quantity FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def participation_with_scores(spark: SparkSession, d: str) -> DataFrame:
    players = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_quantity")
    joined = resolve.participation(players, t(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])
    return joined.select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", "o_custkey", "l_quantity")


@query("""WITH b AS (SELECT l_orderkey * 10 + l_linenumber AS bout_id, l_suppkey AS f, l_partkey + 1000000 AS g, CASE WHEN l_quantity > 45 THEN 'Catchweight' WHEN l_suppkey % 2 = 0 THEN 'Women''s Flyweight' ELSE 'Flyweight' END AS division FROM lineitem),
k AS (SELECT x AS id, bool_or(division LIKE 'Women%') AS w, bool_or(division NOT LIKE 'Women%') AS m FROM (SELECT f AS x, division FROM b UNION ALL SELECT g, division FROM b) WHERE division <> 'Catchweight' GROUP BY 1),
c AS (SELECT bout_id, bool_or(w) AND NOT bool_or(m) AS women FROM (SELECT bout_id, f AS id FROM b WHERE division = 'Catchweight' UNION ALL SELECT bout_id, g FROM b WHERE division = 'Catchweight') JOIN k USING (id) GROUP BY 1)
SELECT gender, division, count(*) AS n FROM (SELECT CASE WHEN b.division <> 'Catchweight' THEN CASE WHEN b.division LIKE 'Women%' THEN 'Women' ELSE 'Men' END WHEN coalesce(women, false) THEN 'Women' ELSE 'Men' END AS gender,
  CASE WHEN b.division = 'Catchweight' AND coalesce(women, false) THEN 'Women''s Catchweight' ELSE b.division END AS division FROM b LEFT JOIN c USING (bout_id)) GROUP BY 1, 2""")
def catchweight_genders(spark: SparkSession, d: str) -> DataFrame:
    division = F.when(F.col("l_quantity") > 45, "Catchweight").when(F.col("l_suppkey") % 2 == 0, "Women's Flyweight").otherwise("Flyweight")
    bouts = t(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("bout_id"), division.alias("division"), F.col("l_suppkey").alias("first_id"), (F.col("l_partkey") + 1_000_000).alias("second_id"))
    return resolve.known_genders(bouts).groupBy("gender", "division").agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT s_nationkey, CAST(floor(s_acctbal / 1000) AS BIGINT) AS venue, count(*) AS n, min(s_suppkey) AS f FROM supplier GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY n DESC, f) AS k FROM c) SELECT s_nationkey, venue, n FROM r WHERE k = 1""")
def most_common_first_seen(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "supplier").select("s_nationkey", F.floor(F.col("s_acctbal") / 1000).cast("long").alias("venue"), "s_suppkey")
    return resolve.most_common(rows, ["s_nationkey"], ["venue"], "s_suppkey")


@query("""WITH r AS (SELECT *, (c_acctbal > 0)::INT * 4 + (c_mktsegment = 'BUILDING')::INT * 2 + (c_custkey % 2 = 0)::INT AS s FROM customer), k AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY s DESC, c_custkey) AS k FROM r) SELECT c_nationkey, c_custkey FROM k WHERE k = 1""")
def scored_identity(spark: SparkSession, d: str) -> DataFrame:
    score = (F.col("c_acctbal") > 0).cast("int") * 4 + (F.col("c_mktsegment") == "BUILDING").cast("int") * 2 + (F.col("c_custkey") % 2 == 0).cast("int")
    return resolve.best_scored(t(spark, d, "customer"), ["c_nationkey"], score, "c_custkey").select("c_nationkey", "c_custkey")


@query("SELECT c_custkey FROM customer WHERE (c_nationkey, c_mktsegment, floor(c_acctbal / 500)) IN (SELECT (c_nationkey, c_mktsegment, floor(c_acctbal / 500)) FROM customer GROUP BY 1 HAVING count(*) = 1)")
def keep_none_of_repeats(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "customer").withColumn("band", F.floor(F.col("c_acctbal") / 500))
    return resolve.keep_singletons(rows, ["c_nationkey", "c_mktsegment", "band"]).select("c_custkey")
