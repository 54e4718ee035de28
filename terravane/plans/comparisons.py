"""Comparisons of groups, cells, fights and dashboards with their full rules for firsts, ties and absent values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terravane.functions import scalar
from terravane.operators import explorer, metrics
from terravane.plans.catalog import query, t

# an order is a record of its customer in the league of its priority; age and country stand on some records only
RECORD_SQL = """r AS (SELECT o_orderpriority AS league, o_custkey AS id, o_orderkey AS k, CASE WHEN o_orderkey % 3 > 0 THEN 16 + (o_custkey * 7 + o_orderkey) % 20 END AS age, o_orderkey % 5 > 1 AS mapped, (o_custkey + o_orderkey % 2) % 25 AS code FROM orders),
p AS (SELECT league, id, min(CASE WHEN age IS NOT NULL THEN struct_pack(k, age) END).age AS age, min(CASE WHEN mapped THEN struct_pack(k, code) END) AS b FROM r GROUP BY 1, 2)"""


@query(f"""WITH {RECORD_SQL}, w AS (SELECT league, count(*) AS players, count(b) AS mapped, coalesce(100.0 * count(*) FILTER (WHERE b.code = 3) / nullif(count(b), 0), 0) AS domestic_pct, median(age) AS median_age,
  coalesce(100.0 * count(*) FILTER (WHERE age < 21) / nullif(count(age), 0), 0) AS under21_pct, coalesce(100.0 * count(*) FILTER (WHERE age >= 30) / nullif(count(age), 0), 0) AS over30_pct FROM p GROUP BY 1),
c AS (SELECT league, 'N' || b.code AS country, count(*) AS n, min(b.k) AS f FROM p WHERE b IS NOT NULL GROUP BY 1, 2), d AS (SELECT league, 'R' || (b.code % 5) AS continent, count(*) AS n, min(b.k) AS f FROM p WHERE b IS NOT NULL GROUP BY 1, 2),
x AS (SELECT league, count(*) AS countries, CASE WHEN count(*) > 1 THEN 100 * sum(-s * ln(s)) / ln(count(*)) ELSE 0 END AS diversity, string_agg(country || ' ' || n, ',' ORDER BY n DESC, f) FILTER (WHERE k <= 4) AS top
  FROM (SELECT *, n / sum(n) OVER (PARTITION BY league) AS s, row_number() OVER (PARTITION BY league ORDER BY n DESC, f) AS k FROM c) GROUP BY 1), y AS (SELECT league, count(*) AS continents, string_agg(continent || ' ' || n, ',' ORDER BY n DESC, f) AS listed FROM d GROUP BY 1)
SELECT league, players, mapped, round(domestic_pct, 9) AS domestic_pct, coalesce(countries, 0) AS countries, coalesce(continents, 0) AS continents, round(coalesce(diversity, 0), 6) AS diversity, median_age, round(under21_pct, 9) AS under21_pct, round(over30_pct, 9) AS over30_pct, coalesce(top, '') AS top_countries, coalesce(listed, '') AS continent_counts
FROM w LEFT JOIN x USING (league) LEFT JOIN y USING (league)""")
def league_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Leagues by their people: home share, countries, continents, diversity, ages and the leading places, ties by who was seen first."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    code = (c + k % 2) % 25
    rows = t(spark, d, "orders").select(
        F.col("o_orderpriority").alias("league"), c.alias("id"), k.alias("k"), F.when(k % 3 > 0, 16 + (c * 7 + k) % 20).alias("age"), (k % 5 > 1).alias("mapped"),
        code.alias("code"), F.concat(F.lit("N"), code.cast("string")).alias("country"), F.concat(F.lit("R"), (code % 5).cast("string")).alias("continent"),
    )
    told = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["name"], F.lit(" "), x["n"].cast("string"))), ",")
    found = metrics.group_comparison(rows, "league", "id", "k", F.lit(3))
    return found.withColumns({c: F.round(c, 9) for c in ("domestic_pct", "under21_pct", "over30_pct")} | {"diversity": F.round("diversity", 6), "top_countries": told("top_countries"), "continent_counts": told("continent_counts")})


@query("""WITH r AS (SELECT c_mktsegment AS conference, c_custkey AS k, c_acctbal > 0 AS mapped, n_name AS country, CASE WHEN c_custkey % 4 > 0 THEN 18 + c_custkey % 17 END AS age, c_custkey % 90 AS minutes FROM customer JOIN nation ON n_nationkey = c_nationkey),
t AS (SELECT conference, count(DISTINCT team) AS teams FROM (SELECT conference, unnest(['T' || k % 12, 'T' || k % 31]) AS team FROM r) GROUP BY 1), c AS (SELECT conference, country, count(*) AS n, row_number() OVER (PARTITION BY conference ORDER BY count(*) DESC, country) AS place FROM r WHERE mapped GROUP BY 1, 2),
p AS (SELECT conference, count(*) AS countries, string_agg(country || ' ' || n, ',' ORDER BY place) FILTER (WHERE place <= 5) AS top FROM c GROUP BY 1)
SELECT conference, count(*) AS players, any_value(teams) AS teams, count(*) FILTER (WHERE mapped) AS mapped, any_value(countries) AS countries, CAST(sum(minutes) AS BIGINT) AS minutes, median(age) AS median_age, round(100.0 * count(*) FILTER (WHERE mapped AND country <> 'NATION_7') / count(*) FILTER (WHERE mapped), 9) AS outside_home_pct, any_value(top) AS top_countries
FROM r JOIN t USING (conference) JOIN p USING (conference) GROUP BY 1""")
def conference_summary(spark: SparkSession, d: str) -> DataFrame:
    """Conferences by their people: teams, mapped people from elsewhere, median age and the five leading countries."""
    k = F.col("c_custkey")
    named = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    mark = lambda c: F.concat(F.lit("T"), c.cast("string"))
    rows = named.select(F.col("c_mktsegment").alias("conference"), F.array(mark(k % 12), mark(k % 31)).alias("teams"), (F.col("c_acctbal") > 0).alias("mapped"), F.col("n_name").alias("country"), F.when(k % 4 > 0, 18 + k % 17).alias("age"), (k % 90).alias("minutes"))
    found = metrics.conference_summary(rows, "conference", "teams", "NATION_7")
    top = F.array_join(F.transform("top_countries", lambda x: F.concat(x["name"], F.lit(" "), x["n"].cast("string"))), ",")
    return found.withColumn("outside_home_pct", F.round("outside_home_pct", 9)).withColumn("top_countries", top)


CELL_SQL = """g AS (SELECT c_custkey % 40 AS cell, sum(c_acctbal) * 20 AS pop FROM customer GROUP BY 1), c AS (SELECT cell, CASE WHEN cell % 7 > 0 THEN pop END AS pop, 'cell ' || cell AS label, 'none' AS country FROM g UNION ALL SELECT 100, 5000, 'cell 100', 'none'),
q AS (SELECT c_custkey AS id, c_custkey % 37 * c_custkey % 40 AS cell, CASE WHEN c_custkey % 3 > 0 THEN 'place ' || c_custkey % 2 END AS place, CASE WHEN c_custkey % 5 > 0 THEN 'N' || c_nationkey % 3 END AS country, c_custkey % 50 AS m FROM customer WHERE c_custkey % 9 > 0),
n AS (SELECT cell, count(*) AS players, sum(m) AS workload FROM q GROUP BY 1), l AS (SELECT cell, arg_min(v, (-n, v)) AS v FROM (SELECT cell, coalesce(place, 'Mapped area') AS v, count(*) AS n FROM q GROUP BY 1, 2) GROUP BY 1), o AS (SELECT cell, arg_min(v, (-n, v)) AS v FROM (SELECT cell, coalesce(country, 'Country unavailable') AS v, count(*) AS n FROM q GROUP BY 1, 2) GROUP BY 1),
f AS (SELECT cell, coalesce(players, 0) AS players, coalesce(workload, 0) AS workload, CASE WHEN coalesce(pop, 0) <> 0 THEN coalesce(players, 0) / pop * 1000000 END AS rate, players IS NULL AS reference, coalesce(players, 0) >= 2 AND coalesce(pop, 0) >= 100000 AS stable, coalesce(l.v, label) AS label, coalesce(o.v, c.country) AS country FROM c LEFT JOIN n USING (cell) LEFT JOIN l USING (cell) LEFT JOIN o USING (cell))"""


def _cells(spark: SparkSession, d: str, references: bool) -> DataFrame:
    k = F.col("c_custkey")
    pop = F.when(F.col("cell") % 7 > 0, F.col("pop"))
    cells = t(spark, d, "customer").groupBy((k % 40).alias("cell")).agg((F.sum("c_acctbal") * 20).alias("pop")).select("cell", pop.alias("population"), F.concat(F.lit("cell "), F.col("cell").cast("string")).alias("label"), F.lit("none").alias("country"))
    cells = cells.unionByName(spark.createDataFrame([(100, 5000.0, "cell 100", "none")], cells.schema))
    people = t(spark, d, "customer").where(k % 9 > 0).select(
        k.alias("person"), (k % 37 * k % 40).alias("cell"), F.when(k % 3 > 0, F.concat(F.lit("place "), (k % 2).cast("string"))).alias("place"),
        F.when(k % 5 > 0, F.concat(F.lit("N"), (F.col("c_nationkey") % 3).cast("string"))).alias("country"), (k % 50).alias("minutes"),
    )
    return metrics.population_cells(cells, people, references)


@query(f"WITH {CELL_SQL} SELECT * REPLACE (round(rate, 6) AS rate) FROM f")
def population_cells_labelled(spark: SparkSession, d: str) -> DataFrame:
    """Cells with their people's rate, the most frequent place and country, and cells without people as references."""
    return _cells(spark, d, True).withColumn("rate", F.round("rate", 6))


@query(f"""WITH {CELL_SQL}, s AS (SELECT list_sort(list(coalesce(rate, 0)) FILTER (WHERE stable)) AS a, list_sort(list(rate) FILTER (WHERE NOT reference AND rate IS NOT NULL)) AS b FROM f), v AS (SELECT CASE WHEN len(a) >= 5 THEN a ELSE b END AS v FROM s)
SELECT 0.0::DOUBLE AS q0, {", ".join(f"round(coalesce(v[CAST(floor((len(v) - 1) * {q / 100} + 0.5) AS INTEGER) + 1], 0), 6) AS q{q}" for q in (25, 50, 75, 95))} FROM v""")
def rate_stops_of_stable_cells(spark: SparkSession, d: str) -> DataFrame:
    """The five stops of a rate scale: 0 first, quantiles of stable cells where there are five of them."""
    stops = metrics.rate_stops(_cells(spark, d, True))
    return stops.select(*[F.round(c, 6).alias(c) for c in stops.columns])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 > 0 AND c_custkey % 5 > 0 AND c_custkey % 5 <> c_custkey % 7 THEN 'dob_mismatch' WHEN c_custkey % 2 = 0 AND c_custkey % 3 > 0 AND c_custkey % 5 = 0 THEN 'entity_dob_missing'
  WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN 'source_dob_missing' WHEN c_custkey % 11 > 0 AND c_custkey % 2 = 1 THEN 'not_linked' WHEN c_custkey % 11 = 0 AND c_custkey % 2 = 1 THEN 'missing_link'
  WHEN c_custkey % 11 = 0 THEN 'missing_link' WHEN c_nationkey % 4 = 0 THEN 'birthplace_missing' WHEN c_acctbal < 0 THEN 'coordinates_missing' ELSE 'resolved' END AS status FROM customer""")
def overriding_status(spark: SparkSession, d: str) -> DataFrame:
    """Rules in order, each replacing what those before it said; the last two only replace ``resolved``."""
    k = F.col("c_custkey")
    link, entity = F.when(k % 11 > 0, k), F.when(k % 2 == 0, k)
    source, found = F.when(k % 3 > 0, k % 7), F.when(k % 5 > 0, k % 5)
    rules = [
        ("missing_link", link.isNull(), False), ("not_linked", link.isNotNull() & entity.isNull(), False), ("source_dob_missing", entity.isNotNull() & source.isNull(), False),
        ("entity_dob_missing", entity.isNotNull() & source.isNotNull() & found.isNull(), False), ("dob_mismatch", entity.isNotNull() & found.isNotNull() & source.isNotNull() & (found != source), False),
        ("birthplace_missing", F.col("c_nationkey") % 4 == 0, True), ("coordinates_missing", F.col("c_acctbal") < 0, True),
    ]
    return t(spark, d, "customer").select("c_custkey", explorer.overriding(rules, "resolved").alias("status"))


@query("""WITH a AS (SELECT c_nationkey AS area, count(*) AS starts, count(DISTINCT c_mktsegment) AS kinds FROM customer GROUP BY 1), p AS (SELECT n_nationkey AS area, y AS year, CASE WHEN n_nationkey % 6 = 0 THEN 0 ELSE n_nationkey * 1000 + y END AS population FROM nation, (VALUES (2024), (2025)) v(y) WHERE n_nationkey < 22)
SELECT area, starts, kinds, CASE WHEN population > 0 THEN population END AS population, CASE WHEN population > 0 THEN starts / population * 1000000.0 END AS starts_per_million, CASE WHEN population > 0 THEN kinds / population * 1000000.0 END AS kinds_per_million FROM a LEFT JOIN (SELECT * FROM p WHERE year = 2025) USING (area)""")
def per_million_of_a_year(spark: SparkSession, d: str) -> DataFrame:
    """Areas have populations of two years, of which the asked one counts."""
    rows = t(spark, d, "customer").groupBy(F.col("c_nationkey").alias("area")).agg(F.count("*").alias("starts"), F.count_distinct("c_mktsegment").alias("kinds"))
    k = F.col("n_nationkey")
    population = t(spark, d, "nation").where(k < 22).select(k.alias("area"), F.explode(F.array(F.lit(2024), F.lit(2025))).alias("year")).withColumn("population", F.when(F.col("area") % 6 == 0, 0).otherwise(F.col("area") * 1000 + F.col("year")))
    return metrics.per_million_of(rows, population, "area", ["starts", "kinds"], 2025)


FIGHT_SQL = """f AS (SELECT l_orderkey * 10 + l_linenumber AS fight_id, 's' || (l_suppkey % 200) AS a, 'p' || (l_partkey % 300) AS b, CASE WHEN l_discount < 0.02 THEN 'D' WHEN l_discount < 0.03 THEN 'NC' WHEN l_quantity > 25 THEN 'W' ELSE 'L' END AS ra, CASE WHEN l_tax > 0.06 THEN 'Heavy' ELSE 'Light' END AS division,
  l_linenumber = 1 AS title, CASE l_returnflag WHEN 'R' THEN 'KO/TKO' WHEN 'A' THEN 'Submission (hold)' ELSE 'Decision - split' END AS method, l_orderkey % 3 > 0 AS detailed, CAST(l_shipdate AS DATE) AS "on", CAST(l_quantity AS BIGINT) AS q FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_shipdate) = 1),
s AS (SELECT fight_id, a AS id, b AS other, ra AS r, division, title, method, detailed, "on", q % 3 + 1 AS kd, q % 9 + 2 AS landed, q % 9 + 12 AS tried, q % 4 AS sub FROM f
UNION ALL SELECT fight_id, b, a, CASE ra WHEN 'W' THEN 'L' WHEN 'L' THEN 'W' ELSE ra END, division, title, method, detailed, "on", q % 3 + 1, 2 * (q % 5), 2 * (q % 5 + 5), 0 FROM f)"""


@query(f"""WITH {FIGHT_SQL} SELECT id AS fighter_id, 'Men' AS gender, division, count(*) AS bouts, count(*) FILTER (WHERE r = 'W') AS wins, count(*) FILTER (WHERE r = 'L') AS losses, count(*) FILTER (WHERE r = 'D') AS draws, count(*) FILTER (WHERE r = 'NC') AS no_contests,
count(*) FILTER (WHERE r = 'W' AND method LIKE 'KO%') AS ko_wins, count(*) FILTER (WHERE r = 'W' AND method LIKE 'Sub%') AS submission_wins, count(*) FILTER (WHERE r = 'W' AND method LIKE 'Dec%') AS decision_wins, count(*) FILTER (WHERE title) AS title_bouts, count(*) FILTER (WHERE detailed) AS detailed_bouts,
CAST(coalesce(sum(kd) FILTER (WHERE detailed), 0) AS BIGINT) AS knockdowns, CAST(coalesce(sum(sub) FILTER (WHERE detailed), 0) AS BIGINT) AS submission_attempts, CAST(coalesce(sum(landed) FILTER (WHERE detailed), 0) AS BIGINT) AS significant_strikes_landed, CAST(coalesce(sum(tried) FILTER (WHERE detailed), 0) AS BIGINT) AS significant_strikes_attempted,
CAST(0 AS BIGINT) AS total_strikes_landed, CAST(0 AS BIGINT) AS total_strikes_attempted, CAST(0 AS BIGINT) AS takedowns_landed, CAST(0 AS BIGINT) AS takedowns_attempted, string_agg(r, '' ORDER BY "on" DESC, fight_id) AS log FROM s GROUP BY 1, 3""")
def fights_with_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Fights as two appearances with results, ways of winning, titles and the sums of their rounds; two of three fights have round statistics, of which some texts are of no use."""
    k, q = F.col("l_orderkey"), F.col("l_quantity").cast("long")
    mark = lambda m, c: F.concat(F.lit(m), c.cast("string"))
    first = F.when(F.col("l_discount") < 0.02, "D").when(F.col("l_discount") < 0.03, "NC").when(F.col("l_quantity") > 25, "W").otherwise("L")
    second = F.when(first == "W", "L").when(first == "L", "W").otherwise(first)
    first_line = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_quantity", "l_shipdate"))
    rows = t(spark, d, "lineitem").withColumn("fight_id", k * 10 + F.col("l_linenumber")).withColumn("_line", first_line).where("_line = 1")
    fights = rows.select(
        "fight_id", mark("s", F.col("l_suppkey") % 200).alias("first_id"), mark("p", F.col("l_partkey") % 300).alias("second_id"), first.alias("first_result"), second.alias("second_result"), F.lit("Men").alias("gender"),
        F.when(F.col("l_tax") > 0.06, "Heavy").otherwise("Light").alias("division"), F.when(F.col("l_returnflag") == "R", "KO/TKO").when(F.col("l_returnflag") == "A", "Submission (hold)").otherwise("Decision - split").alias("method"),
        (F.col("l_linenumber") == 1).alias("title"), F.to_date("l_shipdate").alias("on"),
    )
    said = lambda a, b: F.concat(a.cast("string"), F.lit(" of "), b.cast("string"))
    texts = rows.where(k % 3 > 0).select(
        "fight_id", (q % 3).cast("string").alias("p1_rd1_KD"), F.lit("1").alias("p1_rd2_KD"), F.lit("--").alias("p1_rd3_KD"), (q % 3 + 1).cast("string").alias("p2_rd5_KD"), (q % 4).cast("string").alias("p1_rd1_Sub_att"),
        said(q % 9, q % 9 + 9).alias("p1_rd1_Sig_str"), F.lit("2 of 3").alias("p1_rd4_Sig_str"), said(q % 5, q % 5 + 5).alias("p2_rd1_Sig_str"), said(q % 5, q % 5 + 5).alias("p2_rd2_Sig_str"), F.lit("none").alias("p1_rd1_Td"),
    )
    found = metrics.fighter_splits(fights, metrics.fight_rounds(texts))
    return found.withColumn("log", F.array_join(F.transform("log", lambda x: x["result"]), ""))


# a customer's orders of a year are a row of the dashboard's table
SEASON_SQL = """w AS (SELECT o_custkey AS id, year(o_orderdate) AS season, 'T' || (o_custkey + year(o_orderdate)) % 30 AS team, count(*) FILTER (WHERE o_orderstatus = 'F') AS starts, count(*) FILTER (WHERE o_orderstatus <> 'F') AS subs FROM orders GROUP BY 1, 2, 3),
j AS (SELECT w.*, c_name AS name, c_acctbal > 0 AS mapped, CASE WHEN c_nationkey % 9 > 0 THEN 'Q' || c_nationkey END AS place, n_name AS country FROM w JOIN customer ON c_custkey = id JOIN nation ON n_nationkey = c_nationkey)"""


def _seasons(spark: SparkSession, d: str) -> DataFrame:
    season = F.year("o_orderdate")
    rows = t(spark, d, "orders").groupBy(F.col("o_custkey").alias("id"), season.alias("season")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("starts"), F.count_if(F.col("o_orderstatus") != "F").alias("subs"))
    rows = rows.withColumn("team", F.concat(F.lit("T"), ((F.col("id") + F.col("season")) % 30).cast("string")))
    people = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    place = F.when(F.col("c_nationkey") % 9 > 0, F.concat(F.lit("Q"), F.col("c_nationkey").cast("string")))
    return rows.join(people.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_acctbal") > 0).alias("mapped"), place.alias("place"), F.col("n_name").alias("country")), "id")


@query(f"WITH {SEASON_SQL} SELECT season, team, CAST(sum(starts) AS BIGINT) AS starts FROM j GROUP BY 1, 2")
def dashboard_timeline(spark: SparkSession, d: str) -> DataFrame:
    return explorer.timeline(_seasons(spark, d), "season", "team", "starts")


@query(f"""WITH {SEASON_SQL} SELECT place, country, count(DISTINCT id) AS players, count(DISTINCT CASE WHEN starts > 0 THEN id END) AS unique_starters, CAST(sum(starts) AS BIGINT) AS starts, string_agg(DISTINCT team, ', ' ORDER BY team) AS teams FROM j WHERE mapped GROUP BY 1, 2""")
def dashboard_places(spark: SparkSession, d: str) -> DataFrame:
    """Mapped people by place; people whose place has no name are a group of their own for each country."""
    return explorer.place_summary(_seasons(spark, d).where("mapped"), ["place", "country"], "id", "starts", "team")


@query(f"""WITH {SEASON_SQL} SELECT id, name, string_agg(DISTINCT team, ', ' ORDER BY team) AS teams, count(DISTINCT season) AS seasons, CAST(sum(starts) AS BIGINT) AS starts, CAST(sum(subs) AS BIGINT) AS subs, min_by(place, season) AS place, min_by(country, season) AS country FROM j GROUP BY 1, 2""")
def dashboard_players(spark: SparkSession, d: str) -> DataFrame:
    return explorer.player_summary(_seasons(spark, d), ["id", "name"], "team", "season", ["starts", "subs"], {"place": "place", "country": "country"}, "season")


@query("SELECT c_custkey FROM customer WHERE c_nationkey % 5 <> 3 AND c_custkey % 4 IN (0, 3)")
def accent_free_search(spark: SparkSession, d: str) -> DataFrame:
    """Accents and case count on neither side; a stroke through a letter is no accent."""
    names = F.element_at(F.array(*[F.lit(x) for x in ("São Paulo", "sao tome", "SÃO", "Salto", "S\u0308ao")]), (F.col("c_nationkey") % 5 + 1).cast("int"))
    other = F.element_at(F.array(*[F.lit(x) for x in ("Łódź Fútbol", "lódz futbol", "Łodz", "Łódź FUTBOL")]), (F.col("c_custkey") % 4 + 1).cast("int"))
    rows = t(spark, d, "customer").select("c_custkey", names.alias("a"), other.alias("b"))
    return explorer.contains_text(explorer.contains_text(rows, "SÃo", ["a"]), "łodz FÚT", ["a", "b"]).select("c_custkey")


@query("SELECT page_id, length(title) > 0 AS titled, folded FROM (SELECT page_id, title, regexp_replace(lower(strip_accents(title)), '[^a-z0-9]', '', 'g') AS folded FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages))")
def folded_titles(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the pages' titles, whose letters have accents."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return t(spark, d, "pages").select("page_id", (F.length(title) > 0).alias("titled"), scalar.normalize_key(title).alias("folded"))
