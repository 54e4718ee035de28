"""Queries on landed pages, growing folders, places by names, nested documents and translations, all made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.functions import scalar
from terravane.operators import gazetteer, metrics, templates
from terravane.operators.lineage import shared_folder
from terravane.plans.catalog import query, t
from terravane.sources import landed
from terravane.streaming import landing


def _landed(spark: SparkSession, d: str) -> DataFrame:
    """The pages of the table, landed twice: each page's last landing counts. Every seventh page is not there."""
    path = shared_folder(spark, "pages")
    k = F.col("page_id")
    pages = t(spark, d, "pages").where(k % 7 > 0)
    for half in (1, 0):  # pages of an even number are landed last
        some = pages.where(k % 2 == half).select("url", F.col("html").alias("body"), F.concat(F.lit("2025-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0")).alias("retrieved_at"), F.lit(200 + half).alias("status_code"))
        landed.land(some, path)
    return landed.register(spark).read.format("landed_pages").option("path", path).option("tasks", 8).load()


LANDED_SQL = """p AS (SELECT url, coalesce(html, '') AS body, page_id % 2 AS half, '2025-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS seen FROM pages WHERE page_id % 7 > 0 AND url IS NOT NULL),
w AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY half, seen DESC, body DESC) AS k FROM p)"""


@query(f"WITH {LANDED_SQL} SELECT url, seen AS retrieved_at, CAST(200 + half AS INTEGER) AS status_code, sha256(body) AS sha256, strlen(body) AS n_bytes FROM w WHERE k = 1")
def landed_pages_scan(spark: SparkSession, d: str) -> DataFrame:
    """The page cache, written and read back through its own data source."""
    return _landed(spark, d).select("url", "retrieved_at", "status_code", "sha256", F.octet_length("body").cast("long").alias("n_bytes"))


@query(f"""WITH {LANDED_SQL}, r AS (SELECT page_id, url, page_id % 5 AS failed, CASE page_id % 3 WHEN 0 THEN '30' WHEN 1 THEN 'soon' END AS after FROM pages), u AS (SELECT url, min(struct_pack(page_id, failed, after)) AS r FROM r WHERE url IS NOT NULL GROUP BY 1)
SELECT url, CASE WHEN url IN (SELECT url FROM w) THEN 'cached' WHEN r.failed >= 3 THEN 'failed' WHEN r.failed > 0 THEN 'retry' ELSE 'new' END AS state,
CASE WHEN url NOT IN (SELECT url FROM w) AND r.failed BETWEEN 1 AND 2 THEN TIMESTAMP '2025-02-01 00:00:00' + to_milliseconds(CAST(1000 * greatest(CASE WHEN r.after = '30' THEN 30 ELSE 0 END, 1.5 * pow(2, r.failed - 1)) AS BIGINT)) END AS due FROM u""")
def page_fetch_plan(spark: SparkSession, d: str) -> DataFrame:
    """What a fetching job does next for every page: cached ones nothing, misses at once or when their wait is over."""
    k = F.col("page_id")
    asked = t(spark, d, "pages").where("url IS NOT NULL").select("url", F.struct("page_id", (k % 5).alias("failed"), F.when(k % 3 == 0, "30").when(k % 3 == 1, "soon").alias("after")).alias("r"))
    asked = asked.groupBy("url").agg(F.min("r").alias("r")).select("url", "r.failed", F.col("r.after").alias("retry_after"), F.lit("2025-02-01").cast("timestamp").alias("failed_at"))
    return landed.fetch_plan(asked, _landed(spark, d))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def incremental_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Orders arrive in files of which some stand there from the start; three runs, one of them with nothing new and one whose rows came before, leave the table as one run would."""
    source, target, checkpoint = (shared_folder(spark, f"ingest-{x}") for x in ("source", "target", "checkpoint"))
    orders = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, seen int"
    for seen, some in ((1, F.col("o_orderkey") % 3 == 0), (2, None), (3, F.col("o_orderkey") % 2 >= 0)):
        if some is not None:
            # the first landing of an order holds an outdated price
            price = F.col("o_totalprice") - (1 if seen == 1 else 0)
            orders.where(some).select("o_orderkey", "o_custkey", "o_orderstatus", price.alias("o_totalprice"), F.lit(seen).alias("seen")).write.mode("append").parquet(source)
        landing.ingest_new_files(spark, source, target, checkpoint, schema, files_per_batch=4)
    return landing.latest(spark, target, ["o_orderkey"], ["seen"]).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def _key(c):
    return scalar.normalize_key(c)


def _places(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    return t(spark, d, "part").select(
        k.alias("place_id"), F.initcap("p_name").alias("name"), F.lit("").alias("ascii_name"), F.concat("p_type", F.lit(","), F.concat(F.lit("Ville "), "p_name"), F.lit(",")).alias("other_names"),
        F.concat(F.lit("C"), (k % 7).cast("string")).alias("country_code"), F.lpad((k % 5).cast("string"), 2, "0").alias("admin1"), F.when(k % 11 > 0, F.floor("p_retailprice")).alias("population"),
        (F.col("p_size") * 1.5).alias("lat"), (k % 360 - 180.0).alias("lon"), k.alias("line"),
    )


def _asked(spark: SparkSession, d: str, us: bool = False) -> DataFrame:
    """Customers ask for names of parts, with and without a country and an area, by code or by name."""
    k = F.col("c_custkey")
    names = t(spark, d, "part").select((F.col("p_partkey")).alias("n"), "p_name", "p_type")
    n = names.agg(F.count("*").alias("n")).first()["n"]
    country = F.when(k % 13 == 0, "Nowhere").otherwise(F.concat(F.when(k % 2 == 0, F.lit("Country Ñ")).otherwise(F.lit("c")), (k % 7).cast("string")))
    country = F.when(k % 3 == 0, "usa").otherwise(country) if us else country
    area = F.when(k % 4 == 0, F.concat(F.lit("Área "), (k % 5).cast("string"))).when(k % 4 == 1, F.lpad((k % 5).cast("string"), 2, "0")).when(k % 4 == 2, "unknown")
    city = F.when(k % 5 == 0, F.col("p_type")).when(k % 5 == 1, F.concat(F.lit("VILLE-"), "p_name")).when(k % 5 < 4, F.upper("p_name"))
    return t(spark, d, "customer").withColumn("n", k * 7 % n).join(names, "n").select(k.alias("request_id"), city.alias("city"), country.alias("country"), area.alias("area"))


PLACE_SQL = """l AS (SELECT p_partkey, p_partkey AS line, 'C' || (p_partkey % 7) AS code, lpad(CAST(p_partkey % 5 AS VARCHAR), 2, '0') AS admin1, CASE WHEN p_partkey % 11 > 0 THEN CAST(floor(p_retailprice) AS BIGINT) ELSE 0 END AS pop, p_size * 1.5::DOUBLE AS lat, p_partkey % 360 - 180.0::DOUBLE AS lon, p_name, p_type FROM part),
i AS (SELECT DISTINCT p_partkey, regexp_replace(lower(unnest([p_name, p_type, 'ville' || p_name])), '[^a-z0-9]', '', 'g') AS key FROM l),
q AS (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN p_type WHEN 1 THEN 'ville' || p_name WHEN 4 THEN NULL ELSE p_name END AS city, CASE WHEN c_custkey % 13 <> 0 THEN 'C' || (c_custkey % 7) END AS country,
  CASE WHEN c_custkey % 4 < 2 THEN lpad(CAST(c_custkey % 5 AS VARCHAR), 2, '0') END AS area, c_custkey % 4 AS how FROM customer JOIN part ON p_partkey = c_custkey * 7 % (SELECT count(*) FROM part))"""


@query(f"""WITH {PLACE_SQL}, m AS (SELECT c_custkey, l.* FROM q JOIN i ON key = regexp_replace(lower(city), '[^a-z0-9]', '', 'g') JOIN l USING (p_partkey) WHERE code = country AND (area IS NULL OR admin1 = area)),
r AS (SELECT *, count(*) OVER (PARTITION BY c_custkey) AS n, row_number() OVER (PARTITION BY c_custkey ORDER BY pop DESC, line) AS k FROM m)
SELECT c.c_custkey AS request_id, p_partkey AS place_id, round(lat, 6) AS lat, round(lon, 6) AS lon, code AS country_code, admin1, coalesce(n, 0) AS candidates FROM customer c LEFT JOIN r ON r.c_custkey = c.c_custkey AND k = 1 WHERE c.c_custkey IN (SELECT c_custkey FROM q)""")
def gazetteer_places(spark: SparkSession, d: str) -> DataFrame:
    """Names narrowed by country and by an area's code or name; unknown areas do not narrow."""
    nations = spark.range(7).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("code"), F.lit("").alias("iso3"), F.lit(None).cast("string").alias("fips"), F.concat(F.lit("Country Ñ"), F.col("id").cast("string")).alias("name"), F.col("id").alias("line"))
    parts = t(spark, d, "nation").where("n_nationkey < 25").select((F.col("n_nationkey") % 5).alias("a"), F.floor(F.col("n_nationkey") / 5).alias("b")).crossJoin(spark.range(7).withColumnRenamed("id", "c")).where("b = 0")
    areas = parts.select(F.concat(F.lit("C"), F.col("c").cast("string"), F.lit(".0"), F.col("a").cast("string")).alias("code"), F.concat(F.lit("Área "), F.col("a").cast("string")).alias("name"), F.lit("").alias("ascii_name"), F.col("a").alias("line"))
    return gazetteer.resolve_places(_asked(spark, d), _places(spark, d), gazetteer.country_index(nations, _key), _key, gazetteer.area_index(areas, _key))


@query("SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k, CAST(props ->> '$.k' AS BIGINT) > 50 AS large FROM events")
def variant_event_props(spark: SparkSession, d: str) -> DataFrame:
    """One key of each event's properties, out of a VARIANT."""
    v = t(spark, d, "events").select("event_id", F.try_parse_json("props").alias("v"))
    k = F.try_variant_get("v", "$.k", "bigint")
    return v.select("event_id", k.alias("k"), (k > 50).alias("large"))


LINES_OF_A_TASK = 50_000


def match_documents(spark: SparkSession, d: str) -> DataFrame:
    """An order is a match, its lines are deliveries in innings of odd and even lines; shapes vary: fielders are names or objects, absent extras and wickets have no key.

    Lines move once, before they are text, dealt by order into as many tasks as their number asks for; innings and documents are put together where they lie.
    """
    q = F.col("l_quantity").cast("long")
    name = lambda mark, c: F.concat(F.lit(mark), c.cast("string"))
    fielder = name("b", F.col("l_suppkey") % 10)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("caught", "Run out", "stumped", "caught and bowled", "bowled", "timed out")]), (q % 6 + 1).cast("int"))
    fielders = F.when(q % 6 == 3, F.lit("[]")).when(q % 4 == 0, F.concat(F.lit('["'), fielder, F.lit('"]'))).otherwise(F.concat(F.lit('[{"name": "'), fielder, F.lit('"}, {"substitute": true}]')))
    wicket = F.when(F.col("l_returnflag") == "R", F.concat(F.lit(', "wickets": [{"kind": "'), kind, F.lit('", "fielders": '), fielders, F.lit("}]"))).otherwise("")
    extra = F.when(F.col("l_discount") > 0.08, ', "extras": {"wides": 1}').when(F.col("l_discount") > 0.06, ', "extras": {"noballs": 1, "legbyes": 2}').otherwise("")
    ball = F.concat(F.lit('{"batter": "'), name("b", F.col("l_suppkey") % 10), F.lit('", "bowler": "'), name("p", F.col("l_partkey") % 10), F.lit('", "runs": {"batter": '), (q % 7).cast("string"), F.lit(', "total": '), (q % 7 + 2).cast("string"), F.lit("}"), extra, wicket, F.lit("}"))
    lines = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag")
    lines = lines.repartition(lines.count() // LINES_OF_A_TASK + 1, "l_orderkey")
    innings = lines.select("l_orderkey", (F.col("l_linenumber") % 3).alias("i"), F.struct("l_linenumber", "l_partkey", "l_suppkey", ball.alias("ball")).alias("b"))
    overs = innings.groupBy("l_orderkey", "i").agg(F.array_join(F.sort_array(F.collect_list("b"))["ball"], ", ").alias("balls"))
    text = F.concat(F.lit('{"team": "t'), F.col("i").cast("string"), F.lit('", "overs": [{"over": 0, "deliveries": ['), "balls", F.lit("]}, {}]"), F.when(F.col("i") == 2, ', "super_over": true').otherwise(""), F.lit("}"))
    docs = overs.groupBy("l_orderkey").agg(F.concat(F.lit('{"info": {}, "innings": ['), F.array_join(F.sort_array(F.collect_list(text)), ", "), F.lit("]}")).alias("doc"))
    return docs.select(F.col("l_orderkey").alias("match_id"), F.parse_json("doc").alias("doc"))


@query("""WITH b AS (SELECT l_orderkey AS m, l_linenumber % 3 AS i, 'b' || (l_suppkey % 10) AS bat, 'p' || (l_partkey % 10) AS bowl, CAST(l_quantity AS BIGINT) AS q, l_returnflag = 'R' AS w, l_discount > 0.08 AS wide, l_discount > 0.06 AND l_discount <= 0.08 AS nb FROM lineitem WHERE l_linenumber % 3 < 2),
s AS (SELECT bat AS id, q % 7 AS runs, (q % 7 = 4)::BIGINT AS fours, (q % 7 = 6)::BIGINT AS sixes, (NOT wide)::BIGINT AS faced, 0 AS bowled, 0 AS conceded, 0 AS wickets, 0 AS catches, 0 AS stumpings, 0 AS run_outs FROM b
UNION ALL SELECT bowl, 0, 0, 0, 0, (NOT wide AND NOT nb)::BIGINT, q % 7 + 2 - CASE WHEN nb THEN 2 ELSE 0 END, (w AND q % 6 NOT IN (1, 5))::BIGINT, 0, 0, 0 FROM b
UNION ALL SELECT bat, 0, 0, 0, 0, 0, 0, 0, (q % 6 = 0)::BIGINT, (q % 6 = 2)::BIGINT, (q % 6 = 1)::BIGINT FROM b WHERE w AND q % 6 <> 3 UNION ALL SELECT bowl, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0 FROM b WHERE w AND q % 6 = 3),
n AS (SELECT bat AS id, count(DISTINCT (m, i)) AS batting_innings FROM b GROUP BY 1)
SELECT id, CAST(sum(runs) AS BIGINT) AS runs, CAST(sum(fours) AS BIGINT) AS fours, CAST(sum(sixes) AS BIGINT) AS sixes, CAST(sum(faced) AS BIGINT) AS faced, CAST(sum(bowled) AS BIGINT) AS bowled, CAST(sum(conceded) AS BIGINT) AS conceded, CAST(sum(wickets) AS BIGINT) AS wickets,
CAST(sum(catches) AS BIGINT) AS catches, CAST(sum(stumpings) AS BIGINT) AS stumpings, CAST(sum(run_outs) AS BIGINT) AS run_outs, coalesce(any_value(batting_innings), 0) AS batting_innings FROM s LEFT JOIN n USING (id) GROUP BY id""")
def match_document_totals(spark: SparkSession, d: str) -> DataFrame:
    """Batting, bowling and fielding out of nested match documents."""
    return metrics.cricket_totals(metrics.match_deliveries(match_documents(spark, d)))


MESSAGES = (
    ("a.count", "{n} players", "{n} joueurs"), ("b.from", "{name} has {n} players from {place}", "{place} : {n} joueurs de {name}"), ("c.of", "{a} of {a}", "{a} sur {a}"), ("d.all", "All {n} (players)", "Tous les {n} (joueurs)"), ("e.none", "Nothing.found", "Rien"), ("f.only", "Only here {x}", None),
)
MESSAGE_SQL = "(VALUES " + ", ".join("(" + ", ".join("NULL" if x is None else "'" + x + "'" for x in row) + ")" for row in MESSAGES) + ")"


@query("""WITH c AS (SELECT c_custkey AS k, c_name, c_nationkey AS n, c_mktsegment AS s FROM customer)
SELECT k AS text_id, CASE k % 8 WHEN 0 THEN 'a.count' WHEN 1 THEN 'b.from' WHEN 2 THEN 'c.of' WHEN 3 THEN 'd.all' WHEN 4 THEN 'e.none' WHEN 5 THEN 'f.only' END AS key,
CASE k % 8 WHEN 0 THEN n || ' joueurs' WHEN 1 THEN s || ' : ' || n || ' joueurs de ' || c_name WHEN 2 THEN n || ' sur ' || n WHEN 3 THEN 'Tous les ' || n || ' (joueurs)' WHEN 4 THEN 'Rien' WHEN 5 THEN 'Only here {n}' WHEN 6 THEN n || ' of ' || (n + 1) ELSE 'Nothing found' END AS translation FROM c""")
def messages_translated(spark: SparkSession, d: str) -> DataFrame:
    """English texts of customers told back to their messages and given in French."""
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    text = F.element_at(F.array(
        F.concat(n, F.lit(" players")), F.concat("c_name", F.lit(" has "), n, F.lit(" players from "), "c_mktsegment"), F.concat(n, F.lit(" of "), n), F.concat(F.lit("All "), n, F.lit(" (players)")), F.lit("Nothing.found"),
        F.lit("Only here {n}"), F.concat(n, F.lit(" of "), (F.col("c_nationkey") + 1).cast("string")), F.lit("Nothing found"),
    ), (k % 8 + 1).cast("int"))
    rows = [(language, key, said) for key, *both in MESSAGES for language, said in zip(("en", "fr"), both, strict=True) if said is not None]
    messages = spark.createDataFrame(rows, "language string, key string, text string")
    return templates.translated(t(spark, d, "customer").select(k.alias("text_id"), text.alias("text")), messages, "en", "fr")
