"""Normalisation on ingest, eligibility, projections, rollups and dashboard checks over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.operators import explorer, ingest, metrics, validate
from terravane.plans.catalog import query, t
from terravane.plans.contributions import PEOPLE_SQL, SPLITS_SQL, people, splits

INCOMING_SQL = """i AS (SELECT c_custkey + 2 AS row_number, (c_custkey // 2) % 25 AS k, c_custkey // 2 AS pair,
  CASE c_custkey % 6 WHEN 0 THEN '  nation_' || (c_custkey // 2) % 25 || ' ' WHEN 2 THEN 'Atlantis' WHEN 3 THEN NULL ELSE 'NATION_' || (c_custkey // 2) % 25 END AS team0,
  CASE c_custkey % 5 WHEN 0 THEN ' n' || (c_custkey // 2) % 25 WHEN 1 THEN 'N' || ((c_custkey // 2) % 25 + 1) WHEN 2 THEN 'ZZZ' ELSE 'N' || (c_custkey // 2) % 25 END AS code0,
  CASE c_custkey % 7 WHEN 0 THEN '2005 / 06' WHEN 1 THEN '2005/2006' WHEN 2 THEN '2006' WHEN 3 THEN 'bad' WHEN 4 THEN '1999-00' WHEN 5 THEN NULL ELSE '2005-06' END AS season0,
  CASE (c_custkey // 2) % 4 WHEN 0 THEN '2006' WHEN 1 THEN '2006' WHEN 2 THEN '2031' ELSE 'x' END AS year0,
  CASE WHEN (c_custkey // 2) % 11 = 0 THEN ' ' ELSE ' Player ' || c_custkey // 2 || ' ' END AS name0,
  CASE c_custkey % 4 WHEN 0 THEN '5' WHEN 1 THEN '-1' WHEN 2 THEN 'x' ELSE '2.0' END AS starts0, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE '3' END AS subs0 FROM customer),
cohort AS (SELECT n_name AS team, 'N' || n_nationkey AS code FROM nation WHERE n_nationkey < 20),
j AS (SELECT i.*, a.team AS known, a.code AS expected, coalesce(a.team, trim(team0)) AS team, upper(trim(code0)) AS fifa_code, b.code AS known_code, trim(name0) AS player_name, TRY_CAST(year0 AS BIGINT) AS sey,
  TRY_CAST(TRY_CAST(starts0 AS DOUBLE) AS BIGINT) AS starts, TRY_CAST(subs0 AS BIGINT) AS subs,
  CASE season0 WHEN '2005 / 06' THEN 2006 WHEN '2005/2006' THEN 2006 WHEN '2006' THEN 2006 WHEN '1999-00' THEN 2000 WHEN '2005-06' THEN 2006 END AS parsed
  FROM i LEFT JOIN cohort a ON lower(trim(team0)) = lower(a.team) LEFT JOIN cohort b ON upper(trim(code0)) = b.code),
m AS (SELECT *, CASE WHEN player_name <> '' THEN sha1(lower(player_name) || '|')[1:16] END AS player_id, (sey - 1) || '-' || lpad(CAST(sey % 100 AS VARCHAR), 2, '0') AS label FROM j)"""


def _incoming(spark: SparkSession, d: str) -> DataFrame:
    k, pair = F.col("c_custkey"), F.floor(F.col("c_custkey") / 2)
    n = (pair % 25).cast("string")
    pick = lambda c, by, *values: F.element_at(F.array(*[v if not isinstance(v, str) else F.lit(v) for v in values]), (c % by + 1).cast("int"))
    none = F.lit(None).cast("string")
    nation = F.concat(F.lit("NATION_"), n)
    return t(spark, d, "customer").select(
        (k + 2).alias("row_number"), pick(k, 6, F.concat(F.lit("  nation_"), n, F.lit(" ")), nation, "Atlantis", none, nation, nation).alias(" Country "),
        pick(k, 5, F.concat(F.lit(" n"), n), F.concat(F.lit("N"), (pair % 25 + 1).cast("string")), "ZZZ", F.concat(F.lit("N"), n), F.concat(F.lit("N"), n)).alias("code"),
        pick(k, 7, "2005 / 06", "2005/2006", "2006", "bad", "1999-00", none, "2005-06").alias("season"),
        pick(pair, 4, "2006", "2006", "2031", "x").alias("season_end_year"),
        F.when(pair % 11 == 0, " ").otherwise(F.concat(F.lit(" Player "), pair.cast("string"), F.lit(" "))).alias("player"),
        pick(k, 4, "5", "-1", "x", "2.0").alias("a"), F.when(k % 9 == 0, "").otherwise("3").alias("subs"),
    )


def _cohort(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "nation").where("n_nationkey < 20").select(F.col("n_name").alias("team"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("fifa_code"))


@query(f"""WITH {INCOMING_SQL} SELECT row_number, team, fifa_code, CASE WHEN parsed IS NOT NULL AND label IS NOT NULL THEN label ELSE season0 END AS season, sey AS season_end_year, player_id, player_name, starts, subs AS sub_appearances, 0 AS goals,
  CASE WHEN coalesce(bool_or(known IS NOT NULL AND trim(team0) <> known) OVER (), false) THEN trim(team0) END AS team_source, CASE WHEN coalesce(bool_or(label IS NOT NULL AND trim(season0) <> label) OVER (), false) THEN season0 END AS season_source FROM m""")
def canonical_player_seasons(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = ingest.normalize_player_seasons(_incoming(spark, d), _cohort(spark, d))
    return rows.select("row_number", "team", "fifa_code", "season", "season_end_year", "player_id", "player_name", "starts", "sub_appearances", "goals", "team_source", "season_source")


@query(f"""WITH {INCOMING_SQL}, dup AS (SELECT team, sey, player_id FROM m WHERE team IS NOT NULL AND sey IS NOT NULL AND player_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1)
SELECT 'invalid_integer' AS code, row_number, 'season_end_year' AS "column", year0 AS value FROM m WHERE year0 = 'x' UNION ALL SELECT 'invalid_integer', row_number, 'starts', starts0 FROM m WHERE starts0 = 'x'
UNION ALL SELECT 'invalid_integer', row_number, 'sub_appearances', subs0 FROM m WHERE subs0 = ''
UNION ALL SELECT 'missing_value', row_number, 'team', team FROM m WHERE team IS NULL UNION ALL SELECT 'missing_value', row_number, 'season', season0 FROM m WHERE season0 IS NULL
UNION ALL SELECT 'missing_value', row_number, 'season_end_year', NULL FROM m WHERE sey IS NULL UNION ALL SELECT 'missing_value', row_number, 'player_id', NULL FROM m WHERE player_id IS NULL
UNION ALL SELECT 'missing_value', row_number, 'player_name', player_name FROM m WHERE player_name = '' UNION ALL SELECT 'missing_value', row_number, 'starts', NULL FROM m WHERE starts IS NULL
UNION ALL SELECT 'missing_value', row_number, 'sub_appearances', NULL FROM m WHERE subs IS NULL UNION ALL SELECT 'negative_count', row_number, 'starts', CAST(starts AS VARCHAR) FROM m WHERE starts < 0
UNION ALL SELECT 'unknown_team', row_number, 'team', team FROM m WHERE team IS NOT NULL AND known IS NULL UNION ALL SELECT 'unknown_fifa_code', row_number, 'fifa_code', fifa_code FROM m WHERE known_code IS NULL
UNION ALL SELECT 'team_code_mismatch', row_number, 'fifa_code', fifa_code FROM m WHERE expected <> fifa_code UNION ALL SELECT 'season_out_of_scope', row_number, 'season_end_year', CAST(sey AS VARCHAR) FROM m WHERE sey NOT BETWEEN 2000 AND 2026
UNION ALL SELECT 'invalid_season', row_number, 'season', season0 FROM m WHERE season0 IS NOT NULL AND parsed IS NULL UNION ALL SELECT 'season_mismatch', row_number, 'season', season0 FROM m WHERE parsed <> sey
UNION ALL SELECT 'duplicate_team_season_player', row_number, NULL, NULL FROM m JOIN dup USING (team, sey, player_id)""")
def ingest_issues(spark: SparkSession, d: str) -> DataFrame:
    """All row-level issue codes of an incoming table."""
    _, issues = ingest.normalize_player_seasons(_incoming(spark, d), _cohort(spark, d))
    return issues.select("code", "row_number", "column", "value")


@query("""SELECT team, fifa_code, season, season_end_year FROM (SELECT n_name AS team, 'N' || n_nationkey AS fifa_code, CASE n_nationkey % 3 WHEN 0 THEN '1999-00' WHEN 1 THEN '2004-05' ELSE 'none' END AS season, CASE n_nationkey % 3 WHEN 0 THEN 2000 WHEN 1 THEN 2005 END AS season_end_year FROM nation)""")
def derived_missing_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The code gives the team and the season its end year where their columns are absent."""
    k = F.col("n_nationkey")
    season = F.when(k % 3 == 0, "1999-00").when(k % 3 == 1, "2004/05").otherwise("none")
    raw = t(spark, d, "nation").select((k + 2).alias("row_number"), F.concat(F.lit("n"), k.cast("string")).alias("code"), season.alias("season"), F.col("n_name").alias("name"), F.lit("1").alias("a"), F.lit("1").alias("s"))
    cohort = t(spark, d, "nation").select(F.col("n_name").alias("team"), F.concat(F.lit("N"), k.cast("string")).alias("fifa_code"))
    return ingest.normalize_player_seasons(raw, cohort)[0].select("team", "fifa_code", "season", "season_end_year")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE year(l_shipdate) = 1995 AND l_linenumber <= 5 AND l_quantity IS NOT NULL""")
def regular_rounds(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").withColumn("season", F.year("l_shipdate")).withColumn("round", F.when(F.col("l_linenumber") > 5, "QF").otherwise(F.col("l_linenumber").cast("string")))
    return ingest.numbered_rounds(rows, "season", 1995, "round", ["l_quantity", "l_suppkey"]).select("l_orderkey", "l_linenumber")


@query("""SELECT event_id, CAST(o + f AS BIGINT) AS snaps FROM (SELECT event_id, event_type, CAST(floor(coalesce(value, 0) / 30) AS BIGINT) AS o, CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS f FROM events) WHERE event_type <> 'error' AND o + f > 0""")
def regular_season_snaps(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") == "error", "POST").otherwise("REG").alias("game_type"), F.floor(F.col("value") / 30).alias("offense_snaps"), F.when(F.col("user_id") % 3 == 0, 1).alias("defense_snaps"), F.lit(None).cast("long").alias("st_snaps")
    )
    return ingest.regular_snaps(rows).select("event_id", "snaps")


@query("""SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1996 AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice > 50000 AND (o_custkey % 25 IN (3, 7) OR o_orderkey % 25 IN (3, 7))""")
def eligible_matches(spark: SparkSession, d: str) -> DataFrame:
    team = lambda c: F.concat(F.lit("NATION_"), (F.col(c) % 25).cast("string"))
    matches = t(spark, d, "orders").select(
        "o_orderkey", F.array(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("dates"), F.col("o_orderstatus").alias("team_type"), F.col("o_orderpriority").alias("match_type"),
        F.when(F.col("o_totalprice") > 50000, F.array(F.lit("innings"))).alias("innings"), F.array(team("o_custkey"), team("o_orderkey")).alias("teams"),
    )
    return ingest.eligible_matches(matches, 1996, "1-URGENT", "F", ("NATION_3", "NATION_7")).select("o_orderkey")


@query("SELECT l_suppkey, count(*) AS starts, count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS unfinished, count(CASE WHEN l_discount <> 0 OR l_tax <> 0 THEN 1 END) AS active FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1")
def starters_without_dns(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("l_returnflag") == "R", "DNS").when(F.col("l_returnflag") == "A", "DNF")
    started = ingest.starters(t(spark, d, "lineitem").withColumn("status", status), "status")
    return started.groupBy("l_suppkey").agg(F.count("*").alias("starts"), F.count_if(F.col("status") == "DNF").alias("unfinished"), F.count_if(ingest.any_nonzero(["l_discount", "l_tax"])).alias("active"))


SPEC = explorer.EditionSpec("workload", sum_stats=("games",))
RECORDS_SQL = f"""s AS ({SPLITS_SQL}), p AS ({PEOPLE_SQL}), r0 AS (SELECT id, sum(workload) AS workload, CAST(sum(games) AS BIGINT) AS games, min_by(team, struct_pack(w := -workload, t := team)) AS team, min_by(conference, struct_pack(w := -workload, t := team)) AS conference FROM s WHERE id % 10 <> 0 GROUP BY 1),
r AS (SELECT p.id, p.name, coalesce(r0.team, p.country) AS team, coalesce(r0.conference, p.continent) AS conference, coalesce(r0.workload, 1.0) AS workload, coalesce(r0.games, 1) AS games FROM p LEFT JOIN r0 ON p.id = r0.id),
x AS (SELECT id, team, conference, workload, games FROM s WHERE id % 10 <> 0)"""


def _records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Records with their own measures, and splits; every tenth person, and whoever has no order, has no split."""
    some = splits(spark, d).where("id % 10 <> 0")
    first = F.min(F.struct((-F.col("workload")).alias("w"), "team", "conference"))
    rolled = some.groupBy("id").agg(F.sum("workload").alias("workload"), F.sum("games").alias("games"), first.alias("p"))
    records = people(spark, d).select("id", "name", "country", "continent").join(rolled, "id", "left").select(
        "id", "name", F.coalesce("p.team", "country").alias("team"), F.coalesce("p.conference", "continent").alias("conference"), F.coalesce("workload", F.lit(1.0)).alias("workload"), F.coalesce("games", F.lit(1).cast("long")).alias("games")
    )
    return records, some


@query(f"""WITH {RECORDS_SQL}, e AS (SELECT * FROM x UNION ALL SELECT id, team, conference, workload, games FROM r WHERE id NOT IN (SELECT id FROM x)), f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY workload DESC, team) AS k FROM e WHERE conference IN ('ASIA', 'EUROPE'))
SELECT f.id, name, max(CASE WHEN k = 1 THEN f.team END) AS team, max(CASE WHEN k = 1 THEN f.conference END) AS conference, sum(f.workload) AS workload, CAST(sum(f.games) AS BIGINT) AS games FROM f JOIN r ON r.id = f.id GROUP BY 1, 2""")
def projected_records(spark: SparkSession, d: str) -> DataFrame:
    """Records narrowed to two conferences, with their other columns and the default split of people without one."""
    records, some = _records(spark, d)
    return explorer.project_records(records, some, SPEC, explorer.ExplorerQuery(groups=frozenset({"ASIA", "EUROPE"})))


@query(f"WITH {RECORDS_SQL} SELECT * FROM r")
def untouched_records(spark: SparkSession, d: str) -> DataFrame:
    """Without a team or group in the query every record comes back as it is."""
    records, some = _records(spark, d)
    return explorer.project_records(records, some, SPEC, explorer.ExplorerQuery())


@query(f"WITH {RECORDS_SQL} SELECT team, count(*) AS players, sum(workload) AS workload, round(sum(workload) / max(sum(workload)) OVER (), 9) AS bar FROM (SELECT * FROM x UNION ALL SELECT id, team, conference, workload, games FROM r WHERE id NOT IN (SELECT id FROM x)) GROUP BY 1")
def team_chart(spark: SparkSession, d: str) -> DataFrame:
    """Teams by work, most first, with bars against the largest; a person without splits counts for the record's own team."""
    records, some = _records(spark, d)
    teams = explorer.team_records(records, some, SPEC).groupBy("team").agg(F.count("*").alias("players"), F.sum("workload").alias("workload"))
    most = teams.agg(F.max("workload").alias("most"))
    return teams.crossJoin(most).select("team", "players", "workload", F.round(F.col("workload") / F.col("most"), 9).alias("bar")).orderBy(F.desc("workload"), "team")


@query("""SELECT user_id, count(*) AS entries, CAST(sum(event_id % 5) AS BIGINT) AS rounds, count(CASE WHEN event_id % 7 < 3 THEN 1 END) AS medals, count(CASE WHEN event_id % 7 = 0 THEN 1 END) AS gold, count(CASE WHEN event_id % 7 = 1 THEN 1 END) AS silver, count(CASE WHEN event_id % 7 = 2 THEN 1 END) AS bronze
FROM events WHERE event_type = 'click' GROUP BY 1""")
def event_log_selection(spark: SparkSession, d: str) -> DataFrame:
    medal = F.element_at(F.array(F.lit("Gold"), F.lit("Silver"), F.lit("Bronze"), *[F.lit(None).cast("string")] * 4), (F.col("event_id") % 7 + 1).cast("int"))
    log = t(spark, d, "events").select("user_id", "event_type", (F.col("event_id") % 5).alias("rounds"), medal.alias("medal"))
    return explorer.event_selection(log, "user_id", "event_type", "click")


@query("SELECT c_custkey, n_name AS place, r_name AS country, c_acctbal > 0 AS mapped FROM customer JOIN nation ON n_nationkey = c_custkey % 25 JOIN region ON n_regionkey = r_regionkey")
def location_lens_college(spark: SparkSession, d: str) -> DataFrame:
    n, r = t(spark, d, "nation"), t(spark, d, "region")
    home = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("birth_place"))
    college = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("college_id"), F.col("n_name").alias("college_place"), F.col("r_name").alias("college_country"))
    both = t(spark, d, "customer").withColumn("college_id", (F.col("c_custkey") % 25).cast("int")).join(home, "c_nationkey").join(college, "college_id").withColumn("college_mapped", F.col("c_acctbal") > 0)
    lenses = {"birth": {"place": "birth_place"}, "college": {"place": "college_place", "country": "college_country", "mapped": "college_mapped"}}
    return explorer.location_lens(both, "college", lenses).select("c_custkey", "place", "country", "mapped")


@query("SELECT p_partkey FROM part WHERE (p_type IN ('ECONOMY', 'PROMO') OR p_brand IN ('ECONOMY', 'PROMO', 'Brand#3')) AND p_size >= 10 AND p_size < 25")
def participant_positions(spark: SparkSession, d: str) -> DataFrame:
    parts = t(spark, d, "part").withColumn("positions", F.array("p_type", "p_brand"))
    return explorer.participant_filter(parts, explorer.ExplorerQuery(low=10, high=25, positions=frozenset({"ECONOMY", "PROMO", "Brand#3"})), age="p_size").select("p_partkey")


@query("""WITH y AS (SELECT 'youngest' AS side, p_partkey, row_number() OVER (ORDER BY p_size, p_name || p_partkey) AS place FROM part), o AS (SELECT 'oldest' AS side, p_partkey, row_number() OVER (ORDER BY p_size DESC, p_name || p_partkey) AS place FROM part)
SELECT side, p_partkey, CAST(place AS INTEGER) AS place FROM (SELECT * FROM y UNION ALL SELECT * FROM o) WHERE place <= 10""")
def youngest_and_oldest(spark: SparkSession, d: str) -> DataFrame:
    named = t(spark, d, "part").withColumn("label", F.concat("p_name", F.col("p_partkey").cast("string")))
    return explorer.age_extremes(named, "p_size", "label", 10).select("side", "p_partkey", "place")


@query("""SELECT p_brand, median(p_size) AS median_age, count(CASE WHEN p_size < 23 THEN 1 END) AS young, count(CASE WHEN p_size >= 30 THEN 1 END) AS old, count(p_size) AS aged, count(DISTINCT nullif(p_type, '')) AS represented,
  100.0 * count(CASE WHEN p_size < 23 THEN 1 END) / count(p_size) AS young_pct, 100.0 * count(CASE WHEN p_size >= 30 THEN 1 END) / count(p_size) AS old_pct,
  CASE WHEN count(CASE WHEN p_retailprice > 950 THEN 1 END) > 0 THEN 100.0 * count(CASE WHEN p_retailprice > 950 AND p_type <> 'ECONOMY' THEN 1 END) / count(CASE WHEN p_retailprice > 950 THEN 1 END) ELSE 0 END AS outside_pct FROM part GROUP BY 1""")
def age_country_overview(spark: SparkSession, d: str) -> DataFrame:
    return explorer.age_overview(t(spark, d, "part"), "p_size", ["p_brand"], F.col("p_type") == "ECONOMY", F.col("p_retailprice") > 950, "p_type")


@query("""WITH c AS (SELECT 'c' || (c_custkey % 41) AS cell, count(*) AS people, sum(greatest(c_acctbal, 0)) AS pop FROM customer GROUP BY 1), r AS (SELECT cell, CASE WHEN pop > 0 THEN people / pop * 1000000.0 END AS rate, people % 2 = 0 AS stable FROM c)
SELECT cell, round(rate, 6) AS rate, stable FROM r WHERE rate IS NOT NULL ORDER BY stable DESC, rate DESC, cell LIMIT 12""")
def hotspots_stable_first(spark: SparkSession, d: str) -> DataFrame:
    cells = t(spark, d, "customer").groupBy(F.concat(F.lit("c"), (F.col("c_custkey") % 41).cast("string")).alias("cell")).agg(F.count("*").alias("people"), F.sum(F.greatest(F.col("c_acctbal"), F.lit(0.0))).alias("pop"))
    rated = cells.select("cell", metrics.per_million(F.col("people"), F.col("pop")).alias("rate"), (F.col("people") % 2 == 0).alias("stable"))
    return explorer.stable_first(rated, "rate", "cell", 12).withColumn("rate", F.round("rate", 6))


@query("""SELECT l_suppkey, CAST(sum(l_linenumber) AS BIGINT) AS starts, CAST(4 AS BIGINT) AS matches, CAST(44 AS BIGINT) AS expected_starts, CAST(sum(l_linenumber) - 44 AS BIGINT) AS difference FROM lineitem GROUP BY 1 HAVING sum(l_linenumber) <> 44""")
def lineup_identity(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").withColumn("matches", F.lit(4).cast("long"))
    return validate.lineup_identity(rows, ["l_suppkey"], "l_linenumber", "matches")


@query("""SELECT 'nations' AS name, (SELECT count(*) FROM nation) AS found, CAST(25 AS BIGINT) AS expected, (SELECT count(*) FROM nation) = 25 AS holds UNION ALL SELECT 'regions', (SELECT count(*) FROM region), 5, (SELECT count(*) FROM region) = 5
UNION ALL SELECT 'segments', (SELECT count(DISTINCT c_mktsegment) FROM customer), 4, (SELECT count(DISTINCT c_mktsegment) FROM customer) = 4""")
def exact_counts(spark: SparkSession, d: str) -> DataFrame:
    return validate.expect_counts({
        "nations": (t(spark, d, "nation"), F.count("*"), 25), "regions": (t(spark, d, "region"), F.count("*"), 5), "segments": (t(spark, d, "customer"), F.count_distinct("c_mktsegment"), 4),
    })


DASHBOARD_SQL = """d AS (SELECT CASE WHEN c_custkey % 40 = 0 THEN c_custkey + 1 ELSE c_custkey END AS id, CASE WHEN c_custkey % 33 = 0 THEN ' ' ELSE c_name END AS name, c_nationkey AS team, 2025 AS year, c_acctbal > 0 AS mapped,
  CASE WHEN c_custkey % 29 = 0 THEN 95.0 ELSE 10.0 END AS lat, CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE 20.0 END AS lon, c_mktsegment AS place, 'X' AS country, CASE WHEN c_custkey % 37 = 0 THEN -1.0 WHEN c_custkey % 43 = 0 THEN NULL ELSE c_custkey * 1.0 END AS load FROM customer)"""


@query(f"""WITH {DASHBOARD_SQL}, p AS (SELECT id, bool_or(mapped) AS m, sum(load) AS w FROM d GROUP BY 1), h AS (SELECT count(*) AS n, count(CASE WHEN m THEN 1 END) AS m, sum(w) AS w FROM p)
SELECT 'missing_identity' AS code, CAST(id AS VARCHAR) AS id FROM d WHERE trim(name) = '' UNION ALL SELECT 'invalid_coordinates', CAST(id AS VARCHAR) FROM d WHERE mapped AND (lat > 90 OR lon IS NULL) UNION ALL SELECT 'invalid_workload', CAST(id AS VARCHAR) FROM d WHERE load IS NULL OR load < 0
UNION ALL SELECT 'duplicate_contribution', CAST(id AS VARCHAR) FROM d GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'conflicting_geography', CAST(id AS VARCHAR) FROM d GROUP BY id HAVING count(DISTINCT struct_pack(a := mapped, b := coalesce(lat, -1), c := coalesce(lon, -1), d := place, e := country)) > 1
UNION ALL SELECT 'players_differ', NULL FROM h WHERE n <> 100 UNION ALL SELECT 'mapping_differs', NULL FROM h WHERE m <> 90 OR n - m <> 10 UNION ALL SELECT 'workload_differs', NULL FROM h WHERE abs(w - 1.0) > greatest(1e-6, abs(w) * 1e-9)""")
def dashboard_validation(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    records = t(spark, d, "customer").select(
        F.when(k % 40 == 0, k + 1).otherwise(k).alias("id"), F.when(k % 33 == 0, " ").otherwise(F.col("c_name")).alias("name"), F.col("c_nationkey").alias("team"), F.lit(2025).alias("year"), (F.col("c_acctbal") > 0).alias("mapped"),
        F.when(k % 29 == 0, 95.0).otherwise(10.0).alias("lat"), F.when(k % 31 != 0, 20.0).alias("lon"), F.col("c_mktsegment").alias("place"), F.lit("X").alias("country"),
        F.when(k % 37 == 0, -1.0).when(k % 43 != 0, k * 1.0).alias("load"),
    )
    summary = spark.range(1).select(F.lit(100).alias("players"), F.lit(90).alias("mapped_players"), F.lit(10).alias("unresolved_players"), F.lit(1.0).alias("load"))
    return validate.dashboard_issues(records, summary, "load")


@query("""SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS duplicated FROM lineitem""")
def duplicate_row_flags(spark: SparkSession, d: str) -> DataFrame:
    return validate.flag_duplicates(t(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("""WITH m AS (SELECT n_regionkey AS lang, n_nationkey // 5 AS key, 'text {a} ' || n_name AS text FROM nation), e AS (SELECT n_nationkey // 5 AS key, 'text {a}' AS en FROM nation WHERE n_regionkey = 0 AND n_nationkey < 20)
SELECT CAST(r_regionkey AS VARCHAR) AS language, 'k' || key AS key, 'missing_key' AS code FROM region, e WHERE NOT EXISTS (SELECT 1 FROM nation WHERE n_regionkey = r_regionkey AND n_nationkey // 5 = e.key AND NOT (r_regionkey = 2 AND n_nationkey // 5 = 1))
UNION ALL SELECT CAST(n_regionkey AS VARCHAR), 'k' || n_nationkey // 5, CASE WHEN n_nationkey // 5 = 4 THEN 'unknown_key' WHEN n_regionkey = 3 AND n_nationkey // 5 = 2 THEN 'empty_text' ELSE 'parameters_differ' END FROM nation
WHERE NOT (n_regionkey = 2 AND n_nationkey // 5 = 1) AND NOT (n_regionkey = 0 AND n_nationkey >= 20) AND (n_nationkey // 5 = 4 OR (n_regionkey = 3 AND n_nationkey // 5 = 2) OR (n_regionkey = 4 AND n_nationkey // 5 = 3))""")
def language_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Nations as messages: the region is the language, region 0 the English one."""
    lang, k = F.col("n_regionkey"), F.floor(F.col("n_nationkey") / 5)
    text = F.when((lang == 3) & (k == 2), " ").when((lang == 4) & (k == 3), "text {b}").otherwise("text {a}")
    messages = t(spark, d, "nation").where(~((lang == 2) & (k == 1)) & ~((lang == 0) & (F.col("n_nationkey") >= 20))).select(lang.cast("string").alias("language"), F.concat(F.lit("k"), k.cast("string")).alias("key"), text.alias("text"))
    return validate.language_issues(messages, "0")


@query("SELECT 'page-' || page_id AS path, CASE WHEN page_id % 5 = 0 THEN 'missing' ELSE 'stale' END AS status FROM pages WHERE page_id % 5 = 0 OR (page_id % 7 = 0 AND html IS NOT NULL)")
def stale_assets(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("path")
    made = t(spark, d, "pages").select(path, F.col("html").alias("content"), "page_id")
    published = made.where("page_id % 5 <> 0").select("path", F.when(F.col("page_id") % 7 == 0, F.concat("content", F.lit(" "))).otherwise(F.col("content")).alias("content"))
    return validate.stale_assets(made, published)


@query("""SELECT o_orderstatus || '-' || o_custkey AS player, count(*) AS matches, CAST(sum(o_orderkey % 5) AS BIGINT) AS sets, round(sum(o_totalprice), 2) AS points, string_agg(o_orderkey, ',' ORDER BY o_orderdate DESC, o_orderkey) AS log FROM orders GROUP BY 1""")
def match_log_totals(spark: SparkSession, d: str) -> DataFrame:
    """Sets and points per player within a gender (here the order's status), with the log of matches, latest first."""
    log = F.array_sort(F.collect_list(F.struct((-F.unix_seconds(F.col("o_orderdate").cast("timestamp"))).alias("late"), "o_orderkey")))
    return t(spark, d, "orders").groupBy(F.concat_ws("-", "o_orderstatus", F.col("o_custkey").cast("string")).alias("player")).agg(
        F.count("*").alias("matches"), F.sum(F.col("o_orderkey") % 5).alias("sets"), F.round(F.sum("o_totalprice"), 2).alias("points"), log.alias("log")
    ).withColumn("log", F.array_join(F.transform("log", lambda x: x["o_orderkey"].cast("string")), ","))


@query("""SELECT n_name AS team, CAST(sum(c) AS BIGINT) AS starts, count(DISTINCT CASE WHEN c > 0 THEN o_custkey END) AS unique_starters, count(DISTINCT y) AS tournaments, CAST(sum(CASE WHEN y = 1996 THEN c ELSE 0 END) AS BIGINT) AS starts_1996
FROM (SELECT o_custkey, year(o_orderdate) AS y, count(*) FILTER (WHERE o_orderstatus = 'F') AS c FROM orders GROUP BY 1, 2) JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey WHERE y IN (1995, 1996, 1997) GROUP BY 1""")
def dashboard_team_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("c")).where(F.col("y").isin(1995, 1996, 1997))
    named = rows.join(people(spark, d).select("id", F.col("country").alias("team")), F.col("o_custkey") == F.col("id"))
    return named.groupBy("team").agg(
        F.sum("c").alias("starts"), F.count_distinct(F.when(F.col("c") > 0, F.col("o_custkey"))).alias("unique_starters"), F.count_distinct("y").alias("tournaments"),
        F.sum(F.when(F.col("y") == 1996, F.col("c")).otherwise(0)).alias("starts_1996"),
    )


@query(f"""WITH p AS ({PEOPLE_SQL}) SELECT country AS college, count(*) AS players, round(sum(balance), 4) AS snaps, min_by(segment, id) AS status FROM p WHERE country NOT IN (SELECT country FROM p WHERE balance > 9990) GROUP BY 1""")
def unresolved_rollup(spark: SparkSession, d: str) -> DataFrame:
    p = people(spark, d)
    resolved = p.where("balance > 9990").select("country")
    return p.join(resolved, "country", "left_anti").groupBy(F.col("country").alias("college")).agg(F.count("*").alias("players"), F.round(F.sum("balance"), 4).alias("snaps"), F.min_by("segment", "id").alias("status"))


@query(f"""WITH s AS ({SPLITS_SQL}) SELECT id, min_by(team, struct_pack(a := conference, b := team)) AS first_team, string_agg(DISTINCT team, '; ' ORDER BY team) AS clubs, string_agg(DISTINCT conference, '; ' ORDER BY conference) AS leagues FROM s GROUP BY 1""")
def profile_rollup(spark: SparkSession, d: str) -> DataFrame:
    """One profile per person: the first value in the order of league and team, and sorted lists of both."""
    joined = lambda c: F.concat_ws("; ", F.array_sort(F.collect_set(c)))
    return splits(spark, d).groupBy("id").agg(F.min_by("team", F.struct("conference", "team")).alias("first_team"), joined("team").alias("clubs"), joined("conference").alias("leagues"))


@query("""WITH b AS (SELECT l_orderkey AS match, l_suppkey AS batter, l_partkey AS bowler, CAST(l_quantity AS BIGINT) % 7 AS runs, l_linenumber = 7 AS super_over, l_discount > 0.08 AS wide, l_discount > 0.06 AND l_discount <= 0.08 AS noball, CASE WHEN l_tax > 0.07 THEN 2 ELSE 0 END AS byes, l_returnflag = 'R' AS wicket, l_linestatus = 'O' AS runout FROM lineitem),
d AS (SELECT * FROM b WHERE NOT super_over)
SELECT id, CAST(sum(runs) AS BIGINT) AS runs, CAST(sum(fours) AS BIGINT) AS fours, CAST(sum(sixes) AS BIGINT) AS sixes, CAST(sum(faced) AS BIGINT) AS faced, CAST(sum(bowled) AS BIGINT) AS bowled, CAST(sum(conceded) AS BIGINT) AS conceded, CAST(sum(wickets) AS BIGINT) AS wickets FROM (
  SELECT 'b' || batter AS id, runs, (runs = 4)::BIGINT AS fours, (runs = 6)::BIGINT AS sixes, (NOT wide)::BIGINT AS faced, 0 AS bowled, 0 AS conceded, 0 AS wickets FROM d
  UNION ALL SELECT 'p' || bowler, 0, 0, 0, 0, (NOT wide AND NOT noball)::BIGINT, runs + (wide OR noball)::BIGINT, (wicket AND NOT runout)::BIGINT FROM d) GROUP BY 1""")
def ball_by_ball_totals(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries as runs and boundaries of the batter (wides are not faced) and balls, runs conceded (all but byes) and wickets (run-outs are not the bowler's); super overs are out."""
    runs, wide = F.col("l_quantity").cast("long") % 7, F.col("l_discount") > 0.08
    noball = (F.col("l_discount") > 0.06) & (F.col("l_discount") <= 0.08)
    byes = F.when(F.col("l_tax") > 0.07, 2).otherwise(0).cast("long")
    # the delivery's total holds extras and byes
    balls = t(spark, d, "lineitem").where("l_linenumber <> 7").select(
        "l_suppkey", "l_partkey", runs.alias("runs"), wide.alias("wide"), noball.alias("noball"), byes.alias("byes"), (runs + (wide | noball).cast("long") + byes).alias("total"), ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") != "O")).alias("wicket")
    )
    return metrics.deliveries(balls, F.concat(F.lit("b"), F.col("l_suppkey").cast("string")), F.concat(F.lit("p"), F.col("l_partkey").cast("string")))


@query("""WITH r AS (SELECT DISTINCT event_type AS event, user_id, CAST(ts AS DATE) AS race, value AS mark, CASE WHEN event_id % 97 < 4 THEN event_id % 97 END AS place FROM events WHERE value IS NULL OR value >= 5),
e AS (SELECT user_id, event, count(*) AS rounds, min(CASE WHEN place > 0 THEN place END) AS best, min(CASE WHEN place BETWEEN 1 AND 3 AND dayofmonth(race) % 5 = 0 THEN place END) AS medal FROM r GROUP BY 1, 2)
SELECT user_id, count(*) AS entries, CAST(sum(rounds) AS BIGINT) AS rounds, min(best) AS best_place, count(medal) AS medals, count(CASE WHEN medal = 1 THEN 1 END) AS gold, count(CASE WHEN medal = 2 THEN 1 END) AS silver, count(CASE WHEN medal = 3 THEN 1 END) AS bronze FROM e GROUP BY 1""")
def entries_rounds_medals(spark: SparkSession, d: str) -> DataFrame:
    """Races told twice count once; a medal is the best podium place of a final (here every fifth day)."""
    place = F.when(F.col("event_id") % 97 < 4, F.col("event_id") % 97)
    raw = t(spark, d, "events").select(
        F.col("event_type").alias("event"), "user_id", F.to_date("ts").alias("race"), F.col("value").alias("mark"), place.alias("place"), F.when(F.col("value") < 5, "DNS").alias("status")
    ).withColumn("final", F.dayofmonth("race") % 5 == 0)
    return metrics.entries_and_medals(raw, "user_id", "event", ["race", "mark"])


@query("SELECT event_id, coalesce(value, 0.0) AS minutes FROM events")
def workload_alias(spark: SparkSession, d: str) -> DataFrame:
    return explorer.with_workload(t(spark, d, "events"), explorer.EditionSpec("value")).select("event_id", "minutes")
