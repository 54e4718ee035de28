"""Contribution queries: a customer is a person, a supplier's nation a team, quantity the workload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terravane.operators import explorer, joins, metrics
from terravane.plans.catalog import query, t
from terravane.streaming import incremental

SPLITS_SQL = """SELECT o_custkey AS id, n_name AS team, r_name AS conference, sum(l_quantity) AS workload, count(DISTINCT l_orderkey) AS games
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2, 3"""


def teams(spark: SparkSession, d: str) -> DataFrame:
    n, r = t(spark, d, "nation"), t(spark, d, "region")
    return t(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "s_suppkey", "s_acctbal", F.col("n_name").alias("team"), F.col("r_name").alias("conference")
    )


def splits(spark: SparkSession, d: str) -> DataFrame:
    """A person's work and games for each team. Lines are summed per order before people meet, so no distinct orders are held; both steps hold a bounded number of rows a task."""
    lines = t(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    orders = t(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("id"))
    n = lines.count()
    played = joins.dealt(lines.join(teams(spark, d), F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "team", "conference", "l_quantity"), n, "l_orderkey")
    games = played.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("l_orderkey", "id", "team", "conference").agg(F.sum("l_quantity").alias("workload"))
    return joins.dealt(games.drop("l_orderkey"), n, "id").groupBy("id", "team", "conference").agg(F.sum("workload").alias("workload"), F.count("*").alias("games"))


def people(spark: SparkSession, d: str) -> DataFrame:
    n, r = t(spark, d, "nation"), t(spark, d, "region")
    return t(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("n_name").alias("country"), F.col("r_name").alias("continent"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
    )


PEOPLE_SQL = """SELECT c_custkey AS id, c_name AS name, n_name AS country, r_name AS continent, c_mktsegment AS segment, c_acctbal AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@query(f"""WITH s AS ({SPLITS_SQL}), p AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY workload DESC, team) AS k FROM s)
SELECT id, sum(workload) AS workload, max(workload) AS primary_workload, max(CASE WHEN k = 1 THEN team END) AS primary_team, count(*) AS teams,
       max(workload) / sum(workload) AS primary_share FROM p GROUP BY id""")
def team_splits_primary(spark: SparkSession, d: str) -> DataFrame:
    out = metrics.split_totals(splits(spark, d), "id", "team", "workload", {})
    return out.withColumn("primary_share", F.col("primary_workload") / F.col("workload"))


@query(f"""WITH s AS ({SPLITS_SQL}), p AS ({PEOPLE_SQL})
SELECT count(DISTINCT p.id) AS players, count(DISTINCT CASE WHEN balance > 0 THEN p.id END) AS mapped, sum(workload) AS workload,
       sum(CASE WHEN balance > 0 THEN workload ELSE 0 END) AS mapped_workload, count(DISTINCT country) AS countries, count(DISTINCT team) AS teams,
       100.0 * count(DISTINCT CASE WHEN balance > 0 THEN p.id END) / count(DISTINCT p.id) AS coverage_pct
FROM s JOIN p ON s.id = p.id""")
def snapshot_summary_kpis(spark: SparkSession, d: str) -> DataFrame:
    mapped = F.col("balance") > 0
    return splits(spark, d).join(people(spark, d), "id").agg(
        F.count_distinct("id").alias("players"), F.count_distinct(F.when(mapped, F.col("id"))).alias("mapped"), F.sum("workload").alias("workload"),
        F.sum(F.when(mapped, F.col("workload")).otherwise(0)).alias("mapped_workload"), F.count_distinct("country").alias("countries"),
        F.count_distinct("team").alias("teams"),
        (F.lit(100.0) * F.count_distinct(F.when(mapped, F.col("id"))) / F.count_distinct("id")).alias("coverage_pct"),
    )


@query("""WITH p AS (SELECT n_name AS team, sum(CASE WHEN s_acctbal > 0 THEN s_acctbal ELSE 0 END) AS population FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
m AS (SELECT n_name AS team, l_returnflag AS area, count(DISTINCT CASE WHEN l_quantity > 25 THEN l_suppkey END) AS people, sum(l_quantity) AS starts, sum(l_linenumber) AS subs
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)
SELECT team, area, people, starts, CAST(subs AS BIGINT) AS subs, round(CASE WHEN population > 0 THEN starts / population * 1000000.0 END, 4) AS starts_per_million FROM m LEFT JOIN (SELECT * FROM p WHERE team <> 'NATION_3') p USING (team)""")
def area_metrics_per_million(spark: SparkSession, d: str) -> DataFrame:
    who = teams(spark, d)
    lines = t(spark, d, "lineitem").select("l_suppkey", "l_quantity", "l_linenumber", F.col("l_returnflag").alias("area"))
    facts = lines.join(who, F.col("l_suppkey") == F.col("s_suppkey")).withColumn("person", F.when(F.col("l_quantity") > 25, F.col("l_suppkey")))
    m = metrics.area_metrics(facts, "team", ["area"], "person", "l_quantity", "l_linenumber")
    # one team has no population on purpose: its areas stay, without a rate
    pop = who.where("team <> 'NATION_3'").groupBy("team").agg(F.sum(F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).otherwise(0)).alias("population"))
    return m.join(pop, "team", "left").select("team", "area", "people", "starts", "subs", F.round(metrics.per_million(F.col("starts"), F.col("population")), 4).alias("starts_per_million"))


@query(f"""WITH s AS ({SPLITS_SQL}), c AS (SELECT team, country, sum(workload) AS w FROM s JOIN ({PEOPLE_SQL}) p ON s.id = p.id GROUP BY 1, 2),
x AS (SELECT team, w / sum(w) OVER (PARTITION BY team) AS share FROM c) SELECT team, round(sum(share * share), 9) AS hhi FROM x GROUP BY team""")
def hhi_by_group(spark: SparkSession, d: str) -> DataFrame:
    c = splits(spark, d).join(people(spark, d), "id").groupBy("team", "country").agg(F.sum("workload").alias("w"))
    return metrics.hhi(c, "team", "w").select("team", F.round("hhi", 9).alias("hhi"))


@query("""WITH f AS (SELECT r_name, n_name, year(l_shipdate) AS y, l_quantity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT CASE WHEN grouping(n_name) = 1 THEN 'region' ELSE 'nation' END AS level, r_name AS region, n_name AS nation, sum(l_quantity) AS starts, CAST(min(y) AS INTEGER) AS period_start, CAST(max(y) AS INTEGER) AS period_end FROM f GROUP BY GROUPING SETS ((r_name, n_name), (r_name))""")
def two_level_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Both levels of areas in one pass, with the period that each group's rows cover."""
    lines = t(spark, d, "lineitem").select("l_suppkey", "l_quantity", F.year("l_shipdate").alias("y"))
    facts = lines.join(teams(spark, d), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("conference").alias("region"), F.col("team").alias("nation"), "l_quantity", "y")
    sets = [[F.col("region"), F.col("nation")], [F.col("region")]]
    return facts.groupingSets(sets, "region", "nation").agg(
        F.when(F.grouping("nation") == 1, "region").otherwise("nation").alias("level"), F.sum("l_quantity").alias("starts"), F.min("y").alias("period_start"), F.max("y").alias("period_end")
    )


@query("""WITH g AS (SELECT n_name AS team, y FROM nation CROSS JOIN (SELECT unnest(range(1992, 2002)) AS y)),
o AS (SELECT n_name AS team, year(o_orderdate) AS y, count(*) AS n, count(DISTINCT o_custkey) AS people FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT g.team, CAST(g.y AS INTEGER) AS y, coalesce(n, 0) AS n, coalesce(people, 0) AS people, coalesce(n, 0) > 0 AS covered, coalesce(n, 0) - 11 AS difference FROM g LEFT JOIN o ON g.team = o.team AND g.y = o.y""")
def coverage_grid(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders").join(people(spark, d), F.col("o_custkey") == F.col("id")).groupBy(F.col("country").alias("team"), F.year("o_orderdate").alias("y")).agg(
        F.count("*").alias("n"), F.count_distinct("id").alias("people")
    )
    years = spark.range(1992, 2002).select(F.col("id").cast("int").alias("y"))
    grid = joins.densify(t(spark, d, "nation").select(F.col("n_name").alias("team")), years, o, ["team", "y"], ["n", "people"])
    return grid.withColumn("covered", F.col("n") > 0).withColumn("difference", F.col("n") - 11)


@query(f"""WITH p AS ({PEOPLE_SQL}), o AS (SELECT o_custkey AS id, count(*) AS starts, max(CASE WHEN balance > 0 THEN 1 ELSE 0 END) AS m, min(country) AS country FROM orders JOIN p ON o_custkey = p.id GROUP BY 1)
SELECT country AS team, count(*) AS players, CAST(sum(m) AS BIGINT) AS mapped, CAST(sum(starts) AS BIGINT) AS starts, CAST(sum(CASE WHEN m = 1 THEN starts ELSE 0 END) AS BIGINT) AS mapped_starts, 100.0 * sum(m) / count(*) AS pct FROM o GROUP BY 1""")
def coverage_by_team(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders").join(people(spark, d), F.col("o_custkey") == F.col("id")).groupBy("id", "country").agg(F.count("*").alias("starts"), F.bool_or(F.col("balance") > 0).alias("m"))
    return o.groupBy(F.col("country").alias("team")).agg(
        F.count("*").alias("players"), F.count_if("m").alias("mapped"), F.sum("starts").alias("starts"),
        F.sum(F.when(F.col("m"), F.col("starts")).otherwise(0)).alias("mapped_starts"), (F.lit(100.0) * F.count_if("m") / F.count("*")).alias("pct"),
    )


@query(f"""SELECT continent, country, count(DISTINCT id) AS players, string_agg(DISTINCT segment, ', ' ORDER BY segment) AS segments FROM ({PEOPLE_SQL}) GROUP BY 1, 2""")
def place_summary_sorted_join(spark: SparkSession, d: str) -> DataFrame:
    return people(spark, d).groupBy("continent", "country").agg(
        F.count_distinct("id").alias("players"), F.concat_ws(", ", F.array_sort(F.collect_set("segment"))).alias("segments")
    )


@query(f"""SELECT id, name, country, balance FROM ({PEOPLE_SQL}) WHERE country IN ('FRANCE', 'GERMANY', 'NATION_1', 'NATION_2') OR (segment = 'BUILDING' AND balance >= 1000 AND balance < 5000)""")
def filtered_records(spark: SparkSession, d: str) -> DataFrame:
    p = people(spark, d)
    chosen = F.col("country").isin("FRANCE", "GERMANY", "NATION_1", "NATION_2")
    band = (F.col("segment") == "BUILDING") & (F.col("balance") >= 1000) & (F.col("balance") < 5000)
    return p.where(chosen | band).select("id", "name", "country", "balance")


SPEC = explorer.EditionSpec(workload="workload", sum_stats=("games",))


@query(f"""WITH s AS ({SPLITS_SQL}), r AS (SELECT min(r_name) AS a FROM region), f AS (SELECT * FROM s WHERE conference = (SELECT a FROM r)),
p AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY workload DESC, team) AS k FROM f)
SELECT id, sum(workload) AS workload, CAST(sum(games) AS BIGINT) AS games, max(CASE WHEN k = 1 THEN team END) AS primary_team FROM p GROUP BY id""")
def split_projection_filtered(spark: SparkSession, d: str) -> DataFrame:
    first = t(spark, d, "region").agg(F.min("r_name").alias("conference"))
    return explorer.project_splits(splits(spark, d).join(first, "conference", "left_semi"), SPEC, explorer.ExplorerQuery())


@query(f"""WITH s AS ({SPLITS_SQL}), p AS ({PEOPLE_SQL}) SELECT team, sum(workload) AS workload, count(DISTINCT s.id) AS players, count(DISTINCT CASE WHEN balance > 0 THEN s.id END) AS mapped,
count(DISTINCT country) AS countries, 100.0 * count(DISTINCT CASE WHEN balance > 0 THEN s.id END) / count(DISTINCT s.id) AS coverage_pct FROM s JOIN p ON s.id = p.id GROUP BY team""")
def team_coverage(spark: SparkSession, d: str) -> DataFrame:
    # a person has one row per team, so counts need no distinct
    return splits(spark, d).join(people(spark, d), "id").groupBy("team").agg(
        F.sum("workload").alias("workload"), F.count("*").alias("players"), F.count_if(F.col("balance") > 0).alias("mapped"),
        F.count_distinct("country").alias("countries"), (F.lit(100.0) * F.count_if(F.col("balance") > 0) / F.count("*")).alias("coverage_pct"),
    )


@query(f"""WITH r AS (SELECT *, rank() OVER (PARTITION BY segment ORDER BY balance DESC) AS place FROM ({PEOPLE_SQL})) SELECT id, min(place) AS best FROM r GROUP BY id HAVING min(place) <= 25""")
def rank_subset_min_rank(spark: SparkSession, d: str) -> DataFrame:
    ranked = people(spark, d).withColumn("place", F.rank().over(Window.partitionBy("segment").orderBy(F.desc("balance"))))
    # the bound holds for the least place if it holds for any, and before the group-by it limits what each task hands on
    return ranked.where("place <= 25").groupBy("id").agg(F.min("place").cast("long").alias("best"))


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(concat_ws(' ', p_name, p_brand, p_type)), 'brand#1')")
def search_contains(spark: SparkSession, d: str) -> DataFrame:
    return explorer.contains_text(t(spark, d, "part"), "Brand#1", ["p_name", "p_brand", "p_type"]).select("p_partkey", "p_name")


@query(f"""SELECT country, continent, count(DISTINCT p.id) AS players, count(*) AS orders, string_agg(DISTINCT segment, ',' ORDER BY segment) AS segments FROM ({PEOPLE_SQL}) p JOIN orders ON o_custkey = p.id GROUP BY 1, 2""")
def aggregate_places(spark: SparkSession, d: str) -> DataFrame:
    return people(spark, d).join(t(spark, d, "orders"), F.col("o_custkey") == F.col("id")).groupBy("country", "continent").agg(
        F.count_distinct("id").alias("players"), F.count("*").alias("orders"), F.array_join(F.array_sort(F.collect_set("segment")), ",").alias("segments")
    )


@query("""SELECT o_custkey AS id, count(*) AS contributions, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS kinds, max(o_orderdate) AS last_seen FROM orders GROUP BY 1""")
def aggregate_people(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count("*").alias("contributions"), F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("kinds"), F.max("o_orderdate").alias("last_seen")
    )


@query(f"SELECT country, count(*) AS players, count(CASE WHEN balance > 0 THEN 1 END) AS mapped FROM ({PEOPLE_SQL}) GROUP BY 1")
def aggregate_countries(spark: SparkSession, d: str) -> DataFrame:
    return people(spark, d).groupBy("country").agg(F.count("*").alias("players"), F.count_if(F.col("balance") > 0).alias("mapped"))


@query(f"""WITH c AS (SELECT country, segment, count(*) AS n FROM ({PEOPLE_SQL}) GROUP BY 1, 2) SELECT country, string_agg(segment || ':' || n, ',' ORDER BY n DESC, segment) AS bubbles, CAST(sum(n) AS BIGINT) AS players FROM c GROUP BY 1""")
def place_team_bubbles(spark: SparkSession, d: str) -> DataFrame:
    c = people(spark, d).groupBy("country", "segment").agg(F.count("*").alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "segment")))
    return c.groupBy("country").agg(F.array_join(F.transform(ordered, lambda x: F.concat(x["segment"], F.lit(":"), (-x["k"]).cast("string"))), ",").alias("bubbles"), F.sum("n").alias("players"))


@query(f"""WITH c AS (SELECT segment, country, count(*) AS n FROM ({PEOPLE_SQL}) GROUP BY 1, 2), p AS (SELECT segment, n / sum(n) OVER (PARTITION BY segment) AS p FROM c)
SELECT segment, count(*) AS categories, round(CASE WHEN count(*) > 1 THEN 100 * sum(-p * ln(p)) / ln(count(*)) ELSE 0 END, 6) AS diversity FROM p GROUP BY segment""")
def group_diversity_entropy(spark: SparkSession, d: str) -> DataFrame:
    c = people(spark, d).groupBy("segment", "country").agg(F.count("*").alias("n"))
    return metrics.normalised_entropy(c, "segment", "n").withColumn("diversity", F.round("diversity", 6))


@query(f"""WITH s AS ({SPLITS_SQL}), p AS ({PEOPLE_SQL}), j AS (SELECT s.*, p.continent, p.balance FROM s JOIN p ON s.id = p.id)
SELECT conference, count(DISTINCT id) AS players, sum(workload) AS workload, round(100.0 * sum(CASE WHEN continent <> conference THEN workload ELSE 0 END) / sum(workload), 6) AS outside_pct FROM j GROUP BY 1""")
def conference_comparison(spark: SparkSession, d: str) -> DataFrame:
    j = splits(spark, d).join(people(spark, d), "id")
    away = F.sum(F.when(F.col("continent") != F.col("conference"), F.col("workload")).otherwise(0))
    return j.groupBy("conference").agg(F.count_distinct("id").alias("players"), F.sum("workload").alias("workload"), F.round(F.lit(100.0) * away / F.sum("workload"), 6).alias("outside_pct"))


@query(f"""WITH s AS ({SPLITS_SQL}), c AS (SELECT conference, country, sum(workload) AS w FROM s JOIN ({PEOPLE_SQL}) p ON s.id = p.id GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY conference ORDER BY w DESC, country) AS place FROM c) SELECT conference, country, w, CAST(place AS INTEGER) AS place FROM r WHERE place <= 5""")
def topn_per_group(spark: SparkSession, d: str) -> DataFrame:
    c = splits(spark, d).join(people(spark, d), "id").groupBy("conference", "country").agg(F.sum("workload").alias("w"))
    return c.withColumn("place", F.row_number().over(Window.partitionBy("conference").orderBy(F.desc("w"), "country"))).where("place <= 5")


@query("""WITH c AS (SELECT 'c' || (c_custkey % 97) AS cell, count(*) AS people, sum(CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END) AS pop FROM customer GROUP BY 1)
SELECT cell, people, round(CASE WHEN pop > 0 THEN people / pop * 1000000.0 END, 4) AS rate, people >= 2 AND pop >= 50000 AS stable FROM c""")
def cell_rates_stable(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "customer").groupBy(F.concat(F.lit("c"), (F.col("c_custkey") % 97).cast("string")).alias("cell")).agg(
        F.count("*").alias("people"), F.sum(F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).otherwise(0)).alias("pop")
    )
    return c.select("cell", "people", F.round(metrics.per_million(F.col("people"), F.col("pop")), 4).alias("rate"), ((F.col("people") >= 2) & (F.col("pop") >= 50000)).alias("stable"))


@query("SELECT l_returnflag AS g, median(l_quantity) AS med, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(quantile_cont(l_extendedprice, 0.75), 4) AS q75 FROM lineitem GROUP BY 1")
def median_and_linear_quantiles(spark: SparkSession, d: str) -> DataFrame:
    rows = t(spark, d, "lineitem").select(F.col("l_returnflag").alias("g"), "l_quantity", "l_extendedprice")
    middle = metrics.linear_quantiles(rows, "g", "l_quantity", {"med": 0.5}).withColumnRenamed("g", "_g")
    price = metrics.linear_quantiles(rows, "g", "l_extendedprice", {"q25": 0.25, "q75": 0.75}).withColumnRenamed("g", "_h")
    groups = rows.select("g").distinct()  # one without a value stays
    told = groups.join(middle, F.col("g").eqNullSafe(F.col("_g")), "left").join(price, F.col("g").eqNullSafe(F.col("_h")), "left")
    return told.select("g", "med", F.round("q25", 4).alias("q25"), F.round("q75", 4).alias("q75"))


@query("""WITH s AS (SELECT event_type AS g, list_sort(list(value)) AS v FROM events WHERE value IS NOT NULL GROUP BY 1)
SELECT g, v[CAST(floor((len(v) - 1) * 0.95 + 0.5) AS INTEGER) + 1] AS nearest, v[CAST(floor((len(v) - 1) * 0.95) AS INTEGER) + 1] AS floored FROM s""")
def quantile_nearest_and_floor(spark: SparkSession, d: str) -> DataFrame:
    named = {"nearest": (0.95, "nearest"), "floored": (0.95, "floor")}
    return metrics.ranked_quantiles(t(spark, d, "events").withColumn("g", F.col("event_type")), ["g"], "value", named)


@query("""WITH r AS (SELECT n_nationkey AS k, count(*) * 1.0 AS rate FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1), v AS (SELECT list_sort(list(rate)) AS v FROM r)
SELECT CAST(v[CAST(floor((len(v) - 1) * 0.25 + 0.5) AS INTEGER) + 1] AS DOUBLE) AS q25, CAST(v[CAST(floor((len(v) - 1) * 0.5 + 0.5) AS INTEGER) + 1] AS DOUBLE) AS q50,
CAST(v[CAST(floor((len(v) - 1) * 0.75 + 0.5) AS INTEGER) + 1] AS DOUBLE) AS q75, CAST(v[CAST(floor((len(v) - 1) * 0.95 + 0.5) AS INTEGER) + 1] AS DOUBLE) AS q95 FROM v""")
def rate_scale_stops(spark: SparkSession, d: str) -> DataFrame:
    r = t(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").cast("double").alias("rate"))
    return metrics.ranked_quantiles(r.withColumn("whole", F.lit(True)), ["whole"], "rate", {f"q{q}": (q / 100, "nearest") for q in (25, 50, 75, 95)}).drop("whole")


@query("""WITH k AS (SELECT event_type, value FROM events WHERE value IS NOT NULL), p AS (SELECT event_type, count(*) AS n, stddev_samp(value) AS sd, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM k GROUP BY 1),
w AS (SELECT event_type, n, CASE WHEN n < 2 THEN 1.2 ELSE least(2.5, greatest(0.75, 0.9 * (CASE WHEN iqr > 0 THEN least(sd, iqr / 1.34) WHEN sd > 0 THEN sd ELSE 1.5 END) * pow(n, -0.2))) END AS width FROM p),
g AS (SELECT unnest(range(0, 81)) AS i) SELECT event_type, CAST(i * 1.25 AS DOUBLE) AS x, round(avg(exp(-0.5 * pow((i * 1.25 - value) / width, 2))) / min(width) / sqrt(2 * pi()), 9) AS density FROM k JOIN w USING (event_type) CROSS JOIN g GROUP BY 1, 2""")
def kde_density(spark: SparkSession, d: str) -> DataFrame:
    return metrics.kde(t(spark, d, "events"), "event_type", "value", 0.0, 100.0, 81).withColumn("density", F.round("density", 9))


@query("""SELECT CASE WHEN p_size < 10 THEN 'U10' WHEN p_size < 20 THEN '10-19' WHEN p_size < 30 THEN '20-29' WHEN p_size < 40 THEN '30-39' ELSE '40+' END AS band, p_brand, count(*) AS n,
100.0 * count(*) / sum(count(*)) OVER (PARTITION BY p_brand) AS pct FROM part GROUP BY 1, 2""")
def value_bands(spark: SparkSession, d: str) -> DataFrame:
    edges = [("U10", None, 10), ("10-19", 10, 20), ("20-29", 20, 30), ("30-39", 30, 40), ("40+", 40, None)]
    b = t(spark, d, "part").withColumn("band", metrics.bands(F.col("p_size"), edges)).groupBy("band", "p_brand").agg(F.count("*").alias("n"))
    return b.withColumn("pct", F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy("p_brand")))


@query("""WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) AS k FROM c) SELECT l_suppkey, l_returnflag AS flag FROM r WHERE k = 1""")
def mode_lowest_tie(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "lineitem").groupBy("l_suppkey").agg(metrics.lowest_mode("l_returnflag").alias("flag"))


@query("""WITH r AS (SELECT l_suppkey AS id, l_returnflag = 'R' AS pitching, count(*) AS games, sum(l_quantity) AS load FROM lineitem GROUP BY 1, 2)
SELECT id, max(games) AS games, sum(load) AS workload, coalesce(max(CASE WHEN pitching THEN load END), 0) AS pitch_load FROM r GROUP BY id""")
def conditional_role_stats(spark: SparkSession, d: str) -> DataFrame:
    r = t(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("id"), (F.col("l_returnflag") == "R").alias("pitching")).agg(F.count("*").alias("games"), F.sum("l_quantity").alias("load"))
    return r.groupBy("id").agg(F.max("games").alias("games"), F.sum("load").alias("workload"), F.coalesce(F.max(F.when(F.col("pitching"), F.col("load"))), F.lit(0.0)).alias("pitch_load"))


@query("""SELECT user_id, count(*) AS starts, count(CASE WHEN event_type = 'purchase' THEN 1 END) AS medals, count(DISTINCT event_type) AS kinds, count(CASE WHEN value > 50 THEN 1 END) AS finishes FROM events GROUP BY 1""")
def event_type_counters(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").groupBy("user_id").agg(
        F.count("*").alias("starts"), F.count_if(F.col("event_type") == "purchase").alias("medals"), F.count_distinct("event_type").alias("kinds"), F.count_if(F.col("value") > 50).alias("finishes")
    )


@query("""WITH b AS (SELECT l_suppkey AS a, l_partkey AS b, l_quantity > 25 AS won FROM lineitem), s AS (SELECT 's' || a AS id, won FROM b UNION ALL SELECT 'p' || b, NOT won FROM b)
SELECT id, count(*) AS bouts, count(CASE WHEN won THEN 1 END) AS wins, count(CASE WHEN NOT won THEN 1 END) AS losses FROM s GROUP BY id""")
def two_sided_appearances(spark: SparkSession, d: str) -> DataFrame:
    b = t(spark, d, "lineitem").select("l_suppkey", "l_partkey", (F.col("l_quantity") > 25).alias("won"))
    sides = F.inline(F.array(F.struct(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("id"), F.col("won").alias("w")), F.struct(F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("id"), (~F.col("won")).alias("w"))))
    return b.select(sides).groupBy("id").agg(F.count("*").alias("bouts"), F.count_if("w").alias("wins"), F.count_if(~F.col("w")).alias("losses"))


@query("""WITH s AS (SELECT l_orderkey AS id, l_suppkey AS team, sum(l_extendedprice) AS points FROM lineitem GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY points DESC, team) AS k, sum(points) OVER (PARTITION BY id) AS s FROM s)
SELECT id, team, round(points, 4) AS points, round(points + CASE WHEN k = 1 THEN coalesce(o_totalprice - s, 0) ELSE 0 END, 4) AS adjusted FROM r LEFT JOIN orders ON o_orderkey = id""")
def allocate_gap_to_primary(spark: SparkSession, d: str) -> DataFrame:
    s = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("team")).agg(F.sum("l_extendedprice").alias("points"))
    totals = t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    out = metrics.gap_to_primary(s, totals, "id", "team", "points", [F.desc("points"), F.asc("team")], "o_totalprice")
    return out.select("id", "team", F.round("points", 4).alias("points"), F.round("adjusted", 4).alias("adjusted"))


@query("""WITH e AS (SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day, value FROM events) SELECT user_id, count(DISTINCT event_type) AS entries, count(*) AS rounds, min(value) AS best FROM e GROUP BY 1""")
def dedupe_entries_rounds(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events").select("user_id", "event_type", F.to_date("ts").alias("day"), "value").distinct()
    return e.groupBy("user_id").agg(F.count_distinct("event_type").alias("entries"), F.count("*").alias("rounds"), F.min("value").alias("best"))


@query("""WITH m AS (SELECT DISTINCT l_orderkey AS pair, l_suppkey AS member FROM lineitem), n AS (SELECT pair, count(*) AS n FROM m GROUP BY 1)
SELECT member, round(sum(o_totalprice / n), 4) AS points, count(*) AS entries FROM m JOIN n USING (pair) JOIN orders ON o_orderkey = pair GROUP BY 1""")
def pair_allocation(spark: SparkSession, d: str) -> DataFrame:
    pairs = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("pair")).agg(F.collect_set("l_suppkey").alias("members"))
    each = pairs.join(t(spark, d, "orders"), F.col("o_orderkey") == F.col("pair")).select((F.col("o_totalprice") / F.size("members")).alias("share"), F.explode("members").alias("member"))
    return each.groupBy("member").agg(F.round(F.sum("share"), 4).alias("points"), F.count("*").alias("entries"))


@query("SELECT n_name, row_number() OVER (ORDER BY count(*) DESC, n_name) AS place, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY n DESC, n_name LIMIT 12")
def ranking_topk_tiebreak(spark: SparkSession, d: str) -> DataFrame:
    c = people(spark, d).groupBy(F.col("country").alias("n_name")).agg(F.count("*").alias("n"))
    # twelve rows stand in the window
    return explorer.top(c, "n", "n_name", 12).withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "n_name")).cast("long"))


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 100 OFFSET 100")
def paginate(spark: SparkSession, d: str) -> DataFrame:
    return explorer.page(t(spark, d, "customer"), [F.desc("c_acctbal"), F.asc("c_custkey")], 1, 100).select("c_custkey", "c_name")


@query("SELECT o_orderpriority, count(*) AS n, list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'], o_orderpriority) AS place FROM orders GROUP BY 1")
def custom_order_sort(spark: SparkSession, d: str) -> DataFrame:
    listed = F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    n = t(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return n.withColumn("place", F.nullif(F.array_position(listed, F.col("o_orderpriority")), F.lit(0).cast("long")).cast("int")).orderBy("place")


@query("SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def windowed_event_totals(spark: SparkSession, d: str) -> DataFrame:
    return incremental.windowed_totals(t(spark, d, "events")).withColumn("total", F.round("total", 4))


@query(f"""WITH a AS (SELECT country, count(*) AS n FROM ({PEOPLE_SQL}) WHERE segment = 'BUILDING' AND balance > 9000 GROUP BY 1), b AS (SELECT country, count(*) AS n FROM ({PEOPLE_SQL}) WHERE segment = 'MACHINERY' AND balance > 9000 GROUP BY 1)
SELECT coalesce(a.country, b.country) AS country, a.n AS left_n, b.n AS right_n, CASE WHEN a.n IS NULL OR b.n IS NULL THEN 'unavailable' ELSE 'both' END AS status FROM a FULL JOIN b ON a.country = b.country""")
def ab_compare_full_outer(spark: SparkSession, d: str) -> DataFrame:
    p = people(spark, d).where("balance > 9000")
    side = lambda s, n: p.where(F.col("segment") == s).groupBy("country").agg(F.count("*").alias(n))
    both = side("BUILDING", "left_n").join(side("MACHINERY", "right_n"), "country", "full")
    return both.withColumn("status", F.when(F.col("left_n").isNull() | F.col("right_n").isNull(), "unavailable").otherwise("both"))


@query(f"""WITH s AS ({SPLITS_SQL}) SELECT team, id, workload, workload / max(workload) OVER (PARTITION BY team) AS bar, workload / sum(workload) OVER (PARTITION BY team) AS share FROM s""")
def share_and_bar(spark: SparkSession, d: str) -> DataFrame:
    some = splits(spark, d).select("team", "id", "workload")
    # a row a team, joined back: no task holds a team's rows
    whole = some.groupBy("team").agg(F.max("workload").alias("most"), F.sum("workload").alias("whole"))
    return some.join(whole, "team").select("team", "id", "workload", (F.col("workload") / F.col("most")).alias("bar"), (F.col("workload") / F.col("whole")).alias("share"))
