"""Set operations, semi- and anti-joins, and matches that leave ambiguity visible."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terravane.operators import joins
from terravane.operators.areas import point_in_polygon
from terravane.plans.catalog import query, t


@query("SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000)")
def semi_cohort(spark: SparkSession, d: str) -> DataFrame:
    rich = t(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_custkey").alias("o_custkey"))
    return t(spark, d, "orders").join(rich, "o_custkey", "left_semi").select("o_orderkey")


@query("SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 50)")
def anti_missing(spark: SparkSession, d: str) -> DataFrame:
    big = t(spark, d, "lineitem").where("l_quantity >= 50").select(F.col("l_partkey").alias("p_partkey"))
    return t(spark, d, "part").join(big, "p_partkey", "left_anti").select("p_partkey")


@query("SELECT c_custkey AS id, c_name AS name, 'customer' AS kind, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, 'supplier', NULL FROM supplier")
def union_by_name(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind"), F.col("c_mktsegment").alias("segment"))
    b = t(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal < 0 EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000")
def except_keys(spark: SparkSession, d: str) -> DataFrame:
    a, b = t(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("k")), t(spark, d, "supplier").where("s_acctbal > 9000").select("s_nationkey")
    return a.subtract(b)


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal < 0 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 0")
def intersect_keys(spark: SparkSession, d: str) -> DataFrame:
    a, b = t(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("k")), t(spark, d, "supplier").where("s_acctbal > 0").select("s_nationkey")
    return a.intersect(b)


@query("""WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal < 0 GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(a.n, 0) + coalesce(b.n, 0) AS n FROM a FULL JOIN b ON a.k = b.k""")
def upsert_counters(spark: SparkSession, d: str) -> DataFrame:
    a = t(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_nationkey").alias("k"))
    return a.unionByName(t(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))).groupBy("k").agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT p_brand, p_partkey, p_retailprice FROM part), r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS k FROM c) SELECT p_brand, p_partkey, p_retailprice FROM r WHERE k = 1""")
def candidate_argmax(spark: SparkSession, d: str) -> DataFrame:
    best = F.min(F.struct((-F.col("p_retailprice")).alias("w"), "p_partkey")).alias("best")
    return t(spark, d, "part").groupBy("p_brand").agg(best).select("p_brand", "best.p_partkey", (-F.col("best.w")).alias("p_retailprice"))


@query("""WITH r AS (SELECT s_nationkey, s_suppkey, s_acctbal, row_number() OVER w AS k, lead(s_acctbal) OVER w AS second FROM supplier WINDOW w AS (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey))
SELECT s_nationkey, s_suppkey, s_acctbal, second, second IS NULL OR (s_acctbal >= 5000 AND s_acctbal >= 1.5 * second) AS accepted FROM r WHERE k = 1""")
def candidate_dominance(spark: SparkSession, d: str) -> DataFrame:
    s = t(spark, d, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal")
    return joins.dominant_match(s, ["s_nationkey"], "s_acctbal", "s_suppkey", 5000, 1.5)


@query("""WITH p AS (SELECT s_nationkey AS k, count(DISTINCT s_suppkey) AS candidates, min(s_suppkey) AS only_one FROM supplier WHERE s_acctbal > 7000 GROUP BY 1)
SELECT c_custkey, coalesce(candidates, 0) AS candidates, CASE WHEN candidates IS NULL THEN 'unmatched' WHEN candidates = 1 THEN 'matched' ELSE 'ambiguous' END AS status, CASE WHEN candidates = 1 THEN only_one END AS s_suppkey FROM customer LEFT JOIN p ON c_nationkey = k""")
def unique_match_only(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("k"))
    s = t(spark, d, "supplier").where("s_acctbal > 7000").select(F.col("s_nationkey").alias("k"), "s_suppkey")
    return joins.unique_match(c, s, ["k"], "s_suppkey").drop("k")


@query("SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def many_to_one_join(spark: SparkSession, d: str) -> DataFrame:
    r = t(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return joins.many_to_one(t(spark, d, "nation"), r, ["n_regionkey"]).select("n_nationkey", "n_name", "r_name")


@query("""WITH n AS (SELECT c_custkey AS node, c_custkey // 2 AS parent, CASE WHEN c_acctbal > 8000 THEN c_acctbal END AS v FROM customer)
SELECT a.node, coalesce(a.v, b.v, c.v) AS resolved FROM n a LEFT JOIN n b ON a.parent = b.node LEFT JOIN n c ON b.parent = c.node""")
def parent_chain_fallback(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "customer").select(F.col("c_custkey").alias("node"), F.floor(F.col("c_custkey") / 2).alias("parent"), F.when(F.col("c_acctbal") > 8000, F.col("c_acctbal")).alias("v"))
    return joins.parent_chain(n, "node", "parent", "v", 2).select("node", "resolved")


@query("""SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size <= 45 UNION ALL SELECT p_partkey, 'override', p_retailprice + 1 FROM part WHERE p_size > 45""")
def override_merge(spark: SparkSession, d: str) -> DataFrame:
    base = t(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    new = t(spark, d, "part").where("p_size > 45").select("p_partkey", F.lit("override").alias("p_name"), (F.col("p_retailprice") + 1).alias("p_retailprice"))
    return joins.override(base, new, ["p_partkey"])


@query("""WITH e AS (SELECT event_id, user_id, event_type, ts, CAST(ts AS DATE) AS day FROM events)
SELECT a.event_id AS left_id, b.event_id AS right_id, abs(date_diff('day', a.day, b.day)) AS days FROM e a JOIN e b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase' AND abs(date_diff('day', a.day, b.day)) <= 2""")
def date_window_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Pairs at most two days apart: each left row is filed under its own and two days to either side, so the join is on equality."""
    e = t(spark, d, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))
    a = e.where("event_type = 'click'").select(F.col("event_id").alias("left_id"), "user_id", "day", F.explode(F.sequence(F.date_sub("day", 2), F.date_add("day", 2))).alias("near"))
    b = e.where("event_type = 'purchase'").select(F.col("event_id").alias("right_id"), F.col("user_id").alias("u"), F.col("day").alias("d2"))
    return a.join(b, (F.col("user_id") == F.col("u")) & (F.col("near") == F.col("d2"))).select("left_id", "right_id", F.abs(F.datediff("day", "d2")).cast("long").alias("days"))


@query("""WITH p AS (SELECT c_custkey AS point_id, (c_custkey * 37 % 1800) / 10.0 - 90 AS lat, (c_custkey * 101 % 3600) / 10.0 - 180 AS lon FROM customer),
b AS (SELECT n_nationkey AS code, n_nationkey * 14.0 - 180.05 AS x0, n_nationkey * 14.0 - 164.05 AS x1 FROM nation), h AS (SELECT point_id, count(*) AS hits, min(code) AS code FROM p JOIN b ON lon > x0 AND lon < x1 AND lat > -40.05 AND lat < 60.05 GROUP BY 1)
SELECT p.point_id, CASE WHEN hits = 1 THEN code END AS code, coalesce(hits, 0) AS hits FROM p LEFT JOIN h USING (point_id)""")
def spatial_point_in_polygon(spark: SparkSession, d: str) -> DataFrame:
    points = t(spark, d, "customer").select(F.col("c_custkey").alias("point_id"), ((F.col("c_custkey") * 37 % 1800) / 10.0 - 90).alias("lat"), ((F.col("c_custkey") * 101 % 3600) / 10.0 - 180).alias("lon"))
    x0, x1 = F.col("n_nationkey") * 14.0 - 180.05, F.col("n_nationkey") * 14.0 - 164.05
    corner = lambda x, y: F.struct(x.alias("lon"), F.lit(y).alias("lat"))
    areas = t(spark, d, "nation").select(F.col("n_nationkey").alias("code"), F.array(corner(x0, -40.05), corner(x1, -40.05), corner(x1, 60.05), corner(x0, 60.05)).alias("ring"))
    return point_in_polygon(points, areas)


@query("""WITH m AS (SELECT n_nationkey AS cell, unnest(range(n_nationkey * 5, n_nationkey * 5 + 8)) AS id FROM nation) SELECT cell, count(c_custkey) AS people, coalesce(sum(c_acctbal > 0), 0)::BIGINT AS mapped FROM m LEFT JOIN customer ON c_custkey = id GROUP BY cell""")
def array_membership_join(spark: SparkSession, d: str) -> DataFrame:
    cells = t(spark, d, "nation").select(F.col("n_nationkey").alias("cell"), F.explode(F.sequence(F.col("n_nationkey").cast("long") * 5, F.col("n_nationkey").cast("long") * 5 + 7)).alias("c_custkey"))
    return cells.join(t(spark, d, "customer").withColumn("here", F.lit(1)), "c_custkey", "left").groupBy("cell").agg(F.count("here").alias("people"), F.count_if(F.col("c_acctbal") > 0).alias("mapped"))


@query("SELECT o_custkey, min_by(o_orderkey, struct_pack(a := o_orderdate, b := o_orderkey)) AS first_order FROM orders GROUP BY 1")
def first_by_date(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.struct("o_orderdate", "o_orderkey"))["o_orderkey"].alias("first_order"))


@query("SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2")
def dedupe_keep_first(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey")
    return t(spark, d, "lineitem").withColumn("k", F.row_number().over(w)).where("k = 1").select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_flags(spark: SparkSession, d: str) -> DataFrame:
    from terravane.operators.validate import duplicates

    return duplicates(t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])
