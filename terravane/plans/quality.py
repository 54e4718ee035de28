"""Validation and reconciliation queries, and scans of nested and marked-up text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terravane.operators import validate
from terravane.plans.catalog import query, t
from terravane.sources import files


@query("""SELECT 'error' AS severity, c_custkey, 'negative_balance' AS code, 'c_acctbal' AS "column", 'balance below zero' AS message FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'error', c_custkey, 'unknown_segment', 'c_mktsegment', 'segment outside the cohort' FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')
UNION ALL SELECT 'error', c_custkey, 'missing_value', 'c_name', 'no name' FROM customer WHERE c_name IS NULL OR trim(c_name) = ''""")
def validation_issues(spark: SparkSession, d: str) -> DataFrame:
    rules = [
        ("negative_balance", "c_acctbal", "balance below zero", F.col("c_acctbal") < 0),
        ("unknown_segment", "c_mktsegment", "segment outside the cohort", ~F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "AUTOMOBILE")),
        ("missing_value", "c_name", "no name", F.col("c_name").isNull() | (F.trim("c_name") == "")),
    ]
    return validate.issues(t(spark, d, "customer"), rules, "c_custkey").drop("value")


@query("""WITH a AS (SELECT l_orderkey AS k, sum(l_quantity) AS v FROM lineitem GROUP BY 1), b AS (SELECT l_orderkey AS k, sum(l_quantity) AS v FROM lineitem WHERE l_discount < 0.09 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, a.v AS left_value, b.v AS right_value FROM a FULL JOIN b ON a.k = b.k WHERE a.v IS NULL OR b.v IS NULL OR abs(a.v - b.v) > greatest(1e-6, abs(a.v) * 1e-9)""")
def reconcile_totals(spark: SparkSession, d: str) -> DataFrame:
    lines = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), "l_quantity", "l_discount")
    return validate.reconcile(lines, lines.where("l_discount < 0.09"), ["k"], "l_quantity")


@query("""WITH r AS (SELECT c_mktsegment AS g, c_custkey AS p, rank() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey) AS k FROM customer)
SELECT g, count(*) AS n, min(k) AS low, max(k) AS high, count(DISTINCT k) AS ranks, count(DISTINCT p) AS people, min(k) = 1 AND max(k) = count(*) AND count(DISTINCT k) = count(*) AND count(DISTINCT p) = count(*) AS contiguous FROM r GROUP BY g""")
def contiguous_ranks(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "customer").select(F.col("c_mktsegment").alias("g"), F.col("c_custkey").alias("p"), "c_nationkey")
    # a rank is one more than the rows before: counts per value stand in the window, not rows
    counts = c.groupBy("g", "c_nationkey").agg(F.count("*").alias("n"))
    before = Window.partitionBy("g").orderBy("c_nationkey").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("g", "c_nationkey", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1).alias("k"))
    return validate.contiguous_ranks(c.join(ranks, ["g", "c_nationkey"]), ["g"], "k", "p")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props_scan(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title, len(regexp_extract_all(html, '(?i)<a [^>]*href=\"([^\"]*)\"', 1)) AS links FROM pages")
def html_title_links(spark: SparkSession, d: str) -> DataFrame:
    links = F.size(F.regexp_extract_all("html", F.lit(r'(?i)<a [^>]*href="([^"]*)"'), 1))
    return t(spark, d, "pages").select("page_id", files.html_title(F.col("html")).alias("title"), links.cast("long").alias("links"))


@query("SELECT item_id, len(string_split(text, ' ')) AS words, text FROM benchmark")
def text_scan(spark: SparkSession, d: str) -> DataFrame:
    return t(spark, d, "benchmark").select("item_id", F.size(F.split("text", " ")).cast("long").alias("words"), "text")


@query("""SELECT c_mktsegment AS edition, count(*) AS participants, count(CASE WHEN c_acctbal > 0 THEN 1 END) AS mapped, count(CASE WHEN c_acctbal > 0 AND c_custkey % 3 > 0 THEN 1 END) AS birthplaces,
100.0 * count(CASE WHEN c_acctbal > 0 AND c_custkey % 3 > 0 THEN 1 END) / count(*) AS coverage, 100.0 * count(CASE WHEN c_acctbal > 0 THEN 1 END) / count(*) AS mapped_coverage FROM customer GROUP BY 1""")
def edition_catalog(spark: SparkSession, d: str) -> DataFrame:
    """A place that is no birthplace (here every third) counts as mapped, not as a birthplace."""
    mapped, born = F.count_if(F.col("c_acctbal") > 0), F.count_if((F.col("c_acctbal") > 0) & (F.col("c_custkey") % 3 > 0))
    pct = lambda n: F.lit(100.0) * n / F.count("*")
    return t(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("edition")).agg(
        F.count("*").alias("participants"), mapped.alias("mapped"), born.alias("birthplaces"), pct(born).alias("coverage"), pct(mapped).alias("mapped_coverage")
    )


@query("SELECT c_custkey, CASE WHEN c_acctbal IS NULL THEN 'unknown' WHEN c_acctbal < 0 THEN 'unresolved' WHEN c_acctbal < 1000 THEN 'fallback' ELSE 'resolved' END AS status FROM customer")
def nested_case_status(spark: SparkSession, d: str) -> DataFrame:
    b = F.col("c_acctbal")
    return t(spark, d, "customer").select("c_custkey", F.when(b.isNull(), "unknown").when(b < 0, "unresolved").when(b < 1000, "fallback").otherwise("resolved").alias("status"))


@query("SELECT DISTINCT n_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 1")
def dependent_options(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "nation").where("n_regionkey = 1")
    return t(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", "c_mktsegment").distinct()
