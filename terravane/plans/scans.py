"""Scans of marked-up documents, made here from the driver's tables so that SQL over those tables tells the answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terravane.plans.catalog import query, t
from terravane.sources import markup


def _joined(df: DataFrame, by: str, line, order: str, mark: str) -> DataFrame:
    """One document per group: its lines in the order of ``order``."""
    lines = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l"))))
    return df.groupBy(by).agg(F.array_join(F.transform(lines, lambda x: x["l"]), mark).alias("body"))


@query("SELECT s_nationkey, s_name AS \"Name\", CAST(s_suppkey AS VARCHAR) AS \"No\", '<b>' AS note FROM supplier")
def html_table_scan(spark: SparkSession, d: str) -> DataFrame:
    """Header-driven rows of the right table of a page: columns stand in another order, cells hold markup, entities and a table of their own."""
    row = F.concat(F.lit("<tr><td>&lt;b&gt;<table><tr><td>inner</td></tr></table><td>"), "s_suppkey", F.lit("</td><td><i>"), "s_name", F.lit("</i> </td></tr>"))
    pages = _joined(t(spark, d, "supplier"), "s_nationkey", row, "s_suppkey", "\n")
    html = F.concat(F.lit("<table><tr><th>Other</th></tr><tr><td>1</td></tr></table><script>'<table>'</script><table><tr><th>Note<th>NO</th><th>name</th></tr>"), "body", F.lit("</table>"))
    found = pages.select("s_nationkey", F.explode(markup.table_records(markup.html_tables(html), ["Name", "No", "Note"])).alias("r"))
    return found.select("s_nationkey", F.col("r")["Name"].alias("Name"), F.col("r")["No"].alias("No"), F.col("r")["Note"].alias("note"))


@query("SELECT c_custkey, c_mktsegment AS position, CASE WHEN c_custkey % 2 = 0 THEN n_name END AS birthplace, CAST(c_custkey AS VARCHAR) AS ld FROM customer JOIN nation ON c_nationkey = n_nationkey")
def html_label_fields(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    place = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("<dt>Place of birth:</dt><dd> "), "n_name", F.lit("</dd>"))).otherwise("")
    html = F.concat(F.lit("<style>Position x</style><dl><dt>position</dt><dd><b>"), "c_mktsegment", F.lit("</b></dd>"), place, F.lit('</dl><script type="application/ld+json">{"id": "'), "c_custkey", F.lit('"}</script>'))
    pages = c.select("c_custkey", html.alias("html"))
    lines = pages.select("c_custkey", "html", markup.visible_lines("html").alias("lines"))
    return lines.select(
        "c_custkey", markup.label_value(F.col("lines"), "Position").alias("position"), markup.label_value(F.col("lines"), "Place of birth").alias("birthplace"),
        F.get_json_object(F.get(markup.json_ld(F.col("html")), F.lit(0)), "$.id").alias("ld"),
    )


@query("""SELECT n_regionkey, CAST(n_nationkey + 1 AS INTEGER) AS rank, n_name AS player, CAST(n_nationkey AS VARCHAR) AS player_id, 'ABC' AS country, CAST(n_nationkey * 1000 + 1000 AS BIGINT) AS points, CAST(n_nationkey % 7 AS BIGINT) AS tournaments FROM nation WHERE n_nationkey < 20""")
def markdown_ranking_scan(spark: SparkSession, d: str) -> DataFrame:
    n = t(spark, d, "nation")
    k = F.col("n_nationkey")
    row = F.concat(
        F.lit("| "), (k + 1).cast("string"), F.lit(" | ![Image 3: ABC](x) XYZ | ["), "n_name", F.lit("](https://host.com/player/"), k.cast("string"), F.lit('/name "x") | a | b | c | '),
        F.regexp_replace((k * 1000 + 1000).cast("string"), r"(\d)(\d{3})$", "$1,$2"), F.lit(" / "), (k % 7).cast("string"), F.lit(" |"),
    )
    docs = _joined(n, "n_regionkey", row, "n_nationkey", "\n").withColumn("body", F.concat(F.lit("# title\n| Rank | Country |\n|---|---|\n| 7 | short |\n"), "body"))
    found = markup.markdown_ranking(docs, "body", ["n_regionkey"], 20)
    return found.select("n_regionkey", "rank", F.col("players")[0]["name"].alias("player"), F.col("players")[0]["player_id"].alias("player_id"), F.col("countries")[0].alias("country"), "points", "tournaments")


@query("SELECT s_nationkey, lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS identifier, CAST(s_suppkey % 28 + 1 AS VARCHAR) AS day, 'MAR' AS month, '1999' AS year FROM supplier")
def pdf_text_scan(spark: SparkSession, d: str) -> DataFrame:
    """Dated identities in a document's extracted text."""
    line = F.concat(F.lit("12 Rider "), F.lpad(F.col("s_suppkey").cast("string"), 11, "0"), F.lit(" AUS "), (F.col("s_suppkey") % 28 + 1).cast("string"), F.lit(" MAR 1999 end"))
    docs = _joined(t(spark, d, "supplier"), "s_nationkey", line, "s_suppkey", "\n")
    return markup.text_rows(docs, "body", ["s_nationkey"], r"\b(\d{11})\s+[A-Z]{3}\s+(\d{1,2})\s+([A-Z]{3})\s+(\d{4})\b", ["identifier", "day", "month", "year"])


@query("SELECT s_suppkey // 10 AS page, CAST(s_suppkey % 10 * 3 AS BIGINT) AS line, CAST(s_suppkey AS VARCHAR) AS rank, 'Supplier ' || s_suppkey AS name FROM supplier")
def positioned_words_scan(spark: SparkSession, d: str) -> DataFrame:
    """Columns of a page told by the places of its words."""
    k = F.col("s_suppkey")
    top = (k % 10 * 9).cast("double")
    word = lambda x, shift, text: F.struct(F.lit(x).alias("x0"), (top + shift).alias("top"), text.alias("text"))
    words = t(spark, d, "supplier").select(F.floor(k / 10).alias("page"), F.explode(F.array(word(250.0, 1.0, k.cast("string")), word(80.0, 0.0, k.cast("string")), word(200.0, 2.0, F.lit("Supplier")))).alias("w")).select("page", "w.*")
    found = markup.positioned_rows(words, ["page"], {"rank": (70.0, 91.0), "name": (150.0, 300.0)}, "rank")
    return found.select("page", F.floor(F.col("top") / 3).alias("line"), "rank", "name")


@query("SELECT s_suppkey // 10 AS page, CAST(s_suppkey % 10 * 7 + 2.9::DOUBLE AS DOUBLE) AS top, CAST(s_suppkey AS VARCHAR) AS rank, s_suppkey % 10 || ' name' AS name FROM supplier")
def positioned_words_across_bands(spark: SparkSession, d: str) -> DataFrame:
    """Words a little above and below their rank's word, on either side of any fixed band, and others just out of reach."""
    k = F.col("s_suppkey")
    top = (k % 10 * 7).cast("double") + 2.9
    word = lambda x, shift, text: F.struct(F.lit(x).alias("x0"), (top + shift).alias("top"), text.alias("text"))
    placed = F.array(word(80.0, 0.0, k.cast("string")), word(160.0, -2.5, (k % 10).cast("string")), word(250.0, 0.2, F.lit("name")), word(260.0, 3.1, F.lit("below")), word(85.0, 3.3, F.lit("no-rank")))
    words = t(spark, d, "supplier").select(F.floor(k / 10).alias("page"), F.explode(placed).alias("w")).select("page", "w.*")
    return markup.positioned_rows(words, ["page"], {"rank": (70.0, 91.0), "name": (150.0, 300.0)}, "rank")


@query("SELECT n_regionkey, n_nationkey, n_name FROM nation")
def csv_text_scan(spark: SparkSession, d: str) -> DataFrame:
    row = F.concat_ws(",", F.col("n_nationkey").cast("string"), F.concat(F.lit('"'), "n_name", F.lit('"')))
    docs = _joined(t(spark, d, "nation"), "n_regionkey", row, "n_nationkey", "\r\n").withColumn("body", F.concat(F.lit("﻿key,name\r\n"), "body", F.lit("\r\n")))
    return markup.csv_rows(docs, "body", ["n_regionkey"], "n_nationkey int, n_name string")


@query("""SELECT s_nationkey, s_suppkey, 'line one' || chr(10) || 'said "' || s_suppkey || '", so' || CASE WHEN s_suppkey % 2 = 0 THEN chr(13) || chr(10) ELSE chr(10) END || 'end' AS note, CASE WHEN s_suppkey % 3 > 0 THEN s_name END AS name FROM supplier""")
def csv_quoted_records(spark: SparkSession, d: str) -> DataFrame:
    """Fields with line ends of both kinds, doubled quotes and commas inside quotes; every third name is empty."""
    k = F.col("s_suppkey").cast("string")
    mark = F.when(F.col("s_suppkey") % 2 == 0, "\r\n").otherwise("\n")
    row = F.concat(k, F.lit(',"line one\nsaid ""'), k, F.lit('"", so'), mark, F.lit('end",'), F.when(F.col("s_suppkey") % 3 > 0, F.col("s_name")).otherwise(""))
    docs = _joined(t(spark, d, "supplier"), "s_nationkey", row, "s_suppkey", "\n").withColumn("body", F.concat(F.lit('key,"a ""note""\nof two lines",name\n\n'), "body"))
    return markup.csv_rows(docs, "body", ["s_nationkey"], "s_suppkey long, note string, name string")


@query("SELECT CAST(row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS INTEGER) AS rank, s_suppkey AS player, s_name AS name, s_acctbal AS points FROM supplier QUALIFY rank <= 10")
def ranking_cohort_scan(spark: SparkSession, d: str) -> DataFrame:
    s = t(spark, d, "supplier")
    # ten rows stand in the window
    top = s.orderBy(F.desc("s_acctbal"), "s_suppkey").limit(10).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("s_acctbal"), "s_suppkey")))
    listed = top.select(F.lit("20251229").alias("ranking_date"), "rank", F.col("s_suppkey").alias("player"), F.col("s_acctbal").alias("points"))
    old = listed.withColumn("ranking_date", F.lit("20251222"))
    return markup.ranking_cohort(listed.unionByName(old), s.select(F.col("s_suppkey").alias("player_id"), F.col("s_name").alias("name")), "20251229", 10)


@query("SELECT p_type AS position, count(DISTINCT p_name) AS players, CAST(sum(p_size) AS BIGINT) AS starts, NULL AS birth_country FROM part GROUP BY 1 UNION ALL SELECT NULL, count(DISTINCT c_name), NULL, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def seed_demo(spark: SparkSession, d: str) -> DataFrame:
    """Two small summaries: players by position and by place."""
    positions = t(spark, d, "part").groupBy(F.col("p_type").alias("position")).agg(F.count_distinct("p_name").alias("players"), F.sum("p_size").alias("starts"))
    named = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    areas = named.groupBy(F.col("n_name").alias("birth_country")).agg(F.count_distinct("c_name").alias("players"))
    return positions.unionByName(areas, allowMissingColumns=True)
