"""Scans and sinks in pairs: rows of the driver's tables are written in a format, read back by the library's scan and returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.functions import scalar
from terravane.operators.lineage import shared_folder
from terravane.plans.catalog import query, t
from terravane.sources import files, markup


@query("""SELECT c_custkey, c_name, c_acctbal, ['csv', 'json', 'parquet', 'parquet'][c_custkey % 4 + 1] AS kind FROM customer UNION ALL SELECT c_custkey, c_name, c_acctbal, 'csv' FROM customer WHERE c_custkey % 4 = 3""")
def mixed_table_scan(spark: SparkSession, d: str) -> DataFrame:
    """CSV, JSON and Parquet files as one table; a quarter of the rows is written both as Parquet and as CSV."""
    path, k = shared_folder(spark, "mixed"), F.col("c_custkey")
    rows = t(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    rows.where(k % 4 == 0).write.option("header", "true").csv(f"{path}/csv")
    rows.where(k % 4 == 1).write.json(f"{path}/json")
    rows.where(k % 4 == 2).write.parquet(f"{path}/parquet")
    files.write_both(rows.where(k % 4 == 3), f"{path}/both")
    found = files.read_tables(spark, {"csv": [f"{path}/csv", f"{path}/both/csv"], "json": [f"{path}/json"], "parquet": [f"{path}/parquet", f"{path}/both/parquet"]})
    kind = F.regexp_extract("source_input_file", r"\.(csv|json|parquet)$", 1)
    return found.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", F.col("c_acctbal").cast("double").alias("c_acctbal"), kind.alias("kind"))


@query("SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = (SELECT min(o_orderstatus) FROM orders) THEN 1 ELSE 2 END AS run FROM orders")
def missing_partitions_written(spark: SparkSession, d: str) -> DataFrame:
    """The first run writes one status, the second all; the first one's partition stays."""
    path = shared_folder(spark, "partitions")
    orders = t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    first = orders.join(orders.agg(F.min("o_orderstatus").alias("o_orderstatus")), "o_orderstatus")
    for run, rows in ((1, first), (2, orders)):
        files.write_missing_partitions(rows.withColumn("run", F.lit(run)), path, ["o_orderstatus"])
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "run")


@query("""SELECT s_nationkey AS week, s_name AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'one' || chr(10) || 'two' ELSE 'a, "b"' END AS note FROM supplier""")
def reports_after_preamble(spark: SparkSession, d: str) -> DataFrame:
    """A report file for each nation: lines before the header, blank lines, and quoted fields with line ends."""
    path = f'{shared_folder(spark, "reports")}/files'
    note = F.when(F.col("s_suppkey") % 2 == 0, '"one\ntwo"').otherwise('"a, ""b"""')
    rows = t(spark, d, "supplier").select("s_nationkey", "s_suppkey", F.concat_ws(",", F.col("s_nationkey").cast("string"), "s_name", note).alias("row"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "row"))), lambda x: x["row"]), "\n\n")
    reports = rows.groupBy("s_nationkey").agg(F.concat(F.lit('﻿Report of the "week"\nWeek list,a\nweek,id,note\n'), listed).alias("value"))
    # a file ends with one line break more, which is a blank line
    reports.repartition("s_nationkey").write.partitionBy("s_nationkey").text(path)
    return files.csv_after_preamble(spark, path, "week,id,", "week long, id string, note string")


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'City ' || c_nationkey || ', ' || n_name WHEN 1 THEN 'a, , ' || n_name WHEN 2 THEN NULL ELSE n_name || '''s end' END AS place, CASE c_custkey % 4 WHEN 0 THEN 'Town ' || c_nationkey WHEN 3 THEN n_name END AS title
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def infobox_places(spark: SparkSession, d: str) -> DataFrame:
    """Birthplaces in wikitext: links with labels, flags, references, comments, tags, doubled commas and blanks."""
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    text = F.when(k % 4 == 0, F.concat(F.lit("{{flag|X}} [[Town "), n, F.lit("#History|'''City "), n, F.lit("''']]<ref name=\"a\">[[no]]</ref> , <!-- x -->"), "n_name"))
    text = text.when(k % 4 == 1, F.concat(F.lit("a,, "), "n_name")).when(k % 4 == 2, F.lit("  ")).otherwise(F.concat(F.lit("<small>[["), "n_name", F.lit("]]'s</small> end,")))
    doc = F.concat(F.lit("{{Infobox\n| name = x\n |Birth_place="), text, F.lit("\n| birth_place = other\n}}"))
    named = t(spark, d, "customer").join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select("c_custkey", markup.infobox_field(doc, "birth_place").alias("f")).select("c_custkey", F.col("f.text").alias("place"), F.col("f.title").alias("title"))


@query("""SELECT identifier, max_by(c_custkey, c_custkey) AS line, max_by(name, c_custkey) AS name FROM (SELECT c_custkey, CASE WHEN c_custkey % 10 > 0 THEN 'id' || c_custkey % 300 END AS identifier, c_name AS name FROM customer) WHERE identifier IS NOT NULL GROUP BY 1""")
def register_dimension(spark: SparkSession, d: str) -> DataFrame:
    """Identifiers with spaces around them that come again and again; the last line of each counts, blank ones are out."""
    k = F.col("c_custkey")
    identifier = F.when(k % 10 == 0, " ").otherwise(F.concat(F.when(k % 2 == 0, " ").otherwise(""), F.lit("id"), (k % 300).cast("string"), F.lit(" ")))
    return files.register(t(spark, d, "customer").select(identifier.alias("identifier"), k.alias("line"), F.concat(F.lit(" "), "c_name").alias("name")), "identifier", "line")


@query("""SELECT 'A' || n_nationkey AS code, n_name AS name, CAST(n_regionkey AS VARCHAR) AS adm0_code, CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 3 END AS rings, n_nationkey * 2.0::DOUBLE AS west FROM nation""")
def boundary_file_scan(spark: SparkSession, d: str) -> DataFrame:
    """A GeoJSON file of polygons with a hole and of several polygons; columns are found by their aliases."""
    path, k = f'{shared_folder(spark, "boundaries")}/files', F.col("n_nationkey")
    ring = lambda x: F.concat(F.lit("[["), x.cast("string"), F.lit(",0],["), (x + 1).cast("string"), F.lit(",0],["), (x + 1).cast("string"), F.lit(",1],["), x.cast("string"), F.lit(",0]]"))
    one = F.concat(F.lit('"Polygon","coordinates":['), ring(k * 2), F.lit(","), ring(k * 2), F.lit("]"))
    many = F.concat(F.lit('"MultiPolygon","coordinates":[['), ring(k * 2), F.lit(","), ring(k * 2), F.lit("],["), ring(k * 2 + 50), F.lit("]]"))
    feature = F.concat(F.lit('{"type":"Feature","properties":{"GID_1":"A'), k.cast("string"), F.lit('","NAME_1":"'), "n_name", F.lit('","GID_0":"'), F.col("n_regionkey").cast("string"), F.lit('"},"geometry":{"type":'), F.when(k % 2 == 0, one).otherwise(many), F.lit("}}"))
    doc = t(spark, d, "nation").agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("value"))
    doc.coalesce(1).write.text(path)
    found = files.read_boundaries(spark, path, "adm1", ["GID_1", "NAME_1", "GID_0"])
    return found.select("code", "name", "adm0_code", F.size("rings").alias("rings"), F.array_min(F.transform(F.flatten("rings"), lambda p: p["lon"])).alias("west"))


@query("SELECT c_custkey, c_name, c_mktsegment AS segment FROM customer WHERE c_custkey % 2 = 0")
def dashboard_document(spark: SparkSession, d: str) -> DataFrame:
    """Two versions of a document in parts; its readers see the later one whole."""
    path = shared_folder(spark, "document")
    rows = t(spark, d, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"))
    for some in (rows.where("c_custkey % 2 = 1"), rows.where("c_custkey % 2 = 0")):
        files.envelope(some, some.groupBy("segment").count(), some.where("false"), path)
    return files.read_envelope(spark, path, "records", "c_custkey long, c_name string, segment string")


@query("SELECT c_custkey, c_name, ['unresolved', 'ambiguous'][c_custkey % 2 + 1] AS queue FROM customer WHERE c_acctbal < 1000")
def review_queues(spark: SparkSession, d: str) -> DataFrame:
    """Review queues as CSV files, the empty one with its header too, read back as one table."""
    path = shared_folder(spark, "queues")
    rows = t(spark, d, "customer").where("c_acctbal < 1000").select("c_custkey", "c_name")
    files.queue_sinks({"unresolved": rows.where("c_custkey % 2 = 0"), "ambiguous": rows.where("c_custkey % 2 = 1"), "empty": rows.where("false")}, path)
    found = files.read_tables(spark, {"csv": [f"{path}/{q}" for q in ("unresolved", "ambiguous", "empty")]})
    return found.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", F.regexp_extract("source_input_file", r"/([^/]+)/[^/]+$", 1).alias("queue"))


@query("""SELECT 'Feature' AS type, '1:' || i || ':' || j AS cell, n AS people, 5 AS corners, j * 5.0::DOUBLE - 180 AS west FROM (SELECT c_custkey % 36 AS i, c_custkey % 72 AS j, count(*) AS n FROM customer GROUP BY 1, 2)""")
def geojson_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells as GeoJSON features, parsed back: rings are closed."""
    k = F.col("c_custkey")
    cells = t(spark, d, "customer").groupBy(F.concat_ws(":", F.lit(1), k % 36, k % 72).alias("cell")).agg(F.count("*").alias("people"))
    made = files.features(cells.withColumn("ring", F.slice(scalar.cell_ring(F.col("cell")), 1, 4)), "ring", ["cell", "people"])
    back = made.select(F.from_json("value", "type string, geometry struct<type: string, coordinates: array<array<array<double>>>>, properties struct<cell: string, people: bigint>").alias("f"))
    ring = F.get("f.geometry.coordinates", F.lit(0))
    return back.select("f.type", "f.properties.cell", "f.properties.people", F.size(ring).alias("corners"), F.array_min(F.transform(ring, lambda p: F.get(p, F.lit(0)))).alias("west"))


@query("""WITH l AS (SELECT p_partkey, p_name, p_brand, p_type, 'C' || (p_partkey % 7) AS code, p_size * 1000 AS population FROM part WHERE p_partkey % 6 > 0)
SELECT DISTINCT regexp_replace(lower(alias), '[^a-z0-9]', '', 'g') AS key, p_name AS name, code AS country_code, CASE WHEN p_partkey % 5 > 0 THEN population ELSE 0 END AS population, CAST(p_partkey AS VARCHAR) AS geonames_id FROM (SELECT *, unnest([p_name, p_brand, p_type, 'Ville ' || p_brand]) AS alias FROM l)""")
def gazetteer_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a gazetteer with listed aliases, short lines and blank populations -> its index of aliases."""
    k, none = F.col("p_partkey"), F.lit("")
    fields = [k.cast("string"), F.col("p_name"), F.col("p_brand"), F.concat("p_type", F.lit(",,Ville "), "p_brand"), F.lit("1.5"), F.lit("-2.5"), none, none, F.concat(F.lit("C"), (k % 7).cast("string")), none, F.lit("08"), none, none, none, F.when(k % 5 > 0, (F.col("p_size") * 1000).cast("string")).otherwise(""), none, none, none, none]
    line = F.when(k % 6 == 0, F.concat_ws("\t", *fields[:12])).otherwise(F.concat_ws("\t", *fields))
    return files.city_index(t(spark, d, "part").select(line.alias("line")), lambda c: scalar.normalize_key(c, ascii_only=True)).select("key", "name", "country_code", "population", "geonames_id")
