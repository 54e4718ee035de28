"""Places of people by a gazetteer: names meet an inverted index of aliases, narrowed by country and first-level area."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def alias_index(places: DataFrame, key: Callable[[Column], Column], needed: DataFrame | None = None) -> DataFrame:
    """places (place_id, name, ascii_name, other_names: array or comma-separated text, ..) -> a row per place and different key of its names, with all its columns and ``key``.

    ``needed`` (key) limits the index to the keys that are asked for, before anything else is shuffled; blank keys are no alias.
    """
    others = F.col("other_names") if places.schema["other_names"].dataType.typeName() == "array" else F.split("other_names", ",")
    names = F.concat(F.array("name", "ascii_name"), F.coalesce(others, F.array().cast("array<string>")))
    rows = places.withColumn("key", F.explode(F.array_distinct(F.transform(F.array_compact(names), key)))).where("key <> ''")
    return rows if needed is None else rows.join(needed.select("key").distinct(), "key", "left_semi")


def country_index(countries: DataFrame, key: Callable[[Column], Column], more: dict[str, str] | None = None) -> DataFrame:
    """countries (code, iso3, fips, name, line) -> (country_key, country_code): later lines and later columns win, ``more`` (key -> code) over all."""
    names = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("alias")) for i, c in enumerate(("code", "iso3", "fips", "name"))])
    flat = countries.select(F.col("line").cast("long").alias("line"), "code", F.inline(names)).where("alias <> ''").withColumn("country_key", key(F.col("alias")))
    flat = flat.select("country_key", F.struct(F.lit(0).alias("last"), "line", "i", "code").alias("r"))
    if more:
        extra = countries.sparkSession.createDataFrame([(k, (1, 0, 0, v)) for k, v in sorted(more.items())], flat.schema)
        flat = flat.unionByName(extra)
    return flat.groupBy("country_key").agg(F.max("r")["code"].alias("country_code"))


def area_index(areas: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    """areas (code as ``country.area``, name, ascii_name, line) -> (country_code, area_key, admin1): the area's code and both names, later lines and columns win; codes without a point are left out."""
    country, code = F.substring_index("code", ".", 1), F.expr("substr(code, instr(code, '.') + 1)")
    rows = areas.where("contains(code, '.')").select(F.col("line").cast("long").alias("line"), country.alias("country_code"), code.alias("admin1"), "name", "ascii_name")
    names = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("alias")) for i, c in enumerate(("admin1", "name", "ascii_name"))])
    flat = rows.select("line", "country_code", "admin1", F.inline(names)).where("alias <> ''").withColumn("area_key", key(F.col("alias")))
    return flat.groupBy("country_code", "area_key").agg(F.max(F.struct("line", "i", "admin1"))["admin1"].alias("admin1"))


def resolve_places(requests: DataFrame, places: DataFrame, countries: DataFrame, key: Callable[[Column], Column], areas: DataFrame | None = None, request_id: str = "request_id") -> DataFrame:
    """requests (id, city, country, area) -> id, place_id, lat, lon, country_code, admin1, candidates: the most populous place of that name, or nulls.

    places: (place_id, name, ascii_name, other_names, country_code, admin1, population, lat, lon, line); countries: a ``country_index``; areas: an
    ``area_index``. A request whose country is unknown, or without a city, has no place. An area that the index knows in that country narrows the candidates to it; an
    unknown one is ignored. Without an index, areas of the United States alone count, as codes without case. Of equal populations the
    earlier line counts; a null population is 0.
    """
    asked = requests.select(request_id, key(F.col("city")).alias("key"), key(F.col("country")).alias("country_key"), F.coalesce("area", F.lit("")).alias("area")).where("key <> ''")
    asked = asked.join(countries, "country_key")
    if areas is None:
        asked = asked.withColumn("wanted", F.when((F.col("country_code") == "US") & (F.col("area") != ""), F.upper("area")))
        held = F.upper("p.admin1")
    else:
        asked = asked.withColumn("area_key", key(F.col("area"))).join(areas.withColumnRenamed("admin1", "wanted"), ["country_code", "area_key"], "left")
        held = F.col("p.admin1")
    order = F.struct(F.coalesce("population", F.lit(0)).alias("n"), (-F.col("line")).alias("l"), "place_id", "lat", "lon", "country_code", "admin1")
    # the best place of a name in each area is found before requests meet it, so a name of very many places is a few rows
    index = alias_index(places, key, asked).groupBy("key", "country_code", "admin1").agg(F.max(order).alias("b"), F.count("*").alias("m"))
    met = asked.alias("q").join(index.alias("p"), (F.col("q.key") == F.col("p.key")) & (F.col("q.country_code") == F.col("p.country_code")))
    fits = met.where(F.col("wanted").isNull() | (held == F.col("wanted")))
    best = fits.groupBy(request_id).agg(F.max("p.b").alias("b"), F.sum("p.m").alias("candidates"))
    found = best.select(request_id, "b.place_id", F.round("b.lat", 6).alias("lat"), F.round("b.lon", 6).alias("lon"), "b.country_code", "b.admin1", "candidates")
    return requests.select(request_id).join(found, request_id, "left").withColumn("candidates", F.coalesce("candidates", F.lit(0)).cast("long"))
