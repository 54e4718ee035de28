"""Validation rules as one pass over the rows, and reconciliations as aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def issues(df: DataFrame, rules: list[tuple[str, str, str, Column]], row: str, severity: str = "error") -> DataFrame:
    """(code, column, message, broken) rules -> one row per broken rule and row: severity, code, row, column, value, message."""
    each = [
        F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(column).alias("column"), F.col(column).cast("string").alias("value"), F.lit(message).alias("message")))
        for code, column, message, broken in rules
    ]
    return df.select(F.col(row), F.explode(F.array_compact(F.array(*each))).alias("i")).select(F.lit(severity).alias("severity"), row, "i.*")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    known = df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return known.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def contiguous_ranks(df: DataFrame, by: list[str], rank: str, person: str) -> DataFrame:
    """Whether the ranks of each group are exactly 1 to n over n different people."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.min(rank).alias("low"), F.max(rank).alias("high"), F.count_distinct(rank).alias("ranks"), F.count_distinct(person).alias("people")
    ).withColumn("contiguous", (F.col("low") == 1) & (F.col("high") == F.col("n")) & (F.col("ranks") == F.col("n")) & (F.col("people") == F.col("n")))


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], value: str, tolerance: float = 1e-9) -> DataFrame:
    """Keys whose sums differ by more than the greater of 1e-6 and ``tolerance`` of the value, or that one side lacks."""
    a = left.groupBy(*keys).agg(F.sum(value).alias("left_value"))
    b = right.groupBy(*keys).agg(F.sum(value).alias("right_value"))
    bound = F.greatest(F.lit(1e-6), F.abs("left_value") * tolerance)
    return a.join(b, keys, "full").where(F.col("left_value").isNull() | F.col("right_value").isNull() | (F.abs(F.col("left_value") - F.col("right_value")) > bound))


def lineup_identity(rows: DataFrame, by: list[str], starts: str, matches: str, players: int = 11) -> DataFrame:
    """Groups whose starts are not ``players`` times their matches; the matches of a group are one number told on every row."""
    out = rows.groupBy(*by).agg(F.sum(starts).alias("starts"), F.max(matches).alias("matches"))
    return out.withColumn("expected_starts", F.col("matches") * players).withColumn("difference", F.col("starts") - F.col("expected_starts")).where("difference <> 0")


def expect_counts(counts: dict[str, tuple[DataFrame, Column, int]]) -> DataFrame:
    """name -> (rows, aggregate, expected) -> (name, found, expected, holds), one row a name."""
    told = [df.agg(what.cast("long").alias("found")).select(F.lit(name).alias("name"), "found", F.lit(expected).cast("long").alias("expected")) for name, (df, what, expected) in sorted(counts.items())]
    return reduce(DataFrame.unionByName, told).withColumn("holds", F.col("found") == F.col("expected"))


def must_hold(checks: DataFrame, holds: str, name: str) -> DataFrame:
    """``checks`` unchanged; a row that does not hold fails the query when it runs, whichever columns are read."""
    failed = F.raise_error(F.concat(F.lit("check fails: "), F.coalesce(F.col(name).cast("string"), F.lit("null")))).cast("boolean")
    return checks.where(F.when(F.coalesce(F.col(holds), F.lit(False)), True).otherwise(failed))


def dashboard_issues(records: DataFrame, summary: DataFrame, workload: str, once: bool = True) -> DataFrame:
    """(code, id) of every breach in a dashboard's records (id, name, team, year, mapped, lat, lon, place, country, workload) and its summary.

    missing_identity, duplicate_contribution (the same id, team and year; with ``once`` also the same id), conflicting_geography (an id with several places), invalid_coordinates of a
    mapped row, invalid_workload (null, negative or not finite); against the summary (players, mapped_players, unresolved_players, workload): players_differ, mapping_differs and workload_differs beyond max(1e-6, 1e-9 of it).
    """
    load, lat, lon = F.col(workload), F.col("lat"), F.col("lon")
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    rules = [
        ("missing_identity", blank("id") | blank("name")),
        ("invalid_coordinates", F.coalesce(F.col("mapped"), F.lit(False)) & ~F.coalesce(lat.between(-90, 90) & lon.between(-180, 180) & ~F.isnan(lat) & ~F.isnan(lon), F.lit(False))),
        ("invalid_workload", load.isNull() | F.isnan(load) | (load < 0) | (load == float("inf"))),
    ]
    each = [F.when(broken, F.lit(code)) for code, broken in rules]
    row_issues = records.select(F.explode(F.array_compact(F.array(*each))).alias("code"), F.col("id").cast("string").alias("id"))
    same = records.groupBy("id", *([] if once else ["team", "year"])).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate_contribution").alias("code"), F.col("id").cast("string").alias("id"))
    place = F.struct("mapped", "lat", "lon", "place", "country")
    moved = records.groupBy("id").agg(F.count_distinct(F.to_json(place)).alias("n")).where("n > 1").select(F.lit("conflicting_geography").alias("code"), F.col("id").cast("string").alias("id"))
    people = records.groupBy("id").agg(F.bool_or(F.coalesce("mapped", F.lit(False))).alias("m"), F.sum(workload).alias("w"))
    whole = people.agg(F.count("*").alias("n"), F.count_if("m").alias("m"), F.coalesce(F.sum("w"), F.lit(0.0)).alias("w"))
    against = whole.crossJoin(summary.select(F.col("players").alias("p"), "mapped_players", "unresolved_players", F.col(workload).alias("s")))  # one row each
    differ = F.array_compact(F.array(
        F.when(F.col("n") != F.col("p"), F.lit("players_differ")),
        F.when((F.col("m") != F.col("mapped_players")) | (F.col("n") - F.col("m") != F.col("unresolved_players")), F.lit("mapping_differs")),
        F.when(F.abs(F.col("w") - F.col("s")) > F.greatest(F.lit(1e-6), F.abs("w") * 1e-9), F.lit("workload_differs")),
    ))
    return reduce(DataFrame.unionByName, [row_issues, same, moved, against.select(F.explode(differ).alias("code"), F.lit(None).cast("string").alias("id"))])


def language_issues(messages: DataFrame, english: str = "en", previews: tuple[str, ...] = ()) -> DataFrame:
    """(language, key, text) -> (language, key, code): missing_key, unknown_key, empty_text, parameters_differ against the English texts.

    A preview language may lack keys but those that start with ``template.``, ``action.`` or ``count.``.
    """
    base = messages.where(F.col("language") == english).select("key", F.col("text").alias("_en"))
    languages = messages.select("language").distinct()
    parts = lambda c: F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"\{(\w+)\}"), 1)))
    needed = F.col("key").rlike(r"^(template|action|count)\.") | ~F.col("language").isin(*previews) if previews else F.lit(True)
    missing = languages.crossJoin(base.select("key")).join(messages, ["language", "key"], "left_anti").where(needed).withColumn("code", F.lit("missing_key"))
    told = messages.join(base, "key", "left")
    empty = F.coalesce(F.trim("text"), F.lit("")) == ""
    code = F.when(F.col("_en").isNull(), "unknown_key").when(empty, "empty_text").when(parts(F.col("text")) != parts(F.col("_en")), "parameters_differ")
    return missing.select("language", "key", "code").unionByName(told.withColumn("code", code).where("code IS NOT NULL").select("language", "key", "code"))


def stale_assets(generated: DataFrame, published: DataFrame) -> DataFrame:
    """(path, content) of both sides -> (path, status): ``missing`` or ``stale`` where the published text is not the generated one."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    there = published.select("path", digest(F.col("content")).alias("_old"))
    status = F.when(F.col("_old").isNull(), "missing").when(F.col("_old") != F.col("_new"), "stale")
    return generated.select("path", digest(F.col("content")).alias("_new")).join(there, "path", "left").select("path", status.alias("status")).where("status IS NOT NULL")


def flag_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``duplicated``: whether another row has the same keys; rows with a null key are none."""
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    copies = df.where(known).groupBy(*keys).agg(F.count("*").alias("_copies"))
    return df.join(copies, keys, "left").withColumn("duplicated", F.coalesce(F.col("_copies") > 1, F.lit(False))).drop("_copies")
