"""Canonical player-season rows from incoming tables, with every validation issue and the source values that were changed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.functions.scalar import season_end_year, season_label, stable_id

# The seasons in scope, the canonical columns and their aliases, and the codes of the issues below.
SEASONS = (2000, 2026)
CANONICAL = ("team", "fifa_code", "season", "season_end_year", "player_id", "player_name", "player_url", "starts", "sub_appearances", "goals", "position_source", "source_url", "retrieved_at")
REQUIRED = ("team", "fifa_code", "season", "season_end_year", "player_id", "player_name", "starts", "sub_appearances")
WHOLE = ("season_end_year", "starts", "sub_appearances", "goals", "expected_matches")
COUNTS = ("starts", "sub_appearances", "goals", "expected_matches")
ALIASES = {
    "country": "team", "squad": "team", "code": "fifa_code", "player": "player_name", "name": "player_name", "a": "starts", "s": "sub_appearances",
    "subs": "sub_appearances", "substitutions": "sub_appearances", "g": "goals", "position": "position_source", "profile_url": "player_url",
}
OUTPUT = ["severity", "code", "row_number", "column", "value", "message"]


class ClashingColumns(ValueError):
    """Columns that are one after trimming their names."""


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def _kept_source(data: DataFrame, name: str, changed: Column, source: Column) -> DataFrame:
    """Adds the source text of all rows if any row is changed, nulls otherwise; whether one is, is one row joined to all."""
    any_changed = data.agg(F.coalesce(F.bool_or(changed), F.lit(False)).alias("_any"))
    return data.crossJoin(any_changed).withColumn(name, F.when(F.col("_any"), source)).drop("_any")


def normalize_player_seasons(df: DataFrame, cohort: DataFrame, row: str = "row_number") -> tuple[DataFrame, DataFrame]:
    """Incoming rows (all text columns, and ``row``, the input's row number) and the cohort (team, fifa_code) -> canonical rows, issues.

    Aliases fill canonical columns that are absent, null or blank, and stay themselves. Teams are compared without case and written as the cohort writes them, codes in upper case; the other of
    team and code, and of season and end year, is derived where its column is absent. ``team_source`` and ``season_source`` keep the source text of tables that lack such a column: of all rows
    once one is rewritten, and nulls where none is. An absent column that is required is one issue without a row number. Nothing is dropped: a row with issues stays in the canonical rows.
    """
    trimmed = [c.strip() for c in df.columns]
    if len(set(trimmed)) != len(trimmed):
        raise ClashingColumns(", ".join(sorted(c for c in trimmed if trimmed.count(c) > 1)))
    data = df.toDF(*trimmed)
    data = data.select(*[F.col(f"`{c}`") if c == row else F.col(f"`{c}`").cast("string").alias(c) for c in trimmed])
    by_lower = {c.lower(): c for c in data.columns}
    for alias, name in ALIASES.items():
        if alias in by_lower:
            source = F.col(f"`{by_lower[alias]}`")
            data = data.withColumn(name, F.when(_blank(F.col(name)), source).otherwise(F.col(name)) if name in data.columns else source)
    had = set(data.columns)

    # the cohort is a dimension with one row a team
    teams = cohort.select(F.col("team").alias("_team"), F.col("fifa_code").alias("_code"), F.lower("team").alias("_folded"))
    codes = cohort.select(F.col("team").alias("_team_of"), F.col("fifa_code").alias("_known_code"))
    if "team" in had:
        data = data.withColumn("team", F.trim("team")).join(teams, F.lower("team") == F.col("_folded"), "left")
        changed = F.col("_team").isNotNull() & (F.col("team") != F.col("_team"))
        if "team_source" not in had:
            data = _kept_source(data, "team_source", changed, F.col("team"))
        data = data.withColumn("team", F.coalesce("_team", "team"))
    if "fifa_code" in had:
        data = data.withColumn("fifa_code", F.upper(F.trim("fifa_code"))).join(codes, F.col("fifa_code") == F.col("_known_code"), "left")
    if "team" not in had:
        data = data.withColumn("team", F.col("_team_of") if "fifa_code" in had else F.lit(None).cast("string")).join(teams, F.lower("team") == F.col("_folded"), "left")
    if "fifa_code" not in had:
        data = data.withColumn("fifa_code", F.col("_code")).join(codes, F.col("fifa_code") == F.col("_known_code"), "left")

    number = lambda c: F.trim(c).try_cast("double")
    if "season_end_year" not in had:
        data = data.withColumn("season_end_year", season_end_year(F.col("season")).cast("string") if "season" in had else F.lit(None).cast("string"))
    if "season" not in had:
        data = data.withColumn("season", season_label(number(F.col("season_end_year")).cast("int")))
    for name in ("player_url", "position_source", "source_url", "retrieved_at", "player_id", "player_name", "starts", "sub_appearances"):
        if name not in data.columns:
            data = data.withColumn(name, F.lit(None).cast("string"))
    if "goals" not in data.columns:
        data = data.withColumn("goals", F.lit("0"))
    born = F.trim("dob") if "dob" in had else F.lit(None).cast("string")
    made = stable_id(F.col("player_name"), F.col("player_url"), born)
    data = data.withColumn("player_name", F.trim("player_name")).withColumn("player_id", F.trim(F.when(_blank(F.col("player_id")), made).otherwise(F.col("player_id"))))

    whole = [c for c in WHOLE if c in data.columns]
    for name in whole:
        data = data.withColumn(f"_text_{name}", F.col(name))
    # a fraction is an issue and has no value as a whole number
    bad_number = {c: F.col(f"_text_{c}").isNotNull() & (number(F.col(f"_text_{c}")).isNull() | F.isnan(number(F.col(f"_text_{c}"))) | (number(F.col(f"_text_{c}")) % 1 != 0)) for c in whole}
    for name in whole:
        data = data.withColumn(name, F.when(~bad_number[name], number(F.col(f"_text_{name}")).cast("long")))
    parsed, label = season_end_year(F.col("season")), season_label(F.col("season_end_year"))
    data = data.withColumn("_season", F.col("season")).withColumn("_parsed", parsed).withColumn("_label", label)
    if "season_source" not in had:
        data = _kept_source(data, "season_source", F.col("_label").isNotNull() & (F.trim("_season") != F.col("_label")), F.col("_season"))
    data = data.withColumn("season", F.when(F.col("_parsed").isNotNull() & F.col("_label").isNotNull(), F.col("_label")).otherwise(F.col("season")))
    key = ["team", "season_end_year", "player_id"]
    copies = data.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in key])).groupBy(*key).agg(F.count("*").alias("_copies"))
    data = data.join(copies, key, "left")

    present = lambda c: c in had or c in {"team", "fifa_code", "season", "season_end_year", "player_id"}
    rules: list[tuple[str, str | None, Column, Column, Column]] = []

    def rule(code: str, column: str | None, broken: Column, value: Column | None, message: str | Column) -> None:
        rules.append((code, column, broken, F.lit(None).cast("string") if value is None else value.cast("string"), F.lit(message) if isinstance(message, str) else message))

    for c in whole:
        rule("invalid_integer", c, bad_number[c], F.col(f"_text_{c}"), f"{c} is not a whole number")
    for c in REQUIRED:
        if present(c):
            value = F.col("_season") if c == "season" else F.col(c)
            rule("missing_value", c, value.isNull() if c in WHOLE else _blank(value), value, f"{c} has no value")
    for c in COUNTS:
        if c in data.columns:
            rule("negative_count", c, F.col(c) < 0, F.col(c), f"{c} is below zero")
    rule("unknown_team", "team", F.col("team").isNotNull() & F.col("_code").isNull(), F.col("team"), "no team of the cohort")
    rule("unknown_fifa_code", "fifa_code", F.col("fifa_code").isNotNull() & F.col("_known_code").isNull(), F.col("fifa_code"), "no code of the cohort")
    rule("team_code_mismatch", "fifa_code", F.col("_code").isNotNull() & F.col("fifa_code").isNotNull() & (F.col("_code") != F.col("fifa_code")), F.col("fifa_code"), F.concat(F.lit("the code of "), "team", F.lit(" is "), "_code"))
    rule("season_out_of_scope", "season_end_year", ~F.col("season_end_year").between(*SEASONS), F.col("season_end_year"), f"ends before {SEASONS[0]} or after {SEASONS[1]}")
    rule("invalid_season", "season", F.col("_season").isNotNull() & F.col("_parsed").isNull(), F.col("_season"), "names no season, as 2006, 2005-06 and 2005/2006 do")
    rule("season_mismatch", "season", F.col("_parsed") != F.col("season_end_year"), F.col("_season"), F.concat(F.lit("the end year is "), F.col("season_end_year").cast("string")))
    rule("duplicate_team_season_player", None, F.col("_copies") > 1, None, "another row has this team, season and player")
    each = [
        F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(column).cast("string").alias("column"), value.alias("value"), message.alias("message")))
        for code, column, broken, value, message in rules
    ]
    issues = data.select(F.col(row).cast("long").alias("row_number"), F.explode(F.array_compact(F.array(*each))).alias("i")).select(F.lit("error").alias("severity"), "i.code", "row_number", "i.column", "i.value", "i.message")
    absent = [("error", "missing_column", None, c, None, f"no column {c}") for c in REQUIRED if not present(c)]
    if absent:
        spark = df.sparkSession
        issues = issues.unionByName(spark.createDataFrame(absent, "severity string, code string, row_number long, column string, value string, message string").select("severity", "code", "row_number", "column", "value", "message"))
    kept = [c for c in CANONICAL if c in data.columns]
    extra = [c for c in data.columns if c not in kept and not c.startswith("_")]
    return data.select(*kept, *extra), issues.select(*OUTPUT)


def starters(results: DataFrame, status: str, started: str = "started", out: tuple[str, ...] = ("DNS",)) -> DataFrame:
    """Results of everyone who started: who did not start is out, who started and did not finish stays."""
    return results.where(~F.coalesce(F.trim(status), F.lit("")).isin(*out)).withColumn(started, F.lit(True))


def numbered_rounds(rows: DataFrame, season: str, year: int, round_: str, needed: list[str]) -> DataFrame:
    """Home-and-away rows of a season: the round is a number and all ``needed`` columns have values."""
    kept = rows.where((F.col(season) == year) & F.col(round_).cast("string").rlike(r"^\d+$"))
    return reduce(lambda df, c: df.where(F.col(c).isNotNull()), needed, kept)


def regular_snaps(rows: DataFrame, kind: str = "game_type", snaps: tuple[str, ...] = ("offense_snaps", "defense_snaps", "st_snaps")) -> DataFrame:
    """Regular-season rows of players with a snap; adds their sum as ``snaps``."""
    whole = reduce(Column.__add__, [F.coalesce(F.col(c), F.lit(0)) for c in snaps])
    return rows.where(F.col(kind) == "REG").withColumn("snaps", whole).where("snaps > 0")


def eligible_matches(matches: DataFrame, year: int, match_type: str = "T20", team_type: str = "international", members: tuple[str, ...] = ()) -> DataFrame:
    """(dates, team_type, match_type, innings, teams) of a year's matches of one kind with an innings; one of ``members`` takes part where they are given."""
    kept = matches.where(
        F.startswith(F.get("dates", F.lit(0)), F.lit(f"{year}-")) & (F.col("team_type") == team_type) & (F.col("match_type") == match_type) & (F.size(F.coalesce("innings", F.array())) > 0)
    )
    return kept.where(F.arrays_overlap("teams", F.array(*[F.lit(m) for m in members]))) if members else kept


def any_nonzero(columns: list[str]) -> Column:
    """Whether any of the columns has a number other than 0; nulls and text that is no number are 0."""
    return F.exists(F.array(*[F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0)) for c in columns]), lambda x: x != 0)
