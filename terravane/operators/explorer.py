"""Explorer queries as plans: a specification of an edition and a query over it give one DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terravane.functions.scalar import search_text


@dataclass(frozen=True)
class EditionSpec:
    """workload is the ranking measure; sum_stats and min_stats say how a split's other columns roll up."""

    workload: str
    person: str = "id"
    team: str = "team"
    group: str = "conference"
    sum_stats: tuple[str, ...] = ()
    min_stats: tuple[str, ...] = ()


@dataclass(frozen=True)
class ExplorerQuery:
    groups: frozenset[str] = frozenset()
    teams: frozenset[str] = frozenset()
    countries: frozenset[str] = frozenset()
    low: float | None = None
    high: float | None = None
    best_rank: int | None = None
    positions: frozenset[str] = frozenset()
    equals: dict[str, object] = field(default_factory=dict)


def participant_filter(df: DataFrame, q: ExplorerQuery, country: str = "country", age: str = "age", positions: str = "positions") -> DataFrame:
    """Participant-level predicates; a person without an age is outside every age range, and one of several positions is enough."""
    if q.countries:
        df = df.where(F.col(country).isin(*sorted(q.countries)))
    if q.low is not None:
        df = df.where(F.col(age) >= q.low)
    if q.high is not None:
        df = df.where(F.col(age) < q.high)
    if q.positions:
        df = df.where(F.arrays_overlap(F.col(positions), F.array(*[F.lit(p) for p in sorted(q.positions)])))
    for name, value in sorted(q.equals.items()):
        df = df.where(F.col(name) == F.lit(value))
    return df


def with_workload(df: DataFrame, spec: EditionSpec, name: str = "minutes") -> DataFrame:
    """The edition's ranking measure under the name that every edition shares; a missing one is 0."""
    return df.withColumn(name, F.coalesce(F.col(spec.workload).cast("double"), F.lit(0.0)))


def selected_splits(splits: DataFrame, spec: EditionSpec, q: ExplorerQuery) -> DataFrame:
    if q.groups:
        splits = splits.where(F.col(spec.group).isin(*sorted(q.groups)))
    if q.teams:
        splits = splits.where(F.col(spec.team).isin(*sorted(q.teams)))
    return splits


def project_splits(splits: DataFrame, spec: EditionSpec, q: ExplorerQuery) -> DataFrame:
    """Splits that the query selects, rolled up per person; people without one drop out. The rank bound holds on the rolled-up rank."""
    aggs = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (spec.workload, *spec.sum_stats)] + [F.min(c).alias(c) for c in spec.min_stats]
    primary = F.min(F.struct((-F.col(spec.workload)).alias("_w"), F.col(spec.team)))[spec.team].alias("primary_team")
    out = selected_splits(splits, spec, q).groupBy(spec.person).agg(*aggs, primary)
    if q.best_rank is not None:
        out = out.where(F.col(spec.min_stats[0]) <= q.best_rank)
    return out


def project_records(records: DataFrame, splits: DataFrame, spec: EditionSpec, q: ExplorerQuery) -> DataFrame:
    """Records that the query selects, all columns. Without a team or group in the query a record is returned as it is; with one, its measures and its team and group
    are those of its selected splits (the primary split is the one of most work, ties to the smaller team), and other columns stay. A person without any split has
    the record's own team, group and measures as its one split. The rank bound holds on the result.
    """
    if not (q.groups or q.teams):
        out = records
    else:
        measures = [spec.workload, *spec.sum_stats, *spec.min_stats]
        bare = records.join(splits.select(spec.person), spec.person, "left_anti")
        whole = splits.select(spec.person, spec.team, spec.group, *measures).unionByName(bare.select(spec.person, spec.team, spec.group, *measures))
        first = F.min(F.struct((-F.col(spec.workload)).alias("_w"), F.col(spec.team), F.col(spec.group)))
        aggs = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (spec.workload, *spec.sum_stats)] + [F.min(c).alias(c) for c in spec.min_stats]
        rolled = selected_splits(whole, spec, q).groupBy(spec.person).agg(*aggs, first.alias("_p")).select(spec.person, *measures, f"_p.{spec.team}", f"_p.{spec.group}")
        out = records.drop(spec.team, spec.group, *measures).join(rolled, spec.person).select(*records.columns)
    return out if q.best_rank is None else out.where(F.col(spec.min_stats[0]) <= q.best_rank)


def team_records(records: DataFrame, splits: DataFrame, spec: EditionSpec) -> DataFrame:
    """One row per person and team; a person without splits has one with the record's own values."""
    columns = [spec.person, spec.team, spec.group, spec.workload, *spec.sum_stats, *spec.min_stats]
    return splits.select(*columns).unionByName(records.join(splits.select(spec.person), spec.person, "left_anti").select(*columns))


def event_selection(log: DataFrame, person: str, event: str, chosen: str, rounds: str = "rounds", medal: str = "medal") -> DataFrame:
    """An event log's rows of one event, summed anew per person: entries, rounds and medals by colour."""
    rows = log.where(F.col(event) == chosen)
    won = lambda name: F.count_if(F.col(medal) == name)
    return rows.groupBy(person).agg(
        F.count("*").alias("entries"), F.coalesce(F.sum(rounds), F.lit(0)).alias("rounds"), F.count_if(F.coalesce(F.col(medal), F.lit("")) != "").alias("medals"),
        won("Gold").alias("gold"), won("Silver").alias("silver"), won("Bronze").alias("bronze"),
    )


def location_lens(df: DataFrame, lens: str, lenses: dict[str, dict[str, str]]) -> DataFrame:
    """The columns of one view of a person's place under common names: ``lenses`` maps a lens to (common name -> column)."""
    return df.select("*", *[F.col(column).alias(name) for name, column in lenses[lens].items()])


def top(df: DataFrame, measure: str, name: str, n: int, first: list[Column] | None = None) -> DataFrame:
    return df.orderBy(*(first or []), F.desc(measure), F.asc(name)).limit(n)


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    return df.orderBy(*order).offset(number * size).limit(size)


def contains_text(df: DataFrame, needle: str, columns: list[str]) -> DataFrame:
    """Rows whose columns, joined by spaces, hold the text; case and diacritics do not count on either side."""
    return df.where(F.contains(search_text(F.concat_ws(" ", *columns)), search_text(F.lit(needle))))


def stable_first(cells: DataFrame, rate: str, name: str, n: int, only: bool = False) -> DataFrame:
    """The n cells of the highest rates, stable ones before all others, or stable ones only; cells without a rate are out. Ties by name."""
    known = cells.where(F.col(rate).isNotNull())
    return top(known.where("stable") if only else known, rate, name, n, [F.desc("stable")])


def age_extremes(people: DataFrame, age: str, name: str, n: int = 10) -> DataFrame:
    """The n youngest and the n oldest with a place each; ties by name, people without an age out."""
    known = people.where(F.col(age).isNotNull())
    sides = []
    for side, order in (("youngest", F.asc(age)), ("oldest", F.desc(age))):
        # n rows stand in the window
        some = known.orderBy(order, F.asc(name)).limit(n)
        sides.append(some.withColumn("side", F.lit(side)).withColumn("place", F.row_number().over(Window.orderBy(order, F.asc(name)))))
    return sides[0].unionByName(sides[1])


def age_overview(people: DataFrame, age: str, by: list[str], home: Column, mapped: Column, represented: str | None = None, young: int = 23, old: int = 30) -> DataFrame:
    """Median age, people under ``young`` and from ``old`` on, the share of mapped people from elsewhere than home, and the countries they stand for."""
    n = F.count(age)
    out = people.groupBy(*by).agg(
        F.median(age).alias("median_age"), F.count_if(F.col(age) < young).alias("young"), F.count_if(F.col(age) >= old).alias("old"), n.alias("aged"),
        F.count_if(mapped & ~home).alias("_away"), F.count_if(mapped).alias("_mapped"),
        *([F.count_distinct(F.nullif(F.col(represented), F.lit(""))).alias("represented")] if represented else []),
    )
    pct = lambda a, b: F.when(F.col(b) > 0, F.lit(100.0) * F.col(a) / F.col(b)).otherwise(0.0)
    return out.withColumn("young_pct", pct("young", "aged")).withColumn("old_pct", pct("old", "aged")).withColumn("outside_pct", pct("_away", "_mapped")).drop("_away", "_mapped")


def overriding(rules: list[tuple[str, Column, bool]], start: str) -> Column:
    """The status that the rules leave behind, gone through in order from ``start``: (status, condition, only_start) replaces any earlier status where the condition holds, or only ``start``."""
    status = F.lit(start)
    for name, holds, only_start in rules:
        status = F.when(F.coalesce(holds, F.lit(False)) & ((status == start) if only_start else F.lit(True)), name).otherwise(status)
    return status


def _listed(c: str) -> Column:
    return F.array_join(F.array_sort(F.collect_set(c)), ", ")


def timeline(rows: DataFrame, season: str, team: str, measure: str) -> DataFrame:
    """The measure of each team in each season."""
    return rows.groupBy(season, team).agg(F.sum(measure).alias(measure))


def place_summary(rows: DataFrame, place: list[str], person: str, starts: str, team: str) -> DataFrame:
    """People, those with starts, starts and teams of each place; null parts of a place are a value like any other."""
    return rows.groupBy(*place).agg(
        F.count_distinct(person).alias("players"), F.count_distinct(F.when(F.col(starts) > 0, F.col(person))).alias("unique_starters"), F.sum(starts).alias(starts), _listed(team).alias("teams")
    )


def player_summary(rows: DataFrame, person: list[str], team: str, season: str, sums: list[str], firsts: dict[str, str], order: str) -> DataFrame:
    """Teams, seasons and sums of each person, and of each column in ``firsts`` (name -> column) the first value that is not null by ``order``."""
    first = [F.min(F.when(F.col(c).isNotNull(), F.struct(order, F.col(c).alias("_v"))))["_v"].alias(name) for name, c in firsts.items()]
    return rows.groupBy(*person).agg(_listed(team).alias("teams"), F.count_distinct(season).alias("seasons"), *[F.sum(c).alias(c) for c in sums], *first)
