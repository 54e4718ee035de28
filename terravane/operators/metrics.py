"""Aggregations with named rules for ties, quantiles and empty groups."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terravane.functions.scalar import attempted, landed, whole_int
from terravane.operators.joins import many_to_one
from terravane.operators.lineage import cut


def total(c: Column | str) -> Column:
    """Sum that is 0 for a group without a value."""
    return F.coalesce(F.sum(c), F.lit(0))


def area_metrics(contributions: DataFrame, team: str, area: list[str], person: str, starts: str, subs: str) -> DataFrame:
    """Per team and area: distinct people with starts, sums of starts and subs. Rows without an area code or name drop out."""
    known = contributions
    for a in area:
        known = known.where(F.col(a).isNotNull())
    return known.groupBy(team, *area).agg(
        F.count_distinct(F.when(F.col(starts) > 0, F.col(person))).alias("people"), total(starts).alias("starts"), total(subs).alias("subs")
    )


def per_million(value: Column, population: Column) -> Column:
    return F.when(population > 0, value / population * 1_000_000.0)


def hhi(df: DataFrame, team: str, weight: str) -> DataFrame:
    """Sum of squared shares per team; 0 where the team's total is not positive. One level of areas at a time."""
    whole = F.sum(weight).over(Window.partitionBy(team))
    share = F.when(whole > 0, F.col(weight) / whole).otherwise(0.0)
    return df.withColumn("_s", share).groupBy(team).agg(F.sum(F.col("_s") * F.col("_s")).alias("hhi"))


def normalised_entropy(counts: DataFrame, by: str, n: str) -> DataFrame:
    """100 times the Shannon entropy of the shares over its maximum; 0 for one category."""
    whole = F.sum(n).over(Window.partitionBy(by))
    return counts.withColumn("_p", F.col(n) / whole).groupBy(by).agg(
        F.count("*").alias("categories"),
        F.when(F.count("*") > 1, 100 * F.sum(-F.col("_p") * F.ln("_p")) / F.ln(F.count("*"))).otherwise(0.0).alias("diversity"),
    )


def _placed(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, _v, _m, _end, _n): each group's different values with their counts, the running count up to them and the group's count. Nulls are left out.

    Values are dealt to tasks by range, and each range is given the count of all before it, so no task reads a group's values.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_m"))
    dealt = cut(counts.repartitionByRange(*by, "_v").withColumn("_part", F.spark_partition_id()))
    ranges = dealt.groupBy(*by, "_part").agg(F.sum("_m").alias("_s"))
    group = Window.partitionBy(*[f"_by{i}" for i in range(len(by))])
    before = ranges.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_part").alias("_p"), "_s").withColumn("_before", F.sum("_s").over(group.orderBy("_p")) - F.col("_s")).withColumn("_n", F.sum("_s").over(group))
    here = dealt.withColumn("_end", F.sum("_m").over(Window.partitionBy(*by, "_part").orderBy("_v")))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)], F.col("_part") == F.col("_p"))
    return here.join(before, same).select(*by, "_v", "_m", (F.col("_end") + F.col("_before")).alias("_end"), "_n")


def ranked_quantiles(df: DataFrame, by: list[str], value: str, named: dict[str, tuple[float, str]]) -> DataFrame:
    """name -> (q, rule) quantiles of each group, by counts of equal values and their running sum: no task holds a group's rows.

    ``nearest`` is the element at round((n - 1) q), halves up, of the sorted values, ``floor`` the one at floor((n - 1) q). Nulls are left out; a group without a value has no row.
    """
    placed = _placed(df, by, value)
    out = []
    for name, (q, rule) in named.items():
        place = F.floor((F.col("_n") - 1) * q + (0.5 if rule == "nearest" else 0.0))
        out.append(F.min(F.when(F.col("_end") > place, F.col("_v"))).alias(name))
    return placed.groupBy(*by).agg(*out)


def linear_quantiles(df: DataFrame, by: str, value: str, named: dict[str, float]) -> DataFrame:
    """name -> q: quantiles of each group between the two nearest elements, by counts of equal values and their running sum."""
    placed = _placed(df, [by], value)
    out = []
    for name, q in named.items():
        at = (F.col("_n") - 1) * q
        low, high = (F.min(F.when(F.col("_end") > place, F.col("_v"))) for place in (F.floor(at), F.ceil(at)))
        out.append((low + (high - low) * F.max(at - F.floor(at))).alias(name))
    return placed.groupBy(by).agg(*out)


def quantile_linear(values: str, q: float) -> Column:
    return F.expr(f"percentile({values}, {q})")


def lowest_mode(column: str) -> Column:
    """Most frequent value, the smallest of those on a tie, without holding the group's values."""
    return F.mode(column, True)


def kde(df: DataFrame, by: str, value: str, low: float, high: float, points: int = 81) -> DataFrame:
    """Gaussian density on an even grid; bandwidth 0.9 spread n^-0.2 within 0.75 and 2.5, 1.2 for fewer than two values; spread is min(sd, iqr / 1.34), sd where iqr is 0, and 1.5 for equal values."""
    known = df.where(F.col(value).isNotNull()).select(by, value)
    per = known.groupBy(by).agg(F.count("*").alias("n"), F.stddev_samp(value).alias("sd")).join(linear_quantiles(known, by, value, {"low_q": 0.25, "high_q": 0.75}), by)
    iqr = F.col("high_q") - F.col("low_q")
    spread = F.when(iqr > 0, F.least(F.col("sd"), iqr / 1.34)).otherwise(F.col("sd"))
    spread = F.when(spread == 0, 1.5).otherwise(spread)
    width = F.when(F.col("n") < 2, 1.2).otherwise(F.least(F.lit(2.5), F.greatest(F.lit(0.75), 0.9 * spread * F.pow(F.col("n"), F.lit(-0.2)))))
    step = (high - low) / (points - 1)
    at = F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.lit(low) + i * step))
    z = (F.col("x") - F.col(value)) / F.col("width")
    # each task sums its own rows on the grid before anything is shuffled
    return known.join(per.select(by, "n", width.alias("width")), by).withColumn("x", at).groupBy(by, "x").agg(
        (F.sum(F.exp(-0.5 * z * z)) / (F.first("n") * F.first("width") * math.sqrt(2 * math.pi))).alias("density")
    )


def bands(value: Column, edges: list[tuple[str, float | None, float | None]]) -> Column:
    """First half-open band [low, high) that holds the value; null values have none."""
    out = F.when(value.isNull(), F.lit(None))
    for name, low, high in edges:
        ok = F.lit(True) if low is None else value >= low
        out = out.when(ok if high is None else ok & (value < high), F.lit(name))
    return out


def split_totals(splits: DataFrame, person: str, team: str, workload: str, extra: dict[str, Column]) -> DataFrame:
    """One row a person: sums over the splits, the primary team (largest workload, ties to the smaller name) and the splits themselves."""
    order = F.struct((-F.col(workload)).alias("_w"), F.col(team))
    return splits.groupBy(person).agg(
        total(workload).alias(workload), F.min(order)[team].alias("primary_team"), F.max(workload).alias("primary_workload"),
        F.count("*").alias("teams"), *[c.alias(n) for n, c in extra.items()],
    )


def gap_to_primary(splits: DataFrame, totals: DataFrame, person: str, team: str, points: str, order: list[Column], canonical: str) -> DataFrame:
    """Adds what the canonical total has over the splits' sum to the person's primary split, so that sums agree exactly."""
    w = Window.partitionBy(person)
    placed = splits.withColumn("_place", F.row_number().over(w.orderBy(*order))).withColumn("_sum", F.sum(points).over(w))
    gap = F.coalesce(F.col(canonical) - F.col("_sum"), F.lit(0.0))
    return placed.join(totals.select(person, canonical), person, "left").withColumn(
        "adjusted", F.col(points) + F.when(F.col("_place") == 1, gap).otherwise(0.0)
    ).drop("_place", "_sum", canonical)


def per_million_of(rows: DataFrame, population: DataFrame, area: str, values: list[str], year: int | None = None) -> DataFrame:
    """Adds population and ``<value>_per_million`` of each area; populations of 0 or below, and absent ones, give nulls.

    population: (area, population, and year if there are several). If ``year`` is there only its rows count. An area with two rows left fails the query when it runs.
    """
    if year is not None and "year" in population.columns:
        there = population.agg(F.coalesce(F.bool_or(F.col("year") == year), F.lit(False)).alias("_there"))  # one row
        population = population.crossJoin(there).where(~F.col("_there") | (F.col("year") == year)).drop("_there")
    once = population.select(area, F.when(F.col("population") > 0, F.col("population")).alias("population"))
    joined = many_to_one(rows, once, [area])
    return joined.select("*", *[(F.col(v) / F.col("population") * 1_000_000.0).alias(f"{v}_per_million") for v in values])


def group_comparison(records: DataFrame, group: str, person: str, order: str, home: Column, top: int = 4) -> DataFrame:
    """records (group, person, order, age, mapped, code, country, continent) -> a row per group over its people.

    A person counts once: with the first known age, and with the first mapped record's country. ``home`` is the group's own country code. Columns: players, mapped, domestic_pct (of
    the mapped), countries, continents, diversity (``normalised_entropy`` of countries), median_age, under21_pct and over30_pct (of known ages, from 30 on), the ``top`` countries and all continents with
    their people, the most first and on a tie the one seen first.
    """
    one = records.groupBy(group, person).agg(
        F.min(F.when(F.col("age").isNotNull(), F.struct(order, "age")))["age"].alias("age"),
        F.min(F.when(F.col("mapped"), F.struct(order, "code", "country", "continent"))).alias("born"),
    )
    whole = one.groupBy(group).agg(
        F.count("*").alias("players"), F.count("born").alias("mapped"), F.count_if(F.col("born.code") == home).alias("_home"),
        F.median("age").alias("median_age"), F.count("age").alias("_aged"), F.count_if(F.col("age") < 21).alias("_young"), F.count_if(F.col("age") >= 30).alias("_old"),
    )

    def listed(name: str) -> DataFrame:
        counts = one.where("born IS NOT NULL").groupBy(group, F.col(f"born.{name}").alias("name")).agg(F.count("*").alias("n"), F.min(f"born.{order}").alias("first"))
        ranked = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "first", "name"))), lambda x: F.struct(x["name"].alias("name"), (-x["k"]).alias("n")))
        share = F.col("n") / F.sum("n").over(Window.partitionBy(group))
        return counts.withColumn("_p", share).groupBy(group).agg(
            F.count("*").alias(f"_{name}"), F.when(F.count("*") > 1, 100 * F.sum(-F.col("_p") * F.ln("_p")) / F.ln(F.count("*"))).otherwise(0.0).alias(f"_entropy_{name}"), ranked.alias(f"_list_{name}")
        )

    pct = lambda a, b: F.when(F.col(b) > 0, F.lit(100.0) * F.col(a) / F.col(b)).otherwise(0.0)
    none = F.array().cast("array<struct<name: string, n: bigint>>")
    joined = whole.join(listed("country"), group, "left").join(listed("continent"), group, "left")
    return joined.select(
        group, "players", "mapped", pct("_home", "mapped").alias("domestic_pct"), F.coalesce("_country", F.lit(0)).alias("countries"), F.coalesce("_continent", F.lit(0)).alias("continents"),
        F.coalesce("_entropy_country", F.lit(0.0)).alias("diversity"), "median_age", pct("_young", "_aged").alias("under21_pct"), pct("_old", "_aged").alias("over30_pct"),
        F.slice(F.coalesce("_list_country", none), 1, top).alias("top_countries"), F.coalesce("_list_continent", none).alias("continent_counts"),
    )


def conference_summary(records: DataFrame, conference: str, teams: str, home: str, top: int = 5) -> DataFrame:
    """records (conference, teams: array, mapped, country, age, minutes), one per person -> a row per conference.

    Columns: players, teams, mapped, countries, minutes, median_age of known ages, outside_home_pct of the mapped, and the ``top`` countries of the mapped, the most first and then by name. A mapped
    person without a country is outside.
    """
    mapped = records.where("mapped")
    counts = mapped.where("country IS NOT NULL").groupBy(conference, "country").agg(F.count("*").alias("n"))
    ranked = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col("country")))), lambda x: F.struct(x["country"].alias("name"), (-x["k"]).alias("n")))
    places = counts.groupBy(conference).agg(F.count("*").alias("countries"), F.slice(ranked, 1, top).alias("top_countries"))
    played = records.select(conference, F.explode(teams).alias("team")).groupBy(conference).agg(F.count_distinct("team").alias("teams"))
    whole = records.groupBy(conference).agg(
        F.count("*").alias("players"), F.count_if("mapped").alias("mapped"), total("minutes").alias("minutes"), F.median("age").alias("median_age"),
        F.count_if(F.col("mapped") & ~F.coalesce(F.col("country") == home, F.lit(False))).alias("_outside"),
    )
    joined = whole.join(places, conference, "left").join(played, conference, "left")
    return joined.select(
        conference, "players", F.coalesce("teams", F.lit(0)).alias("teams"), "mapped", F.coalesce("countries", F.lit(0)).alias("countries"), "minutes", "median_age",
        F.when(F.col("mapped") > 0, F.lit(100.0) * F.col("_outside") / F.col("mapped")).otherwise(0.0).alias("outside_home_pct"), "top_countries",
    )


def population_cells(cells: DataFrame, people: DataFrame, references: bool, workload: str | None = None) -> DataFrame:
    """cells (cell, population, label, country) and people (person, cell, place, country, minutes) -> cell, players, workload, rate, reference, stable, label, country.

    Each person counts once a cell. The rate is people, or the sum of ``workload``, per million residents; null without residents. A cell is stable from two people and 100,000 residents on. Label and country are
    the most frequent among its people, on a tie the first by name, and the cell's own without any. Cells without people are references, or left out.
    """
    one = people.groupBy("cell", "person").agg(F.max(F.struct("minutes", "place", "country")).alias("p"))

    def modal(name: str, spare: str) -> DataFrame:
        counts = one.select("cell", F.coalesce(f"p.{name}", F.lit(spare)).alias("v")).groupBy("cell", "v").agg(F.count("*").alias("n"))
        return counts.groupBy("cell").agg(F.min(F.struct((-F.col("n")).alias("k"), "v"))["v"].alias(f"_{name}"))

    sums = one.groupBy("cell").agg(F.count("*").alias("players"), total("p.minutes").alias("workload"))
    joined = cells.join(sums, "cell", "left").join(modal("place", "Mapped area"), "cell", "left").join(modal("country", "Country unavailable"), "cell", "left")
    joined = joined.withColumn("players", F.coalesce("players", F.lit(0))).withColumn("workload", F.coalesce("workload", F.lit(0)))
    measure = F.col(workload) if workload else F.col("players")
    residents = F.coalesce("population", F.lit(0))
    out = joined.select(
        "cell", "players", "workload", F.when(residents != 0, measure / F.col("population") * 1_000_000.0).alias("rate"), (F.col("players") == 0).alias("reference"),
        ((F.col("players") >= 2) & (residents >= 100_000)).alias("stable"), F.coalesce("_place", "label").alias("label"), F.coalesce("_country", F.col("country")).alias("country"),
    )
    return out if references else out.where(~F.col("reference"))


def rate_stops(cells: DataFrame) -> DataFrame:
    """cells (rate, stable, reference) -> one row of five stops: 0 and the quantiles 0.25, 0.5, 0.75 and 0.95 of the rates.

    Rates of stable cells count if there are five of them, otherwise all known ones but references'. Quantiles are elements at round((n - 1) q), 0 where there is none.
    """
    named = {f"q{round(q * 100)}": (q, "nearest") for q in (0.25, 0.5, 0.75, 0.95)}
    told = cells.select(F.explode(F.array(
        F.when(F.col("stable"), F.struct(F.lit("stable").alias("kind"), F.coalesce("rate", F.lit(0.0)).alias("rate"))),
        F.when(~F.col("reference") & F.col("rate").isNotNull(), F.struct(F.lit("all").alias("kind"), F.col("rate"))),
    )).alias("r")).where("r IS NOT NULL").select("r.*")
    each = ranked_quantiles(told, ["kind"], "rate", named).withColumn("s", F.struct(*named))
    some = told.groupBy("kind").agg(F.count("*").alias("n")).join(each, "kind")
    # two rows at most: one for each kind
    both = some.agg(F.max(F.when((F.col("kind") == "stable") & (F.col("n") >= 5), F.col("s"))).alias("a"), F.max(F.when(F.col("kind") == "all", F.col("s"))).alias("b"))
    return both.select(F.lit(0.0).alias("q0"), *[F.coalesce(F.coalesce("a", "b")[n], F.lit(0.0)).alias(n) for n in named])


# The kinds of dismissal that are not the bowler's, and what a fielder is counted for.
NOT_BOWLED = ("obstructing the field", "retired hurt", "retired out", "run out", "timed out")
FIELDED = {"caught": "catches", "caught and bowled": "catches", "stumped": "stumpings", "run out": "run_outs"}


# What is read of a document's innings; whatever may be of another kind stays a VARIANT.
INNINGS = "array<struct<super_over: variant, overs: array<struct<deliveries: array<struct<batter: string, bowler: string, runs: variant, extras: variant, wickets: array<struct<kind: string, fielders: array<variant>>>>>>>>>"


def match_deliveries(matches: DataFrame) -> DataFrame:
    """matches (match_id, doc: VARIANT of a match document), a row per match -> a row per delivery: match_id, innings, batters, batter, bowler, batter_runs, total, wide, noball, byes, wickets.

    A document has ``innings`` of ``overs`` of ``deliveries``; absent lists are empty, super overs are left out, and missing counts are 0. A list that is none, or an element of one that is no object,
    fails the query. wickets is array<struct<kind, fielders>>; a fielder is a name, or an object with one; caught and bowled without a fielder is the bowler's catch. batters are the names who bat in the
    innings, once each, and stand at one of its deliveries; at the others they are null.
    """
    # one pass over a document: parts taken out of a VARIANT one by one are each written anew
    innings = matches.select("match_id", F.expr(f"posexplode(variant_get(doc, '$.innings', '{INNINGS}'))").alias("innings", "i")).where("NOT coalesce(try_variant_get(i.super_over, '$', 'boolean'), false)")
    told = innings.select("match_id", "innings", F.flatten(F.array_compact("i.overs.deliveries")).alias("d"))
    balls = told.select("match_id", "innings", F.inline(F.when(F.size("d") > 0, F.arrays_zip("d", F.array(F.array_distinct("d.batter"))))).alias("d", "batters")).select("match_id", "innings", "batters", "d.*")
    balls = balls.withColumns({
        "runs": F.expr("try_variant_get(runs, '$', 'struct<batter: bigint, total: bigint>')"),
        "extras": F.expr("try_variant_get(extras, '$', 'struct<wides: variant, noballs: variant, byes: bigint, legbyes: bigint, penalty: bigint>')"),
    })
    number = lambda path: F.coalesce(path, F.lit(0).cast("long"))
    names = "filter(transform(w.fielders, f -> coalesce(try_variant_get(f, '$.name', 'string'), try_variant_get(f, '$', 'string'))), n -> n is not null and not startswith(n, '{'))"
    named = f"transform(wickets, w -> named_struct('kind', lower(coalesce(w.kind, '')), 'fielders', coalesce({names}, array())))"
    wickets = F.expr(f"if(size(wickets) > 0, transform({named}, w -> if(w.kind = 'caught and bowled' and size(w.fielders) = 0, named_struct('kind', w.kind, 'fielders', array(bowler)), w)), array())")
    return balls.select(
        "match_id", "innings", "batters", "batter", "bowler", number("runs.batter").alias("batter_runs"), number("runs.total").alias("total"), F.col("extras.wides").isNotNull().alias("wide"),
        F.col("extras.noballs").isNotNull().alias("noball"), (number("extras.byes") + number("extras.legbyes") + number("extras.penalty")).alias("byes"), wickets.alias("wickets"),
    )


def cricket_totals(balls: DataFrame) -> DataFrame:
    """``match_deliveries`` -> id, runs, fours, sixes, faced, bowled, conceded, wickets, catches, stumpings, run_outs and batting_innings of each name, sums over all its roles.

    Deliveries are gone through once, and only sums per name are held; the innings a name batted in are counted where ``batters`` stand.
    """
    n = lambda c: c.cast("long")
    counted = ("runs", "fours", "sixes", "faced", "bowled", "conceded", "wickets", *sorted(set(FIELDED.values())), "batting_innings")

    def row(who: Column, **values: Column) -> Column:
        return F.struct(who.alias("id"), *[values.get(c, F.lit(0).cast("long")).alias(c) for c in counted])

    some = F.size("wickets") > 0
    taken = F.when(some, F.size(F.filter("wickets", lambda w: ~w["kind"].isin(*NOT_BOWLED)))).otherwise(0)
    fielding = F.flatten(F.transform("wickets", lambda w: F.transform(w["fielders"], lambda name: row(name, **{c: n(w["kind"].isin(*[k for k, v in FIELDED.items() if v == c])) for c in set(FIELDED.values())}))))
    # the first of the batters is as a rule the delivery's own
    own = F.coalesce(F.get("batters", F.lit(0)) == F.col("batter"), F.lit(False))
    rest = F.coalesce(F.when(own, F.slice("batters", 2, F.size("batters"))).otherwise(F.col("batters")), F.array().cast("array<string>"))
    batted = F.transform("_rest", lambda name: row(name, batting_innings=F.lit(1).cast("long")))
    # most deliveries have neither; lambdas are told apart from the rows of the batter and the bowler, which are compiled
    told = balls.withColumns({"_taken": n(taken), "_own": n(own), "_rest": rest}).withColumn("_others", F.when(some | (F.size("_rest") > 0), F.concat(fielding, batted)))
    at_bat = row(F.col("batter"), runs=F.col("batter_runs"), fours=n(F.col("batter_runs") == 4), sixes=n(F.col("batter_runs") == 6), faced=n(~F.col("wide")), batting_innings=F.col("_own"))
    at_ball = row(F.col("bowler"), bowled=n(~F.col("wide") & ~F.col("noball")), conceded=F.col("total") - F.col("byes"), wickets=F.col("_taken"))
    both = F.array(at_bat, at_ball)
    rows = told.select(F.inline(F.when(F.col("_others").isNull(), both).otherwise(F.concat(both, "_others")))).where("id IS NOT NULL")
    return rows.groupBy("id").agg(*[F.sum(c).alias(c) for c in counted])


ROUND_FIELDS = {"Sig_str": "significant_strikes", "Total_str": "total_strikes", "Td": "takedowns"}


def fight_rounds(fights: DataFrame, rounds: int = 5) -> DataFrame:
    """Fights with text columns ``p1_rd1_KD``, ``_Sig_str``, ``_Total_str``, ``_Td`` (``x of y``) and ``_Sub_att`` for both sides and each round -> a row per side with its sums.

    Columns: fight_id, side (1 or 2), knockdowns, submission_attempts, and landed and attempted of the three others. Columns that are absent, and texts of another form, count as 0.
    """
    text = lambda side, i, name: F.col(c) if (c := f"p{side}_rd{i}_{name}") in fights.columns else F.lit(None).cast("string")
    summed = lambda f, side, name: reduce(Column.__add__, [f(text(side, i, name)).cast("long") for i in range(1, rounds + 1)])
    sides = [
        F.struct(
            F.lit(side).alias("side"), summed(whole_int, side, "KD").alias("knockdowns"), summed(whole_int, side, "Sub_att").alias("submission_attempts"),
            *[summed(f, side, source).alias(f"{name}_{kind}") for source, name in ROUND_FIELDS.items() for kind, f in (("landed", landed), ("attempted", attempted))],
        )
        for side in (1, 2)
    ]
    return fights.select("fight_id", F.inline(F.array(*sides)))


def fighter_splits(fights: DataFrame, stats: DataFrame) -> DataFrame:
    """fights (fight_id, first_id, second_id, first_result, second_result, gender, division, method, title, on) and ``fight_rounds`` -> a row per fighter and division.

    Counts: bouts, wins, losses, draws, no_contests, wins by knockout, submission and decision (the first of the three words in the method that fits), title_bouts, detailed bouts and the sums of their
    statistics; log lists the fights, the latest first. A fighter of both genders fails the query when it runs.
    """
    sides = F.inline(F.array(*[F.struct(F.lit(i).alias("side"), F.col(f"{a}_id").alias("fighter_id"), F.col(f"{a}_result").alias("result"), F.col(f"{b}_id").alias("opponent_id")) for i, a, b in ((1, "first", "second"), (2, "second", "first"))]))
    rows = fights.select("fight_id", "gender", "division", "title", "on", F.lower("method").alias("_m"), sides).join(stats, ["fight_id", "side"], "left")
    method, won = F.col("_m"), F.col("result") == "W"
    how = F.when(F.contains(method, F.lit("ko")), "ko").when(F.contains(method, F.lit("submission")), "submission").when(F.contains(method, F.lit("decision")), "decision")
    numbers = [c for c in stats.columns if c not in ("fight_id", "side")]
    genders = rows.groupBy("fighter_id").agg(F.min("gender").alias("_low"), F.max("gender").alias("_high"))
    failed = F.raise_error(F.concat(F.lit("both genders: "), F.col("fighter_id").cast("string"))).cast("boolean")
    one = rows.join(genders, "fighter_id").where(F.when(F.col("_low") == F.col("_high"), True).otherwise(failed))
    log = F.transform(F.sort_array(F.collect_list(F.struct("on", (-F.col("fight_id")).alias("k"), "opponent_id", "result")), asc=False), lambda x: F.struct(x["on"].alias("on"), x["opponent_id"].alias("opponent_id"), x["result"].alias("result")))
    return one.groupBy("fighter_id", "gender", "division").agg(
        F.count("*").alias("bouts"), *[F.count_if(F.col("result") == r).alias(n) for r, n in (("W", "wins"), ("L", "losses"), ("D", "draws"), ("NC", "no_contests"))],
        *[F.count_if(won & (how == m)).alias(f"{m}_wins") for m in ("ko", "submission", "decision")], F.count_if("title").alias("title_bouts"),
        F.count(numbers[0]).alias("detailed_bouts"), *[total(c).alias(c) for c in numbers], log.alias("log"),
    )


def deliveries(balls: DataFrame, batter: Column, bowler: Column) -> DataFrame:
    """(runs, wide, noball, byes, total, wicket) -> id, runs, fours, sixes, faced, bowled, conceded, wickets: the batter faces all but wides, the bowler bowls all but wides and no-balls and concedes the total less byes."""
    zero, n = F.lit(0).cast("long"), lambda c: c.cast("long")
    at_bat = F.struct(batter.alias("id"), F.col("runs").alias("runs"), n(F.col("runs") == 4).alias("fours"), n(F.col("runs") == 6).alias("sixes"), n(~F.col("wide")).alias("faced"), zero.alias("bowled"), zero.alias("conceded"), zero.alias("wickets"))
    at_ball = F.struct(
        bowler.alias("id"), zero.alias("runs"), zero.alias("fours"), zero.alias("sixes"), zero.alias("faced"), n(~F.col("wide") & ~F.col("noball")).alias("bowled"), (F.col("total") - F.col("byes")).alias("conceded"), n(F.col("wicket")).alias("wickets")
    )
    sums = [F.sum(c).alias(c) for c in ("runs", "fours", "sixes", "faced", "bowled", "conceded", "wickets")]
    return balls.select(F.inline(F.array(at_bat, at_ball))).groupBy("id").agg(*sums)


def entries_and_medals(results: DataFrame, person: str, event: str, fingerprint: list[str]) -> DataFrame:
    """(person, event, place, status, final, ..) -> entries, rounds, best_place and medals of each person.

    Results that agree in event, person, place and ``fingerprint`` are one. Who did not start has no round. Places count from 1; a place from 1 to 3 in a final is a medal, the best one of an event.
    """
    told = results.where(F.coalesce(F.col("status"), F.lit("")) != "DNS").select(person, event, "place", "final", *fingerprint).distinct()
    podium = F.when(F.col("final") & F.col("place").between(1, 3), F.col("place"))
    per = told.groupBy(person, event).agg(F.count("*").alias("rounds"), F.min(F.when(F.col("place") > 0, F.col("place"))).alias("best"), F.min(podium).alias("medal"))
    won = lambda k: F.count_if(F.col("medal") == k)
    return per.groupBy(person).agg(
        F.count("*").alias("entries"), F.sum("rounds").alias("rounds"), F.min("best").alias("best_place"), F.count("medal").alias("medals"), won(1).alias("gold"), won(2).alias("silver"), won(3).alias("bronze")
    )
