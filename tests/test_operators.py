"""Operators on small frames: what no table of the driver shows."""

import pytest
from pyspark.sql import functions as F

from terravane.functions import scalar as S
from terravane.operators import areas as areas_of
from terravane.operators import explorer, joins, metrics, validate
from terravane.sources import files, markup
from terravane.streaming import incremental


def value(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def test_scalars(spark):
    v = lambda e: value(spark, e)
    assert v(S.normalize_key(F.lit("Łódź-1"))) == "odz1" and v(S.normalize_key(F.lit("Łódź-1"), premapped=True)) == "lodz1" and v(S.normalize_key(F.lit(None).cast("string"))) == ""
    assert v(S.season_label(F.lit(2006))) == "2005-06"
    assert [v(S.season_end_year(F.lit(x))) for x in ("2006", "2005-06", "1999-00", "2005/2006", "x")] == [2006, 2006, 2000, 2006, None]
    assert v(S.age_on(F.lit("2000-02-29").cast("date"), F.lit("2018-02-28").cast("date"))) == 17
    assert v(S.parse_date(F.lit("01 JAN 2000".title()))).isoformat() == "2000-01-01"
    assert [v(S.lenient_int(F.lit(x))) for x in ("1.5", "-", "", "7")] == [1, 0, 0, 7]
    assert (v(S.landed(F.lit("10 of 20"))), v(S.attempted(F.lit("10 of 20")))) == (10, 20)
    assert v(S.wkt_point(F.lit("Point(144.9 -37.8136)"))).lat == -37.8136
    assert v(S.wkt_point(F.lit("none"))) is None
    assert v(S.given_name_first(F.lit("VAN DIJK Jan"))) == "Jan Van Dijk"
    assert v(S.full_name(F.lit("not applicable"), F.lit("Pelé"))) == "Pelé"
    assert v(S.stable_id(F.lit(None).cast("string"), F.lit("u"), F.lit("d"))) is None
    assert v(S.valid_coordinates(F.lit(91.0), F.lit(0.0))) is False
    assert v(S.escape_html(F.lit("<a&'\">"))) == "&lt;a&amp;&#39;&quot;&gt;"
    assert v(S.page_title(F.lit("https://en.wikipedia.org/wiki/S%C3%A3o_Paulo"))) == "São Paulo"
    assert v(S.name_key(F.lit("Müller  Anna"))) == "anna muller"


def test_joins(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="repeat"):
        joins.many_to_one(left, twice, ["k"]).collect()
    checked = joins.many_to_one(left, twice, ["k"])
    for read in (lambda: checked.select("k").collect(), checked.count, lambda: checked.groupBy().count().collect()):
        with pytest.raises(Exception, match="repeat"):
            read()
    with pytest.raises(Exception, match="repeat"):
        joins.many_to_one(left.where("k > 1"), twice, ["k"]).select("k").count()
    assert {(r.k, r.v) for r in joins.many_to_one(left, twice.where("v = 'a'"), ["k"]).collect()} == {(1, "a"), (2, None), (3, None)}
    out = joins.unique_match(left, spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, id string"), ["k"], "id")
    assert {r.k: (r.status, r.id) for r in out.collect()} == {1: ("matched", "a"), 2: ("ambiguous", None), 3: ("unmatched", None)}
    places = spark.createDataFrame([("x", "a", 90.0), ("x", "b", 20.0), ("y", "a", 90.0), ("y", "b", 60.0), ("z", "a", 1.0)], "q string, id string, pop double")
    assert {r.q: r.accepted for r in joins.dominant_match(places, ["q"], "pop", "id", 50, 3).collect()} == {"x": True, "y": False, "z": True}
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    areas = spark.createDataFrame([("A", square), ("B", [(x + 8, y) for x, y in square])], "code string, ring array<struct<lon: double, lat: double>>")
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 5.0, 9.0), (3, 50.0, 50.0)], "point_id int, lat double, lon double")
    assert {r.point_id: (r.code, r.hits) for r in areas_of.point_in_polygon(points, areas).collect()} == {1: ("A", 1), 2: (None, 2), 3: (None, 0)}
    triangle = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0)]
    ringed = spark.createDataFrame([("H", [[(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)], [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)]]), ("T", [[(x + 20, y) for x, y in triangle]])], "code string, rings array<array<struct<lon: double, lat: double>>>")
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 1.0, 5.0), (3, 2.0, 22.0), (4, 9.0, 29.0)], "point_id int, lat double, lon double")
    assert {r.point_id: r.code for r in areas_of.point_in_polygon(points, ringed).collect()} == {1: None, 2: "H", 3: "T", 4: None}
    shapes = spark.createDataFrame([("a", square), ("b", [(x + 5, y + 5) for x, y in square]), ("in", [(x / 10 + 4, y / 10 + 4) for x, y in square]), ("far", [(x + 50, y) for x, y in square]), ("edge", [(x + 10, y) for x, y in square]), ("tri", triangle)], "u string, ring array<struct<lon: double, lat: double>>")
    met = {(r.u, r.w) for r in areas_of.polygons_intersect(shapes, shapes.withColumnRenamed("u", "w"), "u", "w").collect()}
    assert ("a", "b") in met and ("a", "in") in met and ("a", "edge") in met and ("tri", "in") in met and not any("far" in p for p in met - {("far", "far")}) and met == {(y, x) for x, y in met}


def test_metrics(spark):
    df = spark.createDataFrame([("t", 0.0)], "team string, w double")
    assert metrics.hhi(df, "team", "w").first().hhi == 0
    assert value(spark, metrics.per_million(F.lit(3.0), F.lit(0.0))) is None
    s = spark.createDataFrame([(1, "b", 5.0), (1, "a", 5.0)], "id int, team string, w double")
    assert metrics.split_totals(s, "id", "team", "w", {}).first().primary_team == "a"
    adjusted = metrics.gap_to_primary(s, spark.createDataFrame([(1, 12.0)], "id int, total double"), "id", "team", "w", [F.desc("w"), F.asc("team")], "total")
    assert {r.team: r.adjusted for r in adjusted.collect()} == {"a": 7.0, "b": 5.0}


def test_explorer_projection(spark):
    rows = spark.createDataFrame([(1, "x", "E", 10.0, 4), (1, "y", "W", 3.0, 9), (2, "y", "W", 8.0, 30)], "id int, team string, conference string, points double, rank int")
    spec = explorer.EditionSpec("points", min_stats=("rank",))
    got = explorer.project_splits(rows, spec, explorer.ExplorerQuery(groups=frozenset(["W"]), best_rank=10)).collect()
    assert [(r.id, r.points, r["rank"], r.primary_team) for r in got] == [(1, 3.0, 9, "y")]
    people = spark.createDataFrame([(1, 20), (2, None)], "id int, age int")
    assert [r.id for r in explorer.participant_filter(people, explorer.ExplorerQuery(low=0, high=30)).collect()] == [1]


def test_validation(spark):
    ranks = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("b", 3, "y")], "g string, k int, p string")
    assert {r.g: r.contiguous for r in validate.contiguous_ranks(ranks, ["g"], "k", "p").collect()} == {"a": True, "b": False}


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([("2005", 1), ("2006", 2)], "year string, n int")
    files.write_both(df, str(tmp_path / "t"))
    back = files.read_tables(spark, {"csv": [str(tmp_path / "t/csv")], "parquet": [str(tmp_path / "t/parquet")]})
    assert back.count() == 4 and "source_input_file" in back.columns
    files.write_partitions(df, str(tmp_path / "p"), ["year"])
    files.write_partitions(df.where("year = '2006'").withColumn("n", F.lit(9)), str(tmp_path / "p"), ["year"])
    assert {(r.n, str(r.year)) for r in spark.read.parquet(str(tmp_path / "p")).collect()} == {(1, "2005"), (9, "2006")}
    with pytest.raises(files.MissingColumns):
        files.require(df, ["absent"])
    with pytest.raises(PermissionError):
        files.guard_target("out", {"out": "a"}, "b")
    aliased = spark.createDataFrame([("", "Italy"), ("Spain", "x")], "team string, Country string")
    assert [r.team for r in files.coalesce_alias(aliased, {"team": ["country"]}).collect()] == ["Italy", "Spain"]
    assert value(spark, files.markdown_rows(F.lit("x\n| a | b |\n|---|---|\n| 1 | 2 |"))) == [["a", "b"], ["1", "2"]]
    box = value(spark, markup.infobox_field(F.lit("{{Info\n| birth_place = {{flag|AUS}} [[Perth|Perth city]]<!-- x --><br/>[[Western Australia]]<ref>r</ref>\n}}"), "birth_place"))
    assert tuple(box) == ("Perth city, Western Australia", "Perth")
    assert tuple(value(spark, markup.infobox_field(F.lit("| birth_place =  \n"), "birth_place"))) == (None, None)


def test_streaming_equals_batch(spark, tmp_path):
    rows = spark.sql("SELECT timestamp '2024-01-01 10:00:00' + make_interval(0,0,0,0,cast(id AS int)) AS ts, if(id % 2 = 0, 'a', 'b') AS event_type, cast(id AS double) AS value FROM range(60)")
    rows.write.parquet(str(tmp_path / "in"))
    q = incremental.windowed_totals(incremental.event_stream(spark, str(tmp_path / "in"), rows.schema)).writeStream.format("memory").queryName("totals").outputMode("update").start()
    q.processAllAvailable()
    q.stop()
    got = {tuple(r) for r in spark.sql("SELECT * FROM totals").collect()}
    assert got == {tuple(r) for r in incremental.windowed_totals(rows).collect()}


def plain_cascade(left, right):
    """The cascade as a loop over the left rows; rows are (id, name, name, day)."""
    import difflib

    ratio = lambda x, y: difflib.SequenceMatcher(None, x, y).ratio()
    used, out = set(), {}
    for i, a, b, day in left:
        free = [(k, r) for k, r in enumerate(right) if r[0] not in used]
        near = lambda r: abs((r[3] - day).days)  # noqa: E731, B023
        found = sorted((1, near(r), k) for k, r in free if sorted((a, b)) == sorted(r[1:3]))
        found = found or sorted((2, near(r), k) for k, r in free if {a, b} & set(r[1:3]) and near(r) <= 2)
        if not found:
            similar = [(-max((ratio(a, r[1]) + ratio(b, r[2])) / 2, (ratio(a, r[2]) + ratio(b, r[1])) / 2), k) for k, r in free if near(r) <= 2]
            found = [(3, 1 + min(similar)[0], min(similar)[1])] if similar and -min(similar)[0] >= 0.55 else []
        if found:
            tier, cost, k = found[0]
            used.add(right[k][0])
            out[i] = (right[k][0], tier, round(cost, 9))
    return out


def cascade_rows(df, columns):
    return [tuple(r) for r in df.orderBy(columns[1]).select(columns[0], *columns[2:]).collect()]


@pytest.mark.parametrize("seed", [1, 2])
def test_match_cascade_against_brute_force(spark, seed):
    import datetime as dt
    import random

    from terravane.operators import resolve

    rng = random.Random(seed)
    name = lambda: rng.choice(["ana", "bob silva", "carla diaz", "karla diaz", "d"]) + rng.choice(["", "x", " jr", " y"])
    day = lambda: dt.date(2025, 1, 1) + dt.timedelta(days=rng.randrange(20))
    left, right = [(i, name(), name(), day()) for i in range(40)], [(100 + i, name(), name(), day()) for i in range(35)]
    a = spark.createDataFrame([(i, i, *r) for i, *r in left], "left_id long, left_order long, a string, b string, day date")
    b = spark.createDataFrame([(i, i, *r) for i, *r in right], "right_id long, right_order long, c string, d string, on date")
    got = {r.left_id: (r.right_id, r.tier, round(r.cost, 9)) for r in resolve.match_cascade(a, b).collect()}
    assert got == plain_cascade(left, right) and {t for _, t, _ in got.values()} == {1, 2, 3}
    assert resolve.match_cascade(a.limit(0), b).count() == 0


def test_fuzzy_match_cascade_query_against_brute_force(spark):
    from terravane.plans import resolution

    d = "/root/testdata/sf0.001"
    left = cascade_rows(resolution._bouts(spark, d), ["left_id", "left_order", "a", "b", "day"])
    right = cascade_rows(resolution._details(spark, d), ["right_id", "right_order", "c", "d", "on"])
    got = {r.left_id: (r.right_id, r.tier, r.cost) for r in resolution.fuzzy_match_cascade(spark, d).collect()}
    assert got == plain_cascade(left, right) and len(got) > 5


def test_redirects_with_cycles(spark):
    from terravane.operators import resolve

    steps = {f"c{i}": f"c{i + 1}" for i in range(40)} | {"x": "y", "y": "z", "z": "y", "s": "s"}
    titles = ["c0", "c39", "c40", "x", "y", "z", "s", "alone", None]
    found = resolve.resolve_redirects(spark.createDataFrame([(t,) for t in titles], "title string"), spark.createDataFrame(list(steps.items()), "title string, target string"))
    got = {r.title: (r.final, r.looped) for r in found.collect()}
    assert got == {"c0": ("c40", False), "c39": ("c40", False), "c40": ("c40", False), "x": ("y", True), "y": ("y", True), "z": ("z", True), "s": ("s", True), "alone": ("alone", False), None: (None, False)}


def test_ingest(spark):
    from terravane.operators import ingest

    cohort = spark.createDataFrame([("Côte d'Or", "CDO"), ("Brazil", "BRA")], "team string, fifa_code string")
    rows = spark.createDataFrame([(2, " brazil", "2005-06", "1.5", "7"), (3, "BRAZIL ", "bad", None, "-1")], "row_number long, Squad string, ` season ` string, starts string, S string")
    data, issues = ingest.normalize_player_seasons(rows, cohort)
    got = {r.row_number: r for r in data.collect()}
    assert (got[2].team, got[2].team_source, got[2].fifa_code, got[2].season_end_year, got[2].starts, got[2].sub_appearances, got[2].goals) == ("Brazil", "brazil", "BRA", 2006, None, 7, 0)
    codes = {(r.code, r.row_number, r["column"]) for r in issues.collect()}
    assert ("invalid_integer", 2, "starts") in codes and ("invalid_season", 3, "season") in codes and ("negative_count", 3, "sub_appearances") in codes and ("missing_column", None, "player_name") in codes
    with pytest.raises(ingest.ClashingColumns):
        ingest.normalize_player_seasons(spark.createDataFrame([(1, "a", "b")], "row_number int, team string, ` team` string"), cohort)
    assert [c.code for c in ingest.normalize_player_seasons(rows.limit(0), cohort)[1].collect()] == ["missing_column"]


def test_awkward_frames_of_new_operators(spark):
    from terravane.operators import resolve

    with pytest.raises(Exception, match="no scoring row"):
        resolve.participation(spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, 5)], "k int, s int"), ["k"]).collect()
    with pytest.raises(Exception, match="check fails"):
        validate.must_hold(validate.expect_counts({"x": (spark.range(3), F.count("*"), 4)}), "holds", "name").collect()
    flags = validate.flag_duplicates(spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (2, None)], "k int, v string"), ["k", "v"])
    assert sorted((r.k, r.duplicated) for r in flags.collect()) == [(1, True), (1, True), (2, False), (2, False)]
    q = metrics.ranked_quantiles(spark.createDataFrame([("a", float(i)) for i in (1, 2, 2, 9)] + [("b", None)], "g string, v double"), ["g"], "v", {"n": (0.5, "nearest"), "f": (0.5, "floor"), "m": (1.0, "nearest")})
    assert [tuple(r) for r in q.collect()] == [("a", 2.0, 2.0, 9.0)]
    same = spark.createDataFrame([("g", 5.0)] * 4, "g string, v double")
    width = 0.9 * 1.5 * 4**-0.2
    assert abs(max(r.density for r in metrics.kde(same, "g", "v", 0.0, 10.0, 11).collect()) - 1 / (width * (2 * 3.141592653589793) ** 0.5)) < 1e-9


def test_more_sources(spark, tmp_path):
    import json
    import zipfile

    (tmp_path / "w").mkdir()
    (tmp_path / "w/a.csv").write_text("Ranking as of\nWeek list,a,b\nWeek,Id,Rank\n1,x,\"2\"\n\n1,y,3\n", encoding="utf-8")
    rows = files.csv_after_preamble(spark, str(tmp_path / "w"), "Week,Id,", "Week int, Id string, Rank int").collect()
    assert [tuple(r) for r in rows] == [(1, "x", 2), (1, "y", 3)]
    (tmp_path / "w/b.csv").write_text("nothing\n")
    with pytest.raises(Exception, match="no header"):
        files.csv_after_preamble(spark, str(tmp_path / "w"), "Week,Id,", "Week int, Id string, Rank int").collect()
    line = "\t".join(["1", "Perth", "Perth", "Pertho,Boorloo", "-31.9", "115.8", "P", "PPL", "AU", "", "08", "", "", "", "2000000", "", "", "", ""])
    with zipfile.ZipFile(tmp_path / "cities.zip", "w") as z:
        z.writestr("cities.txt", line + "\nshort\tline\n")
    with zipfile.ZipFile(tmp_path / "matches.zip", "w") as z:
        for n in (2, 1):
            z.writestr(f"{n}.json", json.dumps({"info": {"n": n}}))
        z.writestr("README.txt", "x")
    index = files.city_index(files.zipped_lines(spark, str(tmp_path / "cities.zip"), "cities.txt"), S.normalize_key)
    assert {(r.key, r.country_code, r.population) for r in index.collect()} == {("perth", "AU", 2000000), ("pertho", "AU", 2000000), ("boorloo", "AU", 2000000)}
    members = files.zipped_members(spark, str(tmp_path / "matches.zip")).select("member", F.from_json("text", "info struct<n: int>")["info"]["n"].alias("n"))
    assert [tuple(r) for r in members.collect()] == [("1.json", 1), ("2.json", 2)]
    last = files.register(spark.createDataFrame([(1, " a ", "x"), (2, "a", "y"), (3, "", "z")], "line int, identifier string, name string"), "identifier", "line")
    assert [tuple(r) for r in last.collect()] == [(2, "a", "y")]
    shape = {"type": "Polygon", "coordinates": [[[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]]}
    multi = {"type": "MultiPolygon", "coordinates": [shape["coordinates"], [[[20, 0], [30, 0], [30, 10], [20, 0]]]]}
    doc = {"type": "FeatureCollection", "features": [{"properties": {"shapeID": i, "shapeName": i, "shapeGroup": "X"}, "geometry": g} for i, g in (("A", shape), ("B", multi))]}
    (tmp_path / "adm.json").write_text(json.dumps(doc))
    areas = files.read_boundaries(spark, str(tmp_path / "adm.json"), "adm1", ["shapeID", "shapeName", "shapeGroup"])
    assert {(r.code, len(r.rings)) for r in areas.collect()} == {("A", 1), ("B", 2)}
    with pytest.raises(files.UnknownBoundaries):
        files.boundary_columns(["x"], "adm2")
    p = str(tmp_path / "parts")
    files.write_missing_partitions(spark.createDataFrame([("a", 1)], "code string, n int"), p, ["code"])
    files.write_missing_partitions(spark.createDataFrame([("a", 9), ("b", 2)], "code string, n int"), p, ["code"])
    assert {(r.code, r.n) for r in spark.read.parquet(p).collect()} == {("a", 1), ("b", 2)}
    one = spark.createDataFrame([(1,)], "n int")
    for n in (1, 2):
        files.envelope(one.select(F.lit(n).alias("n")), one, one.limit(0), str(tmp_path / "doc"))
    assert [r.n for r in files.read_envelope(spark, str(tmp_path / "doc"), "records", "n int").collect()] == [2]
    files.queue_sinks({"unresolved": one.limit(0)}, str(tmp_path / "qa"))
    assert "n" in "".join(f.read_text() for f in (tmp_path / "qa/unresolved").glob("*.csv"))
    ring = spark.createDataFrame([("c", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)])], "id string, ring array<struct<lon: double, lat: double>>")
    made = json.loads(files.feature_collection(ring, "ring", ["id"], {"source": "x"}).first().value)
    assert made["features"][0]["geometry"]["coordinates"][0][-1] == [0.0, 0.0] and made["metadata"] == {"source": "x"}


def test_markup(spark):
    from terravane.sources import markup

    html = "<p>Position<p> Wing &amp; back <table><tr><th>A<th>b<tr><td>1<table><tr><td>in</table>x<td>2<tr><td>3</table><script>Position: no</script><table><tr><td>open"
    got = spark.createDataFrame([(html,), (None,), ("",)], "html string").select(markup.html_tables("html").alias("t"), markup.visible_lines("html").alias("l")).collect()
    assert got[0].t == [[["A", "b"], ["1x", "2"], ["3"]], [["in"]], [["open"]]] and got[1].t is None and got[2].t == []
    rows = spark.createDataFrame([(got[0].t, got[0].l)], "t array<array<array<string>>>, l string")
    first = rows.select(markup.table_records(F.col("t"), ["B", "a"]).alias("r"), markup.table_records(F.col("t"), ["zz"]).alias("none"), markup.label_value(F.col("l"), "position").alias("p"), markup.label_value(F.col("l"), "Height").alias("h")).first()
    assert first.r == [{"B": "2", "a": "1x"}, {"B": None, "a": "3"}] and first.none is None and (first.p, first.h) == ("Wing & back", None)
    page = F.lit('<script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"x":[1,2]}}}</script>')
    assert value(spark, markup.next_data(page, "$.props.pageProps.x[1]")) == "2" and value(spark, markup.next_data(F.lit("none"))) is None
    listed = spark.createDataFrame([("d", k, k, 1.0) for k in (1, 2, 2)], "ranking_date string, rank int, player int, points double")
    people = spark.createDataFrame([(1, "a"), (2, " ")], "player_id int, name string")
    for bad, message in ((listed, "exact ranks"), (listed.distinct(), "incomplete row")):
        with pytest.raises(Exception, match=message):
            markup.ranking_cohort(bad, people, "d", 2).collect()
    tables = markup.Tables()
    assert tables.get(("a", 1), lambda: spark.range(3)) is tables.get(("a", 1), lambda: spark.range(9))
    tables.clear()
    assert tables.get(("a", 1), lambda: spark.range(9)).count() == 9


def test_more_explorer(spark):
    cells = spark.createDataFrame([("a", 5.0, False), ("b", 1.0, True), ("c", None, True), ("d", 1.0, True)], "cell string, rate double, stable boolean")
    assert [r.cell for r in explorer.stable_first(cells, "rate", "cell", 3).collect()] == ["b", "d", "a"]
    assert [r.cell for r in explorer.stable_first(cells, "rate", "cell", 3, only=True).collect()] == ["b", "d"]
    texts = [("en", "action.x", "go {n}"), ("en", "plain", "p"), ("fr", "action.x", "va {n}"), ("de", "plain", "q {m}"), ("xx", "new", "z")]
    found = {(r.language, r.key, r.code) for r in validate.language_issues(spark.createDataFrame(texts, "language string, key string, text string"), previews=("fr", "de", "xx")).collect()}
    assert found == {("de", "action.x", "missing_key"), ("xx", "action.x", "missing_key"), ("de", "plain", "parameters_differ"), ("xx", "new", "unknown_key")}
    records = spark.createDataFrame([(1, "n1", "x", "E", 9.0, 1), (2, "n2", "y", "W", 4.0, 2), (3, "n3", "z", "W", 1.0, None)], "id int, name string, team string, conference string, points double, rank int")
    some = spark.createDataFrame([(1, "x", "E", 6.0, 1), (1, "y", "W", 3.0, 9)], "id int, team string, conference string, points double, rank int")
    spec = explorer.EditionSpec("points", min_stats=("rank",))
    got = {r.id: (r.name, r.team, r.points, r["rank"]) for r in explorer.project_records(records, some, spec, explorer.ExplorerQuery(groups=frozenset({"W"}))).collect()}
    assert got == {1: ("n1", "y", 3.0, 9), 2: ("n2", "y", 4.0, 2), 3: ("n3", "z", 1.0, None)}
    assert {r.id for r in explorer.project_records(records, some, spec, explorer.ExplorerQuery(best_rank=1)).collect()} == {1}


def joined_rows(df):
    """Rows that the joins of a plan have made, all together, when it was run."""
    df.collect()
    plan, made = df._jdf.queryExecution().executedPlan(), 0
    todo = [plan.executedPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if "Join" in name and node.metrics().contains("numOutputRows"):
            made += node.metrics().apply("numOutputRows").value()
        if name.endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return made


def test_names_meet_one_row_a_tier(spark):
    from terravane.operators import resolve

    short = spark.createDataFrame([(i, "J. Doe", "jdoe") for i in range(100)], "short_id long, name string, key string")
    roster = spark.createDataFrame([(i, ("jimdoe", "kimdoe")[i % 2]) for i in range(200)], "roster_id long, full_key string")
    found = resolve.name_variants(short, roster)
    assert {(r.short_id, r.tier, r.candidates, r.status) for r in found.collect()} == {(i, 3, 100, "ambiguous") for i in range(100)}
    assert 0 < joined_rows(found) < 2_000


def test_first_candidates_meet_one_right_row_a_name_and_day(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from terravane.operators import resolve

    day = lambda i: dt.date(2025, 1, 1 + i % 4)
    left = spark.createDataFrame([(i, i, "ana", f"x{i % 7}", day(i)) for i in range(120)], "left_id long, left_order long, a string, b string, day date")
    right = spark.createDataFrame([(i, i, f"x{i % 7}" if i % 3 else "z", "ana", day(i // 2)) for i in range(110)], "right_id long, right_order long, c string, d string, on date")
    found = resolve.first_candidates(left, right)
    best = resolve.cascade_candidates(left, right, fuzzy=False).groupBy("left_id").agg(F.min(F.struct("tier", "days", "right_id")).alias("b"))
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in best.select("left_id", "b.right_id", "b.tier", "b.days").collect()}
    assert 0 < joined_rows(found) < 3_000


def test_window_candidates_query_joins_few_rows(spark, tmp_path):
    from terravane.plans import resolution

    spark.range(600).selectExpr("id AS c_custkey", "'Customer#1' AS c_name", "0 AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(500).selectExpr("id AS s_suppkey", "'Supplier#1' AS s_name", "0 AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    found = resolution.exact_and_window_candidates(spark, str(tmp_path))
    assert 0 < joined_rows(found) < 3_000 and found.where("tier = 1").count() == 600


def test_quantile_query_keeps_odd_groups_and_reads_no_group_in_one_task(spark, tmp_path):
    from terravane.operators import metrics
    from terravane.plans import contributions

    rows = [("a", float(i), i / 7) for i in range(400)] + [(None, 1.0, 2.0), (None, 2.0, 4.0), ("none", None, None)]
    spark.createDataFrame(rows, "l_returnflag string, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.g: (r.med, r.q25, r.q75) for r in contributions.median_and_linear_quantiles(spark, str(tmp_path)).collect()}
    assert got == {"a": (199.5, round(99.75 / 7, 4), round(299.25 / 7, 4)), None: (1.5, 2.5, 3.5), "none": (None, None, None)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = metrics._placed(spark.range(4000).selectExpr("'a' AS g", "id AS v"), ["g"], "v")
        sizes = placed.groupBy(F_partition()).count().collect()
        assert placed.where("_end = _v + 1 AND _n = 4000").count() == 4000 and max(r["count"] for r in sizes) < 3_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def F_partition():
    from pyspark.sql import functions as F

    return F.spark_partition_id().alias("task")


def test_splits_of_large_inputs_are_dealt_by_their_rows(spark, monkeypatch, tmp_path):
    from terravane.operators import joins
    from terravane.plans import contributions, ingestion

    d = "/root/testdata/sf0.001"
    plain = {tuple(r) for r in ingestion.untouched_records(spark, d).collect()}
    monkeypatch.setattr(joins, "ROWS_OF_A_TASK", 500)
    assert contributions.splits(spark, d).rdd.getNumPartitions() >= spark.read.parquet(f"{d}/lineitem.parquet").count() // 500
    assert {tuple(r) for r in ingestion.untouched_records(spark, d).collect()} == plain
    # an order that is listed twice is one game and counts its work twice
    for name in ("nation", "region", "supplier", "lineitem"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{d}/{name}.parquet")
    orders = spark.read.parquet(f"{d}/orders.parquet")
    orders.unionByName(orders).write.parquet(str(tmp_path / "orders.parquet"))
    once, twice = ({(r.id, r.team): (r.workload, r.games) for r in contributions.splits(spark, p).collect()} for p in (d, str(tmp_path)))
    assert {k: (w / 2, n) for k, (w, n) in twice.items()} == once


def test_match_cascade_makes_no_pairs_and_days_agree(spark, monkeypatch):
    import datetime as dt
    import random

    from terravane.operators import resolve

    rng, most = random.Random(3), []
    # a few names on days far apart: the exact tier crosses days and its right rows are wanted in both
    name = lambda: rng.choice(["ana", "anb", "bob", "bab", "kim", None])
    day = lambda: dt.date(2025, 1, 1) + dt.timedelta(days=7 * rng.randrange(6))
    full = lambda row: None not in row
    left, right = [(i, name(), name(), day()) for i in range(90)], [(100 + i, name(), name(), day()) for i in range(70)]
    left, right = [r for r in left if full(r)], [r for r in right if full(r)]
    schema = "{0}_id long, {0}_order long, {1} string, {2} string, {3} date"
    monkeypatch.setattr(resolve, "cascade_candidates", lambda *_: pytest.fail("all pairs are made"))
    a = spark.createDataFrame([(i, i, *r) for i, *r in left], schema.format("left", "a", "b", "day"))
    b = spark.createDataFrame([(i, i, *r) for i, *r in right], schema.format("right", "c", "d", "on"))
    got = {r.left_id: (r.right_id, r.tier, round(r.cost, 9)) for r in resolve.match_cascade(a, b).collect()}
    assert got == plain_cascade(left, right)
    # without a day or a name only the exact tier is left
    a = spark.createDataFrame([(1, 1, "x", None, None), (2, 2, "x", "y", None), (3, 3, "x", "q", dt.date(2025, 1, 1))], schema.format("left", "a", "b", "day"))
    b = spark.createDataFrame([(7, 7, None, "x", dt.date(2025, 1, 1)), (8, 8, "y", "x", None), (9, 9, "x", None, dt.date(2025, 1, 2))], schema.format("right", "c", "d", "on"))
    assert {(r.left_id, r.right_id, r.tier, r.cost) for r in resolve.match_cascade(a, b).collect()} == {(1, 7, 1, None), (2, 8, 1, None), (3, 9, 2, 1.0)}
    # similar names are compared only while they may be the best
    ratio = resolve.difflib.SequenceMatcher
    monkeypatch.setattr(resolve.difflib, "SequenceMatcher", lambda *names: most.append(names) or ratio(*names))
    cell = resolve._Cell([{"right_id": i, "right_order": i, "x": f"team {i:05d}", "y": "home", "_day": 0, "_until": None} for i in range(300)])
    assert all(cell.take(i, f"teem {7 * i % 300:05d}", "house", 0) for i in range(300)) and cell.take(300, "team 00001", "home", 0) is None and len(most) < 300 * 300 / 4
