"""Landed pages, growing folders, checks that survive pruned columns, texts and names against plain code."""

import csv
import datetime as dt
import difflib
import hashlib
import io
import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from terravane.functions import scalar
from terravane.operators import gazetteer, graphs, metrics, resolve, templates, validate
from terravane.sources import files, landed, markup
from terravane.streaming import landing


def test_landed_pages(spark, tmp_path):
    path = f"file://{tmp_path}/cache"
    pages = [("http://a/1", "<b>é</b>", "2025-01-01", 200), ("http://a/2", None, "2025-01-02", 404), (None, "lost", "2025", 200), ("http://a/1", "old", "2024-01-01", 200)]
    landed.land(spark.createDataFrame(pages, "url string, body string, retrieved_at string, status_code int"), path)
    scan = landed.register(spark).read.format("landed_pages").option("path", path).option("tasks", 3).load()
    assert {(r.url, r.body, r.retrieved_at, r.status_code) for r in scan.collect()} == {("http://a/1", "<b>é</b>", "2025-01-01", 200), ("http://a/2", "", "2025-01-02", 404)}
    one = scan.where(F.col("url") == "http://a/1")
    assert one.count() == 1 and one.rdd.getNumPartitions() == 1 and scan.where(F.col("url").isin("http://a/2", "http://b")).count() == 1
    assert scan.where("url = 'http://a/1' AND url = 'http://a/2'").count() == 0
    name = landed.page_name("http://a/1")
    (tmp_path / "cache" / (name + landed.NOTES)).write_text("no notes")
    got = {r.url: r for r in scan.collect()}
    assert got[None].status_code is None and dt.datetime.fromisoformat(got[None].retrieved_at).tzinfo
    (tmp_path / "cache" / (name + landed.NOTES)).write_text(json.dumps({"source_url": "http://a/1", "sha256": hashlib.sha256(b"whole").hexdigest()}))
    with pytest.raises(Exception, match="noted"):
        scan.collect()
    (tmp_path / "cache" / name).write_bytes(b"whole")
    assert {r.body for r in scan.collect()} == {"whole", ""}
    assert landed.register(spark).read.format("landed_pages").option("path", f"{path}-none").load().count() == 0
    asked = spark.createDataFrame([("http://a/1", 2, None), ("x", 0, None), ("y", 1, "120"), ("z", 2, "soon"), ("w", 3, "9")], "url string, failed int, retry_after string").withColumn("failed_at", F.lit("2025-01-01").cast("timestamp"))
    plan = {r.url: (r.state, r.due) for r in landed.fetch_plan(asked, scan).collect()}
    start = dt.datetime(2025, 1, 1)
    assert plan == {"http://a/1": ("cached", None), "x": ("new", None), "y": ("retry", start + dt.timedelta(seconds=120)), "z": ("retry", start + dt.timedelta(seconds=3)), "w": ("failed", None)}


def test_ingest_of_growing_folders(spark, tmp_path):
    source, target, mark = (str(tmp_path / x) for x in ("source", "target", "mark"))
    schema = "k long, v string, seen int"
    rows = lambda seen, keys: spark.createDataFrame([(k, f"{k}-{seen}", seen) for k in keys], schema)
    rows(1, range(50)).repartition(5).write.parquet(source)
    landing.ingest_new_files(spark, source, target, mark, schema, files_per_batch=2)
    rows(2, range(40, 70)).repartition(3).write.mode("append").parquet(source)
    for _ in range(2):
        landing.ingest_new_files(spark, source, target, mark, schema, files_per_batch=2)
    want = {(k, f"{k}-{2 if k >= 40 else 1}") for k in range(70)}
    found = landing.latest(spark, target, ["k"], ["seen"])
    assert {(r.k, r.v) for r in found.collect()} == want and found.count() == 70
    assert spark.read.option("basePath", target).parquet(f"{target}/batch=*").count() == 80
    # a batch that was written but not noted comes again and replaces itself
    batches = sorted((tmp_path / "mark" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    batches[-1].unlink()
    crc = batches[-1].with_name(f".{batches[-1].name}.crc")
    if crc.exists():
        crc.unlink()
    landing.ingest_new_files(spark, source, target, mark, schema, files_per_batch=2)
    assert spark.read.option("basePath", target).parquet(f"{target}/batch=*").count() == 80
    # one run over everything is the same
    landing.ingest_new_files(spark, source, target + "1", mark + "1", schema)
    assert {(r.k, r.v) for r in landing.latest(spark, target + "1", ["k"], ["seen"]).collect()} == want


def test_checks_hold_when_columns_are_pruned(spark, tmp_path):
    bad = validate.expect_counts({"x": (spark.range(3), F.count("*"), 4)})
    for read in (lambda d: d.select("name").collect(), lambda d: d.count()):
        with pytest.raises(Exception, match="check fails"):
            read(validate.must_hold(bad, "holds", "name"))
    listed = spark.createDataFrame([("d", k, k, 1.0) for k in (1, 2, 4)], "ranking_date string, rank int, player int, points double")
    people = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "player_id int, name string")
    for date, limit in (("d", 3), ("none", 2)):
        for read in (lambda d: d.select("name").collect(), lambda d: d.count(), lambda d: d.select("points").collect()):
            with pytest.raises(Exception, match="exact ranks"):
                read(markup.ranking_cohort(listed, people, date, limit))
    assert markup.ranking_cohort(listed, people, "d", 2).select("name").count() == 2
    shape = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1]]]}
    doc = {"type": "FeatureCollection", "features": [{"properties": {"shapeID": i, "shapeName": "n"}, "geometry": shape} for i in ("A", "A")]}
    (tmp_path / "twice.json").write_text(json.dumps(doc))
    with pytest.raises(Exception, match="unique"):
        files.read_boundaries(spark, str(tmp_path / "twice.json"), "adm1", ["shapeID", "shapeName"]).select("name").collect()
    twice = spark.createDataFrame([(1, 2025, 5.0), (1, 2025, 6.0), (2, 2024, 1.0)], "area int, year int, population double")
    rows = spark.createDataFrame([(1, 3), (2, 4)], "area int, n int")
    with pytest.raises(Exception, match="repeat"):
        metrics.per_million_of(rows, twice, "area", ["n"], 2025).select("n").collect()
    got = metrics.per_million_of(rows, twice.where("population <> 6"), "area", ["n"], 2025)
    assert {(r.area, r.population, r.n_per_million) for r in got.collect()} == {(1, 5.0, 600000.0), (2, None, None)}
    one = metrics.per_million_of(rows, twice.where("population <> 6").drop("year"), "area", ["n"], 2025)
    assert {r.area: r.population for r in one.collect()} == {1: 5.0, 2: 1.0}


def test_csv_records_against_the_csv_module(spark, tmp_path):
    rng = random.Random(3)
    fields = ["plain", "", "a,b", 'said "so"', "two\nlines", "three\r\nof\nthem", '"', "é ü", " spaced "]
    texts = []
    for _ in range(30):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
        writer.writerow(["a", "b\nb", 'c"'])
        writer.writerows([rng.choice(fields), rng.choice(fields), str(i)] for i in range(rng.randint(0, 6)))
        texts.append("﻿" + out.getvalue())
    frame = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = sorted((r.k, int(r.c), r.a or "", r.b or "") for r in markup.csv_rows(frame, "text", ["k"], "a string, b string, c string").collect())
    want = sorted((k, int(c), a, b) for k, text in enumerate(texts) for a, b, c in list(csv.reader(io.StringIO(text.lstrip("﻿"), newline="")))[1:])
    assert got == want
    (tmp_path / "report.csv").write_bytes('Report "of" the week\nWeek,Name\n1,"one\r\n""two"""\n\n2,x\n'.encode())
    assert [tuple(r) for r in files.csv_after_preamble(spark, str(tmp_path / "report.csv"), "Week,", "Week int, Name string").collect()] == [(1, 'one\n"two"'), (2, "x")]


def test_decomposition_against_unicodedata(spark):
    letters = [chr(c) for c in [*range(1, 0x2FF), *range(0x370, 0x1FFF, 3), *range(0x2000, 0x2FFF, 5), *range(0xAC00, 0xD7A4, 97), *range(0xF900, 0xFFFE, 7), *range(0x1D400, 0x1D7FF, 11), 0x2F800]]
    texts = [*letters, "Łódź ﬁn½ ŉ Ǆ 한국어", "plain", "", "a\nb é", "가각힣" * 3]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", scalar.fold_accents(F.col("t")).alias("f"), scalar.strip_diacritics(F.col("t")).alias("s"), scalar.normalize_key(F.col("t")).alias("k"))
    assert "ArrowEvalPython" not in frame._jdf.queryExecution().toString() and "BatchEvalPython" not in frame._jdf.queryExecution().toString()
    for r in frame.collect():
        plain = unicodedata.normalize("NFKD", r.t)
        assert r.f == "".join(c for c in plain if not unicodedata.combining(c)), r.t
        assert r.s == "".join(c for c in plain if not "̀" <= c <= "ͯ"), r.t


@pytest.mark.parametrize(("text", "shown", "title"), [
    ("[[Perth|Perth city]]<!-- x --><br/>[[Western Australia]]<ref>r</ref>", "Perth city, Western Australia", "Perth"),
    ("{{flagicon|AUS}} [[Perth#North|North]] , '''Australia'''", "North, Australia", "Perth"),
    ("A,, b", "A, , b", None), (", x ,", "x", None), ("<ref name=a/>", None, None), ("<ref name='b'>[[no]]</ref>It's", "It's", None),
    ("{{nowrap|here}} <small>x</small>", "{{nowrap|here}} x", None), ("[[broken", "[[broken", None), ("{{Flag|X", "{{Flag|X", None), ("<BR> y", "y", None), ("a < b", "a < b", None),
])
def test_infobox_values(spark, text, shown, title):
    row = spark.range(1).select(markup.infobox_field(F.lit("{{Info\n| other = 1\n|  Birth_Place  = " + text + " \n}}"), "birth_place").alias("v")).first().v
    assert tuple(row) == (shown, title)


def test_pointer_is_renamed(spark, tmp_path):
    one = spark.createDataFrame([(1,)], "n int")
    for n in (1, 2, 3):
        files.envelope(one.select(F.lit(n).alias("n")), one, one.limit(0), str(tmp_path / "doc"))
        assert (tmp_path / "doc/current").is_file() and [r.n for r in files.read_envelope(spark, str(tmp_path / "doc"), "records", "n int").collect()] == [n]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 400)] + [(500, 500)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in graphs.components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("task_pairs", [2_000_000, 5])
def test_choice_by_components(spark, task_pairs):
    """Small components in one task each, large ones by rounds, and both as a plain loop over all."""
    rng = random.Random(7)
    pairs = sorted({(x, 1000 + rng.randrange(60)) for x in range(80) for _ in range(rng.randint(0, 2))} | {(200 + i, 2000 + i + j) for i in range(20) for j in (0, 1)})
    cost = {p: rng.randrange(3) for p in pairs}
    frame = spark.createDataFrame([(a, a, b, cost[a, b]) for a, b in pairs], "l long, o long, r long, c int")
    taken, want = set(), set()
    for a in sorted({a for a, _ in pairs}):
        free = [(cost[a, b], b) for x, b in pairs if x == a and b not in taken]
        if free:
            taken.add(min(free)[1])
            want.add((a, min(free)[1]))
    got = resolve.chosen(frame, "l", "r", "o", ["c"], task_pairs)
    assert {(r.l, r.r) for r in got.collect()} == want and got.columns == ["l", "r", "o", "c"]


def test_alike_names_lose_nothing(spark):
    rng = random.Random(11)
    name = lambda: "".join(rng.choice("aabbcdeé xyz") for _ in range(rng.randint(0, 9)))
    left, right = [(d, name()) for d in (1, 2) for _ in range(60)], [(d, name()) for d in (1, 2, 3) for _ in range(60)]
    found = {(r.d, r.x, r.y) for r in resolve.alike_names(spark.createDataFrame(left, "d int, x string"), spark.createDataFrame(right, "d int, y string"), ["d"]).collect()}
    bound = {(d, x, y) for d, x in left for e, y in right if d == e and difflib.SequenceMatcher(None, x, y).quick_ratio() >= 0.55 - 1e-9}
    assert found == bound and {(d, x, y) for d, x in left for e, y in right if d == e and difflib.SequenceMatcher(None, x, y).ratio() >= 0.55} <= found


def test_templates_told_back(spark):
    said = [("a", "{n} players"), ("b", "{name} has {n} of {n}"), ("c", "all"), ("d", "{x}"), ("e", "all {x}"), ("f", "(.*) {x}+[")]
    texts = ["5 players", "A b has 3 of 3", "A b has 3 of 4", "all", "all in", "(.*) q+[", "other", "", None, "{n} players", "x\ny players"]
    frame = spark.createDataFrame(list(enumerate(texts)), "text_id int, text string")
    got = {r.text_id: (r.key, r["values"]) for r in templates.told_back(frame, spark.createDataFrame(said, "key string, template string")).collect()}
    assert got == {
        0: ("a", {"n": "5"}), 1: ("b", {"name": "A b", "n": "3"}), 2: ("d", {"x": "A b has 3 of 4"}), 3: ("c", {}), 4: ("e", {"x": "in"}), 5: ("f", {"x": "q"}), 6: ("d", {"x": "other"}), 7: (None, None), 8: (None, None),
        9: ("a", {"n": "{n}"}), 10: ("a", {"n": "x\ny"}),
    }
    row = spark.range(1).select(templates.filled(F.lit("{a}-{b}-{a}{c}"), F.create_map(F.lit("a"), F.lit("{b}"), F.lit("b"), F.lit("2"))).alias("v")).first()
    assert row.v == "{b}-2-{b}{c}"


def test_gazetteer(spark):
    key = lambda c: scalar.normalize_key(c, ascii_only=True)
    places = spark.createDataFrame(
        [(1, "Perth", "Perth", "Boorloo,Pertho", "AU", "08", 2_000_000, -31.9, 115.8, 1), (2, "Perth", "Perth", None, "GB", "SCT", 47_000, 56.4, -3.4, 2), (3, "Springfield", "", "", "US", "IL", 100, 1.0, 2.0, 3), (4, "Springfield", "", "", "US", "MA", 300, 3.0, 4.0, 4), (5, "springfield", "", "", "US", "MO", 300, 5.0, 6.0, 5)],
        "place_id int, name string, ascii_name string, other_names string, country_code string, admin1 string, population int, lat double, lon double, line int",
    )
    countries = gazetteer.country_index(spark.createDataFrame([("AU", "AUS", "AS", "Australia", 1), ("GB", "GBR", "UK", "United Kingdom", 2), ("US", "USA", "US", "United States", 3)], "code string, iso3 string, fips string, name string, line int"), key, {"scotland": "GB"})
    areas = gazetteer.area_index(spark.createDataFrame([("US.MA", "Massachusetts", "Massachusetts", 1), ("US.IL", "Illinois", "", 2), ("bad", "x", "y", 3)], "code string, name string, ascii_name string, line int"), key)
    asked = [(1, "pertho", "Australia", None), (2, "Perth", "scotland", "x"), (3, "Springfield", "USA", "il"), (4, "Springfield", "usa", "Massachusetts"), (5, "Springfield", "US", None), (6, "Perth", "Mars", None), (7, None, "US", None), (8, "Perth", None, None), (9, "Springfield", "US", "unknown")]
    frame = spark.createDataFrame(asked, "request_id int, city string, country string, area string")
    by_area = {r.request_id: (r.place_id, r.candidates) for r in gazetteer.resolve_places(frame, places, countries, key, areas).collect()}
    assert by_area == {1: (1, 1), 2: (2, 1), 3: (3, 1), 4: (4, 1), 5: (4, 3), 6: (None, 0), 7: (None, 0), 8: (None, 0), 9: (4, 3)}
    by_code = {r.request_id: r.place_id for r in gazetteer.resolve_places(frame, places, countries, key).collect()}
    assert by_code == {1: 1, 2: 2, 3: 3, 4: None, 5: 4, 6: None, 7: None, 8: None, 9: None}
    assert gazetteer.resolve_places(frame.limit(0), places, countries, key).count() == 0


def test_match_documents_of_mixed_shapes(spark):
    ball = lambda **x: {"batter": "b", "bowler": "p", "runs": {"batter": 4, "total": 5}, **x}
    doc = {"innings": [
        {"overs": [{"deliveries": [
            ball(), ball(extras={"wides": 1}), ball(extras={"noballs": 1, "byes": 2, "penalty": 1}), ball(wickets=[{"kind": "Caught", "fielders": ["f", {"name": "g"}, {"substitute": True}]}]),
            ball(wickets=[{"kind": "caught and bowled"}, {"kind": "run out", "fielders": [{"name": "f"}]}]), ball(wickets=[{"kind": "timed out"}]), {"bowler": "p"},
        ]}, {}]},
        {"super_over": True, "overs": [{"deliveries": [ball()]}]}, {},
    ]}
    rows = spark.createDataFrame([(1, json.dumps(doc)), (2, "{}"), (3, '{"innings": null}')], "match_id int, d string").select("match_id", F.parse_json("d").alias("doc"))
    got = {r.id: r for r in metrics.cricket_totals(metrics.match_deliveries(rows)).collect()}
    assert set(got) == {"b", "p", "f", "g"}
    assert (got["b"].runs, got["b"].fours, got["b"].faced, got["b"].batting_innings) == (24, 6, 5, 1)
    assert (got["p"].bowled, got["p"].conceded, got["p"].wickets, got["p"].catches, got["p"].run_outs) == (5, 27, 2, 1, 0)
    assert (got["f"].catches, got["f"].run_outs, got["g"].catches, got["g"].batting_innings) == (1, 1, 1, 0)


def test_innings_are_counted_where_deliveries_are_read(spark):
    ball = lambda batter, **x: {"batter": batter, "bowler": "p", "runs": {"batter": 1, "total": 1}, **x}
    over = lambda *balls: {"overs": [{"deliveries": list(balls)}, {"deliveries": None}, {}]}
    first = {"innings": [over(ball("a"), ball("b"), ball("a"), {"bowler": "p"}), over(ball("b", extras=[])), {"overs": [{"deliveries": []}]}, None]}
    second = {"innings": [over(ball("a", wickets=None), ball("c", wickets=[{"kind": "caught", "fielders": None}, {"kind": "caught and bowled", "fielders": None}]))]}
    rows = spark.createDataFrame([(1, json.dumps(first)), (2, json.dumps(second)), (3, None)], "match_id int, d string").select("match_id", F.parse_json("d").alias("doc"))
    balls = metrics.match_deliveries(rows)
    assert sorted((r.match_id, r.innings, sorted(filter(None, r.batters))) for r in balls.where("batters IS NOT NULL").collect()) == [(1, 0, ["a", "b"]), (1, 1, ["b"]), (2, 0, ["a", "c"])]
    got = {r.id: r for r in metrics.cricket_totals(balls).collect()}
    assert {k: (r.runs, r.faced, r.batting_innings) for k, r in got.items()} == {"a": (3, 3, 2), "b": (2, 2, 2), "c": (1, 1, 1), "p": (0, 0, 0)}
    assert (got["p"].bowled, got["p"].conceded, got["p"].wickets, got["p"].catches) == (7, 6, 2, 1)
    for torn in ('{"innings": {"overs": []}}', '{"innings": [{"overs": 1}]}', '{"innings": [{"overs": [{"deliveries": "x"}]}]}', '{"innings": [{"overs": [{"deliveries": [{"wickets": {}}]}]}]}'):
        bad = spark.createDataFrame([(1, torn)], "match_id int, d string").select("match_id", F.parse_json("d").alias("doc"))
        with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
            metrics.cricket_totals(metrics.match_deliveries(bad)).collect()


def test_match_documents_are_made_once(spark, tmp_path, monkeypatch):
    """Lines are read once and move once, into as many tasks as their number asks for."""
    from terravane.plans import landing as plans

    monkeypatch.setattr(plans, "LINES_OF_A_TASK", 100)
    lines = [(k // 5, k % 7 + 1, k % 11, k % 13, float(k % 50), (k % 11) / 100, "R" if k % 3 == 0 else "N") for k in range(500)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_discount double, l_returnflag string").write.parquet(str(tmp_path / "lineitem.parquet"))
    frame = plans.match_document_totals(spark, str(tmp_path))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange ") == 2 and plan.count("REPARTITION_BY_NUM") == 1
    assert plans.match_documents(spark, str(tmp_path)).rdd.getNumPartitions() == 6
    assert sum(r.batting_innings for r in frame.collect()) == len({(k, n % 3, s % 10) for k, n, _, s, *_ in lines if n % 3 < 2})


def test_fighters_of_both_genders_fail(spark):
    fights = spark.createDataFrame([(1, "a", "b", "W", "L", "Men", "x", "KO", True, dt.date(2025, 1, 1)), (2, "a", "c", "W", "L", "Women", "x", "KO", True, dt.date(2025, 1, 2))], "fight_id int, first_id string, second_id string, first_result string, second_result string, gender string, division string, method string, title boolean, on date")
    none = metrics.fight_rounds(spark.createDataFrame([], "fight_id int"))
    with pytest.raises(Exception, match="both genders"):
        metrics.fighter_splits(fights, none).select("bouts").collect()
    one = {r.fighter_id: r for r in metrics.fighter_splits(fights.limit(1), none).collect()}
    assert one["a"].ko_wins == 1 and one["b"].losses == 1 and one["a"].detailed_bouts == 0 and one["a"].knockdowns == 0
