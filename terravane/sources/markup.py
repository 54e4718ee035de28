"""Tables and fields inside HTML, Markdown and extracted text. HTML is parsed by the standard library's parser in Arrow batches; everything after it is JVM-side."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QUIET = frozenset(("script", "style", "template"))
# The formats of linked data, of application data and of ranking tables in Markdown.
LINKED_DATA = r"""(?s)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
APPLICATION_DATA = r'(?s)<script id="__NEXT_DATA__" type="application/json">(.*?)</script>'
RANKED_LINE, PLAYER_LINK = r"^\|\s*\d+\s*\|", r'\[([^\]]+)\]\(https?://[^/\s)]+/player/(\d+)/[^\s)]*(?:\s+"[^"]*")?\)'
FLAG_IMAGE, CAPITALS, POINTS = r"Image\s+\d+:\s+([A-Z]{3})", r"\b([A-Z]{3})\b", r"([\d,]+)\s*/\s*(\d+)"


class _Tables(HTMLParser):
    """All tables of a document in the order of their starts; the cells of a nested table are its own and no text of the cell around it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.open: list[tuple[list, list[str] | None]] = []
        self.quiet = 0

    def handle_starttag(self, tag, attrs):
        if tag in _QUIET:
            self.quiet += 1
        elif tag == "table":
            table: list[list[str]] = []
            self.tables.append(table)
            self.open.append((table, None))
        elif self.open and tag == "tr":
            self._end()
            self.open[-1][0].append([])
        elif self.open and tag in ("td", "th"):
            self._end()
            table, _ = self.open[-1]
            if not table:
                table.append([])
            self.open[-1] = (table, [])
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        if tag in _QUIET:
            self.quiet = max(0, self.quiet - 1)
        elif self.open and tag in ("td", "th", "tr"):
            self._end()
        elif self.open and tag == "table":
            self._end()
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1][1] is not None and not self.quiet:
            self.open[-1][1].append(data)

    def _end(self) -> None:
        table, cell = self.open[-1]
        if cell is not None:
            table[-1].append(" ".join("".join(cell).split()))
            self.open[-1] = (table, None)


class _Lines(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[str] = []
        self.quiet = 0

    def handle_starttag(self, tag, attrs):
        self.quiet += tag in _QUIET

    def handle_endtag(self, tag):
        self.quiet = max(0, self.quiet - (tag in _QUIET))

    def handle_data(self, data):
        if not self.quiet and data.strip():
            self.lines.append(data.strip())


def _parsed(html: str, kind: type) -> HTMLParser:
    parser = kind()
    parser.feed(html)
    parser.close()
    while getattr(parser, "open", None):  # tables that never end
        parser._end()
        parser.open.pop()
    return parser


@F.pandas_udf(T.ArrayType(T.ArrayType(T.ArrayType(T.StringType()))))
def html_tables(html: pd.Series) -> pd.Series:
    """Tables of a document, array<rows of cells>; null gives null, a document without a table an empty list."""
    return html.map(lambda h: None if h is None else _parsed(h, _Tables).tables)


@F.pandas_udf(T.StringType())
def visible_lines(html: pd.Series) -> pd.Series:
    """The text nodes of a document, trimmed, one a line; scripts, styles and comments are left out."""
    return html.map(lambda h: None if h is None else "\n".join(_parsed(h, _Lines).lines))


def table_records(tables: Column, headers: list[str]) -> Column:
    """array<map<header, cell>> of the first table whose first row holds all ``headers`` (compared without case); columns are found by their header, short rows have nulls."""
    low = lambda row: F.transform(row, lambda c: F.lower(c))
    wanted = F.array(*[F.lit(h.lower()) for h in headers])
    table = F.get(F.filter(tables, lambda t: (F.size(t) > 0) & (F.size(F.array_except(wanted, low(F.get(t, F.lit(0))))) == 0)), F.lit(0))
    # bound once: the table as the one element of an array
    made = F.transform(
        F.array(table),
        lambda t: F.transform(
            F.slice(t, 2, F.size(t)),
            lambda row: F.map_from_arrays(F.array(*[F.lit(h) for h in headers]), F.array(*[F.get(row, F.array_position(low(F.get(t, F.lit(0))), h.lower()).cast("int") - 1) for h in headers])),
        ),
    )
    return F.when(table.isNotNull(), F.get(made, F.lit(0)))


def label_value(lines: Column, label: str) -> Column:
    """The text after a label, on its line or the next one; null without it."""
    return F.nullif(F.trim(F.regexp_extract(lines, rf"(?i)\Q{label}\E\s*:?\s*\n?\s*([^\n]+)", 1)), F.lit(""))


def json_ld(html: Column) -> Column:
    """JSON texts of the linked-data scripts of a document."""
    return F.regexp_extract_all(html, F.lit(LINKED_DATA), 1)


def next_data(html: Column, path: str = "$.props.pageProps") -> Column:
    """JSON text under ``path`` of a page's application data; null without it."""
    return F.get_json_object(F.nullif(F.regexp_extract(html, APPLICATION_DATA, 1), F.lit("")), path)


def markdown_ranking(df: DataFrame, text: str, keep: list[str], limit: int) -> DataFrame:
    """Ranking tables in Markdown (rank | country | players as links | .. | points / tournaments in the seventh cell) -> keep, rank, players, countries, points, tournaments.

    Lines that do not start with a rank, have fewer than seven cells or a rank beyond ``limit`` are left out. Players are array<struct<name, player_id>> by the number in their link; countries are three capitals.
    """
    line = F.explode(F.filter(F.split(text, r"\r\n|\r|\n"), lambda s: s.rlike(RANKED_LINE)))
    cells = F.transform(F.split(F.btrim(F.trim("line"), F.lit("|")), r"\|"), lambda c: F.trim(c))
    rows = df.select(*keep, line.alias("line")).select(*keep, cells.alias("c")).where(F.size("c") >= 7)
    c = lambda i: F.get("c", F.lit(i))
    names, ids = F.regexp_extract_all(c(2), F.lit(PLAYER_LINK), 1), F.regexp_extract_all(c(2), F.lit(PLAYER_LINK), 2)
    players = F.transform(F.arrays_zip(names.alias("name"), ids.alias("player_id")), lambda p: F.struct(F.regexp_replace(F.trim(p["name"]), r"\s+", " ").alias("name"), p["player_id"].alias("player_id")))
    marked, bare = F.regexp_extract_all(c(1), F.lit(FLAG_IMAGE), 1), F.regexp_extract_all(c(1), F.lit(CAPITALS), 1)
    return rows.select(
        *keep, c(0).cast("int").alias("rank"), players.alias("players"), F.when(F.size(marked) >= F.size(names), marked).otherwise(bare).alias("countries"),
        F.replace(F.regexp_extract(c(6), POINTS, 1), F.lit(","), F.lit("")).try_cast("long").alias("points"), F.regexp_extract(c(6), POINTS, 2).try_cast("long").alias("tournaments"),
    ).where(F.col("rank") <= limit)


def text_rows(df: DataFrame, text: str, keep: list[str], pattern: str, names: list[str]) -> DataFrame:
    """Every match of ``pattern`` in an extracted text (of a PDF, say), its groups as the columns ``names``."""
    groups = [F.regexp_extract_all(text, F.lit(pattern), i + 1).alias(n) for i, n in enumerate(names)]
    return df.select(*keep, F.inline(F.arrays_zip(*groups)))


def positioned_rows(words: DataFrame, page: list[str], columns: dict[str, tuple[float, float]], anchor: str, pattern: str = r"^\d+$", height: float = 3.0) -> DataFrame:
    """Words with their places (page, x0, top, text) -> a row for every word of the column ``anchor`` that fits ``pattern``: page, its top, and the words of each column on its line.

    A word is on the anchor's line if their tops are less than ``height`` apart; columns are ranges of x0, their words joined left to right. Anchors meet words by
    the band of their top and its neighbours, so nearness does not depend on where bands begin.
    """
    left, right = columns[anchor]
    band = F.floor(F.col("top") / height)
    anchors = words.where((F.col("x0") >= left) & (F.col("x0") < right) & F.col("text").rlike(pattern)).select(*page, F.col("top").alias("_top"), F.col("x0").alias("_x0"), F.explode(F.array(band - 1, band, band + 1)).alias("_band"))
    near = anchors.join(words.withColumn("_band", band), [*page, "_band"]).where(F.abs(F.col("top") - F.col("_top")) < height)
    cells = [
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when((F.col("x0") >= low) & (F.col("x0") < high), F.struct("x0", "text")))), lambda w: w["text"]), " ").alias(name)
        for name, (low, high) in columns.items()
    ]
    return near.groupBy(*page, "_top", "_x0").agg(*cells).withColumnRenamed("_top", "top").drop("_x0")


# two noncharacters that no text holds stand for line ends inside quotes
_IN_QUOTES = "\ufdd0\ufdd1"


def csv_records(text: Column) -> Column:
    """The records of a CSV text, blank ones left out: lines, joined where a line end stands inside quotes.

    A quote opens or closes, so an odd number of them before a line end leaves it open; a doubled quote closes and opens again.
    """
    held = F.transform(F.split(text, '"', -1), lambda part, i: F.when(i % 2 == 1, F.translate(part, "\n\r", _IN_QUOTES)).otherwise(part))
    lines = F.split(F.array_join(held, '"'), r"\r\n|\r|\n")
    return F.transform(F.filter(lines, lambda s: F.trim(s) != ""), lambda s: F.translate(s, _IN_QUOTES, "\n\r"))


CSV_OPTIONS = {"escape": '"', "maxCharsPerColumn": "-1"}


def csv_rows(df: DataFrame, text: str, keep: list[str], schema: str) -> DataFrame:
    """CSV documents held in a column, header first -> their rows under ``schema`` (the header's names are not compared). Quoted fields may hold line ends, commas and doubled quotes."""
    records = F.slice(csv_records(F.regexp_replace(text, "^\ufeff", "")), 2, 1 << 30)
    return df.select(*keep, F.explode(records).alias("_line")).select(*keep, F.from_csv("_line", schema, CSV_OPTIONS).alias("_r")).select(*keep, "_r.*")


def ranking_cohort(rankings: DataFrame, players: DataFrame, date: str, limit: int) -> DataFrame:
    """Rankings (ranking_date, rank, player, points) of one date up to ``limit`` with their players (player_id, name).

    Fails when it runs unless the ranks are exactly 1 to ``limit`` over as many players, and each has its metadata and points; a date without rows fails too. The checks are
    conditions on the rows, so they hold whichever columns are read.
    """
    some = rankings.where((F.col("ranking_date") == date) & F.col("rank").between(1, limit))
    whole = some.agg(F.count("*").alias("_n"), F.count_distinct("rank").alias("_r"), F.count_distinct("player").alias("_p"))  # one row, of an empty date too
    exact = (F.col("_n") == limit) & (F.col("_r") == limit) & (F.col("_p") == limit)
    lacking = F.col("name").isNull() | (F.trim("name") == "") | F.col("points").isNull()
    joined = whole.join(some.select("rank", "player", "points"), F.lit(True), "left").join(players.select("player_id", "name"), F.col("player") == F.col("player_id"), "left")
    ok = F.when(~exact, F.raise_error(F.lit(f"expected the exact ranks 1 to {limit}")).cast("boolean")).when(
        lacking, F.raise_error(F.concat(F.lit("incomplete row at rank "), F.coalesce(F.col("rank").cast("string"), F.lit("none")))).cast("boolean")
    ).otherwise(True)
    return joined.where(ok).select("rank", "player", "name", "points")


_ENDS = {"[[": "]]", "{{": "}}", "<!--": "-->", "<": ">"}


def _shown(raw: str) -> tuple[str, str | None]:
    """Reads wikitext from left to right: what it shows, and the title of its first link. Links show their label, comments, references, flags and tags show nothing, a line break is a comma."""
    shown, title, at = [], None, 0
    while at < len(raw):
        mark = next((m for m in _ENDS if raw.startswith(m, at)), None)
        end = raw.find(_ENDS[mark], at + len(mark)) if mark else -1
        if end < 0:
            shown.append(raw[at])
            at += 1
            continue
        inner, after = raw[at + len(mark) : end], end + len(_ENDS[mark])
        name = inner.strip().lower()
        if mark == "[[":
            target, _, label = inner.partition("|")
            shown.append(_shown(label or target)[0])
            title = title or target.partition("#")[0].strip() or None
        elif mark == "{{":
            shown.append("" if name.startswith(("flag", "country")) else raw[at:after])
        elif mark == "<" and name.startswith("ref") and not name.endswith("/"):
            close = raw.lower().find("</ref>", after)
            after = close + len("</ref>") if close >= 0 else after
        elif mark == "<" and name.rstrip("/ ") == "br":
            shown.append(",")
        at = after
    return "".join(shown), title


def _infobox_value(raw: str) -> tuple[str | None, str | None]:
    """Text and title of a field: quote marks of emphasis go, commas stand tight before and a space after, none at the ends."""
    shown, title = _shown(raw)
    text = ", ".join(part.strip() for part in re.sub("'{2,}", "", shown).split(",")).strip(" ,")
    return text or None, title


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("title", T.StringType())]))
def _infobox_values(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None, None) if v is None else _infobox_value(v) for v in raw], columns=["text", "title"])


def infobox_field(wikitext: Column, name: str) -> Column:
    """struct<text, title> of the first infobox line of that name: what it shows, and the title of its first link; nulls where the field is absent or blank."""
    line = F.get(F.filter(F.split(wikitext, r"\r?\n"), lambda s: s.rlike(rf"(?i)^[ \t]*\|[ \t]*{name}[ \t]*=")), F.lit(0))
    return _infobox_values(F.trim(F.substr(line, F.instr(line, "=") + 1)))


class Tables:
    """Tables read once: ``get`` returns the same lazy DataFrame for the same key and keeps it cached on the executors until ``clear``."""

    def __init__(self) -> None:
        self._held: dict[tuple, DataFrame] = {}

    def get(self, key: tuple, load) -> DataFrame:
        if key not in self._held:
            self._held[key] = load().cache()
        return self._held[key]

    def clear(self) -> None:
        for df in self._held.values():
            df.unpersist()
        self._held.clear()
