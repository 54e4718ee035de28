"""Column functions: keys, dates, lenient numbers, names and places. All are JVM-side expressions but ``round_binary``."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@functools.cache
def _decompositions(marks: bool) -> tuple[str, str, dict[str, str]]:
    """Compatibility decompositions of all letters, less their marks: (letters, their single letters, letters -> several).

    ``marks`` tells whether all combining marks go, or only U+0300 to U+036F. Letters without a counterpart stand last, so ``translate`` drops them. Hangul syllables are a rule of their own.
    """
    gone = (lambda c: unicodedata.combining(c) != 0) if marks else (lambda c: "\u0300" <= c <= "\u036f")
    one, none, several = [], [], {}
    for letter in map(chr, [*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xE000, 0x30000)]):
        left = "".join(c for c in unicodedata.normalize("NFKD", letter) if not gone(c))
        if left == letter:
            continue
        if len(left) > 1:
            several[letter] = left
        else:
            (one if left else none).append((letter, left))
    return "".join(x for x, _ in one + none), "".join(y for _, y in one), several


def _decomposed(value: Column, marks: bool) -> Column:
    """Letters with one counterpart go by ``translate``; those with several and Hangul syllables by a map, only in texts that have one."""
    letters, single, several = _decompositions(marks)
    plain = F.translate(value, letters, single)
    known = F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in sorted(several.items()))), F.lit("\x01"), F.lit("\x02"))  # folded to one constant of the plan
    first, middle, last = ([F.lit(chr(c)) for c in range(low, low + n)] for low, n in ((0x1100, 19), (0x1161, 21), (0x11A7, 28)))
    last[0] = F.lit("")

    def parts(c: Column) -> Column:
        place = F.ascii(c) - 0xAC00
        syllable = F.concat(F.get(F.array(*first), F.floor(place / 588).cast("int")), F.get(F.array(*middle), F.floor(place % 588 / 28).cast("int")), F.get(F.array(*last), (place % 28).cast("int")))
        return F.when(c < "\u0080", c).when(c.between("\uac00", "\ud7a3"), syllable).otherwise(F.coalesce(F.try_element_at(known, c), c))

    runs: list[list[str]] = []
    for letter in sorted(several):
        if runs and ord(letter) == ord(runs[-1][1]) + 1:
            runs[-1][1] = letter
        else:
            runs.append([letter, letter])
    some = "[" + "".join(f"{a}-{b}" for a, b in runs) + "\uac00-\ud7a3]"
    wide = F.when(plain.rlike(some), F.array_join(F.transform(F.regexp_extract_all(plain, F.lit("(?s)."), 0), parts), "")).otherwise(plain)
    return F.when(value.rlike("[^\\x00-\\x7F]"), wide).otherwise(value)  # ASCII texts are as they are


def fold_accents(value: Column) -> Column:
    """Compatibility decomposition without combining marks, letter by letter."""
    return _decomposed(value, marks=True)


def strip_diacritics(value: Column) -> Column:
    """Compatibility decomposition without the marks U+0300 to U+036F, letter by letter; other combining marks stay where they stand."""
    return _decomposed(value, marks=False)


def premap(value: Column) -> Column:
    """Letters that decomposition leaves whole."""
    return F.translate(value, "øØłŁđĐðÐ", "oOlLdDdD")


def normalize_key(value: Column, premapped: bool = False, ascii_only: bool = False) -> Column:
    """ASCII letters and digits of the folded, lower-cased value; letters without a decomposition drop out unless ``premapped``. Null gives ''.

    ``ascii_only`` skips the folding where the input needs none.
    """
    value = F.coalesce(value, F.lit(""))
    folded = value if ascii_only else fold_accents(premap(value) if premapped else value)
    return F.regexp_replace(F.lower(folded), "[^a-z0-9]", "")


def search_text(value: Column, ascii_only: bool = False) -> Column:
    """Lower-cased without diacritics; punctuation stays. Null gives ''."""
    value = F.coalesce(value, F.lit(""))
    return F.lower(value if ascii_only else strip_diacritics(value))


def country_key(value: Column, ascii_only: bool = False) -> Column:
    """``search_text`` without anything but ASCII letters and digits."""
    return F.regexp_replace(search_text(value, ascii_only), "[^a-z0-9]", "")


def slug(value: Column, ascii_only: bool = True) -> Column:
    """Runs of ASCII letters and digits joined by dashes; other letters are folded first unless ``ascii_only``, and dropped where they have no ASCII form."""
    flat = value if ascii_only else F.regexp_replace(fold_accents(value), r"[^\x00-\x7F]", "")
    return F.btrim(F.regexp_replace(F.lower(flat), "[^a-z0-9]+", "-"), F.lit("-"))


def profile_id(name: Column, born: Column, nation: Column, prefix: str = "top5", ascii_only: bool = False) -> Column:
    """``prefix:slug:year``; without a birth year ``prefix:slug:unknown-nation``."""
    year = F.when(born.isNotNull(), born.cast("double").cast("long").cast("string")).otherwise(F.concat(F.lit("unknown-"), slug(nation, ascii_only)))
    return F.concat(F.lit(f"{prefix}:"), slug(name, ascii_only), F.lit(":"), year)


def profile_url(name: Column, base: str, ascii_only: bool = False) -> Column:
    return F.concat(F.lit(base), slug(name, ascii_only))


def url_or_name_id(url: Column, name: Column, prefix: str = "wiki-", ascii_only: bool = False) -> Column:
    """The last path segment of the url if it is sixteen hex digits, or else the prefix and sixteen digits of the SHA-1 of the name's key."""
    last = F.regexp_extract(F.coalesce(url, F.lit("")), r"([^/]*)/*$", 1)
    named = F.concat(F.lit(prefix), F.substring(F.sha1(normalize_key(name, ascii_only=ascii_only).cast("binary")), 1, 16))
    return F.when(last.rlike("^[0-9a-f]{16}$"), last).otherwise(named)


def cache_key(value: Column, digits: int = 24) -> Column:
    """The first digits of the SHA-256."""
    return F.substring(F.sha2(value.cast("binary"), 256), 1, digits)


def stable_id(name: Column, url: Column, born: Column) -> Column:
    """Sixteen hex digits of the SHA-1 of the url, or else of name and birth date; null without a name."""
    base = F.coalesce(F.nullif(F.trim(url), F.lit("")), F.concat(F.lower(F.trim(name)), F.lit("|"), F.coalesce(born, F.lit(""))))
    return F.when(F.coalesce(F.trim(name), F.lit("")) != "", F.substring(F.sha1(base.cast("binary")), 1, 16))


def season_label(end_year: Column) -> Column:
    return F.concat((end_year - 1).cast("string"), F.lit("-"), F.lpad((end_year % 100).cast("string"), 2, "0"))


def season_end_year(value: Column) -> Column:
    """``2006``, ``2005-06``, ``2005 / 06`` and ``2005/2006`` name 2006; 1999-00 rolls over, and so does a short end equal to its start (2005-05 is 2105); anything else is null."""
    v = F.trim(value.cast("string"))
    pattern = r"^(\d{4})\s*[-/]\s*(\d{2}|\d{4})$"
    start = F.regexp_extract(v, pattern, 1).try_cast("int")
    end = F.regexp_extract(v, pattern, 2)
    short = (F.floor(start / 100) * 100).cast("int") + end.try_cast("int")
    return (
        F.when(v.rlike(r"^\d{4}$"), v.try_cast("int"))
        .when(F.length(end) == 4, end.try_cast("int"))
        .when(F.length(end) == 2, F.when(short <= start, short + 100).otherwise(short))
    )


def age_on(born: Column, on: Column) -> Column:
    """Completed years; a 29 February birthday completes on 1 March of common years."""
    early = F.date_format(on, "MMdd") < F.date_format(born, "MMdd")
    return F.year(on) - F.year(born) - F.when(early, 1).otherwise(0)


def parse_date(value: Column) -> Column:
    """ISO, day-first, month names and yyyyMMdd; a placeholder such as 19000000 is null."""
    v = F.trim(value)
    tries = ("yyyy-MM-dd", "d/M/yyyy", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy", "yyyyMMdd")
    return F.coalesce(*[F.try_to_timestamp(v, F.lit(p)).cast("date") for p in tries])


def age_at(born: Column, birth_year: Column, on: Column) -> Column:
    """struct<age, exact>: completed years where the birth date is known, or else the difference of the years; null without either."""
    year = F.year(on) - birth_year.cast("int")
    return F.when(born.isNotNull(), F.struct(age_on(born, on).alias("age"), F.lit(True).alias("exact"))).otherwise(F.struct(year.alias("age"), F.lit(False).alias("exact")))


def lenient_int(value: Column) -> Column:
    """Floats are cut, dashes and blanks and anything else count as 0."""
    number = F.trim(value.cast("string")).try_cast("double")
    return F.coalesce(F.when(~F.isnan(number), number).cast("long"), F.lit(0).cast("long"))


def whole_int(value: Column) -> Column:
    """Whole numbers only: a float, a dash, a blank and anything else count as 0."""
    v = F.trim(value.cast("string"))
    return F.when(v.rlike(r"^[+-]?\d+$"), v.try_cast("long")).otherwise(F.lit(0).cast("long"))


def first_int(value: Column, signed: bool = False) -> Column:
    """The first run of digits in a text, 0 without one."""
    return F.coalesce(F.regexp_extract(value, r"(-?\d+)" if signed else r"(\d+)", 1).try_cast("long"), F.lit(0).cast("long"))


_OF = r"(?i)^\s*(\d+)\s+of\s+(\d+)"


def landed(value: Column) -> Column:
    """The first number of a text that begins ``x of y``, 0 for any other."""
    return F.coalesce(F.regexp_extract(value, _OF, 1).try_cast("long"), F.lit(0).cast("long"))


def attempted(value: Column) -> Column:
    return F.coalesce(F.regexp_extract(value, _OF, 2).try_cast("long"), F.lit(0).cast("long"))


def wkt_point(value: Column) -> Column:
    """``Point(lon lat)`` -> struct<lat, lon>; null where it is no point."""
    pattern = r"(?i)^point\s*\(\s*(-?[\d.]+)\s+(-?[\d.]+)\s*\)$"
    return F.when(value.rlike(pattern), F.struct(F.regexp_extract(value, pattern, 2).try_cast("double").alias("lat"), F.regexp_extract(value, pattern, 1).try_cast("double").alias("lon")))


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def page_title(url: Column) -> Column:
    """Title of a page of the English encyclopedia, decoded, underscores as spaces; null for other hosts and without a title."""
    path = F.regexp_replace(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?(?:www\.)?en\.wikipedia\.org(?::\d*)?(/[^?#]*)", 1), ";[^/]*$", "")
    raw = F.when(F.contains(path, F.lit("/wiki/")), F.regexp_extract(path, "^.*?/wiki/(.*)$", 1))
    # a plus is a plus here, and a percent sign without two digits stands for itself
    coded = F.regexp_replace(F.replace(raw, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.nullif(F.trim(F.replace(F.try_url_decode(coded), F.lit("_"), F.lit(" "))), F.lit(""))


def title_case(word: Column) -> Column:
    """A capital after anything that is no letter, small letters after letters: O'NEIL-SMITH is O'Neil-Smith."""
    letters = F.split(word, "")
    after = lambda i: F.coalesce(F.get(letters, i - 1).rlike(r"^\p{L}$"), F.lit(False))
    return F.array_join(F.transform(letters, lambda c, i: F.when(after(i), F.lower(c)).otherwise(F.upper(c))), "")


def _loud(word: Column) -> Column:
    return (word == F.upper(word)) & (word != F.lower(word))


# Particles that can stand in a surname in any case.
PARTICLES = ("van", "von", "der", "den", "de", "del", "da", "do", "du", "le", "la")


def _split_at(parts: Column, ends) -> Column:
    """Words from the first one for which the Column function ``ends`` holds, then the ones before it with capitals eased."""
    flags = F.transform(parts, ends)
    first = F.coalesce(F.nullif(F.array_position(flags, True), F.lit(0).cast("long")).cast("int"), F.size(parts) + 1)
    surname = F.transform(F.slice(parts, 1, first - 1), lambda w: F.when(_loud(w), title_case(w)).otherwise(w))
    return F.array_join(F.concat(F.slice(parts, first, F.size(parts)), surname), " ")


def given_name_first(value: Column) -> Column:
    """``VAN der POEL Mathieu`` -> ``Mathieu Van der Poel``: the leading words in capitals, with particles among them, are the surname. Words in capitals after the given name stay."""
    return _split_at(F.split(F.trim(value), r"\s+"), lambda w: ~F.lower(w).isin(*PARTICLES) & ~_loud(w))


def capitals_last(value: Column) -> Column:
    """The variant without particles: every leading word that equals its upper case is the surname; a name all in capitals is only eased."""
    parts = F.split(F.trim(value), r"\s+")
    quiet = F.exists(parts, lambda w: w != F.upper(w))
    return F.when(quiet, _split_at(parts, lambda w: w != F.upper(w))).otherwise(F.array_join(F.transform(parts, title_case), " "))


def ease_capitals(value: Column) -> Column:
    """Words all in capitals in title case, others as they are."""
    return F.array_join(F.transform(F.split(F.trim(value), r"\s+"), lambda w: F.when(_loud(w), title_case(w)).otherwise(w)), " ")


def name_key(value: Column, ascii_only: bool = False) -> Column:
    folded = F.lower(value if ascii_only else fold_accents(premap(value)))
    return F.array_join(F.array_sort(F.filter(F.split(F.regexp_replace(folded, "[^a-z0-9]+", " "), " "), lambda w: w != "")), " ")


def full_name(given: Column, family: Column) -> Column:
    part = lambda c: F.nullif(F.when(F.lower(F.trim(c)) == "not applicable", F.lit("")).otherwise(F.trim(c)), F.lit(""))
    return F.nullif(F.concat_ws(" ", part(given), part(family)), F.lit(""))


def split_list(value: Column, mark: str = ";") -> Column:
    """Trimmed parts that are not blank; null gives an empty list."""
    value = F.coalesce(value, F.lit(""))
    return F.filter(F.transform(F.split(value, mark), lambda x: F.trim(x)), lambda x: x != "")


def valid_coordinates(lat: Column, lon: Column) -> Column:
    ok = lat.between(-90, 90) & lon.between(-180, 180) & ~F.isnan(lat) & ~F.isnan(lon)
    return F.coalesce(ok, F.lit(False))


def grid_cell(lat: Column, lon: Column, resolution: int) -> Column:
    """Deterministic square cell, halved with each resolution step from 10 degrees; null for invalid coordinates."""
    size = 10.0 / 2**resolution
    code = F.concat_ws(":", F.lit(resolution), F.floor((lat + 90) / size).cast("long"), F.floor((lon + 180) / size).cast("long"))
    return F.when(valid_coordinates(lat, lon), code)


def cell_parent(cell: Column) -> Column:
    """The cell one resolution coarser that holds it; null at resolution 0."""
    part = lambda i: F.get(F.split(cell, ":"), F.lit(i)).cast("long")
    return F.when(part(0) > 0, F.concat_ws(":", part(0) - 1, F.floor(part(1) / 2).cast("long"), F.floor(part(2) / 2).cast("long")))


def cell_ring(cell: Column) -> Column:
    """Closed ring of a cell's corners, array<struct<lon, lat>>; cells do not cross the antimeridian, as they start there."""
    part = lambda i: F.get(F.split(cell, ":"), F.lit(i)).cast("long")
    size = F.lit(10.0) / F.pow(F.lit(2.0), part(0))
    south, west = part(1) * size - 90, part(2) * size - 180
    corner = lambda dx, dy: F.struct((west + size * dx).alias("lon"), (south + size * dy).alias("lat"))
    return F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1), corner(0, 0))


def cell_area(cell: Column, radius_km: float = 6371.0088) -> Column:
    """Square kilometres of a cell on a sphere."""
    ring = cell_ring(cell)
    south, north = F.radians(F.get(ring, F.lit(0))["lat"]), F.radians(F.get(ring, F.lit(2))["lat"])
    wide = F.radians(F.get(ring, F.lit(1))["lon"] - F.get(ring, F.lit(0))["lon"])
    return F.lit(radius_km**2) * wide * (F.sin(north) - F.sin(south))


# A bounding box (south, north, west, east) and the states that can end a city's name.
AUSTRALIA = (-44.5, -9.0, 112.0, 154.5)
STATES = ("NSW", "QLD", "VIC", "WA", "SA", "TAS", "ACT", "NT")


def inside_box(lat: Column, lon: Column, box: tuple[float, float, float, float] = AUSTRALIA) -> Column:
    return F.coalesce(lat.between(box[0], box[1]) & lon.between(box[2], box[3]), F.lit(False))


def first_coordinates(options: list[tuple[str, Column, Column]]) -> Column:
    """struct<lat, lon, precision> of the first option with both coordinates; ``unresolved`` without one."""
    found = [F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon"), F.lit(name).alias("precision"))) for name, lat, lon in options]
    none = F.lit(None).cast("double")
    return F.coalesce(*found, F.struct(none.alias("lat"), none.alias("lon"), F.lit("unresolved").alias("precision")))


def city_search_name(value: Column, no_cities: Column | None = None, ascii_only: bool = False) -> Column:
    """struct<name, country>: the part before the first comma with the rest as a country hint; an Australian state at the end is cut and hints AU. ``no_cities`` is an array of keys that name no city."""
    text = F.trim(value)
    comma = F.instr(text, ",") > 0
    name = F.when(comma, F.trim(F.substring_index(text, ",", 1))).otherwise(text)
    hint = F.when(comma, F.trim(F.regexp_extract(text, "(?s)^[^,]*,(.*)$", 1)))
    state = rf"(?i)\s+({'|'.join(STATES)})$"
    there = name.rlike(state)
    found = F.struct(F.when(there, F.trim(F.regexp_replace(name, state, ""))).otherwise(name).alias("name"), F.when(there, F.lit("AU")).otherwise(hint).alias("country"))
    bad = F.lit(False) if no_cities is None else F.array_contains(no_cities, normalize_key(found["name"], ascii_only=ascii_only))
    return F.when(F.coalesce(value, F.lit("")) != "", F.when(~bad, found))


def last_word(value: Column) -> Column:
    """The last word, as a nation code stands at the end of ``eng ENG``; null for blanks."""
    return F.nullif(F.regexp_extract(F.trim(value), r"(\S+)$", 1), F.lit(""))


def recode(value: Column, names: dict[str, str]) -> Column:
    """The name of a code, and the value itself where the map has none."""
    known = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair]) if names else None
    return value if known is None else F.coalesce(F.get(F.map_values(F.map_filter(known, lambda k, v: k == value)), F.lit(0)), value)


def discipline(event: Column) -> Column:
    """Family of an athletics event by words in its name, the first rule that holds."""
    has = lambda *words: F.coalesce(event.rlike("|".join(words)), F.lit(False))
    return (
        F.when(has("Relay"), "Relays").when(has("Decathlon", "Heptathlon"), "Combined events").when(has("Race Walk"), "Race walks")
        .when(has("Marathon"), "Road").when(has("Jump", "Vault"), "Jumps").when(has("Put", "Throw"), "Throws").otherwise("Track")
    )


def event_type(name: Column) -> Column:
    return F.when(F.coalesce(name.rlike(r"^UFC\s+\d"), F.lit(False)), "Numbered PPV").otherwise("Fight Night")


_CLAIM = "array<struct<rank: string, mainsnak: struct<snaktype: string, datavalue: struct<value: string>>>>"


def claim_value(entity: Column, prop: str) -> Column:
    """JSON text of a claim's value: the first preferred claim, or else the first one; null unless that snak holds a value."""
    claims = F.from_json(F.get_json_object(entity, f"$.claims.{prop}"), _CLAIM)
    chosen = F.coalesce(F.get(F.filter(claims, lambda c: c["rank"] == "preferred"), F.lit(0)), F.get(claims, F.lit(0)))["mainsnak"]
    return F.when(chosen["snaktype"] == "value", chosen["datavalue"]["value"])


def claim_entity(entity: Column, prop: str) -> Column:
    return F.get_json_object(claim_value(entity, prop), "$.id")


def claim_date(entity: Column, prop: str = "P569") -> Column:
    """The first ten characters of the time without its sign; null for shorter ones."""
    raw = F.ltrim(F.get_json_object(claim_value(entity, prop), "$.time"), F.lit("+"))
    return F.when(F.length(raw) >= 10, F.substring(raw, 1, 10))


def claim_coordinates(entity: Column, prop: str = "P625") -> Column:
    at = claim_value(entity, prop)
    return F.struct(F.get_json_object(at, "$.latitude").try_cast("double").alias("lat"), F.get_json_object(at, "$.longitude").try_cast("double").alias("lon"))


def entity_label(entity: Column) -> Column:
    """The English label, or else the first one that is not empty."""
    labels = F.from_json(F.get_json_object(entity, "$.labels"), "map<string, struct<value: string>>")
    other = F.get(F.filter(F.transform(F.map_values(labels), lambda x: x["value"]), lambda v: v != ""), F.lit(0))
    return F.when(F.array_contains(F.map_keys(labels), "en"), F.element_at(labels, "en")["value"]).otherwise(other)


@F.pandas_udf(T.DoubleType())
def round_binary(values: pd.Series, digits: pd.Series) -> pd.Series:
    """Half-even rounding of the binary value itself (2.675 to two digits is 2.67); ``F.round`` and ``F.bround`` round its decimal text."""
    return pd.Series([None if v is None or d is None or v != v else round(float(v), int(d)) for v, d in zip(values, digits, strict=True)], dtype="float64")


def count_word(count: Column, one: str, many: str) -> Column:
    """A count with the noun's form for it."""
    return F.concat(count.cast("string"), F.lit(" "), F.when(count == 1, F.lit(one)).otherwise(F.lit(many)))


def escape_html(value: Column) -> Column:
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        value = F.replace(value, F.lit(plain), F.lit(coded))
    return value


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    for name, value in values.items():
        template = F.replace(template, F.lit("{" + name + "}"), value.cast("string"))
    return template
