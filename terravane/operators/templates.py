"""Filled message templates, told back from their texts and filled anew in another language."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT = r"\{(\w+)\}"


def filled(template: Column, values: Column) -> Column:
    """A template with the values of a map<name, text> in its slots; slots without a value stay."""
    names = F.array_distinct(F.regexp_extract_all(template, F.lit(SLOT), 1))
    # every slot is cut out once, so a value that looks like a slot stays as it is
    parts, slots = F.split(template, SLOT, -1), F.regexp_extract_all(template, F.lit(SLOT), 1)
    shown = F.transform(slots, lambda n: F.coalesce(F.try_element_at(values, n), F.concat(F.lit("{"), n, F.lit("}"))))
    return F.when(F.size(names) == 0, template).otherwise(F.array_join(F.flatten(F.zip_with(parts, shown, lambda p, v: F.array(p, F.coalesce(v, F.lit(""))))), ""))


def told_back(texts: DataFrame, templates: DataFrame, text_id: str = "text_id") -> DataFrame:
    """texts (id, text) and templates (key, template) -> id, key, values: the template that gives the text, with what stands in its slots.

    Templates are filed under their longest literal part, and texts meet them by the substrings of those lengths, so a text is compared only with templates whose longest part it holds; a template of slots alone meets all texts. A template
    fits if its parts follow each other from the text's start to its end; a slot holds at least one character, the fewest that fit, and a name that stands twice holds the same. Of several the one with the most literal
    text counts, then the smaller key. Texts without a template have nulls.
    """
    parts, names = F.split("template", SLOT, -1), F.regexp_extract_all("template", F.lit(SLOT), 1)
    quoted = F.transform(parts, lambda p: F.regexp_replace(p, r"([\\\[\](){}.*+?^$|])", r"\\$1"))
    slot = F.transform(names, lambda n, i: F.when(F.array_position(names, n) - 1 == i, F.lit("(.+?)")).otherwise(F.concat(F.lit("\\"), F.size(F.array_distinct(F.slice(names, 1, F.array_position(names, n).cast("int")))).cast("string"))))
    pattern = F.concat(F.lit("(?s)^"), F.array_join(F.flatten(F.zip_with(quoted, slot, lambda p, s: F.array(p, F.coalesce(s, F.lit(""))))), ""), F.lit("$"))
    longest = F.element_at(F.array_sort(F.transform(parts, lambda p: F.struct(F.length(p).alias("n"), p.alias("p")))), -1)["p"]
    filed = templates.select("key", F.array_distinct(names).alias("names"), pattern.alias("pattern"), longest.alias("part"), F.aggregate(parts, F.lit(0), lambda s, p: s + F.length(p)).alias("literal"))
    lengths = filed.agg(F.collect_set(F.length("part")).alias("_lengths"))  # one row: the lengths of parts of templates
    reach = F.flatten(F.transform("_lengths", lambda n: F.when(n == 0, F.array(F.lit(""))).when(
        n <= F.length("text"), F.transform(F.sequence(F.lit(1), F.length("text") - n + 1), lambda i: F.substr(F.col("text"), i, n))
    ).otherwise(F.array().cast("array<string>"))))
    met = texts.where("text IS NOT NULL").select(text_id, "text").crossJoin(lengths).select(text_id, "text", F.explode(F.array_distinct(reach)).alias("part")).join(filed, "part")
    fits = met.where(F.expr("text rlike pattern"))
    values = F.map_from_arrays("names", F.expr("transform(sequence(1, size(names)), i -> regexp_extract(text, pattern, i))"))
    told = fits.select(text_id, (-F.col("literal")).alias("less"), "key", F.when(F.size("names") > 0, F.map_entries(values)).otherwise(F.array().cast("array<struct<key: string, value: string>>")).alias("v"))
    best = told.groupBy(text_id).agg(F.min(F.struct("less", "key", "v")).alias("b"))
    return texts.select(text_id).join(best.select(text_id, F.col("b.key").alias("key"), F.map_from_entries("b.v").alias("values")), text_id, "left")


def translated(texts: DataFrame, messages: DataFrame, source: str, target: str, text_id: str = "text_id") -> DataFrame:
    """texts (id, text) and messages (language, key, text) -> id, key, translation; the source's message stands in where the target lacks one, and the text itself where nothing fits."""
    told = told_back(texts, messages.where(F.col("language") == source).select("key", F.col("text").alias("template")), text_id)
    there = messages.where(F.col("language").isin(source, target)).groupBy("key").agg(
        F.coalesce(F.max(F.when(F.col("language") == target, F.col("text"))), F.max(F.when(F.col("language") == source, F.col("text")))).alias("_t")
    )
    return texts.join(told, text_id, "left").join(there, "key", "left").select(text_id, "key", F.coalesce(filled(F.col("_t"), F.col("values")), "text").alias("translation"))
