"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

Language identification rejects documents without a language, near-duplicate detection keeps one document of
each class, decontamination drops documents with a benchmark passage, mixing brings the sources to
target weights, and sharding places what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm import decontam, langid, mixing, nearcopies, sharding
from terravane.llm.shared import staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Target weights of the mixture: domains first, then languages within one; absent ones weigh 1.
WEIGHTS = {("domain0",): 2.0, ("domain1",): 1.5, ("domain0", "en"): 1.0, ("domain0", "fr"): 2.0, ("domain1", "es"): 2.0}


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows whose text has a language. Rejected: null texts and texts without a letter (empty ones among them).

    Each row is judged by its own text, repeated ids and null ids included, in the pass that predicts it. No rows give no rows.
    """
    return langid.identify(docs, carry=COLUMNS).where(F.col("lang_pred") != "und").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of texts linked by a five-word similarity of 0.8: that with the smallest doc_id, of several with it the least row; a null id stays only in a class of null ids.

    Pairs come from SimHash classes at five words and from MinHash bands, each verified exactly. Texts without a word (null, empty, white space) are one class. No rows give no rows.
    """
    owned, classes = nearcopies.near_copies(docs)
    keys = staged(owned.groupBy("doc_id", "body").agg(F.count("*").alias("n")), "pipeline-keys")
    # the first key of each text, then of each class: minima that are taken before any shuffle, so copies of one text do not meet in a task
    key = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "body")
    each = keys.groupBy("body").agg(F.min(key).alias("first")).join(classes.select("body", "class"), "body")
    first = each.groupBy("class").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias("k"), F.col("first.body").alias("b"), F.lit(True).alias("kept"))
    # a key has one class, so the kept keys are met by id and text
    told = keys.join(first, F.col("doc_id").eqNullSafe(F.col("k")) & (F.col("body") == F.col("b")), "left").select(
        F.col("doc_id").alias("k"), F.col("body").alias("b"), "n", F.coalesce("kept", F.lit(False)).alias("kept")
    )
    told = staged(told, "pipeline-told")
    body = F.xxhash64("text")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("k")) & (body == F.col("b"))
    # a key of one row is that row; of the few kept keys with several rows one row is chosen
    single = _documents(docs).join(told.where("NOT kept OR n > 1"), same, "left_anti")
    several = _documents(docs).join(told.where("kept AND n > 1"), same, "left_semi")
    chosen = several.groupBy(F.col("doc_id").alias("k"), body.alias("b")).agg(F.min(F.struct(*COLUMNS)).alias("row")).select("row.*")
    return single.unionByName(chosen)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops every document with a window that an item of ``benchmark`` resembles; rows are told by a 128-bit hash of their texts, null and repeated ids included.

    Null and empty texts stay. No rows give no rows.
    """
    body = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    found = decontam.contaminated(docs.select(body.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"), id_type="string")
    leaks = staged(found.select(F.col("doc_id").alias("leak")).distinct(), "pipeline-leaks")
    return _documents(docs).join(leaks, body == F.col("leak"), "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps each leaf's token prefix under ``WEIGHTS``, nine tenths of all tokens, one epoch. Null lang and source are named ``none``, null texts have no tokens. No rows give no rows."""
    return mixing.mixed_documents(_documents(docs), WEIGHTS, budget_share=0.9)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The placement of every document in 40 shards, by sizes near equal; null texts count as empty, repeated rows get a slot each. No rows give no rows."""
    return sharding.shard(docs, 40)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("shards", shards),
]
# The stages train a network and compare fingerprints; tests/llm hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again; what each does with nulls, ties, repeated rows and empty tables stands at the stage. Columns beyond ``COLUMNS`` are left out."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}-out")
    return STAGES[-1][1](spark, docs, sf_dir)
