"""Sharding by longest-processing-time scheduling.

Rows with equal texts form a group that stays on one shard. Groups are scheduled by
size, largest first, each to the least-loaded shard, through a heap. The schedule has a bounded number of
jobs whatever the number of groups: a group of at least ``total / (shards * grain)``
bytes is a job of its own (at most ``shards * grain`` can exist), and all smaller groups are
first bundled by the hash of their text into ``shards * grain`` bundles, which are the other
jobs. So the driver's heap sees at most ``2 * shards * grain`` jobs, and loads differ by about
one bundle, a ``1 / grain`` part of a shard.

Slots are numbered within units of about ``unit_rows`` rows (a job, cut by the hash of the row's own number
where it is large, so that a repeated or missing id does not hold a unit together), whose starts are running sums over the jobs' and then the units' counts; a group of copies
that holds a third of all rows is numbered by many tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terravane.llm.shared import staged


def lpt(jobs: Iterable[tuple[str, int]], shards: int) -> list[tuple[str, int]]:
    """(job, size) -> (job, shard): largest first, ties by name, each to the least-loaded shard, ties to the smaller number."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for job, size in sorted(jobs, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        out.append((job, shard))
        heapq.heappush(heap, (load + size, shard))
    return out


def sized(docs: DataFrame, overhead: int = 16) -> DataFrame:
    """row, doc_id, size, text_crc32, key: everything that sharding needs of a document, without its text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text.cast("binary"), 256).alias("key"),
    )


def shard(docs: DataFrame, shards: int = 40, grain: int = 256, unit_rows: int = 500) -> DataFrame:
    """documents -> doc_id, size, text_crc32, law, shard, slot, grown_shard; one row per input row.

    Law ``bytes``: the sizes of the shards are near equal as far as no group outweighs a shard. A null
    text counts as an empty one, in its group too. Equal rows are placed together and get a slot each, null and repeated ids as well. Other columns are not read. No rows give no rows.
    """
    if shards < 1 or grain < 1 or unit_rows < 1:
        raise ValueError("shards, grain and unit_rows must be positive")
    spark = docs.sparkSession
    rows = staged(sized(docs), "shard-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    small = F.concat(F.lit("bundle-"), (F.conv(F.substring("key", 1, 15), 16, 10).cast("long") % (shards * grain)).cast("string"))
    groups = rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    large = staged(groups.where(F.col("bytes") * shards * grain >= total).select("key", "bytes", "rows"), "shard-large")
    own = large.select("key", F.lit(True).alias("own"))
    # at most shards * grain rows by the definition above, 64 digits each
    placed = rows.join(F.broadcast(own), "key", "left").withColumn("job", F.when(F.col("own"), F.col("key")).otherwise(small))
    placed = staged(placed.select("row", "doc_id", "size", "text_crc32", "key", "job"), "shard-jobs")
    # at most 2 * shards * grain jobs
    jobs = {r.job: r for r in placed.groupBy("job").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()}
    starts, plan = [0] * shards, []
    for job, number in lpt([(j, r.bytes) for j, r in jobs.items()], shards):
        plan.append((job, number, jobs[job].rows, starts[number]))
        starts[number] += jobs[job].rows
    plan = spark.createDataFrame(plan, "job string, shard int, job_rows long, job_start long")
    cut = F.pmod(F.xxhash64("row"), F.ceil(F.col("job_rows") / unit_rows)).cast("int")
    dealt = staged(
        placed.join(F.broadcast(plan), "job").select("row", "doc_id", "size", "text_crc32", "key", "job", "shard", "job_start", cut.alias("part")), "shard-dealt"
    )
    units = dealt.groupBy("job", "job_start", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("job").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = staged(units.select("job", "part", (F.col("job_start") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("start")), "shard-units")
    within = Window.partitionBy("job", "part").orderBy("key", "doc_id", "row")
    numbered = dealt.withColumn("at", F.row_number().over(within) - 1)
    return numbered.join(begins, ["job", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("start") + F.col("at")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
