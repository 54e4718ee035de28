"""Benchmark decontamination in DataFrame functions only.

A benchmark item of n words is looked for in document windows of n words. A window that reaches the similarity holds some of
the item's rarest shingles (its prefix, below), so documents and items meet there first; each pair's windows are then
those that put a shared shingle at its place in the item. Places of a shingle in even steps are one run on both sides, and two runs give one sequence of windows, so repeated words cost a document's windows and not its places times the item's. Windows and items get two SimHashes, one over weighted and one over plain
shingles. Fingerprints are cut into radius + 1 blocks, of which at least one is equal whenever two differ in no more than
radius bits: the equi-join on blocks brings together every window and its item within the radius in either fingerprint. Each
such pair is verified by its exact shingle similarity: the sum of the smaller weights over the sum of the larger ones.

A shingle weighs one over the number of different item texts that hold it, so what many items share counts little; a shingle that
no item holds weighs one. As that would let new words outweigh a shared stem, a pair also passes by its plain similarity, in which every
shingle weighs one. A feature enters a SimHash with the root of its weight: then two sets of similarity J have an angle whose
cosine is at least 2 J / (1 + J), whatever the weights, and a pair at 0.8 lies within 28 of 64 bits (of 40,000 simulated ones all do; at 22 bits about one in 10^4 does not).

Documents meet the items' shingles through Bloom filters, constants of the plan of at most ``FILTER_BITS`` bits at every benchmark
size: only documents that may hold a prefix shingle, and of them only the positions that may hold any, go on. What the filters let through by chance the joins drop;
beyond about 65,000 prefix shingles (six thousand items of sixty words) it becomes more with the benchmark, and the words of those documents are shuffled in vain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terravane.llm.shared import staged

FILTER_BITS = 1 << 21


def words(text: Column) -> Column:
    """Lower-cased words of a whole text, cut at ASCII white space; null gives none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingles(hashes: Column, size: int) -> Column:
    """Hashes of words -> hashes of their runs of ``size`` words, in order; none if there are fewer words."""
    n = F.size(hashes) - size + 1
    one = lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(size)])
    return F.when(n >= 1, F.transform(F.sequence(F.lit(0), n - 1), one)).otherwise(F.array().cast("array<bigint>"))


def _hashed(table: DataFrame, key: str, text: str, id_type: str = "long") -> DataFrame:
    return table.select(F.col(key).cast(id_type).alias(key), F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("w"))


def item_shingles(benchmark: DataFrame, shingle_words: int) -> DataFrame:
    """(item_id, size, n_words, item_pos, h, weight, holders); an item with fewer words than a shingle is one shingle. Items without a word drop out."""
    rows = _hashed(benchmark.where(F.col("item_id").isNotNull()), "item_id", "text").where(F.size("w") > 0).distinct().withColumn("body", F.xxhash64("w"))
    sizes = [rows.where(F.size("w") >= shingle_words).select("item_id", "body", F.lit(shingle_words).alias("size"), F.size("w").alias("n_words"), F.posexplode(shingles(F.col("w"), shingle_words)).alias("item_pos", "h"))]
    sizes += [
        rows.where(F.size("w") == k).select("item_id", "body", F.lit(k).alias("size"), F.size("w").alias("n_words"), F.posexplode(shingles(F.col("w"), k)).alias("item_pos", "h"))
        for k in range(1, shingle_words)
    ]
    flat = reduce(DataFrame.unionByName, sizes)
    weight = flat.groupBy("size", "h").agg(F.count_distinct("body").alias("holders"))
    return flat.drop("body").join(weight, ["size", "h"]).withColumn("weight", 1 / F.col("holders"))


def bloom(items: DataFrame, most_bits: int = FILTER_BITS):
    """A test ``hash -> may be one of the table's h`` as a Column function: four probes of a bit array, 32 bits a shingle or more up to ``most_bits``, behind one look into a small table of flags that spares most hashes the probes.

    At most ``most_bits / 64`` numbers come to the driver, whatever the table; a larger one only lets more through.
    """
    held = items.select("h").distinct()
    bits, flags = min(most_bits, max(64, 1 << (32 * held.count()).bit_length())), 1 << 15

    def places(h: Column) -> list[Column]:
        half = F.lit((1 << 31) - 1)  # sums of halves cannot overflow
        return [(h.bitwiseAND(half) + F.shiftrightunsigned(h, 31).bitwiseAND(half) * i).bitwiseAND(F.lit(bits - 1)) for i in range(4)]

    def flag_of(h: Column) -> Column:
        return F.shiftrightunsigned(h, 49).cast("int")

    slots = held.select(F.explode(F.array(*places(F.col("h")))).alias("place"))
    words_of = slots.groupBy(F.shiftright("place", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("mask"))
    table = [0] * (bits // 64)
    for r in words_of.collect():
        table[r["word"]] = r["mask"]
    some = [0] * flags
    for r in held.select(flag_of(F.col("h")).alias("flag")).distinct().collect():  # at most as many as there are flags
        some[r["flag"]] = 1
    # each folds to one constant, which stands in the plan once
    mask, flag = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>"), F.split(F.lit(",".join(map(str, some))), ",").cast("array<boolean>")

    def probe(place: Column) -> Column:
        word = F.get(mask, F.shiftright(place, 6).cast("int"))
        return F.call_function("shiftrightunsigned", word, place.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return lambda h: F.get(flag, flag_of(h)) & F.forall(F.array(*places(h)), probe)


def _fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, h, n, weight of one) -> (keys, kind, fp): the SimHashes over weighted and over plain shingles."""
    both = rows.select(*keys, "h", F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.sqrt(value).alias("v")) for kind, value in (("weighted", F.col("n") * F.col("each")), ("plain", F.col("n").cast("double")))])).alias("f")).select(*keys, "h", "f.*")
    bits = [F.expr(f"sum(if((shiftrightunsigned(h, {b}) & 1L) = 1L, v, -v)) AS b{b}") for b in range(64)]
    value = F.expr(" | ".join(f"if(b{b} > 0, shiftleft(1L, {b}), 0L)" for b in range(64)))
    return both.groupBy(*keys, "kind").agg(*bits).select(*keys, "kind", value.alias("fp"))


def _blocks(radius: int) -> Column:
    """array<struct<block, part>> of the fingerprint's radius + 1 blocks."""
    n, parts, at = radius + 1, [], 0
    for i in range(n):
        wide = 64 // n + (i < 64 % n)
        parts.append(f"struct({i} AS block, shiftrightunsigned(fp, {at}) & {(1 << wide) - 1 if wide < 64 else -1}L AS part)")
        at += wide
    return F.expr(f"array({', '.join(parts)})")


def runs(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """(keys, at) with distinct positions -> (keys, lo, hi, step, n): positions of a key that follow one another in even steps are one row, so a repeated word is one run however often it stands."""
    order = Window.partitionBy(*keys).orderBy(at)
    gaps = rows.select(*keys, at, (F.col(at) - F.lag(at).over(order)).alias("gap"))
    turns = gaps.withColumn("turn", F.coalesce(F.col("gap") != F.lag("gap").over(order), F.lit(False)).cast("int"))
    numbered = turns.withColumn("run", F.sum("turn").over(order))
    found = numbered.groupBy(*keys, "run").agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.count("*").alias("n"))
    step = F.when(F.col("n") > 1, (F.col("hi") - F.col("lo")) / (F.col("n") - 1)).otherwise(1).cast("int")
    return found.select(*keys, "lo", "hi", step.alias("step"), "n")


def _starts() -> Column:
    """The parts of an item's run that meet a document's run in one even sequence of starts: the whole run, or its single places where the steps differ."""
    even = (F.col("n") == 1) | (F.col("item_n") == 1) | (F.col("step") == F.col("item_step"))
    whole = F.array(F.struct(F.col("item_lo").alias("lo"), F.col("item_hi").alias("hi")))
    single = F.transform(F.sequence("item_lo", "item_hi", "item_step"), lambda q: F.struct(q.alias("lo"), q.alias("hi")))
    return F.when(even, whole).otherwise(single)


def _clamped() -> Column:
    """The distinct first words of the windows that put a place of the run at a place of the part."""
    by = F.when(F.col("n") > 1, F.col("step")).otherwise(F.col("item_step"))
    last = F.greatest(F.col("doc_words") - F.col("n_words"), F.lit(0))
    starts = F.sequence(F.col("lo") - F.col("part.hi"), F.col("hi") - F.col("part.lo"), by)
    return F.array_distinct(F.transform(starts, lambda x: F.greatest(F.least(x, last), F.lit(0))))


def prefixes(items: DataFrame, similarity: float) -> DataFrame:
    """(item_id, size, h): the rarest shingles of each item, as many that what is left over cannot reach ``similarity`` alone, weighted or plain."""
    order = Window.partitionBy("item_id").orderBy("holders", "h", "item_pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("item_id")
    ranked = items.select(
        "item_id", "size", "h", F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("lighter"), (F.row_number().over(order) - 1).alias("fewer"),
        F.sum("weight").over(whole).alias("weight_all"), F.count("*").over(whole).alias("n_all"),
    )
    left = 1 - similarity + 1e-9
    return ranked.where((F.col("lighter") <= F.col("weight_all") * left) | (F.col("fewer") <= F.col("n_all") * left)).select("item_id", "size", "h").distinct()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, shingle_words: int = 5, similarity: float = 0.8, radius: int = 28, id_type: str = "long"
) -> DataFrame:
    """documents, benchmark -> (doc_id, item_id, start_word, n_words, similarity): the best window of each pair that reaches ``similarity``, weighted or plain; the larger one is told, to nine digits.

    Ties go to the first window. A document shorter than the item is one window. Null and empty texts, and items without a word,
    match nothing. doc_id is read as ``id_type``. Where rows repeat a doc_id, the best window of all its texts counts; equal rows count once. Null ids take no part, other columns are not read. An empty table gives no rows.
    """
    if not 0 <= radius < 64 or not 0 < similarity <= 1 or shingle_words < 1:
        raise ValueError("radius must be 0 to 63, similarity above 0 and at most 1, shingle_words positive")
    items = staged(item_shingles(benchmark, shingle_words), "decontam-items")
    per_size = {r["size"]: r["n"] for r in items.groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most shingle_words rows
    if not per_size:
        return docs.sparkSession.createDataFrame([], f"doc_id {id_type}, item_id long, start_word int, n_words int, similarity double")
    first, sizes = staged(prefixes(items, similarity), "decontam-prefixes"), sorted(per_size)
    begins, may = bloom(first), bloom(items)
    hashed = _hashed(docs.where(F.col("doc_id").isNotNull()), "doc_id", "text", id_type)
    # the words stand as an element of an array, so that a filter pushed below their projection computes them once a row
    hashed = hashed.where(F.exists(F.array("w"), lambda w: reduce(Column.__or__, [F.exists(shingles(w, size), begins) for size in sizes])))
    # a document is told by its id and its words, so rows that repeat an id are told apart and equal rows count once
    hashed = staged(hashed.withColumn("body", F.xxhash64("w")).dropDuplicates(["doc_id", "body"]), "decontam-words")
    doc = ["doc_id", "body"]

    def seen(size: int) -> DataFrame:
        at = F.transform(shingles(F.col("w"), size), lambda h, i: F.struct(i.alias("pos"), h.alias("h")))
        return hashed.select(*doc, F.size("w").alias("doc_words"), F.lit(size).alias("size"), F.inline(F.filter(at, lambda x: may(x["h"]))))

    hits = staged(reduce(DataFrame.unionByName, [seen(size) for size in sizes]), "decontam-hits")
    told = hits.select(*doc, "size", "h").distinct()
    pairs = staged(told.join(first, ["size", "h"]).select(*doc, "item_id").distinct(), "decontam-pairs")
    # a pair whose shared weight and count are below similarity times the item's cannot pass: shared / larger sum <= shared / item sum
    needed = items.groupBy("item_id").agg(F.sum("weight").alias("item_total"), F.count("*").alias("item_n"))
    shared = pairs.join(items.select("item_id", "size", "h", "weight"), "item_id").join(told, [*doc, "size", "h"])
    sums = shared.groupBy(*doc, "item_id").agg(F.sum("weight").alias("shared"), F.count("*").alias("shared_n"))
    able = staged(
        sums.join(needed, "item_id").where((F.col("shared") >= F.col("item_total") * similarity - 1e-9) | (F.col("shared_n") >= F.col("item_n") * similarity - 1e-9)).select(*doc, "item_id"),
        "decontam-shared",
    )
    here = runs(hits.join(able, doc, "left_semi"), [*doc, "doc_words", "size", "h"], "pos")
    there = runs(items.select("item_id", "size", "n_words", "h", "item_pos").distinct(), ["item_id", "size", "n_words", "h"], "item_pos")
    there = there.select("item_id", "size", "n_words", "h", *[F.col(c).alias(f"item_{c}") for c in ("lo", "hi", "step", "n")])
    met = able.join(there, "item_id").join(here, [*doc, "size", "h"])
    key = [*doc, "size", "n_words", "start_word"]
    windows = staged(met.select(*doc, "item_id", "size", "n_words", F.explode(_starts()).alias("part"), "doc_words", "lo", "hi", "step", "n", "item_step").select(*doc, "item_id", "size", "n_words", F.explode(_clamped()).alias("start_word")).distinct(), "decontam-windows")
    wanted = windows.groupBy(*doc).agg(F.collect_set(F.struct("size", "n_words", "start_word")).alias("windows"))
    again = hashed.join(wanted, doc).select(*doc, "w", F.explode("windows").alias("window"))
    cut = again.select(*doc, "window.*", F.slice(F.col("w"), F.col("window.start_word") + 1, F.col("window.n_words")).alias("part"))
    flat = reduce(
        DataFrame.unionByName,
        [cut.where(F.col("size") == size).select(*key, F.explode(shingles(F.col("part"), size)).alias("h")) for size in sizes],
    )
    weights = items.select("size", "h", "weight").distinct()
    weighed = staged(
        flat.groupBy(*key, "h").agg(F.count("*").alias("n")).join(weights, ["size", "h"], "left").select(*key, "h", "n", F.coalesce("weight", F.lit(1.0)).alias("each")),
        "decontam-weighed",
    )
    counted = staged(items.groupBy("item_id", "h").agg(F.count("*").alias("n"), F.first("weight").alias("each")), "decontam-counted")
    item_fp = _fingerprints(counted, ["item_id"]).withColumn("at", F.explode(_blocks(radius))).select("item_id", "kind", F.col("fp").alias("item_fp"), "at.*")
    window_fp = windows.join(staged(_fingerprints(weighed, key), "decontam-prints"), key).withColumn("at", F.explode(_blocks(radius))).select(*key, "item_id", "kind", "fp", "at.*")
    near = (
        window_fp.join(item_fp, ["item_id", "kind", "block", "part"])
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select(*key, "item_id").distinct()
    )
    near = staged(near, "decontam-near")
    same = near.join(weighed, key).join(counted.select("item_id", "h", F.col("n").alias("there")), ["item_id", "h"])
    both = F.least("n", "there")
    common = same.groupBy(*key, "item_id").agg(F.sum(both * F.col("each")).alias("common"), F.sum(both).alias("common_n"))
    totals = weighed.groupBy(*key).agg(F.sum(F.col("n") * F.col("each")).alias("total"), F.sum("n").alias("total_n"))
    alike = lambda common, total, item: F.col(common) / (F.col(total) + F.col(item) - F.col(common))
    scored = common.join(totals, key).join(needed, "item_id").withColumn(
        "similarity", F.round(F.greatest(alike("common", "total", "item_total"), alike("common_n", "total_n", "item_n")), 9)
    )
    best = scored.where(F.col("similarity") >= similarity - 1e-9).groupBy("doc_id", "item_id", "n_words").agg(
        F.max(F.struct("similarity", (-F.col("start_word")).alias("back"))).alias("best")
    )
    return best.select("doc_id", "item_id", (-F.col("best.back")).alias("start_word"), "n_words", "best.similarity")
