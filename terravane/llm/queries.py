"""The queries over the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm import ann, chat, decontam, langid, license_scan, mixing, prefix_trie, quality, ranked_search, repeats, sharding, simhash, warc
from terravane.llm.shared import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence findings of all ``documents``, a row per paragraph and family; null and empty texts have none, repeated rows give theirs once for each, very long texts are read in windows. See ``license_scan.scan``."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` in shards 0 to 39 under law ``bytes``; a null text counts as an empty one, equal texts stay together, repeated rows and null ids get a slot each, ties go by the group's hash. See ``sharding.shard``."""
    return sharding.shard(table(spark, sf_dir, "documents"), 40)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -7, formatted and read back; null roles and texts are empty, turns of one number go by role and text, rows without a turn come first, null conversation ids are one conversation. See ``chat``."""
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    nodes = chat.staged(chat.linear_nodes(turns.unionByName(extra)), "chat-nodes")
    leaves, jumps = chat.branches(nodes)
    made = chat.staged(chat.format_paths(chat.paths(chat.best(leaves), jumps), nodes), "chat-formatted")
    read = made.select("tree", "formatted", chat.parse(F.col("formatted")).alias("turns"), chat.learned(F.col("formatted"), F.col("spans")).alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth vec_id; rows without an id or a usable vector take no part, repeated rows are rows of their own, ties go to the smaller vec_id. See ``ann.search``."""
    return ann.search(ann.usable(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0, 10)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text; null and empty texts are texts without a word, repeated rows come out as often, a null id has a null held_out. See ``quality.classify``."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best window of every pair of a document and an item of ``benchmark`` at a similarity of 0.8; null and empty texts match nothing, null ids take no part, ties go to the first window. See ``decontam.contaminated``."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, read back and merged; a null html is an empty payload, rows without an id and repeated rows have records of their own, very large pages have an archive of their own. See ``warc.archive_pages``."""
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured"
    )


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text; ``und`` for null texts and texts without a letter, repeated rows come out as often. See ``langid.identify``."""
    return langid.identify(table(spark, sf_dir, "documents"))


# Uneven targets at all three levels; what a domain, language or source cannot give goes to its siblings first.
TARGETS = {
    ("domain0",): 4.0, ("domain1",): 2.0, ("domain2",): 1.0, ("domain3",): 1.0,
    ("domain0", "en"): 1.0, ("domain0", "fr"): 2.0, ("domain0", "de"): 2.0, ("domain0", "es"): 3.0,
    ("domain1", "en"): 5.0, ("domain2", "de"): 4.0, ("domain3", "fr"): 0.5, ("domain3", "none"): 0.0,
    ("domain0", "en", "src10"): 3.0, ("domain0", "en", "src14"): 0.5, ("domain1", "en", "src6"): 2.0, ("domain2", "en", "src0"): 6.0, ("domain3", "en", "src5"): 0.0,
}


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token prefixes of ``documents`` under ``TARGETS``, 0.8 of all tokens, up to four epochs; a row per chosen document and epoch.

    Null texts have no tokens, null lang and source are named ``none``, repeated rows are rows of their own, empty tables give no rows; see ``mixing.mix``.
    """
    keyed = mixing.tree_columns(table(spark, sf_dir, "documents"))
    return mixing.mix(keyed, TARGETS, budget_share=0.8, max_epochs=4).withColumn("leaf_budget", F.round("leaf_budget", 6))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; texts without a word share fingerprint zero, repeated rows come out as often, null ids take no part in the smallest id. See ``simhash.near_duplicates``."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, radius=3, seed=42)
    return found.select("doc_id", simhash.digits(F.col("fp")).alias("fingerprint"), "component_id")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all ``documents`` for each item of ``benchmark``; null and empty texts neither find nor are found, repeated rows are ranked each, ties go to the smaller doc_id. See ``ranked_search.search``."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all ``conversations``, each begun with turns of the one whose number is divisible by 20; null roles and texts are empty, null turns first, turns of one number go by role and text, null conversation ids take no part. See ``prefix_trie``."""
    return prefix_trie.trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without the words of any window of 35 that stands at two places; null and short texts lose nothing, repeated rows all lose what they share. See ``repeats.remove_repeats``."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), window=35)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_license_scan, op2_sharding, op3_chat_format, op4_rotated_codes, op5_quality,
        op6_decontamination, op7_warc, op8_language, op9_mixing, op10_simhash, op11_ranked_search, op12_prefix_trie, op13_repeats,
    )
    import corpus_pipeline

    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def _crc32_table() -> list[int]:
    table = []
    for c in range(256):
        for _ in range(8):
            c = c >> 1 ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return table


# longest-processing-time scheduling as a recursion over the jobs; slots as far as no job has more rows than a unit
OP2_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, strlen(coalesce(text, '')) + 16 AS size, sha256(coalesce(text, '')) AS key FROM documents),
g AS (SELECT key, sum(size) AS bytes FROM d GROUP BY 1), o AS (SELECT key FROM g WHERE bytes * 40 * 256 >= (SELECT sum(size) FROM d)),
j AS (SELECT d.*, CASE WHEN o.key IS NOT NULL THEN d.key ELSE 'bundle-' || CAST('0x' || substr(d.key, 1, 15) AS BIGINT) % (40 * 256) END AS job FROM d LEFT JOIN o USING (key)),
p AS (SELECT job, sum(size) AS bytes, count(*) AS n, row_number() OVER (ORDER BY sum(size) DESC, job) AS step FROM j GROUP BY 1),
r AS (SELECT CAST(0 AS BIGINT) AS step, list_transform(range(40), lambda x: CAST(0 AS HUGEINT)) AS loads, CAST(0 AS BIGINT) AS shard UNION ALL
  SELECT p.step, list_transform(loads, lambda x, i: x + CASE WHEN i = list_position(loads, list_min(loads)) THEN p.bytes ELSE 0 END), list_position(loads, list_min(loads)) - 1 FROM r JOIN p ON p.step = r.step + 1),
s AS (SELECT p.job, p.step, r.shard, sum(p.n) OVER (PARTITION BY r.shard ORDER BY p.step) - p.n AS start FROM p JOIN r USING (step)),
c AS (SELECT key, any_value(regexp_extract_all(hex(encode(text)), '..')) AS pairs FROM d GROUP BY 1),
x AS (SELECT key, xor(list_reduce(list_transform(pairs, lambda h: CAST('0x' || h AS BIGINT)), lambda a, b: xor(a >> 8, {_crc32_table()}[CAST(xor(a, b) & 255 AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS crc FROM c)
SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard, CAST(start + row_number() OVER (PARTITION BY j.job ORDER BY j.key, doc_id NULLS FIRST) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM j JOIN s USING (job) JOIN x ON x.key = j.key
"""

OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '#', '')) AS escaped,
         length(role) + length(role) - length(replace(replace(replace(replace(role, '\', ''), '<', ''), '#', ''), chr(10), '')) AS role_escaped
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(4 + role_escaped + 1 + escaped + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP4_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), d AS (
  SELECT q.vec_id AS query_id, q.r AS asked, c.vec_id,
         sqrt(list_sum(list_transform(list_zip(c.vec, q.vec), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM v q JOIN v c ON c.r <> q.r AND len(c.vec) = len(q.vec) WHERE q.vec_id % 100 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY asked ORDER BY score, vec_id) AS rank FROM d)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""

OP6_SQL = r"""
WITH i AS (
  SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), ip AS (
  SELECT item_id, w, least(len(w), 5) AS size, len(w) AS n_words, unnest(range(0, len(w) - least(len(w), 5) + 1)) AS item_pos FROM i WHERE len(w) > 0
), ish AS (SELECT item_id, w, size, n_words, item_pos, array_to_string(w[item_pos + 1 : item_pos + size], ' ') AS h FROM ip
), wt AS (SELECT size, h, 1.0 / count(DISTINCT w) AS weight FROM ish GROUP BY 1, 2
), tot AS (SELECT item_id, sum(weight) AS item_total, count(*) AS item_n FROM ish JOIN wt USING (size, h) GROUP BY 1
), icnt AS (SELECT item_id, h, count(*) AS there FROM ish GROUP BY 1, 2
), d AS (
  SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), b AS (SELECT row_number() OVER () AS body, doc_id, w FROM d
), dp AS (SELECT body, w, size, unnest(range(0, len(w) - size + 1)) AS pos FROM b, (SELECT DISTINCT size FROM ish) WHERE len(w) >= size
), dsh AS (SELECT body, len(w) AS doc_words, size, pos, array_to_string(w[pos + 1 : pos + size], ' ') AS h FROM dp
), win AS (
  SELECT DISTINCT body, item_id, size, n_words, greatest(least(pos - item_pos, greatest(doc_words - n_words, 0)), 0) AS start_word FROM dsh JOIN ish USING (size, h)
), cut AS (SELECT win.*, w[start_word + 1 : start_word + n_words] AS part FROM win JOIN b USING (body)
), wp AS (SELECT body, item_id, size, n_words, start_word, part, unnest(range(0, len(part) - size + 1)) AS p FROM cut
), wsh AS (
  SELECT body, item_id, size, n_words, start_word, array_to_string(part[p + 1 : p + size], ' ') AS h, count(*) AS n FROM wp GROUP BY ALL
), s AS (
  SELECT body, item_id, n_words, start_word, sum(n * coalesce(weight, 1.0)) AS total, sum(n) AS total_n,
         coalesce(sum(CASE WHEN there > 0 THEN least(n, there) * weight END), 0) AS common, coalesce(sum(CASE WHEN there > 0 THEN least(n, there) END), 0) AS common_n
  FROM wsh LEFT JOIN wt USING (size, h) LEFT JOIN icnt USING (item_id, h) GROUP BY 1, 2, 3, 4
), r AS (
  SELECT doc_id, item_id, n_words, start_word, round(greatest(common / (total + item_total - common), common_n / (total_n + item_n - common_n)), 9) AS similarity
  FROM s JOIN tot USING (item_id) JOIN b USING (body)
), k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start_word) AS place FROM r WHERE similarity >= 0.8 - 1e-9)
SELECT doc_id, item_id, CAST(start_word AS INTEGER) AS start_word, CAST(n_words AS INTEGER) AS n_words, CAST(similarity AS DOUBLE) AS similarity FROM k WHERE place = 1
"""

OP7_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS keeper FROM p
), u AS (
  SELECT *, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]*)', 1)) AS host,
         regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*', ''), '#.*$', '') AS rest
  FROM k
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to,
       array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || rest AS url_key,
       make_timestamp((1700000000 + page_id) * 1000000) AS captured
FROM u
"""


def license_sql(confident: float = 0.6, confirm: float = 0.5) -> str:
    """SQL of ``op1_license_scan``: the fitted weights and the templates are its constants, everything else is worked out anew."""
    model = license_scan.train()
    n, text = len(model.classes), lambda v: "'" + v.replace("'", "''") + "'"
    weights = ", ".join("(" + ", ".join([text(" ".join(g)), *map(repr, w)]) + ")" for g, w in sorted(model.weights.items()))
    templates = ", ".join(
        f"({1 + k}, {i}, [{', '.join(map(text, license_scan.template_pairs(t)))}])" for k, texts in enumerate(license_scan.TEMPLATES.values(), 1) for i, t in enumerate(texts)
    )
    led = ", ".join(f"({k}, CAST([{', '.join(map(text, license_scan.family_pairs(c)))}] AS VARCHAR[]))" for k, c in enumerate(model.classes))
    logits = ", ".join(f"({b!r} + sum(w{k})) / {model.temperature!r}" for k, b in enumerate(model.intercepts))
    return rf"""
WITH g(gram, {", ".join(f"w{k}" for k in range(n))}) AS (VALUES {weights}), t(k, i, held) AS (VALUES {templates}), u(leader, union_pairs) AS (VALUES {led}),
b AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '
[ 	]*(?:
[ 	]*)+'), lambda x: regexp_matches(x, '[^ 
	]')) AS blocks FROM documents),
p AS (SELECT r, doc_id, unnest(range(0, len(blocks))) AS paragraph, unnest(list_transform(blocks, lambda x: regexp_split_to_array(lower(x), '[^a-z0-9]+'))) AS tokens FROM b),
v AS (SELECT r, doc_id, paragraph, tokens, unnest(range(0, CAST(greatest(0, ceil((len(tokens) - {license_scan.WINDOW}) / {license_scan.STRIDE}.0)) AS BIGINT) + 1)) AS k FROM p),
w AS (SELECT r, doc_id, paragraph, k AS w, tokens[k * {license_scan.STRIDE} + 1 : k * {license_scan.STRIDE} + {license_scan.WINDOW}] AS words FROM v),
s AS (SELECT DISTINCT string_split(gram, ' ')[1] AS first FROM g),
a AS (SELECT r, paragraph, w, words, unnest(range(1, len(words) + 1)) AS i, unnest(words) AS word FROM w),
h AS (SELECT DISTINCT r, paragraph, w, array_to_string(words[i : i + n - 1], ' ') AS gram FROM a JOIN s ON word = first, (SELECT unnest([1, 2, 3]) AS n) WHERE i + n - 1 <= len(words)),
z AS (SELECT r, paragraph, w, [{logits}] AS z FROM h JOIN g USING (gram) GROUP BY ALL),
c AS (SELECT r, paragraph, w, z, list_position(z, list_max(z)) - 1 AS best, unnest(range(1, {n})) AS k FROM z WHERE list_position(z, list_max(z)) > 1),
d AS (SELECT c.*, round(CASE WHEN k = best THEN 1 / list_sum(list_transform(z, lambda x: exp(x - z[k + 1]))) ELSE 1 / (1 + exp(z[1] - z[k + 1]) + exp(z[2] - z[k + 1])) END, 9) AS probability FROM c WHERE k = best OR (k > 1 AND z[k + 1] > z[1] AND z[k + 1] > z[2])),
e AS (SELECT d.*, doc_id, words, list_distinct(list_transform(range(1, greatest(len(words) - 1, 1) + 1), lambda i: concat_ws(' ', words[i], words[i + 1]))) AS pairs FROM d JOIN w USING (r, paragraph, w)),
f AS (SELECT e.*, t.i, len(list_intersect(pairs, held)) / greatest(least(len(pairs), len(held)), 1) AS alike, max(len(list_filter(list_intersect(pairs, held), lambda x: NOT list_contains(union_pairs, x))) / greatest(len(list_filter(held, lambda x: NOT list_contains(union_pairs, x))), 1)) OVER (PARTITION BY r, paragraph, w, e.k) AS own, row_number() OVER (PARTITION BY r, paragraph, w, e.k ORDER BY len(list_intersect(pairs, held)) / greatest(least(len(pairs), len(held)), 1) DESC, t.i) AS near FROM e LEFT JOIN t ON t.k = e.k LEFT JOIN u ON u.leader = e.best),
m AS (SELECT *, CASE WHEN probability >= {confident} THEN [{", ".join(map(text, model.classes))}][k + 1] ELSE 'unknown' END AS family, k > 1 AND probability >= {confident} AND alike >= {confirm} AS confirmed FROM f WHERE near = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY r, paragraph, family ORDER BY probability DESC, w) AS place FROM m WHERE k = best OR (confirmed AND own >= {confirm})),
q AS (SELECT *, count(*) FILTER (WHERE family <> 'unknown') OVER (PARTITION BY r, paragraph) AS families FROM o WHERE place = 1)
SELECT doc_id, CAST(paragraph AS INTEGER) AS paragraph, family, probability, CAST(i AS INTEGER) AS template, coalesce(alike, 0.0) AS template_similarity, coalesce(confirmed, false) AS confirmed, CAST(w * {license_scan.STRIDE} AS INTEGER) AS start_word, array_to_string(words, ' ') AS text
FROM q WHERE family <> 'unknown' OR families = 0
"""


def _level(depth: int) -> str:
    """The nodes of a level, their budgets filled up to the level's water mark; the level above is ``b{depth - 1}``."""
    names, above = ", ".join(mixing.LEVELS[:depth]), ", ".join(mixing.LEVELS[: depth - 1])
    parent = f"PARTITION BY {above} " if above else ""
    budget = f"b{depth - 1}.got" if above else "(SELECT least(sum(leaf_tokens) * 0.8, sum(room)) FROM rooms)"
    return f"""n{depth} AS (SELECT {names}, any_value(w{depth}) AS wants, sum(room) AS cap FROM rooms GROUP BY ALL),
p{depth} AS (SELECT n.*, CASE WHEN wants > 0 AND cap > 0 THEN wants ELSE 0 END AS w, CASE WHEN wants > 0 THEN cap ELSE 0 END AS c, CASE WHEN wants > 0 AND cap > 0 THEN cap / wants END AS ratio, {budget} AS budget FROM n{depth} n {f'JOIN b{depth - 1} USING ({above})' if above else ''}),
v{depth} AS (SELECT *, CASE WHEN ratio IS NOT NULL THEN (budget - coalesce(sum(c) OVER (x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) END AS mark FROM p{depth} WINDOW x AS ({parent}ORDER BY ratio NULLS LAST, {names})),
b{depth} AS (SELECT {names}, greatest(least(c, w * coalesce(max(mark) OVER ({parent}), 0)), 0) AS got FROM v{depth})"""


OP9_SQL = rf"""
WITH d AS (
  SELECT doc_id, 'domain' || CAST('0x' || substr(md5(coalesce(source, 'none')), 1, 8) AS BIGINT) % 4 AS domain, coalesce(lang, 'none') AS language, coalesce(source, 'none') AS origin,
         CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '')) AS BIGINT) AS tokens, CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS mark FROM documents
), t(domain, language, origin, weight) AS (VALUES {", ".join("(" + ", ".join([*(f"'{x}'" for x in path), *["NULL"] * (3 - len(path)), f"{w:.3f}::DOUBLE"]) + ")" for path, w in sorted(TARGETS.items()))}
), l AS (SELECT domain, language, origin, sum(tokens)::DOUBLE AS leaf_tokens FROM d GROUP BY ALL
), g AS (SELECT l.*, coalesce(a.weight, 1) AS w1, coalesce(b.weight, 1) AS w2, coalesce(c.weight, 1) AS w3 FROM l
  LEFT JOIN t a ON a.domain = l.domain AND a.language IS NULL LEFT JOIN t b ON b.domain = l.domain AND b.language = l.language AND b.origin IS NULL LEFT JOIN t c ON c.domain = l.domain AND c.language = l.language AND c.origin = l.origin
), rooms AS (SELECT *, CASE WHEN w1 > 0 AND w2 > 0 AND w3 > 0 THEN leaf_tokens * 4 ELSE 0 END AS room FROM g),
{_level(1)},
{_level(2)},
{_level(3)},
e AS (SELECT b3.domain, b3.language, b3.origin, got, unnest(range(0, CAST(CASE WHEN leaf_tokens > 0 THEN least(4, floor(got / leaf_tokens) + 1) ELSE 1 END AS BIGINT))) AS epoch FROM b3 JOIN l USING (domain, language, origin) WHERE got > 0
), r AS (
  SELECT doc_id, domain, language, origin, tokens, epoch, got, sum(tokens) OVER (PARTITION BY domain, language, origin ORDER BY epoch, md5('17:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || mark), doc_id, mark, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through
  FROM d JOIN e USING (domain, language, origin)
)
SELECT doc_id, domain, language, origin, tokens, CAST(epoch AS INTEGER) AS epoch, round(got, 6) AS leaf_budget, CAST(through AS BIGINT) AS tokens_through FROM r WHERE through <= got + 1e-6
"""


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), g AS (SELECT CAST(count(*) FILTER (WHERE len(terms) > 0) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS length FROM d
), c AS (SELECT r, doc_id, len(terms) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, terms, unnest(terms) AS term FROM d) GROUP BY ALL
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS weight FROM c, g GROUP BY term, n_docs
), s AS (
  SELECT item_id, r, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // length)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN c USING (term), g GROUP BY 1, 2, 3
), k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""

# each node's subtree is told by walking up from every node over its smallest member's own prefixes
OP12_SQL = rf"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda a, b: xor(a >> 8, {_crc32_table()}[CAST(xor(a, b) & 255 AS INTEGER) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), b AS (
  SELECT c.conv_id, i, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND i <= h
  UNION ALL SELECT conv_id, i + 4, role, text FROM c JOIN t USING (conv_id) WHERE i > h
), p AS (
  SELECT conv_id, row_number() OVER x AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words, sha256(array_to_string(list(sha256(length(role) || ':' || role || text)) OVER x, ',')) AS node
  FROM b WINDOW x AS (PARTITION BY conv_id ORDER BY i)
  UNION ALL SELECT conv_id, 0, 0, 'root' FROM c
), m AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS above, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM p
), n AS (
  SELECT node, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CASE WHEN last THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM m GROUP BY 1, 2
), k AS (SELECT above AS node, count(*) AS n_children FROM n GROUP BY 1
), u AS (
  SELECT a.node, CAST(sum(CASE WHEN k.node IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum((n.n_convs - 1) * n.words) AS BIGINT) AS saved_tokens
  FROM n JOIN p a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN k ON k.node = n.node GROUP BY 1
)
SELECT n.conv_id, n.depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN u USING (node) LEFT JOIN k USING (node) LEFT JOIN n o ON o.node = n.above
"""

OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), u AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM d
), w AS (SELECT r, i, sha256(string_agg(word, ' ') OVER x) AS sha, count(*) OVER x AS n FROM u WINDOW x AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
), s AS (SELECT r, i, count(*) OVER (PARTITION BY sha) > 1 AS again FROM w WHERE n = 35
), v AS (SELECT u.r, u.i, word, coalesce(bool_or(again) OVER (PARTITION BY u.r ORDER BY u.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), false) AS gone FROM u LEFT JOIN s ON s.r = u.r AND s.i = u.i
), k AS (SELECT r, count(*) FILTER (WHERE gone) AS n_removed, string_agg(CASE WHEN NOT gone THEN word END, ' ' ORDER BY i) AS kept FROM v GROUP BY 1)
SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": license_sql(), "op2_sharding": OP2_SQL, "op3_chat_format": OP3_SQL, "op4_rotated_codes": OP4_SQL, "op6_decontamination": OP6_SQL, "op7_warc": OP7_SQL, "op9_mixing": OP9_SQL, "op11_ranked_search": OP11_SQL, "op12_prefix_trie": OP12_SQL, "op13_repeats": OP13_SQL}
