"""The training-data operators against brute force, round trips and held-out rows, and on awkward tables."""

import hashlib
import inspect
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terravane.llm import ann, chat, decontam, langid, license_scan, mixing, nearcopies, quality, sharding, simhash, warc
from terravane.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, block string, start string, job string"


def docs_of(spark, rows):
    """(id, text) -> documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", "z", "w") for i, t in rows], DOCS)


AWKWARD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (5, "one"), (6, "word " * 30000), (7, "Ünïcode ßtraße 12"), (8, "a b c d e f g"), (None, "lost id")]


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)]
    parent = {x: x for e in edges for x in e}
    for a, b in edges:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(parent, x) for x in parent)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprint_is_the_majority():
    import xxhash

    words = "the cat sat on the mat the cat sat".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint("THE cat\vsat on  the mat the cat sat") % 2**64 == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("Ä b") % 2**64 == xxhash.xxh64_intdigest("Ä b".encode(), 42)


@pytest.mark.parametrize(("segment_bits", "radius", "block_rows"), [(2, 3, 4096), (2, 3, 4), (4, 2, 8), (1, 5, 16), (8, 1, 3)])
def test_links_lose_nothing(spark, segment_bits, radius, block_rows):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:
        for _ in range(6):
            fps.add(b ^ sum(1 << k for k in rng.sample(range(64), rng.randint(0, radius + 2))))
    fps = sorted(x - 2**64 if x >= 2**63 else x for x in fps)
    parent = {x: x for x in fps}
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if ((a ^ b) % 2**64).bit_count() <= radius:
                u, v = find(parent, a), find(parent, b)
                parent[max(u, v)] = min(u, v)
    edges = simhash.links(spark.createDataFrame([(x,) for x in fps], "fp long"), radius, segment_bits, block_rows)
    got = {r.node: r.root for r in components(edges).collect()}
    assert all(got.get(x, x) == find(parent, x) for x in fps)


def test_near_duplicates_awkward(spark):
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs_of(spark, AWKWARD)).collect()]
    by = dict(got)
    assert len(got) == len(AWKWARD) and by[1] == by[2] == by[3] == 1 and by[5] == 4 and by[8] == 8
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def check_shards(rows, texts):
    assert len(rows) == len(texts)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)


def test_sharding(spark):
    rng = random.Random(2)
    texts = [(i, f"t{rng.randrange(700)} " * rng.randint(1, 60)) for i in range(1500)] + [(5000 + i, "same copies") for i in range(500)]
    rows = sharding.shard(docs_of(spark, texts), 7, grain=64, unit_rows=50).collect()
    check_shards(rows, texts)
    placed = {}
    for r in rows:
        assert placed.setdefault((r.text_crc32, r.size), r.shard) == r.shard
    loads = Counter()
    for r in rows:
        loads[r.shard] += r.size
    assert max(loads.values()) < 1.02 * min(loads.values())
    check_shards(sharding.shard(docs_of(spark, AWKWARD), 3).collect(), AWKWARD)
    assert sharding.shard(docs_of(spark, [])).count() == 0
    assert sharding.lpt([("a", 5), ("b", 4), ("c", 3), ("d", 3)], 2) == [("a", 0), ("b", 1), ("c", 1), ("d", 0)]


def test_chat_trees_and_round_trip(spark):
    nodes = spark.createDataFrame(
        [("t", 1, None, "user", "hi \\s <b> # </turn>\n", 1.0), ("t", 2, 1, "assistant", "a\\", None), ("t", 3, 1, "assistant", "", 2.0), ("t", 4, 3, "us\ner", "ü", 0.0), ("u", 9, 77, None, None, None)],
        "tree string, node long, parent long, role string, text string, score double",
    )
    leaves, jumps = chat.branches(nodes)
    assert {(r.tree, r.leaf): (r.turns, r.score) for r in leaves.collect()} == {("t", 2): (2, 1.0), ("t", 4): (3, 3.0), ("u", 9): (1, 0.0)}
    made = chat.format_paths(chat.paths(chat.best(leaves, 2), jumps), nodes)
    rows = made.select("tree", "branch", chat.parse(F.col("formatted")).alias("turns"), chat.learned(F.col("formatted"), F.col("spans")).alias("loss")).collect()
    got = {(r.tree, r.branch): ([tuple(t) for t in r.turns], r.loss) for r in rows}
    first = ("user", "hi \\s <b> # </turn>\n")
    assert got == {("t", 1): ([first, ("assistant", ""), ("us\ner", "ü")], ""), ("t", 2): ([first, ("assistant", "a\\")], "a\\"), ("u", 1): ([("", "")], "")}
    long = spark.createDataFrame([(1, t, "user" if t % 2 else "assistant", f"<{t}>") for t in range(150)] + [(None, None, None, None), (None, 7, "user", "x")], "conv_id long, turn long, role string, text string")
    nodes = chat.linear_nodes(long)
    leaves, jumps = chat.branches(nodes)
    rows = chat.paths(chat.best(leaves), jumps).collect()
    assert sorted((r.tree or 0, r.at, r.node) for r in rows) == [(0, 1, 1), (0, 2, 2)] + [(1, i, i) for i in range(1, 151)]
    leaves, jumps = chat.branches(nodes.limit(0))
    assert chat.paths(chat.best(leaves), jumps).count() == 0
    # a cycle, and a leaf below it, reach no root
    ring = spark.createDataFrame([(1, 1, 2, 0.0), (1, 2, 1, 0.0), (1, 3, 2, 0.0), (1, 4, None, 0.0)], "tree long, node long, parent long, score double")
    assert [r.leaf for r in chat.branches(ring)[0].collect()] == [4]


def test_ann_recall_and_ties(spark):
    rng = np.random.default_rng(0)
    vecs = rng.standard_normal((600, 24)).astype(np.float32)
    vecs[100:130] = vecs[100]
    rows = [(i, v.tolist()) for i, v in enumerate(vecs)] + [(1000, None), (1001, [0.0] * 24), (1002, [float("nan")] * 24), (1003, [1.0, None]), (1004, [1.0, 2.0]), (None, [1.0] * 24)]
    frame = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = {}
    for r in ann.search(frame, F.col("vec_id") % 50 == 0, 10, block_rows=100, query_rows=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = 0
    for q in range(0, 600, 50):
        d = np.sqrt(((vecs.astype(float) - vecs[q].astype(float)) ** 2).sum(axis=1))
        want = [i for i in np.lexsort((np.arange(600), d)) if i != q][:10]
        have = [v for _, v, _ in sorted(got[q])]
        hit += len(set(want) & set(have))
        assert [k for k, _, _ in sorted(got[q])] == list(range(1, 11))
    assert hit >= 0.98 * 120 and sorted(got[100])[0][1] == 101
    assert ann.search(frame.limit(0), F.col("vec_id") > 0).count() == 0


def test_quality_held_out(spark):
    rng = random.Random(4)
    good = lambda: " ".join(rng.choice(["river", "stone", "walks", "quiet", "house"]) + str(rng.randrange(50)) for _ in range(rng.randint(5, 60))) + "."
    bad = lambda: " ".join(rng.choice(["RIVER!!", "stone%%%", "| x", "go go go"]) for _ in range(rng.randint(3, 40)))
    rows = [(i, good() if i % 3 else bad()) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(600)] + [(1, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs_of(spark, rows + [(900, None), (901, "")]), labels).collect()
    held = [r for r in got if r.held_out and r.doc_id < 600]
    assert held and np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got) and len(got) == 602
    assert quality.classify(docs_of(spark, []), labels.limit(0)).count() == 0
    assert {r.score for r in quality.classify(docs_of(spark, AWKWARD), labels.limit(0)).collect()} == {0.5}


def test_language_held_out(spark):
    rng = random.Random(5)
    words = {"en": ["the", "with", "thing", "and", "where"], "de": ["der", "schön", "und", "nicht", "über"], "es": ["ñandú", "que", "acción", "para", "los"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(4, 300))), lang, "s", 0) for i, lang in enumerate(["en", "de", "es"] * 150)]
    frame = spark.createDataFrame(rows + [(900, None, "en", "s", 0), (901, "12 !!", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in langid.identify(frame).collect()}
    held = [i for i in range(450) if got[i].held_out]
    assert np.mean([got[i].lang_pred == rows[i][2] for i in held]) > 0.95
    assert got[900].lang_pred == got[901].lang_pred == "und"
    assert {r.lang_pred for r in langid.identify(frame.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(frame.limit(0)).count() == 0


def brute_similarity(a, b, weight):
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) * weight(k) for k in keys) / sum(max(a[k], b[k]) * weight(k) for k in keys)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randint(12, 40))) for i in range(12)] + [(50, "only three words"), (51, None), (52, "")]
    rows = [(i, text(rng.randint(0, 200))) for i in range(40)]
    rows += [(100 + i, text(30) + " " + items[i][1].upper() + "  " + text(30)) for i in range(12)]
    rows += [(200 + i, " ".join(items[i][1].split()[1:]) + " " + text(20)) for i in range(12)] + [(300, "so only three words here"), (301, None), (302, ""), (100, text(10))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.contaminated(docs_of(spark, rows), bench).collect()}
    grams = {i: Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) for i, t in items if t and (w := t.lower().split()) and (k := min(5, len(w)))}
    often = Counter(g for c in grams.values() for g in c)
    want = {}
    for d, t in rows:
        w = (t or "").lower().split()
        for i, c in grams.items():
            n, k = len(items[[x for x, _ in items].index(i)][1].split()), len(next(iter(c)))
            for s in range(max(1, len(w) - n + 1)):
                part = w[s : s + n]
                cut = Counter(tuple(part[j : j + k]) for j in range(len(part) - k + 1))
                sim = brute_similarity(cut, c, lambda g: 1 / often.get(g, 1)) if cut else 0
                if sim >= 0.8:
                    want[d, i] = max(want.get((d, i), 0), sim)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want) and len(want) >= 12
    assert decontam.contaminated(docs_of(spark, []), bench).count() == 0
    assert decontam.contaminated(docs_of(spark, rows), bench.limit(0)).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big = "x\r\nWARC/1.1\r\n" * 200
    pages = [(1, "http://b.example.com/x#f", big), (2, "http://a.Example.com/y", big), (3, "http://a.example.com/y", "small"), (4, None, "small"), (5, "http://c.org/a\nb", None), (6, "q", "ü" * 999)]
    rows = warc.archive_pages(spark.createDataFrame(pages, "page_id long, url string, html string"), str(tmp_path / "w")).collect()
    got = {r.page_id: r for r in rows}
    for i, _, html in pages:
        raw = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert (got[1].record_type, got[1].refers_to, got[2].record_type) == ("revisit", 2, "response")
    assert all(got[i].record_type == "response" and got[i].refers_to is None for i in (2, 3, 4, 5, 6))
    assert [(r.url_key, r.page_id) for r in rows] == sorted((r.url_key, r.page_id) for r in rows)
    runs = [sorted(random.Random(s).choices(range(50), k=s * 7)) for s in range(6)]
    assert [x for (x,) in warc.LoserTree([iter([(v,) for v in r]) for r in runs])] == sorted(v for r in runs for v in r)
    assert list(warc.LoserTree([])) == []
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def plain_share(budget, wants, caps):
    """Divide a budget by weight among siblings, none above its cap; what one cannot take goes to the others by weight."""
    got = dict.fromkeys(wants, 0.0)
    open_ = {k for k in wants if wants[k] > 0 and caps[k] > 0}
    left = float(budget)
    while open_ and left > 1e-9:
        weight = sum(wants[k] for k in sorted(open_))
        full = {k for k in sorted(open_) if got[k] + left * wants[k] / weight >= caps[k] - 1e-9}
        if not full:
            for k in sorted(open_):
                got[k] += left * wants[k] / weight
            break
        for k in sorted(full):
            left -= caps[k] - got[k]
            got[k] = float(caps[k])
        open_ -= full
    return got


def plain_budgets(leaves, budget, weights, max_epochs=1):
    """Tokens of each leaf -> its budget. ``weights`` maps a node's path (1 to 3 names) to its weight among its siblings; 1 where absent."""
    caps = {}
    for path, tokens in leaves.items():
        for depth in range(4):
            # a weight of zero anywhere on the path shuts the leaf out, so it must not count as room above
            if all(weights.get(path[: d + 1], 1.0) > 0 for d in range(3)):
                caps[path[:depth]] = caps.get(path[:depth], 0.0) + tokens * max_epochs
            else:
                caps.setdefault(path[:depth], 0.0)
    out = {}

    def give(node, amount):
        if len(node) == 3:
            out[node] = amount
            return
        children = sorted({p[: len(node) + 1] for p in leaves if p[: len(node)] == node})
        for child, got in plain_share(amount, {c: weights.get(c, 1.0) for c in children}, {c: caps[c] for c in children}).items():
            give(child, got)

    give((), min(float(budget), caps.get((), 0.0)))
    return out


def spark_budgets(spark, leaves, weights, share, max_epochs=1):
    frame = spark.createDataFrame([(*k, t, 1) for k, t in leaves.items()], "domain string, language string, origin string, leaf_tokens long, n long")
    return {(r.domain, r.language, r.origin): r.leaf_budget for r in mixing.leaf_budgets(frame, weights, share, max_epochs).collect()}


def test_budgets(spark):
    leaves = {("d", "en", "a"): 100, ("d", "en", "b"): 1000, ("d", "fr", "c"): 50, ("e", "en", "f"): 1000}
    # c is short of 250 by 200, which its sibling language takes before the other domain; a is short of what b takes
    got = spark_budgets(spark, leaves, {("d",): 1.0, ("e",): 1.0}, 1000 / 2150)
    assert {k: round(v, 6) for k, v in got.items()} == {("d", "en", "a"): 100.0, ("d", "en", "b"): 350.0, ("d", "fr", "c"): 50.0, ("e", "en", "f"): 500.0}
    two = {("d", "en", "a"): 10, ("e", "en", "f"): 10}
    assert sum(spark_budgets(spark, two, {}, 25.0).values()) == 20
    assert spark_budgets(spark, two, {}, 25.0, 3) == {("d", "en", "a"): 30.0, ("e", "en", "f"): 30.0}
    rng = random.Random(9)
    for _ in range(4):
        leaves = {(rng.choice("def"), rng.choice(["en", "fr", "de"]), rng.choice("abcdefgh")): rng.choice([0, 1, rng.randint(1, 5000)]) for _ in range(40)}
        weights = {k[:n]: rng.choice([0.0, 0.5, 1.0, 3.0, 7.5]) for k in leaves for n in (1, 2, 3) if rng.random() < 0.5}
        share, epochs = rng.choice([0.0, 0.2, 0.7, 1.5]), rng.randint(1, 3)
        want = plain_budgets(leaves, share * sum(leaves.values()), weights, epochs)
        got = spark_budgets(spark, leaves, weights, share, epochs)
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-5 for k in want)


def test_mixing_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(rng.choice([i, i, i, 7, None]), f"d{i % 2}", rng.choice(["en", "fr"]), rng.choice("abc"), rng.randint(0, 50), "x") for i in range(800)] + [(3, "d0", "en", "a", 5, "x")] * 1500
    frame = spark.createDataFrame(rows, "doc_id long, domain string, language string, origin string, tokens long, epoch string")
    got = Counter((r.doc_id, r.tokens, r.epoch, r.tokens_through) for r in mixing.mix(frame, {("d0",): 3.0, ("d1", "en"): 2.0}, 0.9, 3, bucket_rows=20).collect())
    leaves = Counter()
    for r in rows:
        leaves[r[1:4]] += r[4]
    given = plain_budgets(leaves, sum(leaves.values()) * 0.9, {("d0",): 3.0, ("d1", "en"): 2.0}, 3)
    want = Counter()
    for leaf, budget in given.items():
        run, mine = 0, [r for r in rows if r[1:4] == leaf]
        for epoch in range(min(3, int(budget // leaves[leaf]) + 1)):
            draw = lambda r: hashlib.md5(f"17:{epoch}:{'null' if r[0] is None else r[0]}:{r[4]}".encode()).hexdigest()  # noqa: E731, B023
            for r in sorted(mine, key=draw):
                run += r[4]
                if run <= budget + 1e-6:
                    want[r[0], r[4], epoch, run] += 1
    assert got == want and max(want.values()) >= 1
    assert mixing.mix(frame.limit(0)).count() == 0
    awkward = mixing.tree_columns(docs_of(spark, AWKWARD).withColumn("lang", F.lit(None).cast("string")))
    assert mixing.mix(awkward, budget_share=1.0).count() == len(AWKWARD)


def test_mixed_documents_are_what_mix_chooses(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["en", None]), rng.choice(["a", "b", None]), 1, "x", "y") for i in [*range(300), None]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, domain string, origin string")
    for share in (0.0, 0.3, 0.9, 1.0):
        want = sorted((r.doc_id is None, r.doc_id) for r in mixing.mix(mixing.tree_columns(frame), budget_share=share).collect())
        got = mixing.mixed_documents(frame, budget_share=share)
        assert got.columns == frame.columns
        assert sorted((r.doc_id is None, r.doc_id) for r in got.collect()) == want
    assert len(want) == len(rows)
    assert mixing.mixed_documents(frame.limit(0)).count() == 0
    awkward = docs_of(spark, AWKWARD)
    assert mixing.mixed_documents(awkward, budget_share=1.0).count() == len(AWKWARD)


def plain_license_scan(rows, confident=0.6, confirm=0.5):
    """``license_scan.scan`` in plain Python, n-gram by n-gram."""
    model, out = license_scan.train(), []
    for doc_id, text in rows:
        lines = (text or "").replace("\r\n", "\n").replace("\r", "\n")
        blocks = [b for b in re.split(r"\n[ \t\v\f]*(?:\n[ \t\v\f]*)+", lines) if b.strip(" \n\t\v\f")]
        for number, block in enumerate(blocks):
            tokens, told = license_scan.tokens_of(block), {}
            for k in range(max(0, math.ceil((len(tokens) - 64) / 32)) + 1):
                window = tokens[32 * k : 32 * k + 64]
                grams = [g for g in license_scan.ngrams_of(window) if g in model.weights]
                z = [(b + sum(model.weights[g][c] for g in grams)) / model.temperature for c, b in enumerate(model.intercepts)]
                best, mine = z.index(max(z)), {f"{a} {b}" for a, b in zip(window, window[1:], strict=False)}
                for c in range(1, len(z)) if best else ():
                    if c != best and (c == 1 or z[c] <= max(z[:2])):
                        continue
                    p = 1 / sum(math.exp(x - z[c]) for x in (z if c == best else [z[c], *z[:2]]))
                    texts = license_scan.TEMPLATES.get(model.classes[c], ())
                    pairs = [set(license_scan.template_pairs(t)) for t in texts]
                    near = max(((len(mine & q) / max(1, min(len(mine), len(q))), -i) for i, q in enumerate(pairs)), default=None)
                    family = model.classes[c] if p >= confident else "unknown"
                    sure = c > 1 and p >= confident and near[0] >= confirm
                    led = {q for t in license_scan.TEMPLATES.get(model.classes[best], ()) for q in license_scan.template_pairs(t)}
                    own = max((len((mine & q) - led) / max(1, len(q - led)) for q in pairs), default=0)
                    if c == best or (sure and own >= confirm):
                        said = (round(p, 9), -k, -near[1] if near else None, near[0] if near else 0.0, sure)
                        told[family] = max(told.get(family, said), said, key=lambda x: x[:2])
            if len(told) > 1:
                told.pop("unknown", None)
            out += [(doc_id, number, f, round(p, 9), t, round(s, 9), sure, -k * 32) for f, (p, k, t, s, sure) in told.items()]
    return sorted(out, key=repr)


def scanned(spark, rows):
    got = license_scan.scan(docs_of(spark, rows)).collect()
    return sorted(((r.doc_id, r.paragraph, r.family, round(r.probability, 9), r.template, round(r.template_similarity, 9), r.confirmed, r.start_word) for r in got), key=repr)


WRAPPED = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files, to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish and sell copies of it."


def test_license_scan(spark):
    long = " ".join(f"palabra{i}" for i in range(500))
    rows = [
        (1, "Some prose.\nReleased under the MIT License.\nMore prose of the house."), (2, "Ein Haus mit Garten."), (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "Licensed under CC BY-NC 4.0.\r\nLicensed under the Apache License, Version 2.0."), (5, "He lost his driving license."), (6, "mit"), (7, WRAPPED), (8, f"Title\n\n \n{WRAPPED}\n\nEnd"),
        (9, "Licensed under the Eclipse Public License 2.0."), (10, "Licensed under the EUPL, Version 1.2"), (11, "SPDX-License-Identifier: ISC"), (12, "Released under the ISC License."),
        (13, "This program is licensed under the GNU Affero General Public License, version 3."), (14, f"{long} Released under the MIT License. {long}"), (4, "Released under the Frobnicate License."), (4, "Released under the Frobnicate License."),
    ]
    got = scanned(spark, rows + [(20 + (i or 0), t) for i, t in AWKWARD] + [(None, "All rights reserved.")])
    found = {(r[0], r[1], r[2]): r[6] for r in got}
    families = [(1, 0, "mit"), (3, 0, "gpl"), (4, 0, "cc-by-nc"), (4, 0, "apache-2.0"), (7, 0, "mit"), (8, 1, "mit"), (14, 0, "mit"), (None, 0, "proprietary")]
    assert found == dict.fromkeys(families, True) | {(i, 0, "unknown"): False for i in (4, 9, 10, 11, 12, 13)}
    assert sum(r[0] == 4 and r[2] == "unknown" for r in got) == 2  # repeated rows are found once for each
    assert scanned(spark, []) == []


def test_license_families_that_are_alike(spark):
    """One family where its text holds a shorter template of another; headings; notices of no class; sentences that use the words."""
    rows = [
        (1, "This program is licensed under the GNU General Public License version 2 or later.", "gpl"), (2, "Licensed under CC BY-ND 4.0.", "cc-by-nd"), (3, "The text is under CC BY-NC-SA 4.0", "cc-by-nc-sa"), (4, "MIT License", "mit"),
        (5, "The Apache Software License, Version 1.1", "unknown"), (6, "SPDX-License-Identifier: LGPL-3.0-or-later", "lgpl"), (7, "SPDX-License-Identifier: BSD-2-Clause", "bsd"),
        (8, "the license to operate the mine was granted under the terms of the 1872 act", None), (9, "Licensed under CC BY-NC-ND 4.0.", "cc-by-nc-nd"), (10, "Licensed under CC BY 4.0.", "cc-by"), (11, "GNU Lesser General Public License", "lgpl"),
    ]
    found = {}
    for r in scanned(spark, [(i, t) for i, t, _ in rows]):
        found.setdefault(r[0], []).append(r[2])
    assert found == {i: [f] for i, _, f in rows if f}
    both = scanned(spark, [(1, "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."), (2, "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: GPL-2.0-only")])
    assert {(r[0], r[2]) for r in both} == {(1, "mit"), (1, "apache-2.0"), (2, "mit"), (2, "gpl")}


def test_license_scan_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rng, sentences = random.Random(3), [t for ts in [*license_scan.TEMPLATES.values(), license_scan.PROSE_TEXTS, license_scan.OTHER_NOTICES] for t in ts]
    for i in range(120):
        docs.append((1000 + i, rng.choice(["\n", " ", "\n\n", "\r"]).join(rng.choice(sentences) if rng.random() < 0.6 else "mot " * rng.randint(1, 90) for _ in range(rng.randint(1, 6)))))
    want = plain_license_scan(docs)
    assert scanned(spark, docs) == want and len(want) > 80
    assert not [r for r in want if r[0] < 1000 and r[6] is False]


def test_license_classes_on_texts_left_out():
    model = license_scan.train()
    weights = {g: np.array(w) for g, w in model.weights.items()}
    right = []
    for name, texts in [*license_scan.HELD_NOTICES.items(), ("unknown", license_scan.HELD_OTHER), ("prose", license_scan.HELD_PROSE)]:
        for text in texts:
            z = sum((weights[g] for g in license_scan.ngrams_of(license_scan.tokens_of(text)) if g in weights), np.array(model.intercepts))
            right.append(model.classes[int(z.argmax())] == name)
    assert np.mean(right) > 0.85 and 0.125 < model.temperature < 16


def test_pipeline_stages_on_awkward_tables(spark, tmp_path):
    spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = docs_of(spark, AWKWARD)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == list(corpus_pipeline.COLUMNS)
        ids = {r.doc_id for r in out.collect()}
        if name == "language":
            assert ids == {None, 4, 5, 6, 7, 8}
        if name == "near_duplicates":
            assert ids >= {1, 4, 6, 7, 8} and not ids & {2, 3, 5}
        if name == "decontamination":
            assert 8 not in ids and ids >= {1, 2, 4, 5, 6, 7}
        assert stage(spark, frame.limit(0), str(tmp_path)).count() == 0


def test_pipeline_stages_judge_rows(spark, tmp_path):
    spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages = dict(corpus_pipeline.STAGES)

    def kept(name, rows):
        return sorted((r.doc_id or 0, r.text) for r in stages[name](spark, docs_of(spark, rows), str(tmp_path)).collect())

    rows = [(None, "lost id"), (None, "lost id"), (None, "one"), (4, "one"), (5, "one"), (5, "other words here"), (5, "other words here")]
    assert kept("near_duplicates", rows) == [(0, "lost id"), (4, "one"), (5, "other words here")]
    assert kept("near_duplicates", [(1, "one"), (2, "one"), (3, "two or more")]) == [(1, "one"), (3, "two or more")]
    rows = [(None, "a b c d e f g"), (None, "clean"), (8, "a b c d e f g"), (8, "clean too"), (9, None)]
    assert stages["decontamination"](spark, docs_of(spark, rows), str(tmp_path)).count() == 3


def five(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


@pytest.mark.parametrize("block_rows", [512, 5])
def test_near_copies_against_brute_force(spark, block_rows):
    rng = random.Random(8)
    vocabulary, texts = [f"w{i}" for i in range(400)], []
    for group in range(24):
        base = rng.choices(vocabulary, k=rng.choice([12, 60, 120, 300]))
        texts.append(" ".join(base))
        for _ in range(30 if group == 0 else 4):
            copy = list(base)
            for _ in range(rng.randint(1, max(1, len(base) // 30))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy).title())
    texts += ["", " \n", "one two", "ONE  two", "one two three"]
    sets = [five(t) for t in texts]
    parent = {i: i for i in range(len(texts))}
    for i in parent:
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                u, v = find(parent, i), find(parent, j)
                parent[max(u, v)] = min(u, v)
    owned, classes = nearcopies.near_copies(docs_of(spark, list(enumerate(texts))), block_rows=block_rows)
    got = {r.doc_id: r.component_id for r in owned.join(classes, "body").collect()}
    assert got == {i: find(parent, i) for i in parent} and len(set(got.values())) < len(texts) - 20


def chain(n, step):
    """n texts of 60 words, each shifted by ``step`` words against the one before: neighbours are near copies, distant ones share nothing."""
    words = [f"c{i}" for i in range(60 + n * step)]
    return [" ".join(words[i * step : i * step + 60]) for i in range(n)]


def test_near_copies_of_a_chain_are_compared_by_cell(spark, monkeypatch):
    placed, real = [], nearcopies._blocks

    def counted(rows, block_rows):
        found = real(rows, block_rows)
        placed.append(found.count())
        return found

    monkeypatch.setattr(nearcopies, "_blocks", counted)
    for n in (150, 600):
        owned, classes = nearcopies.near_copies(docs_of(spark, list(enumerate(chain(n, 3)))), block_rows=4)
        assert {r.component_id for r in owned.join(classes, "body").collect()} == {0}
    assert placed[1] < 4.6 * placed[0], placed  # sets that travel grow with the class, not with its square


def test_near_copies_in_one_hot_cell(spark):
    rng = random.Random(30)
    texts = []
    for group in range(12):
        base = [f"h{rng.randrange(3000)}" for _ in range(50)]
        for _ in range(3 if group else 90):
            copy = list(base)
            copy[rng.randrange(50)] = f"h{rng.randrange(3000)}"
            texts.append(" ".join(copy))
    texts += chain(60, 3)
    docs = docs_of(spark, list(enumerate(texts))).withColumn("body", F.xxhash64("text")).select("doc_id", "body", "text")
    # every text stands in one cell, whatever its bands say
    sketch = docs.select("body", F.col("doc_id").alias("first_id"), F.array(F.lit(1).cast("long"), F.lit(7).cast("long")).alias("cells"))
    for block_rows in (3, 10_000):
        found = nearcopies.links(docs, sketch, block_rows=block_rows)
        root = {r.node: r.root for r in components(found).collect()}
        body = {r.doc_id: r.body for r in docs.select("doc_id", "body").collect()}
        sets, parent = [five(t) for t in texts], {i: i for i in range(len(texts))}
        for i in parent:
            for j in range(i):
                if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    u, v = find(parent, i), find(parent, j)
                    parent[max(u, v)] = min(u, v)
        got = [root.get(body[i], body[i]) for i in parent]
        same = [find(parent, i) for i in parent]
        assert len(set(zip(got, same, strict=True))) == len(set(got)) == len(set(same))


def test_pipeline_drops_loose_near_copies(spark, tmp_path):
    rng = random.Random(10)
    base = [f"w{rng.randrange(5000)}" for _ in range(80)]
    near, far = list(base), list(base)
    near[40] = "changed"
    for i in (10, 30, 50, 70):
        far[i] = "changed"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))]
    assert ((simhash.fingerprint(rows[0][1]) ^ simhash.fingerprint(rows[1][1])) % 2**64).bit_count() > 3 and len(five(rows[0][1]) & five(rows[2][1])) < 0.8 * 76
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs_of(spark, rows), str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == {1, 3}


@pytest.mark.parametrize("stem", [False, True])
def test_decontamination_repeated_items_and_shared_stems(spark, stem):
    rng = random.Random(12)
    base = [f"w{rng.randrange(9000)}" for _ in range(59)]
    items = [(i, " ".join([*base, f"end{i}"] if stem else base)) for i in range(5)]
    near = [*base, "end0"] if stem else list(base)
    near[30] = "changed"
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs_of(spark, [(1, " ".join(near)), (2, "clean words")]), bench).collect()}
    assert (1, 0) in got and all(d == 1 for d, _ in got) and (stem or len(got) == 5)


def oracle_rows(sql, **tables):
    import duckdb

    con = duckdb.connect()
    for name, path in tables.items():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    found = con.execute(sql)
    names = [x[0] for x in found.description]
    return [dict(zip(names, r, strict=True)) for r in found.fetchall()]


def test_decontamination_query_against_sql(spark):
    from terravane.llm import queries

    d = "/root/testdata/sf0.01"
    want = oracle_rows(queries.OP6_SQL, documents=f"{d}/documents.parquet", benchmark=f"{d}/benchmark.parquet")
    got = [r.asDict() for r in queries.op6_decontamination(spark, d).collect()]
    assert sorted(map(str, got)) == sorted(str({k: r[k] for k in got[0]}) for r in want) and len(got) > 5


def test_decontamination_prefixes_and_a_large_benchmark(spark):
    rng = random.Random(14)
    word = lambda: f"v{rng.randrange(30000)}"
    stem = [word() for _ in range(50)]
    items = [(i, " ".join([*stem, *(word() for _ in range(10))] if i % 10 == 0 else [word() for _ in range(60)])) for i in range(1700)]
    near = []
    for i in range(0, 1700, 17):
        w = items[i][1].split()
        w[rng.randrange(len(w))] = "changed"
        near.append((i, " ".join([word() for _ in range(20)] + w + [word() for _ in range(20)])))
    rows = near + [(5000 + i, " ".join(word() for _ in range(120))) for i in range(100)] + [(None, items[3][1]), (6000, items[3][1] + " x" * 30000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sum(len(t.split()) - 4 for _, t in items) > 1 << 16
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs_of(spark, rows), bench).collect()}
    assert got >= {(i, i) for i, _ in near} | {(6000, 3)}
    # beside its own item, a text with the shared stem meets only others with the stem
    assert all(a == b or (a % 10 == b % 10 == 0) for a, b in got if a < 5000) and not any(5000 <= a < 6000 or a is None for a, _ in got)
    held = decontam.staged(decontam.item_shingles(bench, 5), "t")
    for bits in (1 << 12, 1 << 21):  # a filter too small for its items lets everything through, and loses none
        may = decontam.bloom(held, bits)
        assert held.where(~may(F.col("h"))).count() == 0
    assert spark.range(100_000).where(may(F.xxhash64("id"))).count() < 1000


def test_simhash_radius_keeps_pairs_at_the_threshold():
    rng, most = np.random.default_rng(5), inspect.signature(decontam.contaminated).parameters["radius"].default
    for _ in range(20_000):
        n = int(rng.integers(2, 150))
        common = math.ceil(2 * n * 0.8 / 1.8)  # two sets of n with a similarity of 0.8
        hashes = rng.integers(0, 1 << 64, 2 * n - common, dtype=np.uint64)
        weight = np.sqrt(1 / rng.integers(1, 6, len(hashes)))
        signs = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).astype(float) * 2 - 1
        a, b = (signs[:n] * weight[:n, None]).sum(axis=0) > 0, (signs[n - common :] * weight[n - common :, None]).sum(axis=0) > 0
        assert (a != b).sum() <= most


def test_decontamination_repeated_words(spark):
    rng = random.Random(21)
    periodic = lambda: (" ".join(rng.choices("ab", k=rng.randint(1, 4))) + " ") * rng.randint(3, 12)
    items = [(i, (periodic() + periodic()).strip()) for i in range(10)] + [(50, "a " * 60), (51, "x " + "a " * 20)]
    rows = [(i, periodic() + periodic() + periodic()) for i in range(25)] + [(100, "a " * 400), (101, "a b " * 150), (102, "x " + "a " * 19)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.start_word, r.similarity) for r in decontam.contaminated(docs_of(spark, rows), bench).collect()}
    grams = {i: [tuple(w[j : j + min(5, len(w))]) for j in range(len(w) - min(5, len(w)) + 1)] for i, t in items for w in [t.split()]}
    bodies = dict(items)
    often = Counter(g for t in set(t for _, t in items) for g in set(grams[next(i for i in grams if bodies[i] == t)]))
    want = {}
    for d, t in rows:
        w = t.split()
        for i, runs in grams.items():
            n, k = len(bodies[i].split()), len(runs[0])
            at = [(p, tuple(w[p : p + k])) for p in range(len(w) - k + 1)]
            starts = {max(0, min(p - q, max(0, len(w) - n))) for p, g in at for q, h in enumerate(runs) if g == h}
            for s in sorted(starts):
                cut = Counter(tuple(w[s : s + n][j : j + k]) for j in range(len(w[s : s + n]) - k + 1))
                sim = round(max(brute_similarity(cut, Counter(runs), lambda g: 1 / often.get(g, 1)), brute_similarity(cut, Counter(runs), lambda g: 1)), 9)
                if sim >= 0.8 - 1e-9 and sim > want.get((d, i), (0, 0))[1]:
                    want[d, i] = (s, sim)
    assert got.keys() == want.keys() and len(want) >= 5
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-8 for k in want)


def test_runs_in_even_steps(spark):
    places = [("a", p) for p in (0, 1, 2, 3, 10, 17, 24, 25)] + [("b", 5)] + [("c", p) for p in range(0, 20_000, 2)]
    got = decontam.runs(spark.createDataFrame(places, "k string, at int"), ["k"], "at").collect()
    assert sorted((r.k, p) for r in got for p in range(r.lo, r.hi + 1, r.step)) == sorted(places)
    assert len([r for r in got if r.k == "c"]) == 1 and all(r.n == len(range(r.lo, r.hi + 1, r.step)) for r in got)

def formatted_nodes(spark, nodes, count):
    leaves, jumps = chat.branches(nodes)
    made = chat.format_paths(chat.paths(chat.best(leaves, count), jumps), nodes)
    return made.select("*", chat.parse(F.col("formatted")).alias("turns"), chat.learned(F.col("formatted"), F.col("spans")).alias("loss")).collect()


def test_chat_branches_against_brute_force(spark):
    rng, rows = random.Random(21), []
    pieces = ["\\", "<", "#", "### Assistant: </turn>\n", "a", "ü", "\n", "", "\\s", "😀"]
    for tree in [*range(25), None]:
        for node in range(rng.randint(1, 40)):
            parent = rng.choice([None, 99, *range(node)]) if node else None
            rows.append((tree, node, parent, rng.choice(["user", "assistant", "as<#\n", None]), rng.choice([None, "".join(rng.choices(pieces, k=rng.randint(0, 6)))]), rng.choice([None, float(rng.randint(-3, 3))])))
    frame = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double").withColumn("up", F.lit("x")).withColumn("at", F.lit("y"))
    want = {}
    for tree in {r[0] for r in rows}:
        by = {r[1]: r for r in rows if r[0] == tree}
        inner = {r[2] for r in by.values() if r[2] in by}
        found = []
        for leaf in set(by) - inner:
            path = [leaf]
            while by[path[-1]][2] in by:
                path.append(by[path[-1]][2])
            found.append((-sum(by[n][5] or 0.0 for n in path), -len(path), leaf, path[::-1]))
        for k, (score, _, _, path) in enumerate(sorted(found)[:3], 1):
            turns = [(by[n][3] or "", by[n][4] or "") for n in path]
            want[tree, k] = (-score, turns, "".join(t for r, t in turns if r == "assistant"))
    got = formatted_nodes(spark, frame, 3)
    assert {(r.tree, r.branch): (r.score, [tuple(t) for t in r.turns], r.loss) for r in got} == want and len(got) == len(want)
    for r in got:
        spans = "".join(r.formatted[s.start : s.start + s.chars] for s in r.spans)
        for plain, coded in (("#", "\\h"), ("<", "\\l"), ("\\", "\\s")):
            spans = spans.replace(coded, plain)
        assert spans == r.loss


def test_chat_long_conversation_is_linear(spark):
    import time

    def seconds(turns):
        frame = spark.range(turns).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("word <#> "), 20).alias("text"))
        made = chat.linear_nodes(frame)
        steps = made.select("tree", F.lit(1).alias("branch"), F.lit(0.0).alias("score"), F.col("node").alias("at"), "node")
        formatted = chat.staged(chat.format_paths(steps, made), "t")
        began = time.time()
        row = formatted.select(F.length(chat.learned(F.col("formatted"), F.col("spans"))).alias("loss"), F.size(chat.parse(F.col("formatted"))).alias("turns")).first()
        assert (row.loss, row.turns) == (180 * (turns // 2), turns)
        return time.time() - began

    seconds(2000)
    assert seconds(40_000) < 3 * seconds(20_000) + 2


def test_chat_rows_repeat_and_clash(spark):
    rows = [(1, 1, "user", "a " * 100_000), (1, 1, "user", "a " * 100_000), (1, None, None, None), (2, 1, "assistant", "x"), (2, 1, "assistant", "x")]
    frame = spark.createDataFrame([(*r, "p", "q") for r in rows], "conv_id long, turn long, role string, text string, tree string, node string")
    got = {r.tree: r for r in formatted_nodes(spark, chat.linear_nodes(frame), 1)}
    assert [t.text for t in got[1].turns] == ["", "a " * 100_000, "a " * 100_000] and got[2].loss == "xx"


def test_warc_small_archives_null_ids_and_zones(spark, tmp_path):
    rng, big = random.Random(30), "same " * 300
    pages = [(i, f"http://h{rng.randrange(4)}.org/{rng.randrange(9)}", rng.choice([None, "", big, "x" * rng.randrange(3000), "long " * 20000]), "u", 7) for i in range(120)]
    pages += [(None, None, big, "u", 7), (None, None, big, "u", 7), (119, "http://h0.org/0", big, "u", 7), (119, "http://h0.org/0", big, "u", 7), (None, "q", "only here " * 200, "u", 7)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, archive string, value int").repartition(3)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        warc.write_archives(frame, str(tmp_path / "w"), archive_bytes=20_000)
        index = warc.read_index(spark, str(tmp_path / "w"))
        rows = warc.merge_histories(index, range_rows=20).withColumn("second", F.unix_seconds("captured")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert len(rows) == len(pages) and all(r.second == 1_700_000_000 + (r.page_id or 0) for r in rows)
    low = -(1 << 62)
    keys = [(r.url_key, r.second, low if r.page_id is None else r.page_id, r.archive, r.record_offset) for r in rows]
    assert keys == sorted(keys) and len({r.archive for r in rows}) > 5
    sizes = Counter()
    for r in rows:
        sizes[r.archive] += r.record_bytes
    assert all(n <= 20_000 or sum(r.archive == a for r in rows) == 1 for a, n in sizes.items())
    held = {}
    for i, _, html, *_ in pages:
        held.setdefault(html or "", set()).add(i)
    for r in rows:
        same = next(ids for html, ids in held.items() if hashlib.sha1(html.encode()).hexdigest() == r.payload_digest)
        keeper = max((i for i in same if i is not None), default=None)
        revisit = r.payload_bytes >= 1000 and keeper is not None and r.page_id != keeper
        assert (r.record_type, r.refers_to) == (("revisit", keeper) if revisit else ("response", None))


def test_warc_dates_are_utc(spark):
    import datetime as dt

    seconds = [0, 86399, 951782400, 1_700_000_000, 1_710_054_000, 4_102_444_799]
    got = [r.t for r in spark.createDataFrame([(s,) for s in seconds], "s long").select(warc.utc_text(F.col("s")).alias("t")).collect()]
    assert got == [dt.datetime.fromtimestamp(s, dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ") for s in seconds]


def test_ann_repeated_rows_and_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(70).tolist()) for i in range(80)]
    rows += [(100, rows[0][1])] * 3 + [(100, rows[1][1]), (200, [1e200] + [0.0] * 69), (300, [1e-200] * 70), (400, [5.0]), (500, [1.0, 2.0]), (600, [3.0, 2.0])]
    frame = ann.usable(spark.createDataFrame([(*r, "a", 1) for r in rows], "vec_id long, embedding array<double>, row string, dims int"))
    got = Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(frame, F.col("vec_id") % 100 == 0, 4, block_rows=30, query_rows=3).collect())
    want = Counter()
    for i, (q, a) in enumerate(rows):
        if q % 100 == 0:
            near = []
            for j, (v, b) in enumerate(rows):
                if j != i and len(a) == len(b):
                    total = 0.0
                    for x, y in zip(a, b, strict=True):
                        total += (y - x) * (y - x)
                    near.append((math.sqrt(total), v))
            want.update((q, k, v, s) for k, (s, v) in enumerate(sorted(near)[:4], 1))
    assert sum((got & want).values()) >= 0.97 * sum(want.values()) and sum(got.values()) == sum(want.values())
    assert got[100, 1, 0, 0.0] == 3 and got[500, 1, 600, 2.0] == 1 and not any(q == 400 for q, *_ in got)


def test_sharding_against_plain_scheduling(spark):
    rng = random.Random(31)
    texts = [(rng.choice([None, 5, i]), f"t{rng.randrange(200)} " * rng.randint(1, 90)) for i in range(900)] + [(None, "hot copies")] * 400
    rows = sharding.shard(docs_of(spark, texts), 5, grain=100_000, unit_rows=30).collect()
    check_shards(rows, texts)
    # at this grain every group is a job of its own, so the loads are those of plain longest-processing-time scheduling
    groups = Counter()
    for _, t in texts:
        groups[t] += len(t.encode()) + 16
    plain, loads = [0] * 5, Counter()
    for size in sorted(groups.values(), reverse=True):
        plain[plain.index(min(plain))] += size
    for r in rows:
        loads[r.shard] += r.size
    assert sorted(loads.values()) == sorted(plain)


def test_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from terravane.llm import shared

    assert shared.shared_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    here = spark._jvm.org.apache.hadoop.fs.Path(shared.shared_dir(spark))
    assert here.getFileSystem(spark._jsc.hadoopConfiguration()).exists(here)
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="a"))
    with pytest.raises(shared.NoSharedFolder):
        shared.shared_dir(cluster)


def test_quality_sample_is_bounded_and_text_alone_counts(spark):
    rows = [(i % 7, f"text {i}") for i in range(300)] + [(3, "same")] * 500
    labels = spark.createDataFrame([(i, i % 2) for i in range(7)] + [(3, 1), (3, 0), (5, None)], "doc_id long, quality int")
    texts, y = quality.labelled_sample(docs_of(spark, rows), labels, rows=40)
    assert len(texts) == len(y) <= 40 and sum(t == "same" for t in texts) <= 2
    names = langid.labelled_sample(spark.createDataFrame([(5, "same", "en")] * 900 + [(i, f"t{i}", f"l{i % 90}") for i in range(900)], "doc_id long, text string, lang string"), per_language=5, languages=10)[1]
    assert len(names) <= 50 and max(Counter(names).values()) <= 5


def test_quality_awkward_texts_with_a_fitted_model(spark):
    rng = random.Random(7)
    good, bad = lambda: " ".join(f"word{rng.randrange(40)}" for _ in range(30)), lambda: "BUY!! " * rng.randint(5, 30)
    rows = [(100 + i, good() if i % 2 else bad()) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int").withColumn("text", F.lit("x"))
    got = quality.classify(docs_of(spark, rows + AWKWARD), labels).collect()
    assert len(got) == len(rows) + len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].score == by[2].score and by[None].held_out is None and Counter(r.doc_id for r in got)[5] == 2


def test_quality_scores_against_plain_sums():
    rng = random.Random(11)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma", "Delta", "42", "!!", "delta"], k=rng.randint(0, 20))) for _ in range(120)]
    y = [int(t.count("alpha") + t.count("beta") > 4) for t in texts]
    model, shapes = quality.train(texts, y, marks=False), quality.Shapes()
    for text in [*texts[:30], "", None, "unseen words only"]:
        words = (text or "").split()
        low = [w.lower() for w in words]
        form = ["".join(c for c, _ in __import__("itertools").groupby("A" if c.isupper() else "a" if c.islower() else "0" if c.isdigit() else c for c in w)).encode() for w in words]
        grams = {w.encode() for w in low} | {(a.encode(), b.encode(), 2) for a, b in zip(low, low[1:], strict=False)} | set(zip(form, form[1:], strict=False)) | {(f,) for f in form}
        known = [model.weights[g] for g in grams if g in model.weights]
        size = math.sqrt(sum(r * r for r, _ in known))
        margin = model.bias + (sum(r * w for r, w in known) / size if size else 0)
        assert abs(quality.score_text(model, text, shapes) - 1 / (1 + math.exp(-(model.slope * margin + model.shift)))) < 1e-9
    # no small step in any direction lowers the fitted loss
    rows = [np.array(sorted(rng.sample(range(30), 6))) for _ in range(60)]
    side, ratio, cost = np.array([1 if 3 in r or 7 in r else -1 for r in rows]), np.linspace(0.5, 2, 30), np.ones(60)
    w, b = quality.dual_descent(rows, ratio, side, cost, epochs=400)

    def loss(w, b):
        units = [ratio[r] / np.sqrt((ratio[r] ** 2).sum()) for r in rows]
        return 0.5 * (w @ w + b * b) + sum(max(0.0, 1 - s * (w[r] @ u + b)) for r, u, s in zip(rows, units, side, strict=True))

    best = loss(w, b)
    assert all(loss(w + 0.01 * d, b + 0.01 * e) > best - 1e-3 for d, e in zip(np.random.default_rng(1).standard_normal((200, 30)), np.random.default_rng(2).standard_normal(200), strict=True))


def test_language_awkward_rows(spark):
    rng = random.Random(13)
    words = {"en": ["the", "with", "thing"], "de": ["der", "schön", "nicht"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=20)), lang, "s", 0, "x") for i, lang in enumerate(["en", "de"] * 120)]
    rows += [(1000, "the thing with " * 60000, None, None, None, "x"), (1001, "der schön", None, None, None, "x"), (1001, "der schön", None, None, None, "x"), (None, "nicht der", "de", None, None, "x"), (1002, "", "en", None, None, "x")]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, lang_pred string")).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[1000].lang_pred == "en" and by[1001].lang_pred == "de" and by[None].held_out is None and by[None].lang_pred == "de" and (by[1002].lang_pred, by[1002].score) == ("und", 0.0)
    net = langid.train([r[1] for r in rows[:240]], [r[2] for r in rows[:240]])
    text = rows[0][1]
    padded, used = langid.cut(text)
    whole = np.zeros(len(net.names))
    for at in range(0, len(padded), langid.WINDOW):  # the convolution written out, window by window
        window = padded[at : at + langid.WINDOW]
        top = np.full(len(net.bias), -np.inf)
        for i in range(langid.WINDOW):
            patch = np.concatenate([net.embed[window[i + j]] if i + j < langid.WINDOW else np.zeros(langid.EMBED) for j in range(max(langid.WIDTHS))])
            top = np.maximum(top, patch @ net.filters)
        z = np.maximum(top + net.bias, 0) @ net.out + net.out_bias
        p = np.exp(z - z.max())
        whole += p / p.sum() * min(langid.WINDOW, used - at)
    names, scores = langid.predict_texts(net, [text])
    assert names[0] == net.names[int(whole.argmax())] and abs(scores[0] - whole.max() / used) < 1e-4


def plain_pipeline(docs, items, weights):
    """The stages' decisions in plain Python over (doc_id, text, lang, source); returns the ids kept by each."""
    ids = lambda rows: {r[0] for r in rows}
    kept = [r for r in docs if r[1] and any(map(str.isalpha, r[1]))]
    out = [ids(kept)]
    sets = [five(r[1]) for r in kept]
    parent = {i: i for i in range(len(kept))}
    for i in parent:
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                u, v = find(parent, i), find(parent, j)
                parent[max(u, v)] = min(u, v)
    least = {}
    for i, r in enumerate(kept):
        least[find(parent, i)] = min(least.get(find(parent, i), r[0]), r[0])
    kept = [r for r in kept if r[0] in set(least.values())]
    out.append(ids(kept))
    cut = lambda t: [w for w in re.split(r"[\x20\t-\r]+", t.lower()) if w]
    grams = {i: Counter(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) for i, t in items if (w := cut(t or "")) and (k := min(5, len(w)))}
    holders = Counter(g for c in {frozenset(c.items()) for c in grams.values()} for g, _ in c)

    def leaks(text):
        w = cut(text)
        for i, c in grams.items():
            k, n = len(next(iter(c))), len(cut(dict(items)[i]))
            have = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}
            if not have & set(c):
                continue
            for s in range(max(1, len(w) - n + 1)):
                part = w[s : s + n]
                mine = Counter(tuple(part[j : j + k]) for j in range(len(part) - k + 1))
                if mine and max(brute_similarity(mine, c, lambda g: 1 / holders.get(g, 1)), brute_similarity(mine, c, lambda g: 1)) >= 0.8:
                    return True
        return False

    kept = [r for r in kept if not leaks(r[1])]
    out.append(ids(kept))
    leaf = lambda r: (f"domain{int(hashlib.md5(r[3].encode()).hexdigest()[:8], 16) % 4}", r[2], r[3])
    tokens, held = Counter(), {}
    for r in kept:
        tokens[leaf(r)] += len(cut(r[1]))
        held.setdefault(leaf(r), []).append(r)
    budgets, chosen = plain_budgets(tokens, 0.9 * sum(tokens.values()), weights), set()
    for name, rows in held.items():
        run = 0
        for r in sorted(rows, key=lambda r: hashlib.md5(f"17:0:{r[0]}:{int(hashlib.md5(r[1].encode()).hexdigest()[:15], 16)}".encode()).hexdigest()):
            run += len(cut(r[1]))
            if run <= budgets[name] + 1e-6:
                chosen.add(r[0])
    return [*out, chosen]


def test_pipeline_run_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text, r.lang or "none", r.source or "none") for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    want = plain_pipeline(docs, items, corpus_pipeline.WEIGHTS)
    assert len({r[0] for r in docs}) == len(docs) and len(docs) > len(want[1]) > len(want[2]) > len(want[3])
    frame = spark.read.parquet(f"{d}/documents.parquet")
    for (_, stage), ids in zip(corpus_pipeline.STAGES[:-1], want, strict=True):
        frame = chat.staged(stage(spark, frame, d), "t")
        assert sorted(r.doc_id for r in frame.collect()) == sorted(ids)
    rows = corpus_pipeline.run(spark, d).collect()
    text = dict((r[0], r[1]) for r in docs)
    check_shards(rows, [(i, text[i]) for i in want[3]])
    assert {r.shard for r in rows} == set(range(40)) if len(rows) >= 200 else len(rows) == len(want[3])


def test_simhash_query_against_brute_force(spark):
    import xxhash

    from terravane.llm import queries

    d = "/root/testdata/sf0.001"
    prints = {}
    for r in spark.read.parquet(f"{d}/documents.parquet").collect():
        words = [w for w in re.split(r"[\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or "")) if w]
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        prints[r.doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    parent = {i: i for i in prints}
    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                u, v = find(parent, a), find(parent, b)
                parent[max(u, v)] = min(u, v)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op10_simhash(spark, d).collect()}
    assert got == {i: (f"{prints[i]:016x}", find(parent, i)) for i in prints} and len({c for _, c in got.values()}) < len(got)


def test_queries_against_sql(spark):
    from terravane.llm import queries

    d = "/root/testdata/sf0.001"
    tables = {t: f"{d}/{t}.parquet" for t in ("documents", "benchmark", "conversations", "embeddings", "pages")}
    for name, sql in queries.oracle_sql().items():
        df = queries.queries()[name](spark, d)
        want = oracle_rows(sql, **tables)
        show = lambda r: str([round(r[c], 9) if isinstance(r[c], float) else str(r[c]) for c in sorted(df.columns)])  # noqa: E731, B023
        assert sorted(map(show, df.collect())) == sorted(map(show, want)) and want, name
