"""Ranked search, the prefix trie and the removal of repeats against brute force, and on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from terravane.llm import prefix_trie, ranked_search, repeats

DOCS = "doc_id long, text string, lang string, term string, tid string, range string, mark string"
AWKWARD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (5, "one"), (6, "word " * 30000), (7, "Ünïcode ßtraße 12"), (8, "a b c d e f g"), (None, "lost id one")]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "x", "y", "z", "w") for i, t in rows], DOCS)


def plain_terms(text):
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", small)


def plain_search(docs, items, k):
    counts = [(i, plain_terms(t)) for i, t in docs]
    n_docs, length = sum(bool(w) for _, w in counts), sum(len(w) for _, w in counts)
    df = Counter(w for _, words in counts for w in set(words))
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(plain_terms(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, words in counts:
            tf, m = Counter(words), 10 + 90 * len(words) * n_docs // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf[t] // (1000 * tf[t] + 8 * m)) for t in terms if tf[t])
            if score > 0:
                scored.append((-score, i is None, i, score))
        out += [(item, r, x[2], x[3]) for r, x in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def told(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.mark.parametrize(("range_docs", "block_terms"), [(4096, 200_000), (7, 30)])
def test_search_against_brute_force(spark, monkeypatch, range_docs, block_terms):
    """Small ranges and blocks of queries as well as large ones; equal documents in plenty, so that ties go over the k-th place."""
    monkeypatch.setattr(ranked_search, "QUERY_TERMS", block_terms)
    rng = random.Random(range_docs)
    words = [f"w{i}" for i in range(60)] + ["Ä", "é9", "SHARED"]
    docs = [(i, " ".join(rng.choices(words, weights=range(1, len(words) + 1), k=rng.randint(0, 30)))) for i in range(150)]
    docs += [(200 + i, "w1 w2; w3") for i in range(40)]
    items = [(i, ", ".join(rng.sample(words, rng.randint(1, 8)))) for i in range(12)] + [(99, "w1-w2"), (100, "none of it"), (101, None), (99, "W3")]
    got = told(ranked_search.search(docs_of(spark, docs), spark.createDataFrame(items, "item_id long, text string"), 10, range_docs=range_docs))
    assert got == plain_search(docs, items, 10)


def test_search_awkward(spark):
    items = [(1, "One"), (None, "word 12"), (2, ""), (3, "straße ßtraße"), (1, "One")]
    items_df = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    assert told(ranked_search.search(docs_of(spark, AWKWARD), items_df, 3)) == plain_search(AWKWARD, items, 3)
    assert ranked_search.search(docs_of(spark, []), items_df).count() == 0
    assert ranked_search.search(docs_of(spark, AWKWARD), items_df.limit(0)).count() == 0
    assert ranked_search.search(docs_of(spark, [(1, None)]), items_df).count() == 0


def test_max_trees_open_few_nodes():
    """The best of 65,536 documents are found without a look at most of them."""
    rng = np.random.default_rng(3)
    term, doc = rng.integers(0, 50, 400_000), rng.integers(0, 65_536, 400_000)
    pair = np.unique(np.stack((term, doc)), axis=1)
    part = np.minimum(rng.pareto(1.0, pair.shape[1]) * 1000, 10**9).astype(np.int64) + 1
    trees = ranked_search.MaxTrees(pair[0], pair[1], part, 65_536)
    seen, sums = [], trees.sums
    trees.sums = lambda level, low, high, asked: (seen.append(high - low) if level == 0 else None, sums(level, low, high, asked))[1]
    asked = np.zeros(50, bool)
    asked[[3, 7, 11]] = True
    score = np.bincount(pair[1], weights=np.where(asked[pair[0]], part, 0), minlength=65_536)
    want = sorted(((int(s), d) for d, s in enumerate(score) if s), key=lambda x: (-x[0], x[1]))[:10]
    assert trees.best(asked, 10, []) == want and sum(seen) < 3000


def plain_trie(turns):
    by = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    made = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        made[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in made.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words
            leaves[p[:d]] += p not in kids
    return sorted(
        (
            (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(str(c) for c in sorted(m) if len(made[c]) == len(p)).encode()).hexdigest())
            for p, m in members.items()
        ),
        key=str,
    )


def trie_rows(df):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()), key=str)


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize(("bits", "chunk_rows"), [(64, 4096), (3, 2), (0, 5)])
def test_trie_against_brute_force(spark, bits, chunk_rows):
    """Also with fingerprints of three bits and of none, so that nearly all groups collide and are split."""
    rng = random.Random(5)
    turns = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b b", "c  d\te"])) for c in range(90) for t in range(rng.randint(1, 6))]
    turns += [(c, t, "user", "same words here") for c in range(100, 160) for t in range(3)]
    got = trie_rows(prefix_trie.trie(prefix_trie.rebuilt(spark.createDataFrame(turns, TURNS)), bits, chunk_rows))
    assert got == plain_trie(turns)


def test_trie_awkward(spark):
    turns = [
        (None, 0, "user", "lost"), (0, None, None, None), (0, 1, "user", "word " * 20000), (0, 1, "assistant", "é"), (1, 0, "user", "x"), (1, 0, "user", "x"),
        (41, 0, "user", "only a turn"), (-7, 3, "user", "below"), (-20, 0, "user", "base"), (40000000001, 2, "", ""), (2, 5, "user:", "x"), (3, 5, "user", ":x"),
    ] + [(7, t, "user", f"{t}") for t in range(300)]
    extra = spark.createDataFrame([(*x, 1, 2, 3) for x in turns], TURNS + ", depth long, fp long, place long")
    assert trie_rows(prefix_trie.trie(prefix_trie.rebuilt(extra))) == plain_trie(turns)
    assert prefix_trie.trie(prefix_trie.rebuilt(extra.limit(0))).count() == 0


def plain_repeats(docs, window):
    words = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for _, t in docs]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words, strict=True):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def repeat_rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize(("window", "gram", "block_rows"), [(35, 12, 4096), (35, 12, 3), (5, 2, 10), (4, 4, 2), (1, 1, 50)])
def test_repeats_against_brute_force(spark, window, gram, block_rows):
    """Passages around the threshold in changing surroundings, inside one document, copies, runs of one word; anchors in one task and dealt out."""
    rng = random.Random(window)
    word = [f"v{i}" for i in range(40 if window > 5 else 400)]
    passages = [rng.choices(word, k=n) for n in (window - 1, window, window + 1, 3 * window, 200)]
    docs = []
    for i in range(60):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += rng.choices(word, k=rng.randint(0, 50)) + rng.choice(passages)
        docs.append((i, "  ".join(text)))
    docs += [(100, docs[3][1]), (101, docs[3][1].replace("  ", "\n")), (102, docs[4][1] + " end"), (103, "same " * 100), (104, "same " * (window - 1)), (105, "u " * window)]
    got = repeat_rows(repeats.remove_repeats(docs_of(spark, docs), window, gram, block_rows))
    assert got == plain_repeats(docs, window)


def test_repeats_awkward(spark):
    docs = [*AWKWARD, (9, "q " * 40 + "end"), (9, "q " * 40 + "end"), (None, " ".join(map(str, range(50)))), (10, " ".join(map(str, range(10, 60)))), (11, "\x1c \x85 x")]
    assert repeat_rows(repeats.remove_repeats(docs_of(spark, docs))) == plain_repeats(docs, 35)
    assert repeats.remove_repeats(docs_of(spark, [])).count() == 0
    with pytest.raises(ValueError):
        repeats.remove_repeats(docs_of(spark, []), 5, 6)


def test_windows_choose_alike():
    """Equal windows choose the same anchor whatever stands around them, runs of equal words too."""
    rng = random.Random(8)
    for shared in ([f"v{rng.randrange(9)}".encode() for _ in range(35)], [b"x"] * 35):
        found = set()
        for _ in range(20):
            before = [f"v{rng.randrange(9)}".encode() for _ in range(rng.randint(0, 40))]
            (grams,) = repeats.rolling([*before, *shared, *[b"v1"] * rng.randint(0, 9)], (12,))
            found.add(int(repeats.choices(grams, 24)[len(before)]) - len(before))
        assert len(found) == 1


def test_new_queries_read_their_tables(spark):
    from terravane.llm import queries

    d = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert repeat_rows(queries.op13_repeats(spark, d)) == plain_repeats(docs, 35)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    assert told(queries.op11_ranked_search(spark, d)) == plain_search(docs, items, 10)
    turns = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(queries.op12_prefix_trie(spark, d)) == plain_trie(turns)
