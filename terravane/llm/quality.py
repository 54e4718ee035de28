"""Quality classification by naive Bayes support vectors.

N-gram indicators of a text are scaled by their class log-count ratios, and a linear hinge-loss model is fitted on them
by dual coordinate descent. N-grams are taken over words (one and two) and over word shapes (runs of letter case, digits and marks), so that
what a text looks like counts beside what it says; a few marks of the whole text (repeats, length, spread, main shapes) are indicators like others and
can be left out. A sigmoid fitted on rows left out of the fit turns margins into scores.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.shared import fold

_CLASSES = bytes.maketrans(
    bytes(range(256)),
    bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)),
)


class Shapes(dict):
    """Translated word -> shape: each run of one class is one character."""

    def __missing__(self, key: bytes) -> bytes:
        shape = bytes(c for i, c in enumerate(key) if not i or key[i - 1] != c)
        if len(self) < 200_000:
            self[key] = shape
        return shape


def indicators(text: str | None, shapes: Shapes, marks: bool = True) -> set:
    """The n-grams that a whole text holds: words and pairs of words, shapes and pairs of shapes, and with ``marks`` those of the whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    form = [shapes[w] for w in raw.translate(_CLASSES).split()]
    low = [w.lower() for w in words]
    found: set = set(low)
    found.update((a, b, 2) for a, b in zip(low, low[1:]))
    found.update(zip(form, form[1:]))
    found.update((f,) for f in set(form))
    if not marks:
        return found
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    n = len(words)
    found.add(("repeat", int(8 * repeats / n) if n else -1, repeats > 0))
    found.add(("length", n.bit_length()))
    found.add(("spread", int(4 * len(set(words)) / n) if n else -1, n.bit_length() // 2))
    # which shapes make up the text, in eighths
    found.update(("part", f, c * 8 // n) for f, c in Counter(form).items() if c * 8 >= n)
    return found


@dataclass
class Model:
    """weights: n-gram -> (log-count ratio, weight); the sigmoid of slope * margin + shift is the score. marks: whether marks of the whole text are among the indicators."""

    weights: dict
    bias: float
    slope: float
    shift: float
    marks: bool = True


def dual_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int = 30, seed: int = 3) -> tuple[np.ndarray, float]:
    """L2-regularised hinge loss by dual coordinate descent over indicator rows (feature numbers) scaled by ``ratio`` and to unit length."""
    rng, w, b, alpha = np.random.default_rng(seed), np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    values = []
    for r in rows:
        v = ratio[r]
        values.append(v / max(np.sqrt((v * v).sum()), 1e-9))
    square = np.array([(v * v).sum() + 1.0 for v in values])
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + b) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            step = new - alpha[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * y[i] * values[i]
                b += step * y[i]
                worst = max(worst, abs(step))
        if worst < 1e-3:
            break
    return w, b


def _sigmoid(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps on the smoothed targets."""
    up, down = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + c, -60, 60)))
        g = np.array([((p - target) * margins).sum() + 1e-6 * a, (p - target).sum()])
        s = p * (1 - p)
        h = np.array([[(s * margins**2).sum(), (s * margins).sum()], [(s * margins).sum(), s.sum()]]) + 1e-6 * np.eye(2)
        move = np.linalg.solve(h, g)
        a, c = a - move[0], c - move[1]
        if np.abs(move).max() < 1e-8:
            break
    return float(max(a, 1e-3)), float(c)


def train(texts: list[str | None], labels: list[int], smoothing: float = 1.0, cost: float = 1.0, least_rows: int = 3, seed: int = 3, marks: bool = True) -> Model:
    """Fit on labelled whole texts. One class alone gives a constant score that leans to it; no rows give 0.5."""
    y = np.where(np.array(labels, dtype=np.int64) == 1, 1, -1)
    if len(set(y.tolist())) < 2:
        n = len(y)
        return Model({}, 0.0, 1.0, math.log((1 + (y > 0).sum()) / (1 + n - (y > 0).sum())))
    shapes = Shapes()
    # most n-grams stand in one text only: a first pass counts their hashes, so that only frequent ones are ever held
    hashes, counts = np.unique(np.concatenate([np.fromiter(map(hash, indicators(t, shapes, marks)), np.int64) for t in texts]), return_counts=True)
    frequent = set(hashes[counts >= least_rows].tolist())
    found = [{f for f in indicators(t, shapes, marks) if hash(f) in frequent} for t in texts]
    often = Counter(f for s in found for f in s)
    names = sorted((f for f, n in often.items() if n >= least_rows), key=repr)
    number = {f: i for i, f in enumerate(names)}
    rows = [np.array(sorted(number[f] for f in s if f in number), np.int64) for s in found]
    del found, often, frequent

    def fit(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        up, down = np.full(len(names), smoothing), np.full(len(names), smoothing)
        for i in ids:
            (up if y[i] > 0 else down)[rows[i]] += 1
        ratio = np.log(up / up.sum()) - np.log(down / down.sum())
        share = {s: len(ids) / 2 / max(1, (y[ids] == s).sum()) for s in (1, -1)}
        w, b = dual_descent([rows[i] for i in ids], ratio, y[ids], np.array([cost * share[s] for s in y[ids]]), seed=seed)
        return ratio, w, b

    def margins(ratio: np.ndarray, w: np.ndarray, b: float, ids: np.ndarray) -> np.ndarray:
        out = []
        for i in ids:
            v = ratio[rows[i]]
            out.append(w[rows[i]] @ v / max(np.sqrt((v * v).sum()), 1e-9) + b)
        return np.array(out)

    order, held = np.random.default_rng(seed).permutation(len(y)), np.zeros(len(y))
    for part in np.array_split(order, min(3, len(order))):
        rest = np.setdiff1d(order, part)
        held[part] = margins(*fit(rest), part)
    slope, shift = _sigmoid(held, y)
    ratio, w, b = fit(np.arange(len(y)))
    return Model({f: (float(ratio[i]), float(w[i])) for f, i in number.items()}, b, slope, shift, marks)


def score_text(model: Model, text: str | None, shapes: Shapes) -> float:
    w = model.weights
    hits = [w[f] for f in indicators(text, shapes, model.marks) & w.keys()] if w else []
    length = math.sqrt(sum(r * r for r, _ in hits))
    margin = model.bias + (sum(r * v for r, v in hits) / length if length else 0.0)
    return 1 / (1 + math.exp(min(60.0, max(-60.0, -(model.slope * margin + model.shift)))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = 4000) -> tuple[list[str | None], list[int]]:
    """Whole texts and labels of at most ``rows`` different training rows, drawn by hashes of id and text.

    ``rows`` bounds the fit and what comes to the driver, whatever repeats: first that many labelled ids, then that many of their different (id, text, label) rows. Both classes are drawn
    at one rate, so a score means the same at every size. Held-out ids and null labels are not drawn. A doc_id with several labels is drawn with each.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).where((fold(F.col("id")) != 0) & F.col("y").isNotNull()).distinct()
    drawn = known.orderBy(F.xxhash64("id", "y"), "id", "y").limit(rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("id"))
    each = joined.groupBy("doc_id", F.xxhash64("text").alias("mark"), "y").agg(F.first("text").alias("text"))
    got = each.orderBy(F.xxhash64("doc_id", "mark", "y"), "doc_id", "mark", "y").limit(rows).collect()
    return [r.text or "" for r in got], [int(r.y == 1) for r in got]


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """documents -> (doc_id, held_out, score, predicted), one row per input row; null and empty texts are scored as texts without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            scores = [score_text(model, t.as_py(), shapes) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == 0).alias("held_out"), "text")
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = 4000, threshold: float = 0.3, marks: bool = True) -> DataFrame:
    """Train on the labelled sample and score every whole text: (doc_id, held_out, score, predicted), one row per input row.

    Null and empty texts are scored as texts without a word; very long ones are read whole. Rows that repeat come out as often. A null doc_id has a null held_out and is never learned from.
    Without a labelled row every score is 0.5, with labels of one class alone they lean to it. Other columns are not read. No documents give no rows.
    """
    texts, y = labelled_sample(docs, labels, label, rows)
    return score(docs, train(texts, y, marks=marks), threshold)
