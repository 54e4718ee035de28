"""Language identification by a byte convolutional network, trained and applied in numpy.

A text is lower-cased, encoded and cut into windows of ``WINDOW`` bytes that cover all of it. Bytes are embedded, filters
of several widths slide over them, each filter keeps its maximum in the window, and a softmax layer
gives the languages' probabilities. A text's probabilities are the mean over its windows, weighted by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.llm.shared import fold

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 6


@dataclass
class ByteCNN:
    """embed (256, EMBED); filters (max width * EMBED, all filters), zero below a filter's width; bias; out (filters, languages); out_bias; names."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    names: list[str]

    def features(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n, WINDOW) bytes -> filter responses at every position, and the embedded patches under the filters."""
        n, deep = len(windows), max(WIDTHS)
        padded = np.zeros((n, WINDOW + deep - 1, EMBED), np.float32)
        padded[:, :WINDOW] = self.embed[windows]
        stride = padded.strides
        view = np.lib.stride_tricks.as_strided(padded, (n, WINDOW, deep * EMBED), (stride[0], stride[1], stride[2]), writeable=False)
        patches = np.ascontiguousarray(view)
        z = patches.reshape(-1, deep * EMBED) @ self.filters
        z = z.reshape(n, WINDOW, -1)
        return z, patches

    def probabilities(self, windows: np.ndarray, at_once: int = 128) -> np.ndarray:
        out = []
        for at in range(0, len(windows), at_once):
            z, _ = self.features(windows[at : at + at_once])
            top = np.maximum(z.max(axis=1) + self.bias, 0)
            out.append(_softmax(top @ self.out + self.out_bias))
        return np.concatenate(out) if out else np.zeros((0, len(self.names)), np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut(text: str) -> tuple[bytes, int]:
    """Lower-cased bytes padded to whole windows, and how many of them are text."""
    raw = text.lower().encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % WINDOW), len(raw)


def train(texts: list[str], names: list[str], epochs: int = 4, windows_a_text: int = 4, batch: int = 128, rate: float = 4e-3, seed: int = 5) -> ByteCNN:
    """Fit by Adam on cross-entropy over windows drawn from the labelled texts; classes weigh alike."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(names))
    xs, ys = [], []
    for text, name in zip(texts, names, strict=True):
        padded, size = cut(text)
        if not size:
            continue
        w = np.frombuffer(padded, np.uint8).reshape(-1, WINDOW)
        for i in rng.permutation(len(w))[:windows_a_text]:
            xs.append(w[i])
            ys.append(langs.index(name))
            # short texts are windows that are mostly padding; cut-off copies teach them
            if rng.random() < 0.35:
                short = w[i].copy()
                short[int(rng.integers(12, WINDOW)) :] = 0
                xs.append(short)
                ys.append(langs.index(name))
    x, y = np.array(xs, np.uint8).reshape(-1, WINDOW), np.array(ys, np.int64)
    deep, width = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((deep * EMBED, width), np.float32)
    for k, w in enumerate(WIDTHS):
        mask[: w * EMBED, k * FILTERS : (k + 1) * FILTERS] = 1
    net = ByteCNN(
        (rng.standard_normal((256, EMBED)) * 0.5).astype(np.float32), (rng.standard_normal(mask.shape) * 0.3).astype(np.float32) * mask,
        np.zeros(width, np.float32), (rng.standard_normal((width, len(langs))) * 0.1).astype(np.float32), np.zeros(len(langs), np.float32), langs,
    )
    net.embed[0] = 0
    weight = np.array([len(y) / max(1, (y == c).sum()) / len(langs) for c in range(len(langs))], np.float32)
    params = [net.embed, net.filters, net.bias, net.out, net.out_bias]
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs if len(y) else 0):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            ids = order[at : at + batch]
            wx, wy, n = x[ids], y[ids], len(ids)
            z, patches = net.features(wx)
            where = z.argmax(axis=1)
            rows, cols = np.arange(n)[:, None], np.arange(width)[None, :]
            raw = z[rows, where, cols] + net.bias
            top = np.maximum(raw, 0)
            p = _softmax(top @ net.out + net.out_bias)
            p[np.arange(n), wy] -= 1
            p *= weight[wy][:, None] / n
            g_out, g_out_bias = top.T @ p, p.sum(axis=0)
            g_top = (p @ net.out.T) * (raw > 0)
            hit = patches[rows, where]  # (n, filters, deep * EMBED)
            g_filters = np.einsum("nf,nfe->ef", g_top, hit) * mask
            g_hit = (g_top[:, :, None] * net.filters.T[None]).reshape(n, width, deep, EMBED)
            g_embed = np.zeros_like(net.embed)
            place = where[:, :, None] + np.arange(deep)
            inside = place < WINDOW
            byte = np.where(inside, wx[np.arange(n)[:, None, None], np.minimum(place, WINDOW - 1)], 0)
            np.add.at(g_embed, byte.ravel(), g_hit.reshape(-1, EMBED))
            g_embed[0] = 0
            t += 1
            lr = rate * (1 - 0.9 * t / (epochs * -(-len(order) // batch) + 1))
            for i, g in enumerate((g_embed, g_filters, g_top.sum(axis=0), g_out, g_out_bias)):
                first[i] += 0.1 * (g - first[i])
                second[i] += 0.001 * (g * g - second[i])
                params[i] -= (lr * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return net


def labelled_sample(docs: DataFrame, per_language: int = 600, languages: int = 64) -> tuple[list[str], list[str]]:
    """Whole texts and languages of at most ``per_language`` different training rows of each of the ``languages`` most frequent languages, drawn by the hash of id and text.

    These two bound the fit and what comes to the driver, whatever repeats; rarer languages are not learned. Held-out rows, null languages and null texts are not drawn.
    """
    known = docs.select("doc_id", "text", "lang").where((fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()}
    if not counts:
        return [], []
    size = 1 << 20
    limit = F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(min(size, int(size * per_language * 1.3 / n) + 64)))])
    place = F.xxhash64("doc_id", "text")
    some = known.where(F.pmod(place, F.lit(size)) < limit[F.col("lang")]).groupBy("lang", "doc_id", place.alias("place")).agg(F.first("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.pmod("place", F.lit(size)), "doc_id", "place")
    drawn = some.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language)
    rows = sorted(((r.doc_id, r.text, r.lang) for r in drawn.collect()), key=lambda r: (r[0], r[1], r[2]))
    return [r[1] for r in rows], [r[2] for r in rows]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predict_texts(net: ByteCNN, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """(language, score) of each whole text; ``und`` and 0 for a text that is null or has no letter."""
    names, scores = ["und"] * len(texts), np.zeros(len(texts))
    group: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal group, size
        if not group:
            return
        cuts = [cut(texts[i]) for i in group]
        probs = net.probabilities(np.frombuffer(b"".join(c for c, _ in cuts), np.uint8).reshape(-1, WINDOW))
        at = 0
        for i, (padded, used) in zip(group, cuts, strict=True):
            n = len(padded) // WINDOW
            weight = np.full(n, float(WINDOW))
            weight[-1] = used - WINDOW * (n - 1)
            p = weight @ probs[at : at + n] / used
            at += n
            names[i], scores[i] = net.names[int(p.argmax())], min(1.0, float(p.max()))
        group, size = [], 0

    for i, text in enumerate(texts):
        if text and net.names and has_letter(text):
            group.append(i)
            size += len(text)
            if size > 1 << 20:
                flush()
    flush()
    return names, scores


def predict(docs: DataFrame, net: ByteCNN, carry: tuple[str, ...] = ()) -> DataFrame:
    """documents -> (doc_id, held_out, lang_pred, score), one row per input row; only doc_id and text are read, and doc_id only to name the row.

    The columns named in ``carry`` come along as a struct ``row``, so a filter on the prediction needs no join and no shuffle of texts.
    """
    inside = "text" in carry
    made = [T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (fold(F.col("doc_id")) == 0).alias("held_out"),
        *([] if inside else ["text"]), *([F.struct(*carry).alias("row")] if carry else []),
    )
    schema = T.StructType(made + ([rows.schema["row"]] if carry else []))
    names_out = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = batch.column("row").field("text") if inside else batch.column("text")
            names, scores = predict_texts(net, read.to_pylist())
            kept = [batch.column("row")] if carry else []
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), *kept], names_out)

    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, per_language: int = 600, carry: tuple[str, ...] = ()) -> DataFrame:
    """Train on the labelled sample of ``docs`` and predict every whole text: (doc_id, held_out, lang_pred, score), one row per input row.

    A null text and one without a letter (empty ones among them) is ``und`` with score 0; very long texts are read whole, in windows. Ties go to the first language by name. Rows that
    repeat come out as often; a null doc_id has a null held_out and is never learned from. Without one labelled row every language is ``und``. Other columns are not read. No rows give no rows.
    """
    texts, names = labelled_sample(docs, per_language)
    return predict(docs, train(texts, names), carry)
