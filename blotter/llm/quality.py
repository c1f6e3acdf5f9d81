"""Quality classifier: a byte-level convolutional network in numpy.

A filter looks at WIDTH consecutive bytes and moves by STRIDE, so its windows
overlap and cover the whole text. Responses are max-pooled over chunks of
CHUNK bytes that overlap by half, a small hidden layer turns each chunk into a
logit, and the mean logit of all chunks, rescaled on the training documents,
gives one probability per document.

The network is fitted on the driver from a bounded sample of labelled rows
(``max_per_class`` rows of each class, each text of at most ``max_bytes``
bytes); scoring runs in Arrow batches over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

WIDTH, STRIDE, CHUNK = 8, 2, 256
#: Score from which a document counts as good.
THRESHOLD = 0.7
HALF = CHUNK // 2
#: Very long texts are scored piece by piece; chunk logits simply add up.
PIECE = 1 << 19


@dataclass
class Network:
    filters: np.ndarray  # (WIDTH, 256, f): response of each filter to each byte at each place
    bias: np.ndarray
    hidden: np.ndarray  # (f, h)
    hidden_bias: np.ndarray
    out: np.ndarray  # (h,)
    out_bias: float = 0.0
    scale: float = 1.0
    shift: float = 0.0

    def pair_tables(self) -> list[np.ndarray]:
        """Responses to two neighbouring bytes, so that a window takes
        WIDTH / 2 look-ups."""
        return [(self.filters[k][None, :, :] + self.filters[k + 1][:, None, :]).reshape(65536, -1)
                .astype(np.float32) for k in range(0, WIDTH, 2)]

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias

    def probability(self, mean_logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * mean_logit + self.shift, -40, 40)))


def _halves(net: Network, tables: list[np.ndarray], data: np.ndarray) -> np.ndarray:
    """Max response of each filter per half chunk; ``data`` has whole half
    chunks and WIDTH more bytes."""
    pairs = data[::2].astype(np.int32) | data[1::2].astype(np.int32) << 8
    n = (len(data) - WIDTH) // STRIDE
    total = tables[0].take(pairs[:n], axis=0)
    for k in range(1, WIDTH // 2):
        total += tables[k].take(pairs[k:k + n], axis=0)
    best = total.reshape(-1, HALF // STRIDE, total.shape[1]).max(axis=1)
    return np.maximum(best + net.bias, 0)


def _pieces(text: bytes) -> Iterator[bytes]:
    for at in range(0, max(len(text), 1), PIECE):
        yield text[at:at + PIECE + HALF + WIDTH]
        if at + PIECE + HALF >= len(text):
            break


def mean_logits(net: Network, texts: list[bytes], tables: list[np.ndarray] | None = None) -> np.ndarray:
    """Mean chunk logit per text. An empty text is one chunk of zero bytes."""
    tables = tables or net.pair_tables()
    sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
    todo, held = [], 0

    def flush() -> None:
        sizes = []
        parts = []
        for _, piece, last in todo:
            halves = max(1, -(-min(len(piece), PIECE + (HALF if not last else PIECE)) // HALF))
            sizes.append(halves)
            room = halves * HALF + WIDTH
            parts.append(piece[:room].ljust(room + WIDTH, b"\0"))
        # Every part takes its half chunks and one more that only pads.
        joined = b"".join(p[:s * HALF + WIDTH].ljust((s + 1) * HALF, b"\0") for p, s in zip(parts, sizes))
        best = _halves(net, tables, np.frombuffer(joined + bytes(WIDTH), np.uint8))
        starts = np.cumsum([0, *[s + 1 for s in sizes]])
        after = np.maximum(best[:-1], best[1:])
        for (i, _, _), s, n in zip(todo, starts, sizes):
            pooled = after[s:s + n - 1] if n > 1 else best[s:s + 1]
            got = net.logits(pooled)
            sums[i] += got.sum()
            counts[i] += len(got)
        todo.clear()

    for i, text in enumerate(texts):
        pieces = list(_pieces(text))
        for k, piece in enumerate(pieces):
            todo.append((i, piece, k == len(pieces) - 1))
            held += len(piece) + CHUNK
            if held > PIECE:
                flush()
                held = 0
    if todo:
        flush()
    return sums / np.maximum(counts, 1)


def train(texts: list[bytes], labels: np.ndarray, n_filters: int = 24, n_hidden: int = 16,
          chunks_per_text: int = 12, epochs: int = 10, seed: int = 7) -> Network:
    """Fit the network by Adam on chunks drawn over the whole of each text.

    Without texts of both classes the network answers the share of label 1.
    """
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.15, (WIDTH, 256, n_filters)), np.zeros(n_filters),
                  rng.normal(0, 0.3, (n_filters, n_hidden)), np.zeros(n_hidden),
                  rng.normal(0, 0.3, n_hidden))
    labels = np.asarray(labels, float)
    if len(labels) == 0 or labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(labels) + 2)
        net.scale, net.shift = 0.0, float(np.log(share / (1 - share)))
        return net

    rows, owner = [], []
    for i, text in enumerate(texts):
        padded = text.ljust(CHUNK + WIDTH, b"\0")
        last = max(len(padded) - CHUNK - WIDTH, 0)
        n = min(chunks_per_text, 1 + last // HALF)
        # One start in each of n equal stretches.
        for at in ((np.arange(n) + rng.random(n)) / n * (last + 1)).astype(int):
            rows.append(np.frombuffer(padded, np.uint8, CHUNK + WIDTH, min(at, last)))
            owner.append(i)
    data, owner = np.stack(rows), np.array(owner)
    # A quarter of the chunks end early, as short texts do.
    ends = np.where(rng.random(len(data)) < 0.25, rng.integers(8, HALF, len(data)), CHUNK + WIDTH)
    data[np.arange(CHUNK + WIDTH) >= ends[:, None]] = 0
    y = labels[owner]
    weight = 1 / np.bincount(owner, minlength=len(texts))[owner]
    # Both classes weigh the same while fitting; the rescaling below restores
    # the classes' shares.
    share = np.bincount(y.astype(int), weight, 2)
    weight = weight / share[y.astype(int)]
    weight *= len(weight) / weight.sum()

    names = ["filters", "bias", "hidden", "hidden_bias", "out"]
    moment = {k: [np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))] for k in [*names]}
    moment["out_bias"] = [0.0, 0.0]
    starts = np.arange(0, CHUNK, STRIDE)
    size, step = 64, 0
    total_steps = epochs * -(-len(data) // size)
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), size):
            pick = order[at:at + size]
            batch = data[pick]
            response = np.zeros((len(pick), len(starts), n_filters))
            for k in range(WIDTH):
                response += net.filters[k][batch[:, starts + k]]
            where = response.argmax(axis=1)
            best = np.take_along_axis(response, where[:, None, :], 1)[:, 0, :] + net.bias
            pooled = np.maximum(best, 0)
            inner = pooled @ net.hidden + net.hidden_bias
            active = np.maximum(inner, 0)
            logit = active @ net.out + net.out_bias
            error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - y[pick]) * weight[pick] / len(pick)
            d_inner = np.outer(error, net.out) * (inner > 0)
            d_pooled = (d_inner @ net.hidden.T) * (best > 0)
            d_filters = np.zeros_like(net.filters)
            f = np.broadcast_to(np.arange(n_filters), where.shape)
            for k in range(WIDTH):
                seen = np.take_along_axis(batch, starts[where] + k, 1)
                np.add.at(d_filters[k], (seen, f), d_pooled)
            grads = {"filters": d_filters + 1e-5 * net.filters, "bias": d_pooled.sum(0),
                     "hidden": pooled.T @ d_inner + 1e-4 * net.hidden,
                     "hidden_bias": d_inner.sum(0), "out": active.T @ error + 1e-4 * net.out,
                     "out_bias": error.sum()}
            step += 1
            rate = 0.01 * (1 - 0.9 * step / total_steps)
            for name, g in grads.items():
                m = moment[name]
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                change = rate * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.999 ** step)) + 1e-8)
                setattr(net, name, getattr(net, name) - change)

    # Rescale mean logits to probabilities on the training documents.
    z = mean_logits(net, texts)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        target = np.where(labels > 0, 1 - 0.5 / (labels.sum() + 1), 0.5 / ((1 - labels).sum() + 1))
        v = p * (1 - p) + 1e-9
        grad = np.array([((p - target) * z).sum() + 1e-3 * a, (p - target).sum()])
        hess = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum() + 1e-6]])
        da, db = np.linalg.solve(hess, grad)
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -2, 2)
    net.scale, net.shift = float(a), float(b)
    return net


def held_out(doc_id) -> F.Column:
    """Rows that never train: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_per_class: int = 1000, max_bytes: int = 20_000) -> Network:
    """Train on at most ``max_per_class`` labelled rows of each class, chosen by
    a hash of their ids among texts of at most ``max_bytes`` bytes. Labels
    without an id are left out, of several labels of an id the lower counts;
    rows that repeat an id are rows of their own; null texts count as empty;
    longer texts are scored like all others but not trained on. Without rows of
    both classes, as in an empty table, the network answers the share of label
    1. Other columns are not read."""
    spark = docs.sparkSession
    rows = (labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL")
            .select("doc_id", F.col("quality").cast("int").alias("quality"))
            .filter(~held_out(F.col("doc_id"))))
    order = F.xxhash64(F.lit("quality"), "doc_id")
    # Three times as many as needed, as some texts are too long or missing.
    wanted = rows.withColumn("_o", order)
    few = [wanted.filter(F.col("quality") == c).orderBy("_o").limit(3 * max_per_class) for c in (0, 1)]
    sample = few[0].union(few[1]).groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.min("_o").alias("_o"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = (docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
             .filter(F.octet_length("text") <= max_bytes)
             .join(F.broadcast(sample), "doc_id"))
    found = cut(found, "quality_sample")
    got = [found.filter(F.col("quality") == c).orderBy("_o", "text").limit(max_per_class)
           .select("text", "quality").collect() for c in (0, 1)]
    both = [*got[0], *got[1]]
    return train([r["text"].encode() for r in both], np.array([r["quality"] for r in both]))


def quality_score(net: Network, text) -> F.Column:
    """The score of each text of a column, worked out in Arrow batches. Null
    counts as empty; texts of any length are scored as a whole."""
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = net.pair_tables()
        for batch in batches:
            scores = [net.probability(mean_logits(net, [(t or "").encode() for t in batch[at:at + 512]], tables))
                      for at in range(0, len(batch), 512)]
            yield pd.Series(np.concatenate(scores) if scores else np.empty(0))

    return F.pandas_udf(score, "double")(text)


def score_quality(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` of every row.

    Null texts are scored like empty ones; ids may be null or repeat, each row
    has its own score. An empty table gives no rows; other columns are ignored.
    """
    scored = docs.select(F.col(id_col).alias("doc_id"), quality_score(net, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
