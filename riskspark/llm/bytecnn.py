"""Quality of a text by a byte-level convolutional network in numpy.

A text is cut into overlapping chunks of CHUNK bytes that cover it whole. In every chunk FILTERS learned filters
of WIDTH bytes slide byte by byte over the learned vectors of the bytes; a filter's largest response is the chunk's feature
(max pooling, after rectifying). Over the chunks of a document each feature's largest and mean value make one
probability through a logistic unit.

Training is stochastic gradient descent on a bounded sample: at most ROWS_PER_LABEL rows and BYTES_PER_LABEL bytes
of each label, those with the smallest hash of the id, and every chunk of their texts; texts of more than an eighth
of these bytes are not trained on. The intercept is then moved to the odds of all labelled rows. Labels are used as given; rows with another label than 0 or 1 are
left out. With one label only, or no row, the score of every text is the share of label 1 (0.5 without rows).

Scoring covers every chunk of every text; NULL counts as empty, and an empty text has one chunk of padding.
Repeated rows get equal scores. Further columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.text import bounded_sample, pieces, raw, utf8
from riskspark.session import materialise

CHUNK, OVERLAP, WIDTH, FILTERS, DIMS = 512, 64, 8, 16, 8
PAD = 256
#: The bound of the training sample.
ROWS_PER_LABEL, BYTES_PER_LABEL = 1200, 16 << 20
EPOCHS, BATCH, RATE = 10, 32, 4e-3
CHUNKS_AT_ONCE, TRAINED_AT_ONCE = 512, 128
#: Bytes scored at once, and chunks of a longer text that one step of scoring cuts out.
BYTES_AT_ONCE, CHUNKS_CUT = 2 << 20, 4096
POSITIONS = np.arange(0, CHUNK - WIDTH + 1)


@dataclass
class Net:
    """`byte` vectors, `filters` over WIDTH of them, biases, and the weights of the last unit."""

    byte: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    last: np.ndarray
    intercept: float

    def tables(self) -> np.ndarray:
        """What each byte at each place of a filter adds to it: place x byte x filter."""
        return np.einsum("bd,kdf->kbf", self.byte, self.filters.reshape(WIDTH, DIMS, FILTERS)).astype(np.float32)


def chunked(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All chunks of texts laid end to end, as rows of byte numbers, and how many chunks each text has."""
    size = np.diff(starts)
    n = np.maximum(1, -(-(size - OVERLAP) // (CHUNK - OVERLAP)))
    text = np.repeat(np.arange(len(n)), n)
    begin = starts[:-1][text] + (np.arange(len(text)) - (np.cumsum(n) - n)[text]) * (CHUNK - OVERLAP)
    at = begin[:, None] + np.arange(CHUNK)
    inside = at < starts[1:][text][:, None]
    return np.where(inside, flat[np.minimum(at, max(len(flat) - 1, 0))] if len(flat) else 0, PAD).astype(np.int16), n


def chunk_features(tables: np.ndarray, bias: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    out = np.empty((len(chunks), FILTERS), np.float32)
    for a in range(0, len(chunks), CHUNKS_AT_ONCE):
        rows = chunks[a : a + CHUNKS_AT_ONCE]
        total = tables[0][rows[:, POSITIONS]]
        for k in range(1, WIDTH):
            total += tables[k][rows[:, POSITIONS + k]]
        out[a : a + len(rows)] = np.maximum(total.max(axis=1) + bias, 0)
    return out


def document_features(features: np.ndarray, n: np.ndarray) -> np.ndarray:
    first = np.cumsum(n) - n
    return np.hstack([np.maximum.reduceat(features, first, axis=0), np.add.reduceat(features, first, axis=0) / n[:, None]])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _best(net: Net, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each filter responds most in each chunk, as an index of POSITIONS, and the response with the bias."""
    byte, filters = net.byte.astype(np.float32), net.filters.astype(np.float32)
    best, response = np.empty((len(chunks), FILTERS), np.int64), np.empty((len(chunks), FILTERS), np.float32)
    for a in range(0, len(chunks), TRAINED_AT_ONCE):
        rows = chunks[a : a + TRAINED_AT_ONCE]
        seen = np.lib.stride_tricks.sliding_window_view(byte[rows], WIDTH, axis=1)
        total = (seen.swapaxes(2, 3).reshape(-1, WIDTH * DIMS) @ filters).reshape(len(rows), len(POSITIONS), FILTERS)
        best[a : a + len(rows)] = at = total.argmax(axis=1)
        response[a : a + len(rows)] = np.take_along_axis(total, at[:, None], axis=1)[:, 0]
    return best, response + net.bias


def _step(net: Net, chunks: np.ndarray, n: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss of one batch, by parameter."""
    best, response = _best(net, chunks)
    h = np.maximum(response, 0)
    doc = document_features(h, n)
    gap = (sigmoid(doc @ net.last + net.intercept) - y) / len(y)
    to_doc = np.outer(gap, net.last)
    text = np.repeat(np.arange(len(n)), n)
    top = doc[:, :FILTERS][text] == h
    share = top / np.maximum(np.add.reduceat(top.astype(float), np.cumsum(n) - n, axis=0)[text], 1)
    to_h = (to_doc[:, :FILTERS][text] * share + to_doc[:, FILTERS:][text] / n[text][:, None]) * (response > 0)
    filters, byte = np.zeros_like(net.filters), np.zeros_like(net.byte)
    for a in range(0, len(chunks), TRAINED_AT_ONCE):
        own = slice(a, a + TRAINED_AT_ONCE)
        rows, g = chunks[own], to_h[own]
        window = rows[np.arange(len(rows))[:, None, None], POSITIONS[best[own]][:, :, None] + np.arange(WIDTH)]
        seen = net.byte[window].reshape(len(rows), FILTERS, WIDTH * DIMS)
        filters += np.einsum("cf,cfx->xf", g, seen)
        back = (g[:, :, None] * net.filters.T[None]).reshape(-1, DIMS)
        np.add.at(byte, window.reshape(-1), back)
    byte[PAD] = 0
    return [byte, filters, to_h.sum(axis=0), doc.T @ gap, gap.sum()]


def long_features(tables: np.ndarray, bias: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The features of one text, cut into chunks step by step: largest and mean over all of them."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(text) - OVERLAP) // step))
    largest, total = np.zeros(FILTERS, np.float32), np.zeros(FILTERS)
    for a in range(0, n, CHUNKS_CUT):
        b = min(a + CHUNKS_CUT, n)
        part = text[a * step : (b - 1) * step + CHUNK]
        own = chunk_features(tables, bias, chunked(part, np.array([0, len(part)]))[0])
        largest, total = np.maximum(largest, own.max(axis=0)), total + own.sum(axis=0, dtype=np.float64)
    return np.concatenate([largest, (total / n).astype(np.float32)])[None]


def fit(texts: list[np.ndarray], labels: np.ndarray, share: float, seed: int = 5) -> Net:
    """Train on the chunks of each text, given as bytes; `share` of all labelled rows have label 1."""
    rng = np.random.default_rng(seed)
    net = Net(rng.normal(0, 0.5, (PAD + 1, DIMS)), rng.normal(0, 0.18, (WIDTH * DIMS, FILTERS)), np.zeros(FILTERS), rng.normal(0, 0.2, 2 * FILTERS), 0.0)
    net.byte[PAD] = 0
    if not len(labels) or labels.min() == labels.max():
        net.last[:] = 0
        net.intercept = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        return net
    moments = [[np.zeros_like(np.asarray(p, float)) for p in (net.byte, net.filters, net.bias, net.last, net.intercept)] for _ in range(2)]
    t = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for own in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // BATCH)):
            t += 1
            # Chunks, many times the size of the bytes, are cut for one batch at a time.
            chunks, n = chunked(np.concatenate([texts[i] for i in own]), np.cumsum([0, *[len(texts[i]) for i in own]]))
            grads = _step(net, chunks, n, labels[own])
            moves = []
            for i, g in enumerate(grads):
                moments[0][i] = 0.9 * moments[0][i] + 0.1 * g
                moments[1][i] = 0.999 * moments[1][i] + 0.001 * np.square(g)
                moves.append(rate * (moments[0][i] / (1 - 0.9**t)) / (np.sqrt(moments[1][i] / (1 - 0.999**t)) + 1e-8))
            net.byte -= moves[0]
            net.filters -= moves[1]
            net.bias -= moves[2]
            net.last -= moves[3]
            net.intercept -= float(moves[4])
    sampled = labels.mean()
    net.intercept += float(np.log(share / (1 - share)) - np.log(sampled / (1 - sampled)))
    return net


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_label: int = ROWS_PER_LABEL,
          bytes_per_label: int = BYTES_PER_LABEL) -> Net:
    """Train on the documents that `labels` (rows of id and label) has; the driver gets a bounded sample."""
    rows = labels.select("id", F.col("label").cast("int").alias("group")).filter("group in (0, 1)")
    sizes = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("bytes"))
    rows = rows.join(sizes.groupBy("id").agg(F.max("bytes").alias("bytes")), "id")
    rows = materialise(rows, "labelled")
    counts = {r["group"]: r["count"] for r in rows.groupBy("group").count().collect()}
    total = sum(counts.values())

    chosen = bounded_sample(docs, rows, rows_per_label, id_col, text_col, bytes_per_label)
    got = chosen.select("group", "id", "text").orderBy("group", "id").toArrow()
    flat, starts = raw(utf8(got.column("text"))) if got.num_rows else (np.empty(0, np.uint8), np.zeros(1, np.int64))
    return fit(np.split(flat, starts[1:-1]) if got.num_rows else [], got.column("group").to_numpy().astype(float), counts.get(1, 0) / total if total else 0.5)


def score(text: Column, net: Net) -> Column:
    """The probability of label 1, 0 to 1."""
    tables, bias, last, intercept = net.tables(), net.bias.astype(np.float32), net.last, net.intercept

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = [np.empty(0)]
            for part in pieces(utf8(batch), BYTES_AT_ONCE):
                flat, starts = raw(part)
                if len(flat) > BYTES_AT_ONCE:  # one long text
                    features = long_features(tables, bias, flat)
                else:
                    chunks, n = chunked(flat, starts)
                    features = document_features(chunk_features(tables, bias, chunks), n)
                out.append(sigmoid(features.astype(np.float64) @ last + intercept))
            yield pa.array(np.concatenate(out))
    return run(text)
