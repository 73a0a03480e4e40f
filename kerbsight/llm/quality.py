"""Quality classifier: a small convolutional network over bytes, in numpy.

Each text is read whole, as overlapping chunks of ``chunk`` bytes that start every ``stride`` bytes. A byte has a learned
vector, and another where the eight bytes from it on also start within the ``REACH`` bytes before it, as filters are sums
and can't compare bytes themselves. Learned filters see all vectors of one chunk; each filter's largest response over the
text, and its mean one, are combined into one probability. Training runs on a sample of labelled rows whose bound is a parameter; scoring runs
in Arrow batches and needs memory for one piece of text, however long the text is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from kerbsight.llm import bytescan
from kerbsight.llm.runtime import crc_bucket, lean
from kerbsight.llm.suffix_dedup import words_at

#: Bytes of text that are scored at once; a longer text is scored in parts and its pools are merged.
PIECE = 1 << 18
#: Means over a text are taken with this many chunks more, at the bias, so that short texts don't swing.
PRIOR = 4.0


#: How far back a repetition is looked for.
REACH = 32
PADDING, SYMBOLS = 512, 513


@dataclass
class Network:
    """Weights: vectors of symbols (SYMBOLS x d), filters (chunk*d x f), their biases, output weights, bias."""

    vectors: np.ndarray
    filters: np.ndarray
    biases: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    chunk: int
    stride: int

    def names(self) -> list[str]:
        return ["vectors", "filters", "biases", "output", "bias"]


def new_network(chunk: int = 16, stride: int = 8, width: int = 6, filters: int = 24, seed: int = 7) -> Network:
    r = np.random.default_rng(seed)
    f = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
    return Network(f(SYMBOLS, width, scale=0.5), f(chunk * width, filters, scale=1 / np.sqrt(chunk * width)), np.zeros(filters, np.float32), f(2 * filters, scale=0.1), np.zeros(1, np.float32), chunk, stride)


def symbols(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte's value, and 256 more where the eight bytes from it on repeat within their row."""
    n = len(data)
    out = data.astype(np.int16)
    if n < 10:
        return out
    w = ((words_at(data) * np.uint64(bytescan.BASE)) >> np.uint64(32)).astype(np.uint32)[: n - 7]
    place = (np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))).astype(np.int32)
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n) >= 8
    seen = np.zeros(n - 7, bool)
    for k in range(1, min(REACH, n - 8) + 1):
        seen[k:] |= (w[k:] == w[:-k]) & (place[k : n - 7] >= k)
    out[: n - 7][seen & room[: n - 7]] += 256
    return out


def chunk_bytes(data: np.ndarray, offsets: np.ndarray, chunk: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of all rows (symbols, PADDING past a row's end), and each row's first chunk (n + 1 values).

    Every byte is in a chunk; an empty row has one chunk of padding.
    """
    size = np.diff(offsets)
    per_row = np.maximum(1, -(-np.maximum(size - chunk, 0) // stride) + 1)
    first = np.concatenate([[0], np.cumsum(per_row)])
    row = np.repeat(np.arange(len(size)), per_row)
    at = offsets[row] + (np.arange(first[-1]) - first[row]) * stride
    index = at[:, None] + np.arange(chunk)
    values = np.concatenate([data, np.zeros(chunk, np.int16)])[np.minimum(index, len(data) + chunk - 1)]
    values[index >= offsets[row + 1][:, None]] = PADDING
    return values, first


def responses(net: Network, values: np.ndarray) -> np.ndarray:
    x = net.vectors[values].reshape(len(values), -1) @ net.filters + net.biases
    return np.tanh(x, out=x)


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maxima and sums of the filters' responses for each row, and its number of chunks."""
    values, first = chunk_bytes(data, offsets, net.chunk, net.stride)
    r = responses(net, values)
    return np.maximum.reduceat(r, first[:-1]), np.add.reduceat(r, first[:-1]), np.diff(first)


def probability(net: Network, top: np.ndarray, total: np.ndarray, count: np.ndarray) -> np.ndarray:
    z = np.concatenate([top, total / (count + PRIOR)[:, None]], axis=1).astype(np.float32) @ net.output + net.bias
    return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))


def scores(net: Network, column: pa.Array) -> np.ndarray:
    """One probability for each text; null texts are scored as empty ones."""
    data, offsets = bytescan.flat(column)
    out = np.empty(len(offsets) - 1)
    for i, j, d, o in bytescan.pieces(data, offsets, PIECE):
        d = symbols(d, o)
        if j - i > 1 or len(d) <= 2 * PIECE:
            out[i:j] = probability(net, *pooled(net, d, o))
            continue
        top, total, count = None, 0, 0
        for a in range(0, len(d) - net.chunk + net.stride, PIECE):
            part = d[a : a + PIECE + net.chunk - net.stride]
            t, s, c = pooled(net, part, np.array([0, len(part)]))
            top, total, count = t if top is None else np.maximum(top, t), total + s, count + c
        out[i:j] = probability(net, top, total, count)
    return out


def train(texts: list[bytes], labels: np.ndarray, net: Network, epochs: int = 12, batch_bytes: int = 1 << 16, rate: float = 4e-3, seed: int = 11) -> Network:
    """Fits the network by gradient descent with Adam on the log loss; classes weigh the same."""
    r = np.random.default_rng(seed)
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6))
    params = {k: getattr(net, k) for k in net.names()}
    m, v, step = {k: np.zeros_like(x) for k, x in params.items()}, {k: np.zeros_like(x) for k, x in params.items()}, 0
    size = np.array([len(t) for t in texts])
    for epoch in range(epochs):
        order = r.permutation(len(texts))
        cuts = np.searchsorted(np.cumsum(size[order]), np.arange(batch_bytes, size.sum() + batch_bytes, batch_bytes))
        for rows in np.split(order, np.unique(np.minimum(cuts + 1, len(order)))):
            if not len(rows):
                continue
            grads = _gradients(net, [texts[k] for k in rows], labels[rows], weight[rows])
            step += 1
            lr = rate * (1 - epoch / epochs) + 1e-4
            for k, x in params.items():
                m[k] += 0.1 * (grads[k] - m[k])
                v[k] += 0.001 * (grads[k] ** 2 - v[k])
                x -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: Network, texts: list[bytes], labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    data = symbols(np.frombuffer(b"".join(texts), np.uint8), offsets)
    if len(texts) == 1 and len(data) > 2 * PIECE:
        parts = [(data[a : a + PIECE + net.chunk - net.stride], None) for a in range(0, len(data) - net.chunk + net.stride, PIECE)]
        pools = [pooled(net, d, np.array([0, len(d)])) for d, _ in parts]
        top, total, count = np.maximum.reduce([t for t, _, _ in pools]), sum(t for _, t, _ in pools), sum(c for _, _, c in pools)
    else:
        parts = [(data, offsets)]
        top, total, count = pooled(net, data, offsets)
    dz = ((probability(net, top, total, count) - labels) * weight / weight.sum()).astype(np.float32)
    pools_of = np.concatenate([top, total / (count + PRIOR)[:, None]], axis=1).astype(np.float32)
    n, decay = top.shape[1], np.float32(1e-5)
    out = {"vectors": np.zeros_like(net.vectors), "filters": decay * net.filters, "biases": np.zeros_like(net.biases), "output": pools_of.T @ dz + decay * net.output, "bias": dz.sum(keepdims=True)}
    taken = np.zeros((len(texts), n), bool)  # a maximum pulls on the first chunk that reaches it
    for d, o in parts:
        values, first = chunk_bytes(d, o if o is not None else np.array([0, len(d)]), net.chunk, net.stride)
        x = net.vectors[values].reshape(len(values), -1)
        r = np.tanh(x @ net.filters + net.biases)
        row = np.repeat(np.arange(len(texts)), np.diff(first))
        best = (r == top[row]) & ~taken[row]
        best &= np.cumsum(best, axis=0) == (np.concatenate([np.zeros((1, n), np.int64), np.cumsum(best, axis=0)])[first[:-1]] + 1)[row]
        taken |= np.logical_or.reduceat(best, first[:-1])
        dr = best * (dz[:, None] * net.output[:n])[row] + (dz[:, None] * net.output[n:] / (count + PRIOR)[:, None])[row].astype(np.float32)
        dr = (dr * (1 - r * r)).astype(np.float32)
        dx, flat = (dr @ net.filters.T).reshape(-1, net.vectors.shape[1]), values.ravel()
        out["vectors"] += np.stack([np.bincount(flat, dx[:, k], SYMBOLS) for k in range(dx.shape[1])], axis=1).astype(np.float32)
        out["filters"] = out["filters"] + x.T @ dr
        out["biases"] += dr.sum(axis=0)
    return out


def sample_of(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, rows: int) -> list:
    """``(id, text, label)`` of at most ``rows`` labelled documents outside the held-out fifth, those with the least hash of their id.

    Their texts come whole; that their number is bounded is what bounds the sample.
    """
    known = labels.where(F.col(label).isin(0, 1) & (crc_bucket(id_col) != 0)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label).cast("int").alias("_y"))
    chosen = known.orderBy(F.xxhash64("_id", F.lit(3)), "_id").limit(rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    first = texts.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.min("_text").alias("_text"), F.first("_y").alias("_y"))
    return first.collect()


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = 1500) -> Network:
    """Trains on the whole texts of at most ``rows`` labelled documents. Without any the network stays as drawn, with an output of one half.

    Of rows that repeat an id the least text is learned; null texts are empty ones; labels other than 0 and 1 don't count.
    """
    sample = sorted(sample_of(docs, labels, label, id_col, text_col, rows), key=lambda r: r[0])
    net = new_network()
    if not sample:
        net.output[:] = 0
        return net
    return train([r["_text"].encode() for r in sample], np.array([r["_y"] for r in sample], np.float64), net)


def score_quality(docs: DataFrame, net: Network, text_col: str = "text", score_col: str = "_score") -> DataFrame:
    """All columns of ``docs`` and ``score_col``, the probability of label 1, for each input row.

    Only the text's bytes are read. Null texts are scored as empty ones; repeated rows score alike; ``score_col`` takes the
    place of a column of that name, all others are passed through; an empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(net)
    rest = docs.select(*[c for c in docs.columns if c.lower() != score_col.lower()])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores(model.value, b.column(text_col)))], names=[*b.schema.names, score_col])

    return rest.mapInArrow(lean(apply), StructType([*rest.schema.fields]).add(score_col, DoubleType()))
