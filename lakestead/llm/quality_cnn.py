"""Quality classifier: a byte-level convolutional network in numpy.

A document is its UTF-8 bytes. Each byte has a learned vector; learned filters see ``width`` bytes and move
on by ``stride``, over the whole document. The rectified responses are max-pooled over chunks of ``chunk`` bytes,
each overlapping the next by half. Largest, mean and smallest response of each filter over all chunks,
and the logarithm of the length, go through one hidden layer to a logit. The probability is its sigmoid.

Training takes at most ``sample`` labelled documents (chosen by a hash of the id), whole texts, in one
task, with Adam and fixed seeds; a retry learns the same weights. The weights, some tens of kilobytes,
are broadcast. Scoring is one pass without a shuffle, in blocks of about ``block`` bytes, also within a document.

Defined cases: a null or empty text is a document of no bytes with a score like any other. Without labels
of both kinds the score is the share of label 1 (0.5 without labels). Rows with a null label or id are
not learned from; of an id with several labels each is learned. Repeated rows get equal scores up to rounding. Extra columns are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestead.llm.arrays import pieces, text_buffer
from lakestead.llm.common import written


@dataclass(frozen=True)
class Network:
    depth: int = 8
    filters: int = 16
    width: int = 16
    stride: int = 4
    chunk: int = 256
    hidden: int = 16
    sample: int = 2500
    epochs: int = 6
    batch: int = 32
    rate: float = 0.004
    seed: int = 11
    block: int = 1 << 20

    @property
    def half(self) -> int:
        return self.chunk // 2


def lay_out(data: np.ndarray, offsets: np.ndarray, net: Network) -> tuple[np.ndarray, np.ndarray]:
    """The documents' bytes, each followed by zeros up to whole half chunks and at least one filter width;
    and where each document's half chunks begin (and the last ones end). Two half chunks at least."""
    lengths = np.diff(offsets)
    halves = np.maximum(-(-(lengths + net.width) // net.half), 2)
    begins = np.concatenate([[0], np.cumsum(halves)])
    out = np.zeros(int(begins[-1]) * net.half, np.uint8)
    for place, start, n in zip(begins[:-1] * net.half, offsets[:-1] - offsets[0], lengths, strict=True):
        out[place : place + n] = data[start : start + n]
    return out, begins


def start_weights(net: Network) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(net.seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (draw.standard_normal(shape) * scale).astype(np.float32)

    seen, pooled = net.width * net.depth, 3 * net.filters + 1
    return {
        "bytes": normal(256, net.depth, scale=0.5),
        "filters": normal(seen, net.filters, scale=(2 / seen) ** 0.5),
        "filter_bias": np.zeros(net.filters, np.float32),
        "hidden": normal(pooled, net.hidden, scale=(2 / pooled) ** 0.5),
        "hidden_bias": np.zeros(net.hidden, np.float32),
        "out": normal(net.hidden, scale=net.hidden**-0.5),
        "out_bias": np.zeros(1, np.float32),
    }


def _responses(w: dict, laid: np.ndarray, ends: np.ndarray, net: Network) -> np.ndarray:
    """Rectified filter responses, (half chunk, place, filter); places that reach beyond a document, which ends before
    one of the half chunks ``ends``, are 0."""
    group = net.stride * net.depth
    x = w["bytes"][laid].reshape(-1, group)
    steps = net.width // net.stride
    out = np.tile(w["filter_bias"], (len(x), 1))
    for s in range(steps):
        out[: len(x) - s] += x[s:] @ w["filters"][s * group : (s + 1) * group]
    np.maximum(out, 0, out=out)
    per_half = net.half // net.stride
    for s in range(1, steps):
        out[ends * per_half - s] = 0
    return out.reshape(-1, per_half, net.filters)


def _pool(top: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: largest, mean and smallest chunk response, and length; the chunks and where they begin."""
    inner = np.ones(len(top), bool)
    inner[begins[1:] - 1] = False  # the last half chunk of a document starts no chunk
    first = np.flatnonzero(inner)
    chunks = np.maximum(top[first], top[first + 1])
    starts = begins[:-1] - np.arange(len(begins) - 1)
    counts = np.diff(begins) - 1
    pooled = np.concatenate(
        [
            np.maximum.reduceat(chunks, starts),
            np.add.reduceat(chunks, starts) / counts[:, None].astype(np.float32),
            np.minimum.reduceat(chunks, starts),
            (np.log1p(lengths)[:, None] / 5 - 1).astype(np.float32),
        ],
        axis=1,
    )
    return pooled, chunks, starts


def _head(w: dict, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.maximum(pooled @ w["hidden"] + w["hidden_bias"], 0)
    return hidden, 1 / (1 + np.exp(-np.clip(hidden @ w["out"] + w["out_bias"], -30, 30)))


def _tops(w: dict, laid: np.ndarray, begins: np.ndarray, net: Network) -> np.ndarray:
    """Largest response per half chunk and filter. A block of half chunks at a time, with the one behind it, into which
    filters reach; so the memory of a long document is a few bytes per byte."""
    top = np.empty((int(begins[-1]), net.filters), np.float32)
    step = max(net.block // net.half, 1)
    for a in range(0, len(top), step):
        b = min(a + step, len(top))
        seen = min(b + 1, len(top))
        ends = begins[(begins > a) & (begins <= seen)] - a
        found = _responses(w, laid[a * net.half : seen * net.half], ends, net)
        top[a:b] = found[: b - a].max(axis=1)
    return top


def probabilities(w: dict, texts: pa.Array, net: Network) -> np.ndarray:
    data, offsets = text_buffer(texts)
    laid, begins = lay_out(data, offsets, net)
    return _head(w, _pool(_tops(w, laid, begins, net), begins, np.diff(offsets))[0])[1].astype(np.float64)


def _gradients(w: dict, laid: np.ndarray, begins: np.ndarray, lengths: np.ndarray, y: np.ndarray, net: Network) -> dict:
    responses = _responses(w, laid, begins[1:], net)
    place = responses.argmax(axis=1)
    top = np.take_along_axis(responses, place[:, None, :], axis=1)[:, 0]
    pooled, chunks, starts = _pool(top, begins, lengths)
    hidden, p = _head(w, pooled)
    f, docs = net.filters, len(y)
    d_out = ((p - y) / docs).astype(np.float32)
    d_hidden = np.outer(d_out, w["out"]) * (hidden > 0)
    d_pooled = d_hidden @ w["hidden"].T
    # Back through the pooling over chunks.
    counts = np.diff(begins) - 1
    of = np.repeat(np.arange(docs), counts)
    d_chunks = d_pooled[of, f : 2 * f] / counts[of][:, None]
    for at, values in ((0, pooled[:, :f]), (2 * f, pooled[:, 2 * f : 3 * f])):
        hit = chunks == values[of]
        share = np.add.reduceat(hit, starts, axis=0, dtype=np.float32)
        d_chunks += d_pooled[of, at : at + f] * hit / share[of]
    # Back to the half chunk, and in it to the place, that gave the maximum.
    inner = np.ones(len(top), bool)
    inner[begins[1:] - 1] = False
    first = np.flatnonzero(inner)
    left = top[first] >= top[first + 1]
    d_top = np.zeros_like(top)
    d_top[first] += d_chunks * left
    d_top[first + 1] += d_chunks * ~left
    d_top *= top > 0
    half, filt = np.nonzero(d_top)
    per_half = net.half // net.stride
    at = (half * per_half + place[half, filt]) * net.stride
    seen = laid[at[:, None] + np.arange(net.width)]
    x = w["bytes"][seen].reshape(len(at), -1)
    slope = d_top[half, filt][:, None]
    d_filters = np.zeros_like(w["filters"])
    d_x = slope * w["filters"].T[filt]
    for k in range(f):
        mine = filt == k
        d_filters[:, k] = (slope[mine] * x[mine]).sum(axis=0)
    d_bytes = np.zeros_like(w["bytes"])
    np.add.at(d_bytes, seen.ravel(), d_x.reshape(-1, net.depth))
    return {
        "bytes": d_bytes,
        "filters": d_filters,
        "filter_bias": d_top.sum(axis=0),
        "hidden": pooled.T @ d_hidden,
        "hidden_bias": d_hidden.sum(axis=0),
        "out": hidden.T @ d_out,
        "out_bias": d_out.sum(keepdims=True),
    }


def train(texts: list[str | None], labels: np.ndarray, net: Network) -> dict[str, np.ndarray]:
    w = start_weights(net)
    m, v = ({k: np.zeros_like(x) for k, x in w.items()} for _ in range(2))
    step = 0
    draw = np.random.default_rng(net.seed)
    share = np.clip(labels.mean(), 0.02, 0.98)
    w["out_bias"][:] = np.log(share / (1 - share))
    laid = []
    for text in texts:
        data, offsets = text_buffer(pa.array([text], pa.string()))
        laid.append((lay_out(data, offsets, net)[0], len(data)))
    total = net.epochs * -(-len(texts) // net.batch)
    for _ in range(net.epochs):
        order = draw.permutation(len(texts))
        for k in range(0, len(order), net.batch):
            some = order[k : k + net.batch]
            halves = [len(laid[i][0]) // net.half for i in some]
            begins = np.concatenate([[0], np.cumsum(halves)])
            joined = np.concatenate([laid[i][0] for i in some])
            grads = _gradients(w, joined, begins, np.array([laid[i][1] for i in some]), labels[some], net)
            step += 1
            rate = net.rate * (1 - 0.9 * step / total)
            for name, g in grads.items():
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.999 * v[name] + 0.001 * g * g
                w[name] -= (rate * (m[name] / (1 - 0.9**step)) / (np.sqrt(v[name] / (1 - 0.999**step)) + 1e-8)).astype(
                    np.float32
                )
    return w


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str, net: Network) -> dict | float:
    """Weights from docs joined with labels(id, label); a constant where there is nothing to tell apart.

    The sample of labels is bounded; it is made first, so only its texts move.
    """
    named = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
    named = named.filter("id is not null and y is not null").withColumn("h", F.xxhash64(F.lit("quality"), "id"))
    chosen = written(named.orderBy("h", "id", "y").limit(net.sample), "label_sample")
    slim = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    sample = written(slim.join(chosen, "id"), "training_sample")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        rows.sort(key=lambda r: (r["h"], r["id"], r["y"], r["text"] or ""))
        y = np.array([r["y"] for r in rows], np.float32)
        if not rows or y.min() == y.max():
            found = float(y.mean()) if rows else 0.5
        else:
            found = train([r["text"] for r in rows], y, net)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], names=["weights"])

    trained = sample.coalesce(1).mapInArrow(work, "weights binary").collect()
    return pickle.loads(trained[0]["weights"]) if trained else 0.5


def score(docs: DataFrame, model: dict | float, id_col: str, text: str, net: Network) -> DataFrame:
    """(id, score) per row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", net.block):
            w = shared.value
            found = np.full(len(batch), w) if isinstance(w, float) else probabilities(w, batch.column(1), net)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=["id", "score"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = dict(slim.dtypes)["id"]
    return slim.mapInArrow(work, f"id {kind}, score double").withColumnRenamed("id", id_col)


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    net: Network = Network(),  # noqa: B008
) -> DataFrame:
    """(id, score) per row of docs, learned from labels(id, label)."""
    return score(docs, learn(docs, labels, id_col, text, label, net), id_col, text, net)
