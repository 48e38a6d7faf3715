"""Quality classifier: a byte-level convolutional network over whole documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripline.llm.common import text_of
from gripline.llm.labels import held_out, labelled, sample

#: Learned from at most so many labelled rows.
SAMPLE = 2500
#: Batches learned from, whatever the number of rows: a small sample is gone through more often.
STEPS = 480
#: Bytes are vectors of DIM numbers; a filter sees two steps of STEP bytes.
DIM = 8
STEP = 4
FILTERS = 24
HIDDEN = 16
#: Filter outputs are pooled in parts of PART steps; a chunk is CHUNK parts and the next one begins HOP parts later.
PART = 32
CHUNK = 4
HOP = 3
#: Chunks worked on at a time: longer documents are scored piece by piece.
PIECE = 256
SLICE_BYTES = 1 << 20
RATE = 0.003


def start(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    normal = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
    p = {
        "bytes": normal(256, DIM, scale=0.3), "w": normal(2, STEP * DIM, FILTERS, scale=0.2), "b": np.zeros(FILTERS, np.float32),
        "v": normal(2 * FILTERS, HIDDEN, scale=0.2), "c": np.zeros(HIDDEN, np.float32), "u": normal(2 * HIDDEN, scale=0.2), "d": np.zeros(1, np.float32),
    }
    p["bytes"][0] = 0
    return p


def pieces(text: bytes, most: int = PIECE) -> Iterator[tuple[bytes, int]]:
    """Bytes and number of chunks of each piece; pieces overlap as chunks do, so all chunks of the document occur once."""
    part = PART * STEP
    parts = max(1, -(-(len(text)) // part))
    chunks = 1 if parts <= CHUNK else 1 + -(-(parts - CHUNK) // HOP)
    for k in range(0, chunks, most):
        n = min(most, chunks - k)
        a = k * HOP * part
        yield text[a : a + ((n - 1) * HOP + CHUNK) * part + STEP], n


def lay_out(texts: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all pieces, padded with zeros to whole parts; parts of each chunk; the first chunk of each piece."""
    part = PART * STEP
    rows, index, starts, at, chunk = [], [], [], 0, 0
    for text, n in texts:
        parts = max(1, -(-len(text) // part))
        buffer = np.zeros((parts + 1) * part, np.uint8)  # an empty part keeps pieces apart
        buffer[: len(text)] = np.frombuffer(text, np.uint8)
        rows.append(buffer)
        index.append(at + np.minimum(np.arange(n)[:, None] * HOP + np.arange(CHUNK)[None, :], parts - 1))
        starts.append(chunk)
        at, chunk = at + parts + 1, chunk + n
    return np.concatenate(rows), np.concatenate(index), np.array(starts)


def chunk_outputs(p: dict[str, np.ndarray], flat: np.ndarray, index: np.ndarray) -> dict[str, np.ndarray]:
    """Everything up to the hidden values of chunks."""
    x = p["bytes"][flat].reshape(-1, STEP * DIM)
    nxt = np.zeros_like(x)
    nxt[:-1] = x[1:]
    f = np.maximum(x @ p["w"][0] + nxt @ p["w"][1] + p["b"], 0).reshape(-1, PART, FILTERS)
    high, mean = f.max(axis=1), f.mean(axis=1)
    chunk = np.concatenate([high[index].max(axis=1), mean[index].mean(axis=1)], axis=1)
    return {"x": x, "next": nxt, "f": f, "high": high, "chunk": chunk, "h": np.maximum(chunk @ p["v"] + p["c"], 0)}


def gradients(p: dict[str, np.ndarray], flat: np.ndarray, index: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean log loss of one batch, a document a piece."""
    o = chunk_outputs(p, flat, index)
    h = o["h"]
    n = np.diff(np.append(starts, len(h)))
    doc = np.repeat(np.arange(len(starts)), n)
    top = np.maximum.reduceat(h, starts)
    mean = np.add.reduceat(h, starts) / n[:, None]
    z = np.concatenate([top, mean], axis=1)
    score = 1 / (1 + np.exp(-(z @ p["u"] + p["d"])))
    ds = (score - y) / len(y)
    dz = ds[:, None] * p["u"][None, :]
    best = h == top[doc]  # chunks that tie share the gradient
    dh = best / np.add.reduceat(best, starts, dtype=np.float32)[doc] * dz[doc, :HIDDEN] + (dz[:, HIDDEN:] / n[:, None])[doc]
    dh = dh * (h > 0)
    dchunk = dh @ p["v"].T
    held = o["high"][index]
    first = held.argmax(axis=1)
    dhigh = np.zeros_like(o["high"])
    np.add.at(dhigh, (np.take_along_axis(index, first, axis=1), np.arange(FILTERS)[None, :]), dchunk[:, :FILTERS])
    dmean = np.zeros_like(o["high"])
    np.add.at(dmean, index, np.repeat(dchunk[:, None, FILTERS:] / CHUNK, CHUNK, axis=1))
    df = np.broadcast_to(dmean[:, None, :] / PART, o["f"].shape).copy()
    at = o["f"].argmax(axis=1)
    s, k = np.indices(at.shape)
    df[s, at, k] += dhigh
    df = (df * (o["f"] > 0)).reshape(-1, FILTERS)
    dx = df @ p["w"][0].T
    dx[1:] += (df @ p["w"][1].T)[:-1]
    dx = dx.reshape(-1, DIM)
    dbytes = np.stack([np.bincount(flat, dx[:, i], 256) for i in range(DIM)], axis=1)
    dbytes[0] = 0
    return {"bytes": dbytes, "w": np.stack([o["x"].T @ df, o["next"].T @ df]), "b": df.sum(axis=0), "v": o["chunk"].T @ dh, "c": dh.sum(axis=0), "u": z.T @ ds, "d": ds.sum(keepdims=True)}


def fit(texts: list[str], y: list[int], steps: int = STEPS, batch: int = 32, seed: int = 7) -> dict[str, np.ndarray]:
    """Adam over whole documents in small batches; without rows of both classes the network answers their share."""
    p = start(seed)
    marks = np.array(y, np.float32)
    if len(set(y)) < 2:
        share = (marks.sum() + 1) / (len(y) + 2)
        p["u"][:] = 0
        p["d"][:] = np.log(share / (1 - share))
        return p
    r = np.random.default_rng(seed)
    # A document longer than a piece teaches by each of its pieces.
    rows = [(piece, m) for t, m in zip(texts, marks, strict=True) for piece in pieces(t.encode())]
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    step, total = 0, steps
    while step < total:
        order = r.permutation(len(rows))
        for a in range(0, len(rows), batch):
            if step == total:
                break
            part = [rows[i] for i in order[a : a + batch]]
            flat, index, starts = lay_out([x[0] for x in part])
            g = gradients(p, flat, index, starts, np.array([x[1] for x in part], np.float32))
            step += 1
            rate = RATE * min(1, step / 50) * (1 - step / (total + 1))
            for k in p:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
                p[k] = (p[k] - rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return p


def scores(p: dict[str, np.ndarray], texts: list[bytes]) -> np.ndarray:
    """Probabilities of whole texts, in slices of bounded size."""
    top = np.zeros((len(texts), HIDDEN), np.float32)
    total, count = np.zeros((len(texts), HIDDEN)), np.zeros(len(texts))
    held, owner, size = [], [], 0

    def work() -> None:
        flat, index, starts = lay_out(held)
        h = chunk_outputs(p, flat, index)["h"]
        n = np.diff(np.append(starts, len(h)))
        np.maximum.at(top, owner, np.maximum.reduceat(h, starts))
        np.add.at(total, owner, np.add.reduceat(h, starts))
        np.add.at(count, owner, n)

    for i, text in enumerate(texts):
        for piece in pieces(text):
            held.append(piece)
            owner.append(i)
            size += len(piece[0]) + 256
            if size > SLICE_BYTES:
                work()
                held, owner, size = [], [], 0
    if held:
        work()
    z = np.concatenate([top, total / count[:, None]], axis=1)
    return 1 / (1 + np.exp(-(z @ p["u"] + p["d"]).astype(np.float64)))


def _score(p: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([*batch.drop_columns(["text"]).columns, pa.array(scores(p, texts) if texts else np.zeros(0))], [*batch.drop_columns(["text"]).schema.names, "score"])

    return run


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, steps: int = STEPS) -> dict[str, np.ndarray]:
    """The network, learned from at most `rows` labelled documents outside the held-out third."""
    return fit(*sample(docs, labelled(docs, labels, "quality"), rows), steps=steps)


def score(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """Rows (doc_id, score): the probability that each row's whole text is good.

    Bytes are looked up as vectors, learned filters slide over them, chunks of pooled filter outputs overlap and cover the whole
    document, and the maximum and mean over all chunks give one probability. A null text is scored as the empty one, which is
    one chunk of padding. Each row has one score, also a repeated one or one without doc_id. An empty table gives an empty one.
    Other columns are not used.
    """
    return docs.select(docs["doc_id"], text_of(docs).alias("text")).mapInArrow(_score(model), "doc_id long, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = score(docs, train(docs, labels))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of docs whose score is `least` or more."""
    model = train(docs, labels)
    columns = [docs[c] for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("doc"), text_of(docs).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(_score(model), f"doc {kind}, score double").where(F.col("score") >= least).select("doc.*")
