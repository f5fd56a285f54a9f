"""A quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkernel import U, Words, list_array, pieces

#: Buckets for hashed words, structure features, and rank of the interactions.
BUCKETS, RANK = 4096, 8
#: Labelled rows that a fit takes at most, those whose hashes come first. Scoring covers every row.
FIT_ROWS = 20_000
STATS = 14
DIMS = BUCKETS + 2 * STATS


def statistics(w: Words) -> np.ndarray:
    """STATS numbers a text, about 0 to 1 each: length, kinds of characters, lines, repetition. The last is what the table says of the length."""
    raw, n = w.raw, len(w.lo)
    kinds = np.zeros((256, 6), dtype=np.int32)
    kinds[48:58, 0] = 1
    kinds[65:91, 1] = 1
    kinds[[ord(c) for c in "#*$%&|<>"], 2] = 1
    kinds[[ord(c) for c in "!?.,;:"], 3] = 1
    kinds[10, 4] = 1
    kinds[[9, 11, 12, 13, 32], 5] = 1
    table = kinds.T.copy()
    bounds = np.concatenate([w.first, [len(raw) + 1]])
    sizes = np.diff(bounds) - 1
    out = np.zeros((n, STATS))
    size = np.maximum(sizes, 1)
    for j in range(6):
        total = np.concatenate([[0], np.cumsum(table[j][raw], dtype=np.int64)])
        out[:, j] = (total[bounds[:-1] + sizes] - total[bounds[:-1]]) / size
    words = w.hi - w.lo
    many = np.maximum(words, 1)
    out[:, 6] = np.log1p(words) / 10
    out[:, 7] = np.log1p(sizes) / 12
    out[:, 8] = np.minimum(size / many, 20) / 20
    h, two = w.hash, w.grams(2)
    for i, (lo, hi) in enumerate(zip(w.lo.tolist(), w.hi.tolist(), strict=True)):
        if hi > lo:
            out[i, 9] = len(np.unique(h[lo:hi])) / (hi - lo)
        if hi - lo > 1:
            out[i, 10] = len(np.unique(two[lo : hi - 1])) / (hi - lo - 1)
    out[:, 11] = words < 20
    out[:, 12] = words < 60
    return out


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def features(texts: list[bytes], lengths: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse hashed words as (row ends, buckets, values), each row of length 1, and the statistics."""
    with np.errstate(over="ignore"):
        w = Words(texts, lower=False)
        stats = statistics(w)
        stats[:, 13] = [np.log1p(max(x or 0, 0)) / 12 for x in lengths]
        bucket = (w.hash >> U(40)).astype(np.int64) % BUCKETS
    row = np.repeat(np.arange(len(texts), dtype=np.int64), w.hi - w.lo)
    cell, count = np.unique(row * BUCKETS + bucket, return_counts=True)
    value = np.log1p(count)
    row = cell // BUCKETS
    norm = np.sqrt(np.bincount(row, value**2, minlength=len(texts)))
    value = value / norm[row]
    ends = np.cumsum(np.bincount(row, minlength=len(texts)))
    return ends, (cell % BUCKETS).astype(np.int32), value.astype(np.float32), stats


def dense(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised statistics and how far each is from the mean."""
    z = np.clip((stats - mean) / scale, -4, 4) / 2
    return np.hstack([z, np.abs(z)]).astype(np.float32)


def score(model: Model, ends: np.ndarray, buckets: np.ndarray, values: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """Logits in time linear in the features: of each factor, half of the squared sum less the sum of squares."""
    d = dense(stats, model.mean, model.scale)
    n = len(ends)
    row = np.repeat(np.arange(n), np.diff(np.concatenate([[0], ends])))
    wd, vd = model.weights[BUCKETS:], model.factors[BUCKETS:]
    out = model.bias + d @ wd + np.bincount(row, values * model.weights[buckets], minlength=n)
    for f in range(model.factors.shape[1]):
        x = values * model.factors[buckets, f]
        sums = np.bincount(row, x, minlength=n) + d @ vd[:, f]
        squares = np.bincount(row, x * x, minlength=n) + (d * d) @ (vd[:, f] ** 2)
        out += 0.5 * (sums * sums - squares)
    return out


def concatenated(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The features of several runs of texts as those of one."""
    sizes = np.concatenate([np.diff(np.concatenate([[0], p[0]])) for p in parts])
    return (np.cumsum(sizes), *(np.concatenate([p[i] for p in parts]) for i in (1, 2, 3)))


def fit(found: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None, y: np.ndarray, epochs: int = 6, rate: float = 0.02, decay: float = 1e-4, batch: int = 256, seed: int = 1) -> Model:
    """Fits features(), with labels ``y``, by Adam on the logistic loss. Without rows, or with one label alone, the score is the labels' share, smoothed."""
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    if not len(y) or y.min() == y.max():
        return Model(bias, np.zeros(DIMS), np.zeros((DIMS, RANK)), np.zeros(STATS), np.ones(STATS))
    ends, buckets, values, stats = found
    begins = np.concatenate([[0], ends])
    mean, scale = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-3)
    d = dense(stats, mean, scale)
    w, v = np.zeros(DIMS, dtype=np.float32), rng.normal(0, 0.05, (DIMS, RANK)).astype(np.float32)
    params = [np.array([bias], dtype=np.float32), w, v]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        lr = rate * (1 - epoch / epochs)
        for at in range(0, len(y), batch):
            idx = order[at : at + batch]
            x = np.zeros((len(idx), DIMS), dtype=np.float32)
            for i, r in enumerate(idx):
                x[i, buckets[begins[r] : begins[r + 1]]] = values[begins[r] : begins[r + 1]]
            x[:, BUCKETS:] = d[idx]
            b, w, v = params
            xv, x2 = x @ v, x * x
            z = b[0] + x @ w + 0.5 * (xv**2 - x2 @ (v**2)).sum(axis=1)
            g = ((1 / (1 + np.exp(-np.clip(z, -30, 30)))) - y[idx]).astype(np.float32) / len(idx)
            grads = [np.array([g.sum()]), x.T @ g + decay * w, x.T @ (g[:, None] * xv) - (x2.T @ g)[:, None] * v + decay * v]
            step += 1
            for p, m, s, gr in zip(params, first, second, grads, strict=True):
                m += 0.1 * (gr - m)
                s += 0.001 * (gr * gr - s)
                p -= lr * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-7)
    b, w, v = params
    return Model(float(b[0]), w.astype(np.float64), v.astype(np.float64), mean, scale)


def flattened(m: Model) -> list[float]:
    return np.concatenate([[m.bias], m.weights, m.factors.ravel(), m.mean, m.scale]).tolist()


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", cut: float = 0.3, rows: int = FIT_ROWS) -> DataFrame:
    """Scores every row of ``docs(doc_id, text, n_chars)``: doc_id, held_out, score, predicted.

    The model is fitted on at most ``rows`` labelled documents, those first by a hash of
    doc_id among the ones not held out, and of a repeated doc_id one row; it sees words,
    structure and n_chars, never doc_id, lang or source. A doc_id with several labels
    counts with their mean, rounded.
    The model (some hundred KB, of fixed size) goes to the workers, which score whole
    texts in runs of bounded size.

    A null or empty text is scored by its statistics; a null n_chars, or none, is 0. A
    null doc_id is never held out and never fitted on. Repeated rows score alike; an
    empty table gives no rows, and without labels every score is one half. Other
    columns are ignored.
    """
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), chars.alias("n_chars"))
    marks = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.round(F.avg(label)).cast("int").alias("y"))
    # only labelled rows are looked up, so the documents are not shuffled: they are probed with the labels' ids
    chosen = marks.filter(~held_out(F.col("doc_id")))
    ids = base.select("doc_id").join(chosen, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    known = base.join(F.broadcast(ids), "doc_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).to_pylist()
            for at, texts in pieces(batch):
                ends, buckets, values, stats = features(texts, lengths[at : at + len(texts)])
                sizes = np.diff(np.concatenate([[0], ends]))
                mine = [batch.column(i).slice(at, len(texts)) for i in (0, 3)]
                rank = pa.array([zlib.crc32(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*mine, rank, list_array(buckets.astype(np.int16), sizes, pa.int16()), list_array(values, sizes, pa.float32()), list_array(stats.ravel(), np.full(len(texts), STATS), pa.float64())], names=["doc_id", "y", "rank", "buckets", "values", "stats"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, y = [], []
        for batch in batches:
            cells, stats = batch.column(0), batch.column(2).flatten().to_numpy().reshape(-1, STATS)
            parts.append((np.cumsum(cells.value_lengths().to_numpy()), cells.flatten().to_numpy().astype(np.int32), batch.column(1).flatten().to_numpy(), stats))
            y.append(batch.column(3).to_numpy())
        m = fit(concatenated(parts) if parts else None, np.concatenate([*y, np.zeros(0)]).astype(np.float64))
        yield pa.RecordBatch.from_arrays([pa.array([flattened(m)], pa.list_(pa.float64()))], names=["model"])

    # features are made where the texts are; one task fits on those of the bounded sample, at most BUCKETS cells a row
    made = known.select("doc_id", "text", "n_chars", "y").mapInArrow(extract, "doc_id long, y int, rank long, buckets array<short>, values array<float>, stats array<double>")
    once = made.groupBy("doc_id").agg(F.min(F.struct("rank", "buckets", "values", "stats", "y")).alias("f"))
    sample = once.repartition(1).sortWithinPartitions("doc_id").select("f.buckets", "f.values", "f.stats", "f.y")
    learned = sample.mapInArrow(learn, "model array<double>").first()
    # without labelled rows there may be no task
    flat = np.array(learned[0] if learned else flattened(fit(None, np.zeros(0))))
    cuts = np.cumsum([1, DIMS, DIMS * RANK, STATS])
    bias, weights, factors, mean, scale = np.split(flat, cuts)
    model = docs.sparkSession.sparkContext.broadcast(Model(float(bias[0]), weights, factors.reshape(DIMS, RANK), mean, scale))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).to_pylist()
            for at, texts in pieces(batch):
                logit = score(model.value, *features(texts, lengths[at : at + len(texts)]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(1 / (1 + np.exp(-np.clip(logit, -30, 30))))], names=["doc_id", "score"])

    scored = base.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
