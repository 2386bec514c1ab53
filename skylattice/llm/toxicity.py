"""Toxicity by a small convolutional text classifier, trained in numpy.

Words (lower-cased, without ASCII punctuation) are hashed to buckets; a bucket has an
embedding. Filters of several widths run over the embeddings, each filter's maximum
over the text is kept (max pooling), and a linear layer with a sigmoid gives the
score. It is calibrated on a part of the training rows that the network has not seen, so
that 0.7 is the best cut there. The score depends on the text alone. For decisions each language gets its own
threshold, calibrated on the same part.

Training takes a bounded sample: at most ``sample_rows`` labelled rows, half of each
class, picked by a hash of the id, and of these the texts of at most ``sample_words``
words. The sample is found in the labels first, so texts are not shuffled; the model
goes to the tasks as a broadcast whose size those two bounds fix. Scoring reads every
whole text and needs no shuffle either.

Defined results: null texts are empty; an empty text gets the score of a text in which
no filter fires. If the sample lacks one class there is nothing to learn and every text
gets the share of label 1 (0.5 without any label). Labels that are null, and label rows
without a document, are not used; of repeated label rows each counts. Repeated
documents give repeated rows. Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skylattice.llm.common import Words, text_pieces

SAMPLE_ROWS = 12_000
SAMPLE_WORDS = 1_500
HELD_OUT_FOLD = 1
FOLDS = 3

_BITS = 22
_DIM = 8
_FILTERS = 8
_WIDTHS = (1, 2, 3)
_EPOCHS = 6
_BATCH = 64
_RATE = 0.01
#: A bucket seen in fewer sample texts has no embedding of its own.
_LEAST_TEXTS = 3
#: In a large sample: in fewer than one text of so many.
_RARE = 700
_SEED = 20240611
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)).cast("int")


def _plain(text: str | None) -> bytes:
    return (text or "").lower().encode().translate(None, _PUNCTUATION)


def _buckets(words: Words) -> np.ndarray:
    return (words.digest >> np.uint64(64 - _BITS)).astype(np.int32)


@dataclass
class Model:
    """``table`` has one row per known bucket; row 0 stands for all others."""

    buckets: np.ndarray
    tables: list[np.ndarray] = field(default_factory=list)
    bias: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.float32))
    intercept: float = 0.0
    scale: float = 1.0
    shift: float = 0.0
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.7

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        if not len(self.buckets):
            return np.zeros(len(buckets), dtype=np.int64)
        place = np.minimum(np.searchsorted(self.buckets, buckets), len(self.buckets) - 1)
        return np.where(self.buckets[place] == buckets, place + 1, 0)

    def logits(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Network output of each text; ``rows`` are all texts' words in a row."""
        pooled = [np.maximum(_pool(rows, first, t) + b, 0) for t, b in
                  zip(self.tables, self.bias, strict=True)]
        return np.concatenate(pooled, axis=1) @ self.weights + self.intercept

    def scores(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        z = self.scale * self.logits(rows, first) + self.shift
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))

    def of_texts(self, texts: list[bytes]) -> np.ndarray:
        words = Words(texts)
        return self.scores(self.rows(_buckets(words)), words.first)


def _responses(rows: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Filter outputs at each start of a width-wide window; ``table`` is (width, rows, filters)."""
    width = len(table)
    out = table[0][rows]
    for j in range(1, width):
        out[: len(rows) - j] += table[j][rows[j:]]
    return out


def _pool(rows: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Maximum over the windows inside each text; texts that are too short have none."""
    width = len(table)
    out = np.full((len(first) - 1, table.shape[2]), -1e9, dtype=np.float32)
    long = np.diff(first) >= width
    if long.any():
        responses = _responses(rows, table)
        # A window that leaves its text must not win.
        for j in range(1, width):
            edge = first[1:] - j
            responses[edge[edge >= 0]] = -1e9
        out[long] = np.maximum.reduceat(responses, first[:-1][long], axis=0)
    return out


# --- training ---------------------------------------------------------------------


class _Adam:
    def __init__(self, shape):
        self.m, self.v, self.t = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0

    def step(self, value: np.ndarray, gradient: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (gradient - self.m)
        self.v += 0.001 * (gradient * gradient - self.v)
        m, v = self.m / (1 - 0.9**self.t), self.v / (1 - 0.999**self.t)
        value -= _RATE * m / (np.sqrt(v) + 1e-8)


def train(texts: list[np.ndarray], labels: np.ndarray, langs: list[str | None]) -> Model:
    """Fit on texts given as bucket arrays."""
    positive = int(labels.sum())
    if positive == 0 or positive == len(labels):
        share = 0.5 if not len(labels) else positive / len(labels)
        return Model(np.zeros(0, dtype=np.int32), constant=float(share))
    rng = np.random.default_rng(_SEED)
    seen = [np.unique(t) for t in texts]
    every, counts = np.unique(np.concatenate(seen), return_counts=True)
    least = max(min(_LEAST_TEXTS, max(1, len(texts) // 100)), len(texts) // _RARE)
    known = every[counts >= least]
    model = Model(known)
    rows = [model.rows(t) for t in texts]

    order = rng.permutation(len(texts))
    held = len(texts) // 5
    check, fit = order[:held], order[held:]

    embedding = rng.normal(0, 0.05, (len(known) + 1, _DIM)).astype(np.float32)
    # The first dimension starts at the word's log-odds, which spares many epochs.
    ones, zeros = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    for i in fit:
        (ones if labels[i] else zeros)[np.unique(rows[i])] += 1
    n1, n0 = labels[fit].sum(), (1 - labels[fit]).sum()
    odds = np.log((ones + 0.5) / (n1 + 1)) - np.log((zeros + 0.5) / (n0 + 1))
    embedding[:, 0] = np.clip(odds / 2, -2, 2)
    embedding[0] = 0
    kernels = [rng.normal(0, 0.1, (w, _DIM, _FILTERS)).astype(np.float32) for w in _WIDTHS]
    for kernel in kernels:
        kernel[:, 0, : _FILTERS // 2] = np.abs(kernel[:, 0, : _FILTERS // 2]) + 0.5 / len(kernel)
    bias = [np.full(_FILTERS, -0.2, np.float32) for _ in _WIDTHS]
    weights = np.full(_FILTERS * len(_WIDTHS), 0.1, np.float32)
    intercept = np.zeros(1, np.float32)
    slots = [*kernels, *bias, weights, intercept]
    steps = [_Adam(x.shape) for x in slots]
    embed_step = _Adam(embedding.shape)

    for _ in range(_EPOCHS):
        shuffled = rng.permutation(fit)
        for at in range(0, len(shuffled), _BATCH):
            chosen = [i for i in shuffled[at : at + _BATCH] if len(rows[i]) >= max(_WIDTHS)]
            if not chosen:
                continue
            first = np.concatenate([[0], np.cumsum([len(rows[i]) for i in chosen])])
            words = np.concatenate([rows[i] for i in chosen])
            vectors = embedding[words]
            pooled, places = [], []
            for kernel, b in zip(kernels, bias, strict=True):
                width = len(kernel)
                out = vectors @ kernel[0]
                for j in range(1, width):
                    out[:-j] += vectors[j:] @ kernel[j]
                    out[first[1:] - j] = -1e9
                best = np.stack(
                    [out[a:b].argmax(axis=0) + a for a, b in zip(first[:-1], first[1:], strict=True)]
                )
                places.append(best)
                pooled.append(np.take_along_axis(out, best, axis=0) + b)
            raw = np.concatenate(pooled, axis=1)
            active = np.maximum(raw, 0)
            z = active @ weights + intercept
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[chosen]) / len(chosen)
            back = (error[:, None] * weights) * (raw > 0)
            gradients = []
            embed_gradient = np.zeros_like(embedding)
            for n, (kernel, best) in enumerate(zip(kernels, places, strict=True)):
                g = back[:, n * _FILTERS : (n + 1) * _FILTERS]
                own = np.zeros_like(kernel)
                for j in range(len(kernel)):
                    at_words = words[best + j]
                    own[j] = np.einsum("bfd,bf->df", embedding[at_words], g)
                    np.add.at(
                        embed_gradient,
                        at_words.ravel(),
                        (g[:, :, None] * kernel[j].T[None]).reshape(-1, _DIM),
                    )
                gradients.append(own)
            embed_gradient[0] = 0
            gradients += [back[:, n * _FILTERS : (n + 1) * _FILTERS].sum(axis=0)
                          for n in range(len(kernels))]
            gradients += [active.T @ error, error.sum(keepdims=True)]
            for value, step, gradient in zip(slots, steps, gradients, strict=True):
                step.step(value, gradient.astype(np.float32))
            embed_step.step(embedding, embed_gradient)

    model.tables = [np.stack([embedding @ k for k in kernel]) for kernel in kernels]
    model.bias, model.weights, model.intercept = bias, weights, float(intercept[0])
    _calibrate(model, [rows[i] for i in check], labels[check], [langs[i] for i in check])
    return model


def _calibrate(model: Model, rows: list, labels: np.ndarray, langs: list) -> None:
    """Scale the output to probabilities, then pick each language's threshold."""
    if not len(labels) or labels.min() == labels.max():
        return
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    z = model.logits(np.concatenate(rows), first).astype(np.float64)
    # Targets off 0 and 1 keep the scale finite when the classes are apart.
    ones = labels.sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))

    def loss(a: float, b: float) -> float:
        x = a * z + b
        return float((np.logaddexp(0, x) - target * x).sum())

    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - target) * z).sum(), (p - target).sum()])
        h = np.array([[(w * z * z).sum() + 1e-6, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        step, size, before = np.linalg.solve(h, g), 1.0, loss(a, b)
        while size > 1e-6 and loss(a - size * step[0], b - size * step[1]) > before:
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
        if before - loss(a, b) < 1e-9:
            break
    model.scale = float(max(a, 1e-3))
    # The best cut of the two classes becomes a score of 0.7.
    cut = _best_cut(model.scale * z + b, labels)
    model.shift = float(np.log(0.7 / 0.3) - cut + b)
    score = 1 / (1 + np.exp(-np.clip(model.scale * z + model.shift, -40, 40)))
    model.threshold = _threshold(score, labels)
    for lang in {x for x in langs if x is not None}:
        own = np.array([x == lang for x in langs])
        if labels[own].sum() >= 20:
            model.thresholds[lang] = _threshold(score[own], labels[own])


def _best_cut(z: np.ndarray, labels: np.ndarray) -> float:
    """Between which two outputs a cut gives the best F1; of equal ones the widest gap."""
    order = np.argsort(z)
    z, labels = z[order], labels[order]
    above = labels.sum() - np.concatenate([[0], np.cumsum(labels)[:-1]])
    f1 = 2 * above / (np.arange(len(z), 0, -1) + labels.sum())
    gap = np.diff(np.concatenate([[z[0] - 1], z]))
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    at = best[gap[best].argmax()]
    return float(z[at] - gap[at] / 2)


def _threshold(score: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the range of thresholds with the best F1, within 0.3 and 0.9."""
    tried = np.arange(0.30, 0.901, 0.01)
    f1 = [
        2 * (labels[score >= t]).sum() / max(1, (score >= t).sum() + labels.sum()) for t in tried
    ]
    best = tried[np.asarray(f1) >= max(f1) - 1e-9]
    return float(best[len(best) // 2])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    sample_words: int = SAMPLE_WORDS,
) -> Model:
    """Train on labelled documents outside the held-out fold."""
    own = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("y")
    ).filter((fold(F.col("doc_id")) != HELD_OUT_FOLD) & F.col("y").isin(0, 1))
    halves = [
        own.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows // 2)
        for y in (0, 1)
    ]
    sample = F.broadcast(halves[0].union(halves[1]))
    rows = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
            F.col("lang").cast("string").alias("lang"),
        )
        .join(sample, "doc_id")
        .select("doc_id", "y", "lang", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_pieces(batches):
            words = Words([_plain(x) for x in batch.column("text").to_pylist()])
            buckets = _buckets(words)
            parts = [buckets[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
            short = [len(p) <= sample_words for p in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").filter(pa.array(short)),
                    batch.column("y").filter(pa.array(short)),
                    batch.column("lang").filter(pa.array(short)),
                    pa.array([p.tobytes() for p, s in zip(parts, short, strict=True) if s],
                             pa.binary()),
                ],
                ["doc_id", "y", "lang", "words"],
            )

    table = rows.mapInArrow(run, "doc_id long, y int, lang string, words binary").toArrow()
    table = table.sort_by([("doc_id", "ascending"), ("y", "ascending"), ("words", "ascending")])
    texts = [np.frombuffer(x, dtype=np.int32) for x in table.column("words").to_pylist()]
    return train(
        texts,
        np.array(table.column("y").to_pylist(), dtype=np.int64),
        table.column("lang").to_pylist(),
    )


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, threshold, flagged.

    ``predicted`` compares with 0.7, ``flagged`` with the language's own threshold.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in text_pieces(batches):
            scores = own.of_texts([_plain(x) for x in batch.column("text").to_pylist()])
            limits = np.array(
                [own.thresholds.get(x, own.threshold) for x in batch.column("lang").to_pylist()],
                dtype=np.float64,
            )
            ids = batch.column("doc_id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(
                        [
                            None if i is None else zlib.crc32(str(i).encode()) % FOLDS == HELD_OUT_FOLD
                            for i in ids
                        ],
                        pa.bool_(),
                    ),
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= 0.7).astype(np.int32)),
                    pa.array(limits),
                    pa.array(scores >= limits),
                ],
                ["doc_id", "held_out", "score", "predicted", "threshold", "flagged"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    return rows.mapInArrow(
        run,
        "doc_id long, held_out boolean, score double, predicted int, threshold double, "
        "flagged boolean",
    )


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """Documents below their language's threshold, with all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in text_pieces(batches):
            scores = own.of_texts([_plain(x) for x in batch.column("text").to_pylist()])
            limits = [own.thresholds.get(x, own.threshold) for x in batch.column("lang").to_pylist()]
            yield batch.filter(pa.array(scores < np.array(limits)))

    return docs.mapInArrow(run, docs.schema)
