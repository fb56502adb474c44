"""Quality classifier: random-indexing vectors pooled per document, then a
two-layer numpy network with temperature-calibrated probabilities.

Random indexing gives every word (and every word shape, such as ``Xx,`` for
"Hello,") a sparse ternary index vector derived from its hash.  A word's
context vector is the sum of the index vectors beside its occurrences in the
training texts.  A document is pooled to the mean index vectors of its words
and shapes, the mean context vector, and four numbers: length, concentration
(norm of the mean index vector), immediate repetition and context strength.

The network is fitted on the driver on a bounded sample (``max_rows``) of
labelled rows; one fold of them sets the temperature.  Scoring is one narrow
pass over the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import bounded_rows, drop_kept, hand_back_memory, written
from parley.llm.tokens import text_slices

DIM = 256  # index vectors of words
FOLDED = 32  # what the network sees of them, and the width of context vectors
SHAPE_DIM = 64
NONZERO = 4
BUCKETS = 4096  # hashed words with a context vector
HIDDEN = 32
SLICE = 4_000_000  # bytes of text per step of a task
HOLD_OUT, CALIBRATION = 2, 3  # folds of crc32(id) mod 4


def fold_of(id_col: str) -> Column:
    """crc32 of the id's text, mod 4 (NULL for a NULL id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def hashes(words: pa.Array) -> np.ndarray:
    if not len(words):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words.to_pylist(), dtype=object), categorize=False)


def shapes(words: pa.Array) -> pa.DictionaryArray:
    """Letters run together to x or X, digits to 9; other characters stay."""
    for pattern, mark in ((r"\p{Ll}+", "x"), (r"\p{Lu}+", "X"), (r"\p{N}+", "9")):
        words = pc.replace_substring_regex(words, pattern, mark)
    return words.dictionary_encode()


def index_entries(h: np.ndarray, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Position and sign of each of the nonzero entries of the index vectors."""
    for k in range(NONZERO):
        part = (h >> np.uint64(16 * k)) & np.uint64(0xFFFF)
        yield (part & np.uint64(dim - 1)).astype(np.int64), 1.0 - 2.0 * (part >> np.uint64(15)).astype(np.float64)


@dataclass
class Words:
    """The words of some texts: which text, and which entry of the word list."""

    doc: np.ndarray
    word: np.ndarray
    word_hash: np.ndarray
    shape_hash: np.ndarray
    shape: np.ndarray
    texts: int

    @classmethod
    def of(cls, texts: pa.Array) -> Words:
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        counts = np.diff(split.offsets.to_numpy())
        flat = split.flatten()
        doc = np.repeat(np.arange(len(counts)), counts)
        full = pc.not_equal(flat, "")
        if not pc.all(full, min_count=0).as_py():
            doc, flat = doc[full.to_numpy(zero_copy_only=False)], flat.filter(full)
        coded = flat.dictionary_encode()
        shaped = shapes(coded.dictionary)
        word = coded.indices.to_numpy()
        return cls(doc, word, hashes(coded.dictionary), hashes(shaped.dictionary), shaped.indices.to_numpy()[word]
                   if len(word) else np.zeros(0, np.int32), len(counts))

    def pooled_index(self, which: np.ndarray, h: np.ndarray, dim: int) -> np.ndarray:
        """Sum of index vectors per text."""
        out = np.zeros(self.texts * dim)
        for position, sign in index_entries(h, dim):
            out += np.bincount(self.doc * dim + position[which], weights=sign[which], minlength=self.texts * dim)
        return out.reshape(self.texts, dim)


def context_sums(words: Words) -> np.ndarray:
    """(BUCKETS, FOLDED) sums of the folded index vectors of the neighbours'
    words and shapes."""
    out = np.zeros(BUCKETS * FOLDED)
    bucket = (words.word_hash % np.uint64(BUCKETS)).astype(np.int64)[words.word]
    beside = words.doc[1:] == words.doc[:-1]
    left, right = np.flatnonzero(beside), np.flatnonzero(beside) + 1
    for centre, other in ((left, right), (right, left)):
        for h, which in ((words.word_hash, words.word), (words.shape_hash, words.shape)):
            for position, sign in index_entries(h, FOLDED):
                out += np.bincount(
                    bucket[centre] * FOLDED + position[which[other]], weights=sign[which[other]], minlength=len(out)
                )
    return out.reshape(BUCKETS, FOLDED)


def unit_rows(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return (m / np.where(norm > 0, norm, 1.0)).astype(np.float32)


def pooled_features(texts: pa.Array, context: np.ndarray) -> np.ndarray:
    """One row of features per text; a text without words has zeros."""
    words = Words.of(texts)
    n = np.bincount(words.doc, minlength=words.texts).astype(float)
    some = np.maximum(n, 1.0)[:, None]
    index = words.pooled_index(words.word, words.word_hash, DIM) / some
    shape = words.pooled_index(words.shape, words.shape_hash, SHAPE_DIM) / some
    bucket = (words.word_hash % np.uint64(BUCKETS)).astype(np.int64)[words.word] if len(words.word) else words.word
    mean = np.zeros((words.texts, FOLDED))
    for first in range(0, words.texts, 128):
        last = min(first + 128, words.texts)
        a, b = np.searchsorted(words.doc, [first, last])
        counts = np.bincount((words.doc[a:b] - first) * BUCKETS + bucket[a:b], minlength=(last - first) * BUCKETS)
        mean[first:last] = counts.reshape(last - first, BUCKETS).astype(np.float32) @ context
    mean /= some
    again = (words.word[1:] == words.word[:-1]) & (words.doc[1:] == words.doc[:-1])
    repeated = np.bincount(words.doc[1:][again], minlength=words.texts)
    norm = (index**2).sum(1) / NONZERO
    numbers = np.stack(
        [np.log1p(n), np.log(norm + 1e-4), repeated / some[:, 0], np.linalg.norm(mean, axis=1)], axis=1
    )
    folded = index.reshape(words.texts, DIM // FOLDED, FOLDED).sum(1)
    out = np.concatenate([folded, mean, shape, numbers], axis=1)
    out[n == 0] = 0.0
    return out


@dataclass
class Network:
    """Two layers on standardised features; ``temperature`` divides the logit."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = HIDDEN, epochs: int = 60, seed: int = 3) -> Network:
    """Adam on the log loss, both classes weighing the same.  One class (or no
    rows) gives a network that answers its smoothed share everywhere."""
    rng = np.random.default_rng(seed)
    share = (y.sum() + 1.0) / (len(y) + 2.0)
    d = x.shape[1]
    if len(y) == 0 or y.min() == y.max():
        flat = np.zeros((d, hidden))
        return Network(np.zeros(d), np.ones(d), flat, np.zeros(hidden), np.zeros(hidden), float(np.log(share / (1 - share))))
    net = Network(
        x.mean(0), x.std(0) + 1e-3, rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden),
        rng.normal(0, hidden**-0.5, hidden), 0.0,
    )
    z = np.clip((x - net.centre) / net.scale, -8, 8)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    parameters = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 256):
            rows = order[at : at + 256]
            t += 1
            h = np.tanh(z[rows] @ parameters[0] + parameters[1])
            p = 1.0 / (1.0 + np.exp(-np.clip(h @ parameters[2] + parameters[3], -40, 40)))
            delta = weight[rows] * (p - y[rows]) / len(rows)
            back = np.outer(delta, parameters[2]) * (1 - h**2)
            gradients = [z[rows].T @ back, back.sum(0), h.T @ delta, np.array([delta.sum()])]
            for i, g in enumerate(gradients):
                g = g + 1e-4 * parameters[i]
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g**2
                step = 0.003 * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
                parameters[i] -= step
    net.w1, net.b1, net.w2, net.b2 = parameters[0], parameters[1], parameters[2], float(parameters[3][0])
    return net


def calibrate(net: Network, x: np.ndarray, y: np.ndarray) -> None:
    """The temperature with the least log loss on rows the fit has not seen."""
    if len(y) == 0:
        return
    logits = net.logits(x)
    sign = np.where(y == 1, 1.0, -1.0)
    grid = np.exp(np.linspace(np.log(0.25), np.log(8.0), 61))
    net.temperature = float(min(grid, key=lambda t: np.logaddexp(0.0, -sign * logits / t).sum()))


@dataclass
class QualityModel:
    context: np.ndarray
    network: Network


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int
) -> DataFrame:
    """(text, label, calibrate, key) of at most ``max_rows`` labelled rows
    outside the held-out fold, chosen by a hash of their ids.

    Rows without id, text or a 0/1 label take no part; of an id that occurs
    with several texts the least one is taken, so the bound holds however often
    an id is repeated.
    """
    learn = labels.where(F.col(label_col).isin(0, 1) & (fold_of(id_col) != HOLD_OUT)).select(
        F.col(id_col), F.col(label_col).cast("int").alias("label")
    )
    texts = docs.select(F.col(id_col), F.col(text_col)).where(F.col(text_col).isNotNull())
    chosen = bounded_rows(learn, learn, id_col, max_rows, "quality").groupBy(id_col).agg(F.max("label").alias("label"))
    return (
        texts.join(F.broadcast(chosen), id_col)
        .groupBy(id_col, "label")
        .agg(F.min(text_col).alias(text_col))
        .select(text_col, "label", (fold_of(id_col) == CALIBRATION).cast("int").alias("calibrate"), F.xxhash64(id_col).alias("key"))
    )


def train_quality_model(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_rows: int = 8000,
) -> QualityModel:
    """Fit on ``labelled_sample``."""
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, max_rows).repartition(16, "key")
    sample = written(sample, "quality-sample")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BUCKETS, FOLDED))
        for whole in batches:
            for batch in text_slices(whole, 0, SLICE):
                total += context_sums(Words.of(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array([total.astype("<f4").tobytes()], pa.binary())], names=["sums"])

    parts = sample.select(text_col).mapInArrow(sums, "sums binary").collect()
    total = sum((np.frombuffer(r["sums"], "<f4").astype(float) for r in parts), np.zeros(BUCKETS * FOLDED))
    context = unit_rows(np.round(total, 3).reshape(BUCKETS, FOLDED))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, 0, SLICE):
                rows = [r.tobytes() for r in pooled_features(batch.column(0), context).astype("<f4")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.binary()), *batch.columns[1:]], names=["x", "label", "calibrate", "key"]
                )

    rows = sorted(sample.mapInArrow(features, "x binary, label int, calibrate int, key long").collect(),
                  key=lambda r: (r["key"], bytes(r["x"])))
    width = FOLDED + FOLDED + SHAPE_DIM + 4
    x = np.array([np.frombuffer(r["x"], "<f4") for r in rows], float).reshape(len(rows), width)
    y = np.array([r["label"] for r in rows], float)
    held = np.array([r["calibrate"] for r in rows], bool)
    network = fit_network(x[~held], y[~held])
    calibrate(network, x[held], y[held])
    return QualityModel(context, network)


def score_documents(
    docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7
) -> DataFrame:
    """(id, held_out, score, predicted) per row; no shuffle."""
    rows = docs.select(F.col(id_col), F.col(text_col), F.coalesce(fold_of(id_col) == HOLD_OUT, F.lit(False)).alias("held"))
    fields = T.StructType([
        T.StructField(id_col, rows.schema[0].dataType),
        T.StructField("held_out", T.BooleanType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType()),
    ])
    context, network = model.context, model.network

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for whole in batches:
            for batch in text_slices(whole, size=SLICE):
                p = network.probabilities(pooled_features(batch.column(1), context))
                columns = [batch.column(0), batch.column(2), pa.array(p), pa.array((p >= threshold).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=fields.names)
        hand_back_memory()

    return rows.mapInArrow(score, fields)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train and score: one row per input row with id, held_out, score and
    predicted.

    NULL and empty texts are scored as texts without words; NULL ids are never
    held out; repeated rows are scored alike; without labelled rows of both
    classes every score is the smoothed share of label 1; an empty table gives
    an empty result.  Only the text enters a score.
    """
    return score_documents(docs, train_quality_model(docs, labels, id_col, text_col), id_col, text_col)


def keep_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7
) -> DataFrame:
    """The documents that the classifier accepts, with all their columns; no
    shuffle of texts."""
    model = train_quality_model(docs, labels, id_col, text_col)
    context, network, text = model.context, model.network, docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept()
        for whole in batches:
            for batch in text_slices(whole, text, SLICE):
                p = network.probabilities(pooled_features(batch.column(text), context))
                yield batch.filter(pa.array(p >= threshold))
        hand_back_memory()

    return docs.mapInArrow(keep, docs.schema)
