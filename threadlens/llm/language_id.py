"""Language identification with a small byte convolutional network, trained and applied in numpy.

A text's UTF-8 bytes (ASCII folded to lower case) are cut into fixed-length windows.  Filters of several
widths run over every window, each filter keeps its maximum over the window, and a softmax layer turns the
maxima into probabilities.  A byte enters a filter of width w through w tables of 256 rows (embedding and
filter weights in one), so a convolution is w table look-ups and their sum.  A text's probabilities are the
mean over all its windows, weighted by the bytes in them: whole texts are read, never a prefix.

The network learns from a bounded sample of labelled rows (``LEARN_DOCS`` per language, ``LEARN_WINDOWS``
windows per language, both by hash order) and is a few hundred kB, sent to tasks in the function's closure.

Null texts and texts without a letter are ``und`` with score 1.  Rows with a null language are not learned
from.  Ties between languages go to the first in alphabetical order.  Labels of more than ``MAX_LANGUAGES`` languages end
the job with an error, as the sample would no longer be bounded.  Very long texts are read whole; repeated rows each;
other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadlens.llm.common import first_rows, slices

UNKNOWN = "und"
LENGTH = 384                       # bytes of a window
WIDTHS, FILTERS = (2, 3, 4), 16    # filters of each width
LEARN_DOCS, LEARN_WINDOWS, MAX_LANGUAGES = 500, 1500, 200
EPOCHS, BATCH, RATE, SEED = 6, 128, 0.01, 7
MIN_SCORE = 0.4                    # below it no language is trusted
LETTER = regex.compile(r"\p{L}")


def windows(texts: list[str], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows x length bytes, padded with 0; text number of each window; its byte count)."""
    raw = [t.encode().lower() for t in texts]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    counts = -(-sizes // length)
    data = np.frombuffer(b"".join(r.ljust(n * length, b"\0") for r, n in zip(raw, counts.tolist())), dtype=np.uint8)
    owner = np.repeat(np.arange(len(raw)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return data.reshape(-1, length), owner, np.minimum(length, sizes[owner] - place * length)


@dataclass
class ByteNetwork:
    """Tables[k] holds, for every byte, what it adds to each filter at offset k (0 where the filter is narrower)."""

    languages: list[str]
    tables: list[np.ndarray]
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    @staticmethod
    def fresh(languages: list[str], seed: int = SEED) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        width = np.repeat(WIDTHS, FILTERS)
        tables = [(rng.normal(0, 0.3, (256, len(width))) * (width > k)).astype(np.float32) for k in range(max(WIDTHS))]
        return ByteNetwork(languages, tables, np.zeros(len(width), np.float32),
                           rng.normal(0, 0.1, (len(width), len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))

    def convolve(self, x: np.ndarray) -> np.ndarray:
        """Filter values at every position; positions beyond the window see zero bytes."""
        total = self.tables[0][x]
        for k in range(1, len(self.tables)):
            total[:, :-k] += self.tables[k][x[:, k:]]
        return total

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.weights + self.offset
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of each window, 8 windows at a time so that values stay in the cache."""
        return np.concatenate([self.probabilities(self.convolve(x[at:at + 8]).max(axis=1)) for at in range(0, len(x), 8)]) \
            if len(x) else np.empty((0, len(self.languages)), np.float32)

    def texts(self, texts: list[str]) -> np.ndarray:
        """Mean probabilities of whole texts; rows of empty texts are 0."""
        x, owner, size = windows(texts)
        out = np.zeros((len(texts), len(self.languages)))
        np.add.at(out, owner, self.predict(x) * size[:, None])
        return out / np.maximum(1e-9, out.sum(axis=1, keepdims=True))

    def learn(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Adam on the cross-entropy; gradients pass the pooling only at each filter's maximum."""
        rng = np.random.default_rng(seed)
        width = np.repeat(WIDTHS, FILTERS)
        params = [*self.tables, self.bias, self.weights, self.offset]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                rows = order[at:at + BATCH]
                v, n = x[rows], len(rows)
                conv = self.convolve(v)
                top = conv.argmax(axis=1)
                pooled = np.take_along_axis(conv, top[:, None, :], axis=1)[:, 0, :]
                hidden = np.maximum(pooled + self.bias, 0)
                d = self.probabilities(pooled)
                d[np.arange(n), y[rows]] -= 1
                d /= n
                back = (d @ self.weights.T) * (hidden > 0)
                grads = []
                for k in range(len(self.tables)):
                    g, place = np.zeros_like(self.tables[k]), top + k
                    seen = (place < v.shape[1]) & (width > k)
                    byte = np.take_along_axis(v, np.minimum(place, v.shape[1] - 1), axis=1)
                    np.add.at(g, (byte[seen], np.broadcast_to(np.arange(len(width)), top.shape)[seen]), back[seen])
                    grads.append(g)
                grads += [back.sum(axis=0), hidden.T @ d, d.sum(axis=0)]
                step += 1
                for p, g, m, s in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-7)


def training_windows(labelled: DataFrame, *, id_col: str, text_col: str, lang_col: str, docs: int = LEARN_DOCS,
                     per_language: int = LEARN_WINDOWS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """A bounded sample: windows of ``docs`` rows per language, first in hash order, then ``per_language`` windows."""
    ids = first_rows(labelled.where(F.col(lang_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(lang_col).alias("lang")),
                     "lang", [F.xxhash64("i"), "i"], docs).select("i").distinct()
    if ids.count() > docs * MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    chosen = labelled.join(F.broadcast(ids), F.col(id_col) == F.col("i"), "left_semi")  # bounded by the check above
    kind = T.ArrayType(T.BinaryType())

    @F.arrow_udf(kind)
    def cut(texts: pa.Array) -> pa.Array:
        return pa.array([[w.tobytes() for w in windows([t])[0]] if t and LETTER.search(t) else [] for t in texts.to_pylist()], pa.list_(pa.binary()))

    parts = chosen.select(F.col(lang_col).alias("lang"), F.explode(cut(F.col(text_col).cast("string"))).alias("w"))
    rows = first_rows(parts, "lang", [F.xxhash64("w"), "w"], per_language).orderBy("lang", "w").collect()
    languages = sorted({r.lang for r in rows})
    if not rows:
        return [], np.empty((0, LENGTH), np.uint8), np.empty(0, np.int64)
    x = np.frombuffer(b"".join(bytes(r.w) for r in rows), dtype=np.uint8).reshape(-1, LENGTH)
    return languages, x, np.array([languages.index(r.lang) for r in rows])


def fit(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteNetwork:
    """Train on a bounded sample; every third window is also cut short so that short texts are known."""
    languages, x, y = training_windows(labelled, id_col=id_col, text_col=text_col, lang_col=lang_col)
    network = ByteNetwork.fresh(languages or [UNKNOWN])
    if len(x):
        rng = np.random.default_rng(SEED)
        short = x[::3].copy()
        short[np.arange(x.shape[1]) >= rng.integers(12, 160, (len(short), 1))] = 0
        network.learn(np.concatenate([x, short]), np.concatenate([y, y[::3]]))
    return network


def predict_column(text: Column, network: ByteNetwork) -> Column:
    """struct<lang_pred string, score double> of a text column."""
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.arrow_udf(kind)
    def predict(texts: pa.Array) -> pa.Array:
        langs, scores = [], []
        for start, stop in slices(texts):
            part = [t if t and LETTER.search(t) else "" for t in texts.slice(start, stop - start).to_pylist()]
            p = network.texts(part)
            best = p.argmax(axis=1)
            langs += [network.languages[b] if t else UNKNOWN for t, b in zip(part, best)]
            scores += [min(1.0, float(p[i, b])) if t else 1.0 for i, (t, b) in enumerate(zip(part, best))]
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["lang_pred", "score"])

    return predict(text.cast("string"))


def identify(docs: DataFrame, network: ByteNetwork, *, text_col: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct column ``into``; other columns are kept as they are."""
    return docs.withColumn(into, predict_column(F.col(text_col), network))


def trusted(prediction: Column, min_score: float = MIN_SCORE) -> Column:
    """True for documents in a known language."""
    return (prediction["lang_pred"] != UNKNOWN) & (prediction["score"] >= min_score)
