"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

* Features: character 1- to 3-grams of the lower-cased text (runs of ASCII
  non-letters read as blanks), hashed to ``2 ** BITS`` buckets. A text's vector
  is its TF-IDF weights scaled to sum to ``SCALE``.
* Document frequencies are counted over *all* training rows (one bucket vector
  a task, summed by Spark).
* The weights are fitted by follow-the-regularised-leader with L1 and L2
  penalties on a bounded sample, about max(``sample``, 20 x languages) rows, dealt evenly to the
  languages by a hash of id and text, repeated rows once; part of it is held
  back to fit the temperature of the softmax.
* Prediction needs no per-text vector: the weighted n-grams of a text are
  summed in place, so every row costs time in proportion to its length.
* A text is read in pieces of at most ``BATCH_CHARS`` characters, each with the
  two that follow it, so a very long text costs no more memory than a batch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import chunks

BITS = 15
ORDERS = (1, 2, 3)
SCALE = 40.0
SAMPLE = 4000
BATCH_CHARS = 1 << 19
UNKNOWN = "und"
_MIX = (np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917))


def padded(text: str) -> str:
    """The text between two blanks on each side, so that its n-grams do not depend on its neighbours."""
    return f"  {text.lower()}  "


def buckets(piece: str) -> np.ndarray:
    """Hashed n-grams that start in the piece, shape (orders, characters); behind its end it reads blanks."""
    c = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    c[(c < 97) | ((c > 122) & (c < 128))] = 32
    h, out = np.zeros(len(c), np.uint32), []
    for k in range(max(ORDERS)):
        shifted = np.full(len(c), 32, np.uint32)
        shifted[:len(c) - k] = c[k:]
        h = (h ^ shifted) * _MIX[k % 3] + np.uint32(k + 1)
        out.append((h ^ (h >> np.uint32(15))) * _MIX[2] >> np.uint32(32 - BITS))
    return np.stack([out[k - 1] for k in ORDERS])


def pieces(texts: list[str], limit: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of the texts: their n-grams, where each text's part starts in them, and the places of those texts.

    A part has ``limit`` characters at most. Every n-gram of every text stands
    in exactly one part: a part is hashed with the characters behind it.
    """
    limit, overlap = limit or BATCH_CHARS, max(ORDERS) - 1
    for s, e in chunks([len(t) for t in texts], limit):
        parts = [padded(t) for t in texts[s:e]]
        if e == s + 1 and len(parts[0]) > limit:
            whole = parts[0]
            for at in range(0, len(whole), limit):
                size = min(limit, len(whole) - at)
                yield buckets(whole[at:at + size + overlap])[:, :size], np.zeros(1, np.int64), np.array([s])
        else:
            starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
            yield buckets("".join(parts)), starts, np.arange(s, e)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of one text and their counts, read in pieces."""
    count = np.zeros(1 << BITS, np.int64)
    for codes, _, _ in pieces([text]):
        count += np.bincount(codes.ravel(), minlength=1 << BITS)
    idx = np.flatnonzero(count)
    return idx, count[idx]


def _strings(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(name).to_pylist()


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """How many of ``rows`` (column text) hold each bucket, over all of them, and their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << BITS, np.int64), 0
        seen = np.zeros(1 << BITS, bool)
        for b in batches:
            ts = [t for t in _strings(b, "text") if has_letter(t)]
            n += len(ts)
            last = -1
            for codes, starts, where in pieces(ts):
                for i, x, y in zip(where.tolist(), starts, np.append(starts[1:], codes.shape[1])):
                    if i != last:
                        df += seen
                        seen[:] = False
                        last = i
                    seen[codes[:, x:y]] = True
            df += seen
            seen[:] = False
        idx = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(idx, -1)), pa.array(np.append(df[idx], n))], names=["bucket", "n"])

    total = rows.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out, n = np.zeros(1 << BITS, np.int64), 0
    for bucket, k in total.collect():  # one row a bucket at most
        if bucket < 0:
            n = k
        else:
            out[bucket] = k
    return out, n


@dataclass
class Model:
    """``table`` holds idf-weighted class weights and the idf itself, one row a bucket."""

    classes: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, texts: list[str]) -> np.ndarray:
        total = np.zeros((len(texts), self.table.shape[1]))
        for codes, starts, where in pieces(texts):
            for row in codes:
                total[where] += np.add.reduceat(self.table[row], starts, axis=0, dtype=np.float64)
        return SCALE * total[:, :-1] / np.maximum(total[:, -1:], 1e-9) + self.bias

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
        where = [i for i, t in enumerate(texts) if self.classes and has_letter(t)]
        if where:
            p = softmax(self.logits([texts[i] for i in where]) / self.temperature)
            for i, k, q in zip(where, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                lang[i], score[i] = self.classes[k], min(1.0, q)
        return lang, score


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Per-coordinate FTRL-proximal for softmax regression, elastic-net penalties l1 and l2."""

    def __init__(self, features: int, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01):
        self.z, self.n = np.zeros((features, classes)), np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, idx) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, idx: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(idx)
        p = softmax(x @ w)
        p[y] -= 1.0
        g = x[:, None] * p
        sigma = (np.sqrt(self.n[idx] + g * g) - np.sqrt(self.n[idx])) / self.alpha
        self.z[idx] += g - sigma * w
        self.n[idx] += g * g


def fit(examples: list[tuple[str, bool, np.ndarray, np.ndarray]], df: np.ndarray, n: int, epochs: int = 4, seed: int = 5) -> Model:
    """Fit on (language, calibrate, buckets, counts) rows; a language that has only calibration rows learns from them."""
    classes = sorted({e[0] for e in examples})
    idf = np.log((1 + n) / (1 + df)) + 0.05
    size = 1 << BITS
    ftrl = Ftrl(size + 1, len(classes))

    def example(e):
        x = e[3] * idf[e[2]]
        return np.append(e[2], size), np.append(SCALE * x / max(x.sum(), 1e-9), 1.0)

    taught = {e[0] for e in examples if not e[1]}
    learn = [e for e in examples if not e[1] or e[0] not in taught]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(learn)).tolist():
            ftrl.learn(*example(learn[i]), classes.index(learn[i][0]))
    w = ftrl.weights(slice(None))
    model = Model(classes, np.concatenate([w[:size] * idf[:, None], idf[:, None]], axis=1).astype(np.float32), w[size])
    held = [e for e in examples if e[1]] or learn
    if held:
        z = np.stack([(lambda i, x: x @ w[i])(*example(e)) for e in held])
        y = np.array([classes.index(e[0]) for e in held])
        rate = lambda t: -np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean()
        model.temperature = min((10 ** k for k in np.linspace(-1, 1, 81)), key=rate)
    return model


def draw(rows: DataFrame, counts: dict[str, int], sample: int = SAMPLE) -> DataFrame:
    """Distinct ``doc_id, text, lang``: about ``sample / languages`` rows of each, 20 at least, all if it has fewer.

    ``counts`` has the rows of every language. The shares are joined as a
    table, one row a language, the size of the model's class list.
    """
    each = max(20, sample // len(counts))
    shares = rows.sparkSession.createDataFrame(
        [(lang, min(1 << 30, int((1 << 30) * each / k) + 1)) for lang, k in counts.items()], "lang string, _share long")
    ticket = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1 << 30))
    return rows.join(F.broadcast(shares), "lang").where(ticket < F.col("_share")).select("doc_id", "text", "lang").distinct()


def train(rows: DataFrame, sample: int = SAMPLE) -> Model:
    """Model from rows with ``doc_id, text, lang`` (non-null): frequencies from all, weights from about max(``sample``, 20 x languages)."""
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # one row a language
    if not counts:
        return Model([], np.zeros((1 << BITS, 1), np.float32), np.zeros(0))
    df, n = document_frequencies(rows)
    drawn = draw(rows, counts, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(i, lang, *vector(t)) for i, t, lang in zip(_strings(b, "doc_id"), _strings(b, "text"), _strings(b, "lang")) if has_letter(t)]
            for s in range(0, len(got), 256):
                part = got[s:s + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p[0] for p in part], b.schema.field("doc_id").type), pa.array([p[1] for p in part], pa.string()),
                     pa.array([p[2].astype(np.int32).tolist() for p in part], pa.list_(pa.int32())),
                     pa.array([p[3].astype(np.int32).tolist() for p in part], pa.list_(pa.int32()))],
                    names=["doc_id", "lang", "idx", "cnt"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = drawn.mapInArrow(run, f"doc_id {kind}, lang string, idx array<int>, cnt array<int>")
    rows_ = sorted(found.collect(), key=lambda r: (r["lang"], r["doc_id"], r["idx"], r["cnt"]))
    examples = [(r["lang"], i % 5 == 0, np.array(r["idx"], np.int64), np.array(r["cnt"], np.float64)) for i, r in enumerate(rows_)]
    return fit(examples, df, n)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` from column ``text`` alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, score = held.value.predict(_strings(b, "text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id is not held out (and never trained on)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row.

    Trained on rows outside the held-out fold with text, id and language. A
    null text or one without a letter gets ``und`` and score 0; so does every
    row when nothing can be learned. Other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    training = source.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    found = predict(source, train(training, sample))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
