"""Operator 8: quality classifier on random-indexing word vectors, with a two-layer network.

Random indexing: every term has a fixed, sparse, random index vector (a few +1 and -1,
drawn from a hash of the term). A term's context vector is the sum of the index vectors of
the terms around it, over all texts that may train, labelled or not; terms used alike get
alike vectors. The sums are whole numbers in a table of fixed size, added up by Spark from one
table for each partition, so they are the same in any order. A document is its terms' normalized context vectors, pooled (mean and spread) over the whole
text, next to the pooled index vectors themselves.

Terms are bounded in number, whatever the corpus: a word's shape (letters, capitals, digits
and marks, runs shortened; also whether it repeats the word before) and its lower-cased form, each hashed into a fixed number of
rows. So words that training never saw have a vector too.

The network (numpy): tanh layer, logistic output, trained by Adam on the labelled rows
given that have a document, at most ``MAX_TRAINING_ROWS`` of them, chosen by a hash of the id.
The driver gets their pooled vectors only, no texts. A further part of
them, also by hash, is left out of the fit; on it the temperature is found that makes the
probabilities fit the labels best (lowest log loss). Scores are sigmoid(logit / temperature).

The model (about 1 MB) is a fixed-size array set, broadcast to score whole texts in one
narrow pass. Labels, languages, sources and ids are no input of a score.

Edge cases: null and empty texts get the score of a document without terms; a null label
doesn't train; without training rows, or with one label alone, every score is the share of
label 1 (0.5 without any); repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import WORD, release_memory, tidy

#: Labelled rows that a model is fitted on at most.
MAX_TRAINING_ROWS = 4000

#: Words whose contexts are added up at once (one text at least).
COUNTED_AT_ONCE = 500_000

#: Of each training text, all words count for the pooled vector; contexts are counted in windows this wide on each side.
WINDOW = 2

SHAPES, WORDS, WIDTH = 2048, 8192, 48
NONZERO = 4
HIDDEN = 24
SEED = 7

_words = re.compile(WORD).findall
_upper, _lower, _digit = re.compile(r"[^\W\d_a-z]{2,}|[A-Z]{2,}"), re.compile(r"[^\W\d_A-Z]+"), re.compile(r"\d+")
_run = re.compile(r"([^\w\s])\1+")


def shape(word: str) -> str:
    """Letters by case, digits as 9, marks as they are, runs of one mark as two."""
    s = _digit.sub("9", word)
    caps = s.isupper()
    s = re.sub(r"[^\W\d_]+", lambda m: "A" if caps and len(m[0]) > 1 else ("Aa" if m[0][0].isupper() else "a"), s)
    return _run.sub(r"\1\1", s)


class Terms(dict):
    """word -> (row of its shape, row of its form) in one number; keeps a bounded number of words."""

    def __missing__(self, word: str) -> int:
        form = zlib.crc32(word.lower().encode("utf-8", "replace")) % WORDS
        row = zlib.crc32(shape(word).encode("utf-8", "replace")) % SHAPES
        found = row * WORDS + form
        if len(self) < 150_000:
            self[word] = found
        return found


_terms = Terms()


def term_rows(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the shapes and of the forms of all words of a text; forms follow the shapes in the tables.

    A word that repeats the one before it has a shape row of its own.
    """
    words = _words(text) if text else []
    both = np.fromiter(map(_terms.__getitem__, words), np.int64, len(words))
    shapes = both // WORDS
    shapes[1:] += SHAPES * (both[1:] == both[:-1])
    return shapes, 2 * SHAPES + both % WORDS


def index_vectors() -> np.ndarray:
    """The fixed sparse random vectors of all rows."""
    draw = np.random.default_rng(SEED)
    out = np.zeros((2 * SHAPES + WORDS, WIDTH), np.float32)
    at = draw.integers(0, WIDTH, (len(out), NONZERO))
    sign = draw.choice(np.array([-1, 1], np.float32), (len(out), NONZERO))
    for j in range(NONZERO):
        np.add.at(out, (np.arange(len(out)), at[:, j]), sign[:, j])
    return out


@dataclass
class Model:
    vectors: np.ndarray  # a row for each term: context vector, then index vector
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def pooled(self, text: str | None) -> np.ndarray:
        return pooled(self.vectors, text)

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2
        return 1 / (1 + np.exp(-np.clip(z / self.temperature, -40, 40)))


def pooled(vectors: np.ndarray, text: str | None) -> np.ndarray:
    """Mean and spread of the shapes' vectors, mean of the forms', over the whole text, and the text's length."""
    shapes, forms = term_rows(text)
    if not len(shapes):
        return np.zeros(3 * vectors.shape[1] + 1)
    # few distinct shapes, many words: counts first
    counts = np.bincount(shapes)
    used = np.flatnonzero(counts)
    share, v = counts[used] / len(shapes), vectors[used].astype(np.float64)
    mean = share @ v
    spread = np.sqrt(np.maximum(share @ (v * v) - mean * mean, 0))
    counts = np.bincount(forms)
    used = np.flatnonzero(counts)
    form = (counts[used] / len(forms)) @ vectors[used].astype(np.float64)
    return np.concatenate([mean, spread, form, [np.log1p(len(shapes))]])


class Contexts:
    """Random indexing over texts: each row's sum of its neighbours' index vectors, in whole numbers."""

    def __init__(self):
        index = index_vectors().astype(np.int64)
        self.table = np.zeros(index.size)  # exact: whole numbers far below 2^53
        # each row's places in its index vector, and what stands there; rows with fewer places have zeros
        self._at = np.argsort(-np.abs(index), axis=1, kind="stable")[:, :NONZERO].astype(np.int32)
        self._value = np.take_along_axis(index, self._at, axis=1).astype(np.float64)
        self._rows: list[np.ndarray] = []
        self._held = 0

    def add(self, text: str | None) -> None:
        for rows in term_rows(text):
            if len(rows):
                self._rows += [rows, np.full(WINDOW, -1)]  # a window does not reach into another text
        self._held += len(rows)
        if self._held >= COUNTED_AT_ONCE:
            self.flush()

    def flush(self) -> None:
        rows = np.concatenate([np.zeros(0, np.int64), *self._rows])
        self._rows, self._held = [], 0
        for step in range(1, WINDOW + 1):
            a, b = rows[:-step], rows[step:]
            both = (a >= 0) & (b >= 0)
            a, b = a[both], b[both]
            for row, near in ((a, b), (b, a)):
                for k in range(NONZERO):
                    self.table += np.bincount(row * WIDTH + self._at[near, k], self._value[near, k], len(self.table))


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Contexts over the column text, each to length one; then the index vectors."""
    size = 2 * SHAPES + WORDS
    columns = [f"c{i}" for i in range(WIDTH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Contexts()
        for batch in batches:
            for text in batch.column(0):
                found.add(text.as_py())
        found.flush()
        _terms.clear()
        table = found.table.astype(np.int64).reshape(size, WIDTH)
        used = np.flatnonzero(table.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), *(pa.array(table[used, i]) for i in range(WIDTH))], names=["row", *columns])

    partial = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), "row long, " + ", ".join(f"{c} long" for c in columns))
    sums = partial.groupBy("row").agg(*(F.sum(c).alias(c) for c in columns)).toArrow()  # a row for each term row at most
    context = np.zeros((size, WIDTH))
    context[sums.column("row").to_numpy()] = np.column_stack([sums.column(c).to_numpy() for c in columns])
    length = np.linalg.norm(context, axis=1, keepdims=True)
    return np.hstack([np.divide(context, length, out=np.zeros_like(context), where=length > 0), index_vectors()]).astype(np.float32)


def fit(vectors: np.ndarray, x: np.ndarray, labels: list[int], spare: list[bool]) -> Model:
    """A model from the pooled vectors ``x`` of the labelled texts; ``spare`` rows only set the temperature."""
    y, spare_ = np.array(labels, np.float64), np.array(spare, bool)
    dim = 3 * vectors.shape[1] + 1
    draw = np.random.default_rng(SEED)
    w1, b1 = draw.normal(0, dim**-0.5, (dim, HIDDEN)), np.zeros(HIDDEN)
    w2, b2 = draw.normal(0, HIDDEN**-0.5, HIDDEN), 0.0
    mean, scale = np.zeros(dim), np.ones(dim)
    if len(set(labels)) < 2:
        share = min(max(float(y.mean()), 1e-6), 1 - 1e-6) if len(y) else 0.5
        return Model(vectors, mean, scale, w1 * 0, b1, w2 * 0, float(np.log(share / (1 - share))), 1.0)
    learn = ~spare_ if len(set(y[~spare_])) == 2 else np.ones(len(y), bool)
    mean, scale = x[learn].mean(axis=0), x[learn].std(axis=0)
    scale = np.where(scale > 1e-6, scale, 1.0)
    a, t = (x[learn] - mean) / scale, y[learn]
    weight = np.where(t == 1, 0.5 / t.mean(), 0.5 / (1 - t.mean()))  # either label counts half
    parts = [w1, b1, w2, np.array([b2])]
    first, second = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    step = 0
    for _ in range(60):
        order = draw.permutation(len(a))
        for at in range(0, len(a), 128):
            i = order[at : at + 128]
            h = np.tanh(a[i] @ parts[0] + parts[1])
            p = 1 / (1 + np.exp(-np.clip(h @ parts[2] + parts[3][0], -40, 40)))
            dz = (p - t[i]) * weight[i] / len(i)
            dh = np.outer(dz, parts[2]) * (1 - h * h)
            grads = [a[i].T @ dh + 1e-4 * parts[0], dh.sum(axis=0), h.T @ dz + 1e-4 * parts[2], np.array([dz.sum()])]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                parts[k] = parts[k] - 0.003 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    model = Model(vectors, mean, scale, parts[0], parts[1], parts[2], float(parts[3][0]), 1.0)
    # the balanced fit is moved back to the labels' own shares, then tempered
    model.b2 += float(np.log(t.mean() / (1 - t.mean())))
    held = spare_ if spare_.any() and learn.sum() < len(y) else np.ones(len(y), bool)
    best = None
    for temperature in np.geomspace(0.25, 8, 41):
        model.temperature = float(temperature)
        p = np.clip(model.scores(x[held]), 1e-9, 1 - 1e-9)
        loss = -(y[held] * np.log(p) + (1 - y[held]) * np.log(1 - p)).mean()
        if best is None or loss < best[0] - 1e-12:
            best = (loss, float(temperature))
    model.temperature = best[1]
    return model


def train(docs: DataFrame, labels: DataFrame, usable: F.Column, max_rows: int = MAX_TRAINING_ROWS) -> Model:
    """A model from the documents for which ``usable`` (of doc_id) holds: contexts from all of them, the network from at most ``max_rows`` labelled ones, by hash.

    The rows that are kept are found on ids alone; texts of no others move.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(usable)
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & usable)
        .groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .join(own.select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    ids = {r["doc_id"]: r["quality"] for r in chosen.collect()}
    if not ids:
        vectors = np.hstack([np.zeros((2 * SHAPES + WORDS, WIDTH), np.float32), index_vectors()])
        return fit(vectors, np.zeros((0, 3 * vectors.shape[1] + 1)), [], [])
    spark = docs.sparkSession
    vectors = context_vectors(own)
    shared = spark.sparkContext.broadcast(vectors)

    @F.arrow_udf("array<double>")
    def features(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([pooled(shared.value, t).tolist() for t in batch.to_pylist()], pa.list_(pa.float64()))
        _terms.clear()
        release_memory()

    small = spark.createDataFrame([(k, v) for k, v in ids.items()], "id long, quality int")  # at most max_rows rows
    # of rows that share an id, the first text by code point
    kept = own.join(F.broadcast(small), F.col("doc_id") == F.col("id")).groupBy("id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    found = {r["id"]: r["x"] for r in kept.select("id", features("text").alias("x")).collect()}
    order = sorted(found)
    return fit(vectors, np.array([found[i] for i in order]), [ids[i] for i in order], [zlib.crc32(f"spare {i}".encode()) % 5 == 0 for i in order])


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns and the score (0 to 1) of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for batch in texts:
            x = [m.pooled(t) for t in batch.to_pylist()]
            yield pa.array(m.scores(np.array(x)) if x else [], pa.float64())
        _terms.clear()
        release_memory()

    return docs.withColumn(score_col, scores(F.col(f"`{text_col}`").cast("string")))


def held_out(doc_id: F.Column) -> F.Column:
    """Rows that never train; the remainder of a null id is that of an empty text's crc32."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def scored_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    model = train(docs, labels, ~held_out(F.col("doc_id")))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
