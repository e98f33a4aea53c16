"""Operator 13: toxicity by subword-bag embeddings averaged into a linear softmax.

A word (lower case, marks at its ends removed) is the bag of its character n-grams, with its
borders marked, and of itself, each hashed into one of ``BUCKETS`` rows. A row has an
embedding; a word is the mean of its rows' embeddings, a text the mean of its distinct words
over the whole text, a word weighing the root of its number (texts that repeat one word
endlessly are not that word alone). A linear softmax on top gives the probabilities of the two
labels. Embeddings and softmax are trained jointly (numpy, gradient descent). Rows start along
one direction, by how surely they occur with one label (signed root of the likelihood ratio,
less ``SURE``), so that the few telling rows among very many don't drown in chance. A
misspelling that training never saw shares most n-grams, and so most of its vector, with the
word that it stands for.

Texts become bags on the executors; the driver gets the bags of a bounded sample alone: at
most ``max_per_label`` labelled rows of each label, by a hash of the id, and of these, in that
order, as many as hold ``max_entries`` bag entries (one row of each label at least). A fifth of
the sample, by hash, is left out of the fit; on it slope and offset of the logit are set
(each label weighing its share among all rows that may train). What each row adds to the logit
(4 MB) is broadcast, and whole texts are scored in one narrow pass. Labels, languages, sources
and ids are no input of a score.

Edge cases: null and empty texts, and texts of marks alone, get the score of an empty bag; a
null label doesn't train; a document with two labels counts as toxic; without training rows,
or with one label alone, every score is the share of label 1 (0 without any); of rows that
share an id the smallest text trains; repeated rows score alike; an empty table gives an
empty result; further columns are kept by ``score`` and not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import release_memory, stored
from casegrid.llm.fingerprints import mixed
from casegrid.llm.pretokens import ragged

#: Labelled rows of each label that a model is fitted on at most, and entries of all their bags.
MAX_PER_LABEL = 2500
MAX_ENTRIES = 10_000_000

BUCKETS, WIDTH = 1 << 20, 8
SHORTEST, LONGEST = 3, 5
#: Bags that a row must be in to have an embedding.
LEAST_BAGS = 3
#: Standard deviations by which a row's labels must differ from chance for a start other than near zero, and the length of the start for each one above.
SURE, START = 4.0, 0.2
#: A text's mean vector is scaled by this before the softmax: a few words among hundreds must count.
SCALE = 30.0
#: Every text's mean counts so many words without any margin: of two or three words none decides alone.
PLAIN = 2.0
#: Steps of the descent, each on ``BATCH`` texts; a small sample is gone through more often. The pace is ``RATE`` over the median squared length of the texts' vectors.
STEPS, BATCH, RATE, SLOW = 900, 64, 7.65, 0.1
SEED = 11

#: Bytes of text that are taken apart at once (one text at least).
SLICE_BYTES = 2 << 20
#: A word's ends that are neither letters nor digits.
_MARKS = r"^[^\pL\pN]+|[^\pL\pN]+$"
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all words end to end, and how many each word has: its n-grams with marked borders, and itself."""
    marked = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    starts = np.cumsum(lengths) - lengths
    left = np.repeat(starts + lengths, lengths) - np.arange(len(marked))  # code points from here to the word's end
    owner = np.repeat(np.arange(len(words)), lengths)
    powers = np.cumprod(np.full(max(LONGEST, int(lengths.max(initial=1))), _PRIME))
    found = [np.add.reduceat(marked * powers[np.arange(len(marked)) - starts[owner]], starts) if len(words) else np.zeros(0, np.uint64)]
    owners = [np.arange(len(words))]
    for n in range(SHORTEST, LONGEST + 1):
        at = np.flatnonzero(left >= n)
        found.append(sum((marked[at + k] * powers[k] for k in range(n)), np.zeros(len(at), np.uint64)) + np.uint64(n))
        owners.append(owner[at])
    rows, owners = (mixed(np.concatenate(found)) % np.uint64(BUCKETS)).astype(np.int64), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return rows[order], np.bincount(owners, minlength=len(words))


def taken_apart(texts: pa.Array) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Of successive slices of the texts: distinct words, the word of each place, and where each text's places end."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    sizes, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES)))
        lists = pc.split_pattern_regex(pc.utf8_lower(texts.slice(at, to - at)), r"[\x20\x09-\x0D]+")
        coded = lists.flatten().dictionary_encode()
        plain = pc.replace_substring_regex(coded.dictionary, _MARKS, "").dictionary_encode()
        words = plain.dictionary.to_pylist()
        which = plain.indices.to_numpy()[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        ends = lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0]
        if "" in words:  # marks alone
            keep = which != words.index("")
            ends, which = np.concatenate([[0], np.cumsum(keep)])[ends], which[keep]
        yield words, which, ends
        at = to


def bags(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each text's rows and their weights: a distinct word weighs the root of its number, a subword the same in its word."""
    for words, which, ends in taken_apart(texts):
        rows, sizes = subwords(words)
        starts, at = np.cumsum(sizes) - sizes, 0
        for end in ends.tolist():
            some, times = np.unique(which[at:end], return_counts=True)
            times = np.sqrt(times)
            weight = np.repeat(times / (times.sum() + PLAIN) / sizes[some], sizes[some])
            found, place = np.unique(ragged(rows, starts[some], sizes[some]), return_inverse=True)
            yield found.astype(np.int32), np.bincount(place, weight, len(found)).astype(np.float32)
            at = end


@dataclass
class Model:
    embeddings: np.ndarray
    weights: np.ndarray
    offsets: np.ndarray

    def row_margins(self) -> np.ndarray:
        """What each row, alone in a text, adds to the logit of label 1 against label 0."""
        return SCALE * (self.embeddings @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float64)


def mean_margins(row_margins: np.ndarray, texts: pa.Array) -> Iterator[np.ndarray]:
    """Each text's mean over its distinct words' margins, themselves means over their rows, weighed as in ``bags``; 0 without words."""
    for words, which, ends in taken_apart(texts):
        rows, sizes = subwords(words)
        each = np.add.reduceat(row_margins[rows].astype(np.float64), np.cumsum(sizes) - sizes) / sizes if words else np.zeros(0)
        # words in an order of their own, so that equal texts score alike to the last bit wherever they stand
        place = np.empty(len(words), np.int64)
        place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        by_place = np.empty(len(words))
        by_place[place] = each
        out, at = [], 0
        for end in ends.tolist():
            some, times = np.unique(place[which[at:end]], return_counts=True)
            weight = np.sqrt(times)
            out.append(float((by_place[some] * weight).sum() / (weight.sum() + PLAIN)))
            at = end
        yield np.array(out)


def surely(with_1: np.ndarray, with_0: np.ndarray, all_1: int, all_0: int) -> np.ndarray:
    """Signed root of the likelihood ratio of "as often with both labels", for rows in so many bags of each label."""

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    share_1, both = all_1 / (all_1 + all_0), with_1 + with_0
    g = part(with_1, both * share_1) + part(with_0, both * (1 - share_1))
    rest = all_1 + all_0 - both
    g += part(all_1 - with_1, rest * share_1) + part(all_0 - with_0, rest * (1 - share_1))
    return np.sign(with_1 - both * share_1) * np.sqrt(np.maximum(2 * g, 0))


def descend(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, start: np.ndarray, rate: float) -> list[np.ndarray]:
    """Embeddings, softmax weights and offsets after ``STEPS`` steps, to the end of the last epoch."""
    draw = np.random.default_rng(SEED)
    direction = draw.normal(0, 1, WIDTH)
    direction /= np.linalg.norm(direction)
    table = draw.normal(0, 1e-3, (len(start), WIDTH)) + np.outer(start, direction)
    weights, offsets = np.stack([-direction / 2, direction / 2], axis=1), np.zeros(2)
    batches = -(-len(rows) // BATCH)
    epochs = -(-STEPS // batches)
    share, step, steps = labels.mean(), 0, epochs * batches
    weigh = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))  # either label counts half
    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for k in range(0, len(order), BATCH):
            some = order[k : k + BATCH]
            used, at = np.unique(np.concatenate([rows[i] for i in some]), return_inverse=True)
            dense = np.zeros((len(some), len(used)))
            dense[np.repeat(np.arange(len(some)), [len(rows[i]) for i in some]), at] = np.concatenate([values[i] for i in some])
            mean = SCALE * (dense @ table[used])
            z = mean @ weights + offsets
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), labels[some]] -= 1
            p *= (weigh[some] / len(some))[:, None]
            pace = rate * (1 - step / steps)
            step += 1
            moves = SCALE * (dense.T @ (p @ weights.T)), mean.T @ p, p.sum(axis=0)
            table[used] -= pace * moves[0]
            weights -= SLOW * pace * moves[1]
            offsets -= pace * moves[2]
    return [table, weights, offsets]


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, spare: np.ndarray, odds: float) -> Model:
    """Embeddings and softmax, trained jointly on the rows that aren't ``spare``; ``odds`` of label 1 among all rows that may train."""
    none = np.zeros((BUCKETS, WIDTH), np.float32)
    if not 0 < odds < np.inf:
        # one label alone or none: its share
        return Model(none, np.zeros((WIDTH, 2)), np.array([0.0, -np.inf if odds == 0 else np.inf]))
    if len(set(labels[~spare])) < 2 or len(set(labels[spare])) < 2:
        spare = np.zeros(len(labels), bool)
    learn = np.flatnonzero(~spare)
    y = labels[learn]
    seen = np.zeros((2, BUCKETS), np.int32)
    for i in learn:
        seen[labels[i], bags[i][0]] += 1
    used = seen.sum(axis=0) >= min(LEAST_BAGS, len(learn))
    place = np.cumsum(used, dtype=np.int32) - 1
    sure = surely(seen[1][used], seen[0][used], int(y.sum()), int(len(y) - y.sum()))
    start = START * np.sign(sure) * np.maximum(np.abs(sure) - SURE, 0)
    kept = [used[bags[i][0]] for i in learn]
    rows, values = [place[bags[i][0][k]] for i, k in zip(learn, kept, strict=True)], [bags[i][1][k] for i, k in zip(learn, kept, strict=True)]
    rate = RATE / max(1e-3, float(np.median([SCALE**2 * (v.astype(np.float64) ** 2).sum() for v in values])))
    with np.errstate(over="ignore", invalid="ignore"):
        found = descend(rows, values, y, start, rate)
        while not all(np.isfinite(x).all() for x in found):  # too fast for these texts
            rate /= 2
            found = descend(rows, values, y, start, rate)
    embeddings = none
    embeddings[used] = found[0]
    model = Model(embeddings, found[1], found[2])
    held = np.flatnonzero(spare) if spare.any() else learn
    margins, t = model.row_margins(), labels[held]
    z = np.array([float(margins[bags[i][0]] @ bags[i][1]) for i in held]) + found[2][1] - found[2][0]
    weigh = np.where(t == 1, odds / (1 + odds) / t.mean(), 1 / (1 + odds) / (1 - t.mean()))
    slope, offset = 1.0, 0.0
    for _ in range(50):  # Newton's method on the weighted log loss, drawn a little towards slope 1
        p = 1 / (1 + np.exp(-np.clip(slope * z + offset, -40, 40)))
        g = np.array([(weigh * (p - t) * z).mean() + 1e-2 * (slope - 1), (weigh * (p - t)).mean() + 1e-6 * offset])
        w = weigh * p * (1 - p)
        h = np.array([[(w * z * z).mean() + 1e-2, (w * z).mean()], [(w * z).mean(), w.mean() + 1e-6]])
        move = np.linalg.solve(h, g)
        move *= min(1.0, 1.0 / max(1e-12, np.abs(move).max()))
        slope, offset = max(1e-3, slope - move[0]), offset - move[1]
    return Model(embeddings, slope * found[1], slope * found[2] + [0.0, offset])


def train(docs: DataFrame, labels: DataFrame, usable: F.Column, max_per_label: int = MAX_PER_LABEL, max_entries: int = MAX_ENTRIES) -> Model:
    """A model from the labelled documents for which ``usable`` (of doc_id) holds."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(usable)
    labelled = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & usable)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .join(own.select("doc_id"), "doc_id", "left_semi")
    )
    counts = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    odds = counts.get(1, 0) / counts[0] if counts.get(0) else (np.inf if counts.get(1) else 0.0)
    if not 0 < odds < np.inf:
        return fit([], np.zeros(0, np.int64), np.zeros(0, bool), odds)
    chosen = {}
    for label in (0, 1):
        some = labelled.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_label)
        chosen |= {r["doc_id"]: (label, k) for k, r in enumerate(some.collect())}
    spark = docs.sparkSession
    small = spark.createDataFrame([(i, *x) for i, x in chosen.items()], "id long, toxic int, place int")  # at most max_per_label rows of each

    @F.arrow_udf("struct<rows:array<int>,weights:array<float>>")
    def packed(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [*bags(batch)]
            offsets = np.concatenate([[0], np.cumsum([len(r) for r, _ in found])]).astype(np.int32)
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, np.concatenate([np.zeros(0, t), *(f[j] for f in found)])) for j, t in ((0, np.int32), (1, np.float32))], names=["rows", "weights"])
        release_memory()

    kept = own.join(F.broadcast(small), F.col("doc_id") == F.col("id")).groupBy("id", "toxic", "place").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    found = stored(kept.select("toxic", "place", packed("text").alias("bag")), "toxicity-bags")
    sizes = found.select("toxic", "place", F.size("bag.rows").alias("n")).orderBy("place", "toxic").collect()
    total, limit = 0, 1
    for r in sizes:
        total += r["n"]
        if total <= max_entries:
            limit = r["place"] + 1
    rows = found.where(F.col("place") < limit).orderBy("place", "toxic").select("toxic", "place", "bag.rows", "bag.weights").toArrow()
    spare = np.array([zlib.crc32(f"spare {k}".encode()) % 5 == 0 for k in rows.column("place").to_pylist()], bool)
    both = [[rows.column(c)[i].values.to_numpy() for i in range(len(rows))] for c in ("rows", "weights")]
    return fit([*zip(*both, strict=True)], rows.column("toxic").to_numpy().astype(np.int64), spare, odds)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns and the probability of label 1 for each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.row_margins().astype(np.float32), float(model.offsets[1] - model.offsets[0])))

    @F.arrow_udf("double")
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        rows, offset = shared.value
        for batch in texts:
            found = np.concatenate([np.zeros(0), *mean_margins(rows, batch)])
            with np.errstate(over="ignore"):
                yield pa.array(1 / (1 + np.exp(-(found + offset))), pa.float64())
        release_memory()

    return docs.withColumn(score_col, scores(F.col(f"`{text_col}`").cast("string")))


def held_out(doc_id: F.Column) -> F.Column:
    """Rows that never train; the remainder of a null id is that of an empty text's crc32."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def scored_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    model = train(docs, labels, ~held_out(F.col("doc_id")))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
