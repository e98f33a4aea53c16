"""Operator 3: document fingerprints as bottom-k sketches of shingle hashes.

A text's shingles are its runs of five words (all of its words as one, if it has fewer).
Its sketch is the k smallest distinct 64-bit hashes of them, with whether there were more.
Sketches merge: the k smallest of the union of two sketches are the sketch of the joined
shingle sets, whichever parts they came from. From two sketches:

* resemblance: of the k smallest hashes of the union, the share that both have;
* distinct shingles: the count itself up to k, else (k - 1) / (largest hash as a share of the range);
* containment of a in b: the shared count (resemblance times the union's count) over a's count.

Edge cases: null counts as empty; an empty text has the empty sketch; two empty sketches are
alike (1.0), an empty and another one are not (0.0). Further columns are not read.

``edited_pairs`` walks over the documents in descending id, each with its next one. Whole
texts are shuffled once: ids are dealt to ranges by quantiles, and the first document of each
range goes to the range before it as well. Null ids come last; documents of one id follow
each other by text. With a single document, it is its own next one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import WORD, tidy

SKETCH = 128
SHINGLE = 5

_words = re.compile(WORD).findall
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], np.uint64)
_MASK = (1 << 64) - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """word -> 64-bit hash; keeps a bounded number of words."""

    def __missing__(self, word: str) -> int:
        h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        if len(self) < 100_000:
            self[word] = h
        return h


_hashes = WordHashes()


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the shingles, in order, repeats included."""
    words = _words(text) if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    if len(h) < width:
        total = 0
        for x in h.tolist():
            total = (total * 0x9E3779B97F4A7C15 + x) & _MASK
        return mixed(np.array([total ^ len(h)], np.uint64))
    n = len(h) - width + 1
    out = h[:n] * _MULTIPLIERS[0]
    for j in range(1, width):
        out = (out ^ (out >> np.uint64(29))) * _MULTIPLIERS[j % 7] + h[j : j + n]
    return mixed(out)


def sketch(hashes: np.ndarray, k: int = SKETCH) -> np.ndarray:
    """The k smallest distinct hashes, ascending, and a last 1 or 0: whether there were more."""
    low = hashes
    if len(hashes) > 8 * k:  # repeats are few as a rule: look among the smallest first
        low = np.partition(hashes, 4 * k)[: 4 * k]
        if len(np.unique(low)) <= k:
            low = hashes
    low = np.unique(low)
    more = len(low) > k or len(low) == k and len(np.unique(hashes)) > k
    return np.append(low[:k], np.uint64(more))


def merge(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> np.ndarray:
    both = np.union1d(a[:-1], b[:-1])
    return np.append(both[:k], np.uint64(len(both) > k or a[-1] or b[-1]))


def distinct(a: np.ndarray) -> float:
    """Estimated number of distinct shingles; exact up to k."""
    n = len(a) - 1
    return float(n) if not a[-1] else (n - 1) / ((float(a[-2]) + 1) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> float:
    if len(a) == 1 or len(b) == 1:
        return float(len(a) == len(b))
    x, y = a[:-1], b[:-1]
    union = np.union1d(x, y)
    if a[-1] or b[-1]:  # only what is smaller than all that either sketch left out
        limit = min(int(s[-2]) for s in (a, b) if s[-1])
        union = union[union <= np.uint64(limit)]
    union = union[:k]
    return float(np.isin(union, np.intersect1d(x, y, assume_unique=True), assume_unique=True).sum() / len(union))


def containment(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> float:
    """Estimated share of a's shingles that b has."""
    if len(a) == 1:
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k)) / distinct(a))


def as_text(a: np.ndarray) -> str:
    """k hashes in hex, and '+' if there were more."""
    return a[:-1].astype(">u8").tobytes().hex() + "+" * int(a[-1])


def from_text(s: str) -> np.ndarray:
    return np.append(np.frombuffer(bytes.fromhex(s.rstrip("+")), ">u8").astype(np.uint64), np.uint64(s.endswith("+")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SKETCH, width: int = SHINGLE) -> DataFrame:
    """The id, the fingerprint and the estimated number of distinct shingles of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ = [sketch(shingle_hashes(t, width), k) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(as_text, all_), pa.string()), pa.array(map(distinct, all_), pa.float64())], names=["id", "fingerprint", "shingles"])

    source = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return source.mapInArrow(tidy(run), f"id {source.dtypes[0][1]}, fingerprint string, shingles double").withColumnRenamed("id", id_col)


def merged(prints: DataFrame, by: list[str], fingerprint_col: str = "fingerprint", k: int = SKETCH) -> DataFrame:
    """One fingerprint for each key, of all the texts together; combined before and after the shuffle.

    The hashes go through plain rows: distinct ones are ranked by key, first inside each
    input partition, so a hot key sends k rows for each partition.
    """
    from pyspark.sql import Window

    keys = [F.col(f"`{c}`") for c in by]
    full = F.col(f"`{fingerprint_col}`")
    rows = prints.select(*keys, full.endswith("+").alias("more"), F.explode_outer(F.when(F.length(full) < 16, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(0), (F.length(full) / 16).cast("int") - 1), lambda i: F.substring(full, i * 16 + 1, F.lit(16))))).alias("hash"))
    rows = rows.withColumn("part", F.spark_partition_id())
    for place in ([F.col("part")], []):
        small = rows.groupBy(*keys, *place, "hash").agg(F.max("more").alias("more"))
        order = Window.partitionBy(*keys, *place).orderBy(F.col("hash").asc_nulls_last())
        rows = small.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
    out = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(F.col("rank") <= k, F.col("hash")))).alias("h"), (F.max("more") | (F.count("hash") > k)).alias("more"))
    return out.select(*keys, F.concat(F.array_join("h", ""), F.when(F.col("more"), "+").otherwise("")).alias(fingerprint_col))


def edited(text: str, following: str) -> str:
    """The last third of a text (rounded down) gives way to the first as many code points of the next one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SKETCH) -> DataFrame:
    """Each document's fingerprint and that of its edited text, and their likeness to each other and to the next document's."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # range 0 has the largest ids; a few numbers for each range come to the driver
    steps = [i / parts for i in range(1, parts)]
    found = d.agg(F.percentile_approx("id", steps, 10_000).alias("q")).first()["q"] if steps else None
    bounds = np.array(sorted(set(found or [])), np.int64)

    @F.arrow_udf("int")
    def range_of(ids: pa.Array) -> pa.Array:
        place = len(bounds) - np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), side="left")
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), len(bounds) + 1, place), pa.int32())

    ranges = d.select("id", range_of("id").alias("range"))
    used = sorted((r["range"], r["first"]) for r in ranges.groupBy("range").agg(F.max("id").alias("first")).collect())
    if not used:
        return spark.createDataFrame([], _RESULT.replace("id long", f"`{id_col}` long"))
    before = {r: used[i - 1][0] for i, (r, _) in enumerate(used)}  # the first range follows the last one
    heads = {first: before[r] for r, first in used if first is not None}
    null_head = next((before[r] for r, first in used if first is None), None)
    last = used[-1][0]
    keys = np.array(sorted(heads), np.int64)
    goes = np.array([heads[x] for x in sorted(heads)], np.int32)

    @F.arrow_udf("int")
    def also_in(ids: pa.Array) -> pa.Array:
        """The range before, of ids that are the first of theirs; else null."""
        v, none = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, v), len(keys) - 1)
            hit, to = keys[at] == v, goes[at]
        else:
            hit, to = np.zeros(len(v), bool), np.zeros(len(v), np.int32)
        if null_head is not None:
            hit, to = hit | none, np.where(none, null_head, to)
        else:
            hit = hit & ~none
        return pa.array(to, pa.int32(), mask=~hit)

    placed = d.withColumn("range", range_of("id")).withColumn("also", also_in("id"))
    # of several documents with a head's id, all go along; the first of them is the one that is used
    both = placed.select("id", "text", F.explode(F.when(F.col("also").isNull(), F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("tail")))).otherwise(
        F.array(F.struct(F.col("range").alias("range"), F.lit(0).alias("tail")), F.struct(F.col("also").alias("range"), F.lit(1).alias("tail"))))).alias("to"))
    both = both.select("id", "text", F.col("to.range").alias("range"), F.col("to.tail").alias("tail"))
    dealt = both.repartitionById(last + 1, F.col("range")).sortWithinPartitions("range", "tail", F.col("id").desc_nulls_last(), "text")
    return dealt.select("id", "text", "range", "tail").mapInArrow(tidy(_walk(k)), _RESULT).withColumnRenamed("id", id_col)


_RESULT = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _walk(k: int):
    def one(doc, following):
        (i, text, own), (_, other, its) = doc, following
        new = edited(text, other)
        changed = sketch(shingle_hashes(new), k)
        sha = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
        return i, len(text), sha, as_text(own), as_text(changed), resemblance(own, changed, k), resemblance(own, its, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by range, the tail after it; each document is done when its next one comes."""
        waiting, done, schema = None, [], None
        names = [f.split()[0] for f in _RESULT.split(", ")]

        def out(rows):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for i, text, tail in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if tail and waiting is None:
                    continue  # a further document of the tail's id
                now = (i, text, sketch(shingle_hashes(text), k))
                if waiting is not None:
                    done.append(one(waiting, now))
                waiting = None if tail else now
                if len(done) >= 256:
                    yield out(done)
                    done = []
        if done:
            yield out(done)

    return run
