"""Operator 6: near-duplicates by a chosen-path set similarity join, and their components.

A document's set is its distinct word shingles. Documents with equal sets are one from the
start (the smallest id stands for them). Each set has a MinHash signature.

Chosen paths: in each of several independent trees, a node picks some of the signature's
coordinates by a hash of its own path, and every set goes on to the child named by its value
there (its selected minwise shingle). Two sets of similarity J share such a child with
probability J for each coordinate picked. Nodes of up to ``node_sets`` sets are compared
exhaustively; larger ones branch again. What is still larger at the last level is cut into
blocks by hash, and every two blocks are compared, so no node is capped.

Comparing has two steps. On signatures, all pairs of a node are tried in memory and the node
falls apart into clusters of sets that could be similar; only memberships leave the task, no
pairs. On full sets, each different cluster's texts meet, links are confirmed by exact
counts, and stars (a set and the smallest one it is connected to) leave the task. A
cluster is held as one sorted array of 8-byte shingle hashes for each set; its texts are
turned into these as they arrive. The components of all stars follow from label propagation
with pointer jumping; every round is written to the shared folder.

Rows are told apart by a key of their own, a hash of id and text, so that null and repeated
ids join with nothing but their own texts.

Recall: with ``TREES * FIRST`` = 8 coordinates picked at the roots, a pair of similarity 0.8
shares no node with probability 0.2^8 = 3e-6 (with two further levels of two picks each:
1.4e-5); the signature's estimate misses a pair of similarity 0.8 if it errs by more than
4.5 standard deviations. Both are far smaller above 0.8, and a component needs only some of
its links.

Edge cases: null and empty texts, and texts without words, have empty sets and are linked
with nothing; with fewer words than a shingle has, the whole sequence is the one shingle;
repeated rows are linked as copies; rows with a null id are linked too, but never name a
component (it is null where there are no others, and such rows are kept); rows of one id and
several texts are linked each by its own text; an empty table gives an empty result; further
columns are not read. ``representatives`` keeps one row of each component, whatever its ids.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import ascii_lower, free_name, stored, tidy
from casegrid.llm.fingerprints import shingle_hashes

SIGNATURE = 128
TREES, FIRST, LATER, LEVELS = 4, 2, 2, 3

#: A node or cluster of so many sets is compared in one task; its signatures take 1 MB.
NODE_SETS = 2048

_draw = np.random.default_rng(6)
_A = (_draw.integers(0, 1 << 32, SIGNATURE, np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _draw.integers(0, 1 << 32, SIGNATURE, np.uint64).astype(np.uint32)
_UPPER = re.compile("[A-Z]+")


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a lower-cased (A-Z) text."""
    return np.unique(shingle_hashes(text, width)) if text else np.empty(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(SIGNATURE, 0xFFFFFFFF, np.uint32)
    h = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    for at in range(0, len(h), 1024):
        v = h[at : at + 1024, None] * _A
        v ^= _B
        np.minimum(low, v.min(axis=0), out=low)
    return low


def _key(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"|".join(parts), digest_size=8).digest(), "little", signed=True)


def _picked(path: int, count: int) -> list[int]:
    """The coordinates that a node picks."""
    found: list[int] = []
    h = path & ((1 << 64) - 1)
    while len(found) < count:
        h = (h * 6364136223846793005 + 1442695040888963407) % (1 << 64)
        c = (h >> 33) % SIGNATURE
        if c not in found:
            found.append(c)
    return found


def _children(path: int, values: np.ndarray, count: int) -> list[int]:
    return [_key(path.to_bytes(8, "little", signed=True), c.to_bytes(2, "little"), values[c].tobytes()) for c in _picked(path, count)]


def row_key(id_col: str = "doc_id", text_col: str = "text") -> F.Column:
    """A hash of id and text: never null, and the same for rows that repeat both."""
    text = F.col(f"`{text_col}`").cast("string")
    name = F.coalesce(F.col(f"`{id_col}`").cast("long").cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(name, F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), text))).cast("binary")))


def sketches(docs: DataFrame, width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, doc_id, n (set size), set (hash of the whole set), sig and the root's children of each document, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = []
                for t in batch.column(2).to_pylist():
                    s = shingle_set(t, width)
                    if not len(s):
                        rows.append((0, None, None, None))
                        continue
                    sig = signature(s)
                    paths = [p for tree in range(TREES) for p in _children(_key(b"tree", bytes([tree])), sig, FIRST)]
                    rows.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), sig.tobytes(), paths))
                n, sets, sigs, paths = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(sigs, pa.binary()), pa.array(paths, pa.list_(pa.int64()))], names=["key", "doc_id", "n", "set", "sig", "paths"])

    d = docs.select(row_key(id_col, text_col).alias("key"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), ascii_lower(F.col(f"`{text_col}`").cast("string")).alias("text"))
    return stored(d.mapInArrow(tidy(run), "key binary, doc_id long, n long, set binary, sig binary, paths array<long>"), "sketches")


def _branch(rows: DataFrame) -> DataFrame:
    """(path, set, n, sig) of large nodes -> the same of their children."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = [np.frombuffer(s, np.uint32) for s in batch.column(3).to_pylist()]
            down = [_children(p, s, LATER) for p, s in zip(batch.column(0).to_pylist(), sigs, strict=True)]
            take = pa.array([i for i, c in enumerate(down) for _ in c], pa.int64())
            rest = [batch.column(k).take(take) for k in (1, 2, 3)]
            yield pa.RecordBatch.from_arrays([pa.array([x for c in down for x in c], pa.int64()), *rest], names=["path", "set", "n", "sig"])

    return rows.mapInArrow(tidy(run), rows.schema)


def _sized(members: DataFrame) -> DataFrame:
    counts = members.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return members.join(counts, "path")


def nodes(sets: DataFrame, node_sets: int) -> DataFrame:
    """(path, set, n, sig): every node that is to be compared, with at most ``node_sets`` sets."""
    signed = sets.select("set", "n", "sig")
    level = stored(_sized(sets.select(F.explode("paths").alias("path"), "set").distinct()), "level")
    out = []
    for depth in range(1, LEVELS + 1):
        small = level.where(F.col("size") <= node_sets).select("path", "set")
        out.append(small.join(signed, "set").select("path", "set", "n", "sig"))
        large = level.where(F.col("size") > node_sets)
        if depth == LEVELS or large.isEmpty():
            break
        branched = _branch(large.join(signed, "set").select("path", "set", "n", "sig"))
        level = stored(_sized(branched.select("path", "set").distinct()), "level")
    if depth == LEVELS:
        # two half-size blocks of a node meet in a node of their own
        blocks = F.ceil(F.col("size") * 3 / node_sets).cast("int")
        mine = F.pmod(F.xxhash64("set"), blocks).cast("int")
        cut = large.select("path", "set", blocks.alias("blocks"), mine.alias("mine"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
        cut = cut.select("path", "set", "mine", other).select(F.xxhash64("path", F.least("mine", "other"), F.greatest("mine", "other")).alias("path"), "set")
        out.append(cut.join(signed, "set").select("path", "set", "n", "sig"))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


class Forest:
    """Union-find over 0..n-1; the root is the smallest member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def _near(sigs: np.ndarray, sizes: np.ndarray, least: float, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each i, the j > i whose size and estimated similarity allow a link, and the estimates."""
    for i in range(len(sigs) - 1):
        same = (sigs[i + 1 :] == sigs[i]).sum(axis=1)
        estimate = (same / SIGNATURE - 1 / 256) * (256 / 255)
        ok = (estimate >= least) & (100 * np.minimum(sizes[i], sizes[i + 1 :]) >= percent * np.maximum(sizes[i], sizes[i + 1 :]))
        j = np.flatnonzero(ok)
        if len(j):
            yield i, j + i + 1, estimate[j]


def least_estimate(percent: int) -> float:
    j = percent / 100
    return j - 4.5 * math.sqrt(j * (1 - j) / SIGNATURE)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows that follow each other with the same first column, without that column."""
    key, rows = None, []
    for batch in batches:
        for k, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != key and rows:
                yield rows
                rows = []
            key = k
            rows.append(tuple(row))
    if rows:
        yield rows


def clusters(members: DataFrame, percent: int) -> DataFrame:
    """(cluster, set): the sets of a node that signatures connect; equal clusters once."""
    least = least_estimate(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, bytes]] = []
        for rows in _groups(batches):
            sets = [r[0] for r in rows]
            sigs = np.array([np.frombuffer(r[2], np.uint32) for r in rows]).astype(np.uint8)
            forest = Forest(len(rows))
            for i, js, _ in _near(sigs, np.array([r[1] for r in rows]), least, percent):
                for j in js.tolist():
                    forest.join(i, j)
            found: dict[int, list[bytes]] = {}
            for i, s in enumerate(sets):
                found.setdefault(forest.root(i), []).append(s)
            for group in found.values():
                if len(group) > 1:
                    name = hashlib.blake2b(b"".join(sorted(group)), digest_size=16).digest()
                    out += [(name, s) for s in group]
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], names=["cluster", "set"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], names=["cluster", "set"])

    together = members.repartition(F.col("path")).sortWithinPartitions("path")
    return together.mapInArrow(tidy(run), "cluster binary, set binary").distinct()


def _common(small: np.ndarray, large: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays of distinct hashes."""
    at = np.searchsorted(large, small)
    return int((large[np.minimum(at, len(large) - 1)] == small).sum())


def links(found: DataFrame, percent: int, width: int) -> DataFrame:
    """(a, b): each set of a cluster with the smallest set that confirmed links connect it to; ``found`` has cluster, set, sig, text."""
    least = least_estimate(percent)

    def stars(sets: dict[bytes, tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[bytes, bytes]]:
        names = sorted(sets)
        arrays = [sets[s][0] for s in names]
        sizes = np.array([len(x) for x in arrays])
        near = [(np.full(len(j), i, np.int32), j.astype(np.int32), e) for i, j, e in _near(np.array([sets[s][1] for s in names]), sizes, least, percent)]
        i, j, e = (np.concatenate(x) for x in zip(*near, strict=True)) if near else (np.zeros(0, np.int32),) * 3
        best = np.argsort(-e, kind="stable")
        forest = Forest(len(names))
        for a, b in zip(i[best].tolist(), j[best].tolist(), strict=True):
            if forest.root(a) == forest.root(b):
                continue
            small, large = (a, b) if sizes[a] <= sizes[b] else (b, a)
            common = _common(arrays[small], arrays[large])
            if 100 * common >= percent * (int(sizes[a]) + int(sizes[b]) - common):
                forest.join(a, b)
        return ((names[forest.root(x)], names[x]) for x in range(len(names)) if forest.root(x) != x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cluster, sets, out = None, {}, []
        for batch in batches:
            for row in range(batch.num_rows):  # one text at a time becomes its array
                of, name, sig, text = (c[row].as_py() for c in batch.columns)
                if of != cluster:
                    out += stars(sets) if sets else ()
                    cluster, sets = of, {}
                if name not in sets:
                    sets[name] = (shingle_set(text, width), np.frombuffer(sig, np.uint32).astype(np.uint8))
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], names=["a", "b"])
                out = []
        out += stars(sets) if sets else ()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], names=["a", "b"])

    together = found.repartition(F.col("cluster")).sortWithinPartitions("cluster")
    return together.select("cluster", "set", "sig", "text").mapInArrow(tidy(run), "a binary, b binary").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every end of an edge: the smallest vertex that it is connected to.

    Every round takes the smallest root among the neighbours, then the root's root.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    at = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("a"), F.min("b")).alias("root")), "roots")
    while True:
        lower = both.join(at, both["b"] == at["v"]).groupBy("a").agg(F.min("root").alias("low"))
        near = at.join(lower, at["v"] == lower["a"]).select("v", F.least("root", "low").alias("root"), F.col("root").alias("old"))
        near = stored(near, "roots")
        top = near.select(F.col("v").alias("r"), F.col("root").alias("top"))
        new = stored(near.join(top, near["root"] == top["r"]).select("v", F.least("root", "top").alias("root"), (F.least("root", "top") != F.col("old")).alias("moved")), "roots")
        if new.where("moved").isEmpty():
            return new.select("v", "root")
        at = new.select("v", "root")


def grouped(docs: DataFrame, percent: int = 80, width: int = 5, node_sets: int = NODE_SETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, doc_id, n (set size), root (a set of the row's component; null for the empty set) and component (its smallest id) of each row."""
    known = sketches(docs, width, id_col, text_col)
    filled = known.where("n > 0")
    one = filled.groupBy("set").agg(F.min("doc_id").alias("first"), F.min("key").alias("key"))  # copies
    # the signature of a set is that of any of its documents
    rest = filled.join(one.select(F.col("key").alias("k")), F.col("key") == F.col("k"), "left_semi").dropDuplicates(["key"]).select("key", "n", "sig", "paths")
    distinct = stored(one.join(rest, "key").select("set", "first", "key", "n", "sig", "paths"), "sets")
    near = stored(clusters(nodes(distinct, node_sets), percent), "clusters")
    wanted = near.join(distinct.select("set", "key", "sig"), "set")
    texts = docs.select(row_key(id_col, text_col).alias("key"), ascii_lower(F.col(f"`{text_col}`").cast("string")).alias("text"))
    # only the texts that a cluster wants move on, rows that repeat id and text once
    texts = texts.join(wanted.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    edges = stored(links(wanted.join(texts, "key").select("cluster", "set", "sig", "text"), percent, width), "links")
    roots = components(edges)
    placed = distinct.select("set", "first").join(roots.withColumnRenamed("v", "set"), "set", "left").select("set", "first", F.coalesce("root", "set").alias("root"))
    names = placed.groupBy("root").agg(F.min("first").alias("component"))
    named = placed.join(names, "root").select(F.col("set").alias("s"), "root", "component")
    return known.select("key", "doc_id", "n", "set").join(named, F.col("set") == F.col("s"), "left").select("key", "doc_id", "n", "root", "component")


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = 5, node_sets: int = NODE_SETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row."""
    out = grouped(docs, percent, width, node_sets, id_col, text_col)
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def representatives(docs: DataFrame, percent: int = 80, width: int = 5, node_sets: int = NODE_SETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay if one of each component does.

    It is the row with the smallest id (a null id only where there is no other), among several rows of that id the
    one with the smallest key. Rows of the empty set all stay. Rows that repeat id and text stand once, by any of them.
    """
    found = stored(grouped(docs, percent, width, node_sets, id_col, text_col).select("key", "doc_id", "n", "root"), "grouped")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key"))
    kept = found.where("n > 0").groupBy("root").agg(best.alias("best")).select("best.key").unionByName(found.where("n = 0").select("key"))
    name = free_name(docs, "row_key")
    mine = free_name(docs, "kept_key")
    out = docs.withColumn(name, row_key(id_col, text_col)).join(kept.select(F.col("key").alias(mine)), F.col(name) == F.col(mine), "left_semi")
    return out.dropDuplicates([name]).drop(name)
