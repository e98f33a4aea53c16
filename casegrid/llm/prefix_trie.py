"""Operator 12: prefix trie of conversations, its subtree totals by time-forward processing.

A node is a distinct sequence of first turns. Its name is a chained hash of them: conversations
are cut into bands of ``BAND`` turns, each band is chained on its own, and a node's name joins the
bands before it; so a conversation of any length is many tasks' work. A node is also told by its
smallest member and its depth, and those give its place in the order.

Totals over subtrees go from the deepest nodes up ("reverse level order"). A node's totals are a
message to its parent, which comes later in that order; the message waits in a priority queue,
ordered by the receiver's place, that spills sorted runs to the shared folder. So no tree is
held in memory.

The trie is cut into shards: connected pieces whose nodes lie in one band of depths and whose
members number alike (256 to the power k, and less than 256 times that: "tier"). A shard has at most 256
nodes of one depth, whatever the number of conversations. Shards of one tier and band don't depend on
each other; Spark sorts each by reverse level order and runs it in one pass. What their roots send
to nodes of other shards is summed for each receiver first, map-side, so a node with millions of
children gets one row. Tiers go from the smallest up, and in a tier bands from the deepest up:
a handful of rounds for usual conversations (the logarithm of their number to base 256, times
their length over ``BAND``).

The ids of the conversations that end at a node are joined in pieces of ``IDS`` by all tasks (a
node with a third of all ids is many pieces), and the pieces hashed one after the other.

Edge cases: rows without a conv_id belong to no conversation; null role or text is empty; rows
of one turn number are ordered by role and text, a null number comes first; repeated rows are
turns of their own; a conversation without turns is a member of the root alone; an empty table has no
nodes; further columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casegrid.llm.common import new_shared_dir, stored, tidy
from casegrid.llm.files import file_system, opened, written
from casegrid.operators.ordering import with_row_numbers

#: Depths of a band.
BAND = 1 << 16
#: Messages that a queue holds in memory.
QUEUE = 200_000
#: Conversation ids joined in one piece.
IDS = 1 << 16

ROOT = bytes(16)
_MESSAGE = np.dtype([("depth", "<i8"), ("conv_id", "<i8"), ("children", "<i8"), ("leaves", "<i8"), ("saved", "<i8")])


# --- conversations


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, role, text, last) and conversations (conv_id, turns) after rebuilding.

    Conversation c starts with the first h turns of conversation c - c % 5, h = crc32(c) % 9, and goes on with
    its own turns after its first h.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    ).where("conv_id IS NOT NULL")
    own = with_row_numbers(turns, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "n", ["conv_id"])
    own = stored(own.select("conv_id", F.col("n").cast("long").alias("n"), "role", "text"), "turns")
    sizes = own.groupBy("conv_id").agg(F.count("*").alias("own"))
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    base_sizes = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("of_base"))
    convs = sizes.withColumns({"h": head, "base": F.col("conv_id") - F.col("conv_id") % 5}).join(base_sizes, "base", "left")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("of_base", F.lit(0))))
    convs = stored(convs.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("turns")), "rebuilt")
    first = own.where("n <= 8").withColumnRenamed("conv_id", "base")
    taken = first.join(convs, "base").where("n <= h").select("conv_id", F.col("n").alias("depth"), "role", "text", "turns")
    rest = own.join(convs, "conv_id").where("n > h").select("conv_id", (F.col("taken") + F.col("n") - F.col("h")).alias("depth"), "role", "text", "turns")
    both = taken.unionByName(rest)
    return both.select("conv_id", "depth", "role", "text", (F.col("depth") == F.col("turns")).alias("last")), convs.select("conv_id", "turns")


# --- nodes


def named_turns(turns: DataFrame, band: int = BAND) -> DataFrame:
    """conv_id, depth, node (the name of the turns up to there), bytes (of the text), last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chain = None, b""
        for batch in batches:
            names, sizes = [], []
            for conv, part, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "band", "role", "text")), strict=True):
                if at != (conv, part):
                    at, chain = (conv, part), b""
                role, text = role.encode(), text.encode()
                chain = hashlib.sha256(chain + len(role).to_bytes(8, "little") + role + text).digest()
                names.append(chain[:16])
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "depth", "last", "band")), pa.array(names, pa.binary()), pa.array(sizes, pa.int64())],
                names=["conv_id", "depth", "last", "band", "chain", "bytes"])

    cut = turns.withColumn("band", F.floor((F.col("depth") - 1) / band).cast("long"))
    dealt = cut.repartition("conv_id", "band").sortWithinPartitions("conv_id", "band", "depth").select("conv_id", "depth", "last", "band", "role", "text")
    chained = stored(dealt.mapInArrow(tidy(run), "conv_id long, depth long, last boolean, band long, chain binary, bytes long"), "chains")
    # whole bands of a conversation: a row for each BAND turns
    whole = chained.where(F.col("depth") % band == 0).select(F.col("conv_id").alias("of"), (F.col("band") + 1).alias("next"), "chain")
    upto = Window.partitionBy("of").orderBy("next")
    before = whole.select("of", "next", F.array_join(F.transform(F.collect_list("chain").over(upto), F.hex), "").alias("before"))
    named = chained.join(before, (F.col("of") == F.col("conv_id")) & (F.col("next") == F.col("band")), "left")
    node = F.when(F.col("band") == 0, F.col("chain")).otherwise(F.unhex(F.md5(F.concat_ws("-", "before", F.hex("chain")).cast("binary"))))
    return named.select("conv_id", "depth", "last", node.alias("node"), "bytes")


def nodes(named: DataFrame, convs: DataFrame, band: int = BAND) -> DataFrame:
    """Nodes with parent, members, and tier, band and shard; ``named`` and ``convs`` are stored tables."""
    known = named.groupBy("node").agg(F.min("conv_id").alias("smallest"), F.count("*").alias("n_convs"))
    tier = F.floor((F.length(F.hex("n_convs")) - 1) / 2).cast("int")  # 256 to its power is the largest not above n_convs
    rows = named.join(known, "node").withColumns({"tier": tier, "band": F.floor(F.col("depth") / band).cast("long"), "next": F.lit(False)})
    # the last turn of a band stands before the next band too, as its first turn's parent
    over = rows.where((F.col("depth") + 1) % band == 0).withColumns({"band": F.col("band") + 1, "next": F.lit(True)})
    path = Window.partitionBy("conv_id", "band").orderBy("depth")
    piece = Window.partitionBy("conv_id", "band", "tier")
    placed = rows.unionByName(over).withColumns({
        "parent": F.lag("node").over(path), "parent_conv_id": F.lag("smallest").over(path),
        "shard": F.min(F.when(~F.col("next"), F.struct("depth", "node"))).over(piece)["node"],
    })
    own = placed.where("NOT next AND conv_id = smallest")
    top = convs.agg(F.min("conv_id").alias("smallest"), F.count("*").alias("n_convs")).where("n_convs > 0")
    columns = ["conv_id", "depth", "node", "parent", "parent_conv_id", "n_convs", "bytes", "tier", "band", "shard"]
    root = top.select(
        F.col("smallest").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"),
        F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.lit(0).cast("long").alias("bytes"), F.lit(127).alias("tier"),  # the last round
        F.lit(0).cast("long").alias("band"), F.lit(ROOT).alias("shard"))
    least = top.select("smallest").first()
    of_root = F.col("depth") == 1
    own = own.withColumns({
        "parent": F.when(of_root, F.lit(ROOT)).otherwise(F.col("parent")),
        "parent_conv_id": F.when(of_root, F.lit(least[0] if least else None).cast("long")).otherwise(F.col("parent_conv_id"))})
    return own.select(columns).unionByName(root)


# --- totals


class SpillingQueue:
    """Messages ordered by their receiver's place (depth from the largest, then conv_id); all but ``limit`` lie in sorted runs in ``folder``."""

    def __init__(self, folder: str, limit: int):
        self._folder, self._limit = folder, limit
        self._heap: list[tuple[int, int, int, int, int]] = []
        self._runs: list[tuple[tuple[int, int, int, int, int], int, Iterator]] = []
        self.files: list[str] = []

    def push(self, depth: int, conv_id: int, children: int, leaves: int, saved: int) -> None:
        heapq.heappush(self._heap, (-depth, conv_id, children, leaves, saved))
        if len(self._heap) > self._limit:
            name = f"run-{uuid.uuid4().hex}"
            with written(self._folder, name) as out:
                self._heap.sort()
                out.write(np.array(self._heap, _MESSAGE).tobytes())
            self._heap = []
            self.files.append(f"{self._folder}/{name}")
            self._advance(len(self.files), self._read(self.files[-1]))

    @staticmethod
    def _read(path: str) -> Iterator[tuple[int, int, int, int, int]]:
        with opened(path) as f:
            while data := f.read(4096 * _MESSAGE.itemsize):
                yield from np.frombuffer(data, _MESSAGE).tolist()

    def _advance(self, number: int, run: Iterator) -> None:
        for message in run:
            heapq.heappush(self._runs, (message, number, run))
            break

    def take(self, depth: int, conv_id: int) -> tuple[int, int, int]:
        """The sums of all messages to this place, which must not come after any that is waiting."""
        key, children, leaves, saved = (-depth, conv_id), 0, 0, 0
        while self._heap and self._heap[0][:2] == key:
            m = heapq.heappop(self._heap)
            children, leaves, saved = children + m[2], leaves + m[3], saved + m[4]
        while self._runs and self._runs[0][0][:2] == key:
            m, number, run = heapq.heappop(self._runs)
            children, leaves, saved = children + m[2], leaves + m[3], saved + m[4]
            self._advance(number, run)
        return children, leaves, saved

    def close(self) -> None:
        """Deletes the runs; none may be left unread."""
        if self._heap or self._runs:
            raise ValueError("messages without a receiver")
        for path in self.files:
            system, name = file_system(path)
            system.delete_file(name)
        self.files = []


def time_forward(folder: str, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Totals of whole shards, each in reverse level order, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, shard = SpillingQueue(folder, limit), None
        names = ["shard", "node", "depth", "conv_id", "parent_conv_id", "n_convs", "bytes", "children", "leaves", "saved"]
        for batch in batches:
            totals = []
            for of, node, depth, conv, parent, n, size, children, leaves, saved in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if of != shard:
                    queue.close()
                    shard = of
                more = queue.take(depth, conv)
                children, leaves, saved = children + more[0], leaves + more[1], saved + more[2] + (n - 1) * size
                leaves = leaves if children else 1
                totals.append((children, leaves, saved))
                if node != of:
                    queue.push(depth - 1, parent, 1, leaves, saved)
            found = zip(*totals, strict=True) if totals else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("node", "parent", "shard", "conv_id", "depth", "parent_conv_id", "n_convs")), *(pa.array(x, pa.int64()) for x in found)],
                names=["node", "parent", "shard", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"])
        queue.close()

    return run


def subtree_totals(found: DataFrame, limit: int = QUEUE) -> DataFrame:
    """n_children, n_leaves and saved_tokens of each node; ``found`` is a stored table of nodes."""
    spark = found.sparkSession
    folder = new_shared_dir(spark, "trie-queues")
    schema = "node binary, parent binary, shard binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    rounds = sorted((r["tier"], -r["band"]) for r in found.select("tier", "band").distinct().collect())  # few, as the module says
    done = spark.createDataFrame([], schema)
    for tier, band in rounds:
        sent = done.where("node = shard AND parent IS NOT NULL").groupBy(F.col("parent").alias("to"))
        sent = sent.agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        some = found.where((F.col("tier") == tier) & (F.col("band") == -band))
        some = some.join(sent, F.col("node") == F.col("to"), "left").fillna(0, ["children", "leaves", "saved"]).drop("to", "tier", "band")
        dealt = some.repartition("shard").sortWithinPartitions("shard", F.col("depth").desc(), "conv_id")
        done = done.unionByName(stored(dealt.mapInArrow(tidy(time_forward(folder, limit)), schema), f"trie-{tier}-{-band}"))
    return done


def end_digests(ends: DataFrame, ids: int = IDS) -> DataFrame:
    """node and the SHA-256 of the ids of its rows, ascending, with commas between."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, held = None, []

        def piece():
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([held[0]]), pa.array([",".join(map(str, held))], pa.large_string()).cast(pa.string())], names=["node", "first", "ids"])

        for batch in batches:
            for n, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (n != node or len(held) >= ids):
                    yield piece()
                    held = []
                node = n
                held.append(conv)
        if held:
            yield piece()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for n, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if n != node:
                    if state is not None:
                        out.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())], names=["node", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    dealt = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = dealt.mapInArrow(tidy(pieces), "node binary, first long, ids string")
    return joined.repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(tidy(hashed), "node binary, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, band: int = BAND, limit: int = QUEUE) -> DataFrame:
    """A row for each node of the conversations' trie: smallest member, depth, parent's smallest member, members, children, leaves, bytes saved, and the digest of the conversations that end there.

    ``turns``: conv_id, depth (1, 2, ... without gaps), role, text, last; ``convs``: conv_id and turns of every conversation.
    """
    named = stored(named_turns(turns, band), "paths")
    totals = subtree_totals(stored(nodes(named, convs, band), "nodes"), limit)
    ends = named.where("last").select("node", "conv_id").unionByName(convs.where("turns = 0").select(F.lit(ROOT).alias("node"), "conv_id"))
    digests = end_digests(ends).withColumnRenamed("node", "at")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return totals.join(digests, F.col("node") == F.col("at"), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(*rebuilt_turns(conversations))


ORACLE = """
WITH RECURSIVE own AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
    FROM conversations WHERE conv_id IS NOT NULL
),
ids AS (SELECT conv_id, count(*) AS own, CAST(conv_id AS VARCHAR) AS name FROM own GROUP BY conv_id),
crc(conv_id, name, place, c) AS (
    SELECT conv_id, name, 1, 4294967295::BIGINT FROM ids
    UNION ALL
    SELECT conv_id, name, place + 1, list_reduce(
        list_prepend(xor(c, ascii(name[place])::BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)
    FROM crc WHERE place <= length(name)
),
heads AS (SELECT conv_id, xor(c, 4294967295::BIGINT) % 9 AS h, conv_id - conv_id % 5 AS base FROM crc WHERE place = length(name) + 1),
sized AS (
    SELECT heads.*, least(h, coalesce(ids.own, 0)) AS taken FROM heads LEFT JOIN ids ON ids.conv_id = heads.base
),
turns AS (
    SELECT s.conv_id, o.n AS depth, o.role, o.text FROM sized s JOIN own o ON o.conv_id = s.base AND o.n <= s.h
    UNION ALL
    SELECT s.conv_id, s.taken + o.n - s.h, o.role, o.text FROM sized s JOIN own o ON o.conv_id = s.conv_id AND o.n > s.h
),
whole AS (
    SELECT s.conv_id, coalesce(list({'r': t.role, 't': t.text} ORDER BY t.depth) FILTER (t.depth IS NOT NULL), []) AS turns
    FROM sized s LEFT JOIN turns t ON t.conv_id = s.conv_id GROUP BY s.conv_id
),
members AS (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM whole),
node AS (
    SELECT turns[:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ends
    FROM members GROUP BY turns[:depth], depth
),
linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id, coalesce((n.n_convs - 1) * strlen(n.path[n.depth].t), 0) AS saved,
           (SELECT count(*) FROM node k WHERE k.depth = n.depth + 1 AND k.path[:n.depth] = n.path) AS n_children
    FROM node n LEFT JOIN node p ON p.depth = n.depth - 1 AND p.path = n.path[:n.depth - 1]
),
below AS (SELECT path[:d] AS top, d, n_children, saved FROM (SELECT path, n_children, saved, unnest(range(depth + 1)) AS d FROM linked)),
sums AS (SELECT top, d, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM below GROUP BY top, d)
SELECT l.conv_id, l.depth, l.parent_conv_id, l.n_convs, l.n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(l.ends) AS ends_sha256
FROM linked l JOIN sums s ON s.d = l.depth AND s.top = l.path
"""
