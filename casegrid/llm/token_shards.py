"""Operator 9: token ids as binary shards with a minimal perfect hash index.

Documents in ascending key order are range-partitioned; each partition encodes its texts
and writes one shard file:

    payload    the ids end to end, unsigned little-endian, 2 bytes each (4 if the vocabulary needs it)
    records    for each document in order: key, first id in the shard, number of ids
    levels     bit arrays of the minimal perfect hash, with running counts of set bits
    slots      for each key's hash: its first record, and a fingerprint of the key
    footer     counts and section sizes

The hash function: keys are hashed into a bit array of twice their number; those that are
alone at their bit are placed there, the others go to the next, smaller array, until none
is left. A key's slot is the number of set bits before its own. So looking up a key takes a
few hashes, one slot and one range read, whatever the shard's size; a key that isn't there
is told by the fingerprint (and surely by the record's key). Equal keys share a slot and
stand together in the records.

A task keeps one shard's records in memory, not its ids, which go to the file as they come.
Files get their name when they are whole, so a repeated task writes the same file again.

Edge cases: null texts are empty documents (the end id alone); null keys come last, in the
order of their texts, and are in the records but not in the index; an empty table has no
shards; further columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casegrid.llm.common import new_shared_dir, tidy
from casegrid.llm.files import opened, read_at, written
from casegrid.llm.fingerprints import mixed
from casegrid.llm.pretokens import JoinedEncoder, ragged

MAGIC = b"IDSHARD1"
#: magic, bytes of an id, records, keys, ids, levels
_FOOTER = struct.Struct("<8sIQQQI")
RECORD = np.dtype([("key", "<i8"), ("null", "<u4"), ("start", "<u8"), ("count", "<u8")])
SLOT = np.dtype([("record", "<u4"), ("fingerprint", "<u4")])
#: Set bits are counted at every so many bits.
_STEP = 512


def _hash(keys: np.ndarray, level: int) -> np.ndarray:
    seed = 0x9E3779B97F4A7C15 * (2 * level + 1) % (1 << 64)
    return mixed(keys.astype(np.int64).view(np.uint64) ^ np.uint64(seed))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, levels: list[np.ndarray]):
        """levels: packed bits, each a multiple of _STEP long."""
        self.levels = levels
        self._counts, total = [], 0
        for bits in levels:
            each = np.bitwise_count(bits).reshape(-1, _STEP // 8).sum(axis=1, dtype=np.int64)
            self._counts.append(total + np.cumsum(each) - each)
            total += int(each.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = -(-2 * len(left) // _STEP) * _STEP
            place = (_hash(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[place]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot; -1 for some of the keys that aren't there."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, counts) in enumerate(zip(self.levels, self._counts, strict=True)):
            place = (_hash(keys[left], level) % np.uint64(8 * len(bits))).astype(np.int64)
            hit = bits[place >> 3] >> (place & 7).astype(np.uint8) & 1 == 1
            for i, p in zip(left[hit].tolist(), place[hit].tolist(), strict=True):
                block = p // _STEP * (_STEP // 8)
                before = int.from_bytes(bits[block : block + _STEP // 8].tobytes(), "little") & ((1 << p % _STEP) - 1)
                out[i] = counts[p // _STEP] + before.bit_count()
            left = left[~hit]
        return out


class ShardWriter:
    """Documents in key order to one shard file."""

    def __init__(self, out: BinaryIO, width: int):
        self._out, self._dtype, self._records, self._ids = out, np.dtype(f"<u{width}"), [], 0

    def add(self, keys: list[int | None], ids: np.ndarray, counts: np.ndarray) -> None:
        """Some documents: keys, their ids end to end, ids of each."""
        rows = np.zeros(len(keys), RECORD)
        rows["null"] = [k is None for k in keys]
        rows["key"] = [0 if k is None else k for k in keys]
        rows["count"] = counts
        rows["start"] = self._ids + np.cumsum(counts) - counts
        self._records.append(rows)
        self._ids += len(ids)
        self._out.write(ids.astype(self._dtype).tobytes())

    def close(self) -> tuple[int, int]:
        records = np.concatenate([np.zeros(0, RECORD), *self._records])
        there = np.flatnonzero(records["null"] == 0)
        keys, first = np.unique(records["key"][there], return_index=True)
        function = PerfectHash.build(keys)
        slots = np.zeros(len(keys), SLOT)
        at = function.slots(keys)
        slots["record"][at] = there[first]
        slots["fingerprint"][at] = _hash(keys, 1 << 20) >> np.uint64(32)
        self._out.write(records.tobytes())
        for bits in function.levels:
            self._out.write(struct.pack("<Q", len(bits)) + bits.tobytes())
        self._out.write(slots.tobytes())
        self._out.write(_FOOTER.pack(MAGIC, self._dtype.itemsize, len(records), len(keys), self._ids, len(function.levels)))
        return len(records), self._ids


class Shard:
    """Keyed access to one shard file."""

    def __init__(self, f: BinaryIO):
        self._f = f
        f.seek(0, 2)
        end = f.tell() - _FOOTER.size
        magic, width, n, keys, ids, levels = _FOOTER.unpack(read_at(f, end, _FOOTER.size))
        if magic != MAGIC:
            raise ValueError("no id shard")
        self._dtype = np.dtype(f"<u{width}")
        at = ids * width
        self.records = np.frombuffer(read_at(f, at, n * RECORD.itemsize), RECORD)
        at += n * RECORD.itemsize
        rest, bits = read_at(f, at, end - at), []
        at = 0
        for _ in range(levels):
            size = int.from_bytes(rest[at : at + 8], "little")
            bits.append(np.frombuffer(rest, np.uint8, size, at + 8))
            at += 8 + size
        self._slots = np.frombuffer(rest, SLOT, keys, at)
        self._function = PerfectHash(bits)

    def locate(self, keys: np.ndarray) -> np.ndarray:
        """The first record of each key, -1 if it isn't there."""
        slot = self._function.slots(keys)
        found = slot >= 0
        entry = self._slots[np.maximum(slot, 0)] if len(self._slots) else np.zeros(len(keys), SLOT)
        found &= entry["fingerprint"] == (_hash(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)
        record = np.where(found, entry["record"], 0).astype(np.int64)
        if len(self.records):
            found &= self.records["key"][record] == keys
        return np.where(found, record, -1)

    def ids(self, record: int) -> np.ndarray:
        r = self.records[record]
        width = self._dtype.itemsize
        return np.frombuffer(read_at(self._f, int(r["start"]) * width, int(r["count"]) * width), self._dtype)


@lru_cache(maxsize=2)
def _encoder(data: bytes, special: bool) -> JoinedEncoder:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(data.decode())
    tokenizer.encode_special_tokens = not special
    # byte-level entries write each byte as one character; added ones stand as they are
    sizes = np.zeros(max(tokenizer.get_vocab().values(), default=0) + 1, np.int64)
    for token, i in tokenizer.get_vocab().items():
        sizes[i] = len(token)
    for i, token in tokenizer.get_added_tokens_decoder().items():
        sizes[i] = len(token.content.encode())

    def encode(texts: list[str]) -> list[array]:
        return [array("i", e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    return JoinedEncoder(encode, sizes, 600_000, least=1)


def write_shards(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0, key_col: str = "doc_id", text_col: str = "text", special: bool = False) -> DataFrame:
    """Writes the documents' shards; a row for each: part (in key order), path, records, ids.

    A special token's string in a text is ordinary text, or with ``special`` that token, as in the tokenizers library.
    """
    with open(tokenizer_path, "rb") as f:
        data = f.read((64 << 20) + 1)
    if len(data) > 64 << 20:
        raise ValueError(f"{tokenizer_path} is over 64 MB")
    model = docs.sparkSession.sparkContext.broadcast(data)
    d = docs.select(F.col(f"`{key_col}`").cast("long").alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))
    order = [F.col("key").asc_nulls_last(), F.col("text")]
    dealt = d.repartitionByRange(order[0]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        batch = next(batches, None)
        if batch is None:
            return
        encoder = _encoder(model.value, special)
        with written(folder, f"shard-{part:06d}.ids") as out:
            shard = ShardWriter(out, 2)
            while batch is not None:
                keys, at = batch.column(0).to_pylist(), 0
                for ids, counts in encoder.slices(batch.column(1)):
                    if len(ids) and int(ids.max()) > 0xFFFF:
                        raise ValueError("an id does not fit into two bytes")
                    ended = np.insert(ids, np.cumsum(counts), end_id)
                    shard.add(keys[at : at + len(counts)], ended, counts + 1)
                    at += len(counts)
                batch = next(batches, None)
            n, total = shard.close()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([f"{folder}/shard-{part:06d}.ids"]), pa.array([n], pa.int64()), pa.array([total], pa.int64())], names=["part", "path", "records", "ids"])

    return dealt.mapInArrow(tidy(run), "part long, path string, records long, ids long")


def documents(shard: Shard, base: int) -> Iterator[pa.RecordBatch]:
    """key, start, n_tokens and ids_crc32 of a shard's documents, whose ids start at ``base``.

    Each distinct key's documents are read where the index says, as many as follow there with the
    same key; only documents without a key are read in their order.
    """
    records = shard.records
    named = records["null"] == 0
    keys = np.unique(records["key"][named])
    # where a run of equal keys ends
    ends = np.append(np.flatnonzero((records["key"][1:] != records["key"][:-1]) | (named[1:] != named[:-1])), len(records) - 1) + 1
    parts = []
    for a in range(0, len(keys), 4096):
        found = shard.locate(keys[a : a + 4096])
        if (found < 0).any():
            raise ValueError("a key is not in the index")
        parts.append(ragged(np.arange(len(records)), found, ends[np.searchsorted(ends, found, side="right")] - found))
    if sum(map(len, parts)) != named.sum():
        raise ValueError("the index does not lead to all documents")
    parts.append(np.flatnonzero(~named))
    for at in (part[i : i + 4096] for part in parts for i in range(0, len(part), 4096)):
        some = records[at]
        crc = [zlib.crc32(shard.ids(i).astype("<u4").tobytes()) for i in at.tolist()]
        yield pa.RecordBatch.from_arrays([
            pa.array(some["key"].astype(np.int64), mask=some["null"] != 0), pa.array(some["start"].astype(np.int64) + base),
            pa.array(some["count"].astype(np.int64)), pa.array(crc, pa.int64())], names=["key", "start", "n_tokens", "ids_crc32"])


def read_documents(shards: DataFrame) -> DataFrame:
    """key, start, n_tokens and ids_crc32 of each document, looked up by key in its shard; ``shards`` has path and base."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, base in (x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
            with opened(path) as f:
                yield from documents(Shard(f), base)

    return shards.select("path", "base").mapInArrow(tidy(run), "key long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, shards: list[str], key: int) -> np.ndarray | None:
    """The ids of one document (the first of its key), by the shards' indexes; None if there is none."""
    for path in shards:
        with opened(path) as f:
            shard = Shard(f)
            at = int(shard.locate(np.array([key]))[0])
            if at >= 0:
                return shard.ids(at)
    return None


def round_trip(docs: DataFrame, tokenizer_path: str, special: bool = False) -> DataFrame:
    """Writes the documents' shards at once, and returns what is read back from them; ``special`` as in ``write_shards``."""
    spark = docs.sparkSession
    listing = new_shared_dir(spark, "shard-list")
    write_shards(docs, tokenizer_path, new_shared_dir(spark, "shards"), special=special).write.parquet(listing)
    made = spark.read.schema("part long, path string, records long, ids long").parquet(listing)
    n = max(1, made.count())
    # a row for each shard, not for each document
    base = F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    based = made.select("path", base.alias("base"))
    return read_documents(based.repartition(n, "path")).withColumnRenamed("key", "doc_id")
