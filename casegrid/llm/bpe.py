"""Operator 1: byte-level BPE encoding and decoding by prefix dynamic programming.

For a rank table of byte-level BPE, every byte prefix of a pretoken has exactly one
valid last token: the token that the encoding of that prefix ends with. A token ``t``
that is a suffix of a prefix is that token if and only if it can stand after the valid
last token of what remains (``PrefixTable.joinable``). So one pass over the token matches
of an Aho-Corasick automaton fills a table of last tokens, and the encoding is read off
the table from the end. The pass takes time in proportion to the bytes, also for a
pretoken of millions of bytes, and the table of a prefix never changes: appending goes on
where it stopped, and an edit re-encodes only until the tables agree again
(``EditableEncoding``).

Edge cases: null and empty texts have no ids; repeated rows and null ``doc_id`` give a row
each; an empty table gives an empty result; columns other than the two named ones are not read.
"""

from __future__ import annotations

import base64
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import release_memory, tidy
from casegrid.llm.pretokens import BatchEncoder

#: The rank file is sent to the executors; a larger one is refused.
MAX_RANK_FILE_BYTES = 64 << 20

#: Pretokens up to so many bytes share the kept prefixes; longer ones go through the automaton alone.
SHORT = 32

#: Prefixes that a worker keeps at most; further ones are worked out each time.
PREFIXES = 80_000

#: Pairs of tokens whose answer a worker keeps at most; then it starts afresh.
PAIRS = 300_000

_INT = struct.Struct("<i")


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank, from the lines ``base64 rank`` of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


class PrefixTable:
    """Last tokens of all prefixes of byte strings, for one rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._prefixes: dict[bytes, bytes] = {}
        self._joinable: dict[int, bool] = {}  # by left << 32 | right
        # by their last three bytes, the lengths that tokens can have, longest first
        lengths: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) > 2:
                lengths.setdefault(token[-3:], {2, 1}).add(len(token))
        self._lengths = {end: tuple(sorted(found, reverse=True)) for end, found in lengths.items()}
        self.matcher = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.matcher.add_word(token.decode("latin-1"), (len(token), rank))
        self.matcher.make_automaton()

    def halves(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; None for a single byte."""
        if rank not in self._halves:
            token = self.tokens[rank]
            parts = [token[i : i + 1] for i in range(len(token))]
            while len(parts) > 2:
                at = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], rank))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self._halves[rank] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self._halves[rank]

    def joinable(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' bytes is these two tokens.

        Undoes merges from the latest on. Whenever a merge across the border would have
        come before the merge undone last, BPE would have crossed the border.
        """
        known = self._joinable.get(left << 32 | right)
        if known is not None:
            return known
        a, b, before, good = left, right, None, True
        while True:
            across = self.ranks.get(self.tokens[a] + self.tokens[b])
            if across is not None and (before is None or across < before):
                good = False
                break
            ha, hb = self.halves(a), self.halves(b)
            if ha is not None and (a > b or hb is None):
                before, a = a, ha[1]
            elif hb is not None:
                before, b = b + 1, hb[0]  # of equal ranks the left one is merged first
            else:
                break
        if len(self._joinable) >= PAIRS:
            self._joinable.clear()
        self._joinable[left << 32 | right] = good
        return good

    def extend(self, last: array, data: bytes) -> None:
        """Goes on with ``last`` (last[i]: last token of data[:i], last[0]: -1) to the end of ``data``."""
        if not last:
            last.append(-1)
        done = len(last) - 1
        last.extend([-1] * (len(data) - done))
        start = max(0, done - self.longest)
        known = self._joinable
        for end, (length, rank) in self.matcher.iter(data[start:].decode("latin-1") if start else data.decode("latin-1")):
            end += start + 1
            if last[end] >= 0:
                continue
            before = end - length
            if before == 0:
                last[end] = rank
            elif before >= start and (left := last[before]) >= 0:
                good = known.get(left << 32 | rank)
                if good or (good is None and self.joinable(left, rank)):
                    last[end] = rank

    def read_off(self, last: array, end: int | None = None) -> list[int]:
        """The ids of a prefix from its table."""
        ids, at = [], len(last) - 1 if end is None else end
        while at > 0:
            ids.append(last[at])
            at -= len(self.tokens[last[at]])
        return ids[::-1]

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of one pretoken."""
        if not data:
            return []
        if len(data) <= SHORT:
            return array("i", self.encode_short(data)).tolist()
        last = array("i", [-1])
        self.extend(last, data)
        return self.read_off(last)

    def encode_short(self, data: bytes) -> bytes:
        """Ids, as int32 bytes, of a short pretoken or a prefix of one.

        The same table, filled only where it is asked for and kept across pretokens:
        words share prefixes, so most need a single new entry.
        """
        get, pairs, n = self.ranks.get, self._joinable, len(data)
        for length in self._lengths.get(data[-3:], (2, 1)):
            if length > n or (rank := get(data[n - length :])) is None:
                continue
            before = n - length
            if before == 0:
                out = _INT.pack(rank)
                break
            start = data[:before]
            head = self._prefixes.get(start)
            if head is None:
                head = self.encode_short(start)
                if len(self._prefixes) < PREFIXES:
                    self._prefixes[start] = head
            left = _INT.unpack_from(head, len(head) - 4)[0]
            good = pairs.get(left << 32 | rank)
            if good or (good is None and self.joinable(left, rank)):
                out = head + _INT.pack(rank)
                break
        return out


class EditableEncoding:
    """The encoding of one text, kept as a table of last tokens per pretoken.

    ``append`` and ``edit`` re-split only from the pretoken at the change until the
    pretokens agree with the old ones again, and keep every table outside that stretch.
    A pretoken that grew goes on from its old table.
    """

    def __init__(self, table: PrefixTable, pattern: str, text: str = ""):
        self._table, self._pattern = table, regex.compile(pattern)
        self.text = ""
        self._starts: list[int] = []
        self._tables: list[tuple[bytes, array]] = []
        self.append(text)

    def _made(self, piece: str, old: tuple[bytes, array] | None) -> tuple[bytes, array]:
        data = piece.encode("utf-8")
        last = array("i", [-1])
        if old is not None:
            shared = 0
            while shared < min(len(data), len(old[0])) and data[shared] == old[0][shared]:
                shared += 1
            last = old[1][: shared + 1]
        self._table.extend(last, data)
        return data, last

    def edit(self, start: int, end: int, new: str) -> None:
        """Puts ``new`` in place of text[start:end]."""
        old_starts, old_tables, old_len = self._starts, self._tables, len(self.text)
        self.text = self.text[:start] + new + self.text[end:]
        # a run of white space makes up to two pretokens, by what follows it: the three pretokens before the change may change too
        first = max(0, next((i for i, s in enumerate(old_starts) if s > start), len(old_starts)) - 3)
        at = old_starts[first] if first < len(old_starts) else 0
        shift = len(new) - (end - start)
        later = {s + shift: i for i, s in enumerate(old_starts) if s >= end}
        starts, tables = old_starts[:first], old_tables[:first]
        k = first
        for m in self._pattern.finditer(self.text, at):
            same = later.get(m.start())
            if same is not None and m.start() >= start + len(new):
                starts += [s + shift for s in old_starts[same:]]
                tables += old_tables[same:]
                break
            starts.append(m.start())
            tables.append(self._made(m.group(), old_tables[k] if k < len(old_tables) and k - first < 4 else None))
            k += 1
        assert old_len + shift == len(self.text)
        self._starts, self._tables = starts, tables

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    @property
    def ids(self) -> list[int]:
        return [i for _, last in self._tables for i in self._table.read_off(last)]


@lru_cache(maxsize=2)
def _encoder(data: bytes, pattern: str) -> BatchEncoder:
    """One for each Python worker and rank file."""
    table, split = PrefixTable(load_ranks(data)), regex.compile(pattern).findall
    return BatchEncoder(lambda chunks: [array("i", [i for p in split(c) for i in table.encode_bytes(p.encode("utf-8"))]).tobytes() for c in chunks], 150_000)


@lru_cache(maxsize=2)
def _vocabulary(data: bytes) -> list[bytes]:
    ranks = load_ranks(data)
    out = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


def _rank_file(docs: DataFrame, path: str):
    with open(path, "rb") as f:
        data = f.read(MAX_RANK_FILE_BYTES + 1)
    if len(data) > MAX_RANK_FILE_BYTES:
        raise ValueError(f"{path} is over {MAX_RANK_FILE_BYTES} bytes")
    return docs.sparkSession.sparkContext.broadcast(data)


def encode(docs: DataFrame, ranks_path: str, pattern: str, keep: list[str], text_col: str = "text", ids_col: str = "ids", verify_col: str | None = None) -> DataFrame:
    """``keep`` columns and the ids (array<int>) of each whole text, a row for each row, in one narrow pass.

    ``verify_col``, if given, tells whether the ids, decoded again in the same pass, are the text.
    """
    ranks = _rank_file(docs, ranks_path)
    source = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text_col}`").cast("string").alias("text"))
    fields = [f"k{i} {t}" for i, (_, t) in enumerate(source.dtypes[:-1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        token = _vocabulary(ranks.value).__getitem__ if verify_col else None
        for whole in batches:
            at = 0
            for ids, counts in encoder.slices(whole.column(len(keep))):
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                batch = whole.slice(at, len(counts))
                at += len(counts)
                columns, names = [*batch.columns[: len(keep)], pa.ListArray.from_arrays(offsets, ids)], [*(f"k{i}" for i in range(len(keep))), "ids"]
                if token:
                    parts = zip(batch.column(len(keep)), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                    columns.append(pa.array([b"".join(map(token, ids[a:b].tolist())) == (t.as_py() or "").encode() for t, a, b in parts], pa.bool_()))
                    names.append("same")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    out = source.mapInArrow(tidy(run), ", ".join([*fields, "ids array<int>", *["same boolean"] * bool(verify_col)]))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], F.col("ids").alias(ids_col), *([F.col("same").alias(verify_col)] if verify_col else []))


def decode(ids: DataFrame, ranks_path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Adds the bytes of each row's ids (null ids: empty); an id outside the vocabulary is an error."""
    ranks = _rank_file(ids, ranks_path)

    @F.arrow_udf("binary")
    def joined(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = _vocabulary(ranks.value).__getitem__
        for column in columns:
            values, offsets = np.asarray(column.values), np.asarray(column.offsets)
            out = []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                if b > a and values[a:b].min() < 0:
                    raise ValueError("negative id")
                out.append(b"".join(map(token, values[a:b].tolist())))
            yield pa.array(out, pa.binary())
        release_memory()

    return ids.withColumn(bytes_col, joined(F.coalesce(F.col(f"`{ids_col}`"), F.array().cast("array<int>"))))


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document, from its ids and the bytes decoded from them."""
    out = decode(encode(docs, ranks_path, pattern, ["doc_id"]), ranks_path)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
