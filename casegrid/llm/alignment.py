"""Operator 11: alignment of two tokenizers' tokens by merge-path partitioning.

Both tokenizers cut the same bytes. Merging the ends of A's tokens with the ends of B's gives
everything: each place where one token ends lies in one token of the other, which is a link
(every pair of overlapping tokens comes up once so), and places where both end close a group.

The merge is cut into pieces of equal work: on each diagonal of the merge grid (so many
ends of both in all) a binary search finds how many ends of A stand before it, whatever lies in
the rest of the lists. A piece reads its own slices (and the last end of A before it),
needs no other piece, and gives its links in order and the groups that close in it; a group
open at a piece's end is stitched to what the next piece closes.

A text is taken as its chunks: it is cut before a space or line feed that stands alone, where no
token of either vocabulary can reach across (checked on the vocabulary of B; else texts stay
whole). So both tokenizers end a token there, and a distinct chunk of a slice of texts is encoded
and aligned once; a text's tokens, groups and links are those of its chunks, one after the other.

Counts over the corpus: a slice of texts ("block", ``SLICE_BYTES`` or one text) has a dictionary
of its distinct links with the number of its documents that hold each. Dictionaries, not
documents, are shuffled by pair, summed, and given their A id's largest count. The sums go back
to their block, where each document's links look them up. A pair that is in every document
stands once in each block, so no key holds more rows than there are blocks, and no group is larger than a
block.

Edge cases: null and empty texts, and texts whose tokens of A or B don't spell space + text
(another normalization, U+2581 in the text), have no tokens, groups or links; special tokens'
strings are plain text; null or repeated ids give a row each; an empty table gives an empty
result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casegrid.llm.common import stored, tidy
from casegrid.llm.pretokens import _SPACE, ragged

#: Texts, with their space before, that are not cut: white space next to white space or at the end, and the mark of the cuts.
_WHOLE = rf"{_SPACE}{_SPACE}|{_SPACE}\z|\x00"

#: Bytes of text that make a block (one text at least).
SLICE_BYTES = 4 << 20

#: Ends of both tokenizers that a piece of the merge has.
PIECE = 1 << 15

#: Tokenizer files are sent to the executors; larger ones are refused.
MAX_FILE_BYTES = 64 << 20

#: Short chunks that a worker keeps with their tokens.
KEPT_CHUNKS = 200_000


# --- the merge


def diagonal_cuts(ends_a: np.ndarray, ends_b: np.ndarray, piece: int) -> np.ndarray:
    """How many ends of A come before each diagonal 0, piece, 2 * piece, ... of the merge (of equal ends, A's comes first), and all of them."""
    n, m = len(ends_a), len(ends_b)
    diagonal = np.append(np.arange(0, n + m, piece), n + m)
    low, high = np.maximum(0, diagonal - m), np.minimum(diagonal, n)
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        before = np.zeros(len(diagonal), bool)
        at = np.flatnonzero(open_)
        before[at] = ends_a[middle[at]] <= ends_b[diagonal[at] - middle[at] - 1]
        low, high = np.where(open_ & before, middle + 1, low), np.where(open_ & ~before, middle, high)
    return np.stack([low, diagonal - low], axis=1)


@dataclass
class Piece:
    """What one piece of the merge gives: links in order, and for each group that closes in it, tokens of A and B and links up to there."""

    a: np.ndarray
    b: np.ndarray
    closed: np.ndarray  # columns: tokens of A, tokens of B, links of this piece


def merge_piece(ends_a: np.ndarray, ends_b: np.ndarray, start: np.ndarray, end: np.ndarray) -> Piece:
    """The piece between two cuts (i, j): reads ends_a[i0 - 1 : i1] and ends_b[j0 : j1] alone."""
    (i0, j0), (i1, j1) = start.tolist(), end.tolist()
    own_a, own_b = ends_a[i0:i1], ends_b[j0:j1]
    in_b = np.searchsorted(own_b, own_a, side="left")  # of A's ends: ends of B before them
    in_a = np.searchsorted(own_a, own_b, side="right")  # of B's ends: ends of A up to them
    size = len(own_a) + len(own_b)
    a, b, group = np.empty(size, np.int64), np.empty(size, np.int64), np.zeros(size, bool)
    at_a, at_b = np.arange(len(own_a)) + in_b, np.arange(len(own_b)) + in_a
    a[at_a], b[at_a] = np.arange(i0, i1), in_b + j0
    a[at_b], b[at_b] = in_a + i0, np.arange(j0, j1)
    # an end of B that is one of A too has its link already, and closes a group
    last = np.concatenate([ends_a[max(i0 - 1, 0) : i0] if i0 else np.array([-1]), own_a])
    group[at_b] = last[in_a] == own_b
    links = np.cumsum(~group)
    place = np.flatnonzero(group)
    return Piece(a[~group], b[~group], np.stack([a[place], b[place] + 1, links[place]], axis=1))


def stitched(pieces: list[Piece]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All links (tokens of A and B by number), and where each group ends: tokens of A, tokens of B, links."""
    before = np.cumsum([0, *(len(p.a) for p in pieces)])
    closed = [p.closed + [0, 0, n] for p, n in zip(pieces, before[:-1].tolist(), strict=True)]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *(p.a for p in pieces)]), np.concatenate([none, *(p.b for p in pieces)]), np.concatenate([np.zeros((0, 3), np.int64), *closed])


def merged(ends_a: np.ndarray, ends_b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links and groups of two token sequences over the same bytes."""
    cuts = diagonal_cuts(ends_a, ends_b, piece)
    return stitched([merge_piece(ends_a, ends_b, *c) for c in zip(cuts[:-1], cuts[1:], strict=True)])


# --- the tokenizers


class Tokenizers:
    """A: a byte-level vocabulary of the tokenizers library; B: a sentencepiece model that adds a space."""

    def __init__(self, a: bytes, b: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        # byte-level entries write each byte as one character; those that aren't printable follow at 256
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(c): c for c in plain} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in plain)}
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.bytes_a = [bytes(byte.get(c, 0) for c in self.a.id_to_token(i) or "") for i in range(size)]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.sizes_a, self.sizes_b = (np.array([*map(len, t)], np.int64) for t in (self.bytes_a, self.bytes_b))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size()) if not self.b.is_byte(i)]
        self.cuttable = not any("\n" in p or re.search("[^▁]▁", p) for p in pieces)
        self._known: dict[str, tuple[bytes, bytes]] = {}

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, chunks: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of A and B (int32 bytes) of each chunk; both empty if their tokens don't spell it."""
        out = [*map(self._known.get, chunks)]
        new = [k for k, x in enumerate(out) if x is None]
        texts = [chunks[k] for k in new]
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        ids_b = self.b.encode([t[1:] if t[:1] == " " else t for t in texts], num_threads=1)
        token_a, token_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        for k, text, a, b in zip(new, texts, ids_a, ids_b, strict=True):
            if text[:1] != " ":  # the space that B adds is no part of it
                b = b[1:] if token_b(b[0]) == b" " else []
            data = text.encode()
            if b"".join(map(token_a, a)) != data or b"".join(map(token_b, b)) != data:
                a, b = [], []
            out[k] = found = array("i", a).tobytes(), array("i", b).tobytes()
            if len(text) <= 32 and len(self._known) < KEPT_CHUNKS:
                self._known[text] = found
        return out


@lru_cache(maxsize=2)
def _tokenizers(a: bytes, b: bytes) -> Tokenizers:
    """One pair for each Python worker and pair of files."""
    return Tokenizers(a, b)


# --- a block of texts


class Block:
    """The alignment of one slice of texts, by its distinct chunks."""

    def __init__(self, tokenizers: Tokenizers, texts: pa.Array):
        self.tokenizers = t = tokenizers
        chunks, self.which, self.ends = self._chunks(texts)
        coded = t.encode(chunks)
        self.ids_a, self.n_a = self._joined([a for a, _ in coded])
        self.ids_b, self.n_b = self._joined([b for _, b in coded])
        # distinct chunks as one sequence of bytes: both tokenizers end a token at each chunk's end
        self.a, self.b, self.groups = merged(np.cumsum(t.sizes_a[self.ids_a]), np.cumsum(t.sizes_b[self.ids_b]))
        # groups and links of each chunk, by the number of A's tokens up to its end
        upto = np.searchsorted(self.groups[:, 0], np.cumsum(self.n_a), side="right")
        links = np.concatenate([[0], self.groups[:, 2]])[upto]
        self.n_groups, self.n_links = np.diff(upto, prepend=0), np.diff(links, prepend=0)
        self.first_link = links - self.n_links
        # texts with a chunk that isn't spelt by its tokens have no tokens
        spelt = np.concatenate([[0], np.cumsum(self.n_a[self.which] == 0)])
        self.starts = np.concatenate([[0], self.ends[:-1]])
        self.valid = (spelt[self.ends] == spelt[self.starts]) & (self.ends > self.starts)

    @staticmethod
    def _joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids)) // 4

    def _chunks(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct chunks, the chunk of each place, and where each text's places end; null and empty texts have none."""
        empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        texts = pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type))
        whole = pc.match_substring_regex(texts, _WHOLE).to_numpy(zero_copy_only=False) if self.tokenizers.cuttable else np.ones(len(texts), bool)
        cut = pc.if_else(pa.array(whole), pa.scalar("", texts.type), texts)
        lists = pc.split_pattern(pc.replace_substring(pc.replace_substring(cut, " ", "\0 "), "\n", "\0\n"), "\0")
        coded = lists.flatten().dictionary_encode()
        chunks, which = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        ends = lists.offsets.to_numpy()[1:].astype(np.int64) - int(lists.offsets.to_numpy()[0])
        # the first part of each text, before its first cut, is empty; a whole text has that part alone
        first = np.concatenate([[0], ends[:-1]])
        keep = np.ones(len(which), bool)
        keep[first] = whole & ~empty
        last = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        keep &= ~empty[last]
        at = np.flatnonzero(whole & ~empty)
        which[first[at]] = len(chunks) + np.arange(len(at))
        chunks += [texts[i].as_py() for i in at.tolist()]
        ends = np.concatenate([[0], np.cumsum(keep)])[ends]
        used, which = np.unique(which[keep], return_inverse=True)
        return [chunks[k] for k in used.tolist()], which, ends

    def per_text(self, of_chunk: np.ndarray) -> np.ndarray:
        """Sums over each text's chunks; 0 for texts without tokens."""
        sums = np.concatenate([[0], np.cumsum(of_chunk[self.which])])
        return np.where(self.valid, sums[self.ends] - sums[self.starts], 0)

    def _places(self) -> tuple[np.ndarray, np.ndarray]:
        """The places (chunks) of texts with tokens, and their texts."""
        text = np.repeat(np.arange(len(self.ends)), self.ends - self.starts)
        keep = self.valid[text]
        return self.which[keep], text[keep]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct links of texts with tokens (A id << 32 | B id), and for each text and link of it: text, number of the pair, occurrences."""
        which, text = self._places()
        # of each distinct link of the chunks its pair, then of each text its links
        pair = self.ids_a[self.a].astype(np.int64) << 32 | self.ids_b[self.b]
        distinct, number = np.unique(pair, return_inverse=True)
        held = ragged(number, self.first_link[which], self.n_links[which])
        key, times = np.unique(np.repeat(text, self.n_links[which]) * max(1, len(distinct)) + held, return_counts=True)
        text, number = key // max(1, len(distinct)), key % max(1, len(distinct))
        used, number = np.unique(number, return_inverse=True)
        return distinct[used], text, number, times

    def digests(self) -> list[str]:
        """Each text's groups "a1,a2|b1;a3|b2" as lowercase hex of their SHA-256; '' without tokens."""
        # in each group A's tokens, then B's, each followed by what stands after it
        ends_a, ends_b, _ = self.groups.T
        before_a, before_b = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
        group_a, group_b = np.repeat(np.arange(len(ends_a)), ends_a - before_a), np.repeat(np.arange(len(ends_b)), ends_b - before_b)
        last_a, last_b = np.zeros(len(self.ids_a), bool), np.zeros(len(self.ids_b), bool)
        last_a[ends_a - 1], last_b[ends_b - 1] = True, True
        order = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        order[np.arange(len(self.ids_a)) + before_b[group_a]] = self.ids_a * 4 + last_a
        order[np.arange(len(self.ids_b)) + ends_a[group_b]] = self.ids_b * 4 + 2 + last_b
        marks = ",", "|", ",", ";"
        text = [f"{x >> 2}{marks[x & 3]}" for x in order.tolist()]
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        chunk = ["".join(text[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        which = self.which.tolist()
        return [
            hashlib.sha256("".join(map(chunk.__getitem__, which[a:b]))[:-1].encode()).hexdigest() if good else ""
            for a, b, good in zip(self.starts.tolist(), self.ends.tolist(), self.valid.tolist(), strict=True)
        ]

    def lists(self) -> tuple[list[pa.Array], np.ndarray]:
        """Ids of A, ids of B, and tokens of A and of B in each group, as lists for each text."""
        which, text = self._places()
        first_group = np.cumsum(self.n_groups) - self.n_groups
        sizes = np.diff(self.groups, axis=0, prepend=np.zeros((1, 3), np.int64))
        out = []
        for values, start, n in (
            (self.ids_a, np.cumsum(self.n_a) - self.n_a, self.n_a), (self.ids_b, np.cumsum(self.n_b) - self.n_b, self.n_b),
            (sizes[:, 0], first_group, self.n_groups), (sizes[:, 1], first_group, self.n_groups),
        ):
            offsets = np.concatenate([[0], np.cumsum(self.per_text(n))])
            out.append(pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(ragged(values, start[which], n[which]), pa.int32())))
        return out, text


def _blocks(tokenizers: Tokenizers, batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Blocks of the rows of a partition, with their rows."""
    for batch in batches:
        texts = pc.fill_null(batch.column(column), "").cast(pa.large_string())
        sizes, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES)))
            yield batch.slice(at, to - at), Block(tokenizers, texts.slice(at, to - at))
            at = to


def _files(docs: DataFrame, *paths: str):
    found = []
    for path in paths:
        with open(path, "rb") as f:
            data = f.read(MAX_FILE_BYTES + 1)
        if len(data) > MAX_FILE_BYTES:
            raise ValueError(f"{path} is over {MAX_FILE_BYTES} bytes")
        found.append(data)
    return docs.sparkSession.sparkContext.broadcast(found)


# --- over a corpus


def align(docs: DataFrame, path_a: str, path_b: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, a_ids and b_ids of each whole text, and a_sizes and b_sizes: tokens of each in successive groups."""
    files = _files(docs, path_a, path_b)
    source = docs.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text_col}`").cast("string").alias("text"))
    names = ["a_ids", "b_ids", "a_sizes", "b_sizes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, block in _blocks(_tokenizers(*files.value), batches, len(keep)):
            yield pa.RecordBatch.from_arrays([*rows.columns[: len(keep)], *block.lists()[0]], names=[*(f"k{i}" for i in range(len(keep))), *names])

    fields = [f"k{i} {t}" for i, (_, t) in enumerate(source.dtypes[:-1])] + [f"{c} array<int>" for c in names]
    return source.mapInArrow(tidy(run), ", ".join(fields)).select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *names)


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows of documents (doc_id, counts, digest, their links by number in the block's dictionary, with occurrences) and, without doc columns, a row for each block's dictionary."""
    files = _files(docs, path_a, path_b)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fields = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, link array<int>, times array<int>, pair array<long>, docs array<int>"
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for rows, block in _blocks(_tokenizers(*files.value), batches, 1):
            pairs, text, link, times = block.pairs()
            n = len(rows)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))]).astype(np.int32)
            none = pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, number)), rows.column(0), *(pa.array(block.per_text(x)) for x in (block.n_a, block.n_b, block.n_groups, block.n_links)),
                pa.array(block.digests()), *(pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (link, times)), *none], names=names)
            held = np.bincount(link, minlength=len(pairs))
            one = [pa.array([number]), *(pa.nulls(1, pa.int64()) for _ in range(5)), pa.nulls(1, pa.string()), *(pa.nulls(1, pa.list_(pa.int32())) for _ in range(2))]
            whole = np.array([0, len(pairs)], np.int32)
            yield pa.RecordBatch.from_arrays([*one, pa.ListArray.from_arrays(whole, pa.array(pairs)), pa.ListArray.from_arrays(whole, pa.array(held, pa.int32()))], names=names)
            number += 1

    return source.mapInArrow(tidy(run), fields)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, docs (documents that hold it linked) and best (whether no pair of its A id has more), from stored blocks."""
    entries = blocks.where("pair IS NOT NULL").select(F.explode(F.arrays_zip("pair", "docs")).alias("e")).select("e.pair", "e.docs")
    counts = entries.groupBy("pair").agg(F.sum("docs").alias("docs"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))  # at most as many as B has ids
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(of_a))


def digests(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document: tokens, groups, links, those that are their A id's most frequent, the links' summed counts, and the groups' digest."""
    blocks = stored(aligned_blocks(docs, path_a, path_b), "alignment")
    entries = blocks.where("pair IS NOT NULL").select("block", F.posexplode("pair").alias("link", "pair"))
    known = entries.join(pair_counts(blocks), "pair").select(F.col("block").alias("of"), "link", "docs", "best")
    rows = blocks.where("pair IS NULL").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "link", "times", "groups_sha256")
    fields = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def looked_up(rows: pa.Table, known: pa.Table) -> pa.Table:
        link = known.column("link").to_numpy()
        docs_, best = np.zeros(len(link), np.int64), np.zeros(len(link), np.int64)
        docs_[link], best[link] = known.column("docs").to_numpy(), known.column("best").to_numpy()
        rows = rows.combine_chunks()
        lists = rows.column("link").combine_chunks() if rows.num_rows else None
        out = []
        for of_pair in (best, docs_):
            if lists is None:
                out.append(pa.array([], pa.int64()))
                continue
            at, times = lists.flatten().to_numpy(), rows.column("times").combine_chunks().flatten().to_numpy()
            sums = np.concatenate([[0], np.cumsum(of_pair[at] * times.astype(np.int64))])
            offsets = lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]
            out.append(pa.array(sums[offsets[1:]] - sums[offsets[:-1]]))
        return pa.table([*(rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), *out, rows.column("groups_sha256")], names=[f.split()[0] for f in fields.split(", ")])

    return rows.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(looked_up, fields)
