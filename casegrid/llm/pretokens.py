"""Byte-level BPE over whole texts, batch by batch: each distinct chunk of a batch is encoded once.

A chunk is what stands between two places that no pretoken can cross. The pretoken
pattern never joins white space to what stands before it; so where white space stands
alone (one character, with something else on either side), a pretoken ends before it. Texts
in which all white space stands alone are cut before each space and newline; any other
text is one chunk. The chunks' ids, put together again, are the text's ids.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: All characters that count as white space (fixed values), and the NUL that marks the cuts.
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_UNSAFE = rf"{_SPACE}{_SPACE}|\A{_SPACE}|{_SPACE}\z|\x00"

#: Bytes of text that are worked on at once (one text at least).
SLICE_BYTES = 3 << 20

#: Bytes of chunks that ``JoinedEncoder`` puts together at most, and the last chunk's rest.
JOINED_BYTES = 4096


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[starts[i] : starts[i] + lengths[i]] of all i, one after the other."""
    ends = np.cumsum(lengths)
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(len(at))
    return values[at]


def distinct_chunks(texts: pa.Array) -> tuple[pa.Array, int, np.ndarray, np.ndarray]:
    """The distinct chunks of texts (large_string without nulls): first those of texts that can be cut, how many these are, then the other texts; the chunk at each place of all texts; where each text's places end."""
    unsafe = pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False)
    cut = pc.if_else(pa.array(unsafe), "", texts) if unsafe.any() else texts
    cut = pc.replace_substring(pc.replace_substring(cut, " ", "\0 "), "\n", "\0\n")
    lists = pc.split_pattern(cut, "\0")
    coded = lists.flatten().dictionary_encode()
    chunks, which = coded.dictionary, coded.indices.to_numpy()
    n = len(chunks)
    ends = lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0]
    if unsafe.any():
        whole = np.flatnonzero(unsafe)
        chunks = pa.concat_arrays([chunks, texts.take(pa.array(whole))])
        which = which.copy()
        which[ends[whole] - 1] = n + np.arange(len(whole))  # its one empty chunk
    return chunks, n, which, ends


class BatchEncoder:
    """Whole texts -> ids, given the encoding of a list of chunks.

    Up to ``keep`` short chunks, of those met ``least`` times in a slice, are kept with their ids.
    """

    def __init__(self, encode_chunks: Callable[[list[str]], list[bytes]], keep: int = 250_000, least: int = 2):
        self._encode, self._keep, self._least = encode_chunks, keep, least
        self._known: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids as int32 end to end, ids of each text) for successive slices of the texts; null is empty."""
        return list(self.slices(texts))

    def slices(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What ``encode`` returns, a slice at a time."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + SLICE_BYTES)))
            yield self._slice(texts.slice(at, to - at))
            at = to

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        chunks, n, which, ends = distinct_chunks(texts)
        values, lengths = self._ids(chunks, n, which)
        starts = np.cumsum(lengths) - lengths
        sums = np.concatenate([[0], np.cumsum(lengths[which])])
        per_text = np.diff(np.concatenate([[0], sums[ends]]))
        return ragged(values, starts[which], lengths[which]), per_text

    def _ids(self, chunks: pa.Array, n: int, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks end to end, and each chunk's number of ids; ``chunks``, ``n`` and ``which`` as from ``distinct_chunks``."""
        names = chunks.to_numpy(zero_copy_only=False).tolist()
        ids = [*map(self._known.get, names)]
        new = [k for k, x in enumerate(ids) if x is None]
        often = np.bincount(which, minlength=len(names)) >= self._least
        for k, x in zip(new, self._coded(chunks, n, names, new), strict=True):
            ids[k] = x
            if often[k] and len(self._known) < self._keep and len(names[k]) <= 32:
                self._known[names[k]] = x
        return np.frombuffer(b"".join(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids)) // 4

    def _coded(self, chunks: pa.Array, n: int, names: list[str], new: list[int]) -> list[bytes]:
        """The ids, as int32 bytes, of the chunks at ``new``."""
        return self._encode([names[k] for k in new])


class JoinedEncoder(BatchEncoder):
    """Whole texts -> ids, given the encoding of a list of texts and the bytes that each id stands for.

    Chunks that aren't kept are put together again, whatever texts they come from, and encoded
    some thousand bytes at once: what ends before white space that stands alone may be followed
    by any chunk that begins with such. The ids' sizes tell where each chunk's ids end. Where
    they don't add up to the text (a tokenizer that changes it), chunks are encoded one by one.
    """

    def __init__(self, encode_texts: Callable[[list[str]], list[array]], sizes: np.ndarray, keep: int = 250_000, least: int = 2):
        """sizes: bytes by id."""
        super().__init__(lambda chunks: [x.tobytes() for x in encode_texts(chunks)], keep, least)
        self._encode_texts, self._sizes = encode_texts, sizes

    def _coded(self, chunks: pa.Array, n: int, names: list[str], new: list[int]) -> list[bytes]:
        if not new:
            return []
        some = chunks.take(pa.array(new, pa.int64()))
        places = np.frombuffer(some.buffers()[1], np.int64)[some.offset : some.offset + len(some) + 1]
        data = memoryview(some.buffers()[2] or b"")
        first = np.frombuffer(data, np.uint8)[np.minimum(places[:-1], len(data) - 1)] if len(data) else np.zeros(len(some), np.uint8)
        alone = (first != 0x20) & (first != 0x0A)
        alone[np.searchsorted(new, n) :] = True
        alone[1:] |= np.diff(places[:-1] // JOINED_BYTES) > 0
        cuts = np.unique(np.concatenate([places[:1], places[:-1][alone], places[-1:]])).tolist()
        ids = np.concatenate([np.zeros(0, np.int32), *self._encode_texts([str(data[a:b], "utf-8") for a, b in pairwise(cuts)])])
        ends, wanted = np.concatenate([[0], np.cumsum(self._sizes[ids])]), places[1:] - places[0]
        upto = np.searchsorted(ends, wanted, side="right") - 1
        if upto[-1] != len(ids) or (ends[upto] != wanted).any():
            return super()._coded(chunks, n, names, new)
        raw = ids.astype(np.int32, copy=False).tobytes()
        return [raw[4 * a : 4 * b] for a, b in pairwise([0, *upto.tolist()])]
