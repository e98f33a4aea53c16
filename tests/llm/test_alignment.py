"""Operator 11 against plain Python over the two libraries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from casegrid.llm import alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ODD = ["", " ", "a", "  a", "a  ", "\n\n x \n", "line one\nline two\n", "don't we'll", "日本語 текст", "x" * 3000, " " * 300 + "y", "é́!!!??? 12345", "<|endoftext|> <s> <0x41>", "a\0b", "a▁b", "▁", "\x1c \x85　z", "the the  the\tthe", "ﬁ ① Å", "😀 a\U0010ffff"]


def plain(texts):
    """Per text: tokens of A and B, links as index pairs, groups; None where the bytes differ."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte, n = {chr(c): c for c in printable}, 0
    for c in range(256):
        if c not in printable:
            byte[chr(256 + n)] = c
            n += 1
    out = []
    for t in texts:
        if not t:
            out.append(None)
            continue
        ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        bytes_a = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
            out.append(None)
            continue
        links, groups, i, j, end_a, end_b, ga, gb = [], [], 0, 0, len(bytes_a[0]), len(bytes_b[0]), 0, 0
        while True:
            links.append((ids_a[i], ids_b[j]))
            step_a, step_b = end_a <= end_b, end_b <= end_a
            if step_a and step_b:
                groups.append((ids_a[ga : i + 1], ids_b[gb : j + 1]))
                ga, gb = i + 1, j + 1
            i, j = i + step_a, j + step_b
            if i == len(ids_a):
                break
            end_a += len(bytes_a[i]) if step_a else 0
            end_b += len(bytes_b[j]) if step_b else 0
        out.append((ids_a, ids_b, links, groups))
    return out


def wanted(rows):
    found = plain([t for _, t in rows])
    held = Counter(p for x in found if x for p in set(x[2]))
    most = defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = []
    for (i, _), x in zip(rows, found, strict=True):
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        digest = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in x[3])
        out.append((i, len(x[0]), len(x[1]), len(x[3]), len(x[2]), sum(held[p] == most[p[0]] for p in x[2]), sum(held[p] for p in x[2]), hashlib.sha256(digest.encode()).hexdigest()))
    return out


def test_merge_pieces_in_any_order():
    draw = np.random.default_rng(5)
    for piece in (1, 2, 3, 7, 64):
        for _ in range(40):
            total = int(draw.integers(1, 60))
            ends = [np.append(np.flatnonzero(draw.random(total - 1) < p) + 1, total) for p in draw.random(2)]
            cuts = alignment.diagonal_cuts(*ends, piece)
            work = np.diff(cuts.sum(axis=1))
            assert (work[:-1] == piece).all() and (np.diff(cuts, axis=0) >= 0).all()
            order = draw.permutation(len(cuts) - 1)
            pieces = {int(k): alignment.merge_piece(*ends, cuts[k], cuts[k + 1]) for k in order}
            a, b, groups = alignment.stitched([pieces[k] for k in range(len(cuts) - 1)])
            starts = [np.append(0, e[:-1]) for e in ends]
            want = [(i, j) for i in range(len(ends[0])) for j in range(len(ends[1])) if max(starts[0][i], starts[1][j]) < min(ends[0][i], ends[1][j])]
            assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == want
            both = np.intersect1d(*ends)
            assert groups[:, 0].tolist() == (np.searchsorted(ends[0], both) + 1).tolist() and groups[:, 1].tolist() == (np.searchsorted(ends[1], both) + 1).tolist()


def test_alignment_is_plain(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate([*ODD, None, ODD[7]])] + [(None, "null id the"), (3, "the the the end")]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, link int, block string")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = alignment.digests(docs, A, B)
    assert got.columns == columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, wanted(rows)))
    assert alignment.digests(docs.where("false"), A, B).count() == 0
    lists = {(r["doc_id"], r["text"]): r for r in alignment.align(docs, A, B, ["doc_id", "text"]).collect()}
    for (i, t), x in zip(rows, plain([t for _, t in rows]), strict=True):
        r = lists[i, t]
        assert (r["a_ids"], r["b_ids"]) == (x[:2] if x else ([], []))
        assert [*zip(r["a_sizes"], r["b_sizes"], strict=True)] == ([(len(a), len(b)) for a, b in x[3]] if x else [])


@pytest.mark.parametrize("size", [1, 4000])
def test_small_blocks(size):
    """The sums are the same whatever the blocks and pieces."""
    import pyarrow as pa

    with open(A, "rb") as f, open(B, "rb") as g:
        both = alignment.Tokenizers(f.read(), g.read())
    texts = [t for t in ODD if t] * 2
    alone = [alignment.Block(both, pa.array([t], pa.large_string())) for t in texts]
    together = alignment.Block(both, pa.array(texts, pa.large_string()))
    assert together.digests() == [d for b in alone for d in b.digests()]
    assert together.per_text(together.n_links).tolist() == [int(b.per_text(b.n_links)[0]) for b in alone]
    whole = alignment.merged(np.cumsum(both.sizes_a[together.ids_a]), np.cumsum(both.sizes_b[together.ids_b]), size)
    for x, y in zip(whole, (together.a, together.b, together.groups), strict=True):
        assert (x == y).all()


def test_query_is_plain(spark):
    from casegrid.llm import queries

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(repr, map(tuple, queries.op11_alignment(spark, SF).collect()))) == sorted(map(repr, wanted(docs)))
