"""Operator 12 against plain Python, with small bands and queues."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from casegrid.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x)] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain(convs):
    """Rows of the trie of {conv_id: turns}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
        ends[tuple(convs[c])].append(c)
    out = []
    for path, inside in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = lambda q: sum(len(p) == len(q) + 1 and p[: len(q)] == q for p in members)
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        out.append((min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside), children(path),
                    sum(children(p) == 0 for p in below), saved, hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest()))
    return sorted(map(repr, out))


def found(df):
    return sorted(repr(tuple(r)) for r in df.select(COLUMNS).collect())


def some_rows(n=60):
    draw = np.random.default_rng(2)
    texts = ["a", "bé", "", None, "same start", "x" * 700]
    rows = [(int(c) - 8, int(t) if t % 4 else None, [None, "user", "assistant"][int(draw.integers(3))], texts[int(draw.integers(6))]) for c in range(n) for t in range(int(draw.integers(1, 7)))]
    rows += [(3, 1, "user", "tie"), (3, 1, "user", "tie"), (3, 1, "assistant", "tie"), (None, 1, "user", "no conversation")]
    return rows + [(c, t, "user", f"turn {t}") for c in range(1000, 1040) for t in range(12)]


def test_trie_is_plain(spark):
    rows = some_rows()
    df = spark.createDataFrame([(*r, 5, "n") for r in rows], "conv_id long, turn int, role string, text string, depth int, node string")
    got = prefix_trie.conversation_trie(df)
    assert sorted(got.columns) == sorted(COLUMNS)
    assert found(got) == plain(rebuilt(rows))
    assert prefix_trie.conversation_trie(df.where("false")).count() == 0


@pytest.mark.parametrize("band", [2, 3, 1000])
def test_bands_and_spills(spark, band):
    """Long conversations in several bands, and queues that hold two messages."""
    convs = {c: [("user", f"{t if t < 9 - c % 4 else c * t}") for t in range(11)] for c in range(1, 30)}
    convs |= {c: [("user", "0")] * (c - 400) for c in range(400, 404)}
    convs[7] = convs[7][:4]
    turns = spark.createDataFrame([(c, d + 1, *t, d + 1 == len(x)) for c, x in convs.items() for d, t in enumerate(x)], "conv_id long, depth long, role string, text string, last boolean")
    sizes = spark.createDataFrame([(c, len(x)) for c, x in convs.items()], "conv_id long, turns long")
    assert found(prefix_trie.trie(turns, sizes, band, 2)) == plain(convs)


def test_several_tiers(spark):
    """More than 256 members, so that shards of two tiers pass messages."""
    convs = {c: [("user", "hot"), ("assistant", str(c % 300)), ("user", str(c))][: 1 + c % 3] for c in range(900)}
    turns = spark.createDataFrame([(c, d + 1, *t, d + 1 == len(x)) for c, x in convs.items() for d, t in enumerate(x)], "conv_id long, depth long, role string, text string, last boolean")
    sizes = spark.createDataFrame([(c, len(x)) for c, x in convs.items()], "conv_id long, turns long")
    assert found(prefix_trie.trie(turns, sizes)) == plain(convs)


def test_queue_spills_in_order(tmp_path):
    draw = np.random.default_rng(1)
    queue, want = prefix_trie.SpillingQueue(str(tmp_path), 5), defaultdict(lambda: [0, 0, 0])
    for depth, conv in draw.integers(0, 12, (400, 2)).tolist():
        queue.push(depth, conv, 1, depth, conv)
        want[-depth, conv] = [a + b for a, b in zip(want[-depth, conv], (1, depth, conv), strict=True)]
    assert len(queue.files) > 10
    for depth, conv in sorted((-d, c) for d in range(12) for c in range(12)):
        assert list(queue.take(-depth, conv)) == want.get((depth, conv), [0, 0, 0])
    queue.close()
    assert not [p for p in tmp_path.iterdir()]
    queue.push(1, 1, 1, 1, 1)
    with pytest.raises(ValueError):
        queue.close()


def test_end_digests_in_pieces(spark):
    ends = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN X'00' ELSE X'01' END AS node", "id - 1500 AS conv_id")
    got = {bytes(r["node"]): r["ends_sha256"] for r in prefix_trie.end_digests(ends, 100).collect()}
    ids = {k: [i - 1500 for i in range(3000) if (i % 3 == 0) == (k == b"\0")] for k in (b"\0", b"\1")}
    assert got == {k: hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for k, x in ids.items()}
