"""The training-data operators against brute force, round trips and held-out labels, and their edge cases."""

import hashlib
import io
import random
import re
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from casegrid.llm import bpe, chat, fingerprints, html_text, minhash_join, mixing, permutation_index, quality, token_shards, warc_zip

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN
ODD = ["", " ", "a", "  a", "a  ", "\n\n x \n", "don't we'll", "日本語 текст", "x" * 5000, " " * 300 + "y", "é́!!!??? 12345", "<|endoftext|>", "a\0b", "\x1c \x85　z", "the the  the\tthe"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    with open(RANKS, "rb") as f:
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.load_ranks(f.read()), special_tokens={})


# 1


def test_bpe_is_tiktoken(spark, tiktoken_encoding):
    rows = [(i, t, "s") for i, t in enumerate([*ODD, None, ODD[7]])] + [(None, "null id", None)]
    got = {(r["doc_id"], r["ids_sha256"], r["decoded_sha256"], r["n_tokens"]) for r in bpe.digests(documents(spark, rows), RANKS, PATTERN).collect()}
    want = set()
    for i, t, _ in rows:
        ids = tiktoken_encoding.encode_ordinary(t or "")
        want.add((i, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), len(ids)))
    assert got == want
    assert bpe.digests(documents(spark, []), RANKS, PATTERN).count() == 0


def test_bpe_appends_and_edits(tiktoken_encoding):
    with open(RANKS, "rb") as f:
        table = bpe.PrefixTable(bpe.load_ranks(f.read()))
    draw = np.random.default_rng(3)
    parts = ["a", " the", "  ", "\n", "'s", "é", "12", "!!", "\t", " x"]
    for _ in range(300):
        e = bpe.EditableEncoding(table, PATTERN, "".join(draw.choice(parts, 8)))
        for _ in range(3):
            a = int(draw.integers(0, len(e.text) + 1))
            b = min(len(e.text), a + int(draw.integers(0, 4)))
            e.edit(a, b, "".join(draw.choice(parts, 2)))
            e.append(str(draw.choice(parts)))
            assert e.ids == tiktoken_encoding.encode_ordinary(e.text)


# 2


def one_page(page, url="http://a.example/x"):
    blocks, _ = html_text.parse(page)
    inside = any(b[2] for b in blocks)
    return [b[0] for b in blocks if b[2] or not inside]


def test_html_article_only():
    page = (
        '<body class="has-sidebar"><header><h1>Site</h1></header><div id="top-nav"><a>Home</a></div><main><article><header><h1>T &amp; t</h1></header>'
        "<p>One <b>two<br>three</p><p>four<span class=ad>buy</span> five<ul><li>a<li>b</ul><aside>aside</aside>"
        '<section id="comments"><article class="comment">reader</article></section><form><p>mail</p></form></article></main>'
        '<div class="cookie-notice">cookies</div><footer>foot</footer><script>var a="</p>";if(a<b){}</script><style>p{}</style>'
    )
    assert one_page(page) == ["T & t", "One two three", "four", "five", "a", "b"]


@pytest.mark.parametrize("page,want", [
    ("", []), ("x < y and <3", ["x < y and <3"]), ("<p>a<p>b &lt;i&gt; &nbsp; c</div> d", ["a", "b <i> c", "d"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]), ("<p>text<!-- open", ["text"]), ("<script>never closed", []), ('<a href="x>y</a>z', ["yz"]),
])
def test_html_broken_markup(page, want):
    assert one_page(page) == want


def test_html_style_tree(spark):
    """Unnamed boilerplate goes by importance; copies of a page keep their text; a lone page keeps all."""
    rows = [(i, f"http://x.example/{i}", f"<body><div class=a>Welcome here</div><div class=b><p>story {i} of {i * 7}</p><p>more {i * 13}</p></div></body>") for i in range(30)]
    rows += [(100 + i, "http://copies.example/", "<body><div class=b><p>same story</p></div></body>") for i in range(5)]
    rows += [(200, "http://lone.example/", "<body><div class=a>Welcome here</div><p>t</p></body>"), (201, None, None), (202, "u", ""), (None, None, "<p>n")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("row", F.lit("x"))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.main_text(d).collect()}
    assert all(got[i][0] == f"story {i} of {i * 7} more {i * 13}" for i in range(30))
    assert all(got[100 + i] == ("same story", 10) for i in range(5))
    assert got[200][0] == "Welcome here t" and got[201] == got[202] == ("", 0) and got[None][0] == "n"
    assert html_text.main_text(d.limit(0)).count() == 0


def test_html_texts_do_not_depend_on_the_host_size(spark):
    """Pages with 1 to 15 paragraphs of their own: all stay, and the line on every page goes, on hosts of 30, 1,000 and 20,000 pages."""
    sizes = (30, 1000, 20_000)
    story = lambda n: [f"story {n} part {k}" for k in range(1 + n * 7 % 15)]
    # texts beside the paragraphs make the holder look different from page to page, too
    mixed = lambda n: "".join(f"<p>{t}</p>" if (n >> k) % 2 else f"{t}<hr>" for k, t in enumerate(story(n)))
    rows = [(h * 10**6 + i, f"http://h{h}.example/{i}", f"<body><div class=a>Welcome here</div><div class=b><h1>t {i}</h1>{mixed(i)}</div></body>") for h in sizes for i in range(h)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(d).collect()}
    assert got == {h * 10**6 + i: " ".join([f"t {i}", *story(i)]) for h in sizes for i in range(h)}


@pytest.mark.parametrize("page,want", [
    ('<body class="single comments-open"><p>text</p>', "text"),
    ('<body><article class="post has-comments"><p>text</p></article>', "text"),
    ('<form><nav>menu</nav><article><p>text</p><form><p>mail</p></form></article></form>', "text"),
    ('<div class="comments-on"><main><p>text</p></main></div>', "text"),
    ('<article><section id="discussion"><h2 id="related-work">a</h2><p>b</p></section><section id="search-results"><p>c</p></section>'
     '<div class="social-impact">d</div><p class="notice-period">e</p></article>', "a b c d e"),
    ('<article><p>text</p><section id="comments"><h3>2 comments</h3><ol class="comment-list"><li>first</ol></section></article>', "text"),
    ('<main><p>text</p><section id="comments"><article class="comment">reader</article></section></main>', "text"),
    ('<main><p>text</p></main><section id="comments"><article>reader</article></section>', "text"),
])
def test_html_names_do_not_take_texts(spark, page, want):
    d = spark.createDataFrame([(1, "http://a.example/", page)], "page_id long, url string, html string")
    assert html_text.main_text(d).first()["text"] == want


def test_html_names_nominate(spark):
    """What a name nominates in an article goes if pages of the host repeat it, one of many repeated texts at its place, too."""
    page = lambda i: f'<article><p>story {i}</p><section id="discussion"><p>talk {i}</p></section><p class="ad">buy {i // 4}</p><p class="x">part {i // 4}</p></article>'
    d = spark.createDataFrame([(i, f"http://a.example/{i}", page(i)) for i in range(400)], "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in html_text.main_text(d).collect()} == {i: f"story {i} talk {i} part {i // 4}" for i in range(400)}


def test_html_tree_decides_without_articles(spark):
    """Hosts of 5 to 400 pages without article elements: every text is asked for, and those that the host repeats go."""
    sizes = {f"h{n}.example": n for n in (5, 50, 400)}
    page = lambda h, i: (
        f'<body><div class="aa">Welcome to {h}<ul><li>one<li>two</ul></div><div class="bb"><h1>{h} {i}</h1>'
        + "".join(f"<p>part {k} of {h} {i}</p>" for k in range(1 + i % 9)) + f'</div><div class="cc"><p>All of {h}</p></div></body>')
    d = spark.createDataFrame([(i, f"http://{h}/{i}", page(h, i)) for h, n in sizes.items() for i in range(n)], "page_id long, url string, html string")
    asked = html_text.parsed(d).select(F.explode("blocks").alias("b")).where("b.key is not null").count()
    assert asked == sum(5 + 1 + i % 9 for n in sizes.values() for i in range(n))
    got = {(r["url"], r["text"]) for r in html_text.main_text(d).collect()}
    assert got == {(f"http://{h}/{i}", " ".join([f"{h} {i}", *(f"part {k} of {h} {i}" for k in range(1 + i % 9))])) for h, n in sizes.items() for i in range(n)}


# 3


def test_fingerprints_estimate():
    draw = np.random.default_rng(0)
    words = [f"w{x}" for x in draw.integers(0, 10**6, 3000)]
    a, b = " ".join(words[:2500]), " ".join(words[500:])
    sets = [set(zip(*[t.split()[i:] for i in range(5)])) for t in (a, b)]
    true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    x, y = (fingerprints.sketch(fingerprints.shingle_hashes(t)) for t in (a, b))
    assert abs(fingerprints.resemblance(x, y) - true) < 0.15
    assert abs(fingerprints.containment(x, y) - len(sets[0] & sets[1]) / len(sets[0])) < 0.2
    assert abs(fingerprints.distinct(x) / len(sets[0]) - 1) < 0.3
    whole = fingerprints.sketch(np.concatenate([fingerprints.shingle_hashes(a), fingerprints.shingle_hashes(b)]))
    assert (fingerprints.merge(x, y) == whole).all()
    assert (fingerprints.from_text(fingerprints.as_text(x)) == x).all()
    empty = fingerprints.sketch(fingerprints.shingle_hashes(None))
    assert fingerprints.resemblance(empty, empty) == 1 and fingerprints.resemblance(empty, x) == 0 and fingerprints.as_text(empty) == ""


def test_fingerprints_merge_by_key(spark):
    rows = [(1, "a b c d e f g", "x"), (2, "h i j k l m", "x"), (3, "a b c", "y"), (4, None, "z"), (5, " ".join(map(str, range(400))), "x")]
    d = documents(spark, rows)
    prints = fingerprints.fingerprints(d).join(d.select("doc_id", "source"), "doc_id")
    got = {r["source"]: r["fingerprint"] for r in fingerprints.merged(prints, ["source"]).collect()}
    by = defaultdict(list)
    for _, t, s in rows:
        by[s].append(fingerprints.shingle_hashes(t))
    assert got == {s: fingerprints.as_text(fingerprints.sketch(np.concatenate(h))) for s, h in by.items()}


def test_fingerprint_pairs(spark):
    rows = [(i * 3, "".join(chr(97 + (i * j) % 26) + " " * (j % 4 == 0) for j in range(i * 5)), "s") for i in range(40)] + [(None, "x y z", "s"), (7, None, "s"), (8, "", "s")]
    for some in (rows, rows[:1], []):
        got = {r["doc_id"]: r for r in fingerprints.edited_pairs(documents(spark, some)).collect()}
        order = sorted(some, key=lambda r: (r[0] is None, -(r[0] or 0)))
        assert len(got) == len(some)
        for (i, t, _), (_, other, _) in zip(order, order[1:] + order[:1]):
            t, other = t or "", other or ""
            n = len(t) // 3
            new = t[: len(t) - n] + other[:n]
            assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
            a, b, c = (fingerprints.sketch(fingerprints.shingle_hashes(x)) for x in (t, new, other))
            assert got[i]["near_edited"] == fingerprints.resemblance(a, b) and got[i]["near_next"] == fingerprints.resemblance(a, c)


# 4


def water_level(size, weight, total, least, most):
    low, high = 0.0, 1e12
    for _ in range(200):
        mid = (low + high) / 2
        if sum(min(most * s, max(least * s, mid * w)) for s, w in zip(size, weight)) < total:
            low = mid
        else:
            high = mid
    return [min(most * s, max(least * s, low * w)) for s, w in zip(size, weight)]


@pytest.mark.parametrize("least", [0.0, 1.0])
def test_mix_targets(spark, least):
    rows = [("b", 100), ("a", 1000), (None, 40), ("c", 10), ("d", 500), ("e", 0)]
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(rows, "source string, source_size long"), least=least).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or ""))
    want = water_level([r[1] for r in order], [(3, 1, 2)[i % 3] for i in range(6)], 1.5 * sum(r[1] for r in order), least, 2.0)
    assert [got[r[0]] for r in order] == pytest.approx(want, abs=1e-3)


def test_mix_takes_its_targets(spark):
    rows = [(i, "w " * (i % 17), ("s0" if i % 3 else f"s{i % 5}") if i % 11 else None) for i in range(600)] + [(700, None, "s1"), (701, "  ", None), (None, "a b", "s0")]
    d = documents(spark, rows).withColumn("mix", F.lit("clash")).withColumn("plan", F.lit("clash"))
    got = mixing.mix(d, size_col=None).select("doc_id", "source", "mix", "mix_").collect()
    by = defaultdict(int)
    for r in got:
        taken = sum(c["taken"] for c in r["mix_"]["copies"])
        assert r["mix"] == "clash" and taken <= 2 * r["mix_"]["size"]
        assert all(0 <= c["position"] <= 1 for c in r["mix_"]["copies"])
        by[r["source"]] += taken
    for r in got:
        assert abs(by[r["source"]] - r["mix_"]["target"]) <= 1
    again = mixing.mix(d).select("doc_id", "source", "mix", "mix_").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert mixing.mix(d.limit(0)).count() == 0


def test_mix_order(spark):
    """Sources with a falling schedule come earlier than those with a rising one."""
    rows = [(i, "a b c d", f"s{i % 3}") for i in range(300)]
    ordered = mixing.training_order(mixing.mix(documents(spark, rows))).select("source", "mix.position").collect()
    assert [r["position"] for r in ordered] == sorted(r["position"] for r in ordered)
    mean = {s: np.mean([r["position"] for r in ordered if r["source"] == s]) for s in ("s0", "s1", "s2")}
    assert mean["s0"] > mean["s1"] > mean["s2"]


def test_mix_order_of_wordless_documents(spark):
    rows = [(i, "a b c d", "s") for i in range(20)] + [(30, None, "s"), (31, "", "only"), (32, " ", None)]
    mixed = mixing.mix(documents(spark, rows), epochs=1.5, least=1.0, whole=True)
    assert {r["doc_id"] for r in mixing.training_order(mixed).collect()} == set(range(20))
    ordered = mixing.training_order(mixed, ties=("doc_id",), wordless=True).select("doc_id", "mix.taken", "mix.position").collect()
    assert [(r["doc_id"], r["taken"], r["position"]) for r in ordered[-3:]] == [(30, 0, 2.0), (31, 0, 2.0), (32, 0, 2.0)]
    assert len(ordered) == 33 and max(r["position"] for r in ordered[:-3]) <= 1


# 5


def test_permutation_index_recall(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(1500, 24)) * draw.uniform(0.2, 3, size=(1500, 1))
    x[600:1100] = x[600] + 0.01 * draw.normal(size=(500, 24))
    x[1200:1260] = x[1200]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(2000, None), (2020, [0.0] * 24), (2040, [float("nan")] * 24), (2060, [None] * 24), (None, [1.0] * 24), (2080, []), (2100, [1.0, 2.0])]
    d = spark.createDataFrame(rows + rows[:3] + bad, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0)).withColumn("score", F.lit(0))
    found = defaultdict(list)
    for r in permutation_index.search(d, F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    assert set(found) == set(range(0, 1500, 20))  # the only vector of its dimension finds nothing
    recall = []
    for q, got in found.items():
        score = (x * x[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(1500), -score)) if i != q][:20]
        recall.append(len({i for i, _, _ in got} & set(order)) / 20)
        assert [r for _, _, r in got] == list(range(1, 21)) and q not in {i for i, _, _ in got}
        assert all(abs(score[i] - s) < 1e-9 for i, s, _ in got)
        assert got == sorted(got, key=lambda g: (-g[1], g[0]))
    assert np.mean(recall) >= 0.9
    few = {r["vec_id"] for r in permutation_index.search(d.where("vec_id < 5"), F.col("vec_id") == 0, 20).collect()}
    assert few == {1, 2, 3, 4}
    assert permutation_index.search(d.limit(0), F.col("vec_id") % 20 == 0).count() == 0


# 6


def components(rows, width, percent):
    words = re.compile(r"[^\x20\x09-\x0D]+")
    sets = []
    for i, t, _ in rows:
        w = words.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()))
    up = list(range(len(sets)))

    def root(a):
        while up[a] != a:
            a = up[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                up[root(a)] = root(b)
    low = {}
    for a, (i, _) in enumerate(sets):
        low[root(a)] = min(low.get(root(a), i), i)
    return {i: (len(s), low[root(a)]) for a, (i, s) in enumerate(sets)}


def near_copies(seed, groups, copies):
    draw = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        base = [f"w{x}" for x in draw.integers(0, 400, 60 + g)]
        for _ in range(copies):
            w = list(base)
            for at in draw.integers(0, len(w), int(draw.integers(0, 5))):
                w[at] = f"e{draw.integers(0, 9)}"
            rows.append((int(draw.integers(0, 10**9)), " ".join(w), "s"))
    return list({r[0]: r for r in rows}.values())


@pytest.mark.parametrize("node_sets", [2048, 12])
def test_near_duplicates_are_all_found(spark, node_sets):
    """With small nodes, paths branch to the last level and what is left is compared in blocks."""
    rows = near_copies(5, 6, 25) + [(1, None, "s"), (2, "", "s"), (3, " \n ", "s"), (4, "two Words", "s"), (5, "TWO words", "s"), (6, "x " * 3000, "s"), (7, "two", "s")]
    want = components(rows, 4, 80)
    got = minhash_join.near_duplicates(documents(spark, rows).withColumn("set", F.lit(1)).withColumn("kept", F.lit(2)), 80, 4, node_sets).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_edges(spark):
    assert minhash_join.near_duplicates(documents(spark, [])).count() == 0
    got = minhash_join.near_duplicates(documents(spark, [(1, "a b c d e f", "s"), (1, "a b c d e f", "s"), (None, "a b c d e f", "s"), (None, "q", "s")])).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got) == [(-1, -1, True), (-1, 1, False), (1, 1, True), (1, 1, True)]


def test_near_duplicates_by_row(spark):
    """Null and repeated ids: rows are told apart by id and text, and each is linked by its own text."""
    rng = random.Random(9)
    text = lambda: " ".join(rng.choice("abcdefghijklmnop") + rng.choice("qrstuvwxyz") for _ in range(60))
    groups = [[t, t + " end", t + " End"] for t in (text() for _ in range(5))]
    rows = [(None, t, "s") for g in groups for t in g] + [(7, text(), "s"), (7, text(), "s"), (7, groups[0][0], "s"), (3, groups[1][1], "s")]
    rows += [rows[0], rows[-1], (None, None, "s"), (None, "", "s"), (5, " ", "s")]
    d = documents(spark, rows).withColumn("row_key", F.lit(1)).withColumn("kept_key", F.lit(2))
    got = Counter((r["component_id"], r["kept"]) for r in minhash_join.near_duplicates(d, 80, 4).where("n_shingles > 0").collect())
    # group 0 is named by the row of id 7, group 1 by the one of id 3, the other three by none; both other texts of id 7 stand alone
    assert got == {(7, False): 4, (7, True): 3, (3, False): 3, (3, True): 2, (None, True): 9}
    kept = minhash_join.representatives(d, 80, 4)
    assert kept.columns == d.columns
    left = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert max(left.values()) == 1
    stay = {(7, t) for i, t, _ in rows if i == 7} | {(3, groups[1][1]), (None, None), (None, ""), (5, " ")}
    assert stay <= set(left) and len(left) == len(stay) + 3
    assert all(sum((None, t) in left for t in g) == 1 for g in groups[2:]) and not any((None, t) in left for g in groups[:2] for t in g)
    assert minhash_join.representatives(documents(spark, [])).count() == 0


def test_large_clusters_of_long_texts(spark):
    """Clusters of 9 sets and of 60 long ones go the same way as pairs."""
    rng = random.Random(4)
    long = [f"w{rng.randrange(10**6)}" for _ in range(4000)]
    rows = [(i, " ".join(long[: 3990 + i % 10] + [f"x{i}"]), "s") for i in range(60)]
    short = [f"v{k}" for k in range(80)]
    rows += [(100 + i, " ".join(short[:72 + i]), "s") for i in range(9)] + [(200, " ".join(short[20:]), "s")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash_join.near_duplicates(documents(spark, rows), 80, 5).collect()}
    assert got == components(rows, 5, 80)


def test_common_hashes():
    draw = np.random.default_rng(3)
    for n, m in ((1, 1), (5, 40), (300, 300)):
        a, b = (np.unique(draw.integers(0, 200, k).astype(np.uint64)) for k in (n, m))
        assert minhash_join._common(a, b) == len(set(a.tolist()) & set(b.tolist()))


def test_component_labels(spark):
    """A long chain and a star."""
    edges = [(f"{i:03d}".encode(), f"{i + 1:03d}".encode()) for i in range(40)] + [(b"500", f"{i}".encode()) for i in range(600, 660)]
    got = {bytes(r["v"]): bytes(r["root"]) for r in minhash_join.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert all(got[v] == (b"000" if v < b"100" else b"500") for v in got) and len(got) == 41 + 61


# 7


def test_chat_folds_events(spark):
    log = [
        (1, 0, 0, "delta", "user", "hi"), (1, 1, 1, "delta", "assistant", "wr"), (1, 2, 1, None, "assistant", "ong"), (1, 3, 1, "regenerate", "assistant", "ri"),
        (1, 4, 1, "delta", "assistant", "ght"), (1, 5, 0, "edit", "user", "hello"), (1, 6, 2, "delta", "user", "x"), (1, 7, 2, "delete", None, None),
        (2, 0, 0, "delta", None, None), (None, 0, 0, "delta", "user", "n"),
    ]
    d = spark.createDataFrame(log, "conv_id long, seq long, msg long, kind string, role string, text string")
    got = {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.reconstruct(d).collect()}
    assert got == {1: [("user", "hello"), ("assistant", "right")], 2: [("", "")], None: [("user", "n")]}


def test_chat_stream_folds_to_the_turns(spark):
    texts = ["abcdefgh", "", "x", None, "日本 \U0001f600 <b>", "draft draft", "12", "one\ntwo"]
    rows = [(c, k, ("user", "assistant")[k % 2], t) for c in (1, 2) for k, t in enumerate(texts)] + [(None, 0, None, "n")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = chat.as_stream(d)
    kinds = {}
    for r in log.where("conv_id = 1").orderBy("seq").collect():
        kinds.setdefault(r["msg"], []).append(r["kind"])
    assert [kinds[m] for m in range(4)] == [
        ["delta"] * 3, ["delta", "edit", "delta", "delta"], ["delta", "regenerate", "delta", "delta"], ["delta", "delete", "delta", "delta", "delta"]]
    assert log.count() == log.select("conv_id", "seq").distinct().count() == 2 * 2 * (3 + 4 + 4 + 5) + 3
    key = lambda df: {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in chat.reconstruct(df).collect()}
    assert key(log) == key(chat.as_events(d)) == {c: [(("user", "assistant")[k % 2], t or "") for k, t in enumerate(texts)] for c in (1, 2)} | {None: [("", "n")]}


def test_chat_reads_back(spark):
    texts = ["", 'a\\s<b>"c"\r\n', "</turn>\n", '<turn role="assistant">x', "\\", "\\l\\\\g", "日本 \U0001f600", chat.SPOKEN_MARKUP]
    rows = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(texts)] + [(2, 0, 'r"ole>', "x"), (3, None, None, None), (3, 1, "assistant", "b"), (3, 1, "assistant", "a")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    rendered = chat.render(chat.reconstruct(chat.as_events(d)))
    back = {r["conv_id"]: [(t["role"], t["text"]) for t in r["t"]] for r in rendered.select("conv_id", chat.parse(F.col("formatted")).alias("t")).collect()}
    assert back[1] == [(("user", "assistant")[k % 2], t) for k, t in enumerate(texts)]
    assert back[2] == [('r"ole>', "x")] and back[3] == [("", ""), ("assistant", "a"), ("assistant", "b")]
    loss = {r["conv_id"]: r["loss"] for r in rendered.select("conv_id", chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert loss[1] == "".join(texts[1::2]) and loss[2] == "" and loss[3] == "ab"
    out = {r["conv_id"]: r for r in chat.digests(chat.with_markup_conversation(d)).collect()}
    spoken = "".join(f"{r}\n{chat.SPOKEN_MARKUP}\n" for r in ("user", "assistant"))
    assert out[-7]["turns_sha256"] == hashlib.sha256(spoken.encode()).hexdigest() and out[-7]["loss_chars"] == len(chat.SPOKEN_MARKUP)
    assert chat.digests(d.limit(0)).count() == 0


# 8


def test_quality_learns_and_leaves_rows_out(spark):
    draw = np.random.default_rng(2)
    word = lambda: "".join(draw.choice(list("abcdefgh"), 5))
    good = lambda: " ".join(word() for _ in range(80)).capitalize() + "."
    junk = lambda: " ".join(word().upper() + "!!" for _ in range(80))
    rows = [(i, good() if i % 4 else junk(), "s") for i in range(400)] + [(1000, None, "s"), (1001, "", "s"), (None, good(), "s")]
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(400)] + [(1000, None), (None, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.scored_documents(documents(spark, rows), labels).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i]["held_out"] == (i in set(held)) for i in range(400))
    assert np.mean([got[i]["predicted"] == int(i % 4 > 0) for i in held]) >= 0.95
    assert got[1000]["score"] == got[1001]["score"] and all(0 <= r["score"] <= 1 for r in got.values())
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.scored_documents(documents(spark, rows), flipped).collect()}
    assert again == {i: r["score"] for i, r in got.items()}
    assert {r["score"] for r in quality.scored_documents(documents(spark, rows[:3]), labels.limit(0)).collect()} == {0.5}


def test_quality_shapes_are_whole():
    """Words that differ late have shapes that differ."""
    assert quality.shape("aA-" * 20) != quality.shape("aA-" * 40) and quality.shape("x" * 5000) == "a"


def test_quality_contexts_are_those_of_all_texts(spark):
    """Contexts come from every text that may train, labelled or not; labels without a document take no place in the fit."""
    texts = [f"alpha{i % 37} beta{i % 11} alpha{i % 37} Gamma!! delta{i}" for i in range(60)] + ["", None, "one"]
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)]).repartition(4)
    index, want = quality.index_vectors(), np.zeros((2 * quality.SHAPES + quality.WORDS, quality.WIDTH))
    usable = ~quality.held_out(F.col("doc_id"))
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 4 != 2:
            for rows in quality.term_rows(t):
                for a in range(len(rows)):
                    for b in range(max(0, a - quality.WINDOW), min(len(rows), a + quality.WINDOW + 1)):
                        if a != b:
                            want[rows[a]] += index[rows[b]]
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9)
    trains = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2][:12]
    labels = [(i, k % 2) for k, i in enumerate(trains)]
    ours = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(docs, ours, usable)
    assert np.allclose(model.vectors[:, : quality.WIDTH], want, atol=1e-6)
    # 2,000 labels of no document, and room for as many rows as have one
    more = spark.createDataFrame(labels + [(10**6 + k, 1) for k in range(2000)], "doc_id long, quality int")
    again = quality.train(docs, more, usable, max_rows=len(labels))
    assert all(np.array_equal(getattr(model, k), getattr(again, k)) for k in ("vectors", "mean", "scale", "w1", "b1", "w2", "b2", "temperature"))


# 9


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(4).integers(-(2**62), 2**62, 20_000))
    f = token_shards.PerfectHash.build(keys)
    assert sorted(f.slots(keys).tolist()) == list(range(len(keys)))
    assert len(token_shards.PerfectHash.build(keys[:0]).slots(keys[:2])) == 2


def test_token_shards_round_trip(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = [(k * 7 % 101, t, "s") for k, t in enumerate(ODD)] + [(5, "again", "s"), (5, "again", "s"), (None, "no id", "s"), (None, None, "s")]
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start = [], 0
    for i, t, _ in order:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in token_shards.round_trip(documents(spark, rows), JSON).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert token_shards.round_trip(documents(spark, []), JSON).count() == 0
    made = token_shards.write_shards(documents(spark, rows), JSON, f"file://{tmp_path}/shards").collect()
    paths = [r["path"] for r in sorted(made, key=lambda r: r["part"])]
    assert token_shards.lookup(spark, paths, 7).tolist() == [*tokenizer.encode(ODD[1], add_special_tokens=False).ids, 0]
    assert token_shards.lookup(spark, paths, 10**12) is None


def test_token_shards_are_read_by_the_index(spark, tmp_path, monkeypatch):
    """Each distinct key is asked for once; rows are those that the index gives, so a wrong index does not pass unseen."""
    rows = [(k // 3, f"text {k}", "s") for k in range(300)] + [(None, "no id", "s"), (None, None, "s")]
    made = token_shards.write_shards(documents(spark, rows), JSON, f"file://{tmp_path}/shards").collect()
    asked, locate = [], token_shards.Shard.locate
    monkeypatch.setattr(token_shards.Shard, "locate", lambda self, keys: asked.extend(keys.tolist()) or locate(self, keys))

    def read():
        for r in made:
            with open(r["path"].removeprefix("file://"), "rb") as f:
                yield from (x["key"] for b in token_shards.documents(token_shards.Shard(f), 0) for x in b.to_pylist())

    assert sorted(read(), key=lambda k: (k is None, k or 0)) == [k for k, _, _ in rows]
    assert sorted(asked) == list(range(100))
    monkeypatch.setattr(token_shards.Shard, "locate", lambda self, keys: locate(self, keys) + 1)
    with pytest.raises(ValueError, match="all documents"):
        [*read()]


def test_token_shards_query_is_the_unmodified_library(spark, tmp_path):
    """The registered query against a Tokenizer as it is loaded, special tokens' strings included."""
    from tokenizers import Tokenizer

    from casegrid.llm import queries

    special = ["a <|endoftext|> b", "x<|endoftext|>\n\n y", "<|endoftext|><|endoftext|>", " <|endoftext|>  z", "<|endoftext| >"]
    documents(spark, [(i, t, "s") for i, t in enumerate([*ODD, *special])]).write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer, want, start = Tokenizer.from_file(JSON), [], 0
    for i, t in enumerate([*ODD, *special]):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in queries.op9_token_shards(spark, str(tmp_path)).select("doc_id", "start", "n_tokens", "ids_crc32").collect()) == want


# 10


def test_zip_is_read_by_others_and_reads_others(tmp_path):
    out = io.BytesIO()
    z = warc_zip.StoredZipWriter(out)
    for name, data in (("a", b"1" * 1000), ("empty", b""), ("b/é", b"xyz")):
        z.begin(name)
        z.write(data)
        z.end()
    z.close()
    with zipfile.ZipFile(io.BytesIO(out.getvalue())) as theirs:
        assert theirs.testzip() is None and theirs.read("b/é") == b"xyz"
    # an archive of ours after a preamble, and one of another writer with a comment
    for raw in (out.getvalue(), b"preamble" + out.getvalue()):
        ours = warc_zip.ArchiveReader(io.BytesIO(raw))
        assert ours.read("a", 10, 5) == b"11111" and ours.read("empty") == b"" and ours.read("b/é") == b"xyz"
        with pytest.raises(ValueError):
            ours.read("a", 990, 11)
    other = io.BytesIO()
    with zipfile.ZipFile(other, "w") as w:
        w.writestr("s", b"stored")
        w.writestr(zipfile.ZipInfo("packed"), b"z" * 99, zipfile.ZIP_DEFLATED)
        w.comment = b"PK\5\6 in a comment"
    reader = warc_zip.ArchiveReader(other)
    assert reader.read("s") == b"stored"
    with pytest.raises(ValueError):
        reader.read("packed")
    with pytest.raises(ValueError):
        warc_zip.ArchiveReader(io.BytesIO(b"no archive"))


def test_warc_round_trip(spark, tmp_path):
    long = "<p>" + "x" * 200
    rows = [(5, "http://a/", long), (3, "u\r\nv", long), (9, None, long), (4, "s", "short"), (6, "s", "short"), (7, "n", None), (8, "e", ""), (None, "z", long), (2, "é", "é\r\n\r\n" * 60), (3, "w", long)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(0)).withColumn("first", F.lit(0))
    got = sorted((tuple(r) for r in warc_zip.round_trip(d).collect()), key=repr)
    want = []
    for i, _, p in rows:
        raw = (p or "").encode()
        again = p == long and i != 3
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", 3 if again else None))
    assert got == sorted(want, key=repr)
    assert warc_zip.round_trip(d.limit(0)).count() == 0
    made = [r["path"] for r in warc_zip.write_archives(warc_zip.with_responses(d), f"file://{tmp_path}/w", archive_bytes=300).collect()]
    back = warc_zip.read_archives(spark, made).collect()
    assert len(made) > 1 and sorted((r["payload"] or b"").decode() for r in back if r["record_type"] == "response") == sorted([long, long, "short", "short", "", "", "é\r\n\r\n" * 60])
    assert {r["url"] for r in back} == {"http://a/", "u%0D%0Av", None, "s", "n", "e", "z", "é", "w"}


def test_batch_encoder_slices(tiktoken_encoding):
    """Slices and unsafe texts make no difference."""
    from casegrid.llm import pretokens

    encode = lambda chunks: [np.array(tiktoken_encoding.encode_ordinary(c), np.int32).tobytes() for c in chunks]
    old, pretokens.SLICE_BYTES = pretokens.SLICE_BYTES, 50
    try:
        found = pretokens.BatchEncoder(encode, keep=3).encode(pa.array([*ODD, None, *ODD]))
    finally:
        pretokens.SLICE_BYTES = old
    ids = np.concatenate([a for a, _ in found]).tolist()
    assert ids == [i for t in [*ODD, "", *ODD] for i in tiktoken_encoding.encode_ordinary(t)]


def test_batch_encoder_works_slice_by_slice():
    """A slice's ids are there before the next slice is encoded."""
    from casegrid.llm import pretokens

    calls = []
    encode = lambda chunks: [calls.append(c) or np.array([len(c)], np.int32).tobytes() for c in chunks]
    old, pretokens.SLICE_BYTES = pretokens.SLICE_BYTES, 50
    try:
        found = pretokens.BatchEncoder(encode).slices(pa.array(["first " + "a" * 60, "second " + "b" * 60]))
        ids, counts = next(found)
    finally:
        pretokens.SLICE_BYTES = old
    assert calls == ["first", " " + "a" * 60] and ids.tolist() == [5, 61] and counts.tolist() == [2]


def test_joined_encoder():
    """Chunks are encoded together, with the ids that they have alone; tokenizers whose ids don't spell the text get chunks."""
    from tokenizers import Tokenizer

    from casegrid.llm import pretokens, token_shards

    texts = ["a b", " a", "", "x<|endoftext|> y\nz <|endoftext|>", None, "don't 's x it's", "\0 a", "b a", "<|endoftext|>", *ODD, *(f"w{i} é{i}!" for i in range(2000))]
    tokenizer = Tokenizer.from_file(JSON)
    for special in (True, False):
        tokenizer.encode_special_tokens = not special
        want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
        encoder = token_shards._encoder.__wrapped__(open(JSON, "rb").read(), special)
        given, inner = [], encoder._encode_texts
        encoder._encode_texts = lambda x, given=given, inner=inner: given.extend(x) or inner(x)
        (ids, counts), = encoder.encode(pa.array(texts))
        assert ids.tolist() == [i for x in want for i in x] and counts.tolist() == [*map(len, want)]
        assert len(given) < 2100  # 4000 chunks and more: first words alone, the others together
    odd = pretokens.JoinedEncoder(lambda chunks: [token_shards.array("i", [len(c.strip())]) for c in chunks], np.ones(5000, np.int64))
    (ids, counts), = odd.encode(pa.array(["ab cde f", "gh ab"]))
    assert ids.tolist() == [2, 3, 1, 2, 2] and counts.tolist() == [3, 2]
