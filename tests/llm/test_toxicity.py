"""Operator 13: bags against plain Python, the margins against the bags, and labels that training never saw."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casegrid.llm import toxicity

TEXTS = ["", None, "One two two", "!!! ... ###", "Idiot, idiot! (idiot)", "été Straße 日本", "a b c a b c a", " \t\n x", "x" * 300, "the the The THE end"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_bag(text):
    words = [w for w in (w.strip("!.#,()") for w in (text or "").lower().split()) if w]
    rows = {}
    total = sum(words.count(w) ** 0.5 for w in set(words))
    for w in set(words):
        own = toxicity.subwords([w])[0].tolist()
        for r in own:
            rows[r] = rows.get(r, 0) + words.count(w) ** 0.5 / (total + toxicity.PLAIN) / len(own)
    return rows


def test_subwords():
    rows, sizes = toxicity.subwords(["idiot", "a", "idiott", "日本"])
    # <idiot>: 7 code points, so 5 + 4 + 3 n-grams and the word itself
    assert sizes.tolist() == [13, 2, 16, 1 + 2 + 1] and len(rows) == sizes.sum()
    parts = np.split(rows, np.cumsum(sizes)[:-1])
    for i, word in enumerate(["idiot", "a", "idiott", "日本"]):
        assert (parts[i] == toxicity.subwords([word])[0]).all()
    shared = len(set(parts[0].tolist()) & set(parts[2].tolist()))
    assert shared >= 9  # all n-grams without the border at the end
    assert [len(x) for x in toxicity.subwords([])] == [0, 0]


@pytest.mark.parametrize("slice_bytes", [1, 1 << 20])
def test_bags_and_margins(monkeypatch, slice_bytes):
    monkeypatch.setattr(toxicity, "SLICE_BYTES", slice_bytes)
    found = [*toxicity.bags(pa.array(TEXTS))]
    assert len(found) == len(TEXTS)
    for (rows, weights), text in zip(found, TEXTS, strict=True):
        want = plain_bag(text)
        assert rows.tolist() == sorted(want) and np.allclose(weights, [want[r] for r in rows.tolist()], rtol=1e-6)
    margins = np.random.default_rng(3).normal(size=toxicity.BUCKETS)
    got = np.concatenate([*toxicity.mean_margins(margins, pa.array(TEXTS))])
    assert np.allclose(got, [sum(margins[r] * w for r, w in plain_bag(t).items()) for t in TEXTS])


def corpus(n, seed=4):
    draw = np.random.default_rng(seed)
    syllables = ["an", "re", "tho", "is", "mel", "ka", "or", "vi", "du", "pe", "sha", "lin"]
    bad = ["idiot", "moron", "scumbag"]
    rows = []
    for i in range(n):
        words = ["".join(draw.choice(syllables, int(draw.integers(1, 4)))) for _ in range(int(draw.integers(20, 120)))]
        toxic = int(draw.random() < 0.25)
        for _ in range(toxic * max(2, len(words) // 30)):
            words[int(draw.integers(len(words)))] = str(draw.choice(bad))
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = corpus(700)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return toxicity.train(docs, labels, ~toxicity.held_out(F.col("doc_id")))


def test_held_out_and_misspelt(spark, model):
    rows = corpus(400, 9)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, toxic int"), model).collect()}
    toxic, clean = [got[i] for i, _, y in rows if y], [got[i] for i, _, y in rows if not y]
    assert np.mean(np.array(toxic) >= 0.7) >= 0.9 and np.mean(np.array(clean) < 0.7) >= 0.98
    misspelt = [(i, t.replace("idiot", "idiott").replace("moron", "moronn").replace("scumbag", "scummbag")) for i, t, y in rows if y]
    again = [r["score"] for r in toxicity.score(spark.createDataFrame(misspelt, "doc_id long, text string"), model).collect()]
    # words that training never saw: nearly all such texts stand above nearly all clean ones
    above = np.mean([np.mean(np.array(clean) < x) for x in again])
    assert above >= 0.9


def test_rerun_and_bound(spark, model):
    rows = corpus(700)
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t, _ in rows], DOCS).repartition(7)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    again = toxicity.train(docs, labels, ~toxicity.held_out(F.col("doc_id")))
    assert (again.row_margins() == model.row_margins()).all() and (again.offsets == model.offsets).all()
    small = toxicity.train(docs, labels, F.lit(True), max_per_label=40, max_entries=20_000)
    assert np.isfinite(small.row_margins()).all()


def test_odd_rows(spark, model):
    odd = [(i, t, "en", "s", None) for i, t in enumerate(TEXTS)] + [(None, "idiot", None, None, None), (4, TEXTS[4], "en", "s", 0)]
    docs = spark.createDataFrame(odd, DOCS).withColumns({"score": F.lit("mine"), "toxic": F.lit(5), "bag": F.lit(1)})
    scored = toxicity.score(docs, model, score_col="p")
    assert scored.columns == [*docs.columns, "p"] and scored.where("p IS NULL OR p < 0 OR p > 1").count() == 0 and scored.count() == len(odd)
    same = {r["doc_id"]: r["p"] for r in scored.where("doc_id IN (0, 1, 3, 7)").collect()}
    assert same[0] == same[1] == same[3]  # nothing to go by
    labels = "doc_id long, quality int, toxic int"
    a, b, c, d = [i for i in range(len(TEXTS)) if zlib.crc32(str(i).encode()) % 3 != 1][:4]  # rows that may train
    for given, want in (([], 0.0), ([(a, 1, 1), (b, 1, 1)], 1.0), ([(a, 1, 0), (b, 0, None), (None, 0, 1), (77, 0, 1)], 0.0)):
        out = toxicity.scored_documents(docs, spark.createDataFrame(given, labels)).collect()
        assert len(out) == len(odd) and {r["score"] for r in out} == {want} and {r["predicted"] for r in out} == {int(want)}
    few = toxicity.scored_documents(docs, spark.createDataFrame([(a, 1, 0), (a, 1, 1), (b, 1, 1), (c, 1, 0), (d, 0, 0)], labels))
    assert few.columns == ["doc_id", "held_out", "score", "predicted"] and few.where("score IS NULL OR isnan(score)").count() == 0
    empty = spark.createDataFrame([], DOCS)
    assert toxicity.scored_documents(empty, spark.createDataFrame([], labels)).count() == 0
