"""The pipeline's stages, each against a plain version on its own input, and the whole registered set."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from casegrid.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        new = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
        out.append((docs, new))
        docs = new
    return out


def test_names():
    found = entry.queries()
    assert "pipeline" in found
    assert all(sum(n.startswith(f"op{k}_") for n in found) == 1 for k in range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_columns(stages):
    for docs, new in stages[:-1]:
        assert new.columns == docs.columns


def test_quality_stage(spark, stages):
    docs, new = stages[0]
    kept = {r["doc_id"] for r in new.select("doc_id").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good, bad = [i for i in labels if labels[i] == 1], [i for i in labels if labels[i] == 0]
    assert sum(i in kept for i in good) >= 0.95 * len(good) and sum(i in kept for i in bad) <= 0.3 * len(bad)


def test_near_duplicate_stage(stages):
    from test_llm_operators import components

    docs, new = stages[1]
    rows = [(r["doc_id"], r["text"], None) for r in docs.collect()]
    want = {low for _, low in components(rows, 5, 80).values()}
    assert sorted(r["doc_id"] for r in new.collect()) == sorted(want)


def test_mixture_stage(stages):
    docs, new = stages[2]
    before, after = {r["doc_id"] for r in docs.collect()}, Counter(r["doc_id"] for r in new.collect())
    assert set(after) == before and max(after.values()) == 2
    words = lambda d: d.agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")))).first()[0]
    assert 1.4 <= words(new) / words(docs) <= 1.6


def test_token_stage(stages):
    import public_tokenizers
    import tiktoken

    from casegrid.llm import bpe

    docs, new = stages[3]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(f.read()), special_tokens={})
    want = Counter((r["doc_id"], tuple(encoding.encode_ordinary(r["text"]))) for r in docs.collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in new.collect()) == want
    assert new.where("NOT decodes").count() == 0


def test_odd_rows(spark, tmp_path):
    """Nulls, empty and repeated rows, and further columns, through all stages."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "And then the of and in the that was a for on with it as his by at this from but not. " * 3
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text + "end", None, None, None), (None, text, "en", "s", 1), (3, None, "en", "s", 0), (4, "", "en", "s", 0)]
    spark.createDataFrame(rows, schema).withColumns({"mix": F.lit(1), "score": F.lit(2), "kept_id": F.lit(3)}).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    alone = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert alone.columns == docs.columns and sorted(r["doc_id"] for r in alone.collect()) == [1, 3, 4]
    mixed = [r["doc_id"] for r in corpus_pipeline.mixture(spark, docs, str(tmp_path)).collect()]
    assert mixed[-2:] == [3, 4] and Counter(mixed).keys() == {1, 2, None, 3, 4} and mixed.count(3) == mixed.count(4) == 1
    passed = {r["doc_id"] for r in corpus_pipeline.quality_filter(spark, docs, str(tmp_path)).collect()}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 1 in passed and {r["doc_id"] for r in got} == passed & {1, 3, 4}
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_batches_of_long_texts(spark):
    """Whole texts reach the workers some MB at a time, however long they are; a smaller limit stays."""
    import pyarrow as pa

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(name)
    docs = spark.range(0, 60, 1, 1).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.repeat(F.lit("word "), 100_000).alias("text"))
    try:
        spark.conf.unset(name)
        found = corpus_pipeline.token_ids(spark, docs, SF)
        most = max(r["n"] for r in docs.mapInArrow(sizes, "n long").collect())
        assert most < 15 and found.where("decodes").count() == 60
        spark.conf.set(name, "1m")
        corpus_pipeline.token_ids(spark, docs, SF)
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, old)
