"""The pipeline's stages on a small folder, each against its brute-force decision."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import quality
from test_llm_operators import brute_groups


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    at, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
        out.append(docs)
    return out


def test_stages(spark, sf_dir, stages):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [d.columns for d in stages[:-1]] == [docs.columns] * 4
    good, lines, unique, clean, packed = stages
    model = quality.train(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    want = {r.doc_id for r in docs.collect() if model.score([quality.statistics(r.text.encode())])[0] >= 0.3}
    assert {r.doc_id for r in good.collect()} == want
    assert lines.count() == good.count() and lines.where(F.length("text") != F.col("n_chars")).count() == 0
    rows = sorted((r.doc_id, r.text) for r in lines.collect())
    roots, _ = brute_groups([t for _, t in rows], 5, 80)
    assert {r.doc_id for r in unique.collect()} == {rows[i][0] for i in range(len(rows)) if roots[i] == i}
    fold = lambda t: " ".join(t.lower().split())
    items = [fold(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = {r.doc_id: fold(r.text) for r in clean.collect()}
    assert not any(i in t for t in left.values() for i in items)
    lost = {r.doc_id for r in unique.collect()} - set(left)
    assert all(any(i[:60] in fold(r.text) or i[-60:] in fold(r.text) for i in items) for r in unique.collect() if r.doc_id in lost)
    assert {r.doc_id for r in packed.collect()} == set(left)


def test_packed_texts_are_the_documents(stages):
    *_, clean, packed = stages
    whole = {}
    for r in packed.orderBy("doc_id", "piece").collect():
        assert r.start == len(whole.get(r.doc_id, "").encode()) and r.end == r.start + len(r.text.encode()) and r.n_tokens == len(r.text.encode().split())
        whole[r.doc_id] = whole.get(r.doc_id, "") + r.text
    assert whole == {r.doc_id: r.text for r in clean.collect()}


def folder(spark, at, rows, labels):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, r string, key string, n long, score double, __hits string, __quality string, __lines string").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality long").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, "who was the first to cross the river with the red boat in that year"), (None, "x"), (2, None)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_stages_at_the_edges(spark, tmp_path):
    """Nulls in every column, repeated ids and rows, ties, clashing names, a very long text."""
    other = ("x", "y", 5, 0.25, "h", "q", "l")
    base = " ".join("word%d" % i for i in range(60))
    texts = [(1, base), (1, base), (1, base + " more"), (None, base), (None, None), (2, None), (3, ""), (3, ""), (4, " \n"), (5, "alone " * 50_000), (6, " ".join("b%d" % i for i in range(50)) + " who was the first to cross the river with the red boat in that year"), (7, "w1 w2"), (7, "w1 w2"), (7, "w3 w4"), (None, "w5 w6"), (None, "w5 w6")]
    rows = [(i, t, None, None if k % 2 else "s", None, *other) for k, (i, t) in enumerate(texts)]
    at = folder(spark, tmp_path, rows, [(None, 1), (1, None)])
    docs, out = spark.read.parquet(f"{at}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, at).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
        out.append(docs)
    good, lines, unique, clean, packed = out
    assert good.count() == lines.count() == len(rows) and all(d.columns == good.columns for d in out[:-1])
    assert all(tuple(r)[5:] == other for r in unique.collect())
    kept = sorted((str(r.doc_id), min(len(r.text or ""), 400) if r.doc_id == 1 else len(r.text or "")) for r in unique.collect())  # of id 1 either text
    assert kept == sorted([("1", 400), ("None", 0), ("2", 0), ("3", 0), ("3", 0), ("4", 2), ("5", 300_000), ("6", len(texts[10][1])), ("7", 5), ("7", 5), ("None", 5)])
    assert clean.count() == unique.count() - 1 and clean.where("doc_id = 6").count() == 0
    assert packed.where("doc_id = 5").count() == 25 and packed.count() == clean.count() + 24


def test_empty_folder(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, [], [])).count() == 0


def test_run(spark, sf_dir, stages):
    assert corpus_pipeline.run(spark, sf_dir).count() == stages[-1].count()
