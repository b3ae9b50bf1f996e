"""The toxicity classifier: responses against a convolution over every word, held-out accuracy, edges."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import _text, queries, toxicity

DOC = "doc_id long, text string, lang string, source string, r string, label long, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", "x", 1, 0.5) for i, t in rows], DOC)


def labelled(n=1500, seed=11):
    """Half English, half German; toxic texts hold some of a few words, or stems that take many endings."""
    r = random.Random(seed)
    syllables = ["ka", "lo", "mi", "tes", "run", "bel", "or", "ing", "sta", "wen"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randrange(2, 5)))
    rows, labels = [], []
    for i in range(n):
        common = (toxicity.COMMON["en"] if i % 2 else toxicity.COMMON["de"]).split()
        words = [r.choice(common) if r.random() < 0.4 else word() for _ in range(r.randrange(20, 200))]
        bad = r.random() < 0.2
        for _ in range(r.randrange(2, 5) if bad else 0):
            own = r.choice(["grubby", "Vile", "NASTY!"]) if i % 2 else "widerlich" + word()
            words.insert(r.randrange(len(words)), own)
        if not bad and r.random() < 0.05:
            words.append(r.choice(["vil", "grubb", "wider"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = labelled()
    docs, marks = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    return rows, dict(labels), toxicity.fit(docs, marks), docs


def whole_convolution(model, text):
    """The log odds by responses at every place of the padded text."""
    words = re.findall(rb"[A-Za-z\x80-\xff]+", (text or "").encode())
    pad = max(toxicity.WIDTHS + toxicity.WIDE)
    vectors = np.zeros((len(words) + 2 * pad, toxicity.DIMS))
    for k, w in enumerate(words):
        raw = np.frombuffer(w, np.uint8)
        whole = _text.word_hashes(raw, np.array([0]), np.array([len(raw)])) | np.uint64(1)
        hashes = toxicity.features(raw, np.array([0]), np.array([len(raw)]), whole)[0]
        for h in hashes[hashes > 0]:
            one, two = (int(b[0]) for b in toxicity.buckets(np.array([h])))
            if one in model.used and two in model.used:
                vectors[pad + k] += model.table[1 + np.searchsorted(model.used, one)] + model.table[1 + np.searchsorted(model.used, two)]
    logit = model.offset
    for k, width in enumerate(toxicity.WIDTHS + toxicity.WIDE):
        f = model.filters[k] if k < len(toxicity.WIDTHS) else np.repeat(model.filters[k][None], width, 0)
        response = np.array([np.einsum("wd,wdf->f", vectors[s : s + width], f) for s in range(len(vectors) - width + 1)]) + model.bias[k]
        logit += np.maximum(response, 0).max(0) @ model.weights[k * toxicity.FILTERS : (k + 1) * toxicity.FILTERS]
    return logit


EDGE = [None, "", " \n", "12 %", "grubby", "The vile", "nasty " * 300, "x" * 30_000, "widerlichtes widerlichka", "éé ñ grubby \U0001f600 Vile"]


def test_responses(learned):
    rows, _, model, _ = learned
    texts = [t for _, t in rows[:30]] + EDGE
    column = _text.buffers(pa.array(texts))
    batch = toxicity.Batch.of(*column)
    got = model.log_odds(batch.n, *model.used_words(batch))
    assert np.allclose(got, [whole_convolution(model, t) for t in texts], atol=1e-8)


def test_held_out_accuracy(learned):
    rows, label, model, docs = learned
    got = {r.doc_id: r.score for r in toxicity.annotate(docs, model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    right = [(got[i] >= toxicity.THRESHOLD) == bool(label[i]) for i in held]
    assert len(held) > 200 and np.mean(right) > 0.98
    # inflected forms that no learning text holds
    assert all((got[i] >= toxicity.THRESHOLD) == bool(label[i]) for i in held if i % 2 == 0 and label[i])
    assert (model.cut[[toxicity.LANGUAGES.index("de"), toxicity.LANGUAGES.index("en")]] != model.cut[-1]).any()


def test_learning_repeats(spark, learned):
    rows, labels, model, docs = learned
    again = toxicity.fit(docs.repartition(7), spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    assert (model.used == again.used).all()
    left, right = ({r.doc_id: r.score for r in toxicity.annotate(docs, m).collect()} for m in (model, again))
    assert all((left[i] >= toxicity.THRESHOLD) == (right[i] >= toxicity.THRESHOLD) for i in left)


def test_the_score_depends_on_the_text_alone(spark, learned):
    rows, _, model, docs = learned
    other = docs.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit(None).cast("string").alias("lang"), F.lit("q").alias("source"))
    left = sorted((r.doc_id + 7, r.score) for r in toxicity.annotate(docs, model).collect())
    assert left == sorted((r.doc_id, r.score) for r in toxicity.annotate(other, model).collect())


def test_edges(spark, learned):
    rows, labels, model, _ = learned
    docs = frame(spark, list(enumerate(EDGE)) + [(0, "nasty"), (None, "nasty")])
    got = toxicity.annotate(docs, model)
    assert got.columns == docs.columns
    scores = [(r.doc_id, r.score) for r in got.collect()]
    assert len(scores) == len(EDGE) + 2 and all(0 <= s <= 1 for _, s in scores)
    by = dict(scores[1:10])
    assert scores[0][1] == by[1] == by[2] == by[3] < toxicity.THRESHOLD and by[6] > toxicity.THRESHOLD
    assert toxicity.annotate(frame(spark, []), model).collect() == []
    none = toxicity.fit(docs, spark.createDataFrame([(1, None), (2, 0), (2, 1)], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.annotate(docs, none).collect()} == {0.5}
    one = toxicity.fit(docs, spark.createDataFrame([(i, 0) for i in range(10)], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.annotate(docs, one).collect()} == {0.0}


def test_languages_by_common_words():
    texts = ["the cat and the dog", "der Hund und die Katze", "le chat et les chiens", "el gato y los perros", "zzz", ""]
    batch = toxicity.Batch.of(*_text.buffers(pa.array(texts)))
    assert [toxicity.LANGUAGES[k] if k >= 0 else None for k in batch.languages()] == ["en", "de", "fr", "es", None, None]


def test_query(spark, sf_dir):
    got = queries.QUERIES["op12_toxicity"](spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.3) for r in rows)


def test_accuracy_on_the_tables(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = queries.QUERIES["op12_toxicity"](spark, folder).where("held_out").join(labels, "doc_id").collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == k] for k in (1, 0))
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.01
