"""Texts that are no prose: broken HTML, nulls in pages, code, blanks and rulers."""

import random
import time
import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import decontaminate, line_dedup, queries


def test_unclosed_tags_are_read_once(spark):
    openers = "<!-- <script " * 170_000  # 2 MB
    rows = [(1, "a<p>" + openers), (2, "<style>" * 300_000 + "b"), (3, "x<!-- y --><b>z</b><script>q</script>w"), (4, "</script" + " " * 2_000_000), (5, None)]
    start = time.time()
    got = {r.id: r.t for r in spark.createDataFrame(rows, "id long, html string").select("id", line_dedup.html_lines(F.col("html")).alias("t")).collect()}
    assert time.time() - start < 20
    assert got[1] == "a\n" and got[2] == "\n" and got[3] == "x\nz\nw" and got[5] is None


def test_twin_on_nulls_and_repeats(spark, tmp_path):
    rows = [(i, None, "foot<p>n%d" % i) for i in range(5)] + [(10 + i, "no url", "foot<p>e%d" % i) for i in range(40)]
    rows += [(60, None, None), (61, "http://A.b/x", None), (62, "http://a.b/y", ""), (63, "http://a.b/y", "<!-- open"), (63, "http://a.b/y", "<!-- open"), (None, "http://a.b", "one<script>two")]
    rows += [(70 + i, "http://u@C.d:80/%d" % i, "head<br>line %d<br>head" % i) for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = queries.QUERIES["op2_line_dedup"](spark, str(tmp_path))
    columns = sorted(got.columns)
    twin = con.sql(queries.ORACLES["op2_line_dedup"])
    names, want = twin.columns, twin.fetchall()
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == sorted((tuple(r[names.index(c)] for c in columns) for r in want), key=str)
    assert {(r.host, r.n_dropped) for r in got.where("page_id < 60").collect()} == {(None, 1), ("", 1)}


NAMES = ["value", "items", "index", "result", "total", "count", "left", "right", "node", "queue", "matrix", "text"]


def function(r, k):
    lines = [f"def function_{k}({r.choice(NAMES)}, {r.choice(NAMES)}):", '    """Return the ' + " ".join(r.choice(NAMES) for _ in range(12)) + '."""']
    for _ in range(r.randrange(6, 18)):
        x, y = r.choice(NAMES), r.choice(NAMES)
        lines.append(" " * 4 * r.randrange(1, 6) + r.choice([f"for {x} in range(len({y})):", f"if {x} > {y}:", f"{x} = {x} + {y}", f"return {x}", f"{x}.append({y})"]))
    return "\n".join(lines)


@pytest.fixture(scope="module")
def code():
    r = random.Random(1)
    return decontaminate.Index([(k, function(r, k).encode()) for k in range(164)]), r


def timed(index, text):
    raw = np.frombuffer(text.encode(), np.uint8)
    tracemalloc.start()
    start = time.time()
    hits = index.hits(raw, np.array([0, len(raw)]))
    took, peak = time.time() - start, tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return hits, took, peak


@pytest.mark.parametrize("text", [" " * 5_000, " " * 1_000_000, "-" * 1_000_000, "0, " * 300_000, "| --- | --- |\n" * 70_000, "═" * 300_000, "            x\n" * 70_000])
def test_blanks_and_rulers(code, text):
    hits, took, peak = timed(code[0], text)
    assert hits == [] and took < 10 and peak < 1 << 30


@pytest.mark.parametrize("functions", [6, 24, 100])
def test_code(code, functions):
    index, r = code
    text = "\n".join(function(r, 1000 + k) for k in range(functions))
    _, took, peak = timed(index, text)
    assert took < 2 + len(text) / 1_000 and peak < 1 << 30


def test_memory_follows_the_limit_and_not_the_result(code, monkeypatch):
    index, r = code
    texts = ["\n".join(function(r, 2000 + k) for k in range(5)), function(random.Random(1), 0)]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.array([0, len(texts[0]), len(raw)])
    whole = sorted(index.hits(raw, off))
    monkeypatch.setattr(decontaminate, "MOST_PAIRS", 10_000)
    assert sorted(index.hits(raw, off)) == whole
    assert {item for i, item, *_ in whole if i == 1} >= {0}


def test_offsets_are_those_of_the_text():
    words = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa"
    index = decontaminate.Index([(7, words.encode())])
    spaced = "   start \n\n" + "-" * 50 + "\t" + words.replace(" ", " \n\t  ").upper() + "    end"
    raw = np.frombuffer(("x" + spaced).encode(), np.uint8)
    hits = index.hits(raw, np.array([0, 1, len(raw)]))
    lo, hi = min(h[2] for h in hits), max(h[3] for h in hits)
    assert {h[0] for h in hits} == {1} and {h[4] for h in hits} == {0}
    assert "ALPHA" in spaced[lo:hi] and "PAPA" in spaced[lo:hi] and 0 < lo < hi <= len(spaced)


def test_several_blocks_one_index_at_a_time(spark):
    r = random.Random(3)
    bench = spark.createDataFrame([(k, function(r, k)) for k in range(40)], "item_id long, text string")
    docs = spark.createDataFrame([(k, function(random.Random(100 + k), k)) for k in range(30)] + [(99, bench.first().text), (100, None)], "doc_id long, text string")
    one, many = ({x.doc_id: sorted((h.item, h.start, h.end, h.edits) for h in x["__hits"]) for x in decontaminate.contaminated(docs, bench, block_bytes=b).collect()} for b in (1 << 22, 3_000))
    assert one == many and one[99] and one[100] == []


def test_numbers_of_one_prefix_run_short(spark):
    """More than half of the numbers that have the same first two digits."""
    from quarry.llm import pii
    from quarry.llm._scratch import Scratch

    n = 600
    entities = spark.range(n).select(F.lit("abroad").alias("kind"), F.concat(F.lit("49"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("canonical"))
    got = pii.assign(entities, "k", Scratch(spark, "t"))
    row = got.agg(F.count("*").alias("n"), F.count_distinct("surrogate").alias("d"), F.count_if(F.length("surrogate") != 5).alias("odd")).first()
    assert (row.n, row.d, row.odd) == (n, n, 0) and got.join(entities.select(F.col("canonical").alias("surrogate")), "surrogate", "left_semi").isEmpty()


def test_language_sample_is_bounded_by_rows(spark, monkeypatch):
    """One id that thousands of rows repeat."""
    from quarry.llm import language_id

    rows = [(7, "the cat and the dog %d" % i, "en") for i in range(3_000)] + [(i, "le chat et le chien %d" % i, "fr") for i in range(100, 160)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").union(spark.createDataFrame([(7, "the cat and", "en")] * 500, "doc_id long, text string, lang string"))
    model = language_id.fit(docs, per_language=20, held_fold=9)
    assert model.languages == ["en", "fr"]
    assert model.predict(["the dog", "le chien"])[0] == ["en", "fr"]
