"""The search index: results, files that are read, generations."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.sources import search


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    r = random.Random(2)
    rows = [(f"m{i % 7}", f"/home/u{r.randrange(30)}/é{i % 13}/file{r.randrange(4_000):05d}.{r.choice(['txt', 'jpg', 'JPG'])}") for i in range(20_000)]
    rows += [("m1", "plain"), ("m1", "/x/"), ("m2", None), ("m3", "/a/b\\1$"), ("m3", "/a/b\\1$"), ("m4", "/z/\U0001f600.png")]
    found = search.SearchIndex(spark, f"file://{tmp_path_factory.mktemp('index')}/at")
    found.build(spark.createDataFrame(rows, "medium_hash string, path string"), rows_per_file=1_000)
    return found, [(m, p) for m, p in rows if p is not None]


def got(frame):
    return sorted((r.medium_hash, r.path) for r in frame.collect())


def read_files(frame):
    """Files that the scan opened, from its metrics."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    nodes, total = [plan], 0
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        metrics = node.metrics()
        if metrics.contains("numFiles"):
            total += metrics.apply("numFiles").value()
    return total


def test_names(index):
    found, rows = index
    name = rows[5][1].rsplit("/", 1)[1]
    one = found.by_name(name)
    assert got(one) == sorted(x for x in rows if x[1].rsplit("/", 1)[-1] == name) and read_files(one) <= 2
    assert len(found.manifest["filename"]) >= 15
    assert got(found.by_name("plain")) == [("m1", "plain")] and got(found.by_name("")) == [("m1", "/x/")] and got(found.by_name("b\\1$", "b\\1$")) == [("m3", "/a/b\\1$")] * 2
    assert got(found.by_name("\U0001f600.png")) == [("m4", "/z/\U0001f600.png")]
    assert got(found.by_name("~none")) == [] and found.files("filename", [("\U0010fff0", "\U0010fff0")]) == [] and got(found.by_name()) == []


def test_many_names(index):
    found, rows = index
    names = sorted({p.rsplit("/", 1)[1] for _, p in rows if "/" in p})[::40]
    matches = {r.filename: (r.match_count, r.found_in) for r in found.matches(*names, "absent").collect()}
    want = {}
    for m, p in rows:
        own = p.rsplit("/", 1)[-1]
        if own in names:
            want.setdefault(own, []).append(m)
    assert matches == {n: (len(x), sorted(set(x))) for n, x in want.items()}


def test_endings(index):
    found, rows = index
    for endings in (["/é3/file00017.jpg"], ["17.jpg", "017.jpg", "file0"], ["JPG"], ["nothing"], [""], ["plain", "\U0001f600.png"]):
        want = sorted(x for x in rows if any(e and x[1].endswith(e) for e in endings))
        assert got(found.by_ending(*endings)) == want
    assert read_files(found.by_ending("/é3/file00017.jpg")) <= 2


def test_plan_pushes_the_filter(index):
    plan = index[0].by_name("x.txt")._jdf.queryExecution().toString() if index[0].files("filename", [("x.txt", "x.txt")]) else index[0].by_name("file00017.jpg")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(filename), EqualTo(filename" in plan or "In(filename" in plan


def test_generations(spark, tmp_path):
    at = f"file://{tmp_path}/g"
    found, other = search.SearchIndex(spark, at), search.SearchIndex(spark, at)
    found.build(spark.createDataFrame([("m", "/a/old")], "medium_hash string, path string"))
    running = other.by_name("old")
    found.build(spark.createDataFrame([("m", "/a/new")], "medium_hash string, path string"))
    assert got(running) == [("m", "/a/old")] and got(found.by_name("old")) == [] and got(found.by_name("new")) == [("m", "/a/new")]
    other.refresh()
    assert got(other.by_name("new")) == [("m", "/a/new")]
    found.vacuum()
    assert len([p for p in (tmp_path / "g").iterdir() if p.is_dir()]) == 1 and got(found.by_name("new")) == [("m", "/a/new")]
    found.build(spark.createDataFrame([], "medium_hash string, path string"))
    assert got(found.by_name("new")) == [] and got(found.by_ending("new")) == []
    assert spark.read.schema("x string").json(f"{at}/manifest.json").agg(F.count("*")).first()[0] == 1
