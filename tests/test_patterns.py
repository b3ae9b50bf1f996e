"""Many patterns against the alternation of all of them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.functions import columns as c
from quarry.functions import patterns
from quarry.operators import ingest

PATTERNS = [
    "node_modules", r"\.cache", "^/proc/", r"~$", r"/(tmp|temp)/", r"a+b", r"(abc)+d", r"x?yz", r"[Tt]humbs\.db", r"\d{4}-\d\d", "(?i)desktop", r"foo|bar", r"(one|two)three", r"q{2,3}r", r"end$|^start", r"\Qa.b\E", r"é+ü",
    r"a(?:b|c)d", r"\.(jpg|png)$", r"dot.com", r"(x|)y", r"back\\slash", r"tab\tx", "",
]


@pytest.fixture(scope="module")
def paths(spark):
    r = random.Random(8)
    parts = ["node_modules", ".cache", "/proc/", "~", "/tmp/", "/temp/", "aab", "ab", "abcabcd", "abcd", "yz", "xyz", "Thumbs.db", "thumbsXdb", "2020-12", "DESKTOP", "foo", "bar", "twothree", "qqr", "qr", "end", "start", "a.b", "éü", "ü", "abd", "acd", ".jpg", ".png", "dotxcom", "y", "back\\slash", "tab\tx", "plain", "/", "#", "\n"]
    rows = [("".join(r.choice(parts) for _ in range(r.randrange(1, 4))),) for _ in range(1500)] + [("",), (None,), ("plain",)]
    return spark.createDataFrame(rows, "path string").cache()


@pytest.mark.parametrize("pattern", PATTERNS[:-1])
def test_one_pattern(paths, pattern):
    assert paths.where(~patterns.matches(F.col("path"), [pattern]).eqNullSafe(F.col("path").rlike(pattern))).count() == 0


def test_all_patterns(paths):
    r = random.Random(1)
    for k in (2, 5, 10, len(PATTERNS) - 1):
        some = r.sample(PATTERNS[:-1], k)
        want = F.col("path").rlike("|".join(some))
        assert paths.where(~patterns.matches(F.col("path"), some).eqNullSafe(want)).count() == 0
    words = ["".join(r.choice("abcé/.$") for _ in range(r.randrange(1, 6))) for _ in range(60)]
    some = [re.escape(w) for w in words]
    text = "concat(path, 'ab/c.a$é')"
    assert paths.where(~patterns.matches(F.expr(text), some).eqNullSafe(F.expr(text).rlike("|".join(some)))).count() == 0


def test_required():
    want = {"node_modules": ["node_modules"], r"\.cache": [".cache"], "^/proc/": ["/proc/"], r"foo|bar": ["foo", "bar"], r"(abc)+d": ["abc"], r"x?yz": ["yz"], r"\d\d": None, "(?i)x": None, r"(x|)y": ["y"], "foo|b*": None, "": None}
    assert {p: patterns.required(p) for p in want} == want
    assert [p for p in PATTERNS if patterns.is_plain(p)] == ["node_modules", r"\.cache", r"back\\slash", r"tab\tx"]
    assert patterns.trie(["ab", "abc", "ad", "x"]) == "(?:a(?:b|d)|x)"


def test_excluded_and_impact(spark, paths):
    marks = paths.select(c.excluded(F.col("path"), PATTERNS[:5] + ["# a comment", " "]).alias("m"), F.col("path").rlike("|".join([*PATTERNS[:5], "#"])).alias("w"))
    assert marks.where("coalesce(w, false) <> (m is not null)").count() == 0
    assert paths.where(c.excluded(F.col("path"), []).isNotNull()).count() == paths.where("path like '%#%'").count()
    assert ingest.drop_excluded(paths, []).count() == paths.count()
    got = {r.pattern: r.n_paths for r in ingest.pattern_impact(paths, PATTERNS + ["foo|bar"]).collect()}
    assert got == {p: paths.where(F.col("path").rlike(p)).count() for p in PATTERNS if p}
    assert ingest.pattern_impact(paths, ["# none"]).collect() == []
