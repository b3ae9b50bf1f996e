"""Spelling variants against all pairs, and their defined results at the edges."""

import random
import re
import zlib
from collections import Counter

import pytest

from quarry.llm import queries, spelling

DOC = "doc_id long, text string, word string, n long, id long, next string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    near = {w: [] for w in words}
    ordered = sorted(words)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if abs(len(a) - len(b)) <= 1 and one_edit(a, b):
                near[a].append(b), near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return out


def result(frame):
    rows = frame.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh", "aéÿz"])
def test_all_pairs(spark, alphabet):
    r = random.Random(len(alphabet))
    base = ["".join(r.choice(alphabet) for _ in range(r.randrange(5, 12))) for _ in range(60)]
    words = {}
    for w in base:
        words[w] = r.choice([1, 3, 40, 500, 7000])
        for _ in range(6):
            k, c = r.randrange(len(w) + 1), r.choice(alphabet)
            words.setdefault(r.choice([w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]]), r.choice([1, 2, 30, 30]))
    words.pop("", None)
    got = result(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute(words)
    assert any(row[1] for row in got)


def test_prefixes_doubled_characters_and_long_words(spark):
    words = {"a": 1, "aa": 20, "aaa": 400, "aaaa": 8000, "aab": 7, "b": 1, "ab": 90, "x" * 50_000: 3, "x" * 50_001: 40, "x" * 20_000 + "y" + "x" * 29_999: 9, "\U0001f600a": 5, "\U0001f600": 60}
    got = result(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute(words)
    assert {row[2] for row in got if row[0] in ("aa", "aaa", "aaaa")} == {"aaaa"}  # a chain of two


def test_counts_of_whole_texts(spark):
    r = random.Random(5)
    vocabulary = ["Straßenbahn", "ÉLANÉLAN", "continuation", "wordwordword", "sevenab", "sixabc"]
    rows = [(i, " ".join(r.choice(vocabulary) + r.choice(["", ".", "1", "×"]) for _ in range(300))) for i in range(40)]
    rows += [(None, "continuation " * 50), (7, None), (8, ""), (9, " \n\t 12"), (1, rows[1][1]), (1, rows[1][1]), (50, "q" * 40_000 + " " + "q" * 40_000)]
    docs = spark.createDataFrame([(i, t, "w", 1, 2, "n") for i, t in rows], DOC)
    assert {(r.word, r.n) for r in spelling.word_counts(docs).collect()} == set(counted(rows).items())
    assert result(spelling.variants(spelling.word_counts(docs))) == brute(counted(rows))


def test_empty(spark):
    assert spelling.variants(spelling.word_counts(spark.createDataFrame([], DOC))).collect() == []
    assert spelling.variants(spelling.word_counts(spark.createDataFrame([(1, None, "w", 1, 2, "n")], DOC))).collect() == []


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op11_spelling"](spark, sf_dir)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert result(got) == brute(counted([(r.doc_id, r.text) for r in docs]))
