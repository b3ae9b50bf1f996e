"""Token alignment against a plain walk over the tokens' byte ranges."""

import hashlib
from bisect import bisect_left
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import alignment, queries

DOC = "doc_id long, text string, row long, pairs string, r string, n_a string"
EDGE = [
    None, "", " ", "\n\t ", "one", "One two  three   four\n\n", "<|endoftext|> <s> </s> <unk> <0x41>", "a▁b", "▁", "x" * 50_000, " " * 5_000 + "x", "\n" * 3_000,
    "éñü ß 漢字 \U0001f600\U0001f600 ﬁ ½", "don't it's we'll 1234567890 12.5%   x", "\x00\x01\x7f", "one", "éé", "word " * 4_000,
]


@pytest.fixture(scope="module")
def plain():
    """(ids, bytes) of both tokenizers for a text, straight from the two libraries."""
    whole = Tokenizer.from_file(f"{alignment.TOKENIZERS}/{alignment.BYTE_LEVEL}")
    whole.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/{alignment.PIECES}")
    byte = alignment.byte_of_character()

    def encode(text):
        a = whole.encode(" " + text, add_special_tokens=False).ids
        b = model.encode(text)
        pieces = [model.id_to_piece(i) for i in b]
        return (
            [(i, bytes(byte[c] for c in whole.id_to_token(i))) for i in a],
            [(i, bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()) for i, p in zip(b, pieces)],
        )

    return encode


def ranges(tokens):
    at, out = 0, []
    for i, spelled in tokens:
        out.append((i, at, at + len(spelled)))
        at += len(spelled)
    return out


def brute(texts, encode):
    each = []
    for text in texts:
        a, b = encode(text) if text else ([], [])
        whole = (" " + text).encode() if text else b""
        if b"".join(s for _, s in a) != whole or b"".join(s for _, s in b) != whole:
            a, b = [], []
        a, b = ranges(a), ranges(b)
        links, j = [], 0
        for i, lo, hi in a:
            while j < len(b) and b[j][2] <= lo:
                j += 1
            k = j
            while k < len(b) and b[k][1] < hi:
                links.append((i, b[k][0]))
                k += 1
        groups, done = [], 0
        for end in sorted({z for *_, z in a} & {z for *_, z in b}):
            part = []
            for side in (a, b):
                first = bisect_left(side, done, key=lambda x: x[1])
                part.append(",".join(str(i) for i, *_ in side[first : bisect_left(side, end, key=lambda x: x[1])]))
            groups.append("|".join(part))
            done = end
        each.append((len(a), len(b), groups, links))
    held = Counter(pair for *_, links in each for pair in set(links))
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return [
        (n_a, n_b, len(groups), len(links), sum(held[p] == most[p[0]] for p in links), sum(held[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for n_a, n_b, groups, links in each
    ]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


@pytest.mark.parametrize("most", [alignment.MOST_BROADCAST, 0])
def test_edges_by_broadcast_and_by_join(spark, plain, most):
    docs = spark.createDataFrame([(i, t, 5, "p", "r", "x") for i, t in enumerate(EDGE)], DOC)
    aligned = alignment.align(docs)
    assert aligned.columns == ["doc_id", "text", "row", "r", *alignment.OWN]
    assert {r.doc_id: (r.text, r.row, r.r) for r in aligned.collect()} == {i: (t, 5, "r") for i, t in enumerate(EDGE)}
    rows = {r.doc_id: r for r in alignment.weigh(aligned, most_broadcast=most).collect()}
    assert len(rows) == len(EDGE)
    for i, want in enumerate(brute(EDGE, plain)):
        groups = rows[i].groups
        assert (*(rows[i][c] for c in NAMES), hashlib.sha256(groups.encode()).hexdigest() if groups else "") == want, EDGE[i]


def test_without_ranks(plain):
    slow, fast = (alignment.ByteLevel(f"{alignment.TOKENIZERS}/{alignment.BYTE_LEVEL}", fast=f) for f in (False, True))
    assert slow.by_rank is None and fast.by_rank is not None
    texts = [" " + t for t in EDGE if t]
    assert slow.encode(texts) == fast.encode(texts)


def test_every_code_point_encodes_alike():
    slow, fast = (alignment.ByteLevel(f"{alignment.TOKENIZERS}/{alignment.BYTE_LEVEL}", fast=f) for f in (False, True))
    points = [c for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{chr(c)}b {chr(c)} 1{chr(c)}2 .{chr(c)}" for c in points[k : k + 64]) for k in range(0, len(points), 64)]
    assert slow.encode(texts) == fast.encode(texts)


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOC)
    assert alignment.weigh(alignment.align(docs)).collect() == []
    docs = spark.createDataFrame([(None, None, 5, "p", "r", "x")], DOC)
    assert [tuple(r[c] for c in NAMES) for r in alignment.weigh(alignment.align(docs)).collect()] == [(0,) * 6]


def test_query(spark, plain, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = queries.QUERIES["op13_alignment"](spark, sf_dir)
    assert dict(got.dtypes) == {"doc_id": "bigint", **dict.fromkeys(NAMES, "bigint"), "groups_sha256": "string"}
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == len(docs)
    for d, want in zip(docs, brute([d.text for d in docs], plain)):
        assert (*(rows[d.doc_id][c] for c in NAMES), rows[d.doc_id].groups_sha256) == want
    assert got.agg(F.sum("n_links")).first()[0] > 0
