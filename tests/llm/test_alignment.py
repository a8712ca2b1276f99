"""Alignment: against whole texts given to both libraries, and sparse products against dense ones."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskweave.llm import alignment, queries
from tests.conftest import TINY
from tests.llm.conftest import EDGES, prose

COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    "", None, " ", "  ", "a", " a", "a ", "a  b   c ", "tabs\tand\nlines \n x", "it's 3.14, you'll <|endoftext|> see <s> </s> <0x41>",
    "▁ low line", "no\xa0break \xa0 \xa0 x", "ünï 語言 모델 😀😀 é", "\x00 nul", "x" * 500, "語" * 300, "a ▁b", "<unk> <|endoftext|>",
    "1 2 3  4  5 　 6", "don't stop  \r\n\r\n now",
]


@pytest.fixture(scope="module")
def both():
    return alignment.Pair(alignment.BYTES, alignment.PIECES)


def tokens(both, text):
    """Whole texts, one by one."""
    if not text:
        return [], []
    a = both.plain.encode(" " + text, add_special_tokens=False).ids
    b = both.pieces.encode(text)
    want = (" " + text).encode()
    if any(b"".join(names[i] for i in ids) != want for names, ids in zip(both.bytes, (a, b))):
        return [], []
    return a, b


def brute(both, texts):
    seen = []
    for text in texts:
        a, b = tokens(both, text)
        spans = [], []
        for ids, names, out in zip((a, b), both.bytes, spans):
            at = 0
            for i in ids:
                out.append((at, at + len(names[i]), i))
                at += len(names[i])
        linked = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[1] == y[1]]
        overlaps = sum(x[0] < y[1] and y[0] < x[1] for x in spans[0] for y in spans[1])
        groups, last = [], 0
        for end in sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]}):
            groups.append([[x[2] for x in side if last < x[1] <= end] for side in spans])
            last = end
        text_of = ";".join("|".join(",".join(map(str, ids)) for ids in g) for g in groups)
        digest = hashlib.sha256(text_of.encode()).hexdigest() if a else ""
        seen.append((len(a), len(b), len(groups), linked, overlaps, sum(len(x) * len(y) for x, y in groups), digest))
    counts = Counter(p for s in seen for p in s[3])
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [
        (na, nb, g, len(p), sum(counts[x] == highest[x[1]] for x in p), sum(counts[x] for x in p), digest, o, s)
        for na, nb, g, p, o, s, digest in seen
    ]


def check(spark, both, texts, parts=3):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    rows = alignment.scored(frame).orderBy("doc_id").collect()
    got = [tuple(r[c] for c in [*COLUMNS, "n_overlaps", "n_shared"]) for r in rows]
    assert got == brute(both, texts)
    return rows


def test_odd_texts(spark, both):
    rows = check(spark, both, ODD)
    assert rows[0].n_a == rows[10].n_a == rows[16].n_a == 0 and rows[9].n_a > 0


def test_random_pieces(spark, both):
    source = random.Random(3)
    parts = ["word", "Ünï", "語", " ", "  ", "\t", "\n", "\xa0", "'s", ",", "12", "<|endoftext|>", "é", "😀", " ", "The", ".", "-", "�"]
    texts = ["".join(source.choice(parts) for _ in range(source.randrange(1, 25))) for _ in range(600)]
    check(spark, both, texts + texts[:50])


def test_edges_and_clashing_columns(spark, edges, both):
    short = edges.filter("coalesce(doc_id, 0) <> 6").withColumn("pairs", edges.size).withColumn("n_a", edges.part)
    rows = alignment.scored(short).collect()
    texts = [t for i, t in EDGES if i != 6]
    order = Counter(r[:7] for r in brute(both, texts))
    assert Counter(tuple(r[c] for c in COLUMNS) for r in rows) == order
    assert alignment.scored(edges.limit(0)).count() == 0


def test_links_are_rows_of_the_products(spark, both):
    texts = ["Tokenization differs, doesn't it? 語言", "plain words here", None, "▁"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = alignment.links(frame).collect()
    a, b = tokens(both, texts[0])
    sizes = [np.array([len(names[i]) for i in ids]) for names, ids in zip(both.bytes, (a, b))]
    cover = [np.repeat(np.eye(len(x), dtype=int), x, axis=1) for x in sizes]
    dense = cover[0] @ cover[1].T
    assert {(r.a, r.b): r.n for r in found if r.doc_id == 0} == {(i, j): dense[i, j] for i, j in zip(*dense.nonzero())}
    assert all(a[r.a] == r.a_id and b[r.b] == r.b_id for r in found if r.doc_id == 0)
    assert {r.doc_id for r in found} == {0, 1}
    shared = alignment.links(frame, shared=True).filter("doc_id = 0").count()
    assert shared == brute(both, texts)[0][8]


def test_products_against_dense_matrices():
    source = np.random.default_rng(1)
    for _ in range(20):
        x, y = (source.integers(0, 3, (n, m)) * (source.random((n, m)) < 0.3) for n, m in ((7, 5), (5, 9)))
        sparse = [alignment.CSR(np.concatenate(([0], np.cumsum((d > 0).sum(1)))), d.nonzero()[1], d[d.nonzero()]) for d in (x, y)]
        out = alignment.product(*sparse, 9)
        dense = np.zeros((7, 9), int)
        dense[out.rows, out.indices] = out.data
        assert (dense == x @ y).all()
        back = sparse[0].transposed(5)
        dense = np.zeros((5, 7), int)
        dense[back.rows, back.indices] = back.data
        assert (dense == x.T).all()


def test_long_text_without_space(spark, both):
    """Runs longer than a chunk that is remembered, beside prose."""
    check(spark, both, ["ab1" * 2_000, prose(3, 300), "ab1" * 2_000])


def test_registered(spark, both):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_alignment"](spark, TINY).collect()
    assert len(rows) == len(texts)
    short = [r for r in rows if len(texts[r.doc_id] or "") < 3_000]
    whole = brute(both, [texts[r.doc_id] for r in short])
    assert [(r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) for r in short] == [(*w[:4], w[6]) for w in whole]
    assert len(short) > 100
