"""Joins by similarity: classes against brute force, on odd rows, hot groups and small blocks."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from riskweave.llm import embedding_dedup, graph, jaccard_join, queries, shingles
from tests.compare import connect, difference
from tests.conftest import TINY
from tests.llm.conftest import EDGES, prose

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def classes(nodes, links):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    return {n: top(n) for n in nodes}


def brute(docs):
    sets = {i: shingle_set(t) for i, t in docs}
    links = [
        (a, b) for a, b in combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    found = classes(sets, links)
    return {i: (len(sets[i]), found[i]) for i in sets}


def joined(spark, docs, parts=3):
    rows = jaccard_join.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def near_copies(source, base, n, changes):
    words = base.split()
    for _ in range(n):
        copy = list(words)
        for _ in range(source.randint(0, changes)):
            copy[source.randrange(len(copy))] = str(source.random())
        yield " ".join(copy)


def test_shingle_sets_match_plain_ones():
    texts = [t for _, t in EDGES] + [None, "a b c d e", "A B C d  E\nf", "é É x y z w", "a b c d e f a b c d e f"]
    found = shingles.shingle_sets(pa.array(texts))
    assert [len(s) for s in found] == [len(shingle_set(t)) for t in texts]
    both = dict(zip(texts, found, strict=True))
    assert shingles.common(both["a b c d e"], both["A B C d  E\nf"]) == 1


def test_join_on_odd_rows(spark, edges):
    rows = jaccard_join.join(edges).collect()
    assert len(rows) == len(EDGES)
    for r in rows:
        text = dict(EDGES)[r.doc_id]
        assert r.n_shingles == len(shingle_set(text))
        assert r.component_id == (7 if r.doc_id == 8 else r.doc_id)


@pytest.mark.parametrize("block", [1_024, 8])
def test_join_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    source = random.Random(5)
    passage = prose(900, 30)
    texts = []
    for k in range(12):
        texts += near_copies(source, prose(k, source.randint(8, 90)), source.randint(1, 12), 4)
    # Unlike texts with a long passage in common, some of them half of it.
    texts += [f"{passage} {prose(200 + k, source.randint(5, 40))}" for k in range(40)]
    texts += [passage + " end"] * 15 + list(near_copies(source, passage, 25, 2))
    source.shuffle(texts)
    docs = list(enumerate(texts, 100))
    assert joined(spark, docs) == brute(docs)


def test_join_with_a_hot_group(spark):
    source = random.Random(6)
    texts = [prose(0, 60)] * 200 + list(near_copies(source, prose(1, 60), 200, 2)) + [prose(k, 30) for k in range(2, 200)]
    docs = list(enumerate(texts))
    assert joined(spark, docs, 7) == brute(docs)


def test_rows_without_id_stand_for_no_other(spark):
    """Null-id copies before and beside documents whose near copies link with them."""
    source = random.Random(9)
    bases = [prose(k, 40) for k in range(20)]
    near = [" ".join(b.split()[:-1]) for b in bases]
    docs = [*enumerate(bases), *enumerate(near, 100)]
    source.shuffle(docs)
    rows = [(None, t) for t in bases + near] + docs
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = jaccard_join.join(frame).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == brute(docs)
    assert len(found) == len(rows)


def test_buckets_of_repeated_rows_stay_apart(spark):
    """Each row twice, read in different tasks: unlike buckets of one size must not look alike."""
    rows = [(5, [1]), (6, [2]), (7, [1, 2]), (9, [1, 2]), (11, [3]), (12, [3]), (13, [4]), (14, [4])]
    sketch = spark.createDataFrame([(i, 9, f) for i, f in rows], "doc_id long, n long, first array<long>").coalesce(1)
    bucket = jaccard_join.buckets(sketch.union(sketch))
    assert bucket.count() == bucket.distinct().count() == sum(len(f) for _, f in rows)
    kept = jaccard_join.divided(bucket, spark.createDataFrame([], "node long, component long")).collect()
    expected = {(t, i) for i, f in rows for t in f}
    assert {(r.token, r.doc_id) for r in kept} == expected and all(r.weight == 1 for r in kept)


def test_join_of_repeated_rows(spark):
    source = random.Random(10)
    passage, texts = prose(900, 30), []
    for k in range(10):
        texts += near_copies(source, f"{passage} {prose(k, source.randint(5, 20))}", 6, 3)
    docs = list(enumerate(texts))
    frame = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    rows = jaccard_join.join(frame.union(frame)).collect()
    assert len(rows) == 2 * len(docs) and {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute(docs)


def test_tree_loses_no_pair():
    source = np.random.default_rng(3)
    base = source.poisson(1, (6, jaccard_join.GROUPS))
    points = np.concatenate([np.maximum(b + (source.random((20, len(b))) < 0.03), 0) for b in base]).astype(np.uint8)
    n = points.sum(1).astype(np.int64)
    component, excess = source.integers(0, 50, len(n)), np.zeros(len(n), np.int64)
    tree = jaccard_join.Tree(points, n, excess, component)
    found = {tuple(sorted(p)) for p in zip(*jaccard_join.surviving(tree, tree), strict=True)}
    expected = {
        (a, b) for a, b in combinations(range(len(n)), 2)
        if component[a] != component[b] and 4 * min(n[a], n[b]) >= 3 * max(n[a], n[b])
        and np.minimum(points[a], points[b]).sum(dtype=int) >= jaccard_join.needed(n[a], n[b])
    }
    assert found == expected and len(expected) > 100


def test_components(spark):
    source = random.Random(8)
    edges = [(source.randrange(300), source.randrange(300)) for _ in range(200)] + [(400 + k, 401 + k) for k in range(60)]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert found == classes(nodes, edges)


def test_join_of_an_empty_table(edges):
    assert jaccard_join.join(edges.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op4_embedding_dedup", "op6_jaccard_join"])
def test_registered_against_sql(spark, name):
    assert difference(name, queries.QUERIES[name], queries.ORACLE_SQL[name], spark, connect(TINY), TINY) is None


def links_of(vectors):
    unit = np.array(vectors, float)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= embedding_dedup.COSINE
    np.fill_diagonal(linked, False)
    return linked


@pytest.mark.parametrize("block", [1_024, 64])
def test_vectors_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "OVERLAP", block // 4)
    source = np.random.default_rng(4)
    centres = source.standard_normal((20, 16))
    vectors = np.concatenate([c + source.standard_normal((source.integers(1, 40), 16)) * 0.3 for c in centres])
    vectors = np.concatenate((vectors, vectors[:30], np.repeat(vectors[:1], 300, 0), source.standard_normal((400, 16))))
    linked = links_of(vectors)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame, recall=0.99999).collect()}
    expected = classes(range(len(vectors)), zip(*np.nonzero(linked), strict=True))
    assert [found[k].n_links for k in found] == [linked[k].sum() for k in found]
    assert {k: r.component_id for k, r in found.items()} == expected
    assert all(r.kept == (k == r.component_id) for k, r in found.items())


def test_vectors_around_one_base(spark, monkeypatch):
    """A dense group of edited copies, each linked with the base but not with each other."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    monkeypatch.setattr(embedding_dedup, "OVERLAP", 16)
    source = np.random.default_rng(11)
    base = source.standard_normal(64)
    base /= np.linalg.norm(base)
    noise = source.standard_normal((1_500, 64))
    noise -= np.outer(noise @ base, base)
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    copies = 0.905 * base + np.sqrt(1 - 0.905**2) * noise
    vectors = np.concatenate((copies, base[None], source.standard_normal((1_500, 64))))
    source.shuffle(vectors)
    linked = links_of(vectors)
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in embedding_dedup.near_duplicates(frame.repartition(4), recall=0.99999).collect()}
    assert linked.sum(1).max() >= 1_500 > 10 * np.median(linked.sum(1))
    assert {k: r.component_id for k, r in found.items()} == classes(range(len(vectors)), zip(*np.nonzero(linked), strict=True))
    assert [found[k].n_links for k in found] == [linked[k].sum() for k in found]


def test_odd_vectors(spark):
    good = [1.0, 2.0, 3.0]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 1.0]), (5, [float("nan"), 1.0, 1.0]),
        (6, [float("inf"), 1.0, 1.0]), (7, good), (8, good), (9, [2.0, 4.0, 6.0]), (10, [1.0, 2.0]), (None, good),
        (9, [-1.0, 0.0, 0.0]), (11, [1e-200, 2e-200, 3e-200]),
    ]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, copies int, rep int")
    found = sorted(map(tuple, embedding_dedup.near_duplicates(frame).collect()), key=str)
    alone = {i: (i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10)}
    linked = [(7, 3, 7, True), (8, 3, 7, False), (9, 3, 7, False), (11, 3, 7, False)]
    assert found == sorted([*alone.values(), *linked, (9, 0, 9, True), (None, 0, None, None)], key=str)
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0
