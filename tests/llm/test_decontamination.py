"""Decontamination: against brute force over all windows, and the fingerprint's guarantees."""

import random
import re
from collections import Counter

import pytest

from riskweave.llm import decontamination, queries
from tests.compare import connect, difference
from tests.conftest import TINY
from tests.llm.conftest import EDGES, prose
from tests.llm.test_joins import LOWER


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def bag(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(docs, items):
    out = {}
    for i, text in docs:
        w = words(text)
        for item, other in items:
            v = words(other)
            k = min(5, len(v))
            theirs = bag(v, k)
            best = 0
            for s in range(max(len(w) - len(v), 0) + 1 if v else 0):
                ours = bag(w[s : s + len(v)], k)
                c = sum((ours & theirs).values())
                total = sum((ours | theirs).values())
                best = max(best, c / total if total else 0)
            if 4 * best >= 3:
                out.setdefault(i, {})[item] = best
    return out


def found(spark, docs, items):
    rows = decontamination.mark(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert sorted(r.doc_id for r in rows) == sorted(i for i, _ in docs)
    for r in rows:
        assert r.contaminated == (r.n_items > 0)
    return {r.doc_id: (list(r.item_ids), pytest.approx(r.similarity)) for r in rows if r.contaminated}


def test_matches_brute_force(spark):
    source = random.Random(4)
    items = [(k, prose(k, source.randint(6, 60))) for k in range(12)] + [(20, "one two"), (21, "go go go go go go go go")]
    docs = []
    for k in range(150):
        item = words(source.choice(items)[1])
        edited = list(item)
        for _ in range(source.randint(0, 3)):
            at = source.randrange(len(edited))
            edited[at : at + 1] = source.choice([[], ["new"], [edited[at], "extra"]]) or ["x"]
        before, after = prose(500 + k, source.randint(0, 40)), prose(900 + k, source.randint(0, 40))
        text = source.choice([f"{before} {' '.join(edited)} {after}", " ".join(edited), " ".join(item).upper(), before])
        docs.append((k, text))
    docs += [(200, "go " * 30), (201, f"{items[0][1]} {items[1][1]}"), (202, "two one two"), (203, items[3][1] * 2)]
    expected = {i: (sorted(x), pytest.approx(max(x.values()))) for i, x in brute(docs, items).items()}
    got = found(spark, docs, items)
    assert got == expected and len(got) > 50


def test_odd_rows(spark, edges):
    items = [(1, None), (2, ""), (3, "same text twice"), (3, "same text twice"), (None, "a"), (5, prose(6, 300))]
    frame = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    rows = decontamination.mark(edges, frame).collect()
    assert len(rows) == len(EDGES)
    flagged = sorted(r.doc_id for r in rows if r.contaminated)
    assert flagged == [4, 6, 7, 7, 8]
    kept = decontamination.clean(edges, frame)
    assert kept.columns == edges.columns and kept.count() == len(EDGES) - 5
    assert decontamination.mark(edges, frame.limit(0)).filter("contaminated").count() == 0
    assert decontamination.mark(edges.limit(0), frame).count() == 0


def test_repeated_rows_items_and_ids(spark):
    """Rows are judged by their own text, as often as they come; equal items are reported under every id."""
    item = prose(1, 20)
    near = " ".join([*item.split()[:-1], "other"])
    docs = [(1, near)] * 2 + [(2, near), (3, prose(2, 30)), (None, f"{item} end"), (None, "clean"), (2, "also clean")]
    items = [(7, item)] * 2 + [(8, item), (None, item), (None, prose(9, 12)), (7, prose(3, 8)), (-1, prose(4, 9))]
    rows = decontamination.mark(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    got = sorted((r.doc_id or 0, r.contaminated, r.n_items, round(r.similarity, 4)) for r in rows)
    same = round(15 / 17, 4)
    assert got == sorted([
        (1, True, 3, same), (1, True, 3, same), (2, True, 3, same), (2, False, 0, 0.0), (3, False, 0, 0.0),
        (0, True, 3, 1.0), (0, False, 0, 0.0),
    ])
    assert all(list(r.item_ids) == [7, 8] for r in rows if r.contaminated)


@pytest.mark.parametrize("seed", [1, 2])
def test_short_and_repetitive_items(spark, seed):
    """Small bags and bags with one heavy shingle: fingerprints say nothing, the comparison stays exact."""
    source = random.Random(seed)
    items = [(k, prose(40 * seed + k, 6 + k % 5)) for k in range(40)]
    items += [(100 + k, prose(k, 30) + " go" * (12 + k)) for k in range(5)]
    docs = []
    for k in range(300):
        words_ = source.choice(items)[1].split()
        at = source.randrange(len(words_))
        edited = [words_[:at] + words_[at + 1 :], words_[:-1], words_ + ["more"], words_[1:], words_ + ["go"] * 9][k % 5]
        docs.append((k, f"{prose(800 + k, k % 7)} {' '.join(edited)}"))
    expected = {i: (sorted(x), pytest.approx(max(x.values()))) for i, x in brute(docs, items).items()}
    assert found(spark, docs, items) == expected and len(expected) > 60


def test_blocks_find_all_within_the_radius(spark):
    source = random.Random(5)
    rows = []
    for k in range(300):
        x = source.getrandbits(64)
        y = x
        for bit in source.sample(range(64), source.randint(0, decontamination.RADIUS)):
            y ^= 1 << bit
        rows.append((k, x - (1 << 63), y - (1 << 63)))
    frame = spark.createDataFrame(rows, "k long, x long, y long")
    left = frame.select("k", decontamination.blocks("x").alias("b"))
    right = frame.select("k", decontamination.blocks("y").alias("b"))
    assert left.join(right, ["k", "b"]).select("k").distinct().count() == 300


def test_simhash(spark):
    source = random.Random(6)
    lists = [[source.getrandbits(64) - (1 << 63) for _ in range(n)] for n in (1, 2, 31, 200)]
    rows = spark.createDataFrame([(x,) for x in lists], "h array<long>").select("h", decontamination.simhash(decontamination.F.col("h")).alias("p"))
    for r in rows.collect():
        expected = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in r.h) > len(r.h))
        assert r.p & ((1 << 64) - 1) == expected


def test_registered_against_sql(spark):
    name = "op10_decontamination"
    assert difference(name, queries.QUERIES[name], queries.ORACLE_SQL[name], spark, connect(TINY), TINY) is None


def test_only_spark_expressions(spark, edges):
    frame = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = decontamination.mark(edges, frame)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
