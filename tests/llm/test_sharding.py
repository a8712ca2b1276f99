"""Sharding: near equal sizes, gapless slots, copies together, on skewed rows too."""

import zlib
from collections import defaultdict

import pytest

from riskweave.llm import queries, sharding
from tests.conftest import TINY
from tests.llm.conftest import EDGES, prose


def check(rows, docs, shards, slack):
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in docs
    )
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total = sum(sizes.values())
    assert max(sizes.values()) <= total / shards + slack
    return sizes


def test_odd_rows(edges):
    rows = sharding.shard(edges, 3).collect()
    check(rows, EDGES, 3, max(len((t or "").encode()) + 1 for _, t in EDGES))


def test_one_text_in_a_third_of_all_rows(spark):
    docs = [(i, prose(0, 40) if i % 3 == 0 else prose(i, 5 + i % 60)) for i in range(3_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = sharding.shard(frame, 8).collect()
    sizes = check(rows, docs, 8, 2_000)
    assert min(sizes.values()) >= sum(sizes.values()) / 8 - 2_000


def test_overfull_ranges_are_cut_again(spark, monkeypatch):
    docs = [(i, prose(i, 30)) for i in range(2_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    whole, cut = sharding.quantiles, []

    def poor(sample, ranges):
        cut.append((len(sample), ranges))
        return whole(sample, ranges)[:3] if len(cut) == 1 else whole(sample, ranges)

    monkeypatch.setattr(sharding, "quantiles", poor)
    check(sharding.shard(frame, 4).collect(), docs, 4, 1_000)
    assert len(cut) > 1


def test_light_copies_stay_together(spark):
    docs = [(i, prose(i // 2, 20)) for i in range(4_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    place = defaultdict(set)
    for r in sharding.shard(frame, 4).collect():
        place[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in place.values())


def test_hot_text_without_ids_and_repeated_rows(spark):
    docs = [(None, prose(0, 4))] * 2_000 + [(5, prose(1, 4))] * 1_000 + [(i, prose(i, 4)) for i in range(2_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    sizes = check(sharding.shard(frame, 16).collect(), docs, 16, 100)
    assert len(sizes) == 16 and min(sizes.values()) >= sum(sizes.values()) / 16 - 100


def test_empty_table(edges):
    assert sharding.shard(edges.limit(0)).count() == 0


@pytest.mark.parametrize("table", [TINY])
def test_registered(spark, table):
    docs = [tuple(r) for r in spark.read.parquet(f"{table}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.QUERIES["op7_sharding"](spark, table).collect()
    check(rows, docs, 16, max(len(t.encode()) + 1 for _, t in docs))
