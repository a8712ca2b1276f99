"""The prefix trie: against a plain trie of tuples, on skewed, long and odd conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from riskweave.llm import prefix_trie, queries
from tests.compare import connect, difference
from tests.conftest import SMALL, TINY

SCHEMA = "conv_id long, turn long, role string, text string"


def told(rows):
    """Turns of each conversation in order; ties by role only, so tests have none beyond that."""
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append(((turn is not None, turn or 0, role or ""), (role or "", text or "")))
    return {c: [t for _, t in sorted(x, key=lambda y: y[0])] for c, x in out.items()}


def rebuilt(told_):
    out = {}
    for c, own in told_.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = told_.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute(told_):
    members = defaultdict(list)
    for c, turns in told_.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out = []
    sums = {}
    for path in sorted(members, key=len, reverse=True):
        leaves = sum(sums[x][0] for x in children[path]) if children[path] else 1
        saved = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        sums[path] = leaves, saved + sum(sums[x][1] for x in children[path])
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(told_[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(convs), len(path), parent, len(convs), len(children[path]), *sums[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(frame):
    assert frame.columns == prefix_trie.NODE
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def skewed(seed):
    """Copies of one conversation for a third of all, one common first turn, shared heads of every length."""
    source = random.Random(seed)
    rows = []
    for c in range(400):
        kind = c % 3
        if kind == 0:
            turns = [("user", "hello"), ("assistant", "ünïcode 語 😀"), ("user", "bye")]
        elif kind == 1:
            turns = [("user", "hello")] + [("assistant", str(source.randrange(3))) for _ in range(source.randrange(1, 6))]
        else:
            turns = [(source.choice(["user", None, "a"]), source.choice([None, "", "x", f"own {c}"])) for _ in range(source.randrange(1, 5))]
        rows += [(c, k if k else source.choice([None, 0]), r, t) for k, (r, t) in enumerate(turns)]
    source.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells", [prefix_trie.CELLS, 64])
def test_matches_a_plain_trie(spark, monkeypatch, cells):
    """Also with a sketch so full that it proves hardly anything."""
    if cells == 64:
        monkeypatch.setattr(prefix_trie, "STRIPE", 64)
    rows = skewed(1)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    turns = prefix_trie.turns_of(frame)
    assert got(prefix_trie.trie(turns, prefix_trie.sizes_of(turns), cells)) == brute(told(rows))
    assert got(prefix_trie.trie(*prefix_trie.regrouped(turns), cells)) == brute(rebuilt(told(rows)))


def test_long_conversations_and_many_ends(spark, monkeypatch):
    """Digests run on over blocks and tasks; ids of a busy node are hashed in pieces."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "PIECE", 8)
    rows = [(c, k, "user", str(k)) for c in (1, 2) for k in range(150)]
    rows += [(2, 150, "user", "more"), (5, 0, "user", "0"), (5, 1, "user", "other")]
    rows += [(c, 0, "user", "same") for c in range(10, 120)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert got(prefix_trie.prefix_trie(frame)) == brute(told(rows))


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "no conversation"), (7, None, None, None), (7, None, "b", "2"), (7, 3, "user", "x"), (8, 0, "", ""),
        (9, 0, "ab", "c"), (10, 0, "a", "bc"), (-3, 0, "user", "negative"), (11, 5, "user", "y" * 50_000), (12, 5, "user", "y" * 50_000),
        (13, 0, "user", "again"), (13, 1, "user", "again"), (13, 1, "user", "again"),
    ]
    clash = spark.createDataFrame([(*r, 1, "z", 2) for r in rows], f"{SCHEMA}, depth int, x1 string, position int").repartition(3)
    assert got(prefix_trie.prefix_trie(clash)) == brute(told(rows))
    assert prefix_trie.prefix_trie(clash.limit(0)).count() == 0
    turns = prefix_trie.turns_of(clash.limit(0))
    assert prefix_trie.trie(*prefix_trie.regrouped(turns)).count() == 0


def test_turnless_conversations_end_at_the_root(spark):
    """Without a first conversation of the group, short ones lose all their turns."""
    rows = [(c, 0, "user", str(c)) for c in range(101, 160)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = brute(rebuilt(told(rows)))
    assert got(prefix_trie.trie(*prefix_trie.regrouped(prefix_trie.turns_of(frame)))) == expected
    root = next(r for r in expected if r[1] == 0)
    assert root[3] == 59 and root[7] != hashlib.sha256(b"").hexdigest()


def test_tails_do_not_shuffle(spark):
    """The sketch proves what only one conversation has: few prefixes go on to the exact grouping."""
    rows = [(c, k, "user", f"{c if k else 'first'} {k}") for c in range(2_000) for k in range(5)]
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, SCHEMA))
    marked = prefix_trie.screened(prefix_trie.prefixes(turns))
    assert 2_000 <= marked.filter("not single").count() < 2_000 + 400
    assert marked.filter("single and depth = 1").count() == 0


@pytest.mark.parametrize("table", [TINY, SMALL])
def test_registered_against_sql(spark, table):
    name = "op13_prefix_trie"
    assert difference(name, queries.QUERIES[name], queries.ORACLE_SQL[name], spark, connect(table), table) is None
