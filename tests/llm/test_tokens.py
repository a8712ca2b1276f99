"""Token ids, counts, packing: against the tokenizers library and by exact round trip."""

import json
import random
import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from riskweave.llm import chunks, packing, queries, token_files, transducer
from tests.conftest import TINY
from tests.llm.conftest import EDGES

ORDER = sorted(EDGES, key=lambda e: (e[0] is not None, e[0] or 0))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(token_files.VOCABULARY)


@pytest.fixture(scope="module")
def pieces():
    return Tokenizer.from_file(packing.VOCABULARY)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def odd_texts(seed, n):
    letters = "abcthe'sdren12 ,.!%<|>endoftextİΣßÉé́ \n\t語日本ｶﾞ٣½  "
    source = random.Random(seed)
    return ["".join(source.choice(letters) for _ in range(source.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("name", [token_files.VOCABULARY, packing.VOCABULARY])
def test_chunks_encode_as_whole_texts_do(name):
    texts = odd_texts(1, 4_000) + [t or "" for _, t in EDGES]
    offsets, found = chunks.encode(pa.array(texts), name)
    known = chunks.library(name)
    whole = [known.encode(t, add_special_tokens=False).ids for t in texts]
    assert [found[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == whole


@pytest.mark.parametrize("name", [token_files.VOCABULARY, packing.VOCABULARY])
def test_chunks_keep_runs_of_white_space(name):
    """Of every character that is, or is taken for, white space; between spaces and at either end."""
    blank = [chr(c) for c in (*range(33), 0x7F, *range(0x80, 0x110000)) if not 0xD800 <= c < 0xE000 and (
        chr(c).isspace() or c < 0xA1 or c in (0xAD, 0x180E, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)
    )]
    texts = [f"a{' ' + c}{(' ' + c) * n}{end}" for c in blank for n in (0, 1, 3, 7) for end in ("", " b", "b", "\n\nb.")]
    texts += [f"{c} {c} b" for c in blank] + [f"語{c} b{c}\t{c}.é {c}" for c in blank]
    source = random.Random(4)
    texts += ["".join(source.choice("ab. \n\xa0\u2003\u3000é語") for _ in range(30)) for _ in range(2_000)]
    offsets, found = chunks.encode(pa.array(texts), name)
    known = chunks.library(name)
    whole = [known.encode(t, add_special_tokens=False).ids for t in texts]
    assert [found[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == whole


def test_transducer_counts_as_the_library_does(words):
    counter = transducer.ChunkCounter(transducer.VOCABULARY)
    for text in odd_texts(2, 3_000) + [t or "" for _, t in EDGES]:
        assert counter.count(text) == len(ids(words, text)), text


def test_transducer_starts_anew_when_full(words, monkeypatch):
    monkeypatch.setattr(transducer, "STATES", 50)
    counter = transducer.ChunkCounter(transducer.VOCABULARY)
    for text in odd_texts(3, 300):
        assert counter.count(text) == len(ids(words, text))


def test_transducer_refuses_other_kinds(tmp_path):
    definition = json.load(open(packing.VOCABULARY))
    place = tmp_path / "v.json"
    place.write_text(json.dumps(definition))
    with pytest.raises(ValueError):
        transducer.ChunkCounter(str(place))


def test_count_tokens_on_odd_rows(edges, words):
    found = transducer.count_tokens(edges).collect()
    expected = [(i, len((t or "").encode()), n := len(ids(words, t)), n > 2048) for i, t in EDGES]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_coding_round_trip():
    source = np.random.default_rng(0)
    values = (source.integers(0, 1 << 32, 5_000) >> source.choice([0, 8, 16, 24, 30], 5_000)).astype(np.uint32)
    offsets = np.concatenate(([0], np.sort(source.integers(0, 5_001, 300)), [5_000]))
    _, control, ends, data = token_files.compress(values, offsets)
    assert len(data) < 4 * len(values) and ends[-1] == len(data)
    assert (token_files.expand(control, data, np.diff(offsets)) == values).all()


def test_token_files_read_back(spark, edges, words):
    place = token_files.scratch(spark)
    token_files.write(edges, place)
    rows = token_files.load(spark, place).orderBy("start").collect()
    expected = [(i, [*ids(words, t), 2]) for i, t in ORDER]
    assert [(r.doc_id, list(r.ids)) for r in rows] == expected
    assert [r.start for r in rows] == np.cumsum([0, *(len(x) for _, x in expected)])[:-1].tolist()
    files = spark.read.parquet(f"{place}/ids").select("part", "doc_id").collect()
    for _, group in groupby(files, key=lambda r: r.part):
        known = [r.doc_id for r in group if r.doc_id is not None]
        assert known == sorted(known)


def test_ranks_go_by_frequency(spark, edges):
    encoded = token_files.materialise(token_files.encode_ids(edges, token_files.VOCABULARY, 2))
    rows = token_files.ranks(encoded).orderBy("rank").collect()
    assert [r.rank for r in rows] == list(range(len(rows)))
    assert [(-r.n, r.id) for r in rows] == sorted((-r.n, r.id) for r in rows)


def test_registered_token_files(spark, words):
    rows = queries.QUERIES["op2_token_files"](spark, TINY).orderBy("start").collect()
    docs = spark.read.parquet(f"{TINY}/documents.parquet").orderBy("doc_id").collect()
    before = 0
    for row, doc in zip(rows, docs, strict=True):
        found = [*ids(words, doc.text), 2]
        assert tuple(row) == (doc.doc_id, before, len(found), crc(found))
        before += len(found)


def test_registered_token_counts(spark, words):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()}
    for row in queries.QUERIES["op5_token_counts"](spark, TINY).collect():
        assert row.n_tokens == len(ids(words, docs[row.doc_id]))
        assert row.n_bytes == len(docs[row.doc_id].encode())


@pytest.mark.parametrize(("tokens", "longest", "expected"), [
    (1, 8, [1]), (7, 8, [4, 2, 1]), (8, 8, [8]), (21, 8, [8, 8, 4, 1]), (5, 1, [1] * 5), (0, 8, []),
])
def test_power_of_two_lengths(tokens, longest, expected):
    assert packing.lengths_of(tokens, longest) == expected


def check_packing(rows, docs, tokenizer):
    docs = dict(docs)
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    by_length = [r.length for r in sorted(rows, key=lambda r: r.sequence_id)]
    assert by_length == sorted(by_length, reverse=True)
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 1024 for r in rows)
    for doc_id, text in docs.items():
        whole = [*ids(tokenizer, text), 0]
        own = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start)
        assert sum(r.length for r in own) == len(whole)
        at = 0
        for r in own:
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(whole), crc(whole[at : at + r.length]))
            if "ids" in r:
                assert list(r.ids) == whole[at : at + r.length]
            at += r.length


def test_packing_odd_rows(edges, pieces):
    once = [(i, t) for i, t in EDGES if i != 7]
    rows = packing.pack(edges).collect()
    assert sum(r.doc_id == 7 for r in rows) == 2 * len(packing.lengths_of(len(ids(pieces, EDGES[6][1])) + 1, 1024))
    rows = packing.pack(edges.filter("doc_id is null or doc_id <> 7")).collect()
    check_packing(rows, once, pieces)


def test_registered_packing(spark, pieces):
    docs = [tuple(r) for r in spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()]
    check_packing(queries.QUERIES["op8_packing"](spark, TINY).collect(), docs, pieces)


def test_lean_packing_gives_the_same_rows(spark, edges, pieces):
    """A lean worker cuts smaller slices and remembers less; what it returns is the same."""
    long = spark.range(3_000).selectExpr("id + 1000 as doc_id", "repeat(concat('word', id, ' '), 300) as text")
    docs = edges.select("doc_id", "text").unionByName(long).coalesce(1)
    lean, usual = (packing.pack(docs, lean=x) for x in (True, False))
    assert lean.count() == usual.count() and lean.exceptAll(usual).count() == 0


def test_a_lean_worker_remembers_few_chunks():
    words = pa.array([" ".join(f"word{k}x{i}" for i in range(600)) for k in range(20)])
    few, many = (chunks.encode(words, packing.VOCABULARY, packing.END, room) for room in (1_000, chunks.REMEMBERED))
    assert all((a == b).all() for a, b in zip(few, many, strict=True))
    chunks.forget()
    for k in range(len(words)):
        chunks.encode(words[k : k + 1], packing.VOCABULARY, packing.END, 1_000)
    memory = chunks.packed_ids(packing.VOCABULARY, 1_000)
    assert 0 < len(memory.known) + len(memory.before) <= 2 * 1_600


def test_empty_tables(spark, edges):
    none = edges.limit(0)
    assert transducer.count_tokens(none).count() == packing.pack(none).count() == 0
    place = token_files.scratch(spark)
    token_files.write(none, place)
    assert token_files.load(spark, place).count() == 0


def test_what_is_remembered_is_bounded_in_bytes():
    """Long chunks are not kept, short ones up to a number, and answers are the same either way."""
    asked = []

    def double(new):
        asked.extend(new)
        return [c + c for c in new]

    memory = chunks.Remembering(double, room=50)
    long = "x" * (chunks.LONGEST + 1)
    for k in range(40):
        part = [f"c{k * 10 + n}" for n in range(10)] + [long, "often"]
        assert memory(part) == [c + c for c in part]
    assert asked.count(long) == 40 and asked.count("often") == 1
    assert all(len(c) <= chunks.LONGEST for d in (memory.known, memory.before) for c in d)
    assert len(memory.known) + len(memory.before) <= 2 * 50 + 40
