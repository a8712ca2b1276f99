"""Aligning the tokens of two tokenizers through the bytes they cover.

Both tokenizers see the text with a space before it: A (byte-level pairs) is given it, B (pieces) adds
it itself. Incidence matrices of tokens and bytes are kept as compressed sparse rows (CSR); Gustavson's
row products of A and the transpose of B give the overlap links, pairs of token occurrences with the
number of bytes they share. Offsets where an A and a B token both end cut the tokens into groups;
products of the tokens' group incidences give the shared-group links.

A linked pair here is an overlap link whose tokens end together. As each ends at the same byte, the
bytes of one token end with all bytes of the other: a vocabulary has a bounded number of such id pairs
(below the summed lengths of all tokens of both), which bounds the table of counts that is sent to the
tasks whatever the corpus.

Texts are cut into chunks where one space stands between other characters; no token of either
vocabulary spans such a place (checked for B's pieces), so both tokenizers end tokens there and a text's
groups are its chunks' groups put together. Products are computed for the distinct chunks of a slice and
remembered for short chunks.

Special tokens' strings inside texts are plain text. Null and empty texts, and texts that the tokens of
A or B do not give back byte by byte (a text with U+2581), have no tokens: zeros and an empty digest.
Repeated rows count as often as they come. An empty table gives no rows. Only doc_id and text are read,
so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm import chunks
from riskweave.llm.chunks import SPACE, Remembering, ends_wide, gather
from riskweave.llm.common import byte_view, prepare, slices
from riskweave.session import materialise

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Chunks a worker remembers with their links.
REMEMBERED = 100_000
#: Chunks whose matrices are made together.
TOGETHER = 16_000
#: A pair of ids is one number: A's id times this, and B's id.
WIDE = 1 << 20
SLICE = 2 << 20
#: Numbers before a chunk's pairs: its tokens of A and B, groups, overlap links, shared-group links.
HEAD = 5
SEEN = "doc_id long, n_a long, n_b long, n_groups long, n_overlaps long, n_shared long, pairs array<long>, groups_sha256 string"


class CSR:
    """A sparse matrix by rows: where each row begins, the columns, and the values (ones, if none)."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, data: np.ndarray | None = None):
        self.indptr, self.indices, self.data = indptr, indices, data

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self, columns: int) -> CSR:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=columns))))
        return CSR(indptr, self.rows[order], None if self.data is None else self.data[order])


def product(a: CSR, b: CSR, columns: int) -> CSR:
    """a b by Gustavson's rule: row i is the sum of the rows of b that row i of a names.

    All rows at once: b's rows are laid out in the order in which a names them, then equal places summed.
    """
    size = np.diff(b.indptr)
    found = gather(a.indices, size, b.indices)
    rows = np.repeat(a.rows, size[a.indices])
    values = np.ones(len(found), np.int64) if b.data is None else gather(a.indices, size, b.data)
    if a.data is not None:
        values = values * np.repeat(a.data, size[a.indices])
    key = rows * columns + found
    if len(key) and (key[1:] < key[:-1]).any():
        order = np.argsort(key, kind="stable")
        key, values = key[order], values[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    key = key[first]
    sums = np.add.reduceat(values, first) if len(first) else values
    indptr = np.searchsorted(key, np.arange(len(a.indptr)) * columns)
    return CSR(indptr, key % columns, sums)


def covering(lengths: np.ndarray) -> CSR:
    """Token-byte incidence of tokens that lie one after another."""
    ends = np.concatenate(([0], np.cumsum(lengths)))
    return CSR(ends, np.arange(ends[-1]))


def overlaps(a: np.ndarray, b: np.ndarray) -> CSR:
    """A x B matrix of bytes that two tokens share, from the lengths of both, of the same bytes."""
    whole = int(a.sum())
    return product(covering(a), covering(b).transposed(whole), len(b))


def grouped(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(group of each A token, of each B token, number of groups): cut where tokens of both end."""
    ends = [np.cumsum(x) for x in (a, b)]
    cuts = np.intersect1d(*ends, assume_unique=True)
    return *(np.searchsorted(cuts, e) for e in ends), len(cuts)


def incidence(groups: np.ndarray) -> CSR:
    """Token-group incidence: one group a token."""
    return CSR(np.arange(len(groups) + 1), groups)


def shared_groups(a: np.ndarray, b: np.ndarray) -> CSR:
    """A x B matrix of token occurrences in the same group."""
    group_a, group_b, n = grouped(a, b)
    return product(incidence(group_a), incidence(group_b).transposed(n), len(b))


class Pair:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, first: str, second: str):
        import sentencepiece

        self.quick, self.plain = chunks.library(first), chunks.library(first)
        self.plain.encode_special_tokens = True
        self.special = [t.content for t in self.plain.get_added_tokens_decoder().values()]
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=second)
        names = [self.pieces.id_to_piece(k) for k in range(self.pieces.get_piece_size())]
        if any(re.search("[^▁]▁", x) for x in names):
            raise ValueError("a piece goes on after a word's end: texts cannot be cut into chunks")
        with open(first, encoding="utf-8") as file:
            entries = json.load(file)["model"]["vocab"]
        back = unicode_bytes()
        by_id = {k: bytes(back[c] for c in entry) for entry, k in entries.items() if all(c in back for c in entry)}
        self.bytes = [by_id.get(k, b"") for k in range(max(by_id) + 1)], [piece_bytes(x) for x in names]
        self.lengths = tuple(np.array([len(x) for x in table], np.int64) for table in self.bytes)
        self.flat = tuple(np.frombuffer(b"".join(table), np.uint8) for table in self.bytes)
        self.text = tuple(pa.array([str(k) for k in range(len(table))], pa.large_string()) for table in self.bytes)

    def ids(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], ...]:
        """(ids of all chunks, how many each has) of A and B. Chunks begin with a space, which B is not given."""
        special = [k for k, t in enumerate(texts) if any(s in t for s in self.special)]
        if special:
            own = set(special)
            rest = iter(chunks.ids_of(self.quick, [t for k, t in enumerate(texts) if k not in own]))
            odd = iter(self.plain.encode_batch_fast([texts[k] for k in special], add_special_tokens=False))
            a = [np.array(next(odd).ids, np.uint32).tobytes() if k in own else next(rest) for k in range(len(texts))]
        else:
            a = chunks.ids_of(self.quick, texts)
        b = self.pieces.encode([t[1:] for t in texts], num_threads=1)
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(texts)) for x in (a, b))
        flat_b = np.fromiter(chain.from_iterable(b), np.int64, int(n_b.sum()))
        return (np.frombuffer(b"".join(a), np.uint32).astype(np.int64), n_a // 4), (flat_b, n_b)

    def given_back(self, side: int, ids: np.ndarray, n: np.ndarray, bounds: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Which texts the bytes of their tokens equal; texts lie in ``data`` between ``bounds``."""
        length = self.lengths[side][ids]
        ends = np.concatenate(([0], np.cumsum(length)))[np.cumsum(n)]
        good = np.diff(ends, prepend=0) == np.diff(bounds)
        kept = np.repeat(good, n)
        found = gather(ids[kept], self.lengths[side], self.flat[side])
        size = np.diff(bounds)[good]
        wrong = found != data[np.repeat(good, np.diff(bounds))]
        if wrong.any():
            good[np.flatnonzero(good)[np.searchsorted(np.cumsum(size), np.flatnonzero(wrong), "right")]] = False
        return good


def unicode_bytes() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a character: printable ones as they are, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def piece_bytes(piece: str) -> bytes:
    if re.fullmatch("<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


@cache
def pair(first: str, second: str) -> Pair:
    return Pair(first, second)


def cut(column: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(index of each text's first chunk, with the end; chunks) of texts with a space put before them."""
    space, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    column = pc.binary_join_element_wise(space, pc.fill_null(column.cast(pa.large_string()), ""), none)
    bounds, data = byte_view(column)
    begins = np.zeros(len(data) + 1, bool)
    begins[1:-2] = (data[1:-1] == 32) & (data[2:] != 32) & ~SPACE[data[:-2]]
    at = np.flatnonzero(begins)
    at = at[data[at - 1] > 127]
    begins[at[ends_wide(data, at)]] = False
    begins[bounds - 1] = False  # a text's last space stays with its chunk
    begins[bounds] = True
    starts = np.flatnonzero(begins[:-1])
    offsets = np.append(starts, len(data)).astype(np.int64)
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
    return np.searchsorted(starts, bounds), found.dictionary_encode()


def aligned(both: Pair, texts: list[str]) -> list[bytes]:
    """``HEAD`` counts, the id pairs that end together, and the groups as text, of each chunk as one value.

    Empty for a chunk that its tokens do not give back.
    """
    if not texts:
        return []
    bounds, data = byte_view(pa.array(texts, pa.large_string()))
    (a, n_a), (b, n_b) = both.ids(texts)
    good = both.given_back(0, a, n_a, bounds, data) & both.given_back(1, b, n_b, bounds, data) & (np.diff(bounds) > 0)
    out = [b""] * len(texts)
    if not good.any():
        return out
    a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
    # The chunks lie one after another, so the matrices are those of one text.
    size_a, size_b = (table[x] for table, x in zip(both.lengths, (a, b), strict=True))
    link = overlaps(size_a, size_b)
    rows, ends_a, ends_b = link.rows, np.cumsum(size_a), np.cumsum(size_b)
    together = ends_a[rows] == ends_b[link.indices]
    pairs = (a[rows[together]] * WIDE + b[link.indices[together]]).tobytes()
    group_a, group_b, n = grouped(size_a, size_b)
    in_a, in_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    of_a, of_b = np.cumsum(n_a[good]), np.cumsum(n_b[good])
    of_group = group_a[of_a - 1] + 1
    # Entries of the product of group incidences: of each group, all its A with all its B.
    of_shared = np.cumsum(in_a * in_b)[of_group - 1]
    counts = np.column_stack([np.diff(x, prepend=0) for x in (of_a, of_b, of_group, link.indptr[of_a], of_shared)]).astype("<i8").tobytes()
    said = ["", ""]
    for side, ids, own in ((0, a, in_a), (1, b, in_b)):
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(own))), pa.int32()), both.text[side].take(pa.array(ids)))
        said[side] = pc.binary_join(lists, pa.scalar(",", pa.large_string()))
    groups = pc.binary_join_element_wise(*said, pa.scalar("|", pa.large_string()))
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], of_group)), pa.int32()), groups), pa.scalar(";", pa.large_string()))
    begin, head = 0, 8 * HEAD
    for k, at, stop, text in zip(np.flatnonzero(good).tolist(), range(0, len(counts), head), of_group.tolist(), whole.to_pylist(), strict=True):
        out[k] = counts[at : at + head] + pairs[8 * begin : 8 * stop] + text.encode()
        begin = stop
    return out


@cache
def remembered(first: str, second: str) -> Remembering:
    chunks.forget()
    both = pair(first, second)

    def values(new: list[str]) -> list[bytes]:
        return [v for k in range(0, len(new), TOGETHER) for v in aligned(both, new[k : k + TOGETHER])]

    return Remembering(values, REMEMBERED)


def align(docs: DataFrame, first: str = BYTES, second: str = PIECES) -> DataFrame:
    """``SEEN``: of every row its tokens, groups, links, the id pairs that end together, and its groups' digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = remembered(first, second)
        for batch in slices(batches, size=SLICE):
            bounds, found = cut(batch["text"])
            values = known(found.dictionary.to_pylist())
            codes = found.indices.to_numpy(False)
            bad = np.array([not v for v in values], bool)
            values = [v or bytes(8 * HEAD) for v in values]
            counts = np.frombuffer(b"".join([v[: 8 * HEAD] for v in values]), "<i8").reshape(-1, HEAD)
            own = counts[:, 2]
            bodies = [(8 * HEAD, 8 * (HEAD + n)) for n in own.tolist()]
            linked = np.frombuffer(b"".join([v[i:j] for v, (i, j) in zip(values, bodies, strict=True)]), "<i8")
            wrong = np.add.reduceat(bad[codes], bounds[:-1]) > 0
            sums = np.column_stack([np.add.reduceat(c[codes], bounds[:-1]) for c in counts.T])
            sums[wrong] = 0
            # Pairs of the chunks in their order, without those of texts that are not given back.
            pairs = gather(codes[np.repeat(~wrong, np.diff(bounds))], own, linked)
            said = [v[j:] for v, (_, j) in zip(values, bodies, strict=True)]
            digests, order = [], codes.tolist()
            for a, b, no in zip(bounds[:-1].tolist(), bounds[1:].tolist(), wrong.tolist(), strict=True):
                digests.append("" if no else hashlib.sha256(b";".join([said[c] for c in order[a:b]])).hexdigest())
            offsets = np.concatenate(([0], np.cumsum(sums[:, 2]))).astype(np.int32)
            columns = {c: pa.array(sums[:, k]) for k, c in enumerate(("n_a", "n_b", "n_groups", "n_overlaps", "n_shared"))}
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"].cast(pa.int64()), **columns,
                "pairs": pa.ListArray.from_arrays(pa.array(offsets), pa.array(pairs)), "groups_sha256": pa.array(digests, pa.string()),
            })

    prepare(docs.sparkSession)
    return docs.select("doc_id", F.when(F.col("text") != "", F.col("text")).alias("text")).mapInArrow(run, SEEN)


def links(docs: DataFrame, shared: bool = False, first: str = BYTES, second: str = PIECES) -> DataFrame:
    """(doc_id, a, b, a_id, b_id, n): overlap links of every row, n the bytes shared; a and b are places from 0.

    With ``shared``, links of tokens in the same group instead (n is 1). Rows stream out in slices.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(first, second)
        for batch in slices(batches, size=1 << 20):
            bounds, found = cut(batch["text"])
            names = found.dictionary.to_pylist()
            codes = found.indices.to_numpy(False)
            ids = [np.split(x, np.cumsum(n)[:-1]) for x, n in both.ids(names)]
            good = np.array([v != b"" for v in aligned(both, names)], bool)
            for k in range(batch.num_rows):
                own = codes[bounds[k] : bounds[k + 1]]
                if not good[own].all():
                    continue
                a, b = (np.concatenate([ids[side][c] for c in own]) for side in (0, 1))
                sizes = [table[x] for table, x in zip(both.lengths, (a, b), strict=True)]
                link = shared_groups(*sizes) if shared else overlaps(*sizes)
                rows = link.rows
                doc_id = pa.array([batch["doc_id"][k].as_py()] * len(rows), pa.int64())
                columns = (doc_id, *map(pa.array, (rows, link.indices, a[rows], b[link.indices], link.data)))
                yield pa.RecordBatch.from_arrays(list(columns), names=["doc_id", "a", "b", "a_id", "b_id", "n"])

    prepare(docs.sparkSession)
    rows = docs.select("doc_id", F.when(F.col("text") != "", F.col("text")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, a long, b long, a_id long, b_id long, n long")


def pair_counts(seen: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted id pairs, count of each, whether it is its B id's highest) over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, counts = np.unique(batch["pairs"].flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_pydict({"pair": pa.array(pairs, pa.int64()), "n": pa.array(counts, pa.int64())})

    counts = seen.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # bounded by the vocabularies
    pairs, n = table["pair"].to_numpy(), table["n"].to_numpy()
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order]
    b = pairs % WIDE
    highest = np.zeros(int(b.max()) + 1 if len(b) else 0, np.int64)
    np.maximum.at(highest, b, n)
    return pairs, n, n == highest[b]


def scored(docs: DataFrame, first: str = BYTES, second: str = PIECES) -> DataFrame:
    """``align`` with what the corpus says of each row's links: n_links, n_best, count_sum."""
    seen = materialise(align(docs, first, second))
    pairs, counts, best = pair_counts(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(pairs, batch["pairs"].flatten().to_numpy())
            cuts = np.concatenate(([0], np.cumsum(pc.list_value_length(batch["pairs"]).to_numpy(False))))
            told = {
                "n_links": np.diff(cuts),
                **{name: np.diff(np.concatenate(([0], np.cumsum(x[at])))[cuts]) for name, x in (("n_best", best), ("count_sum", counts))},
            }
            columns = {c: batch[c] for c in batch.schema.names if c != "pairs"}
            yield pa.RecordBatch.from_pydict(columns | {c: pa.array(x, pa.int64()) for c, x in told.items()})

    kinds = SEEN.replace("pairs array<long>, ", "") + ", n_links long, n_best long, count_sum long"
    return seen.mapInArrow(run, kinds)
