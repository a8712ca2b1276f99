"""Encoding texts with a public tokenizer by way of their distinct chunks.

A chunk begins where ASCII white space follows something else, and where one of a few signs follows
an ASCII letter. For a vocabulary that keeps white space, "something else" is no white space of
Unicode either: such a vocabulary has tokens for runs of both kinds, no-break spaces between spaces
among them. The supported vocabularies split text so that no token spans such a place, and
their special strings hold none; so a text's ids are its chunks' ids put together. Each distinct
chunk is given to the library once per slice; chunks up to a fixed length are remembered up to a fixed
number, so what a worker keeps is bounded in bytes too.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa

from riskweave.llm.common import byte_view

#: Distinct chunks a worker remembers: those met since the last time so many had come, and before that.
REMEMBERED = 400_000
#: Characters of the longest chunk that is remembered; words are shorter.
LONGEST = 64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: White space, signs that end a word and are in no special string, letters.
KINDS = np.zeros(256, np.uint8)
KINDS[SPACE] = 1
KINDS[list(b".,;:!?#$%&*")] = 2
KINDS[[*range(65, 91), *range(97, 123)]] = 3
#: White space beyond ASCII: its characters' bytes read as one number, by their count.
WIDE = {
    n: [int.from_bytes(b) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
        if len(b := chr(c).encode()) == n]
    for n in (2, 3)
}


def ends_wide(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the places ``at`` come straight after white space beyond ASCII."""
    two = data[at - 2].astype(np.int64) << 8 | data[at - 1]
    return np.isin(two, WIDE[2]) | np.isin(data[at - 3].astype(np.int64) << 16 | two, WIDE[3])


def starts_of(bounds: np.ndarray, data: np.ndarray, signs: bool = True, whole: bool = False) -> np.ndarray:
    """Where the chunks of texts laid end to end begin; without ``signs``, at white space only.

    With ``whole``, no chunk begins inside a run of white space of any kind.
    """
    before, after = KINDS[data[:-1]], KINDS[data[1:]]
    begins = np.zeros(len(data) + 1, bool)
    begins[1:-1] = (after == 1) & (before != 1)
    if whole:
        at = np.flatnonzero(begins[1:-1] & (data[:-1] > 127)) + 1
        begins[at[ends_wide(data, at)]] = False
    if signs:
        begins[1:-1] |= (after == 2) & (before == 3)
    begins[bounds] = True
    return np.flatnonzero(begins[:-1])


def cut(
    column: pa.Array, signs: bool = True, fold: bool = False, whole: bool = False
) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray]:
    """(index of each text's first chunk, with the end; chunks as dictionary codes; lengths in bytes).

    With ``fold``, chunks come without their white space and in ASCII lower case; with ``whole``, runs
    of white space of any kind stay in one chunk.
    """
    bounds, data = byte_view(column)
    starts = starts_of(bounds, data, signs, whole)
    offsets = np.append(starts, len(data)).astype(np.int64)
    if fold:
        solid = ~SPACE[data]
        offsets = np.concatenate(([0], np.cumsum(solid)))[offsets]
        data = data[solid]
        if not ((data[1:] == 0x7C) & (data[:-1] == 0x3C)).any():  # no special string can arise
            data = LOWER[data]
    chunks = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))
    )
    return np.searchsorted(starts, bounds), chunks.dictionary_encode(), np.diff(bounds)


@cache
def folds(path: str) -> bool:
    """Whether a vocabulary drops white space and lower-cases, so that folded chunks have the same ids."""
    with open(path, encoding="utf-8") as file:
        definition = json.load(file)
    steps = str(definition["normalizer"]), str(definition["pre_tokenizer"])
    return "'Lowercase'" in steps[0] and "'behavior': 'Removed', 'invert': True" in steps[1]


#: Texts laid end to end for one call of the library.
TOGETHER = 2_000


def library(path: str):
    """The tokenizers library's tokenizer of a vocabulary file, one thread a task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def ids_of(known, texts: list[str]) -> list[bytes]:
    """Each text's ids as 4-byte numbers in native order.

    Texts are laid end to end with a special string between them, at which the library cuts before
    all else; texts that hold the string themselves, and all if there is none, go in one by one.
    """
    special = next(iter(known.get_added_tokens_decoder().items()), None)
    between, mark = (special[1].content, special[0]) if special else ("", -1)
    out: list[bytes] = [b""] * len(texts)
    plain = [k for k, t in enumerate(texts) if between and between not in t]
    for begin in range(0, len(plain), TOGETHER):
        part = plain[begin : begin + TOGETHER]
        joined = known.encode_batch_fast([between.join(texts[k] for k in part)], add_special_tokens=False)[0]
        ids = np.array(joined.ids, np.uint32)
        cuts = np.flatnonzero(ids == mark)
        raw, starts, ends = ids.tobytes(), (4 * np.append(0, cuts + 1)).tolist(), (4 * np.append(cuts, len(ids))).tolist()
        for k, a, b in zip(part, starts, ends, strict=True):
            out[k] = raw[a:b]
    rest = [k for k, t in enumerate(texts) if not between or between in t]
    for k, e in zip(rest, known.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False), strict=True):
        out[k] = np.array(e.ids, np.uint32).tobytes()
    return out


class Remembering:
    """Values of distinct chunks, from a function on lists of them; long chunks are not kept."""

    def __init__(self, function: Callable[[list[str]], list], room: int = REMEMBERED):
        self.function, self.room, self.known, self.before = function, room, {}, {}

    def __call__(self, chunks: list[str]) -> list:
        if len(self.known) > self.room:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        new = [c for c in chunks if c not in known]
        if before:
            known.update((c, before[c]) for c in new if c in before)
            new = [c for c in new if c not in known]
        known.update(zip(new, self.function(new), strict=True))
        out = list(map(known.__getitem__, chunks))
        if max(map(len, new), default=0) > LONGEST:
            for c in new:
                if len(c) > LONGEST:
                    del known[c]
        return out


@lru_cache(1)
def packed_ids(path: str, room: int = REMEMBERED) -> Remembering:
    """Ids of chunks as 4-byte numbers; kept by the worker from task to task."""
    known = library(path)
    return Remembering(lambda new: ids_of(known, new), room)


def forget() -> None:
    """Free what a worker remembers, when it turns to other work."""
    packed_ids.cache_clear()


def gather(codes: np.ndarray, lengths: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` named by ``codes``, one after another."""
    begins = np.cumsum(lengths) - lengths
    size = lengths[codes]
    ends = np.cumsum(size)
    if not len(ends):
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(begins[codes] - ends + size, size)]


def encode(
    column: pa.Array, path: str, end: int | None = None, room: int = REMEMBERED
) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of each text's ids, all ids as uint32), ``end`` appended to every text if given.

    ``room``: how many distinct chunks are remembered.
    """
    first, chunks, _ = cut(column, fold=folds(path), whole=not folds(path))
    distinct = packed_ids(path, room)(chunks.dictionary.to_pylist())
    lengths = np.fromiter(map(len, distinct), np.int64, len(distinct)) // 4
    flat = np.frombuffer(b"".join(distinct), np.uint32)
    codes = chunks.indices.to_numpy(False)
    ids = gather(codes, lengths, flat)
    offsets = np.concatenate(([0], np.cumsum(lengths[codes])))[first]
    if end is not None:
        ids = np.insert(ids, offsets[1:], end)
        offsets = offsets + np.arange(len(offsets))
    return offsets, ids
