"""Counting tokens with a compiled finite-state transducer instead of a tokenizer.

Two deterministic transducers are compiled from the vocabulary file. The first splits a chunk of
text into pieces by character class. The second reads the symbols of a piece and says after each
how many tokens its encoding so far has grown by.

The second rests on a fact about byte-pair encodings whose every token encodes to itself: a list of
tokens is the encoding of their text exactly if each two neighbours are (`follows`). So the last
token of a prefix's encoding is the one suffix token that may follow the last token of what lies
before it. What later symbols can depend on is the suffixes that may still grow into a token: for
each, the last token before it and the count there, relative to now. That is the state. States and
transitions are compiled when first met and kept, each transition with its emitted count.

A whole text is a run of chunks cut where white space follows something else. There any state goes
to the start state, so a chunk's map of states is constant: composing maps is adding their counts,
and the prefix scan over them is a running sum.

Null and empty texts have no bytes and no tokens. Repeated rows are counted as often as they come.
An empty table gives no rows. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from riskweave.llm import chunks
from riskweave.llm.common import prepare, slices

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIMIT = 2_048
#: Compiled states kept in a worker; beyond it, compiling starts anew.
STATES = 250_000
APOSTROPHES = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def byte_names() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, by rule."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class PieceCounter:
    """The second transducer. A symbol is a byte, or 256 + byte where a piece ends."""

    def __init__(self, definition: dict):
        names, ending = byte_names(), definition["model"]["end_of_word_suffix"] or ""
        self.final = 256 if ending else 0

        def symbols(token: str) -> tuple[int, ...]:
            stem = token.removesuffix(ending) if ending else token
            read = [names[c] for c in stem]
            if stem != token:
                read[-1] += 256
            return tuple(read)

        self.ids = {symbols(t): i for t, i in definition["model"]["vocab"].items()}
        self.symbols = {i: s for s, i in self.ids.items()}
        self.ranks = {}
        for rank, (a, b) in enumerate(definition["model"]["merges"]):
            pair = self.ids[symbols(a)], self.ids[symbols(b)]
            self.ranks.setdefault(pair, (rank, self.ids[symbols(a) + symbols(b)]))
        # The trie of token prefixes: node * 512 + symbol -> node, and the token that ends at a node.
        self.grow: dict[int, int] = {}
        self.token = [-1]
        for text, token in self.ids.items():
            node = 0
            for symbol in text:
                step = node * 512 + symbol
                if step not in self.grow:
                    self.grow[step] = len(self.token)
                    self.token.append(-1)
                node = self.grow[step]
            self.token[node] = token
        self.allowed: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        # A state packs, for each open suffix: its trie node, the last token before it, and the
        # count there relative to now.
        self.states = [array("i", (0, -1, 0)).tobytes()]
        self.numbers = {self.states[0]: 0}
        self.moves: dict[int, int] = {}  # state * 512 + symbol -> next state and emitted count

    def follows(self, before: int, token: int) -> bool:
        """Whether the two tokens' text is encoded as just these two."""
        if before < 0:
            return True
        key = before << 24 | token
        if key not in self.allowed:
            if len(self.allowed) > 2 * STATES:
                self.allowed.clear()
            self.allowed[key] = self.merged(self.symbols[before] + self.symbols[token]) == [before, token]
        return self.allowed[key]

    def merged(self, text: tuple[int, ...]) -> list[int]:
        """Encoding of a short list of symbols by the merge rules."""
        ids = [self.ids[(s,)] for s in text]
        while len(ids) > 1:
            found = min(self.ranks.get(p, (1 << 40, -1)) + (k,) for k, p in enumerate(zip(ids, ids[1:], strict=False)))
            if found[1] < 0:
                break
            ids[found[2] : found[2] + 2] = [found[1]]
        return ids

    def move(self, state: int, symbol: int) -> int:
        """Next state and emitted count, packed as in ``moves``; compiled now."""
        opened, last, at = [], -1, 0
        read = array("i", self.states[state])
        for k in range(0, len(read), 3):
            node = self.grow.get(read[k] * 512 + symbol)
            if node is None:
                continue
            before, count = read[k + 1], read[k + 2]
            opened += node, before, count
            token = self.token[node]
            if token >= 0 and last < 0 and self.follows(before, token):
                last, at = token, count + 1
        # Counts are kept relative to the new place, where a suffix may also begin.
        for k in range(2, len(opened), 3):
            opened[k] -= at
        key = array("i", (*opened, 0, last, 0)).tobytes()
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
        packed = self.moves[state * 512 + symbol] = number << 12 | at + 2048
        return packed

    def count(self, piece: bytes) -> int:
        """Tokens of one piece: the sum of what its transitions emit."""
        if len(self.states) > STATES:
            self.reset()
        state = total = 0
        moves, end = self.moves, len(piece) - 1
        for k, symbol in enumerate(piece):
            if k == end:
                symbol += self.final
            packed = moves.get(state * 512 + symbol)
            if packed is None:
                packed = self.move(state, symbol)
            state = packed >> 12
            total += (packed & 4095) - 2048
        return total


class ChunkCounter:
    """The first transducer: splits a chunk into pieces by character class, and sums their counts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            definition = json.load(file)
        if definition["model"]["type"] != "BPE" or "Lowercase" not in str(definition["normalizer"]):
            raise ValueError("only lower-casing byte-pair vocabularies with word ends can be compiled")
        self.pieces = PieceCounter(definition)
        self.special = [t["content"] for t in definition["added_tokens"]]
        self.is_special = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.classes: dict[str, str] = {}
        self.letter, self.digit, self.space = map(regex.compile, (r"\p{L}", r"\p{N}", r"\s"))

    def kind(self, char: str) -> str:
        """L letter, N digit, S white space, or O for the rest."""
        found = self.classes.get(char)
        if found is None:
            kinds = (("L", self.letter), ("N", self.digit), ("S", self.space))
            found = self.classes[char] = next((k for k, p in kinds if p.match(char)), "O")
        return found

    def split(self, text: str) -> Iterator[str]:
        """Maximal runs of letters and of other signs, single digits, and English endings."""
        begin, size = 0, len(text)
        while begin < size:
            if text[begin] == "'" and (short := next((a for a in APOSTROPHES if text.startswith(a, begin)), "")):
                end = begin + len(short)
                yield short
            else:
                kind, end = self.kind(text[begin]), begin + 1
                while kind in "LO" and end < size and self.kind(text[end]) == kind:
                    end += 1
                if kind != "S":
                    yield text[begin:end]
            begin = end

    def count(self, chunk: str) -> int:
        total = 0
        if "<|" in chunk:
            total = len(self.is_special.findall(chunk))
            parts = self.is_special.split(chunk)
        else:
            parts = [chunk]
        for part in parts:
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
                part = "".join(c.lower() for c in part)
            else:
                part = part.lower()
            for piece in self.split(part):
                total += self.pieces.count(piece.encode())
        return total


@cache
def counts_of(path: str) -> chunks.Remembering:
    """Counts of chunks; the compiled transducers are kept by the worker from task to task."""
    counter = ChunkCounter(path)
    return chunks.Remembering(lambda new: [counter.count(c) for c in new])


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counts_of(vocabulary)
        for batch in slices(batches):
            first, codes, size = chunks.cut(batch["text"], fold=True)
            emitted = np.array(of(codes.dictionary.to_pylist()), np.int64)[codes.indices.to_numpy(False)]
            scan = np.concatenate(([0], np.cumsum(emitted)))  # the prefix scan over constant maps
            tokens = np.diff(scan[first])
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch["doc_id"].cast(pa.int64()),
                "n_bytes": pa.array(size),
                "n_tokens": pa.array(tokens),
                "over_limit": pa.array(tokens > limit),
            })

    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )
