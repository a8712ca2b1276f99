"""Name folding as columns, and the longest-common-subsequence kernel used by screening."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

NON_ASCII = r"[^\x00-\x7F]"
# After folding, names hold only these symbols.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789 "
_CODES = {c: i for i, c in enumerate(ALPHABET)}
PAD = len(ALPHABET)
WORD = 64


@F.pandas_udf(StringType())
def _fold_accents(names: pd.Series) -> pd.Series:
    return names.map(
        lambda s: unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode(),
        na_action="ignore",
    )


def normalise_name(name: Column) -> Column:
    """Lower-case ASCII letters, digits and single spaces.

    Only names with other characters are sent to Python; the rest travel as nulls.
    """
    accented = name.rlike(NON_ASCII)
    ascii_only = F.when(accented, _fold_accents(F.when(accented, name))).otherwise(name)
    return normalise_ascii_name(ascii_only)


def normalise_ascii_name(name: Column) -> Column:
    spaced = F.regexp_replace(F.lower(name), "[^a-z0-9 ]", " ")
    return F.trim(F.regexp_replace(spaced, " +", " "))


def encode(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Names as one padded matrix of symbol codes, and their lengths."""
    lengths = np.fromiter((len(s) for s in names), np.int64, len(names))
    codes = np.full((len(names), int(lengths.max(initial=1))), PAD, np.uint8)
    for row, name in enumerate(names):
        codes[row, : len(name)] = [_CODES[c] for c in name]
    return codes, lengths


def symbol_counts(codes: np.ndarray) -> np.ndarray:
    return np.stack([(codes == s).sum(axis=1) for s in range(PAD)], axis=1).astype(np.int32)


def _match_masks(codes: np.ndarray) -> np.ndarray:
    """Per name and symbol, the bit set of positions; only names of up to 64 symbols."""
    masks = np.zeros((len(codes), PAD + 1), np.uint64)
    rows = np.arange(len(codes))
    for position in range(min(codes.shape[1], WORD)):
        masks[rows, codes[:, position]] |= np.uint64(1 << position)
    masks[:, PAD] = 0
    return masks


def _lcs_long(a: str, b: str) -> int:
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for c in b:
        hit = free & masks.get(c, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


class Encoded:
    """A list of names, encoded once for any number of tables."""

    def __init__(self, names: list[str]):
        self.names = names
        self.codes, self.lengths = encode(names)
        self.masks = _match_masks(self.codes)
        self.counts = symbol_counts(self.codes)


class LcsTable:
    """Exact LCS lengths between chosen rows of two name lists.

    Bit-parallel over pairs: one machine word holds a whole name of up to 64 symbols, and
    the other name, of any length, is walked symbol by symbol. Two longer names go through
    arbitrary-width integers instead.
    """

    def __init__(self, left: list[str] | Encoded, right: list[str] | Encoded):
        sides = [x if isinstance(x, Encoded) else Encoded(x) for x in (left, right)]
        self.names, self.codes, self.lengths, self.masks, self.counts = (
            tuple(getattr(x, name) for x in sides) for name in ("names", "codes", "lengths", "masks", "counts")
        )

    def lengths_of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), np.int64)
        fits_left = self.lengths[0][i] <= WORD
        fits_right = self.lengths[1][j] <= WORD
        for side, chosen in ((0, fits_left), (1, ~fits_left & fits_right)):
            if chosen.any():
                pick = (i[chosen], j[chosen])
                out[chosen] = self._walk(side, pick[side], pick[1 - side])
        for k in np.flatnonzero(~fits_left & ~fits_right):
            out[k] = _lcs_long(self.names[0][i[k]], self.names[1][j[k]])
        return out

    def _walk(self, side: int, pattern: np.ndarray, text: np.ndarray) -> np.ndarray:
        masks, codes = self.masks[side], self.codes[1 - side]
        free = np.full(len(pattern), np.iinfo(np.uint64).max, np.uint64)
        for position in range(int(self.lengths[1 - side][text].max(initial=0))):
            hit = free & masks[pattern, codes[text, position]]
            free = (free + hit) | (free - hit)
        return np.bitwise_count(~free).astype(np.int64)
