"""Exact best match of names in a list, through an index that leaves most pairs unseen.

Names are points: how often each symbol comes. Candidates are packed into leaves of similar points; a
leaf keeps the largest count of every symbol, its shortest and longest name, and which countries and
types it holds. Two names' longest common subsequence is at most the sum of smaller counts, so a leaf
gives an upper bound for all its candidates at once.

A search starts with the candidates that share a name's rarest letter triples, whose scores set a mark.
Leaves are then visited best bound first, a few at a time; a leaf is left closed once its bound is below
the mark, and so is a candidate of an opened leaf. What reaches the mark is scored exactly, so the
result is that of scoring every pair; equal scores go to the first candidate in list order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from riskweave.functions.text import Encoded, LcsTable

NAME_WEIGHT, COUNTRY_POINTS, TYPE_POINTS = 0.9, 5, 5
LEAF = 4
#: Posting lists that give a name's first candidates, and how many of each are taken.
RAREST, TAKEN = 8, 32
#: Leaves opened a name before the mark is looked at again, and cells of one table of bounds.
STEPS = (8, 64, 512)
CELLS = 4_000_000
PAIRS = 200_000


def triples(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, triple) of every three symbols in a row; shorter names are padded to one triple."""
    codes = codes.astype(np.int64)
    if codes.shape[1] < 3:
        codes = np.pad(codes, ((0, 0), (0, 3 - codes.shape[1])), constant_values=40)
    value = (codes[:, :-2] * 64 + codes[:, 1:-1]) * 64 + codes[:, 2:]
    inside = np.arange(value.shape[1]) < np.maximum(lengths - 2, 1)[:, None]
    return np.nonzero(inside)[0], value[inside]


def packed(counts: np.ndarray, leaf: int) -> np.ndarray:
    """Rows in an order in which each run of ``leaf`` lies close together: halves along the widest symbol."""
    order, open_ = np.arange(len(counts)), [(0, len(counts))]
    while open_:
        begin, stop = open_.pop()
        if stop - begin <= leaf:
            continue
        rows = order[begin:stop]
        own = counts[rows]
        widest = own[:, np.argmax(own.var(axis=0))]
        rows = rows[np.argsort(widest, kind="stable")]
        order[begin:stop] = rows
        half = begin + -(-(stop - begin) // (2 * leaf)) * leaf
        open_ += [(begin, half), (half, stop)]
    return order


class NameIndex:
    """An index over listed names, in list order."""

    def __init__(self, names: list[str], country: np.ndarray, kind: np.ndarray, leaf: int = LEAF):
        self.list = Encoded(names)
        self.leaf = leaf
        lengths, counts = self.list.lengths, self.list.counts
        self.countries, country = np.unique(country.astype(str), return_inverse=True)
        self.kinds, kind = np.unique(kind.astype(str), return_inverse=True)
        self.country, self.kind = country, kind
        self.order = packed(np.column_stack((counts, lengths)), leaf)
        starts = np.arange(0, len(names), leaf)
        self.counts = counts.astype(np.int16)
        self.most = np.maximum.reduceat(self.counts[self.order], starts)
        self.shortest = np.minimum.reduceat(lengths[self.order], starts)
        self.longest = np.maximum.reduceat(lengths[self.order], starts)
        self.holds = [
            np.maximum.reduceat(np.eye(len(known) + 1, dtype=bool)[codes[self.order]], starts)
            for known, codes in ((self.countries, country), (self.kinds, kind))
        ]
        row, triple = triples(self.list.codes, lengths)
        by_triple = np.lexsort((row, triple))
        self.triple, first = np.unique(triple[by_triple], return_index=True)
        self.posting, self.bounds = row[by_triple], np.append(first, len(row))
        #: What searches did: leaves bounded, candidates bounded, candidates scored.
        self.leaves_bounded = self.pairs_bounded = self.pairs_scored = 0

    def search(self, names: list[str], country: np.ndarray, kind: np.ndarray, floor: np.ndarray):
        """(list row or -1, score, common symbols) of each name; -1 where none reaches the name's ``floor``."""
        out = [self._search(names[k : k + step], country[k : k + step], kind[k : k + step], floor[k : k + step])
               for step in [max(1, CELLS // len(self.most))] for k in range(0, len(names), step)]
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _search(self, names, country, kind, floor):
        search = _Search(self, names, country, kind, floor)
        search.consider(*self._first(search.table))
        bound = search.leaf_bounds()
        for step in (*STEPS, None):
            open_ = bound >= search.best[:, None]
            if not open_.any():
                break
            if step is not None and step < bound.shape[1]:
                top = np.argpartition(bound, -step, axis=1)[:, -step:]
                chosen = np.zeros_like(open_)
                np.put_along_axis(chosen, top, True, axis=1)
                open_ &= chosen
            search.visit(*np.nonzero(open_))
            bound[open_] = -1
        return search.where, search.best, search.common

    def _first(self, table: LcsTable) -> tuple[np.ndarray, np.ndarray]:
        """(name, candidate) pairs that share one of the name's rarest triples."""
        row, triple = triples(table.codes[0], table.lengths[0])
        at = np.searchsorted(self.triple, triple)
        at[at == len(self.triple)] = 0
        met = self.triple[at] == triple
        row, at = row[met], at[met]
        size = self.bounds[at + 1] - self.bounds[at]
        order = np.lexsort((size, row))
        row, at, size = row[order], at[order], size[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        row, at, size = (x[rank < RAREST] for x in (row, at, size))
        taken = np.minimum(size, TAKEN)
        inside = np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
        pair = np.repeat(row, taken) * len(self.list.names) + self.posting[np.repeat(self.bounds[at], taken) + inside]
        return np.divmod(np.unique(pair), len(self.list.names))


class _Search:
    """Some names against the index: the best of each so far."""

    def __init__(self, index: NameIndex, names, country, kind, floor):
        self.index = index
        self.table = LcsTable(names, index.list)
        self.codes = [self._known(index.countries, country), self._known(index.kinds, kind)]
        self.counts = self.table.counts[0].astype(np.int16)
        self.best, self.where = floor.astype(float).copy(), np.full(len(names), -1, np.int64)
        self.common = np.zeros(len(names), np.int64)

    @staticmethod
    def _known(known: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Code of each value; one beyond the last for values that the list has not."""
        values = values.astype(str)
        at = np.searchsorted(known, values)
        at[at == len(known)] = 0
        return np.where(known[at] == values, at, len(known))

    @staticmethod
    def _score(shared, total, same_country, same_kind):
        share = 100.0 * (1.0 - (total - 2 * shared) / np.maximum(total, 1))
        share = np.where(total == 0, 100.0, share)
        return NAME_WEIGHT * share + COUNTRY_POINTS * same_country + TYPE_POINTS * same_kind

    def leaf_bounds(self) -> np.ndarray:
        """Upper bound of every name's score in every leaf."""
        index, length = self.index, self.table.lengths[0]
        shared = np.zeros((len(self.counts), len(index.most)), np.int16)
        for symbol in np.flatnonzero(index.most.any(axis=0)):
            shared += np.minimum(self.counts[:, symbol, None], index.most[None, :, symbol])
        shared = np.minimum(np.minimum(shared, length[:, None]), index.longest[None, :])
        # With so many symbols in common, the best is the shortest name that can hold them.
        total = length[:, None] + np.maximum(index.shortest[None, :], shared)
        index.leaves_bounded += shared.size
        holds = [h[:, c].T for h, c in zip(index.holds, self.codes, strict=True)]
        return self._score(shared, total, *holds) + 1e-9

    def visit(self, names: np.ndarray, leaves: np.ndarray) -> None:
        """Open leaves: bound their candidates one by one, score those that reach the mark."""
        index, per = self.index, self.index.leaf
        n = len(index.order)
        for begin in range(0, len(names), max(1, PAIRS // per)):
            who, leaf = (x[begin : begin + max(1, PAIRS // per)] for x in (names, leaves))
            at = leaf[:, None] * per + np.arange(per)
            i, j = np.repeat(who, per)[(at < n).ravel()], index.order[at[at < n]]
            shared = np.minimum(self.counts[i], index.counts[j]).sum(axis=1, dtype=np.int64)
            index.pairs_bounded += len(i)
            keep = self._score(shared, *self._context(i, j)) >= self.best[i] - 1e-9
            self.consider(i[keep], j[keep])

    def _context(self, i, j):
        index = self.index
        return self.table.lengths[0][i] + self.table.lengths[1][j], self.codes[0][i] == index.country[j], self.codes[1][i] == index.kind[j]

    def consider(self, i: np.ndarray, j: np.ndarray) -> None:
        """Score pairs and keep a name's best, the first in list order among equals."""
        if not len(i):
            return
        lcs = self.table.lengths_of(i, j)
        self.index.pairs_scored += len(i)
        got = self._score(lcs, *self._context(i, j))
        rank = np.lexsort((j, -got, i))
        i, j, got, lcs = i[rank], j[rank], got[rank], lcs[rank]
        lead = np.r_[True, i[1:] != i[:-1]]
        i, j, got, lcs = i[lead], j[lead], got[lead], lcs[lead]
        # A floor is reached, not beaten: the first candidate as good as it counts.
        better = (got > self.best[i]) | ((got == self.best[i]) & ((self.where[i] < 0) | (j < self.where[i])))
        i, j = i[better], j[better]
        self.best[i], self.where[i], self.common[i] = got[better], j, lcs[better]


def best_in_part(names: pd.DataFrame, part: pd.DataFrame, keys: list[str], columns: list[str]) -> pd.DataFrame:
    """The best candidate of one part of the list for each name of one chunk that reaches its ``floor``."""
    if names.empty or part.empty:
        return pd.DataFrame(columns=columns)
    part = part.sort_values(["entity_id", "name_position"], ignore_index=True)
    index = NameIndex(part["normal"].tolist(), part["country"].to_numpy(object), part["entity_type"].to_numpy(object))
    asked = names["normal"].tolist(), names["country"].to_numpy(object), names["entity_type"].to_numpy(object)
    where, best, common = index.search(*asked, names["floor"].to_numpy(float))
    names, where, best, common = names[keys][where >= 0], where[where >= 0], best[where >= 0], common[where >= 0]
    hit = part.iloc[where].reset_index(drop=True)
    names = names.reset_index(drop=True)
    return names.assign(
        entity_id=hit["entity_id"], matched_entity=hit["canonical_name"], alias_match=hit["alias_match"].astype(bool),
        country_match=names["country"].to_numpy(object) == hit["country"].to_numpy(object),
        type_match=names["entity_type"].to_numpy(object) == hit["entity_type"].to_numpy(object),
        name_position=hit["name_position"].astype("int32"), candidate_length=hit["normal"].str.len().astype("int32"),
        lcs=common.astype("int32"), score=best,
    )
