"""Largest inner products in Arrow batches: matrix products find the candidates, sums in order decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows and vectors of one matrix product, and pairs that are summed in order at a time.
ROWS, VECTORS, PAIRS = 2_048, 512, 1 << 16
#: Numbers that a block of broadcast vectors holds at most.
BLOCK_NUMBERS = 1 << 22
EPS = float(np.finfo(np.float64).eps)


def matrices(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each length of the vectors of a list column: their places, a matrix of doubles, which have a null, and which
    have that or a number not fit for a bound (no finite or a very large one). Null vectors are in none."""
    size = np.asarray(pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False), np.int64)
    values = col.values.cast(pa.float64())
    gone = values.is_null().to_numpy(zero_copy_only=False)
    values, begin = values.to_numpy(zero_copy_only=False), col.offsets.to_numpy()[:-1]
    for d in np.unique(size[size >= 0]):
        at = np.flatnonzero(size == d)
        cell = begin[at][:, None] + np.arange(d)
        m, null = values[cell], gone[cell].any(axis=1)
        yield at, m, null, null | ~(np.abs(m) < 1e150).all(axis=1)


def in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed from the first number to the last."""
    s = np.zeros(len(a))
    with np.errstate(all="ignore"):
        for j in range(a.shape[1]):
            s += a[:, j] * b[:, j]
    return s


def places(ids: pa.Array) -> np.ndarray:
    """Numbers in the order of the ids, nulls first."""
    if pa.types.is_integer(ids.type) and not ids.null_count:
        return ids.to_numpy()
    return pc.rank(ids, null_placement="at_start", tiebreaker="dense").to_numpy()


class Best:
    """The k best of scored ids for each of n vectors, over pieces. A null score is the smallest, NaN the largest; ties go to
    the smaller id. least: the smallest scores instead."""

    def __init__(self, n: int, k: int, ids: pa.DataType, least: bool = False):
        self.n, self.k, self.least = n, k, least
        self.q, self.s, self.null, self.ids = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool), pa.array([], ids)
        self.bound = np.full(n, -np.inf)

    def add(self, q: np.ndarray, s: np.ndarray, null: np.ndarray, ids: pa.Array) -> None:
        if len(q) == 0:
            return
        q, s, null = np.concatenate([self.q, q]), np.concatenate([self.s, s]), np.concatenate([self.null, null])
        ids = pa.concat_arrays([self.ids, ids])
        nan = np.isnan(s) & ~null
        kind, s = np.where(null, 0, np.where(nan, 2, 1)), np.where(null | nan, 0.0, s)
        sign = 1 if self.least else -1
        order = np.lexsort((places(ids), sign * s, sign * kind, q))
        first = np.searchsorted(q[order], np.arange(self.n + 1))
        rank = np.arange(len(q)) - np.repeat(first[:-1], np.diff(first))
        order = order[rank < self.k]
        self.q, self.s, self.null, self.ids = q[order], np.where(nan, np.nan, s)[order], null[order], ids.take(pa.array(order))
        if not self.least:
            first = np.searchsorted(self.q, np.arange(self.n + 1))
            full = np.flatnonzero(np.diff(first) == self.k)
            last = first[full + 1] - 1
            kind = kind[order][last]
            self.bound[full] = np.where(kind == 0, -np.inf, np.where(kind == 2, np.inf, self.s[last]))

    def scores(self) -> pa.Array:
        return pa.array(self.s, mask=self.null)


class Vectors:
    """Some vectors, and the k largest inner products of each with rows that come in pieces. Each block of VECTORS keeps its own."""

    def __init__(self, vectors: pa.Array, k: int, kind: pa.DataType, ids: list | None = None):
        """kind: the type of the rows' ids. ids: those of the vectors, where a row of the same id is left out."""
        self.n, self.by = len(vectors), {}
        self.own = None if ids is None else {x: i for i, x in enumerate(ids)}
        for at, m, null, odd in matrices(vectors):
            for j in range(0, len(m), VECTORS):
                to = slice(j, j + VECTORS)
                plain = np.where(odd[to, None], 0.0, m[to])
                norm = np.sqrt((plain * plain).sum(axis=1))
                self.by.setdefault(m.shape[1], []).append((at[to], m[to], np.ascontiguousarray(plain.T), null[to], odd[to], norm, Best(len(plain), k, kind)))

    def anew(self) -> None:
        """Forgets all rows."""
        for blocks in self.by.values():
            blocks[:] = [(*x, Best(best.n, best.k, best.ids.type)) for *x, best in blocks]

    def meet(self, ids: pa.Array, rows: pa.Array) -> None:
        """Products by matrices tell apart what can't be among the k best, by a bound on what the order of a sum can change;
        the others are summed in order, as SQL does."""
        own = None if self.own is None else np.array([self.own.get(x, -1) for x in ids.to_pylist()], np.int64)
        for place, x, xnull, xodd in matrices(rows):
            d = x.shape[1]
            for i in range(0, len(x) if d in self.by else 0, ROWS):
                part, odd_row = x[i : i + ROWS], xodd[i : i + ROWS]
                plain = np.where(odd_row[:, None], 0.0, part)
                reach = float(np.sqrt((plain * plain).sum(axis=1).max()))
                for at, m, turned, null, odd, norm, best in self.by[d]:
                    s = plain @ turned
                    slack = 4 * (d + 4) * EPS * reach * norm + np.finfo(np.float64).tiny
                    if own is not None:
                        mine = own[place[i : i + ROWS]]
                        to = np.minimum(np.searchsorted(at, mine), len(at) - 1)
                        same = np.flatnonzero(at[to] == mine)
                        s[same, to[same]] = -np.inf
                    least, new = best.bound, np.flatnonzero(np.isneginf(best.bound))
                    if len(new) and len(s) > best.k and not odd_row.any():
                        least = least.copy()
                        least[new] = np.partition(s[:, new], len(s) - best.k, axis=0)[len(s) - best.k] - slack[new]
                    hit = s >= least - slack
                    if odd.any() or odd_row.any():
                        hit |= odd_row[:, None] | odd
                    r, q = np.nonzero(hit)
                    if own is not None:
                        other = own[place[i + r]] != at[q]
                        r, q = r[other], q[other]
                    for a in range(0, len(r), PAIRS):
                        rr, qq = r[a : a + PAIRS], q[a : a + PAIRS]
                        best.add(qq, in_order(part[rr], m[qq]), xnull[i + rr] | null[qq], ids.take(pa.array(place[i + rr])))

    def found(self) -> Iterator[tuple[np.ndarray, pa.Array, pa.Array]]:
        """(places of the vectors, ids of rows, scores), block by block."""
        for blocks in self.by.values():
            for at, *_, best in blocks:
                if len(best.q):
                    yield at[best.q], best.ids, best.scores()
