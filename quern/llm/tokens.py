"""Vectorised pre-tokenisation for two of the public tokenizers, with the library itself behind it.

`Pretokens` finds the pre-tokens of many texts at once on their bytes. That is proven for texts of ASCII and
U+00C0..U+00FF without control characters; any other text, and any that holds "<|" (special strings), goes to the
library as a whole. So results are the library's for every text, and speed is for the common ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd

from .common import U, span_hashes

LETTER, DIGIT, SPACE, OTHER = 0, 1, 2, 3
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[65:91] = _CLASS[97:123] = LETTER
_CLASS[48:58] = DIGIT
_CLASS[[32, 9, 10, 11, 12, 13]] = SPACE
_CLASS[128:192] = LETTER  # continuation bytes, all after 0xC3 in a plain text
_CLASS[195] = LETTER
_PLAIN = np.zeros(256, bool)
_PLAIN[32:127] = True
_PLAIN[9:14] = True
_PLAIN[128:192] = True
_PLAIN[195] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TAILS = {ord("s"): 1, ord("t"): 1, ord("m"): 1, ord("d"): 1}
_PAIRS = ((ord("r"), ord("e")), (ord("v"), ord("e")), (ord("l"), ord("l")))


def plain_texts(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Which texts the byte routines cover."""
    odd = ~_PLAIN[data]
    if len(data) > 1:
        odd[:-1] |= (data[:-1] == 60) & (data[1:] == 124)
    seen = np.zeros(len(data) + 1, np.int64)
    np.cumsum(odd, out=seen[1:])
    return seen[offs[1:]] == seen[offs[:-1]]


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and U+00C0..U+00DE."""
    out = _LOWER[data]
    c3 = np.flatnonzero(data[:-1] == 195) + 1
    up = c3[(data[c3] >= 0x80) & (data[c3] <= 0x9E) & (data[c3] != 0x97)]
    out[up] += 32
    return out


def pretoken_spans(data: np.ndarray, offs: np.ndarray, blanks: bool) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of plain texts.

    blanks: True for the byte-level pattern (a blank belongs to what follows it, runs of digits stay whole), False for
    the pattern that drops white space and takes digits one by one. Contractions split the same way in both.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cls = _CLASS[data]
    signs = np.flatnonzero((data[:-1] == 195) & ((data[1:] == 0x97) | (data[1:] == 0xB7)))  # the times and division signs
    cls[signs] = cls[signs + 1] = OTHER
    first = np.zeros(n + 1, bool)
    first[offs] = True
    cut = first.copy()
    cut[1:n] |= cls[1:] != cls[:-1]
    if not blanks:
        digit = cls == DIGIT
        cut[:n] |= digit
    else:
        p = np.flatnonzero(cut[1:n] & ~first[1:n] & (cls[:-1] == SPACE) & (cls[1:] != SPACE)) + 1
        cut[p - 1] = True
        cut[p] = data[p - 1] != 32
    for i in np.flatnonzero((data == 39) & cut[:n]).tolist():
        a = int(data[i + 1]) if i + 1 < n and not first[i + 1] else 0
        b = int(data[i + 2]) if a and i + 2 < n and not first[i + 2] else 0
        k = _TAILS.get(a, 0) or 2 * ((a, b) in _PAIRS)
        if k:
            cut[i + 1] = False
            cut[i + 1 + k] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    if not blanks:
        word = cls[starts] != SPACE
        starts, ends = starts[word], ends[word]
    return starts, ends


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTERS = byte_letters()


def merged(model, text: str) -> list:
    """The model's merges of one pre-token."""
    return model.tokenize(text.encode().decode("latin-1").translate(_LETTERS))


class Cached:
    """For each distinct pre-token what `make(list of strings)` gives, kept by hash for at most `most` of them.

    There are two generations: when the young one is half of what may be kept it becomes the old one, and what is asked
    for again moves back, so common pre-tokens stay and the many that come once go.
    """

    def __init__(self, make, most: int = 120_000):
        self.make, self.most, self.known, self.old = make, most, {}, {}

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list]:
        """The number of its distinct pre-token for each span, and the values by that number."""
        codes, distinct = pd.factorize(span_hashes(data, starts, ends))
        keys = distinct.tolist()
        known, old, out, new = self.known, self.old, [], []
        for i, k in enumerate(keys):
            v = known.get(k)
            if v is None and (v := old.get(k)) is not None:
                known[k] = v
            if v is None:
                new.append(i)
            out.append(v)
        if new:
            at = np.empty(len(keys), np.int64)
            at[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)  # the first place of each
            raw = data.tobytes()
            texts = [raw[starts[at[i]] : ends[at[i]]].decode() for i in new]
            for i, v in zip(new, self.make(texts), strict=True):
                out[i] = known[keys[i]] = v
        if len(known) > self.most // 2:
            self.old, self.known = known, {}
        return codes, out


def split_plain(data: np.ndarray, offs: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the plain texts alone."""
    if plain.all():
        return data, offs
    size = np.diff(offs)
    keep = np.repeat(plain, size)
    out = np.zeros(int(plain.sum()) + 1, np.int64)
    np.cumsum(size[plain], out=out[1:])
    return data[keep], out


__all__ = ["Cached", "U", "lowered", "merged", "plain_texts", "pretoken_spans", "split_plain"]
