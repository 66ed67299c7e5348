"""Sets of character windows of many texts at once, as numbers in the windows' own order, and their MD5 hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_TURN = np.array([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], np.uint32)
_SINE = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2**32).astype(np.uint32)


def texts_of(col: pa.Array) -> list[str]:
    """A string column as Python's; a null is an empty text."""
    return ["" if x is None else x.decode("utf-8", "replace") for x in col.cast(pa.large_binary()).to_pylist()]


class Shingled:
    """Every text's set of windows of n characters, without its very last window: `sets` has them as increasing codes, which
    mean the same in all texts of this object, in the order of the windows."""

    def __init__(self, texts: list[str], n: int = 5):
        self.n = n
        ends = np.cumsum(np.array([len(x) for x in texts], np.int64))
        self.chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        seen = np.zeros(0x110000, bool)
        seen[self.chars] = True
        self.letters = np.flatnonzero(seen)
        rank = np.zeros(0x110000, np.int64)
        rank[self.letters] = np.arange(len(self.letters))
        many = max(2, len(self.letters))
        r, m = rank[self.chars], max(0, len(self.chars) - n + 1)
        code, top = r[:m], many
        for k in range(1, n):
            if top * many >= 1 << 62:  # an alphabet this large: numbered anew, in the same order
                code = np.unique(code, return_inverse=True)[1].reshape(-1).astype(np.int64)
                top = int(code.max()) + 1 if m else 1
            code, top = code * many + r[k : k + m], top * many
        self.code = code
        self.sets = [self._set(a, b) for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist())]

    def _set(self, a: int, b: int) -> np.ndarray:
        x = np.sort(self.code[a : max(a, b - self.n)])
        return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x

    def told(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct windows' characters (a row for each), the place of each set's codes among them, all sets in a row, and
        where sets end."""
        every = np.concatenate([*self.sets, np.zeros(0, np.int64)])
        codes, place = np.unique(every, return_inverse=True)
        many = max(2, len(self.letters))
        if many**self.n < 1 << 62:  # a code is its letters' numbers
            left, rows = codes, np.empty((len(codes), self.n), np.uint32)
            for k in range(self.n - 1, -1, -1):
                left, at = np.divmod(left, many)
                rows[:, k] = self.letters[at] if len(codes) else 0
        else:
            first = np.unique(self.code, return_index=True)
            at = first[1][np.searchsorted(first[0], codes)]
            rows = self.chars[at[:, None] + np.arange(self.n)]
        return rows, place.reshape(-1), np.cumsum([len(x) for x in self.sets])


def utf8(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of rows of characters, padded with zeros, and how many there are."""
    out = np.zeros((len(rows), 4 * rows.shape[1]), np.uint8)
    size = np.full(len(rows), rows.shape[1], np.int64)
    plain = (rows < 0x80).all(axis=1)
    out[plain, : rows.shape[1]] = rows[plain]
    other = np.flatnonzero(~plain)
    if len(other):
        out[other], size[other] = _utf8(rows[other])
    return out, size


def _utf8(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = 1 + (rows >= 0x80).astype(np.int64) + (rows >= 0x800) + (rows >= 0x10000)
    end = np.cumsum(size, axis=1)
    out = np.zeros((len(rows), 4 * rows.shape[1]), np.uint8)
    for n, lead in ((1, 0), (2, 0xC0), (3, 0xE0), (4, 0xF0)):
        i, j = np.nonzero(size == n)
        c, at = rows[i, j], end[i, j] - n
        for k in range(n):
            out[i, at + k] = ((c >> (6 * (n - 1 - k))) & (0x3F if k else 0xFF)) | (lead if k == 0 else 0x80)
    return out, end[:, -1]


def md5_words(data: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first four bytes of the MD5 of each row's first bytes (55 at most), big-endian."""
    block = np.zeros((len(data), 64), np.uint8)
    block[:, : data.shape[1]] = data
    block[np.arange(len(data)), size] = 0x80
    block[:, 56:58] = (size * 8).astype("<u2")[:, None].view(np.uint8)
    out = np.empty(len(data), np.uint32)
    for at in range(0, len(data), 8_192):
        m = np.ascontiguousarray(block[at : at + 8_192].view("<u4").T)
        used = m.any(axis=1)
        a, b, c, d = (np.full(m.shape[1], x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
        for i in range(64):
            q = i // 16
            f, g = ((b & c) | (~b & d), i) if q == 0 else ((d & b) | (~d & c), (5 * i + 1) % 16) if q == 1 else (b ^ c ^ d, (3 * i + 5) % 16) if q == 2 else (c ^ (b | ~d), 7 * i % 16)
            f = f + a + _SINE[i]
            if used[g]:
                f += m[g]
            s = _TURN[q, i % 4]
            a, d, c, b = d, c, b, b + ((f << s) | (f >> np.uint32(32 - s)))
        out[at : at + 8_192] = (a + np.uint32(0x67452301)).byteswap()
    return out


def hashes(windows: np.ndarray) -> np.ndarray:
    """The first 28 bits of each window's MD5."""
    return md5_words(*utf8(windows)) >> np.uint32(4)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many codes two sets share."""
    x = np.sort(np.concatenate([a, b]))
    return int((x[1:] == x[:-1]).sum())


def least_permuted(s: Shingled, a: np.ndarray, b: np.ndarray, prime: int, rows: int = 32_768) -> np.ndarray:
    """For each set, the least (a * hash + b) modulo prime = 2^31 - 1 of each permutation; prime for an empty set.

    So many distinct windows are permuted at a time; a window that many texts have is permuted once."""
    windows, place, ends = s.told()
    low = np.full((len(ends), len(a)), prime, np.uint32)
    sets = np.split(place, ends[:-1]) if len(ends) else []
    made, wide, more = np.empty((rows, len(a)), np.uint32), np.empty((256, len(a)), np.uint64), np.empty((256, len(a)), np.uint64)
    for at in range(0, len(windows), rows):
        h = hashes(windows[at : at + rows]).astype(np.uint64)
        for k in range(0, len(h), 256):  # as much as stays in a core's cache
            x, y, z = wide[: len(h) - k], more[: len(h) - k], made[k : min(k + 256, len(h))]
            np.multiply(h[k : k + 256, None], a, out=x)
            x += b
            np.right_shift(x, np.uint64(31), out=y)
            x &= np.uint64(prime)
            x += y  # modulo 2^31 - 1, but for one subtraction
            z[:] = x
            np.minimum(z, z - np.uint32(prime), out=z)
        for i, one in enumerate(sets):
            lo, hi = np.searchsorted(one, (at, at + len(h)))
            for k in range(lo, hi, 1_024):
                np.minimum(low[i], np.take(made, one[k : min(k + 1_024, hi)] - at, axis=0).min(axis=0), out=low[i])
    return low
