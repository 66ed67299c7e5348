"""What the training-data operators share: staged tables, Arrow chunks and byte-level text routines."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship, stage

#: The five ASCII separators besides the blank; a word is a maximal run of anything else.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

#: Python stages look at this many bytes of text at a time (one longer document is taken whole).
CHUNK_BYTES = 1 << 19


def ascii_lower(c: F.Column | str) -> F.Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _trimmed(batches: Iterator[pa.RecordBatch], f: Callable) -> Iterator[pa.RecordBatch]:
    """f's batches; then what the worker has freed goes back to the system, as workers live on between stages."""
    yield from f(batches)
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def arrow_map(df: DataFrame, f: Callable, schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(partial(_trimmed, f=f), schema)


def drawn(df: DataFrame, most: int, id_col: str = "id", *ties: str) -> DataFrame:
    """At most `most` rows of df: those with the smallest id digests (ties by id, then `ties`).

    A bound on the digest that leaves about twice as many goes first, so a task returns few rows however many tasks
    there are; should it leave too few, the rows are taken without it.
    """
    digest, n = F.xxhash64(id_col), df.count()
    if n > 4 * most:
        near = df.where(digest < int(2 * most / n * 2**64) - 2**63)
        df = near if near.limit(most).count() == most else df
    return df.orderBy(digest, id_col, *ties).limit(most)


# Rows and keys

#: Keys that hold more than a HEAVY-th of all rows are taken apart in joins; there are fewer than HEAVY of them.
HEAVY = 10_000


def fresh(df: DataFrame, name: str) -> str:
    """name, or it with underscores behind, such that df has no such column (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_digest(df: DataFrame) -> F.Column:
    """A 64-bit digest of a whole row; maps have no order and go in as JSON."""
    plain = [F.to_json(F.col(f"`{f.name}`")) if f.dataType.simpleString().startswith("map") else F.col(f"`{f.name}`") for f in df.schema.fields]
    return F.xxhash64(F.lit(len(plain)), *plain)


def join_counted(rows: DataFrame, facts: DataFrame, keys: list[str], count: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with facts (one row for each key; `count` says how many rows have it, `total` how many there are).

    A key that more than a HEAVY-th of all rows have would make one task too large. Fewer than HEAVY keys can be like
    that: digests of theirs (a bounded list) tell the rows that meet their facts by broadcast from those that are
    shuffled. HEAVY facts or fewer are broadcast as they are. facts is read several times and best a staged table.
    """
    if facts.count() <= HEAVY:
        return rows.join(F.broadcast(facts), keys, how)
    digest = F.xxhash64(*keys)
    heavy = [r[0] for r in facts.where(F.col(count) * HEAVY > total).select(digest).collect()]
    if not heavy:
        return rows.join(facts, keys, how)
    apart = digest.isin(heavy)
    return rows.where(apart).join(F.broadcast(facts.where(apart)), keys, how).unionByName(rows.where(~apart).join(facts.where(~apart), keys, how))


# Arrow strings as one byte array


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of rows; a null is an empty text."""
    col = batch.column(batch.schema.get_field_index(column))
    col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
    n = len(col)
    if n == 0:
        return
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, dtype=np.int64)[col.offset : col.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offs, offs[at] + limit, "right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end, raw[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


# Hashing

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=np.uint64) + U(seed)) * U(0x9E3779B97F4A7C15))


BYTE = seeds(256, 11)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTE_LOWER = BYTE[LOWER]
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_power = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_power["up"]) < n:
        n = max(n, 1 << 16)
        for k, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _power[k] = np.multiply.accumulate(p)
    return _power["up"], _power["down"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, by: np.ndarray = BYTE) -> np.ndarray:
    """64-bit hashes of the bytes [start, end) of many spans, in increasing order: prefix sums of a polynomial.

    Spans are taken in groups that cover at most CHUNK_BYTES, so memory doesn't follow the length of a text.
    """
    out = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        lo = int(starts[k])
        j = max(k + 1, int(np.searchsorted(ends, lo + CHUNK_BYTES, "right")))
        hi = int(ends[j - 1])
        up, down = _powers(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(by[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        s, e = starts[k:j] - lo, ends[k:j] - lo
        out[k:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * U(0xD6E8FEB86659FD93))
        k = j
    return out


def word_spans(data: np.ndarray, offs: np.ndarray, apart: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (maximal runs of bytes not in `apart`), and the word offsets of each text."""
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    sp = apart[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = True
    edge[1:] = True
    edge[1:-1] = sp[:-1]
    edge[offs] = True
    word = ~sp
    starts = np.flatnonzero(word & edge[:-1])
    edge[:-2] = False
    edge[:-2] = sp[1:]
    edge[-2] = True
    edge[offs[offs > 0] - 1] = True
    ends = np.flatnonzero(word & edge[:-1]) + 1
    return starts, ends, np.searchsorted(starts, offs)


__all__ = ["BYTE", "BYTE_LOWER", "CHUNK_BYTES", "HEAVY", "IS_SPACE", "SPACES", "U", "WORD", "arrow_map", "ascii_lower", "drawn", "fresh", "join_counted", "mix", "row_digest", "seeds", "span_hashes", "stage", "text_chunks", "word_spans"]
