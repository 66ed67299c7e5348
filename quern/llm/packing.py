"""Packing into training sequences under several limits at once (operator 2).

Vector bin packing by the dot-product rule: the open sequence has room left for tokens, segments and loss-bearing
tokens; of the waiting pieces that fit, the one whose demand has the largest inner product with the room left (both
as shares of the limits) goes in. When none fits, the best piece is cut to fill the sequence exactly, and its rest
waits on, so only the last sequence of a task can be short; that one is written as sequences of powers of two, which
need no padding. Every task packs what it reads, in order, with a bounded number of pieces waiting: no shuffle, no
state beyond the waiting pieces, and a lost task repeats with the same result. Which pieces share a sequence so
depends on how the table is split into tasks.

Of plain documents every token bears loss, so the third limit equals the first unless a smaller one is given. Examples
made of parts (`pack_examples`, `pack_conversations`) say which parts bear loss, as the answers of instruction data.

Edge cases: a null or empty text is the end token alone, as is an example without parts; a null part has no tokens, a
null loss mark means none; texts of any length are cut freely; null ids are packed as any other; repeated rows are
packed each time; an empty table gives an empty one; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, text_chunks
from .tokens import Cached, merged, plain_texts, pretoken_spans, split_plain

#: Pieces that wait in a task at most before one must go.
WAITING = 512


class Packer:
    """Streams pieces into sequences; add() takes (key, ids, loss mask or None), rows come out of `out`."""

    def __init__(self, tokens: int = 2048, segments: int = 256, loss: int | None = None, waiting: int = WAITING):
        self.limit = np.array([tokens, segments, loss or tokens], np.float64)
        self.waiting, self.items, self.out, self.sequence = waiting, [], [], 0
        self.need = np.zeros((2 * waiting + 2, 3))  # tokens, segments, loss-bearing tokens of what waits
        self.room = self.limit.copy()
        self.open: list = []

    def add(self, doc, ids: np.ndarray, loss: np.ndarray | None = None) -> None:
        tokens, total, start = int(self.limit[0]), len(ids), 0
        free = loss is None and self.limit[2] >= tokens
        while free and total - start >= tokens and not self.open:  # whole sequences of one document
            self._row(doc, start, ids[start : start + tokens], total, self.sequence, 0)
            self.sequence += 1
            start += tokens
        while start < total:
            end = min(total, start + tokens)
            # a copy: what waits must not keep the whole array it was cut from
            self._wait((doc, start, ids[start:end].copy(), None if loss is None else loss[start:end].copy(), total))
            start = end
            while len(self.items) > self.waiting:
                self._place()

    def _wait(self, item) -> None:
        self.need[len(self.items)] = len(item[2]), 1, len(item[2]) if item[3] is None else item[3].sum()
        self.items.append(item)

    def _take(self, i: int):
        item = self.items[i]
        last = len(self.items) - 1
        self.items[i] = self.items[last]
        self.need[i] = self.need[last]
        self.items.pop()
        return item

    def _row(self, doc, start, ids, total, sequence, offset) -> None:
        self.out.append((doc, start, ids, total, sequence, offset))

    def _place(self) -> None:
        need, n = self.need[: len(self.items)], len(self.items)
        value = need @ (self.room / (self.limit * self.limit))
        fits = (need <= self.room).all(axis=1)
        if fits.any():
            i = int(np.argmax(np.where(fits, value, -1.0)))
            self._put(self._take(i))
        elif n and self.room[1] >= 1 and self.room[0] >= 1 and self.room[2] >= 1:
            doc, start, ids, loss, total = self._take(int(np.argmax(value)))
            k = int(min(self.room[0], len(ids)))
            k = min(k, int(self.room[2]) if loss is None else int(np.searchsorted(np.cumsum(loss), self.room[2], "right")))
            self._put((doc, start, ids[:k], None if loss is None else loss[:k], total))
            if k < len(ids):
                self._wait((doc, start + k, ids[k:], None if loss is None else loss[k:], total))
        else:
            self._close()
        if self.room[0] < 1:
            self._close()

    def _put(self, item) -> None:
        self.open.append(item)
        self.room -= (len(item[2]), 1, len(item[2]) if item[3] is None else item[3].sum())

    def _close(self) -> None:
        at = 0
        for doc, start, ids, _, total in self.open:
            self._row(doc, start, ids, total, self.sequence, at)
            at += len(ids)
        if self.open:
            self.sequence += 1
        self.open, self.room = [], self.limit.copy()

    def finish(self) -> None:
        """Packs what waits; the last sequence leaves as powers of two."""
        while self.items:
            self._place()
        at, left = 0, sum(len(x[2]) for x in self.open)
        part = 1 << (left.bit_length() - 1) if left else 0
        for doc, start, ids, _, total in self.open:
            done = 0
            while done < len(ids):
                k = min(len(ids) - done, part - at)
                self._row(doc, start + done, ids[done : done + k], total, self.sequence, at)
                done, at = done + k, at + k
                if at == part:
                    left -= part
                    self.sequence, at, part = self.sequence + 1, 0, 1 << (left.bit_length() - 1) if left else 0
        self.open, self.room = [], self.limit.copy()


@lru_cache(maxsize=4)
def _encoder(path: str) -> tuple:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    model = t.model
    return t, Cached(lambda texts: [np.array([x.id for x in merged(model, w)], np.uint32).tobytes() for w in texts])


def encode_texts(data: np.ndarray, offs: np.ndarray, path: str, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many texts one after another, each with end_id behind it, and their offsets."""
    t, cached = _encoder(path)
    plain = plain_texts(data, offs)
    n, tail = len(offs) - 1, end_id is not None
    d, o = split_plain(data, offs, plain)
    flat, lens = np.zeros(0, np.uint32), np.zeros(int(plain.sum()), np.int64)
    if len(d):
        starts, ends = pretoken_spans(d, o, blanks=True)
        codes, values = cached(d, starts, ends)
        size = np.fromiter(map(len, values), np.int64, len(values)) // 4
        pool, at = np.frombuffer(b"".join(values), np.uint32), np.zeros(len(values) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        sums = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(size[codes], out=sums[1:])
        flat = pool[np.arange(sums[-1]) + np.repeat(at[codes] - sums[:-1], size[codes])]
        lens = np.diff(sums[np.searchsorted(starts, o)])
    total = np.zeros(n, np.int64)
    total[plain] = lens
    odd = {i: np.array(t.encode(data[offs[i] : offs[i + 1]].tobytes().decode(), add_special_tokens=False).ids, np.uint32) for i in np.flatnonzero(~plain).tolist()}
    for i, x in odd.items():
        total[i] = len(x)
    out_offs = np.zeros(n + 1, np.int64)
    np.cumsum(total + tail, out=out_offs[1:])
    out = np.empty(out_offs[-1], np.uint32)
    spot = np.ones(out_offs[-1], bool)
    if tail:
        out[out_offs[1:] - 1] = end_id
        spot[out_offs[1:] - 1] = False
    for i, x in odd.items():
        out[out_offs[i] : out_offs[i] + len(x)] = x
        spot[out_offs[i] : out_offs[i] + len(x)] = False
    out[spot] = flat
    return out, out_offs


def _rows(p: Packer, base: int, with_ids: bool, id_type: pa.DataType) -> pa.RecordBatch:
    rows, p.out = p.out, []
    cols = [pa.array([r[0] for r in rows], id_type)]
    for v in ([r[1] for r in rows], [len(r[2]) for r in rows], [zlib.crc32(r[2].astype("<u4").tobytes()) for r in rows], [r[3] for r in rows], [base + r[4] for r in rows], [r[5] for r in rows]):
        cols.append(pa.array(v, pa.int64()))
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        cols.append(pa.array([r[2].astype(np.int32) for r in rows], pa.list_(pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(cols, names)


def _pack(batches: Iterator[pa.RecordBatch], path: str, end_id: int, tokens: int, segments: int, loss: int | None, with_ids: bool) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    base, p = TaskContext.get().partitionId() << 36, Packer(tokens, segments, loss)
    kind = pa.int64()
    for b in batches:
        for lo, hi, data, offs in text_chunks(b, "text"):
            ids, at = encode_texts(data, offs, path, end_id)
            for doc, s, e in zip(b.column(0).slice(lo, hi - lo).to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                p.add(doc, ids[s:e])
            if p.out:
                yield _rows(p, base, with_ids, kind)
    p.finish()
    if p.out:
        yield _rows(p, base, with_ids, kind)


def _pack_parts(batches: Iterator[pa.RecordBatch], path: str, end_id: int, tokens: int, segments: int, loss: int | None, with_ids: bool) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    base, p, kind = TaskContext.get().partitionId() << 36, Packer(tokens, segments, loss), pa.int64()
    tail = np.array([end_id], np.uint32)
    for b in batches:
        parts = b.column(1)
        many, flat = parts.value_lengths().fill_null(0).to_numpy(), parts.flatten()
        bears = flat.field("loss").fill_null(False).to_numpy(zero_copy_only=False)
        ids, mask = [], []
        for lo, hi, data, offs in text_chunks(pa.RecordBatch.from_arrays([flat.field("text")], ["text"]), "text"):
            got, at = encode_texts(data, offs, path, None)
            ids += [got[s:e] for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            mask += [np.full(e - s, m, np.int64) for s, e, m in zip(at[:-1].tolist(), at[1:].tolist(), bears[lo:hi].tolist(), strict=True)]
        k = 0
        for doc, n in zip(b.column(0).to_pylist(), many.tolist(), strict=True):
            last = np.array([n > 0 and bears[k + n - 1]], np.int64)  # the end token goes with the last part
            p.add(doc, np.concatenate([*ids[k : k + n], tail]), np.concatenate([*mask[k : k + n], last]))
            k += n
        if p.out:
            yield _rows(p, base, with_ids, kind)
    p.finish()
    if p.out:
        yield _rows(p, base, with_ids, kind)


_PIECES = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", *, tokens: int = 2048, segments: int = 256, loss: int | None = None, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]) of all texts."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    f = partial(_pack, path=tokenizer_path, end_id=end_id, tokens=tokens, segments=segments, loss=loss, with_ids=with_ids)
    return arrow_map(src, f, _PIECES + ", ids array<int>" * with_ids)


def pack_examples(examples: DataFrame, tokenizer_path: str, id_col: str = "id", parts_col: str = "parts", *, tokens: int = 2048, segments: int = 256, loss: int | None = None, end_id: int = 1, with_ids: bool = True) -> DataFrame:
    """The same for examples whose parts, an array of (text, loss), are encoded one after another.

    A sequence holds at most `tokens` tokens, `segments` pieces and `loss` tokens of parts that bear loss.
    """
    parts = F.col(f"`{parts_col}`").cast("array<struct<text:string,loss:boolean>>")
    f = partial(_pack_parts, path=tokenizer_path, end_id=end_id, tokens=tokens, segments=segments, loss=loss, with_ids=with_ids)
    return arrow_map(examples.select(F.col(f"`{id_col}`").cast("long").alias("id"), parts.alias("parts")), f, _PIECES + ", ids array<int>" * with_ids)


def pack_conversations(chats: DataFrame, tokenizer_path: str, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", *, answers: str = "assistant", **limits) -> DataFrame:
    """Conversations as examples: a tagged part for each turn, of which those of the role `answers` bear loss."""
    x = F.struct(*[F.col(f"`{c}`").alias(n) for c, n in ((turn_col, "turn"), (role_col, "role"), (text_col, "text"))])
    turns = chats.groupBy(F.col(f"`{conv_col}`").alias("id")).agg(F.sort_array(F.collect_list(x)).alias("turns"))
    part = lambda t: F.struct(F.concat(F.lit("<|im_start|>"), F.coalesce(t["role"], F.lit("")), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit("<|im_end|>\n")).alias("text"), F.coalesce(t["role"] == answers, F.lit(False)).alias("loss"))
    return pack_examples(turns.select("id", F.transform("turns", part).alias("parts")), tokenizer_path, **limits)
