"""Quality of documents from a linear-chain conditional random field over their lines (operator 9).

Every line with a word is a position of the chain, good or bad. A position's features are measures of the line and of
the lines before and after it; transitions have weights of their own. The model is trained here, on at most
TRAIN_DOCS labelled documents (those with the smallest id digests), every line with its document's label, by
gradient steps on the exact conditional likelihood; of a long document a run of `lines` lines is the chain to learn
from, with the neighbours that its ends have in the document. A document's score is the mean of its lines' forward-backward
marginals of "good", weighted by length. Whole texts are scored, on their bytes, in one pass without a shuffle.

Edge cases: null texts and texts without a word score the training documents' share of label 1 (0.5 without labels);
null labels and labels of unknown documents are ignored; repeated equal labels count once, labels that disagree each;
of rows that share a labelled id the one with the least text digest is learned from; documents of any length are scored
whole; other columns, whatever their names, are never looked at; without two kinds of labels every score is that share;
an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, arrow_map, drawn, mix, span_hashes, text_chunks, word_spans

TRAIN_DOCS, TRAIN_LINES, STEPS = 4_000, 48, 120

_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = True
_ALPHA[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_KINDS = {"symbol": b"#*$%&<>@^~_=+\\", "bar": b"|", "bang": b"!?", "digit": b"0123456789", "stop": b".,;:", "bracket": b"()[]{}/\"'"}
_TABLES = [np.isin(np.arange(256), np.frombuffer(v, np.uint8)) for v in _KINDS.values()]
N_OWN = 16


def line_features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, lengths in bytes and document number of every line that holds a word."""
    starts, ends, _ = word_spans(data, offs)
    if not len(starts):
        return np.zeros((0, N_OWN)), np.zeros(0), np.zeros(0, np.int64)
    full = offs[:-1][np.diff(offs) > 0]
    breaks = np.flatnonzero(data == 10) + 1
    heads = np.union1d(full, breaks[breaks < len(data)])
    line = np.searchsorted(heads, starts, "right") - 1
    n = np.bincount(line, minlength=len(heads)).astype(np.float64)
    has = n > 0
    w = np.maximum(n, 1)
    count = lambda flag: np.add.reduceat(flag.astype(np.int32), heads).astype(np.float64)
    size = count(~np.isin(data, (9, 10, 11, 12, 13, 32)))
    b = np.maximum(size, 1)
    alpha = count(_ALPHA[data])
    upper = _UPPER[data]
    upper[1:] |= (data[:-1] == 195) & (data[1:] <= 0x9E) & (data[1:] >= 0x80)
    upper = count(upper)
    kinds = [count(t[data]) for t in _TABLES]
    h = span_hashes(data, starts, ends)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
    near = np.zeros(len(h), bool)
    for k in (2, 3, 4):
        near[k:] |= (h[k:] == h[:-k]) & (line[k:] == line[:-k])
    per_word = lambda x: np.bincount(line, x, minlength=len(heads)) / w
    key = np.zeros(len(heads), np.uint64)
    np.add.at(key, line, mix(h ^ (np.arange(len(h)) - np.searchsorted(line, line)).astype(np.uint64) * U(0x9E3779B97F4A7C15)))
    doc = np.searchsorted(offs, heads, "right") - 1
    again = pd.Series(mix(key ^ mix(doc.astype(np.uint64) + U(1)))).duplicated().to_numpy()
    last = data[np.maximum.reduceat(ends, np.searchsorted(line, np.flatnonzero(has))) - 1]
    ended = np.zeros(len(heads))
    ended[has] = np.isin(last, np.frombuffer(b".!?:;\"')", np.uint8))
    cols = [np.log1p(n), size / w, upper / np.maximum(alpha, 1), alpha / b, *(k / w for k in kinds), per_word(same), per_word(near), again * 1.0, ended, (n < 4) * 1.0, np.minimum(n, 400) / 100]
    f = np.stack([np.minimum(c, 50.0) for c in cols], axis=1)
    return f[has], (size + n)[has], doc[has]


def with_neighbours(f: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and after it (zero at the ends), and a constant."""
    n, z = len(f), np.zeros((1, f.shape[1]))
    before, after = np.concatenate([z, f[:-1]]), np.concatenate([f[1:], z])
    edge = np.ones(n + 1, bool)
    edge[1:-1] = doc[1:] != doc[:-1]
    before[edge[:-1]] = 0
    after[edge[1:]] = 0
    return np.concatenate([f, before, after, edge[:-1, None] * 1.0, edge[1:, None] * 1.0, np.ones((n, 1))], axis=1)


class Chains:
    """Chains of different lengths, longest first, position by position."""

    def __init__(self, doc: np.ndarray):
        self.names, first, size = np.unique(doc, return_index=True, return_counts=True)
        order = np.argsort(-size, kind="stable")
        self.order, self.first, self.size = order, first[order], size[order]
        self.live = np.searchsorted(-self.size, -np.arange(1, self.size[0] + 1), "right") if len(size) else np.zeros(0, int)

    def marginals(self, u: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """P(good) of every line, expected transition counts, and log Z. u: logits of good (of bad: 0); t: 2 x 2."""
        a, scale = np.empty((len(u), 2)), np.zeros(len(u))
        e = np.stack([np.zeros(len(u)), u], axis=1)
        e -= (top := e.max(axis=1, keepdims=True))
        x, m = np.exp(e), np.exp(t)
        for k, n in enumerate(self.live):
            at = self.first[:n] + k
            v = x[at] if k == 0 else (a[at - 1] @ m) * x[at]
            s = v.sum(axis=1)
            a[at], scale[at] = v / s[:, None], s
        b = np.ones((len(u), 2))
        pairs = np.zeros((2, 2))
        for k in range(len(self.live) - 1, 0, -1):
            at = self.first[: self.live[k]] + k
            v = x[at] * b[at] / scale[at][:, None]
            b[at - 1] = v @ m.T
            pairs += (a[at - 1].T @ v) * m
        p = a * b
        return p[:, 1] / p.sum(axis=1), pairs, float(np.log(scale).sum() + top.sum())


def train(f: np.ndarray, doc: np.ndarray, y: np.ndarray, inside: np.ndarray | None = None, steps: int = STEPS, decay: float = 1e-3) -> dict:
    """Weights from lines' features, document numbers and labels: Adam on the conditional likelihood.

    Lines that are not inside a run are neighbours of its ends and nothing else.
    """
    inside = np.ones(len(f), bool) if inside is None else inside
    mean, std = f[inside].mean(axis=0), f[inside].std(axis=0) + 1e-6
    x, doc, y = with_neighbours((f - mean) / std, doc)[inside], doc[inside], y[inside]
    chains = Chains(doc)
    inner = np.ones(len(doc), bool)
    inner[0] = False
    inner[1:] = doc[1:] == doc[:-1]
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[at - 1], y[at]), 1)
    w, t = np.zeros(x.shape[1]), np.zeros((2, 2))
    # lines of a document are not independent witnesses: each document weighs the same
    mw, vw, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)
    for k in range(1, steps + 1):
        p, pairs, _ = chains.marginals(x @ w, t)
        gw = x.T @ (p - y) / len(y) + decay * w
        gt = (pairs - seen) / len(y) + decay * t
        for g, m, v, z in ((gw, mw, vw, w), (gt, mt, vt, t)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            z -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return {"w": w, "t": t, "mean": mean, "std": std}


def score(model: dict, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    out = np.full(len(offs) - 1, model["share"])
    if "w" not in model:
        return out
    f, size, doc = line_features(data, offs)
    if len(f):
        x = with_neighbours((f - model["mean"]) / model["std"], doc)
        p, _, _ = Chains(doc).marginals(x @ model["w"], model["t"])
        weight = np.bincount(doc, size, minlength=len(out))
        some = weight > 0
        out[some] = np.clip((np.bincount(doc, p * size, minlength=len(out))[some]) / weight[some], 0, 1)
    return out


def _run_starts(ids: np.ndarray, n: np.ndarray, lines: int) -> np.ndarray:
    """Where in documents of n lines the run of lines begins that training looks at: by digest of the id."""
    room = np.maximum(n - lines, 0) + 1
    return (mix(ids.astype(np.int64).view(np.uint64) ^ U(0x51ED2701)) % room.astype(np.uint64)).astype(np.int64)


def _line_rows(batches: Iterator[pa.RecordBatch], lines: int) -> Iterator[pa.RecordBatch]:
    """(id, y, first, n, f): features of a run of lines and of the lines right before and after it; the run is first .. first + n of them."""
    for b in batches:
        for lo, hi, data, offs in text_chunks(b, "text"):
            f, _, doc = line_features(data, offs)
            n = np.bincount(doc, minlength=hi - lo)
            start = _run_starts(b.column(0).slice(lo, hi - lo).to_numpy(zero_copy_only=False), n, lines)
            nth = np.arange(len(doc)) - np.searchsorted(doc, doc) - start[doc]
            cut = (nth >= -1) & (nth <= lines)
            f, doc = f[cut].astype(np.float32), doc[cut]
            at = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32) * N_OWN
            own = [b.column(k).slice(lo, hi - lo) for k in range(2)]
            yield pa.RecordBatch.from_arrays([*own, pa.array((start > 0).astype(np.int32)), pa.array(np.minimum(n, lines).astype(np.int32)), pa.ListArray.from_arrays(pa.array(at), pa.array(f.ravel()))], ["id", "y", "first", "n", "f"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, where: str = "true", most: int = TRAIN_DOCS, lines: int = TRAIN_LINES) -> dict:
    """The model, from labels(doc_id, quality) for which `where` (on doc_id) holds; at most `most` labels, `lines` lines of each."""
    known = labels.where("quality in (0, 1) and doc_id is not null").where(where).select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("y"))
    known = drawn(known.distinct(), most, "id", "y")
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    both = src.join(F.broadcast(known), "id").groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = arrow_map(both, partial(_line_rows, lines=lines), "id long, y int, first int, n int, f array<float>").toPandas().sort_values(["id", "y"], kind="stable")
    if not len(rows):
        return {"share": 0.5}
    share = float(rows["y"].mean())
    size = rows["f"].map(len).to_numpy() // N_OWN
    if share in (0.0, 1.0) or not size.sum():
        return {"share": share}
    f = np.concatenate([np.asarray(x, np.float64) for x in rows["f"]]).reshape(-1, N_OWN)
    doc = np.repeat(np.arange(len(rows)), size)
    nth = np.arange(len(doc)) - np.searchsorted(doc, doc)
    first, n = rows["first"].to_numpy()[doc], rows["n"].to_numpy()[doc]
    return {"share": share} | train(f, doc, np.repeat(rows["y"].to_numpy(), size), (nth >= first) & (nth < first + n))


def _scores(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, offs in text_chunks(b, "text"):
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(score(model, data, offs))], ["id", "score"])


def quality_scores(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(src, partial(_scores, model=model), "id long, score double")


def good_documents(docs: DataFrame, model: dict, text_col: str = "text", *, cutoff: float = 0.7) -> DataFrame:
    """The rows of docs with a score of at least cutoff, all columns as they are."""
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offs in text_chunks(b, text_col):
                yield b.slice(lo, hi - lo).filter(pa.array(score(model, data, offs) >= cutoff))

    return arrow_map(docs, keep, schema)
