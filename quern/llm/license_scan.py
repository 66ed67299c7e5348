"""Licence scans with a trained paragraph classifier (operator 10).

A paragraph is a line, with the lines that it is wrapped into: a line goes on in the next one if it ends without a
stop and no blank line is between. In windows of 2 x HALF tokens, half overlapping, it is a sparse bag of word 1- and
2-grams, hashed; a softmax regression over licence families and "none" is trained here on notices and licence bodies
with words dropped and added, alone and inside corpus text, against at most NEGATIVES lines of the corpus and sentences
that speak of licences and grant none (negated, comparing, telling). The logits are divided by a temperature fitted on
held-out variants, and the score that a licence needs is set above all but a NOISE share of held-out plain lines.

Each prediction is then compared with templates, the notices in pieces of PIECE words. A family is named in a likely
window that has a CONFIRMED share (in any other window, as of a short notice inside a long paragraph, a SURE share) of
a template's word pairs, and as much of those pairs that no other family's templates have: families whose windows look
alike compete by what is their own, and a paragraph may name several. A notice with a negation or a comparison right
before it names none. A likely window in which no family is named but that holds word pairs of templates is the
"unknown" class, unless a family is named at most AROUND windows away: then it is the rest of that licence.

Edge cases: null, empty and wordless texts have no licence; a text of any length is scanned whole; several families
are all listed, sorted; repeated rows count each; null ids are kept; an empty table gives an empty one; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_LOWER, U, arrow_map, drawn, mix, span_hashes, text_chunks, word_spans
from .license_texts import NAMES, NEGATIONS, NO_GRANT, TEMPLATES

FAMILIES = ("none", *TEMPLATES)
BUCKETS, HALF, NEGATIVES, NOISE, CONFIRMED, SURE = 1 << 14, 32, 4_000, 0.0005, 0.5, 0.75
PIECE, AROUND, BEFORE = 40, 64, 8
_APART = np.ones(256, bool)
for _r in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _APART[slice(*_r)] = False


def windows(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token starts, ends and hashes; half-window of each token; paragraph number of each half."""
    starts, ends, _ = word_spans(data, offs, _APART)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), z, z
    h = span_hashes(data, starts, ends, BYTE_LOWER)
    breaks, stops = (np.concatenate([[0], np.cumsum(np.isin(data, np.frombuffer(v, np.uint8)))]) for v in (b"\n", b".!?:;"))
    between = breaks[starts[1:]] - breaks[ends[:-1]]
    stopped = stops[starts[1:]] - stops[ends[:-1]] > 0
    doc = np.searchsorted(offs, starts, "right") - 1
    new = np.ones(len(starts), bool)
    new[1:] = (between > 1) | ((between == 1) & stopped) | (doc[1:] != doc[:-1])
    line = np.cumsum(new) - 1
    nth = np.arange(len(line)) - np.searchsorted(line, line)
    new = (nth % HALF) == 0
    half = np.cumsum(new) - 1
    return starts, ends, h, half, line[new]


def grams(h: np.ndarray, half: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the 1- and 2-grams, and the half each belongs to. A pair may reach over to the next half."""
    joined = line[half[1:]] == line[half[:-1]] if len(h) else np.zeros(0, bool)
    two = mix(h[:-1] * U(3) + h[1:])[joined] if len(h) else h
    return np.concatenate([h % U(BUCKETS), two % U(BUCKETS)]).astype(np.int64), np.concatenate([half, half[:-1][joined] if len(h) else half])


def probabilities(model: dict, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Family probabilities of each window (its half and the next of the same line)."""
    tokens = windows(data, offs)
    _, _, h, half, line = tokens
    n = len(line)
    if not n:
        return np.zeros((0, len(FAMILIES))), tokens
    g, at = grams(h, half, line)
    order = np.argsort(at, kind="stable")
    w = model["w"][g[order]]
    sums = np.add.reduceat(w, np.searchsorted(at[order], np.arange(n)), axis=0)
    size = np.bincount(at, minlength=n).astype(np.float32)
    more = np.flatnonzero(line[1:] == line[:-1])
    sums2, size2 = sums.copy(), size.copy()
    sums2[more] += sums[more + 1]
    size2[more] += size[more + 1]
    z = (sums2 / np.sqrt(size2)[:, None] + model["b"]) / model["heat"]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True), tokens


@lru_cache(maxsize=1)
def _all_pairs() -> frozenset[int]:
    return frozenset().union(*(t for v in _template_pairs().values() for t in v))


@lru_cache(maxsize=1)
def _template_pairs() -> dict[str, list[frozenset[int]]]:
    return {k: [frozenset(_pairs(piece)) for t in v for piece in _pieces(t)] for k, v in TEMPLATES.items()}


def _pieces(text: str) -> list[str]:
    """A text in equal pieces of at most PIECE words."""
    words = text.split()
    n = -(-len(words) // PIECE)
    return [" ".join(words[len(words) * k // n : len(words) * (k + 1) // n]) for k in range(n)]


@lru_cache(maxsize=1)
def _negations() -> np.ndarray:
    return np.concatenate([_tokens(w) for w in NEGATIONS])


def _pairs(text: str) -> list[int]:
    raw = np.frombuffer(text.encode(), np.uint8)
    s, e, _ = word_spans(raw, np.array([0, len(raw)]), _APART)
    h = span_hashes(raw, s, e, BYTE_LOWER)
    return mix(h[:-1] * U(3) + h[1:]).tolist()


def confirmed(family: str, h: np.ndarray) -> bool:
    """Whether one of the family's templates has CONFIRMED of its word pairs among the tokens' (or covers half of them)."""
    have = set(mix(h[:-1] * U(3) + h[1:]).tolist())
    return any(len(t & have) >= CONFIRMED * min(len(t), max(3, len(have))) for t in _template_pairs()[family])


@lru_cache(maxsize=1)
def _own_pairs() -> dict[str, list[tuple[frozenset[int], frozenset[int]]]]:
    """Each template's word pairs, and those of them that no other family has."""
    found = _template_pairs()
    others = {k: frozenset().union(*(t for f, v in found.items() if f != k for t in v)) for k in found}
    return {k: [(t, t - others[k]) for t in v] for k, v in found.items()}


@lru_cache(maxsize=1)
def _all_own() -> np.ndarray:
    return np.array(sorted({x for v in _own_pairs().values() for _, own in v for x in own}), U)


def named(family: str, own: np.ndarray, pairs: np.ndarray, share: float = CONFIRMED) -> bool:
    """Whether a template has `share` of its word pairs among the tokens', as much of those of its family alone, and no negation before it."""
    have = set(pairs.tolist())
    for t, alone in _own_pairs()[family]:
        if alone and len(alone & have) >= share * len(alone) and len(t & have) >= share * len(t):
            first = int(np.flatnonzero(np.isin(pairs, np.array(sorted(t), U)))[0])
            if not np.isin(own[max(0, first - BEFORE) : first], _negations()).any():
                return True
    return False


def _any_confirmed(text: str) -> bool:
    h = _tokens(text)
    return not _all_pairs().isdisjoint(mix(h[:-1] * U(3) + h[1:]).tolist()) and any(confirmed(f, h) for f in TEMPLATES)


def scan(model: dict, data: np.ndarray, offs: np.ndarray) -> list[dict[str, float]]:
    """For each text the licences found, with the best probability of each."""
    out: list[dict[str, float]] = [{} for _ in range(len(offs) - 1)]
    p, (starts, _, h, half, line) = probabilities(model, data, offs)
    if not len(p):
        return out
    likely = 1 - p[:, 0] >= model["needs"]
    pairs = np.isin(mix(h[:-1] * U(3) + h[1:]), _all_own())
    holds = np.bincount(half[:-1][pairs], minlength=len(p)) > 0
    more = np.append(line[1:] == line[:-1], False)
    holds[:-1] |= holds[1:] & more[:-1]
    hits = np.flatnonzero(likely | holds)
    first = np.searchsorted(half, np.arange(len(p) + 2))
    doc = np.searchsorted(offs, starts[first[hits]], "right") - 1
    places: dict[int, list[int]] = {}
    unknown: list[tuple[int, int]] = []
    for i, d in zip(hits.tolist(), doc.tolist(), strict=True):
        own = h[first[i] : first[i + 1 + int(more[i])]]
        own_pairs = mix(own[:-1] * U(3) + own[1:])
        names = [k for k in range(1, len(FAMILIES)) if named(FAMILIES[k], own, own_pairs, CONFIRMED if likely[i] else SURE)]
        for k in names:
            out[d][FAMILIES[k]] = max(out[d].get(FAMILIES[k], 0.0), float(p[i, k]))
        if names:
            places.setdefault(d, []).append(i)
        elif likely[i] and len(_all_pairs().intersection(own_pairs.tolist())) >= 2 and not np.isin(own, _negations()).any():
            unknown.append((d, i))
    for d, i in unknown:
        if not any(abs(i - j) <= AROUND for j in places.get(d, ())):
            out[d]["unknown"] = max(out[d].get("unknown", 0.0), float(1 - p[i, 0]))
    return out


def _variants(rng: np.random.Generator, filler: list[str], lines: list[str], each: int) -> tuple[list[str], list[int]]:
    texts, y = [], []
    for k, fam in enumerate(TEMPLATES, 1):
        for t in (piece for x in TEMPLATES[fam] for piece in _pieces(x)):
            for i in range(each):
                words = t.split()
                if i and len(words) > 6:
                    words = [w for w in words if rng.random() > 0.06]
                if i % 3 == 1:
                    words = [*rng.choice(filler, rng.integers(1, 6)).tolist(), *words]
                if i % 3 == 2:
                    words = [*words, *rng.choice(filler, rng.integers(1, 6)).tolist()]
                text = " ".join(words)
                texts.append(text.upper() if i % 5 == 4 else text)
                y.append(k)
            for i in range(each // 2):  # inside a full window, every second time with another licence
                words, also = t.split(), 0
                if i % 2:
                    also = int(rng.integers(1, len(FAMILIES)))
                    words += ["or", *str(rng.choice(TEMPLATES[FAMILIES[also]])).split()]
                around = lines[rng.integers(len(lines))].split() if lines else rng.choice(filler, 2 * HALF).tolist()
                around = around[: max(0, 2 * HALF - len(words))]
                at = int(rng.integers(len(around) + 1))
                text = " ".join([*around[:at], *words, *around[at:]])
                texts += [text] * (1 + bool(also))
                y += [k, also][: 1 + bool(also)]
    return texts, y


def _told(rng: np.random.Generator, lines: list[str]) -> list[str]:
    """Sentences that speak of licences and grant none, alone and inside corpus text."""
    names = [n for v in NAMES.values() for n in v]
    out = [form.format(n, names[int(rng.integers(len(names)))]) for form in NO_GRANT for n in names for _ in range(2)]
    around = [lines[rng.integers(len(lines))].split()[:HALF] if lines else [] for _ in out]
    return out + [" ".join([*w, x]) for w, x in zip(around, out, strict=True)]


def cut(line: str) -> list[str]:
    """A line in pieces of HALF tokens."""
    raw = line.encode()
    s, e, _ = word_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), _APART)
    at = [0, *s[HALF::HALF].tolist(), len(raw)]
    return [raw[a:b].decode() for a, b in zip(at[:-1], at[1:], strict=True)]


def plain_windows(line: str) -> list[str]:
    """The windows of a line but those that share tokens with a confirmed one."""
    h = [*cut(line), ""]
    bad = [_any_confirmed(a + b) for a, b in zip(h[:-1], h[1:], strict=True)]
    return [h[i] + h[i + 1] for i in range(0, len(h) - 1, 2) if not any(bad[max(0, i - 1) : i + 2])]


def train(lines: list[str], seed: int = 5, each: int = 12, steps: int = 150) -> dict:
    """The model from plain corpus lines and the templates."""
    rng = np.random.default_rng(seed)
    lines = [x for line in lines for x in plain_windows(line)]
    plain = "the of and to in a is that for it as was with be by on this are from or not have an which at but all were can has more one about use file text work book page terms version free software source code license public general copy rights reserved".split()
    filler = sorted({w for x in lines[:500] for w in x.split()[:10]} | set(plain))
    pos, y = _variants(rng, filler, lines, each)
    noise = [" ".join(rng.choice(plain, rng.integers(1, 25))) for _ in range(600)] + _told(rng, lines)
    texts, y = pos + lines + noise, np.array(y + [0] * (len(lines) + len(noise)))
    raw = [t.replace("\n", " ").encode() for t in texts]
    offs = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(x) for x in raw], out=offs[1:])
    _, _, h, _, _ = tok = windows(np.frombuffer(b"".join(raw), np.uint8), offs)
    doc = np.searchsorted(offs, tok[0], "right") - 1
    one = np.arange(len(texts))
    g, at = grams(h, doc, one)
    size = np.sqrt(np.maximum(np.bincount(at, minlength=len(texts)), 1)).astype(np.float32)
    bags = _Bags(g, at, size, BUCKETS)
    held = rng.random(len(texts)) < 0.2
    w, b = np.zeros((BUCKETS, len(FAMILIES)), np.float32), np.zeros(len(FAMILIES), np.float32)
    goal = np.eye(len(FAMILIES), dtype=np.float32)[y]
    weight = np.where(y == 0, 1.0, max(1.0, (y == 0).sum() / max(1, (y > 0).sum()))).astype(np.float32)[:, None]
    weight[held] = 0
    mw, vw = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, steps + 1):
        e = (_softmax(bags.scores(w) + b) - goal) * weight / weight.sum()
        gw = bags.gradient(e) + 1e-6 * w
        mw += 0.1 * (gw - mw)
        vw += 0.01 * (gw * gw - vw)
        w -= 0.1 * (mw / (1 - 0.9**k)) / (np.sqrt(vw / (1 - 0.99**k)) + 1e-8)
        b -= 0.5 * e.sum(axis=0)
    z = (bags.scores(w) + b)[held]
    heat = min((0.5, 0.7, 1.0, 1.5, 2.0, 3.0), key=lambda t: -float(np.log(_softmax(z / t)[np.arange(len(z)), y[held]] + 1e-9).mean()))
    p = _softmax(z / heat)
    quiet = 1 - p[y[held] == 0, 0]
    needs = float(np.clip(np.quantile(quiet, 1 - NOISE) + 0.05 if len(quiet) else 0.5, 0.5, 0.9))
    return {"w": w, "b": b, "heat": np.float32(heat), "needs": needs}


class _Bags:
    """Sparse bags of hashed n-grams, each divided by the root of its size."""

    def __init__(self, g: np.ndarray, at: np.ndarray, size: np.ndarray, buckets: int):
        self.g, self.at, self.size, self.buckets = g, at, size[:, None], buckets

    def scores(self, w: np.ndarray) -> np.ndarray:
        sums = [np.bincount(self.at, v[self.g], len(self.size)) for v in w.T.copy()]
        return np.stack(sums, axis=1).astype(np.float32) / self.size

    def gradient(self, e: np.ndarray) -> np.ndarray:
        sums = [np.bincount(self.g, v[self.at], self.buckets) for v in (e / self.size).T.copy()]
        return np.stack(sums, axis=1).astype(np.float32)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _tokens(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    s, e, _ = word_spans(raw, np.array([0, len(raw)]), _APART)
    return span_hashes(raw, s, e, BYTE_LOWER)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, negatives: int = NEGATIVES) -> dict:
    """The model; its plain lines are the middle ones of at most `negatives` documents, those with the smallest digests."""
    line = F.expr(f"split(`{text_col}`, '\\n', -1)")
    middle = F.element_at(line, F.greatest(F.lit(1), (F.size(line) / 2).cast("int")))
    got = drawn(docs.select(F.col(id_col).alias("id"), middle.alias("x")), negatives).collect()
    return train(sorted(r.x for r in got if r.x and r.x.strip()))


def _found(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, offs in text_chunks(b, "text"):
            found = scan(model.value, data, offs)
            names = [",".join(sorted(x)) or None for x in found]
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(names, pa.string()), pa.array([len(x) for x in found], pa.int64()), pa.array([max(x.values(), default=None) for x in found], pa.float64())], ["id", "licenses", "n_licenses", "confidence"])


def license_scan(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, licenses, n_licenses, confidence) of every row; licenses: families joined by commas, null if none."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    return arrow_map(src, partial(_found, model=held), "id long, licenses string, n_licenses long, confidence double")
