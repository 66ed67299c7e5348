"""Queries without SQL, over whole tables, against plain Python."""

import hashlib
import re

import duckdb
import pytest

from quern.operators import blend as B
from quern.operators import samples as S
from quern.plans import registry


def texts(sf):
    return dict(duckdb.execute(f"select doc_id, text from '{sf}/documents.parquet'").fetchall())


def words(text):
    return re.findall(r"\w+", text.lower())


def test_samples_hold_every_word(spark, sf):
    """Each 512 words of a text are a sample, to its end."""
    parts = {(i, k): w[k * 512 : k * 512 + 512] for i, t in texts(sf).items() if (w := words(t)) for k in range(-(-len(w) // 512))}
    assert max(k for _, k in parts) > 0
    got = {(r.id, r.sample): (r.n, r.masked) for r in registry.QUERIES["W9_masked_tokens"](spark, sf).collect()}
    assert got == {(i, k): (len(w), len(S.masked(w, 7 + i + k * 0x9E3779B1)[1])) for (i, k), w in parts.items()}
    got = {(r.id, r.sample): (r.encoder, r.decoder) for r in registry.QUERIES["W11_span_corruption"](spark, sf).collect()}
    assert got == {(i, k): tuple(map(len, S.span_corrupted(w, 7 + i + k * 0x9E3779B1))) for (i, k), w in parts.items()}


def test_pair_samples_hold_every_word(spark, sf):
    """The samples of a text of two sentences or more have all its words, in two halves each."""
    want, long = {}, 0
    for i, t in texts(sf).items():
        s = [w for x in re.findall(r"[^.!?]+[.!?]*", t) if (w := words(x))]
        if len(s) > 1:
            want[i], long = sum(map(len, s)), long + (len(s) > 20)
    got = {}
    for r in registry.QUERIES["W10_pair_samples"](spark, sf).collect():
        assert r.n <= 131 and 2 <= r.second <= r.n - 3
        got[r.id] = got.get(r.id, 0) + r.n - 3
    assert long and got == want


@pytest.mark.parametrize("sizes", [[1, 1], [64, 64, 1], [64, 64, 64], [300, 1], [1, 300], [5] * 60, [128, 128, 1], [200, 7, 129, 1]])
def test_pair_groups(sizes):
    at = iter(range(sum(sizes)))
    s = [[next(at) for _ in range(n)] for n in sizes]
    got = S.pair_groups(s, 128)
    assert [w for g in got for p in g for w in p] == list(range(sum(sizes)))
    assert all(len(g) > 1 and all(g) and sum(map(len, g)) <= 128 for g in got)


@pytest.mark.parametrize("exhaustive", [False, True])
def test_blend_in_ranges(spark, exhaustive):
    """Ranges made apart are the picks of one walk."""
    sizes = [5, 300, 9, 41, 1, 77, 2]
    count, want = [0] * 7, []
    for i in range(sum(sizes)):
        k = max((j for j in range(7) if not exhaustive or count[j] < sizes[j]), key=lambda j: (sizes[j] / sum(sizes) * max(i, 1) - count[j], -j))
        want.append((i, k, count[k]))
        count[k] += 1
    assert sorted(map(tuple, B.blend_ranges(spark, sizes, exhaustive, step=50).collect())) == want


def test_blends_have_every_source(spark, sf):
    n = sorted(duckdb.execute(f"select count(*) from '{sf}/documents.parquet' group by source").fetchall())
    got = registry.QUERIES["B4_exhaustive_blend"](spark, sf).groupBy("dataset").count().collect()
    assert len(n) > 5 and sorted((r["count"],) for r in got) == n
    assert registry.QUERIES["B3_greedy_blend"](spark, sf).select("dataset").distinct().count() == len(n)


def test_patch_grid_of_every_document(spark, sf):
    """Patches of two frames in 2 x 2 blocks."""

    def grid(h, w):
        return [(t, y + b, x + a) for t in range(2) for y in range(0, h, 2) for x in range(0, w, 2) for b in range(2) for a in range(2)]

    want = {i: hashlib.md5(" ".join(".".join(map(str, p)) for p in grid((i % 3 + 1) * 2, (i % 2 + 1) * 2)).encode()).hexdigest() for i in texts(sf)}
    assert len(want) > 50 and dict(map(tuple, registry.QUERIES["S13_patch_grid"](spark, sf).collect())) == want


def test_overlap_of_whole_texts(spark, sf):
    """Every document has a row; all its words count if there are ten or more."""
    want = {}
    for i, t in texts(sf).items():
        n = len(words(t))
        size = n + -(-n * (i % 30 + 1) // 40)
        overlap = n if n >= 10 else 0
        want[i] = (overlap, overlap > 0 and size * 0.6 <= overlap <= size * 0.9)
    got = {r.doc_id: (r.overlap, r.kept) for r in registry.QUERIES["X18_overlap_filter"](spark, sf).collect()}
    assert got == want and {k for _, k in got.values()} == {False, True} and max(n for n, _ in got.values()) > 40


def test_overlap_in_runs():
    know = [f"k{i}" for i in range(100)]
    assert S.overlap_in_runs(know[:9] + ["x"] + know[:10] + ["x"] + know[50:90], know) == 50
    assert S.overlap_in_runs(know[:9], know) == 0 and S.overlap_in_runs([], []) == 0
    assert [S.overlap_kept(*x) for x in ((85, 100, 100), (79, 100, 100), (59, 100, 60), (91, 100, 100), (0, 0, 0), (90, 100, 100), (60, 100, 75))] == [True, False, False, False, False, True, True]


def test_few_shot_beyond_one_block(spark):
    """More queries than a block holds; topic 9 is unknown."""
    q = [(i, 9 if i % 500 == 0 else i % 3, [float(i % 7), 1.0]) for i in range(10_001)]
    e = [(j, j % 3, [float(j * j % 11), float(j % 5)]) for j in range(40)]
    score = lambda v, x: v[0] * x[0] + v[1] * x[1]
    want = set()
    for i, topic, v in q:
        if topic == 9:
            best = [min((-score(v, x), j) for j, t, x in e if t == c) for c in range(3)]
            want |= {(i, p, j) for p, (_, j) in enumerate(sorted((-s, j) for s, j in best), 1)}
        else:
            best = sorted((-score(v, x), j) for j, t, x in e if t == topic)[:10]
            want |= {(i, 11 - p, j) for p, (_, j) in enumerate(best, 1)}
    a, b = spark.createDataFrame(q, "q long, topic int, qv array<double>"), spark.createDataFrame(e, "e long, topic int, v array<double>")
    assert set(map(tuple, S.few_shot(a, b).collect())) == want
