"""The registered queries with SQL, and the others against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import ann_forest, license_scan, minhash_dedup, packing, quality_crf, token_counts
from quern.llm.queries import NOT_HELD_OUT, ORACLES, QUERIES, tokenizer
from quern.session import table
from tests.test_oracles import duck, rows  # noqa: F401

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, sf, duck, name):  # noqa: F811
    df = QUERIES[name](spark, sf)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLES[name])
    assert got == rows([d[0] for d in cur.description], cur.fetchall())


def near_docs(n=40):
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(160)]
    out = [(0, None), (1, ""), (2, " \n"), (3, "One two"), (4, "one TWO"), (5, "one two three"), (None, " ".join(base))]
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append((100 + i, " ".join(w).upper() if i % 3 else "\t".join(w)))
    out += [(300 + i, " ".join(base[40:120] + [f"y{i}z{k}" for k in range(60)])) for i in range(30)]
    out += [(400 + i, "same text five words long here") for i in range(30)] + [(400, "same text five words long here")]
    return out


def py_components(docs, words, percent):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    sets = {}
    for i, t in docs:
        w = WORDS.findall(lower(t))
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    ids = sorted(i for i in sets if i is not None)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(spark, words):
    docs = near_docs()
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n int")
    got = minhash_dedup.near_duplicates(df, words=words).collect()
    assert len(got) == len(docs)
    want = py_components(docs, words, 80)
    assert {r.id: (r.n_shingles, r.component_id) for r in got if r.id is not None} == want
    assert all(r.kept == (r.id is None or r.component_id == r.id) for r in got)
    assert minhash_dedup.near_duplicates(df.limit(0)).count() == 0


def test_sketch_fills_every_coordinate():
    rng = np.random.default_rng(0)
    s = np.unique(rng.integers(0, 2**63, 700, dtype=np.uint64))
    a, b = s[:600], np.concatenate([s[:500], s[600:]])
    both = minhash_dedup.sketch(np.concatenate([a, b, s[:1]]), np.array([0, 600, 1200, 1201]), 128)
    assert (both != np.iinfo(np.uint64).max).all()
    assert abs((both[0] == both[1]).mean() - 500 / 700) < 0.15


def odd_texts():
    rng = random.Random(7)
    letters = list("abzRSTdlvem'  \n\t 019.,!$<|>é×ÉÀß") + ["'s", "'re", "'LL", "’", "<|endoftext|>", "<|startoftext|>", "\x1c", "\xa0", "İ", "ﬁ", "日本"]
    made = ["".join(rng.choice(letters[:-9] if rng.random() < 0.8 else letters) for _ in range(rng.randrange(60))) for _ in range(800)]
    return [None, "", "\n\n", "  a", "a  ", "a \n b", "\n\n b", "word " * 30000, "x" * 50000, *made]


def test_token_counts(spark, sf):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    df = spark.createDataFrame(list(enumerate(odd_texts())), "doc_id long, text string").union(table(spark, sf, "documents").select(F.col("doc_id") + 10000, "text"))
    got = {r.id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(df, path).collect()}
    for r in df.collect():
        n = len(t.encode(r.text or "", add_special_tokens=False).ids)
        assert got[r.doc_id] == (len((r.text or "").encode()), n, n > 2048)


def test_packing(spark, sf):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    df = spark.createDataFrame(list(enumerate(odd_texts())), "doc_id long, text string").union(table(spark, sf, "documents").select(F.col("doc_id") + 10000, "text")).repartition(3, "doc_id")
    got = packing.pack_documents(df, path).collect()
    docs, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        docs[r.id].append(r)
        seqs[r.sequence_id].append(r)
        assert r.length == len(r.ids) > 0 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for r in df.collect():
        want = [*t.encode(r.text or "", add_special_tokens=False).ids, 1]
        own = sorted(docs[r.doc_id], key=lambda x: x.start)
        assert [i for p in own for i in p.ids] == want
        assert all(p.doc_tokens == len(want) for p in own) and [p.start for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
    padding = 0
    for pieces in seqs.values():
        pieces.sort(key=lambda x: x.offset)
        assert [p.offset for p in pieces] == np.cumsum([0, *[p.length for p in pieces]])[:-1].tolist()
        n = sum(p.length for p in pieces)
        assert n <= 2048 and len(pieces) <= 256
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    assert padding <= 0.01 * sum(r.length for r in got)


def test_packing_limits():
    rng = random.Random(1)
    p = packing.Packer(tokens=100, segments=4, loss=60, waiting=16)
    size = {}
    for i in range(200):
        n = rng.randrange(1, 90)
        mask = np.array([rng.random() < 0.6 for _ in range(n)], int)
        size[i] = mask
        p.add(i, np.arange(n), mask)
    p.finish()
    seqs, seen = defaultdict(list), Counter()
    for doc, start, ids, total, seq, _ in p.out:
        seqs[seq].append((doc, start, len(ids)))
        seen[doc] += len(ids)
        assert total == len(size[doc])
    assert all(seen[i] == len(m) for i, m in size.items())
    for v in seqs.values():
        assert sum(n for _, _, n in v) <= 100 and len(v) <= 4 and sum(size[d][s : s + n].sum() for d, s, n in v) <= 60


def test_nearest(spark, sf):
    e = table(spark, sf, "embeddings")
    odd = spark.createDataFrame([(90000, None, 1), (90100, [0.0] * 64, 1), (90200, [1.0, None] + [0.0] * 62, 1), (90300, [float("nan")] * 64, 1), (90400, [1.0], 1), (90500, [0.5] * 64, 1), (90501, [0.5] * 64, 1), (90502, [0.5] * 64, 1)], e.schema)
    rows_ = e.union(odd).collect()
    got = defaultdict(list)
    for r in ann_forest.nearest(e.union(odd), "id % 100 = 0").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    ok = [r for r in rows_ if r.embedding is not None and len(r.embedding) == 64 and all(v is not None and np.isfinite(v) for v in r.embedding) and any(r.embedding)]
    x, ids = np.array([r.embedding for r in ok], float), np.array([r.vec_id for r in ok])
    assert set(got) == {i for i in ids if i % 100 == 0} and 90500 in got
    hit = 0
    for q, g in got.items():
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        d[ids == q] = np.inf
        best = np.lexsort((ids, d))[:10]
        hit += len(set(ids[best]) & {v for _, v, _ in g})
        assert [r for r, _, _ in sorted(g)] == list(range(1, 11)) and all(abs(d[ids == v][0] - s) < 1e-9 for _, v, s in g)
    assert hit >= 9 * len(got)
    assert [v for _, v, _ in sorted(got[90500])][:2] == [90501, 90502]
    few = ann_forest.nearest(e.limit(0).union(odd), "id = 90500").collect()
    assert sorted((r.rank, r.vec_id) for r in few) == [(1, 90501), (2, 90502)]
    assert ann_forest.nearest(e.limit(0), "true").count() == 0


def test_forest_recall():
    """The share that is measured gives its recall, and is small where vectors lie in clusters."""
    rng = np.random.default_rng(2)
    flat = rng.standard_normal((6000, 32))
    centres = 5 * rng.standard_normal((60, 32))
    shares = []
    for x in (flat, centres[rng.integers(0, 60, 6000)] + rng.standard_normal((6000, 32))):
        f = ann_forest.Forest(x, 8, 1)
        q, leaf, hit, seen_rows = x[:50], f.leaves(x), 0, 0
        for i in range(50):
            d = ((x - q[i]) ** 2).sum(axis=1)
            d[i] = np.inf
            seen = set(f.visited(q[i], f.share))
            best = np.argsort(d)[:10]
            hit += sum(any((t, leaf[b, t]) in seen for t in range(8)) for b in best)
            seen_rows += np.any([np.isin(leaf[:, t], [v for u, v in seen if u == t]) for t in range(8)], axis=0).sum()
        assert hit >= 0.9 * 500
        shares.append(seen_rows / 50 / 6000)
    assert shares[0] < 0.9 and shares[1] < 0.1


def test_queue_order():
    """One queue over all trees pops leaves by the largest distance to a plane on their path."""
    x = np.random.default_rng(4).standard_normal((3000, 8))
    f = ann_forest.Forest(x, 3, 1)
    q = x[0] - f.middle
    far = {}
    for t in range(3):
        for leaf in range(1 << f.depth):
            node, out = leaf + (1 << f.depth), 0.0
            while node > 1:
                m = q @ f.w[t, node // 2] - f.b[t, node // 2]
                if (m >= 0) != node % 2:
                    out = max(out, abs(m))
                node //= 2
            far[t, leaf] = out
    got = list(f._popped(q))
    assert sorted(got) == sorted(far) and np.allclose([far[x] for x in got], sorted(far.values()))


def test_quality(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality_crf.fit(docs, labels, where=NOT_HELD_OUT)
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, " \n"), (-4, "word\n" * 20000)], "doc_id long, text string")
    got = {r.id: r.score for r in quality_crf.quality_scores(docs.select("doc_id", "text").union(odd), model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[-1] == got[-2] == got[-3] == model["share"]
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    right = sum((s >= 0.7) == (y == 1) for s, y in held)
    assert right >= 0.9 * len(held)
    assert quality_crf.fit(docs, labels.limit(0)) == {"share": 0.5}
    kept = quality_crf.good_documents(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect() if got[r.doc_id] >= 0.7}


def test_marginals():
    """Forward-backward against the sum over all labellings."""
    rng = np.random.default_rng(5)
    doc = np.array([0, 0, 0, 1, 2, 2])
    u, t = rng.standard_normal(6), rng.standard_normal((2, 2))
    p, _, z = quality_crf.Chains(doc).marginals(u, t)
    want, total = np.zeros(6), 0.0
    for bits in range(64):
        y = [(bits >> i) & 1 for i in range(6)]
        s = sum(u[i] * y[i] for i in range(6)) + sum(t[y[i - 1], y[i]] for i in range(1, 6) if doc[i] == doc[i - 1])
        want += np.exp(s) * np.array(y)
        total += np.exp(s)
    assert np.allclose(p, want / total) and np.isclose(z, np.log(total))


def test_licenses(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    base = docs.limit(30).collect()
    lines = [("Released under the MIT License.", "MIT"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("This work is licensed under the GNU General Public License, version 3.", "GPL"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC")]
    planted = [(1000 + i, f"{b.text}\n{lines[i % 4][0]}") for i, b in enumerate(base)] + [(2000, None), (2001, "")]
    model = license_scan.fit(docs)
    got = {r.id: r.licenses for r in license_scan.license_scan(spark.createDataFrame(planted, "doc_id long, text string"), model).collect()}
    assert got[2000] is None and got[2001] is None
    assert sum(lines[i % 4][1] in (got[1000 + i] or "") for i in range(30)) >= 29
    marked = re.compile("|".join(re.escape(x) for x, _ in lines))
    clean = [r.doc_id for r in docs.collect() if not marked.search(r.text)]
    found = {r.id: r.licenses for r in license_scan.license_scan(docs, model).collect()}
    assert sum(found[i] is not None for i in clean) <= 0.01 * len(clean)
