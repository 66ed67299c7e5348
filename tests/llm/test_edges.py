"""Edge cases of the operators: repeated ids, clashing columns, empty tables, hot groups."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quern.llm import ann_forest, line_dedup, minhash_dedup
from quern.llm.chat_collapse import format_chats
from tests.llm.test_native_ops import py_chats

CLASH = "doc_id long, text string, source string, id string, _id int, _digest int, _keep int, _dropped int, _n int, _size int, _rd int, grp int"


def clashing(spark, rows):
    """(doc_id, text) with columns of the names that operators use themselves."""
    return spark.createDataFrame([(i, t, "a", "x", *range(8)) for i, t in rows], CLASH)


def test_lines_of_repeated_ids(spark):
    common = "this is the common line of three"
    rows = [(1, f"{common}\nshort"), (1, "keep me\nkeep me too"), (1, "keep me\nkeep me too"), (2, common), (3, common), (3, "other\n" + common), (None, common)]
    d = clashing(spark, rows)
    got = line_dedup.keep_lines(d, line_dedup.line_bitmaps(d))
    assert got.columns == [*d.columns, "_n_lines", "_n_dropped"]
    out = Counter((r.doc_id, r.text, r._n_lines, r._n_dropped) for r in got.collect())
    assert out == Counter([(1, "short", 2, 1), (1, "keep me\nkeep me too", 2, 0), (1, "keep me\nkeep me too", 2, 0), (2, "", 1, 1), (3, common, 1, 0), (3, "other\n" + common, 2, 0), (None, common, 1, 0)])


def test_lines_hot_and_sparse(spark):
    """A line that all documents hold, others that few hold, and words of the bitmap without a lost line."""
    hot, rng = "a line that is in every document", random.Random(3)
    few = [f"line number {k} that some documents hold" for k in range(60)]
    rows = [(i, "\n".join([f"own {i} {k} and nobody else's line" for k in range(rng.randrange(200))] + [hot] + rng.sample(few, 3))) for i in range(300)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    held, last = Counter(), {}
    for i, t in rows:
        for x in set(t.split("\n")):
            held[x] += 1
            last[x] = max(last.get(x, 0), i)
    got = {r.doc_id: r.text for r in line_dedup.keep_lines(d, line_dedup.line_bitmaps(d)).collect()}
    assert got == {i: "\n".join(x for x in t.split("\n") if held[x] < 3 or last[x] == i) for i, t in rows}


def test_lines_beyond_one_task(spark):
    """More postings than HEAVY, so that lines of both kinds take part."""
    rows = [(i, "\n".join(["a line that is in every document", f"line {i // 4} that four documents hold", *[f"own {i} {k} and nobody else's line" for k in range(20)]])) for i in range(1000)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r._n_dropped for r in line_dedup.keep_lines(d, line_dedup.line_bitmaps(d)).collect()}
    assert got == {i: (i != 999) + (i % 4 != 3) for i in range(1000)}


def test_near_duplicates_of_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (5, "some other text that stands alone"), (5, text + " x"), (5, text + " x"), (7, text + " x"), (None, text), (8, None), (9, text)]
    d = clashing(spark, rows)
    got = Counter((r.id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(d).collect())
    assert got == Counter([(1, 56, 1, True), (5, 2, 5, True), (5, 57, 1, False), (5, 57, 1, False), (7, 57, 1, False), (None, 56, None, True), (8, 0, 8, True), (9, 56, 1, False)])
    left = minhash_dedup.without_near_duplicates(d)
    assert left.columns == d.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([(1, text), (5, rows[1][1]), (None, text), (8, None)])


def test_one_of_rows_alike(spark):
    text = " ".join(f"w{i}" for i in range(60))
    d = clashing(spark, [(1, text)] * 5 + [(1, text + " x"), (2, None), (2, None)])
    left = [(r.doc_id, r.text) for r in minhash_dedup.without_near_duplicates(d).collect()]
    assert len([x for x in left if x[0] == 1]) == 1 and left.count((2, None)) == 2
    assert minhash_dedup.without_near_duplicates(d.limit(0)).count() == 0


def test_groups_behind_groups(spark):
    """Many small clusters around one passage: no bucket's first or central member links them."""
    rng = random.Random(8)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for c in range(60):
        own = base[:85] + [f"c{c}x{k}" for k in range(15)]
        for k in range(6):
            w = list(own)
            w[rng.randrange(100)] = f"y{c}z{k}"
            rows.append((len(rows), " ".join(w)))
    from tests.llm.test_queries import py_components

    d = spark.createDataFrame(rows, "doc_id long, text string")
    for hubs in (minhash_dedup.HUBS, 2):
        old, minhash_dedup.HUBS = minhash_dedup.HUBS, hubs
        got = {r.id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_duplicates(d).collect()}
        minhash_dedup.HUBS = old
        assert got == py_components(rows, 5, 80) and len({c for _, c in got.values()}) > 1


def test_long_and_repeated_conversations(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"t{k}") for k in range(3000)]
    rows += [(2, k, r, t) for _, k, r, t in rows[:1000]] + [(3, 0, "user", "t0"), (3, 0, "user", "t0")] + [(4, 0, "user", "t0"), (4, 1, "user", "t0")] + [(5, None, "user", "t0"), (5, 7, None, "")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"k": F.lit(1), "n": F.lit(2), "a": F.lit(3), "x": F.lit("y")})
    got = {r.conv_id: (r.n_turns, r.text) for r in format_chats(d).collect()}
    assert got == py_chats(rows) and set(got) == {1, 3, 5}


def found(spark, rows, is_query="true", **how):
    d = spark.createDataFrame([(i, None if v is None else [float(x) for x in v], 1, 2) for i, v in rows], "vec_id long, embedding array<double>, row int, leaf int")
    out = {}
    for r in ann_forest.nearest(d, is_query, **how).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def py_nearest(rows, queries, k=10):
    out = {}
    for q in queries:
        v = min(x for i, x in rows if i == q)
        got = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, x)))), i) for i, x in rows if i != q)[:k]
        out[q] = [(n + 1, i, s) for n, (s, i) in enumerate(got)]
    return {q: g for q, g in out.items() if g}


def alike(a, b):
    return a.keys() == b.keys() and all([x[:2] for x in a[q]] == [x[:2] for x in b[q]] and np.allclose([x[2] for x in a[q]], [x[2] for x in b[q]], atol=1e-9) for q in a)


def test_nearest_of_repeated_ids(spark):
    rows = [(1, (0, 1)), (1, (0, 2)), (2, (0, 1)), (3, (5, 5)), (3, (5, 5)), (4, (0, 1))]
    assert alike(found(spark, rows), py_nearest(rows, (1, 2, 3, 4)))
    assert found(spark, [(1, (1, 1))]) == {} and found(spark, [(1, (1, 1)), (1, (2, 2))]) == {}
    assert found(spark, [(1, (1, 1)), (2, (2, 2)), (None, (3, 3)), (5, ())], "id = 1") == {1: [(1, 2, 2**0.5)]}
    assert found(spark, [(1, None)]) == {}


def test_nearest_far_from_the_origin(spark):
    rng = np.random.default_rng(6)
    rows = [(i, tuple(1e5 + 1e-3 * rng.standard_normal(8))) for i in range(1500)]
    got, want = found(spark, rows, "id % 50 = 0", share=1.0), py_nearest(rows, range(0, 1500, 50))
    assert sum(len({i for _, i, _ in got[q]} & {i for _, i, _ in want[q]}) for q in want) >= 0.99 * 300
    assert all(abs(a[2] - b[2]) < 1e-9 for q in want for a, b in zip(got[q], want[q]))


def test_nearest_of_equal_vectors(spark):
    """A third of all vectors are equal: one leaf of each tree holds them; nearest of them are the smallest ids."""
    rng = np.random.default_rng(7)
    rows = [(i, tuple([1.0] * 4) if i % 3 == 0 else tuple(rng.standard_normal(4))) for i in range(3000)]
    got = found(spark, rows, "id % 300 = 0")
    assert len(got) == 10 and all([i for _, i, _ in g] == [i for i in range(0, 36, 3) if i != q][:10] and g[9][2] == 0 for q, g in got.items())


def test_more_short_queries_than_a_block(spark):
    """A share of one leaf leaves 5,000 queries with fewer than k; all are searched again."""
    rng = np.random.default_rng(9)
    rows = [(i, tuple(rng.standard_normal(4))) for i in range(5000)]
    got = found(spark, rows, share=1e-9, k=60)
    assert len(got) == 5000 and all(len(g) == 60 for g in got.values())


def test_features_of_runs_are_those_of_documents():
    """op9: a run inside a document has the neighbours that scoring sees."""
    import pyarrow as pa

    from quern.llm import quality_crf as Q

    texts = ["\n".join(f"line {i} of {k} words and " * (1 + i % 4) for i in range(k)) for k in (1, 3, 60, 200)]
    b = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array([1, 0, 1, 0], pa.int32()), pa.array(texts)], ["id", "y", "text"])
    for r in next(iter(Q._line_rows(iter([b]), 48))).to_pylist():
        raw = texts[r["id"] - 1].encode()
        f, _, doc = Q.line_features(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        whole = Q.with_neighbours(f, doc)
        own = np.array(r["f"]).reshape(-1, Q.N_OWN)
        run = Q.with_neighbours(own, np.zeros(len(own), int))[r["first"] : r["first"] + r["n"]]
        start = int(Q._run_starts(np.array([r["id"]]), np.array([len(f)]), 48)[0])
        assert r["n"] == min(48, len(f)) and np.allclose(run, whole[start : start + r["n"]], atol=1e-5)


def test_quality_of_repeated_and_odd_rows(spark):
    from quern.llm import quality_crf as Q

    rows = [(i, "Good sentences stand here, one by one.\nThey end well." if i % 2 else "$$ ## win win win\n!!! $$$ ##", "a") for i in range(40)] + [(1, "x $$", "a")] * 3 + [(None, "none", "b"), (77, None, "b")]
    d = spark.createDataFrame(rows, "doc_id long, text string, y string").withColumns({"first": F.lit(1), "f": F.lit(2), "score": F.lit("z")})
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(1, 1), (3, 0), (99, 1), (None, 1), (5, None)], "doc_id long, quality int")
    model = Q.fit(d, labels)
    got = Q.quality_scores(d, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got) and abs(model["share"] - 20 / 41) < 1e-9
    kept = Q.good_documents(d, model)
    assert kept.columns == d.columns and kept.where("doc_id = 7").count() == 1 and kept.where("doc_id = 8").count() == 0
    assert Q.quality_scores(d.limit(0), model).count() == 0 and Q.fit(d.limit(0), labels) == {"share": 0.5}


def bound_holds(n, k, p, level):
    from math import comb

    return sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)) <= level


def test_steps_are_those_of_the_exact_bound(spark):
    """op6: the step of every stratum against the joint verdict and a bound summed in plain Python."""
    from quern.llm import quality_rules as R

    rng = random.Random(12)
    rows = [(i, " ".join(["word" + str(rng.randrange(900)) for _ in range(40)] + ["#"] * rng.choice([0] * 60 + [1, 2, 5, 9]) + ["!"] * rng.choice([0] * 60 + [3, 30])), rng.choice(["a", "a", "b", None, None, "few"] if i % 9 else ["a"])) for i in range(2500)]
    rows = [(i, t, s if s != "few" or i < 40 else "a") for i, t, s in rows]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(2500)] + [(0, 1), (9999, 1), (3, None)], "doc_id long, quality int")
    risk, level = 0.04, 0.05
    m = R.measures(d).withColumn("base_failed", R.base_failed())
    got = {r.stratum: r.step for r in R.thresholds(m, labels, risk, level).collect()}
    values = {}
    for r in m.where("not base_failed").selectExpr("id", "stratum", *[f"cast({e} as double) as m{k}" for k, (_, e, _) in enumerate(R.RULES)]).collect():
        values.setdefault(r.stratum, []).extend([r[2:]] * (2 if r.id == 0 else 1))
    want = {}
    for s, v in values.items():
        for step in range(R.STEPS):
            k = sum(any(x > R.ladder(cuts)[step] for x, (_, _, cuts) in zip(row, R.RULES)) for row in v)
            if not bound_holds(len(v), k, risk, level / len(values)):
                break
            want[s] = step
    assert got == want and "few" in values and "few" not in want and len(want) == 3 and set(want.values()) != {R.STEPS - 1}
    for s in values:
        own = [r.kept for r in R.apply_rules(d, labels, risk=risk, level=level).where("not base_failed").collect() if r.stratum == s]
        assert sum(not x for x in own) <= risk * len(own)


def test_joint_false_rejection_stays_within_risk():
    """op6: steps learned on samples of a known population: how often the verdict's true rate is over the risk."""
    rng, over = np.random.default_rng(3), 0
    rates = [0.0012 * (s + 1) ** 1.5 for s in range(10)]
    for _ in range(300):
        n, u, held = 1500, None, 0.0
        u = rng.random(n)
        for p in rates:
            if not bound_holds(n, int((u < p).sum()), 0.02, 0.05):
                break
            held = p
        over += held > 0.02
    assert over <= 0.08 * 300


def test_rules_of_empty_and_repeated_rows(spark):
    from quern.llm import quality_rules as R

    text = " ".join(f"w{i}" for i in range(20))
    d = spark.createDataFrame([(1, text, None), (1, text, None), (None, text, "a"), (2, None, "a")], "doc_id long, text string, lang string").withColumns({"id": F.lit(1), "cuts": F.lit(2), "stratum": F.lit(3), "_s": F.lit(4)})
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None)], "doc_id long, quality int")
    assert Counter((r.id, r.kept) for r in R.apply_rules(d, labels).collect()) == Counter([(1, True), (1, True), (None, True), (2, False)])
    assert R.apply_rules(d.limit(0), labels).count() == 0


def masked_examples(rng, n):
    """(id, parts) of prompts and answers."""
    word = lambda k: " ".join(rng.choice(("the", "river", "Überzug", "x1", "#")) for _ in range(k))
    return [(i, [(word(rng.randrange(1, 160)), False), (word(rng.randrange(0, 60)), True)] * rng.choice((1, 1, 2))) for i in range(n)]


def test_packing_of_loss_bearing_tokens(spark):
    """op2: all three limits hold through the table operator; parts are encoded in order; the end token goes with the last."""
    from tokenizers import Tokenizer

    from quern.llm import packing
    from quern.llm.queries import tokenizer

    path = tokenizer("byte_bpe_50k.json")
    t, rng = Tokenizer.from_file(path), random.Random(2)
    made = masked_examples(rng, 400) + [(900, []), (901, None), (902, [(None, True), ("a", None)]), (None, [("b", True)]), (7, [("again", True)])]
    d = spark.createDataFrame(made, "id long, parts array<struct<text:string,loss:boolean>>").withColumns({"ids": F.lit(1), "start": F.lit(2)}).repartition(2)
    want = {}
    for i, parts in made:
        ids, mask = [], []
        for text, loss in parts or []:
            new = t.encode(text or "", add_special_tokens=False).ids
            ids, mask = ids + new, mask + [bool(loss)] * len(new)
        want.setdefault(i, []).append((ids + [1], mask + [bool(parts and parts[-1][1])]))
    got = packing.pack_examples(d, path, tokens=256, segments=6, loss=100).collect()
    seqs, docs = {}, Counter()
    for r in got:
        seqs.setdefault(r.sequence_id, []).append(r)
        docs[r.id] += r.length
    assert docs == {i: sum(len(x) for x, _ in v) for i, v in want.items()}
    some_loss = 0
    for v in seqs.values():
        bears = sum(sum(want[r.id][0][1][r.start : r.start + r.length]) for r in v if r.id != 7)
        some_loss += bears == 100
        assert sum(r.length for r in v) <= 256 and len(v) <= 6 and bears <= 100
    for i in range(7):
        own = sorted((r for r in got if r.id == i), key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == want[i][0][0]
    assert some_loss > 3


def test_packing_limits_of_plain_texts(spark):
    """op2: a loss limit without a mask bounds all tokens; empty tables, null ids and repeated rows."""
    from quern.llm import packing
    from quern.llm.queries import tokenizer

    d = clashing(spark, [(1, "a b c d e f g h i j k l m n o p")] * 3 + [(None, "x y z"), (4, None), (5, "")])
    got = packing.pack_documents(d, tokenizer("byte_bpe_50k.json"), loss=10).collect()
    n = Counter()
    for r in got:
        n[r.sequence_id] += r.length
    assert max(n.values()) <= 10 and sum(n.values()) == 3 * 17 + 4 + 2
    assert packing.pack_documents(d.limit(0), tokenizer("byte_bpe_50k.json")).count() == 0


def test_dot_product_is_not_the_longest_piece():
    """op2: with loss masks the largest inner product often is another piece than the longest that fits."""
    from quern.llm import packing

    rng, other, placed = random.Random(5), 0, 0

    class Watched(packing.Packer):
        def _place(self):
            nonlocal other, placed
            need = self.need[: len(self.items)]
            fits = (need <= self.room).all(axis=1)
            if fits.any():
                value = np.where(fits, need @ (self.room / (self.limit * self.limit)), -1.0)
                placed += 1
                other += need[int(np.argmax(value)), 0] < need[fits, 0].max()
            super()._place()

    p = Watched(tokens=512, segments=8, loss=200, waiting=64)
    for i in range(600):
        n = rng.randrange(10, 300)
        p.add(i, np.arange(n), (np.arange(n) >= n * rng.random()).astype(int))
    p.finish()
    assert placed > 300 and other > 0.1 * placed


def test_packing_of_conversations(spark):
    from quern.llm import packing
    from quern.llm.queries import tokenizer

    rows = [(c, k, "user" if k % 2 == 0 else "assistant", f"words of turn {k} in {c}") for c in range(50) for k in range(6)] + [(99, 0, None, None)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = packing.pack_conversations(d, tokenizer("byte_bpe_50k.json"), tokens=512, loss=128).collect()
    assert {r.id for r in got} == {*range(50), 99} and max(r.length for r in got) <= 512
