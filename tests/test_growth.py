"""Steps that grew faster than their input: results as by plain Python, and plans or memory that don't grow with pairs."""

import math

import pytest
from pyspark.sql import functions as F


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def in_order(a, b):
    s = 0.0
    for x, y in zip(a, b):
        s += x * y
    return s


@pytest.fixture(scope="module")
def vectors(spark):
    """Few different numbers, so scores tie, and their sums depend on the order."""
    v = {i: [((i * i + 7 * j) % 5 - 2) * 0.1 + (1e8 if (i + j) % 11 == 0 else 0.0) - (1e8 if (i + j) % 13 == 0 else 0.0) for j in range(6)] for i in range(700)}
    return v, spark.createDataFrame(list(v.items()), "vec_id long, embedding array<double>").repartition(3)


def test_inner_products_are_sums_in_order(vectors):
    from quern.operators.vector import top_inner_products

    v, e = vectors
    got = top_inner_products(e.where("vec_id % 5 = 0"), e, 7, block=50)
    want = {(q, r + 1, i) for q in v if q % 5 == 0 for r, i in enumerate(sorted(v, key=lambda i: (-in_order(v[q], v[i]), i))[:7])}
    assert {(r.query_id, r.rank, r.vec_id) for r in got.collect()} == want
    assert all(r.score == in_order(v[r.query_id], v[r.vec_id]) for r in got.collect())
    assert "NestedLoop" not in plan(got)  # no row for each pair


def test_inner_products_of_odd_vectors(spark):
    from quern.operators.vector import top_inner_products

    odd = [(0, [1.0, 2.0]), (1, [math.nan, 1.0]), (2, [None, 1.0]), (3, None), (4, [1.0]), (5, [math.inf, 1.0]), (6, [1.0, 2.0]), (7, [])]
    e = spark.createDataFrame(odd, "vec_id long, embedding array<float>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in top_inner_products(e.where("vec_id in (0, 7)"), e, 9).collect()}
    assert [got.pop((0, k))[0] for k in range(1, 6)] == [1, 5, 0, 6, 2] and got == {(7, 1): (7, 0.0)}
    assert top_inner_products(e.where("vec_id < 0"), e, 9).isEmpty()


ODD_TEXTS = ["", None, "abcd", "abcde", "abcdef", "aaaaaaaaaa", "x😀y😀z😀x😀y", "é€ü" * 9, "the cat sat on the mat, the cat sat on the mat"]


def windows(x):
    x = x or ""
    return {x[i : i + 5] for i in range(len(x) - 5)}


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string").repartition(2)


def test_signatures_are_over_whole_characters(odd):
    import hashlib

    from quern.operators.dedup import PRIME, permutations, signatures

    h = {i: [int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in windows(x)] for i, x in enumerate(ODD_TEXTS)}
    want = {i: [min((a * v + b) % PRIME for v in x) for a, b in permutations(100)] for i, x in h.items() if x}
    got = signatures(odd)
    assert {r.id: list(r.sig) for r in got.collect()} == want
    assert "regexp" not in plan(got) and "md5" not in plan(got)  # neither for each shingle of each document


def test_shingles_beyond_an_alphabet_of_one_number():
    import hashlib

    from quern.operators.shingles import Shingled, hashes, shared

    long = "".join(map(chr, range(0x4E00, 0x4E00 + 7000))) + "😀abc" * 3
    texts = [long, "", long[:40], long[20:90] + "é"]
    s = Shingled(texts)
    rows, place, ends = s.told()
    names = ["".join(map(chr, r)) for r in rows]
    assert names == sorted(set(names)) and hashes(rows).tolist() == [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in names]
    assert [set(names[i] for i in place[e - len(x) : e]) for x, e in zip(s.sets, ends)] == [windows(x) for x in texts]
    assert shared(s.sets[0], s.sets[3]) == len(windows(texts[0]) & windows(texts[3])) == 66


def test_tokens_of_pieces_are_the_library_s():
    import random

    import public_tokenizers

    from quern.operators.tokenizer import loaded

    rng, k = random.Random(5), loaded(public_tokenizers.path("byte_bpe_50k.json"))
    letters = [*"ab'sStrRveELld  \t\n\r\x0b\x0c019_.-<|>!?éÀ×÷ÿß", "'ll", "'re", "  ", "<|endoftext|>", "\x1c", "²", "\xa0", "😀", "中"]
    texts = ["".join(rng.choices(letters[: rng.choice([-7, 99])], k=rng.randrange(60))) for _ in range(5_000)]
    want = [e.ids for e in k.t.encode_batch(texts, add_special_tokens=False)]
    assert k.encode(texts) == want
    asked, model, k.young, k.old = [], k.model, {}, {}
    k.model = type("Counted", (), {"tokenize": lambda self, x: asked.append(x) or model.tokenize(x)})()
    try:
        assert k.encode(["abs  sab é"] * 1_000) == [k.t.encode("abs  sab é", add_special_tokens=False).ids] * 1_000
        assert len(asked) == len(set(asked)) == 4  # the model sees a piece once
    finally:
        k.model = model
    ids = [rng.choices(range(50_300), k=rng.randrange(20)) for _ in range(5_000)]
    assert k.decode(ids) == k.t.decode_batch(ids, skip_special_tokens=False)


def test_language_is_told_from_words_named_once(spark):
    from quern.functions.text import words
    from quern.operators.samples import detected_language

    texts = ["The cat and the dog", "le chat et la", "der Hund und die", "el gato y los", "", None, "xyz", "la"]
    d = spark.createDataFrame(list(enumerate(texts)), "i long, t string").repartition(2).select("i", detected_language(words(F.col("t"))).alias("found"))
    assert [r.found for r in d.orderBy("i").collect()] == ["en", "fr", "de", "es", None, None, None, "es"]
    assert plan(d).count("regexp_extract_all") == 1


def test_rows_are_made_in_small_parts(spark):
    import pyarrow as pa

    from quern.operators.arrow import PART, parts
    from quern.operators.samples import per_row

    b = pa.RecordBatch.from_pydict({"i": list(range(300)), "k": [["word"] * (50 * i) for i in range(300)]})
    cut = list(parts(b))
    assert sum(x.num_rows for x in cut) == 300 and len(cut) > 9 and all(x.nbytes <= PART or x.num_rows == 1 for x in cut)
    got = per_row(spark.range(5).selectExpr("id", "array_repeat('a', int(id)) as k"), lambda r: [(r.id, x) for x in r.k], "id long, w string")
    assert sorted(map(tuple, got.collect())) == [(i, "a") for i in range(5) for _ in range(i)]


def test_image_words_of_any_bytes(spark):
    from quern.sources.pairs import image_words

    raw = [b"", None, b"\x01", b"\xff\xff\xff\xff\x01\x00\x00\x80", bytes(range(256)) * 40 + b"abc"]
    d = spark.createDataFrame(list(enumerate(raw)), "i long, b binary").select("i", image_words(F.col("b")).alias("w"))
    got = {r.i: r.w for r in d.collect()}
    word = lambda x: [-len(x) % 4, *(int.from_bytes((x + b"\0" * 3)[k : k + 4], "little", signed=True) for k in range(0, len(x), 4))]
    assert got == {i: None if x is None else word(x) for i, x in enumerate(raw)} and "regexp" not in plan(d)


def test_few_shot_of_many_topics(spark, vectors):
    from quern.operators.samples import few_shot

    v, e = vectors
    topic = lambda i: i % 3 if i < 400 else i  # three large topics, and 300 of one example
    ex = e.selectExpr("vec_id as e", "if(vec_id < 400, vec_id % 3, vec_id) as topic", "embedding as v")
    qs = e.where("vec_id % 9 = 0").selectExpr("vec_id as q", "if(vec_id % 2 = 0, -1, if(vec_id < 400, vec_id % 3, vec_id)) as topic", "embedding as qv")
    want = set()
    for q in range(0, 700, 9):
        s = {i: in_order(v[q], v[i]) for i in v if i != q}
        if q % 2:
            best = sorted((i for i in s if topic(i) == topic(q)), key=lambda i: (-s[i], i))[:4]
            want |= {(q, 4 - r, i) for r, i in enumerate(best)}
        else:
            best = {}
            for i in sorted(s, key=lambda i: (-s[i], i)):
                best.setdefault(topic(i), i)
            want |= {(q, r + 1, i) for r, i in enumerate(sorted(best.values(), key=lambda i: (s[i], i))[:4])}
    got = few_shot(qs, ex, k=4, block=30, apart=True)
    assert set(map(tuple, got.collect())) == want and "NestedLoop" not in plan(got)
