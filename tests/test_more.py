"""Operators and sources whose results SQL can't express, and hand-made rows for others."""

import io
import os
import random
import struct
import tarfile
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.functions import url as U
from quern.operators import blend as B
from quern.operators import decontam as C
from quern.operators import formats as R
from quern.operators import media as M
from quern.operators import packing as K
from quern.operators import samples as S
from quern.operators import vector as V
from quern.operators.dedup import buckets, duplicate_edges, signatures
from quern.operators.tasks import load_tasks, task_texts
from quern.operators.tokenizer import Tokenizer
from quern.plans import registry
from quern.sources import blocks, files, indexed, pairs, shards, stores


def test_urls(spark):
    """F1, F2, F4, F5 on hand-made urls."""
    rows = [
        ("http://www.reddit.com/r/x", "reddit", True, False, False), ("https://i.imgur.com/a.png?x=1", "imgur", True, True, False), ("http://news.bbc.co.uk/a", "bbc", False, False, False),
        ("http://amazon.co.jp/x.7z", "amazon", True, False, False), ("http://a.com/x.7z.ai", "a", False, True, False), ("http://a.com/x.png#f", "a", False, False, False), ("http://a.com/X.TAR.GZ", "a", False, True, False),
        ("http://shop.example.com.au", "example", False, False, False), ("http://exa mple.com", "exa mple", False, False, True), ("ftp://a.com/x", "a", False, False, True), ("http://localhost/x", "", False, False, True), ("http://10.0.0.1:80/x", None, False, False, False),
    ]
    d = spark.createDataFrame([(x[0],) for x in rows], "url string")
    c = F.col("url")
    got = {r.url: r for r in d.select("url", U.registered_name(c).alias("name"), U.domain_blocked(c).alias("d"), U.extension_blocked(c).alias("e"), U.malformed(c).alias("m")).collect()}
    for url, name, domain, ending, odd in rows:
        r = got[url]
        assert (name is None or r.name == name) and (r.d, r.e, r.m) == (domain, ending, odd), r
    assert len(U.BLOCKED_NAMES) == len(set(U.BLOCKED_NAMES)) == 111


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_tokenizer(spark, name):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    t = Tokenizer(spark, public_tokenizers.path(name))
    d = spark.createDataFrame([(0, "The river runs past."), (1, "Überall Häuser"), (2, ""), (3, None)], "i long, text string")
    r = {x.i: x for x in d.select("i", t.tokenize(F.col("text")).alias("ids"), t.offsets(F.col("text")).alias("at"), t.detokenize(t.tokenize(F.col("text"))).alias("back")).collect()}
    assert r[0].back.strip() == "The river runs past." and r[1].back.strip() == "Überall Häuser" and r[2].ids == r[3].ids == []
    assert len(r[0].at) == len(r[0].ids) and r[0].at == sorted(r[0].at) and r[0].at[0] == 0
    v = t.vocab()
    assert v.count() == t.size and v.select("token").distinct().count() == t.size and t.eod in (50256, 2) and t.special


def test_formats_and_templates(spark):
    config = '{"a": {"format": "alpaca", "columns": {"prompt": "instruction", "query": "input", "response": "output"}}}'
    f = R.formats(config)
    d = spark.createDataFrame([(1, "do", "this", "done"), (2, "do", "", "x")], "id long, instruction string, input string, output string")
    got = {r.id: (r.prompt[0].content, r.response[0].content, r.d_len) for r in R.unified(d, f["a"], "id").collect()}
    assert got == {1: ("do\nthis", "done", 10), 2: ("do", "x", 3)}
    with pytest.raises(ValueError):
        R.formats('{"a": {"format": "other", "columns": {}}}')
    assert len(R.TEMPLATES) == 14
    m = spark.createDataFrame([([("system", "S"), ("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")],)], "m array<struct<role:string,content:string>>")
    turns = lambda k: m.select(R.rendered_turns(F.col("m"), k)).first()[0]
    assert turns("default") == ["S\nHuman: a\nAssistant:", "b</s>", "\nHuman: c\nAssistant:", "d</s>"]
    assert turns("llama2") == ["<s>[INST] <<SYS>>\nS\n<</SYS>>\n\na [/INST]", "b</s>", "<s>[INST] c [/INST]", "d</s>"]
    assert turns("empty") == ["Sa", "b", "c", "d"]
    with pytest.raises(ValueError):
        R.register("qwen", R.Template())


def test_tasks_and_dictionary(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"text": "' + " ".join(f"w{i}" for i in range(14)) + '"}\n{"text": "one two"}\n')
    (tmp_path / "c.jsonl").write_text('{"questions": ["' + " ".join(f"q{i}" for i in range(9)) + '", "short one"]}\n')
    got = load_tasks(spark, {"lambada": str(tmp_path / "l.jsonl"), "coqa": str(tmp_path / "c.jsonl")})
    assert Counter(r.task for r in got.collect()) == {"lambada": 2, "coqa": 2}
    d = C.ngram_dictionary(got)
    C.save_dictionary(d, str(tmp_path / "d"))
    assert sorted(map(tuple, C.load_dictionary(spark, str(tmp_path / "d")).collect())) == sorted(map(tuple, d.collect())) and d.count() == 3
    with pytest.raises(ValueError):
        task_texts(got, "other")


def test_pair_ingest(spark, tmp_path):
    """IO20: one image of every length modulo 4, texts shorter and longer than the length, and a round trip through a store."""
    raw = {f"k{i}": bytes(range(1, 10 + i)) for i in range(4)} | {"k9": b""}
    ids = {f"k{i}": list(range(i * 3)) for i in range(4)} | {"k9": [7] * 20}
    t = spark.createDataFrame([(k, v) for k, v in ids.items()], "key string, ids array<int>")
    m = spark.createDataFrame([(k, bytearray(v)) for k, v in raw.items()] + [("alone", bytearray(b"x"))], "key string, content binary")
    got = pairs.ingest(t, m, length=8, eod=99)
    want = []
    for n, k in enumerate(sorted(raw)):
        x = ids[k][:8] + [99] * (8 - len(ids[k][:8])) if ids[k] else []
        pad = -len(raw[k]) % 4
        want += [(n, 2 * n, 0, x), (n, 2 * n + 1, 1, [pad, *np.frombuffer(raw[k] + bytes(pad), "<i4").tolist()])]
    assert sorted((r.doc_id, r.seq_no, r.mode, r.tokens) for r in got.collect()) == want
    indexed.write(got, str(tmp_path / "p"), modes=True)
    indexed.register(spark)
    back = spark.read.format("indexed_tokens").option("ranges", 3).load(str(tmp_path / "p"))
    assert sorted((r.doc_id, r.seq_no, r.mode, r.tokens) for r in back.collect()) == want
    big = m.select(pairs.image_words(F.unhex(F.lit("FFFFFFFF01000080"))).alias("w")).first().w
    assert big == [0, -1, -2147483647]


def test_written_store_is_that_of_one_writer(spark, tmp_path):
    """IO10: files that tasks write side by side, against the bytes of a plain writer."""
    rng = random.Random(1)
    rows = [(doc, 10 * doc + k, [rng.randrange(60000) for _ in range(rng.randrange(30))]) for doc in range(40) for k in range(rng.randrange(1, 5))]
    df = spark.createDataFrame(rows, "doc_id long, seq_no long, tokens array<long>").repartition(5)
    indexed.write(df, str(tmp_path / "x"), indexed.dtype_code(60000))
    lengths = [len(t) for _, _, t in rows]
    ends = [0, *[max(i for i, r in enumerate(rows) if r[0] == doc) + 1 for doc in range(40)]]
    data = b"".join(np.asarray(t, np.uint16).tobytes() for _, _, t in rows)
    index = b"MMIDIDX\x00\x00" + struct.pack("<QBQQ", 1, 8, len(rows), len(ends)) + np.asarray(lengths, np.int32).tobytes() + (np.concatenate([[0], np.cumsum(lengths)[:-1]]) * 2).astype(np.int64).tobytes() + np.asarray(ends, np.int64).tobytes()
    assert (tmp_path / "x.bin").read_bytes() == data and (tmp_path / "x.idx").read_bytes() == index
    indexed.write(df.limit(0), str(tmp_path / "e"))
    indexed.register(spark)
    assert spark.read.format("indexed_tokens").load(str(tmp_path / "e")).count() == 0


def test_shards_on_disk(spark, tmp_path):
    """IO15, IO16, IO19: streamed tars, their progress, final names and a look into one."""
    d = spark.range(30).selectExpr("format_string('%03d-%03d', id div 12, (id div 5) % 2) as shard", "format_string('%04d', id) as key", "map('json', encode(concat('{\"n\":', id, '}'), 'UTF-8'), 'img0.jpg', encode(repeat('x', 9), 'UTF-8')) as members")
    for _ in range(2):  # a second run leaves the same
        got = {os.path.basename(r.path): (r.n, r.bytes) for r in shards.write_shards(d, str(tmp_path), "s").collect()}
        assert sum(n for n, _ in got.values()) == 30 and sorted(got) == sorted(x for x in os.listdir(tmp_path) if x.endswith(".tar"))
    tars = spark.read.format("binaryFile").load(f"{tmp_path}/*.tar")
    members = shards.tar_members(tars)
    assert {r.chunk: r.n for r in shards.progress(members, "s").collect()} == {0: 12, 1: 12, 2: 6}
    keys = shards.sample_keys(members).collect()
    assert len(keys) == 30 and all(r.extensions == ["img0.jpg", "json"] for r in keys)
    r = next(x for x in keys if x.key == "0007")
    assert shards.sample_of(members, r.path, "0007")["json"] == b'{"n":7}'
    at = shards.tar_places(tars).where("member = '0007.json'").first()
    with open(at.path.removeprefix("file:"), "rb") as f:
        f.seek(at.at)
        assert f.read(at.size) == b'{"n":7}'
    names = shards.finalized(str(tmp_path), "s")
    assert names == [f"s-{k:06d}.tar" for k in range(len(got))] and shards.finalized(str(tmp_path), "s") == []
    assert sum(len(tarfile.open(f"{tmp_path}/{x}").getnames()) for x in names) == 60
    assert shards.chunk_numbers("0-3, 7,,2", 5) == [0, 1, 2, 3] and shards.chunk_numbers("7", 9) == [7]
    one = spark.range(1).select(shards.caption_turns(F.lit("a cat"), F.lit("what?")).alias("m"), shards.packed_payload(F.array(F.lit("p")), F.array(F.lit("c")), F.array(F.array(F.lit("i.jpg")))).alias("p")).first()
    assert one.m[0].content == "<image>\nwhat?" and '"sample_count":1' in one.p


def test_blocks_go_on_where_they_stopped(spark, tmp_path):
    """V7."""
    df = spark.range(25).selectExpr("id as ord", "id * 2 as v")
    made = blocks.run_blocks(df, str(tmp_path), 10, lambda x: x.withColumn("w", F.col("v") + 1))
    assert made == ["000-010", "010-020", "020-025"] and blocks.run_blocks(df, str(tmp_path), 10, lambda x: x) == []
    os.remove(tmp_path / "010-020" / "_SUCCESS")
    assert blocks.run_blocks(df, str(tmp_path), 10, lambda x: x.withColumn("w", F.col("v") + 1), valid=lambda x: x.count() > 6) == ["010-020", "020-025"]
    assert blocks.blocks(spark, str(tmp_path)).agg(F.sum("w")).first()[0] == sum(2 * i + 1 for i in range(25))
    todo = blocks.block_ranges(50, 10)
    assert [len(x) for x in blocks.dealt_to(todo, 2)] == [3, 3] and blocks.dealt_to(todo, 2)[1][-1] is None


def test_stores(spark, tmp_path):
    """IO12."""
    assert stores.split_path("s3://b/k/x.idx") == ("b", "k/x.idx") and stores.is_object_path("s3a://b") and not stores.is_object_path("/a/b")
    with pytest.raises(ValueError):
        stores.split_path("/a/b")
    (tmp_path / "a.bin").write_bytes(b"123")
    assert stores.exists(spark, str(tmp_path / "a.bin")) and not stores.exists(spark, str(tmp_path / "no"))
    got = stores.fetched(spark, f"file:{tmp_path}/a.bin", str(tmp_path / "copy"))
    assert open(got, "rb").read() == b"123" and stores.fetched(spark, f"file:{tmp_path}/a.bin", str(tmp_path / "copy")) == got


def png(pixels: bytes, w: int, h: int) -> bytes:
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    rows = b"".join(b"\x00" + pixels[i * w : i * w + w] for i in range(h))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def test_images(spark, tmp_path):
    """F17, X13."""
    good, black = png(b"\x00\x01" * 8, 4, 4), png(bytes(16), 4, 4)
    cases = [(good, True), (black, False), (good[:-20], False), (b"", False), (None, False), (b"hello", False), (b"\xff\xd8\xff\xe0 x \xff\xd9", True), (b"\xff\xd8\xff\xe0 cut", False), (b"GIF89a..", True)]
    assert [M.image_fine(x) for x, _ in cases] == [y for _, y in cases]
    d = spark.createDataFrame([("a/x.png", bytearray(good), "x.png"), ("b/x.png", bytearray(black), "x_1.png")], "path string, content binary, unique_name string")
    assert d.select(M.image_ok(F.col("content")).alias("ok")).collect() == [(True,), (False,)]
    got = M.copied(d, str(tmp_path / "m")).collect()
    assert {os.path.basename(r.target): r.n_bytes for r in got} == {"x.png": len(good), "x_1.png": len(black)} and (tmp_path / "m" / "x.png").read_bytes() == good


def test_questions(spark):
    """X9."""
    d = spark.createDataFrame([("who", """['a', "b's", 'c\\'d', 'e, f']"""), ("none", "[]")], "c0 string, c1 string")
    assert {r.question: r.answers for r in files.questions(d).collect()} == {"who": ["a", "b's", "c'd", "e, f"], "none": []}
    j = spark.createDataFrame([("Why?", ["x"], [("p",), ("q",)], [("h",)], [])], "question string, answers array<string>, positive_ctxs array<struct<text:string>>, hard_negative_ctxs array<struct<text:string>>, negative_ctxs array<struct<text:string>>")
    r = files.retrieval_samples(j).first()
    assert (r.question, r.positive.text, len(r.hard_negatives), r.negatives) == ("Why", "p", 1, [])


@pytest.mark.parametrize("strategy, value", [("auto", None), ("custom_half", None), ("specified_keys", [700, 512]), ("size_range", (300, 800)), ("top_n", 5), ("capacity_ratio", 0.4)])
def test_hash_buckets(strategy, value):
    """K9: every sample in one box, none over its capacity, the first boxes full."""
    rng = random.Random(3)
    sizes = [rng.choice((64, 128, 256, 512)) for _ in range(200)] + [rng.randrange(1, 1000) for _ in range(300)] + [0, 1025, 70000]
    got = K.hash_buckets(sizes, 1024, 40, strategy, value)
    assert [i for i, b in enumerate(got) if b < 0] == [500, 501, 502]
    use, count = Counter(), Counter()
    for s, b in zip(sizes, got):
        if b >= 0:
            use[b] += s
            count[b] += 1
    assert sorted(use) == list(range(len(use))) and max(use.values()) <= 1024 and max(count.values()) <= 40
    assert all(use[b] == 1024 for b in range(10)) and sum(use.values()) >= 0.9 * 1024 * len(use)
    with pytest.raises(ValueError):
        K.hash_buckets([5], 10, strategy="other")


def test_knapsack_against_a_plain_loop():
    rng = random.Random(9)
    sizes = [rng.randrange(0, 400) for _ in range(300)]
    left, want, b = sorted((s, i) for i, s in enumerate(sizes)), [-1] * 300, 0
    while left:
        room = 1000
        while any(s <= room for s, _ in left):
            s, i = max(x for x in left if x[0] <= room)
            left.remove((s, i))
            want[i], room = b, room - s
        b += 1
    assert K.knapsack(sizes, 1000) == want


def test_loader_composition(spark):
    """B10."""
    assert B.rotation_offsets([5, 7, 3], 4) == [0, 1, 0] and B.rotation_offsets([], 4) == []
    d = spark.range(500).selectExpr("id", "cast(id as string) as t")
    got = B.shuffle_buffered(d, ["id"], 32).collect()
    assert sorted(r.id for r in got) == list(range(500)) and all(r.t == str(r.id) for r in got)
    for part in {r.part for r in got}:
        own = sorted((r for r in got if r.part == part), key=lambda r: r.place)
        first = min(r.id for r in own)
        assert [r.place for r in own] == list(range(len(own))) and [r.id for r in own] != sorted(r.id for r in own)
        assert all(r.id - first <= r.place + 32 for r in own)  # no row leaves before it came
    assert sorted(map(tuple, got)) == sorted(map(tuple, B.shuffle_buffered(d, ["id"], 32).collect()))
    e = B.epoch_of(spark.range(7), ["id"], 10, 1).collect()
    assert sorted((r.place, r.id) for r in e) == [(k, (10 + k) % 7) for k in range(10)]


def test_embedder_and_indexes(spark):
    """V10 and the index factory."""
    d = spark.createDataFrame([(i, "x" * (i % 7)) for i in range(40)] + [(99, None)], "i long, t string")
    got = {r.id: r.embedding for r in V.embedded(d, lambda texts: np.array([[len(x), len(texts)] for x in texts]), "i", "t", 8).collect()}
    assert all(v[0] == (i % 7 if i != 99 else 0) and v[1] <= 8 for i, v in got.items()) and len(got) == 41
    e = spark.createDataFrame([(i, [float(i % 5), float(i % 3)], 0) for i in range(60)], "vec_id long, embedding array<double>, label int")
    flat = V.index_of("flat").add(e).search(e.where("vec_id < 3"), 4)
    assert flat.count() == 12 and V.index_of("cells", n=2).add(e).search(e.where("vec_id < 3"), 4).groupBy("query_id").count().count() == 3
    with pytest.raises(ValueError):
        V.index_of("other")


def test_legacy_builders():
    """X3."""
    tokens = ["[CLS]", *[x for k in range(40) for x in (f"w{k}", f"##a{k}")], "[SEP]"]
    for longer in (False, True):
        out, at, was = S.legacy_masked(tokens, 5, longer_first=longer, permuted=0.1)
        assert len(out) == len(tokens) and [tokens[p] for p in at] == was and 0 not in at and len(tokens) - 1 not in at
        assert all(out[p] == tokens[p] for p in range(len(tokens)) if p not in at)
    _, at, _ = S.legacy_masked(tokens, 6)
    assert len(at) <= round(len(tokens) * 0.15) and all((p + 1 in at) if tokens[p + 1].startswith("##") else True for p in at)
    t, kinds, cut = S.segments(list("abcdefgh"), list("xyz"), 6, 1)
    assert len(t) == 9 and len(kinds) == 9 and cut and t[0] == "[CLS]" and t.count("[SEP]") == 2
    assert S.segments(["a"], [], 6, 1) == (["[CLS]", "a", "[SEP]"], [0, 0, 0], False)


def test_supervised_against_a_plain_fold(spark):
    """V-A7."""
    from quern.operators.chat import supervised

    def plain(pairs, most, on_prompt, eos):
        ids, labels, used = [], [], int(eos is not None)
        for k, (s, t) in enumerate(pairs):
            room = most - used
            if room <= 0:
                break
            share = room if 2 * len(t) < room else room - len(s) if 2 * len(s) < room else int(room * (len(t) / (len(s) + len(t))))
            t = t[: min(share, len(t))]
            s = s[: max(room - len(t), 0)]
            used += len(s) + len(t)
            blank = s if on_prompt else [-100] * len(s) if eos is None or not k else [eos, *[-100] * (len(s) - 1)]
            ids, labels = ids + s + t, labels + blank + t
        end = [] if eos is None else [eos]
        return ids + end, labels + end

    rng = random.Random(4)
    rows = [(i, [([rng.randrange(9) for _ in range(rng.randrange(1, 60))], [rng.randrange(9) for _ in range(rng.randrange(1, 60))]) for _ in range(rng.randrange(1, 5))]) for i in range(60)]
    d = spark.createDataFrame(rows, "i long, p array<struct<source:array<int>,target:array<int>>>")
    for on_prompt, eos in ((False, None), (True, None), (False, 2)):
        got = {r.i: (r.x.ids, r.x.labels, r.x.loss_mask) for r in d.select("i", supervised(F.col("p"), 100, on_prompt, eos).alias("x")).collect()}
        for i, p in rows:
            ids, labels = plain(p, 100, on_prompt, eos)
            assert got[i] == (ids, labels, [int(x != -100) for x in labels])


def test_inverse_cloze_and_short_targets(spark, sf):
    """Every query is a sentence of its text. W7 with short targets: samples follow one another to the end."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = registry.QUERIES["W12_inverse_cloze"](spark, sf).collect()
    assert got and all(r.query in texts[r.id] for r in got)
    rows = registry.QUERIES["W7_short_sentence_pairs"](spark, sf).collect()
    ends = {}
    for r in sorted(rows, key=lambda r: (r.id, r.first)):
        assert r.first == ends.get(r.id, 0) and r.end > r.first and 2 <= r.target <= 128
        ends[r.id] = r.end
    assert any(r.target < 128 for r in rows)


def test_text_repair(spark):
    """F6."""
    cases = [("cafÃ©", "café"), ("plain", "plain"), ("e\u0301", "é"), ("a\x00b\x07c\n", "abc\n"), ("doesnâ€™t", "doesn’t")]
    assert [S.repaired(a) for a, _ in cases] == [b for _, b in cases]
    d = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)] + [(9, None)], "doc_id long, text string")
    assert {r.id: (r.text, r.fixed) for r in S.repaired_texts(d).collect()} == {i: (b, a != b) for i, (a, b) in enumerate(cases)} | {9: ("", False)}


def test_split_pieces_against_the_contract(spark, sf):
    """No piece holds a kept n-gram, pieces are parts of their text, in order, and longer than the least."""
    import re

    t = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    dic = C.ngram_dictionary(spark.read.parquet(f"{sf}/benchmark.parquet"))
    found = C.matches(docs, dic)
    kept = C.telling(C.document_frequency(dic, found))
    grams = {r.ngram for r in kept.collect()}
    hit = {r.id for r in C.contaminated(found, kept).collect()}
    rows = C.decontaminated(docs, found, kept).collect()
    assert hit and {r.id for r in rows} == set(t) and {r.id for r in rows if r.status != "clean"} == hit
    for r in rows:
        if r.status in ("split", "trimmed"):
            w = re.findall(r"\w+", r.text.lower())
            assert r.text in t[r.id] and len(r.text) > 200
            assert not any(" ".join(w[i : i + n]) in grams for n in {g.count(" ") + 1 for g in grams} for i in range(len(w) - n + 1))
    n = Counter(r.status for r in rows if r.piece == 0)
    assert sum(n.values()) == len(t)


def test_star_until_done_finds_what_pairs_find(spark):
    """On a small table the exact rounds find every pair of a bucket that is alike enough to a main."""
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh ") for _ in range(300))
    rows = [(i, base[: 300 - i] + "".join(rng.choice("xyz ") for _ in range(i))) for i in range(0, 40, 4)] + [(100 + i, "".join(rng.choice("klmno ") for _ in range(200))) for i in range(5)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    shingles = {i: {t[k : k + 5] for k in range(len(t) - 5)} for i, t in rows}
    like = lambda a, b: len(shingles[a] & shingles[b]) / len(shingles[a] | shingles[b])
    edges = {(r.main, r.other): r.sim for r in duplicate_edges(d, rounds=-1).collect()}
    assert edges and all(abs(like(a, b) - s) < 1e-9 and s > 0.5 for (a, b), s in edges.items())
    groups = {}
    for r in buckets(signatures(d)).collect():
        groups.setdefault((r.band, r.bucket), set()).add(r.id)
    want = set()
    for ids in groups.values():
        left = set(ids)
        while len(left) > 1:
            main = min(left)
            near = {x for x in left if x != main and like(main, x) > 0.5}
            want |= {(main, x) for x in near}
            left -= near | {main}
    assert set(edges) == want


def test_tar_bytes_are_the_same():
    rows = [("a", {"json": b"{}", "txt": b"x"})]
    assert shards.tar_bytes(rows) == shards.tar_bytes(rows) and tarfile.open(fileobj=io.BytesIO(shards.tar_bytes(rows))).getnames() == ["a.json", "a.txt"]
