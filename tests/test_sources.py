"""Readers, writers, streams and the parts without SQL."""

import gzip
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import blend as B
from quern.operators import decontam as C
from quern.operators import packing as K
from quern.operators import timebucket as S
from quern.sources import files, indexed, shards
from quern.streaming import buckets
from quern.session import table


def test_jsonl(spark, tmp_path):
    p = tmp_path / "a.jsonl.gz"
    p.write_bytes(gzip.compress(b'{"text": "a", "k": 1}\n\n{broken\n{"text": "b"}\n'))
    good, bad = files.jsonl(spark, str(p), "text string, k int")
    assert [(r.text, r.k) for r in good.collect()] == [("a", 1), ("b", None)] and [r.value for r in bad.collect()] == ["{broken"]
    (tmp_path / "l.json").write_text('[{"a": 1}, {"a": 2}]')
    assert files.json_auto(spark, str(tmp_path / "l.json")).count() == 2
    (tmp_path / "o.json").write_text('{"a": 1}')
    with pytest.raises(ValueError):
        files.json_auto(spark, str(tmp_path / "o.json"))
    with pytest.raises(ValueError):
        files.load(spark, ["a.csv", "b.json"])


def test_tables(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("\t".join("abcdefghijkl") + "\n" + "\t".join(["7", *"1234567", " x ", "y", "z", "neutral"]) + "\n")
    r = files.pair_classification(files.tsv(spark, str(tmp_path / "m.tsv"))).first()
    assert (r.uid, r.text_a, r.text_b, r.label) == (7, "x", "y", "neutral")
    art = spark.createDataFrame([("art", ["Is _ it", "why"], [["a", "b", "c", "d"], ["e", "f", "g", "h"]], ["B", "D"])], "article string, questions array<string>, options array<array<string>>, answers array<string>")
    got = {(r.q, r.option): (r.qa, r.label) for r in files.multiple_choice(art).collect()}
    assert got[(0, 1)] == ("Is b it", 1) and got[(1, 3)] == ("why h", 3) and len(got) == 8
    lines = spark.createDataFrame([(" a.tar : 12",), ("b.tar: x",), ("c.tar:3 ",)], "value string")
    assert [(r.tar, r.n) for r in files.tar_counts(lines).orderBy("tar").collect()] == [("a.tar", 12), ("c.tar", 3)]


def test_indexed_round_trip(spark, tmp_path):
    rows = [(0, 0, [1, 2, 3]), (0, 1, [4]), (1, 2, []), (2, 3, list(range(500)))]
    df = spark.createDataFrame(rows, "doc_id long, seq_no long, tokens array<long>")
    indexed.write(df, str(tmp_path / "x"), indexed.dtype_code(1000))
    indexed.register(spark)
    got = spark.read.format("indexed_tokens").option("ranges", 3).load(str(tmp_path / "x"))
    assert sorted((r.doc_id, r.seq_no, r.tokens) for r in got.collect()) == rows
    two = indexed.merged([got, got])
    assert sorted(r.doc_id for r in two.collect()) == [0, 0, 1, 2, 3, 3, 4, 5]
    assert {r.seq_no: r.tokens for r in indexed.sliced(got, 1, 2).collect()}[0] == [2, 3]


def test_tar_shards(spark, tmp_path):
    d = spark.range(25).selectExpr("id", "format_string('%04d', id) as key", "concat('{\"n\":', id, '}') as payload", "10L as size")
    got = shards.tar_shards(shards.shard_numbers(d, ["id"], "size", 10).select("shard", "key", "payload")).collect()
    assert sorted(r.n for r in got) == [5, 10, 10]
    for r in got:
        (tmp_path / f"{r.shard}.tar").write_bytes(r.tar)
    back = shards.tar_members(spark.read.format("binaryFile").load(str(tmp_path)))
    assert sorted(json.loads(r.data)["n"] for r in back.collect()) == list(range(25))


def test_stream_equals_batch(spark, sf, tmp_path):
    e = table(spark, sf, "events").orderBy("ts")
    e.repartitionByRange(3, "ts").write.parquet(str(tmp_path / "in"))
    df = buckets.tumbling(buckets.event_stream(spark, str(tmp_path / "in"), e.schema), "1 hour", "3650 days")
    buckets.run_to_table(df, "b1", str(tmp_path / "c"), "complete")
    want = e.withColumn("ts", F.col("ts").cast("timestamp")).groupBy("user_id", F.window("ts", "1 hour").alias("w")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("value"), F.count(F.lit(1)).alias("n")).select("user_id", "w.start", "value", "n")
    assert sorted(map(tuple, spark.table("b1").collect())) == sorted(map(tuple, want.collect()))


def test_blends():
    assert B.parse_blend(["30", "p", "70", "q"]) == (["p", "q"], [30.0, 70.0]) and B.parse_blend(["a", "b"]) == (["a", "b"], None)
    with pytest.raises(ValueError):
        B.parse_blend(["30", "p", "x", "q"])
    got = B.greedy_blend([0.5, 0.3, 0.2], 1000)
    assert all(abs((got == k).sum() - 1000 * w) <= 1 for k, w in enumerate([0.5, 0.3, 0.2]))
    assert np.bincount(B.exhaustive_blend([5, 3, 9])).tolist() == [5, 3, 9]
    assert [round(b, 3) for _, b in B.split_matrix("969, 30, 1")] == [0.969, 0.999, 1.0]
    assert B.legacy_bounds(10, "969,30,1")[-1] == 10
    assert B.intersected([(0, 0.9), (0.9, 1)], [(0.5, 1), (0, 0.2)]) == [(0.5, 0.9), None]


def test_packers():
    sizes = sorted(np.random.default_rng(0).integers(1, 1000, 300).tolist(), reverse=True)
    for rule in (K.first_fit, K.best_fit, K.knapsack):
        own = sizes if rule is not K.knapsack else sizes[::-1]
        bins = rule(own, 1000, 5)
        use, count = {}, {}
        for s, b in zip(own, bins):
            use[b], count[b] = use.get(b, 0) + s, count.get(b, 0) + 1
        assert max(use.values()) <= 1000 and (rule is K.knapsack or max(count.values()) <= 5)
    plain, bins = [], []
    for s in sizes:
        b = next((i for i, (t, n) in enumerate(plain) if t + s <= 1000 and n < 5), None)
        if b is None:
            plain.append((0, 0))
            b = len(plain) - 1
        plain[b] = (plain[b][0] + s, plain[b][1] + 1)
        bins.append(b)
    assert bins == K.first_fit(sizes, 1000, 5)
    with pytest.raises(ValueError):
        K.knapsack([5, 20], 10)
    assert K.knapsack([5, 20], 10, strict=False) == [0, -1]
    assert K.first_fit([12, 3], 10, 5) == [0, 1] and K.best_fit([12, 3], 10, 5) == [0, 1]


def test_split_and_trim():
    gram = " ".join(f"g{i}" for i in range(13))
    filler = " ".join(f"w{i}" for i in range(120)) + ". "
    text = filler + gram + ". " + filler
    got = C.split_text(text, {gram})
    assert len(got) == 2 or all(gram not in p for p in got)
    assert C.split_text("short text", {gram}) == ["short text"] and C.split_text(filler, {gram}) == [filler]
    assert C.split_text(gram + " " + "x" * 300, {gram}) == []


def test_small_time_functions(spark):
    one = spark.range(1)
    r = one.select(S.spliced(F.array(F.lit("a"), F.lit("b")), F.array(F.lit(2), F.lit(0))).alias("s"), S.parsed_times(F.lit("5, 6.7,")).alias("t"), S.even_spaced(F.lit(10), 4).alias("e"), F.size(S.patch_grid(F.lit(1), F.lit(4), F.lit(4))).alias("g"), S.frame_times(F.array(F.lit(4), F.lit(2), F.lit(4)), 2.0).alias("f"), S.rate_spaced(F.lit(2.0), 2, 10, F.lit(15)).alias("r")).first()
    assert (r.s, r.t, r.e, r.g, r.f, r.r) == (["a", "a"], [5, 6], [0, 3, 6, 9], 16, [1.0, 2.0], [0, 5, 10, 14])
