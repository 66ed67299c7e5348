"""Near-duplicate detection over character shingles."""

from __future__ import annotations

import random
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .arrow import map_parts
from .graph import connected_components
from .shingles import Shingled, least_permuted, shared, texts_of

PRIME = (1 << 31) - 1


def char_shingles(text: Column, n: int = 5) -> Column:
    """Distinct character windows, without the very last one (as the published tool has it)."""
    found = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
    return F.array_distinct(F.slice(found, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0))))


def similarity(both: Column, a: Column, b: Column, over: str = "union") -> Column:
    """Shared shingles over those of the union, the smaller or the larger set, from their numbers; 0 if a set is empty."""
    of = {"union": a + b - both, "min": F.least(a, b), "max": F.greatest(a, b)}[over]
    return F.when((a == 0) | (b == 0), F.lit(0.0)).otherwise(both / F.greatest(of, F.lit(1)))


def jaccard(a: Column, b: Column, over: str = "union") -> Column:
    """D2, of two columns of sets."""
    return similarity(F.size(F.array_intersect(a, b)), F.size(a), F.size(b), over)


def _sizes(part: pa.RecordBatch, n: int) -> pa.RecordBatch:
    s = Shingled(texts_of(part.column(1)), n)
    windows, place, ends = s.told()
    first = [int(e) - len(x) for x, e in zip(s.sets, ends)]
    least = ["".join(map(chr, windows[place[at]])) if len(x) else None for x, at in zip(s.sets, first)]
    return pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) for x in s.sets], pa.int32()), pa.array(least, pa.string())], ["id", "n", "least"])


def shingle_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5) -> DataFrame:
    """(id, n, least): how many distinct shingles a text has and the least of them; a null text has none."""
    kind = docs.schema[id_col].dataType.simpleString()
    return map_parts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), partial(_sizes, n=n), f"id {kind}, n int, least string")


def _overlaps(part: pa.RecordBatch, n: int) -> pa.RecordBatch:
    known: dict[str, int] = {}
    at = [[known.setdefault(x, len(known)) for x in texts_of(part.column(k))] for k in (-2, -1)]
    sets = Shingled(list(known), n).sets
    pairs = [(sets[i], sets[j]) for i, j in zip(*at)]
    made = [[shared(x, y) for x, y in pairs], [len(x) for x, _ in pairs], [len(y) for _, y in pairs]]
    return pa.RecordBatch.from_arrays([*part.columns[:-2], *(pa.array(x, pa.int32()) for x in made)], [*part.schema.names[:-2], "both", "na", "nb"])


def shingle_overlaps(pairs: DataFrame, n: int = 5) -> DataFrame:
    """Pairs whose last two columns are texts: instead of these how many shingles both have (`both`), and each (`na`, `nb`)."""
    names = pairs.columns[:-2]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields[:-2])
    return map_parts(pairs, partial(_overlaps, n=n), f"{kinds}, both int, na int, nb int").select(*names, "both", "na", "nb")


def permutations(n: int, seed: int = 1234) -> list[tuple[int, int]]:
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(0, PRIME)) for _ in range(n)]


def _signed(part: pa.RecordBatch, perms: list[tuple[int, int]]) -> pa.RecordBatch:
    s = Shingled(texts_of(part.column(1)))
    has = np.flatnonzero([len(x) > 0 for x in s.sets])
    low = least_permuted(s, *(np.array(x, np.uint64) for x in zip(*perms)), PRIME)[has].astype(np.int64)
    sig = pa.ListArray.from_arrays(pa.array(np.arange(len(has) + 1) * len(perms), pa.int32()), pa.array(low.reshape(-1)))
    return pa.RecordBatch.from_arrays([part.column(0).take(pa.array(has)), sig], ["id", "sig"])


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, perms: int = 100, seed: int = 1234) -> DataFrame:
    """D3: (id, sig) with the smallest of each permuted shingle hash; documents without a shingle are left out.

    The base hash is the first 28 bits of an MD5. Everything is numpy on parts of Arrow batches; a shingle that several
    texts of a part have is hashed and permuted once.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_parts(src, partial(_signed, perms=permutations(perms, seed)), f"id {kind}, sig array<bigint>", 1 << 20)


def buckets(sigs: DataFrame, bands: int = 10, rows: int = 10) -> DataFrame:
    """(band, bucket, id); a bucket is the digest of a band's values."""
    made = F.array(*[F.struct(F.lit(i).alias("band"), F.md5(F.array_join(F.transform(F.slice("sig", i * rows + 1, rows), lambda x: x.cast("string")), ",")).alias("bucket")) for i in range(bands)])
    return sigs.select("id", F.inline(made))


def star_pairs(bucketed: DataFrame) -> DataFrame:
    """D5, first round: (main, other) where main is the smallest id of a shared bucket. Linear in a bucket's size."""
    main = bucketed.groupBy("band", "bucket").agg(F.min("id").alias("main"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return bucketed.join(main, ["band", "bucket"]).where("id <> main").select("main", F.col("id").alias("other")).distinct()


def scored_pairs(pairs: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, over: str = "union", above: float = 0.5) -> DataFrame:
    """Pairs whose shingle sets are alike by more than `above`: (main, other, sim)."""
    t = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    a, b = t.select(F.col("i").alias("main"), F.col("t").alias("ta")), t.select(F.col("i").alias("other"), F.col("t").alias("tb"))
    s = shingle_overlaps(pairs.join(b, "other").join(a, "main").select("main", "other", "ta", "tb"))
    return s.select("main", "other", similarity(F.col("both"), F.col("na"), F.col("nb"), over).alias("sim")).where(F.col("sim") > above)


def duplicate_edges(docs: DataFrame, sigs: DataFrame | None = None, rounds: int = 1, **how) -> DataFrame:
    """Star rounds over the buckets; rounds=-1 goes on until every bucket holds one document or none.

    After a round, a bucket's main and what it matched leave the bucket.
    """
    b = stage(buckets(sigs if sigs is not None else signatures(docs)), "buckets")
    found, k = None, 0
    while rounds < 0 or k < rounds:
        main = b.groupBy("band", "bucket").agg(F.min("id").alias("main"), F.count(F.lit(1)).alias("n")).where("n > 1")
        of = b.join(main, ["band", "bucket"])
        pairs = stage(of.where("id <> main").select("main", F.col("id").alias("other")).distinct(), "pairs")
        if pairs.isEmpty():
            break
        edges = stage(scored_pairs(pairs, docs, **how), "edges")
        found, k = edges if found is None else found.union(edges).distinct(), k + 1
        if rounds < 0 or k < rounds:
            gone = of.join(edges, (of["main"] == edges["main"]) & (of["id"] == edges["other"]), "left_semi").select("band", "bucket", "id")
            gone = gone.union(main.select("band", "bucket", F.col("main").alias("id")))
            b = stage(b.join(main.select("band", "bucket"), ["band", "bucket"], "left_semi").join(gone, ["band", "bucket", "id"], "left_anti"), "buckets")
    return found if found is not None else docs.sparkSession.createDataFrame([], "main long, other long, sim double")


def duplicate_groups(edges: DataFrame, at_least: float = 0.7) -> DataFrame:
    """(id, component) of documents in groups of two or more."""
    return connected_components(edges.where(F.col("sim") >= at_least).select(F.col("main").alias("a"), F.col("other").alias("b")))


def without_duplicates(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The smallest id of each group stays."""
    gone = groups.where("id <> component").select(F.col("id").alias("_gone"))
    return docs.join(gone, F.col(id_col) == F.col("_gone"), "left_anti")


def keyed_sources(sources: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """(id, source, text) of several (name, table, key column, text column); an id is name:key, so keys may repeat."""
    out = None
    for name, df, key, text in sources:
        t = df.select(F.concat(F.lit(f"{name}:"), F.col(key).cast("string")).alias("id"), F.lit(name).alias("source"), F.col(text).alias("text"))
        out = t if out is None else out.unionByName(t)
    if out is None:
        raise ValueError("no sources")
    return out
