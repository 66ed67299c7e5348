"""Near-duplicate documents (operator 1).

Every text becomes the set of its distinct word shingles. A *fast similarity sketch* of the set fills T coordinates:
round i < T throws every shingle into a hashed bin with the value i + hash, and the smallest value in a bin stays;
rounds T..2T-1 put every shingle into bin i - T, so that every coordinate is filled, and rounds stop as soon as all
are. Bands of R coordinates are the buckets. Texts with equal sets are one class from the start (a 128-bit digest of
the set), so thousands of copies cost one sketch row downstream. Classes, not ids, are what is linked.

Links are confirmed on the full sets. A bucket never emits all its pairs:

1. every member is compared with two members of its bucket, the first and the most central one (that which shares
   buckets with the most others; in a group of edited copies this is the original);
2. buckets that the links of 1 leave in more than one component go through an exact similarity join. Shingles are
   ordered from rare to common. Two sets of n <= m shingles that reach the threshold t share one among the first
   n - ceil(2t/(1+t) n) + 1 of the smaller and the first m - ceil(t m) + 1 of the larger set. First every set is
   compared with one hub for each of these shingles and size band, which joins clusters; then the pairs that are still
   in different components and have enough left behind the shingle they share are compared, long lists in slices.

So a pair is lost only if it shares no bucket: (1 - J^R)^(T/R), 5e-8 at J = 0.8 for T = 128, R = 4.

Hot keys: joins on a bucket, a shingle, a class or a component take the keys that hold more than a 10,000th of the rows
apart (`join_counted`); counts and minima are taken map-side.

Edge cases: null and wordless texts have no shingles, are linked with nothing and kept; fewer words than a shingle
make the whole sequence one shingle; a null id gives a row with a null component that is kept; rows that repeat an id
are documents of their own, each with the component of its own text; extra columns are ignored; an empty table gives
an empty one. `without_near_duplicates` keeps one row of each group, of rows alike in every column one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from .common import BYTE_LOWER, U, arrow_map, fresh, join_counted, mix, row_digest, seeds, span_hashes, stage, text_chunks, word_spans

#: Ids of candidate documents up to this many are broadcast (8 bytes each) instead of shuffling all texts.
BROADCAST_IDS = 500_000

#: Sets on the list of one shingle that a task compares with the list at a time.
SLICE = 2_000

#: A list of more sets than this goes through its hubs before its pairs are looked at.
HUBS = 100


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and their offsets."""
    starts, ends, woffs = word_spans(data, offs)
    h = span_hashes(data, starts, ends, BYTE_LOWER)
    n = np.diff(woffs)
    doc = np.repeat(np.arange(len(n)), n)
    k = seeds(words, 77) | U(1)
    full = n >= words
    rolled = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for j in range(words):
        rolled += h[j : j + len(rolled)] * k[j]
    inside = np.arange(len(rolled)) <= (woffs[1:] - words)[doc[: len(rolled)]]
    s, d = mix(rolled[inside]), doc[: len(rolled)][inside]
    short = np.flatnonzero(~full & (n > 0))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for i, x in enumerate(short):
            extra[i] = (h[woffs[x] : woffs[x + 1]] * k[: n[x]]).sum() + U(int(n[x]))
        s, d = np.concatenate([s, mix(extra)]), np.concatenate([d, short])
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    if len(s):
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
        s, d = s[new], d[new]
    return s, np.searchsorted(d, np.arange(len(n) + 1))


def sketch(s: np.ndarray, offs: np.ndarray, coords: int) -> np.ndarray:
    """Fast similarity sketches, one row of `coords` values for each set that isn't empty (others hold the maximum)."""
    n, bits = len(offs) - 1, coords.bit_length() - 1
    if 1 << bits != coords:
        raise ValueError("coords must be a power of two")
    top, low = U(64 - bits), U((1 << 54) - 1)
    out = np.full(n * coords, np.iinfo(np.uint64).max, np.uint64)
    doc, key = np.repeat(np.arange(n), np.diff(offs)), seeds(2 * coords, 5)
    for i in range(2 * coords):
        if not len(s):
            break
        h = mix(s ^ key[i])
        b = (h >> top).astype(np.int64) if i < coords else i - coords
        np.minimum.at(out, doc * coords + b, (h & low) | U(i << 54))
        if i % 2 or i > 7:
            open_ = (out.reshape(n, coords) == np.iinfo(np.uint64).max).any(axis=1)
            stay = open_[doc]
            if not stay.all():
                s, doc = s[stay], doc[stay]
    return out.reshape(n, coords)


def _digests(s: np.ndarray, so: np.ndarray) -> np.ndarray:
    """Two 64-bit digests of each set."""
    n = np.diff(so)
    tops, has = np.zeros((2, len(n)), np.uint64), np.flatnonzero(n)
    if len(has):
        for k in range(2):
            tops[k, has] = np.add.reduceat(mix(s ^ seeds(1, 100 + k)), so[has])
    return tops.view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch], words: int, coords: int, rows: int) -> Iterator[pa.RecordBatch]:
    band_key = seeds(coords, 9).reshape(-1, rows) | U(1)
    for b in batches:
        for lo, hi, data, offs in text_chunks(b, "text"):
            s, so = shingle_sets(data, offs, words)
            keys = mix((sketch(s, so, coords).reshape(hi - lo, -1, rows) * band_key).sum(axis=2) + band_key[:, 0])
            bands = keys.shape[1]
            keys = pa.ListArray.from_arrays(pa.array(np.arange(0, (hi - lo + 1) * bands, bands, dtype=np.int32)), pa.array(keys.ravel().view(np.int64)))
            own = [b.column(k).slice(lo, hi - lo) for k in range(2)]
            yield pa.RecordBatch.from_arrays([*own, pa.array(np.diff(so)), *map(pa.array, _digests(s, so)), keys], ["id", "rd", "n", "f1", "f2", "keys"])


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, offs in text_chunks(b, "text"):
            s, so = shingle_sets(data, offs, words)
            sets = pa.ListArray.from_arrays(pa.array(so.astype(np.int32)), pa.array(s.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *map(pa.array, _digests(s, so)), sets], ["id", "f1", "f2", "s"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs(a, b), those with 100 |A n B| >= percent |A u B|."""
    a = sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("s").alias("sa"))
    b = sets.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("s").alias("sb"))
    fit = F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    both = F.size(F.array_intersect("sa", "sb"))
    found = pairs.join(a, "a").join(b, "b").where(fit).withColumn("i", both)
    return found.where(F.expr(f"100 * i >= {percent} * (na + nb - i)")).select("a", "b")


def _ordered(pairs: DataFrame, x: str, y: str) -> DataFrame:
    return pairs.where(F.col(x) != F.col(y)).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5, percent: int = 80, coords: int = 128, rows: int = 4) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row of docs; kept marks the smallest id of a component."""
    got = _grouped(docs, id_col, text_col, F.lit(0).cast("long"), words, percent, coords, rows)
    component = F.when(F.col("id").isNotNull(), F.coalesce("least_id", "id"))
    return got.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5, percent: int = 80, coords: int = 128, rows: int = 4) -> DataFrame:
    """docs with one row of each group: that of the smallest id, of equal ids that of the smallest row digest."""
    got = _grouped(docs, id_col, text_col, row_digest(docs), words, percent, coords, rows).where("grp is not null")
    got = stage(got.select("id", "rd", "grp"), "grouped")
    first = F.struct("id", "rd")
    best = got.groupBy("grp").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("size"))
    told = join_counted(got, best, ["grp"], "size", got.count())
    told = told.select("id", "rd", (first == F.col("first")).alias("stays")).groupBy("id", "rd").agg(F.bool_or("stays").alias("stays"), F.count(F.lit(1)).alias("same"))
    told = stage(told.where("not stays or same > 1"), "told")
    i, d = fresh(docs, "_id"), fresh(docs, "_rd")
    named = docs.withColumns({i: F.col(id_col).cast("long"), d: row_digest(docs)})
    marks = lambda t: t.select(F.col("id").alias(i), F.col("rd").alias(d))
    left = named.join(marks(told), [i, d], "left_anti").select(*docs.columns)
    twice = told.where("stays")
    if twice.isEmpty():
        return left
    once = named.join(marks(twice), [i, d], "left_semi").groupBy(i, d).agg(*[F.first(F.col(f"`{c}`")).alias(c) for c in docs.columns])
    return left.unionByName(once.select(*docs.columns))


def _grouped(docs: DataFrame, id_col: str, text_col: str, digest: F.Column, words: int, percent: int, coords: int, rows: int) -> DataFrame:
    """(id, rd, n, grp, least_id) of every row: its group's number and smallest id, null for a document alone."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), digest.alias("rd"), F.col(text_col).cast("string").alias("text"))
    sk = stage(arrow_map(src, partial(_sketches, words=words, coords=coords, rows=rows), "id long, rd long, n long, f1 long, f2 long, keys array<long>"), "sketch")
    classes = sk.where("n > 0 and id is not null").groupBy("n", "f1", "f2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys"))
    classes = stage(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    comp = _components(src.select("id", "text"), classes, words, percent)
    named = classes.drop("keys").join(comp.select(F.col("id").alias("cls"), F.col("component").alias("grp")), "cls", "left").where("copies > 1 or grp is not null")
    named = stage(named.withColumn("grp", F.coalesce("grp", "cls")), "named")
    least = named.groupBy("grp").agg(F.min("rep").alias("least_id"), F.count(F.lit(1)).alias("members"))
    named = join_counted(named, least, ["grp"], "members", named.count()).select("n", "f1", "f2", "copies", "grp", "least_id")
    some = sk.where("n > 0 and id is not null").select("id", "rd", "n", "f1", "f2")
    told = join_counted(some, stage(named, "named"), ["n", "f1", "f2"], "copies", sk.count(), "left").select("id", "rd", "n", "grp", "least_id")
    return told.unionByName(sk.where("n = 0 or id is null").select("id", "rd", "n"), allowMissingColumns=True)


def _components(src: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, component) of the classes that are linked with another."""
    rows = classes.select(F.explode("keys").alias("key"), "cls")
    shared = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("cls").alias("hub")).where("size > 1"), "shared")
    total = shared.agg(F.sum("size")).first()[0] or 0
    mem = stage(join_counted(rows, shared, ["key"], "size", total), "members")
    central = mem.groupBy("cls").agg(F.sum("size").alias("score"))
    middle = mem.join(central, "cls").groupBy("key").agg(F.max_by("cls", F.struct("score", -F.col("cls"))).alias("mid"), F.count(F.lit(1)).alias("size"))
    pairs = mem.select("cls", F.col("hub").alias("to")).union(join_counted(mem.select("key", "cls"), stage(middle, "middle"), ["key"], "size", total).select("cls", F.col("mid").alias("to")))
    pairs = stage(_ordered(pairs, "cls", "to"), "pairs")
    need = mem.select("cls").distinct().join(classes.select("cls", F.col("rep").alias("id"), "n", "f1", "f2"), "cls")
    need = stage(need, "need")
    ids = need.select("id").distinct()
    found = src.join(F.broadcast(ids) if need.count() <= BROADCAST_IDS else ids, "id", "left_semi")
    sets = arrow_map(found, partial(_sets, words=words), "id long, f1 long, f2 long, s array<long>")
    sets = stage(sets.join(need, ["id", "f1", "f2"]).dropDuplicates(["cls"]).select("cls", "n", "s"), "sets")
    comp = connected_components(stage(_verified(pairs, sets, percent), "links"))
    return _rest(mem, sets, comp, percent)


def _merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """Components with more links: those between components make a (smaller) graph of their own."""
    if links.isEmpty():
        return comp
    of = comp.select("id", F.col("component").alias("c"))
    ends = links.join(of.withColumnRenamed("id", "a"), "a", "left").withColumn("x", F.coalesce("c", "a")).drop("c")
    ends = ends.join(of.withColumnRenamed("id", "b"), "b", "left").withColumn("y", F.coalesce("c", "b"))
    top = connected_components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")))
    moved = comp.join(top.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    fresh_ = top.join(comp, "id", "left_anti")  # classes without a link before
    return stage(moved.unionByName(fresh_), "components")


def _rest(mem: DataFrame, sets: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """comp with the links between components inside buckets that hold several: an exact join on rare prefix shingles."""
    label = mem.select("key", "cls").join(comp.withColumnRenamed("id", "cls"), "cls", "left").withColumn("c", F.coalesce("component", "cls"))
    split = label.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).where("x <> y").select("key")
    left = label.join(split, "key", "left_semi").select("cls").distinct()
    part = stage(left.join(sets, "cls"), "left")
    if part.isEmpty():
        return comp
    post = part.select("cls", "n", F.explode("s").alias("h"))
    often = stage(post.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "often")
    ranked = join_counted(post, often, ["h"], "df", often.agg(F.sum("df")).first()[0] or 0)
    ranked = ranked.selectExpr("*", "row_number() over (partition by cls order by df, h) as r", "count(1) over (partition by cls) as m")
    # shingles that no other set holds come first; they can't make a pair
    ranked = ranked.withColumn("at", F.expr("r + n - m"))
    prefix = ranked.where(f"at <= n - ceil({percent} * n / 100D) + 1").withColumn("small", F.expr(f"at <= n - ceil({2 * percent} * n / {100 + percent}D) + 1"))
    prefix = stage(prefix.select("h", "cls", "n", "at", "small"), "prefix")

    total = prefix.count()
    now, lists, longest = _lists(prefix, comp)
    if longest > HUBS:
        band = F.floor(F.log(1.25, F.col("n")))
        hubs = prefix.withColumn("band", band).groupBy("h", "band").agg(F.max_by("cls", F.struct("n", "cls")).alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1")
        pairs = join_counted(prefix.withColumn("band", band), stage(hubs, "hubs"), ["h", "band"], "size", total)
        comp = _merged(comp, stage(_verified(stage(_ordered(pairs, "cls", "hub"), "pairs"), sets, percent), "links"))
        now, lists, longest = _lists(prefix, comp)
    if not longest:
        return comp
    now = join_counted(now, lists, ["h"], "size", total)
    large = now.select("h", F.pmod(F.xxhash64("cls"), F.col("slices")).cast("int").alias("slice"), F.col("cls").alias("y"), F.col("c").alias("cy"), F.col("n").alias("ny"), F.col("at").alias("aty"))
    small = now.where("small").select("h", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"), "cls", "c", "n", "at")
    # at its first common shingle a pair can't share more than what is left of either set from there on
    fits = F.expr(f"c <> cy and (n < ny or (n = ny and cls < y)) and 100 * n >= {percent} * ny")
    reach = F.expr(f"{100 + percent} * (least(n - at, ny - aty) + 1) >= {percent} * (n + ny)")
    pairs = _ordered(small.join(large, ["h", "slice"]).where(fits & reach), "cls", "y")
    return _merged(comp, stage(_verified(pairs, sets, percent), "links"))


def _lists(prefix: DataFrame, comp: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """prefix with components, the shingles whose lists hold several components, and how long the longest list is."""
    now = prefix.join(comp.select(F.col("id").alias("cls"), F.col("component").alias("c")), "cls", "left").withColumn("c", F.coalesce("c", "cls"))
    lists = now.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo <> hi")
    lists = stage(lists.select("h", "size", F.expr(f"cast(least(1 + size div {SLICE}, 65536) as int)").alias("slices")), "lists")
    return now, lists, lists.agg(F.max("size")).first()[0] or 0
