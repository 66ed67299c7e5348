"""Samples with media: paths, marks, coordinates and checks (F20 to F23, P4 to P10, IO8, J2, X12)."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .ordinal import running

BOX = r"\[\s*([0-9.]+)\s*,\s*([0-9.]+)\s*,\s*([0-9.]+)\s*,\s*([0-9.]+)\s*\]"


def missing_media(samples: DataFrame, listing: DataFrame, key: str, images: str) -> DataFrame:
    """(key, image) of images that the listing(path) doesn't have."""
    return samples.select(key, F.explode(images).alias("image")).join(listing.select(F.col("path").alias("image")), "image", "left_anti")


def sampled(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """k rows by seeded digest; the sample is the feature."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(k)


def intact(samples: DataFrame, listing: DataFrame, key: str, images: str) -> DataFrame:
    """samples none of whose images is missing."""
    return samples.join(missing_media(samples, listing, key, images).select(key).distinct(), key, "left_anti")


def consistent(*lists: Column, count: Column) -> Column:
    """all lists have `count` members."""
    ok = F.lit(True)
    for x in lists:
        ok = ok & (F.size(x) == count)
    return ok


def quantized(values: Column) -> Column:
    """Shares to 0 .. 999, rounded half to even."""
    return F.transform(values, lambda v: F.least(F.greatest(F.bround(v.cast("double") * 1000), F.lit(0)), F.lit(999)).cast("int"))


def boxes(text: Column) -> Column:
    """The quantised coordinates of every box in a text, one after another."""
    return quantized(F.flatten(F.transform(F.regexp_extract_all(text, F.lit(BOX), F.lit(0)), lambda b: F.split(F.regexp_replace(b, r"[\[\]\s]", ""), ","))))


def source_tag(path: Column, marker: str = "images") -> Column:
    """P5: the folder after the marker, or nothing."""
    p = F.split(path, "/")
    at = F.array_position(p, marker)
    return F.when((at > 0) & (at < F.size(p)), F.get(p, at.cast("int"))).otherwise("")


def content_id(messages: Column, images: Column) -> Column:
    """SHA-1 of the canonical JSON."""
    return F.sha1(F.to_json(F.struct(messages.alias("m"), images.alias("i"))))


def unique_names(files: DataFrame, name: str, order: str) -> DataFrame:
    """The n-th repeat of base.ext is base_n.ext, the first stays. Repeats are numbered over a global order, in two steps."""
    nth = running(files, [name, order])
    first = nth.groupBy(name).agg(F.min("ord").alias("_first")).withColumnRenamed(name, "_name")
    both = nth.join(first, F.col(name) == F.col("_name")).withColumn("n", F.col("ord") - F.col("_first"))
    base, ext = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 2)
    return both.withColumn("unique_name", F.when(F.col("n") == 0, F.col(name)).otherwise(F.concat(base, F.lit("_"), F.col("n").cast("string"), ext))).drop("ord", "_first", "_name", "n")


def resolved_path(path: Column, rel: Column, root: Column, base: Column) -> Column:
    """Absolute paths as they are, else under the relative folder, the image root or the folder of the JSON."""
    at = lambda d: F.concat_ws("/", d, path)
    return F.when(F.startswith(path, F.lit("/")), path).when(rel.isNotNull(), at(rel)).when(root.isNotNull(), at(root)).otherwise(at(base))


def marks_first(m: Column, n_images: Column) -> Column:
    """Marks and lines that are empty without them go; so many marks stand before the first user turn."""
    clean = lambda t: F.array_join(F.filter(F.split(F.regexp_replace(t, "<image>|<video>", ""), "\n"), lambda x: F.trim(x) != ""), "\n")
    first = F.array_position(F.transform(m, lambda x: x["role"]), "user") - 1
    lead = F.repeat(F.lit("<image>\n"), n_images)
    return F.transform(m, lambda x, i: F.struct(x["role"].alias("role"), F.when(i == first, F.concat(lead, clean(x["content"]))).otherwise(clean(x["content"])).alias("content")))


def video_as_images(text: Column, n_images: Column, n_videos: Column) -> Column:
    """P10: a video mark becomes a block of image marks when there are images and no video."""
    return F.when((n_images > 0) & (n_videos == 0), F.replace(text, F.lit("<video>"), F.repeat(F.lit("<image>"), n_images))).otherwise(text)


def first_fraction(files: DataFrame, cls: str, path: str, fraction: float) -> DataFrame:
    """IO8: class index (classes in order) and the first floor(n fraction) paths of each class."""
    sizes = files.groupBy(cls).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.withColumn("class_index", F.row_number().over(Window.orderBy(cls)) - 1).withColumnRenamed(cls, "_c")
    r = running(files, [cls, path])
    least = r.groupBy(cls).agg(F.min("ord").alias("_least")).withColumnRenamed(cls, "_l")
    both = r.join(sizes, F.col(cls) == F.col("_c")).join(least, F.col(cls) == F.col("_l"))
    return both.where(F.col("ord") - F.col("_least") < F.floor(F.col("_n") * fraction)).drop("ord", "_n", "_c", "_least", "_l")


def frame_rows(samples: DataFrame, key: str, frames: str, fps: float, digits: int = 1) -> DataFrame:
    """(key, i, at, label) of every frame."""
    at = F.bround(F.col("i") / F.lit(fps), digits)
    return samples.select(key, F.posexplode(frames).alias("i", "_f")).select(key, "i", at.alias("at"), F.format_string(f"<%.{digits}f s>", at).alias("label"))


def regular_size(w: Column, h: Column) -> tuple[Column, Column]:
    """At least 28 a side; a side over 200 times the other becomes 180 times it."""
    w, h = F.greatest(w, F.lit(28)), F.greatest(h, F.lit(28))
    wide, tall = w / h > 200, h / w > 200
    return F.when(wide, h * 180).otherwise(w), F.when(tall, w * 180).otherwise(h)


# How image files begin, and how JPEG files end.
SIGNATURES = (b"\x89PNG\r\n\x1a\n", b"\xff\xd8\xff", b"GIF87a", b"GIF89a", b"BM", b"RIFF", b"II*\x00", b"MM\x00*")
JPEG_END = b"\xff\xd9"


def image_fine(data: bytes | None) -> bool:
    """no image is empty, of an unknown kind, cut off or black all over.

    PNG files are unpacked; of others only what shows without a decoder is looked at: signature, JPEG end, BMP pixels.
    """
    if not data or not data.startswith(SIGNATURES):
        return False
    if data.startswith(SIGNATURES[0]):
        return _png_fine(data)
    if data.startswith(b"\xff\xd8"):
        return data.rstrip(b"\x00").endswith(JPEG_END)
    if data.startswith(b"BM"):
        at = struct.unpack_from("<I", data, 10)[0] if len(data) >= 14 else len(data)
        return any(data[at:])
    return True


def _png_fine(data: bytes) -> bool:
    packed, at, ended, colour = [], 8, False, None
    while at + 8 <= len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        if len(body) < size:
            return False
        if kind == b"IHDR":
            colour = body[9]
        elif kind == b"IDAT":
            packed.append(body)
        elif kind == b"IEND":
            ended = True
        at += 12 + size
    try:
        raw = zlib.decompress(b"".join(packed))
    except zlib.error:
        return False
    # palettes say nothing about black, so any index counts there
    return ended and bool(raw) and (colour == 3 or any(raw.strip(b"\x00")))


def image_ok(content: Column) -> Column:
    """F17 as a column."""

    @F.pandas_udf("boolean")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda v: image_fine(None if v is None else bytes(v)))

    return run(content)


def copied(files: DataFrame, folder: str) -> DataFrame:
    """(path, target, n_bytes) of files(path, content, unique_name) written into a shared folder under their unique names.

    Each is written beside its name and then moved there, so a repeat leaves the same files. Recoding needs a decoder:
    a column that holds recoded bytes may stand for content.
    """
    os.makedirs(folder, exist_ok=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        for d in batches:
            rows = []
            for path, content, name in zip(d["path"], d["content"], d["unique_name"], strict=True):
                target = f"{folder}/{name}"
                with open(f"{target}.{attempt}.tmp", "wb") as f:
                    f.write(content)
                os.replace(f"{target}.{attempt}.tmp", target)
                rows.append((path, target, len(content)))
            yield pd.DataFrame(rows, columns=["path", "target", "n_bytes"])

    ship(files.sparkSession)
    return files.select("path", "content", "unique_name").mapInPandas(run, "path string, target string, n_bytes long")
