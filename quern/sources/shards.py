"""Tar shards of samples (M11, IO15 to IO17, IO19). Folders are ones that the driver and all executors share."""

from __future__ import annotations

import io
import json
import os
import re
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordinal import running
from ..session import ship


def shard_numbers(samples: DataFrame, order: list[str], size_col: str, most: int = 10_000, most_bytes: int = 3 << 30) -> DataFrame:
    """IO15: samples with `shard`, cut by count; a shard of too many bytes is cut further by its running size."""
    r = running(samples, order).withColumn("part", F.expr(f"ord div {most}"))
    inside = F.expr(f"sum({size_col}) over (partition by part order by ord rows between unbounded preceding and 1 preceding)")
    return r.withColumn("cut", (F.coalesce(inside, F.lit(0)) / most_bytes).cast("long")).withColumn("shard", F.format_string("%06d-%03d", "part", "cut")).drop("ord", "part", "cut")


def tar_bytes(rows: list[tuple[str, dict[str, bytes]]]) -> bytes:
    """One tar of samples; members are key.extension, times are zero, so the same rows give the same bytes."""
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        for key, members in rows:
            for ext in sorted(members):
                info = tarfile.TarInfo(f"{key}.{ext}")
                info.size = len(members[ext])
                t.addfile(info, io.BytesIO(members[ext]))
    return out.getvalue()


def tar_shards(samples: DataFrame) -> DataFrame:
    """(shard, n, tar) from (shard, key, payload): a tar of key.json members for each shard. For shards well below the
    2 GB that one value may have; `write_shards` has no such limit."""

    def pack(key: tuple, d: pd.DataFrame) -> pd.DataFrame:
        d = d.sort_values("key")
        return pd.DataFrame({"shard": [key[0]], "n": [len(d)], "tar": [tar_bytes([(k, {"json": p.encode()}) for k, p in zip(d["key"], d["payload"], strict=True)])]})

    ship(samples.sparkSession)
    return samples.groupBy("shard").applyInPandas(pack, "shard string, n long, tar binary")


def write_shards(samples: DataFrame, folder: str, prefix: str) -> DataFrame:
    """IO15: (path, n, bytes) of the tars prefix-shard.tar made of (shard, key, members map<string, binary>).

    A task streams its shards, sorted, to files that get their names when they are whole, so a repeat leaves the same
    files and memory doesn't follow a shard's size.
    """
    os.makedirs(folder, exist_ok=True)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        name = tar = None
        made, n, attempt = [], 0, TaskContext.get().taskAttemptId()

        def close() -> None:
            tar.close()
            final = f"{folder}/{prefix}-{name}.tar"
            os.replace(f"{final}.{attempt}.tmp", final)
            made.append((final, n, os.path.getsize(final)))

        for d in batches:
            for shard, key, members in zip(d["shard"], d["key"], d["members"], strict=True):
                if shard != name:
                    if tar is not None:
                        close()
                    name, n = shard, 0
                    tar = tarfile.open(f"{folder}/{prefix}-{shard}.tar.{attempt}.tmp", "w")
                for ext, data in sorted(dict(members).items()):
                    info = tarfile.TarInfo(f"{key}.{ext}")
                    info.size = len(data)
                    tar.addfile(info, io.BytesIO(data))
                n += 1
        if tar is not None:
            close()
        yield pd.DataFrame(made, columns=["path", "n", "bytes"])

    ship(samples.sparkSession)
    dealt = samples.select("shard", "key", "members").repartition("shard").sortWithinPartitions("shard", "key")
    return dealt.mapInPandas(pack, "path string, n long, bytes long")


def finalized(folder: str, prefix: str) -> list[str]:
    """IO16: the chunks' tars, prefix-chunk-part.tar, renamed to prefix-%06d.tar in order of name; older final ones go."""
    names = sorted(os.listdir(folder))
    chunks = [x for x in names if re.fullmatch(rf"{re.escape(prefix)}-[^-]+-[^-]+\.tar", x)]
    if not chunks:
        return []
    for x in names:
        if re.fullmatch(rf"{re.escape(prefix)}-\d{{6}}\.tar(\.idx)?", x):
            os.remove(f"{folder}/{x}")
    out = []
    for k, x in enumerate(chunks):
        new = f"{prefix}-{k:06d}.tar"
        os.replace(f"{folder}/{x}", f"{folder}/{new}")
        if os.path.exists(f"{folder}/{x}.idx"):
            os.replace(f"{folder}/{x}.idx", f"{folder}/{new}.idx")
        out.append(new)
    return out


def chunk_numbers(text: str, last: int) -> list[int]:
    """IO16: "0-3,7" as numbers from 0 to last, rising, each once."""
    found: set[int] = set()
    for part in filter(None, map(str.strip, text.split(","))):
        low, dash, high = part.partition("-")
        found |= set(range(int(low), int(high) + 1)) if dash else {int(low)}
    return sorted(x for x in found if 0 <= x <= last)


def progress(members: DataFrame, prefix: str) -> DataFrame:
    """IO16: (chunk, n): how many samples (JSON members) the tars of each chunk hold, from tar_members."""
    chunk = F.regexp_extract("path", rf"{prefix}-(\d+)-[^/]*\.tar$", 1)
    return members.where(F.endswith("member", F.lit(".json"))).select(chunk.alias("chunk")).where("chunk <> ''").groupBy(F.col("chunk").cast("int").alias("chunk")).agg(F.count(F.lit(1)).alias("n"))


def tar_members(tars: DataFrame, content: str = "content") -> DataFrame:
    """(path, member, data) of tars read with format binaryFile."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            for path, raw in zip(d["path"], d[content], strict=True):
                with tarfile.open(fileobj=io.BytesIO(raw)) as t:
                    got = [(path, m.name, t.extractfile(m).read()) for m in t if m.isfile()]
                yield pd.DataFrame(got, columns=["path", "member", "data"])

    return tars.select("path", content).mapInPandas(unpack, "path string, member string, data binary")


def sample_keys(members: DataFrame) -> DataFrame:
    """IO19: (path, key, extensions) of the samples in tars."""
    key, ext = F.regexp_extract("member", r"^([^.]*)\.(.*)$", 1), F.regexp_extract("member", r"^([^.]*)\.(.*)$", 2)
    return members.select("path", key.alias("key"), ext.alias("ext")).groupBy("path", "key").agg(F.sort_array(F.collect_set("ext")).alias("extensions"))


def sample_of(members: DataFrame, path: str, key: str) -> dict[str, bytes]:
    """IO19: a sample's members by extension."""
    got = members.where((F.col("path").endswith(path)) & F.startswith("member", F.lit(f"{key}."))).select("member", "data").collect()
    return {r.member[len(key) + 1 :]: bytes(r.data) for r in got}


def tar_places(tars: DataFrame, content: str = "content") -> DataFrame:
    """IO19: (path, member, at, size): where each member's bytes lie, for reading one without the rest."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            for path, raw in zip(d["path"], d[content], strict=True):
                with tarfile.open(fileobj=io.BytesIO(raw)) as t:
                    got = [(path, m.name, m.offset_data, m.size) for m in t if m.isfile()]
                yield pd.DataFrame(got, columns=["path", "member", "at", "size"])

    return tars.select("path", content).mapInPandas(look, "path string, member string, at long, size long")


def conversation_payload(m: Column) -> Column:
    """IO17: the JSON of a sample's turns."""
    return F.to_json(F.struct(turns_of(m).alias("messages")))


def turns_of(m: Column) -> Column:
    return F.transform(m, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))


def media_payload(m: Column, images: Column, videos: Column | None = None, fps: Column | None = None) -> Column:
    """IO17: the JSON of turns with media names: images, videos or both; fps for frames of one video."""
    parts = [turns_of(m).alias("messages"), images.alias("images")]
    parts += [videos.alias("videos")] if videos is not None else []
    parts += [fps.alias("fps")] if fps is not None else []
    return F.to_json(F.struct(*parts))


def packed_payload(prompts: Column, captions: Column, images: Column, fps: Column | None = None) -> Column:
    """IO17: the JSON of a packed bin; the three lists have a member for each sample."""
    return F.to_json(F.struct(prompts.alias("prompts"), captions.alias("captions"), images.alias("images"), F.size(prompts).alias("sample_count"), *([fps.alias("fps")] if fps is not None else [])))


def caption_turns(caption: Column, question: Column | None = None) -> Column:
    """IO17, X14: a caption (or a question and its answer) as turns with the image first."""
    ask = F.lit("<image>") if question is None else F.concat(F.lit("<image>\n"), question)
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return F.array(turn("user", ask), turn("assistant", caption))


def payload_of(data: bytes) -> dict:
    return json.loads(data)
