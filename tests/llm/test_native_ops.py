"""Operators 3, 5, 6 and 8 against plain Python on small fixtures."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from quern.llm.chat_collapse import format_chats
from quern.llm.line_dedup import keep_lines, line_bitmaps
from quern.llm.quality_rules import apply_rules, measures
from quern.llm.source_mix import fair_queue, mixed_documents
from quern.session import shared_dir, table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, h int"
LONG = "A line that is long enough to count 1"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), "x", 1) for i, t, s in rows], DOCS)


def odd_docs(spark):
    return docs(spark, [
        (1, f"{LONG}\nshort\n\n{LONG.upper()}", "b"), (2, f"  {LONG}\t\nother words that are only once here", "a"), (3, LONG, None), (4, None, "a"), (5, "", "b"),
        (6, "\n".join([f"line number {k} with its own words" for k in range(150)] + [LONG] * 3), "c"), (7, "é" * 25, "c"), (8, "É" * 25, "c"), (9, "é" * 25, "c"), (10, "é" * 25, ""),
        (11, "w x y z v w x y z v w x y z v", "b"), (12, " \t\n", "a"), (13, "a " * 5000, "a"), (None, LONG, "a"),
    ])


def py_lines(rows):
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= 20:
                    held[key(x)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i is None or len(held[key(x)]) < 3 or max(held[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(keep), "\n".join(keep))
    return out


def check_lines(d):
    got = {r.doc_id: (r._n_lines, r._n_dropped, r.text or "") for r in keep_lines(d, line_bitmaps(d)).collect()}
    assert got == py_lines([(r.doc_id, r.text) for r in d.collect()])
    return got


def test_lines(spark, sf):
    got = check_lines(odd_docs(spark))
    assert got[1] == (4, 2, "short\n") and got[6][1] == 0
    check_lines(table(spark, sf, "documents"))
    d = odd_docs(spark).limit(0)
    assert keep_lines(d, line_bitmaps(d)).count() == 0


def py_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        free = sum(w[s] for s in names if s not in full)
        t = {s: cap * sizes[s] if s in full else left * w[s] / free for s in names}
        if not (over := {s for s in names if s not in full and t[s] > cap * sizes[s]}):
            return t
        full |= over


def py_queue(rows, target, cap=3, packets=1024):
    """(size, source_size, taken) of each (id, source, text), by a queue of entries in plain Python."""
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size = {i: words(t) for i, _, t in rows}
    sizes = Counter()
    for i, s, _ in rows:
        sizes[s] += size[i]
    budget, entries = sum(sizes.values()), []
    for nr, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode()))):
        at = 0
        for _ in range(cap):
            for i in sorted((i for i, x, _ in rows if x == s), key=lambda i: (hashlib.md5(f"1:{i}".encode()).hexdigest(), i)):
                width = size[i] if at + size[i] <= target[s] else -(-size[i] // packets)
                for k in range(0, size[i], max(width, 1)):
                    if at + k < target[s]:
                        n = min(width, size[i] - k)
                        entries.append(((at + k + n) * budget / target[s], nr, at + k, i, n))
                at += size[i]
    taken, served = Counter(), 0
    for _, _, _, i, n in sorted(entries):
        taken[i] += max(0, min(n, budget - served))
        served += n
    return {i: (size[i], sizes[s], taken[i]) for i, s, _ in rows}


def test_queue_of_copies(spark, sf):
    """op3: every document's words against a queue in plain Python, on unique ids."""
    for d in (odd_docs(spark).where("doc_id is not null"), table(spark, sf, "documents")):
        rows = [(r.doc_id, r.source, r.text) for r in d.collect()]
        got = fair_queue(d).collect()
        want = py_queue(rows, {r.source: r.target for r in got})
        assert {r.id: (r.size, r.source_size, r.taken) for r in got} == want and len(got) == len(rows)
        assert sum(r.taken for r in got) == sum(r.size for r in got)


def test_mix(spark, sf):
    for d in (odd_docs(spark), table(spark, sf, "documents")):
        rows, texts = fair_queue(d).collect(), d.select("doc_id", "source", "text").collect()
        words = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in texts}
        assert {r.id: r.size for r in rows} == words and len(rows) == len(texts)
        sizes, taken, longest = Counter(), Counter(), max(words.values())
        for r in rows:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            assert 0 <= r.taken <= 3 * r.size
        want = py_targets(sizes)
        for r in rows:
            assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9)
        for s in sizes:
            assert abs(taken[s] - want[s]) <= 1 + longest / 1024
        assert sorted(map(str, rows)) == sorted(map(str, fair_queue(d.orderBy(F.desc("doc_id"))).collect()))
        out = mixed_documents(d)
        assert out.columns == d.columns
        got = Counter()
        for r in out.collect():
            got[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert all(got[s] == taken[s] for s in sizes)
    assert fair_queue(odd_docs(spark).limit(0)).count() == 0 and mixed_documents(odd_docs(spark).limit(0)).count() == 0


def test_mix_stages_few_files(spark):
    """A table with a row per source is one file, and the queue is staged once: each file costs executors a process."""
    many = docs(spark, [(k, "a b c " * (k % 7), f"s{k % 8}") for k in range(800)])
    folder = Path(shared_dir(spark).removeprefix("file://"), "quern")
    before = set(folder.iterdir()) if folder.exists() else set()
    assert fair_queue(many).count() == 800
    tables = [list(t.glob("*.parquet")) for t in set(folder.iterdir()) - before]
    assert all(len(files) == 1 for files in tables if sum(pq.ParquetFile(f).metadata.num_rows for f in files) <= 8)
    assert len(tables) <= 9


def test_mix_of_rows_alike(spark):
    same = docs(spark, [(1, "a b c", "a"), (1, "a b c", "a"), (2, "d e", "b")])
    assert sum(r.taken for r in fair_queue(same).collect()) == 8
    many = docs(spark, [(1, f"a b {k // 40}", "a") for k in range(120)] + [(None, "d e f g", "b")] * 30 + [(3, "x y", None)])
    many = many.withColumns({x: F.lit(1) for x in ("_size", "_n", "_i", "_key", "_full", "_part", "_left", "start", "taken")})
    taken = Counter()
    for r in fair_queue(many).collect():
        taken[r.source] += r.taken
    out = mixed_documents(many).collect()
    assert all(len(r) == len(many.columns) for r in out)
    got = Counter()
    for r in out:
        got[r.source] += len(r.text.split())
    assert got == +taken and sum(got.values()) == 482


def py_chats(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn, role, text))
    key = lambda x: tuple((v is not None, v if v is not None else 0) if i == 0 else (v is not None, v or "") for i, v in enumerate(x))
    lists = {c: [(r, t) for _, r, t in sorted(v, key=key)] for c, v in convs.items()}
    out = {}
    for c, v in lists.items():
        if not any((len(o) > len(v) and o[: len(v)] == v) or (o == v and k < c) for k, o in lists.items() if k != c):
            out[c] = (len(v), "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in v))
    return out


def test_chats(spark, sf):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "assistant", "b"), (3, 0, "user", "a"), (3, 1, "assistant", "b"), (4, 0, "user", "a"), (4, 1, "assistant", "c"), (5, None, None, None), (6, 0, "user", ""), (6, 0, "assistant", "x"), (None, 0, "user", "z"), (7, 0, "user", None), (7, 1, "user", "q"), (8, 0, "user", ""), (8, 1, "user", "q")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: (r.n_turns, r.text) for r in format_chats(d).collect()}
    assert got == py_chats(rows) and set(got) == {2, 4, 5, 6, 7, 8}
    assert format_chats(d.limit(0)).count() == 0
    t = table(spark, sf, "conversations")
    assert {r.conv_id: (r.n_turns, r.text) for r in format_chats(t).collect()} == py_chats([tuple(r) for r in t.select("conv_id", "turn", "role", "text").collect()])


def py_measures(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    n = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def test_measures(spark, sf):
    for d in (odd_docs(spark), table(spark, sf, "documents")):
        got = {r.id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in measures(d).collect()}
        assert got == {r.doc_id: py_measures(r.text) for r in d.select("doc_id", "text").collect()}


def test_rules_hold_their_risk(spark):
    good = [(i, f"word{i} " + " ".join(f"t{i}x{k}" for k in range(30)) + (" #" * 3 if i % 200 == 0 else ""), "a") for i in range(800)]
    bad = [(1000 + i, " ".join(f"z{i}y{k} ##" for k in range(30)), "a") for i in range(20)]
    d = docs(spark, good + bad)
    labels = spark.createDataFrame([(i, 1) for i, _, _ in good] + [(i, 0) for i, _, _ in bad], "doc_id long, quality int")
    rows = apply_rules(d, labels).collect()
    assert all(not r.kept for r in rows if r.id >= 1000)
    n, k = 800, sum(not r.kept for r in rows if r.id < 1000)
    assert k <= 4
    p = 0.02
    assert sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1)) <= 0.05 / 7
    none = apply_rules(d, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in none)


def test_sha(spark):
    d = odd_docs(spark)
    r = keep_lines(d, line_bitmaps(d)).where("doc_id = 4").select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("s")).first()
    assert r.s == hashlib.sha256(b"").hexdigest()
