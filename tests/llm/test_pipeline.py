"""The pipeline's stages on small tables."""

import re
from collections import Counter

import corpus_pipeline
from quern.session import stage, table


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    seen = {}
    for name, f in corpus_pipeline.STAGES:
        before, docs = docs, stage(f(spark, docs, sf), name)
        seen[name] = docs
        if name != "pack":
            assert docs.columns == before.columns and docs.schema == before.schema
    raw = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    good = {r.doc_id: r.text for r in seen["quality"].collect()}
    assert set(good) <= set(raw) and all(raw[i] == t for i, t in good.items())
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    held = Counter()
    last = {}
    for i, t in good.items():
        for k in {key(x) for x in t.split("\n")}:
            held[k] += 1
            last[k] = max(i, last.get(k, i))
    lines = {r.doc_id: r.text for r in seen["lines"].collect()}
    assert lines == {i: "\n".join(x for x in t.split("\n") if len(key(x)) < 20 or held[key(x)] < 3 or last[key(x)] == i) for i, t in good.items()}
    near = [r.doc_id for r in seen["near_duplicates"].collect()]
    assert len(near) == len(set(near)) and set(near) <= set(lines)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    mixed = seen["mix"].collect()
    total = sum(words(lines[i]) for i in near)
    assert abs(sum(words(r.text) for r in mixed) - total) <= 40 and all(lines[r.doc_id].startswith(r.text) for r in mixed)
    tokens = Counter()
    for r in seen["pack"].collect():
        tokens[r.sequence_id] += r.length
    assert max(tokens.values()) <= 2048
