"""Repeated byte strings against a brute-force version."""
import hashlib
import random
from collections import Counter

import numpy as np

from feedloom.llm import queries as Q
from feedloom.llm import suffix_dedup as S


def slow(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        hit = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                hit[i:i + length] = b"\1" * length
        kept = bytes(c for c, h in zip(d, hit) if not h)
        runs = sum(1 for i, h in enumerate(hit) if h and (i == 0 or not hit[i - 1]))
        out.append((len(d), len(d) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_two_stage_order_is_the_suffix_array():
    rnd = random.Random(5)
    for alphabet in (b"ab", b"abcd", b"a", bytes(range(256))):
        for _ in range(30):
            segs = [bytes(rnd.choice(alphabet) for _ in range(rnd.randrange(1, 40))) for _ in range(6)]
            text, ends = b"".join(segs), np.cumsum([len(s) for s in segs])
            owner = ends[np.searchsorted(ends, np.arange(len(text)), side="right")]
            got = S.two_stage_order(text, ends, ends - [len(s) for s in segs], ends)
            assert sorted(got) == list(range(len(text)))
            suffix = [text[i:owner[i]] for i in got]
            assert suffix == sorted(suffix)
            want = [next((k for k in range(40) if k >= min(len(x), len(y)) or x[k] != y[k])) for x, y in zip(suffix, suffix[1:])]
            assert S.common_prefixes(text, np.array(got), ends, 24).tolist() == [min(w, 24) for w in want]


def mixed_texts(rnd):
    words = [f"{rnd.choice('bcdfg')}{rnd.choice('aeiou')}{i}é" for i in range(400)]
    make = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passages = [make(n) for n in (30, 45, 60, 90)] + ["ab" * 300, "x" * 500]
    texts = [None, "", "short", "y" * 199, "y" * 200, "z" * 201]
    for _ in range(60):
        t = [make(rnd.randrange(5, 60))]
        for _ in range(rnd.randrange(0, 3)):
            p = rnd.choice(passages)
            i = rnd.randrange(0, 60)
            t += [p[i:], make(rnd.randrange(0, 9))]
        texts.append(" ".join(t))
    return texts + [texts[10]] * 4 + [texts[11] + "!", "?" + texts[11]]


def check(spark, texts, monkeypatch=None, **over):
    ids = [None if i == 7 else i // 2 for i in range(len(texts))]  # nulls and shared ids
    df = spark.createDataFrame(list(zip(ids, texts, range(len(texts)))), "doc_id long, text string, key long")
    got = sorted((r.did is None, r.did, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(df).collect())
    want = sorted((d is None, d, *x) for d, x in zip(ids, slow(texts, 200)))
    assert got == want
    assert any(r[3] for r in got) and any(not r[3] for r in got)


def test_against_brute_force(spark):
    check(spark, mixed_texts(random.Random(11)))


def test_hot_grams_are_split(spark, monkeypatch):
    rnd = random.Random(13)
    line = " ".join(f"line{i}" for i in range(30))  # 199 bytes and more around many different texts
    texts = [f"{rnd.random()} {rnd.choice(['x', 'yy'])} {line[:rnd.choice([150, 190, 209])]} {rnd.choice(['p', 'q'])} {rnd.random()} end" for _ in range(120)]
    for limit in (30, 5, 1):  # whole groups, offset ranges, single windows
        monkeypatch.setattr(S.repeated_intervals, "__defaults__", (200, 48, limit))
        check(spark, texts + [None, ""])


def test_long_text_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 1000)
    rnd = random.Random(17)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(5000))
    rows, bs = [], long.encode()
    for size in (1000, 1 << 20):
        monkeypatch.setattr(S, "BLOCK", size)
        import pyarrow as pa
        b = pa.record_batch([pa.array([1]), pa.array([2], pa.int32()), pa.array([long])], names=["uid", "th", "text"])
        out = [r for x in S._anchor_stage(200, 48)([b]) for r in x.to_pylist()]
        cover = sorted((r["a"] + i, r["key"]) for r in out for i in range(r["more"] + 1))
        rows.append(cover)
    assert rows[0] == rows[1] and len(rows[0]) == len(bs) - 199


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    got = Q.queries()["op6_suffix_dedup"](spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    want = slow([d.text for d in docs], 200)
    assert [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == [(d.doc_id, *w) for d, w in zip(docs, want)]
