"""SimHash groups against a brute-force version."""
import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from feedloom.llm import queries as Q
from feedloom.llm import simhash_vp as S


def slow_simhash(text, k=3):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    import re
    words = [w for w in re.split("[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups(ids, fps, bits):
    comp = {i: i for i in range(len(ids))}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a, b in itertools.combinations(range(len(ids)), 2):
        if bin(fps[a] ^ fps[b]).count("1") <= bits:
            comp[find(a)] = find(b)
    best = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            best[r] = min(best.get(r, d), d)
    return [best.get(find(i)) for i in range(len(ids))]


def test_shard_links_cover_every_pair():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 400, dtype=np.uint64)
    near = base[:200] ^ (np.uint64(1) << rng.integers(0, 63, 200, dtype=np.uint64))
    fps = np.unique(np.concatenate([base, near, near ^ np.uint64(6)]))
    tree = S.router(fps[::3], 4)
    shard, idx, home = S.route(tree, fps, 3)
    assert sorted(idx[home]) == list(range(len(fps)))
    comp = {int(f): int(f) for f in fps}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for s in np.unique(shard):
        m = shard == s
        for u, v in zip(*S.shard_links(fps[idx[m]], home[m], 3)):
            comp[find(int(u))] = find(int(v))
    want = groups(list(range(len(fps))), [int(f) for f in fps], 3)
    got = {}
    for i, f in enumerate(fps):
        got.setdefault(find(int(f)), []).append(i)
    exp = {}
    for i, w in enumerate(want):
        exp.setdefault(w, []).append(i)
    assert sorted(got.values()) == sorted(exp.values())


def test_groups_match_brute_force(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(40):
        t = [rnd.choice(words) for _ in range(120)]
        texts.append(" ".join(t))
        for _ in range(3):
            u = list(t)
            u[rnd.randrange(120)] = "edit"
            texts.append(" ".join(u))
    texts += [None, "", "  \n", "One two", "ONE  two", "é È"] + [texts[0]] * 30
    rows = [(i * 7 % 1000, t, i) for i, t in enumerate(texts)] + [(None, texts[5], 1), (None, "lone row of words", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    got = {(r.did, r.fp & (2 ** 64 - 1), r.component_id) for r in S.near_duplicates(df).collect()}
    ids, fps = [r[0] for r in rows], [slow_simhash(r[1]) for r in rows]
    assert got == set(zip(ids, fps, groups(ids, fps, 3)))


def test_queries_in_blocks_lose_no_link(spark, monkeypatch):
    rnd = random.Random(12)
    fps = [rnd.getrandbits(64) for _ in range(1500)]
    fps += [f ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for f in fps[:700]]
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in set(fps)], "fp long")
    whole = {(r.node, r.root) for r in S.components(S.links(df)).collect()}
    monkeypatch.setattr(S, "QUERY_BLOCK", 40)
    made = []
    monkeypatch.setattr(S, "query_blocks", lambda *a, f=S.query_blocks: made.append(f(*a)) or made[-1])
    assert {(r.node, r.root) for r in S.components(S.links(df)).collect()} == whole and made[0] > 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).count() == 0


def test_query(spark):
    df = Q.queries()["op7_simhash_groups"](spark, "/root/testdata/sf0.001")
    rows = df.orderBy("doc_id").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    fps = [slow_simhash(d.text) for d in docs]
    want = groups([d.doc_id for d in docs], fps, 3)
    assert [(r.doc_id, r.fingerprint, r.component_id) for r in rows] == \
        [(d.doc_id, f"{f:016x}", w) for d, f, w in zip(docs, fps, want)]
    assert df.select(F.col("fingerprint")).dtypes == [("fingerprint", "string")]
