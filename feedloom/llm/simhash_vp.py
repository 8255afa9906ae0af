"""SimHash near-duplicate groups through a sharded vantage-point tree.

Every text gets a 64-bit SimHash of its word shingles.  Distinct fingerprints
are partitioned by a vantage-point tree fitted on a bounded sample: at each
node a fingerprint goes to the inner side (distance to the vantage point at
most ``mu``) or the outer side, and, as a query, also to the other side when
the triangle inequality allows a partner there (within ``max_bits`` of the
boundary).  So every pair within ``max_bits`` meets in the home shard of both
of its members.  A shard's queries are dealt in blocks, each of which meets its
home members in one task.  There the same partition goes on in memory down to
small leaves, which are compared in full.  A shard returns a spanning forest
of its links, never its pairs; the forests are joined into components by
alternating star contraction.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_map, corpus, keep, slices
from feedloom.session import ship_package

#: Seed of the shingle hash (XXH64).
SEED = 42
#: Fingerprints per shard the router aims at.
SHARD_TARGET = 20_000
#: Deepest router: at most 2**MAX_LEVELS shards, and SAMPLE_PER_SHARD times as many sampled fingerprints on the driver.
#: With more fingerprints shards hold more home members (8 bytes each), and more blocks of queries meet them.
MAX_LEVELS = 12
SAMPLE_PER_SHARD = 16
#: Queries that meet a shard's home members in one task, on average.
QUERY_BLOCK = 1 << 20
#: Leaves of the in-memory tree, compared in full.
LEAF = 192
_MIX = np.uint64(0x9E3779B97F4A7C15)


def simhash(text: str, shingle: int = 3) -> int:
    """64-bit SimHash: A-Z lower-cased, words between ASCII white space,
    shingles of ``shingle`` words with repeats; a bit is set when more than
    half of the shingle hashes have it.  No word: zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(did, th, fp)`` per document: id, a hash of the text, and the SimHash
    as a signed long.  Null and empty texts and texts of white space have
    fingerprint zero."""
    def run(batches):
        for b in slices(batches):
            fps = np.fromiter((simhash(t, shingle) for t in b.column("text").to_pylist()), dtype=np.uint64, count=b.num_rows)
            yield pa.record_batch([b.column("did"), b.column("th"), pa.array(fps.view(np.int64))], names=["did", "th", "fp"])

    rows = corpus(docs, id_col, text_col).select("did", F.xxhash64("text").alias("th"), "text")
    return arrow_map(rows, run, "did long, th long, fp long")


# ------------------------------------------------------------------ tree
def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _split(points: np.ndarray, rng: np.random.Generator):
    """Vantage point and radius of a node; None if no radius separates the points.

    Of a few vantage points and the radii that leave each side at least a
    quarter, the one with the fewest points near the boundary is taken."""
    best = None
    for vp in points[rng.integers(0, len(points), 6)]:
        hist = np.bincount(_distance(points, vp), minlength=65)
        below = np.cumsum(hist)
        for mu in range(64):
            if min(below[mu], len(points) - below[mu]) * 4 >= len(points):
                near = hist[max(0, mu - 2):mu + 4].sum()
                if best is None or near < best[0]:
                    best = (near, vp, mu)
    if best is None:
        vp = points[0]
        d = _distance(points, vp)
        if d.min() == d.max():
            return None
        return vp, int((int(d.min()) + int(d.max())) // 2)
    return best[1], best[2]


def router(sample: np.ndarray, levels: int) -> list:
    """Nested list tree: ``[vp, mu, inner, outer]`` or a shard number."""
    rng, shards = np.random.default_rng(SEED), iter(range(1 << 30))

    def grow(points, level):
        cut = _split(points, rng) if level < levels and len(points) >= 8 else None
        if cut is None:
            return next(shards)
        vp, mu = cut
        inside = _distance(points, vp) <= mu
        return [int(vp), mu, grow(points[inside], level + 1), grow(points[~inside], level + 1)]

    return grow(sample, 0)


def route(tree, fps: np.ndarray, max_bits: int):
    """``(shard, index, home)`` arrays: each fingerprint in its home shard, and
    as a query in every shard that may hold a partner."""
    out = []

    def walk(node, idx, home):
        if not len(idx):
            return
        if not isinstance(node, list):
            out.append((np.full(len(idx), node, dtype=np.int32), idx, home))
            return
        vp, mu, inner, outer = node
        d = _distance(fps[idx], np.uint64(vp)).astype(np.int16)
        inside = d <= mu
        to_in, to_out = d <= mu + max_bits, d >= mu + 1 - max_bits
        walk(inner, idx[to_in], (home & inside)[to_in])
        walk(outer, idx[to_out], (home & ~inside)[to_out])

    walk(tree, np.arange(len(fps)), np.ones(len(fps), dtype=bool))
    return [np.concatenate(x) for x in zip(*out)]


class _Forest:
    """Union-find over array positions, vectorised over link batches."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        r = self.parent[x]
        while True:
            up = self.parent[r]
            if np.array_equal(up, r):
                return r
            r = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            differ = a != b
            if not differ.any():
                return
            lo, hi = np.minimum(a, b)[differ], np.maximum(a, b)[differ]
            # hook each larger root under the smallest root it meets; what is left goes round again
            order = np.lexsort((lo, hi))
            lo, hi = lo[order], hi[order]
            first = np.r_[True, hi[1:] != hi[:-1]]
            self.parent[hi[first]] = lo[first]
            a, b = lo[~first], hi[~first]


def shard_links(fps: np.ndarray, home: np.ndarray, max_bits: int, query: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between a shard's queries (all members if
    not given) and its home members."""
    forest, rng = _Forest(len(fps)), np.random.default_rng(SEED)
    stack = [(np.arange(len(fps)) if query is None else np.flatnonzero(query), np.flatnonzero(home))]
    while stack:
        q, h = stack.pop()
        if not len(q) or not len(h):
            continue
        cut = _split(fps[h] if len(h) <= 4096 else fps[rng.choice(h, 4096, replace=False)], rng) if len(h) > LEAF else None
        if cut is None:
            step = max(1, 2_000_000 // len(h))
            for i in range(0, len(q), step):
                a, b = np.nonzero(_distance(fps[q[i:i + step], None], fps[None, h]) <= max_bits)
                forest.link(q[i:i + step][a], h[b])
            continue
        vp, mu = cut
        dq, dh = _distance(fps[q], vp).astype(np.int16), _distance(fps[h], vp)
        stack.append((q[dq <= mu + max_bits], h[dh <= mu]))
        stack.append((q[dq >= mu + 1 - max_bits], h[dh > mu]))
    roots = forest.roots(np.arange(len(fps)))
    member = np.flatnonzero(roots != np.arange(len(fps)))
    return fps[member], fps[roots[member]]


# ------------------------------------------------------------- distributed
def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Spanning links ``(u, v)`` between distinct fingerprints ``fp`` that are
    connected through pairs at most ``max_bits`` apart.  Complete: no link is
    lost; sharding is by the router described above."""
    n = distinct.count()
    levels = min(MAX_LEVELS, max(3, int(np.ceil(np.log2(max(1, n / SHARD_TARGET))))))
    bound = SAMPLE_PER_SHARD << levels  # at most 65,536 fingerprints reach the driver
    picked = distinct.orderBy(F.xxhash64("fp"), "fp").limit(bound).collect()
    sample = np.array([r.fp for r in picked], dtype=np.int64).view(np.uint64)
    tree = router(sample, levels) if picked else 0
    blocks = query_blocks(tree, sample, n, max_bits)

    def deal(batches):
        for b in batches:
            fps = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(fps):
                continue
            shard, idx, home = route(tree, fps, max_bits)
            block = ((fps[idx] * _MIX) >> np.uint64(32)) % np.uint64(blocks)
            for k in range(blocks):  # queries in their block, home members in all
                query = block == k
                at = np.flatnonzero(query | home)
                yield pa.record_batch([pa.array(shard[at]), pa.array(np.full(len(at), k, dtype=np.int32)), pa.array(fps[idx[at]].view(np.int64)),
                                       pa.array(home[at]), pa.array(query[at])], names=["shard", "block", "fp", "home", "query"])

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        u, v = shard_links(pdf["fp"].to_numpy().view(np.uint64), pdf["home"].to_numpy(), max_bits, pdf["query"].to_numpy())
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    ship_package(distinct.sparkSession)
    return arrow_map(distinct.select("fp"), deal, "shard int, block int, fp long, home boolean, query boolean") \
        .groupBy("shard", "block").applyInPandas(search, "u long, v long")


def query_blocks(tree, sample: np.ndarray, n: int, max_bits: int) -> int:
    """Blocks of about QUERY_BLOCK queries in the shard that most of the sample visits, at ``n`` fingerprints."""
    if not len(sample):
        return 1
    shard, _, _ = route(tree, sample, max_bits)
    return max(1, int(np.ceil(np.bincount(shard).max() / len(sample) * n / QUERY_BLOCK)))


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of the undirected edges ``(u, v)`` by alternating
    large-star and small-star steps; one checkpoint a round, until the edge
    set stands still.  Rows per round stay at most the number of edges."""
    edges = keep(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                            F.col("m").alias("v"))
        edges = keep(small.unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: ``did``, ``th`` (hash of its text), ``fp`` (signed
    long), ``root`` (a fingerprint that names the group) and ``component_id``.

    ``component_id`` is the smallest id reachable through pairs of
    fingerprints at most ``max_bits`` apart, the document's own included.
    Copies share a fingerprint and so never become pairs.  Null texts count
    as empty (fingerprint zero, linked like any other).  Null ids keep their
    row; a group of null ids alone has a null ``component_id``.  Repeated
    rows keep one output row each.  An empty table gives no rows.
    """
    prints = keep(fingerprints(docs, shingle, id_col, text_col))
    firsts = keep(prints.groupBy("fp").agg(F.min("did").alias("first_id")))
    found = components(links(firsts.select("fp"), max_bits))
    rooted = firsts.join(found.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = keep(rooted.join(least, "root").select("fp", "root", "component_id"))
    return prints.join(labels, "fp").select("did", "th", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the
    smallest id (null ids last, then by a hash of the text); of equal rows one."""
    groups = near_duplicates(docs, shingle, max_bits, id_col, text_col)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("did").isNull().alias("null"), "did", "th")).alias("k")).select("k.did", "k.th")
    tagged = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("did"),
                         F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"))
    met = tagged.join(first.withColumnsRenamed({"did": "d", "th": "t"}), F.col("did").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")), "left_semi")
    return met.groupBy("did", "th").agg(F.first("row").alias("row")).select("row.*")
