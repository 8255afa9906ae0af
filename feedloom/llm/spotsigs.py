"""SpotSigs fingerprints: chains of content words behind common-word anchors.

At every anchor (a common word) the next ``CHAIN`` words that are not anchors
form a signature.  A text's fingerprint is its set of signature hashes, and
likeness is the Jaccard similarity of two sets.  Near duplicates are found
within partitions of similar set length: a pair can only reach the threshold
when the shorter set has at least that share of the longer one's size, so
only neighbouring partitions meet.  Inside, sets meet on their rarest
signatures (enough of them that no pair above the threshold is missed), and
Jaccard counting stops as soon as the threshold is out of reach.
"""
from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_map, corpus, keep, slices, stored
from feedloom.llm.simhash_vp import components

#: Common words that anchor signatures (English, German, French, Spanish).
ANCHORS = frozenset("""a an and are as at be by for from in is it of on or that the this to was were will with
aber als auch auf aus bei das dem den der des die ein eine einen er es für im ist mit nicht sich sie um und von zu
au avec ce dans de des du elle en est et il la le les ne par pas pour que qui se sur un une
con del el las lo los no para pero por se su una y""".split())
#: Content words per signature.
CHAIN = 2
#: Likeness of near duplicates.
THRESHOLD = 0.8
#: Sampled ids per range of documents in id order.
SAMPLE_PER_RANGE = 16
#: Sets of one signature and length partition that meet all others of it in one block.
BUCKET = 500
#: Sets, at most about, whose signatures are counted to order them, and how many of the most frequent ones are told apart.
SAMPLE_SETS = 50_000
FREQUENT = 65_536
#: Turns in which each set is compared with so many next ones of a bucket.
TURNS, NEXT = 2, 2
#: Values counted before it is asked again whether the threshold is in reach.
COUNTED = 32

_WORD = regex.compile(r"[\p{L}\p{N}]+")


def _hash(*words: str) -> int:
    return xxhash.xxh32_intdigest("\0".join(words).encode("utf-8", "surrogatepass"))


def signatures(text: str, chain: int = CHAIN) -> frozenset[int]:
    """Signature hashes (32 bits) of a text.  Without a whole chain behind an
    anchor every word is an anchor; with too few words for that the words as
    a whole are the signature, without any the text is; an empty text has none."""
    words = _WORD.findall(text.lower())
    out, after = set(), []
    for w in reversed(words):
        if w in ANCHORS:
            if len(after) == chain:
                out.add(_hash(w, *after))
        else:
            after = [w, *after[:chain - 1]]
    if not out and len(words) > chain:
        out = {_hash(*words[i:i + chain + 1]) for i in range(len(words) - chain)}
    if not out and text:
        out = {_hash(*words) if words else _hash(text)}
    return frozenset(out)


def likeness(a: frozenset, b: frozenset) -> float:
    """Jaccard similarity; two empty sets are alike."""
    both = len(a & b)
    return both / (len(a) + len(b) - both) if a or b else 1.0


def fingerprint(sigs: frozenset[int]) -> str:
    """The set as text: eight hexadecimal digits per signature, ascending."""
    return np.sort(np.fromiter(sigs, dtype=np.uint32, count=len(sigs))).astype(">u4").tobytes().hex()


# ----------------------------------------------------- neighbours in id order
def _neighbour_stage():
    schema = pa.schema([("did", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def row(did, text, sigs, nxt, nxt_sigs):
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        es = signatures(edited) if edited != text else sigs
        return (did, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(sigs), fingerprint(es),
                likeness(sigs, es), likeness(sigs, nxt_sigs))

    def run(batches):
        held = None  # bucket, id, text, signatures of the row that waits for its next one
        for b in slices(batches):
            out = []
            for bucket, tail, did, text in zip(*(b.column(c).to_pylist() for c in ("bucket", "tail", "did", "text"))):
                sigs = signatures(text)
                if held is not None and held[0] == bucket:
                    out.append(row(*held[1:], text, sigs))
                held = None if tail else (bucket, did, text, sigs)
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return run


def range_cuts(rows: DataFrame, n: int) -> list[tuple[int, int]]:
    """At most ``n - 1`` pairs (k, th), ascending, that cut the rows into about equal ranges: quantiles of a sample by hash."""
    total = rows.count()
    share = min(1.0, n * SAMPLE_PER_RANGE / max(1, total))
    picked = rows.select("k", "th").filter(F.pmod(F.xxhash64(F.lit("cut"), "k", "th"), F.lit(1_000_000)) < share * 1_000_000) if share < 1 else rows.select("k", "th")
    sample = sorted((r.k, r.th) for r in picked.distinct().collect())
    return sorted({sample[len(sample) * i // n] for i in range(1, n)}) if sample else []


def _above(cuts: list[tuple[int, int]]):
    """How many of the cuts are above a row's (k, th): first among every so many, then inside one such block."""
    if not cuts:
        return F.lit(0)
    at = F.struct("k", "th")
    as_array = lambda cs: F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(h).cast("long").alias("th")) for k, h in cs])
    size = math.isqrt(len(cuts)) + 1
    blocks = [cuts[i:i + size] for i in range(0, len(cuts), size)]
    # the block that holds the last cut at or below the row: cuts of later blocks are above it
    block = F.greatest(F.lit(0), F.size(F.filter(as_array([b[0] for b in blocks]), lambda c: c <= at)) - 1)
    behind = F.get(F.array(*[F.lit(len(cuts) - (i + 1) * size if (i + 1) * size < len(cuts) else 0) for i in range(len(blocks))]), block)
    return (behind + F.size(F.filter(F.get(F.array(*[as_array(b) for b in blocks]), block), lambda c: c > at))).cast("int")


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Each document against its edited text and its next document.

    The next document is the one with the next smaller id (null ids are the
    smallest; rows of one id go by a hash of their text; after the last comes
    the first).  The edited text has the last half of the code points
    replaced by as many of the next document's first ones.  One row per input
    row: ``did``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.  Null texts count
    as empty; a lone document is its own next one; an empty table gives no rows.

    Rows are cut into ranges of (id, hash of the text) at quantiles of a sample,
    so that rows without ids are many ranges; a range is sorted and read
    through in one task, and the first row of the range that follows is dealt
    to it as well.  The driver sees SAMPLE_PER_RANGE ids per range.
    """
    spark = docs.sparkSession
    rows = corpus(docs, id_col, text_col).withColumn("k", F.coalesce("did", F.lit(-(2 ** 63)).cast("long"))).withColumn("th", F.xxhash64("text"))
    n = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("bucket", _above(range_cuts(rows, n)))
    heads = sorted((r.bucket, r.m.k, r.m.th) for r in dealt.groupBy("bucket").agg(F.max(F.struct("k", "th")).alias("m")).collect())
    if not heads:
        before = F.lit(None).cast("int")
    else:
        # the first row of each range also ends the range before it; the very first one ends the last
        known = F.create_map(*[x for (_, k, th), p in zip(heads, [heads[-1], *heads])
                               for x in (F.struct(F.lit(k).cast("long").alias("k"), F.lit(th).cast("long").alias("th")), F.lit(p[0]).cast("int"))])
        # only a range's own first row is looked up
        own = F.get(F.array(*[F.lit(th).cast("long") for th in _by_bucket(heads)]), F.col("bucket")) == F.col("th")
        before = F.when(own, F.element_at(known, F.struct("k", "th")))
    places = F.array_compact(F.array(F.struct(F.col("bucket").cast("int").alias("bucket"), F.lit(False).alias("tail")),
                                     F.when(before.isNotNull(), F.struct(before.alias("bucket"), F.lit(True).alias("tail")))))
    ranged = dealt.select("did", "k", "th", "text", F.explode(places).alias("p")).select("did", "k", "th", "text", "p.*") \
        .repartition("bucket").sortWithinPartitions("bucket", "tail", F.col("k").desc(), F.col("th").desc())
    return arrow_map(ranged.select("bucket", "tail", "did", "text"), _neighbour_stage(),
                     "did long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _by_bucket(heads: list[tuple[int, int, int]]) -> list[int | None]:
    """The hash of each range's first row, by range; None for ranges without rows."""
    found = {b: th for b, _, th in heads}
    return [found.get(b) for b in range(max(found) + 1)]


# ------------------------------------------------------------ near duplicates
def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(did, sigs)`` per document; ``sigs`` is the ascending signature array."""
    def run(batches):
        for b in slices(batches):
            sets = [np.sort(np.fromiter(s, dtype=np.int64, count=len(s))) for s in map(signatures, b.column("text").to_pylist())]
            yield pa.record_batch([b.column("did"), pa.array(sets, pa.list_(pa.int64()))], names=["did", "sigs"])

    return arrow_map(corpus(docs, id_col, text_col), run, "did long, sigs array<bigint>")


def pruned_jaccard(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Whether two ascending sets reach the threshold.  Lengths decide first;
    then values are counted in blocks, and counting stops as soon as all that is
    left could not make up for what is missing."""
    if min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    need = threshold / (1 + threshold) * (len(a) + len(b)) - 1e-9
    both = i = j = 0
    while i < len(a) and j < len(b):
        if both + min(len(a) - i, len(b) - j) < need:
            return False
        part = a[i:i + COUNTED]
        end = int(np.searchsorted(b, part[-1], "right"))
        both += len(np.intersect1d(part, b[j:end], assume_unique=True))
        i, j = i + len(part), end
    return both >= need


def frequent(sets: DataFrame) -> np.ndarray:
    """The FREQUENT most frequent signatures of about SAMPLE_SETS sets, rarest first.  They only steer the
    order in which sets meet on their signatures; any order leads to the same groups."""
    share = min(1.0, SAMPLE_SETS / max(1, sets.count()))
    picked = sets.filter(F.pmod("fid", F.lit(1_000_000)) < share * 1_000_000).select(F.explode("sigs").alias("sig"))
    top = picked.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").orderBy(F.desc("df"), "sig").limit(FREQUENT).collect()
    return np.array([r.sig for r in reversed(top)], dtype=np.int64)


def _place_stage(hot: np.ndarray, threshold: float):
    """Rows of the signatures on which sets meet: a pair above the threshold shares one of
    the first n - ceil(t n) + 1, in one order for all sets (signatures that are not frequent come first)."""
    by_value = np.argsort(hot)
    known, ranks = hot[by_value], by_value + 1

    def run(batches):
        for b in slices(batches):
            n = pc.list_value_length(b.column("sigs")).to_numpy(zero_copy_only=False).astype(np.int64)
            values = b.column("sigs").flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(n)), n)
            rank = np.zeros(len(values), dtype=np.int64)
            if len(known):
                at = np.minimum(np.searchsorted(known, values), len(known) - 1)
                rank = np.where(known[at] == values, ranks[at], 0)
            pos = np.arange(len(values)) - np.repeat(np.cumsum(n) - n, n)
            taken = pos < (n - np.ceil(n * threshold - 1e-9).astype(np.int64) + 1)[row]
            sig, row, pos = values[np.lexsort((values, rank, row))][taken], row[taken], pos[taken]
            part = np.floor(np.log(n) / -math.log(threshold) + 1e-9).astype(np.int64)[row]
            fid = b.column("fid").to_numpy(zero_copy_only=False)[row]
            for own in (True, False):
                yield pa.record_batch([pa.array((part + (not own)) << 32 | sig), pa.array(fid), pa.array(n[row].astype(np.int32)), pa.array(pos.astype(np.int32)),
                                       pa.array(np.full(len(row), own))], names=["bucket", "fid", "n", "pos", "own"])

    return run


def _in_reach(a: Column, b: Column, threshold: float) -> Column:
    """Whether two sets of different groups that meet on their first common signature can reach the threshold by
    length and place.  Sets of one partition meet in its own bucket, not once more in the one above."""
    need = (a["n"] + b["n"]) * (threshold / (1 + threshold)) - 1e-9
    return (a["root"] != b["root"]) & (a["own"] | b["own"]) & (F.least(a["n"], b["n"]) >= F.greatest(a["n"], b["n"]) * threshold - 1e-9) \
        & (F.least(a["n"] - a["pos"], b["n"] - b["pos"]) >= need)


def _alike(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(u, v)`` of sets that reach the threshold, each counted once."""
    def run(batches):
        for b in slices(batches):
            a, z = (b.column(c) for c in ("a", "z"))
            hit = [pruned_jaccard(a[i].values.to_numpy(zero_copy_only=False), z[i].values.to_numpy(zero_copy_only=False), threshold) for i in range(b.num_rows)]
            yield pa.record_batch([b.column("u"), b.column("v")], names=["u", "v"]).filter(pa.array(hit, pa.bool_()))

    pairs = stored(pairs.select(F.least("x.fid", "y.fid").alias("u"), F.greatest("x.fid", "y.fid").alias("v")).distinct())
    asked = stored(sets.select("fid", "sigs").join(pairs.select(F.explode(F.array("u", "v")).alias("fid")).distinct(), "fid", "left_semi"))
    met = pairs.join(asked.toDF("u", "a"), "u").join(asked.toDF("v", "z"), "v")
    return arrow_map(met.select("u", "v", "a", "z"), run, "u long, v long")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``did``, ``component_id``, the smallest id
    reachable through pairs of fingerprints with Jaccard ``threshold`` or more.

    Equal fingerprints are one set and never become pairs; empty texts are
    alike.  Null ids keep their rows (a group of them alone has a null
    component); repeated rows keep one row each; an empty table gives no rows.

    Sets meet in buckets of one signature and length partition, without their
    signatures.  In TURNS turns each set is compared with the NEXT ones of its
    buckets, in another order each turn; what that joins is a group, so that a
    large group is not compared pair by pair.  Then all pairs of different
    groups are.  A bucket of more than BUCKET sets is dealt by blocks.  Only
    pairs in reach by length and place fetch their sets, once for all buckets.
    """
    prints = stored(fingerprints(docs, id_col, text_col).withColumn("fid", F.xxhash64("sigs")))
    sets = stored(prints.groupBy("fid").agg(F.min("did").alias("first_id"), F.first("sigs").alias("sigs")))
    # smaller sets have no other set above the threshold
    several = sets.filter(F.size("sigs") >= (F.size("sigs") + 1) * threshold - 1e-9).filter("size(sigs) > 0").select("fid", "sigs")
    places = arrow_map(several, _place_stage(frequent(several), threshold), "bucket long, fid long, n int, pos int, own boolean")
    met, groups = places.select("bucket", F.struct("fid", "n", "pos", "own", F.col("fid").alias("root")).alias("x")), None
    for turn in range(TURNS):
        line = Window.partitionBy("bucket").orderBy(*([] if turn else ["x.n"]), F.xxhash64("x.fid", "bucket", F.lit(turn)))
        beside = met.withColumns({f"y{k}": F.lead("x", k).over(line) for k in range(1, NEXT + 1)} | {"last": F.lag("x").over(line)})
        # sets that are alone in a bucket meet nothing there
        met = stored(beside.filter("y1 is not null or last is not null").select("bucket", "x", F.filter(
            F.array(*[f"y{k}" for k in range(1, NEXT + 1)]), lambda y: y.isNotNull() & _in_reach(F.col("x"), y, threshold)).alias("ys")))
        links = _alike(met.select("x", F.explode("ys").alias("y")), sets, threshold)
        edges = links if groups is None else groups.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(links)
        groups = components(edges)
        grouped = met.select("bucket", "x.fid", "x.n", "x.pos", "x.own").join(groups.withColumnRenamed("node", "fid"), "fid", "left").withColumn("root", F.coalesce("root", "fid"))
        # all pairs of at most NEXT + 1 sets were compared above
        mixed = grouped.groupBy("bucket").agg(F.count(F.lit(1)).alias("m"), F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("own").alias("any")) \
            .filter(f"m > {NEXT + 1} and lo < hi and any").select("bucket", F.ceil(F.col("m") / BUCKET).cast("int").alias("blocks"))
        dealt = stored(grouped.join(mixed, "bucket").select("bucket", "blocks", F.struct("fid", "n", "pos", "own", "root").alias("x")))
        met = dealt.drop("blocks")
    one = dealt.withColumn("block", F.pmod("x.fid", "blocks").cast("int")).drop("blocks")
    other = dealt.select("bucket", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.col("x").alias("y"))
    across = one.join(other, ["bucket", "block"]).filter(_in_reach(F.col("x"), F.col("y"), threshold) & F.expr("x.n < y.n or x.n = y.n and x.fid < y.fid"))
    links = _alike(across.select("x", "y"), sets, threshold)
    found = components(groups.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(links))
    rooted = sets.join(found.withColumnRenamed("node", "fid"), "fid", "left").select("fid", "first_id", F.coalesce("root", "fid").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = keep(rooted.join(least, "root").select("fid", "component_id"))
    return prints.join(labels, "fid").select("did", "component_id")
