"""Removal of byte strings that occur more than once, by suffix sorting.

A repeated string of ``length`` bytes is found in three steps.

1. *Anchors.*  Every window of ``length`` bytes names one ``GRAM``-byte gram
   inside it: the one that hashes lowest (leftmost on ties).
   The choice depends on the window alone, so equal windows name equal grams
   at equal offsets.  Neighbouring windows mostly share their gram, so a text
   turns into about one anchor per 65 bytes: the gram's hash, and the hash of
   the *segment* that the anchor's windows span.
2. *Grouping.*  Anchors meet by gram hash.  A gram seen once can have no
   repeated window.  Where all segments of a gram are equal, all its windows
   repeat and no text is needed, so copies never travel.  Where they differ,
   one text of each distinct segment is fetched.
3. *Suffix sorting.*  The distinct segments of whole gram groups form blocks.
   A two-stage sort orders a block's suffixes: those smaller than their
   successor are sorted directly, the others are induced by one scan over the
   buckets.  Adjacent common prefixes of ``length`` bytes or more mark the
   repeated windows.

A gram with more distinct segments than ``GROUP_LIMIT`` is split exactly: its
windows are dealt to finer grams by their offset to the anchor (every window
of one offset range contains the same longer gram), and where a finer gram is
above the limit again, to whole windows.  So no task ever holds an unbounded
group, and nothing is dropped.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_map, corpus, identified, keep, slices, stored

LENGTH = 200
GRAM = 48
#: Bytes hashed at a time in the anchor stage; longer texts are cut into overlapping blocks.
BLOCK = 1 << 20
#: Distinct segments of one gram that may meet in one suffix array (about 0.3 MB of text).
GROUP_LIMIT = 1024
#: Offset ranges of a gram above the limit; in ranges that are above it again each window stands alone.
SPLIT = 8
#: Bytes of segments sorted at a time.
SORT_BLOCK = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(200).integers(1, 2 ** 64, 256, dtype=np.uint64)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, up to ``n``."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK + 4096)
        with np.errstate(over="ignore"):
            _POWERS[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size, b, dtype=np.uint64)], dtype=np.uint64)
                          for b in (_BASE, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def anchors(block: bytes, starts: np.ndarray, lengths: np.ndarray, length: int, gram: int):
    """Anchors of the texts at ``starts`` (ascending) of ``block``.

    Returns arrays ``(text index, gram hash, segment hash, first window,
    windows - 1, anchor - first window)``; positions are in the block."""
    n, width = len(block), length - gram + 1
    raw = np.frombuffer(block, dtype=np.uint8)
    up, down = _powers(n + 1)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_TABLE[raw] * up[:n], out=prefix[1:])
    hashes = _mix((prefix[gram:] - prefix[:-gram]) * down[:n - gram + 1])
    order = hashes & np.uint64(0xFFFFFFFF00000000) | np.arange(len(hashes), dtype=np.uint64)
    low, span = order, 1
    while span * 2 <= width:
        low, span = np.minimum(low[:-span], low[span:]), span * 2
    if span < width:
        low = np.minimum(low[:len(order) - width + 1], low[width - span:])
    chosen = low & np.uint64(0xFFFFFFFF)
    valid = np.zeros(len(chosen) + 1, dtype=np.int8)
    fits = lengths >= length
    np.add.at(valid, starts[fits], 1)
    np.add.at(valid, starts[fits] + lengths[fits] - length + 1, -1)
    valid = np.cumsum(valid[:-1]).astype(bool)
    cut = np.flatnonzero((chosen[1:] != chosen[:-1]) | (valid[1:] != valid[:-1])) + 1
    first = np.r_[0, cut]
    last = np.r_[cut, len(chosen)] - 1
    use = valid[first]
    first, last = first[use], last[use]
    at = chosen[first].astype(np.int64)
    key = hashes[at]
    seg = _mix((prefix[last + length] - prefix[first]) * down[first] + (last - first).astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
    return np.searchsorted(starts, first, side="right") - 1, key, seg, first, last - first, at - first


_ANCHOR = "uid long, th long, key long, seg long, a long, more short, off short"


def _anchor_stage(length: int, gram: int):
    def blocks(batch) -> Iterator[tuple[bytes, list, list, list]]:
        """Texts packed into blocks: bytes, row of each text, its place in its row's text, its length."""
        parts, rows, place, sizes, total = [], [], [], [], 0
        for row, text in enumerate(batch.column("text").to_pylist()):
            data = text.encode("utf-8", "surrogatepass")
            if len(data) < length:
                continue
            for i in range(0, len(data) - length + 1, BLOCK):
                piece = data[i:i + BLOCK + length - 1]
                parts.append(piece), rows.append(row), place.append(i), sizes.append(len(piece))
                total += len(piece)
                if total >= BLOCK:
                    yield b"".join(parts), rows, place, sizes
                    parts, rows, place, sizes, total = [], [], [], [], 0
        if parts:
            yield b"".join(parts), rows, place, sizes

    def run(batches):
        for b in slices(batches):
            uid, th = (b.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "th"))
            for block, rows, place, sizes in blocks(b):
                sizes, rows, place = np.array(sizes), np.array(rows), np.array(place)
                starts = np.cumsum(sizes) - sizes
                which, key, seg, first, more, off = anchors(block, starts, sizes, length, gram)
                yield pa.record_batch(
                    [pa.array(uid[rows[which]]), pa.array(th[rows[which]]), pa.array(key.view(np.int64)),
                     pa.array(seg.view(np.int64)), pa.array(first - starts[which] + place[which]),
                     pa.array(more.astype(np.int16)), pa.array(off.astype(np.int16))],
                    names=["uid", "th", "key", "seg", "a", "more", "off"])

    return run


# ----------------------------------------------------------- suffix sorting
def two_stage_order(text: bytes, ends: np.ndarray, begin: np.ndarray, until: np.ndarray) -> list[int]:
    """Suffix array of the positions ``begin[k] <= i < until[k]`` of each
    segment ``k`` of ``text`` that ends at ``ends[k]``; suffixes end there.

    Ascending suffixes (smaller than their successor) and the last position
    of a segment are sorted directly; every other one is placed when its
    successor is met in a scan from the smallest suffix on, at the front of
    its first byte's bucket."""
    raw = np.frombuffer(text, dtype=np.uint8)
    n = len(raw)
    last = np.zeros(n, dtype=bool)
    last[ends - 1] = True
    # ascending: the next different byte (within the segment) is larger
    differs = np.r_[raw[1:] != raw[:-1], True] | last
    at = np.flatnonzero(differs)
    nxt = at[np.searchsorted(at, np.arange(n))]
    rises = np.zeros(n, dtype=bool)
    inner = ~last[nxt]
    rises[inner] = raw[np.minimum(nxt[inner] + 1, n - 1)] > raw[nxt[inner]]
    direct = rises | last
    # from each wanted range on to the next directly sorted position
    at = np.flatnonzero(direct)
    stop = at[np.searchsorted(at, until - 1)] + 1
    delta = np.zeros(n + 1, dtype=np.int64)
    np.add.at(delta, begin, 1)
    np.add.at(delta, stop, -1)
    wanted = np.cumsum(delta[:-1]) > 0
    owner = ends[np.searchsorted(ends, np.arange(n), side="right")]
    seeds = np.flatnonzero(wanted & direct)
    limit = owner[seeds]
    seeds = [i for _, i in sorted(zip(map(text.__getitem__, map(slice, seeds.tolist(), limit.tolist())), seeds.tolist()))]
    # buckets: induced suffixes of a byte stand before its directly sorted ones, but a bare last byte comes first of all
    induced = wanted & ~direct
    n_direct = np.bincount(raw[wanted & direct], minlength=256)
    n_induced = np.bincount(raw[induced], minlength=256)
    n_bare = np.bincount(raw[wanted & last], minlength=256)
    base = np.cumsum(n_direct + n_induced) - (n_direct + n_induced)
    order: list[int] = [-1] * int(base[-1] + n_direct[-1] + n_induced[-1])
    place = base.copy().tolist()
    front = (base + n_bare).tolist()
    skip = (base + n_induced).tolist()
    lone = last.tolist() if len(raw) < 1 << 22 else last
    for i in seeds:
        c = text[i]
        if lone[i]:
            order[place[c]] = i
            place[c] += 1
        else:
            order[skip[c] + int(n_bare[c])] = i
            skip[c] += 1
    can = induced.tolist()
    for i in order:
        if i > 0 and can[i - 1]:
            c = text[i - 1]
            order[front[c]] = i - 1
            front[c] += 1
    return order


def common_prefixes(text: bytes, order: np.ndarray, ends: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix of each suffix with the next in ``order``, counted up to ``cap`` bytes and within its segment."""
    pad = np.frombuffer(text + bytes(cap + 8), dtype=np.uint8)
    words = np.ndarray((len(pad) - 7,), dtype=">u8", buffer=pad.data, strides=(1,))
    owner = ends[np.searchsorted(ends, order, side="right")] - order
    out = np.zeros(max(0, len(order) - 1), dtype=np.int64)
    live = np.arange(len(out))
    for k in range(0, cap, 8):
        x = words[order[live] + k].astype(np.uint64) ^ words[order[live + 1] + k].astype(np.uint64)
        lead = np.full(len(x), 8, dtype=np.int64)
        for byte in range(7, -1, -1):
            lead[(x >> np.uint64(56 - 8 * byte)) & np.uint64(255) != 0] = byte
        out[live] += lead
        live = live[lead == 8]
        if not len(live):
            break
    return np.minimum(np.minimum(out, cap), np.minimum(owner[:-1], owner[1:]))


def repeated_starts(segments: list[bytes], length: int) -> list[list[tuple[int, int]]]:
    """For each segment the maximal runs ``(first, last)`` of window starts
    whose ``length`` bytes also start elsewhere in the segments."""
    sizes = np.array([len(s) for s in segments])
    text, ends = b"".join(segments), np.cumsum(sizes)
    begin = ends - sizes
    order = np.array(two_stage_order(text, ends, begin, ends - length + 1), dtype=np.int64)
    same = np.flatnonzero(common_prefixes(text, order, ends, length) >= length)
    hit = np.zeros(len(text) + 1, dtype=np.int8)
    hit[order[same]] = 1
    hit[order[same + 1]] = 1
    edge = np.diff(np.r_[np.int8(0), hit])
    up, down = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    out: list[list[tuple[int, int]]] = [[] for _ in segments]
    for k, i, j in zip(np.searchsorted(ends, up, side="right").tolist(), up.tolist(), down.tolist()):
        out[k].append((i - int(begin[k]), j - int(begin[k])))
    return out


def _sort_stage(length: int):
    """Rows sorted by ``gkey``: blocks of whole groups through ``repeated_starts``."""
    def solve(held, texts):
        rows = [(k, s, at + i, at + j) for (k, s, at), runs in zip(held, repeated_starts(texts, length)) for i, j in runs]
        cols = list(zip(*rows)) or [[]] * 4
        return pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                                pa.array(cols[3], pa.int32())], names=["key", "seg", "i", "j"])

    def run(batches):
        held, texts, total, last = [], [], 0, None
        for b in batches:
            for g, k, s, at, t in zip(*(b.column(c).to_pylist() for c in ("gkey", "key", "seg", "shift", "txt"))):
                if total >= SORT_BLOCK and g != last:
                    yield solve(held, texts)
                    held, texts, total = [], [], 0
                held.append((k, s, at)), texts.append(t)
                total += len(t)
                last = g
        if held:
            yield solve(held, texts)

    return run


# -------------------------------------------------------------- distributed
_DOC = ["uid", "th"]


def _bytes(start: str, size: str):
    return F.expr(f"substring(txt, cast({start} + 1 as int), cast({size} as int))")


def _parts(segs: DataFrame, length: int, gram: int) -> DataFrame:
    """Segments with their text, cut into ``parts`` offset ranges: windows
    ``a2..b2`` of the segment, all of which contain the finer gram ``g``."""
    step = F.ceil(F.lit(length - gram + 1) / F.col("parts"))
    return segs.select("*", F.explode(F.expr("sequence(0, parts - 1)")).alias("t")) \
        .withColumn("d0", F.col("t") * step).withColumn("d1", F.least(F.col("d0") + step - 1, F.lit(length - gram))) \
        .withColumn("a2", F.greatest(F.lit(0), F.col("off") - F.col("d1")).cast("int")) \
        .withColumn("b2", F.least(F.col("more"), F.col("off") - F.col("d0")).cast("int")).filter("a2 <= b2") \
        .withColumn("part", _bytes("a2", f"b2 - a2 + {length}")).withColumn("g", _bytes("off - d0", f"{length} + d0 - d1"))


def repeated_intervals(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Byte intervals ``(uid, th, s, e)`` of ``identified`` rows that are
    covered by a ``length``-byte string that also starts anywhere else."""
    rows = arrow_map(docs.select("uid", "th", "text"), _anchor_stage(length, gram), _ANCHOR)
    status = keep(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("seg").alias("lo"), F.max("seg").alias("hi"))
                  .filter("n > 1").select("key", (F.col("lo") != F.col("hi")).alias("mixed")))
    met = stored(rows.join(status, "key"))
    alike = met.filter("not mixed").select(*_DOC, F.col("a").alias("s"), (F.col("a") + F.col("more") + length).alias("e"))

    mixed = met.filter("mixed").drop("mixed")
    distinct = mixed.groupBy("key", "seg").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*_DOC, "a", "more", "off")).alias("one"))
    hot = keep(distinct.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > group_limit))
    segs = distinct.select("key", "seg", "one.*").join(hot, "key", "left") \
        .withColumn("parts", F.when(F.col("m").isNull(), 1).otherwise(SPLIT)) \
        .join(docs.select(*_DOC, F.col("text").cast("binary").alias("txt")), _DOC) \
        .select("key", "seg", "more", "off", "parts", _bytes("a", f"more + {length}").alias("txt"))
    # a segment that occurs twice repeats whole; the rest finds what different segments share
    again = distinct.filter("n > 1").select("key", "seg", F.lit(0).alias("i"), F.col("one.more").cast("int").alias("j"))
    calm = segs.filter("parts = 1").select(F.col("key").alias("gkey"), "key", "seg", F.lit(0).alias("shift"), "txt")
    fine = stored(_parts(segs.filter("parts > 1"), length, gram).select(
        F.xxhash64("key", "t", "g").alias("gkey"), "key", "seg", F.col("a2").alias("shift"), F.col("part").alias("txt")))
    met_again = fine.join(fine.groupBy("gkey").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "gkey")
    groups = calm.unionByName(met_again.filter(F.col("m") <= group_limit).drop("m"))
    sorted_runs = arrow_map(groups.repartition("gkey").sortWithinPartitions("gkey"), _sort_stage(length), "key long, seg long, i int, j int")
    windows = met_again.filter(F.col("m") > group_limit) \
        .select("key", "seg", "shift", "txt", F.explode(F.expr(f"sequence(0, octet_length(txt) - {length})")).alias("x")) \
        .select("key", "seg", (F.col("shift") + F.col("x")).alias("i"), _bytes("x", str(length)).alias("window")) \
        .select("key", "seg", "i", F.xxhash64("window").alias("w"), F.xxhash64(F.lit(1), "window").alias("w2"))
    twice = windows.groupBy("w", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w", "w2")
    alone = windows.join(twice, ["w", "w2"]).select("key", "seg", "i", F.col("i").alias("j"))
    shared = mixed.join(sorted_runs.unionByName(again).unionByName(alone), ["key", "seg"]).select(
        *_DOC, (F.col("a") + F.col("i")).alias("s"), (F.col("a") + F.col("j") + length).alias("e"))
    return alike.unionByName(shared)


def _cut_stage():
    def run(batches):
        for b in slices(batches):
            sizes, removed, n_spans, rest, digest = [], [], [], [], []
            for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                merged: list[list[int]] = []
                for x in sorted((s["s"], s["e"]) for s in spans or ()):
                    if merged and x[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x[1])
                    else:
                        merged.append(list(x))
                kept, at = [], 0
                for s, e in merged:
                    kept.append(data[at:s])
                    at = e
                kept = b"".join([*kept, data[at:]])
                sizes.append(len(data)), removed.append(len(data) - len(kept)), n_spans.append(len(merged))
                rest.append(kept), digest.append(hashlib.sha256(kept).hexdigest())
            yield pa.record_batch([b.column("did"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                                   pa.array(rest, pa.binary()), pa.array([k.decode("utf-8", "ignore") for k in rest], pa.string()),
                                   pa.array(digest, pa.string()), b.column("row")],
                                  names=["did", "n_bytes", "n_removed", "n_spans", "kept", "kept_text", "kept_sha256", "row"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Each document without the bytes covered by a repeated ``length``-byte string.

    One row per input row: ``did``, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept`` (bytes; a cut may fall inside a character), ``kept_text`` (the
    whole characters of it), ``kept_sha256``, and ``row``, a struct of the
    ``carry`` columns.  Strings are judged on the input; every occurrence
    goes, overlaps count, matches never cross documents.  Null texts count as
    empty; texts shorter than ``length`` stay whole; repeated rows are copies
    of each other and so lose all they share.  Null ids keep their rows.  An
    empty table gives no rows.
    """
    rows = identified(corpus(docs, id_col, text_col))
    spans = repeated_intervals(rows, length).distinct().groupBy(*_DOC).agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    whole = rows
    if carry:
        whole = identified(docs.select(F.col(id_col).cast("long").alias("did"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                                       F.struct(*[docs[c] for c in carry]).alias("row")), "row")
    joined = whole.join(spans, _DOC, "left").select("did", "text", F.col("row") if carry else F.struct(F.lit(0).alias("none")).alias("row"), "spans")
    kind = joined.schema["row"].dataType.simpleString()
    return arrow_map(joined, _cut_stage(), "did long, n_bytes long, n_removed long, n_spans long, kept binary, kept_text string, "
                                           f"kept_sha256 string, row {kind}")
