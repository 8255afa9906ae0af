"""Compression of vectors to one code byte a part, with Orchard's search.

Vectors are cut into equal parts; each part position has a codebook that a few
rounds of nearest-entry assignment and averaging fit on all rows.  The nearest
entry is found by Orchard's search: every entry keeps a list of all entries by
distance; the search walks the list of the best entry so far, skips entries it
has seen, jumps to the list of an entry that is nearer, and stops where the
list goes beyond twice the current distance, for by the triangle inequality
nothing there can be nearer or as near.  All distances are squared integers, so
"beyond twice" is "above four times" and ties are exact.  A step looks at a few
list places of many vectors at a time.

Each round is one pass over the rows: tasks send sums per entry, which are
added up; only the codebooks (entries x dimension numbers) reach the driver.
"""
from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_map, slices, stored
from feedloom.llm.vectors import integer_vectors, matrix

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: List places looked at in a step, vectors searched together, entries that a search may start from.
STEP, TOGETHER, STARTS = 16, 512, 16
#: A label with more than this share of the rows counts as hot: there are fewer than 1 / HOT of them.
HOT = 0.001


class Orchard:
    """Codebook entries, each with the others in order of distance."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        self.narrow = entries.astype(np.int32)  # for vectors as near the origin as no distance leaves 31 bits
        self.reach = math.isqrt((2 ** 31 - 1) // entries.shape[1]) - int(np.abs(entries).max())
        apart = np.stack([((self.entries - e) ** 2).sum(axis=1) for e in self.entries])
        self.order = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=1)
        self.starts = np.unique(np.linspace(0, len(entries) - 1, STARTS).astype(np.int64))
        self.looked_at = 0  # distances between a vector and an entry

    def _distance(self, x: np.ndarray, entry: np.ndarray) -> np.ndarray:
        away = x - (self.narrow if x.dtype == np.int32 else self.entries)[entry]
        self.looked_at += len(away)
        return np.einsum("ij,ij->i", away, away)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to each vector's nearest entry; the lowest index of several."""
        n, k = len(vectors), len(self.entries)
        x = vectors.astype(np.int32 if n and int(np.abs(vectors).max()) <= self.reach else np.int64)
        seen = np.zeros((n, k), dtype=bool)
        best = np.full(n, self.starts[0])
        dist = self._distance(x, best)
        for s in self.starts[1:]:
            d = self._distance(x, np.full(n, s))
            best, dist = np.where(d < dist, s, best), np.minimum(d, dist)
        seen[:, self.starts] = True
        place, at_work = np.zeros(n, dtype=np.int64), np.arange(n)
        while len(at_work):
            b, near = best[at_work], dist[at_work]
            at = place[at_work][:, None] + np.arange(STEP)
            inside = at < k
            at = np.minimum(at, k - 1)
            entry = self.order[b[:, None], at]
            within = inside & (self.apart[b[:, None], at] <= 4 * near.astype(np.int64)[:, None])
            row, col = np.nonzero(within & ~seen[at_work[:, None], entry])
            found = entry[row, col]
            seen[at_work[row], found] = True
            # of the entries looked at, the nearest, and of those the lowest
            d = np.full(entry.shape, np.iinfo(x.dtype).max, dtype=x.dtype)
            d[row, col] = self._distance(x[at_work[row]], found)
            least = d.min(axis=1)
            lowest = np.where(d == least[:, None], entry, k).min(axis=1)
            jump = (least < near) | ((least == near) & (lowest < b))
            best[at_work[jump]], dist[at_work[jump]] = lowest[jump], least[jump]
            place[at_work] = np.where(jump, 0, place[at_work] + STEP)
            at_work = at_work[jump | within.all(axis=1)]
        return best, dist.astype(np.int64)


def _searched(batches, books, dim):
    """Slices of the rows with the nearest entries and squared distances by part."""
    lists = [Orchard(np.array(e, dtype=np.int64)) for e in books]
    for b in slices(batches, TOGETHER):
        x = matrix(b.column("v"), dim)
        parts = np.split(x, len(books), axis=1)
        yield b, parts, [o.nearest(p) for o, p in zip(lists, parts)]


def _sum_stage(books, dim):
    def run(batches):
        width, k = dim // len(books), len(books[0])
        sums, used = np.zeros((len(books), k, width), dtype=np.int64), np.zeros((len(books), k), dtype=np.int64)
        for _, parts, found in _searched(batches, books, dim):
            for p, (x, (best, _)) in enumerate(zip(parts, found)):
                by = np.argsort(best, kind="stable")
                entries, first = np.unique(best[by], return_index=True)
                sums[p, entries] += np.add.reduceat(x[by].astype(np.int64), first, axis=0)
                used[p] += np.bincount(best, minlength=k)
        part, entry = np.nonzero(used)
        yield pa.record_batch([pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(used[part, entry]),
                               *(pa.array(sums[part, entry, i]) for i in range(width))], names=["part", "entry", "n", *(f"s{i}" for i in range(width))])

    return run


def _code_stage(books, dim):
    def run(batches):
        for b, _, found in _searched(batches, books, dim):
            codes = np.stack([best for best, _ in found], axis=1).astype(np.uint8)
            error = sum(d for _, d in found)
            yield pa.record_batch([b.column("vid"), b.column("label"), pa.array([r.tobytes().hex() for r in codes], pa.string()), pa.array(error, pa.int64())],
                                  names=["vid", "label", "code", "error"])

    return run


def dimension(rows: DataFrame, parts: int = PARTS) -> int:
    """The most frequent length of the vectors that can be cut into ``parts``, the shortest of several; 0 if none can."""
    found = rows.groupBy(F.size("v").alias("d")).count().filter((F.col("d") > 0) & (F.col("d") % parts == 0)) \
        .orderBy(F.desc("count"), "d").limit(1).collect()
    return found[0].d if found else 0


def fit(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[list[list[int]]]:
    """Codebooks by part, entry and component, from all ``rows``.

    They start as the parts of the vectors with the smallest ids (null ids
    last; among equal ids the smaller vector).  With fewer rows than
    ``entries`` there are as many entries as rows."""
    first = [r.v for r in rows.orderBy(F.col("vid").asc_nulls_last(), "v").select("v").limit(entries).collect()]
    width = dim // parts
    books = [[v[p * width:(p + 1) * width] for v in first] for p in range(parts)]
    sums = [f"s{i}" for i in range(width)]
    for _ in range(rounds):
        found = arrow_map(rows.select("v"), _sum_stage(books, dim), ", ".join(["part int", "entry int", "n long", *(f"{s} long" for s in sums)]))
        # at most parts x entries rows
        for r in found.groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in ["n", *sums])).collect():
            books[r.part][r.entry] = [r[s] // r.n for s in sums]
    return books


def encode(rows: DataFrame, books: list, dim: int) -> DataFrame:
    """``(vid, label, code, error)``: two hex digits a part, squared distances summed over the parts."""
    label = rows.schema["label"].dataType.simpleString()
    return arrow_map(rows, _code_stage(books, dim), f"vid long, label {label}, code string, error long")


def digest(books: list) -> str:
    """SHA-256 of all components as decimal text, by part, entry, place."""
    return hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the errors of its label summed; null labels are one.  Null where no long can hold the sum.

    Hot labels, of which there can only be few, are joined map-side; no other
    label brings many rows to one task."""
    sums = stored(coded.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count("*").alias("rows")))
    total = sums.agg(F.sum("rows")).first()[0] or 0
    hot = F.col("rows") > total * HOT
    same = F.col("label").eqNullSafe(F.col("of"))
    few = F.broadcast(sums.filter(hot).select(F.col("label").alias("of"), "label_error"))
    rest = sums.filter(~hot).select(F.col("label").alias("of"), "label_error")
    return coded.join(few, same).drop("of").unionByName(coded.join(few, same, "left_anti").join(rest, same).drop("of"))


def compress(df: DataFrame, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Codes of all vectors under codebooks fitted on all of them.

    One row per vector: ``vid``, ``label``, ``code``, ``error``,
    ``label_error``, ``codebooks_sha256``.  Vectors that are null, hold a null,
    NaN or infinite component, or differ from the table's dimension (its most
    frequent length divisible by ``parts``) have no row.  Null ids and null
    labels keep their rows, repeated rows are rows of their own; an empty table
    gives no rows.  Components beyond +-2 ** 20 count as that.
    """
    rows = stored(integer_vectors(df, scale, id_col, vec_col, label_col))
    dim = dimension(rows, parts)
    rows = rows.filter(F.size("v") == dim) if dim else rows.limit(0)
    books = fit(rows, dim, parts, entries, rounds) if dim else []
    coded = stored(encode(rows, books, dim)) if dim else rows.select("vid", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    return label_errors(coded).withColumn("codebooks_sha256", F.lit(digest(books)))
