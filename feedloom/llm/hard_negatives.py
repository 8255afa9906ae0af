"""Hard negatives by LEMP-style coordinate pruning.

For anchors and their best rows of the same label (positives), the best rows of
other labels whose score lies in a band below the positive's.  Scores are inner
products of integer vectors.

Rows are sorted by length and dealt into groups, groups into buckets of rows of
about one length.  A bucket holds, for each coordinate, its rows sorted by the
normalised value.  For a score of at least ``lo`` (and at most ``hi``) the angle
between anchor and row is bounded by the bucket's lengths, so on each of the
anchor's largest (focus) coordinates only a range of values is feasible.  The
ranges' candidate sets are intersected and verified exactly; buckets that are
too short for ``lo`` are skipped; where no range leaves out half the bucket, all
of it is verified at once.

Anchors are copied to the groups they have to visit, and meet each group's rows
in one task that streams them.  An anchor first visits about the square root of
the number of groups; its best scores there are the lower bounds with which it
visits the others, which so return few rows.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import arrow_map, stored
from feedloom.llm.vectors import integer_vectors, matrix

SCALE, ANCHORS, POSITIVES, NEGATIVES = 256, 100, 5, 10
#: A negative's score in percent of the positive's, at least and at most.
LOW, HIGH = 30, 90
#: Rows a group is meant for and of a bucket, focus coordinates, anchors searched together.
GROUP_ROWS, BUCKET_ROWS, FOCUS, TOGETHER = 1 << 15, 2048, 6, 256
#: Marks on the way of lengths at which groups can be left out before they are visited.
MARKS = 1024
#: Beyond any score.
FAR = 1 << 62
_SLACK = 1e-9
_NO_ID = 2 ** 63 - 1


class Bucket:
    """Rows of about one length with sorted coordinate lists."""

    def __init__(self, v: np.ndarray, vid: np.ndarray, null_id: np.ndarray, label: np.ndarray):
        self.v, self.vid, self.null_id, self.label = v, vid, null_id, label
        length = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
        self.longest, self.shortest = float(length.max()), float(length.min())
        unit = v / np.where(length > 0, length, 1.0)[:, None]
        self.order = np.argsort(unit, axis=0).T.astype(np.int32)
        self.sorted = np.take_along_axis(unit.T, self.order, axis=1)
        self.unit = unit
        self.as_float = {}

    def floats(self, kind) -> np.ndarray:
        if kind not in self.as_float:
            self.as_float[kind] = self.v.astype(kind)
        return self.as_float[kind]

    def feasible(self, unit: np.ndarray, size: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """For each anchor (its unit vector and length, rows of score ``lo`` to ``hi`` are sought): whether the bucket can
        hold one, its focus coordinates, and the least and greatest feasible value on them."""
        with np.errstate(divide="ignore", invalid="ignore"):
            at_least = lo / (size * np.where(lo > 0, self.longest, self.shortest))
            at_most = hi / (size * np.where(hi >= 0, self.shortest, self.longest))
        free = (size == 0) | ((lo <= 0) & (self.shortest == 0))
        at_least = np.where(free | np.isnan(at_least), -1.0, at_least)
        at_most = np.where((size == 0) | np.isnan(at_most), 1.0, at_most)
        possible = (at_least <= 1 + _SLACK) & ((size > 0) | ((lo <= 0) & (hi >= 0)))
        near = np.arccos(np.clip(at_least - _SLACK, -1, 1))[:, None]  # greatest angle to the anchor
        far = np.arccos(np.clip(at_most + _SLACK, -1, 1))[:, None]  # least angle
        n_focus = min(FOCUS, unit.shape[1])
        focus = np.argpartition(-np.abs(unit), n_focus - 1, axis=1)[:, :n_focus]
        own = np.arccos(np.clip(np.take_along_axis(unit, focus, axis=1), -1, 1))
        least = np.cos(np.minimum(np.pi, np.minimum(own + near, 2 * np.pi - own - far))) - 1e-7
        most = np.cos(np.maximum(0.0, np.maximum(own - near, far - own))) + 1e-7
        if self.shortest == 0:  # rows of length 0 have no direction
            least, most = np.minimum(least, 0.0), np.maximum(most, 0.0)
        return possible, focus, least, most

    def candidates(self, focus, least, most) -> np.ndarray | None:
        """Rows in all feasible ranges of one anchor; None where the shortest range holds more than half the rows."""
        ends = [(np.searchsorted(self.sorted[f], a, "left"), np.searchsorted(self.sorted[f], e, "right")) for f, a, e in zip(focus, least, most)]
        shortest = min(range(len(ends)), key=lambda i: ends[i][1] - ends[i][0])
        a, e = ends[shortest]
        if 2 * (e - a) > len(self.v):
            return None
        rows = self.order[focus[shortest], a:e]
        for i, f in enumerate(focus):
            if i != shortest:
                x = self.unit[rows, f]
                rows = rows[(x >= least[i]) & (x <= most[i])]
        return rows


class Best:
    """The best ``k`` rows of every (anchor, band), kept while buckets come in."""

    def __init__(self, lo: np.ndarray, hi: np.ndarray, k: int):
        self.lo, self.hi, self.k = lo.copy(), hi, k  # anchors x bands; bands that are not there have lo > hi
        self.key, self.score, self.vid, self.null = (np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, anchor, score, vid, null) -> None:
        n_bands = self.lo.shape[1]
        new = []
        for band in range(n_bands):
            inside = (score >= self.lo[anchor, band]) & (score <= self.hi[anchor, band])
            new.append((anchor[inside] * n_bands + band, score[inside], vid[inside], null[inside]))
        key, score, vid, null = (np.concatenate(c) for c in zip((self.key, self.score, self.vid, self.null), *new))
        by = np.lexsort((vid, null, -score, key))
        key = key[by]
        first = np.searchsorted(key, key, "left")
        rank = np.arange(len(key)) - first
        kept = by[rank < self.k]
        last = rank == self.k - 1  # from now on only rows as good as the k-th
        self.lo.ravel()[key[last]] = score[by][last]
        self.key, self.score, self.vid, self.null = key[rank < self.k], score[kept], vid[kept], null[kept]


class Group:
    """The rows of a group in buckets of one dimension and about one length."""

    def __init__(self, parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts)
        names, label = np.unique(np.array(rows.column("label").to_pylist(), dtype=object), return_inverse=True)
        self.label = {n: i for i, n in enumerate(names)}
        ids = rows.column("vid").combine_chunks()
        null, vid = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(_NO_ID).to_numpy()
        v = rows.column("v").combine_chunks()
        sizes = np.diff(v.offsets.to_numpy())
        self.buckets: dict[int, list[Bucket]] = {}
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)  # by falling length
            if dim:
                whole = matrix(v.take(pa.array(at)), int(dim))
                self.buckets[int(dim)] = [Bucket(whole[i:i + BUCKET_ROWS], *(c[at[i:i + BUCKET_ROWS]] for c in (vid, null, label)))
                                          for i in range(0, len(at), BUCKET_ROWS)]

    def search(self, dim: int, q: np.ndarray, vid: np.ndarray, label: np.ndarray, lo: np.ndarray, hi: np.ndarray, same: bool, k: int) -> Best:
        """Best rows of ``q`` (anchors as rows) of their own label, or of others, in their bands ``lo`` to ``hi``."""
        best = Best(lo, hi, k)
        size = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        unit = q / np.where(size > 0, size, 1.0)[:, None]
        for bucket in self.buckets.get(dim, ()):
            there = best.lo <= hi
            least = np.where(there, best.lo, FAR).min(axis=1)
            most = np.where(there, hi, -FAR).max(axis=1)
            possible, focus, a, e = bucket.feasible(unit, size, least.astype(np.float64), most.astype(np.float64))
            possible &= there.any(axis=1)
            # integers below these are exact, whatever the order of the sum
            bound = float(size.max()) * bucket.longest
            kind = np.float32 if bound < 2 ** 24 else np.float64 if bound < 2 ** 53 else np.int64
            found, whole = [], []
            narrow = ((a > bucket.sorted[focus, 0]) | (e < bucket.sorted[focus, -1])).any(axis=1)
            for i in np.flatnonzero(possible):
                rows = bucket.candidates(focus[i], a[i], e[i]) if narrow[i] else None
                if rows is None:
                    whole.append(i)
                elif len(rows):
                    score = (bucket.floats(kind)[rows] @ q[i].astype(kind)).astype(np.int64)
                    found.append((np.full(len(rows), i), rows, score))
            if whole:
                at = np.array(whole)
                score = q[at].astype(kind) @ bucket.floats(kind).T
                i, rows = np.nonzero((score >= least[at][:, None]) & (score <= most[at][:, None]))
                found.append((at[i], rows, score[i, rows].astype(np.int64)))
            if found:
                i, rows, score = (np.concatenate(c) for c in zip(*found))
                fit = (bucket.label[rows] == label[i]) if same else (bucket.label[rows] != label[i])
                fit &= (bucket.vid[rows] != vid[i]) | bucket.null_id[rows]
                best.add(i[fit], score[fit], bucket.vid[rows[fit]], bucket.null_id[rows[fit]])
        return best


_FOUND = "aid long, ah long, band long, other long, score long"


def _search_stage(same: bool, k: int):
    def answers(group: Group, anchors: pa.RecordBatch):
        v = anchors.column("v")
        sizes = np.diff(v.offsets.to_numpy())
        bands = anchors.column("bands").to_pylist()
        labels = np.array([group.label.get(x, -1) for x in anchors.column("label").to_pylist()])
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            width = max(len(bands[i]) for i in at)
            lo, hi = np.full((len(at), width), FAR), np.full((len(at), width), -FAR)
            mark = np.zeros((len(at), width), dtype=np.int64)
            for r, i in enumerate(at):
                for c, b in enumerate(bands[i]):
                    mark[r, c], lo[r, c], hi[r, c] = b["band"], b["lo"], b["hi"]
            vid, ah = (anchors.column(c).to_numpy()[at] for c in ("vid", "ah"))
            best = group.search(int(dim), matrix(v.take(pa.array(at)), int(dim)), vid, labels[at], lo, hi, same, k)
            r = best.key // width
            yield pa.record_batch([pa.array(vid[r]), pa.array(ah[r]), pa.array(mark.ravel()[best.key]), pa.array(best.vid, mask=best.null),
                                   pa.array(best.score)], names=["aid", "ah", "band", "other", "score"])

    def run(batches):
        number, held, group = None, [], None
        for b in batches:
            numbers, kinds = b.column("grp").to_numpy(), b.column("kind").to_numpy()
            edges = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(kinds) != 0)) + 1
            for i, j in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows]):
                if i == j:
                    continue
                if numbers[i] != number:
                    number, held, group = numbers[i], [], None
                if kinds[i] == 0:
                    held.append(b.slice(i, j - i))
                elif held or group:
                    group, held = group or Group(held), []
                    for s in range(i, j, TOGETHER):
                        yield from answers(group, b.slice(s, min(TOGETHER, j - s)))

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each (anchor, band) with their ``rank``."""
    order = Window.partitionBy("aid", "ah", "band").orderBy(F.desc("score"), F.col("other").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class Search:
    """The table in groups, and its anchors."""

    def __init__(self, rows: DataFrame, anchors: int):
        spark = rows.sparkSession
        rows = rows.withColumn("n2", F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x)) \
            .withColumn("ah", F.xxhash64("label", "v"))
        n = rows.count()
        order = [F.size("v"), F.desc("n2"), F.col("ah"), F.col("vid"), F.col("row")]
        dealt = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(max(1, -(-n // GROUP_ROWS)), *order)
        self.rows = stored(dealt.select(F.spark_partition_id().alias("grp"), "vid", "ah", "label", "v", "n2"))
        self.n_groups = (self.rows.agg(F.max("grp")).first()[0] or 0) + 1
        # at most MARKS rows: the greatest length from a mark's groups on, for groups of one dimension fall in length
        mark = F.floor(F.col("grp") * MARKS / self.n_groups)
        tops = self.rows.groupBy(mark.alias("m")).agg(F.max("n2").alias("n2"), F.max("grp").alias("grp")).orderBy("m").collect()
        reach, self.tops = 0, [] if tops else [(0.0, -1)]
        for t in reversed(tops):
            reach = max(reach, t.n2)
            self.tops.append((math.sqrt(reach) * (1 + 1e-9), t.grp))
        self.tops.reverse()
        self.anchors = stored(self.rows.filter(F.col("vid") % anchors == 0).drop("grp").dropDuplicates(["vid", "ah"]))
        self.spark = spark

    def first_groups(self):
        """About the square root of the number of groups, spread over all of them."""
        n = math.isqrt(self.n_groups - 1) + 1
        start = F.pmod("ah", F.lit(self.n_groups))
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.pmod(start + i * (self.n_groups // n), F.lit(self.n_groups)).cast("int"))

    def other_groups(self):
        """The other groups that hold rows long enough for the least band."""
        least = F.array_min(F.transform("bands", lambda b: b["lo"]))
        tops = F.array(*(F.struct(F.lit(float(size)).alias("s"), F.lit(g).alias("g")) for size, g in self.tops))
        long_enough = F.filter(tops, lambda t: (least <= 0) | (t["s"] * F.sqrt("n2") >= least))
        last = F.coalesce(F.array_max(F.transform(long_enough, lambda t: t["g"])), F.lit(-1))
        every = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.array_except(every, self.first_groups())

    def visit(self, asked: DataFrame, groups, same: bool, k: int) -> DataFrame:
        """The best rows that each of ``asked`` (an anchor with ``bands``) meets in ``groups``."""
        bands = "array<struct<band:bigint,lo:bigint,hi:bigint>>"
        rows = self.rows.select("grp", F.lit(0).alias("kind"), "vid", "ah", "label", "v", "n2", F.lit(None).cast(bands).alias("bands"))
        copies = asked.select(F.explode(groups).alias("grp"), F.lit(1).alias("kind"), "vid", "ah", "label", "v", "n2", F.col("bands").cast(bands))
        met = rows.unionByName(copies).repartition(self.n_groups, "grp").sortWithinPartitions("grp", "kind", F.desc("n2"))
        return arrow_map(met, _search_stage(same, k), _FOUND)

    def best(self, asked: DataFrame, same: bool, k: int) -> DataFrame:
        """The best ``k`` rows of all groups for each band of ``asked``, with their ``rank``."""
        asked = stored(asked.select("vid", "ah", "label", "v", "n2", "bands"))
        first = stored(self.visit(asked, self.first_groups(), same, k))
        # a band's k-th best score so far is its new lower bound
        kth = _best(first, k).filter(F.col("rank") == k).groupBy("aid", "ah").agg(F.map_from_entries(F.collect_list(F.struct("band", "score"))).alias("kth"))
        raised = asked.join(kth.withColumnRenamed("aid", "vid"), ["vid", "ah"], "left").withColumn(
            "bands", F.transform("bands", lambda b: F.struct(b["band"].alias("band"), F.coalesce(F.col("kth")[b["band"]], b["lo"]).alias("lo"), b["hi"].alias("hi"))))
        return _best(first.unionByName(self.visit(raised, self.other_groups(), same, k)), k)


def mine(df: DataFrame, scale: int = SCALE, anchors: int = ANCHORS, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Hard negatives for every anchor (id divisible by ``anchors``) and each of its positives.

    Columns ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``.  The positives are the ``positives``
    best other rows of the anchor's label, the negatives the ``negatives`` best
    rows of other labels with ``low`` to ``high`` percent of the positive's
    score; higher scores first, then smaller ids, null ids last.

    Rows with a null label, a null vector or a null, NaN or infinite component
    take no part; vectors meet vectors of their own length only; components
    beyond +-2 ** 20 count as that.  Rows of the anchor's id are the anchor and
    not others; rows of one id with different labels or vectors are anchors
    each, repeated rows are one anchor but rows of their own in the lists.  An
    anchor without positives, and a positive without negatives, have no rows;
    an empty table gives none.
    """
    rows = integer_vectors(df, scale, id_col, vec_col, label_col).filter(F.col("label").isNotNull() & (F.size("v") > 0)).withColumn("label", F.col("label").cast("string"))
    table = Search(rows, anchors)
    band = lambda band, lo, hi: F.struct(band.cast("long").alias("band"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
    everything = table.anchors.withColumn("bands", F.array(band(F.lit(0), F.lit(-FAR), F.lit(FAR))))
    found = stored(table.best(everything, same=True, k=positives).select("aid", "ah", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")))
    p = F.col("positive_score")
    # rounded down and up to whole scores, in whole numbers
    down = F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100)) div 100")
    up = -F.expr(f"(-{low} * positive_score - pmod(-{low} * positive_score, 100)) div 100")
    bands = found.select("aid", "ah", band(p, up, down).alias("b")).filter("b.lo <= b.hi").groupBy("aid", "ah").agg(F.collect_set("b").alias("bands"))
    asked = table.anchors.join(bands.withColumnRenamed("aid", "vid"), ["vid", "ah"])
    lists = table.best(asked, same=False, k=negatives)
    return found.join(lists.withColumnRenamed("band", "positive_score"), ["aid", "ah", "positive_score"]) \
        .select(F.col("aid").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"))


#: ``op11_hard_negatives`` by brute force.
MINE_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as other_id, list_dot_product(a.v, b.v)::bigint as score
  from v a join v b on b.vec_id <> a.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5),
negatives as (
  select p.anchor_id, p.positive_id, p.positive_score, n.other_id as negative_id, n.score as negative_score,
         row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.other_id)::int as rank
  from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
   and 30 * p.positive_score <= 100 * n.score and 100 * n.score <= 90 * p.positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 10
"""
