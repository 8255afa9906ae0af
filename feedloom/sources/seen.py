"""A store of seen ids with a Bloom filter per day and bucket beside the keys.

A batch of ids is first held against the filters of its buckets, all days at
once: an id that no filter may hold is new without a look at the store.  For the
others only the (day, bucket) folders whose filter may hold one of them are
read, and an exact anti join decides.  Filters are built by one pass that sets
bits per (day, bucket); all have BITS bits, so those of several batches are
merged by OR.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import scratch_path, ship_package
from feedloom.sources.daily import NO_DAY, DayTable

#: Bits of a filter and positions per id: about 1 id in 120 passes wrongly at 13,000 ids a (day, bucket).
BITS, HASHES = 1 << 17, 7


def positions(h1: np.ndarray, h2: np.ndarray, bits: int, hashes: int) -> np.ndarray:
    """Bit positions of ids by their two hashes, one row an id."""
    step = h2.view(np.uint64) | np.uint64(1)
    return ((h1.view(np.uint64)[:, None] + np.arange(hashes, dtype=np.uint64) * step[:, None]) % np.uint64(bits)).astype(np.int64)


def _runs(b: pa.RecordBatch, names: list[str]):
    """Slices of a sorted batch with equal values in ``names``."""
    if not b.num_rows:
        return
    values = list(zip(*(b.column(n).to_pylist() for n in names)))
    start = 0
    for i in range(1, len(values) + 1):
        if i == len(values) or values[i] != values[start]:
            yield values[start], b.slice(start, i - start)
            start = i


def _build_stage(bits: int, hashes: int):
    def run(batches):
        at, filled, n = None, None, 0
        row = lambda: pa.record_batch([pa.array([at[0]]), pa.array([at[1]], pa.int32()), pa.array([np.packbits(filled).tobytes()], pa.binary()),
                                       pa.array([n], pa.int64())], names=["day", "b", "bits", "n"])
        for batch in batches:
            for key, part in _runs(batch, ["day", "b"]):
                if key != at:
                    if at is not None:
                        yield row()
                    at, filled, n = key, np.zeros(bits, dtype=bool), 0
                filled[positions(part.column("h1").to_numpy(), part.column("h2").to_numpy(), bits, hashes).ravel()] = True
                n += part.num_rows
        if at is not None:
            yield row()

    return run


def _probe_stage(bits: int, hashes: int):
    def run(batches):
        bucket, days = None, {}
        for batch in batches:
            for (b, kind), part in _runs(batch, ["b", "kind"]):
                if b != bucket:
                    bucket, days = b, {}
                if kind == 0:
                    for day, data in zip(part.column("day").to_pylist(), part.column("bits").to_pylist()):
                        more = np.unpackbits(np.frombuffer(data, dtype=np.uint8)).astype(bool)
                        days[day] = days[day] | more if day in days else more
                    continue
                for i in range(0, part.num_rows, 4096):
                    ids = part.slice(i, 4096)
                    at = positions(ids.column("h1").to_numpy(), ids.column("h2").to_numpy(), bits, hashes)
                    found: list[list[str]] = [[] for _ in range(ids.num_rows)]
                    for day, held in days.items():
                        for k in np.flatnonzero(held[at].all(axis=1)):
                            found[k].append(day)
                    yield pa.record_batch([ids.column("id"), ids.column("b"), pa.array(found, pa.list_(pa.string()))], names=["id", "b", "days"])

    return run


class SeenStore:
    """Seen ids (``id``, ``seen_at``); one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16, bits: int = BITS, hashes: int = HASHES):
        self.spark, self.bits, self.hashes = spark, bits, hashes
        self.keys = DayTable(spark, f"{path.rstrip('/')}/keys", "id string, seen_at timestamp_ntz", "id", "seen_at", buckets)
        self.filters = f"{path.rstrip('/')}/bloom"
        #: Ids held against the filters, and those that needed the store, of the last call of ``unseen``.
        self.asked = self.looked_up = 0

    def _hashed(self, ids: DataFrame) -> DataFrame:
        return ids.withColumn("h1", F.xxhash64("id")).withColumn("h2", F.xxhash64(F.lit("bloom"), "id")).withColumn("b", self.keys.bucket())

    def add(self, ids: DataFrame, app: str, batch: int) -> bool:
        """Store ids (``id``, ``seen_at``), once per batch of ``app``.  The filters of a
        batch are there before its keys count, so none is ever missing."""
        if self.keys.committed(app, batch):
            return False
        ship_package(self.spark)
        commit = self.keys.state()["commit"] + 1
        day = F.coalesce(F.date_format("seen_at", "yyyy-MM-dd"), F.lit(NO_DAY))
        rows = self._hashed(ids).select(day.alias("day"), "b", "h1", "h2").repartition("day", "b").sortWithinPartitions("day", "b")
        rows.mapInArrow(_build_stage(self.bits, self.hashes), "day string, b int, bits binary, n long") \
            .write.mode("overwrite").parquet(f"{self.filters}/f={commit}")
        return self.keys.append(ids.select("id", "seen_at"), app, batch)

    def _filters(self) -> DataFrame | None:
        """The filters of the days that the store holds."""
        days, files = self.keys.state()["days"], self.keys.files
        at = [f"{self.filters}/{n}" for n in files.names(self.filters) if n.startswith("f=")]
        if not days or not at:
            return None
        # a day that was written anew keeps the filters of its older rows: they may hold too much, never too little
        return self.spark.read.schema("day string, b int, bits binary, n long").parquet(*at).filter(F.col("day").isin(sorted(days)))

    def probe(self, ids: DataFrame) -> DataFrame:
        """``id``, ``b``, ``days``: on which days the store may hold each of ``ids``."""
        ship_package(self.spark)
        filters = self._filters()
        hashed = self._hashed(ids.select("id"))
        if filters is None:
            return hashed.select("id", "b", F.array().cast("array<string>").alias("days"))
        rows = filters.select("b", F.lit(0).alias("kind"), "day", "bits", F.lit(None).cast("string").alias("id"), F.lit(0).cast("long").alias("h1"),
                              F.lit(0).cast("long").alias("h2")) \
            .unionByName(hashed.select("b", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("day"), F.lit(None).cast("binary").alias("bits"), "id", "h1", "h2"))
        return rows.repartition("b").sortWithinPartitions("b", "kind").mapInArrow(
            _probe_stage(self.bits, self.hashes), "id string, b int, days array<string>")

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The rows of ``batch`` whose ``id`` is not in the store."""
        probed = self.probe(batch.select("id").filter("id is not null").distinct()).persist()
        try:
            suspects = probed.filter(F.size("days") > 0)
            self.asked, self.looked_up = probed.count(), suspects.count()
            if not self.looked_up:
                return batch
            places: dict[str, list[int]] = {}
            # at most days x buckets rows
            for r in suspects.select(F.explode("days").alias("day"), "b").distinct().collect():
                places.setdefault(r.day, []).append(r.b)
            path = scratch_path(self.spark)
            self.keys.read(places=places).select("id").join(suspects.select("id"), "id", "left_semi").distinct().write.parquet(path)
            return batch.join(self.spark.read.parquet(path), "id", "left_anti")
        finally:
            probed.unpersist()

    def retain(self, cutoff) -> dict:
        """Forget ids seen before ``cutoff``; filters of days that are gone go too, once no file holds another day."""
        done = self.keys.retain(cutoff)
        days = set(self.keys.state()["days"])
        for name in self.keys.files.names(self.filters):
            if name.startswith("f="):
                held = {r.day for r in self.spark.read.parquet(f"{self.filters}/{name}").select("day").distinct().collect()}
                if not held & days:
                    self.keys.files.delete(f"{self.filters}/{name}")
        return done
