"""A table by day and hash bucket, for rows that arrive, age and go.

Layout under ``path``: ``data/c=<commit>/day=<day>/b=<bucket>/`` and
``log/<commit>.json``, which names the commits that hold each day and the last
batch of every application that wrote (as in :mod:`feedloom.sources.keyed`).
Retention takes whole days out of the log without touching their files' rows and
writes anew what is left of the one day that the cutoff falls into.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.session import ts_lit
from feedloom.sources.keyed import KEEP, Files

#: Days of rows whose time is null.
NO_DAY = "none"


class DayTable:
    """Rows with a key and a time; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, key: str, ts: str, buckets: int = 16):
        self.spark, self.path, self.key, self.ts, self.buckets = spark, path.rstrip("/"), key, ts, buckets
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.files = Files(spark, path)

    # ------------------------------------------------------------ commits
    def state(self) -> dict:
        done = sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/log") if n.endswith(".json"))
        return json.loads(self.files.read(f"{self.path}/log/{done[-1]}.json")) if done else {"commit": -1, "days": {}, "batches": {}}

    def committed(self, app: str, batch: int) -> bool:
        return self.state()["batches"].get(app, -1) >= batch

    def _commit(self, state: dict) -> None:
        self.files.create(f"{self.path}/log/{state['commit']}.json", json.dumps(state))
        done = sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/log") if n.endswith(".json"))
        kept = [json.loads(self.files.read(f"{self.path}/log/{c}.json"))["days"] for c in done[-KEEP:]]
        used = {(day, c) for days in kept for day, commits in days.items() for c in commits}
        for c in done[:-KEEP]:
            self.files.delete(f"{self.path}/log/{c}.json")
        for name in self.files.names(f"{self.path}/data"):
            at, c = f"{self.path}/data/{name}", int(name[2:])
            days = [n[4:] for n in self.files.names(at) if n.startswith("day=")]
            if c <= done[-1]:
                for day in days:
                    if (day, c) not in used:
                        self.files.delete(f"{at}/day={day}")
                if not any((day, c) in used for day in days):
                    self.files.delete(at)

    def bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _write(self, rows: DataFrame, commit: int) -> list[str]:
        """The rows as a commit's folders; the days that have some."""
        day = F.coalesce(F.date_format(self.ts, "yyyy-MM-dd"), F.lit(NO_DAY))
        rows.select(*self.schema.fieldNames()).withColumn("day", day).withColumn("b", self.bucket()) \
            .repartition("day", "b").write.mode("overwrite").partitionBy("day", "b").parquet(f"{self.path}/data/c={commit}")
        return [n[4:] for n in self.files.names(f"{self.path}/data/c={commit}") if n.startswith("day=")]

    def append(self, rows: DataFrame, app: str, batch: int) -> bool:
        """Add rows.  False, and nothing happens, if this batch of ``app`` is in already."""
        state = self.state()
        if state["batches"].get(app, -1) >= batch:
            return False
        state["commit"] += 1
        for day in self._write(rows, state["commit"]):
            state["days"].setdefault(day, []).append(state["commit"])
        state["batches"][app] = batch
        self._commit(state)
        return True

    def retain(self, cutoff) -> dict:
        """Let rows before ``cutoff`` go (H4).  Rows without a time stay.  Says which days went and which was written anew."""
        cutoff = dt.datetime.fromisoformat(str(cutoff))
        edge, state = cutoff.date().isoformat(), self.state()
        gone = [d for d in state["days"] if d != NO_DAY and d < edge]
        split = edge in state["days"] and cutoff.time() != dt.time(0)
        if not gone and not split:
            return {"dropped": [], "rewritten": None}
        state["commit"] += 1
        if split:
            left = self.read(days=[edge]).filter(F.col(self.ts) >= ts_lit(cutoff))
            state["days"][edge] = [state["commit"]] if self._write(left, state["commit"]) else []
        state["days"] = {d: c for d, c in state["days"].items() if d not in gone and c}
        self._commit(state)
        return {"dropped": sorted(gone), "rewritten": edge if split else None}

    # -------------------------------------------------------------- reads
    def read(self, days: list[str] | None = None, places: dict[str, list[int]] | None = None) -> DataFrame:
        """The rows; only of ``days``, or only of the buckets that ``places`` names for each day."""
        state, at = self.state(), []
        for day, commits in sorted(state["days"].items()):
            for c in commits:
                if places is not None:
                    there = set(self.files.names(f"{self.path}/data/c={c}/day={day}"))
                    at += [f"{self.path}/data/c={c}/day={day}/b={b}" for b in places.get(day, ()) if f"b={b}" in there]
                elif days is None or day in days:
                    at.append(f"{self.path}/data/c={c}/day={day}")
        if not at:
            return self.spark.createDataFrame([], self.schema)
        fields = T.StructType([*self.schema.fields, T.StructField("c", T.LongType()), T.StructField("day", T.StringType()), T.StructField("b", T.IntegerType())])
        return self.spark.read.schema(fields).option("basePath", f"{self.path}/data").parquet(*at).select(*self.schema.fieldNames())

    def orphans(self, other: "DayTable") -> DataFrame:
        """Rows of ``other`` (with the same buckets) whose key is in no row here: bucket meets bucket."""
        if other.buckets != self.buckets:
            raise ValueError("both tables need the same number of buckets")
        return other.read().withColumn("_b", other.bucket()).join(
            self.read().select(F.col(self.key).alias("_k"), self.bucket().alias("_kb")), (F.col("_b") == F.col("_kb")) & (F.col(other.key) == F.col("_k")),
            "left_anti").drop("_b")
