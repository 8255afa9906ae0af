"""A keyed table as a log of changes: hash buckets, delta folders, merge on read, compaction.

Layout under ``path``: ``data/c=<commit>/b=<bucket>/`` holds the rows of one
commit by bucket of their key, ``log/<commit>.json`` the table after that
commit: which commit holds each bucket's base, which commits are deltas on it,
and the last batch of every application that wrote.  A commit is the creation
of its log file, which fails if it is there already; data without a log file
are not part of the table, and the next commit writes over them.

A commit writes the changed rows only.  After ``compact_after`` deltas the
buckets they touch get a new base, the others keep theirs; folders that no kept
log file names are deleted.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folders of logs that readers may still use; older ones go with the data that only they name.
KEEP = 4


class Files:
    """What the driver does with single files, in any store that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.make = jvm.org.apache.hadoop.fs.Path
        self.fs = self.make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.jvm = jvm

    def names(self, path: str) -> list[str]:
        p = self.make(path)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.make(path))

    def read(self, path: str) -> str:
        stream = self.fs.open(self.make(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        """A new file; raises if there is one."""
        draft = f"{path}.draft"
        stream = self.fs.create(self.make(draft), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self.make(path)) or not self.fs.rename(self.make(draft), self.make(path)):
            raise FileExistsError(path)

    def delete(self, path: str) -> None:
        self.fs.delete(self.make(path), True)


class KeyedTable:
    """One row per key; see the module.  One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, key: str, buckets: int = 16, compact_after: int = 8):
        self.spark, self.path, self.key, self.buckets, self.compact_after = spark, path.rstrip("/"), key, buckets, compact_after
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.files = Files(spark, path)

    # ------------------------------------------------------------ commits
    def commits(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/log") if n.endswith(".json"))

    def state(self) -> dict:
        """The table after the last commit."""
        done = self.commits()
        if not done:
            return {"commit": -1, "base": {}, "deltas": [], "batches": {}}
        return json.loads(self.files.read(f"{self.path}/log/{done[-1]}.json"))

    def committed(self, app: str, batch: int) -> bool:
        return self.state()["batches"].get(app, -1) >= batch

    def bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def upsert(self, rows: DataFrame, app: str, batch: int, gone: bool = False) -> bool:
        """Put ``rows`` (one per key), or with ``gone`` take their keys out.
        False, and nothing happens, if this batch of ``app`` is in already."""
        state = self.state()
        if state["batches"].get(app, -1) >= batch:
            return False
        commit = state["commit"] + 1
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) if not gone or f.name == self.key else F.lit(None).cast(f.dataType).alias(f.name)
                  for f in self.schema]
        self._write(rows.select(*fields, F.lit(gone).alias("_gone")), commit)
        if self.files.exists(f"{self.path}/data/c={commit}"):
            state["deltas"].append(commit)
        state["commit"] = commit
        state["batches"][app] = batch
        self._commit(state)
        if len(state["deltas"]) > self.compact_after:
            self.compact()
        return True

    def _write(self, rows: DataFrame, commit: int) -> None:
        rows.withColumn("b", self.bucket()).repartition("b").write.mode("overwrite").partitionBy("b").parquet(f"{self.path}/data/c={commit}")

    def _commit(self, state: dict) -> None:
        self.files.create(f"{self.path}/log/{state['commit']}.json", json.dumps(state))
        self._vacuum()

    def _vacuum(self) -> None:
        done = self.commits()
        used = set()
        for c in done[-KEEP:]:
            s = json.loads(self.files.read(f"{self.path}/log/{c}.json"))
            used |= {*s["deltas"], *s["base"].values()}
        for c in done[:-KEEP]:
            self.files.delete(f"{self.path}/log/{c}.json")
        for name in self.files.names(f"{self.path}/data"):
            if int(name[2:]) <= done[-1] and int(name[2:]) not in used:
                self.files.delete(f"{self.path}/data/{name}")

    def compact(self) -> None:
        """A new base for the buckets that deltas touch."""
        state = self.state()
        touched = self._touched(state["deltas"])
        if not touched:
            return
        commit = state["commit"] + 1
        rows = self._merged(state, touched).filter(~F.col("_gone"))
        self._write(rows.select(*self.schema.fieldNames(), "_gone"), commit)
        there = {n[2:] for n in self.files.names(f"{self.path}/data/c={commit}") if n.startswith("b=")}
        base = {b: c for b, c in state["base"].items() if int(b) not in touched} | {b: commit for b in there}
        self._commit(state | {"commit": commit, "base": base, "deltas": []})

    def _touched(self, deltas: list[int]) -> list[int]:
        return sorted({int(n[2:]) for c in deltas for n in self.files.names(f"{self.path}/data/c={c}") if n.startswith("b=")})

    # -------------------------------------------------------------- reads
    def read(self) -> DataFrame:
        """The table's rows."""
        return self._merged(self.state()).filter(~F.col("_gone")).select(*self.schema.fieldNames())

    def _load(self, folders: list[tuple[int, int]]) -> DataFrame | None:
        """Rows of ``(commit, bucket)`` folders with their commit."""
        if not folders:
            return None
        at = [f"{self.path}/data/c={c}/b={b}" for c, b in folders]
        fields = T.StructType([*self.schema.fields, T.StructField("_gone", T.BooleanType()), T.StructField("c", T.LongType()), T.StructField("b", T.IntegerType())])
        return self.spark.read.schema(fields).option("basePath", f"{self.path}/data").parquet(*at).drop("b")

    def _merged(self, state: dict, only: list[int] | None = None) -> DataFrame:
        wanted = lambda b: only is None or int(b) in only
        base = self._load([(c, int(b)) for b, c in sorted(state["base"].items()) if wanted(b)])
        deltas = self._load([(c, int(n[2:])) for c in state["deltas"] for n in self.files.names(f"{self.path}/data/c={c}")
                             if n.startswith("b=") and wanted(n[2:])])
        names = [*self.schema.fieldNames(), "_gone"]
        if deltas is None:
            return (base.select(*names) if base is not None else
                    self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("_gone", T.BooleanType())])))
        latest = deltas.groupBy(self.key).agg(F.max_by(F.struct(*names), "c").alias("r")).select("r.*")
        if base is None:
            return latest
        # changed keys are few beside the base: the join is theirs, broadcast if small
        return base.join(deltas.select(self.key).distinct(), self.key, "left_anti").select(*names).unionByName(latest)
