"""Queue and item life cycle: transition logs folded into snapshots, claims,
quarantine, requeue, receipts, repairs and cascades.

Mutable UPSERT tables are modelled as append-only transition logs plus a
deterministic fold.  The queue fold (F1) has owner and lease-expiry guards,
which makes it sequential per item: the log is hash-partitioned by item,
sorted inside partitions (external sort, spills) and folded as a stream in
``mapInPandas``; state is carried across Arrow batches, so an item with a
huge history is streamed through, never collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.functions import fixed
from feedloom.functions import text as T
from feedloom.sources import feeds as S
from feedloom.session import checkpoint_dir, reliable_checkpoint, ship_package, ts_lit

LOG_COLUMNS = ["item_id", "ts", "seq", "action", "worker", "lease_until", "reason"]

SNAPSHOT_SCHEMA = (
    "item_id string, state string, lease_owner string, lease_until timestamp_ntz, "
    "delivery_count int, enqueued_at timestamp_ntz, done_at timestamp_ntz, "
    "last_error string, updated_at timestamp_ntz")

_OUT_COLS = ["item_id", "state", "lease_owner", "lease_until", "delivery_count",
             "enqueued_at", "done_at", "last_error", "updated_at"]


def _nat(v):
    return None if v is None or pd.isna(v) else v


POISON, RETRY = "poison_item: analysis_failed: ", "analysis_failed: "


def poisoned(error: str, delivery_count: int, max_attempts: int) -> bool:
    """F4's decision for one failed claim: no further delivery."""
    return fixed.MISSING_REQUIRED in error.strip().lower() or delivery_count >= max_attempts


def queue_step(s: dict | None, iid, a, w, t, lease_until, reason, max_attempts: int | None = None) -> dict | None:
    """One queue transition (shared by the batch fold and the streaming state).

    With ``max_attempts`` a release is a failed claim that F4 decides: the item
    goes back with its reason, or is quarantined (``DONE``)."""
    if a == "enqueue":
        if s is None:
            return {"item_id": iid, "state": "QUEUED", "lease_owner": None, "lease_until": None,
                    "delivery_count": 0, "enqueued_at": t, "done_at": None, "last_error": "", "updated_at": t}
        s.update(state="QUEUED", lease_owner=None, lease_until=None, last_error="", updated_at=t)
        return s
    if s is None:
        return None
    if a == "claim":
        lu = _nat(s["lease_until"])
        if s["state"] == "QUEUED" or (s["state"] == "LEASED" and lu is not None and lu <= t):
            s.update(state="LEASED", lease_owner=w, lease_until=lease_until,
                     delivery_count=s["delivery_count"] + 1, last_error="", updated_at=t)
        return s
    if a in ("complete", "release", "fail") and s["lease_owner"] is not None and s["lease_owner"] == w:
        why = "" if reason is None else str(reason).strip()
        if a == "release" and max_attempts is not None:
            a = "fail" if poisoned(why, s["delivery_count"], max_attempts) else a
            why = (POISON if a == "fail" else RETRY) + why
        done = s["done_at"] if _nat(s["done_at"]) is not None else t
        if a == "complete":
            s.update(state="DONE", lease_owner=None, lease_until=None, done_at=done, last_error="", updated_at=t)
        elif a == "release":
            s.update(state="QUEUED", lease_owner=None, lease_until=None, last_error=why, updated_at=t)
        else:
            s.update(state="DONE", lease_owner=None, lease_until=None, done_at=done, last_error=why, updated_at=t)
    return s


def _fold_queue(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stream fold over rows sorted by (item_id, ts, seq); state carried across batches."""
    cur = None
    s = None  # state of the current item, None = not enqueued yet
    for pdf in batches:
        out = []
        ids = pdf["item_id"].to_numpy()
        acts = pdf["action"].to_numpy()
        wks = pdf["worker"].to_numpy()
        tss = pdf["ts"].to_numpy()
        lus = pdf["lease_until"].to_numpy()
        rsn = pdf["reason"].to_numpy()
        for i in range(len(pdf)):
            if ids[i] != cur:
                if s is not None:
                    out.append(tuple(s[c] for c in _OUT_COLS))
                cur, s = ids[i], None
            s = queue_step(s, ids[i], acts[i], wks[i], tss[i], lus[i], rsn[i])
        if out:
            yield _frame(out)
    if s is not None:
        yield _frame([tuple(s[c] for c in _OUT_COLS)])


def _frame(rows) -> pd.DataFrame:
    df = pd.DataFrame(rows, columns=_OUT_COLS)
    for c in ("lease_until", "enqueued_at", "done_at", "updated_at"):
        df[c] = pd.to_datetime(df[c])
    df["delivery_count"] = df["delivery_count"].astype("int32")
    return df


def _fold_sorted(src: DataFrame, key: str) -> DataFrame:
    ship_package(src.sparkSession)
    # no fixed number of partitions, so that AQE may join small ones
    return (src.repartition(key).sortWithinPartitions(key, "ts", "seq")
            .mapInPandas(_fold_queue, SNAPSHOT_SCHEMA))


def running_last(log: DataFrame, mark: Column, partitions: int | None = None) -> DataFrame:
    """Each row with ``_mark``, the latest non-null ``mark`` (a struct that
    begins with ``ts, seq``) of its item at or before it, as a distributed scan:
    range-partition by (item, ts, seq) and checkpoint; running max inside
    (partition, item); the carry from earlier partitions comes from a small
    per-(partition, item) summary.  A hot item spans many partitions, never one
    task."""
    spark = log.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = reliable_checkpoint(log.repartitionByRange(n, "item_id", "ts", "seq")
                               .withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid", "item_id").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    local = part.withColumn("_m", F.max(mark).over(w))
    summary = local.groupBy("_pid", "item_id").agg(F.max(mark).alias("_last"))
    ws = Window.partitionBy("item_id").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_carry", F.max("_last").over(ws)).select("_pid", "item_id", "_carry")
    return local.join(summary, ["_pid", "item_id"]).withColumn("_mark", F.coalesce(F.col("_m"), F.col("_carry"))).drop("_pid", "_m", "_carry")


def enqueue_segments(log: DataFrame, partitions: int | None = None) -> DataFrame:
    """Tag each event with the seq of the latest enqueue at or before it (null
    before the first enqueue)."""
    marked = running_last(log, F.when(F.col("action") == "enqueue", F.struct("ts", "seq")), partitions)
    seg = F.col("_mark")
    return marked.withColumn("seg", F.when(seg.isNotNull(), F.concat_ws(
        ":", F.lpad(F.unix_micros(seg["ts"].cast("timestamp")).cast("string"), 20, "0"),
        F.lpad(seg["seq"].cast("string"), 20, "0")))).drop("_mark")


def queue_snapshot(log: DataFrame, partitions: int | None = None, segmented: bool = True) -> DataFrame:
    """fold a queue transition log into one snapshot row per item.

    Log columns: item_id, ts, seq, action (enqueue|claim|complete|release|
    fail), worker, lease_until, reason.  Rules: enqueue creates or resets to
    QUEUED keeping enqueued_at/delivery_count/done_at; claim only when
    QUEUED or the lease expired (``lease_until <= ts``), +1 delivery; complete
    / release / fail only by the lease owner.  Items never enqueued give no row.

    An enqueue resets the lease control; only counters cross it (delivery
    count adds up, enqueued_at and done_at are the first ones).  So with
    ``segmented`` the log is cut at enqueues (:func:`enqueue_segments`),
    every (item, segment) is folded on its own, and the segments are
    combined with aggregates: an item with a huge history is spread over its
    segments instead of one task, and all items take the same way.  Without
    ``segmented`` each item is folded whole (for logs known to be even).
    """
    src = log.select(*LOG_COLUMNS)
    parts = partitions or int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not segmented:
        return _fold_sorted(src, "item_id")
    return _segmented_fold(src, parts)


def _segmented_fold(src: DataFrame, parts: int) -> DataFrame:
    seg = enqueue_segments(src, parts).filter(F.col("seg").isNotNull())
    keyed = seg.withColumn("_item", F.col("item_id")).withColumn(
        "item_id", F.concat_ws("\u0001", F.col("item_id"), F.col("seg").cast("string")))
    folded = _fold_sorted(keyed.select(*LOG_COLUMNS), "item_id")
    # the segment key is "<ts micros>:<seq>" zero-padded, so it sorts in (ts, seq) order
    folded = folded.withColumn("_item", F.split(F.col("item_id"), "\u0001").getItem(0)).withColumn(
        "_seg", F.split(F.col("item_id"), "\u0001").getItem(1))
    last = F.max_by(F.struct("state", "lease_owner", "lease_until", "last_error", "updated_at"), F.col("_seg"))
    agg = folded.groupBy("_item").agg(
        last.alias("_l"), F.sum("delivery_count").cast("int").alias("delivery_count"),
        F.min("enqueued_at").alias("enqueued_at"), F.min("done_at").alias("done_at"))
    return agg.select(F.col("_item").alias("item_id"), F.col("_l.state").alias("state"),
                      F.col("_l.lease_owner").alias("lease_owner"), F.col("_l.lease_until").alias("lease_until"),
                      "delivery_count", "enqueued_at", "done_at", F.col("_l.last_error").alias("last_error"),
                      F.col("_l.updated_at").alias("updated_at"))


# ---------------------------------------------------------------- F2
def item_status(log: DataFrame) -> DataFrame:
    """current status per item from a status-write log.

    Log: item_id, ts, seq, status, error, and optionally ``requeue``
    (boolean).  NEW and DISPATCHED writes and requeues (to NEW or ANALYZED)
    always apply; other ANALYZED / FAILED writes are ignored while the item is
    DISPATCHED.  Hence the status is DISPATCHED when the latest write that
    always applies is DISPATCHED, else the latest write.  NEW writes and
    requeues clear ``dispatched_at``, so a requeued item is sent again.
    Pure partial aggregates: no per-item buffering, skew-safe.
    """
    clears = F.col("status") == "NEW"
    if "requeue" in log.columns:
        clears = clears | F.coalesce(F.col("requeue"), F.lit(False))
    sent = F.col("status") == "DISPATCHED"
    agg = log.groupBy("item_id").agg(
        F.max(F.when(clears | sent, F.struct("ts", "seq", "status", "error"))).alias("_u"),
        F.max(F.struct("ts", "seq", "status", "error")).alias("_l"),
        F.max(F.when(clears, F.struct("ts", "seq"))).alias("_c"),
        F.max(F.when(sent, F.struct("ts", "seq"))).alias("_d"),
    ).withColumn("dispatched_at", F.when(F.col("_c").isNull() | (F.col("_d") > F.col("_c")), F.col("_d.ts")))
    pinned = F.coalesce(F.col("_u.status") == "DISPATCHED", F.lit(False))
    last = F.when(pinned, F.col("_u")).otherwise(F.col("_l"))
    return agg.select(
        "item_id",
        last["status"].alias("status"),
        F.coalesce(last["error"], F.lit("")).alias("last_error"),
        last["ts"].alias("status_at"),
        "dispatched_at",
    )


def item_record(log: DataFrame) -> DataFrame:
    """F2 with everything a write leaves on the item: status, error and time of
    the last write that applied; ``analyzed_at`` and the stored payload of the
    last ANALYZED write that applied (requeues keep both) and
    ``first_analyzed_at``; ``dispatched_at``, cleared by NEW writes and requeues,
    and ``first_dispatched_at``.

    Log as for :func:`item_status`, with an optional ``payload``.  ANALYZED and
    FAILED writes apply unless the latest NEW, DISPATCHED or requeue write
    before them is DISPATCHED."""
    again = F.coalesce(F.col("requeue"), F.lit(False)) if "requeue" in log.columns else F.lit(False)
    rows = log.select("item_id", "ts", "seq", "status", F.coalesce("error", F.lit("")).alias("error"), again.alias("requeue"),
                      F.col("payload") if "payload" in log.columns else F.lit(None).cast("string").alias("payload"))
    always = F.col("status").isin("NEW", "DISPATCHED") | F.col("requeue")
    marked = running_last(rows, F.when(always, F.struct("ts", "seq", "status")))
    applied = marked.filter(always | F.coalesce(F.col("_mark.status") != "DISPATCHED", F.lit(True)))
    at, here = F.struct("ts", "seq"), F.struct("ts", "seq", "status", "error")
    analyzed, sent = (F.col("status") == "ANALYZED") & ~F.col("requeue"), F.col("status") == "DISPATCHED"
    agg = applied.groupBy("item_id").agg(
        F.max(here).alias("l"), F.max(F.when(analyzed, F.col("ts"))).alias("analyzed_at"), F.min(F.when(analyzed, F.col("ts"))).alias("first_analyzed_at"),
        F.max(F.when(analyzed & F.col("payload").isNotNull(), F.struct("ts", "seq", "payload"))).alias("p"),
        F.max(F.when((F.col("status") == "NEW") | F.col("requeue"), at)).alias("c"), F.max(F.when(sent, at)).alias("d"),
        F.min(F.when(sent, F.col("ts"))).alias("first_dispatched_at"))
    return agg.select("item_id", "l.status", F.col("l.error").alias("last_error"), F.col("l.ts").alias("updated_at"), "analyzed_at", "first_analyzed_at",
                      F.col("p.payload").alias("analyzed_payload_json"),
                      F.when(F.col("c").isNull() | (F.col("d") > F.col("c")), F.col("d.ts")).alias("dispatched_at"), "first_dispatched_at")


# ---------------------------------------------------------------- F3
def claim_batch(snapshot: DataFrame, n: int, now, worker: str, lease_minutes: int = 2) -> DataFrame:
    """the ``n`` oldest claimable items (QUEUED or expired lease) -> claim events.

    ``orderBy().limit(n)`` plans as TakeOrderedAndProject: a per-partition
    top-n then a merge of at most n rows per partition.
    """
    now = ts_lit(now)
    eligible = snapshot.filter(
        (F.col("state") == "QUEUED")
        | ((F.col("state") == "LEASED") & F.col("lease_until").isNotNull() & (F.col("lease_until") <= now)))
    top = eligible.orderBy(F.col("enqueued_at").asc_nulls_first(), "item_id").limit(n)
    return top.select(
        "item_id", now.alias("ts"), F.lit("claim").alias("action"), F.lit(worker).alias("worker"),
        (now + F.make_dt_interval(mins=F.lit(lease_minutes))).alias("lease_until"),
        (F.col("delivery_count") + 1).alias("delivery_count"))


# ---------------------------------------------------------------- F4
def quarantine(failures: DataFrame, snapshot: DataFrame, max_attempts: int = 3) -> DataFrame:
    """per failed claim decide quarantine (fail) or release.

    Quarantine when the message says "missing required analyzed fields" or
    the claim's delivery_count >= ``max_attempts``; reason prefixes follow
    the two outcomes.
    """
    j = failures.join(snapshot.select("item_id", "delivery_count", "lease_owner"), "item_id", "left")
    msg = F.lower(T.trim_space(F.coalesce(F.col("error"), F.lit(""))))
    q = msg.contains(fixed.MISSING_REQUIRED) | (
        F.coalesce(F.col("delivery_count"), F.lit(0)) >= max_attempts)
    return j.select(
        "item_id",
        F.when(q, F.lit("fail")).otherwise(F.lit("release")).alias("action"),
        F.when(q, F.concat(F.lit("poison_item: analysis_failed: "), F.col("error")))
        .otherwise(F.concat(F.lit("analysis_failed: "), F.col("error"))).alias("reason"),
        F.when(q, F.lit("FAILED")).alias("item_status"),
        F.coalesce(F.col("delivery_count"), F.lit(0)).alias("delivery_count"))


# ---------------------------------------------------------------- F5
def feed_state(outcomes: DataFrame, cooldown_minutes: int) -> DataFrame:
    """latest poll outcome per feed -> failure_count, down_until."""
    last = outcomes.groupBy("feed_url").agg(F.max(F.struct("ts", "ok")).alias("_l"))
    ok = F.col("_l.ok")
    return last.select(
        "feed_url",
        F.when(ok, F.lit(0)).otherwise(F.lit(5)).alias("failure_count"),
        F.when(~ok, F.col("_l.ts") + F.make_dt_interval(mins=F.lit(cooldown_minutes))).alias("down_until"),
        F.col("_l.ts").alias("updated_at"))


# ---------------------------------------------------------------- F6
def requeue(ids: DataFrame, items: DataFrame, now) -> DataFrame:
    """requeue requested items.

    Stored payload non-blank -> dispatch enqueue of it, status ANALYZED; else a
    raw enqueue of the raw item rebuilt from the stored columns, status NEW.
    Both clear dispatched_at and the error and count one enqueue.  Unknown ids
    give a ``not_found`` row.  Output: one plan row per requested id with the
    ``payload_json`` to enqueue; :func:`requeue_writes` gives the status writes.
    """
    now = ts_lit(now)
    req = ids.select(T.trim_space(F.col("id")).alias("id")).filter(F.col("id") != "").distinct()

    def stored(name, default):
        return F.coalesce(F.col(name), default) if name in items.columns else default

    none = F.array().cast("array<string>")
    feed = T.trim_space(stored("source_feed_url", F.lit("")))
    raw = S.encode_payload(items.select(
        F.lit("v1").alias("schema_version"), "id", feed.alias("feed_url"), T.source_label(feed).alias("source_label"),
        *[T.trim_space(stored(c, F.lit(""))).alias(c) for c in ("guid", "url", "title", "description")],
        *[stored(c, none).alias(c) for c in ("links", "image_urls")],
        *[stored(c, now).alias(c) for c in ("published_at", "fetched_at")],
        "analyzed_payload_json", "status", F.lit(True).alias("_known")))
    j = req.join(raw.select("id", "analyzed_payload_json", "status", "payload_json", "_known"), "id", "left")
    has_payload = T.trim_space(F.coalesce(F.col("analyzed_payload_json"), F.lit(""))) != ""
    return j.select(
        "id",
        F.when(F.col("_known").isNull(), F.lit("not_found"))
        .when(has_payload, F.lit("dispatch_queue")).otherwise(F.lit("analyzer_queue")).alias("target"),
        F.when(F.col("_known").isNull(), F.lit(None).cast("string"))
        .when(has_payload, F.lit("ANALYZED")).otherwise(F.lit("NEW")).alias("new_status"),
        F.coalesce(F.col("status"), F.lit("")).alias("old_status"),
        F.when(F.col("_known").isNotNull(), now).alias("enqueued_at"),
        F.when(has_payload, F.col("analyzed_payload_json")).otherwise(F.col("payload_json")).alias("payload_json"),
        F.when(F.col("_known").isNotNull(), 1).otherwise(0).alias("enqueue_count_add"))


def requeue_writes(plan: DataFrame, seq: int = 2 ** 62) -> DataFrame:
    """F6 -> F2: the status writes of a requeue plan, for the status log."""
    return plan.filter(F.col("new_status").isNotNull()).select(
        F.col("id").alias("item_id"), F.col("enqueued_at").alias("ts"), F.lit(seq).cast("long").alias("seq"),
        F.col("new_status").alias("status"), F.lit("").alias("error"), F.lit(True).alias("requeue"))


# ---------------------------------------------------------------- F7
def analyzed_projection(analyzed: DataFrame) -> DataFrame:
    """latest analysed record per id; id required; blank category -> default."""
    a = analyzed.filter(T.trim_space(F.coalesce(F.col("id"), F.lit(""))) != "")
    cols = [c for c in a.columns if c not in ("id", "created_at")]
    last = a.groupBy("id").agg(F.max(F.struct("created_at", *cols)).alias("_l")).select("id", "_l.*")
    if "job_category" in last.columns:
        cat = T.trim_space(F.coalesce(F.col("job_category"), F.lit("")))
        last = last.withColumn("job_category", F.when(cat == "", F.lit("Altri ruoli")).otherwise(cat))
    return last


def store_analyzed(items: DataFrame, analyzed: DataFrame, now, payload: str = "payload_json") -> DataFrame:
    """``items`` after the analysed records were stored: those that are not
    DISPATCHED become ANALYZED with the record's payload, the enqueue time, and
    no error; the others, and items without a record, stay as they are."""
    now = ts_lit(now)
    last = analyzed.filter(T.trim_space(F.coalesce(F.col("id"), F.lit(""))) != "").groupBy("id").agg(
        F.max_by(F.col(payload), F.struct("created_at", payload)).alias("_payload"))
    j = items.join(last, "id", "left")
    hit = F.col("_payload").isNotNull() & (F.coalesce(F.col("status"), F.lit("")) != "DISPATCHED")
    new = {"status": F.lit("ANALYZED"), "analyzed_at": now, "analyzed_payload_json": F.col("_payload"), "analyzed_enqueued_at": now, "last_error": F.lit(""),
           "updated_at": now}
    return j.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in items.columns])


# ---------------------------------------------------------------- F8
def apply_receipts(receipts: DataFrame) -> DataFrame:
    """F8: processed receipts -> DISPATCHED status writes (url or id required)."""
    iid = T.trim_space(F.coalesce(F.col("item_id"), F.lit("")))
    url = T.trim_space(F.coalesce(F.col("url"), F.lit("")))
    r = receipts.filter((iid != "") | (url != ""))
    return r.select(
        F.when(iid != "", iid).otherwise(T.item_hash("guid", "url", "title")).alias("item_id"),
        F.col("processed_at").alias("ts"),
        F.lit("DISPATCHED").alias("status"),
        F.lit("").alias("error"),
        T.normalize_url(F.col("url")).alias("url"))


# ---------------------------------------------------------------- F9
def quarantine_stale(snapshot: DataFrame, now, age_minutes: int = 30) -> DataFrame:
    """QUEUED/LEASED items enqueued at or before now - age -> fail events."""
    cutoff = ts_lit(now) - F.make_dt_interval(mins=F.lit(age_minutes))
    stale = snapshot.filter(F.col("state").isin("QUEUED", "LEASED") & (F.col("enqueued_at") <= cutoff))
    return stale.select("item_id", F.lit("DONE").alias("new_state"), F.lit("FAILED").alias("item_status"),
                        F.lit(f"stale_queue_item: older than {age_minutes}m").alias("reason"))


# ---------------------------------------------------------------- F10
def enqueue_counters(log: DataFrame) -> DataFrame:
    """per item, latest enqueue time and number of enqueues."""
    e = log.filter(F.col("action") == "enqueue")
    return e.groupBy("item_id").agg(F.max("ts").alias("last_enqueued_at"),
                                    F.count(F.lit(1)).cast("int").alias("enqueue_count"))


# ---------------------------------------------------------------- F11
def feed_admin(changes: DataFrame, feeds: DataFrame) -> DataFrame:
    """apply admin changes (add / enable / disable / remove / seed) to feeds.

    Sequential meaning: add creates or re-enables; enable/disable act only on
    an existing feed; remove deletes; seed creates a missing feed enabled and
    never re-enables an existing one.  As aggregates per feed: after the last
    remove the feed is gone until the first add/seed re-creates it; the
    value is then the last add/enable/disable from the (re)creation on, else
    true; a feed never removed keeps its initial value unless such an op
    follows.  Two partial-aggregate passes, no per-feed buffering.
    """
    op, ts = F.col("op"), F.col("ts")
    r = changes.groupBy("feed_url").agg(F.max(F.when(op == "remove", ts)).alias("_r"))
    c = changes.join(r, "feed_url").filter(F.col("_r").isNull() | (ts > F.col("_r")))
    setter = op.isin("add", "enable", "disable")
    agg = c.groupBy("feed_url").agg(
        F.min(F.when(op.isin("add", "seed"), ts)).alias("_c"),
        F.max(F.when(setter, F.struct(ts.alias("t"), op.alias("o")))).alias("_last"))
    agg = r.join(agg, "feed_url", "left")
    j = feeds.select("feed_url", F.col("enabled").alias("_e0")).join(agg, "feed_url", "full_outer")
    removed = F.col("_r").isNotNull()
    base_exists = ~removed & F.col("_e0").isNotNull()
    # last setter from the creation on (for a re-created feed) or overall (for an existing one)
    last_after_create = F.when(F.col("_last.t") >= F.col("_c"), F.col("_last.o"))
    val_existing = F.when(F.col("_last").isNotNull(), F.col("_last.o") != "disable").otherwise(F.col("_e0"))
    val_created = F.when(last_after_create.isNotNull(), last_after_create != "disable").otherwise(F.lit(True))
    exists = base_exists | F.col("_c").isNotNull()
    enabled = F.when(base_exists, val_existing).otherwise(val_created)
    return j.filter(exists).select("feed_url", enabled.alias("enabled"))


def feed_admin_state(changes: DataFrame, state: DataFrame) -> DataFrame:
    """the feed state that is left: a removal also removes the feed's state
    up to then, and adding the feed again does not bring it back."""
    gone = changes.filter(F.col("op") == "remove").groupBy("feed_url").agg(F.max("ts").alias("_at")).withColumnRenamed("feed_url", "_url")
    later = F.col("updated_at").isNotNull() & (F.col("updated_at") > F.col("_at"))
    return state.join(gone, (F.col("feed_url") == F.col("_url")) & ~later, "left_anti")


# ---------------------------------------------------------------- F12
def item_status_lookup(ids: DataFrame, items: DataFrame) -> DataFrame:
    """id -> status, last_error and times; unknown ids are flagged."""
    req = ids.select(T.trim_space(F.col("id")).alias("id")).distinct()
    return req.join(items.select("id", "status", "last_error", "updated_at", "analyzed_at", "dispatched_at")
                    .withColumn("found", F.lit(True)), "id", "left").withColumn(
        "found", F.coalesce("found", F.lit(False)))


# ---------------------------------------------------------------- D5-D8
def already_seen(batch: DataFrame, keys: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Split a batch into (new, seen) by existence of ``key``."""
    k = keys.select(key)
    return batch.join(k, key, "left_anti"), batch.join(k, key, "left_semi")


def already_dispatched(queue: DataFrame, items: DataFrame) -> DataFrame:
    """Queue rows flagged ``skip`` when the item is DISPATCHED (case/space
    insensitive) or has dispatched_at set -> completed without sending."""
    i = items.select(F.col("id").alias("item_id"), "status", "dispatched_at")
    j = queue.join(i, "item_id", "left")
    done = (F.upper(T.trim_space(F.coalesce(F.col("status"), F.lit("")))) == "DISPATCHED") | F.col(
        "dispatched_at").isNotNull()
    return j.withColumn("skip", done).drop("status", "dispatched_at")


def already_analyzed(queue: DataFrame, items: DataFrame) -> DataFrame:
    """Queue rows whose item already has a non-blank stored payload -> forward it."""
    i = items.select(F.col("id").alias("item_id"),
                     T.trim_space(F.coalesce(F.col("analyzed_payload_json"), F.lit(""))).alias("stored_payload"))
    j = queue.join(i, "item_id", "left")
    return j.withColumn("cached", F.coalesce(F.col("stored_payload") != "", F.lit(False)))


def poll_request_valid(requests: DataFrame, feeds: DataFrame) -> DataFrame:
    """Poll requests for known feeds only."""
    return requests.join(feeds.select("feed_url"), "feed_url", "left_semi")


# ---------------------------------------------------------------- H5 / H8 / H9
def delete_items(ids: DataFrame, tables: dict[str, tuple[DataFrame, str]]) -> dict[str, DataFrame]:
    """H5: cascade delete of ``ids`` over several tables, plus unknown ids.

    ``tables`` maps a name to (frame, key column).  Returns the kept rows per
    table and ``not_found`` (ids present in none of them).
    """
    req = ids.select(T.trim_space(F.col("id")).alias("_id")).distinct()
    out = {}
    found = None
    for name, (df, key) in tables.items():
        out[name] = df.join(req, df[key] == req["_id"], "left_anti")
        hit = df.select(F.col(key).alias("_id")).join(req, "_id", "left_semi")
        found = hit if found is None else found.unionByName(hit)
    out["not_found"] = req.join(found.distinct(), "_id", "left_anti").withColumnRenamed("_id", "id")
    return out


def backoff_plan(failed: DataFrame, attempts: int, base_seconds: float, ts: str = "ts") -> DataFrame:
    """H8: planned retry times base * 2^(i-1) after each failed attempt."""
    i = F.explode(F.sequence(F.lit(1), F.lit(attempts))).alias("attempt")
    e = failed.select("*", i)
    delay = F.lit(base_seconds) * F.pow(F.lit(2.0), F.col("attempt") - 1)
    return e.withColumn("delay_s", delay).withColumn(
        "retry_at", F.col(ts) + F.make_dt_interval(secs=F.col("delay_s").cast("decimal(18,6)")))


def cascade_orphans(items: DataFrame, queue: DataFrame) -> tuple[DataFrame, DataFrame]:
    """H9: queue rows without items, and items without a queue row."""
    q = queue.select("item_id").distinct()
    i = items.select(F.col("id").alias("item_id"))
    return queue.join(i, "item_id", "left_anti"), items.join(
        q.withColumnRenamed("item_id", "id"), "id", "left_anti")
