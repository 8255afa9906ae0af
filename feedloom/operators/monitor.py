"""Monitoring views: joins of items with queue snapshots, zero-filled state
counts, the queue monitor, dense per-minute ratio series, lanes, latencies.

All counts are conditional aggregates in one pass (partial aggregation on
the map side); fixed domains are tiny literal frames joined on the small
aggregated side.  Per-lane top-n uses the two-stage ranking of
``ingest.top_n_per_group`` because only six lanes exist (heavy skew).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedloom.functions import fixed
from feedloom.functions import text as T
from feedloom.operators.ingest import top_n_per_group
from feedloom.session import reliable_checkpoint, scratch_path, ts_lit


def _domain(spark: SparkSession, name: str, values: list[str]) -> DataFrame:
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"ord int, {name} string")


def zero_fill(counts: DataFrame, spark: SparkSession, name: str, values: list[str],
              count_col: str = "n") -> DataFrame:
    """Counts over a fixed domain: missing values get 0, unknown values are dropped."""
    dom = F.broadcast(_domain(spark, name, values))
    return dom.join(counts, name, "left").select(
        name, F.coalesce(F.col(count_col), F.lit(0)).cast("long").alias(count_col))


# ---------------------------------------------------------------- D1
def feeds_with_state(feeds: DataFrame, state: DataFrame) -> DataFrame:
    """Feeds left-joined with their state (failure_count defaults to 0)."""
    s = state.select("feed_url", "failure_count", "down_until")
    return feeds.select("feed_url", "enabled").join(s, "feed_url", "left").withColumn(
        "failure_count", F.coalesce("failure_count", F.lit(0)))


# ---------------------------------------------------------------- D2 / D3
def item_queue_state(status: Column, aq_item: Column, aq_state: Column, analyzed_enq: Column) -> Column:
    """The nine-way item-view queue state."""
    return (F.when((status == "NEW") & aq_item.isNull(), "not_enqueued_raw")
            .when((status == "NEW") & (aq_state == "QUEUED"), "queued_raw")
            .when((status == "NEW") & (aq_state == "LEASED"), "inflight_raw")
            .when((status == "NEW") & (aq_state == "DONE"), "processed_raw")
            .when((status == "ANALYZED") & analyzed_enq.isNull(), "not_enqueued_analyzed")
            .when(status == "ANALYZED", "queued_analyzed")
            .when(status == "DISPATCHED", "dispatched")
            .when(status == "FAILED", "failed")
            .otherwise("unknown"))


def items_with_queue_state(items: DataFrame, aq: DataFrame) -> DataFrame:
    """Items left-joined with the analyzer queue + derived queue_state."""
    a = aq.select(F.col("item_id").alias("_aq_item"), F.col("state").alias("_aq_state"))
    j = items.join(a, items["id"] == a["_aq_item"], "left")
    return j.withColumn("queue_state", item_queue_state(
        F.col("status"), F.col("_aq_item"), F.col("_aq_state"), F.col("analyzed_enqueued_at")))


def item_flags(df: DataFrame) -> DataFrame:
    """D3: raw_enqueued, analyzed_enqueued, has_analyzed (on D2 output)."""
    return df.select(
        "*",
        (F.col("_aq_item").isNotNull() | F.col("status").isin("ANALYZED", "DISPATCHED")).alias("raw_enqueued"),
        (F.col("analyzed_enqueued_at").isNotNull() | (F.col("status") == "DISPATCHED")).alias("analyzed_enqueued"),
        (T.trim_space(F.coalesce(F.col("analyzed_payload_json"), F.lit(""))) != "").alias("has_analyzed"))


# ---------------------------------------------------------------- D4
def board(items: DataFrame, aq: DataFrame, dq: DataFrame) -> DataFrame:
    """Items with both queues -> lane ('' = off board), board queue_state,
    priority and fifo_ts."""
    a = aq.select(F.col("item_id").alias("_ai"), F.col("state").alias("_as"), F.col("enqueued_at").alias("_ae"))
    d = dq.select(F.col("item_id").alias("_di"), F.col("state").alias("_ds"), F.col("enqueued_at").alias("_de"))
    j = items.join(a, items["id"] == a["_ai"], "left").join(d, items["id"] == d["_di"], "left")
    st, as_, ds = F.col("status"), F.col("_as"), F.col("_ds")
    lane = (F.when(as_ == "LEASED", "raw_inflight").when(as_ == "QUEUED", "raw_backlog")
            .when(ds == "LEASED", "analyzed_inflight").when(ds == "QUEUED", "analyzed_backlog")
            .when(st == "FAILED", "failed").when(st == "DISPATCHED", "")
            .when((st == "ANALYZED") & (ds == "DONE"), "anomalies")
            .when((st == "NEW") & (as_ == "DONE"), "anomalies")
            .when((st == "ANALYZED") & F.col("_di").isNull(), "anomalies")
            .when((st == "NEW") & F.col("_ai").isNull(), "anomalies")
            .otherwise(""))
    qs = (F.when(as_ == "LEASED", "inflight_raw").when(as_ == "QUEUED", "queued_raw")
          .when(as_ == "DONE", "processed_raw").when(ds == "LEASED", "inflight_analyzed")
          .when(ds == "QUEUED", "queued_analyzed").when(ds == "DONE", "processed_analyzed")
          .when((st == "NEW") & F.col("_ai").isNull(), "not_enqueued_raw")
          .when((st == "ANALYZED") & F.col("_di").isNull(), "not_enqueued_analyzed")
          .when(st == "DISPATCHED", "dispatched").when(st == "FAILED", "failed").otherwise("unknown"))
    prio = (F.when(as_ == "QUEUED", 1).when(as_ == "LEASED", 2).when(ds == "QUEUED", 3)
            .when(ds == "LEASED", 4).when(st == "FAILED", 5).otherwise(6))
    fifo = (F.when(st == "NEW", F.coalesce(F.col("_ae"), F.col("created_at"), F.col("updated_at")))
            .when(st == "ANALYZED", F.coalesce(F.col("_de"), F.col("analyzed_enqueued_at"),
                                               F.col("updated_at"), F.col("created_at")))
            .otherwise(F.coalesce(F.col("updated_at"), F.col("created_at"))))
    return j.select(
        "id", "title", "url", "status", lane.alias("lane"), qs.alias("queue_state"),
        "source_feed_url", T.source_label(F.coalesce(F.col("source_feed_url"), F.lit(""))).alias("source_label"),
        "created_at", "updated_at", F.coalesce(F.col("last_error"), F.lit("")).alias("last_error"),
        prio.alias("priority"), fifo.alias("fifo_ts"))


# ---------------------------------------------------------------- G1
def overview(feeds: DataFrame, items: DataFrame) -> DataFrame:
    """G1: feeds on/off and item counts by three statuses, one row.

    One aggregate over a tagged union of the two narrow projections.
    """
    u = feeds.select(F.lit("f").alias("_t"), F.col("enabled"), F.lit(None).cast("string").alias("status")) \
        .unionByName(items.select(F.lit("i").alias("_t"), F.lit(None).cast("boolean").alias("enabled"), "status"))
    f, i = F.col("_t") == "f", F.col("_t") == "i"
    return u.agg(F.count_if(f & F.col("enabled")).alias("feeds_enabled"),
                 F.count_if(f & ~F.col("enabled")).alias("feeds_disabled"),
                 F.count_if(i & (F.col("status") == "NEW")).alias("items_new"),
                 F.count_if(i & (F.col("status") == "DISPATCHED")).alias("items_dispatched"),
                 F.count_if(i & (F.col("status") == "ANALYZED")).alias("items_analyzed"))


# ---------------------------------------------------------------- G2 / G4 / G5
def queue_state_counts(aq: DataFrame, dq: DataFrame) -> DataFrame:
    """(queue, stage, state) counts, zero-filled over QUEUED/LEASED/DONE."""
    spark = aq.sparkSession
    parts = []
    for q, stage, df in (("analyzer_queue", "raw", aq), ("dispatch_queue", "analyzed", dq)):
        c = df.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
        parts.append(zero_fill(c, spark, "state", fixed.QUEUE_STATES).select(
            F.lit(q).alias("queue"), F.lit(stage).alias("pipeline_stage"), "state", "n"))
    return parts[0].unionByName(parts[1])


def status_counts(items: DataFrame) -> DataFrame:
    """Items per status, zero-filled."""
    c = items.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return zero_fill(c, items.sparkSession, "status", fixed.ITEM_STATUSES)


def derived_state_counts(items: DataFrame, aq: DataFrame) -> DataFrame:
    """D2 grouped by queue_state, zero-filled over the nine states."""
    c = items_with_queue_state(items, aq).groupBy("queue_state").agg(F.count(F.lit(1)).alias("n"))
    return zero_fill(c, items.sparkSession, "queue_state", fixed.DERIVED_QUEUE_STATES)


# ---------------------------------------------------------------- G3
def feed_report(feeds: DataFrame, state: DataFrame, items: DataFrame, now) -> DataFrame:
    """D1 + item count per feed (one aggregate, not one count per feed) + health."""
    now = ts_lit(now)
    counts = items.groupBy(F.col("source_feed_url").alias("feed_url")).agg(
        F.count(F.lit(1)).alias("items_count"))
    f = feeds_with_state(feeds, state).join(counts, "feed_url", "left")
    broken = F.col("down_until").isNotNull() & (F.col("down_until") > now)
    health = F.when(~F.col("enabled"), "disabled").when(broken, "broken").otherwise("ok")
    reason = (F.when(~F.col("enabled"), fixed.FEED_DISABLED)
              .when(broken, fixed.FEED_BROKEN).otherwise(""))
    return f.select("feed_url", "enabled", "failure_count", "down_until",
                    health.alias("health_status"), reason.alias("health_reason"),
                    T.source_label(F.col("feed_url")).alias("source_label"),
                    F.coalesce(F.col("items_count"), F.lit(0)).alias("items_count"))


# ---------------------------------------------------------------- G6
def queue_monitor(items: DataFrame, aq: DataFrame, dq: DataFrame, now) -> DataFrame:
    """Depths, totals, stuck counts, last-5-minute counts, blocked flags; one row.

    One conditional-aggregate pass over a tagged union of the three inputs.
    """
    now = ts_lit(now)
    m10 = now - F.make_dt_interval(mins=F.lit(10))
    m5 = now - F.make_dt_interval(mins=F.lit(5))
    nts, nstr = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("string")
    q = lambda df, tag: df.select(F.lit(tag).alias("_t"), F.col("state"), F.col("enqueued_at"),
                                  nstr.alias("status"), nts.alias("created_at"), nts.alias("analyzed_at"),
                                  nts.alias("dispatched_at"))
    u = q(aq, "a").unionByName(q(dq, "d")).unionByName(items.select(
        F.lit("i").alias("_t"), nstr.alias("state"), nts.alias("enqueued_at"),
        "status", "created_at", "analyzed_at", "dispatched_at"))
    a, d, i = F.col("_t") == "a", F.col("_t") == "d", F.col("_t") == "i"
    st, stat = F.col("state"), F.col("status")
    r = u.agg(
        F.count_if(a & (st == "QUEUED")).alias("raw_backlog"),
        F.count_if(a & (st == "LEASED")).alias("raw_inflight"),
        F.count_if(d & (st == "QUEUED")).alias("analyzed_backlog"),
        F.count_if(d & (st == "LEASED")).alias("analyzed_inflight"),
        F.count_if(i & (stat == "FAILED")).alias("failed"),
        F.count_if(i & (stat == "DISPATCHED") & F.col("dispatched_at").isNotNull()).alias("dispatched_total"),
        F.count_if(a & st.isin("QUEUED", "LEASED") & (F.col("enqueued_at") <= m10)).alias("stuck_new_10m"),
        F.count_if(i & (stat == "ANALYZED") & (F.col("analyzed_at") < m10)).alias("stuck_analyzed_10m"),
        F.count_if(i & (F.col("created_at") >= m5)).alias("new_last_5m"),
        F.count_if(i & (F.col("dispatched_at") >= m5)).alias("dispatched_last_5m"))
    return r.select("*",
                    ((F.col("stuck_new_10m") > 0) & (F.col("raw_backlog") > 0)).alias("consumer_blocked_raw"),
                    ((F.col("stuck_analyzed_10m") > 0) & (F.col("analyzed_backlog") > 0))
                    .alias("consumer_blocked_analyzed"))


# ---------------------------------------------------------------- G7
RUNTIME_DEFAULT = {
    "name": "job-analyzer", "model": "", "endpoint": "", "timeout": "20s", "max_tokens": 512,
    "thinking_enabled": False, "max_concurrency": 1, "max_jobs_per_min": 20,
    "queue_poll_interval": "1200ms", "lease_duration": "2m",
}


def runtime_latest(snapshots: DataFrame, now, horizon_minutes: int = 20,
                   default: dict | None = None) -> DataFrame:
    """Latest snapshot per worker updated within the horizon, newest first;
    a single default row when none is recent."""
    spark = snapshots.sparkSession
    since = ts_lit(now) - F.make_dt_interval(mins=F.lit(horizon_minutes))
    cols = list(RUNTIME_DEFAULT)
    last = (snapshots.groupBy("worker_id").agg(F.max(F.struct("updated_at", *cols)).alias("_s"))
            .select("worker_id", "_s.*").filter(F.col("updated_at") >= since))
    d = dict(RUNTIME_DEFAULT, **(default or {}))
    dflt = spark.createDataFrame([tuple(d[c] for c in cols)], last.select(*cols).schema)
    # default only when ``last`` is empty: anti join on a constant key, no collect
    flag = last.select(F.lit(1).alias("_k")).limit(1)
    dflt = (dflt.withColumn("_k", F.lit(1)).join(flag, "_k", "left_anti").drop("_k")
            .select(F.lit(None).cast("string").alias("worker_id"), *cols,
                    F.lit(None).cast("timestamp_ntz").alias("updated_at")))
    return last.select("worker_id", *cols, "updated_at").unionByName(dflt).orderBy(F.desc_nulls_last("updated_at"), "worker_id")


# ---------------------------------------------------------------- G8 / G9
def minute_counts(items: DataFrame, ts_col: str, since) -> DataFrame:
    """Count per UTC minute of ``ts_col`` >= since (nulls skipped)."""
    since = ts_lit(since)
    return (items.filter(F.col(ts_col).isNotNull() & (F.col(ts_col) >= since))
            .groupBy(F.date_trunc("minute", F.col(ts_col)).cast("timestamp_ntz").alias("minute"))
            .agg(F.count(F.lit(1)).alias("n")))


def ratio_series(items: DataFrame, now, minutes: int = 180) -> DataFrame:
    """Dense minutes now-(minutes-1) .. now (truncated): new, dispatched,
    ratio = new/dispatched (null when no dispatch)."""
    spark = items.sparkSession
    end = F.date_trunc("minute", ts_lit(now)).cast("timestamp_ntz")
    start = end - F.make_dt_interval(mins=F.lit(minutes - 1))
    grid = spark.range(minutes).select(
        (start + F.make_dt_interval(mins=F.col("id"))).alias("minute"))
    new = minute_counts(items, "created_at", start).withColumnRenamed("n", "new_count")
    disp = minute_counts(items, "dispatched_at", start).withColumnRenamed("n", "dispatched_count")
    g = grid.join(new, "minute", "left").join(disp, "minute", "left")
    n = F.coalesce(F.col("new_count"), F.lit(0))
    d = F.coalesce(F.col("dispatched_count"), F.lit(0))
    return g.select("minute", n.alias("new_count"), d.alias("dispatched_count"),
                    F.when(d > 0, F.round(n.cast("double") / d, 6)).alias("ratio"))


# ---------------------------------------------------------------- G10 / H2
def lane_counts(board_df: DataFrame) -> DataFrame:
    """Items per lane over the six lanes, zero-filled; '' excluded."""
    c = board_df.filter(F.col("lane") != "").groupBy("lane").agg(F.count(F.lit(1)).alias("n"))
    out = zero_fill(c, board_df.sparkSession, "lane", fixed.BOARD_LANES)
    titles = F.create_map(*[x for k, v in fixed.BOARD_LANE_TITLES.items() for x in (F.lit(k), F.lit(v))])
    return out.select("lane", F.element_at(titles, F.col("lane")).alias("title"), "n")


def board_lanes(board_df: DataFrame, limit_per_lane: int = 100) -> DataFrame:
    """H2: per lane keep ``limit_per_lane`` items by (priority, fifo_ts nulls
    first, created_at); invalid limits (outside 1..500) fall back to 100."""
    n = limit_per_lane if 0 < limit_per_lane <= 500 else 100
    on = board_df.filter(F.col("lane") != "")
    order = [F.col("priority").asc(), F.col("fifo_ts").asc_nulls_first(),
             F.col("created_at").asc_nulls_first(), F.col("id").asc()]
    return top_n_per_group(on, ["lane"], order, n, rank_col="rank")


# ---------------------------------------------------------------- H3
def feed_items_page(items: DataFrame, aq: DataFrame, feed_url: str, limit: int = 100) -> DataFrame:
    """H3: one feed's items, newest first, with D2 state and D3 flags."""
    n = limit if 0 < limit <= 500 else 100
    f = items.filter(F.col("source_feed_url") == feed_url)
    flagged = item_flags(items_with_queue_state(f, aq))
    return (flagged.orderBy(F.col("created_at").desc_nulls_last(), "id").limit(n)
            .select("id", "created_at", "title", "url", "status", "queue_state",
                    "raw_enqueued", "analyzed_enqueued", "has_analyzed"))


# ---------------------------------------------------------------- G11 / G12
def rate_windows(events: DataFrame, ts_col: str, label: str, window_minutes: int = 5,
                 slide_minutes: int = 1) -> DataFrame:
    """Per-second rate per label over sliding windows (dashboard panels)."""
    w = F.window(F.col(ts_col), f"{window_minutes} minutes", f"{slide_minutes} minute")
    return (events.groupBy(w.alias("w"), F.col(label))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), label, "n",
                    F.round(F.col("n") / F.lit(window_minutes * 60.0), 6).alias("per_second")))


def _stage_durations(items: DataFrame) -> DataFrame:
    secs = lambda a, b: (F.unix_micros(F.col(b).cast("timestamp")) -  # noqa: E731
                         F.unix_micros(F.col(a).cast("timestamp"))) / 1e6
    st = F.explode(F.array(
        F.struct(F.lit("analyze").alias("stage"), secs("created_at", "analyzed_at").alias("s")),
        F.struct(F.lit("dispatch").alias("stage"), secs("analyzed_at", "dispatched_at").alias("s")),
        F.struct(F.lit("end_to_end").alias("stage"), secs("created_at", "dispatched_at").alias("s"))))
    return items.select(st.alias("x")).select("x.stage", "x.s").filter(F.col("s").isNotNull())


def stage_latency(items: DataFrame) -> DataFrame:
    """Per stage count, mean, min, max seconds (from item timestamps)."""
    return _stage_durations(items).groupBy("stage").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("s"), 6).alias("mean_s"),
        F.round(F.min("s"), 6).alias("min_s"), F.round(F.max("s"), 6).alias("max_s"))


#: Distinct values that are counted up in one task, and splitters of a round.
PERCENTILE_VALUES, SPLITTERS = 50_000, 63
#: Groups up to which the open ranges are joined map-side (their number is counted).
FEW_GROUPS = 10_000


def exact_percentiles(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """Discrete percentiles per group: the smallest value whose cumulative
    count reaches ``ceil(share * n)``.

    Equal values are counted before the shuffle.  For every (group, share) a
    range of values is open, at first all.  While one holds more than
    PERCENTILE_VALUES distinct values, splitters at their approximate quantiles
    (a sketch, so that a long tail is only one of the parts) cut it, counts per
    part find the one that holds the rank, and that becomes the range.  What is
    left is counted up by one window."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.filter(F.col(value).isNotNull()).groupBy(group, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c")).write.parquet(path)
    counts = spark.read.parquet(path)
    totals = counts.groupBy(group).agg(F.sum("_c").alias("n"), F.count(F.lit(1)).alias("_m"))
    kind = counts.schema["_v"].dataType
    names = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.ceil(F.lit(q) * F.col("n") - 1e-9).alias("rank")) for k, q in shares.items()]))
    open_ = reliable_checkpoint(totals.select(group, "n", "_m", names.alias("q")).select(
        group, "n", "_m", "q.*", F.lit(None).cast(kind).alias("_lo"), F.lit(None).cast(kind).alias("_hi"), F.lit(0).cast("long").alias("_before")))
    few = open_.count() <= FEW_GROUPS

    def inside() -> DataFrame:
        """The distinct values of the open ranges, above ``_lo`` up to ``_hi``."""
        ranges = open_.withColumnRenamed(group, "_g")
        met = counts.join(F.broadcast(ranges) if few else ranges, counts[group].eqNullSafe(F.col("_g")))
        return met.filter((F.col("_lo").isNull() | (F.col("_v") > F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_v") <= F.col("_hi"))))

    def splitters(rows: DataFrame) -> DataFrame:
        """About evenly spaced values of every range, by a sketch: partial aggregates, whatever a range holds."""
        return rows.groupBy(group, "name").agg(F.sort_array(F.array_distinct(F.percentile_approx(
            "_v", [i / (SPLITTERS + 1) for i in range(1, SPLITTERS + 1)], 2000))).alias("_s"))

    while (open_.agg(F.max("_m")).first()[0] or 0) > PERCENTILE_VALUES:
        wide = inside().filter(F.col("_m") > PERCENTILE_VALUES)
        cuts = reliable_checkpoint(splitters(wide)).withColumnsRenamed({group: "_sg", "name": "_sn"})
        cut = wide.join(F.broadcast(cuts) if few else cuts, wide[group].eqNullSafe(F.col("_sg")) & (wide["name"] == F.col("_sn")))
        part = cut.withColumn("_b", F.size(F.filter("_s", lambda x: x < F.col("_v"))))
        sums = part.groupBy(group, "name", "_b").agg(*[F.first(c).alias(c) for c in ("n", "rank", "_lo", "_hi", "_before", "_s")],
                                                     F.sum("_c").alias("_sum"), F.count(F.lit(1)).alias("_k"))
        upto = F.sum("_sum").over(Window.partitionBy(group, "name").orderBy("_b"))
        hit = sums.withColumn("_upto", F.col("_before") + upto).filter((F.col("_upto") >= F.col("rank")) & (F.col("_upto") - F.col("_sum") < F.col("rank")))
        narrowed = hit.select(group, "n", F.col("_k").alias("_m"), "name", "rank", F.coalesce(F.get("_s", F.col("_b") - 1), "_lo").alias("_lo"),
                              F.coalesce(F.get("_s", F.col("_b")), "_hi").alias("_hi"), (F.col("_upto") - F.col("_sum")).alias("_before"))
        open_ = reliable_checkpoint(open_.filter(F.col("_m") <= PERCENTILE_VALUES).unionByName(narrowed))
    w = Window.partitionBy(group, "name").orderBy("_v")
    reached = inside().withColumn("_cum", F.col("_before") + F.sum("_c").over(w)).filter(F.col("_cum") >= F.col("rank"))
    return reached.groupBy(group).agg(F.max("n").alias("n"), *[F.min(F.when(F.col("name") == k, F.col("_v"))).alias(k) for k in shares])


def stage_latency_p95(items: DataFrame) -> DataFrame:
    """Exact p50/p95 per stage."""
    return exact_percentiles(_stage_durations(items), "stage", "s", {"p50_s": 0.5, "p95_s": 0.95})


#: Growth of a sketch's buckets; an estimate is within (GAMMA - 1) / (GAMMA + 1) of its value, about 1 %.
GAMMA = 1.02


def latency_sketch(samples: DataFrame, series: str, ts: str, value: str, gamma: float = GAMMA) -> DataFrame:
    """The stored aggregate ``(series, minute, bucket, n)``.

    Bucket ``i`` holds the values above ``gamma ** (i - 1)`` up to ``gamma **
    i``; values at or below 0 are in the null bucket.  Sketches of any rows are
    merged by adding ``n``; nulls do not count."""
    v = F.col(value).cast("double")
    return samples.filter(v.isNotNull() & F.col(ts).isNotNull()).groupBy(
        F.col(series).alias("series"), F.date_trunc("minute", F.col(ts)).cast("timestamp_ntz").alias("minute"),
        F.when(v > 0, F.ceil(F.round(F.log(v) / F.lit(math.log(gamma)), 9))).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """One sketch of the rows of all."""
    every = sketches[0]
    for s in sketches[1:]:
        every = every.unionByName(s)
    return every.groupBy("series", "minute", "bucket").agg(F.sum("n").alias("n"))


def window_quantiles(sketch: DataFrame, shares: dict[str, float], minutes: int = 5, gamma: float = GAMMA) -> DataFrame:
    """Quantiles per series and window of ``minutes``, one window a minute, from
    the sketch alone.  A quantile is its bucket's middle, within the sketch's
    relative error of the smallest value whose cumulative count reaches
    ``ceil(share * n)``.  A (series, window) has at most as many rows as buckets."""
    windows = sketch.select("series", F.explode(F.transform(F.sequence(F.lit(1), F.lit(minutes)), lambda k: F.col("minute") + F.make_dt_interval(mins=k))).alias("until"),
                            "bucket", "n").groupBy("series", "until", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("series", "until")
    up = windows.withColumn("total", F.sum("n").over(w)).withColumn("cum", F.sum("n").over(w.orderBy(F.col("bucket").asc_nulls_first())))
    middle = F.coalesce(F.lit(2 / (gamma + 1)) * F.pow(F.lit(gamma), F.col("bucket")), F.lit(0.0))
    reached = [F.min(F.when(F.col("cum") >= F.ceil(F.lit(q) * F.col("total") - 1e-9), middle)).alias(k) for k, q in shares.items()]
    return up.groupBy("series", "until").agg(F.max("total").alias("n"), *reached)


def stage_latency_windows(items: DataFrame, minutes: int = 5) -> DataFrame:
    """p50 and p95 per stage and window, the dashboard's panels, from per-minute sketches."""
    secs = lambda a, b: (F.unix_micros(F.col(b).cast("timestamp")) - F.unix_micros(F.col(a).cast("timestamp"))) / 1e6
    st = F.explode(F.array(*[F.struct(F.lit(name).alias("stage"), F.col(b).alias("at"), secs(a, b).alias("s")) for name, a, b in (
        ("analyze", "created_at", "analyzed_at"), ("dispatch", "analyzed_at", "dispatched_at"), ("end_to_end", "created_at", "dispatched_at"))]))
    samples = items.select(st.alias("x")).select("x.*")
    return window_quantiles(latency_sketch(samples, "stage", "at", "s"), {"p50_s": 0.5, "p95_s": 0.95}, minutes)


def counter_rates(samples: DataFrame, series: str, ts: str, value: str, order: str | None = None, minutes: int = 5) -> DataFrame:
    """Per-second rate of cumulative counters, one window of ``minutes`` a minute.

    A value below the one before is a reset: the counter began again at 0.  A
    window's increase is that from its first to its last sample, extended to the
    window's edges: on each side by the time to the edge if that is below 1.1
    average distances between samples, else by half of one, and at the start
    never below 0.  Windows with fewer than two samples, or all at one time,
    have no rate.  Samples of one time go by ``order``; rows with a null series,
    time or value do not count.

    Samples become one pane a (series, minute); a pane's increase is summed
    inside it, the steps between panes come from its neighbours, and windows are
    frames over panes: no sample is copied into windows."""
    t = (F.unix_micros(F.col(ts).cast("timestamp")) / 1e6)
    rows = samples.select(F.col(series).alias("series"), t.alias("t"), F.col(value).cast("double").alias("v"), (F.col(order) if order else F.lit(0)).alias("o")) \
        .filter("series is not null and t is not null and v is not null").withColumn("pane", F.floor(F.col("t") / 60))
    step = lambda now, was: F.when(was.isNull(), F.lit(0.0)).when(now < was, now).otherwise(now - was)
    place = F.struct("t", "o", "v")
    inner = rows.withColumn("d", step(F.col("v"), F.lag("v").over(Window.partitionBy("series", "pane").orderBy("t", "o", "v"))))
    panes = inner.groupBy("series", "pane").agg(F.min(place).alias("a"), F.max(place).alias("z"), F.count(F.lit(1)).alias("n"), F.sum("d").alias("d"))
    by_pane = Window.partitionBy("series").orderBy("pane")
    linked = panes.withColumn("link", step(F.col("a.v"), F.lag("z.v").over(by_pane)))
    frame = by_pane.rangeBetween(-(minutes - 1), 0)
    # windows end with every minute up to the last that still holds a pane
    ends = linked.select("series", F.explode(F.sequence(F.col("pane"), F.col("pane") + (minutes - 1))).alias("pane")).distinct()
    full = ends.join(linked, ["series", "pane"], "left")
    first = lambda c: F.first(c, ignorenulls=True).over(frame)
    seen = full.select("series", "pane", F.sum("n").over(frame).alias("n"), first("a").alias("a"), F.last("z", ignorenulls=True).over(frame).alias("z"),
                       (F.sum(F.col("d") + F.col("link")).over(frame) - first("link")).alias("up"))
    sampled = F.col("z.t") - F.col("a.t")
    mean = sampled / (F.col("n") - 1)
    to_start, to_end = F.col("a.t") - (F.col("pane") - (minutes - 1)) * 60, (F.col("pane") + 1) * 60 - F.col("z.t")
    to_zero = F.when((F.col("up") > 0) & (F.col("a.v") >= 0), sampled * F.col("a.v") / F.col("up"))
    to_start = F.least(to_start, F.coalesce(to_zero, to_start))
    reach = sampled + F.when(to_start < mean * 1.1, to_start).otherwise(mean / 2) + F.when(to_end < mean * 1.1, to_end).otherwise(mean / 2)
    return seen.filter((F.col("n") > 1) & (sampled > 0)).select(
        "series", F.timestamp_seconds((F.col("pane") + 1) * 60).cast("timestamp_ntz").alias("until"), "n", F.col("up").alias("increase"),
        (F.col("up") * reach / sampled / (60.0 * minutes)).alias("per_second"))


# ---------------------------------------------------------------- G13 / G14 / G15
def job_counters(outcomes: DataFrame) -> DataFrame:
    """Counts by (stage, outcome, reason)."""
    return outcomes.groupBy("stage", "outcome", "reason").agg(F.count(F.lit(1)).alias("n"))


def scrape_failures(excerpts: DataFrame, extractor: str) -> DataFrame:
    """Page fetches of items with a URL that gave no excerpt, by extractor
    and reason, from C5's ``excerpt_reason``."""
    failed = excerpts.filter((F.col("excerpt_reason") != "") & (T.trim_space(F.coalesce(F.col("url"), F.lit(""))) != ""))
    return failed.groupBy(F.lit(extractor).alias("extractor"), F.col("excerpt_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def sla_report(items: DataFrame, accepted: DataFrame | None = None) -> DataFrame:
    """Per ISO week: share dispatched within 5 minutes of creation, and
    the share of items with a stored payload (completeness of the required
    fields is in :func:`sla_quality`)."""
    wk = F.date_trunc("week", F.col("created_at")).cast("timestamp_ntz")
    lat = (F.unix_micros(F.col("dispatched_at").cast("timestamp"))
           - F.unix_micros(F.col("created_at").cast("timestamp")))
    agg = items.groupBy(wk.alias("week")).agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col("dispatched_at").isNotNull()).alias("dispatched"),
        F.count_if(F.col("dispatched_at").isNotNull() & (lat <= 300 * 1000000)).alias("dispatched_5m"),
        F.count_if(T.trim_space(F.coalesce(F.col("analyzed_payload_json"), F.lit(""))) != "")
        .alias("with_payload"))
    return agg.select("*",
                      F.when(F.col("dispatched") > 0, F.round(F.col("dispatched_5m") / F.col("dispatched"), 6))
                      .alias("share_5m"),
                      F.round(F.col("with_payload") / F.col("items"), 6).alias("payload_share"))


def extract_counters(extractions: DataFrame) -> DataFrame:
    """Extraction requests by result: count and duration mean/min/max."""
    return extractions.groupBy("result").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("duration_ms"), 6).alias("mean_ms"),
        F.min("duration_ms").alias("min_ms"), F.max("duration_ms").alias("max_ms"))


def extract_duration_p95(extractions: DataFrame) -> DataFrame:
    """Exact p95 extraction duration per result."""
    return exact_percentiles(extractions, "result", "duration_ms", {"p95_ms": 0.95}).select("result", "p95_ms")


def sla_duplicates(outcomes: DataFrame, ts: str = "published") -> DataFrame:
    """Weekly duplicate share of ingest outcomes (target <= 0.1 %)."""
    wk = F.date_trunc("week", F.col(ts)).cast("timestamp_ntz")
    agg = outcomes.groupBy(wk.alias("week")).agg(
        F.count(F.lit(1)).alias("items"), F.count_if(F.col("outcome") == "duplicate").alias("duplicates"))
    return agg.withColumn("duplicate_share", F.round(F.col("duplicates") / F.col("items"), 6))


def sla_quality(analyzed: DataFrame) -> DataFrame:
    """Required-field completeness (role, company, location or remote
    type, summary) and link / image coverage of analysed items (>= 95 %)."""
    def filled(c):
        return T.trim_space(F.coalesce(F.col(c), F.lit(""))) != ""
    complete = filled("role") & filled("company") & (filled("location") | filled("remote_type")) & filled("summary_it")
    agg = analyzed.agg(
        F.count(F.lit(1)).alias("items"), F.count_if(complete).alias("complete"),
        F.count_if(F.size(F.coalesce(F.col("original_links"), F.array().cast("array<string>"))) > 0).alias("with_links"),
        F.count_if(F.size(F.coalesce(F.col("original_images"), F.array().cast("array<string>"))) > 0)
        .alias("with_images"))
    return agg.select("*", F.round(F.col("complete") / F.col("items"), 6).alias("completeness"),
                      F.round(F.col("with_links") / F.col("items"), 6).alias("link_coverage"),
                      F.round(F.col("with_images") / F.col("items"), 6).alias("image_coverage"))
