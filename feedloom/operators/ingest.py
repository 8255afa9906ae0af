"""Ingest jobs: raw items, hash dedupe, per-feed caps, three-key greedy dedupe,
cold start, seen keys, due feeds, duplicate rates, retention.

Every job is declarative; skewed groups (one feed or one key holding a large
share of the rows) are handled by partial aggregation or by the two-stage
top-n in :func:`top_n_per_group`, never by buffering a whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from feedloom.functions import text as T
from feedloom.session import checkpoint_dir, reliable_checkpoint, scratch_path, ts_lit


def _opt(df: DataFrame, name: str) -> Column | None:
    return F.col(name) if name in df.columns else None


# ---------------------------------------------------------------- A3
def raw_items(batch: DataFrame, now) -> DataFrame:
    """A3 (+B3, B4, B7, B8): one RawItem row per feed entry.

    Input: ``feed_url, pos, guid, url, title, description`` and optionally
    ``content``, ``enclosures`` (array<struct<url,type>>), ``published``.
    ``published_at`` falls back to ``now``; ``fetched_at`` is ``now``.
    """
    now = ts_lit(now)
    content, enc = _opt(batch, "content"), _opt(batch, "enclosures")
    published = _opt(batch, "published")
    return batch.select(
        F.lit("v1").alias("schema_version"),
        T.item_hash("guid", "url", "title").alias("id"),
        T.trim_space(F.col("feed_url")).alias("feed_url"),
        T.source_label("feed_url").alias("source_label"),
        T.trim_space(F.coalesce(F.col("guid"), F.lit(""))).alias("guid"),
        T.trim_space(F.coalesce(F.col("url"), F.lit(""))).alias("url"),
        T.trim_space(F.coalesce(F.col("title"), F.lit(""))).alias("title"),
        T.trim_space(F.coalesce(F.col("description"), F.lit(""))).alias("description"),
        T.extract_links("url", "description", "content" if content is not None else None,
                        "enclosures" if enc is not None else None).alias("links"),
        T.extract_images("description", "content" if content is not None else None,
                         "enclosures" if enc is not None else None).alias("image_urls"),
        (F.coalesce(published, now) if published is not None else now).alias("published_at"),
        now.alias("fetched_at"),
        F.col("pos"),
    )


# ---------------------------------------------------------------- E1
def _tie(df: DataFrame, skip: tuple) -> Column:
    """One hash of the other columns: breaks ties without carrying them."""
    rest = [F.col(c) for c in df.columns if c not in skip]
    return F.xxhash64(*rest) if rest else F.lit(0).cast("long")


def first_keys(items: DataFrame, stored: DataFrame | None, key: str, order: tuple) -> DataFrame:
    """Narrow ``(key, order..., _t)`` of the first occurrence per key.

    ``min(struct(order...))`` is a partial (map-side) aggregate over narrow
    rows, so a key repeated in a third of the batch collapses before the shuffle.
    """
    narrow = items.select(key, *order, _tie(items, (key, *order)).alias("_t"))
    first = narrow.groupBy(key).agg(F.min(F.struct(*order, "_t")).alias("_r")).select(key, "_r.*")
    return first if stored is None else first.join(stored.select(key), key, "left_anti")


def rows_of(items: DataFrame, keys: DataFrame, key: str, order: tuple) -> DataFrame:
    """One whole row for each of the narrow ``keys``; one semi join, bodies move once.

    Rows are met by a struct of key, order and tie, which is never null and
    holds nulls like other values; of equal rows one is kept."""
    at = F.struct(key, *order, "_t")
    tied = items.withColumn("_t", _tie(items, (key, *order))).withColumn("_at", at)
    met = tied.join(keys.select(at.alias("_at")), "_at", "left_semi")
    one = met.withColumn("_n", F.row_number().over(Window.partitionBy("_at").orderBy("_t")))
    return one.filter(F.col("_n") == 1).select(*items.columns)


def dedupe_hash(items: DataFrame, stored: DataFrame | None = None,
                key: str = "id", order: tuple = ("feed_url", "pos")) -> DataFrame:
    """First occurrence per ``key`` in ``order`` wins; stored keys are
    skipped.  Nulls come first in order; rows equal in order go by a hash of
    the others columns, and of equal rows one stays."""
    return rows_of(items, first_keys(items, stored, key, order), key, order)


# ---------------------------------------------------------------- H1 / top-n helper
def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of every group in ``order``; ties go by one row hash.

    ``row_number() <= n`` plans as a window group limit on both sides of the
    shuffle: each task sends at most ``n`` rows of a group, so no group is
    ever ranked whole.
    """
    rn = F.row_number().over(Window.partitionBy(*group).orderBy(*order, F.col("_h")))
    out = df.withColumn("_h", F.xxhash64(*[F.col(c) for c in df.columns])).withColumn("_rn", rn).filter(F.col("_rn") <= n).drop("_h")
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


def cap_per_feed(items: DataFrame, n: int, feed: str = "feed_url", pos: str = "pos") -> DataFrame:
    """H1: at most ``n`` new items per feed per poll, in feed order; n <= 0 = no cap."""
    if n <= 0:
        return items
    return top_n_per_group(items, [feed], [F.col(pos)], n)


def ingest_items(batch: DataFrame, stored: DataFrame | None, now, max_per_feed: int = 100) -> DataFrame:
    """Poll path: A3 -> E1 -> H1.  Returns the items to store and enqueue.

    Dedupe and cap work on narrow keys; the rows follow by one semi join."""
    raw = raw_items(batch, now)
    order = ("feed_url", "pos")
    keys = cap_per_feed(first_keys(raw, stored, "id", order), max_per_feed)
    return rows_of(raw, keys, "id", order)


# ---------------------------------------------------------------- E2 / E4
LAST_ROUNDS = [0]  # rounds used by the latest dedupe_keys call (diagnostics)


def item_keys(df: DataFrame, guid="guid", url="url", title="title") -> DataFrame:
    """The dedupe keys of each row as typed strings: guid (when non-blank), url, title."""
    g = T.trim_space(F.coalesce(F.col(guid), F.lit("")))
    keys = F.array_compact(F.array(
        F.when(g != "", F.concat(F.lit("g:"), g)),
        F.concat(F.lit("u:"), T.normalize_url(F.col(url))),
        F.concat(F.lit("t:"), T.normalize_title(F.col(title))),
    ))
    return df.withColumn("_keys", keys)


def seen_keys(pending: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    """Union of pending and processed keys, one row per key.

    Inputs carry ``guid, url, title_norm`` (url already normalised).
    """
    src = pending if processed is None else pending.unionByName(processed)
    g = T.trim_space(F.coalesce(F.col("guid"), F.lit("")))
    keys = F.array_compact(F.array(
        F.when(g != "", F.concat(F.lit("g:"), g)),
        F.concat(F.lit("u:"), F.coalesce(F.col("url"), F.lit(""))),
        F.concat(F.lit("t:"), F.coalesce(F.col("title_norm"), F.lit(""))),
    ))
    return src.select(F.explode(keys).alias("key")).distinct()


def _decide(undecided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over ``(_rid, key)``: ids to accept now, and the pairs still
    open.  A row is accepted when it is the first holder of all its keys; rows
    that share a key with it are rejected."""
    firsts = undecided.groupBy("key").agg(F.min("_rid").alias("_kmin"))
    accepted = undecided.join(firsts, "key").groupBy("_rid").agg(F.bool_and(F.col("_rid") == F.col("_kmin")).alias("_ok")) \
        .filter("_ok").select("_rid")
    taken = undecided.join(accepted, "_rid", "left_semi").select("key")
    decided = undecided.join(taken, "key", "left_semi").select("_rid")
    return accepted, undecided.join(decided, "_rid", "left_anti")


def _contract(undecided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round over ``(_rid, key)`` that decides whole chains.

    A row without earlier rows that share a key is accepted.  A row with exactly
    one is accepted if that one is not, so along a chain of such rows decisions
    alternate from its first row on: pointer jumping halves the chains each
    step.  Rows with several earlier ones, and chains that start at them, stay
    open unless they share a key with an accepted row."""
    spark = undecided.sparkSession
    firsts = undecided.groupBy("key").agg(F.min("_rid").alias("_k1"))
    met = undecided.join(firsts, "key")
    seconds = met.filter(F.col("_rid") != F.col("_k1")).groupBy("key").agg(F.min("_rid").alias("_k2"))
    met = met.join(seconds, "key", "left")
    before = met.groupBy("_rid").agg(
        F.bool_or(F.coalesce((F.col("_rid") != F.col("_k1")) & (F.col("_rid") != F.col("_k2")), F.lit(False))).alias("_many"),
        F.collect_set(F.when(F.col("_rid") == F.col("_k2"), F.col("_k1"))).alias("_before"))  # at most one a key
    rows = reliable_checkpoint(before.select(
        "_rid", F.when(~F.col("_many") & (F.size("_before") == 1), F.element_at("_before", 1)).alias("_p"),
        (~F.col("_many") & (F.size("_before") == 0)).alias("_free")))
    free = rows.filter("_free").select("_rid")
    done = scratch_path(spark)
    links, step = rows.filter("_p is not null").select("_rid", "_p", F.lit(True).alias("_odd")), 0
    while True:
        up = links.select(F.col("_rid").alias("_p"), F.col("_p").alias("_pp"), F.col("_odd").alias("_podd"))
        jumped = reliable_checkpoint(links.join(up, "_p", "left").select(
            "_rid", F.coalesce("_pp", "_p").alias("_p"), (F.col("_odd") != F.coalesce("_podd", F.lit(False))).alias("_odd"),
            F.col("_pp").isNotNull().alias("_on")))
        jumped.filter("not _on").select("_rid", "_p", "_odd").write.parquet(f"{done}/step={step}")
        # rows at the end of their chain stay, for others jump to them
        if jumped.filter("_on").isEmpty():
            break
        links, step = jumped.drop("_on"), step + 1
    ends = spark.read.parquet(f"{done}/step={step}").select("_rid", "_p", "_odd")
    even = ends.join(free.withColumnRenamed("_rid", "_p"), "_p", "left_semi").filter("not _odd").select("_rid")
    accepted = free.unionByName(even)
    taken = undecided.join(accepted, "_rid", "left_semi").select("key")
    decided = undecided.join(taken, "key", "left_semi").select("_rid")
    return accepted, undecided.join(decided, "_rid", "left_anti")


def dedupe_keys(batch: DataFrame, seen: DataFrame | None = None, order: tuple = ("feed_url", "pos"),
                max_rounds: int | None = None) -> DataFrame:
    """Order-dependent greedy dedupe on three keys.

    A row is a duplicate when its non-blank guid, its url or its title equals
    a seen key or a key of a row *accepted* earlier in ``order`` (nulls first,
    then by a hash of the other columns; of equal rows one is the first and the
    others its duplicates).  Rows that share no key with another are accepted
    at once and never enter the rounds.  The others are decided in rounds
    without pairwise expansion: two plain ones first, which end most cases, then
    rounds that decide whole chains of rows by pointer jumping.  Each round's
    decisions are written to one table, its open rows to another.  The first
    open row is always accepted, so the loop ends; there is no round cap.

    Returns ``batch`` plus ``accepted`` (boolean).
    """
    spark = batch.sparkSession
    checkpoint_dir(spark)
    tied = batch.withColumn("_rid", F.struct(*order, _tie(batch, order).alias("_t")))
    pairs = item_keys(tied).select("_rid", F.explode("_keys").alias("key")).distinct()
    if seen is not None:
        hit = pairs.join(seen.select("key"), "key", "left_semi").select("_rid")
        pairs = pairs.join(hit, "_rid", "left_anti")
    shared = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    linked = pairs.join(shared, "key", "left_semi").select("_rid")
    where, rounds = scratch_path(spark), 0

    def written(state: DataFrame) -> DataFrame:
        """Of rows ``(_rid, key)``, those without a key into the table of decisions; the others, open, read back."""
        state.withColumn("open", F.col("key").isNotNull()).write.partitionBy("open").parquet(f"{where}/round={rounds}")
        return spark.read.schema(state.schema).parquet(f"{where}/round={rounds}/open=true") if _there(spark, f"{where}/round={rounds}/open=true") \
            else spark.createDataFrame([], state.schema)

    none = F.lit(None).cast("string").alias("key")
    open_ = written(pairs.join(linked.withColumn("_l", F.lit(True)).distinct(), "_rid", "left")
                    .select("_rid", F.when(F.col("_l"), F.col("key")).alias("key")).distinct())
    while not open_.isEmpty():
        if rounds == 0:
            first, rest = _decide(open_)
            second, rest = _decide(rest)
            accepted, made = first.unionByName(second), 2
        else:
            (accepted, rest), made = _contract(open_), 1
        rounds += made
        open_ = written(accepted.select("_rid", none).unionByName(rest))
        LAST_ROUNDS[0] = rounds
        if max_rounds is not None and rounds >= max_rounds and not open_.isEmpty():
            raise RuntimeError("dedupe_keys did not converge within max_rounds")
    flag = spark.read.schema(T_.StructType([*pairs.schema.fields, T_.StructField("open", T_.BooleanType())])).parquet(where) \
        .filter(~F.col("open")).select("_rid").withColumn("accepted", F.lit(True))
    one = F.row_number().over(Window.partitionBy("_rid").orderBy(F.lit(0))) == 1  # of equal rows
    return tied.join(flag, "_rid", "left").withColumn("accepted", F.coalesce("accepted", F.lit(False)) & one).select(*batch.columns, "accepted")


def _there(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def cold_start(batch: DataFrame, seen: DataFrame | None, n: int,
               order: tuple = ("feed_url", "pos")) -> tuple[DataFrame, DataFrame]:
    """First start; returns (to_enqueue, to_mark_seen).

    All rows accepted by E2 are marked seen; the first ``n`` accepted per
    feed (in feed order) are enqueued.
    """
    decided = dedupe_keys(batch, seen, order=order)
    accepted = decided.filter("accepted").drop("accepted")
    enqueue = cap_per_feed(accepted, n) if n > 0 else accepted.limit(0)
    marked = accepted.select(
        T.item_hash("guid", "url", "title").alias("id"),
        T.trim_space(F.coalesce("guid", F.lit(""))).alias("guid"),
        T.normalize_url(F.col("url")).alias("url"),
        T.normalize_title(F.col("title")).alias("title_norm"))
    return enqueue, marked


# ---------------------------------------------------------------- E5
def due_feeds(feeds: DataFrame, state: DataFrame | None, requests: DataFrame | None, now,
              max_requests: int = 20) -> DataFrame:
    """E5: enabled feeds out of cooldown, plus the oldest forced requests.

    Requests ignore cooldown and the enabled flag; blank urls are skipped.
    One row per feed; ``force`` is true when a request asked for it.
    """
    now = ts_lit(now)
    f = feeds.filter(F.col("enabled"))
    if state is not None:
        f = f.join(state.select("feed_url", "down_until"), "feed_url", "left")
        f = f.filter(~F.coalesce(now < F.col("down_until"), F.lit(False)))
    regular = f.select("feed_url", F.lit(False).alias("force"))
    if requests is None:
        return regular
    req = (requests.select(T.trim_space(F.col("feed_url")).alias("feed_url"), "requested_at")
           .filter(F.col("feed_url") != "")
           .orderBy(F.col("requested_at").asc_nulls_first(), "feed_url").limit(max_requests)
           .select("feed_url", F.lit(True).alias("force")))
    return regular.unionByName(req).groupBy("feed_url").agg(F.max("force").alias("force"))


# ---------------------------------------------------------------- E6
def duplicate_rate(outcomes: DataFrame, feed: str = "feed_url") -> DataFrame:
    """Enqueued / duplicate / error counts per feed and the duplicate share."""
    o = F.col("outcome")
    agg = outcomes.groupBy(feed).agg(
        F.count_if(o == "enqueued").alias("enqueued"),
        F.count_if(o == "duplicate").alias("duplicate"),
        F.count_if(o == "error").alias("error"),
        F.count(F.lit(1)).alias("total"))
    return agg.withColumn("duplicate_rate", F.round(F.col("duplicate") / F.col("total"), 6))


# ---------------------------------------------------------------- H4 / H7 / A1
def retention(df: DataFrame, now, hours: int, ts: str = "created_at") -> DataFrame:
    """H4: keep rows with ``ts >= now - hours`` or null ``ts``; hours <= 0 keeps all."""
    if hours <= 0:
        return df
    cutoff = ts_lit(now) - F.make_dt_interval(hours=F.lit(hours))
    return df.filter(F.col(ts).isNull() | (F.col(ts) >= cutoff))


def retention_orphans(queue: DataFrame, kept_items: DataFrame) -> DataFrame:
    """H4/Q10: queue rows whose item was removed by retention."""
    return queue.join(kept_items.select(F.col("id").alias("item_id")), "item_id", "left_anti")


def feed_list_sorted(feeds: DataFrame) -> DataFrame:
    """H7: enabled feeds by url."""
    return feeds.filter(F.col("enabled")).select("feed_url").orderBy("feed_url")


def feed_list(spark, csv: str, path: str | None = None) -> DataFrame:
    """A1: comma list first, then file lines; trim; skip blank/``#``; first wins."""
    parts = [x for x in (csv or "").split(",")]
    first = spark.createDataFrame([(i, p) for i, p in enumerate(parts)], "pos long, line string")
    if path:
        # file order without a global window: the id increases with partition and row
        lines = spark.read.text(path).select(
            (F.lit(len(parts)) + F.monotonically_increasing_id()).alias("pos"), F.col("value").alias("line"))
        first = first.unionByName(lines)
    return feed_lines(first)


def feed_lines(lines: DataFrame) -> DataFrame:
    """A1 over ``(pos, line)``: trim; skip blank lines and comments; the first
    position of each feed."""
    cleaned = lines.select("pos", T.trim_space(F.col("line")).alias("feed_url"))
    cleaned = cleaned.filter((F.col("feed_url") != "") & ~F.col("feed_url").startswith("#"))
    return cleaned.groupBy("feed_url").agg(F.min("pos").alias("pos")).select("pos", "feed_url")
