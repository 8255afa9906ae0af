"""Ingest: hash dedupe, caps, greedy three-key dedupe vs a sequential loop, cold start, due feeds."""
import random

from pyspark.sql import functions as F

from feedloom.operators import ingest


def _batch(spark, rows):
    return spark.createDataFrame(rows, "feed_url string, pos long, guid string, url string, title string")


def _seq_dedupe(rows, seen=()):
    """Sequential reference: the per-item loop of a cold start."""
    acc_g, acc_u, acc_t = set(), set(), set()
    seen = set(seen)
    out = {}
    for f, p, g, u, t in sorted(rows, key=lambda r: (r[0], r[1])):
        g = g.strip()
        tn = " ".join(t.lower().split())
        keys = ({"g:" + g} if g else set()) | {"u:" + u, "t:" + tn}
        dup = bool(keys & seen) or (g and g in acc_g) or u in acc_u or tn in acc_t
        out[p] = not dup
        if not dup:
            if g:
                acc_g.add(g)
            acc_u.add(u)
            acc_t.add(tn)
    return out


def test_dedupe_keys_matches_sequential_loop(spark):
    rnd = random.Random(7)
    for case in range(6):
        n = rnd.randint(5, 40)
        rows = [(f"f{rnd.randint(0, 2)}", i, rnd.choice(["", "g1", "g2", "g3"]),
                 f"https://x.org/{rnd.randint(0, n // 2)}", f"Title {rnd.randint(0, n // 2)}") for i in range(n)]
        got = {r.pos: r.accepted for r in ingest.dedupe_keys(_batch(spark, rows)).collect()}
        assert got == _seq_dedupe(rows), case


def test_dedupe_keys_chain_needs_many_rounds(spark):
    # row i shares its url with row i+1 and its title with row i-1: a chain
    rows = [("f", i, "", f"https://x.org/{i // 2}", f"T{(i + 1) // 2}") for i in range(14)]
    got = {r.pos: r.accepted for r in ingest.dedupe_keys(_batch(spark, rows)).collect()}
    assert got == _seq_dedupe(rows)


def test_dedupe_keys_seen(spark):
    rows = [("f", 0, "", "https://x.org/a", "Alpha"), ("f", 1, "", "https://x.org/b", "Beta")]
    seen = spark.createDataFrame([("t:alpha",)], ["key"])
    got = {r.pos: r.accepted for r in ingest.dedupe_keys(_batch(spark, rows), seen).collect()}
    assert got == {0: False, 1: True}


def test_dedupe_hash_first_wins_and_stored_skipped(spark):
    df = spark.createDataFrame([("h1", "f2", 0, "a"), ("h1", "f1", 5, "b"), ("h2", "f1", 1, "c"), ("h3", "f1", 2, "d")],
                               "id string, feed_url string, pos long, v string")
    stored = spark.createDataFrame([("h3",)], ["id"])
    got = sorted((r.id, r.v) for r in ingest.dedupe_hash(df, stored).collect())
    assert got == [("h1", "b"), ("h2", "c")]


def test_cap_per_feed_skewed(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").otherwise(
        F.concat(F.lit("f"), (F.col("id") % 7).cast("string"))).alias("feed_url"), F.col("id").alias("pos"))
    out = ingest.cap_per_feed(df, 3)
    got = {r.feed_url: sorted(r.p) for r in out.groupBy("feed_url").agg(F.collect_list("pos").alias("p")).collect()}
    assert got["hot"] == [0, 1, 2]
    assert all(len(v) == 3 for v in got.values()) and len(got) == 8


def test_cold_start_marks_then_duplicate(spark):
    batch = _batch(spark, [("https://feed", 0, "1", "https://example.com/job/1", "Go Engineer")])
    enq, marked = ingest.cold_start(batch, None, 1)
    assert enq.count() == 1 and marked.count() == 1
    seen = ingest.seen_keys(marked)
    enq2, marked2 = ingest.cold_start(batch, seen, 1)
    assert enq2.count() == 0 and marked2.count() == 0


def test_due_feeds(spark):
    feeds = spark.createDataFrame([("a", True), ("b", True), ("c", False)], "feed_url string, enabled boolean")
    state = spark.createDataFrame([("b", "2024-01-02 00:00:00")], "feed_url string, down_until string").select(
        "feed_url", F.col("down_until").cast("timestamp_ntz").alias("down_until"))
    req = spark.createDataFrame([(" c ", "2024-01-01 00:00:00"), ("", "2024-01-01 00:00:00")],
                                "feed_url string, requested_at string")
    got = {r.feed_url: r.force for r in ingest.due_feeds(feeds, state, req, "2024-01-01 12:00:00").collect()}
    assert got == {"a": False, "c": True}


def test_feed_list(spark, tmp_path):
    p = tmp_path / "feeds.txt"
    p.write_text("# comment\nhttps://b\n\nhttps://a\nhttps://c\n")
    got = [r.feed_url for r in ingest.feed_list(spark, " https://a ,https://x,", str(p)).orderBy("pos").collect()]
    assert got == ["https://a", "https://x", "https://b", "https://c"]


def test_retention(spark):
    df = spark.createDataFrame([("1", "2024-01-01 00:00:00"), ("2", "2024-01-08 00:00:00"), ("3", None)],
                               "id string, created_at string").select(
        "id", F.col("created_at").cast("timestamp_ntz").alias("created_at"))
    assert sorted(r.id for r in ingest.retention(df, "2024-01-08 12:00:00", 168).collect()) == ["2", "3"]
    assert ingest.retention(df, "2024-01-08 12:00:00", 0).count() == 3


def test_dedupe_keys_positions_restart_per_feed(spark):
    # equal positions and one guid in two feeds: rows are told apart by (feed, pos)
    rows = [("f1", 0, "g", "https://x.org/a", "A"), ("f2", 0, "g", "https://x.org/b", "B"), ("f2", 1, "", "https://x.org/c", "C")]
    got = {(r.feed_url, r.pos): r.accepted for r in ingest.dedupe_keys(_batch(spark, rows), max_rounds=6).collect()}
    assert got == {("f1", 0): True, ("f2", 0): False, ("f2", 1): True}
    enq, marked = ingest.cold_start(_batch(spark, rows), None, 5)
    assert enq.count() == marked.count() == 2
    twice = sorted((r.feed_url, r.pos, r.accepted) for r in ingest.dedupe_keys(_batch(spark, rows + rows)).collect())
    assert twice == [("f1", 0, False), ("f1", 0, True), ("f2", 0, False), ("f2", 0, False), ("f2", 1, False), ("f2", 1, True)]


def test_long_chains_are_decided_in_few_rounds(spark):
    rnd = random.Random(4)
    rows = [("f", i, "", f"https://x.org/{i // 2}", f"T{(i + 1) // 2}") for i in range(1000)]  # one chain in order
    rows += [("g", i, "", f"https://y.org/{k // 2}", f"U{(k + 1) // 2}") for i, k in enumerate(rnd.sample(range(300), 300))]  # one out of order
    got = {r.pos: r.accepted for r in ingest.dedupe_keys(_batch(spark, [r for r in rows if r[0] == "f"]), max_rounds=6).collect()}
    assert got == _seq_dedupe([r for r in rows if r[0] == "f"]) and sum(got.values()) == 500
    got = {r.pos: r.accepted for r in ingest.dedupe_keys(_batch(spark, [r for r in rows if r[0] == "g"]), max_rounds=12).collect()}
    assert got == _seq_dedupe([r for r in rows if r[0] == "g"])


def test_repeated_rows_and_null_keys(spark):
    schema = "id string, feed_url string, pos long, v string"
    same = ("h1", "f1", 0, "a")
    df = spark.createDataFrame([same, same, ("h1", "f2", 0, "b"), ("h2", None, 3, "c"), ("h2", "f1", 1, "d"), ("h3", "f1", None, "e"), ("h3", "f1", 5, "f"),
                                (None, "f9", 1, "g"), (None, "f8", 1, "h"), ("h4", None, None, None), ("h4", None, None, None)], schema)
    got = sorted(((r.id, r.feed_url, r.pos, r.v) for r in ingest.dedupe_hash(df).collect()), key=str)
    assert got == sorted([same, ("h2", None, 3, "c"), ("h3", "f1", None, "e"), (None, "f8", 1, "h"), ("h4", None, None, None)], key=str)
    posts = [("f", 0, "", "https://x.org/a", "A")] * 3 + [(None, 4, "", "https://x.org/b", "B"), ("f", None, "", "https://x.org/c", "C"), ("f", 9, "", "https://x.org/c", "D")]
    raw = spark.createDataFrame([(*p, "text") for p in posts], "feed_url string, pos long, guid string, url string, title string, description string")
    assert sorted(r.url for r in ingest.ingest_items(raw, None, "2024-01-01 00:00:00").collect()) == [f"https://x.org/{c}" for c in "abcc"]
    got = sorted((r.url, r.title, r.accepted) for r in ingest.dedupe_keys(_batch(spark, posts)).collect())
    assert got == [("https://x.org/a", "A", False)] * 2 + [("https://x.org/a", "A", True), ("https://x.org/b", "B", True), ("https://x.org/c", "C", True),
                                                           ("https://x.org/c", "D", False)]


def test_no_body_in_the_dedupe_shuffles(spark):
    import re

    from feedloom.plans import catalog
    for name in ("label_counts", "ingest_items"):
        plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        final = plan[plan.index("== Physical Plan =="):]
        for block in re.findall(r"Exchange hashpartitioning\(feed_url[^\n]*\n[^\n]*\n", final):
            assert "description" not in block
