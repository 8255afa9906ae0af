"""Streaming jobs over a landing folder with availableNow triggers, checked against batch results."""
import datetime as dt
import os

from pyspark.sql import functions as F

from feedloom.operators import lifecycle as L
from feedloom.sources import feeds as S
from feedloom.streaming import jobs as J


def _rss(items):
    body = "".join(f"<item><guid>{g}</guid><title>{t}</title><link>{u}</link>"
                   f"<pubDate>Mon, 01 Jan 2024 00:0{i}:00 +0000</pubDate></item>" for i, (g, t, u) in enumerate(items))
    return f'<rss version="2.0"><channel><title>f</title>{body}</channel></rss>'


def test_stream_items_and_dedupe(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.xml").write_text(_rss([("1", "Go Dev", "https://x/1"), ("2", "Py Dev", "https://x/2")]))
    (land / "b.xml").write_text(_rss([("1", " go  dev ", "https://x/1#frag")]))
    items = J.stream_dedupe(J.stream_items(spark, str(land)))
    q = (items.writeStream.format("memory").queryName("items_t").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = spark.table("items_t").select("id", "title", "published_at").collect()
    assert len(got) == 2
    assert {r.title for r in got} <= {"Go Dev", "Py Dev", "go  dev"}
    assert min(r.published_at for r in got) == dt.datetime(2024, 1, 1, 0, 0)


def test_feed_items_atom(spark):
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title><entry><id>e1</id><title>A</title>'
            '<link href="https://x/a"/><published>2024-01-01T10:00:00Z</published></entry></feed>')
    df = spark.createDataFrame([("f", atom)], "feed_url string, doc string")
    r = S.feed_items(df).collect()[0]
    assert (r.guid, r.title, r.link, r.published) == ("e1", "A", "https://x/a", dt.datetime(2024, 1, 1, 10))


def test_stream_queue_matches_batch_fold(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i, (item, a, w) in enumerate([("x", "enqueue", "w1"), ("x", "claim", "w1"), ("y", "enqueue", "w2"),
                                      ("x", "complete", "w2"), ("x", "complete", "w1"), ("y", "claim", "w2"),
                                      ("y", "release", "w2"), ("z", "claim", "w1")]):
        t = t0 + dt.timedelta(seconds=i)
        rows.append((item, t, i, a, w, t + dt.timedelta(minutes=2), "r" if a == "release" else ""))
    schema = ("item_id string, ts timestamp_ntz, seq long, action string, worker string, "
              "lease_until timestamp_ntz, reason string")
    log = spark.createDataFrame(rows, schema)
    land = tmp_path / "log"
    log.limit(4).write.parquet(str(land / "p1"))
    log.orderBy("seq").offset(4).write.parquet(str(land / "p2"))
    src = spark.readStream.schema(log.schema).option("recursiveFileLookup", "true").parquet(str(land))
    q = (J.stream_queue(src).writeStream.format("memory").queryName("queue_t").outputMode("update")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(180)
    stream = {}
    for r in spark.table("queue_t").collect():
        stream[r.item_id] = (r.state, r.delivery_count, r.last_error)
    batch = {r.item_id: (r.state, r.delivery_count, r.last_error) for r in L.queue_snapshot(log).collect()}
    assert stream == batch == {"x": ("DONE", 1, ""), "y": ("QUEUED", 1, "r")}


def test_stream_minutes(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(t0 + dt.timedelta(seconds=s),) for s in (1, 2, 61, 3700)], "created_at timestamp_ntz")
    df.write.parquet(str(tmp_path / "in"))
    src = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = (J.stream_minutes(src).writeStream.format("memory").queryName("min_t").outputMode("update")
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r.minute: r.n for r in spark.table("min_t").collect()}
    assert got[t0] == 2 and got[t0 + dt.timedelta(minutes=1)] == 1


def test_publish_batch_idempotent(spark, tmp_path):
    a = spark.createDataFrame([("1", "Dev", "ACME", "https://x/1"), ("2", "Ops", "B", "https://x/2")],
                              "item_id string, role string, company string, source_url string")
    items = spark.createDataFrame([("1", "DISPATCHED", None), ("2", "ANALYZED", None)],
                                  "id string, status string, dispatched_at timestamp_ntz")
    out = str(tmp_path / "out")
    for _ in range(2):  # the same batch id twice -> the same single file set
        J.publish_batch(a, 7, items, out, "2024-01-01 00:00:00")
    texts = spark.read.text(os.path.join(out, "batch_id=7"), wholetext=True).collect()
    body = "".join(t.value for t in texts)
    assert body.count("[candidati](https://x/2)") == 1 and "https://x/1" not in body


def test_monitor_upsert(spark, tmp_path):
    snap = str(tmp_path / "snap")
    u1 = spark.createDataFrame([("a", "QUEUED"), ("b", "LEASED")], "item_id string, state string")
    u2 = spark.createDataFrame([("b", "DONE")], "item_id string, state string")
    J.upsert_snapshot(u1, snap, 0)
    got = {r.item_id: r.state for r in J.upsert_snapshot(u2, snap, 1).collect()}
    assert got == {"a": "QUEUED", "b": "DONE"}


def test_stream_publish_end_to_end(spark, tmp_path):
    a = spark.createDataFrame([("1", "Dev", "ACME", "https://x/1"), ("2", "Ops", "B", "https://x/2")],
                              "item_id string, role string, company string, source_url string")
    a.write.parquet(str(tmp_path / "land"))
    items = spark.createDataFrame([("1", "DISPATCHED", None), ("2", "ANALYZED", None)],
                                  "id string, status string, dispatched_at timestamp_ntz")
    src = spark.readStream.schema(a.schema).parquet(str(tmp_path / "land"))
    out = str(tmp_path / "out")
    q = J.stream_publish(src, items, out, now="2024-01-01 00:00:00", checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(120)
    body = "".join(r.value for r in spark.read.text(out, wholetext=True).collect())
    assert "[candidati](https://x/2)" in body and "https://x/1" not in body


def test_stream_monitor_end_to_end(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("x", t0, 0, "enqueue", "w", t0, ""), ("x", t0 + dt.timedelta(seconds=1), 1, "claim", "w",
                                                      t0 + dt.timedelta(minutes=2), ""),
            ("y", t0, 2, "enqueue", "w", t0, "")]
    log = spark.createDataFrame(rows, "item_id string, ts timestamp_ntz, seq long, action string, worker string, "
                                      "lease_until timestamp_ntz, reason string")
    log.write.parquet(str(tmp_path / "log"))
    src = spark.readStream.schema(log.schema).parquet(str(tmp_path / "log"))
    dq = spark.createDataFrame([], "item_id string, state string, enqueued_at timestamp_ntz")
    items = spark.createDataFrame([("x", "NEW", None), ("y", "NEW", None)],
                                  "id string, status string, analyzed_enqueued_at timestamp_ntz")
    out = str(tmp_path / "mon")
    q = J.stream_monitor(J.stream_queue(src), dq, items, out, checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(180)
    g = {(r.metric, r.key): r.n for r in spark.read.parquet(out + "/gauges").collect()}
    assert g[("queue_items", "analyzer_queue/LEASED")] == 1 and g[("queue_items", "analyzer_queue/QUEUED")] == 1
    assert g[("item_queue_state", "inflight_raw")] == 1 and g[("item_queue_state", "queued_raw")] == 1
