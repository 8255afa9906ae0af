"""Queue fold, status fold, quarantine, requeue, receipts, admin changes."""
import datetime as dt
import random

from pyspark.sql import functions as F

from feedloom.operators import lifecycle as L

T0 = dt.datetime(2024, 1, 1)


def _log(spark, rows):
    return spark.createDataFrame(
        rows, "item_id string, ts timestamp_ntz, seq long, action string, worker string, "
              "lease_until timestamp_ntz, reason string")


def _ev(i, sec, action, worker="w1", lease=60, reason=""):
    t = T0 + dt.timedelta(seconds=sec)
    return ("x", t, i, action, worker, t + dt.timedelta(seconds=lease), reason)


def test_queue_fold_guards(spark):
    rows = [_ev(0, 0, "claim"),                      # ignored: not enqueued yet
            _ev(1, 1, "enqueue"),
            _ev(2, 2, "claim", "w1", 60),            # LEASED by w1 until 62
            _ev(3, 3, "claim", "w2"),                # lease not expired: ignored
            _ev(4, 4, "complete", "w2"),             # not the owner: ignored
            _ev(5, 70, "claim", "w2", 60),           # expired: w2 leases, count 2
            _ev(6, 71, "release", "w2", reason=" boom "),
            _ev(7, 72, "claim", "w1"),               # count 3
            _ev(8, 73, "complete", "w1"),
            _ev(9, 74, "enqueue")]                   # requeue keeps count/done_at
    r = L.queue_snapshot(_log(spark, rows)).collect()[0]
    assert (r.state, r.lease_owner, r.delivery_count, r.last_error) == ("QUEUED", None, 3, "")
    assert r.enqueued_at == T0 + dt.timedelta(seconds=1)
    assert r.done_at == T0 + dt.timedelta(seconds=73)


def _py_fold(events):
    s = None
    for _, t, _, a, w, lu, reason in sorted(events, key=lambda e: (e[1], e[2])):
        if a == "enqueue":
            if s is None:
                s = dict(state="QUEUED", owner=None, until=None, dc=0, enq=t, done=None, err="")
            else:
                s.update(state="QUEUED", owner=None, until=None, err="")
        elif s is None:
            continue
        elif a == "claim":
            if s["state"] == "QUEUED" or (s["state"] == "LEASED" and s["until"] is not None and s["until"] <= t):
                s.update(state="LEASED", owner=w, until=lu, dc=s["dc"] + 1, err="")
        elif s["owner"] is not None and s["owner"] == w:
            if a == "complete":
                s.update(state="DONE", owner=None, until=None, done=s["done"] or t, err="")
            elif a == "release":
                s.update(state="QUEUED", owner=None, until=None, err=reason.strip())
            elif a == "fail":
                s.update(state="DONE", owner=None, until=None, done=s["done"] or t, err=reason.strip())
    return s


def test_queue_fold_matches_loop_random(spark):
    rnd = random.Random(3)
    rows = []
    for item in range(30):
        for k in range(rnd.randint(0, 25) if item else 400):  # item 0 is hot
            t = T0 + dt.timedelta(seconds=rnd.randint(0, 500))
            rows.append((f"i{item}", t, len(rows), rnd.choice(["enqueue", "claim", "complete", "release", "fail"]),
                         rnd.choice(["w1", "w2"]), t + dt.timedelta(seconds=rnd.randint(10, 100)), f"e{k}"))
    got = {r.item_id: r for r in L.queue_snapshot(_log(spark, rows), partitions=3).collect()}
    plain = {r.item_id: r for r in L.queue_snapshot(_log(spark, rows), partitions=3, segmented=False).collect()}
    assert {k: tuple(v) for k, v in got.items()} == {k: tuple(v) for k, v in plain.items()}
    for item in {r[0] for r in rows}:
        exp = _py_fold([r for r in rows if r[0] == item])
        if exp is None:
            assert item not in got
            continue
        g = got[item]
        assert (g.state, g.lease_owner, g.delivery_count, g.enqueued_at, g.done_at, g.last_error) == (
            exp["state"], exp["owner"], exp["dc"], exp["enq"], exp["done"], exp["err"]), item


def test_item_status_guard(spark):
    rows = [("a", T0, 1, "NEW", ""), ("a", T0 + dt.timedelta(seconds=1), 2, "DISPATCHED", ""),
            ("a", T0 + dt.timedelta(seconds=2), 3, "FAILED", "late"),
            ("b", T0, 1, "ANALYZED", ""), ("b", T0 + dt.timedelta(seconds=1), 2, "FAILED", "x")]
    df = spark.createDataFrame(rows, "item_id string, ts timestamp_ntz, seq long, status string, error string")
    got = {r.item_id: (r.status, r.last_error) for r in L.item_status(df).collect()}
    assert got == {"a": ("DISPATCHED", ""), "b": ("FAILED", "x")}


def test_quarantine_rules(spark):
    snap = spark.createDataFrame([("a", 1, "w"), ("b", 3, "w"), ("c", 1, "w")],
                                 "item_id string, delivery_count int, lease_owner string")
    fails = spark.createDataFrame([("a", "missing required analyzed fields"), ("b", "llm status: 503"),
                                   ("c", "llm status: 503")], "item_id string, error string")
    got = {r.item_id: (r.action, r.reason) for r in L.quarantine(fails, snap, 3).collect()}
    assert got["a"] == ("fail", "poison_item: analysis_failed: missing required analyzed fields")
    assert got["b"][0] == "fail" and got["c"] == ("release", "analysis_failed: llm status: 503")


def test_requeue(spark):
    items = spark.createDataFrame([("d", '{"id":"d"}', "DISPATCHED"), ("n", "", "ANALYZED")],
                                  "id string, analyzed_payload_json string, status string")
    ids = spark.createDataFrame([("d",), ("n",), ("zz",)], ["id"])
    got = {r.id: (r.target, r.new_status) for r in L.requeue(ids, items, "2024-01-01 00:00:00").collect()}
    assert got == {"d": ("dispatch_queue", "ANALYZED"), "n": ("analyzer_queue", "NEW"), "zz": ("not_found", None)}


def test_already_dispatched(spark):
    q = spark.createDataFrame([("a", "QUEUED"), ("b", "QUEUED")], "item_id string, state string")
    items = spark.createDataFrame([("a", " dispatched ", None), ("b", "ANALYZED", None)],
                                  "id string, status string, dispatched_at timestamp_ntz")
    assert {r.item_id: r.skip for r in L.already_dispatched(q, items).collect()} == {"a": True, "b": False}


def test_feed_admin_seed_does_not_reenable(spark):
    feeds = spark.createDataFrame([("a", True), ("b", False), ("d", False), ("e", True)],
                                  "feed_url string, enabled boolean")
    ch = spark.createDataFrame([("a", 1, "disable"), ("a", 2, "seed"),       # seed keeps it disabled
                                ("b", 0, "remove"), ("b", 1, "seed"),         # removed, then re-created
                                ("c", 1, "enable"), ("c", 2, "seed"),         # enable on a missing feed: no-op
                                ("d", 1, "seed"),                            # disabled stays disabled
                                ("e", 1, "remove"), ("e", 2, "disable")],     # gone
                               "feed_url string, ts long, op string")
    got = {r.feed_url: r.enabled for r in L.feed_admin(ch, feeds).collect()}
    assert got == {"a": False, "b": True, "c": True, "d": False}


def test_receipts_hash_fallback(spark):
    r = spark.createDataFrame([("", "1", "https://example.com/job/1", "Go Engineer", T0), ("", "", "", "", T0)],
                              "item_id string, guid string, url string, title string, processed_at timestamp_ntz")
    got = L.apply_receipts(r).collect()
    assert len(got) == 1 and got[0].item_id == "2bfe6fb1f018b94eced79d8093cc51dfceb762f1"


def test_backoff(spark):
    f = spark.createDataFrame([("a", T0)], "id string, ts timestamp_ntz")
    got = [r.delay_s for r in L.backoff_plan(f, 3, 2.0).orderBy("attempt").collect()]
    assert got == [2.0, 4.0, 8.0]


def test_requeued_item_is_sent_again(spark):
    items = spark.createDataFrame([("a", "DISPATCHED", '{"id":"a"}', "https://f.example.org/x", "T", "https://x/a"),
                                   ("b", "DISPATCHED", "", "https://f.example.org/x", "U", "https://x/b")],
                                  "id string, status string, analyzed_payload_json string, source_feed_url string, title string, url string")
    ids = spark.createDataFrame([(" a ",), ("b",), ("zz",), ("",)], "id string")
    plan = L.requeue(ids, items, "2024-01-02 00:00:00")
    got = {r.id: r for r in plan.collect()}
    assert set(got) == {"a", "b", "zz"} and got["zz"].target == "not_found" and got["zz"].payload_json is None
    assert got["a"].payload_json == '{"id":"a"}' and got["a"].new_status == "ANALYZED" and got["a"].enqueue_count_add == 1
    import json
    assert json.loads(got["b"].payload_json) == {"schema_version": "v1", "id": "b", "feed_url": "https://f.example.org/x",
                                                 "source_label": "f_example_org_x", "title": "U", "url": "https://x/b",
                                                 "published_at": "2024-01-02T00:00:00Z", "fetched_at": "2024-01-02T00:00:00Z"}
    sec = dt.timedelta(seconds=1)
    log = spark.createDataFrame([(i, T0 + k * sec, k, s, "", False) for i in "ab" for k, s in enumerate(["NEW", "ANALYZED", "DISPATCHED"])],
                                "item_id string, ts timestamp_ntz, seq long, status string, error string, requeue boolean")
    queue = spark.createDataFrame([("a",), ("b",)], "item_id string")

    def skips(lg):
        status = L.item_status(lg).withColumnRenamed("item_id", "id")
        return {r.item_id: r.skip for r in L.already_dispatched(queue, status).collect()}
    assert skips(log) == {"a": True, "b": True}
    again = log.unionByName(L.requeue_writes(plan))
    assert skips(again) == {"a": False, "b": False}
    sent = again.unionByName(log.filter("status = 'DISPATCHED' and item_id = 'a'").withColumn("ts", F.lit("2024-01-03").cast("timestamp_ntz")))
    assert skips(sent) == {"a": True, "b": False}
