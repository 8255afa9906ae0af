"""Item records, stored analyses, dispatch payloads, feed state of removed feeds."""
import datetime as dt
import random

from feedloom.operators import lifecycle as L
from feedloom.sources import feeds as S

T0 = dt.datetime(2024, 1, 1)


def test_item_record_is_the_sequential_rule(spark):
    rnd, rows = random.Random(2), []
    for seq in range(400):
        status = rnd.choice(["NEW", "ANALYZED", "ANALYZED", "FAILED", "DISPATCHED"])
        rows.append((rnd.choice("abcdef"), T0 + dt.timedelta(minutes=rnd.randrange(90)), seq, status, rnd.choice([None, "e"]),
                     status in ("NEW", "ANALYZED") and rnd.random() < .2, rnd.choice([None, f"p{seq}"])))
    want = {}
    for item, t, _, status, error, again, payload in sorted(rows, key=lambda r: r[1:3]):
        r = want.setdefault(item, dict.fromkeys(["status", "last_error", "updated_at", "analyzed_at", "first_analyzed_at", "analyzed_payload_json", "dispatched_at",
                                                 "first_dispatched_at"]))
        if r["status"] == "DISPATCHED" and status in ("ANALYZED", "FAILED") and not again:
            continue
        r.update(status=status, last_error=error or "", updated_at=t)
        if status == "ANALYZED" and not again:
            r.update(analyzed_at=t, first_analyzed_at=r["first_analyzed_at"] or t, analyzed_payload_json=payload or r["analyzed_payload_json"])
        if status == "DISPATCHED":
            r.update(dispatched_at=t, first_dispatched_at=r["first_dispatched_at"] or t)
        elif status == "NEW" or again:
            r["dispatched_at"] = None
    log = spark.createDataFrame(rows, "item_id string, ts timestamp_ntz, seq long, status string, error string, requeue boolean, payload string")
    assert {r.item_id: {k: r[k] for k in want["a"]} for r in L.item_record(log).collect()} == want
    plain = L.item_record(log.drop("requeue", "payload")).collect()
    assert len(plain) == 6 and all(r.analyzed_payload_json is None for r in plain)


def test_store_analyzed_leaves_dispatched_items(spark):
    schema = "id string, status string, analyzed_at timestamp_ntz, analyzed_payload_json string, analyzed_enqueued_at timestamp_ntz, last_error string, updated_at timestamp_ntz, n int"
    items = spark.createDataFrame([("1", "NEW", None, None, None, "e", T0, 1), ("2", "DISPATCHED", T0, "old", T0, "", T0, 2), ("3", None, None, "", None, "e", None, 3)], schema)
    records = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), ("2", "c", 1), (" ", "d", 1), (None, "d", 1), ("9", "x", 1)], "id string, payload_json string, created_at int")
    got = {r.id: r for r in L.store_analyzed(items, records, "2024-01-02 00:00:00").collect()}
    assert (got["1"].status, got["1"].analyzed_payload_json, got["1"].last_error, got["1"].analyzed_enqueued_at) == ("ANALYZED", "b", "", T0 + dt.timedelta(days=1))
    assert tuple(got["2"]) == ("2", "DISPATCHED", T0, "old", T0, "", T0, 2) and got["3"].last_error == "e" and len(got) == 3


def test_dispatch_payloads(spark):
    texts = ['{"id":" ","role":"r","tags":["a"],"job_post_quality_score":7,"confidence":1,"created_at":"2024-01-01T00:00:00Z","extra":{}}',
             '{"id":"z","tech_stack":null,"confidence":0.25}', "{}", '{"role":5}', '{"confidence":"x"}', '{"job_post_quality_score":1.5}', '{"tags":[1]}', "[]", "nope", "", None]
    good, bad = S.analyzed_payloads(spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(texts)], "item_id string, payload_json string"))
    rows = {r.item_id: r for r in good.collect()}
    assert set(rows) == {"k0", "k1", "k2"} and {r.item_id for r in bad.collect()} == {f"k{i}" for i in range(3, 11)}
    assert (rows["k0"].id, rows["k0"].role, rows["k0"].tags, rows["k0"].job_post_quality_score, rows["k0"].confidence, rows["k0"].created_at) == ("k0", "r", ["a"], 7, 1.0, T0)
    assert (rows["k1"].id, rows["k1"].tech_stack, rows["k1"].confidence) == ("z", [], .25) and rows["k2"].id == "k2"
    enc = S.encode_analyzed(spark.createDataFrame([("1", "a & b", [], None)], "id string, role string, tech_stack array<string>, tags array<string>")).first().payload_json
    assert '"role":"a \\u0026 b"' in enc and '"tech_stack":[]' in enc and "tags" not in enc and enc.startswith('{"schema_version":"v1","id":"1",')


def test_removed_feeds_lose_their_state(spark):
    changes = spark.createDataFrame([("a", T0, "remove"), ("a", T0 + dt.timedelta(hours=1), "add"), ("b", T0, "disable"), ("c", T0, "remove")], "feed_url string, ts timestamp_ntz, op string")
    state = spark.createDataFrame([("a", T0 - dt.timedelta(hours=1)), ("b", T0), ("c", T0 + dt.timedelta(hours=2)), ("c", None)], "feed_url string, updated_at timestamp_ntz")
    assert sorted(r.feed_url for r in L.feed_admin_state(changes, state).collect()) == ["b", "c"]
