"""Sources: RFC-1123 dates, time layouts, payload round trip, generator, XML feeds."""
import datetime as dt
import json

from pyspark.sql import functions as F

from feedloom.operators import ingest
from feedloom.sources import feeds as S
from feedloom.sources import synth as Y


def test_rfc1123(spark):
    df = spark.createDataFrame([("Mon, 01 Jan 2024 10:05:00 +0200",), ("1 Jan 2024 10:05:00 GMT",), ("garbage",)], ["d"])
    got = [r.t for r in df.select(S.parse_rfc1123(F.col("d")).alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 8, 5), dt.datetime(2024, 1, 1, 10, 5), None]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 5),)], "t timestamp_ntz")
    assert ts.select(S.rfc1123(F.col("t")).alias("r")).first().r == "Mon, 01 Jan 2024 00:05:00 +0000"


def test_parse_times_layouts(spark):
    vals = ["2024-01-02T03:04:05.123456789Z", "2024-01-02T05:04:05+02:00", "2024-01-02 03:04:05.5 +0000 UTC",
            "2024-01-02 03:04:05 -0100 CET", "2024-01-02 03:04:05.25", " 2024-01-02 03:04:05 ", "yesterday", ""]
    df = spark.createDataFrame([(v,) for v in vals], ["v"])
    got = [r.t for r in df.select(S.parse_times("v").alias("t")).collect()]
    base = dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got == [base.replace(microsecond=123456), base, base.replace(microsecond=500000),
                   base + dt.timedelta(hours=1), base.replace(microsecond=250000), base, None, None]


def test_payload_roundtrip_omitempty(spark):
    batch = spark.createDataFrame([("https://f/x", 1, "", "https://a/1", "T & <b>", "")],
                                  "feed_url string, pos long, guid string, url string, title string, description string")
    raw = ingest.raw_items(batch, "2024-01-01 00:00:00.5")
    enc = S.encode_payload(raw).select("id", "payload_json").first()
    obj = json.loads(enc.payload_json)
    assert "guid" not in obj and "description" not in obj and "traceparent" not in obj
    assert obj["fetched_at"] == "2024-01-01T00:00:00.5Z" and "\\u0026" in enc.payload_json
    q = spark.createDataFrame([("k1", enc.payload_json.replace(enc.id, " ")), ("k2", "{broken")],
                              "item_id string, payload_json string")
    good, bad = S.queue_payloads(q)
    g = good.first()
    assert g.id == "k1" and g.title == "T & <b>" and g.guid == "" and g.fetched_at == dt.datetime(2024, 1, 1, 0, 0, 0, 500000)
    assert [r.item_id for r in bad.collect()] == ["k2"]


def test_synth_and_slug(spark):
    pos = spark.range(3).select(F.col("id").alias("i"))
    p = Y.synth_postings(pos, "2024-01-01 00:07:00", 300, "http://h/").orderBy("index").collect()
    first = p[-1]
    assert first.published_at == dt.datetime(2024, 1, 1, 0, 5)
    idx = first["index"]
    assert first.company == ["Acme Cloud", "Nimbus Labs", "Northstar Data", "Pixel Orbit", "Atlas Metrics"][idx % 5]
    assert first.slug.endswith(f"-{idx}") and first.url == "http://h/jobs/" + first.slug
    assert first.salary_min_k == 95 + (idx % 5) * 10 and len(first.stack) == 4
    req = spark.createDataFrame([(first.slug,), ("x" + first.slug,), ("no-number",)], ["slug"])
    got = Y.posting_from_slug(req, 300, "http://h/").collect()
    assert [r.slug for r in got] == [first.slug]


def test_feed_items_rss_multi(spark):
    doc = ('<rss version="2.0"><channel><title>t</title>'
           '<item><guid isPermaLink="false">g1</guid><title>A &amp; B</title><link>https://x/1</link>'
           '<enclosure url="https://x/i.png" type="image/png"/></item>'
           '<item><title>C</title><link>https://x/2</link></item></channel></rss>')
    rows = S.feed_items(spark.createDataFrame([("f", doc)], "feed_url string, doc string")).orderBy("position").collect()
    assert [(r.position, r.title, r.link) for r in rows] == [(0, "A & B", "https://x/1"), (1, "C", "https://x/2")]
    assert rows[0].enclosures[0].url == "https://x/i.png"


def test_feed_items_content_links_and_dates(spark):
    rss = ('<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>t</title>'
           '<item><title>A</title><link>https://x/1</link><description>d</description>'
           '<content:encoded>&lt;a href="https://y/1"&gt;y&lt;/a&gt;</content:encoded><pubDate>Mon, 01 Jan 2024 10:00 EST</pubDate></item>'
           '<item><title>B</title><link>https://x/2</link><pubDate>Tue, 02 Jan 2024 10:00:05 +0100</pubDate></item></channel></rss>')
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title><entry><id>e</id><title>C</title>'
            '<link rel="self" href="https://x/self"/><link rel="alternate" href="https://x/c"/>'
            '<link rel="enclosure" type="image/png" href="https://x/i.png"/><updated>2024-01-01T10:00:00Z</updated></entry></feed>')
    df = spark.createDataFrame([("r", rss), ("a", atom)], "feed_url string, doc string")
    got = {r.title: r for r in S.feed_items(df).collect()}
    assert got["A"].content == '<a href="https://y/1">y</a>' and got["A"].published == dt.datetime(2024, 1, 1, 15)
    assert got["B"].content == "" and got["B"].published == dt.datetime(2024, 1, 2, 9, 0, 5)
    assert got["C"].link == "https://x/c" and [tuple(e) for e in got["C"].enclosures] == [("https://x/i.png", "image/png")]


def test_mistyped_payloads_are_diverted(spark):
    texts = ['{"id":"a","title":"t","links":["x"],"extra":5}', '{"id":"b","title":5}', '{"id":"c","links":"x"}', '{"id":"d","links":[1]}',
             '{"title":null,"links":null}', '[1]', 'nope', '{"id":"e","more":{"title":5},"links":[]}']
    q = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(texts)], "item_id string, payload_json string")
    good, bad = S.queue_payloads(q)
    assert {r.item_id: r.id for r in good.collect()} == {"k0": "a", "k4": "k4", "k7": "e"}
    assert {r.item_id for r in bad.collect()} == {"k1", "k2", "k3", "k5", "k6"}


def test_page_bodies_are_whole(spark, tmp_path):
    from feedloom.operators import enrich as N
    from feedloom.sources import tables
    body = "<p>" + "word " * 70_000 + "end</p>"
    df = spark.createDataFrame([(1, "https://x/1", body), (2, "https://x/1", body.replace("end", "later"))], "page_id long, url string, html string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    pages = tables.read_pages(spark, str(tmp_path))
    assert {len(r.html) for r in pages.collect()} == {len(body), len(body) + 2}
    texts = {r._txt[-5:] for r in N.page_excerpts(pages, 0).collect()}
    assert texts == {"later"}  # one row per url, the latest fetch
    assert len(N.page_excerpts(pages, 0, body_bytes=262144).collect()[0]._txt) < 262144


def test_page_and_message_sinks(spark, tmp_path):
    from feedloom.operators import publish as P
    from feedloom.sources import tables as TB
    pages = spark.createDataFrame([("https://x/1", "<p>a\nb</p>", 1), ("https://x/2", None, 2)], "url string, html string, n int")
    for _ in range(2):
        TB.write_pages(pages, str(tmp_path / "pages"))
    back = spark.read.parquet(str(tmp_path / "pages"))
    assert back.columns == ["url", "html"] and sorted((r.url, r.html) for r in back.collect()) == sorted([("https://x/1", "<p>a\nb</p>"), ("https://x/2", None)] * 2, key=str)
    rendered = spark.createDataFrame([("one\ntwo",), ("three",)], "message string")
    P.write_messages(rendered, str(tmp_path / "out"), "2024-01-31 10:00:00")
    P.write_messages(rendered.limit(1), str(tmp_path / "out"), "2024-02-01 10:00:00")
    text = {r.date.isoformat(): "" for r in spark.read.text(str(tmp_path / "out")).select("date").distinct().collect()}
    for r in spark.read.text(str(tmp_path / "out"), wholetext=True).collect():
        text[r.date.isoformat()] += r.value
    assert set(text) == {"2024-01-31", "2024-02-01"}
    assert "2024-01-31T10:00:00Z\none\ntwo\n\n---\n\n" in text["2024-01-31"] and text["2024-01-31"].count("---") == 2 and text["2024-02-01"].count("---") == 1
