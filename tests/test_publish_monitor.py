"""Rendering, delivery, pacing, monitors, enrichment."""
import datetime as dt
import json
import random

from pyspark.sql import functions as F

from feedloom.operators import enrich as N
from feedloom.operators import monitor as M
from feedloom.operators import publish as P

A_SCHEMA = ("id string, role string, title string, company string, location string, salary string, "
            "tech_stack array<string>, tags array<string>, seniority string, contract_type string, "
            "language string, source_url string, summary_it string, job_post_quality_rank string, "
            "job_post_quality_score int, source_label string, job_category string, remote_type string, "
            "original_links array<string>, original_images array<string>")


def _analyzed(spark):
    return spark.createDataFrame([(
        "1", "Backend Engineer", "T", "ACME", "Remote", "50k", ["Node JS", "C#", "ci_cd"],
        ["remote-eu", "full time", "go_lang"], "Senior", "Full-time", "it", "https://x/1", "Sintesi", "B", 80,
        "src_a", "Programmazione", "remote", ["https://x/1"], [])], A_SCHEMA)


def test_chat_hashtags(spark):
    m = P.render_messages(_analyzed(spark), "chat").collect()[0].message
    assert "#nodejs #c #cicd" in m and "#remoteeu #fulltime #golang" in m
    for bad in ("#remote-eu", "#full time", "#go_lang"):
        assert bad not in m
    assert m.endswith("[candidati](https://x/1)\n") and "⭐ B (80/100)" in m


def test_default_layout(spark):
    m = P.render_messages(_analyzed(spark), "default").collect()[0].message
    assert m.startswith("*JOB-FEED*\nsrc\\_a\n\nhttps://x/1\n\n*Categoria:* Programmazione\n")
    assert "- Stack: Node JS, C#, ci\\_cd\n- Tags: #remote-eu #full time #go\\_lang\n" in m
    assert "*Link Originali*\n- https://x/1\n" in m and "*Immagini*" not in m


def test_delivery_request_and_outcomes(spark):
    r = P.render_messages(_analyzed(spark), "chat")
    req = json.loads(P.delivery_requests(r, "-1001", "Markdown", True, 7).collect()[0].request)
    assert req["parse_mode"] == "Markdown" and req["message_thread_id"] == 7 and req["chat_id"] == "-1001"
    req2 = json.loads(P.delivery_requests(r, "-1001", " ").collect()[0].request)
    assert "parse_mode" not in req2 and "message_thread_id" not in req2
    assert P.delivery_requests(r, "").collect()[0].request_error == "telegram chat id missing"
    resp = spark.createDataFrame([(1, 200, '{"ok":true}'), (2, 400, "bad"), (3, 200, "x"),
                                  (4, 200, '{"ok":false,"description":"Bad Request: can\'t parse entities"}')],
                                 "item_id int, status_code int, body string")
    got = {o.item_id: o.error for o in P.delivery_outcomes(resp).collect()}
    assert got[1] == "" and got[2] == "telegram send failed status=400 body=bad"
    assert got[3] == "telegram response decode failed" and got[4].startswith("telegram api not ok: Bad Request")


def test_pace_matches_token_bucket_loop(spark):
    rnd = random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(str(i), rnd.choice(["a", "b"]), t0 + dt.timedelta(seconds=rnd.randint(0, 120))) for i in range(60)]
    df = spark.createDataFrame(rows, "item_id string, dest string, ready_at timestamp_ntz")
    got = {r.item_id: r.send_at for r in P.pace(df, 30).collect()}
    for d in ("a", "b"):
        last = None
        for iid, _, ready in sorted([r for r in rows if r[1] == d], key=lambda r: (r[2], r[0])):
            send = ready if last is None else max(ready, last + dt.timedelta(seconds=2))
            assert got[iid] == send
            last = send


def test_ratio_series_dense(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0)
    items = spark.createDataFrame([(t0 - dt.timedelta(minutes=5), t0 - dt.timedelta(minutes=5)),
                                   (t0 - dt.timedelta(minutes=5), None), (t0 - dt.timedelta(hours=5), None)],
                                  "created_at timestamp_ntz, dispatched_at timestamp_ntz")
    rows = M.ratio_series(items, "2024-01-01 12:00:30", 180).orderBy("minute").collect()
    assert len(rows) == 180 and rows[-1].minute == t0 and rows[0].minute == t0 - dt.timedelta(minutes=179)
    hit = [r for r in rows if r.new_count][0]
    assert (hit.new_count, hit.dispatched_count, hit.ratio) == (2, 1, 2.0)
    assert all(r.ratio is None for r in rows if not r.dispatched_count)


def test_runtime_default_row(spark):
    snaps = spark.createDataFrame([("w", dt.datetime(2024, 1, 1), "m")],
                                  "worker_id string, updated_at timestamp_ntz, model string")
    for c, v in M.RUNTIME_DEFAULT.items():
        if c != "model":
            snaps = snaps.withColumn(c, F.lit(v))
    old = M.runtime_latest(snaps, "2024-01-02 00:00:00").collect()
    assert len(old) == 1 and old[0].worker_id is None and old[0].name == "job-analyzer"
    new = M.runtime_latest(snaps, "2024-01-01 00:10:00").collect()
    assert len(new) == 1 and new[0].worker_id == "w"


def test_main_content_and_markdown(spark):
    html = ("<html><head><title>x</title></head><body><nav>menu</nav><main><article><h1>Go Dev</h1>"
            "<p>About the job: <b>build</b> <a href='https://a/b'>apply now</a></p><ul><li>Go</li></ul></article>"
            "</main><aside>related jobs</aside><footer>f</footer></body></html>")
    pages = spark.createDataFrame([(1, "https://x/1", html), (2, "ftp://x", "<p>q</p>")],
                                  "page_id long, url string, html string")
    best = N.main_content(pages).filter("page_id = 1").collect()[0]
    assert best.selector_rank == 0 and "about the job" in best.text.lower()
    md = {r.page_id: r for r in N.page_markdown(pages).collect()}
    assert md[1].status == "ok" and md[1].markdown.startswith("# Go Dev")
    assert "**build**" in md[1].markdown and "[apply now](https://a/b)" in md[1].markdown and "* Go" in md[1].markdown
    assert "menu" not in md[1].markdown and md[2].status == "invalid_url"


def test_hybrid_excerpt(spark):
    long_p = "<p>" + "word " * 80 + "</p>"
    pages = spark.createDataFrame([(1, "https://x/1", long_p), (2, "https://x/2", "<main><h1>T</h1><p>short</p></main>")],
                                  "page_id long, url string, html string")
    items = spark.createDataFrame([(1, "https://x/1"), (2, "https://x/2"), (3, "https://x/3")], "pos long, url string")
    got = {r.pos: r for r in N.page_excerpt(items, pages, "hybrid", 220).collect()}
    assert got[1].excerpt.startswith("word word") and got[2].excerpt.startswith("# T")
    assert got[3].excerpt == "" and "basic: fetch_failed" in got[3].excerpt_reason
    assert {r.excerpt for r in N.page_excerpt(items, pages, "off").collect()} == {""}


def test_pace_hot_destination_spans_partitions(spark):
    rnd = random.Random(11)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(f"{i:04d}", "hot" if i % 10 else "cold", t0 + dt.timedelta(seconds=rnd.randint(0, 300)))
            for i in range(400)]
    df = spark.createDataFrame(rows, "item_id string, dest string, ready_at timestamp_ntz")
    out = P.pace(df, 20, partitions=7)
    got = {r.item_id: r.send_at for r in out.collect()}
    for d in ("hot", "cold"):
        last = None
        for iid, _, ready in sorted([r for r in rows if r[1] == d], key=lambda r: (r[2], r[0])):
            send = ready if last is None else max(ready, last + dt.timedelta(seconds=3))
            assert got[iid] == send, (d, iid)
            last = send


def test_block_selectors_and_scoring(spark):
    html = ("<body><section class='listing-container big'><p>Related jobs: a b c d e f g h i j k l m n o p</p></section>"
            "<div id='job_show'><p>Salary 50k</p></div>"
            "<div data-testid='job-details'><p>Salary 50k</p></div>"
            "<div class='listing-container'><p>x</p></div></body>")
    pages = spark.createDataFrame([(1, "https://x/1", html), (2, "https://x/2", "<body><p>only body</p></body>")],
                                  "page_id long, url string, html string")
    blocks = {(r.page_id, r.ord): r for r in N.page_blocks(pages).collect()}
    assert [blocks[(1, i)].selector_rank for i in range(4)] == [1, 3, 4, 7]   # selector order
    assert blocks[(2, 0)].selector_rank == len(N.SELECTORS)                    # body fallback
    best = {r.page_id: r for r in N.main_content(pages).collect()}
    deep = "<body><main>" + "<li><div>" * 3000 + "x" + "<article><p>about the job<p>salary</article></body>"
    bad = "<article>related jobs</article>"
    more = spark.createDataFrame([(3, "https://x/3", deep), (4, "https://x/4", bad), (5, "https://x/5", None),
                                  (6, "https://x/6", "<main><article><p>a<article>b</article></article></main>")], pages.schema)
    got = {r.page_id: r for r in N.main_content(more).collect()}
    assert got[3].selector_rank == 5 and got[3].text == "x about the job salary" and 4 not in got
    assert [(r.ord, r.selector_rank) for r in N.page_blocks(more.filter("page_id = 6")).collect()] == [(0, 0), (1, 0), (2, 5)]
    assert {r.page_id: r.markdown for r in N.page_markdown(more).collect()}[4] == "related jobs"
    # "related jobs" without "about the job" is penalised; the two salary blocks tie -> first one wins
    assert best[1].selector_rank == 3 and best[2].text == "only body"


def test_pace_of_a_long_queue_in_one_partition(spark):
    n = 1500  # 1,499 places of two seconds are more microseconds than an int holds
    q = spark.range(n).selectExpr("cast(id as string) AS item_id", "'d' AS dest", "timestamp_ntz '2024-01-01 00:00:00' AS ready_at")
    sent = sorted(r.send_at for r in P.pace(q, 30, partitions=1).collect())
    assert sent == [dt.datetime(2024, 1, 1) + dt.timedelta(seconds=2 * i) for i in range(n)]
