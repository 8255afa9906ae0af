"""Adapter views: the driver's tables re-read as feed items, queue logs,
item state, model responses and feeds.

The driver tables hold no feed or queue tables, so every registered query
starts from one of these views.  They are pure projections of the given
tables (their size grows with them); ``plans.oracle`` holds the same views
in DuckDB SQL for the correctness check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import ts_lit
from feedloom.sources.tables import read_pages, read_table

# Clock values of the fixtures: every job takes ``now`` explicitly.
NOW_ITEMS = "2024-01-02 00:00:00"       # poll time of the page items
STORED_BEFORE = "2024-01-01 00:20:00"   # pages 0-19 were stored by older polls (every scale has new ones)
NOW_EVENTS = "2024-01-31 00:00:00"      # monitor clock: after the last event at every scale

ACTION_RAW = {"signup": "enqueue", "click": "claim", "view": "complete",
              "error": "release", "purchase": "fail"}
ACTION_DISPATCH = {"purchase": "enqueue", "signup": "claim", "click": "claim",
                   "view": "complete", "error": "release"}
STATUS_BY_EVENT = {"signup": "NEW", "click": "ANALYZED", "view": "ANALYZED",
                   "purchase": "DISPATCHED", "error": "FAILED"}


def _map_lit(d: dict) -> F.Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def _origin(url) -> F.Column:
    return F.regexp_extract(url, "^([A-Za-z]+://[^/?#]+)", 1)


def v_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed items from ``pages``, plus a re-post of every 7th page.

    guid blank for every 5th page; description = the page with root-relative
    hrefs made absolute (every 6th page keeps them relative, which the link
    rule drops); feed = scheme + host + first path segment.
    """
    p = read_pages(spark, sf_dir)
    origin = _origin(F.col("url"))
    first_seg = F.regexp_extract("url", "^([A-Za-z]+://[^/?#]+/[^/?#]*)", 1)
    base = p.select(
        F.when(F.col("page_id") % 6 == 0, F.col("html")).otherwise(
            F.replace(F.col("html"), F.lit('href="/'), F.concat(F.lit('href="'), origin, F.lit("/")))
        ).alias("description"),
        F.when(first_seg != "", first_seg).otherwise(origin).alias("feed_url"),
        F.col("page_id").alias("pos"),
        F.when(F.col("page_id") % 5 == 0, F.lit("")).otherwise(F.col("page_id").cast("string")).alias("guid"),
        F.col("url"),
        F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1).alias("title"),
        (ts_lit("2024-01-01 00:00:00") + F.make_dt_interval(secs=(F.col("page_id") * 60).cast("decimal(18,6)"))).alias("published"),
    )
    repost = base.filter(F.col("pos") % 7 == 0).select(
        "description", "feed_url",
        (F.col("pos") + 2 ** 40).alias("pos"),
        "guid",
        F.concat(F.col("url"), F.lit("#dup")).alias("url"),
        F.concat(F.lit("  "), F.replace(F.col("title"), F.lit(" "), F.lit("   ")), F.lit("\t")).alias("title"),
        "published",
    )
    return base.unionByName(repost)


def v_doc_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed items from ``documents``: real exact and near copies.

    guid blank; three neighbouring documents share a url number;
    title = the whole first line; feed = the document source.
    """
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return d.select(
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/feed")).alias("feed_url"),
        F.col("doc_id").alias("pos"),
        F.lit("").alias("guid"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/"),
                 F.floor(F.col("doc_id") / 3).cast("string")).alias("url"),
        F.split(F.col("text"), "\n", 2).getItem(0).alias("title"),
        (ts_lit("2024-01-01 00:00:00") + F.make_dt_interval(secs=F.col("doc_id").cast("decimal(18,6)"))).alias("published"),
    )


def _log_from_events(spark: SparkSession, sf_dir: str, actions: dict, id_offset: int) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return e.select(
        (F.col("user_id") + id_offset).cast("string").alias("item_id"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.col("event_id").alias("seq"),
        F.element_at(_map_lit(actions), F.col("event_type")).alias("action"),
        F.concat(F.lit("w"), (F.col("event_id") % 2).cast("string")).alias("worker"),
        (F.col("ts").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(12))).alias("lease_until"),
        F.concat(F.lit("error "), F.col("props")).alias("reason"),
    )


def v_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analyzer-queue transition log: one event per ``events`` row."""
    return _log_from_events(spark, sf_dir, ACTION_RAW, 0)


def v_log_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dispatch-queue transition log: same events, other actions, ids shifted by 75."""
    return _log_from_events(spark, sf_dir, ACTION_DISPATCH, 75)


def v_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item table: one item per ``events`` row, status by event type."""
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    ts = F.col("ts").cast("timestamp_ntz")
    status = F.element_at(_map_lit(STATUS_BY_EVENT), F.col("event_type"))
    analyzed_at = F.when(status.isin("ANALYZED", "DISPATCHED"),
                         ts + F.make_dt_interval(mins=F.col("event_id") % 17))
    dispatched_at = F.when(status == "DISPATCHED", ts + F.make_dt_interval(mins=F.col("event_id") % 29))
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("https://src"), (F.col("user_id") % 23).cast("string"),
                 F.lit(".example.org/feed")).alias("source_feed_url"),
        F.concat(F.lit("Job posting "), F.col("event_id").cast("string")).alias("title"),
        F.concat(F.lit("https://jobs.example.org/p/"), F.col("event_id").cast("string")).alias("url"),
        F.lit("").alias("guid"),
        status.alias("status"),
        ts.alias("created_at"),
        analyzed_at.alias("analyzed_at"),
        dispatched_at.alias("dispatched_at"),
        F.coalesce(dispatched_at, analyzed_at, ts).alias("updated_at"),
        F.when(F.col("event_id") % 3 != 0, analyzed_at).alias("analyzed_enqueued_at"),
        F.when(status == "FAILED", F.lit("llm status: 503")).otherwise(F.lit("")).alias("last_error"),
        F.when(status.isin("ANALYZED", "DISPATCHED") & (F.col("event_id") % 4 != 0),
               F.concat(F.lit('{"id":"'), F.col("event_id").cast("string"), F.lit('"}')))
        .otherwise(F.lit("")).alias("analyzed_payload_json"),
    )


def v_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed dimension + state + poll requests from the distinct document sources."""
    d = read_table(spark, sf_dir, "documents").select("source").distinct()
    n = F.regexp_extract("source", "([0-9]+)$", 1).cast("long")
    return d.select(
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/feed")).alias("feed_url"),
        (n % 4 != 0).alias("enabled"),
        F.when(n % 3 == 1, ts_lit("2024-01-31 06:00:00"))
        .when(n % 3 == 2, ts_lit("2024-01-30 18:00:00")).alias("down_until"),
        F.when(n % 3 != 0, F.lit(5)).otherwise(F.lit(0)).alias("failure_count"),
        F.when(n % 5 == 0, ts_lit("2024-01-30 23:00:00") + F.make_dt_interval(mins=n)).alias("requested_at"),
    )


# ---------------------------------------------------------------- responses / prompts
RESP_CATEGORIES = ["Programmazione", "marketing", "devops/sysadmin", "other roles", "Design", "", "Jobs",
                   "Data science"]
RESP_SENIORITY = ["Senior", "Junior", "n/a", "", "Mid"]
RESP_LOCATION = ["Remote", "Milano", "unknown", "Roma (RM)", "-", "Torino", ""]
RESP_CONTRACT = ["Full-time", "", "tbd", "Contract"]
RESP_SALARY = ["50k-60k EUR", "competitive", "", "RAL 40.000", "depends on experience", "$100k"]
RESP_STACK = ['["Go","go","Kubernetes","n/a","Python","SQL","Rust","Java","Scala"]', "[]",
              '["Node JS","C#","ci_cd"]']
RESP_TAGS = ['["remote-eu","full time","go_lang","#Go","","x","y"]', '["Fintech","fintech"]', "[]", "null"]
RESP_CONFIDENCE = ["2", "0.75", '"alta"', '"85%"', "0.8", "0.8", "0.8", "0.8", "0.8", '"bogus"', '"1,5"']


def _pick(values: list, idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values)).cast("int") + 1)


def _plain_text() -> F.Column:
    """A document's text without quotes, backslashes and control characters."""
    return F.regexp_replace(F.coalesce("text", F.lit("")), '["\\\\\\x00-\\x1f]+', " ")


def v_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model responses, one per document: JSON text, role and summary from the
    document's, with injected faults by doc_id mod 11 (1 placeholders, 2/3/9/10
    confidence text, 4 numeric role, 5 no company, 6 truncated, 7 code fence, 8
    vague salary)."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", _plain_text().alias("t"))
    k = F.col("doc_id") % 11
    ph = k == 1
    sen = F.when(ph, "N/A").otherwise(_pick(RESP_SENIORITY, F.col("doc_id")))
    loc = F.when(ph, "unknown").otherwise(_pick(RESP_LOCATION, F.col("doc_id")))
    con = F.when(ph, "tbd").otherwise(_pick(RESP_CONTRACT, F.col("doc_id")))
    sal = F.when(ph, "n/a").when(k == 8, "competitive").otherwise(_pick(RESP_SALARY, F.col("doc_id")))
    stack = F.when(ph, '["none"]').otherwise(_pick(RESP_STACK, F.col("doc_id")))
    role = F.when(k == 4, F.lit("42")).otherwise(F.concat(F.lit('"'), F.substring("t", 1, 40), F.lit('"')))
    company = F.when(k == 5, F.lit("")).otherwise(F.concat(F.lit(',"company":"Company '), F.col("source"), F.lit('"')))
    lang = F.when(F.col("doc_id") % 3 != 0, F.col("lang")).otherwise(F.lit(""))
    full = F.concat(
        F.lit('{"job_category":"'), _pick(RESP_CATEGORIES, F.col("doc_id")), F.lit('","role":'), role, company,
        F.lit(',"seniority":"'), sen, F.lit('","location":"'), loc, F.lit('","remote_type":"remote","tech_stack":'),
        stack, F.lit(',"tags":'), _pick(RESP_TAGS, F.col("doc_id")), F.lit(',"contract_type":"'), con,
        F.lit('","salary":"'), sal, F.lit('","language":"'), lang, F.lit('","summary_it":"'),
        F.substring("t", 41, 400), F.lit('","confidence":'), _pick(RESP_CONFIDENCE, k), F.lit("}"))
    content = (F.when(k == 6, F.substring(full, 1, 60))
               .when(k == 7, F.concat(F.lit("```json\n"), full, F.lit("\n```")))
               .otherwise(full))
    return d.select(F.col("doc_id").cast("string").alias("item_id"), content.alias("content"))


def v_doc_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw items for documents (id = doc_id): what prompts and conform read.
    ``excerpt`` is blank for every third document."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/job/"), F.col("doc_id").cast("string"))
    return d.select(
        F.col("doc_id").cast("string").alias("id"), F.lit("").alias("guid"), url.alias("url"),
        F.col("source").alias("source_label"),
        F.split(F.col("text"), "\n", 2).getItem(0).alias("title"),
        F.col("text").alias("description"),
        F.array(url, F.concat(url, F.lit("#apply")), F.lit(" "), url).alias("links"),
        F.array(F.concat(F.lit("https://img.example.org/"), F.col("source"), F.lit(".png"))).alias("image_urls"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(
            F.col("text")).alias("excerpt"))


AN_SENIORITY, AN_LOCATION, AN_CONTRACT, AN_SALARY = ["Senior", "", "Junior"], ["Remote", "Milano"], \
    ["Full-time", ""], ["50k", "", "$100k"]
AN_STACKS = [["Node JS", "C#", "ci_cd"], [], ["Go"]]
AN_TAGS = [["remote-eu", "full time", "go_lang"], ["x_y"], [], ["#Go", "go"]]


def _pick_list(lists: list, idx) -> F.Column:
    arrs = [F.array(*[F.lit(x) for x in lst]) if lst else F.array().cast("array<string>") for lst in lists]
    return F.element_at(F.array(*arrs), (idx % len(lists)).cast("int") + 1)


def v_analyzed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysed items (one per document): title, role and summary from its text, the rest markdown-sensitive for rendering."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.regexp_replace(F.coalesce("text", F.lit("")), "[ \t\r\n]+", " ").alias("t"))
    i = F.col("doc_id")
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.org/job/"), i.cast("string"))
    score = (i % 6) * 20
    return d.select(
        i.cast("string").alias("id"), F.col("source").alias("source_label"), url.alias("source_url"),
        F.substring("t", 1, 60).alias("title"),
        _pick(["Programmazione", "Devops & Sysadmin", "Marketing", "Altri ruoli"], i).alias("job_category"),
        F.when(i % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("Dev_"), F.substring("t", 1, 30), F.lit(" *lead*"))).alias("role"),
        F.concat(F.lit("ACME ["), F.col("source"), F.lit("]")).alias("company"),
        _pick(AN_SENIORITY, i).alias("seniority"), _pick(AN_LOCATION, i).alias("location"),
        F.lit("remote").alias("remote_type"), _pick(AN_CONTRACT, i).alias("contract_type"),
        _pick(AN_SALARY, i).alias("salary"),
        F.when(i % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("Sintesi `x` "), F.substring("t", 61, 500))).alias("summary_it"),
        F.col("lang").alias("language"),
        _pick_list(AN_STACKS, i).alias("tech_stack"), _pick_list(AN_TAGS, i).alias("tags"),
        F.when(i % 4 == 0, F.array().cast("array<string>")).otherwise(
            F.array(url, F.concat(url, F.lit("/apply")))).alias("original_links"),
        F.when(i % 5 == 0, F.array(F.concat(F.lit("https://img.example.org/"), F.col("source"), F.lit(".png"))))
        .otherwise(F.array().cast("array<string>")).alias("original_images"),
        score.cast("int").alias("job_post_quality_score"),
        F.when(score >= 90, "A").when(score >= 70, "B").when(score >= 50, "C").otherwise("D").alias("job_post_quality_rank"),
        F.round((i % 100) / 100.0, 2).alias("confidence"),
        (ts_lit("2024-01-02 00:00:00") + F.make_dt_interval(secs=i.cast("decimal(18,6)"))).alias("created_at"),
    )
