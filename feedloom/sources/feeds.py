"""Feed documents, payloads and text times as tables.

* A2  ``feed_items``: landed RSS / Atom documents -> one row per entry
  (``from_xml`` with explicit schemas + ``posexplode``)
* A5  ``queue_payloads`` / A6 ``encode_payload``: RawItem JSON both ways
* A7  ``parse_times``: six text layouts, first match wins, else null
* A1  ``feed_list`` lives in ``operators.ingest`` and is re-exported here
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import fixed
from feedloom.functions import text as T
from feedloom.operators.extract import go_json_escape
from feedloom.operators.ingest import feed_list  # noqa: F401  (A1)

RSS_SCHEMA = ("channel struct<title:string, item:array<struct<guid:string, title:string, link:string, "
              "description:string, `content:encoded`:string, pubDate:string, "
              "enclosure:array<struct<_url:string, _type:string>>>>>")
ATOM_SCHEMA = ("title string, entry array<struct<id:string, title:string, "
               "link:array<struct<_href:string, _rel:string, _type:string>>, "
               "summary:string, content:string, published:string, updated:string>>")


def _xml_text(c: Column) -> Column:
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


_WEEKDAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def rfc1123(ts: Column) -> Column:
    """Format a timestamp as an RFC-1123 date with +0000."""
    wd = F.element_at(F.array(*[F.lit(d) for d in _WEEKDAYS]), F.dayofweek(ts))
    return F.concat(wd, F.lit(", "), F.date_format(ts, "dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))


def parse_rfc1123(c: Column) -> Column:
    """RFC-1123 / RFC-822 date text -> timestamp_ntz (UTC); weekday stripped
    first, seconds and the zone may be missing or a North American name."""
    t = F.regexp_replace(T.trim_space(F.coalesce(c, F.lit(""))), "^[A-Za-z]{3},\\s*", "")
    m = F.regexp_extract(t, "^(\\d{1,2}) ([A-Za-z]{3}) (\\d{4}) (\\d{2}:\\d{2}(?::\\d{2})?)( [+-]\\d{4}| [A-Z]{1,4})?$", 0)
    clock = F.regexp_replace(F.regexp_replace(m, "( [+-]\\d{4}| [A-Z]{1,4})$", ""), "( \\d{2}:\\d{2})$", "$1:00")
    base = F.try_to_timestamp(clock, F.lit("d MMM yyyy HH:mm:ss"))
    zone = F.regexp_extract(m, " ([A-Z]{1,4})$", 1)
    named = F.element_at(F.create_map(*[F.lit(x) for kv in fixed.ZONE_OFFSETS.items() for x in kv]), zone)
    off = F.coalesce(named, F.regexp_extract(m, "([+-])(\\d{2})(\\d{2})$", 0))
    mins = F.when(off != "", (F.substring(off, 2, 2).cast("int") * 60 + F.substring(off, 4, 2).cast("int"))
                  * F.when(off.startswith("-"), -1).otherwise(1)).otherwise(0)
    return F.when(m != "", (base.cast("timestamp_ntz") - F.make_dt_interval(mins=mins)))


def rss_document(items: DataFrame) -> DataFrame:
    """Render feed items as RSS documents (landing-file fixture).  A second
    entry without a guid follows, whose content is the item's description."""
    doc = F.concat(
        F.lit('<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>'),
        _xml_text(F.col("feed_url")), F.lit("</title><item><guid>"),
        _xml_text(F.col("guid")), F.lit("</guid><title>"), _xml_text(F.col("title")), F.lit("</title><link>"),
        _xml_text(F.col("url")), F.lit("</link><pubDate>"), rfc1123(F.col("published")),
        F.lit("</pubDate></item><item><title>"), _xml_text(F.col("title")), F.lit("</title><link>"), _xml_text(F.col("url")),
        F.lit("</link><content:encoded>"), _xml_text(F.col("description")), F.lit("</content:encoded></item></channel></rss>"))
    return items.select("feed_url", "pos", doc.alias("doc"))


def _by_rel(rel: str) -> Column:
    """An Atom entry's links of a relation; a link without one is an alternate."""
    links = F.coalesce(F.col("e.link"), F.array().cast("array<struct<_href:string,_rel:string,_type:string>>"))
    return F.filter(links, lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == rel)


def feed_items(docs: DataFrame, doc_col: str = "doc", keep: tuple = ("feed_url",)) -> DataFrame:
    """A2: one row per RSS item or Atom entry of each landed document.

    Output: keep columns, position, guid, title, link, description, content,
    enclosures (array<struct<url,type>>), published (timestamp_ntz).
    """
    d = docs.select(*keep, F.col(doc_col).alias("_doc"))
    is_atom = F.col("_doc").rlike("(?s)^\\s*(<\\?xml[^>]*>\\s*)?<feed[\\s>]")
    rss = (d.filter(~is_atom).select(*keep, F.from_xml("_doc", RSS_SCHEMA).alias("_x"))
           .select(*keep, F.posexplode_outer("_x.channel.item").alias("position", "e"))
           .filter(F.col("e").isNotNull())
           .select(*keep, "position",
                   F.coalesce(F.col("e.guid"), F.lit("")).alias("guid"),
                   F.coalesce(F.col("e.title"), F.lit("")).alias("title"),
                   F.coalesce(F.col("e.link"), F.lit("")).alias("link"),
                   F.coalesce(F.col("e.description"), F.lit("")).alias("description"),
                   F.coalesce(F.col("e.`content:encoded`"), F.lit("")).alias("content"),
                   F.transform(F.coalesce(F.col("e.enclosure"), F.array().cast(
                       "array<struct<_url:string,_type:string>>")),
                       lambda x: F.struct(x["_url"].alias("url"), x["_type"].alias("type"))).alias("enclosures"),
                   parse_rfc1123(F.col("e.pubDate")).alias("published")))
    atom = (d.filter(is_atom).select(*keep, F.from_xml("_doc", ATOM_SCHEMA).alias("_x"))
            .select(*keep, F.posexplode_outer("_x.entry").alias("position", "e"))
            .filter(F.col("e").isNotNull())
            .select(*keep, "position",
                    F.coalesce(F.col("e.id"), F.lit("")).alias("guid"),
                    F.coalesce(F.col("e.title"), F.lit("")).alias("title"),
                    F.coalesce(F.get(_by_rel("alternate"), F.lit(0))["_href"], F.get(F.col("e.link"), F.lit(0))["_href"],
                               F.lit("")).alias("link"),
                    F.coalesce(F.col("e.summary"), F.lit("")).alias("description"),
                    F.coalesce(F.col("e.content"), F.lit("")).alias("content"),
                    F.transform(_by_rel("enclosure"), lambda x: F.struct(x["_href"].alias("url"), x["_type"].alias("type")))
                    .alias("enclosures"),
                    parse_times(F.coalesce(F.col("e.published"), F.col("e.updated"))).alias("published")))
    return rss.unionByName(atom)


# ---------------------------------------------------------------- A7
_RFC3339 = "^(\\d{4}-\\d{2}-\\d{2})T(\\d{2}:\\d{2}:\\d{2})(\\.\\d+)?(Z|[+-]\\d{2}:\\d{2})$"
_GOSTR = "^(\\d{4}-\\d{2}-\\d{2}) (\\d{2}:\\d{2}:\\d{2})(\\.\\d+)? ([+-]\\d{4}) [A-Za-z]+$"
_PLAIN = "^(\\d{4}-\\d{2}-\\d{2}) (\\d{2}:\\d{2}:\\d{2})(\\.\\d+)?$"


def parse_times(c) -> Column:
    """RFC3339(Nano), Go ``time.String`` with/without fraction, plain
    ``yyyy-MM-dd HH:mm:ss[.f]``; first match wins, unparseable -> null.
    Fractions beyond microseconds are truncated; offsets are folded to UTC."""
    t = T.trim_space(F.coalesce(T._c(c), F.lit("")))

    def build(pat: str, off_group: int | None):
        date = F.regexp_extract(t, pat, 1)
        clock = F.regexp_extract(t, pat, 2)
        frac = F.regexp_extract(t, pat, 3)
        micros = F.when(frac != "", F.rpad(F.substring(frac, 2, 6), 6, "0").cast("int")).otherwise(0)
        base = F.try_to_timestamp(F.concat(date, F.lit(" "), clock), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
        ts = base + F.make_dt_interval(secs=(micros / 1e6).cast("decimal(8,6)"))
        if off_group is not None:
            off = F.regexp_replace(F.regexp_extract(t, pat, off_group), ":", "")
            mins = F.when((off == "Z") | (off == ""), 0).otherwise(
                (F.substring(off, 2, 2).cast("int") * 60 + F.substring(off, 4, 2).cast("int"))
                * F.when(off.startswith("-"), -1).otherwise(1))
            ts = ts - F.make_dt_interval(mins=mins)
        return F.when(t.rlike(pat), ts)

    return F.coalesce(build(_RFC3339, 4), build(_GOSTR, 4), build(_PLAIN, None))


# ---------------------------------------------------------------- A5 / A6
RAW_ITEM_DDL = ("schema_version string, id string, traceparent string, tracestate string, feed_url string, "
                "source_label string, guid string, url string, title string, description string, "
                "links array<string>, image_urls array<string>, published_at string, fetched_at string")


def rfc3339(ts: Column) -> Column:
    """Go's RFC3339Nano text of a UTC timestamp (trailing fraction zeros trimmed)."""
    frac = F.regexp_replace(F.date_format(ts, "SSSSSS"), "0+$", "")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(F.lit("")), F.lit("Z"))


def encode_payload(raw: DataFrame) -> DataFrame:
    """RawItem -> JSON text; ``omitempty`` fields are left out when empty."""
    def opt_s(name):
        c = F.col(name) if name in raw.columns else F.lit("")
        return F.when(F.coalesce(c, F.lit("")) != "", c).alias(name)

    def opt_a(name):
        return F.when(F.size(F.coalesce(F.col(name), F.array().cast("array<string>"))) > 0, F.col(name)).alias(name)

    s = F.struct(
        F.coalesce(F.col("schema_version"), F.lit("v1")).alias("schema_version") if "schema_version" in raw.columns
        else F.lit("v1").alias("schema_version"),
        F.col("id"), opt_s("traceparent"), opt_s("tracestate"), F.col("feed_url"), opt_s("source_label"),
        opt_s("guid"), F.col("url"), F.col("title"), opt_s("description"), opt_a("links"), opt_a("image_urls"),
        rfc3339(F.col("published_at")).alias("published_at"), rfc3339(F.col("fetched_at")).alias("fetched_at"))
    return raw.withColumn("payload_json", go_json_escape(F.to_json(s)))


# a field of another type fails the whole payload, as a typed decoder does; absent and null fields are blank
_RAW_KINDS = {c: "STRING" for c in ("schema_version", "id", "traceparent", "tracestate", "feed_url", "source_label", "guid", "url", "title",
                                    "description", "published_at", "fetched_at")} | {c: "ARRAY<STRING>" for c in ("links", "image_urls")}
ANALYZED_TEXTS = ("schema_version", "traceparent", "tracestate", "guid", "source_url", "source_label", "title", "job_category", "role", "company", "seniority",
                  "location", "remote_type", "contract_type", "salary", "job_post_quality_rank", "language", "summary_it")
ANALYZED_LISTS = ("tech_stack", "tags", "job_post_missing_fields", "original_links", "original_images")
_ANALYZED_KINDS = {c: "STRING" for c in (*ANALYZED_TEXTS, "id", "created_at")} | {c: "ARRAY<STRING>" for c in ANALYZED_LISTS} | {
    "job_post_quality_score": "BIGINT", "confidence": "DOUBLE"}
#: What a typed decoder takes for each kind, as the start of a variant's schema text.
_TAKES = {"STRING": "STRING|VOID", "ARRAY<STRING>": "ARRAY<STRING>|ARRAY<VOID>|VOID", "BIGINT": "BIGINT|VOID", "DOUBLE": "BIGINT|DECIMAL|DOUBLE|FLOAT|VOID"}


def _decoded(queue: DataFrame, payload: str, kinds: dict[str, str]) -> DataFrame:
    """``_v``, the payload parsed once into a variant, and ``_ok``, whether it is an object whose fields are of their kinds."""
    def fits(v):
        def kind(path):
            return F.schema_of_variant(F.try_variant_get(v, path, "variant"))

        typed = F.lit(True)
        for c, k in kinds.items():
            typed = typed & F.coalesce(kind(f"$.{c}").rlike(f"^(?:{_TAKES[k]})"), F.lit(True))
        # the whole value's schema text settles nearly every row; only odd ones are tested field by field
        odd = "|".join(f"[<, `](?:{'|'.join(c for c in kinds if kinds[c] == k)})`?: (?!{_TAKES[k]})" for k in sorted(set(kinds.values())))
        return T._let(F.schema_of_variant(v), lambda s: F.when(~F.coalesce(s.startswith("OBJECT"), F.lit(False)), F.lit(False))
                      .when(~s.rlike(odd), F.lit(True)).otherwise(typed))

    # the text is parsed once for the test, whatever the optimizer does with the filter
    return queue.withColumn("_ok", T._let(F.try_parse_json(F.col(payload)), fits)).withColumn("_v", F.try_parse_json(F.col(payload)))


def _text(name: str) -> Column:
    return F.coalesce(F.try_variant_get("_v", f"$.{name}", "string"), F.lit(""))


def _list(name: str) -> Column:
    return F.coalesce(F.try_variant_get("_v", f"$.{name}", "array<string>"), F.array().cast("array<string>"))


def _id(key: str) -> Column:
    return F.when(T.trim_space(_text("id")) != "", _text("id")).otherwise(F.col(key).cast("string")).alias("id")


def analyzed_payloads(queue: DataFrame, payload: str = "payload_json", key: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """A5 for the dispatch queue: decode payloads to AnalyzedItem; blank id
    falls back to the queue key.  Returns (good, bad); bad rows keep the raw
    text for diversion.  Absent numbers are 0, an unreadable time is null."""
    q = _decoded(queue, payload, _ANALYZED_KINDS)
    good = q.filter("_ok").select(
        key, _id(key), *[_text(c).alias(c) for c in ANALYZED_TEXTS], *[_list(c).alias(c) for c in ANALYZED_LISTS],
        F.coalesce(F.try_variant_get("_v", "$.job_post_quality_score", "int"), F.lit(0)).alias("job_post_quality_score"),
        F.coalesce(F.try_variant_get("_v", "$.confidence", "double"), F.lit(0.0)).alias("confidence"),
        parse_times(F.try_variant_get("_v", "$.created_at", "string")).alias("created_at"))
    bad = q.filter(~F.coalesce("_ok", F.lit(False))).select(key, F.col(payload).alias("raw_payload"), F.lit("invalid_dispatch_payload").alias("reason"))
    return good, bad


def encode_analyzed(analyzed: DataFrame) -> DataFrame:
    """A6 for the dispatch queue: AnalyzedItem -> JSON text; ``omitempty`` fields are left out when empty."""
    there = set(analyzed.columns)

    def field(name):
        if name in ANALYZED_LISTS:
            c = F.coalesce(F.col(name), F.array().cast("array<string>")) if name in there else F.array().cast("array<string>")
            return (c if name == "tech_stack" else F.when(F.size(c) > 0, c)).alias(name)
        if name == "job_post_quality_score":
            return (F.coalesce(F.col(name), F.lit(0)) if name in there else F.lit(0)).alias(name)
        if name == "confidence":
            return (F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in there else F.lit(0.0)).alias(name)
        if name == "created_at":
            return (rfc3339(F.col(name)) if name in there else F.lit("0001-01-01T00:00:00Z")).alias(name)
        c = F.coalesce(F.col(name), F.lit("")) if name in there else F.lit("v1" if name == "schema_version" else "")
        return (F.when(c != "", c) if name in ("traceparent", "tracestate", "guid", "source_label") else c).alias(name)

    names = ["schema_version", "id", "traceparent", "tracestate", "guid", "source_url", "source_label", "title", "job_category", "role", "company", "seniority",
             "location", "remote_type", "tech_stack", "tags", "contract_type", "salary", "job_post_quality_score", "job_post_quality_rank",
             "job_post_missing_fields", "language", "summary_it", "original_links", "original_images", "confidence", "created_at"]
    return analyzed.withColumn("payload_json", go_json_escape(F.to_json(F.struct(*[field(n) for n in names]))))


def queue_payloads(queue: DataFrame, payload: str = "payload_json", key: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """A5: decode queue payloads to RawItem; blank id falls back to the queue
    key.  Returns (good, bad); bad rows keep the raw text for diversion.

    The text is parsed once into a variant column; fields are then read from
    the binary variant (per-field ``from_json`` would re-parse the text).
    """
    q = _decoded(queue, payload, _RAW_KINDS)
    v, s, a = F.col("_v"), _text, _list
    good = q.filter("_ok").select(
        key, *[s(c).alias(c) for c in ("schema_version", "traceparent", "tracestate", "feed_url", "source_label", "guid",
                                       "url", "title", "description")],
        *[a(c).alias(c) for c in ("links", "image_urls")],
        _id(key),
        parse_times(F.try_variant_get(v, "$.published_at", "string")).alias("published_at"),
        parse_times(F.try_variant_get(v, "$.fetched_at", "string")).alias("fetched_at"))
    bad = q.filter(~F.col("_ok")).select(key, F.col(payload).alias("raw_payload"),
                                        F.lit("invalid_raw_payload").alias("reason"))
    return good, bad
