"""Scalar rules (B*) against the reference's unit cases."""
from pyspark.sql import functions as F

from feedloom.functions import text as T
from tests.conftest import one


def row(spark, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols))


def test_normalize_title_and_url(spark):
    r = one(row(spark, t="  Senior   Go Developer   REMOTE ", u="https://example.com/jobs/1#section").select(
        T.normalize_title("t").alias("t"), T.normalize_url("u").alias("u")))
    assert r.t == "senior go developer remote"
    assert r.u == "https://example.com/jobs/1"


def test_unicode_whitespace_collapses(spark):
    r = one(row(spark, t=" Go  Dev　").select(T.normalize_title("t").alias("t")))
    assert r.t == "go dev"


def test_url_unparseable_kept_and_path_escaped(spark):
    r = one(row(spark, a=" http://x.org/a%zz#f ", b="https://Ex.org/für a?q=1#x", c="HTTP://h/p").select(
        T.normalize_url("a").alias("a"), T.normalize_url("b").alias("b"), T.normalize_url("c").alias("c")))
    assert r.a == "http://x.org/a%zz#f"
    assert r.b == "https://Ex.org/f%C3%BCr%20a?q=1"
    assert r.c == "http://h/p"


def test_item_hash(spark):
    r = one(row(spark, g="1", u="https://example.com/job/1", t="Go Engineer").select(
        T.item_hash("g", "u", "t").alias("h")))
    assert r.h == "2bfe6fb1f018b94eced79d8093cc51dfceb762f1"


def test_source_label(spark):
    df = spark.createDataFrame([("https://www.Example.com/jobs/remote.rss",), ("https://example.com/feed",),
                                ("https://example.com/",), ("http://a.b:8080/x/Go-Jobs.XML",), (":bad",)], ["u"])
    got = [r.l for r in df.select(T.source_label("u").alias("l")).collect()]
    assert got == ["example_com_remote", "example_com", "example_com", "a_b_go_jobs", "feed"]


def test_valid_feed_url(spark):
    df = spark.createDataFrame([("https://x",), ("HTTP://x",), ("ftp://x",), ("x.org",)], ["u"])
    assert [r.v for r in df.select(T.valid_feed_url("u").alias("v")).collect()] == [True, True, False, False]


def test_html_unescape_single_pass(spark):
    r = one(row(spark, s="&amp;lt; &#233; &#x1F600; &copy; x&quot;y &#150; &bogus;").select(
        T.html_unescape("s").alias("s")))
    assert r.s == '&lt; é \U0001F600 © x"y – &bogus;'


def test_links_and_images(spark):
    html = ('<a href="/rel">x</a><A HREF=\'https://b.org/x#frag\'>y</A><a href="//cdn.c.org/p">z</a>'
            '<img src="https://i.org/a.png"><a href="https://b.org/x">dup</a><a href="mailto:q">m</a>')
    r = one(row(spark, link="https://a.org/job", d=html).select(
        T.extract_links(F.col("link"), F.col("d")).alias("l"), T.extract_images(F.col("d")).alias("i")))
    assert r.l == ["https://a.org/job", "https://b.org/x", "https://cdn.c.org/p"]
    assert r.i == ["https://i.org/a.png"]


def test_html_to_text_and_clamp(spark):
    r = one(row(spark, h="<p>Hi<script>x</script><style>a{}</style> &amp; <b>you</b></p>", e="   ").select(
        T.html_to_text("h").alias("t"), T.html_to_text("e").alias("e"),
        T.clamp_text(F.lit("  abcdef  "), 3).alias("c"), T.clamp_text(F.lit(" ab "), 0).alias("n")))
    assert (r.t, r.e, r.c, r.n) == ("Hi & you", "", "abc", "ab")


def test_code_fence_and_markdown(spark):
    r = one(row(spark, c="```json\n{\"a\":1}\n```", m="a  \r\nb\n\n\n\nc").select(
        T.strip_code_fence("c").alias("c"), T.normalize_markdown("m").alias("m")))
    assert r.c == '{"a":1}'
    assert r.m == "a\nb\n\nc"


def test_categories(spark):
    vals = ["Programmazione", "marketing", "devops/sysadmin", "other roles", "data science", ""]
    df = spark.createDataFrame([(v,) for v in vals], ["c"])
    got = [r.c for r in df.select(T.normalize_category("c").alias("c")).collect()]
    assert got == ["Programmazione", "Marketing", "Devops & Sysadmin", "Altri ruoli", "Altri ruoli", "Altri ruoli"]


def test_tags(spark):
    vals = ["Remote EU", "full-time", "go_lang", "#C++", "  "]
    df = spark.createDataFrame([(v,) for v in vals], ["t"])
    assert [r.t for r in df.select(T.normalize_tag("t").alias("t")).collect()] == [
        "remoteeu", "fulltime", "golang", "c", ""]
    r = one(row(spark, x=1).select(T.sanitize_tags(F.array(*[F.lit(v) for v in
                                                             ["#Go", "Kubernetes", "Remote EU", "go"]])).alias("t")))
    assert r.t == ["go", "kubernetes", "remoteeu"]


def test_stack_and_unknown(spark):
    r = one(row(spark, x=1).select(
        T.sanitize_stack(F.array(*[F.lit(v) for v in ["Go", "n/a", "go", "K8s"]])).alias("s"),
        T.sanitize_unknown(F.lit(" Non Indicato ")).alias("u"), T.sanitize_unknown(F.lit(" Roma ")).alias("r")))
    assert r.s == ["Go", "K8s"] and r.u == "" and r.r == "Roma"


def test_salary_and_quality(spark):
    r = one(row(spark, x=1).select(
        T.has_clear_salary(F.lit("50k €")).alias("a"), T.has_clear_salary(F.lit("competitive 50k")).alias("b"),
        T.has_clear_salary(F.lit("tbd")).alias("c"),
        T.quality(F.lit("n/a"), F.lit("Remote EU"), F.lit("full-time"), F.lit("competitive"),
                  F.array(F.lit("Go"), F.lit("Kubernetes"))).alias("q")))
    assert (r.a, r.b, r.c) == (True, False, False)
    assert (r.q.score, r.q.rank, r.q.missing) == (60, "C", ["seniority", "salary"])


def test_escape_slug_endpoint(spark):
    r = one(row(spark, x=1).select(
        T.escape_markdown(F.lit("a_b*c[d`e\\f")).alias("e"), T.slugify(F.lit(" Senior Go (Remote) / EU_x. ")).alias("s"),
        T.endpoint_parts(F.lit("llama:8080")).alias("p"), T.endpoint_parts(F.lit("")).alias("z"),
        T.required_fields(F.lit(" "), F.lit("A"), F.lit("s")).alias("ok")))
    assert r.e == "a\\_b\\*c\\[d\\`e\\\\f"
    assert r.s == "senior-go-remote-eu-x"
    assert (r.p.host, r.p.port, r.z, r.ok) == ("llama", 8080, None, True)


def test_html_unescape_unbounded_and_unterminated(spark):
    cases = {"&#0000000065;": "A", "&#x000000000041;": "A", "&#99999999999999;": "\ufffd", "&amp x": "& x", "&ampx": "&x", "&copy2024": "\u00a92024",
             "&notit;": "\u00acit;", "&nosuchname;": "&nosuchname;", "&CounterClockwiseContourIntegral;": "\u2233", "a & b": "a & b"}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.u for r in df.select("s", T.html_unescape("s").alias("u")).collect()}
    assert got == cases
