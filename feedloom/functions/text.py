"""Scalar text, URL and list rules as native ``Column`` builders.

Each builder returns a Catalyst expression, so the rules run inside
whole-stage codegen next to the scan that feeds them.  No row UDFs.
Operator ids refer to the inventory (B1 ... B27).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions import fixed

def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


_MEMO: dict = {}


def memo(fn):
    """Reuse a built expression when a rule is called with column names.

    Building the larger rules takes thousands of Py4J calls; Columns are
    immutable unresolved expressions, so the same one can serve every query
    of the application (keyed per SparkContext).
    """
    import functools

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        plain = all(a is None or isinstance(a, (str, int, float, bool)) for a in list(args) + list(kwargs.values()))
        if not plain:
            return fn(*args, **kwargs)
        from pyspark import SparkContext
        sc = SparkContext._active_spark_context
        key = (fn.__name__, id(sc), args, tuple(sorted(kwargs.items())))
        if key not in _MEMO:
            _MEMO[key] = fn(*args, **kwargs)
        return _MEMO[key]
    return wrapper


def trim_space(c) -> Column:
    """Trim Unicode white space on both ends (not only ASCII blanks)."""
    return F.regexp_replace(_c(c), "(?U)^\\s+|\\s+$", "")


def collapse_space(c) -> Column:
    """Runs of Unicode white space become one blank; result is trimmed."""
    return F.trim(F.regexp_replace(_c(c), "(?U)\\s+", " "))


# ---------------------------------------------------------------- B1
@memo
def normalize_title(c) -> Column:
    """B1: lower, trim, collapse Unicode white space runs to one blank."""
    return collapse_space(F.lower(F.coalesce(_c(c), F.lit(""))))


# ---------------------------------------------------------------- B2
# Generic URI split: scheme, //authority, path, ?query, #fragment.
_URI_RE = "^(?:([A-Za-z][A-Za-z0-9+.\\-]*):)?(//([^/?#]*))?([^?#]*)(\\?[^#]*)?(#.*)?$"
# Path characters kept verbatim when a path is re-encoded.
_PATH_KEEP = "[A-Za-z0-9\\-._~!$&'()*+,;=:@/%]"
_PATH_BAD = "[^A-Za-z0-9\\-._~!$&'()*+,;=:@/%]"


def _let(value: Column, fn) -> Column:
    """Bind ``value`` once to a lambda variable and return ``fn(var)``.

    Catalyst does not share common sub-expressions inside higher-order
    functions, so a rule that uses an input many times binds it first.
    """
    return F.element_at(F.transform(F.array(value), fn), 1)


def _url_part(c: Column, group: int) -> Column:
    return F.regexp_extract(c, _URI_RE, group)


def _url_parts(t: Column) -> Column:
    return F.struct(*[F.regexp_extract(t, _URI_RE, g).alias(f"p{g}") for g in (1, 2, 3, 4, 5)])


def _parse_error_parts(t: Column, p: Column) -> Column:
    hostport = F.regexp_replace(p["p3"], "^.*@", "")
    bad_port = (p["p2"] != "") & ~hostport.startswith("[") & hostport.rlike(":.*[^0-9].*$|:.*:")
    return (
        t.rlike("[\\x00-\\x1f\\x7f]")
        | t.rlike("%([^0-9A-Fa-f]|.[^0-9A-Fa-f]|.?$)")
        | t.startswith(":")
        | bad_port
    )


def url_parse_error(c) -> Column:
    """True when the text is not a parseable URL reference.

    Rules: control characters, a ``%`` not followed by two hex digits,
    a leading ``:`` (missing scheme) or a non-numeric port.
    """
    return _let(_c(c), lambda t: _parse_error_parts(t, _url_parts(t)))


def percent_encode_path(path: Column) -> Column:
    """Percent-encode (UTF-8) every path character outside the kept set."""
    chars = F.regexp_extract_all(path, F.lit("(?s)."), F.lit(0))
    enc = F.transform(
        chars,
        lambda ch: F.when(ch.rlike("^" + _PATH_KEEP + "$"), ch).otherwise(
            F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1")),
    )
    return F.when(path.rlike(_PATH_BAD), F.array_join(enc, "")).otherwise(path)


def _rebuild_parts(p: Column) -> Column:
    return F.concat(
        F.when(p["p1"] != "", F.concat(F.lower(p["p1"]), F.lit(":"))).otherwise(F.lit("")),
        p["p2"],
        percent_encode_path(p["p4"]),
        p["p5"],
    )


@memo
def normalize_url(c) -> Column:
    """B2: trim; drop the fragment; lower-case scheme; escape the path.

    An unparseable input is returned trimmed but otherwise unchanged.
    """
    def rule(t):
        return _let(_url_parts(t), lambda p: F.when(_parse_error_parts(t, p), t).otherwise(_rebuild_parts(p)))
    return _let(trim_space(F.coalesce(_c(c), F.lit(""))), rule)


# ---------------------------------------------------------------- B3
@memo
def item_hash(guid, url, title) -> Column:
    """Hex sha1 of trim(guid) | normalize_url(url) | normalize_title(title)."""
    return F.sha1(F.concat_ws(
        "|",
        trim_space(F.coalesce(_c(guid), F.lit(""))),
        normalize_url(url),
        normalize_title(title),
    ))


# ---------------------------------------------------------------- B4
def _host_of(p: Column) -> Column:
    hostport = F.regexp_replace(p["p3"], "^.*@", "")
    return F.regexp_replace(F.regexp_replace(hostport, ":[0-9]*$", ""), "^\\[|\\]$", "")


def url_host(c) -> Column:
    """Host name of an absolute URL: no user info, no port, no brackets."""
    return _let(_url_parts(_c(c)), _host_of)


@memo
def source_label(c) -> Column:
    """Host (lower, no ``www.``, dots to ``_``) + ``_`` + last path segment."""
    def rule(t, p):
        host = F.replace(F.regexp_replace(F.lower(_host_of(p)), "^www\\.", ""), F.lit("."), F.lit("_"))
        segs = F.filter(F.split(F.btrim(p["p4"], F.lit("/")), "/"), lambda s: trim_space(s) != "")
        last = F.lower(F.coalesce(F.try_element_at(segs, F.lit(-1)), F.lit("")))
        last = F.regexp_replace(F.regexp_replace(last, "\\.rss$", ""), "\\.xml$", "")
        last = F.btrim(F.regexp_replace(last, "[^a-z0-9]+", "_"), F.lit("_"))
        label = _let(F.struct(host.alias("h"), last.alias("l")), lambda hl: F.when(
            (hl["l"] == "") | (hl["l"] == "feed"), hl["h"]).otherwise(F.concat(hl["h"], F.lit("_"), hl["l"])))
        return F.when(_parse_error_parts(t, p), F.lit("feed")).otherwise(label)
    return _let(trim_space(F.coalesce(_c(c), F.lit(""))), lambda t: _let(_url_parts(t), lambda p: rule(t, p)))


# ---------------------------------------------------------------- B5
@memo
def valid_feed_url(c) -> Column:
    """Scheme is http or https."""
    t = trim_space(F.coalesce(_c(c), F.lit("")))
    scheme = F.lower(F.regexp_extract(t, "^([A-Za-z][A-Za-z0-9+.\\-]*):", 1))
    return scheme.isin("http", "https") & ~url_parse_error(t)


# ---------------------------------------------------------------- B9
_ENTITY_RE = "&(#[0-9]+;?|#[xX][0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;?)"
_LEGACY_LONGEST = 6  # longest reference name that may stand without its semicolon


def _named_entity_map() -> Column:
    # Built from the HTML5 named character reference table of the Python
    # standard library (a public rule source).  One JSON literal: Catalyst
    # folds it into a constant map once.
    import html.entities as he
    import json

    return F.from_json(F.lit(json.dumps(he.html5, ensure_ascii=False)), "map<string,string>")


def _legacy_entity_map() -> Column:
    """The names that may stand without a semicolon."""
    import html.entities as he
    import json

    table = {k: v for k, v in he.html5.items() if not k.endswith(";")}
    return F.from_json(F.lit(json.dumps(table, ensure_ascii=False)), "map<string,string>")


def _named_ref(e: Column) -> Column:
    """A named reference with or without its semicolon; else the longest
    legacy name that the text begins with; else the text as it is."""
    name = F.substring(e, 2, 2 ** 31 - 1)
    found = [F.element_at(_named_entity_map(), name)]
    for n in range(_LEGACY_LONGEST, 1, -1):
        found.append(F.when(F.length(name) > n, F.concat(
            F.element_at(_legacy_entity_map(), F.substring(name, 1, n)), F.substring(name, n + 1, 2 ** 31 - 1))))
    return F.coalesce(*found, e)


def _numeric_ref(e: Column) -> Column:
    digits = F.regexp_extract(e, "^&#([0-9]+);?$", 1)
    hexd = F.regexp_extract(e, "^&#[xX]([0-9A-Fa-f]+);?$", 1)
    # any number of digits: leading zeros do not count, and more than ten digits are out of range
    dec, hx = F.regexp_replace(digits, "^0+(?=.)", ""), F.regexp_replace(hexd, "^0+(?=.)", "")
    num = F.when((digits != "") & (F.length(dec) <= 10), dec.try_cast("bigint")).when(
        (hexd != "") & (F.length(hx) <= 10), F.conv(hx, 16, 10).try_cast("bigint"))
    c1 = F.create_map(*[x for k, v in fixed.C1_REPLACEMENTS.items() for x in (F.lit(k), F.lit(v))])

    def rule(n):
        bad = n.isNull() | (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        as_text = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return (F.when(bad, F.lit("\ufffd"))
                .when(n.between(0x80, 0x9F), F.coalesce(F.element_at(c1, n.cast("int")), as_text))
                .otherwise(as_text))
    return _let(num, rule)


@memo
def html_unescape(c) -> Column:
    """One pass over named and numeric character references.

    The text is split at references; each reference is decoded once and the
    pieces are zipped back, so ``&amp;lt;`` yields ``&lt;``.
    """
    def rule(c):
        parts = F.split(c, _ENTITY_RE, -1)
        ents = F.regexp_extract_all(c, F.lit("(" + _ENTITY_RE + ")"), F.lit(1))
        decoded = F.transform(ents, lambda e: F.when(
            e.startswith("&#"), _numeric_ref(e)).otherwise(
            _named_ref(e)))

        def join(ps):
            tail = F.zip_with(decoded, F.slice(ps, 2, F.greatest(F.size(ps) - 1, F.lit(1))),
                              lambda d, p: F.concat(d, F.coalesce(p, F.lit(""))))
            return F.concat(F.element_at(ps, 1), F.array_join(tail, ""))
        return F.when(~c.contains("&"), c).otherwise(_let(parts, join))
    return _let(F.coalesce(_c(c), F.lit("")), rule)


# ---------------------------------------------------------------- B6
@memo
def clean_link(c) -> Column:
    """Trim, unescape, ``//x`` -> ``https://x``; needs scheme and host; no fragment.

    Invalid input gives null.
    """
    def rule(v):
        def check(p):
            ok = ((v != "") & ~_parse_error_parts(v, p) & (p["p1"] != "")
                  & (F.regexp_replace(p["p3"], "^.*@", "") != ""))
            return F.when(ok, _rebuild_parts(p))
        return _let(_url_parts(v), check)
    v0 = html_unescape(trim_space(F.coalesce(_c(c), F.lit(""))))
    return _let(v0, lambda v: _let(
        F.when(v.startswith("//"), F.concat(F.lit("https:"), v)).otherwise(v), rule))


# ---------------------------------------------------------------- B7/B8
_HREF_RE = "(?i)href=[\"']([^\"']+)[\"']"
_SRC_RE = "(?i)src=[\"']([^\"']+)[\"']"


def _clean_set(arr: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(arr, clean_link),
                                                  lambda x: x.isNotNull())))


@memo
def extract_links(link, description, content=None, enclosures=None) -> Column:
    """Item link + every href in description/content + enclosure urls; sorted set."""
    blob = F.concat_ws("\n", F.coalesce(_c(description), F.lit("")),
                       F.coalesce(_c(content), F.lit("")) if content is not None else F.lit(""))
    hrefs = F.regexp_extract_all(blob, F.lit(_HREF_RE), F.lit(1))
    parts = [F.array(F.coalesce(_c(link), F.lit(""))), hrefs]
    if enclosures is not None:
        parts.append(F.transform(F.coalesce(_c(enclosures), F.array()), lambda e: e["url"]))
    return _clean_set(F.concat(*parts))


@memo
def extract_images(description, content=None, enclosures=None) -> Column:
    """Every src in description/content + image enclosures; sorted set."""
    blob = F.concat_ws("\n", F.coalesce(_c(description), F.lit("")),
                       F.coalesce(_c(content), F.lit("")) if content is not None else F.lit(""))
    parts = [F.regexp_extract_all(blob, F.lit(_SRC_RE), F.lit(1))]
    if enclosures is not None:
        imgs = F.filter(F.coalesce(_c(enclosures), F.array()),
                        lambda e: F.lower(F.coalesce(e["type"], F.lit(""))).startswith("image/"))
        parts.append(F.transform(imgs, lambda e: e["url"]))
    return _clean_set(F.concat(*parts))


# ---------------------------------------------------------------- B10/B11
def strip_tags(c) -> Column:
    """Script, style, then any tag become one blank each."""
    c = F.coalesce(_c(c), F.lit(""))
    c = F.regexp_replace(c, "(?is)<script[^>]*>.*?</script>", " ")
    c = F.regexp_replace(c, "(?is)<style[^>]*>.*?</style>", " ")
    return F.regexp_replace(c, "(?s)<[^>]+>", " ")


@memo
def html_to_text(c) -> Column:
    """Blank -> ''; drop script/style/tags; unescape; collapse white space."""
    c = F.coalesce(_c(c), F.lit(""))
    return F.when(trim_space(c) == "", F.lit("")).otherwise(
        collapse_space(html_unescape(strip_tags(c))))


def clamp_text(c, max_chars: int) -> Column:
    """Trim; cut to ``max_chars`` code points and trim again; <= 0 = no limit."""
    t = trim_space(F.coalesce(_c(c), F.lit("")))
    if max_chars <= 0:
        return t
    return F.when(F.length(t) > max_chars, trim_space(F.substring(t, 1, max_chars))).otherwise(t)


# ---------------------------------------------------------------- B12
def normalize_markdown(c, max_chars: int = 0) -> Column:
    """Trim; CRLF->LF; 3+ newlines -> 2; blanks before a newline removed; clamp."""
    t = trim_space(F.coalesce(_c(c), F.lit("")))
    t = F.replace(t, F.lit("\r\n"), F.lit("\n"))
    t = F.regexp_replace(t, "\n{3,}", "\n\n")
    t = F.regexp_replace(t, "[ \t]+\n", "\n")
    if max_chars > 0:
        t = trim_space(F.substring(t, 1, max_chars))
    return t


# ---------------------------------------------------------------- B14
def strip_code_fence(c) -> Column:
    """Trim; drop a leading ```json then ```, a trailing ```; trim."""
    t = trim_space(F.coalesce(_c(c), F.lit("")))
    t = F.regexp_replace(t, "^```json", "")
    t = F.regexp_replace(t, "^```", "")
    t = F.regexp_replace(t, "```$", "")
    return trim_space(t)


# ---------------------------------------------------------------- B15
def sanitize_unknown(c) -> Column:
    """Trimmed text, or '' when it is one of the placeholder words."""
    t = trim_space(F.coalesce(_c(c), F.lit("")))
    return F.when(F.lower(t).isin(*fixed.PLACEHOLDERS), F.lit("")).otherwise(t)


# ---------------------------------------------------------------- B16
def normalize_category(c) -> Column:
    """Alias map on lower/trim, else the default category."""
    k = F.lower(trim_space(F.coalesce(_c(c), F.lit(""))))
    amap = F.create_map(*[x for a, v in fixed.CATEGORY_ALIASES.items() for x in (F.lit(a), F.lit(v))])
    return F.coalesce(F.element_at(amap, k), F.lit(fixed.DEFAULT_CATEGORY))


# ---------------------------------------------------------------- B18-B21
def normalize_tag(c) -> Column:
    """Letters and digits only, lower-cased (a leading ``#`` goes too)."""
    return F.lower(F.regexp_replace(F.coalesce(_c(c), F.lit("")), "[^\\p{L}\\p{Nd}]", ""))


def sanitize_tags(arr, keep: int = 6, max_len: int = 24) -> Column:
    """First ``keep`` raw tags; normalise; drop blank; cut; stable distinct."""
    a = F.slice(F.coalesce(_c(arr), F.array().cast("array<string>")), 1, keep)
    a = F.filter(F.transform(a, normalize_tag), lambda t: t != "")
    return F.array_distinct(F.transform(a, lambda t: F.substring(t, 1, max_len)))


def sanitize_stack(arr, keep: int = 8) -> Column:
    """First ``keep`` raw entries; placeholders out; case-insensitive stable distinct."""
    a = F.slice(F.coalesce(_c(arr), F.array().cast("array<string>")), 1, keep)
    a = F.filter(F.transform(a, sanitize_unknown), lambda t: t != "")
    return F.aggregate(
        a, F.array().cast("array<string>"),
        lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc)
        .otherwise(F.concat(acc, F.array(x))))


def unique_urls(*arrays) -> Column:
    """Trimmed, blank dropped, stable distinct over the concatenation."""
    parts = [F.coalesce(_c(a), F.array().cast("array<string>")) for a in arrays]
    a = F.transform(F.concat(*parts), trim_space)
    return F.array_distinct(F.filter(a, lambda x: x.isNotNull() & (x != "")))


# ---------------------------------------------------------------- B22/B23
_VAGUE_RE = "|".join(re.escape(t) for t in fixed.VAGUE_SALARY_TOKENS)


def has_clear_salary(c) -> Column:
    """Not a placeholder, no vague token, has a digit or a currency sign."""
    s = sanitize_unknown(c)
    return (s != "") & ~F.lower(s).rlike(_VAGUE_RE) & s.rlike("[0-9€$£]")


def quality(seniority, location, contract_type, salary, tech_stack) -> Column:
    """struct(score, rank, missing) from five checks worth 20 each."""
    checks = [
        ("seniority", sanitize_unknown(seniority) != ""),
        ("location", sanitize_unknown(location) != ""),
        ("contract_type", sanitize_unknown(contract_type) != ""),
        ("salary", has_clear_salary(salary)),
        ("tech_stack", F.size(sanitize_stack(tech_stack)) > 0),
    ]
    score = sum((F.when(ok, F.lit(20)).otherwise(F.lit(0)) for _, ok in checks), F.lit(0))
    rank = (F.when(score >= 90, "A").when(score >= 70, "B").when(score >= 50, "C").otherwise("D"))
    missing = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in checks]))
    return F.struct(score.alias("score"), rank.alias("rank"), missing.alias("missing"))


# ---------------------------------------------------------------- B24/B25/B26/B27
def escape_markdown(c) -> Column:
    """Backslash-escape backslash, underscore, star, bracket and backtick."""
    return F.regexp_replace(F.coalesce(_c(c), F.lit("")), "([\\\\_*\\[`])", "\\\\$1")


def slugify(c) -> Column:
    """lower/trim; blank / _ -> '-'; drop ( ) . , :; collapse '--'; trim '-'."""
    s = F.lower(trim_space(F.coalesce(_c(c), F.lit(""))))
    s = F.translate(s, " /_().,:", "---")
    s = F.regexp_replace(s, "-{2,}", "-")
    return F.btrim(s, F.lit("-"))


def endpoint_parts(c) -> Column:
    """struct(host, port) of an endpoint; ``http://`` added when no scheme."""
    t = trim_space(F.coalesce(_c(c), F.lit("")))
    t = F.when(t.contains("://"), t).otherwise(F.concat(F.lit("http://"), t))
    hostport = F.regexp_replace(_url_part(t, 3), "^.*@", "")
    host = url_host(t)
    port = F.regexp_extract(hostport, ":([0-9]+)$", 1)
    ok = ~url_parse_error(t) & (trim_space(host) != "")
    return F.when(ok, F.struct(host.alias("host"),
                               F.when(port != "", port.try_cast("int")).alias("port")))


def required_fields(role, company, summary) -> Column:
    """Role, company and summary are all non-empty (white space passes)."""
    return ((F.coalesce(_c(role), F.lit("")) != "")
            & (F.coalesce(_c(company), F.lit("")) != "")
            & (F.coalesce(_c(summary), F.lit("")) != ""))
