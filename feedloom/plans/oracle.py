"""Independent DuckDB SQL for the correctness check.

The same adapter views as ``plans.views`` and the same rules as
``functions.text``, written as plain SQL text.  Builders take a SQL
expression and return a SQL expression; queries are single ``WITH ...
SELECT`` statements over the pre-registered driver tables.
"""

from __future__ import annotations

from feedloom.functions import fixed
from feedloom.plans import views as V

WS = r"[\s\x{0B}\x{85}\p{Z}]"
URI = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"
PATH_KEEP = r"[A-Za-z0-9\-._~!$&''()*+,;=:@/%]"
PATH_BAD = r"[^A-Za-z0-9\-._~!$&''()*+,;=:@/%]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def ts(s: str) -> str:
    return f"TIMESTAMP '{s}'"


def trim_space(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def norm_title(x: str) -> str:
    return collapse(f"lower(coalesce({x}, ''))")


def part(x: str, g: int) -> str:
    return f"regexp_extract({x}, '{URI}', {g})"


def parse_error(t: str) -> str:
    hp = f"regexp_replace({part(t, 3)}, '^.*@', '')"
    return (f"(regexp_matches({t}, '[\\x00-\\x1f\\x7f]') OR regexp_matches({t}, '%([^0-9A-Fa-f]|.[^0-9A-Fa-f]|.?$)')"
            f" OR starts_with({t}, ':') OR ({part(t, 2)} <> '' AND NOT starts_with({hp}, '[')"
            f" AND regexp_matches({hp}, ':.*[^0-9].*$|:.*:')))")


def enc_path(p: str) -> str:
    return (f"CASE WHEN regexp_matches({p}, '{PATH_BAD}') THEN array_to_string(list_transform("
            f"regexp_extract_all({p}, '(?s).', 0), lambda ch: CASE WHEN regexp_full_match(ch, '{PATH_KEEP}') "
            f"THEN ch ELSE regexp_replace(hex(encode(ch)), '(..)', '%\\1', 'g') END), '') ELSE {p} END")


def rebuild(t: str) -> str:
    return (f"(CASE WHEN {part(t, 1)} <> '' THEN lower({part(t, 1)}) || ':' ELSE '' END"
            f" || {part(t, 2)} || {enc_path(part(t, 4))} || {part(t, 5)})")


def norm_url(x: str) -> str:
    t = trim_space(f"coalesce({x}, '')")
    return f"(CASE WHEN {parse_error(t)} THEN {t} ELSE {rebuild(t)} END)"


def item_hash(g: str, u: str, t: str) -> str:
    gg = trim_space("coalesce(" + g + ", '')")
    return f"sha1({gg} || '|' || {norm_url(u)} || '|' || {norm_title(t)})"


def host(x: str) -> str:
    hp = f"regexp_replace({part(x, 3)}, '^.*@', '')"
    return f"regexp_replace(regexp_replace({hp}, ':[0-9]*$', ''), '^\\[|\\]$', '', 'g')"


def source_label(x: str) -> str:
    t = trim_space(f"coalesce({x}, '')")
    h = f"replace(regexp_replace(lower({host(t)}), '^www\\.', ''), '.', '_')"
    segs = f"list_filter(string_split(trim({part(t, 4)}, '/'), '/'), lambda s: {trim_space('s')} <> '')"
    last = f"lower(coalesce({segs}[-1], ''))"
    last = f"regexp_replace(regexp_replace({last}, '\\.rss$', ''), '\\.xml$', '')"
    last = f"trim(regexp_replace({last}, '[^a-z0-9]+', '_', 'g'), '_')"
    return (f"(CASE WHEN {parse_error(t)} THEN 'feed' WHEN {last} IN ('', 'feed') THEN {h} "
            f"ELSE {h} || '_' || {last} END)")


# Entities present in the test tables; &amp; last so one pass is kept.
_ENTS = [("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&lt;", "<"), ("&gt;", ">"),
         ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def unescape(x: str) -> str:
    out = x
    for k, v in _ENTS:
        out = f"replace({out}, {q(k)}, {q(v)})"
    return out


def clean_link(x: str) -> str:
    v0 = unescape(trim_space(f"coalesce({x}, '')"))
    v = f"(CASE WHEN starts_with({v0}, '//') THEN 'https:' || {v0} ELSE {v0} END)"
    ok = (f"({v} <> '' AND NOT {parse_error(v)} AND {part(v, 1)} <> '' AND "
          f"regexp_replace({part(v, 3)}, '^.*@', '') <> '')")
    return f"(CASE WHEN {ok} THEN {rebuild(v)} END)"


def html_to_text(x: str) -> str:
    c = f"coalesce({x}, '')"
    s = f"regexp_replace({c}, '(?is)<script[^>]*>.*?</script>', ' ', 'g')"
    s = f"regexp_replace({s}, '(?is)<style[^>]*>.*?</style>', ' ', 'g')"
    s = f"regexp_replace({s}, '(?s)<[^>]+>', ' ', 'g')"
    return f"(CASE WHEN {trim_space(c)} = '' THEN '' ELSE {collapse(unescape(s))} END)"


def clamp(x: str, n: int) -> str:
    t = trim_space(f"coalesce({x}, '')")
    if n <= 0:
        return t
    return f"(CASE WHEN length({t}) > {n} THEN {trim_space(f'substr({t}, 1, {n})')} ELSE {t} END)"


def sanitize_unknown(x: str) -> str:
    t = trim_space(f"coalesce({x}, '')")
    words = ", ".join(q(w) for w in fixed.PLACEHOLDERS)
    return f"(CASE WHEN lower({t}) IN ({words}) THEN '' ELSE {t} END)"


def links_text(url: str, blob: str) -> str:
    hrefs = f"regexp_extract_all({blob}, '(?i)href=[\"'']([^\"'']+)[\"'']', 1)"
    arr = f"list_concat([coalesce({url}, '')], {hrefs})"
    cleaned = f"list_filter(list_transform({arr}, lambda x: {clean_link('x')}), lambda x: x IS NOT NULL)"
    return f"array_to_string(list_sort(list_distinct({cleaned})), ' ')"


def images_text(blob: str) -> str:
    srcs = f"regexp_extract_all({blob}, '(?i)src=[\"'']([^\"'']+)[\"'']', 1)"
    cleaned = f"list_filter(list_transform({srcs}, lambda x: {clean_link('x')}), lambda x: x IS NOT NULL)"
    return f"array_to_string(list_sort(list_distinct({cleaned})), ' ')"


def _map_case(col: str, d: dict) -> str:
    arms = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in d.items())
    return f"CASE {col} {arms} END"


# ---------------------------------------------------------------- views
def v_items() -> str:
    origin = r"regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1)"
    first = r"regexp_extract(url, '^([A-Za-z]+://[^/?#]+/[^/?#]*)', 1)"
    return f"""v_items_base AS (
  SELECT CASE WHEN page_id % 6 = 0 THEN html
              ELSE replace(html, 'href="/', 'href="' || {origin} || '/') END AS description,
         CASE WHEN {first} <> '' THEN {first} ELSE {origin} END AS feed_url,
         page_id AS pos,
         CASE WHEN page_id % 5 = 0 THEN '' ELSE CAST(page_id AS VARCHAR) END AS guid,
         url,
         regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(page_id) AS published
  FROM pages),
v_items AS (
  SELECT * FROM v_items_base
  UNION ALL
  SELECT description, feed_url, pos + 1099511627776 AS pos, guid, url || '#dup' AS url,
         '  ' || replace(title, ' ', '   ') || chr(9) AS title, published
  FROM v_items_base WHERE pos % 7 = 0)"""


def raw_items(src: str = "v_items", now: str = V.NOW_ITEMS) -> str:
    return f"""raw AS (
  SELECT {item_hash('guid', 'url', 'title')} AS id,
         {trim_space('feed_url')} AS feed_url,
         {source_label('feed_url')} AS source_label,
         {trim_space("coalesce(guid, '')")} AS guid,
         {trim_space("coalesce(url, '')")} AS url,
         {trim_space("coalesce(title, '')")} AS title,
         {links_text('url', "coalesce(description, '') || chr(10)")} AS links,
         {images_text("coalesce(description, '') || chr(10)")} AS image_urls,
         coalesce(published, {ts(now)}) AS published_at,
         {ts(now)} AS fetched_at,
         pos
  FROM {src})"""


def v_doc_items() -> str:
    return """v_doc_items AS (
  SELECT 'https://' || source || '.example.org/feed' AS feed_url, doc_id AS pos, '' AS guid,
         'https://' || source || '.example.org/' || CAST(doc_id // 3 AS VARCHAR) AS url,
         split_part(text, chr(10), 1) AS title,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS published
  FROM documents)"""


def _log(name: str, actions: dict, offset: int) -> str:
    return f"""{name} AS (
  SELECT CAST(user_id + {offset} AS VARCHAR) AS item_id, CAST(ts AS TIMESTAMP) AS ts, event_id AS seq,
         {_map_case('event_type', actions)} AS action,
         'w' || CAST(event_id % 2 AS VARCHAR) AS worker,
         CAST(ts AS TIMESTAMP) + INTERVAL 12 HOUR AS lease_until,
         'error ' || props AS reason
  FROM events)"""


def v_log() -> str:
    return _log("v_log", V.ACTION_RAW, 0)


def v_log_dispatch() -> str:
    return _log("v_log_dispatch", V.ACTION_DISPATCH, 75)


def v_status() -> str:
    st = _map_case("event_type", V.STATUS_BY_EVENT)
    return f"""v_status0 AS (
  SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts, {st} AS status FROM events),
v_status1 AS (
  SELECT *, CASE WHEN status IN ('ANALYZED', 'DISPATCHED') THEN ts + to_minutes(event_id % 17) END AS analyzed_at,
            CASE WHEN status = 'DISPATCHED' THEN ts + to_minutes(event_id % 29) END AS dispatched_at
  FROM v_status0),
v_status AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         'https://src' || CAST(user_id % 23 AS VARCHAR) || '.example.org/feed' AS source_feed_url,
         'Job posting ' || CAST(event_id AS VARCHAR) AS title,
         'https://jobs.example.org/p/' || CAST(event_id AS VARCHAR) AS url,
         '' AS guid, status, ts AS created_at, analyzed_at, dispatched_at,
         coalesce(dispatched_at, analyzed_at, ts) AS updated_at,
         CASE WHEN event_id % 3 <> 0 THEN analyzed_at END AS analyzed_enqueued_at,
         CASE WHEN status = 'FAILED' THEN 'llm status: 503' ELSE '' END AS last_error,
         CASE WHEN status IN ('ANALYZED', 'DISPATCHED') AND event_id % 4 <> 0
              THEN '{{"id":"' || CAST(event_id AS VARCHAR) || '"}}' ELSE '' END AS analyzed_payload_json
  FROM v_status1)"""


def v_feeds() -> str:
    n = r"CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT)"
    return f"""v_feeds AS (
  SELECT 'https://' || source || '.example.org/feed' AS feed_url,
         ({n} % 4 <> 0) AS enabled,
         CASE WHEN {n} % 3 = 1 THEN TIMESTAMP '2024-01-31 06:00:00'
              WHEN {n} % 3 = 2 THEN TIMESTAMP '2024-01-30 18:00:00' END AS down_until,
         CASE WHEN {n} % 3 <> 0 THEN 5 ELSE 0 END AS failure_count,
         CASE WHEN {n} % 5 = 0 THEN TIMESTAMP '2024-01-30 23:00:00' + to_minutes({n}) END AS requested_at
  FROM (SELECT DISTINCT source FROM documents))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def with_rec(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def queue_fold(log: str, out: str, max_attempts: int | None = None) -> str:
    """F1 as a recursive CTE: one step per event, in (ts, seq) order per item.
    With ``max_attempts`` a release goes through F4."""
    e, f = "e", "f"
    E = f"({e}.action = 'enqueue')"
    C = (f"({e}.action = 'claim' AND {f}.ex AND ({f}.state = 'QUEUED' OR ({f}.state = 'LEASED' "
         f"AND {f}.lease_until IS NOT NULL AND {f}.lease_until <= {e}.ts)))")
    OK = f"({f}.ex AND {f}.lease_owner IS NOT NULL AND {f}.lease_owner = {e}.worker)"
    CP, RL, FL = (f"({e}.action = 'complete' AND {OK})", f"({e}.action = 'release' AND {OK})",
                  f"({e}.action = 'fail' AND {OK})")
    why = f"{e}.reason"
    if max_attempts is not None:
        POI = f"({RL} AND (lower({e}.reason) LIKE '%missing required analyzed fields%' OR {f}.delivery_count >= {max_attempts}))"
        why = (f"(CASE WHEN {POI} THEN 'poison_item: analysis_failed: ' WHEN {RL} THEN 'analysis_failed: ' ELSE '' END || {e}.reason)")
        RL, FL = f"({RL} AND NOT {POI})", f"({FL} OR {POI})"
    CLR = f"({E} OR {CP} OR {RL} OR {FL})"
    ANY = f"({E} OR {C} OR {CP} OR {RL} OR {FL})"
    return f"""{out}_ev AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY ts, seq) AS rn, action, worker, ts,
         lease_until, {trim_space("coalesce(reason, '')")} AS reason FROM {log}),
{out}_f(item_id, rn, ex, state, lease_owner, lease_until, delivery_count, enqueued_at, done_at, last_error, updated_at) AS (
  SELECT DISTINCT item_id, CAST(0 AS BIGINT), false, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
         CAST(NULL AS TIMESTAMP), 0, CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR),
         CAST(NULL AS TIMESTAMP) FROM {out}_ev
  UNION ALL
  SELECT {f}.item_id, {e}.rn, {f}.ex OR {E},
    CASE WHEN {E} THEN 'QUEUED' WHEN {C} THEN 'LEASED' WHEN {CP} OR {FL} THEN 'DONE' WHEN {RL} THEN 'QUEUED' ELSE {f}.state END,
    CASE WHEN {CLR} THEN NULL WHEN {C} THEN {e}.worker ELSE {f}.lease_owner END,
    CASE WHEN {CLR} THEN NULL WHEN {C} THEN {e}.lease_until ELSE {f}.lease_until END,
    CASE WHEN {C} THEN {f}.delivery_count + 1 WHEN {E} AND NOT {f}.ex THEN 0 ELSE {f}.delivery_count END,
    CASE WHEN {E} AND NOT {f}.ex THEN {e}.ts ELSE {f}.enqueued_at END,
    CASE WHEN {CP} OR {FL} THEN coalesce({f}.done_at, {e}.ts) ELSE {f}.done_at END,
    CASE WHEN {E} OR {C} OR {CP} THEN '' WHEN {RL} OR {FL} THEN {why} ELSE {f}.last_error END,
    CASE WHEN {ANY} THEN {e}.ts ELSE {f}.updated_at END
  FROM {out}_f {f} JOIN {out}_ev {e} ON {e}.item_id = {f}.item_id AND {e}.rn = {f}.rn + 1),
{out} AS (
  SELECT item_id, state, lease_owner, lease_until, CAST(delivery_count AS INTEGER) AS delivery_count,
         enqueued_at, done_at, last_error, updated_at
  FROM {out}_f WHERE ex QUALIFY rn = max(rn) OVER (PARTITION BY item_id))"""


def status_fold(log: str, out: str) -> str:
    """F2 as a sequential recursive CTE (independent of the aggregate rule)."""
    g = "(e.status IN ('ANALYZED', 'FAILED') AND f.status = 'DISPATCHED')"
    return f"""{out}_ev AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY ts, seq) AS rn, ts, status, error FROM {log}),
{out}_f(item_id, rn, status, last_error, status_at, dispatched_at) AS (
  SELECT DISTINCT item_id, CAST(0 AS BIGINT), 'NEW', '', CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP) FROM {out}_ev
  UNION ALL
  SELECT f.item_id, e.rn,
    CASE WHEN {g} THEN f.status ELSE e.status END,
    CASE WHEN {g} THEN f.last_error ELSE coalesce(e.error, '') END,
    CASE WHEN {g} THEN f.status_at ELSE e.ts END,
    CASE e.status WHEN 'DISPATCHED' THEN e.ts WHEN 'NEW' THEN NULL ELSE f.dispatched_at END
  FROM {out}_f f JOIN {out}_ev e ON e.item_id = f.item_id AND e.rn = f.rn + 1),
{out} AS (SELECT item_id, status, last_error, status_at, dispatched_at FROM {out}_f
  WHERE rn > 0 QUALIFY rn = max(rn) OVER (PARTITION BY item_id))"""


def _arr(values: list) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def _pick(values: list, idx: str) -> str:
    return f"{_arr(values)}[({idx}) % {len(values)} + 1]"


def v_responses() -> str:
    k = "doc_id % 11"
    sen = f"CASE WHEN {k} = 1 THEN 'N/A' ELSE {_pick(V.RESP_SENIORITY, 'doc_id')} END"
    loc = f"CASE WHEN {k} = 1 THEN 'unknown' ELSE {_pick(V.RESP_LOCATION, 'doc_id')} END"
    con = f"CASE WHEN {k} = 1 THEN 'tbd' ELSE {_pick(V.RESP_CONTRACT, 'doc_id')} END"
    sal = f"CASE WHEN {k} = 1 THEN 'n/a' WHEN {k} = 8 THEN 'competitive' ELSE {_pick(V.RESP_SALARY, 'doc_id')} END"
    stack = f"CASE WHEN {k} = 1 THEN '[\"none\"]' ELSE {_pick(V.RESP_STACK, 'doc_id')} END"
    t = "regexp_replace(coalesce(text, ''), '[\"\\\\\\x00-\\x1f]+', ' ', 'g')"
    role = f"CASE WHEN {k} = 4 THEN '42' ELSE '\"' || substr({t}, 1, 40) || '\"' END"
    company = f"CASE WHEN {k} = 5 THEN '' ELSE ',\"company\":\"Company ' || source || '\"' END"
    lang = "CASE WHEN doc_id % 3 <> 0 THEN lang ELSE '' END"
    full = (f"'{{\"job_category\":\"' || {_pick(V.RESP_CATEGORIES, 'doc_id')} || '\",\"role\":' || {role} || {company}"
            f" || ',\"seniority\":\"' || {sen} || '\",\"location\":\"' || {loc} || '\",\"remote_type\":\"remote\",\"tech_stack\":'"
            f" || {stack} || ',\"tags\":' || {_pick(V.RESP_TAGS, 'doc_id')} || ',\"contract_type\":\"' || {con}"
            f" || '\",\"salary\":\"' || {sal} || '\",\"language\":\"' || {lang} || '\",\"summary_it\":\"'"
            f" || substr({t}, 41, 400) || '\",\"confidence\":' || {_pick(V.RESP_CONFIDENCE, k)} || '}}'")
    return f"""v_responses AS (
  SELECT CAST(doc_id AS VARCHAR) AS item_id,
         CASE WHEN {k} = 6 THEN substr({full}, 1, 60)
              WHEN {k} = 7 THEN '```json' || chr(10) || {full} || chr(10) || '```'
              ELSE {full} END AS content
  FROM documents)"""


def v_doc_raw() -> str:
    url = "'https://' || source || '.example.org/job/' || CAST(doc_id AS VARCHAR)"
    return f"""v_doc_raw AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, '' AS guid, {url} AS url, source AS source_label,
         split_part(text, chr(10), 1) AS title, text AS description,
         [{url}, {url} || '#apply', ' ', {url}] AS links,
         ['https://img.example.org/' || source || '.png'] AS image_urls,
         CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS excerpt
  FROM documents)"""


def strip_fence(x: str) -> str:
    t = trim_space(f"coalesce({x}, '')")
    t = f"regexp_replace(regexp_replace(regexp_replace({t}, '^```json', ''), '^```', ''), '```$', '')"
    return trim_space(t)


def stable_distinct(lst: str) -> str:
    return f"list_filter({lst}, lambda x, i: NOT list_contains({lst}[1:i - 1], x))"


def norm_tag(x: str) -> str:
    return f"lower(regexp_replace(coalesce({x}, ''), '[^\\p{{L}}\\p{{Nd}}]', '', 'g'))"


def sanitize_tags(lst: str) -> str:
    a = f"list_transform(list_filter(list_transform(coalesce({lst}, [])[1:6], lambda x: {norm_tag('x')}), lambda x: x <> ''), lambda x: substr(x, 1, 24))"
    return stable_distinct(a)


def sanitize_stack(lst: str) -> str:
    a = f"list_filter(list_transform(coalesce({lst}, [])[1:8], lambda x: {sanitize_unknown('x')}), lambda x: x <> '')"
    return (f"list_filter({a}, lambda x, i: NOT list_contains(list_transform({a}[1:i - 1], lambda y: lower(y)), lower(x)))")


def has_clear_salary(x: str) -> str:
    s = sanitize_unknown(x)
    vague = "|".join(fixed.VAGUE_SALARY_TOKENS)
    return f"({s} <> '' AND NOT regexp_matches(lower({s}), '{vague}') AND regexp_matches({s}, '[0-9€$£]'))"


def category(x: str) -> str:
    k = "lower(" + trim_space("coalesce(" + x + ", '')") + ")"
    arms = " ".join(f"WHEN {q(a)} THEN {q(v)}" for a, v in fixed.CATEGORY_ALIASES.items())
    return f"CASE {k} {arms} ELSE {q(fixed.DEFAULT_CATEGORY)} END"


def _list_lit(lst: list) -> str:
    return "CAST([" + ", ".join(q(x) for x in lst) + "] AS VARCHAR[])"


def _pick_list(lists: list, idx: str) -> str:
    return "[" + ", ".join(_list_lit(x) for x in lists) + f"][({idx}) % {len(lists)} + 1]"


def v_analyzed() -> str:
    url = "'https://' || source || '.example.org/job/' || CAST(doc_id AS VARCHAR)"
    score = "(doc_id % 6) * 20"
    t = "regexp_replace(coalesce(text, ''), '[ \\t\\r\\n]+', ' ', 'g')"
    return f"""v_analyzed AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, source AS source_label, {url} AS source_url,
    substr({t}, 1, 60) AS title,
    {_pick(['Programmazione', 'Devops & Sysadmin', 'Marketing', 'Altri ruoli'], 'doc_id')} AS job_category,
    CASE WHEN doc_id % 10 = 0 THEN '' ELSE 'Dev_' || substr({t}, 1, 30) || ' *lead*' END AS role,
    'ACME [' || source || ']' AS company,
    {_pick(V.AN_SENIORITY, 'doc_id')} AS seniority, {_pick(V.AN_LOCATION, 'doc_id')} AS location,
    'remote' AS remote_type, {_pick(V.AN_CONTRACT, 'doc_id')} AS contract_type, {_pick(V.AN_SALARY, 'doc_id')} AS salary,
    CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'Sintesi `x` ' || substr({t}, 61, 500) END AS summary_it,
    lang AS language, {_pick_list(V.AN_STACKS, 'doc_id')} AS tech_stack, {_pick_list(V.AN_TAGS, 'doc_id')} AS tags,
    CASE WHEN doc_id % 4 = 0 THEN CAST([] AS VARCHAR[]) ELSE [{url}, {url} || '/apply'] END AS original_links,
    CASE WHEN doc_id % 5 = 0 THEN ['https://img.example.org/' || source || '.png'] ELSE CAST([] AS VARCHAR[]) END AS original_images,
    CAST({score} AS INTEGER) AS job_post_quality_score,
    CASE WHEN {score} >= 90 THEN 'A' WHEN {score} >= 70 THEN 'B' WHEN {score} >= 50 THEN 'C' ELSE 'D' END AS job_post_quality_rank,
    round((doc_id % 100) / 100.0, 2) AS confidence,
    TIMESTAMP '2024-01-02 00:00:00' + to_seconds(doc_id) AS created_at
  FROM documents)"""


def md(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '([\\\\_*\\[`])', '\\\\\\1', 'g')"
