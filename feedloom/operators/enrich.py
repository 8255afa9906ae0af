"""Page enrichment: basic text excerpts, main-content blocks, markdown.

C1 and C5 are column expressions; the page text is cut to its excerpt before
the join with the items.  Finding the main content block needs balanced tag
matching, which regular expressions cannot do, so C2 and C3 are one
``mapInPandas`` stage: it reads each page once with the standard-library
tokeniser into a flat event list (no recursion, so depth does not matter),
finds and scores the candidate blocks, and returns them with the html of the
best one.  Markdown (B13) is written from the same events.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import text as T
from feedloom.operators.markdown import to_markdown
from feedloom.session import ship_package

# --- fixed values: noise elements removed before choosing a block ----------
NOISE_TAGS = {"script", "style", "noscript", "svg", "path", "head", "meta", "link", "iframe",
              "nav", "header", "footer", "aside", "form"}
# --- fixed values: candidate selectors, in rank order ----------------------
SELECTORS = [
    "main article",
    "section.listing-container",
    "#job-listing-show-container",
    "#job_show",
    "[data-testid='job-details']",
    "main",
    "article",
    ".listing-container",
]
# --- fixed values: block score terms ---------------------------------------
SCORE_TITLE, SCORE_ABOUT, SCORE_SALARY, SCORE_JOBTYPE, SCORE_APPLY = 6000, 4000, 3000, 2000, 1000
SCORE_RELATED, SCORE_H1 = -5000, 2000

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}


# Start tags that end an open element of the given kinds, up to the nearest boundary.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "p": ({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "main", "body", "dd", "button"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "option": ({"option"}, {"select", "datalist"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
}


class _Page(HTMLParser):
    """A page as flat events: ``(kind, value)`` with kind s(tart), e(nd), t(ext)
    or c(omment).  Nodes are ``[tag, attrs, first event, event behind, parent,
    inside main]``; noise elements leave no events."""

    def __init__(self, drop: set = NOISE_TAGS):
        super().__init__(convert_charrefs=True)
        self.drop = drop
        self.nodes = [["#root", {}, 0, 0, -1, False]]
        self.noise = [False]
        self.open, self.n_open, self.events = [0], Counter(), []

    def handle_starttag(self, tag, attrs, empty=False):
        closes, bounds = _IMPLIED.get(tag, ((), ()))
        if any(self.n_open[t] for t in closes):
            for i in range(len(self.open) - 1, 0, -1):
                name = self.nodes[self.open[i]][0]
                if name in closes:
                    self._close(i)
                    break
                if name in bounds:
                    break
        parent = self.open[-1]
        k = len(self.nodes)
        self.nodes.append([tag, {a: (v or "") for a, v in attrs}, len(self.events), len(self.events), parent,
                           self.nodes[parent][5] or self.nodes[parent][0] == "main"])
        self.noise.append(self.noise[parent] or tag in self.drop)
        if not self.noise[k]:
            self.events.append(("s", k))
        self.open.append(k)
        self.n_open[tag] += 1
        if empty or tag in _VOID:
            self._close(len(self.open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, empty=True)

    def _close(self, depth):
        while len(self.open) > depth:
            k = self.open.pop()
            self.n_open[self.nodes[k][0]] -= 1
            if not self.noise[k]:
                self.events.append(("e", k))
            self.nodes[k][3] = len(self.events)

    def handle_endtag(self, tag):
        if self.n_open[tag]:
            i = len(self.open) - 1
            while self.nodes[self.open[i]][0] != tag:
                i -= 1
            self._close(i)

    def handle_data(self, data):
        if self.noise[self.open[-1]]:
            return
        if self.events and self.events[-1][0] == "t":
            self.events[-1] = ("t", self.events[-1][1] + data)
        else:
            self.events.append(("t", data))

    def handle_comment(self, data):
        self.events.append(("c", data))

    def done(self):
        self.close()
        self._close(1)
        self.nodes[0][3] = len(self.events)
        return self

    def strings(self, node) -> str:
        """The stripped texts below a node, joined by blanks."""
        return " ".join(x for x in (v.strip() for kind, v in self.events[node[2]:node[3]] if kind == "t") if x)

    def html(self, node) -> str:
        out = []
        for kind, v in self.events[node[2]:node[3]]:
            if kind == "t":
                out.append(escape(v, quote=False))
            elif kind == "s":
                tag, attrs = self.nodes[v][:2]
                out.append(f"<{tag}" + "".join(f' {a}="{escape(x)}"' for a, x in attrs.items()) + ("/>" if tag in _VOID else ">"))
            elif kind == "e" and self.nodes[v][0] not in _VOID:
                out.append(f"</{self.nodes[v][0]}>")
        return "".join(out)


def _rank(node) -> int | None:
    """The first selector that matches the node."""
    tag, attrs, _, _, _, in_main = node
    classes = attrs.get("class", "").split()
    hits = (tag == "article" and in_main, tag == "section" and "listing-container" in classes,
            attrs.get("id") == "job-listing-show-container", attrs.get("id") == "job_show",
            attrs.get("data-testid") == "job-details", tag == "main", tag == "article", "listing-container" in classes)
    return next((i for i, hit in enumerate(hits) if hit), None)


def block_score(text: str, main_title: str, has_h1: bool) -> int:
    """C3 score: text length plus keyword and heading terms."""
    low = text.lower()
    about = "about the job" in low
    return (len(text) + SCORE_TITLE * bool(main_title and main_title in low) + SCORE_ABOUT * about
            + SCORE_SALARY * ("salary" in low) + SCORE_JOBTYPE * ("job type" in low) + SCORE_APPLY * ("apply now" in low)
            + SCORE_RELATED * ("related jobs" in low and not about) + SCORE_H1 * has_h1)


def blocks_of(html: str):
    """``(blocks, best)`` of a page: candidate blocks ``(ord, selector_rank,
    has_h1, text_len, score)`` in selector order, each element once, and
    ``(ord, text, html)`` of the first with the highest score from zero up."""
    page = _read(html)
    blocks, best = _choose(page)
    return blocks, (best[0], best[1], page.html(best[2])) if best else (None, None, None)


def _read(html: str, drop: set = NOISE_TAGS) -> _Page:
    page = _Page(drop)
    page.feed(html)
    return page.done()


def _choose(page: _Page):
    """Candidate blocks and ``(ord, text, node)`` of the best."""
    live = [n for n, noise in zip(page.nodes[1:], page.noise[1:]) if not noise]
    heads = [n for n in live if n[0] == "h1"]
    title = page.strings(heads[0]).lower() if heads else ""
    cands = sorted(((r, i) for i, n in enumerate(live) if (r := _rank(n)) is not None))
    nodes = [(r, live[i]) for r, i in cands]
    if not nodes:
        nodes = [(len(SELECTORS), next((n for n in live if n[0] == "body"), page.nodes[0]))]
    blocks, best, best_score = [], None, -1
    for k, (r, n) in enumerate(nodes):
        text = page.strings(n)
        has_h1 = any(n[2] < h[2] and h[3] <= n[3] for h in heads)
        score = block_score(text, title, has_h1)
        blocks.append((k, r, has_h1, len(text), score))
        if score > best_score:
            best, best_score = (k, text, n), score
    return blocks, best


_BLOCKS = "array<struct<ord: int, selector_rank: int, has_h1: boolean, text_len: int, score: int>>"
_NAMES = ("ord", "selector_rank", "has_h1", "text_len", "score")


def _focus_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for pid, url, html in zip(pdf["page_id"], pdf["url"], pdf["html"]):
            blocks, (at, text, block) = blocks_of(html or "")
            rows.append((pid, url, html, [dict(zip(_NAMES, b)) for b in blocks], at, text, block))
        out = pd.DataFrame(rows, columns=["page_id", "url", "html", "blocks", "best", "text", "block_html"])
        yield out.astype({"best": "Int32"})


def focused_pages(pages: DataFrame) -> DataFrame:
    """C2 + C3 in one stage: each page with its candidate ``blocks`` and the
    ``best`` one's number, ``text`` and ``block_html`` (null when every
    candidate scores below zero).  No shuffle, one scan."""
    ship_package(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInPandas(
        _focus_batches, f"page_id long, url string, html string, blocks {_BLOCKS}, best int, text string, block_html string")


def page_blocks(pages: DataFrame) -> DataFrame:
    """Candidate main-content blocks, one row per (page, candidate)."""
    return focused_pages(pages).select("page_id", "url", F.inline("blocks"))


def main_content(pages: DataFrame) -> DataFrame:
    """Best block per page: highest score, first candidate on ties; pages
    whose candidates all score below zero have none."""
    return focused_pages(pages).filter("best is not null").select(
        "page_id", "url", "block_html", "text", F.element_at("blocks", F.col("best") + 1).alias("b")) \
        .select("page_id", "url", "block_html", "text", "b.score", "b.selector_rank")


# ---------------------------------------------------------------- B13
def markdown_of(html: str) -> str:
    """Markdown of a whole page or fragment, scripts and styles left out (before B12)."""
    page = _read(html, {"script", "style"})
    return to_markdown(page.nodes, page.events)


def main_markdown(html: str) -> str:
    """Markdown of a page's main block; of the whole page where there is none or it is empty."""
    page = _read(html)
    best = _choose(page)[1]
    text = to_markdown(page.nodes, page.events[best[2][2]:best[2][3]]) if best else ""
    return text or markdown_of(html)


def _markdown_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "_md": [main_markdown(h or "") for h in pdf["html"]]})


def page_markdown(pages: DataFrame, max_chars: int = 2500) -> DataFrame:
    """C4: main block -> markdown; else whole page; with a status.  One scan, no shuffle."""
    ship_package(pages.sparkSession)
    valid = pages.select("page_id", "url", F.when(T.valid_feed_url(F.col("url")), F.col("html")).alias("html"))
    j = valid.mapInPandas(_markdown_batches, "page_id long, url string, _md string").select(
        "page_id", "url", T.valid_feed_url(F.col("url")).alias("_valid"), T.normalize_markdown(F.col("_md"), max_chars).alias("markdown"))
    status = F.when(~F.col("_valid"), "invalid_url").when(F.col("markdown") == "", "empty").otherwise("ok")
    return j.select("page_id", "url", "markdown", status.alias("status"))


# ---------------------------------------------------------------- C1 / C5
def page_excerpts(pages: DataFrame, max_chars: int = 2500, body_bytes: int | None = None) -> DataFrame:
    """One excerpt per url, from its latest fetch (highest ``page_id``).

    ``body_bytes`` limits the bytes read of a body, as the basic fetch of the
    reference does (262144); by default whole bodies are read.
    """
    html = F.col("html")
    if body_bytes is not None:
        cut = F.make_valid_utf8(F.substring(html.cast("binary"), 1, body_bytes).cast("string"))
        html = F.when(F.octet_length(html) > body_bytes, cut).otherwise(html)
    # the text is cut to its excerpt before anything is shuffled
    texts = pages.select("page_id", F.col("url").alias("_purl"), T.clamp_text(T.html_to_text(html), max_chars).alias("_t"))
    return texts.groupBy("_purl").agg(F.max_by("_t", "page_id").alias("_txt"))


def page_excerpt_basic(items: DataFrame, pages: DataFrame, max_chars: int = 2500, body_bytes: int | None = None) -> DataFrame:
    """Fetched page text for each item url (http/https only) clamped to
    ``max_chars``; failures become a reason and the item continues."""
    p = page_excerpts(pages, max_chars, body_bytes)
    j = items.join(p, items["url"] == p["_purl"], "left")
    scheme_ok = F.lower(F.regexp_extract(T.trim_space(F.col("url")), "^([A-Za-z][A-Za-z0-9+.\\-]*):", 1)).isin(
        "http", "https")
    j = j.select(*items.columns, "_purl", scheme_ok.alias("_sok"), "_txt")
    reason = (F.when(~F.col("_sok"), F.lit("unsupported_scheme"))
              .when(F.col("_purl").isNull(), F.lit("fetch_failed"))
              .when(F.col("_txt") == "", F.lit("empty_text")).otherwise(F.lit("")))
    j = j.select(*items.columns, "_txt", reason.alias("excerpt_reason"))
    return j.select(*items.columns, F.when(F.col("excerpt_reason") == "", F.col("_txt")).otherwise(F.lit(""))
                    .alias("excerpt"), "excerpt_reason")


def page_excerpt(items: DataFrame, pages: DataFrame, mode: str = "basic", min_chars: int = 220,
                 max_chars: int = 2500) -> DataFrame:
    """Off / basic / main / hybrid (unknown mode = basic).

    hybrid: basic when it has >= ``min_chars`` code points, else the main
    content, else non-blank basic, else an error with both reasons.
    """
    mode = (mode or "").strip().lower()
    if mode == "off":
        return items.withColumn("excerpt", F.lit("")).withColumn("excerpt_reason", F.lit(""))
    if mode not in ("basic", "main", "scrapling", "hybrid"):
        mode = "basic"
    basic = page_excerpt_basic(items, pages, max_chars)
    if mode == "basic":
        return basic
    md = page_markdown(pages, max_chars).groupBy(F.col("url").alias("_murl")).agg(
        F.max_by("markdown", "page_id").alias("markdown"), F.max_by("status", "page_id").alias("status"))
    j = basic.join(md, basic["url"] == md["_murl"], "left")
    md_ok = F.coalesce(F.col("markdown"), F.lit("")) != ""
    if mode in ("main", "scrapling"):
        exc = F.when(md_ok, F.col("markdown")).otherwise(F.lit(""))
        reason = F.when(md_ok, F.lit("")).otherwise(F.coalesce(F.col("status"), F.lit("fetch_failed")))
    else:
        long_basic = F.length(T.trim_space(F.col("excerpt"))) >= min_chars
        exc = (F.when(long_basic, F.col("excerpt")).when(md_ok, F.col("markdown"))
               .when(F.col("excerpt") != "", F.col("excerpt")).otherwise(F.lit("")))
        reason = F.when(exc != "", F.lit("")).otherwise(F.concat_ws(
            "; ", F.concat(F.lit("basic: "), F.col("excerpt_reason")),
            F.concat(F.lit("main: "), F.coalesce(F.col("status"), F.lit("fetch_failed")))))
    return j.select(*items.columns, exc.alias("excerpt"), reason.alias("excerpt_reason"))
