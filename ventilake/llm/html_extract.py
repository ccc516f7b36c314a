"""Main text of web pages by differencing pages of nearest URL.

Pages are sorted by host and URL path, and each is paired with the neighbour of
its host whose path shares the longer beginning.  Pages of the same URL or with the
same text are no such neighbours; the nearest pages beyond them are.  Both are read as lines, one
for each block of text, and aligned by longest common subsequence; a line that
both share is template and is deleted.  Two readings of the markup correct this
where it cannot be right:

- blocks in containers that are no article by tag, role, class or id (menus,
  page headers, footers, sidebars, notices, adverts, forms, comments) are deleted
  though no neighbour repeats them, as adverts and menus differ from page to page.
  Classes and ids count as whole words; an article or main element inside such a
  container is read all the same (among comments, adverts and the like only where
  the page has nothing else);
- blocks inside the page's article element stay though a neighbour has the same,
  as articles quote and copy each other.

So differencing decides about everything that markup leaves open.

Pages are spread by ranges of (host, path), so a host of any size is split; at
the edge of a range a page has a neighbour on one side only.  Each partition is
read as a stream that holds three pages, and those that repeat one of them.

Defined cases: null and empty html have no text; a null or relative URL belongs
to the empty host; a page alone on its host is not differenced; of equally near
neighbours the earlier is taken; unclosed and crossed tags are read as far as
they go; repeated rows, recrawls of a URL and neighbours with equal texts are not
differenced against each other; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from html import unescape
from os.path import commonprefix

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: where a block stands
OPEN, ARTICLE, MAIN, ASIDE, APART, INNER = 0, 1, 2, 3, 4, 5
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe|object|select|annotation-xml|annotation)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)",
    re.S | re.I,
)
#: attributes one after the other, so that no name is looked for inside a value or another name
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_READ = frozenset("class id role itemprop hidden aria-hidden".split())
_SPACE = re.compile(r"\s+")
#: elements that start a block of their own (fixed by the HTML standard)
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot"
    " th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE_TAGS = frozenset("nav footer aside form button dialog menu head select option".split())
#: asides whose articles are others than the page's own
APART_TAGS = frozenset("nav footer aside dialog menu".split())
APART_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments disqus respond reply replies"
    " related recommended recommendations widget widgets".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu menus"
    " breadcrumb breadcrumbs sidebar widget widgets footer masthead cookie cookies consent gdpr notice notices popup modal overlay"
    " newsletter subscribe subscription signup social share sharing related recommended recommendations comment comments disqus"
    " respond reply replies pagination pager toolbar copyright login search".split()
)


def _place(tag: str, attributes: str, inside: int) -> int:
    """Where the content of an element stands, its parent standing ``inside``.

    Reading starts anew at an article or main element, whatever holds it; what is
    so found among comments, related pages, adverts and the like is ``INNER``."""
    given = {}
    if attributes:
        for m in _ATTRIBUTE.finditer(attributes):
            if m[1].lower() in _READ:
                given.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    role = given.get("role", "").strip().lower()
    words = set(given.get("class", "").lower().split()) | {given.get("id", "").strip().lower()}
    unseen = "hidden" in given or given.get("aria-hidden") == "true"
    article = tag == "article" or role == "article" or given.get("itemprop", "").lower() == "articlebody"
    if article or tag == "main" or role == "main":
        if inside in (APART, INNER) or unseen or words & {"comment", "reply"}:
            return INNER
        return ARTICLE if article or inside == ARTICLE else MAIN
    if inside == APART:
        return APART
    if unseen or tag in APART_TAGS or words & APART_WORDS:
        return APART if tag not in ("html", "body") else inside
    if inside == ASIDE:
        return ASIDE
    if tag in ASIDE_TAGS or role in ASIDE_ROLES or words & ASIDE_WORDS:
        return ASIDE if tag not in ("html", "body") else inside
    if tag == "header" or "header" in words:
        return inside if inside in (ARTICLE, MAIN) else ASIDE
    return inside


def blocks(html: str | None) -> list[tuple[str, int]]:
    """The page's blocks of text in order, and where each stands."""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []
    place, at = OPEN, 0
    html = html or ""

    def close_block() -> None:
        if held:
            text = _SPACE.sub(" ", unescape("".join(held))).strip()
            held.clear()
            if text:
                out.append((text, place))

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            held.append(html[at : m.start()])
        at = m.end()
        closing, tag = m[2], (m[3] or "").lower()
        if not tag:
            if m[0][:9].upper() == "<![CDATA[":
                held.append(m[0][9:-3].replace("&", "&amp;"))
            continue
        if tag in BLOCKS:
            close_block()
        elif tag == "br":
            held.append(" ")
        if tag in VOID:
            continue
        if not closing:
            if tag in BLOCKS and any(t == "p" for t, _ in stack[-8:]) and tag not in ("li", "td", "th"):
                # a block ends the open paragraph, unless another container was opened in it
                k = max(i for i, (t, _) in enumerate(stack) if t == "p")
                if not any(t in BLOCKS for t, _ in stack[k + 1 :]):
                    del stack[k:]
            elif tag in ("li", "dd", "dt", "td", "th", "tr", "option") and stack and stack[-1][0] == tag:
                stack.pop()
            place = stack[-1][1] if stack else OPEN
            place = _place(tag, m[4], place)
            if not m[4].rstrip().endswith("/"):
                stack.append((tag, place))
        else:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
            place = stack[-1][1] if stack else OPEN
    held.append(html[at:])
    close_block()
    return out


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``.

    Equal ends are taken off first; the middle is solved as a longest rising
    subsequence of match positions, so only pairs of equal lines are looked at."""
    n, m, head = len(a), len(b), 0
    while head < n and head < m and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < n - head and tail < m - head and a[n - 1 - tail] == b[m - 1 - tail]:
        tail += 1
    out = {*range(head), *range(n - tail, n)}
    where: dict[str, list[int]] = {}
    for j in range(m - tail - 1, head - 1, -1):
        where.setdefault(b[j], []).append(j)
    ends: list[int] = []
    links: list[tuple[int, object]] = []
    for i in range(head, n - tail):
        for j in where.get(a[i], ()):
            k = bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    link = links[-1] if links else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def main_text(lines: list[tuple[str, int]], near: list[tuple[str, int]] | None) -> str:
    """What is left of a page once the lines shared with its neighbour and those outside the article are deleted."""
    shared = common_lines([t for t, _ in lines], [t for t, _ in near]) if near else set()
    best = next((p for p in (ARTICLE, MAIN, OPEN) if any(q == p for _, q in lines)), INNER)
    kept = [t for i, (t, p) in enumerate(lines) if p == best and (p == ARTICLE or i not in shared)]
    return "\n".join(kept)


def _stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pages in order of host and path; each waits for the next page that can tell its template from its text.

    Such a page has another URL and another text: neighbours of the same URL or the
    same text wait together (``alike``), and the pages before and after them are
    their neighbours."""
    before = None  # (host, path, lines)
    alike: list[tuple] = []  # (host, path, lines, page_id, url)

    def finished(following: tuple | None) -> list[tuple]:
        out = []
        for host, path, lines, page_id, url in alike:
            near = [p for p in (before, following) if p and p[0] == host]
            near = max(near, key=lambda p: len(commonprefix([p[1], path])), default=None)
            text = main_text(lines, near[2] if near else None)
            out.append((page_id, url, text, len(text)))
        return out

    def frame_of(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["page_id", "url", "text", "n_chars"]).astype({"page_id": "Int64"})

    for frame in frames:
        rows = []
        for host, path, page_id, url, html in zip(frame["host"], frame["path"], frame["page_id"], frame["url"], frame["html"], strict=True):
            lines, last = blocks(html), alike[-1] if alike else None
            if last and host == last[0] and [t for t, _ in lines] == [t for t, _ in last[2]]:
                lines = last[2] if lines == last[2] else lines  # equal pages share their lines
            elif last and not (host == last[0] and url is not None and url == last[4]):
                rows += finished((host, path, lines))
                before = last[:3]
                alike.clear()
            alike.append((host, path, lines, None if pd.isna(page_id) else int(page_id), url))
        yield frame_of(rows)
    yield frame_of(finished(None))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    parts = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^?#]*)"
    rows = pages.select(
        F.lower(F.regexp_extract(url, parts, 1)).alias("host"),
        F.regexp_extract(url, parts, 2).alias("path"),
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    order = ["host", "path", "url", "page_id"]
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return spread.mapInPandas(_stream, "page_id long, url string, text string, n_chars long")
