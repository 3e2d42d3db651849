"""Main text of web pages by line-block distribution.

The markup is stripped so that each block element gives one line. Elements that can't
belong to an article (menus, page headers and footers, sidebars, notices, adverts,
forms, comments, hidden parts) leave one empty line. The text lengths of ``WINDOW`` following
lines are summed at each line; a *surge point* is a line where that sum rises to the threshold and
which is followed by text, a *dive point* the line from which a whole window is empty. Text
between a surge and its dive is kept. The threshold is relative to the page (so that very short
articles are found) and never above ``SURGE`` characters; text of links counts as empty. Where
marked articles (``article``, ``main``) hold no less text than any run of lines outside them,
only their lines are measured, links too, and any text is a surge.

Defined results: a null or empty page, and a page without main text, give an empty
string; broken markup is read leniently: unclosed elements end with their container,
embedded ones (``_EMBEDDED``) also with the next block, a head with the first tag or text
of a body, and only comments and raw text (script, style, textarea) with the page; repeated rows are extracted each; nothing is cut short, however long the page; columns
of the input other than the page are ignored by :func:`extract`.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysight.llm.common import bound_batches, table, text_or_empty

#: Lines in a window; characters in a window that always count as a surge; share of the
#: page's largest window that a surge needs at least.
WINDOW, SURGE, SHARE = 3, 80, 0.25

#: Comments and elements of raw text, which run to the end of the page where they are not closed, and closed titles.
_RAW = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(script|style|textarea)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<title\b[^>]*>(?:(?!<title|<body|<article|<main|</head).)*?</title\s*>", re.S | re.I)
#: Other elements whose content is never text of the page.
_EMBEDDED = frozenset("noscript template svg math iframe object canvas video audio select".split())
_EMBEDDED_START = re.compile(f"<(?:{'|'.join(sorted(_EMBEDDED))})\\b", re.I)
#: Tags that can stand in a head; any other one starts the body.
_HEAD = frozenset("html head title base basefont bgsound link meta noframes script style".split()) | {"noscript", "template"}
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

_BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre
search section summary table tbody td tfoot th thead title tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BOILERPLATE = frozenset("nav footer aside form menu dialog button search fieldset label".split())
_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert form toolbar".split())
#: Class and id names that stand for boilerplate: a whole name is one of the words, with or without
#: words of place before it and of shape after it (``site-footer``, ``ad-slot``; not ``share-price``).
_WORD = (r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|nav|navbar|navigation|menu|topbar|toolbar|"
         r"breadcrumbs?|pagination|pager|sidebar|widgets?|footer|site-?header|page-?header|masthead|comments?|commentlist|disqus|replies|"
         r"reply|respond|related|recommend\w*|share|sharing|social|newsletter|subscribe|signup|login|popup|modal|overlay|skip-?link|"
         r"copyright|tags|trending|teaser")
_PLACE = "site|page|main|top|bottom|left|right|global|primary|secondary|post|article|entry|blog|user|mobile|sticky"
_SHAPE = ("area|articles|bar|block|box|buttons?|column|container|content|form|icons?|inner|items?|label|left|lines?|links?|lists?|media|message|"
          "outer|panel|policy|posts?|right|row|section|slot|space|stories|thread|top|unit|warning|wrap|wrapper|zone")
_NAMES = re.compile(rf"(?:(?:{_PLACE})[-_])*(?:{_WORD})(?:[-_](?:{_WORD}|{_SHAPE}|\d+))*", re.I)


def _boilerplate(name: str, attributes: str, in_article: bool) -> bool:
    if name in _BOILERPLATE or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body", "article", "main") and "comment" not in attributes.lower():
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if (key == "hidden" or key == "aria-hidden" and value == "true"
                or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)
                or key == "role" and value.lower() in _ROLES
                or key in ("class", "id") and any(map(_NAMES.fullmatch, value.split()))):
            return True
    return False


def _without_embedded(page: str) -> str:
    """The page without closed embedded elements; start tags of unclosed ones are left."""
    if not _EMBEDDED_START.search(page):
        return page
    opened: list[tuple[int, str]] = []
    spans: list[tuple[int, int]] = []
    count = dict.fromkeys(_EMBEDDED, 0)
    for m in _TAG.finditer(page):
        name = (m[2] or "").lower()
        if name not in _EMBEDDED:
            continue
        if m[1] != "/":
            if not m[3].endswith("/"):
                opened.append((m.start(), name))
                count[name] += 1
        elif count[name]:
            while True:
                start, x = opened.pop()
                count[x] -= 1
                if x == name:
                    break
            while spans and spans[-1][0] >= start:
                spans.pop()
            spans.append((start, m.end()))
    kept, at = [], 0
    for start, end in spans:
        kept.append(page[at:start])
        at = end
    return "".join(kept) + page[at:]


def lines_of(page: str) -> list[tuple[str, int, bool]]:
    """(text, length of its text outside links, stands in an article or main element) of
    each block; a run of boilerplate elements gives one empty line."""
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # open elements: name, boilerplate, article
    links, linked, skipping, article, removed = 0, 0, 0, 0, False
    head, loose = False, 0  # head is open; open embedded elements without an end tag ("?" before their names)

    def end_line() -> None:
        nonlocal linked, removed
        if skipping and not parts:
            return  # removed blocks add no lines of their own
        text = " ".join(html.unescape("".join(parts)).split())
        removed = removed and not text
        lines.append((text, max(0, len(text) - linked), article > 0))
        parts.clear()
        linked = 0

    def pop() -> str:
        nonlocal skipping, article, head, loose, removed
        name, hid, art = stack.pop()
        removed = removed or hid
        skipping, article = skipping - hid, article - art
        head, loose = head and name != "head", loose - name.startswith("?")
        return name

    def add(text: str) -> None:
        nonlocal linked
        if head and stack[-1][0] == "head" and text.strip():  # text that stands in no title starts the body
            pop()
        if text and not skipping:
            parts.append(text)
            if links:
                linked += len(text.strip())

    page = _without_embedded(_RAW.sub("", page))
    at = 0
    for m in _TAG.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name, closing = m[2].lower(), m[1] == "/"
        if not closing:
            while loose and name in _BLOCKS:  # unclosed embedded elements end with the next block
                pop()
            while head and not loose and name not in _HEAD:
                pop()
        if name in _BLOCKS and not (removed and not "".join(parts).strip() and not closing
                                    and _boilerplate(name, m[3], article > 0)):  # several removed ones leave one break
            end_line()
        if name == "a":
            links = 0 if closing else 1
        if name in _VOID or m[3].endswith("/") and name not in _BLOCKS:
            continue
        if not closing:
            if name in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == name:
                pop()  # these end where the next one starts
            if name == "head":
                if any(x[0] != "html" for x in stack):
                    continue
                hid, art, head = True, False, True
            elif name in _EMBEDDED:
                name, hid, art, loose = "?" + name, True, False, loose + 1
            else:
                hid, art = _boilerplate(name, m[3], article > 0), name in ("article", "main")
            stack.append((name, hid, art))
            skipping, article = skipping + hid, article + art
        elif any(x[0] == name for x in stack):
            while pop() != name:  # unclosed elements end with their container
                pass
    add(page[at:])
    end_line()
    return lines


def main_text(page: str) -> str:
    """The text between surge and dive points of the page's line-block distribution.

    Where the marked articles hold no less text than any run of lines outside them, they are
    what is measured: their links count like other text, the page's other lines are empty, and
    any text is a surge. Else all lines are measured without the text of their links."""
    lines = lines_of(page)
    marked = sum(free for text, free, article in lines if article)
    outside = runs([("", 0) if article else (text, free) for text, free, article in lines], 1)
    if any(text and article for text, _, article in lines) and marked >= max((sum(n for _, n in run) for run in outside), default=0):
        measured, surge = [(text, len(text)) if article else ("", 0) for text, _, article in lines], 1.0
    else:
        measured = [(text, free) for text, free, _ in lines]
        surge = min(SURGE, max(1.0, SHARE * max(window_sums(_squeeze(measured)), default=0)))
    return " ".join(text for run in runs(measured, surge) for text, _ in run if text)


def window_sums(lines: list[tuple[str, int]]) -> list[int]:
    """At each line the text lengths of the window that starts there."""
    sizes = [n for _, n in lines]
    return [sum(sizes[i:i + WINDOW]) for i in range(len(sizes))]


def runs(lines: list[tuple[str, int]], surge: float) -> list[list[tuple[str, int]]]:
    """The lines from text up to the dive point (a window without any), of each run that has a surge point."""
    lines = _squeeze(lines)
    sums = window_sums(lines)
    out, i = [], 0
    while i < len(lines):
        stop = i
        while stop < len(lines) and sums[stop] > 0:
            stop += 1
        if stop > i and max(sums[i:stop]) >= surge:
            out.append(lines[i:stop])
        i = stop + 1
    return out


def _squeeze(lines: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """Runs of empty lines shrink by one: nested block tags give several for one break."""
    out: list[tuple[str, int]] = []
    empty = 0
    for x in lines:
        empty = 0 if x[0] else empty + 1
        if empty != 1:
            out.append(x)
    return out


def extract(page: Column) -> Column:
    """Main text of an html column."""
    @F.pandas_udf("string")
    def extracted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([main_text(x) for x in s], dtype=object)
    return extracted(F.coalesce(page.cast("string"), F.lit("")))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", text_or_empty("html").alias("html"))
    return (pages.select("page_id", "url", extract(F.col("html")).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
