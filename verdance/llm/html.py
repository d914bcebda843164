"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block of the page. Each line has a
weight: the characters of its text outside links. Weights are summed over sliding
windows of lines. Where the sum rises to the surge the main text begins, and where it
falls to nothing it ends; what lies between is kept. Lines of its container go with it:
headings before, closing lines after, paragraphs that are links.

Markup changes weights and no more. Lines in menus, headers, footers, sidebars, notices,
adverts, forms and reader comments weigh nothing and are never kept. A line of an article
element weighs more by a window's share of the surge, so that its short lines stay; the
lines around it weigh a part, if the article holds most of the page's text. Windows don't
reach across an article's edges.
A class or id can also name what an element goes with ("no-sidebar"), so words there do not
mark one that holds the page's text.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdance.llm.common import map_batches

#: Lines to a window, and the sum of weights that a main text begins with.
WINDOW, SURGE = 3, 80
#: What is left of the weight of lines around an article that holds most of the text.
ASIDE = 0.25

RAW = ("script", "style", "noscript", "template", "iframe", "svg", "textarea", "object", "canvas", "math", "title", "noframes", "xmp")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    rf"|<({'|'.join(RAW)})\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"""|<(/?)([a-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-z][^\s/>]*)([^>]*+)>""",
    re.IGNORECASE | re.DOTALL,
)
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul button label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(("article", "main"))
APART = frozenset("nav footer aside form menu dialog select button search head fieldset".split())
CONTAINERS = frozenset("html body div section article main center td th dd details".split())
LISTS = frozenset(("nav", "ul", "li", "menu"))
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Parts of class and id names that mark boilerplate; a whole part must match.
NAMES = frozenset("ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs cookie cookies consent gdpr notice notices notification alert popup modal overlay sidebar sidenav aside menu nav navbar navigation topbar header masthead footer comment comments respond reply replies disqus discussion share sharing social related recommended recommendations promo promotion sponsor sponsored newsletter subscribe subscription signup login widget pagination pager toolbar skip".split())
#: Those of reader comments, which can be longer than the text.
COMMENTS = frozenset("comment comments respond reply replies disqus discussion".split())
#: Words before or after a name that make a compound tell of the page instead: no-sidebar, comments-open.
SETTING = frozenset("no non not has have with without hide hidden show is open closed on off free enabled disabled fixed".split())
MAIN_NAMES = frozenset("article content main post entry story".split())
ATTRIBUTE = re.compile(r"""([a-z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+").findall


def names_in(words: str) -> set[str]:
    """The parts of class and id words, but for compounds that tell of a setting."""
    out: set[str] = set()
    for word in words.split():
        parts = [p.lower() for p in PARTS(word)]
        out.update(p for p in parts if len(parts) == 1 or p not in NAMES or not SETTING & set(parts))
    return out


SPACE = re.compile(r"\s+")


TAG_BEGINS = re.compile(r"<[a-z/!?]", re.IGNORECASE)


def unclosed(m: re.Match) -> bool:
    """Whether a comment or an element of raw text runs on to the end of the page."""
    if m[1]:
        return re.search(rf"</{m[1]}\s*>\Z", m[0], re.IGNORECASE) is None
    return m[0].startswith("<!--") and not m[0].endswith("-->") or m[0].startswith("<![CDATA[") and not m[0].endswith("]]>")


class Lines:
    """The page's lines: text, weight, whether boilerplate by markup, whether in an article, innermost mark by name (0: none)."""

    def __init__(self, html: str):
        self.lines: list[tuple[str, int, bool, bool, int]] = []
        #: Elements that a class or id marks: (mark around it, whether it may be a wrapper, whether in an article).
        self.marks: list[tuple[int, bool, bool]] = [(0, False, False)]
        self.mark = 0
        #: Containers: (the one around it, whether a class or id names it as the main one); and of each line its container and whether it is a paragraph.
        self.boxes: list[tuple[int, bool]] = [(0, False)]
        self.box = 0
        self.places: list[tuple[int, bool]] = []
        self.block = ""
        self.text: list[str] = []
        self.linked = 0
        self.in_link = 0
        #: Open elements that matter: (name, boilerplate, article, mark around it, container around it); and how many of each name.
        self.open: list[tuple[str, bool, bool, int, int]] = []
        self.count: Counter = Counter()
        self.apart = self.main = 0
        # beyond the last ">" no tag ends: what looks like one there is looked at once
        at, last, cut = 0, None, html.rfind(">") + 1
        for last in TOKEN.finditer(html, 0, cut):
            if last.start() > at:
                self.add(html[at : last.start()])
            at = last.end()
            name = last[3] or last[6]
            if name:
                (self.close if last[2] or last[5] else self.start)(name.lower(), last[4] or last[7] or "")
        if not (last and at == cut and unclosed(last)):
            rest = html[at:]
            broken = TAG_BEGINS.search(rest)
            self.add(rest[: broken.start()] if broken else rest)
        self.end()

    def add(self, text: str) -> None:
        text = unescape(text) if "&" in text else text
        self.text.append(text)
        if self.in_link:
            self.linked += len(text.strip())

    def end(self) -> None:
        """End the line."""
        if self.text:
            line = SPACE.sub(" ", "".join(self.text)).strip()
            if line:
                self.lines.append((line, max(0, len(line) - self.linked), self.apart > 0, self.main > 0, self.mark))
                self.places.append((self.box, self.block == "p"))
            self.text, self.linked = [], 0

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self.end()
            self.block = name
        elif name == "br":
            self.text.append(" ")
        if name == "a":
            self.in_link = 1
        if name not in BLOCKS or name in VOID or name == "p" and not attributes:
            return
        apart, main, mark = name in APART or name == "header" and not self.main, name in MAIN, None
        main_name = False
        if "=" in attributes or "hidden" in attributes:
            own = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
            parts = names_in(own.get("class", "") + " " + own.get("id", ""))
            apart |= own.get("role", "").lower() in ROLES
            main_name = bool(parts & MAIN_NAMES) and not parts & NAMES
            apart |= re.search(r"display\s*:\s*none", own.get("style", ""), re.IGNORECASE) is not None or re.search(r"(^|\s)hidden(\s|=|$)", attributes) is not None
            main |= own.get("role", "").lower() == "main" or own.get("itemprop", "") == "articleBody"
            if parts & NAMES and name in LISTS:
                apart = True
            elif parts & NAMES and name not in ("html", "body", "main") and not (name == "article" and parts - NAMES):
                mark = not parts <= NAMES and not parts & COMMENTS
        if name in MAIN and not apart and mark is None and self.apart and not self.count["article"] and not self.count["main"] and all(n in LISTS for n, a, *_ in self.open if a):
            while self.open:  # a menu that was never closed
                self.pop()
        self.open.append((name, apart, main, self.mark, self.box))
        if name in CONTAINERS:
            self.boxes.append((self.box, (main_name or main and not apart) and name not in ("html", "body")))
            self.box = len(self.boxes) - 1
        if mark is not None:
            self.marks.append((self.mark, mark, self.main > 0))
            self.mark = len(self.marks) - 1
        self.count[name] += 1
        self.apart += apart
        self.main += main

    def pop(self) -> str:
        name, apart, main, self.mark, self.box = self.open.pop()
        self.count[name] -= 1
        self.apart -= apart
        self.main -= main
        return name

    def close(self, name: str, _: str) -> None:
        if name in BLOCKS:
            self.end()
            self.block = ""
        if name == "a":
            self.in_link = 0
        if self.count[name]:
            while self.pop() != name:
                pass


def boilerplate(page: Lines) -> list[bool]:
    """Whether each line is boilerplate, by markup or by a class or id that names its part.

    Names do not count on a wrapper: an element, not named as boilerplate outright, with
    most of the page's text (in an article, or on a page without an article that no name
    marks), or around the least marked article if all are marked.
    """
    n = len(page.marks)
    held, free, total, comment = [0] * n, 0, 0, [False] * n
    for k in range(1, n):
        around, wrapper, _ = page.marks[k]
        comment[k] = comment[around] or not wrapper
    for _, w, b, _, k in page.lines:
        if not b:
            held[k] += w
            total += 0 if comment[k] else w
            free += 0 if k else w
    for k in range(n - 1, 0, -1):
        held[page.marks[k][0]] += held[k]
    clear = any(w and m and not b and not k for _, w, b, m, k in page.lines)
    wrapper = [False] * n
    for k in range(1, n):
        wrapper[k] = page.marks[k][1] and 2 * held[k] > total and (page.marks[k][2] or not clear)
    depth = [0] * n
    for k in range(1, n):
        depth[k] = depth[page.marks[k][0]] + (not wrapper[k])
    marked = {k for _, w, b, m, k in page.lines if w and m and not b}
    if marked and all(depth[k] for k in marked):
        k = min(marked, key=lambda k: (depth[k], -held[k]))
        if held[k] >= free:
            while k:
                wrapper[k] |= page.marks[k][1]
                k = page.marks[k][0]
            for k in range(1, n):
                depth[k] = depth[page.marks[k][0]] + (not wrapper[k])
    return [b or depth[k] > 0 for *_, b, _, k in page.lines]


def around(page: Lines, kept: list[bool], weight: list[int]) -> list[bool]:
    """Whether each line lies in a container of kept lines, or in the innermost one named as the main one with most of them."""
    n = len(page.boxes)
    held = [0] * n
    for (k, _), on, w in zip(page.places, kept, weight):
        held[k] += w if on else 0
    near = [x > 0 for x in held]
    total = sum(held)
    for k in range(n - 1, 0, -1):
        held[page.boxes[k][0]] += held[k]
    main = max((k for k in range(n) if page.boxes[k][1] and total and 2 * held[k] >= total), default=0)
    within = [False] * n
    for k in range(1, n):
        within[k] = main > 0 and (k == main or within[page.boxes[k][0]])
    return [near[k] or within[k] for k, _ in page.places]


def main_lines(html: str | None, window: int = WINDOW, surge: int = SURGE) -> list[str]:
    """The lines of the page's main text."""
    page = Lines(html or "")
    lines, apart = page.lines, boilerplate(page)
    own = [0 if b else w for (_, w, *_), b in zip(lines, apart)]
    main = [m and not b for (*_, m, _), b in zip(lines, apart)]
    held = sum(w for w, m in zip(own, main) if m)
    part = ASIDE if held and 2 * held >= sum(own) else 1.0
    more = -(-surge // window)
    weight = [w + more if m and (w or p) else w if m else w * part for w, m, (_, p) in zip(own, main, page.places)]
    kept = [False] * len(lines)
    edges = [0, *(i for i in range(1, len(lines)) if lines[i][3] != lines[i - 1][3]), len(lines)]
    for a, z in zip(edges, edges[1:]):
        stretch(weight, kept, a, z, window, surge)
    near = around(page, kept, own)
    only = any(k and m for k, m in zip(kept, main))
    kept = [k or n and not b and (w > 0 or p) and (m or not only) for k, n, b, w, m, (_, p) in zip(kept, near, apart, own, main, page.places)]
    text = [x[0] for x, k in zip(lines, kept) if k]
    # short pages; then those where names mark all that is left
    return text or [x[0] for x, m in zip(lines, main) if m] or [x[0] for x, w in zip(lines, own) if w] or [line for line, w, b, *_ in lines if w and not b]


def stretch(weight: list[float], kept: list[bool], a: int, z: int, window: int, surge: int) -> None:
    """Mark as kept the lines from a to z between the points of surge and dive."""
    sums, total = [0.0] * (z - a), 0.0
    # the window that begins at each line
    for i in range(z - 1, a - 1, -1):
        total += weight[i] - (weight[i + window] if i + window < z else 0)
        sums[i - a] = total
    on = False
    for i in range(a, z):
        if not on and sums[i - a] >= surge and weight[i]:
            on = True
        elif on and sums[i - a] <= 0:
            on = False
        kept[i] = on and weight[i] > 0


def extract(pages: DataFrame, window: int = WINDOW, surge: int = SURGE) -> DataFrame:
    """page_id, url, text, n_chars of every row.

    A null or empty html, or one without main text, gives the empty text. Pages of any
    length are one pass; broken and unclosed markup is taken as it comes; repeated rows
    give repeated rows. No shuffle.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text = ["\n".join(main_lines(h, window, surge)) for h in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return map_batches(rows, run, "page_id long, url string, text string, n_chars long")
