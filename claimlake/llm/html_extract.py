"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags.  Words score positive, tags negative;
one linear scan finds the contiguous run with the greatest sum, which tells what element the
article is: the outermost ``article`` or ``main`` around the run, or else the smallest element that holds all of the run.
The text is all of that element but what is excluded, so nothing inside it can be trimmed.  The
weights come from pages that label themselves (an ``article`` or ``main`` element marks the content): a tag costs
more the more of its uses lie outside, a word in a link counts less the more
of such words lie outside.  Subtrees that are never content (menus, footers,
forms, scripts, notices, adverts, comments of readers and the like, by element,
role, class or id) give no words and cost a bounded amount to bridge.  A class,
an id or a form does not exclude an element that holds an article or main
element, but for readers' comments; elements whose end tag is left out end where HTML ends them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_PAGES = 2_000       # labelled pages that weights are learned from, at most
BRIDGE = 4.0            # most that a subtree without content costs
BORDER = 40.0           # cost of the borders of an article or main element
SLIGHT = 20             # an article or main element counts unless the best run outside has over SLIGHT times its words

# Elements of HTML by role.
RAW = ("script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "select")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NEVER = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "head", "fieldset"}
BORDERS = {"article", "main"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt",
          "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "td", "th", "time", "tt", "u", "var", "wbr"}
CONTENT = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "b", "i", "em", "strong", "br", "blockquote", "pre", "code", "figure", "figcaption", "q", "cite", "sub", "sup", "span", "hr", "img",
           "dl", "dt", "dd", "table", "tbody", "tr", "td", "th", "section"}
# Words of class and id names. A name is marked when all of its words but the structural ones are marking words.
READERS = {"comment", "comments", "commentlist", "disqus", "replies", "respond"}
MARKS = READERS | {"ad", "ads", "advert", "adverts", "advertisement", "advertisements", "advertising", "sponsor", "sponsors", "sponsored", "promo", "promos", "promotion", "promotions", "banner", "banners",
                   "sidebar", "sidebars", "widget", "widgets", "notice", "notices", "cookie", "cookies", "consent", "gdpr", "alert", "alerts", "newsletter", "newsletters", "subscribe", "subscription",
                   "signup", "popup", "popups", "modal", "modals", "menu", "menus", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "footers", "masthead", "related", "recommended",
                   "recommendations", "share", "sharing", "social", "login", "search", "pagination", "pager", "toolbar", "skiplink"}
STRUCTURE = {"area", "article", "articles", "bar", "block", "body", "bottom", "box", "boxes", "btn", "button", "buttons", "col", "column", "container", "content", "desktop", "entry", "field", "form", "frame", "global",
             "group", "header", "holder", "icon", "icons", "inner", "input", "item", "items", "layer", "left", "link", "links", "list", "main", "media", "message", "mobile", "module", "news", "outer", "page", "panel",
             "post", "posts", "primary", "right", "row", "secondary", "section", "site", "slot", "stories", "story", "strip", "teaser", "teasers", "text", "thread", "title", "tools", "top", "unit", "wrap", "wrapper", "zone"}
MODIFIERS = {"has", "no", "non", "not", "with", "without"}  # has-sidebar tells of a sidebar elsewhere
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar", "alertdialog"}

# Elements whose end tag can be left out: the tags that end them, and what hides such tags when nested.
_CELL = {"td", "th", "tr", "tbody", "thead", "tfoot"}
IMPLIED = {
    "p": ({"address", "article", "aside", "blockquote", "center", "details", "dd", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
           "h6", "header", "hgroup", "hr", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "table", "ul"}, ()),
    "li": ({"li"}, ("ul", "ol", "menu")), "dt": ({"dt", "dd"}, ("dl",)), "dd": ({"dt", "dd"}, ("dl",)),
    "tr": (_CELL - {"td", "th"}, ("table",)), "td": (_CELL, ("table",)), "th": (_CELL, ("table",))}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}


def marked(value: str) -> str:
    """Whether a class or id names something beside the article: "" not, "reader" readers' comments, "mark" anything else."""
    found = ""
    for name in value.lower().replace("side-bar", "sidebar").replace("skip-link", "skiplink").split():
        words = [w.strip("0123456789") for w in _WORDS.split(name)]
        if MODIFIERS.intersection(words):
            continue
        core = [w for w in words if len(w) > 1 and w not in STRUCTURE]
        if core and MARKS.issuperset(core):
            found = "reader" if found == "reader" or READERS.intersection(core) else "mark"
    return found


_WORDS = re.compile(r"[-_:]+")


def named(attrs: str) -> str:
    """``marked`` of an element's class and id."""
    found = [marked(m[2].strip("\"'")) for m in _ATTR.finditer(attrs) if m[2] and m[1].lower() in ("class", "id")] if attrs else []
    return "reader" if "reader" in found else "mark" if "mark" in found else ""


def excluded(name: str, attrs: str, in_border: bool) -> str:
    """Whether an element's subtree is never content: "" not, "mark" or "reader" if a class, an id or a form says so, else "sure"."""
    if name in ("form", "fieldset"):
        found = "mark"
    elif name in NEVER or name == "header" and not in_border:
        return "sure"
    else:
        found = ""
    if not attrs or name in ("body", "html", "main"):
        return found
    found = named(attrs) or found
    for m in _ATTR.finditer(attrs):
        key = m[1].lower()
        if name != "article" and key == "role" and m[2] and m[2].strip("\"'").lower() in ROLES or key == "hidden" or key == "aria-hidden" and m[2] and "true" in m[2]:
            return "sure"
        if key == "style" and m[2] and "display:none" in m[2].replace(" ", "").lower():
            return "sure"
    return found


def holders(html: str) -> set[int]:
    """Where the article and main elements begin that are neither marked (a reader's comment, a teaser) nor among
    readers' comments, and the elements that hold one.  One pass with a stack of the open elements."""
    out: set[int] = set()
    stack: list[tuple[str, int, bool]] = []
    count: dict[str, int] = {}
    readers = 0

    def pop() -> str:
        nonlocal readers
        n, _, reader = stack.pop()
        count[n] -= 1
        readers -= reader
        return n

    pos = 0
    while (m := _TOKEN.search(html, pos)) is not None:
        pos = m.end()
        name = m[2] or m[5]
        if name is None:
            continue
        name, close, attrs = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in _RAW_END and not close:
            if not attrs.endswith("/"):
                end = _RAW_END[name].search(html, pos)
                pos = end.end() if end else len(html)
            continue
        if close:
            if count.get(name):
                while pop() != name:
                    pass
            continue
        while stack and stack[-1][0] in IMPLIED and name in IMPLIED[stack[-1][0]][0]:
            pop()
        mark = named(attrs)
        if name in BORDERS and not readers and (name == "main" or not mark):
            out.add(m.start())
            # those around a holder are holders already
            for _, start, _ in reversed(stack):
                if start in out:
                    break
                out.add(start)
        if name not in VOID:
            reader = mark == "reader" and name not in ("body", "html", "main")
            stack.append((name, m.start(), reader))
            count[name] = count.get(name, 0) + 1
            readers += reader
    return out


def events(html: str) -> Iterator[tuple]:
    """("text", text, in link, inside) and ("tag", name, breaks a block, never content, inside, opens 1 or closes -1) in page order;
    inside: the number of the outermost article or main element around (0: none)."""
    pos, skip, depth, link, inside, region, borders = 0, "", 0, 0, 0, 0, 0
    n = len(html)
    inner: dict[str, int] = {}  # open elements of a skipped one that may have no end tag
    holds: set[int] | None = None
    while pos < n:
        m = _TOKEN.search(html, pos)
        if m is None:
            if not skip:
                yield "text", html[pos:], link > 0, region if inside else 0
            return
        if m.start() > pos and not skip:
            yield "text", html[pos:m.start()], link > 0, region if inside else 0
        pos = m.end()
        name = m[2] or m[5]
        if name is None:
            if m[0].startswith("<![CDATA[") and not skip:
                yield "text", m[0][9:-3].replace("&", "&amp;"), link > 0, region if inside else 0
            continue
        name, close, attrs = name.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in _RAW_END and not close:
            if not attrs.endswith("/"):
                end = _RAW_END[name].search(html, pos)
                pos = end.end() if end else n
            continue
        opens = not close and name not in VOID
        if skip in IMPLIED:
            ends, scopes = IMPLIED[skip]
            nested = any(inner.get(x) for x in scopes)
            outer = close and not inner.get(name)  # the end of an element around, or of the skipped one
            if not nested and name != skip and outer and (name not in INLINE or name in _CELL) or not nested and not close and name in ends:
                skip = ""
            else:
                inner[name] = max(0, inner.get(name, 0) + (1 if opens else -1 if close else 0))
                depth = 0 if name == skip and outer and not nested else 1
        if skip:
            if skip not in IMPLIED and name == skip:
                depth += 1 if opens else -1 if close else 0
            ends_border = False
            if name in BORDERS and name != skip:  # borders within the skipped element; another's end is the end of one around it
                ends_border = close and borders == 0
                borders = max(0, borders + (1 if opens else -1 if close else 0))
            if depth == 0 or ends_border or close and name in ("body", "html"):
                skip = ""
            if ends_border:
                inside = max(0, inside - 1)
            yield "tag", name, True, True, region if inside else 0, 0
            continue
        never = excluded(name, attrs, inside > 0) if opens else ""
        if never in ("mark", "reader"):
            if holds is None:
                holds = holders(html)
            # without any other article, a marked one may be the article
            never = "" if m.start() in holds and never == "mark" or name in BORDERS and not holds else never
        if never:
            skip, depth, inner, borders = name, 1, {}, 0
            yield "tag", name, True, True, region if inside else 0, 0
            continue
        if name in BORDERS:
            if not close and not inside:
                region += 1
            inside = max(0, inside + (-1 if close else 1))
        if name == "a":
            link = 0 if close else 1
        elif name not in INLINE:
            link = 0
        yield "tag", name, name not in INLINE, False, region if inside or name in BORDERS else 0, 1 if opens else -1 if close else 0
        if not close and name in ("br", "td", "th", "img", "wbr") or close and name in ("td", "th"):
            yield "text", " ", link > 0, region if inside else 0


def counts(html: str) -> dict[str, list[int]]:
    """Of one labelled page: how often each kind of token lies outside and inside the marked content."""
    out: dict[str, list[int]] = {}
    for e in events(html):
        if e[0] == "text":
            k, n, inside = "word in link" if e[2] else "word", len(e[1].split()), e[3] > 0
        else:
            k, n, inside = "<" + e[1], 1, e[4] > 0 and not e[3]
        if n:
            out.setdefault(k, [0, 0])[inside] += n
    return out


def weights(found: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Scores by kind of token from (outside, inside) counts; without counts, the prior alone."""
    out = {}
    kinds = {"word", "word in link", *("<" + t for t in CONTENT), *found}
    for k in kinds:
        outside, inside = found.get(k, (0, 0))
        prior = 0.02 if k == "word" or k[1:] in CONTENT else 0.6
        share = (outside + 20 * prior) / (outside + inside + 20)
        out[k] = max(0.05, 1 - share) if k.startswith("word") else -(0.02 + 3 * share * share)
    return out | {"<" + b: -BORDER for b in BORDERS}


_UNSEEN = -(0.02 + 3 * 0.6 * 0.6)


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and last place of the contiguous run with the greatest sum (0, -1 if none is above 0)."""
    best, total, start, first, last = 0.0, 0.0, 0, 0, -1
    for at, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, at
        total += s
        if total > best:
            best, first, last = total, start, at
    return first, last


def extract(html: str | None, weight: dict[str, float]) -> str:
    """The blocks of the article, joined by an empty line; empty for a null, empty or wordless page."""
    if not html:
        return ""
    scores, texts, regions, words = [], [], [], []  # one entry per token; texts: a piece of text, None for a block's end, "" for an inline tag
    depth, names, stack = [], [], []  # open elements after each token, its tag
    bridged = 0.0
    for e in events(html):
        if e[0] == "text":
            t = unescape(e[1])
            n = len(t.split())
            scores.append(n * weight["word in link" if e[2] else "word"])
            texts.append(t)
            words.append(n)
            regions.append(e[3])
            names.append("")
            bridged = 0.0 if t.strip() else bridged
        else:
            _, name, breaks, never, region, opens = e
            s = weight.get("<" + name, _UNSEEN)
            if never:
                s = max(s, bridged - BRIDGE, -BRIDGE) if bridged < BRIDGE else 0.0
                bridged -= s
            else:
                bridged = 0.0
            scores.append(s)
            texts.append(None if breaks else "")
            words.append(0)
            regions.append(region)
            names.append(name)
            if opens > 0:
                while stack and stack[-1] in IMPLIED and name in IMPLIED[stack[-1]][0]:
                    stack.pop()
                stack.append(name)
            elif opens < 0 and name in stack:
                while stack.pop() != name:
                    pass
        depth.append(len(stack))
    first, last = best_run(scores)
    inside, size = best_run([s if r else -BORDER for s, r in zip(scores, regions)]), 0
    if inside[1] >= 0:
        region = next(r for r, n in zip(regions[inside[0]:], words[inside[0]:]) if n)
        size = sum(n for n, r in zip(words, regions) if r == region)
    if size and SLIGHT * size >= sum(n for n, r in zip(words[first:last + 1], regions[first:last + 1]) if not r):
        texts = [t for t, r in zip(texts, regions) if r == region]
    elif last >= 0:
        first, last = _holder(html, names, depth, words, first, last)
        texts = texts[first:last + 1]
    else:
        texts = []
    blocks, block = [], []
    for t in texts:
        if t is None:
            blocks.append("".join(block))
            block = []
        else:
            block.append(t)
    blocks.append("".join(block))
    return "\n\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


_PAGE = re.compile(r"<(?:html|body)[\s>]", re.I)


def _holder(html: str, names: list[str], depth: list[int], words: list[int], first: int, last: int) -> tuple[int, int]:
    """The smallest element around the words of a run that is more than a block of text, as its first and last
    token; where that is the page itself, the parts of the page that the run's ends lie in."""
    while not words[first]:
        first += 1
    while not words[last]:
        last -= 1
    page = len(set(x.lower() for x in _PAGE.findall(html)))
    level = max(min(depth[first:last + 1]), page + 1)
    while True:
        while first > 0 and depth[first] >= level and depth[first - 1] >= level:
            first -= 1
        while last + 1 < len(depth) and depth[last] >= level and depth[last + 1] >= level:
            last += 1
        if level - 1 <= page or names[first] not in _TEXTUAL:
            return first, last
        level -= 1


_TEXTUAL = (CONTENT | INLINE | {"li", "ul", "ol", "center"}) - {"section"}


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, list[int]] = {}
    for b in batches:
        for h in b.column("html").to_pylist():
            for k, (o, i) in counts(h).items():
                t = total.setdefault(k[:40], [0, 0])
                t[0], t[1] = t[0] + o, t[1] + i
    yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([v[0] for v in total.values()], pa.int64()), pa.array([v[1] for v in total.values()], pa.int64())],
                                     ["kind", "outside", "inside"])


def learn(pages: DataFrame, rows: int = MAX_PAGES) -> dict[str, float]:
    """Weights from at most ``rows`` pages that mark their content: those with the smallest digests of their id
    (pages without one are not used, of several pages under one id the least).
    The driver gets one row per kind of token that at least three uses have."""
    own = pages.filter(F.col("page_id").isNotNull() & F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    # ids first: only the html of chosen pages moves, and that to as many tasks as there are
    ids = own.select("page_id").distinct().orderBy(F.md5(F.col("page_id").cast("string")), "page_id").limit(rows)
    chosen = own.select("page_id", "html").join(F.broadcast(ids), "page_id", "left_semi").groupBy("page_id").agg(F.min("html").alias("html")).select("html")
    got = (chosen.mapInArrow(_counted, "kind string, outside bigint, inside bigint").groupBy("kind")
           .agg(F.sum("outside").alias("o"), F.sum("inside").alias("i")).filter(F.col("o") + F.col("i") >= 3).collect())
    return weights({r["kind"]: (r["o"], r["i"]) for r in got})


def main_text(pages: DataFrame, weight: dict[str, float], html: str = "html") -> DataFrame:
    """All rows and columns but the page's source, with ``text`` and ``n_chars`` (columns of those names are replaced).

    Null, empty and wordless pages give an empty text; repeated rows give equal ones.
    """
    keep = [f for f in pages.schema if f.name not in (html, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(h, weight) for h in b.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in keep), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                             [*(f.name for f in keep), "text", "n_chars"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), "text string, n_chars bigint"])
    return pages.select(*(f.name for f in keep), html).mapInArrow(run, schema)
