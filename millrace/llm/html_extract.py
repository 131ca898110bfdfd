"""Main text of web pages by equivalence-class template deduction.

Pages of a host are dealt in chunks of about CHUNK pages. A page is a sequence of tokens: block-level tags and words, told
apart by the path of elements they stand in. Within a chunk every token has an occurrence vector: how often each
distinct page has it. Tokens with the same vector form an equivalence class. A class is valid if it has at least
CLASS_SIZE tokens, words among them, occurs in nearly all pages (SUPPORT) and comes in each as repetitions of one order.
Valid classes nest: each repetition of one lies in one gap between the tokens of another, the same gap on all pages, or
apart from it; classes that cross a larger one are none of the template's. The places between the tokens of the nested
classes are the slots. A block is kept if it holds some of a slot's text; one of template tokens alone is furniture of
the site. Slots that hold mostly links on all pages are menus.

How many pages a template needs follows from chance: a passage that a share PASSAGE of all documents has (licences, quotes)
is on all of n pages with probability PASSAGE ** n, and a template must be less likely than CHANCE; that takes 8 pages.

The elements' own meaning (nav, footer, forms, scripts, ...) and names of classes and ids mark furniture, too, so that a
host with a single page is served. On a page with an article or main element only what these hold is kept, and the rules
differ by place:

* Outside main elements a name (but no id of a heading) counts if all parts of one whole word of it say so ("sidebar", "site-header"); one that only
  begins or ends so ("related-work", "ad-hoc") needs evidence besides: most of the element's words are links, or it is
  short. A name covers no article or main if the page has none outside such elements; names that begin with a word like
  no, has or with say nothing. Template tokens and menus by slots count here alone; a heading of template tokens that
  a kept block of the same element follows at once is kept with it.
* Inside a main element the template doesn't count, and names hardly decide. Ids, and any names of headings, quotes, code and
  table rows, say nothing, as software makes them of what the text is about. A class (or role) needs evidence: most of
  the words are links; or, if it says advert, header of the site, sharing or the like, the element is short or other pages of
  the chunk have its blocks. Two need none: a class that is a word for adverts by itself ("ad", "advertisement", ...), and
  one of a list or division that says comments. An id that says comments needs comments, articles or a form below it, or
  a short division.

A block is the text between two block-level tags; <br> is white space in it, formulas (math) and elements of unknown
kind with a hyphen are part of it. Character references are decoded, white space becomes one space, blocks are trimmed,
empty ones go, the rest is joined by two line feeds in page order.

Defined results: null or empty html gives an empty text; so does a page of furniture; repeated pages count once for the
vectors and each gets its text; null or odd URLs share a host named by nothing; an empty table gives an empty result;
unclosed and stray tags are tolerated; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import whole_runs
from .shared import BROADCAST_IDS, cut, light, ship

#: Pages of one host that are looked at together, in expectation.
CHUNK = 64
#: A passage's share of the documents, and the probability below which a template must be chance.
PASSAGE, CHANCE = 1 / 3, 2e-4
#: Distinct pages that a template needs.
LEAST_PAGES = math.ceil(math.log(CHANCE) / math.log(PASSAGE))
#: The share of the pages that has a token of the template, and the tokens that a class needs.
SUPPORT, CLASS_SIZE = 0.95, 3
#: Share of words in links from which an element or slot is a menu; words of an element that is short.
LINKED, SHORT = 0.5, 25

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_PARTS = re.compile(r"[a-z]+")

# Names of HTML elements by kind.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br"}
FURNITURE = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "fieldset"}
#: What these hold isn't text of the page, but they don't end a block.
EMBEDDED = {"svg", "canvas", "object", "audio", "video", "button", "select", "datalist", "annotation", "annotation-xml"}
MAIN = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Parts of class names, ids and roles that mark furniture.
FURNITURE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "alert",
    "comment", "comments", "disqus", "reply", "replies", "respond", "sidebar", "aside", "rail", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "share", "sharing",
    "social", "related", "recommended", "newsletter", "subscribe", "subscription", "signup", "login", "popup", "modal", "overlay", "widget", "toolbar", "pagination", "pager", "skip", "search", "contentinfo", "complementary", "dialog",
}
# Parts of such names that say where or how, not what.
QUALIFIERS = {
    "site", "page", "main", "global", "primary", "secondary", "left", "right", "top", "bottom", "header", "list", "item", "items", "area", "box", "bar", "container", "wrapper", "wrap", "inner", "outer", "block", "section",
    "post", "posts", "article", "articles", "stories", "user", "reader", "links", "link", "button", "buttons", "icons", "slot", "unit", "form", "google", "media", "mobile", "desktop", "to",
}
# Words that are a class of adverts by themselves, and parts that say so, or comments, or a header, inside an article.
ADVERTS = {"ad", "ads", "advert", "adverts", "advertisement", "adsbygoogle", "sponsored"}
ADVERT_PARTS = {*ADVERTS, "sponsor", "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "newsletter", "subscribe", "subscription", "signup", "share", "sharing", "social", "sidebar", "breadcrumb", "breadcrumbs", "pagination", "pager", "masthead", "topbar", "footer", "nav", "navbar"}
COMMENTS = {"comment", "comments", "disqus", "replies", "respond"}
#: Elements that may hold comments.
HOLDERS = {"div", "section", "ol", "ul"}
SITE = {"site", "page", "global", "main", "top"}
#: Parts of a header's name that make it the article's own.
ARTICLE = {"article", "entry", "post", "story", "content", "section", "card"}
#: Elements of a text whose names say nothing inside an article.
TEXTUAL = {"h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "q", "pre", "code", "td", "th", "tr", "dt", "dd", "figure", "figcaption", "em", "strong", "b", "i", "mark", "cite", "body", "html"}
# First parts of names that tell a page's layout.
LAYOUT = {"no", "not", "non", "has", "with", "without"}
_CLOSED_BY_BLOCK = {"p", *HEADINGS}


def _words(value: str) -> list[list[str]]:
    """The parts of each word of a class, id or role, without words that tell a layout."""
    return [p for word in value.split() if (p := _PARTS.findall(word)) and p[0] not in LAYOUT]


def _header(p: list[str]) -> bool:
    """Whether a name says that it is a header of the site."""
    return "header" in p and ARTICLE.isdisjoint(p) and all(x in QUALIFIERS or x in FURNITURE_NAMES for x in p)


def _named(value: str) -> int:
    """Whether a class, id or role marks furniture outside main elements: 2 if a whole word of it does, 1 if a part does."""
    found = 0
    for p in _words(value):
        if not FURNITURE_NAMES.isdisjoint(p):
            found = max(found, 2 if all(x in FURNITURE_NAMES or x in QUALIFIERS for x in p) else 1)
        elif _header(p):
            found = 2
    return found


def _named_inside(value: str) -> str:
    """What a class or role inside a main element says: ad (needs no evidence), advert, header, comments, some, or nothing."""
    found = ""
    for p in _words(value):
        if len(p) == 1 and p[0] in ADVERTS:
            return "ad"
        whole = all(x in FURNITURE_NAMES or x in QUALIFIERS for x in p)
        if whole and not COMMENTS.isdisjoint(p):
            found = "comments"
        elif whole and not ADVERT_PARTS.isdisjoint(p):
            found = found or "advert"
        elif _header(p) and (len(p) == 1 or not SITE.isdisjoint(p)):
            found = found or "header"
        elif not FURNITURE_NAMES.isdisjoint(p):
            found = found or "some"
    return found


@dataclass
class Block:
    path: str
    words: list[str]
    main: bool
    linked: int  #: words in links, about
    marks: tuple[int, ...]  #: elements around it whose names may mark furniture
    at: int  #: place of its first word in the page's tokens


class Page:
    """Text blocks of a page, furniture left out, and its tokens: (path, word), and ("", path) for a block-level tag."""

    def __init__(self, source: str, lifted: frozenset[str] = frozenset()):
        """``lifted``: kinds of main element (article, main) that names of elements above don't cover."""
        self.blocks: list[Block] = []
        self.tokens: list[tuple[str, str]] = []
        self.has_main = False
        self.said: dict[int, str] = {}  # marked elements: what their names say inside a main element, "" outside
        self.proven: set[int] = set()  # marked elements that hold comments or a form; headers that hold a heading
        stack: list[tuple[str, str, int, bool, int]] = []  # name, path, furniture (1 by a name, 2 by itself), main, mark
        seen: tuple[set[str], set[str]] = set(), set()  # kinds of main element outside furniture, and below names alone
        parts: list[str] = []
        linked = marks = 0  # words in links, elements marked so far
        special = links = False  # whether a formula or embedded element, or a link, has been seen
        end = len(source)

        def close() -> None:
            nonlocal linked
            if parts:
                words = _html.unescape("".join(parts)).split()
                parts.clear()
                if words:
                    path = stack[-1][1] if stack else ""
                    own = tuple(s[4] for s in stack if s[4])
                    self.blocks.append(Block(path, words, bool(stack) and stack[-1][3], min(linked, len(words)), own, len(self.tokens)))
                    self.tokens += [(path, w) for w in words]
            linked = 0

        def pop(name: str, stop: set[str] = frozenset()) -> None:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    return
                if stack[k][0] in stop:
                    return

        at = 0
        while at < end:
            m = _TOKEN.search(source, at)
            to = m.start() if m else end
            if to > at and not (stack and stack[-1][2]):
                parts.append(source[at:to])
                if links and any(s[0] == "a" for s in stack):
                    linked += len(source[at:to].split())
            if not m:
                break
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name:
                continue
            closing, attributes = m[1] or m[4], m[3] or m[6] or ""
            inline = name in INLINE or name in EMBEDDED or name == "math" or "-" in name or (special and any(s[0] == "math" or s[0] in EMBEDDED for s in stack))
            if not inline:
                close()
            if closing:
                if name == "p" and not any(s[0] == "p" for s in stack):
                    continue
                pop(name, MAIN if name not in MAIN and name not in ("body", "html") else frozenset())
                continue
            if name in RAW:
                if not attributes.rstrip().endswith("/") or name in ("script", "style"):
                    over = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.I).search(source, at)
                    at = over.end()
                continue
            if name == "br":
                if parts:
                    parts.append(" ")
                continue
            if name in VOID or (inline and attributes.rstrip().endswith("/")):
                continue
            if name == "body":
                pop("head")
            elif name in MAIN:  # an element left open above must not swallow the article
                while stack and stack[-1][2] and stack[-1][0] in ("nav", "head", "ul", "ol", "li", "a", "p"):
                    stack.pop()
            elif not inline:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in _CLOSED_BY_BLOCK:
                        del stack[k:]
                        break
                    if stack[k][0] not in INLINE:
                        break
                if name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    pop(name, {"ul", "ol", "dl", "table", "select"})
            above = stack[-1] if stack else ("", "", 0, False, 0)
            furniture = 2 if name in FURNITURE or name in EMBEDDED or (name == "header" and not above[3]) else above[2]
            mark, held = 0, [s[4] for s in stack if s[4]] if self.said else []
            if held and (name in ("form", "article") or name in HEADINGS):
                self.proven.update(m for m in held if self.said[m].startswith("header" if name in HEADINGS else "comments"))
            if attributes and furniture < 2 and name not in MAIN and name not in ("html", "body"):
                for kind, value in _NAMES.findall(attributes):
                    kind, value = kind.lower(), value.strip("\"'").lower()
                    if (kind == "hidden") or (kind == "aria-hidden" and value == "true") or (kind == "style" and "display:none" in value.replace(" ", "")):
                        furniture = 2
                    elif above[3] and kind in ("class", "id", "role"):
                        says = _named_inside(value) if name not in TEXTUAL else ""
                        if says == "comments":
                            self.proven.update(m for m in held if self.said[m].startswith("comments"))
                            says = "" if name not in HOLDERS else "ad" if kind == "class" else "comments of a section" if name == "section" else says
                        elif kind == "id":
                            says = ""
                        if says == "ad":
                            furniture = max(furniture, 1)
                        elif says and not mark:
                            mark = marks = marks + 1
                            self.said[mark] = says
                    elif not above[3] and (kind in ("class", "role") or (kind == "id" and name not in HEADINGS)):
                        found = _named(value)
                        if found == 2:
                            furniture = max(furniture, 1)
                        elif found and not mark:
                            mark = marks = marks + 1
                            self.said[mark] = ""
            own = name if name in MAIN else "main" if "main" in attributes and re.search(r"role\s*=\s*[\"']?main\b", attributes) else ""
            if own and furniture < 2:
                if own in lifted:
                    furniture = 0
                seen[furniture].add(own)
            main = above[3] or (own != "" and not furniture)
            self.has_main |= main
            path = above[1] if inline else f"{above[1]}/{name}"
            if not inline:
                self.tokens.append(("", path))
            links |= name == "a"
            special |= name == "math" or name in EMBEDDED
            stack.append((name, path, furniture, main, mark))
        close()
        if not lifted and (covered := frozenset(seen[1] - seen[0])):
            self.__init__(source, covered)

    def marked(self, common: set[tuple[str, ...]] = frozenset()) -> set[int]:
        """The marked elements for which there is evidence; ``common`` are blocks that other pages have, too."""
        words, links, shared, inside = Counter(), Counter(), Counter(), set()
        for b in self.blocks:
            for mark in b.marks:
                if b.main:
                    inside.add(mark)
                words[mark] += len(b.words)
                links[mark] += b.linked
                shared[mark] += len(b.words) if tuple(b.words) in common else 0
        gone = set()
        for k, n in words.items():
            says, proven = self.said[k], k in self.proven
            if links[k] >= LINKED * n:
                gone.add(k)
            elif says == "":
                if n <= SHORT and k not in inside:
                    gone.add(k)
            elif says == "advert" or (says == "header" and not proven):
                if n <= SHORT or shared[k] == n:
                    gone.add(k)
            elif says.startswith("comments") and (proven or (n <= SHORT and says == "comments")):
                gone.add(k)
        return gone


@dataclass
class Class:
    """A valid equivalence class: its tokens in order, and the class and gap that hold each of its repetitions."""

    tokens: tuple[tuple[str, str], ...]
    parent: int = -1
    gap: int = -1
    places: list[list[int]] = field(default_factory=list, repr=False)  #: by page, in page order


def classes(pages: list[Page]) -> list[set[tuple[str, str]]]:
    """The equivalence classes, words among them, of tokens that nearly all pages have."""
    vectors: dict[tuple[str, str], list[tuple[int, int]]] = defaultdict(list)
    for k, p in enumerate(pages):
        for token, count in Counter(p.tokens).items():
            vectors[token].append((k, count))
    alike: dict[tuple[tuple[int, int], ...], list[tuple[str, str]]] = defaultdict(list)
    for token, vector in vectors.items():
        if len(vector) >= SUPPORT * len(pages):
            alike[tuple(vector)].append(token)
    return [set(tokens) for tokens in alike.values() if len(tokens) >= CLASS_SIZE and any(t[0] for t in tokens)]


def ordered(found: list[set[tuple[str, str]]], pages: list[Page]) -> list[Class]:
    """Those of the classes that come on each page as repetitions of one order."""
    of = {token: c for c, tokens in enumerate(found) for token in tokens}
    places = [[[] for _ in pages] for _ in found]
    for k, p in enumerate(pages):
        for i, token in enumerate(p.tokens):
            if (c := of.get(token)) is not None:
                places[c][k].append(i)
    out = []
    for tokens, own in zip(found, places, strict=True):
        k = next(k for k, at in enumerate(own) if at)
        order = tuple(pages[k].tokens[i] for i in own[k][: len(tokens)])
        if set(order) == tokens and all(tuple(p.tokens[i] for i in at) == order * (len(at) // len(order)) for p, at in zip(pages, own, strict=True)):
            out.append(Class(order, places=own))
    return out


def _gap(inner: Class, outer: Class) -> int | None:
    """The gap of the outer class that holds every repetition of the inner one on all pages; 0 is outside; None if there is none."""
    gap = None
    m, size = len(outer.tokens), len(inner.tokens)
    for at, around in zip(inner.places, outer.places, strict=True):
        for s in range(0, len(at), size):
            low, high = bisect_left(around, at[s]), bisect_left(around, at[s + size - 1])
            if low != high or gap not in (None, low % m):
                return None
            gap = low % m
    return gap


def nested(valid: list[Class]) -> list[Class]:
    """The classes, larger ones first, that cross no larger one, each with the innermost class that holds it."""
    kept: list[Class] = []
    for c in sorted(valid, key=lambda c: (-len(c.tokens), c.tokens)):
        if all(_gap(c, k) is not None or _gap(k, c) is not None for k in kept):
            kept.append(c)
    for c in kept:
        around = [(len(k.tokens), i, gap) for i, k in enumerate(kept) if k is not c and (gap := _gap(c, k))]
        if around:
            _, c.parent, c.gap = min(around)
    return kept


def template(pages: list[Page]) -> list[Class]:
    """The nested classes of distinct pages of one site; none of too few pages."""
    return nested(ordered(classes(pages), pages)) if len(pages) >= LEAST_PAGES else []


def slots(page: Page, fixed: set[tuple[str, str]]) -> list[tuple[str, str] | None]:
    """The slot, named by the template's token before it, of each block of the page; None for a block of template tokens alone."""
    known = [i for i, token in enumerate(page.tokens) if token in fixed]
    out = []
    for b in page.blocks:
        free = next((i for i in range(b.at, b.at + len(b.words)) if page.tokens[i] not in fixed), None)
        before = bisect_left(known, free) - 1 if free is not None else None
        out.append(None if before is None else ("", "") if before < 0 else page.tokens[known[before]])
    return out


def main_texts(sources: list[str | None]) -> list[str]:
    """The main text of each of some pages of one site."""
    parsed: dict[str, Page] = {}
    for s in sources:
        if s and s not in parsed:
            parsed[s] = Page(s)
    # pages with the same text are one page to the vectors
    distinct = list({tuple(tuple(b.words) for b in p.blocks): p for p in parsed.values()}.values())
    fixed = {token for c in template(distinct) for token in c.tokens}
    slot_of = {id(p): slots(p, fixed) for p in parsed.values()} if fixed else {}
    words, links = Counter(), Counter()
    for p in distinct if fixed else ():
        for b, slot in zip(p.blocks, slot_of[id(p)], strict=True):
            words[slot] += len(b.words)
            links[slot] += b.linked
    had = Counter(block for p in distinct if p.said for block in {tuple(b.words) for b in p.blocks if b.marks})
    common = {block for block, n in had.items() if n > 1}
    done = {}
    for s, p in parsed.items():
        gone, own = p.marked(common), slot_of.get(id(p)) or [("", "")] * len(p.blocks)
        on = [gone.isdisjoint(b.marks) and (b.main if p.has_main else slot is not None and links[slot] <= LINKED * words[slot]) for b, slot in zip(p.blocks, own, strict=True)]
        for k in range(len(on) - 2, -1, -1) if fixed and not p.has_main else ():
            head, _, tag = p.blocks[k].path.rpartition("/")
            if own[k] is None and tag in HEADINGS and on[k + 1] and gone.isdisjoint(p.blocks[k].marks) and p.blocks[k + 1].path.startswith(f"{head}/"):
                on[k] = True
        done[s] = "\n\n".join(" ".join(b.words) for b, keep in zip(p.blocks, on, strict=True) if keep)
    return [done[s] if s else "" for s in sources]


def extract(pages: DataFrame, chunk: int = CHUNK, limit: int = BROADCAST_IDS) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    A host's pages are dealt by a hash of the page into as many chunks as its count asks for. Only hosts of more than
    one chunk are looked up, by a broadcast where they are ``limit`` at most, else by a join.
    """
    ship(pages.sparkSession)
    rows = pages.select("page_id", "url", "html").withColumn("host", F.lower(F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit(""))))
    large = rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
    rows = rows.join(light(cut(large, "hosts"), limit), "host", "left")
    part = F.pmod(F.xxhash64("page_id", "url"), F.ceil(F.coalesce("n", F.lit(1)) / chunk))
    dealt = rows.select("page_id", "url", "html", F.xxhash64("host", part).alias("site")).repartition("site").sortWithinPartitions("site")
    key = pages.schema["page_id"].dataType.simpleString()

    def run(batches):
        for table, edges in whole_runs(batches, ["site"], rows=256):
            column = table.column("html")
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                texts = main_texts(column.slice(a, b - a).to_pylist())
                part = table.slice(a, b - a).combine_chunks()
                get = lambda c, part=part: part.column(c).chunk(0)
                yield pa.RecordBatch.from_arrays([get("page_id"), get("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return dealt.mapInArrow(run, f"page_id {key}, url string, text string, n_chars long")
