"""Main text of raw HTML pages by line-block distribution.

Markup is stripped into lines, one to each block of the page, in page order.
Blocks in menus, headers, footers, sidebars, notices, adverts, forms and
comments (by element, role, class or id) are lines of length 0, and the text of
links does not count, except in headings and on pages that have no other.  Lengths
are summed over sliding windows of ``WINDOW`` lines; text surges where a sum reaches
half the mean length of the page's lines of text and dives where it falls to zero;
of the lines between a surge and its dive all outside boilerplate are kept,
whatever their own length.

A mark of the article (``article``, ``main``) is a weight: where its lines hold at
least half of the page's text, each of them weighs enough to surge and the lines
outside weigh nothing; where they hold less (teasers), the mark is passed over.
Inside an article a class or id of several words, one of which may mean boilerplate
or not (``social-history``, ``share-buttons``), is decided by the lines below it: they
are text if less than a quarter of them is links and their mean length reaches the
surge level.

Cases: null html is empty text; unclosed elements end with their parent or the
page; a page cut off anywhere is read as far as it goes; repeated rows are
extracted each.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakeops.llm._common import map_batches

WINDOW = 3
#: a mark of the article stands if its lines hold one part in so many of the page's text
MARK_SHARE = 2

HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
                    r"|<(script|style|textarea|title)\b"
                    r"[^>]*(?:/>|>.*?(?:</\1\s*>|\Z)|\Z)", re.S | re.I)
TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)(/?)>|<(?=/?[a-zA-Z])[^<>]*\Z""")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

#: elements without text of the page; one without an end tag ends with its parent
UNSEEN = frozenset("noscript template svg iframe object select".split())
NEXT = {name: re.compile(rf"<(/?){name}\b", re.I) for name in UNSEEN}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section
    summary table tbody td tfoot th thead tr ul""".split())
BOILERPLATE = frozenset("nav footer aside form button menu dialog".split())
#: words of class and id names that mark boilerplate
MARKS = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
    consent cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice popup promo
    promoted related replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar widget
    """.split())
#: of these, words that are common in names of article sections too
AMBIGUOUS = frozenset("ad banner menu notice related reply respond share sharing social widget".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
SPLIT = re.compile(r"[^a-z0-9]+")
HREF = re.compile(r"\bhref\s*=", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: elements that an opening tag of the same kind, or a block, closes
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "a": {"a"}}


def boilerplate(name: str, attributes: str, in_article: bool) -> int:
    """2 if an element is boilerplate, 1 if the lines below it decide, else 0."""
    if name in BOILERPLATE or name == "header" and not in_article:
        return 2
    if not attributes or name in ("body", "html", "article", "main") and not in_article:
        return 0
    found = 0
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key == "role" and value in ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return 2
        if key in ("class", "id"):
            for words in map(SPLIT.split, value.split()):
                marks = MARKS.intersection(words)
                if marks and not (in_article and marks <= AMBIGUOUS and len(set(filter(None, words))) > len(marks)):
                    return 2
                found = found or int(bool(marks))
    return found


class Open:
    """The open elements, with the depths of each name, so that no tag walks the stack."""

    def __init__(self):
        self.names: list[str] = []
        self.depths: dict[str, list[int]] = {}

    def push(self, name: str):
        self.depths.setdefault(name, []).append(len(self.names))
        self.names.append(name)

    def cut(self, depth: int):
        while len(self.names) > depth:
            self.depths[self.names.pop()].pop()

    def last(self, name: str) -> int:
        """Depth of the innermost one of a name, -1 if none is open."""
        at = self.depths.get(name)
        return at[-1] if at else -1

    def first(self, name: str) -> int:
        at = self.depths.get(name)
        return at[0] if at else -1


def ends(stack: Open, hide_at: int, name: str) -> bool:
    """Whether the block ``name`` ends an unseen element that has no end tag: it
    ends the parent, no tag must end the parent, or svg cannot hold it."""
    parent = stack.names[hide_at - 2] if hide_at > 1 else "html"
    return (parent in ("html", "body", "p") or name in CLOSES and parent in CLOSES[name]
            or stack.names[hide_at - 1] == "svg" and stack.last("foreignobject") < hide_at)


def lines(html: str) -> tuple[list[tuple[str, bool, bool, int, int]], bool]:
    """((text, boilerplate, in the article, length without links, number of the
    undecided element it lies in or 0) of each block; article marked)."""
    out: list[tuple[str, bool, bool, int, int]] = []
    stack = Open()
    skip_at = article_at = link_at = open_at = 0  # depth of the element that began it; 0: none
    hide_at, unclosed = 0, False                 # the same of an element in UNSEEN; whether it has no end tag
    seen_article, undecided = False, 0
    part: list[str] = []
    linked: list[str] = []

    def add(text: str):
        if hide_at:
            return
        part.append(text)
        if link_at:
            linked.append(text)

    def end_block():
        if part:
            text = " ".join(unescape("".join(part)).split())
            if text:
                links = len(" ".join(unescape(" ".join(linked)).split())) if linked else 0
                out.append((text, bool(skip_at), bool(article_at), max(len(text) - links, 0),
                            undecided if open_at else 0))
            part.clear()
            linked.clear()

    def close_to(depth: int):
        nonlocal skip_at, article_at, link_at, open_at, hide_at
        stack.cut(depth)
        skip_at = 0 if skip_at > depth else skip_at
        article_at = 0 if article_at > depth else article_at
        link_at = 0 if link_at > depth else link_at
        open_at = 0 if open_at > depth else open_at
        hide_at = 0 if hide_at > depth else hide_at

    html, last = HIDDEN.sub(" ", html), 0
    for m in TAG.finditer(html):
        if m.start() > last:
            add(html[last:m.start()])
        last = m.end()
        closing, name, attributes = m[1], (m[2] or "").lower(), m[3]
        if name == "br":
            part.append(" ")
        if not name or name == "head" or name in VOID and name != "hr":
            continue
        if hide_at:
            if closing:
                if stack.last(name) >= hide_at - 1:
                    close_to(stack.last(name))
            elif unclosed and name in BLOCK and ends(stack, hide_at, name):
                close_to(hide_at - 1)
            else:
                if name != "hr" and not m[4] and not attributes.endswith("/"):
                    stack.push(name)
                continue
        if name in BLOCK:
            end_block()
        if name == "hr":
            continue
        if closing:
            if stack.last(name) >= 0:
                close_to(stack.last(name))
            continue
        if m[4] or attributes.endswith("/"):
            continue
        if name in BLOCK and stack.first("p") >= max(skip_at, article_at, 0):
            close_to(stack.first("p"))                             # a block ends a paragraph
        elif name in CLOSES and stack.names and stack.names[-1] in CLOSES[name]:
            close_to(len(stack.names) - 1)
        stack.push(name)
        if name in UNSEEN:
            part.append(" ")
            after = NEXT[name].search(html, last)
            hide_at, unclosed = len(stack.names), not after or not after[1]
        if name == "a" and not link_at and HREF.search(attributes) and all(stack.last(h) < 0 for h in HEADINGS):
            link_at = len(stack.names)
        kind = 0 if skip_at else boilerplate(name, attributes, bool(article_at))
        if kind == 2:
            skip_at = len(stack.names)
        elif kind and not open_at:
            open_at, undecided = len(stack.names), undecided + 1
        elif not article_at and not skip_at and name in ("article", "main"):
            article_at, seen_article = len(stack.names), True
    add(html[last:])
    end_block()
    return out, seen_article


def regions(lengths: list[float], window: int = WINDOW, level: float = 0) -> list[tuple[int, int]]:
    """[surge, dive) of each stretch where the sums over ``window`` lines from
    each line on reach ``level`` and then stay above zero; it begins and ends
    with a line of text."""
    n, out, start = len(lengths), [], None
    total = sum(lengths[:window])
    for i in range(n + 1):
        if start is None and i < n and lengths[i] and total >= level:
            start = i
        if start is not None and (i == n or not total):
            end = i
            while end > start and not lengths[end - 1]:
                end -= 1
            out.append((start, end))
            start = None
        if i < n:
            total += (lengths[i + window] if i + window < n else 0) - lengths[i]
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    blocks, marked = lines(html)
    own = [0 if skip else n for _, skip, _, n, _ in blocks]
    if not any(own):                                               # links are all the text there is
        own = [0 if skip else len(text) for text, skip, _, _, _ in blocks]
    level = sum(own) / (2 * max(sum(map(bool, own)), 1))
    below: dict[int, list[int]] = {}                               # undecided element -> lines, text, text without links
    for (text, skip, _, n, element) in blocks:
        if element and not skip:
            sums = below.setdefault(element, [0, 0, 0])
            for i, x in enumerate((1, len(text), n)):
                sums[i] += x
    dropped = {e for e, (n, size, free) in below.items() if 4 * free <= 3 * size or free < n * level}
    kept = [not skip and element not in dropped for _, skip, _, _, element in blocks]
    if marked:
        inside = [k and b[2] for k, b in zip(kept, blocks)]
        if any(inside) and MARK_SHARE * sum(n for n, i in zip(own, inside) if i) >= sum(n for n, k in zip(own, kept) if k):
            kept, own = inside, [max(n, level, 1) for n in own]
    weights = [n if k else 0 for n, k in zip(own, kept)]
    return "\n\n".join(blocks[i][0] for a, b in regions(weights, WINDOW, level) for i in range(a, b) if kept[i])


def extract(pages: DataFrame) -> DataFrame:
    """One row a page: page_id, url, text, n_chars."""
    schema = StructType([pages.schema["page_id"], pages.schema["url"], StructField("text", StringType()),
                         StructField("n_chars", LongType())])

    def make():
        def step(batch):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            return [batch.column(0), batch.column(1), texts, [len(t) for t in texts]]
        return step

    return map_batches(pages.select("page_id", "url", "html"), make, schema)
