"""Main text of web pages by composite text density.

A page becomes a tree of elements. Elements that can't be part of an article (menus,
footers, sidebars, forms, scripts, notices, adverts, reader comments: told by their
tags, roles and the words of their classes and ids) are cut off. Of what is left, every
element has C characters, T tags, and LC characters and LT tags of links, all with its
descendants. Its density is

    C / T * log(C * T / (LC * LT)) / log(log(C * LC / (C - LC) + C * LC_body / C_body + e))

(numbers that are 0 count as 1): text for each tag, less where links take part of it.
The density sum of a block is that of its child blocks and of its own text. The block
with the largest sum is the article; inline elements are part of the block they stand
in. The smallest density on the path from `body` down to that block is the threshold:
other blocks are content too where they reach it and their density sum is at least
`SHARE` of the article's, as with an article in several sections. Where the article
lies in an `article` element, that whole element and nothing else is the content. A
heading of level 1 in front of the content belongs to it.

Pages are handled one by one in the tasks that read them; nothing is shuffled.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyroll.llm.common import texts_of

#: A block outside the article is content from this share of the article's density sum on.
SHARE = 0.25
#: A block of at least so many links is a menu if they hold at least two thirds of its characters.
MENU_LINKS = 3

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg select object math".split())
BLOCKS = frozenset(
    "html body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
CELLS = frozenset(("td", "th", "br"))
HEADINGS = frozenset(f"h{k}" for k in range(1, 7))
#: A start tag of the first kind ends open elements of the second, up to one of the third.
ENDS_ITSELF = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tr", "tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tr", "tbody", "thead"), ("table",)),
}
#: Blocks whose start ends an open paragraph.
ENDS_P = BLOCKS - frozenset("html body caption dd dt li legend summary tbody tfoot thead tr".split())
JUNK_TAGS = frozenset("head nav footer aside form button menu dialog audio video canvas input".split())
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
#: Words of classes and ids.
JUNK_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot banner sponsor sponsored sponsors promo promos promotion promoted "
    "cookie cookies consent gdpr notice notices disclaimer popup modal overlay newsletter subscribe subscription signup paywall "
    "menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar masthead footer sidebar sidebars widget widgets "
    "share sharing social related recommended recommendations trending "
    "comment comments commentlist disqus respond replies discussion login search searchbox searchform skip header".split())
#: Of these, words that also name the frame around an article ("with-sidebar"): not junk where they hold most of the page's text.
FRAME_WORDS = frozenset("header masthead menu nav navbar search sidebar sidebars skip social toolbar widget widgets".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_TOKEN = re.compile(
    r"""<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|/[^A-Za-z][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*(?:>|\Z)))""", re.DOTALL)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE) for tag in RAW}


def attributes(raw: str) -> dict[str, str]:
    """Attributes by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), html.unescape(double or single or bare))
    return out


class Element:
    """An element with its child elements and texts in order, and the sums over its subtree."""

    __slots__ = ("tag", "parent", "items", "mark", "chars", "tags", "link_chars", "link_tags", "density", "own")

    def __init__(self, tag: str, parent: Element | None, mark: str = ""):
        self.tag, self.parent, self.items, self.mark = tag, parent, [], mark
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.own = 0.0

    def children(self) -> list[Element]:
        return [x for x in self.items if x.__class__ is Element]


def mark_of(tag: str, raw: str) -> str:
    """junk: certainly no content; words or frame: junk by the words of its class, id or role, which its content may refute."""
    if tag in JUNK_TAGS:
        return "junk"
    if not raw or tag in ("html", "body"):
        return ""
    found = attributes(raw)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or ("style" in found and _HIDDEN.search(found["style"])):
        return "junk"
    words = {w.lower() for key in ("class", "id") if key in found for w in _WORD.findall(found[key])}
    junk = words & JUNK_WORDS
    if found.get("role", "").lower() in JUNK_ROLES or junk - FRAME_WORDS:
        return "words"
    return "frame" if junk else ""


def parse(page: str) -> Element:
    """The tree of a page; elements need not be closed, nor need the page be whole."""
    root = Element("html", None)
    body = None
    at, stack, last = root, {"html": 1}, 0  # `stack` counts the open elements of each tag

    def close(upto: Element) -> None:
        nonlocal at
        while at is not upto:
            stack[at.tag] -= 1
            at = at.parent
        stack[at.tag] -= 1
        at = at.parent

    def end(tags: tuple[str, ...], stop: tuple[str, ...]) -> None:
        """Close the outermost open element of these tags within the innermost of `stop`."""
        if not any(stack.get(t) for t in tags):
            return
        x, found = at, None
        while x is not None and x.tag not in stop:
            if x.tag in tags:
                found = x
            x = x.parent
        if found is not None:
            close(found)

    position, size = 0, len(page)
    while position < size:
        token = _TOKEN.search(page, position)
        start = token.start() if token else size
        if start > last:
            text = page[last:start]
            at.items.append(html.unescape(text) if "&" in text else text)
        if token is None:
            break
        position = last = token.end()
        tag = token.group(2)
        if tag is None:
            continue
        tag, raw = tag.lower(), token.group(3)
        if not raw.endswith(">"):
            break  # the page ends within a tag
        if token.group(1):
            if tag not in VOID and stack.get(tag) and tag not in ("html", "body"):
                x, inline = at, tag not in BLOCKS and tag not in CELLS
                stop = ENDS_ITSELF[tag][1] if tag in ENDS_ITSELF else ()
                while x.tag != tag and x.tag not in stop and not (inline and x.tag in BLOCKS):
                    x = x.parent
                if x.tag == tag:
                    close(x)
            continue
        if tag == "html":
            continue
        if tag == "body":
            if body is None:
                while at is not root:
                    stack[at.tag] -= 1
                    at = at.parent
            else:
                continue
        if tag in RAW:
            if not raw.endswith("/>") or tag in ("script", "style", "textarea", "title"):
                found = _RAW_END[tag].search(page, position)
                position = last = found.end() if found else size
            continue
        if tag in ENDS_P and stack.get("p"):
            end(("p",), ("table", "button"))
        if tag in ENDS_ITSELF:
            end(*ENDS_ITSELF[tag])
        if tag != "head" and stack.get("head"):
            if tag in ("meta", "link", "base"):
                continue
            end(("head",), ())
        one = Element(tag, at, mark_of(tag, raw[:-1]))
        at.items.append(one)
        if tag == "body":
            body = one
        if tag not in VOID:
            at = one
            stack[tag] = stack.get(tag, 0) + 1
    return root


def _postorder(root: Element) -> list[Element]:
    out, todo = [], [root]
    while todo:
        x = todo.pop()
        out.append(x)
        todo.extend(x.children())
    return out[::-1]


def _measure(root: Element) -> list[Element]:
    """Set the sums of all elements; returns them, children before parents."""
    order = _postorder(root)
    for x in order:
        x.chars = x.tags = x.link_chars = x.link_tags = 0
        for item in x.items:
            if item.__class__ is Element:
                x.chars += item.chars
                x.tags += item.tags + 1
                x.link_chars += item.link_chars
                x.link_tags += item.link_tags
            else:
                x.chars += len(item) - item.count(" ") if item.isascii() else sum(map(len, item.split()))
        if x.tag == "a":
            x.link_chars = x.chars
            x.link_tags += 1
    return order


def _refuted(x: Element, total: int, articles: set[Element]) -> bool:
    """Words of a class don't make an element junk that holds an article; without articles, words of frames don't where most of the text is."""
    return x in articles or (not articles and x.mark == "frame" and 2 * x.chars > total)


def cut_junk(root: Element) -> None:
    """Take the elements off the tree that hold no part of an article."""
    order = [root]
    for x in order:  # certain junk first: its text must not count as text of the page
        x.items = [i for i in x.items if i.__class__ is not Element or i.mark != "junk" or (i.tag == "form" and _holds_article(i))]
        order.extend(x.children())
    order = _measure(root)
    holders: set[Element] = set()
    for x in order:
        if x.tag in ("article", "main") and not x.mark:
            while x is not None and x not in holders:
                holders.add(x)
                x = x.parent
    todo = [(root, False)]
    while todo:
        x, inside = todo.pop()
        inside = inside or x.tag in ("article", "main")
        kept = []
        for i in x.items:
            if i.__class__ is Element:
                if i.tag == "header" or (inside and i.mark and any(y.tag == "h1" for y in i.children())):
                    if not inside:
                        continue
                    # An article's header: its headings; one amid the text: those of level 1.
                    first = not any(y.chars if y.__class__ is Element else y.strip() for y in kept)
                    i.items = [y for y in _postorder(i)[::-1] if y.tag == "h1" or (first and y.tag in HEADINGS)]
                elif i.mark and i.chars and not _refuted(i, root.chars, holders):
                    continue
                elif i.tag in BLOCKS and i.tag not in ("html", "body") and i.link_tags >= MENU_LINKS and 3 * i.link_chars >= 2 * i.chars and i not in holders:
                    continue
                todo.append((i, inside))
            kept.append(i)
        x.items = kept


def _holds_article(x: Element) -> bool:
    return any(y.tag in ("article", "main") for y in _postorder(x))


def density(c: int, t: int, lc: int, lt: int, body_share: float) -> float:
    if not c:
        return 0.0
    t, lt, links, plain = max(t, 1), max(lt, 1), max(lc, 1), max(c - lc, 1)
    return c / t * math.log(max(1.0, c * t / (links * lt))) / math.log(math.log(c * links / plain + body_share * c + math.e))


def set_densities(root: Element) -> list[Element]:
    """Densities and density sums of all blocks; returns the blocks, children before parents."""
    order = _measure(root)
    body_share = root.link_chars / max(1, root.chars)
    blocks = []
    for x in order:
        if x.tag not in BLOCKS:
            continue
        x.density, x.own = density(x.chars, x.tags, x.link_chars, x.link_tags, body_share), 0.0
        # What is not in child blocks is the block's own text.
        c, t, lc, lt, todo = 0, 0, 0, 0, list(x.items)
        while todo:
            i = todo.pop()
            if i.__class__ is Element:
                if i.tag in BLOCKS:
                    x.own += i.density
                    continue
                t += 1
                if i.tag == "a":
                    lt += 1
                    lc += i.chars
                todo.extend(i.items)
            else:
                c += sum(map(len, i.split()))
        if c:
            x.own += density(c, t, min(lc, c), lt, body_share)
        blocks.append(x)
    return blocks


def content_roots(root: Element) -> list[Element]:
    """The blocks that are content, in page order."""
    blocks = set_densities(root)
    best = max(reversed(blocks), key=lambda x: x.own)  # of equal sums that nearest to the root
    if not root.chars:
        return []
    path, articles = [], []
    x = best
    while x is not None:
        path.append(x)
        if x.tag == "article":
            articles.append(x)
        x = x.parent
    if articles:
        found = [articles[-1]]
    else:
        threshold = min(x.density for x in path if x.tag in BLOCKS)
        on_path, found, todo = set(path), [], [root]
        while todo:
            x = todo.pop()
            if x is best or (x not in on_path and x.density >= threshold and x.own >= SHARE * best.own):
                found.append(x)
            elif x.tag in BLOCKS or x in on_path:
                todo.extend(reversed(x.children()))
    inside, at, title = False, [root], None
    while at:  # the last heading of level 1 in front of the content, if none is within
        x = at.pop()
        if x in found:
            inside = True
            break
        if x.tag == "h1":
            title = x
        at.extend(reversed(x.children()))
    if title is not None and inside and not any(y.tag == "h1" for x in found for y in _postorder(x)):
        found.insert(0, title)
    return found


def text_of(roots: list[Element]) -> str:
    """Texts of blocks, white space in one put together, one block a line."""
    lines: list[str] = []
    held: list[str] = []

    def end_block() -> None:
        if held:
            words = " ".join("".join(held).split())
            if words:
                lines.append(words)
            held.clear()

    for root in roots:
        todo: list = [root]
        while todo:
            x = todo.pop()
            if x is None:
                end_block()
            elif x.__class__ is Element:
                if x.tag in CELLS:
                    held.append(" ")
                    todo.append(" ")
                elif x.tag in BLOCKS:
                    end_block()
                    todo.append(None)
                todo.extend(reversed(x.items))
            else:
                held.append(x)
        end_block()
    return "\n".join(lines)


def main_text(page: str) -> str:
    """The main text of one page."""
    root = parse(page)
    cut_junk(root)
    return text_of(content_roots(root))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: the id, the url, text, n_chars (code points).

    Character references are decoded, white space within a block becomes one space, and
    blocks are joined by one line feed; nothing of the content is dropped or capped. A
    null, empty or blank page, and one without text, has the empty text. Pages cut
    short are read as far as they go. Null ids and urls stay null, repeated rows are
    extracted one by one, other columns are not read; an empty table gives an empty one.
    """
    rows = pages.select(id_col, url_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in texts_of(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    kinds = [f.dataType.simpleString() for f in rows.schema.fields]
    return rows.mapInArrow(run, f"`{id_col}` {kinds[0]}, `{url_col}` {kinds[1]}, text string, n_chars long")
