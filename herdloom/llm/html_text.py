"""Main text of web pages by the distribution of text over lines and blocks."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from statistics import median_low
from typing import NamedTuple

from pyspark.sql import DataFrame

from herdloom.llm.base import map_slices

#: Lines of a sliding window whose text lengths are summed.
WINDOW = 3
#: Characters outside links that a window of the article has, as long as the page has windows of twice that.
SURGE = 80
#: Part of the text of a page from which what holds it is a wrapper.
MOST = 1 / 2
#: How many times text in article and main elements counts against text outside of them.
TAGGED = 4

# Elements that start a line, that hold no text of the page, and words in classes and ids
# that mark what is not the article.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
SILENT = frozenset("head script style noscript template iframe object embed svg canvas audio video select".split())
RAW = frozenset("script style noscript template iframe textarea title annotation annotation-xml".split())
BOILERPLATE = frozenset("nav menu footer aside form dialog input textarea fieldset".split())
CONTROLS = frozenset("button label".split())
ENDED_BY_NEXT = frozenset("p li option dt dd tr td th a".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|adverts|advertisement|advertising|banner|sponsor|sponsored|promo|promotion|"
    r"sidebar|side|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|footer|header|masthead|topbar|toolbar|notice|"
    r"notices|cookie|cookies|consent|gdpr|popup|modal|alert|newsletter|subscribe|subscription|share|sharing|social|"
    r"related|recommended|widget|widgets|comment|comments|reply|replies|disqus|respond|pagination|pager|copyright|"
    r"disclaimer|login|search|skip)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: Marks of adverts, of all that is never a wrapper of the article, of headers, and of headers of articles.
ADVERTS = "ad|ads|adv|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion"
ADVERT = re.compile(rf"(?:^|[\s_-])(?:{ADVERTS})(?:$|[\s_-])", re.IGNORECASE)
APART = re.compile(
    rf"(?:^|[\s_-])(?:{ADVERTS}|comments?|reply|replies|disqus|respond|related|recommended|cookies?|consent|gdpr|popup|"
    r"newsletter|subscribe|subscription|share|sharing|breadcrumbs?|copyright|disclaimer)(?:$|[\s_-])",
    re.IGNORECASE,
)
HEADER = re.compile(r"(?<![^\s_-])(?:header|masthead)(?![^\s_-])", re.IGNORECASE)
OWN_HEADER = re.compile(r"(?<!\S)(?:entry|post|article|story|content)[_-]+header(?!\S)", re.IGNORECASE)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
PROSE = frozenset("p blockquote pre".split()) | HEADINGS
CELLS = frozenset("td th dt dd caption figcaption".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())

COMMENT = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)", re.DOTALL)
NAME = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
ATTRIBUTE = re.compile(r"([A-Za-z_:][-A-Za-z0-9_:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"\s+")
RIGHTS = re.compile(r"©|\(c\)|copyright\b", re.IGNORECASE)


def marks_of(tag: str, attributes: str, article: bool) -> tuple[bool, bool, bool]:
    """Whether a tag marks its element as boilerplate for certain, softly, or as a matter of its own.

    Soft marks (classes, ids, roles, a form) may stand on a mere wrapper of the page, see ``weigh``. Those of
    comments and the like are soft, but an article within them is no sign of a wrapper. In an article, a class
    on a paragraph or heading counts if it says advert only, and a header is the article's own.
    """
    if tag in BOILERPLATE:
        return tag != "form", tag == "form", False
    if not attributes.strip() or tag in ("html", "body", "main", "article"):
        return False, False, False
    hard = soft = apart = False
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        name = name.lower()
        if name in ("class", "id"):
            value = OWN_HEADER.sub(" ", value)
            if article:
                value = HEADER.sub(" ", value)
            if (ADVERT if article and tag in PROSE else MARKS).search(value):
                soft = True
                apart = apart or APART.search(value) is not None
        elif name == "role":
            soft = soft or value.lower() in ROLES
        hard = hard or name == "hidden" or name == "aria-hidden" and value.lower() == "true"
    return hard, soft, apart


class Line(NamedTuple):
    """What stands between two block boundaries: text, characters of it in links and in controls (links
    counted too), innermost element."""

    text: str
    linked: int
    control: int
    element: int


class Page:
    """Elements of a page in the order they open, and its lines."""

    def __init__(self) -> None:
        self.tags, self.parent, self.block, self.article = [""], [-1], [0], [0]
        self.hard, self.soft, self.apart = [False], [False], [False]
        self.lines: list[Line] = []

    def open(self, tag: str, attributes: str, parent: int) -> int:
        at, article = len(self.tags), self.article[parent]
        hard, soft, apart = marks_of(tag, attributes, article > 0)
        self.tags.append(tag)
        self.parent.append(parent)
        self.block.append(at if tag in BLOCKS or tag in BOILERPLATE else self.block[parent])
        self.article.append(at if tag in ("article", "main") else article)
        self.hard.append(hard or tag == "head" or tag == "header" and not article)
        self.soft.append(soft)
        self.apart.append(apart)
        return at


class OpenTags:
    """Elements that are open, with the places of each name, so that no look-up walks through all of them."""

    def __init__(self) -> None:
        self.elements: list[tuple[str, int]] = []  # name and number of the element
        self.places: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []

    def push(self, tag: str, number: int) -> None:
        if tag in BLOCKS:
            self.blocks.append(len(self.elements))
        self.places[tag].append(len(self.elements))
        self.elements.append((tag, number))

    def innermost(self) -> int:
        return self.elements[-1][1] if self.elements else 0

    def close(self, tag: str) -> None:
        """End the innermost element of a name and all within it; nothing if none is open."""
        if not self.places[tag]:
            return
        ended = None
        while ended != tag:
            ended = self.elements.pop()[0]
            self.places[ended].pop()
            if ended in BLOCKS:
                self.blocks.pop()

    def end_within_block(self, tag: str) -> None:
        """End the innermost element of a name unless a block was opened within it."""
        if self.places[tag] and (not self.blocks or self.places[tag][-1] >= self.blocks[-1]):
            self.close(tag)


class Tags:
    """Ends of tags. Quotes that are never closed are remembered, so that no part of a page is searched twice."""

    def __init__(self, page: str):
        self.page, self.hopeless = page, set()
        self.special = [m.start() for m in re.finditer("[>\"']", page)]

    def end(self, at: int) -> int | None:
        """Where the attributes of a tag that begin at ``at`` end; None where a quote in them is never closed."""
        seen = []
        while True:
            k = bisect_left(self.special, at)
            if k == len(self.special):
                return len(self.page)
            at = self.special[k]
            if self.page[at] == ">":
                return at
            seen.append(at)
            close = -1 if at in self.hopeless else self.page.find(self.page[at], at + 1)
            if close < 0:
                self.hopeless.update(seen)
                return None
            at = close + 1


def parse(page: str) -> Page:
    """Elements and lines of a page, in one pass over its markup."""
    found, tags, opened = Page(), Tags(page), OpenTags()
    parts, links, controls = [], [], []
    at = 0

    def add(text: str) -> None:
        parts.append(text)
        control = opened.places["button"] or opened.places["label"]
        if control:
            controls.append(text)
        if control or opened.places["a"]:
            links.append(text)

    def plain(pieces: list[str]) -> str:
        return SPACE.sub(" ", html.unescape("".join(pieces))).strip()

    def flush() -> None:
        if text := plain(parts):
            linked, control = (min(len(plain(pieces)), len(text)) if pieces else 0 for pieces in (links, controls))
            found.lines.append(Line(text, linked, control, opened.innermost()))
        for pieces in (parts, links, controls):
            pieces.clear()

    while at < len(page):
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        add(page[at:lt])
        if match := COMMENT.match(page, lt):
            at = match.end()
            continue
        match = NAME.match(page, lt)
        end = tags.end(match.end()) if match else None
        if end is None:
            add("<")
            at = lt + 1
            continue
        at = end + 1
        closing, tag = match[1] == "/", match[2].lower()
        if tag in BLOCKS or tag in SILENT or tag in BOILERPLATE:
            flush()
        if closing:
            opened.close(tag)
            continue
        if tag in VOID:
            if tag == "br":
                add(" ")
            continue
        if tag in RAW or tag in SILENT and tag != "head":
            closed = re.compile(f"</{re.escape(tag)}\\s*>", re.IGNORECASE).search(page, at)
            at = closed.end() if closed else len(page)
            continue
        if tag == "body":
            opened.close("head")
        if tag in ENDED_BY_NEXT:
            # Elements within a line that were left open end with it.
            opened.end_within_block(tag)
        opened.push(tag, found.open(tag, page[match.end() : end], opened.innermost()))
    flush()
    return found


def choices(page: Page) -> list[bool]:
    """Lines that offer choices: buttons or labels alone, or links alone outside of paragraphs and cells.

    A list item of links alone is one where all items of its list are, as in a menu.
    """
    blocks = [page.block[line.element] for line in page.lines]
    alone = [line.linked == len(line.text) for line in page.lines]
    lists = defaultdict(lambda: True)
    for block, link in zip(blocks, alone):
        lists[page.parent[block]] &= link
    found = []
    for line, block, link in zip(page.lines, blocks, alone):
        tag = page.tags[block]
        menu = link and tag not in PROSE and tag not in CELLS and (tag != "li" or lists[page.parent[block]])
        found.append(menu or line.control == len(line.text))
    return found


def weigh(page: Page) -> list[int]:
    """Characters of every line, but 0 where it stands in a menu, header, footer, sidebar, advert or the like.

    A soft mark on an element around an article or main element, or around half of the text of the page
    that stands in no certain boilerplate, is that of a wrapper and says nothing, comments and the like
    apart. Where the marks leave no text at all none of the soft ones counts.
    """
    n = len(page.tags)
    hard = page.hard[:]
    for e in range(1, n):
        hard[e] = hard[e] or hard[page.parent[e]]
    text, article = [0] * n, [tag in ("article", "main") for tag in page.tags]
    for line in page.lines:
        text[line.element] += 0 if hard[line.element] else len(line.text) - line.linked
    for e in range(n - 1, 0, -1):
        text[page.parent[e]] += text[e]
        article[page.parent[e]] = article[page.parent[e]] or article[e]
    bad = hard[:]
    for e in range(1, n):
        wrapper = not page.apart[e] and (article[e] or 0 < text[0] <= text[e] / MOST)
        bad[e] = bad[e] or bad[page.parent[e]] or page.soft[e] and not wrapper
    if all(bad[line.element] for line in page.lines):
        bad = hard
    return [0 if bad[line.element] or choice else len(line.text) for line, choice in zip(page.lines, choices(page))]


def shifted(page: Page, weights: list[int]) -> list[float]:
    """Characters outside links of every line, less where article and main elements speak against it.

    Text within these elements and text outside are held against each other, that within counted ``TAGGED``
    times. Lines of the lighter side lose weight in proportion: beside an article a footer does not surge,
    and a teaser in an article element does not beside eight paragraphs without one.
    """
    plain = [weight and weight - line.linked for weight, line in zip(weights, page.lines)]
    tagged = [page.article[line.element] > 0 for line in page.lines]
    within = TAGGED * sum(w for w, t in zip(plain, tagged) if t)
    outside = sum(w for w, t in zip(plain, tagged) if not t)
    if not within or not outside:
        return plain
    return [w * min(1, within / outside if t else outside / within) for w, t in zip(plain, tagged)]


def surging(weights: list[float], window: int = WINDOW) -> list[int]:
    """Numbers of the lines that carry a surge: they lie in ``window`` lines whose weights add up to
    ``SURGE`` (half of the highest sum on pages of little text) and have their part of it themselves."""
    sums = [sum(weights[i : i + window]) for i in range(len(weights))]
    surge = min(SURGE, max(sums, default=0) / 2)
    covered = [max(sums[max(0, i - window + 1) : i + 1]) >= surge for i in range(len(weights))]
    return [i for i, weight in enumerate(weights) if weight and covered[i] and weight * window >= surge]


def distributed(page: Page, weights: list[int], window: int = WINDOW) -> list[bool]:
    """Lines of the article by the distribution of text that stands in no link.

    The lines of all surges belong to it, and those between two of them that are less than a window apart:
    what ends a stretch of the article, as an advert in its middle, does not end the article. Tags are
    evidence for short lines: where lines of an article or main element, or paragraphs, carry a surge, all that
    stands in this container belongs to the article (the paragraphs alone, where that is the whole page), but
    for a list before its first heading, paragraph or surge; headings right before it do too. A single line
    after the last of these containers is a footer, unless it is as long as the lines of the surges and does not
    begin with a copyright mark.
    """
    plain = shifted(page, weights)
    heavy = surging(plain, window)
    keep = [False] * len(plain)
    for i, following in zip(heavy, [*heavy[1:], len(plain) + window]):
        for k in range(i, following if following - i <= window else i + 1):
            keep[k] = plain[k] > 0 or k == i
    blocks = [page.block[line.element] for line in page.lines]
    within, alone = [0] * len(page.tags), set()
    for i in heavy:
        if article := page.article[page.lines[i].element]:
            within[article] = article
        elif page.tags[blocks[i]] in PROSE:
            parent = page.block[page.parent[blocks[i]]]
            if page.tags[parent] in ("", "html", "body"):
                alone.add((parent, page.tags[blocks[i]]))
            else:
                within[parent] = parent
    for e in range(1, len(page.tags)):
        within[e] = within[page.parent[e]] or within[e]
    kin, begun, surges = [], set(), set(heavy)
    for i, block in enumerate(blocks):
        container = within[block]
        if container and (i in surges or page.tags[block] != "li"):
            begun.add(container)
        kin.append(container in begun or (page.block[page.parent[block]], page.tags[block]) in alone)
    end = max((i for i, k in enumerate(kin) if k), default=len(kin))
    if len(after := [i for i in heavy if i > end]) == 1:
        least = min(2 * SURGE, median_low([plain[i] for i in heavy if i <= end]))
        keep[after[0]] = plain[after[0]] >= least and not RIGHTS.match(page.lines[after[0]].text)
    keep = [k or near and weight > 0 for k, near, weight in zip(keep, kin, weights)]
    for i in range(len(keep) - 1, -1, -1):
        if page.tags[blocks[i]] in HEADINGS and weights[i] and any(keep[i + 1 : i + window]):
            keep[i] = True
    return keep


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in order, joined by an empty line; empty if there is none.

    The distribution of text over the lines chooses on every page. Marks of boilerplate, links and article
    elements change what a line weighs, and containers of a surge bring the short lines of an article in.
    """
    found = parse(page or "")
    keep = distributed(found, weigh(found))
    return "\n\n".join(line.text for kept, line in zip(keep, found.lines) if kept)


def extract_pages(df: DataFrame) -> DataFrame:
    """``page_id``, ``url``, main text and its length of every row of ``df``, from the whole ``html``.

    NULL, empty and textless pages give an empty text. Broken markup is read as far as it goes: what is
    no tag is text. One row per row; other columns are not read. Each page is one pass over its markup.
    """
    ddl = "page_id bigint, url string, text string, n_chars bigint"

    def work(batch):
        found = [main_text(h) for h in batch.column("html").to_pylist()]
        return [batch.column("page_id"), batch.column("url"), found, [len(t) for t in found]]

    return map_slices(df.select("page_id", "url", "html"), lambda: work, ddl)
