"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element. The text lengths of
windows of lines next to each other are summed; the main text runs from the
line where the sums surge to the line after which they dive. Lines that markup
names as something else (menus, adverts, forms, comments) count as empty,
unless nothing surges without them, and the text of links does not count, so
menus without a name do not surge. Where a page marks its article,
the marks are a bonus: the lines inside count whole and those outside do not,
unless a surge outside is larger, and then lengths alone decide.
"""

import html
import re
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.llm.batches import map_text

# Lines in a window, and the text in one that may be a surge: a share of the page's largest, CALM at most.
LINES = 3
SHARE = 0.2
CALM = 120
# Nested elements that are put back one within the other; after these, what is put back is so with all in it.
ROUNDS = 8

# Fixed values of HTML: elements whose content is code, and those whose content is no text of the page.
CODE = "script|style"
RAW = "noscript|template|textarea|iframe|svg|title|select|noembed|noframes"
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead tr ul xmp".split()
)
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav aside footer form menu dialog button head search".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
ASIDE_NAMES = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar sidebars aside footer masthead banner ad ads adv advert "
    "adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login search share sharing social related "
    "recommended recommendations comment comments commentlist disqus reply replies respond responses pagination pager "
    "widget widgets toolbar topbar skip disclaimer copyright form".split()
)
# Words that make a compound of such names: `site-footer`, `post-comments`, `ad-slot-2`; with any other word a name says nothing.
BEFORE_NAMES = frozenset("site page global main top bottom left right primary secondary sticky fixed mobile desktop post article entry user".split())
AFTER_NAMES = frozenset(
    "bar box block container wrapper wrap list links link item items button buttons icon icons slot unit area inner outer top bottom left "
    "right primary secondary posts articles stories thread trail law info media".split()
)
# Names that also say what stands beside an element: one with such a name only is kept if it holds the article.
LAYOUT = frozenset("nav navbar navigation menu menubar sidebar sidebars aside footer banner ad ads widget widgets search form".split())
LAYOUT_TAGS = frozenset("form search header".split())
KEPT = frozenset("html body article main".split())
TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<code>{CODE})\b[^>]*>.*?(?:</(?P=code)\b[^>]*>|\Z)|<!\[CDATA\[.*?\]\]>"
    # Closed by itself, or by its end tag ahead of the next one of its kind; else it is a tag like any other.
    rf"|<(?P<raw>{RAW})\b(?:[^>]*/>|[^>]*>(?:(?!<(?P=raw)\b).)*?</(?P=raw)\b[^>]*>)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
UNSEEN = frozenset([("display", "none"), ("visibility", "hidden")])
NAME_PART = re.compile(r"[^a-z0-9]+")
SPACE = re.compile(r"\s+")


def _is_hidden(attributes: dict[str, str]) -> bool:
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip() == "true":
        return True
    declared = (part.partition(":") for part in attributes.get("style", "").split(";"))
    return any((key.strip(), value.replace("!important", "").strip()) in UNSEEN for key, _, value in declared)


def _aside_names(value: str) -> set[str]:
    """The names of something else among the classes or in the id: whole ones, and compounds of nothing but such names."""
    found = set()
    for token in value.split():
        parts = [part for part in NAME_PART.split(token) if part]
        names = ASIDE_NAMES.intersection(parts)
        if not names:
            continue
        first = next(i for i, part in enumerate(parts) if part in ASIDE_NAMES)
        after = (part in ASIDE_NAMES or part in AFTER_NAMES or part.isdigit() for part in parts[first:])
        if BEFORE_NAMES.issuperset(parts[:first]) and all(after):
            found |= names
    return found


def _is_aside(name: str, rest: str, in_article: bool, holds_article: bool, holds_main: bool) -> bool:
    attributes: dict[str, str] = {}
    for key, *values in ATTRIBUTE.findall(rest or ""):
        attributes.setdefault(key.lower(), next((v for v in values if v), "").lower())
    if _is_hidden(attributes):
        return name not in KEPT
    if holds_main:
        return False
    if name in ASIDE or name == "header" and not in_article:
        return not (holds_article and name in LAYOUT_TAGS)
    if attributes.get("role", "").strip() in ASIDE_ROLES and name not in KEPT:
        return True
    if name in ("html", "body", "main"):
        return False
    names = _aside_names(attributes.get("class", "")) | _aside_names(attributes.get("id", ""))
    return bool(names) and not (holds_article and names <= LAYOUT)


class _Lines:
    """The blocks of a page in order: their text, the length outside links, whether it stands in the article."""

    def __init__(self) -> None:
        self.texts: list[str] = []
        self.weights: list[int] = []
        self.inside: list[bool] = []
        self.cut: list[tuple[int, int, int]] = []  # of what is something else: start of its tag, start and end of its content
        self.parts: list[str] = []
        self.linked = 0

    def end(self, inside: bool) -> None:
        if self.parts:
            text = SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
            if text:
                self.texts.append(text)
                self.weights.append(max(0, len(text) - self.linked))
                self.inside.append(inside)
            self.parts, self.linked = [], 0

    def gap(self) -> None:
        """A part of the page that is something else, as a line without text."""
        self.texts.append("")
        self.weights.append(0)
        self.inside.append(False)


def _closings(tags: list[re.Match]) -> dict[int, int]:
    """For each start tag, the place of its end tag among the tags; tags that never end have none."""
    open_: dict[str, list[int]] = {}
    found: dict[int, int] = {}
    for i, tag in enumerate(tags):
        name = tag["name"]
        if name:
            name = name.lower()
            if not tag["close"]:
                open_.setdefault(name, []).append(i)
            elif open_.get(name):
                found[open_[name].pop()] = i
    return found


def _lines(page: str, kept: set[int] | None = None) -> _Lines:
    """The lines of a page. Elements whose tags start in `kept` are not cut; without it, none is."""
    lines = _Lines()
    tags = list(TAG.finditer(page))
    ends = _closings(tags)
    articles: list[int] = []  # places of the end tags of open articles
    named = [(i, (tag["name"] or "").lower()) for i, tag in enumerate(tags) if not tag["close"]]
    starts = [i for i, name in named if name in ("article", "main")]
    mains = [i for i, name in named if name == "main"]
    at, i, in_link = 0, 0, False

    def add(text: str) -> None:
        if text:
            lines.parts.append(text)
            if in_link:
                lines.linked += len(SPACE.sub(" ", html.unescape(text)))

    while i < len(tags):
        tag = tags[i]
        add(page[at : tag.start()])
        at = tag.end()
        while articles and articles[-1] <= i:
            lines.end(True)
            articles.pop()
        name = (tag["name"] or "").lower()
        if name and not tag["close"]:
            end = ends.get(i, i)
            holds, holds_main = (bisect_right(found, i) < bisect_right(found, end) for found in (starts, mains))
            may_go = kept is not None and name not in EMPTY and end > i and tag.start() not in kept
            if may_go and _is_aside(name, tag["rest"], bool(articles), holds, holds_main):
                lines.end(bool(articles))
                lines.gap()
                lines.cut.append((tag.start(), tag.end(), tags[end].start()))
                i = end
                at = tags[i].end()
            elif name in ("article", "main"):
                lines.end(bool(articles))
                articles.append(ends.get(i, len(tags)))
            elif name in BLOCKS:
                lines.end(bool(articles))
        elif name in BLOCKS:
            lines.end(bool(articles))
        if name == "a":
            in_link = not tag["close"]
        elif name in ("br", "hr", "img", "wbr") and name == "br":
            lines.parts.append(" ")
        i += 1
    add(page[at:])
    lines.end(bool(articles))
    return lines


def _sums(weights: list[int]) -> list[int]:
    return [sum(weights[max(0, i - LINES + 1) : i + 1]) for i in range(len(weights) + LINES - 1)]


def _page_lines(page: str) -> _Lines:
    """The lines of a page; where nothing surges without what was cut, what surges in itself is put back, outermost first."""
    kept: set[int] = set()
    for _ in range(ROUNDS):
        lines = _lines(page, kept)
        largest = max(_sums(lines.weights), default=0)
        if largest > CALM or not lines.cut:
            return lines
        own = {start: max(_sums(_lines(page[first:last]).weights), default=0) for start, first, last in lines.cut}
        surging = {start for start, total in own.items() if total > CALM}
        if not surging or largest > SHARE * max(own.values()):
            return lines
        kept |= surging
    spans = [(first, last) for start, first, last in lines.cut if start in surging]
    inner = {tag.start() for tag in TAG.finditer(page) if any(first <= tag.start() < last for first, last in spans)}
    return _lines(page, kept | inner)


def _surge(weights: list[int]) -> tuple[int, int]:
    """The largest window, and the most text of lines on end that lie in windows that surge."""
    sums = _sums(weights)
    largest = max(sums, default=0)
    level = min(CALM, SHARE * largest)
    most = total = 0
    for weight, high in zip(weights, (any(s > level for s in sums[i : i + LINES]) for i in range(len(weights))), strict=False):
        total = total + weight if high else 0
        most = max(most, total)
    return largest, most


def _mark_decides(lines: _Lines) -> bool:
    """Whether the surge of the marked lines, with a bonus of CALM, is at least that of the others, in height and in text."""
    if not any(lines.inside):
        return False
    inside = _surge([w if i else 0 for w, i in zip(lines.weights, lines.inside, strict=True)])
    outside = _surge([0 if i else w for w, i in zip(lines.weights, lines.inside, strict=True)])
    return all(own + CALM >= other for own, other in zip(inside, outside, strict=True))


def main_text(page: str | None) -> str:
    """The main text of a page: its blocks, joined by line breaks; empty for a page without any."""
    if not page:
        return ""
    lines = _page_lines(page)
    marked = _mark_decides(lines)
    # A line of the marked region has a bonus with which it surges; the lines outside it are no part of the main text.
    weights = [(w + CALM + 1 if i else 0) if marked else w for w, i in zip(lines.weights, lines.inside, strict=True)]
    sums = _sums(weights)
    largest = max(sums, default=0)
    if not largest:
        return ""
    level = min(CALM, SHARE * largest)
    high = [i for i, total in enumerate(sums) if total > level]
    first, last = max(0, high[0] - LINES + 1), min(len(weights) - 1, high[-1])
    # Of the first and last window, only what counts: a window reaches over lines before the surge.
    while not weights[first]:
        first += 1
    while not weights[last]:
        last -= 1
    chosen = range(first, last + 1)
    return "\n".join(lines.texts[i] for i in chosen if lines.texts[i] and (lines.inside[i] or not marked))


def extract_text(pages: DataFrame, page: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns, `text` and `n_chars` (its code points) of every page.

    A NULL or empty page, and one without text, gives an empty text. Scripts
    and styles reach to their end tag or the end of the page; other elements
    without text of the page (frames, drawings, lists of choices) to their end
    tag, and one that is closed by itself or never holds nothing. Other
    unclosed tags are taken as they stand; markup cut off at the end is no text.
    Repeated rows are all returned; an empty table gives no rows.
    """
    read = map_text(pages, page, list(keep), "text string", lambda: lambda found: [[main_text(p) for p in found]])
    return read.withColumn("n_chars", F.length("text").cast("bigint"))
