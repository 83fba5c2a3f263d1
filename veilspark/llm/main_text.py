"""Main text of web pages by tag-path ratios.

A page is read into blocks of text, each with the path of tags from the root to it. For
every path, the length of its text and its punctuation, over how many blocks share the path,
make two ratios; both are smoothed along the page and multiplied. Blocks above a threshold
show where the content is: the <article> or <main> with most of their text, else the innermost
container with nearly all of it. Its blocks are the main text, short ones too, and so are blocks
above the threshold outside it, with what stands in the same innermost container.

Menus, footers, scripts and the like, by their tags, are left out. Parts that a class, id or role names so, and
forms, are left out if the scores agree: one that holds most of the selected text is a wrapper of
the page and stays, unless it is named after comments. A name counts if all its words name parts or are
filler: `page-with-sidebar` says nothing.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from veilspark.llm.common import in_chunks

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s\"'>]++))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?。，、；：！？]")

# Names of HTML, and words that name parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed")}
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
CONTAINER = frozenset("article body center div html main section table tbody td".split())
SKIPPED = frozenset(
    "aside button canvas dialog footer head iframe input math menu nav noscript object option script select style"
    " svg template textarea title".split()
)
NEVER = frozenset("body html main".split())
PARTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " copyright disqus footer gdpr hidden legal login menu modal nav navbar navigation newsletter notice notification"
    " pager pagination popup promo promoted promotion recommended related replies reply share sharing sidebar signup skip"
    " social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Of these, what an <article> can be; its other class names say what it is about.
ASIDE = frozenset("ad ads advert advertisement comment comments promo related replies reply sponsored".split())
HEADS = frozenset("header masthead".split())
#: What readers write can be longer than what they read.
READERS = frozenset("comment comments disqus replies reply".split())
#: Elements of the text itself: these, and those within a line. All words of a class have to name a part.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTUAL = HEADINGS | frozenset("p section".split())
#: One-word ids that stand for a part outside articles, also of a section.
FRAME = ASIDE | HEADS | frozenset("banner breadcrumb breadcrumbs footer menu nav navbar navigation pager pagination sidebar toolbar".split())
#: Words that stand beside a part's name and don't say what a text is about.
FILLER = frozenset(
    "area articles bar block body bottom box btn button buttons center container content count entry form group icon icons"
    " inner item items label left link links list main media meta page post posts primary right row secondary section site"
    " slot text title toggle top unit wrap wrapper".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

SHARE = 0.9
HALF = 0.5
WINDOW = np.exp(-0.5 * np.arange(-2, 3) ** 2)


@dataclass
class Node:
    tag: str
    path: int
    parent: Node | None
    skipped: bool
    in_article: bool
    main: bool
    depth: int
    need: float = 0.0  # of a named part: its share, of its selected text and that in no part, that makes it a wrapper
    part: Node | None = None  # the innermost named part around it, itself included
    weight: float = 0.0
    inside: bool = False
    container: Node | None = None


@dataclass
class Page:
    """Blocks of a page in order, each with its node; all nodes, the outer before the inner."""

    texts: list[str] = field(default_factory=list)
    nodes: list[Node] = field(default_factory=list)
    tree: list[Node] = field(default_factory=list)


def _named_part(tag: str, name: str, word: str, above: Node) -> float:
    """The `need` of a part that a class or id names, 0 if it names none.

    An id is often made from a heading, so it counts for no heading, paragraph or element
    within a line, and for a section only if it is one word.
    """
    parts = [part.lower() for part in _WORD.findall(word)]
    if not parts or parts[0] in ("has", "no", "with", "is"):
        return 0.0
    textual = tag in TEXTUAL or tag not in BLOCK
    if name == "id" and textual:
        if tag != "section" or len(parts) > 1 or parts[0] not in (ASIDE if above.in_article else FRAME):
            return 0.0
    known = ASIDE if tag == "article" else PARTS if above.in_article or (textual and tag != "section") else PARTS | HEADS
    other = [part for part in parts if part not in known and not part.isdigit()]
    if other and len(parts[0]) <= 2 and other[0] == parts[0]:
        del other[0]  # a prefix as in js-menu
    if known.isdisjoint(parts) or not FILLER.issuperset(other):
        return 0.0
    return np.inf if not READERS.isdisjoint(parts) else HALF if other else SHARE


def _skips(tag: str, rest: str, above: Node) -> tuple[bool, bool, float]:
    """Whether an element is no content, whether it says that it is the main part, and its `need` as a named part."""
    if tag in SKIPPED or (tag == "header" and not above.in_article):
        return True, False, 0.0
    main, need = tag == "main", HALF if tag == "form" else 0.0
    if tag in NEVER or not rest.strip(" /"):
        return False, main, need
    for name, value in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'")
        if name == "role":
            main |= value.lower() == "main"
            if value.lower() in ROLES:
                need = max(need, HALF if value.lower() == "form" else SHARE)
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, False, 0.0
        elif name == "style":
            if "display:none" in value.replace(" ", "").lower():
                return True, False, 0.0
        elif name in ("class", "id"):
            need = max(need, *(_named_part(tag, name, word, above) for word in value.split()), 0.0)
    return False, main and not need, need


def read_page(source: str) -> Page:
    """The blocks of a page. Tags that aren't closed, or closed but not open, do no harm."""
    page, paths = Page(), {}
    root = Node("", 0, None, False, False, False, 0)
    stack, open_tags = [root], {}
    page.tree.append(root)
    parts: list[str] = []
    owner = root

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            page.texts.append(text)
            page.nodes.append(owner)

    def say(text: str) -> None:
        nonlocal owner
        if not stack[-1].skipped and text:
            if not parts:
                owner = stack[-1]
            parts.append(text)

    def pop() -> None:
        open_tags[stack.pop().tag] -= 1

    def close(tag: str) -> None:
        if open_tags.get(tag):
            while stack[-1].tag != tag:
                pop()
            pop()

    at, last = 0, source.rfind(">") + 1
    while match := _MARKUP.search(source, at, last):
        say(source[at : match.start()])
        at = match.end()
        tag = (match["tag"] or "").lower()
        if not tag:
            continue
        if tag in BLOCK:
            flush()
        if match["end"]:
            close(tag)
            continue
        if tag in BLOCK and tag not in ("br", "hr", "html", "head", "body") and open_tags.get("p"):
            inner = next((node.tag for node in reversed(stack) if node.tag == "p" or node.tag in CONTAINER), None)
            if inner == "p":
                close("p")
        if tag in CLOSES:
            same, upto = CLOSES[tag]
            open_ = next((node.tag for node in reversed(stack) if node.tag in same or node.tag in upto), None)
            if open_ in same:
                close(open_)
        if tag in VOID:
            continue
        above = stack[-1]
        skipped, main, need = (True, False, 0.0) if above.skipped else _skips(tag, match["rest"], above)
        path = paths.setdefault((above.path, tag), len(paths) + 1)
        if tag in RAW:
            end = RAW[tag].search(source, at)
            at = end.end() if end else len(source)
            last = max(last, at)
            continue
        node = Node(tag, path, above, skipped, above.in_article or main or tag == "article", main, above.depth + 1, need, above.part)
        node.part = node if need else above.part
        stack.append(node)
        page.tree.append(stack[-1])
        open_tags[tag] = open_tags.get(tag, 0) + 1
    say(source[at:])
    flush()
    return page


def path_scores(page: Page) -> np.ndarray:
    """For each block, the smoothed and multiplied text and punctuation ratios of its path."""
    paths = np.unique([node.path for node in page.nodes], return_inverse=True)[1]
    lengths = np.array([len(text) for text in page.texts], float)
    marks = np.array([len(_PUNCTUATION.findall(text)) for text in page.texts], float)
    shared = np.bincount(paths)
    ratios = (np.bincount(paths, lengths) / shared)[paths], (np.bincount(paths, marks) / shared)[paths]
    weight = np.convolve(np.ones(len(paths)), WINDOW, "full")[2:-2]
    text, mark = (np.convolve(ratio, WINDOW, "full")[2:-2] / weight for ratio in ratios)
    return text * (1 + mark)


def _selected(page: Page) -> np.ndarray:
    """Places of the blocks above the threshold."""
    found = path_scores(page)
    return np.flatnonzero(found >= min(found.std(), found.max()))


def _weigh(page: Page, places: np.ndarray) -> float:
    """Gives each node the length of these blocks within it; returns that of all."""
    for node in page.tree:
        node.weight = 0.0
    for place in places:
        page.nodes[place].weight += len(page.texts[place])
    for node in reversed(page.tree[1:]):
        node.parent.weight += node.weight
    return page.tree[0].weight


def _without_parts(page: Page) -> Page:
    """The page without the blocks in named parts, but for those that are wrappers of its text."""
    if not any(node.part for node in page.nodes):
        return page
    readers = {id(node) for node in page.tree if node.need == np.inf}
    for node in page.tree[1:]:
        if id(node.parent) in readers:
            readers.add(id(node))
    chosen = [place for place in _selected(page) if id(page.nodes[place]) not in readers]
    total = _weigh(page, chosen)
    holds = set()  # the nodes around an article or main part with most of the text
    for node in page.tree:
        if (node.tag == "article" or node.main) and not node.need and node.weight > HALF * total:
            while node and id(node) not in holds:
                holds.add(id(node))
                node = node.parent
    outside = sum(len(page.texts[place]) for place in chosen if not page.nodes[place].part)
    shut = set()
    for node in page.tree[1:]:
        most = node.weight >= HALF * total and node.weight >= node.need * (outside + node.weight)
        wraps = total and (most or id(node) in holds) and node.need < np.inf
        if id(node.parent) in shut or (node.need and not wraps):
            shut.add(id(node))
    kept = [place for place, node in enumerate(page.nodes) if id(node) not in shut]
    return Page([page.texts[place] for place in kept], [page.nodes[place] for place in kept], page.tree)


def main_text(source: str | None) -> str:
    """The main text of a page, its blocks joined by one space; empty if it has none."""
    page = _without_parts(read_page(source or ""))
    if not page.texts:
        return ""
    chosen = _selected(page)
    total = _weigh(page, chosen)
    named = [node for node in page.tree if (node.tag == "article" or node.main) and node.weight > total / 2]
    if named:
        held = max(named, key=lambda node: (node.weight, node.depth))
    else:
        inner = (node for node in page.tree if node.weight >= SHARE * total and (node.tag in CONTAINER or not node.parent))
        held = max(inner, key=lambda node: node.depth)
    held.inside = True
    around, node = set(), held
    while node:
        around.add(id(node))
        node = node.parent
    for node in page.tree[1:]:  # the innermost container, the outer nodes come first
        node.container = node if node.tag in CONTAINER else node.parent.container
    alone = set()
    for place in chosen:
        container = page.nodes[place].container
        if container and id(container) not in around:
            container.inside = True
        else:
            alone.add(place)
    for node in page.tree[1:]:
        node.inside |= node.parent.inside
    return " ".join(text for place, (text, node) in enumerate(zip(page.texts, page.nodes)) if node.inside or place in alone)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each row of `pages` (page_id, url, html).

    Null and empty pages, and pages without text, have an empty text. Nothing else is left out
    or cut, however long. Null ids and urls stay null, repeated rows give repeated results,
    other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in in_chunks(batches, "html"):
            texts = [main_text(source) for source in chunk.column("html").to_pylist()]
            columns = [chunk.column("page_id"), chunk.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
