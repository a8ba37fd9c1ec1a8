"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass looks at one block at a time. Blocks
of menus, notices and the like are bad, and so are those that are mostly links. Of the others, evidence
is added up: length, stop-word density, and whether an article element is around it; much of it
makes a block good, and short blocks and headings stay undecided. The second pass gives a heading the label
of what it introduces, and other undecided blocks that of the nearest decided neighbour. Blocks of
menus and notices are nobody's neighbours, and an article's blocks have theirs in the article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class BlockRules:
    long_chars: int = 140
    short_chars: int = 70
    stop_density: float = 0.2
    link_density: float = 0.5
    #: Evidence that makes a block good: of 1 for full length, 1 for full density and 1 for an article element.
    good: float = 1.5
    #: Evidence but for the element's with which a block is kept if none of its neighbours is decided, in an article and outside.
    lone: float = 0.005
    lone_outside: float = 0.3


# Frequent function words of the languages at hand.
STOP_WORDS = frozenset(
    """
    a an and are as at be by for from has he in is it its of on or that the this to was were will with
    aber als am auch auf aus bei das dass dem den der des die ein eine einer es für hat ich im in ist mit nicht sich sie
    sind über um und von vor war wie wird zu zum zur
    al como con de del el en es esta la las lo los más no o para pero por que se ser si sin su sus un una y
    au aux avec ce ces cette dans des du elle est et il ils je le les leur mais ne nous ont ou par pas plus pour qu que
    qui sa se ses son sont sur une vous
    """.split()
)

_HIDDEN = {"script", "style", "noscript", "template", "head", "title", "svg", "math", "iframe", "object", "textarea", "select", "button", "canvas", "audio", "video"}
#: Their content is text in which no tag counts.
_RAW = {"script", "style", "textarea", "title", "iframe", "noscript"}
_BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend",
    "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_CONTAINERS = _HIDDEN | {"article", "aside", "blockquote", "body", "center", "details", "dialog", "div", "dl", "fieldset", "figure", "footer", "form", "header", "html", "main", "menu", "nav", "ol", "section", "table", "td", "th", "tr", "ul"}
_BOILERPLATE = {"nav", "footer", "aside", "form", "menu", "dialog", "header"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
def _marker(words: str) -> re.Pattern[str]:
    return re.compile(rf"(?:^|[\s_-])(?:{words})(?:$|[\s_-])", re.IGNORECASE)


# Words in class, id or role that mark what does not belong to an article; the second set
# does so only outside articles, whose own parts use such names too.
_MARKED = _marker(
    "ads?|adverts?|advertisements?|advertising|adsbygoogle|sponsor(?:ed)?|promo|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|"
    "comments?|commentlist|usercomments|respond|replies|reply|disqus|sidebar|widget|related|recommended|share|sharing|social|newsletter|subscribe|"
    "menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|footer|complementary|contentinfo"
)
_MARKED_OUTSIDE = _marker("header|masthead|side|toolbar|search|skip|copyright|legal|signup|login")
# Names and values in turn, so that words inside other values and names don't count.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    link_chars: int
    boilerplate: bool
    article: int
    heading: bool
    label: bool | None = None


@dataclass
class _Open:
    tag: str
    marked: bool
    boilerplate: bool
    article: int
    hidden: bool


@dataclass
class _Page:
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=lambda: [_Open("", False, False, 0, False)])
    parts: list[str] = field(default_factory=list)
    link_parts: list[str] = field(default_factory=list)
    in_link: bool = False
    heading: bool = False
    articles: int = 0
    title: str | None = None

    def flush(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            top = self.stack[-1]
            links = len(" ".join(html.unescape("".join(self.link_parts)).split()))
            self.blocks.append(Block(text, links, top.boilerplate, top.article, self.heading))
        self.parts, self.link_parts, self.heading = [], [], False

    def open(self, name: str, attributes: str) -> None:
        top = self.stack[-1]
        marked, hidden = False, name in _HIDDEN
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id", "role"):
                if name in ("article", "main"):
                    marked |= bool(re.search(r"comment|reply", value, re.IGNORECASE))
                elif name not in ("html", "body"):
                    marked |= bool(_MARKED.search(value)) or (not top.article and bool(_MARKED_OUTSIDE.search(value)))
            elif key == "style":
                hidden |= "display:none" in value.replace(" ", "").lower()
            elif key == "hidden" or key == "aria-hidden":
                hidden |= key == "hidden" or value.lower() == "true"
        boilerplate, article = top.boilerplate or marked, top.article
        if name in ("article", "main") and not marked and not any(x.tag == "article" for x in self.stack):
            # An article is no part of a menu or page header that was never closed.
            boilerplate = any(x.marked for x in self.stack)
            self.articles += 1
            article = self.articles
        elif name in _BOILERPLATE and not (name == "header" and article):
            boilerplate = True
        self.stack.append(_Open(name, marked, boilerplate, article, top.hidden or hidden))

    def close(self, name: str) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == name:
                del self.stack[k:]
                return


def blocks_of(page: str) -> list[Block]:
    """Blocks in page order, not yet labelled."""
    return scan(page)[1]


def scan(page: str) -> tuple[str, list[Block]]:
    """The title as written (the first one closed, not that of a drawing or template) and the blocks in page order."""
    out, at = _Page(), 0
    lower: str | None = None
    while True:
        tag = page.find("<", at)
        text = page[at:] if tag < 0 else page[at:tag]
        if text and not out.stack[-1].hidden:
            out.parts.append(text)
            if out.in_link:
                out.link_parts.append(text)
        if tag < 0:
            break
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), tag):
            end = page.find(">", tag)
            at = len(page) if end < 0 else end + 1
            continue
        found = _NAME.match(page, tag + 1)
        if not found:
            if not out.stack[-1].hidden:
                out.parts.append("<")
            at = tag + 1
            continue
        end = _tag_end(page, found.end())
        name, attributes = found[0].lower(), page[found.end() : end]
        at = min(end + 1, len(page))
        closing, name = name.startswith("/"), name.lstrip("/")
        if name in _BLOCKS:
            out.flush()
        elif name in ("br", "img", "input"):
            out.parts.append(" ")
        if name == "a":
            out.in_link = not closing
        elif closing:
            if name in _CONTAINERS:
                out.close(name)
        elif name in _RAW:
            lower = page.lower() if lower is None else lower
            end = lower.find("</" + name, at) if len(lower) == len(page) else page.find("</" + name, at)
            if name == "title" and end >= 0 and out.title is None and not any(x.tag in ("svg", "math", "template") for x in out.stack):
                out.title = page[at:end]
            close = len(page) if end < 0 else page.find(">", end)
            at = len(page) if close < 0 else close + (close < len(page))
        elif name in _CONTAINERS and name not in _VOID:
            out.open(name, attributes)
        elif name[:1] == "h" and name[1:].isdigit():
            out.heading = True
        if name == "body" and not closing:
            # What the head left open ends here.
            out.stack = [x for x in out.stack if not x.hidden]
    out.flush()
    return out.title or "", out.blocks


def _tag_end(page: str, at: int) -> int:
    """Place of the > that ends a tag; those inside quotes do not."""
    while True:
        end = page.find(">", at)
        if end < 0:
            return len(page)
        quote = min((q for q in (page.find('"', at, end), page.find("'", at, end)) if q >= 0), default=-1)
        if quote < 0:
            return end
        close = page.find(page[quote], quote + 1)
        if close < 0:
            return end
        at = close + 1


def _first_pass(b: Block, rules: BlockRules) -> tuple[float, bool | None]:
    """(evidence, label) of one block, whatever stands around it."""
    words = _WORD.findall(b.text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    evidence = min(1.0, len(b.text) / max(rules.long_chars, 1)) + (min(1.0, stops / rules.stop_density) if rules.stop_density > 0 else 1.0)
    evidence += bool(b.article)
    if b.boilerplate or (b.link_chars > rules.link_density * len(b.text) and not b.article):
        return evidence, False
    if b.heading or len(b.text) < rules.short_chars or b.link_chars > rules.link_density * len(b.text):
        return evidence, None
    if evidence >= rules.good:
        return evidence, True
    # A long text without a single stop word is a list or a code.
    return evidence, False if len(b.text) >= rules.long_chars and not stops and not b.article else None


def _nearest(blocks: list[Block], order: range) -> list[int]:
    """For every block the last decided one before it in `order`, of the same article; -1 where there is none."""
    found, last = [-1] * len(blocks), {}
    for k in order:
        found[k] = last.get(blocks[k].article, -1)
        if blocks[k].label is not None and not blocks[k].boilerplate:
            last[blocks[k].article] = k
    return found


def label(blocks: list[Block], rules: BlockRules = BlockRules()) -> None:
    """Set every block's label: True for main text."""
    evidence = []
    for b in blocks:
        known, b.label = _first_pass(b, rules)
        evidence.append(known)
    before, after = _nearest(blocks, range(len(blocks))), _nearest(blocks, range(len(blocks) - 1, -1, -1))
    single = sum(not b.boilerplate for b in blocks) == 1
    decided = []
    for k, b in enumerate(blocks):
        left, right = before[k], after[k]
        if b.label is not None:
            decided.append(b.label)
        elif left < 0 and right < 0:
            least = 1 + rules.lone if b.article else rules.lone_outside
            decided.append(evidence[k] >= least or (single and not b.link_chars))
        elif left < 0 or right < 0 or b.heading:
            decided.append(bool(blocks[right if right >= 0 else left].label))
        elif k - left == right - k:
            decided.append(bool(blocks[left].label and blocks[right].label))
        else:
            decided.append(bool(blocks[left if k - left < right - k else right].label))
    for b, keep in zip(blocks, decided, strict=True):
        b.label = keep


def main_text(page: str | None, rules: BlockRules = BlockRules()) -> str:
    """Good blocks in page order, one per line; empty for null, empty and text-less pages."""
    if not page:
        return ""
    blocks = blocks_of(page)
    label(blocks, rules)
    return "\n".join(b.text for b in blocks if b.label)


def extract(pages: DataFrame, rules: BlockRules = BlockRules()) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page.

    Input: page_id, url and html; other columns are not read. Null and empty pages give an
    empty text. Null ids and urls and repeated rows pass through, one row out for each row in;
    an empty table gives an empty result. Whole pages are read. An undecided block between a
    good and a bad one at equal distance is bad, but a heading goes with what follows it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, rules) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")
