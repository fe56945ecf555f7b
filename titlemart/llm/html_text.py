"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# every part is possessive and stops at the next "<", so a broken tag costs its own length once
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^<>]*+>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+')*+|[^<>]*+)>""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe textarea title svg math select".split())
PHRASE = set("a abbr acronym b bdi bdo big cite code data dfn em font i kbd label mark q s samp small span strike strong sub sup time tt u var".split())
NOT_TEXT = set("nav aside footer form button dialog menu object canvas audio video head".split())
SCOPE = {"article", "main"}
SELF_CLOSING = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}),
    "option": ({"option"}, {"select"}),
}
# a name counts if all parts of one whole token are boilerplate words, apart from words of place and form
NOT_TEXT_NAME = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscri\w+|"
    r"sidebar|side|rail|widgets?|menu|nav\w*|breadcrumbs?|pagination|pager|toolbar|masthead|header|footer|copyright|legal|"
    r"share|sharing|social|related|recommend\w*|search|login|signup",
    re.I,
)
DISCUSSION_NAME = re.compile(r"comments?|comment(?:list|area|section|thread|box|form|wrap)s?|replies|respond|disqus|discussion", re.I)
# names that no wrapper of an article has: they never hold it where something else speaks for one
CERTAIN_NAME = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|popup|modal|newsletter|subscri\w+|sidebar|breadcrumbs?|pagination|pager|"
    r"copyright|share|sharing|social|related|recommend\w*|search|login|signup|comment\w*|replies|respond|disqus|discussion",
    re.I,
)
FORM_NAME = re.compile(r"site|main|global|top|bottom|left|right|bar|box|links?|buttons?|icons?|list|form|body|item|\d+", re.I)
# words of form after a word of boilerplate, and of what readers comment on before one of discussion
AFTER_NAME = re.compile(r"posts?|content|area|section|wrap(?:per)?|container|inner|block|articles?|stories|thread|panel|module|group|row|col(?:umn)?|title|text|holder", re.I)
BEFORE_NAME = re.compile(r"post|article|story|page|user|reader|fb|facebook", re.I)
PART = re.compile(r"[_-]+|(?<=[a-z])(?=[A-Z])")
LARGE_SHARE = 0.5  # of the page's unlinked text: what a name cannot drop
ALL_BUT = 0.98  # the share that a discussion needs beside a heading, main part or article
SPOKEN = 60  # characters of unlinked paragraph text beside a heading that speak for an article
OUTWEIGHS = 4  # times such text that an element with a doubtful name must hold to be the article all the same
NAMED, CERTAIN, DISCUSSION = 1, 2, 3
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# a container of one of these with text is not a mere row of links
TEXT_TAGS = set("p li dt dd td th h1 h2 h3 h4 h5 h6 blockquote pre figcaption caption summary address".split())
LINK_BLOCKS = {"div", "section", "header", "center"}
NOT_TEXT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"}


class Page:
    """Block-level elements of one page in page order, with their pieces of text."""

    def __init__(self) -> None:
        self.tag, self.parent, self.dropped = ["#root"], [-1], [False]
        self.named = [0]  # has a class, id or role of boilerplate, or of a discussion
        self.pieces: list[tuple[int, str, bool]] = []  # node, text, inside a link; an empty text ends a block
        self.spans: list[list[int]] = []  # pieces of each phrase element with such a name
        self.tags, self.link_tags = [1], [0]

    def open(self, tag: str, parent: int, dropped: bool, named: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.dropped.append(dropped)
        self.named.append(named)
        self.tags.append(1)
        self.link_tags.append(0)
        self.pieces.append((parent, "", False))
        return len(self.tag) - 1


def _named(tag: str, attributes: str, in_article: bool = False) -> int:
    if tag in ("html", "body", "main") or "=" not in attributes:
        return 0
    for name, *values in ATTRIBUTE.findall(attributes):
        value = next(filter(None, values), "")
        if name.lower() == "role":
            if value.lower() in NOT_TEXT_ROLES:
                return NAMED
            continue
        for token in value.split():
            parts = [p for p in PART.split(token) if p and not FORM_NAME.fullmatch(p)]
            if len(parts) == 2 and BEFORE_NAME.fullmatch(parts[0]) and DISCUSSION_NAME.fullmatch(parts[1]):
                return DISCUSSION
            parts = [p for i, p in enumerate(parts) if not i or not AFTER_NAME.fullmatch(p)]
            if not parts or not all(DISCUSSION_NAME.fullmatch(p) or NOT_TEXT_NAME.fullmatch(p) for p in parts):
                continue
            if DISCUSSION_NAME.fullmatch(parts[0]):
                return DISCUSSION
            if tag != "article" and not (in_article and parts[0].lower() == "header"):
                return CERTAIN if any(CERTAIN_NAME.fullmatch(p) for p in parts) else NAMED
    return 0


def _spoken(page: Page, off: list[bool], own: list[int]) -> tuple[list[int], int]:
    """Paragraph text beside headings or in article elements, below each node, and in no named element at all.

    An article element counts by its paragraphs even without a heading; less than ``SPOKEN`` characters of one
    parent do not count.
    """
    n = len(page.tag)
    paragraphs, heads = [0] * n, [False] * n
    for i in range(1, n):
        up = page.parent[i]
        if not off[i] and page.tag[i] == "p":
            paragraphs[up] += own[i]
        heads[up] |= not off[i] and page.tag[i] in HEADINGS
    spoken = [t if t >= SPOKEN and (h or tag == "article") else 0 for t, h, tag in zip(paragraphs, heads, page.tag)]
    inside, outside = [bool(x) for x in page.named], 0
    for i in range(1, n):
        inside[i] = inside[i] or inside[page.parent[i]]
        outside += 0 if inside[i] or off[i] else spoken[i]
    for i in range(n - 1, 0, -1):
        spoken[page.parent[i]] += spoken[i]
    return spoken, outside


def _settle(page: Page) -> None:
    """Drop what lies in dropped elements, and named ones where nothing speaks for them.

    A name is a hint. It does not drop an element that holds a heading, a main part or an
    article (unless that is named itself), or over half of the page's unlinked text and four times what
    articles elsewhere hold. A discussion may be longer than the article, so beside such an element
    it must be all but the whole text. Where something outside speaks for an article (a heading beside paragraphs,
    or an article element, in no named element), certain names drop what they are on at any length, and
    doubtful ones unless it has a heading beside paragraphs itself and ``OUTWEIGHS`` times that text.
    """
    n = len(page.tag)
    off, own, holds = list(page.dropped), [0] * n, [0] * n
    for i in range(1, n):
        off[i] = off[i] or off[page.parent[i]]
    for node, text, linked in page.pieces:
        if not linked and not off[node]:
            own[node] += len(text.strip())
    for i, tag in enumerate(page.tag):
        holds[i] = int(not off[i] and (tag in ("h1", "main") or tag == "article" and not page.named[i]))
    size = list(own)
    for i in range(n - 1, 0, -1):
        size[page.parent[i]] += size[i]
        holds[page.parent[i]] += holds[i]
    around = [0] * n  # outermost article around a node
    for i in range(1, n):
        around[i] = around[page.parent[i]] or (i if page.tag[i] == "article" and holds[i] else 0)
    articles = sum(size[i] for i in range(1, n) if around[i] == i)
    spoken, outside = _spoken(page, off, own)
    for i in range(1, n):
        name = page.named[i]
        if name == DISCUSSION:
            stays = holds[i] or size[i] > (ALL_BUT if holds[0] else LARGE_SHARE) * size[0]
        else:
            stays = holds[i] or size[i] > LARGE_SHARE * size[0] and size[i] >= 4 * (articles - (size[around[i]] if around[i] else 0))
        if outside and not holds[i] and not around[i]:
            stays = stays and name == NAMED and spoken[i] >= OUTWEIGHS * outside
        page.dropped[i] = page.dropped[i] or page.dropped[page.parent[i]] or bool(name) and not stays
    gone = set()
    for span in page.spans:
        if sum(len(page.pieces[k][1].strip()) for k in span if not page.pieces[k][2]) <= LARGE_SHARE * size[0]:
            gone.update(span)
    if gone:
        page.pieces = [p for k, p in enumerate(page.pieces) if k not in gone]


def parse(source: str) -> Page:
    page, stack, links, at = Page(), [0], 0, 0
    opened: dict[str, list[int]] = {}  # places of open elements in the stack, by tag
    skipped: list[str] = []  # open phrase elements whose name says that they hold no text
    lowered = None
    end = len(source)

    def close_from(depth: int) -> None:
        while len(stack) > depth:
            opened[page.tag[stack.pop()]].pop()

    def last(tags: set[str]) -> int:
        return max((opened[t][-1] for t in tags if opened.get(t)), default=0)

    while at < end:
        match = TOKEN.search(source, at)
        text = source[at : match.start() if match else end]
        if text:
            if skipped:
                page.spans[-1].append(len(page.pieces))
            page.pieces.append((stack[-1], text, links > 0))
        if not match:
            break
        at = match.end()
        closing, tag, attributes = match.group(1), match.group(2), match.group(3)
        if not tag:
            continue
        tag = tag.lower()
        if tag in RAW and not closing:
            if not attributes.endswith("/") or tag not in ("svg", "math"):
                lowered = source.lower() if lowered is None else lowered
                close = lowered.find(f"</{tag}", at) if len(lowered) == end else source.find(f"</{tag}", at)
                at = end if close < 0 else close
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                page.pieces.append((stack[-1], " ", False) if tag == "br" else (stack[-1], "", False))
            page.tags[stack[-1]] += 1
        elif tag in PHRASE:
            page.tags[stack[-1]] += not closing
            if tag == "a":
                links = max(0, links - 1) if closing else 1
                page.link_tags[stack[-1]] += not closing
            if skipped:
                if tag == skipped[0]:
                    skipped.pop() if closing else skipped.append(tag)
            elif not closing and _named(tag, attributes):
                skipped.append(tag)
                page.spans.append([])
        elif closing:
            links, skipped = 0, []
            if depth := last({tag}):
                close_from(depth)
            page.pieces.append((stack[-1], "", False))
        else:
            links, skipped = 0, []
            if page.tag[stack[-1]] == "p":  # a paragraph ends where the next block begins
                close_from(len(stack) - 1)
            if tag in SELF_CLOSING:
                ends, within = SELF_CLOSING[tag]
                if (depth := last(ends)) > last(within):
                    close_from(depth)
            in_article = last(SCOPE) > 0
            named = _named(tag, attributes, in_article)
            opened.setdefault(tag, []).append(len(stack))
            stack.append(page.open(tag, stack[-1], tag in NOT_TEXT or tag == "header" and not in_article, named))
    _settle(page)
    return page


def _density(chars: int, tags: int, link_chars: int, link_tags: int, body_ratio: float) -> float:
    """Composite density: characters per tag, lowered where links hold many of them."""
    if not chars:
        return 0.0
    rest = max(chars - link_chars, 1)
    base = math.log(chars / rest * link_chars + body_ratio * chars + math.e)
    spread = chars / max(link_chars, 1) * tags / max(link_tags, 1)
    return chars / tags * math.log(max(spread, 1.0) + 1e-9) / base if base > 0 else 0.0


def _row_of_links(chars: int, link_chars: int, link_tags: int) -> bool:
    """Several links with no more than signs or a short label between them."""
    return link_tags > 1 and 2 * link_chars > chars and chars - link_chars <= 4 * link_tags


def main_text(source: str) -> str:
    """The article of a page, one line per block; empty if there is none.

    Block elements are the nodes; phrase markup belongs to its block. Elements that hold
    no article by their tag, class, id or role are left out first (a name is a hint: see ``_settle``). Then every node gets its composite
    density, the node whose children's densities sum highest is chosen, and the lowest
    density on its way up to the body is the threshold: neighbours on that way that
    reach it belong to the article too. A block inside that is below it and a mere row of links
    does not; paragraphs, list items and cells of links do. An article or main element around the choice is added whole, and so
    are articles elsewhere of half its size; tags never take anything away. Everything else inside
    stays, short blocks too.
    """
    page = parse(source)
    n = len(page.tag)
    chars, link_chars = [0] * n, [0] * n
    texts = []
    for node, text, linked in page.pieces:
        text = html.unescape(text) if "&" in text else text
        texts.append(text)
        if text and not page.dropped[node]:
            size = len(text.strip())
            chars[node] += size
            if linked:
                link_chars[node] += size
    tags, link_tags = [0 if d else t for t, d in zip(page.tags, page.dropped)], list(page.link_tags)
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        if not page.dropped[i]:
            for sums in (chars, link_chars, tags, link_tags):
                sums[up] += sums[i]
    if not chars[0]:
        return ""
    ratio = link_chars[0] / max(chars[0], 1)
    density = [0.0 if page.dropped[i] else _density(chars[i], max(tags[i], 1), link_chars[i], link_tags[i], ratio) for i in range(n)]
    sums = [0.0] * n
    leaf = [True] * n
    for i in range(1, n):
        sums[page.parent[i]] += density[i]
        leaf[page.parent[i]] = False
    sums = [density[i] if leaf[i] else sums[i] for i in range(n)]
    best = max(range(n), key=lambda i: (sums[i], -i))
    path = [best]
    while page.parent[path[-1]] >= 0 and page.tag[path[-1]] != "body":
        path.append(page.parent[path[-1]])
    threshold = min(density[i] for i in path)
    # an article or main element around the choice belongs to it whole; so does an article elsewhere of half its size
    bound = next((i for i in path if page.tag[i] in SCOPE), best)
    articles = [i for i in range(1, n) if page.tag[i] == "article" and not page.dropped[i] and 2 * chars[i] >= chars[best]]
    chosen, inside = {best, bound, *articles}, set(path)
    for i in range(1, n):
        if page.parent[i] in inside and i not in inside and density[i] >= threshold and 2 * link_chars[i] < chars[i]:
            chosen.add(i)
    in_text = [False] * n
    for i in range(1, n):
        in_text[i] = in_text[page.parent[i]] or page.tag[i] in TEXT_TAGS
    running = [page.tag[i] in TEXT_TAGS and chars[i] > 0 for i in range(n)]
    for i in range(n - 1, 0, -1):
        running[page.parent[i]] |= running[i]
    member = [False] * n
    for i in range(n):
        up = page.parent[i]
        linky = page.tag[i] in LINK_BLOCKS and not (running[i] or in_text[i]) and _row_of_links(chars[i], link_chars[i], link_tags[i]) and density[i] < threshold
        member[i] = not page.dropped[i] and (i in chosen or up >= 0 and member[up] and not linky)
    out, block = [], []
    for (node, _, _), text in zip(page.pieces, texts):
        if text:
            if member[node] or node in inside and node != 0 and len(text.strip()) >= max(threshold, 1):
                block.append(text)
        elif block:
            out.append(" ".join("".join(block).split()))
            block = []
    if block:
        out.append(" ".join("".join(block).split()))
    return "\n".join(filter(None, out))


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` of every row of ``pages(page_id, url, html)``; NULL html gives empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h or "") for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    ready = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return ready.mapInArrow(run, "page_id long, url string, text string")
