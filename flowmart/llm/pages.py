"""Main text of HTML pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass looks at each block alone: blocks of menus, page headers,
footers, sidebars, notices, adverts, forms and reader comments (by element, role, class or id) are boilerplate, and so
are blocks that are mostly links or short ones that state a copyright (what a class or id hints never covers an article
or main, reader comments and related articles behind the text excepted, and where the page is left without text the hints are
tried without, as far as the blocks under them are long text); long blocks with many stop words are text; the rest is left open,
as short blocks are. On a page that marks its article, what is outside is boilerplate and every block inside that is long
enough is text, whatever its stop words. The second pass gives open blocks the label of their nearest decided neighbours:
text if both sides (or the only side) are text, by stop words if they differ; headings follow the block after them. Where
the stop words of the language are not known, length and the share of links decide alone. If nothing is text, the paragraphs that
are no boilerplate are. What stands inside a link counts as linked, also through block tags in it, and hidden elements
(also by their style) are boilerplate.

Scripts, styles, comments and the elements of the head never become blocks; the end tag of the head may be missing. Character references are decoded, white space inside a block
becomes one space, blocks are joined by an empty line in page order. NULL pages count as empty, their text is empty.
Rows are independent: repeated rows give repeated results, an empty table an empty one. Extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm.quality import LATIN, OTHER_LETTERS, OTHER_STOP_WORDS, OWN_LATIN, STOP_WORDS

SHORT = 70
LONG = 200
LINK_DENSITY = 0.5
STOP_HIGH = 0.32
STOP_LOW = 0.2

# Elements of HTML by role.
_RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|textarea|select|title|audio|video"
_BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINER = _BLOCK - set("p hr h1 h2 h3 h4 h5 h6".split())
_SIDE = set("nav aside footer form button dialog menu search fieldset".split())
_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
_HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|widget|menu|nav|navbar|navigation|"
    r"breadcrumbs?|footer|header|masthead|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|"
    r"subscription|share|sharing|social|related|recommended|comments?|commentlist|disqus|replies|respond|reply|login|"
    r"signup|signin|search|pagination|pager|toolbar|copyright|disclaimer)(?:$|[\s_-])"
)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<({_RAW})(?=[\s/>])(?:(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>",
    re.S | re.I,
)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in _RAW.split("|")}
# Matches follow each other through the attributes, so the words of a value are never taken for names.
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s>/=]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
# Classes that tell how a page is laid out, whatever part of the page they name.
_LAYOUT = re.compile(r"^(?:has|no|with|without)[_-]|^elementor|side[_-]by[_-]side|content[_-]sidebar|sidebar[_-]content")
# Hints of what stands in articles of its own behind the article of the page.
_BEHIND = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|replies|respond|reply|related|recommended)(?:$|[\s_-])")
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)")
_HINTED, _HINTED_BEHIND, _SURE = 1, 2, 3
_SPACE = re.compile(r"\s+")
_COPYRIGHT = re.compile(r"^\s*(?:©|\(c\)|copyright\b)", re.I)
_STOPS = frozenset(STOP_WORDS)
_OTHER_STOPS = frozenset(OTHER_STOP_WORDS)
_LETTER = re.compile(r"[^\W\d_]")
_LATIN_LETTER = re.compile(f"[{LATIN}]")
_OTHER_LETTER = re.compile(f"(?![{OWN_LATIN}])[{LATIN}]")


@dataclass
class Block:
    """side: inside boilerplate, see _aside; article: inside a marked article; heading: an h1 to h6; paragraph: a p."""

    side: int
    article: bool
    heading: bool
    paragraph: bool = False
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    good: bool | None = None
    foreign: bool = False  # in a language whose stop words are not known


def _hints(value: str) -> str:
    """The names of a class or id that hint at boilerplate."""
    return " ".join(name for name in value.split() if _HINT.search(name) and not _LAYOUT.search(name))


def _aside(tag: str, attributes: str, in_article: bool, holds: bool, told: bool) -> int:
    """Whether an element is boilerplate: _SURE, as a class or id hints (_HINTED, _HINTED_BEHIND), or not at all (0).
    holds: it is or contains an article or main; told: a long text of an article came before."""
    # Some pages are one form as a whole.
    if tag in _SIDE and not (tag == "form" and holds) or tag == "header" and not in_article:
        return _SURE
    hinted = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value):
            return _SURE
        if name == "role" and value in _ROLES:
            return _SURE
        # A page may hang its layout on all that is around its text; such a class says nothing about the text inside.
        if name in ("class", "id") and tag not in ("html", "body", "main"):
            hints = _hints(value)
            behind = bool(_BEHIND.search(hints))
            if hints and (not holds or told and behind):
                hinted = max(hinted, _HINTED_BEHIND if behind else _HINTED)
    return hinted


def _tokens(page: str) -> Iterator[tuple[int, int, re.Match]]:
    """Start, end and match of every tag and of all that is no text. A raw element goes up to its end tag. One without
    is its start tag alone, as a self-closed svg or math is; a script or style goes to the end of the page, as in HTML."""
    at = 0
    endless: set[str] = set()
    while token := _TOKEN.search(page, at):
        at, raw = token.end(), (token.group(1) or "").lower()
        if raw and not (raw in ("svg", "math") and token.group().endswith("/>")):
            end = None if raw in endless else _RAW_END[raw].search(page, at)
            if end:
                at = end.end()
            elif raw in ("script", "style"):
                at = len(page)
            else:
                endless.add(raw)  # there is none further on either
        yield token.start(), at, token


def _close_up_to(tag: str, stack: list[tuple], open_tags: Counter[str]) -> None:
    """Closes the innermost element of a tag and all inside it; an end tag without a start closes nothing."""
    while open_tags[tag]:
        name = stack.pop()[0]
        open_tags[name] -= 1
        if name == tag:
            break


def _ended_links(tokens: list[tuple[int, int, re.Match]]) -> set[int]:
    """Places of the start tags of links that have an end tag before the next link."""
    found, last = set(), None
    for place, (_, _, token) in enumerate(tokens):
        if (token.group(3) or "").lower() == "a":
            if token.group(2) and last is not None:
                found.add(last)
            last = None if token.group(2) else place
    return found


def _holding(tokens: list[tuple[int, int, re.Match]]) -> set[int]:
    """Places of the start tags of containers that are or contain an article or main."""
    found: set[int] = set()
    stack: list[tuple[str, int]] = []
    open_tags: Counter[str] = Counter()
    for place, (_, _, token) in enumerate(tokens):
        tag = (token.group(3) or "").lower()
        if tag not in _CONTAINER:
            continue
        if token.group(2):
            _close_up_to(tag, stack, open_tags)
        elif not token.group(4).endswith("/"):
            stack.append((tag, place))
            open_tags[tag] += 1
            if tag in ("article", "main"):
                # Whatever is open below a container that was found has been found with it.
                for _, around in reversed(stack):
                    if around in found:
                        break
                    found.add(around)
    return found


def blocks(page: str) -> list[Block]:
    """All blocks with text, in page order."""
    found: list[Block] = []
    stack: list[tuple[str, int, bool]] = []  # open containers: tag, boilerplate, article
    open_tags: Counter[str] = Counter()
    links, at, side, article, heading, paragraph, told = 0, 0, 0, False, False, False, False
    current = Block(0, False, False)

    def close() -> None:
        nonlocal current, told
        text = _SPACE.sub(" ", html.unescape("".join(current.parts))).strip()
        if text:
            current.text = text
            found.append(current)
            told = told or current.article and not current.side and len(text) >= LONG
        current = Block(side, article, heading, paragraph)

    def add(text: str) -> None:
        if text:
            current.parts.append(text)
            if links:
                current.linked += len(_SPACE.sub(" ", text).strip())

    tokens = list(_tokens(page))
    holding, ended = _holding(tokens), _ended_links(tokens)
    for place, (start, end, token) in enumerate(tokens):
        add(page[at:start])
        at = end
        tag = (token.group(3) or "").lower()
        if not tag:
            continue
        if tag == "a":
            # A link without an end is one up to the next block tag only.
            links = 0 if token.group(2) else 2 if place in ended else 1
        elif tag == "br":
            current.parts.append(" ")
        elif tag in _BLOCK:
            if token.group(2):
                _close_up_to(tag, stack, open_tags)
            elif tag in _CONTAINER and not token.group(4).endswith("/"):
                inherited = stack[-1][1:] if stack else (0, False)
                inside = inherited[1] or tag in ("article", "main")
                close()
                aside = max(inherited[0], _aside(tag, token.group(4), inherited[1], place in holding, told))
                stack.append((tag, aside, inside))
                open_tags[tag] += 1
            side, article = stack[-1][1:] if stack else (0, False)
            heading = not token.group(2) and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
            paragraph = not token.group(2) and tag == "p"
            links = links if links == 2 else 0
            close()
    add(page[at:])
    close()
    return found


def _stop_density(text: str, stops: frozenset[str] = _STOPS) -> float:
    words = [w.strip(".,;:!?\"'()#*$%&|<>") for w in text.lower().split()]
    return sum(w in stops for w in words) / len(words) if words else 0.0


def _foreign(text: str) -> bool:
    """Mostly in another script, with letters of other alphabets, or with more function words of other languages."""
    density = _stop_density(text)
    if density >= STOP_LOW:
        return False
    latin = len(_LATIN_LETTER.findall(text))
    if len(_LETTER.findall(text)) > 2 * latin or len(_OTHER_LETTER.findall(text)) > OTHER_LETTERS * latin:
        return True
    return _stop_density(text, _OTHER_STOPS) > max(density, STOP_LOW / 2)


def _mark_foreign(found: list[Block], sides: int) -> None:
    """A block is foreign by itself, or as a part of a page that is."""
    open_ = [b for b in found if b.side < sides and b.linked <= LINK_DENSITY * len(b.text)]
    page = _foreign(" ".join(b.text for b in open_))
    for block in open_:
        block.foreign = (page and _stop_density(block.text) < STOP_LOW) or _foreign(block.text)


def _linked_or_legal(block: Block) -> bool:
    """Mostly links, or a short note of copyright."""
    if block.linked > LINK_DENSITY * len(block.text):
        return True
    short = len(block.text) < SHORT or len(block.text) < LONG and _stop_density(block.text) < STOP_LOW
    return bool(short and _COPYRIGHT.match(block.text))


def _first_pass(block: Block, marked: bool, sides: int) -> bool | None:
    if block.side >= sides or marked and not block.article or _linked_or_legal(block):
        return False
    if len(block.text) < SHORT or block.heading:
        return None
    if marked:
        return True
    if block.foreign:
        return True if len(block.text) >= LONG else None
    density = _stop_density(block.text)
    if len(block.text) >= LONG and density >= STOP_LOW or density >= STOP_HIGH:
        return True
    return None if density >= STOP_LOW else False


def main_text(page: str) -> str:
    """The text blocks of a page, joined by an empty line."""
    found = blocks(page)
    good = _second_pass(found, _HINTED)
    # A class may hint at boilerplate on what is all the text of the page; then its long blocks count.
    for sides in (_HINTED_BEHIND, _SURE):
        if not good and any(0 < b.side < sides for b in found):
            tried = _second_pass(found, sides)
            good = tried if sum(len(b.text) for b in tried) >= 2 * LONG else []
    if not good:
        good = [b for b in found if not b.side and b.paragraph and not _linked_or_legal(b)]
    return "\n\n".join(b.text for b in good)


def _second_pass(found: list[Block], sides: int) -> list[Block]:
    """The blocks that are text, where blocks from this degree of `side` on are boilerplate."""
    marked = any(b.article and b.side < sides for b in found)
    if not marked:
        _mark_foreign(found, sides)
    for block in found:
        block.good = _first_pass(block, marked, sides)
    labels = [b.good for b in found]
    before, after = [], [None] * len(found)
    # Within a marked article the neighbours are those of the article: what is outside has been decided.
    counts = [not marked or b.article and b.side < sides for b in found]
    last = None
    for label, own in zip(labels, counts, strict=True):
        before.append(last)
        last = label if label is not None and own else last
    last = None
    for k in range(len(found) - 1, -1, -1):
        after[k] = last
        last = labels[k] if labels[k] is not None and counts[k] else last
    for k, block in enumerate(found):
        if block.good is not None:
            continue
        near = [x for x in ((after[k],) if block.heading and after[k] is not None else (before[k], after[k])) if x is not None]
        if not near:
            block.good = marked or _stop_density(block.text) >= STOP_LOW or block.foreign and len(block.text) >= SHORT
        elif len(set(near)) == 1:
            block.good = near[0]
        else:
            block.good = marked or _stop_density(block.text) >= STOP_HIGH or block.foreign and len(block.text) >= SHORT
    return [b for b in found if b.good]


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "") for page in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return rows.mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")
