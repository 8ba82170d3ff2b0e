"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass looks at each block alone: text in menus, footers,
forms, adverts, notices, comments and the like, or mostly of links, is boilerplate; long text with few links is content if
it stands in the article or is dense in stop words. The second pass lets the short blocks left undecided
inherit the label of the nearest decided neighbours on their side of the article's border.
"""
from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML and usual class names.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article aside blockquote body details dialog div dl fieldset figure footer form header html main menu nav "
                       "ol search section table td tr ul".split())
UNREAD = frozenset("script style template noscript textarea title svg iframe object canvas audio video select button".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog search".split())
UNWANTED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|side-?bar|"
    r"menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|comments?|replies|reply|discussion|disqus|share|sharing|"
    r"social|subscribe|subscription|newsletter|signup|login|related|recommended|widget|toolbar|pagination|pager|copyright|legal|"
    r"disclaimer|skip)(?:$|[\s_-])", re.I)
#: Elements that hold the main text whatever they are called, and what names say of the page, not of the element.
NEVER_NAMED = frozenset("html body main article".split())
HAVING = frozenset("has no with without".split())
TOPICS = frozenset("legal social share sharing related login copyright disclaimer skip alert".split())
STOP_WORDS = frozenset(
    # English
    "a an and are as at be but by for from had has have he her his i in is it its not of on or our she that the their them there "
    "they this to was we were which who will with you "
    # German
    "als am auf aus bei bin das dass dem den der des die ein eine einem einen einer er es für hat ich im ist mit nicht noch sich sie "
    "sind und von war was wie wir zu zum zur "
    # French
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour qui que sa se ses "
    "son sont sur un une vous "
    # Spanish
    "al como con del el ella en es esta este la las lo los más no para pero por que se sin su sus un una y".split())

#: Characters from which a block can be decided alone, and shares of stop words and of link text that decide.
LONG = 70
DENSE_STOP_WORDS = 0.25
MANY_LINKS = 0.5
FEW_LINKS = 0.2

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'"<>])*)>|<[!?][^>]*(?:>|\Z)""", re.S)
_CLOSE = {name: re.compile(rf"</{name}\s*>", re.I) for name in UNREAD}
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


@dataclass
class Block:
    text: str
    linked: int  # characters of link text
    unwanted: bool
    article: int  # number of the article or main element it stands in, 0 outside


def _condemned(labels: str) -> bool:
    """Whether a name speaks of something that is no main text. Names of what a page has or lacks (``has-sidebar``) don't, nor
    words that also name a topic (``legal-news``) beside one that is none of them."""
    for name in labels.split():
        parts = [x for x in re.split(r"[_-]+", name) if x]
        if parts and parts[0].lower() in HAVING:
            continue
        found = [x for x in parts if UNWANTED.fullmatch(x)]
        if (found or UNWANTED.search(name)) and not (found and len(found) < len(parts) and all(x.lower() in TOPICS for x in found)):
            return True
    return False


def blocks(page: str) -> list[Block]:
    """Blocks with text in page order; tags that are never closed end with the element around them."""
    out: list[Block] = []
    parts: list[str] = []
    linked = links = articles = 0
    # Open containers: name, unwanted, article.
    stack: list[tuple[str, bool, int]] = []
    opened: Counter[str] = Counter()

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            parts.append(raw)
            if links:
                linked += len("".join(html.unescape(raw).split()))

    def end_block() -> None:
        nonlocal parts, linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            _, unwanted, article = stack[-1] if stack else ("", False, 0)
            out.append(Block(text, linked, unwanted, article))
        parts, linked = [], 0

    at = 0
    while (tag := _TAG.search(page, at)) is not None:
        add(page[at:tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name, closing = tag[2].lower(), bool(tag[1])
        if name == "a":
            links = max(0, links - 1) if closing else links + 1
        elif name == "br":
            add("\n")
        elif name in UNREAD and not closing:
            if not tag[3].endswith("/"):
                closed = _CLOSE[name].search(page, at)
                at = closed.end() if closed else len(page)
            add(" " if name in ("select", "button", "textarea") else "")
        elif name in BLOCKS:
            end_block()
            links = 0 if name in CONTAINERS else links
            if name not in CONTAINERS:
                continue
            if closing:
                while opened[name]:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
                continue
            _, unwanted, article = stack[-1] if stack else ("", False, 0)
            labels = " ".join(a or b or c for a, b, c in _NAMED.findall(tag[3]))
            named = _condemned(labels) and name not in NEVER_NAMED
            if name in ("article", "main") and not article:
                articles += 1
                unwanted, article = False, articles
            page_header = name == "header" and not article
            opened[name] += 1
            stack.append((name, unwanted or named or name in BOILERPLATE or page_header, article))
    add(page[at:])
    end_block()
    return out


def decide(found: list[Block]) -> list[bool]:
    """Whether each block is content."""
    labels: list[bool | None] = []
    for block in found:
        size = len(block.text)
        share = block.linked / max(1, len("".join(block.text.split())))
        words = [w.strip(".,;:!?\"'()").lower() for w in block.text.split()]
        dense = sum(w in STOP_WORDS for w in words) / max(1, len(words)) >= DENSE_STOP_WORDS
        if block.unwanted or share > MANY_LINKS:
            labels.append(False)
        elif size < LONG or share > FEW_LINKS:
            labels.append(None)
        elif block.article or dense:
            labels.append(True)
        else:
            labels.append(None)
    before, after = _nearest(found, labels, 1), _nearest(found, labels, -1)
    out = []
    for i, block in enumerate(found):
        if labels[i] is not None:
            out.append(labels[i])
            continue
        # Of two equally near neighbours, content counts.
        near = min(((abs(i - j), not labels[j]) for j in (before[i], after[i]) if j is not None), default=None)
        out.append(bool(block.article) if near is None else not near[1])
    return out


def _nearest(found: list[Block], labels: list[bool | None], step: int) -> list[int | None]:
    """Per block the last decided one of its article that a walk in direction ``step`` met before it.

    Unwanted blocks (an advert, a share bar) say nothing about the text around them.
    """
    out: list[int | None] = [None] * len(found)
    last: dict[int, int] = {}
    for i in range(len(found))[::step]:
        out[i] = last.get(found[i].article)
        if labels[i] is not None and not found[i].unwanted:
            last[found[i].article] = i
    return out


def main_text(page: str) -> str:
    found = blocks(page)
    return "\n\n".join(b.text for b, content in zip(found, decide(found), strict=True) if content)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), 128):
            part = batch.slice(at, 128)
            texts = [main_text(page or "") for page in part.column(part.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                [*part.schema.names[:-1], "_text", "_chars"])


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] | None = None) -> DataFrame:
    """Columns ``keep`` (default: all), the main text as ``_text`` and its code points as ``_chars``.

    Character references are decoded and white space inside a block is one space; blocks are joined by an empty line.
    A null or empty page, or one without content, gives an empty text; long pages are read whole; repeated rows
    give equal texts; an empty table gives no rows.
    """
    pages = pages.drop("_text", "_chars")
    wanted = pages.select(*(pages.columns if keep is None else keep), F.col(html_col).alias("__pitf_html"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields[:-1])
    return wanted.mapInArrow(_extract, f"{fields}, _text string, _chars long")
