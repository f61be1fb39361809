"""Main text of web pages by two-pass block rules."""

from __future__ import annotations

import re
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.common import small_batches

#: Frequent function words of the languages looked for.
STOP_WORDS = frozenset((
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which "
    "one you were all we can there their been has when who will no if out so what up its about than into them only "
    "der die das und in zu den mit von für ist des ein eine dem nicht sich auch auf es an als wie im war bei aus nach "
    "le la les de des et un une en du que qui dans pour pas sur au avec par est il ce sont plus ne se sa son ou mais "
    "el los las y que de un una en es por con para no se del al lo su como más pero sus le o este ha").split())

#: Elements without text of their own, or never part of an article.
DROPPED = frozenset("script style noscript template svg math iframe object embed applet canvas audio video select "
                    "option optgroup datalist button textarea form nav footer header aside head title menu dialog".split())
#: Of those, the ones whose content is raw text up to the end tag.
RAW = frozenset("script style noscript template textarea title iframe svg math".split())
BLOCKS = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 "
                   "h3 h4 h5 h6 hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul "
                   "form nav footer header aside".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: End tags that HTML lets a page leave out: a start tag of a key ends an open element of its values.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}

#: Class, id and role words of parts that are not the article.
_BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side-?bar|"
    r"rail|widget\w*|footer\w*|foot|header\w*|masthead|topbar|cookies?|consent|gdpr|notices?|notification|alert|popup|"
    r"modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|comments?|commentlist|respond|"
    r"replies|disqus|related|recommend\w*|teasers?|tags?|pagination|pager|copyright|legal|disclaimer|search\w*|"
    r"skip-?link|toolbar|complementary|contentinfo|navigation|alertdialog)(?=$|[\s_-])", re.I)
_CONTENT = re.compile(r"(?:^|[\s_-])(?:article-?body|entry-?content|post-?content|main-?content|article)(?=$|[\s_-])", re.I)

_TAG = re.compile(r"<(?:!--.*?(?:-->|$)|!\[CDATA\[.*?(?:\]\]>|$)|[!?][^>]*(?:>|$)|"
                  r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]|=(?:\s*(?:\"[^\"]*(?:\"|$)|'[^']*(?:'|$)))?)*)(?:>|$))", re.S)
#: An attribute value without quotes at a tag's end: a slash there belongs to it.
_BARE_END = re.compile(r"=\s*[^\s\"'=<>`]+$")
_ATTR = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[^\W\d_]+")

SHORT_WORDS = 8
STOP_GOOD = 0.15
LINK_BAD = 0.4
#: Characters of running text in a script that does not part its words by spaces.
LONG_CHARS = 40


class Block:
    __slots__ = ("text", "words", "stop", "links", "heading", "label", "inside")

    def __init__(self, text: str, linked: int, heading: bool, inside: bool):
        self.text, self.heading, self.inside = text, heading, inside
        words = _WORD.findall(text.lower())
        self.words = len(words)
        self.stop = sum(w in STOP_WORDS for w in words) / max(1, len(words))
        self.links = linked / max(1, len(text))
        self.label = None


def _is_boilerplate(name: str, attrs: str) -> bool:
    if name in DROPPED:
        return True
    if not attrs or name in ("html", "body", "article", "main"):
        return False
    for key, value in _ATTR.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            return True
        if key in ("class", "id", "role") and _BOILERPLATE.search(value) and not _CONTENT.search(value):
            return True
    return False


def blocks(html: str) -> tuple[list[Block], bool]:
    """Text blocks outside boilerplate elements, and whether the page marks an article."""
    found: list[Block] = []
    text: list[str] = []
    linked = links = 0
    stack: list[tuple[str, bool]] = []  # open elements; True: boilerplate
    skipped = article = 0
    marked = False

    def end_block() -> None:
        nonlocal linked
        if text:
            whole = " ".join(unescape("".join(text)).split())
            if whole:
                found.append(Block(whole, linked, any(n in HEADINGS for n, _ in stack[-3:]), article > 0))
            text.clear()
        linked = 0

    def pop(k: int) -> None:
        nonlocal skipped, article, links
        while len(stack) > k:
            name, bad = stack.pop()
            skipped -= bad
            article -= name in ("article", "main")
            links -= name == "a"

    def add(piece: str) -> None:
        nonlocal linked
        if piece and not skipped:
            text.append(piece)
            if links:
                linked += len(piece)

    at, size = 0, len(html)
    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            add(html[at:])
            break
        m = _TAG.match(html, lt)
        if m is None:  # a "<" that starts no markup
            add(html[at:lt + 1])
            at = lt + 1
            continue
        if lt > at:
            add(html[at:lt])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name in BLOCKS:
                end_block()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    pop(k)
                    break
            continue
        if name == "br":
            add(" ")
            continue
        if name in VOID:
            if name == "hr":
                end_block()
            continue
        if name in RAW:
            closing = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = closing.end() if closing else size
            continue
        if name in BLOCKS:
            end_block()
            for k in range(len(stack) - 1, -1, -1):  # a new block ends an open paragraph
                if stack[k][0] == "p":
                    pop(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        for k in range(len(stack) - 1, max(-1, len(stack) - 6), -1):
            if stack[k][0] in CLOSES.get(name, ()):
                pop(k)
                break
        if m[3].endswith("/") and not _BARE_END.search(m[3]):
            continue
        bad = _is_boilerplate(name, m[3])
        stack.append((name, bad))
        skipped += bad
        if name in ("article", "main") and not skipped:
            marked = True
        article += name in ("article", "main")
        links += name == "a"
    end_block()
    return found, marked


def classify(page: list[Block], marked: bool) -> None:
    """Set ``label`` of every block: first each by itself, then the undecided by their neighbours.

    Pass 1: a block outside a marked article, or mostly links, is not content; a
    block of running words with enough stop words is; a short block, or one with few
    stop words, stays undecided.  Pass 2: an undecided block takes the label of the
    nearest decided block before and after it (content if either side is and the
    nearer one does not say otherwise; a tie goes to the heading's following block,
    else to the one before).  On a page where no block has stop words (another
    language, short lines), running blocks with few links are content by their length;
    where there are none either, all blocks are that are not mostly links.
    """
    for b in page:
        if marked and not b.inside or b.links > LINK_BAD:
            b.label = False
        elif b.words >= SHORT_WORDS and b.stop >= STOP_GOOD:
            b.label = True
        elif b.words >= SHORT_WORDS and b.stop < STOP_GOOD / 3 and not b.inside:
            b.label = False
    if not any(b.label for b in page):
        open_blocks = [b for b in page if (b.inside or not marked) and b.links <= LINK_BAD]
        long = [b for b in open_blocks if b.links <= LINK_BAD / 2 and (b.words >= SHORT_WORDS or len(b.text) >= LONG_CHARS)]
        for b in long or open_blocks:
            b.label = True
    first = [b.label for b in page]
    n = len(page)
    before, after = [None] * n, [None] * n
    last = None
    for i in range(n):
        if first[i] is not None and (page[i].inside or not marked):
            last = i
        before[i] = last
    last = None
    for i in range(n - 1, -1, -1):
        if first[i] is not None and (page[i].inside or not marked):
            last = i
        after[i] = last
    for i, b in enumerate(page):
        if first[i] is not None:
            continue
        p, q = before[i], after[i]
        if p is None and q is None:
            b.label = b.inside
        elif p is None or q is None:
            b.label = first[q if p is None else p]
        elif first[p] == first[q]:
            b.label = first[p]
        elif i - p == q - i:
            b.label = first[q if b.heading else p]
        else:
            b.label = first[p if i - p < q - i else q]


def main_text(html: str) -> str:
    page, marked = blocks(html)
    classify(page, marked)
    return "\n\n".join(b.text for b in page if b.label)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of each page: id, url, ``text`` (empty if none) and ``n_chars``.

    The whole html is read; a null or empty one gives an empty text; a page cut off in
    the middle ends its open elements there.  Repeated rows and null ids or urls give
    one row each; an empty table gives none; other columns are ignored.
    """
    small_batches(pages.sparkSession)
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                          F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    @F.pandas_udf("string")
    def text_of(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in html], dtype=object)

    return source.withColumn("text", text_of("html")) \
        .select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text",
                F.char_length("text").cast("long").alias("n_chars"))
