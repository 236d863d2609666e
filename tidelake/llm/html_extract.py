"""Main text of web pages by two passes of block rules.

The first pass looks at each block alone: its place, its link density, its length and its share of stop words make it
content, boilerplate or undecided. The second pass gives undecided blocks the label of their nearest decided neighbours.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidelake.llm.common import table, texts_of

# Elements of HTML by their role.
UNSEEN = {"script", "style", "noscript", "template", "head", "svg", "math", "iframe", "object", "canvas", "select", "textarea", "title"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template"}
FRAME = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
BODY = {"article", "main"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html",
    "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
FOREIGN = {"svg", "math"}
#: What an opening tag closes, as browsers read it. Cells look for it up to the table, items through these only.
SIBLINGS = {
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr", "caption"},
    **{name: {"td", "th", "tr", "thead", "tbody", "tfoot", "caption"} for name in ("thead", "tbody", "tfoot")},
}
THROUGH = {"address", "div", "p"}
CELLS = {"td", "th", "tr", "thead", "tbody", "tfoot"}
#: Elements that may stand in a head; any other ends it.
HEAD = {"head", "title", "meta", "link", "base", "basefont", "bgsound", "noframes", "style", "script", "noscript", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Words in class, id or role that speak against a container: as a whole name or as the noun at its end, without MODIFIERS.
FRAME_NAMES = set(
    """ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion nav navbar navigation menu
    breadcrumb breadcrumbs footer masthead topbar toolbar sidebar aside rail widget widgets related recommended recommendations share sharing
    social cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login register
    comment comments commentlist discussion respond replies reply disqus form search pagination pager skip copyright complementary
    contentinfo paywall""".split()
)
#: Words of place or form behind the noun, and words that make a name say something about another element.
PLACES = {"left", "right", "top", "bottom", "box", "area", "list", "item", "items", "section", "block", "links", "buttons"}
MODIFIERS = {"has", "no", "not", "non", "with", "without", "is", "hide", "show", "before", "after", "above", "below", "under", "beside", "to"}
NEVER_NAMED = {"html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6"}
# Frequent function words of the four languages.
STOP_WORDS = {
    "en": "the of and to in a is that it for was on are as with be this by at from or have an not which but they his her has had were been their its you we can will would there all one so if when who what more no out up about into than them only some could these two may then do",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde sei",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont ont avec son on aux d l été cette ou mais comme nous sa ses leur entre elle tout fait être deux même peut sans où si ils",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante todos uno les ni contra otros ese eso",
}
STOPS = frozenset(word for words in STOP_WORDS.values() for word in words.split())

#: Signs that end or part sentences.
_SENTENCE = re.compile(r"[.,;:!?…。、！？，；：।،؛؟]")
SHORT_CHARS = 70
MOST_LINKS = 0.33
GOOD_STOPS = 0.12
BAD_STOPS = 0.02

#: Comments and declarations, raw elements with their content, tags. A tag without an end runs to the next one.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^\"'<>])*+)(?:>|$|(?=<))",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_WORDS = re.compile(r"[^\W\d_]+")
_ENDS = {name: re.compile(rf"</{name}\s*>|</{name}$", re.IGNORECASE) for name in RAW}


@dataclass
class Block:
    """One run of text between block boundaries, with the place where it stood."""

    framed: bool
    within: bool
    heading: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    label: int = 0
    #: The number of the nearest container whose name speaks against it; 0 if there is none.
    named: int = 0


def speaks_against(attributes: str) -> bool:
    """Whether class, id or role has a name of FRAME_NAMES."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role"):
            for token in "".join(values).split():
                parts = [part.lower() for part in _NAME_PARTS.findall(token)]
                if token.lower() in FRAME_NAMES:
                    return True
                while len(parts) > 1 and parts[-1] in PLACES:
                    parts.pop()
                if parts and parts[-1] in FRAME_NAMES and MODIFIERS.isdisjoint(parts):
                    return True
    return False


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order; text of unseen elements is left out."""
    done: list[Block] = []
    open_tags: list[tuple[str, bool, bool, int]] = []  # name, framed, within an article, number of the named container
    current = Block(False, False, False)
    links = 0
    containers = 0
    at, size = 0, len(page)

    def add(text: str) -> None:
        if open_tags and open_tags[-1][0] == "head" and text.strip():
            open_tags.pop()
            boundary()
        if text:
            current.parts.append(text)
            if links:
                current.linked += len(text)

    def boundary() -> None:
        nonlocal current
        if current.parts:
            done.append(current)
        _, framed, within, named = open_tags[-1] if open_tags else ("", False, False, 0)
        current = Block(framed, within, any(t[0] in HEADINGS for t in open_tags[-3:]), named=named)

    def close_siblings(name: str) -> None:
        outermost = len(open_tags)
        for k in range(len(open_tags) - 1, -1, -1):
            if open_tags[k][0] in SIBLINGS[name]:
                outermost = k
            elif open_tags[k][0] == "table" or (name not in CELLS and open_tags[k][0] not in THROUGH):
                break
        del open_tags[outermost:]

    while at < size:
        found = _MARKUP.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = max(found.end(), found.start() + 1)
        name = (found[2] or "").lower()
        if not name:
            continue
        if open_tags and open_tags[-1][0] == "head" and name not in HEAD and (found[1] != "/" or name in ("body", "html")):
            open_tags.pop()
            boundary()
        closing = found[1] == "/"
        if name == "a":
            links = 0 if closing else 1
        if name == "br":
            add("\n")
        elif name in RAW and not closing and found[3].endswith("/") and any(t[0] in FOREIGN for t in open_tags):
            continue
        elif name in RAW and not closing:
            end = _ENDS[name].search(page, at)
            at = end.end() if end else size
            add(" ")
        elif name in BLOCK or name in UNSEEN:
            if closing:
                depth = next((k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] == name), -1)
                if depth >= 0:
                    del open_tags[depth:]
            elif name not in VOID and not (name in FOREIGN and found[3].endswith("/")):
                # A new block ends an open paragraph, as browsers read it, and a new item or cell those before it.
                if open_tags and open_tags[-1][0] == "p" and name not in FOREIGN:
                    open_tags.pop()
                if name in SIBLINGS:
                    close_siblings(name)
                _, framed, within, named = open_tags[-1] if open_tags else ("", False, False, 0)
                inside = within or name in BODY
                out = framed or name in UNSEEN or name in FRAME or (name == "header" and not inside)
                if found[3] and not out and name not in NEVER_NAMED and speaks_against(found[3]):
                    containers += 1
                    named = containers
                open_tags.append((name, out, inside, named))
            links = 0
            boundary()
    boundary()
    for block in done:
        block.text = " ".join(html.unescape("".join(block.parts)).split())
    return [block for block in done if block.text]


HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


def much_linked(block: Block) -> bool:
    return block.linked > MOST_LINKS * max(1, sum(map(len, block.parts)))


def stop_words(block: Block) -> tuple[int, int]:
    """Words, and stop words among them."""
    words = _WORDS.findall(block.text.lower())
    return len(words), sum(word in STOPS for word in words)


def in_known_language(blocks: list[Block]) -> bool:
    """Does the page's longer text hold stop words at all? If not, their absence says nothing about a block."""
    counts = [stop_words(b) for b in blocks if not b.framed and len(b.text) >= SHORT_CHARS and not much_linked(b)]
    words, stops = sum(n for n, _ in counts), sum(s for _, s in counts)
    return not words or stops > BAD_STOPS * words


def first_pass(block: Block, known: bool) -> int:
    """1 for content, -1 for boilerplate, 0 for undecided. ``known``: the page is in a language whose stop words are known; else
    a longer block with few links and the signs of sentences is content. Links make a heading, or a block of the article,
    undecided at most."""
    if block.framed:
        return -1
    if much_linked(block):
        return 0 if block.within or block.heading else -1
    if len(block.text) < SHORT_CHARS or block.heading:
        return 0
    if not known:
        return 1 if _SENTENCE.search(block.text) else 0
    words, found = stop_words(block)
    stops = found / max(1, words)
    if stops >= GOOD_STOPS:
        return 1
    # Inside a marked article rare stop words prove nothing (lists, names, other languages).
    return 0 if block.within or stops > BAD_STOPS else -1


def second_pass(labels: list[int], within: list[bool], heading: list[bool] | None = None) -> list[int]:
    """Undecided blocks take the label of the nearest decided one on each side; if these differ, of the nearer one.

    Equal distances give a heading the label of what follows it, and make other blocks content inside the article and boilerplate outside. Blocks of a marked article look
    only at blocks of the article, other blocks only at others; with no decided block there, they are content.
    """
    out = list(labels)
    for inside in (True, False):
        places = [i for i, w in enumerate(within) if w == inside]
        before: dict[int, int] = {}
        last = None
        for i in places:
            if labels[i]:
                last = i
            elif last is not None:
                before[i] = last
        following = None
        for i in reversed(places):
            if labels[i]:
                following = i
                continue
            left, right = before.get(i), following
            if left is None and right is None:
                out[i] = 1
            elif left is None or right is None:
                out[i] = labels[right if left is None else left]
            elif labels[left] == labels[right] or i - left < right - i:
                out[i] = labels[left]
            elif right - i < i - left or (heading and heading[i]):
                out[i] = labels[right]
            else:
                out[i] = 1 if inside else -1
    return out


def first_labels(blocks: list[Block]) -> tuple[list[int], bool]:
    """The first pass over a page, with the names of containers as a feature, and whether the page marks its article.

    What stands outside a marked article is boilerplate, unless more than twice as much prose stands there as inside: then
    the marked elements are teasers, and the page is read as if it had none. A container whose name speaks against it is boilerplate unless a block in it reads like content. If one does, its blocks are
    labelled as if it had no name inside a marked article, or where such containers hold more of the page's content than all the
    rest; elsewhere they are undecided.
    """
    known = in_known_language(blocks)
    labels = [first_pass(b, known) for b in blocks]
    # In a marked article a long text with few links will do, as rare stop words prove nothing there.
    prose = [x > 0 or (x == 0 and b.within and not b.heading and len(b.text) >= SHORT_CHARS) for b, x in zip(blocks, labels, strict=True)]
    good = {b.named for b, x in zip(blocks, prose, strict=True) if x}
    kept = [not b.framed and (not b.named or b.named in good) for b in blocks]
    article = any(b.within and k for b, k in zip(blocks, kept, strict=True))
    shares = [sum(len(b.text) for b, x, k in zip(blocks, prose, kept, strict=True) if x and k and b.within == inside) for inside in (True, False)]
    article = article and shares[1] <= 2 * shares[0] if shares[0] else article
    sizes = [len(b.text) if x and (b.within or not article) else 0 for b, x in zip(blocks, prose, strict=True)]
    named = sum(n for b, n in zip(blocks, sizes, strict=True) if b.named)
    for i, b in enumerate(blocks):
        if not kept[i] or (article and not b.within):
            labels[i] = -1
        elif b.named and not b.within and labels[i] > 0 and 2 * named <= sum(sizes):
            labels[i] = 0
    return labels, article


def main_text(page: str) -> str:
    """The content blocks of a page, one a line."""
    blocks = blocks_of(page)
    labels, article = first_labels(blocks)
    final = second_pass(labels, [b.within and article for b in blocks], [b.heading for b in blocks])
    return "\n".join(b.text for b, label in zip(blocks, final, strict=True) if label > 0)


@F.arrow_udf(StringType())
def _main_text(pages: pa.Array) -> pa.Array:
    return pa.array([main_text(page) for page in texts_of(pages)], pa.string())


def extracted(page: Column) -> Column:
    """The main text of an HTML column."""
    return _main_text(page.cast("string"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``.

    Null or empty html and pages without content give an empty text. Broken markup is read as far as it goes: an open
    comment or script swallows the rest, an unclosed tag ends at the next one. Repeated rows stay repeated, other columns
    are not read, an empty table gives no rows.
    """
    texts = pages.select("page_id", "url", extracted(F.col("html")).alias("text"))
    return texts.select("*", F.length("text").cast("long").alias("n_chars"))


def query(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
