"""Main text of web pages by two passes of block rules."""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import prepared, slices

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """
    the of and to in is that for it as was with be by on not he this are or from at which but have an had they you were
    his a we her she there been one all their has would what if when so no will can more do about up out them then its
    der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass
    sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis
    le la les de des et un une du en est que qui dans pour sur pas au avec ce il elle par plus ne se son sa ses ou mais
    comme on nous vous leur aux été cette sont
    el los las del y una que es se no por con su para al lo como más pero sus o este ha si sin sobre ya entre cuando
    """.split()
)

# Elements that hold no text of the page, and those that begin and end a block.
_SILENT = "script|style|noscript|template|svg|iframe|object|title|select|textarea|button|canvas|math"
_OUTSIDE = frozenset("nav footer aside form dialog menu".split())
_BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul caption".split()
)
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words in a class or id that name something beside the article.
_BESIDE = re.compile(
    r"(?<![a-z])(ad|ads|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice\w*|alert|popup|modal|overlay|"
    r"nav\w*|menu\w*|breadcrumbs?|sidebar\w*|side|widget\w*|related|recommend\w*|share|sharing|social|subscribe\w*|newsletter|"
    r"comments?|comment-\w+|replies|reply|disqus|respond|footer\w*|header\w*|masthead|topbar|toolbar|login|signup|search|pagination|pager|skip)(?![a-z])",
    re.I,
)
# In the article these name its own head; elements named by the others hold pages' other texts whole.
_OWN_HEAD = re.compile(r"header|masthead", re.I)
_APART = re.compile(r"comment|repl(?:y|ies)|disqus|respond|related|recommend", re.I)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<({_SILENT})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[a-zA-Z/][^>]*$",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?(?:false|until))|display\s*:\s*none", re.I)
_STRIP = re.compile(r"^\W+|\W+$")

LONG, SHORT = 200, 70
STOPS_HIGH, STOPS_LOW = 0.30, 0.10
LINKS_HIGH = 0.33
# Short lines that end a page and are no text of its own.
_RIGHTS = re.compile(r"\W*(?:copyright\b|©|\(c\)\s*\d|all rights reserved)", re.I)


class Block:
    """Text of one block with what the rules look at."""

    __slots__ = ("text", "link_chars", "beside", "inside", "heading")

    def __init__(self, text: str, link_chars: int, beside: bool, inside: bool, heading: bool):
        self.text, self.link_chars, self.beside, self.inside, self.heading = text, link_chars, beside, inside, heading


class Marks:
    """Elements marked as beside the article that may be wrappers of it, by their place among all tags."""

    def __init__(self):
        self.sizes: dict[int, int] = {}  # characters in each
        self.titled: set[int] = set()  # those with an h1
        self.around: list[frozenset[int]] = []  # of each article or main: those that contain it
        self.bare = False  # an article or main is in no marked element
        self.total = 0


def blocks(page: str) -> list[Block]:
    """The page's blocks in order, white space joined and character references decoded.

    An element that contains the article is not beside it, whatever its name: the marked
    elements around the article or main that has the fewest of them count as unmarked. On a
    page without any, those count so that hold more than half of the text and the h1, or more
    than half where nothing else is main text.
    """
    marks = Marks()
    found = _blocks(page, frozenset(), marks)
    if marks.bare:
        return found
    if marks.around:
        return _blocks(page, min(marks.around, key=len), Marks())
    wide = {e for e, size in marks.sizes.items() if 2 * size > marks.total}
    if wide and (wide & marks.titled or not any(_classified(found, True))):
        return _blocks(page, frozenset(wide & marks.titled or wide), Marks())
    return found


def _blocks(page: str, wrappers: frozenset[int], marked: Marks) -> list[Block]:
    """Blocks where ``wrappers`` are not marked as beside the article; fills ``marked``."""
    found: list[Block] = []
    parts: list[str] = []
    stack: list[tuple[str, bool]] = []  # open elements, and whether each is beside the article
    opened: Counter[str] = Counter()  # how many of each name are open
    around: list[tuple[int, int, bool]] = []  # open marked ones: depth, place, whether it may be a wrapper
    links = link_chars = main = beside = 0
    heading = False

    def close() -> None:
        nonlocal parts, link_chars, heading
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            marked.total += len(text)
            for _, place, soft in around:
                if soft:
                    marked.sizes[place] = marked.sizes.get(place, 0) + len(text)
            found.append(Block(text, min(link_chars, len(text)), beside > 0, main > 0, heading))
        parts, link_chars, heading = [], 0, False

    def put(text: str) -> None:
        nonlocal link_chars
        if text:
            parts.append(text)
            if links:
                link_chars += len("".join(entities.unescape(text).split()))

    at = 0
    for token in _TOKEN.finditer(page):
        put(page[at : token.start()])
        at = token.end()
        name = (token[3] or "").lower()
        if not name:
            if token[0][:9] == "<![CDATA[":
                put(token[0][9:].removesuffix("]]>"))
            continue
        if name in _BLOCK:
            close()
            heading = token[2] == "" and name in ("h1", "h2", "h3", "h4", "h5", "h6")
        elif name == "br":
            parts.append(" ")
        if token[2]:
            if opened[name]:
                while stack:
                    open_name, aside = stack.pop()
                    opened[open_name] -= 1
                    beside -= aside
                    main -= open_name in ("article", "main")
                    links -= open_name == "a"
                    if around and around[-1][0] == len(stack):
                        around.pop()
                    if open_name == name:
                        break
        elif name not in _EMPTY and not token[4].endswith("/"):
            if name in ("p", "li", "td", "th", "tr", "dd", "dt", "option") and stack and stack[-1][0] == name:
                _, aside = stack.pop()  # its end tag may be left out
                opened[name] -= 1
                beside -= aside
                if around and around[-1][0] == len(stack):
                    around.pop()
            marks = " ".join(a or b or c for a, b, c in _NAMES.findall(token[4]))
            # a header beside the article is the page's, one in it is the article's own
            hidden = bool(_HIDDEN.search(token[4]))
            aside = name in _OUTSIDE or (name == "header" and not main) or hidden
            if not aside and name not in ("html", "body", "article", "main"):
                aside = any(not (main and _OWN_HEAD.match(m[1])) for m in _BESIDE.finditer(marks))
            if name in ("article", "main") and not hidden:
                if not around:
                    marked.bare = True
                elif all(soft for _, _, soft in around):
                    marked.around.append(frozenset(place for _, place, _ in around))
            elif name == "h1":
                marked.titled.update(place for _, place, _ in around)
            if aside and token.start() in wrappers:
                aside = False
            elif aside:
                soft = not hidden and (name == "form" or name not in _OUTSIDE) and not _APART.search(marks)
                around.append((len(stack), token.start(), soft))
            stack.append((name, aside))
            opened[name] += 1
            beside += aside
            main += name in ("article", "main")
            links += name == "a"
    put(page[at:])
    close()
    return found


def classify(found: list[Block]) -> list[bool]:
    """Which blocks are main text.

    First pass, by itself: blocks beside the article and those made of links are out; long
    ones with many stop words are in, long ones with hardly any are out unless the page marks
    them as its article; short ones and those in between stay open. Second pass: an open
    block takes the label of the nearest decided block; of two equally near ones that differ,
    and for a heading, the one that follows decides. A page without any main text by stop
    words may be in a language that has none here: its blocks are judged by length and links.
    """
    out = _classified(found, True)
    return out if any(out) else _classified(found, False)


def _length(text: str) -> int:
    """Characters, where one of a script without spaces counts as three."""
    return len(text) + 2 * sum("\u2e80" <= c <= "\ud7a3" for c in text)


def _classified(found: list[Block], by_words: bool) -> list[bool]:
    labels: list[bool | None] = []
    for b in found:
        words = b.text.split()
        if b.beside or b.link_chars > LINKS_HIGH * len(b.text):
            labels.append(False)
            continue
        if not by_words:
            labels.append(True if _length(b.text) >= SHORT else None)
            continue
        stops = sum(_STRIP.sub("", w).lower() in STOP_WORDS for w in words) / len(words)
        if len(b.text) < SHORT:
            labels.append(False if not b.inside and _RIGHTS.match(b.text) else None)
        elif stops >= STOPS_HIGH or (stops >= STOPS_LOW and len(b.text) >= LONG):
            labels.append(True)
        elif stops < STOPS_LOW and not b.inside:
            labels.append(False)
        else:
            labels.append(None)
    marked = any(b.inside for b in found)
    out = []
    for i, label in enumerate(labels):
        if label is None and marked:
            # where the page marks its article, neighbours on the other side of its border don't count
            label = _nearest(labels, i, found)
            label = found[i].inside if label is None else label
        elif label is None:
            label = bool(_nearest(labels, i, found))
        out.append(label and (found[i].inside or not marked))
    return out


def _nearest(labels: list[bool | None], i: int, found: list[Block]) -> bool | None:
    def look(step: int) -> tuple[int, bool | None]:
        j = i + step
        while 0 <= j < len(labels):
            if found[j].inside != found[i].inside or found[j].beside:
                break
            if labels[j] is not None:
                return abs(j - i), labels[j]
            j += step
        return len(labels) + 1, None

    (before, first), (after, second) = look(-1), look(1)
    if first is None or second is None:
        return second if first is None else first
    return second if after <= before or found[i].heading else first


def main_text(page: str | None) -> str:
    """Main text of one page: its blocks in order with an empty line between them."""
    found = blocks(page or "")
    return "\n\n".join(b.text for b, good in zip(found, classify(found)) if good)


def extract_pages(pages: DataFrame) -> DataFrame:
    """All columns of ``pages`` but html, plus text and n_chars (code points).

    Null, empty and broken html give what text can be found, at least an empty string; tags
    that never end run to the end of the page. Columns called text or n_chars are replaced.
    Every row is worked on where it is read, so repeated pages give repeated rows.
    """
    prepared(pages.sparkSession)
    pages = pages.drop("text", "n_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            kept = [c for c in batch.schema.names if c != "html"]
            columns = [*(batch.column(c) for c in kept), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "text", "n_chars"])

    schema = pages.drop("html").select("*", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return pages.mapInArrow(run, schema)
