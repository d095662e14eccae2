"""Main text of web pages as a maximum-scoring subsequence (operator 13).

A page is read once as a sequence of tags and words. Words score positive
and tags negative; the main text lies in the contiguous stretch of the
largest sum, which one linear scan finds. What a word or tag scores is
learnt from labelled pages: the logarithm of how often its kind occurs in
the marked text against elsewhere, held above zero for words and below for
tags. Pages label themselves where they hold exactly one article (or, with
no article, one main) element; a few hand-marked pages stand for layouts
without one.

The kind of a word is its zone, if it stands in one (navigation, header,
footer, aside, form, elements whose class, id or role names such a thing,
hidden elements, and text outside the article where a page has one), else
whether it is in the page's one article, else its block, the size of that
and whether it is a link's. Words of zones that are rarer in
marked texts than elsewhere are no text, wherever they stand. In the
stretch all other words are text: character references are decoded, block
tags part blocks, white space is one space, blocks are joined by an empty
line. Scripts, styles, comments, titles and other raw elements are read
over.

Results in special cases: a null or empty page, and one without words,
gives the empty text; without any labelled page the hand-marked ones
decide; broken markup is read tolerantly (unclosed elements end with their
parents, an unclosed comment or script at the end of the page, a "<" that
starts no tag is text); texts are taken whole, in time linear in the page;
of equal stretches the first and longest counts; rows are treated one by
one, repeated ones alike; an empty table gives an empty result; other
columns pass through (``output`` and ``n_chars`` are overwritten).
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import text_or_empty
from tallyhouse.llm.labelled_pages import LABELLED

#: Pages that weights are learnt from, in expectation.
SAMPLE_PAGES = 20_000
WORD_LEAST, WORD_MOST, TAG_LEAST, TAG_MOST, UNSEEN, UNIT = 0.1, 5.0, -5.0, -0.1, 1.0, 1000

# Elements of HTML by what they do to text.
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option optgroup p pre search section select
    summary table tbody td tfoot th thead tr ul""".split())
INLINE = frozenset("a abbr b big cite code em font i kbd mark q s small span strike strong sub sup tt u".split())
#: Elements that an opening tag ends, up to the nearest of the others.
ENDS = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select"),
        "tr": ("tr td th", "table"), "td": ("td th", "table tr"), "th": ("td th", "table tr")}
ENDS = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS.items()}

# Zones: elements, and words in a class, id or role.
ZONES = {"nav": "nav", "menu": "nav", "aside": "aside", "footer": "footer", "header": "header", "form": "form", "button": "form",
         "select": "form", "fieldset": "form", "dialog": "boiler"}
BOILER = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted promotion
    outbrain taboola alert alertdialog banner consent cookie cookies gdpr modal newsletter notice notices notification overlay paywall popup signup
    subscribe subscription breadcrumb breadcrumbs menu menubar nav navbar navigation pager pagination skip tabs toolbar topbar aside
    complementary popular recommended related share sharing sidebar social trending comment comments commentlist
    discussion disqus replies reply respond contentinfo copyright foot footer legal login search""".split())
HEADING = frozenset("header masthead branding logo".split())
CONTENT = frozenset("article content entry main post story".split())
WHOLE = frozenset("html body article main".split())

MARKS = ("text", "/text")
TOKEN = re.compile(
    r"<!--(?P<mark>.*?)(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*+>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>]*+))?|=)*+)>?"
    r"|</[^>]*+>?", re.S)
NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*))|(?=[\s/>]|$))""", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Token(NamedTuple):
    text: str | None  # None: a tag
    kind: str
    zone: str | None
    part: bool  # a tag that parts blocks
    inside: int  # 1 in a main element, 2 or more in an article


@lru_cache(maxsize=8192)
def _zone(name: str, rest: str) -> str | None:
    """Zone that an element opens by its name or attributes."""
    if name in WHOLE and name != "article":
        return None
    zone = ZONES.get(name)
    if zone is not None or not rest or name in VOID:
        return zone
    content = heading = boiler = False
    for m in NAMED.finditer(rest):
        attribute, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if attribute == "hidden" or attribute == "aria-hidden" and value.lower() == "true" or (
                attribute == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            return "hidden"
        if attribute in ("class", "id", "role"):
            for part in value.split():
                words = [w.lower() for w in PARTS.findall(part)]
                if not words or words[0] in ("has", "with", "no"):
                    continue
                content |= not CONTENT.isdisjoint(words)
                heading |= not HEADING.isdisjoint(words)
                boiler |= not BOILER.isdisjoint(words)
    if name == "article":
        return "boiler" if boiler and "comment" in rest.lower() else None
    return "boiler" if boiler else "header" if heading and not content else None


def _block(name: str) -> str:
    return "h" if re.fullmatch("h[1-6]", name) else name if name in ("p", "li", "td", "pre", "blockquote") else "dd" if name in (
        "dt", "dd", "th") else "div"


def tokens(page: str, marked: bool = False) -> tuple[list[Token], str | None]:
    """The page as a sequence, and the element that holds its article:
    'article' or 'main' where it is one, 'articles' or 'mains', or None."""
    out: list[Token] = []
    stack: list[tuple[str, str | None, str]] = []  # element, zone, block of the words in it
    open_count: Counter[str] = Counter()
    found: Counter[str] = Counter()

    def pop(to: int) -> None:
        for name, _, _ in stack[to:]:
            open_count[name] -= 1
        del stack[to:]

    def add(text: str | None, kind: str, part: bool = False) -> None:
        zone = stack[-1][1] if stack else None
        out.append(Token(text, kind, zone, part, min(2 * open_count["article"] + open_count["main"], 3)))

    def words(text: str) -> None:
        if text:
            text = entities.unescape(text) if "&" in text else text
            if text:
                add(text, (stack[-1][2] if stack else "div") + (":link" if open_count["a"] else ""))

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.search(page, at)
        words(page[at:m.start()] if m else page[at:])
        if m is None:
            break
        at = m.end()
        name = m["name"]
        if name is None:
            if marked and m["mark"] in MARKS:
                out.append(Token(None, m["mark"], None, False, 0))
            elif m["data"]:
                words(m["data"])
            continue
        name = name.lower()
        part = name in BLOCKS
        if m["end"]:
            if open_count[name]:
                where = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name)
                add(None, "close:" + (name if part or name in INLINE else "other"), part)
                if name in INLINE and any(s[0] not in INLINE for s in stack[where + 1:]):
                    open_count[name] -= 1
                    del stack[where]
                else:
                    pop(where)
            elif name == "p" or name == "br":
                add(None, "close:other", True)
            continue
        if name in RAW:
            if not (m["rest"].endswith("/") and name in ("svg", "math")):
                close = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*+>?", re.I).search(page, at)
                at = close.end() if close else end
            add(None, "open:other", name in ("textarea", "title", "iframe", "xmp"))
            continue
        if part or name in ENDS:
            ended, barrier = ENDS.get(name, (frozenset(("p",)), None))
            if name not in ENDS and open_count["p"]:  # a block ends an open paragraph
                i = len(stack) - 1
                while i >= 0 and stack[i][0] in INLINE:
                    i -= 1
                if i >= 0 and stack[i][0] == "p":
                    pop(i)
            if any(open_count[e] for e in ended) and barrier:
                i, last = len(stack) - 1, None
                while i >= 0 and stack[i][0] not in barrier:
                    last = i if stack[i][0] in ended else last
                    i -= 1
                if last is not None:
                    pop(last)
        if name == "a" and open_count["a"]:  # links do not nest
            del stack[next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "a")]
            open_count["a"] -= 1
        zone, block = (stack[-1][1], stack[-1][2]) if stack else (None, "div")
        if zone is None:
            zone = _zone(name, m["rest"] if name != "a" else "")
            if zone == "header" and (open_count["article"] or open_count["main"]):
                zone = None
            if zone is None and name in ("article", "main"):
                found[name] += 1
        if name not in VOID:
            stack.append((name, zone, _block(name) if part else block))
            open_count[name] += 1
        if name == "br":
            add(" ", "br")
        else:
            add(None, "open:" + (name if part or name in INLINE else "other"), part)
    holder = next((n for n in ("article", "main") if found[n]), None)
    return out, holder if holder is None or found[holder] == 1 else f"{holder}s"


def _count(token: Token) -> int:
    return len(token.text.split()) if token.text else 0


def read(page: str, marked: bool = False) -> tuple[list[tuple[Token, str, int]], str | None]:
    """Tokens with their kinds in the model and their numbers of words (a
    tag has none), and the element that holds the article."""
    sequence, holder = tokens(page, marked)
    counts = [_count(t) for t in sequence]
    least = {"article": 2, "main": 1}.get((holder or "").rstrip("s"))
    if least:
        plain = [(n, t.inside >= least) for t, n in zip(sequence, counts) if t.zone is None]
        if sum(n for n, inside in plain if inside) < sum(n for n, inside in plain if not inside):
            least, holder = None, None  # a teaser: the article is elsewhere
    out: list[tuple[Token, str, int]] = []
    block: list[int] = []  # positions of the words of a block

    def close_block() -> None:
        total = sum(counts[i] for i in block)
        size = "short" if total < 5 else "middle" if total < 15 else "long"
        for i in block:
            out[i] = (out[i][0], f"{out[i][1]}:{size}", out[i][2])
        block.clear()

    for i, (t, n) in enumerate(zip(sequence, counts)):
        inside = least is not None and t.inside >= least
        zone = t.zone or (None if inside or least is None else "outside")
        if t.part:
            close_block()
        if t.text is None or t.kind == "br":
            tag = "open:br" if t.kind == "br" else t.kind
            out.append((t, f"tag@{zone}{':in' if inside else ''}" if zone else tag, 0))
        elif zone or inside and holder in WHOLE:
            out.append((t, f"word@{zone}" if zone else "word:in", n))
        else:
            block.append(i)
            out.append((t, f"word:{t.kind}", n))
    close_block()
    return out, holder


def kinds_of(page: str, marked: bool = False) -> Counter:
    """(kind, in the text) -> occurrences, if the page is labelled: by marks
    or by its one article (or main) element."""
    sequence, holder = read(page, marked)
    counts: Counter = Counter()
    if not marked and holder not in WHOLE:
        return counts
    on = not marked
    for t, kind, n in sequence:
        if t.text is None and t.kind in MARKS:
            on = t.kind == MARKS[0]
        elif kind.startswith("word"):
            counts[kind, on and "@" not in kind] += n
        else:
            counts[kind, on and (marked or "@" not in kind or kind.endswith(":in"))] += 1
    return counts


def weights_of(counts: Iterable[tuple[str, bool, int]]) -> dict[str, int]:
    """Scores in thousandths; a word kind of score 0 in a zone is no text."""
    seen: dict[str, list[int]] = {}
    for kind, inside, n in counts:
        seen.setdefault(kind, [0, 0])[not inside] += n
    out = {}
    for kind, (inside, outside) in seen.items():
        odds = math.log((inside + 1) / (outside + 1))
        low, high = (TAG_LEAST, TAG_MOST) if not kind.startswith("word") else (0.0 if "@" in kind else WORD_LEAST, WORD_MOST)
        out[kind] = round(UNIT * min(max(odds, low), high))
    return out


def hand_marked() -> Counter:
    total: Counter = Counter()
    for page in LABELLED:
        total.update(kinds_of(page, marked=True))
    return total


def score(kind: str, weights: dict[str, int]) -> int:
    """Score of a tag or of one word; kinds that no labelled page shows get
    a middling one, of zones and links none."""
    found = weights.get(kind)
    if found is not None:
        return found
    word = kind.startswith("word")
    return 0 if word and ("@" in kind or ":link" in kind) else round(UNIT * (UNSEEN if word else -UNSEEN))


def extract(page: str, weights: dict[str, int]) -> str:
    """The main text of one page."""
    sequence, _ = read(page)
    best = running = 0
    first = last = start = 0
    for i, (t, kind, n) in enumerate(sequence):
        word = kind.startswith("word")
        running += score(kind, weights) * (n if word else 1)
        if running < 0:
            running, start = 0, i + 1
        elif word and running > best:
            best, first, last = running, start, i + 1
    blocks: list[str] = []
    block: list[str] = []
    for t, kind, _ in sequence[first:last]:
        if t.text is None:
            if t.part and block:
                blocks.append("".join(block))
                block = []
        elif "@" not in kind or score(kind, weights) > 0:
            block.append(t.text)
    blocks.append("".join(block))
    return "\n\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def fit(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> dict[str, int]:
    """Scores of the kinds of words and tags, from the labelled ones of about
    ``sample_pages`` pages, chosen by hash, and the hand-marked pages."""
    rows = pages.count()
    column = text_or_empty(html_col)
    sample = pages.select(column.alias("html")).where(F.pmod(F.xxhash64("html"), F.lit(max(rows, 1))) < sample_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for page in b["html"].to_pylist():
                total.update(kinds_of(page))
        columns = [[k for k, _ in total], [i for _, i in total], list(total.values())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.bool_(), pa.int64()))],
                                         names=["kind", "inside", "n"])

    counted = sample.mapInArrow(run, "kind string, inside boolean, n long").groupBy("kind", "inside").agg(F.sum("n").alias("n"))
    learnt = [(r["kind"], r["inside"], r["n"]) for r in counted.collect()]  # a few hundred kinds
    return weights_of([*learnt, *((k, i, n) for (k, i), n in hand_marked().items())])


def main_text(pages: DataFrame, weights: dict[str, int], html_col: str = "html", output: str = "text") -> DataFrame:
    """``pages`` with the main text of every page and its code points."""

    @F.pandas_udf("string")
    def texts(column):
        return column.map(lambda page: extract(page, weights))

    found = pages.withColumn(output, texts(text_or_empty(html_col)))
    return found.withColumn("n_chars", F.char_length(F.col(f"`{output}`")).cast("long"))
