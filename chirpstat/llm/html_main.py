"""Operator 6: main text of HTML pages by two-pass block rules.

A page is cut into blocks at block-level tags. First pass: a block is boiler
plate if it lies in an element that holds none of the article (menus, adverts,
comments, ...; by tag, role, or a word of its class or id) or is mostly links; it
is text if it is long enough and rich enough in stop words; otherwise it stays
open. Forms and words of a page's layout (a sidebar, a widget, ...) only mark an
element: the mark is dropped if the element holds nearly all text of the page,
as site engines also name the frame of a page so. Where the words of a page fit
none of the known languages, length and link density decide alone. Second pass: open blocks take the label of the nearest decided
neighbours in the same article or main element (or in the page, where there is
none; blocks of left-out elements do not count): both agree, or only one side is decided; between two labels a heading
goes with what follows it, and the rest goes with the element they are in.
Where a page has an article or main element, blocks outside it are boiler
plate, unless they hold far more decided text: then an article element without
any is a teaser, and a main element counts as part of the page.

Defined results: null and empty pages have an empty text; markup that is cut
off ends at the page's end; repeated rows are extracted one by one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirpstat.llm.common import table

# Frequent function words of four languages, one a line.
STOP_LISTS = """
a an and are as at be but by for from had has have he her his i in is it its not of on or that the their they this to was we were which will with you
au aux avec ce ces dans de des du elle en est et eux il je la le les leur lui mais me ne nous on ou par pas pour qu que qui sa se ses son sur un une vous
als am an auf aus bei bin bis das dass dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach nicht oder sich sie sind so um und von war wie wir zu zum zur
al como con de del el en es esta este la las lo los más no o para pero por que se si sin su sus un una y ya
"""
LANGUAGES = [frozenset(line.split()) for line in STOP_LISTS.strip().splitlines()]
STOP_WORDS = frozenset().union(*LANGUAGES)

BLOCK_TAGS = frozenset("""
address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td
tfoot th thead title tr ul
""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style title textarea noscript template iframe noembed noframes xmp svg math object audio video canvas".split())
#: These end with the page if their end tag is missing; the others of RAW_TAGS are then empty.
ENDLESS_TAGS = frozenset("script style title textarea iframe noembed noframes xmp".split())
SKIP_TAGS = frozenset("aside button dialog footer head input label legend menu nav optgroup option select".split())
SKIP_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
SKIP_WORDS = frozenset("""
ad ads adv advert adverts advertisement advertising breadcrumb breadcrumbs comment comments consent cookie cookies
disqus gdpr newsletter notice notices popup promo promoted
promotion related replies reply respond share sharing signup sponsor sponsored subscribe subscription
""".split())
MARK_TAGS = frozenset(["fieldset", "form"])
MARK_WORDS = frozenset("banner footer menu modal nav navbar navigation overlay pager pagination sidebar sidenav skip social toolbar widget widgets".split())
#: A class or id with one of these describes the state of its page, not what it holds (no-sidebar, comments-open).
STATE_WORDS = frozenset("closed disabled enabled has hidden hide is no not off on open show with without".split())
CONTAINERS = frozenset(["article", "main"])
CONTAINER_SKIP_WORDS = frozenset(["comment", "comments", "reply", "ad", "related", "promo"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
#: A start tag of one of these ends an open paragraph, or an open element of its own kind.
CLOSES_P = BLOCK_TAGS - {"button", "option", "select", "optgroup", "legend", "summary"}
CLOSES_SELF = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class BlockRules:
    max_link_density: float = 0.4
    #: characters and stop-word share from which a block is decided as text
    min_text_chars: int = 70
    min_stop_density: float = 0.15
    #: a long block under this stop-word share is decided as boiler plate (outside articles)
    low_stop_density: float = 0.05
    #: a marked element is not left out if it holds this many times the text of the rest
    mark_weight: float = 4.0
    #: containers hold the article unless the rest has this many times their decided text
    container_weight: float = 2.0


@dataclass
class Block:
    text: str
    link_chars: int
    skipped: bool
    scope: int
    heading: bool
    marks: tuple[int, ...] = ()
    teaser: bool = False  # in an article (not main) element
    label: bool | None = None


def _named(value: str, words: frozenset[str]) -> bool:
    """Whether one of the names of a class or id holds one of the words and tells no state."""
    if words.isdisjoint(_SPLIT.split(value)):
        return False
    return any(not words.isdisjoint(own) and STATE_WORDS.isdisjoint(own) for own in map(_SPLIT.split, value.split()))


def _skipped(tag: str, attributes: str, in_container: bool) -> bool | None:
    """Whether an element holds nothing of the article; None if that is likely only (a mark)."""
    if tag in SKIP_TAGS or (tag == "header" and not in_container):
        return True
    marked: bool | None = None if tag in MARK_TAGS else False
    if not attributes or tag in ("html", "body"):
        return marked
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _HIDDEN.search(value)):
            return True
        if name == "role" and value.strip() in SKIP_ROLES:
            return True
        if name not in ("class", "id"):
            continue
        if _named(value, CONTAINER_SKIP_WORDS if tag in CONTAINERS else SKIP_WORDS) and tag not in HEADINGS:
            return True
        if tag not in CONTAINERS | HEADINGS and _named(value, MARK_WORDS):
            marked = None
    return marked


def blocks(page: str) -> list[Block]:
    """The blocks with text of a page, in order."""
    out: list[Block] = []
    # tag, skipped, scope, link, marks, teaser
    stack: list[tuple[str, bool, int, bool, tuple[int, ...], bool]] = [("", False, 0, False, (), False)]
    scopes = marked = 0
    parts: list[str] = []
    link_chars = 0
    heading = False

    def put(raw: str) -> None:
        nonlocal link_chars
        if raw:
            data = html.unescape(raw) if "&" in raw else raw
            parts.append(data)
            if stack[-1][3]:
                link_chars += len(data.strip())

    def close() -> None:
        nonlocal link_chars, heading
        text = " ".join("".join(parts).split())
        if text:
            _, skipped, scope, _, marks, teaser = stack[-1]
            out.append(Block(text, link_chars, skipped, scope, heading, marks, teaser))
        parts.clear()
        link_chars, heading = 0, False

    at, lower = 0, None
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            put(page[at:])
            break
        put(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        block = tag in BLOCK_TAGS
        if m[1]:
            if block:
                close()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if stack[k][0] in CONTAINERS and tag not in ("body", "html", "main", "article", "div", "section"):
                    break
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if block:
            close()
            ends = CLOSES_SELF.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    del stack[k:]
                    break
                if stack[k][0] in BLOCK_TAGS:
                    break
        closed = m[3].rstrip().endswith("/")
        if tag in RAW_TAGS:
            if closed and tag not in ENDLESS_TAGS:
                continue
            lower = lower if lower is not None else page.lower()
            end = lower.find(f"</{tag}", at) if len(lower) == len(page) else page.find(f"</{tag}", at)
            if end >= 0 or tag in ENDLESS_TAGS:
                at = len(page) if end < 0 else end
            continue
        if tag in VOID_TAGS or closed and not block:
            continue
        _, skipped, scope, link, marks, teaser = stack[-1]
        own = _skipped(tag, m[3], scope > 0)
        skipped = skipped or bool(own)
        if own is None:
            marked += 1
            marks = (*marks, marked)
        if tag in CONTAINERS and not skipped and scope == 0:
            scopes += 1
            scope, teaser = scopes, tag == "article"
        stack.append((tag, skipped, scope, link or tag == "a", marks, teaser))
        heading = heading or tag in HEADINGS
    close()
    return out


def _nearest(found: list[Block], step: int) -> list[bool | None]:
    """For each block the label of the nearest decided block before (step 1) or after it (step -1) in its element.

    Blocks of left-out elements are no neighbours: they say nothing about the text around them.
    """
    out, last = [], {}
    for b in found[::step]:
        out.append(last.get(b.scope))
        if b.label is not None and not b.skipped:
            last[b.scope] = b.label
    return out[::step]


def _leave_out(found: list[Block], rules: BlockRules) -> None:
    """Leave out the blocks of marked elements, but for elements that hold nearly all text of the page.

    Elements are judged by their decided text, the largest (then the outermost) first. One
    beside text of an article or main element is left out whatever it holds.
    """
    weight: dict[int, int] = {}
    for b in found:
        for m in b.marks:
            weight[m] = weight.get(m, 0) + (len(b.text) if b.label and not b.skipped else 0)
    dropped: set[int] = set()
    for m in sorted((m for m, w in weight.items() if w >= rules.min_text_chars), key=lambda m: (-weight[m], m)):
        rest = [b for b in found if m not in b.marks and not b.skipped and b.label is not False and not b.heading and dropped.issuperset(b.marks)]
        if not any(b.scope for b in rest) and rules.mark_weight * sum(len(b.text) for b in rest) < weight[m]:
            dropped.add(m)
    for b in found:
        if not dropped.issuperset(b.marks):
            b.skipped, b.label = True, False


def main_text(page: str | None, rules: BlockRules = BlockRules()) -> str:
    """The article of a page: its blocks, joined by line feeds."""
    if not page:
        return ""
    found = blocks(page)
    words = [_WORD.findall(b.text.lower()) for b in found]
    prose = [w for b, own in zip(found, words, strict=True) if not b.skipped and len(b.text) >= rules.min_text_chars for w in own]
    known = any(sum(w in stops for w in prose) >= rules.min_stop_density * len(prose) for stops in LANGUAGES)
    for b, own in zip(found, words, strict=True):
        stops = sum(w in STOP_WORDS for w in own) / len(own) if own else 0.0
        if b.skipped or b.link_chars > rules.max_link_density * len(b.text):
            b.label = False
        elif len(b.text) >= rules.min_text_chars and (stops >= rules.min_stop_density or not known):
            b.label = True
        elif not b.scope and len(b.text) >= rules.min_text_chars and stops < rules.low_stop_density:
            b.label = False
    _leave_out(found, rules)
    inner, outer = (sum(len(b.text) for b in found if b.label and (b.scope > 0) == own) for own in (True, False))
    inside = any(b.scope and b.label is not False for b in found) and outer <= rules.container_weight * inner
    if not inside:
        full = {b.scope for b in found if b.label}
        for b in found:
            if b.teaser and b.scope not in full:
                b.skipped, b.label = True, False
            b.scope = 0
    decided = [b.label for b in found]
    for b, label, before, after in zip(found, decided, _nearest(found, 1), _nearest(found, -1), strict=True):
        if label is not None:
            continue
        home = b.scope > 0 or not inside
        if b.scope and False not in (before, after):
            b.label = True
        elif before is None or after is None or before == after:
            b.label = home if before is None and after is None else (after if before is None else before)
        else:
            b.label = after if b.heading else b.scope > 0
    return "\n".join(b.text for b in found if b.label and (b.scope or not inside))


def extract_pages(pages: DataFrame, rules: BlockRules = BlockRules()) -> DataFrame:
    """page_id, url, text, n_chars of every row of `pages` (page_id, url, html)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h, rules) for h in batch["html"]]
            yield pd.DataFrame({
                "page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts],
            })

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInPandas(run, "page_id long, url string, text string, n_chars long")


def op6_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages"))
