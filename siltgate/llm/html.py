"""Main text of web pages by two passes of rules over text blocks.

The first pass decides blocks by stop-word density, length and link density; short blocks and
those in between stay undecided. The second gives each undecided block the label of its nearest
decided neighbours. Elements that name themselves menus, adverts, comments and so on never count.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, StringType, StructType

from siltgate.llm.base import annotate

# Common words of the languages the pages are written in; a parameter of ``extract``.
STOP_WORDS = {
    "en": "a an and are as at be but by for from had has have he her his i in is it not of on or she that the their they this to was we were which will with you",
    "de": "aber als am an auch auf aus bei das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach nicht oder sein sich sie sind über um und uns vom von war werden wie wir zu zum zur",
    "fr": "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour qui que sa se ses son sont sur un une vous",
    "es": "al como con de del donde el ella en entre era es esta este fue ha la las lo los más me muy no nos o para pero por que se ser si sin su sus también un una y ya",
}
SHORT = 70
LONG = 200
LOW_STOPS = 0.2
HIGH_STOPS = 0.3
LINKS = 0.4

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)(?:((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|[^>]*(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Their content is text of another kind, up to their own end tag.
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas audio video xmp noembed noframes head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# Elements that one of their own kind, or the parent's end, closes.
CLOSED_BY = {"p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
BOILERPLATE = frozenset("nav footer aside form button select input label fieldset menu search dialog datalist".split())
MAIN = frozenset("article main".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
# Words in class and id names that say what an element is.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle adsense sponsor sponsored promo promotion banner "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc "
    "sidebar aside rail widget widgets related recommended recommendations "
    "footer masthead "
    "comment comments commentlist disqus respond reply replies discussion "
    "notice notices notification cookie cookies consent gdpr alert popup modal overlay lightbox newsletter subscribe subscription signup login paywall disclaimer "
    "share sharing social form search searchform".split()
)
# Names of content that may hold one of the words above: an element that says so stays.
CONTENT = frozenset("content main article post entry story body text page wrapper container".split())
READERS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())


@dataclass
class Block:
    text: str
    linked: int
    inside: int  # number of the article or main element around it, 0 for none
    label: str = ""


def _own_words(attributes: str) -> tuple[set[str], set[str], bool]:
    """(words of class and id, roles, hidden) of a tag."""
    names, roles, hidden = set(), set(), False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
        if key in ("class", "id"):
            for name in value.split():
                if not re.match(r"(?i)(has|with|without|no|is|not)[-_]", name):
                    names.update(x.lower() for x in re.split(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])", name) if x)
        elif key == "role":
            roles.update(value.lower().split())
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"(?i)display\s*:\s*none", value):
            hidden = True
    return names, roles, hidden


def _excluded(name: str, attributes: str, inside: int) -> bool:
    if name in BOILERPLATE or name == "header" and not inside:
        return True
    if name in ("html", "body") or not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return False
    words, roles, hidden = _own_words(attributes)
    if hidden or roles & ROLES or words & READERS:
        return True
    if name in MAIN or words & CONTENT:
        return False
    return bool(words & NAMES) or "header" in words and not inside


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, without those of excluded elements."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # open elements: name, excluded, number of the main element
    parts: list[tuple[str, bool]] = []
    links = breaks = mains = 0
    excluded, inside = False, 0
    # Where each open name stands in the stack, where its blocks do, and names whose end no longer follows: no tag searches.
    places: dict[str, list[int]] = {}
    open_blocks: list[int] = []
    endless: set[str] = set()

    def flush() -> None:
        nonlocal breaks
        breaks = 0
        if parts:
            text = " ".join("".join(p for p, _ in parts).split())
            if text:
                out.append(Block(text, len("".join("".join(p for p, linked in parts if linked).split())), inside))
            parts.clear()

    def drop(at: int) -> None:
        nonlocal excluded, inside, links
        while len(stack) > at:
            name = stack.pop()[0]
            places[name].pop()
            if name in BLOCKS:
                open_blocks.pop()
            links -= name == "a"
        excluded, inside = (stack[-1][1], stack[-1][2]) if stack else (False, 0)

    def close(at: int) -> None:
        flush()
        drop(at)

    at, end = 0, len(page)
    while at < end:
        mark = page.find("<", at)
        m = TOKEN.match(page, mark) if mark >= 0 else None
        # A mark that begins no tag is text.
        upto = mark if m else end if mark < 0 else mark + 1
        if upto > at and not excluded:
            text = page[at:upto]
            if "&" in text:
                text = entities.unescape(text)
            if not text.isspace():
                breaks = 0
            parts.append((text, links > 0))
        if not m:
            at = upto
            continue
        at = m.end()
        name, attributes = (m[2] or "").lower(), m[3] or ""
        if not name:
            continue
        if m[1]:
            found = places[name][-1] if places.get(name) else None
            if found is None:
                if name in BLOCKS:
                    flush()
            elif name in BLOCKS:
                close(found)
            elif not open_blocks or open_blocks[-1] < found:
                was = excluded
                drop(found)
                if was != excluded:
                    parts.append((" ", False))
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, at) if not attributes.endswith("/") and name not in endless else None
            if not stop and not attributes.endswith("/"):
                endless.add(name)
            if stop:
                at = stop.end()
            elif name in ("script", "style"):
                at = end
            continue
        if name == "br":
            breaks += 1
            if breaks == 2:
                flush()
            elif not excluded:
                parts.append((" ", False))
            continue
        if name == "hr":
            flush()
        if name in VOID:
            continue
        if name in BLOCKS:
            # A new block ends an open paragraph, a new item the open item of the same list.
            if open_blocks and name in CLOSED_BY.get(stack[open_blocks[-1]][0], ()):
                close(open_blocks[-1])
            flush()
        if attributes.endswith("/") and name not in BLOCKS:
            continue
        if name in MAIN and not excluded and not inside:
            mains += 1
            inside_now = mains
        else:
            inside_now = inside
        excluded = excluded or _excluded(name, attributes, inside)
        inside = inside_now
        places.setdefault(name, []).append(len(stack))
        if name in BLOCKS:
            open_blocks.append(len(stack))
        stack.append((name, excluded, inside))
        links += name == "a"
    flush()
    return out


def _decide(block: Block, stops: frozenset[str]) -> str:
    """First pass: good, bad, or undecided (short or near)."""
    size = len(block.text)
    links = block.linked / max(1, len(block.text.replace(" ", "")))
    if links > LINKS:
        return "bad"
    if size < SHORT:
        return "bad" if links > 0 and not block.inside else "short"
    words = re.findall(r"[^\W\d_]+", block.text.lower())
    density = sum(w in stops for w in words) / max(1, len(words))
    if density >= HIGH_STOPS:
        return "good" if size > LONG else "near"
    if density >= LOW_STOPS:
        return "near"
    # In an article plain text of few stop words is undecided; outside, it is no prose.
    return "short" if block.inside else "bad"


def classify(found: list[Block], stops: frozenset[str]) -> list[Block]:
    """Second pass: labels good and bad. Neighbours are looked for inside the same article, or outside of all."""
    for block in found:
        block.label = _decide(block, stops)
    by_place: dict[int, list[Block]] = {}
    for block in found:
        by_place.setdefault(block.inside, []).append(block)
    for place, members in by_place.items():
        first = [b.label for b in members]
        decided = [i for i, label in enumerate(first) if label in ("good", "bad")]
        n = 0
        for i, block in enumerate(members):
            if first[i] in ("good", "bad"):
                continue
            while n < len(decided) and decided[n] < i:
                n += 1
            around = [decided[k] for k in (n - 1, n) if 0 <= k < len(decided)]
            nearest = min((abs(k - i) for k in around), default=0)
            labels = {first[k] for k in around if abs(k - i) == nearest}
            if place or not labels:
                # Nothing speaks against it, or it stands in an article, where only links do.
                good = True
            elif first[i] == "near":
                good = labels != {"bad"} or first[i - 1 : i] == ["near"] or first[i + 1 : i + 2] == ["near"]
            else:
                good = labels == {"good"}
            block.label = "good" if good else "bad"
    return found


def main_text(page: str | None, stops: frozenset[str]) -> str:
    """The page's article; where a page marks articles, blocks outside them are not part of it."""
    if not page:
        return ""
    found = classify(blocks(page), stops)
    if any(b.inside and b.label == "good" for b in found):
        found = [b for b in found if b.inside]
    return "\n\n".join(b.text for b in found if b.label == "good")


def extract(pages: DataFrame, html: str = "html", into: str = "_main", stop_words: dict[str, str] = STOP_WORDS) -> DataFrame:
    """``pages`` plus a struct ``into``: the main text and how many blocks it and the page have.

    NULL, empty and unreadable pages have the empty text. Whole pages are read whatever their length;
    rows, repeats and other columns stay as they are, and nothing is shuffled.
    """
    stops = frozenset(w for words in stop_words.values() for w in words.split())
    fields = StructType().add("text", StringType()).add("n_blocks", IntegerType())

    def work(pages: pa.Array) -> list[pa.Array]:
        texts = [main_text(p.as_py(), stops) for p in pages]
        return [pa.array(texts, pa.string()), pa.array([t.count("\n\n") + 1 if t else 0 for t in texts], pa.int32())]

    return annotate(pages, html, into, fields, lambda: work)
