"""Main text of web pages, by nearest-URL page differencing.

Pages are sorted by host and URL path, and each is paired with the nearest pages on
its host, before and after it, that are no copies of it. Their text lines are aligned by a
longest common subsequence, and lines of all are the site's template. A page's article is
what stands in its `article` or `main` element; in a page without one, it is every
line that is not in the template.

Differencing alone gives wrong results on pages whose menus differ, and deletes
passages that two articles share. So elements that say what they are (menus, adverts,
forms and so on) go by that, and shared lines inside an `article` or `main` stay.
Pages next to each other that share nine tenths of their text are copies: they say nothing
about a template, and share the partners of their run. Copies that fill a whole range
of the order (`neighbours.py`) have none, and keep their lines.
"""

from __future__ import annotations

import json
import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.llm.common import each, rows, small_batches
from loanbook.llm.neighbours import OWN, beside

# Element names of the HTML standard.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style noscript template title textarea iframe svg math object select datalist head".split())
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
_LANDMARKS = {"article", "main"}
#: Elements, roles and words of a class or id that are no part of an article.
_ASIDE = set("nav footer aside form menu dialog search button".split())
_ROLES = set("navigation banner contentinfo complementary search form dialog alert".split())
_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|alert|popup|modal|overlay"
    r"|nav\w*|menu\w*|breadcrumbs?|pagination|pager|sidebar\w*|side|widget\w*|footer\w*|masthead|toolbar"
    r"|comments?|commentlist|replies|reply|respond|disqus|share\w*|social\w*|related\w*|recommended|newsletter"
    r"|subscribe\w*|subscription|signup|login|search\w*)(?:$|[\s_-])",
    re.IGNORECASE,
)
_HEADER = re.compile(r"(?:^|[\s_-])(?:site|page|top|global)[_-]?header(?:$|[\s_-])|^header$", re.IGNORECASE)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)

_COMMENTS = re.compile(r"comment|repl(?:y|ies)|respond|disqus", re.IGNORECASE)
_REPLIES = "#replies"
#: Elements in which an `article` is not the page's.
_HOSTILE = {"aside", _REPLIES}

#: Bits of a table of two pages' lines that are kept at once.
TABLE = 2**28
#: Zones of a line: in an article, anywhere else, in an element that is no article.
ARTICLE, PLAIN, OTHER = 2, 1, 0


def _is_aside(name: str, attributes: str, zone: int) -> bool:
    if name in _ASIDE or (name == "header" and zone != ARTICLE):
        return True
    if name in ("html", "body") or not attributes:
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "").strip()
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return True
        if key == "role" and value.lower() in _ROLES:
            return True
        if key in ("class", "id") and (_NAMES.search(value) or (zone != ARTICLE and _HEADER.search(value))):
            return True
    return False


def lines_of(html: str | None) -> list[tuple[int, str]]:
    """`(zone, text)` of each block with text, in page order."""
    found: list[tuple[int, str]] = []
    open_: list[tuple[str, int]] = []  # elements and the zone inside them
    parts: list[str] = []
    zone, at, html = PLAIN, 0, html or ""

    def end_block() -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            found.append((zone, text))
        parts.clear()

    while True:
        match = _TOKEN.search(html, at)
        parts.append(html[at : match.start()] if match else html[at:])
        if not match:
            break
        at = match.end()
        closing, name, attributes = match.group(1), (match.group(2) or "").lower(), match.group(3)
        if not name:
            continue
        if name in _BLOCKS:
            end_block()
        if name == "br":
            parts.append(" ")
        if closing:
            for i in range(len(open_) - 1, -1, -1):
                if open_[i][0] == name:
                    del open_[i:]
                    zone = open_[-1][1] if open_ else PLAIN
                    break
        elif name in _RAW and name != "head":
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.IGNORECASE).search(html, at)
                at = end.end() if end else len(html)
        elif name not in _VOID and not attributes.endswith("/"):
            if name == "p" and open_ and open_[-1][0] == "p":
                open_.pop()
                zone = open_[-1][1] if open_ else PLAIN
            inside = zone
            if _is_aside(name, attributes, zone):
                inside = OTHER
            elif name in _LANDMARKS and not any(tag in _HOSTILE for tag, _ in open_):
                inside = ARTICLE
            if inside == OTHER and _COMMENTS.search(attributes):
                open_.append((_REPLIES, inside))
            if name in _BLOCKS:
                open_.append((name, inside))
                zone = inside
            elif inside != zone:
                end_block()
                open_.append((name, inside))
                zone = inside
    end_block()
    return found


def _grown(a: list[str], b: list[str]) -> Iterator[int]:
    """For each beginning of `a`: bits of the places in `b` where the subsequence does not grow."""
    places: dict[str, list[int]] = {}
    for j, line in enumerate(b):
        places.setdefault(line, []).append(j)

    @lru_cache(maxsize=256)
    def bits(line: str) -> int:
        at = places.get(line, ())
        if len(at) < 2:
            return 1 << at[0] if at else 0
        marked = np.zeros(len(b), dtype=np.uint8)
        marked[at] = 1
        return int.from_bytes(np.packbits(marked, bitorder="little").tobytes(), "little")

    full = still = (1 << len(b)) - 1
    for line in a:
        met = still & bits(line)
        still = ((still + met) | (still - met)) & full
        yield still


def _lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of `a` and each beginning of `b`."""
    still = deque(_grown(a, b), maxlen=1)[0]
    stays = np.frombuffer(still.to_bytes(len(b) // 8 + 1, "little"), dtype=np.uint8)
    grows = 1 - np.unpackbits(stays, bitorder="little")[: len(b)].astype(np.int64)
    return np.concatenate([[0], np.cumsum(grows)])


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in `a` of a longest common subsequence with `b`.

    Rows of the usual table are kept as bits, one for each line of `b`. Where they would
    take more than `TABLE` bits, `a` is halved and `b` cut where both halves together
    reach the whole length, so memory stays bounded for pages of any length.
    """
    first = 0
    while first < len(a) and first < len(b) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    out = {*range(first), *range(len(a) - last, len(a))}
    b = b[first : len(b) - last]
    there = set(b)
    kept = [i for i in range(first, len(a) - last) if a[i] in there]
    own = [a[i] for i in kept]
    there = set(own)
    b = [line for line in b if line in there]
    if not own:
        return out
    if len(own) * len(b) > TABLE and len(own) > 1:
        half = len(own) // 2
        cut = int(np.argmax(_lengths(own[:half], b) + _lengths(own[half:][::-1], b[::-1])[::-1]))
        out |= {kept[i] for i in common_lines(own[:half], b[:cut])}
        return out | {kept[half + i] for i in common_lines(own[half:], b[cut:])}
    table, j = [(1 << len(b)) - 1, *_grown(own, b)], len(b)
    i = len(own)
    while i and j:
        if table[i] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if table[i] >> (j - 1) & 1:
                out.add(kept[i])
                j -= 1
    return out


def main_lines(lines: list[tuple[int, str]]) -> list[str]:
    """Lines in an article; without one, those not known to be boilerplate."""
    return [text for zone, text in lines if zone == ARTICLE] or [text for zone, text in lines if zone == PLAIN]


def are_copies(a: list[str], b: list[str]) -> bool:
    """Whether at least nine tenths of the text of each are lines of the other."""

    def within(x: list[str], y: list[str]) -> bool:
        known = set(y)
        return 10 * sum(len(line) for line in x if line in known) >= 9 * sum(map(len, x))

    return within(a, b) and within(b, a)


def article(lines: list[tuple[int, str]], partners: list[list[tuple[int, str]]]) -> str:
    """The article in a page's lines, given other pages of its site that are no copies.

    Lines shared with all partners are the template, as one page may have a passage
    of the article too. With one partner, a page that shares half of its text or more may
    be an edited copy of it, so nothing is deleted.
    """
    own = main_lines(lines)
    if any(zone == ARTICLE for zone, _ in lines) or not partners:
        return "\n".join(own)
    template = set.intersection(*[common_lines(own, [text for _, text in partner]) for partner in partners])
    if len(partners) == 1 and 2 * sum(len(own[i]) for i in template) >= sum(map(len, own)):
        template = set()
    return "\n".join(text for i, text in enumerate(own) if i not in template)


def extract(pages: DataFrame) -> DataFrame:
    """`page_id, url, text, n_chars` of every page, from its whole html.

    White space inside a block becomes one space, blocks are joined by one `\\n`, and
    character references are decoded. A null or empty html, or one without an article,
    has the empty text. A page whose url is null or names no host, or that is alone on
    its host but for copies, is paired with none. Repeated rows give a row each and are
    copies of each other. An empty table gives an empty result.
    """
    small_batches(pages.sparkSession)
    address = r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^?#]*)"
    given = pages.select(
        "page_id", "url", "html",
        F.lower(F.coalesce(F.regexp_extract("url", address, 1), F.lit(""))).alias("_host"),
        F.coalesce(F.regexp_extract("url", address, 2), F.lit("")).alias("_path"),
    )
    keys = ["_host", "_path", "page_id"]
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("_host", pa.string()), ("_path", pa.string()), ("packed", pa.binary()),
    ])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            out = [
                (page_id, url, host, path, packer.compress(json.dumps(lines_of(html)).encode()))
                for page_id, url, html, host, path in each([batch], "page_id", "url", "html", "_host", "_path")
            ]
            if out:
                yield rows(schema, **dict(zip(schema.names, zip(*out))))

    result = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdDecompressor()

        def unpacked(packed: bytes) -> list[tuple[int, str]]:
            return json.loads(packer.decompress(packed))

        def runs() -> Iterator[tuple]:
            """Pages of a range and host next to each other that are copies, with their main lines."""
            run, site, head = [], None, []
            for place, side, page_id, url, host, packed in each(
                batches, "_range", "_side", "page_id", "url", "_host", "packed"
            ):
                own = main_lines(unpacked(packed))
                if not own:  # says nothing about a template
                    yield None, [(side, page_id, url, packed)]
                    continue
                if run and (host == "" or (place, host) != site or not are_copies(head, own)):
                    yield site, run
                    run = []
                if not run:
                    site, head = (place, host), own
                if run and run[-1][-1] == packed:
                    packed = run[-1][-1]  # equal pages are kept once
                run.append((side, page_id, url, packed))
            if run:
                yield site, run

        def texts() -> Iterator[tuple]:
            before, now = None, None
            for after in chain(runs(), (None,)):
                if after is not None and after[0] is None:
                    yield from resolved(None, after, None)
                    continue
                if now is not None:
                    yield from resolved(before, now, after)
                before, now = now, after

        def resolved(before, now, after) -> Iterator[tuple]:
            site, run = now
            partners = [
                unpacked(beside_it[1][at][-1])
                for beside_it, at in ((before, -1), (after, 0))
                if beside_it is not None and beside_it[0] == site and site[1]
            ]
            for side, page_id, url, packed in run:
                if side == OWN:
                    text = article(unpacked(packed), partners)
                    yield page_id, url, text, len(text)

        out = []
        for row in texts():
            out.append(row)
            if len(out) == 256:
                yield rows(result, **dict(zip(result.names, zip(*out))))
                out = []
        if out:
            yield rows(result, **dict(zip(result.names, zip(*out))))

    parsed = given.mapInArrow(parse, "page_id long, url string, _host string, _path string, packed binary")
    ordered = beside(parsed, keys, cut_by=given.select(*keys))
    return ordered.mapInArrow(difference, "page_id long, url string, text string, n_chars long")
