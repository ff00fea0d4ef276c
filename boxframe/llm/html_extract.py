"""Main text of web pages by markup and a host's suffix array.

A page is cut into blocks (paragraphs, headings, items, cells). Blocks in
menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments go by their markup. A page that names its article
(``article``, ``main``) gives the blocks in it; others give all remaining ones.

What markup does not tell, the host does: the suffixes of the token streams of
a host's pages are sorted to a depth of ``Rules.run`` tokens (by a hash of these), and
equal neighbours are substrings that repeat across pages. Windows repeated on
enough distinct pages are boilerplate; a block mostly covered by them goes, the
others stay whole and in order. Blocks shorter than a window (menu items) are
compared as wholes. Pages whose kept blocks are equal count as one
page, so copies of an article don't make it boilerplate, and a window inside a
named article must be on most pages of the host. On pages that name no article,
the same holds between the first and the last block that is the page's own;
``left_out`` has the rules.

All suffixes of all of a host's pages are counted, by the same rules for hosts of any size. They are dealt
over tasks by their hashes (``parts``), so that a host with a third of all pages is
several tasks, packed to 5 bytes each; what a host repeats goes back to its pages.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.llm.common import map_arrow, slices, small
from boxframe.session import cut_lineage, cut_lineage_observed

#: Elements that start a block.
BLOCKS = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead title tr ul caption"
).split())
#: Elements whose text is never part of the article.
CHROME = frozenset((
    "nav aside footer form button select textarea head title menu dialog search datalist fieldset label legend map object audio "
    "video canvas progress meter template iframe"
).split())
#: Elements whose content is no markup.
RAW = "script|style|noscript|template|svg|annotation|annotation-xml|iframe|textarea|xmp|noembed|noframes"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class and id names, and roles, that mark what is not the article.
MARKS = frozenset((
    "ad ads advert adverts advertisement advertising advertorial banner sponsor sponsored sponsors promo promotion sidebar sidebars "
    "nav navbar navigation menu menus breadcrumb breadcrumbs footer header masthead topbar toolbar pagination pager notice notices "
    "cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations comment comments commentlist disqus replies respond widget widgets skip copyright hidden"
).split())
#: Of these, what holds readers' comments, however much.
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
#: Within a named article, only these elements can be marked by a class or id, which must be one of MARKS as it stands.
CONTAINERS = frozenset("div section article aside nav ul ol dl menu details figure center fieldset".split())
#: Of MARKS, what names a part of the article there.
PARTS = frozenset("header banner masthead notice notices skip copyright share social widget".split())
#: As a whole class or id, these name an advert, however much text it has.
ADVERTS = frozenset("ad ads advert adverts advertisement advertising".split())
#: Class names that tell what a page has or which state it is in, not what the element is.
STATE = re.compile(r"(?:has|with|without|no|not)(?:[-_]|(?=[A-Z])).*|.*[-_](?:open|closed)", re.S)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
#: What an article may stand in without being part of it, if only by an element that was never closed.
FIRM = frozenset("aside form footer".split())

TOKEN = re.compile(
    rf"<!--.*?(?:-->|$)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^>]*>?|<(?P<raw>{RAW})\b[^>]*?(?:/>|>.*?(?:</(?P=raw)\s*>|$))"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
XMP = re.compile(r"^<xmp\b[^>]*>|</xmp\s*>$", re.I)
ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"

NO_MARK, NAME, COMMENT, FIRM_MARK = 0, 1, 2, 3  # what marks an element: nothing, its names, names of comments or adverts, its attributes

PRINT_BITS = 38  # of a hash; the last two bits of 40 are its kind
PART_PAGES = 8_000  # pages of a host whose suffixes are sorted together, about
SHARE_PAGES = 2_000  # pages of a host that meet what it repeats in one task, about, if that is not broadcast
KNOWN_BYTES = 32_000_000  # of all hosts' repeats that are broadcast
IS_SHORT, ASKED, TEMPLATE = 1, 2, 4  # a whole short block; in open text somewhere; by at least half outside of articles
MOST, ENOUGH, PLAIN = 1, 2, 4  # what a repeat is enough for: all blocks; open ones; open ones of pages with marked menus or headers
WHOLE = 0x5DEECE66D  # seed of the hashes of whole blocks

ARTICLE, OPEN, OUTSIDE = 0, 1, 2  # kinds of blocks: in a named article, on a page that names none, not of the article
SHORT = 3  # whole blocks shorter than a window


@dataclass(frozen=True)
class Rules:
    run: int = 8  # tokens of a repeated substring
    open_pages: float = 0.2  # share of a host's pages (3 at least) that make an open block's window boilerplate
    most_open: int = 40  # pages that do so whatever their share, on pages without any marked menu or header
    article_pages: float = 0.6  # the same (5 at least) within a named article
    covered: float = 0.5  # share of a block's tokens
    least: int = 5  # pages that make an open block's window boilerplate on pages with marked menus or headers
    own: int = 8  # tokens of a block that the host does not repeat from which on it bounds a page's text


def _marked(tag: str, attrs: str, inside: bool = False) -> int:
    """What marks an element. ``inside`` a named article, a name marks containers only, by a whole class or id."""
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return NO_MARK
    found = NO_MARK
    for name, a, b, c in ATTR.findall(attrs):
        value, name = a or b or c, name.lower()
        if name == "role":
            if value.strip().lower() in ROLES:
                return FIRM_MARK
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return FIRM_MARK
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return FIRM_MARK
        elif name in ("class", "id") and tag not in ("body", "html", "main"):
            if inside:
                words = {y.lower() for y in value.split()} - PARTS if tag in CONTAINERS else set()
            else:
                words = {x.lower() for y in value.split() if not STATE.fullmatch(y) for x in NAMES.findall(y)}
            if not COMMENTS.isdisjoint(words) or tag != "article" and not ADVERTS.isdisjoint(value.lower().split()) and not (inside and tag not in CONTAINERS):
                found = COMMENT
            elif not MARKS.isdisjoint(words):
                found = max(found, NAME)
    return found


def parse(page: str) -> list[tuple[str, int]]:
    """Blocks of a whole page in order: (text, kind). White space is one space, character references are decoded.

    Names don't mark ``main`` (and its role) nor an element that holds most of
    the page's text (without links), unless they are those of comments; a
    marked ``article`` counts if no other has text.
    """
    found, spared = _parse(page, frozenset())
    return _parse(page, spared)[0] if spared else found


def _parse(page: str, spare: frozenset[int]) -> tuple[list[tuple[str, int]], frozenset[int]]:
    """The blocks, and the places of the elements whose names should not mark them; ``spare`` are those known."""
    blocks: list[tuple[list[str], int]] = []
    stack: list[tuple[str, int, int]] = []  # element, depth of what is left out, depth of articles (with it)
    out = inside = named = 0
    now: list[str] = []
    # Elements marked by names: place, the one around it, whether an article, whether of comments, characters of text in it.
    marks: list[list[int]] = []
    around: list[tuple[int, int]] = []  # of every element of the stack: marked one around it (or -1), depth of what is left out for sure
    links = total = 0

    def add(text: str) -> None:
        nonlocal total
        now.append(text)
        if not links and not (around and around[-1][1]):
            n = len(text.strip())
            total += n
            if around and around[-1][0] >= 0:
                marks[around[-1][0]][4] += n

    def close() -> None:
        if now and out and any(x[0] == "title" for x in stack):
            now.clear()  # the page's name repeats its heading and is no sign of a template
        elif now:
            blocks.append((now[:], OUTSIDE if out else ARTICLE if inside else OPEN))
            now.clear()

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(html.unescape(page[at : m.start()]))
        at = m.end()
        if m["cdata"]:
            add(m["cdata"])
        if m["raw"] and m["raw"].lower() == "xmp":  # shows its content as it stands
            close()
            add(XMP.sub("", m[0]))
            close()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            now.append(" ")
            continue
        if tag == "a":
            links = not m["end"]
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    before = stack[k - 1][1:] if k else (0, 0)
                    if before != (out, inside) or not BLOCKS.isdisjoint(x[0] for x in stack[k:]):
                        close()
                    del stack[k:], around[k:]
                    out, inside = before
                    break
            else:
                if tag in BLOCKS:
                    close()
            continue
        attrs = m["attrs"]
        main = tag == "main" or "role" in attrs and re.search(r"role\s*=\s*[\"']?main\b", attrs, re.I) is not None
        article, mark = main or tag == "article", _marked(tag, attrs, inside > 0)
        named_so = mark in (NAME, COMMENT) and not main and m.start() not in spare
        firm = tag in CHROME or tag == "header" and not inside or mark == FIRM_MARK
        gone = firm or named_so
        if tag in BLOCKS or gone:
            close()
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
            continue
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):  # these end their like
            for k in range(len(stack) - 1, max(-1, len(stack) - 4), -1):
                if stack[k][0] == tag:
                    del stack[k:], around[k:]
                    out, inside = (stack[-1][1], stack[-1][2]) if stack else (0, 0)
                    break
                if stack[k][0] in BLOCKS:
                    break
        if article and not gone and out and not any(x[0] in FIRM for x in stack):
            out = 0  # a menu or header that was never closed
            around.append((-1, 0))
        else:
            around.append(around[-1] if around else (-1, 0))
        if named_so:
            marks.append([m.start(), around[-1][0], tag == "article", mark == COMMENT, 0])
        around[-1] = len(marks) - 1 if named_so else around[-1][0], around[-1][1] + firm
        out += gone
        inside += article and not out
        named |= article and not out
        stack.append((tag, out, inside))
    if at < len(page):
        add(html.unescape(page[at:]))
    close()
    found = []
    for parts, kind in blocks:
        text = " ".join("".join(parts).split())
        if text:
            found.append((text, OUTSIDE if named and kind == OPEN else kind))
    for own in reversed(marks):  # what is in an element is in the one around it
        if own[1] >= 0 and not own[3]:
            marks[own[1]][4] += own[4]
    none = not any(kind == ARTICLE for _, kind in found)
    return found, frozenset(x[0] for x in marks if not x[3] and (2 * x[4] > total or x[2] and none and x[4]))


def suffixes(blocks: list[tuple[str, int]], run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the first ``run`` tokens of a page's suffixes by their start, and every token's kind and block."""
    tokens = [t.lower().split(" ") for t, _ in blocks]
    size = [len(x) for x in tokens]
    number = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(tokens)), np.uint64, sum(size))
    kind = np.repeat(np.array([k for _, k in blocks], np.int8), size)
    block = np.repeat(np.arange(len(blocks)), size)
    n = max(0, len(number) - run + 1)
    out = np.zeros(n, np.uint64)
    for k in range(run):
        out = out * np.uint64(0x9E3779B97F4A7C15) + number[k : k + n]
    return out, kind, block


def short_blocks(blocks: list[tuple[str, int]], run: int) -> list[int]:
    """Places of the blocks of a page that are too short for a window and not outside: menu items, bylines, short lines."""
    return [b for b, (t, k) in enumerate(blocks) if k != OUTSIDE and t.count(" ") + 1 < run]


def codes_of(blocks: list[tuple[str, int]], rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """What a page shows to its host: prints of its suffixes and whole short blocks, and their kinds (``SHORT`` for the blocks)."""
    own, kind, _ = suffixes(blocks, rules.run)
    short = np.array([short_print(blocks[b][0]) for b in short_blocks(blocks, rules.run)], np.uint64)
    return np.concatenate((prints(own), short)), np.concatenate((kind[: len(own)], np.full(len(short), SHORT, np.int8)))


def prints(own: np.ndarray) -> np.ndarray:
    """The upper bits of hashes, whose lower ones are the weaker of a product."""
    return own >> np.uint64(64 - PRINT_BITS)


def short_print(text: str) -> int:
    return xxhash.xxh64_intdigest(text.lower().encode("utf-8", "surrogatepass"), WHOLE) >> 64 - PRINT_BITS


def tally(code: np.ndarray, kind: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prints that repeat, sorted, on how many contents each is, and what it is (bits ``IS_SHORT``, ``ASKED``, ``TEMPLATE``).

    ``code``, ``kind`` and ``content``: a row for every place of them on the host's pages.
    """
    order = np.lexsort((content, code))
    code, kind, content = code[order], kind[order], content[order]
    first = np.append(True, code[1:] != code[:-1])[: len(code)]
    group = np.cumsum(first) - 1
    often = np.bincount(group[first | np.append(True, content[1:] != content[:-1])[: len(code)]])
    total, outside, asked = np.bincount(group), np.bincount(group, kind == OUTSIDE), np.bincount(group, (kind == OPEN) | (kind == SHORT)) > 0
    what = IS_SHORT * (kind[first] == SHORT) + ASKED * asked + TEMPLATE * (outside * 2 >= total)
    kept = often > 1
    return code[first][kept], often[kept].astype(np.int64), what[kept].astype(np.int8)


def enough(often: np.ndarray, what: np.ndarray, whole: int, rules: Rules) -> np.ndarray:
    """For what prints of ``tally`` are repeated enough on a host of ``whole`` contents: bits ``MOST``, ``ENOUGH``, ``PLAIN``."""
    suffix, asked = what & IS_SHORT == 0, what & ASKED > 0
    some = np.maximum(3, rules.open_pages * whole)
    open_ = (often >= min(some, max(3, rules.most_open))) | suffix & (what & TEMPLATE > 0)
    plain = (often >= some) & (~suffix | (often >= rules.least))
    most = often >= max(5, rules.article_pages * whole)
    return (MOST * most + ENOUGH * (open_ & asked) + PLAIN * (plain & asked)).astype(np.int8)


def covered(blocks: list[tuple[str, int]], known: np.ndarray, bits: np.ndarray, rules: Rules) -> tuple[list[bool], ...]:
    """For the blocks of a page whether the host's repeats cover them: with and without regard to what other pages' markup
    says of a repeat, and by repeats on most pages. Within a named article and outside only the last count.

    ``known``, ``bits``: the prints that the page's host repeats, sorted, and those of ``enough``.
    """
    own, kind, block = suffixes(blocks, rules.run)

    def found(code: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(known, code), max(0, len(known) - 1))
        return np.where(known[at] == code, bits[at], 0) if len(known) else np.zeros(len(code), np.int8)

    got = found(prints(own))
    size = np.maximum(1, np.bincount(block, minlength=len(blocks)))

    def flags(bit: int) -> list[bool]:
        hit = np.flatnonzero(np.where(kind[: len(own)] == OPEN, got & bit, got & MOST))
        cover = np.zeros(len(kind) + 1, np.int64)
        cover[hit] += 1
        cover[hit + rules.run] -= 1
        return (np.bincount(block[np.cumsum(cover[:-1]) > 0], minlength=len(blocks)) / size > rules.covered).tolist()

    return flags(ENOUGH), flags(PLAIN), flags(MOST)


def short_repeats(blocks: list[tuple[str, int]], known: np.ndarray, bits: np.ndarray, rules: Rules) -> tuple[set[int], ...]:
    """The short blocks of a page whose whole text the host repeats, as ``covered`` has the others."""
    short = short_blocks(blocks, rules.run)
    code = np.array([short_print(blocks[b][0]) for b in short], np.uint64)
    at = np.minimum(np.searchsorted(known, code), max(0, len(known) - 1))
    got = np.where(known[at] == code, bits[at], 0).tolist() if len(known) else [0] * len(short)
    return tuple({b for b, g in zip(short, got, strict=True) if g & bit} for bit in (ENOUGH, PLAIN, MOST))


def boilerplate(pages: list[list[tuple[str, int]]], cells: np.ndarray, rules: Rules) -> list[list[bool]]:
    """For every block of every page whether the host's repeats cover it. ``cells``: each page's host; hosts don't mix."""
    out: list[list[bool]] = [[]] * len(pages)
    for cell in np.unique(cells).tolist():
        rows = np.flatnonzero(cells == cell).tolist()
        content = np.array([content_of(pages[i], str(i)) for i in rows])
        shown = [codes_of(pages[i], rules) for i in rows]
        code, kind = (np.concatenate(x) for x in zip(*shown, strict=True))
        known, often, what = tally(code, kind, np.repeat(content, [len(c) for c, _ in shown]))
        bits = enough(often, what, len(set(content.tolist())), rules)
        for i in rows:
            out[i] = covered(pages[i], known, bits, rules)[0]
    return out


def left_out(blocks: list[tuple[str, int]], flags: tuple[list[bool], ...], short: tuple[set[int], ...], rules: Rules) -> list[bool]:
    """The blocks of a page that the host's repeats take away; ``flags``: those of ``covered``, ``short``: of ``short_repeats``.

    A page whose markup tells no block as menu, header or the like goes by what other
    pages' markup says of the same words; on others, an open block may well quote them. Within a named article it takes repeats on most pages, and whole short
    blocks stay. On other pages the place counts: between the first and the last
    block of ``own`` tokens that the host does not repeat, the text may quote what
    other pages have too, so only repeats on most pages go; before and behind
    them stand menus and notices, where a smaller share suffices.
    """
    silent = all(k != OUTSIDE for _, k in blocks)
    most = flags[2]
    weak = [f or b in short[not silent] for b, f in enumerate(flags[not silent])]
    own = [b for b, (t, k) in enumerate(blocks) if k == OPEN and not weak[b]]
    own = [b for b in own if blocks[b][0].count(" ") + 1 >= rules.own] or own
    first, last = (own[0], own[-1]) if own else (len(blocks), -1)
    out = []
    for b, (_, k) in enumerate(blocks):
        if k == OPEN:
            out.append(most[b] or b in short[2] if first < b < last else weak[b] and b not in (first, last))
        else:
            out.append(k == ARTICLE and most[b])
    return out


def content_of(blocks: list[tuple[str, int]], other: str) -> int:
    """Number of a page's content, as in ``boilerplate``; pages without any are told apart by ``other``."""
    own = "\n\n".join(t for t, k in blocks if k != OUTSIDE)
    return xxhash.xxh64_intdigest((own or f"\0{other}").encode("utf-8", "surrogatepass"), 0 if own else 1) >> 1


def host_repeats(pages: DataFrame, rules: Rules) -> DataFrame:
    """(__host, known, bits): what each host repeats (``enough``), in rows of bounded size.

    ``pages``: __host, __key (of the row), __html of all pages. They are parsed here and once more where blocks
    are left out: their texts would take more disk than what is counted of them.
    """

    def shown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__html", max_chars=8_000_000):
            hosts: dict[str, int] = {}
            host_of, parts_of, size, content, codes, kinds = [], [], [], [], [], []
            for host, n, key, page in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                blocks = parse(page) if page else []
                code, kind = codes_of(blocks, rules)
                host_of.append(hosts.setdefault(host, len(hosts)))
                parts_of.append(parts(n))
                size.append(len(code)), content.append(content_of(blocks, key)), codes.append(code), kinds.append(kind)
            if not hosts:
                continue
            names, contents = list(hosts), np.array(content, np.int64)
            each = [np.unique(contents[np.array(host_of) == h]) for h in range(len(names))]
            none = pa.array([b""] * len(names), pa.binary())
            yield pa.RecordBatch.from_arrays(  # part -1: the contents alone
                [pa.array(names, pa.string()), pa.array(np.full(len(names), -1, np.int32)), none, none, none,
                 pa.array([x.tobytes() for x in each], pa.binary())], ["__host", "part", "low", "high", "length", "content"])
            if not sum(size):
                continue
            code, kind = np.concatenate(codes), np.concatenate(kinds)
            page = np.repeat(np.arange(len(size)), size)
            host = np.array(host_of)[page]
            part = (code % np.array(parts_of, np.uint64)[page]).astype(np.int64)
            order = np.lexsort((page, part, host))
            code, kind, page, host, part = code[order], kind[order], page[order], host[order], part[order]
            new = np.append(True, (host[1:] != host[:-1]) | (part[1:] != part[:-1]))
            start = np.flatnonzero(new)
            # a run is what a page has in the part: its length and content are kept once
            run = np.flatnonzero(new | np.append(True, page[1:] != page[:-1]))
            length, own = np.diff(np.append(run, len(code))).astype(np.uint32), contents[page[run]]
            low = (code & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            high = ((code >> np.uint64(32)).astype(np.uint8) << 2) | kind.astype(np.uint8)
            ends, runs = np.append(start[1:], len(code)), np.searchsorted(run, np.append(start, len(code)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[h] for h in host[start]], pa.string()), pa.array(part[start].astype(np.int32)), *[pa.array([x[a:b].tobytes() for a, b in zip(start, ends, strict=True)], pa.binary()) for x in (low, high)],
                 *[pa.array([x[a:b].tobytes() for a, b in zip(runs[:-1], runs[1:], strict=True)], pa.binary()) for x in (length, own)]],
                ["__host", "part", "low", "high", "length", "content"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            low, high, length, own = (np.frombuffer(b"".join(r[k] for r in rows), t) for k, t in (
                (2, np.uint32), (3, np.uint8), (4, np.uint32), (5, np.int64)))
            if rows[0][1] < 0:
                yield row(rows[0][0], len(np.unique(own)), None, None, None)
                return
            code = (high >> 2).astype(np.uint64) << np.uint64(32) | low
            found = tally(code, (high & 3).astype(np.int8), np.repeat(own, length))
            for k in range(0, len(found[0]), 100_000):
                yield row(rows[0][0], None, *[x[k : k + 100_000].tobytes() for x in found])

        def row(host: str, whole: int | None, *values: bytes | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([whole], pa.int64()), *[pa.array([v], pa.binary()) for v in values]],
                                              ["__host", "__whole", "known", "often", "what"])

        held: list[tuple] = []
        for batch in batches:
            for one in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if held and held[0][:2] != one[:2]:
                    yield from done(held)
                    held = []
                held.append(one)
        if held:
            yield from done(held)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, whole, known, often, what in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                bits = enough(np.frombuffer(often, np.int64), np.frombuffer(what, np.int8), whole, rules)
                yield pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([np.frombuffer(known, np.uint64)[bits > 0].tobytes()], pa.binary()),
                                                  pa.array([bits[bits > 0].tobytes()], pa.binary())], ["__host", "known", "bits"])

    hosts = small(pages.groupBy("__host").agg(F.count("*").alias("__pages")), 200_000, "hosts")
    packed = map_arrow(pages.join(hosts, "__host").select("__host", "__pages", "__key", "__html"), shown,
                       "__host string, part int, low binary, high binary, length binary, content binary")
    tallied = cut_lineage(map_arrow(packed.repartition("__host", "part").sortWithinPartitions("__host", "part"), counted,
                                    "__host string, __whole bigint, known binary, often binary, what binary"), "repeats", compression="zstd")
    whole = small(tallied.where("__whole is not null").select("__host", "__whole"), 200_000, "hosts")
    return map_arrow(tallied.where("known is not null").drop("__whole").join(whole, "__host").select("__host", "__whole", "known", "often", "what"),
                     judged, "__host string, known binary, bits binary")


def parts(pages: int) -> int:
    """Tasks' shares of what a host of so many pages shows: a power of two. They deal the work only, each print is in one."""
    return 1 << (max(1, -(-pages // PART_PAGES)) - 1).bit_length()


def blocks_of(texts: str, digits: str) -> list[tuple[str, int]]:
    """A page's blocks, from their lines and kinds."""
    return list(zip(texts.split("\n"), map(int, digits), strict=True)) if digits else []


def joined(chunks: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """What a host repeats, of the rows of ``host_repeats``."""
    known, bits = (np.frombuffer(b"".join(x), t) for x, t in zip(zip(*chunks, strict=True) if chunks else ((), ()), (np.uint64, np.int8), strict=True))
    order = np.argsort(known)
    return known[order], bits[order]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules: Rules = Rules()) -> DataFrame:
    """id, url, ``text`` (blocks joined by two line ends) and ``n_chars`` (code points) of every row.

    NULL and empty pages give an empty text. Pages without a readable host
    (NULL urls too) are one host of their own. Repeated rows count as one page
    and give equal results.
    """
    spark, kinds = pages.sparkSession, dict(pages.dtypes)
    names = [id_col, url_col, "__host"]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__html"):
            found = [parse(x) if x else [] for x in batch.column(3).to_pylist()]
            # A block has no line end, so a page's blocks are lines; their kinds are one digit each.
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(["\n".join([t for t, _ in x]) for x in found], pa.string()),
                 pa.array(["".join([str(k) for _, k in x]) for x in found], pa.string())], [*names, "__texts", "__kinds"])

    def left(batch: pa.RecordBatch, known: dict[str, tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        """The result rows of pages (id, url, host, texts, kinds)."""
        texts, nothing = [], joined([])
        for host, lines, digits in zip(*[batch.column(k).to_pylist() for k in (2, 3, 4)], strict=True):
            page, own = blocks_of(lines, digits), known.get(host, nothing)
            gone = left_out(page, covered(page, *own, rules), short_repeats(page, *own, rules), rules) if page else []
            texts.append("\n\n".join(t for (t, k), g in zip(page, gone, strict=True) if k != OUTSIDE and not g))
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                          [id_col, url_col, "text", "n_chars"])

    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), HOST, 1)), F.lit(""))
    key = F.concat_ws(" ", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(url_col), F.lit("")))
    own = pages.select(F.col(id_col), F.col(url_col), host.alias("__host"), key.alias("__key"), F.col(html_col).alias("__html"))
    known, total = cut_lineage_observed(host_repeats(own.select("__host", "__key", "__html"), rules), "repeats", size=F.sum(F.length("known")))
    rows, schema = own.select(*names, "__html"), f"`{id_col}` {kinds[id_col]}, `{url_col}` string, text string, n_chars bigint"
    if (total["size"] or 0) <= KNOWN_BYTES:
        shared = spark.sparkContext.broadcast(known.toArrow().to_pydict())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chunks: dict[str, list] = {}
            for name, *chunk in zip(*shared.value.values(), strict=True):
                chunks.setdefault(name, []).append(chunk)
            of = {name: joined(x) for name, x in chunks.items()}
            for batch in blocks(batches):
                yield left(batch, of)

        return map_arrow(rows, run, schema)

    # More than a task should hold: pages meet what their host repeats, in shares of a host's pages.
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[str, list] = {}  # of the host at hand, whose rows come before its pages
        of: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in slices(batches, "__texts"):
            at = 0
            for i, (name, chunk) in enumerate(zip(batch.column(2).to_pylist(), zip(batch.column(5).to_pylist(), batch.column(6).to_pylist()), strict=True)):
                if chunk[0] is not None:
                    if i > at:
                        yield left(batch.slice(at, i - at), of)
                    at = i + 1
                    chunks = {name: [*chunks.get(name, []), chunk]}
                    of = {}
                elif name not in of:
                    if i > at:
                        yield left(batch.slice(at, i - at), of)
                    at = i
                    of = {name: joined(chunks.get(name, []))}
            if at < batch.num_rows:
                yield left(batch.slice(at), of)

    parsed = map_arrow(rows, blocks, f"`{id_col}` {kinds[id_col]}, `{url_col}` string, __host string, __texts string, __kinds string")
    shares = small(own.groupBy("__host").agg(F.ceil(F.count("*") / SHARE_PAGES).cast("int").alias("__n")), 200_000, "hosts")
    dealt = parsed.join(shares, "__host").withColumn("__share", F.pmod(F.xxhash64(id_col, url_col), F.col("__n")).cast("int")).drop("__n")
    spread = known.join(shares, "__host").withColumn("__share", F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
    both = dealt.unionByName(spread, allowMissingColumns=True).repartition("__host", "__share").sortWithinPartitions(
        "__host", "__share", F.col("known").isNull())
    return map_arrow(both.select(*names, "__texts", "__kinds", "known", "bits"), meet, schema)
