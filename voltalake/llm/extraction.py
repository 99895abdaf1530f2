"""Main text of web pages by differencing with the page of the nearest URL.

1. A page's markup becomes text lines, one for each block element. Scripts,
   styles and the like have no lines. Where the page names its main part
   (``article``, ``main``), only that part counts; elements that name
   themselves as menus, headers, footers, sidebars, notices, adverts, forms or
   comments never do.
2. In each host the distinct paths are put in order, and each path is paired
   with the neighbour that shares the longest beginning with it.
3. A page's lines are aligned with all of its partner's, also those outside a main
   part and in menus and the like, by their longest common subsequence, and what
   both have is deleted. In a main part that the page names, whole blocks (``div``,
   which says nothing of its content) are aligned instead: one that the partner's
   main part has too, with the same lines at the same place, is part of the design
   and is deleted. Single lines stay there, as articles quote the same passages and
   menus and adverts quote articles. A page that has nearly all of its text or its
   ``LONGEST`` longest lines in common with its partner is a copy of it rather than
   another page of the same design, and loses nothing.

Repeated lines match in order of occurrence: the k-th with the k-th.

A null or empty page has an empty text, and so has one without visible text. A
page whose host has no other path, or whose URL is null, is not differenced.
Repeated rows give repeated results. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate
from typing import NamedTuple
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltalake.llm.text import Batch, compressed, map_batches, texts, unpacked
from voltalake.session import stage

COPY = 0.9  # from this share of its characters on, a page is a copy of its partner
LONGEST = 3  # or if so many of its longest lines are its partner's
PARSED = (
    "page_id long, url string, host string, path string, named boolean, "
    "keys array<long>, shown array<long>, blocks array<long>, spans array<long>, packed binary"
)
RESULT = "page_id long, url string, text string, n_chars long"

# Fixed values of the HTML standard: elements without visible text, elements
# that are part of a line, elements without an end tag, and elements that an
# element of the same kind, or the end of the parent, ends.
HIDDEN = "script style template noscript svg math head iframe object select textarea".split()
INLINE = (
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q "
    "ruby rt rp s samp small span strike strong sub sup time tt u var wbr br"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
OPTIONAL = "p li dt dd tr td th option thead tbody tfoot".split()
# Elements and names (of classes, ids and roles) that do not belong to the text.
ASIDE = "nav header footer aside form button menu dialog".split()
NAMES = (
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments "
    "complementary contentinfo cookie cookies disclaimer footer form header login masthead menu "
    "nav navbar navigation newsletter notice popup promo promoted related search share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget"
).split()
MAIN = "article main".split()
BLOCK = "div"

HIDDEN_SET, INLINE_SET, VOID_SET = map(frozenset, (HIDDEN, INLINE, VOID))
OPTIONAL_SET, ASIDE_SET, NAME_SET, MAIN_SET = map(frozenset, (OPTIONAL, ASIDE, NAMES, MAIN))
RAW = "|".join(("script", "style", "textarea", "template", "noscript", "iframe", "svg"))
# A comment, a raw element with its content, or a tag. What is not closed reaches to
# the end of the page, as in the standard, so that no part is looked at twice.
MARKUP = re.compile(
    rf"(<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\2\s*>|\Z)"
    r"|<[!?/]?[a-zA-Z](?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+(?:>|\Z))",
    re.S | re.I,
)
# References to characters far beyond the last one, whose numbers have no end.
ENDLESS = re.compile(r"&#(?:[0-9]{20,}|[xX][0-9a-fA-F]{20,});?")
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
PART = re.compile(r"[a-z]+")
# The hash of a block's lines is a polynomial of theirs, so that nested blocks share it.
FIELD, BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E68


class Block(NamedTuple):
    """A block of a main part: hash of its place and lines, and the first line and the
    one after the last."""

    key: int
    start: int
    end: int


def _decoded(parts: list[str]) -> str:
    """The text of a line's parts, with references decoded and white space joined."""
    text = ENDLESS.sub("\N{REPLACEMENT CHARACTER}", "".join(parts))
    return " ".join(html.unescape(text).split())


def _words(tag: str) -> list[str]:
    """Words of the tag's classes, id and role."""
    values = (next(filter(None, m), "") for m in NAMED.findall(tag))
    return [word for value in values for word in value.lower().split()]


def _place_of(tag: str, above: int) -> int:
    """Hash of a block's names, without numbers, and of the blocks around it."""
    names = " ".join("-".join(PART.findall(word)) for word in _words(tag))
    return xxhash.xxh64_intdigest(f"{above} {names}")


def _is_aside(tag: str, name: str, in_main: bool) -> bool:
    if name in ASIDE_SET:
        # A header of the article itself holds its title.
        return not (in_main and name == "header")
    if name in MAIN_SET or name in ("html", "body"):
        return False
    return any(part in NAME_SET for word in _words(tag) for part in PART.findall(word))


def lines_of(page: str) -> tuple[list[str], bool]:
    """The visible lines of the page, and whether they are a main part that it names."""
    return all_lines_of(page)[:2]


def all_lines_of(page: str) -> tuple[list[str], bool, list[str], list[Block]]:
    """The same, all lines that the page shows, with those of menus and the like, and
    the blocks of the main part in the order of their ends."""
    lines: list[tuple[str, bool]] = []  # text, and whether it lies in a main part
    shown: list[str] = []
    parts: list[str] = []
    beside: list[str] = []  # of a line in a menu or the like
    open_tags: list[tuple[str, bool, bool, bool]] = []  # name, aside, main, hidden
    depth: Counter[str] = Counter()  # open tags by name
    aside = main = hidden = 0
    blocks: list[Block] = []
    # Open blocks: place, number of open tags outside, and lines before.
    open_blocks: list[tuple[int, int, int]] = []
    hashed = [0]  # of the main part's lines up to each

    def end_line() -> None:
        text = _decoded(parts)
        if text:
            lines.append((text, main > 0))
            shown.append(text)
            if main:
                hashed.append((hashed[-1] * BASE + xxhash.xxh64_intdigest(text)) % FIELD)
        parts.clear()

    def end_beside() -> None:
        text = _decoded(beside)
        if text:
            shown.append(text)
        beside.clear()

    def end_blocks(tags: int) -> None:
        """End the blocks that lie in more open tags."""
        while open_blocks and open_blocks[-1][1] >= tags:
            of, _, start = open_blocks.pop()
            end = len(hashed) - 1
            if end > start:
                inside = (hashed[end] - hashed[start] * pow(BASE, end - start, FIELD)) % FIELD
                key = xxhash.xxh64_intdigest(f"{of} {end - start} {inside}")
                blocks.append(Block(key, start, end))

    at = 0
    for match in MARKUP.finditer(page):
        if not hidden and match.start() > at:
            (beside if aside else parts).append(page[at : match.start()])
        at = match.end()
        tag = match.group()
        named = TAG.match(tag)
        if match.group(2) or not named:
            continue
        closing, name = named.group(1), named.group(2).lower()
        if name == "br":
            if not hidden:
                (beside if aside else parts).append(" ")
            continue
        if name not in INLINE_SET:
            end_beside()
            if not aside:
                end_line()
            parts.clear()
        if closing or name in OPTIONAL_SET:
            ends = depth[name] > 0 if closing else bool(open_tags) and open_tags[-1][0] == name
            while ends:
                last, was_aside, was_main, was_hidden = open_tags.pop()
                depth[last] -= 1
                aside -= was_aside
                main -= was_main
                hidden -= was_hidden
                ends = last != name
            end_blocks(len(open_tags))
            if not aside:
                end_beside()
        if not closing and name not in VOID_SET and not tag.endswith("/>"):
            is_hidden = name in HIDDEN_SET
            is_aside = is_hidden or _is_aside(tag, name, main > 0)
            is_main = name in MAIN_SET
            if name == BLOCK and main and not aside and not is_aside:
                above = open_blocks[-1][0] if open_blocks else 0
                open_blocks.append((_place_of(tag, above), len(open_tags), len(hashed) - 1))
            open_tags.append((name, is_aside, is_main, is_hidden))
            depth[name] += 1
            aside += is_aside
            main += is_main
            hidden += is_hidden
    if not hidden:
        (beside if aside else parts).append(page[at:])
    end_beside()
    if not aside:
        end_line()
    end_blocks(0)
    if len(hashed) > 1:
        return [text for text, inside in lines if inside], True, shown, blocks
    return [text for text, _ in lines], False, shown, []


def _signed(hashes: list[int]) -> np.ndarray:
    return np.array(hashes, np.uint64).view(np.int64)


def _keys(lines: list[str]) -> np.ndarray:
    return _signed([xxhash.xxh64_intdigest(x) for x in lines])


def place(url: str | None) -> tuple[str | None, str | None]:
    """Host and path of a URL; what only selects a view of the page is left out."""
    try:
        parts = urlsplit((url or "").strip())
        host = parts.hostname
    except ValueError:
        return None, None
    if not host:
        return None, None
    path = re.sub(r"/+$", "", parts.path)
    path = re.sub(r"\.(?:html?|php|aspx?)$", "", path) or "/"
    return re.sub(r"^(?:www|m)\.", "", host.lower()), path


def parsed(pages: DataFrame) -> DataFrame:
    """Place of each page, hashes of its lines, of all that it shows and of the blocks of
    its main part, with the ends of these, and the lines, compressed."""

    def parse(batch: Batch) -> Batch:
        urls = batch.column("url").to_pylist()
        hosts, paths = zip(*map(place, urls), strict=True)
        found = [all_lines_of(x.decode()) for x in texts(batch, "html")]
        lines, named, shown, blocks = zip(*found, strict=True)
        hashes = pa.list_(pa.int64())
        return pa.record_batch(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(hosts, pa.string()),
                pa.array(paths, pa.string()),
                pa.array(named, pa.bool_()),
                pa.array(map(_keys, lines), hashes),
                pa.array(map(_keys, shown), hashes),
                pa.array([_signed([b.key for b in x]) for x in blocks], hashes),
                pa.array([[at for b in x for at in (b.start, b.end)] for x in blocks], hashes),
                compressed(["\n".join(x).encode() for x in lines]),
            ],
            [
                "page_id", "url", "host", "path", "named",
                "keys", "shown", "blocks", "spans", "packed",
            ],
        )

    return map_batches(pages.select("page_id", "url", "html"), PARSED, parse)


def partners(pages: DataFrame) -> DataFrame:
    """(host, path, partner, partner_blocks): the hashed lines and blocks of the nearest
    other path's first page.

    Distinct paths are sorted over the whole cluster and numbered by sorted
    part, so a host with a third of all pages is spread like any other; the
    neighbours then meet by joins on the number.
    """
    first = (
        pages.filter("host is not null")
        .groupBy("host", "path")
        .agg(F.min(F.struct("page_id", "keys", "blocks")).alias("page"))
    )
    ordered = stage(
        first.orderBy("host", "path").select(
            "host",
            "path",
            F.col("page.keys").alias("keys"),
            F.col("page.blocks").alias("blocks"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "paths",
    )
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # A row for each task of the sort.
    numbered = ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
    numbered = numbered.select(
        "host", "path", "keys", "blocks", (F.col("offset") + inside).alias("number")
    )

    def other(step: int, name: str) -> DataFrame:
        return numbered.select(
            (F.col("number") - step).alias("number"),
            F.struct("host", "path", "keys", "blocks").alias(name),
        )

    near = numbered.join(other(1, "next"), "number", "left").join(
        other(-1, "last"), "number", "left"
    )

    def shared(name: str):
        """Common beginning of both paths, or nothing if the host is another."""
        n = F.array_max(
            F.transform(
                F.sequence(F.lit(0), F.least(F.length("path"), F.length(f"{name}.path"))),
                lambda k: F.when(
                    F.substring("path", F.lit(1), k) == F.substring(f"{name}.path", F.lit(1), k), k
                ).otherwise(0),
            )
        )
        return F.when(F.col(f"{name}.host") == F.col("host"), n)

    use_last = F.coalesce(shared("last"), F.lit(-1)) >= F.coalesce(shared("next"), F.lit(-1))
    same = F.when(use_last, F.col("last")).otherwise(F.col("next"))
    of_host = F.col("other.host") == F.col("host")
    return near.select("host", "path", same.alias("other")).select(
        "host",
        "path",
        F.when(of_host, F.col("other.keys")).alias("partner"),
        F.when(of_host, F.col("other.blocks")).alias("partner_blocks"),
    )


def _occurrences(keys: list[int]) -> list[tuple[int, int]]:
    """Each key with how often it has come before."""
    seen: Counter[int] = Counter()
    out = []
    for key in keys:
        out.append((key, seen[key]))
        seen[key] += 1
    return out


def common(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence, where repeats match in order.

    Each key then occurs once on either side, so it is the longest increasing
    run of places in ``b``.
    """
    place_in_b = {key: k for k, key in enumerate(_occurrences(b))}
    pairs = [
        (k, place_in_b[key]) for k, key in enumerate(_occurrences(a)) if key in place_in_b
    ]
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for n, (_, at) in enumerate(pairs):
        k = bisect_left(tails, at)
        before.append(ends[k - 1] if k else -1)
        if k == len(tails):
            tails.append(at)
            ends.append(n)
        else:
            tails[k], ends[k] = at, n
    out = []
    n = ends[-1] if ends else -1
    while n >= 0:
        out.append(pairs[n][0])
        n = before[n]
    return out[::-1]


def kept_lines(lines: list[str], keys: list[int], partner: list[int] | None) -> list[str]:
    """The lines that the partner does not share."""
    if not partner or not lines:
        return lines
    return _without(lines, set(common(keys, partner)))


def kept_blocks(
    lines: list[str], blocks: list[int], spans: list[int], partner: list[int] | None
) -> list[str]:
    """The lines of a named main part without the blocks that the partner shares.

    ``spans`` has the first line of each block and the one after its last.
    """
    if not partner or not blocks:
        return lines
    # How many shared blocks begin or end before a line; blocks may lie in others.
    steps = [0] * (len(lines) + 1)
    for k in common(blocks, partner):
        steps[spans[2 * k]] += 1
        steps[spans[2 * k + 1]] -= 1
    return _without(lines, {k for k, n in enumerate(accumulate(steps[:-1])) if n})


def _without(lines: list[str], shared: set[int]) -> list[str]:
    """The lines without those at some places, but all of a page that is a copy."""
    size = sum(map(len, lines))
    longest = sorted(range(len(lines)), key=lambda k: -len(lines[k]))[:LONGEST]
    if sum(len(lines[k]) for k in shared) >= COPY * size or shared.issuperset(longest):
        return lines
    return [x for k, x in enumerate(lines) if k not in shared]


def main_text(pages: DataFrame) -> DataFrame:
    """A row for each page: its main text and the number of its characters.

    Pages are parsed twice, once for the hashes of their lines and once for the
    lines, which is cheaper than to store the lines.
    """
    rows = parsed(pages)
    whole = rows.select("page_id", "host", "path", F.col("shown").alias("keys"), "blocks")
    near = partners(stage(whole, "lines"))
    named = F.col("named")
    # A page is aligned by its lines or by its blocks, and only those meet its partner's.
    joined = rows.join(near, ["host", "path"], "left").select(
        "page_id",
        "url",
        "named",
        "packed",
        "spans",
        F.when(named, F.col("blocks")).otherwise(F.col("keys")).alias("keys"),
        F.when(named, F.col("partner_blocks")).otherwise(F.col("partner")).alias("partner"),
    )

    def difference(batch: Batch) -> Batch:
        kept = []
        of = zip(
            unpacked(batch),
            batch.column("named").to_pylist(),
            batch.column("keys").to_pylist(),
            batch.column("spans").to_pylist(),
            batch.column("partner").to_pylist(),
            strict=True,
        )
        for text, is_named, keys, spans, partner in of:
            lines = text.decode().split("\n") if text else []
            if is_named:
                lines = kept_blocks(lines, keys, spans, partner)
            else:
                lines = kept_lines(lines, keys, partner)
            kept.append("\n".join(lines))
        return pa.record_batch(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(kept, pa.string()),
                pa.array(map(len, kept), pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )

    return map_batches(joined, RESULT, difference)
