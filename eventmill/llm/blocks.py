"""Leaf blocks of an HTML page and their feature vectors.

A block is a run of text between block-level tags, with the path of open elements it
stands in. Tag soup is taken as it comes: a block-level tag ends an open paragraph, an
end tag closes up to its start, unclosed elements end with the page. Comments,
scripts, styles, the head and other raw-text elements give no text. A tag that the page
ends in is markup. Reading is linear in the page, however deep or broken its tags are.
"""

from __future__ import annotations

import html as entities
import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np

RAW = "script|style|textarea|title|iframe|noembed|noframes|template|svg|xmp"
# Attributes end as in browsers: a quote counts only right behind the equals sign. One that
# is never closed is a plain character, so that the rest of the page is not lost.
GAP = r"[ \t\n\f\r]"
VALUE = r"""(?>"([^"]*+)"|'([^']*+)'|((?:[^ \t\n\f\r>"'][^ \t\n\f\r>]*+|["'][^ \t\n\f\r>]*+)?+))"""
ATTRIBUTE = re.compile(
    rf"(?:{GAP}|/)*+([^ \t\n\f\r/>][^ \t\n\f\r/>=]*+)(?:{GAP}*+={GAP}*+{VALUE})?+"
)
PLAIN = re.sub(r"\((?!\?)", "(?:", ATTRIBUTE.pattern)
TAIL = rf"(?>{PLAIN})*+(?:{GAP}|/)*+"
EDGE = r"(?=[ \t\n\f\r/>]|\Z)"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW}){EDGE}{TAIL}(?:>.*?(?:</(?P=raw){EDGE}[^>]*+(?:>|\Z)|\Z)|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^ \t\n\f\r/>]*+)(?P<attrs>{TAIL})(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br button cite code data del dfn em font i img input ins kbd label "
    "mark meter output picture progress q rp rt ruby s samp small span strike strong sub sup time "
    "tt u var wbr link meta".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

PATH_BUCKETS, WORD_BUCKETS, NUMBERS = 192, 48, 10
WIDTH = PATH_BUCKETS + WORD_BUCKETS + NUMBERS


# Names that say whether an element, or one around it, belongs to the article.
ARTICLE = frozenset(("article", "main"))
BOILER = frozenset(
    "nav header footer aside form noscript button select dialog menu "
    ".ad .ads .advert .sidebar .comment .comments .footer .header .menu .nav .cookie .notice "
    ".related .share .promo .banner .widget".split()
)


class Element:
    """An open element. What it inherits is kept as sets of bounded size, so that a deep
    path costs no more than a short one."""

    __slots__ = ("names", "parent", "buckets", "marks")

    def __init__(self, names: tuple[str, ...], parent: Element | None):
        self.names, self.parent = names, parent
        self.buckets = frozenset(bucket(n) for n in names)
        self.marks = (ARTICLE | BOILER).intersection(names)
        if parent is not None:
            self.buckets |= parent.buckets
            self.marks |= parent.marks


@dataclass
class Block:
    text: str
    path: Element | None  # the innermost open element
    link_chars: int


def bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % PATH_BUCKETS


def names_of(tag: str, attrs: str) -> tuple[str, ...]:
    """The tag, then the words of class, id and role."""
    parts = [tag]
    attrs = attrs.rstrip(" \t\n\f\r/")
    if attrs:
        for name, *values in ATTRIBUTE.findall(attrs):
            name, value = name.lower(), "".join(values)
            if name == "hidden" or (name == "aria-hidden" and value.lower() != "false"):
                parts.append(".hidden")
            elif name in ("class", "id", "role"):
                parts += ["." + w.lower() for w in NAME_PART.findall(value)]
    return tuple(parts)


def leaf_blocks(page: str | None) -> list[Block]:
    page = page or ""
    out: list[Block] = []
    stack: list[Element] = []
    known: dict[tuple, Element] = {}  # equal elements in equal places are one
    open_tags: Counter = Counter()
    pieces: list[str] = []
    path: Element | None = None
    links = in_links = 0

    def flush():
        nonlocal links
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                out.append(Block(text, path, links))
            pieces.clear()
        links = 0

    def add(text: str):
        nonlocal path, links
        if not text:
            return
        if not pieces:
            if text.isspace():
                return
            path = stack[-1] if stack else None
        pieces.append(text)
        if in_links:
            links += len(text)

    def pop():
        open_tags[stack.pop().names[0]] -= 1

    at = 0
    for m in TOKEN.finditer(page):
        if at < m.start() and not (stack and stack[0].names[0] == "head"):
            add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["raw"]:
                add(" ")
            continue
        tag = tag.lower()
        if tag == "html":
            continue
        if tag in INLINE:
            if tag == "a":
                in_links = 0 if m["end"] else 1
            elif tag == "br":
                add("\n")
            continue
        flush()
        if m["end"]:
            if open_tags[tag] > 0:
                while stack[-1].names[0] != tag:
                    pop()
                pop()
            continue
        if tag == "body" and stack and stack[0].names[0] == "head":
            stack.clear()
            open_tags.clear()
        if stack and stack[-1].names[0] == "p":
            pop()
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1].names[0] == tag:
            pop()
        if tag not in VOID and not m["attrs"].endswith("/"):
            parent = stack[-1] if stack else None
            key = (tag, m["attrs"], id(parent))
            if key not in known:
                known[key] = Element(names_of(tag, m["attrs"]), parent)
            stack.append(known[key])
            open_tags[tag] += 1
        in_links = 0
    if at < len(page) and not (stack and stack[0].names[0] == "head"):
        add(page[at:])
    flush()
    return out


def path_buckets(path: Element | None) -> set[int]:
    """Buckets of the names on a whole path; of the nearest two elements by distance too."""
    found = set(path.buckets) if path else set()
    for depth in range(2):
        if path is None:
            break
        found.update(bucket(f"{depth}{name}") for name in path.names)
        path = path.parent
    return found


def vectors(blocks: list[Block]) -> np.ndarray:
    """Features of a page's blocks: hashed tag paths, hashed words, shape of the text."""
    n = len(blocks)
    out = np.zeros((n, WIDTH), np.float32)
    crc = zlib.crc32
    for i, block in enumerate(blocks):
        row = out[i]
        row[list(path_buckets(block.path))] = 1.0
        text = block.text
        words = text.lower().encode("utf-8", "replace").split()
        counts = np.bincount([crc(w) % WORD_BUCKETS for w in words], minlength=WORD_BUCKETS)
        row[PATH_BUCKETS : PATH_BUCKETS + WORD_BUCKETS] = np.sqrt(counts / len(words))
        size = len(text)
        row[-NUMBERS:] = (
            math.log1p(size) / 6, math.log1p(len(words)) / 5, min(1.0, block.link_chars / size),
            text.count(",") / len(words), text.count(".") / len(words),
            text[-1] in ".!?:;\"'", text[0].isupper(), "©" in text or "@" in text,
            i / n, 1.0 / n,
        )
    return out
